"""The registered queries, the tables they start from, and their SQL counterparts."""

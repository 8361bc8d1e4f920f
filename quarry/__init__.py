"""quarry: document preparation and retrieval as Spark DataFrame jobs."""

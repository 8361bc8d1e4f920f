"""Text as columns: white space, words, tokens, HTML tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes that Java and RE2 read alike.  The white space
# class holds every character Python's ``str.strip`` removes.
SPACE_SET = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"
SPACES = f"[{SPACE_SET}]+"
NON_SPACE = f"[^{SPACE_SET}]"
SPACE_SIGNS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WORD = r"[\p{L}\p{N}_]+"
NON_WORDS = r"[^\p{L}\p{N}_]+"
TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{SPACE_SET}]"
TOKEN_WITH_SPACE = rf"(?:[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{SPACE_SET}])[{SPACE_SET}]*"

# Signs of the end of a text that are looked at first for each token that is wanted of it.
END_SIGNS = 12

# Table markup patterns.
TABLE_ROW = r"(?is)<tr[^>]*>(.*?)</tr>"
TABLE_CELL = r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"
TAG = r"<[^>]+>"

# File type -> media type, and the type used for anything else.
MEDIA_TYPES = {
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "png": "image/png",
    "gif": "image/gif",
    "webp": "image/webp",
    "image/jpg": "image/jpeg",
    "image/jpeg": "image/jpeg",
    "image/png": "image/png",
    "image/gif": "image/gif",
    "image/webp": "image/webp",
}
DEFAULT_MEDIA_TYPE = "image/png"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_SIGNS))


def is_filled(text: Column) -> Column:
    """True if there is any character that is not white space; null counts as empty."""
    return F.coalesce(F.ltrim(text, F.lit(SPACE_SIGNS)) != "", F.lit(False))


def single_spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, F.lit(SPACES), F.lit(" ")))


def words(text: Column) -> Column:
    """Lower-cased word tokens, the unit of lexical search."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def spaced_words(text: Column) -> Column:
    """What ``words`` gives, as one text with a blank between words; null if there are none."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(text), F.lit(NON_WORDS), F.lit(" "))), F.lit(""))


def token_count(text: Column) -> Column:
    """Size of a text in tokens: a run of letters and digits, or one other visible sign."""
    # Each token and the white space after it become one sign, which makes no string per token.
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), F.lit(TOKEN_WITH_SPACE), F.lit("."))
    return F.length(F.ltrim(marks, F.lit(SPACE_SIGNS)))


def last_tokens(text: Column, count: Column) -> Column:
    """The last ``count`` tokens of a text, spacing kept, ends stripped."""

    def pieces(part: Column) -> Column:
        return F.regexp_extract_all(part, F.lit(TOKEN_WITH_SPACE), F.lit(0))

    def last(found: Column) -> Column:
        wanted = F.slice(found, F.greatest(F.size(found) - count, F.lit(0)) + 1, F.greatest(count, F.lit(0)))
        return strip(F.array_join(wanted, ""))

    # Only the first piece of the end of a text may be part of a token: if more are found than are wanted, those wanted are whole.
    end = F.right(text, count * END_SIGNS + END_SIGNS)
    return bind(pieces(end), lambda found: F.when(F.size(found) > count, last(found)).otherwise(bind(pieces(text), last)))


def media_type(filetype: Column) -> Column:
    known = F.create_map(*[F.lit(part) for pair in MEDIA_TYPES.items() for part in pair])
    name = strip(F.lower(F.coalesce(filetype, F.lit("png"))))
    return F.coalesce(F.try_element_at(known, name), F.lit(DEFAULT_MEDIA_TYPE))


def html_table_to_markdown(html: Column) -> Column:
    """Rows and cells of an HTML table as a Markdown table; without rows, the bare text."""

    def cell_text(cell: Column) -> Column:
        untagged = single_spaced(F.regexp_replace(cell, F.lit(TAG), F.lit("")))
        plain = F.when(cell.contains("<"), untagged).otherwise(F.trim(cell))
        return F.replace(F.replace(plain, F.lit("&nbsp;"), F.lit(" ")), F.lit("&amp;"), F.lit("&"))

    def line(cells: Column) -> Column:
        return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

    def table(rows: Column) -> Column:
        return bind(F.array_max(F.transform(rows, F.size)), lambda width: lines(rows, width))

    def lines(rows: Column, width: Column) -> Column:
        body = F.transform(rows, lambda r: line(F.concat(r, F.array_repeat(F.lit(""), width - F.size(r)))))
        rule = F.array(line(F.array_repeat(F.lit("---"), width)))
        return F.array_join(F.concat(F.slice(body, 1, 1), rule, F.slice(body, 2, F.size(body))), "\n")

    # White space is made single once for the whole table: only cells with tags inside need patterns of their own.
    spaced = F.regexp_replace(html, F.lit(SPACES), F.lit(" "))
    rows = F.filter(
        F.transform(
            F.regexp_extract_all(spaced, F.lit(TABLE_ROW), F.lit(1)),
            lambda row: F.transform(F.regexp_extract_all(row, F.lit(TABLE_CELL), F.lit(1)), cell_text),
        ),
        lambda cells: F.size(cells) > 0,
    )
    bare = single_spaced(F.regexp_replace(html, F.lit(TAG), F.lit(" ")))
    return bind(rows, lambda found: F.when(F.size(found) > 0, table(found)).otherwise(bare))

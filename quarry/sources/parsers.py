"""Raw content to ordered elements, one content per row and no shuffle.

Each ``*_elements`` function turns a content column into an array of element
structs inside the row; ``explode_elements`` makes it one row per element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.rows import unfold
from quarry.functions.text import NON_SPACE, bind, single_spaced, strip
from quarry.schemas import ELEMENT_METADATA

# What the HTML rules look for.  RE2 and Java read them alike.
HTML_DROPPED = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<head\b.*?</head>|<!doctype[^>]*>"
HTML_BLOCK = (
    r"(?is)(<table\b.*?</table>|<img\b[^>]*>|"
    r"</?(?:h[1-6]|p|li|ul|ol|div|nav|article|section|main|aside|header|footer|body|html|blockquote|pre)\b[^>]*>)"
)
HTML_BREAK = r"(?i)<br\b[^>]*>"
HTML_TAG = r"<[^>]+>"
HTML_DATA_IMAGE = r"(?is)^<img\b[^>]*\bsrc=[\"']data:image/([a-z]+);base64,([^\"']*)[\"']"
BLOCK_START = "\x01"
BLOCK_END = "\x02"
TITLE_MAX_CHARS = 80
CELL_END = "\x01"
ROW_END = "\x02"
# A cell, and the comma or line end after it; the possessive loops need no stack, however long the cell.
CSV_CELL = r'("[^"]*+(?:""[^"]*+)*+"[^,\r\n]*+|[^,\r\n"][^,\r\n]*+|)(,|\r\n|\n)'
CSV_QUOTED = r'(?s)\A"([^"]*+(?:""[^"]*+)*+)"(.*)\z'


def _metadata(**known: Column) -> Column:
    fields = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ELEMENT_METADATA.fields]
    return F.struct(*fields)


def _element(kind: Column, text: Column, **known: Column) -> Column:
    return F.struct(kind.alias("type"), text.alias("text"), _metadata(**known).alias("metadata"))


def text_elements(content: Column) -> Column:
    """Plain text or Markdown: one element per non-blank line.

    ``# …`` is a Title, ``- …`` / ``* …`` a ListItem, a short line with a letter and
    without closing punctuation a Title, anything else NarrativeText.
    """

    def line_element(line: Column) -> Column:
        # Most lines are told by their first sign, without a pattern.
        hashed, listed = line.startswith("#"), line.startswith("-") | line.startswith("*")
        short = (F.length(line) <= TITLE_MAX_CHARS) & line.rlike(r"\p{L}") & ~line.rlike(r"[.!?:;,]\z")
        kind = (
            F.when(hashed & line.rlike(r"\A#+ "), "Title")
            .when(listed & line.rlike(r"\A[-*] "), "ListItem")
            .when(short, "Title")
            .otherwise("NarrativeText")
        )
        marked = (hashed | listed) & line.rlike(r"\A(?:#+|[-*]) ")
        return _element(kind, F.when(marked, strip(F.regexp_replace(line, r"\A(?:#+|[-*]) ", ""))).otherwise(line))

    lines = F.transform(F.split(content, "\n"), strip)
    return F.transform(F.filter(lines, lambda line: line != ""), line_element)


def _unescape(text: Column) -> Column:
    # The entities undone here; ``&amp;`` last, so nothing is undone twice.
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return text


def html_elements(content: Column) -> Column:
    """Web pages: headings, paragraphs, list items, tables and inline (data) images.

    Block tags cut the page into pieces; the tag that opens a piece names its type.
    Text after any other block tag is kept as UncategorizedText.
    """

    def plain(markup: Column) -> Column:
        broken = F.regexp_replace(markup, F.lit(HTML_BREAK), F.lit(" "))
        return single_spaced(_unescape(F.regexp_replace(broken, F.lit(HTML_TAG), F.lit(""))))

    def piece_elements(piece: Column) -> Column:
        return bind(
            F.struct(
                F.substring_index(piece, BLOCK_END, 1).alias("tag"),
                plain(F.substring_index(piece, BLOCK_END, -1)).alias("text"),
            ),
            lambda p: tagged_elements(p["tag"], p["text"]),
        )

    def tagged_elements(tag: Column, text: Column) -> Column:
        name = F.lower(F.regexp_extract(tag, r"(?i)^<([a-z0-9]+)", 1))
        kind = (
            F.when(name.rlike("^h[1-6]$"), "Title")
            .when(name == "p", "NarrativeText")
            .when(name == "li", "ListItem")
            .otherwise("UncategorizedText")
        )
        spaced_cells = F.regexp_replace(tag, F.lit(HTML_TAG), F.lit(" "))
        table = _element(F.lit("Table"), single_spaced(_unescape(spaced_cells)), text_as_html=tag)
        image = _element(
            F.lit("Image"),
            F.lit(""),
            image_base64=F.regexp_extract(tag, HTML_DATA_IMAGE, 2),
            filetype=F.lower(F.regexp_extract(tag, HTML_DATA_IMAGE, 1)),
        )
        return F.concat(
            F.filter(F.array(table), lambda _: name == "table"),
            F.filter(F.array(image), lambda e: (name == "img") & (e["metadata"]["image_base64"] != "")),
            F.filter(F.array(_element(kind, text)), lambda e: e["text"] != ""),
        )

    unmarked = F.translate(content, BLOCK_START + BLOCK_END, "  ")
    kept = F.regexp_replace(unmarked, F.lit(HTML_DROPPED), F.lit(""))
    marked = F.regexp_replace(kept, F.lit(HTML_BLOCK), F.lit(f"{BLOCK_START}$1{BLOCK_END}"))
    # The text before the first block tag has no tag of its own.
    pieces = F.transform(
        F.split(marked, BLOCK_START),
        lambda piece, i: F.when(i == 0, F.concat(F.lit(BLOCK_END), piece)).otherwise(piece),
    )
    return F.flatten(F.transform(pieces, piece_elements))


def csv_elements(content: Column) -> Column:
    """Comma-separated text: one Table element per file.

    A cell that begins with a quote goes to the closing quote, over commas and line ends; two
    quotes in it are one.  A quote that is never closed, or inside a plain cell, is a sign like others.
    """
    # Each cell is marked together with what ends it, then line ends become row ends.
    marked = F.regexp_replace(F.translate(content, CELL_END + ROW_END, "  "), F.lit(CSV_CELL), F.lit(f"$1{CELL_END}$2{ROW_END}"))
    for separator, end in ((",", CELL_END), ("\r\n", ROW_END), ("\n", ROW_END)):
        marked = F.replace(marked, F.lit(f"{CELL_END}{separator}{ROW_END}"), F.lit(end))

    def plain(cell: Column) -> Column:
        inside = F.replace(F.regexp_extract(cell, CSV_QUOTED, 1), F.lit('""'), F.lit('"'))
        unquoted = F.concat(inside, F.regexp_extract(cell, CSV_QUOTED, 2))
        return strip(F.when(cell.rlike(CSV_QUOTED), unquoted).otherwise(cell))

    rows = F.transform(
        F.filter(F.split(marked, ROW_END), lambda line: line.rlike(NON_SPACE)),
        lambda line: F.transform(F.split(line, CELL_END), plain),
    )

    def table(found: Column) -> Column:
        html = F.array_join(
            F.transform(
                found,
                lambda r: F.concat(
                    F.lit("<tr>"),
                    F.array_join(F.transform(r, lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))), ""),
                    F.lit("</tr>"),
                ),
            ),
            "",
        )
        text = F.array_join(F.transform(found, lambda r: F.array_join(r, " ")), "\n")
        return _element(F.lit("Table"), text, text_as_html=F.concat(F.lit("<table>"), html, F.lit("</table>")))

    return bind(rows, lambda found: F.filter(F.array(table(found)), lambda _: F.size(found) > 0))


def file_elements(content: Column, extension: Column) -> Column:
    """Elements of a file by its (lower-case) suffix; null for a type no rule reads."""
    return (
        F.when(extension.isin(".html", ".htm"), html_elements(content))
        .when(extension == ".csv", csv_elements(content))
        .when(extension.isin(".txt", ".md"), text_elements(content))
    )


def explode_elements(documents: DataFrame, elements: str = "elements") -> DataFrame:
    """Rows (document, elements) to the elements table."""
    return unfold(documents, ["document"], F.col(elements), "e", "pos").select(
        "document", "pos", "e.type", "e.text", "e.metadata"
    )


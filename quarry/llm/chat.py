"""Chat formatting: records of any known layout become canonical turns, and turns become marked text.

**Schema fingerprints.** A record is a variant. Its nested field paths, without the types of single values, are hashed, and
the hash selects one of the declared mappings; a mapping names the path of a list of messages, or the paths of single texts
with the roles they stand for. Records with no mapping come back from ``unmapped``.

**Template.** A turn is ``### role``, a line feed, the text, and ``</turn>`` with a line feed. In roles and texts the backslash
becomes ``\\b``, ``#`` becomes ``\\h`` and ``<`` becomes ``\\l`` (in roles also line feed ``\\n``), so that neither mark can occur
in them and ``unescape`` gives back the text exactly. ``segments`` has the role, start and end (code points) of every text
in the formatted string and whether it is under the loss mask.

Only DataFrame functions are used. Turns are shuffled once, by conversation; a conversation is one row of the result by its
nature, so its turns meet in one task.

Defined results: null text and null role are empty; null conv_id is one conversation; turns are ordered by turn (null
last), then role, then text, so ties and repeated rows have a place; an empty table gives no rows; an empty list of
messages gives a record without turns, which is not formatted; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN, CLOSE = "### ", "</turn>\n"
LOSS_ROLES = ("assistant",)


@dataclass(frozen=True)
class Mapping:
    """How records of one layout become turns.

    ``layout``: the field paths as ``fingerprint_text`` writes them. ``key``, ``turn``: paths of the conversation's id and of
    the number of the (first) turn, or None. Either ``messages`` (path of a list) with ``role`` and ``text`` inside each
    message, or ``parts``: (role, path) or (path of the role, path) for single texts; a role path starts with ``$``.
    ``roles``: other names of roles and what they become.
    """

    layout: str
    key: str | None = "$.conv_id"
    turn: str | None = None
    messages: str | None = None
    role: str = "$.role"
    text: str = "$.content"
    parts: tuple[tuple[str, str], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


SHARED_NAMES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
MAPPINGS = (
    Mapping("OBJECT<conv_id, role, text, turn>", turn="$.turn", parts=(("$.role", "$.text"),)),
    Mapping("OBJECT<conv_id, prompt, response>", parts=(("user", "$.prompt"), ("assistant", "$.response"))),
    Mapping("OBJECT<completion, conv_id, prompt>", parts=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Mapping(
        "OBJECT<conv_id, input, instruction, output>",
        parts=(("system", "$.instruction"), ("user", "$.input"), ("assistant", "$.output")),
    ),
    Mapping("OBJECT<conv_id, instruction, output>", parts=(("user", "$.instruction"), ("assistant", "$.output"))),
    Mapping("OBJECT<conv_id, messages: ARRAY<OBJECT<content, role>>>", messages="$.messages"),
    Mapping(
        "OBJECT<conv_id, conversations: ARRAY<OBJECT<from, value>>>",
        messages="$.conversations",
        role="$.from",
        text="$.value",
        roles=SHARED_NAMES,
    ),
)


def fingerprint_text(record: Column) -> Column:
    """Nested field paths of a variant in order of their names, as text without the types of single values."""
    shape = F.schema_of_variant(record)
    return F.regexp_replace(shape, r": (?!OBJECT|ARRAY)[A-Z ]+(\(\d+, ?\d+\))?", "")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(fingerprint_text(record))


def _value(path: str | None, kind: str, of: Column) -> Column:
    return F.lit(None).cast(kind) if path is None else F.try_variant_get(of, path, kind)


def _turns(mapping: Mapping, record: Column) -> Column:
    """Array of (conv_id, turn, place, role, text) of one record."""
    known = F.create_map(*[F.lit(x) for pair in mapping.roles for x in pair]) if mapping.roles else None
    key, turn = _value(mapping.key, "long", record), _value(mapping.turn, "long", record)

    def one(role: Column, text: Column, place: Column) -> Column:
        name = role if known is None else F.coalesce(known[role], role)
        return F.struct(
            key.alias("conv_id"),
            (turn if mapping.turn else place.cast("long")).alias("turn"),
            F.coalesce(name, F.lit("")).alias("role"),
            F.coalesce(text, F.lit("")).alias("text"),
        )

    if mapping.messages:
        items = F.try_variant_get(record, mapping.messages, "array<variant>")
        return F.transform(
            items, lambda m, i: one(_value(mapping.role, "string", m), _value(mapping.text, "string", m), i)
        )
    return F.array(
        *[
            one(
                _value(role, "string", record) if role.startswith("$") else F.lit(role),
                _value(path, "string", record),
                F.lit(i),
            )
            for i, (role, path) in enumerate(mapping.parts)
        ]
    )


def canonical_turns(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """conv_id, turn, role, text for each turn of the column ``record`` (variant)."""
    record = F.col("record")
    marked = records.select("record", fingerprint(record).alias("print"))
    chosen = None
    for mapping in mappings:
        is_it, turns = F.col("print") == F.xxhash64(F.lit(mapping.layout)), _turns(mapping, record)
        chosen = F.when(is_it, turns) if chosen is None else chosen.when(is_it, turns)
    return marked.select(F.explode(chosen).alias("t")).select("t.conv_id", "t.turn", "t.role", "t.text")


def unmapped(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """How many records have each layout that no mapping declares."""
    known = [m.layout for m in mappings]
    return (
        records.select(fingerprint_text(F.col("record")).alias("layout"))
        .where(F.col("layout").isNull() | ~F.col("layout").isin(known))
        .groupBy("layout")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def escape(text: Column, line_feeds: bool = False) -> Column:
    for plain, coded in (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), *((("\n", "\\n"),) if line_feeds else ())):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in (("\n", "\\n"), ("<", "\\l"), ("#", "\\h"), ("\\", "\\b")):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def format_turns(turns: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """conv_id, formatted, segments (array of role, start, end, loss): one row per conversation."""
    head = F.concat(F.lit(OPEN), escape(F.col("role"), line_feeds=True), F.lit("\n"))
    body = escape(F.col("text"))
    pieces = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).select("conv_id", "turn", "role", "text", head.alias("head"), body.alias("body"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    long = F.length("head") + F.length("body") + len(CLOSE)
    placed = pieces.withColumn("n", F.row_number().over(order)).withColumn(
        "begin", F.coalesce(F.sum(long).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    start = F.col("begin") + F.length("head")
    row = F.struct(
        "n",
        F.struct(
            "role",
            start.cast("long").alias("start"),
            (start + F.length("body")).cast("long").alias("end"),
            F.col("role").isin(*loss_roles).alias("loss"),
        ).alias("segment"),
        F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
    )
    return (
        placed.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(row)).alias("rows"))
        .select(
            "conv_id",
            F.array_join("rows.piece", "").alias("formatted"),
            F.col("rows.segment").alias("segments"),
        )
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted_chars, turns (array of role, text), learned (texts under the mask), from the formatted text alone.

    The text of a turn is what stands between its head and its end mark; the text under the mask is cut out by the
    offsets of the mask, counted from the end of the segment before.
    """
    parts = F.slice(F.split("formatted", CLOSE, -1), F.lit(1), F.size("segments"))
    rows = formatted.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"), "segments", parts.alias("parts")
    )
    skip = F.lit(len(OPEN) + 1)
    turns = F.transform(
        "parts",
        lambda x: F.struct(
            unescape(F.substring(x, skip, F.locate("\n", x) - skip)).alias("role"),
            unescape(F.substring(x, F.locate("\n", x) + 1, F.length(x))).alias("text"),
        ),
    )
    begin = lambda i: F.coalesce(F.get("segments", i - 1)["end"] + len(CLOSE), F.lit(0))
    learned = F.transform(
        "segments",
        lambda s, i: F.when(
            s["loss"],
            unescape(
                F.substring(F.get("parts", i), (s["start"] - begin(i) + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
            ),
        ),
    )
    return rows.select(
        "conv_id", "formatted_chars", turns.alias("turns"), F.filter(learned, lambda x: x.isNotNull()).alias("learned")
    )

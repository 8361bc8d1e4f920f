"""Elements to chunks.

Texts and images stay in *stretches* of a document, rows of at most ``STRETCH`` positions; text documents become such rows
where they are read, without a shuffle.  Where groups begin and end is found from the numbers of the elements alone (tokens, kinds,
and vectors for similarity grouping), which are gathered by document, or, of documents as long as they like, in blocks: each block
is a map from the ways a group may enter it to the way the last one leaves it, and the way through all blocks is
found by composing maps (``entry_nodes``).  Groups then go to the stretch their elements lie in.  Only a group that lies in
several stretches is put together from rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions.rows import unfold
from quarry.functions.text import bind, html_table_to_markdown, is_filled, last_tokens, token_count
from quarry.operators.borders import (
    ALONE,
    OVERLAP_MARK,
    OVERLAP_MARK_TOKENS,
    TEXT,
    TITLE,
    ChunkParams,
    exit_column,
    group_column,
)
from quarry.operators.elements import STAND_ALONE, is_valid, reading_text, valid_elements
from quarry.session import cut_lineage

# Positions of a document whose elements, with all they hold, stand in one row.
STRETCH = 1_000

IMAGE_FIELDS = ("image_base64", "image_description", "filetype")


# -- rows -------------------------------------------------------------------------


def _measured(kind: Column, text: Column, metadata: Column) -> list[Column]:
    """What grouping and output need to know of one element; the text of a title is its ``body``."""
    body = reading_text(kind, text, metadata["text_as_html"])
    kind_code = F.when(kind.isin(*STAND_ALONE), ALONE).when(kind == "Title", TITLE).otherwise(TEXT)
    return [
        kind.alias("type"),
        body.alias("body"),
        token_count(text).alias("tokens"),
        F.coalesce(kind_code, F.lit(TEXT)).alias("kind"),
        metadata["page_number"].alias("page_number"),
        *[metadata[f].alias(f) for f in IMAGE_FIELDS],
    ]


def rows_of_arrays(documents: DataFrame) -> DataFrame:
    """Rows (document, elements) whose elements already stand together: no shuffle."""
    valid = F.filter(
        "elements", lambda e: is_valid(F.coalesce(e["type"], F.lit("")), e["text"], e["metadata"]["image_base64"])
    )
    measured = F.transform(valid, lambda e: F.struct(*_measured(e["type"], e["text"], e["metadata"])))
    return documents.select("document", measured.alias("elements"))


def stretches_of(elements: DataFrame) -> DataFrame:
    """(document, stretch, elements) of an elements table; of one with a ``vector`` column, for similarity grouping, also ``vectors``.

    The one shuffle of all that elements hold.  Elements without a document belong to the document ''.
    """
    vector = [F.col("vector")] if "vector" in elements.columns else []
    # Keys that cannot be null: joins then put no conditions of their own under the shuffle, and all uses share it.
    document = F.coalesce("document", F.lit("")).alias("document")
    stretch = F.coalesce(F.floor(F.col("pos") / STRETCH).cast("int"), F.lit(0)).alias("stretch")
    measured = valid_elements(elements).select(
        document, "pos", stretch, *vector, *_measured(F.col("type"), F.col("text"), F.col("metadata"))
    )
    fields = [c for c in measured.columns if c not in ("document", "pos", "stretch", "vector")]
    return (
        measured.groupBy("document", "stretch")
        .agg(F.array_sort(F.collect_list(F.struct("pos", F.struct(*fields).alias("e"), *vector))).alias("sorted"))
        .select("document", "stretch", F.col("sorted.e").alias("elements"), *[F.col("sorted.vector").alias("vectors") for _ in vector])
    )


def _numbers(stretches: DataFrame) -> list[Column]:
    """The numbers of the elements of a stretch, as arrays."""
    vectors = [F.col("vectors")] if "vectors" in stretches.columns else []
    return [F.col("elements.tokens").alias("tokens"), F.col("elements.kind").alias("kinds"), *vectors]


def _light(names: list[str], pick: Callable[[str], Column]) -> dict[str, Column]:
    return {name: pick(name) for name in names}


# -- groups -----------------------------------------------------------------------


def groups_of(stretches: DataFrame, params: ChunkParams) -> DataFrame:
    """(document, ordinal, chain, title, parts), one row per group; the numbers of a document are one row."""
    numbers = _numbers(stretches)
    names = [n for n in ("tokens", "kinds", "vectors") if n in stretches.select(*numbers).columns]
    gathered = (
        stretches.select("document", "stretch", *numbers)
        .groupBy("document")
        .agg(F.array_sort(F.collect_list(F.struct("stretch", *names))).alias("s"))
    )
    own_stretch = F.flatten(F.transform("s", lambda s: F.array_repeat(s["stretch"], F.size(s["tokens"]))))
    place = F.flatten(F.transform("s", lambda s: F.transform(s["tokens"], lambda _, i: i)))
    light = _light(names, lambda name: F.flatten(F.col(f"s.{name}"))) | {"stretches": own_stretch, "places": place}
    nothing = F.lit(0)
    whole = F.aggregate("s", nothing, lambda n, s: n + F.size(s["tokens"]))
    groups = gathered.select("document", group_column(params, light, whole, nothing, nothing, nothing).alias("groups"))
    return unfold(groups, ["document"], F.col("groups"), "g", "ordinal").select("document", "ordinal", "g.*")


def blocks_of(stretches: DataFrame, params: ChunkParams, block_rows: int) -> DataFrame:
    """Numbers of at most ``block_rows`` elements, and of those after them that the last group may need.

    A group ends at the latest with the element after the one that passes the size
    limit, and before a table or an image, so the elements lent from the next block are few.
    """
    numbers = _numbers(stretches)
    names = [n for n in ("tokens", "kinds", "vectors") if n in stretches.select(*numbers).columns]
    earlier = W.partitionBy("document").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    placed = stretches.select("document", "stretch", *numbers).withColumn(
        "before", F.coalesce(F.sum(F.size("tokens").cast("long")).over(earlier), F.lit(0))
    )
    each = placed.select("document", "stretch", "before", F.posexplode(F.arrays_zip(*names)).alias("place", "e")).select(
        "document", "stretch", "place", (F.col("before") + F.col("place")).alias("nth"), "e.*"
    )
    in_block = W.partitionBy("document", "block").orderBy("nth")
    weight = F.when(F.col("kinds") == ALONE, params.max_tokens + 1).otherwise(F.col("tokens"))
    spent = F.sum(weight).over(in_block.rowsBetween(W.unboundedPreceding, -2))
    dealt = each.withColumn("block", F.floor(F.col("nth") / block_rows)).withColumn(
        "lent", (F.col("block") > 0) & (F.coalesce(spent, F.lit(0)) <= params.max_tokens)
    )
    copies = F.when(F.col("lent"), F.array(F.col("block"), F.col("block") - 1)).otherwise(F.array("block"))
    here = F.col("block") == F.col("row")
    return (
        dealt.withColumn("row", F.explode(copies))
        .groupBy("document", F.col("row").alias("block"))
        .agg(
            F.array_sort(F.collect_list(F.struct("nth", "stretch", "place", *names))).alias("e"),
            F.count_if(here).cast("int").alias("own"),
            F.count_if(here & F.col("lent")).cast("int").alias("lent"),
        )
        .select(
            "document", "block", "own", "lent",
            F.col("e.stretch").alias("stretches"), F.col("e.place").alias("places"), *[F.col(f"e.{n}").alias(n) for n in names],
        )
    )


NODE = ("document", "block", "at", "overlap")


def entry_nodes(blocks: DataFrame, params: ChunkParams) -> DataFrame:
    """For each block, the node at which the true chain of its document enters it.

    Blocks work at the same time: each follows every entry it may get without repeated text, then those that any
    followed entry of its predecessor hands over, until the way from the first block meets only entries that have been followed.
    """
    arrays = [n for n in ("tokens", "kinds", "vectors") if n in blocks.columns]

    def followed(requests: DataFrame) -> DataFrame:
        asked = requests.groupBy("document", "block").agg(F.collect_list(F.struct("at", "overlap")).alias("nodes"))
        exits = exit_column(params, _light(arrays, F.col), F.col("own"), F.col("nodes"))
        return (
            blocks.join(asked, ["document", "block"])
            .select("document", "block", exits.alias("exits"))
            .select("document", "block", F.inline("exits"))
        )

    # A group ends at the latest with the last element lent to its block, so the next one
    # begins at one of these or right after them.
    entries = F.when(F.col("block") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("lent")))
    requests = blocks.select("document", "block", F.explode(entries).alias("at"), F.lit(0).alias("overlap"))
    known = cut_lineage(followed(requests))
    there = blocks.select("document", "block")
    while True:
        # The last block of a document hands nothing over.
        steps = known.select(
            *NODE, (F.col("block") + 1).alias("to_block"), F.col("exit_at").alias("to_at"), F.col("exit_overlap").alias("to_overlap")
        ).join(there.withColumnRenamed("block", "to_block"), ["document", "to_block"], "left_semi")
        reached = _reached(there.filter("block = 0"), steps)
        if reached.join(known, list(NODE), "left_anti").isEmpty():
            return reached
        handed_over = steps.select("document", F.col("to_block").alias("block"), F.col("to_at").alias("at"), F.col("to_overlap").alias("overlap"))
        new = handed_over.distinct().join(known, list(NODE), "left_anti")
        known = cut_lineage(known.unionByName(followed(new)))


def _reached(first: DataFrame, steps: DataFrame) -> DataFrame:
    """The nodes on the way from the first block of each document, as far as steps are known.

    ``steps`` go one block ahead.  Composed with themselves they go two, four, … blocks ahead, and each time the way found so
    far is doubled: as many rounds as the number of blocks has binary digits, each a join on nodes.
    """
    reached = first.select("document", "block", F.lit(0).alias("at"), F.lit(0).alias("overlap"))
    target = [F.col(f"to_{c}").alias(c) for c in NODE[1:]]
    while True:
        steps = cut_lineage(steps)
        if steps.isEmpty():
            return cut_lineage(reached)
        reached = cut_lineage(reached.unionByName(reached.join(steps, list(NODE)).select("document", *target)))
        further = steps.select("document", *target, *[F.col(f"to_{c}").alias(f"last_{c}") for c in NODE[1:]])
        second = steps.select(*NODE, *[F.col(f"to_{c}").alias(f"last_{c}") for c in NODE[1:]])
        steps = (
            steps.select("document", *[F.col(c).alias(f"from_{c}") for c in NODE[1:]], *target)
            .join(second, list(NODE))
            .select(
                "document", *[F.col(f"from_{c}").alias(c) for c in NODE[1:]], *[F.col(f"last_{c}").alias(f"to_{c}") for c in NODE[1:]]
            )
        )


def groups_of_blocks(stretches: DataFrame, params: ChunkParams, block_rows: int) -> DataFrame:
    """As ``groups_of``, of documents of any length."""
    blocks = cut_lineage(blocks_of(stretches, params, max(block_rows, params.max_tokens + 2)))
    nodes = entry_nodes(blocks, params)
    arrays = [c for c in blocks.columns if c not in ("document", "block", "own", "lent")]
    # Repeated text reaches back fewer tokens than a block holds: a block is walked from the entry of the one before it.
    before = blocks.join(nodes, ["document", "block"]).select(
        "document",
        (F.col("block") + 1).alias("block"),
        *[F.slice(c, 1, F.col("own")).alias(f"{c}_before") for c in arrays],
        F.col("own").alias("skip"),
        F.col("at").alias("at_before"),
        F.col("overlap").alias("overlap_before"),
    )
    entered = blocks.join(nodes, ["document", "block"]).join(before, ["document", "block"], "left")

    def both(name: str) -> Column:
        return F.when(F.col("skip").isNull(), F.col(name)).otherwise(F.concat(f"{name}_before", name))

    skip = F.coalesce("skip", F.lit(0))
    found = group_column(
        params, _light(arrays, both), skip + F.col("own"), skip, F.coalesce("at_before", "at"), F.coalesce("overlap_before", "overlap")
    )
    grouped = cut_lineage(entered.select("document", "block", found.alias("groups")))
    earlier = W.partitionBy("document").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    first = F.coalesce(F.sum(F.size("groups")).over(earlier), F.lit(0)).alias("first")
    counted = grouped.select("document", "block", first).join(grouped, ["document", "block"])
    return unfold(counted, ["document", "first"], F.col("groups"), "g").select(
        "document", (F.col("first") + F.col("_at")).cast("int").alias("ordinal"), "g.*"
    )


# -- chunks -----------------------------------------------------------------------


def _own_text(elements: Column, begin: Column, group: Column) -> Column:
    bodies = _members(elements, begin, group, lambda e: e["body"])
    return F.array_join(F.filter(bodies, is_filled), "\n\n")


def _members(elements: Column, begin: Column, group: Column, pick: Callable[[Column], Column]) -> Column:
    """Something of each element of a group, read by place: ``slice`` would copy the whole row first."""
    places = F.sequence(begin + group["start"], begin + group["stop"] - 1)
    return F.transform(places, lambda i: pick(elements[i]))


def _group_text(params: ChunkParams, elements: Column, begin: Column, chain: Column) -> Column:
    """Text of the last group of a chain, with the end of the text before it where that is repeated."""
    if params.overlap == 0:
        return _own_text(elements, begin, chain[0])

    def further(before: Column, group: Column) -> Column:
        repeated = F.concat(F.lit(OVERLAP_MARK), last_tokens(before, group["overlap"]))
        return F.concat(repeated, F.lit("\n\n"), _own_text(elements, begin, group))

    first = _own_text(elements, begin, chain[0])
    return F.when(F.size(chain) == 1, first).otherwise(
        F.aggregate(F.slice(chain, 2, F.size(chain) - 1), first, further)
    )


def _chunk_struct(params: ChunkParams, elements: Column, begin: Column, item: Column, title_before: Column) -> Column:
    """The chunk of ``item`` (ordinal, chain, title), whose chain begins at place ``begin`` of ``elements``."""
    chain = item["chain"]
    group = F.element_at(chain, -1)
    first = elements[begin + group["start"]]
    is_image = first["type"] == "Image"
    chunk_type = F.when(is_image, "image").when(first["type"] == "Table", "table").otherwise("text")
    title_at = begin + item["title"]
    # A title before the elements seen is the last one of the stretch before them, or of an earlier stretch.
    seen = F.filter(F.slice(elements, 1, begin), lambda e: e["type"] == "Title")
    title = (
        F.when(title_at >= 0, elements[title_at]["body"])
        .when(item["title"].isNull() & (F.size(seen) > 0), F.element_at(seen, -1)["body"])
        .otherwise(title_before)
    )
    repeated = (group["overlap"] > 0).cast("int")
    # Tables count by their Markdown, everything else by its text, already counted.
    counted = _members(elements, begin, group, lambda e: F.when(e["type"] == "Table", token_count(e["body"])).otherwise(e["tokens"]))
    tokens = F.aggregate(counted, F.lit(0), lambda total, n: total + n)
    return F.struct(
        item["ordinal"].alias("ordinal"),
        _group_text(params, elements, begin, chain).alias("original_content"),
        (tokens + group["overlap"] + repeated * OVERLAP_MARK_TOKENS).alias("text_tokens"),
        F.coalesce(chunk_type, F.lit("text")).alias("chunk_type"),
        title.alias("section_title"),
        first["page_number"].alias("page_number"),
        (group["stop"] - group["start"] + repeated).alias("element_count"),
        F.when(is_image, True).when(first["type"] == "Table", None).otherwise(False).alias("has_image"),
        *[F.when(is_image, first[f]).alias(f) for f in IMAGE_FIELDS],
    )


def _numbered(chunks: DataFrame) -> DataFrame:
    """Final chunk rows; blank ones leave a gap in the numbering."""
    return (
        chunks.withColumn("chunk_index", F.col("ordinal").cast("int"))
        .filter(is_filled(F.col("original_content")))
        .select(
            F.concat("document", F.lit("_chunk_"), "chunk_index").alias("chunk_id"),
            "document",
            "chunk_index",
            "original_content",
            "text_tokens",
            "chunk_type",
            "section_title",
            "page_number",
            "element_count",
            "has_image",
            *IMAGE_FIELDS,
        )
    )


def chunk_rows(rows: DataFrame, params: ChunkParams) -> DataFrame:
    """Chunks of documents that are one row each."""
    places = F.transform("elements", lambda _, i: i)
    light = {
        "tokens": F.col("elements.tokens"),
        "kinds": F.col("elements.kind"),
        "stretches": F.transform("elements", lambda _: F.lit(0)),
        "places": places,
    }
    nothing = F.lit(0)
    grouped = rows.withColumn("groups", group_column(params, light, F.size("elements"), nothing, nothing, nothing))
    none = F.lit(None).cast("string")

    def chunk(group: Column, ordinal: Column) -> Column:
        item = F.struct(ordinal.alias("ordinal"), group["chain"].alias("chain"), group["title"].alias("title"))
        return _chunk_struct(params, F.col("elements"), group["parts"][0]["begin"], item, none)

    chunks = F.transform("groups", chunk)
    return _numbered(unfold(grouped, ["document"], chunks, "c").select("document", "c.*"))


def _with_titles(stretches: DataFrame) -> DataFrame:
    """Stretches with ``title_before``, the text of the last title in earlier ones."""
    earlier = W.partitionBy("document").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    titles = F.filter("elements", lambda e: e["type"] == "Title")
    last = stretches.select("document", "stretch", bind(titles, lambda t: F.when(F.size(t) > 0, F.element_at(t, -1)["body"])).alias("title"))
    before = last.select("document", "stretch", F.last("title", True).over(earlier).alias("title_before"))
    return stretches.join(before, ["document", "stretch"])


def chunk_elements(elements: DataFrame, params: ChunkParams, block_rows: int | None = None) -> DataFrame:
    """Chunks of an elements table.

    The numbers of a document (some 16 bytes per element, and its vectors for similarity grouping) are one row.  With
    ``block_rows`` they are rows of so many elements (of as many as the longest group that ``params`` allow, at least), for documents of any length.
    """
    # In blocks the groups are found by jobs of their own; what these and the texts come from is then made once.
    stretches = stretches_of(elements) if block_rows is None else cut_lineage(stretches_of(elements))
    groups = groups_of(stretches, params) if block_rows is None else groups_of_blocks(stretches, params, block_rows)
    items = (
        groups.select("document", "ordinal", "chain", "title", F.size("parts").alias("n_parts"), F.posexplode("parts").alias("part", "p"))
        .select("document", "p.stretch", F.struct("ordinal", "chain", "title", "n_parts", "part", "p.begin", "p.stop").alias("item"))
        .groupBy("document", "stretch")
        .agg(F.collect_list("item").alias("items"))
    )
    titled = _with_titles(stretches.drop("vectors"))
    one = F.transform(
        F.filter("items", lambda i: i["n_parts"] == 1),
        lambda i: _chunk_struct(params, F.col("elements"), i["begin"], i, F.col("title_before")),
    )
    inside = unfold(titled.join(items, ["document", "stretch"]), ["document"], one, "c").select("document", "c.*")

    # A group that lies in several stretches: its elements in one array, after the title that holds where they begin.
    def portion(item: Column) -> Column:
        seen = F.filter(F.slice("elements", 1, item["begin"] + 1), lambda e: e["type"] == "Title")
        title = F.when(F.size(seen) > 0, F.element_at(seen, -1)["body"]).otherwise(F.col("title_before"))
        own = F.slice("elements", item["begin"] + 1, item["stop"] - item["begin"])
        return F.struct(
            item["ordinal"].alias("ordinal"), item["part"].alias("part"), item["chain"].alias("chain"),
            F.greatest(item["title"], F.lit(-1)).alias("title"), F.when(item["part"] == 0, title).alias("title_before"), own.alias("elements"),
        )

    # These are few or none; then the stretches are not looked at again.
    several = (
        unfold(items, ["document", "stretch"], F.filter("items", lambda i: i["n_parts"] > 1), "item")
        .repartition("document", "stretch")
        .groupBy("document", "stretch")
        .agg(F.collect_list("item").alias("items"))
    )
    spread = (
        unfold(titled.join(several, ["document", "stretch"]), ["document"], F.transform("items", portion), "p")
        .select("document", "p.*")
        .groupBy("document", "ordinal")
        .agg(F.array_sort(F.collect_list(F.struct("part", "elements"))).alias("sorted"), F.min_by(F.struct("chain", "title", "title_before"), "part").alias("i"))
        .select("document", F.flatten("sorted.elements").alias("elements"), F.struct("ordinal", "i.chain", "i.title").alias("item"), "i.title_before")
    )
    over = spread.select(
        "document", _chunk_struct(params, F.col("elements"), F.lit(0), F.col("item"), F.col("title_before")).alias("c")
    ).select("document", "c.*")
    return _numbered(inside.unionByName(over))


# -- group texts and records -------------------------------------------------------


def chunk_texts(grouped_elements: DataFrame) -> DataFrame:
    """Text of groups given as rows (document, chunk_ord, pos, type, text, metadata)."""
    html = F.col("metadata.text_as_html")
    is_table = F.coalesce((F.col("type") == "Table") & (html != ""), F.lit(False))
    body = F.when(is_table, html_table_to_markdown(html)).otherwise(F.coalesce("text", F.lit("")))
    return (
        grouped_elements.select("document", "chunk_ord", "pos", body.alias("text"))
        .filter(is_filled(F.col("text")))
        .groupBy("document", "chunk_ord")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("parts"))
        .select("document", "chunk_ord", F.array_join("parts.text", "\n\n").alias("text"))
    )


def chunk_records(chunks: DataFrame, context: Column | None = None) -> DataFrame:
    """Contextualised text and final token count; ``context`` is a sentence per chunk."""
    text = F.col("original_content")
    full = text if context is None else F.concat(context, F.lit("\n\n"), text)
    tokens = F.col("text_tokens") if context is None else F.col("text_tokens") + token_count(context)
    return chunks.select(
        "chunk_id",
        "document",
        "chunk_index",
        "original_content",
        full.alias("contextualized_content"),
        tokens.cast("int").alias("token_count"),
        "chunk_type",
        "section_title",
        "page_number",
        "has_image",
        *IMAGE_FIELDS,
        "element_count",
    )

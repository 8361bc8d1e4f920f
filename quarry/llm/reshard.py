"""Resharding by minimum-cost flow.

A table lies in old shards of unequal size and is to fill new shards of given capacities while as few bytes as possible
move. Only the sizes go into the flow: a source feeds each old shard with its bytes, each new shard drains its capacity, an
edge from an old to a new shard costs nothing where the bytes stay and one per byte where they move (or what a given cost
table says). Successive shortest paths solve it; the graph has old x new edges and nothing in it grows with the rows.

The flow is carried out in blocks. Rows of equal text share a block (a range of a hash within their old shard), so that
copies stay together. A block that no shard can hold is dealt out by text; only the rows of a text that no shard can hold are dealt
out by row (rows that are alike, and many, by their place in the table). Blocks go, largest first, to the new shard with
the most bytes of the flow still open. The number of blocks is fixed by parameters, so the driver sees a bounded table of sizes.

Slots are numbered without gaps: rows of a shard are counted in small pieces, the counts are added up, and rows are numbered
within their piece, so that no shard is sorted in one task.

``rewrite`` writes the files of those new shards only whose rows change.

Defined results: null text has no bytes and counts as empty; every row has one byte more than its text; repeated rows each
get a slot; ties are broken by id, then the whole row; an empty table gives an empty result; further columns are kept by ``reshard`` and
ignored by ``assign``.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import row_key, stored, text_key, text_or_empty

OLD_SHARDS, NEW_SHARDS = 12, 16
#: Blocks per old shard.
FINE = 1024
#: Rows numbered together, about.
PIECE_ROWS = 1000


def min_cost_flow(supply: Sequence[int], capacity: Sequence[int], cost: Sequence[Sequence[int]]) -> list[list[int]]:
    """Bytes from each old to each new shard, all of the supply, at the least total cost.

    Successive shortest paths with potentials; capacities must add up to the supply at least.
    """
    n, m = len(supply), len(capacity)
    if sum(capacity) < sum(supply):
        raise ValueError("the new shards hold less than the old ones")
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    potential = [0] * (n + m)
    while any(left):
        far = [None] * (n + m)
        came = [-1] * (n + m)
        queue = [(0, i) for i in range(n) if left[i]]
        for _, i in queue:
            far[i] = 0
        heapq.heapify(queue)
        done = [False] * (n + m)
        while queue:
            d, v = heapq.heappop(queue)
            if done[v]:
                continue
            done[v] = True
            if v < n:
                steps = ((n + j, cost[v][j]) for j in range(m))
            else:
                steps = ((i, -cost[i][v - n]) for i in range(n) if flow[i][v - n])
            for w, c in steps:
                e = d + c + potential[v] - potential[w]
                if far[w] is None or e < far[w]:
                    far[w], came[w] = e, v
                    heapq.heappush(queue, (e, w))
        ends = [j for j in range(m) if room[j] and far[n + j] is not None]
        end = n + min(ends, key=lambda j: (far[n + j] + potential[n + j], j))
        limit = max(x for x in far if x is not None)
        for v in range(n + m):
            potential[v] += limit if far[v] is None else far[v]
        path, v = [], end
        while came[v] >= 0:
            path.append((came[v], v))
            v = came[v]
        amount = min([left[v], room[end - n], *(flow[b][a - n] for a, b in path if a >= n)])
        for a, b in path:
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[v] -= amount
        room[end - n] -= amount
    return flow


def place_blocks(blocks: Sequence[tuple], flow: list[list[int]]) -> list[int]:
    """The new shard of each block (old shard, ..., bytes): largest first, to where the flow has most bytes open."""
    open_bytes = [list(row) for row in flow]
    # What a new shard still lacks over all old shards decides between openings that are about equal.
    lack = [sum(row[j] for row in flow) for j in range(len(flow[0]))]
    to = [0] * len(blocks)
    for k in sorted(range(len(blocks)), key=lambda k: (-blocks[k][-1], blocks[k][:-1])):
        old, size = blocks[k][0], blocks[k][-1]
        targets = [j for j in range(len(lack)) if flow[old][j]] or list(range(len(lack)))
        fits = [j for j in targets if open_bytes[old][j] >= size]
        j = max(fits or targets, key=lambda j: (open_bytes[old][j] if fits else lack[j], -j))
        to[k] = j
        open_bytes[old][j] -= size
        lack[j] -= size
    return to


def assign(
    docs: DataFrame,
    old_shards: int = OLD_SHARDS,
    new_shards: int = NEW_SHARDS,
    old_shard: Column | None = None,
    fine: int = FINE,
    piece_rows: int = PIECE_ROWS,
    cost: Sequence[Sequence[int]] | None = None,
) -> DataFrame:
    """doc_id, row_key, size, text_crc32, old_shard, shard, slot: one row per row of ``docs``.

    ``old_shard``: where a row lies now, 0 to old_shards - 1, as a Column over doc_id, text and text_key (equal texts should
    lie together); by default a range of the hash of its text.
    """
    key_hash = F.xxhash64("text_key")
    now = F.pmod(key_hash, F.lit(old_shards)) if old_shard is None else old_shard
    text = text_or_empty()
    rows = docs.select("doc_id", row_key(docs).alias("row_key"), text.alias("text"), text_key().alias("text_key"))
    rows = stored(
        rows.select(
            "doc_id",
            "row_key",
            "text_key",
            (F.octet_length("text") + 1).cast("long").alias("size"),
            F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
            now.cast("int").alias("old_shard"),
            F.pmod(F.shiftright(key_hash, 20), F.lit(fine)).cast("int").alias("block"),
            # Fixed once it is written.
            F.monotonically_increasing_id().alias("place"),
        )
    )
    sizes = rows.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    found = sizes.collect()  # old_shards x fine rows at most
    n_rows = max(1, sum(r["n"] for r in found))
    table = sorted((r["old_shard"], r["block"], r["bytes"]) for r in found)
    total = sum(x[2] for x in table)
    capacity = [total // new_shards + (j < total % new_shards) for j in range(new_shards)]
    # A block that no shard can hold is dealt out over its texts, a text that none can hold over its rows.
    pieces = {(o, b): 64 * -(-size // max(1, capacity[0])) for o, b, size in table if size > capacity[0]}
    blocks = [(o, b, 0, size) for o, b, size in table if (o, b) not in pieces]
    part = F.lit(0)
    if pieces:
        spark = rows.sparkSession
        many = spark.createDataFrame([(o, b, n) for (o, b), n in pieces.items()], "old_shard int, block int, pieces int")
        rows = rows.join(F.broadcast(many), ["old_shard", "block"], "left")  # old_shards x fine rows at most
        split = rows.where("pieces is not null")
        of_text = split.groupBy("text_key").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > capacity[0])
        of_text = stored(of_text.select("text_key", F.lit(True).alias("giant")))  # fewer than new_shards rows
        rows = rows.join(F.broadcast(of_text), "text_key", "left")
        of_row = rows.where("giant").groupBy("row_key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        of_row = of_row.where((F.col("n") > 1) & (64 * F.col("bytes") > capacity[0]))
        of_row = stored(of_row.select("row_key", F.lit(True).alias("alike")))  # fewer than 64 x new_shards rows
        rows = rows.join(F.broadcast(of_row), "row_key", "left")
        dealt = F.when(F.col("alike"), F.xxhash64("row_key", "place")).when(F.col("giant"), F.xxhash64("row_key"))
        dealt = F.coalesce(dealt, F.xxhash64(F.lit("part"), "text_key"))
        part = F.coalesce(F.pmod(dealt, F.col("pieces")), F.lit(0)).cast("int")
        rows = rows.withColumn("part", part).drop("pieces", "giant", "alike")
        split = rows.join(F.broadcast(many.drop("pieces")), ["old_shard", "block"], "left_semi")
        found = split.groupBy("old_shard", "block", "part").agg(F.sum("size").alias("bytes")).collect()
        blocks += [(r["old_shard"], r["block"], r["part"], r["bytes"]) for r in found]
    else:
        rows = rows.withColumn("part", part)
    supply = [sum(x[-1] for x in blocks if x[0] == o) for o in range(old_shards)]
    if cost is None:
        cost = [[int(o != j) for j in range(new_shards)] for o in range(old_shards)]
    to = place_blocks(blocks, min_cost_flow(supply, capacity, cost)) if blocks else []
    where = rows.sparkSession.createDataFrame(
        [(o, b, p, j) for (o, b, p, _), j in zip(blocks, to, strict=True)],
        "old_shard int, block int, part int, shard int",
    )
    placed = rows.join(F.broadcast(where), ["old_shard", "block", "part"])  # as bounded as the blocks

    n_pieces = -(-n_rows // (new_shards * piece_rows))
    placed = placed.withColumn("piece", F.pmod(F.xxhash64("row_key"), F.lit(n_pieces)).cast("int"))
    counts = placed.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.select("shard", "piece", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first")))
    order = Window.partitionBy("shard", "piece").orderBy("doc_id", "row_key")
    return (
        placed.withColumn("nth", F.row_number().over(order) - 1)
        .join(starts, ["shard", "piece"])
        .select(
            "doc_id", "row_key", "size", "text_crc32", "old_shard", "shard",
            (F.col("first") + F.col("nth")).cast("long").alias("slot"),
        )
    )


def reshard(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with old_shard, shard and slot; columns of these names in the input are replaced."""
    names = [c for c in docs.columns if c not in ("old_shard", "shard", "slot")]
    docs = docs.select(*names)
    place = F.struct("slot", "shard", "old_shard")
    found = assign(docs, **options).groupBy("row_key").agg(F.collect_list(place).alias("__places"))
    found = stored(found.withColumnRenamed("row_key", "__row"))
    # Rows that are alike are one row here, which comes once for each of their places.
    one = docs.withColumn("__row", row_key(docs)).join(found, "__row").dropDuplicates(["__row"])
    return one.withColumn("__p", F.explode("__places")).select(*names, "__p.old_shard", "__p.shard", "__p.slot")


def rewrite(resharded: DataFrame, path: str) -> None:
    """Write the files of the new shards that gain or lose rows, partitioned by shard; others are left as they are."""
    moved = resharded.where("old_shard <> shard")
    touched = stored(
        moved.select(F.explode(F.array("old_shard", "shard")).alias("touched")).distinct()
    )
    rows = resharded.join(touched, resharded["shard"] == touched["touched"], "left_semi")
    rows.repartition("shard", F.pmod(F.col("slot"), F.lit(64))).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("shard").parquet(path)

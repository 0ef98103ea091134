"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text are one group. Groups are dealt to parts by hash and packed there into small bins; a group larger
than a small bin is a bin of its own. The small bins, whose number is bounded by the number of shards and of parts,
are then packed into the shards. Both packings are best fit decreasing: items by falling size, each into the bin with
the least room that still takes it, found in a balanced tree over the rooms.
"""

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.workspace import materialize, name_package

#: Small bins per shard, groups per part, rows numbered in one task.
BINS_PER_SHARD, GROUPS_PER_PART, BLOCK = 256, 50_000, 4096

#: Bytes that a row takes besides its text.
ROW_BYTES = 8


class Rooms:
    """The bins' rooms in an AVL tree ordered by (room, bin)."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None  # node: [key, left, right, height]

    def add(self, key) -> None:
        self.root = _insert(self.root, key)

    def remove(self, key) -> None:
        self.root = _delete(self.root, key)

    def least_from(self, room: int):
        """The least (room, bin) with at least that room, or None."""
        node, found = self.root, None
        while node:
            if node[0][0] >= room:
                found, node = node[0], node[1]
            else:
                node = node[2]
        return found


def _height(node) -> int:
    return node[3] if node else 0


def _fixed(node):
    node[3] = 1 + max(_height(node[1]), _height(node[2]))
    return node


def _turned(node, up: int, down: int):
    """The child at `up` becomes the parent."""
    child = node[up]
    node[up] = child[down]
    child[down] = _fixed(node)
    return _fixed(child)


def _balanced(node):
    tilt = _height(node[1]) - _height(node[2])
    if -2 < tilt < 2:
        return _fixed(node)
    up, down = (1, 2) if tilt > 0 else (2, 1)
    if _height(node[up][down]) > _height(node[up][up]):
        node[up] = _turned(node[up], down, up)
    return _turned(node, up, down)


def _insert(node, key):
    if node is None:
        return [key, None, None, 1]
    side = 1 if key < node[0] else 2
    node[side] = _insert(node[side], key)
    return _balanced(node)


def _delete(node, key):
    if key != node[0]:
        side = 1 if key < node[0] else 2
        node[side] = _delete(node[side], key)
        return _balanced(node)
    if node[1] is None or node[2] is None:
        return node[1] or node[2]
    least = node[2]
    while least[1]:
        least = least[1]
    node[0], node[2] = least[0], _delete(node[2], least[0])
    return _balanced(node)


def best_fit_decreasing(sizes: Iterable[int], capacity: int) -> tuple[list[int], int]:
    """(bin of each item, number of bins) for items in falling order of size; a larger item gets a bin of its own."""
    rooms, place, bins = Rooms(), [], 0
    for size in sizes:
        found = rooms.least_from(size)
        if found:
            rooms.remove(found)
            room, at = found
        else:
            room, at = max(capacity, size), bins
            bins += 1
        place.append(at)
        if room > size:
            rooms.add((room - size, at))
    return place, bins


def fewest_even(sizes: list[int], shards: int) -> list[int]:
    """Bins of items in falling order of size: the least capacity for which best fit decreasing needs no more than
    `shards` bins."""
    if not sizes:
        return []
    low = max(-(-sum(sizes) // shards), sizes[0])
    place, bins = best_fit_decreasing(sizes, low)
    high = low
    while bins > shards:
        low, high = high, high + max(1, high // 64)
        place, bins = best_fit_decreasing(sizes, high)
    while high - low > max(1, high // 20_000):
        middle = (low + high) // 2
        tried, bins = best_fit_decreasing(sizes, middle)
        if bins <= shards:
            place, high = tried, middle
        else:
            low = middle
    return place


def pack_small(groups: DataFrame, parts: int, capacity: int) -> DataFrame:
    """(part, bin, a, b) of each group (a, b, bytes): each part packs its groups into bins of `capacity`."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "a", "b"], ascending=[False, True, True])
        place, _ = best_fit_decreasing(pdf["bytes"].tolist(), capacity)
        return pd.DataFrame({"part": pdf["part"], "bin": place, "a": pdf["a"], "b": pdf["b"]})

    name_package(groups.sparkSession)
    dealt = groups.withColumn("part", F.pmod(F.xxhash64("b", "a"), F.lit(parts)))
    return dealt.groupBy("part").applyInPandas(pack, "part long, bin long, a long, b long")


def shard_groups(
    docs: DataFrame, shards: int = 24, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: (id_col, size, text_crc32, law, shard, slot, grown_shard).

    size is the UTF-8 bytes of the text plus ROW_BYTES, text_crc32 its CRC-32 as an unsigned number; a null text has
    no bytes and a null CRC. Rows of equal text (null texts too) go to one shard. The law is "bytes": the shards'
    sizes are as near to each other as the groups allow; grown_shard is null. slot numbers a shard's rows from 0
    without a gap, in the order of bin and id; equal rows take slots in either order. An empty table gives no rows;
    there may be fewer groups than shards. Other columns are not read. Equal texts are found by two 64-bit hashes.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit("again"), text).alias("b"),
    )
    rows = materialize(rows, "rows")
    groups = materialize(rows.groupBy("a", "b").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    whole = groups.agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).first()
    small = max(1, (whole["bytes"] or 0) // (shards * BINS_PER_SHARD))
    parts = max(1, -(-whole["n"] // GROUPS_PER_PART))
    packed = pack_small(groups.filter(F.col("bytes") <= small), parts, small)
    large = groups.filter(F.col("bytes") > small).select(F.lit(-1).cast("long").alias("part"), F.lit(0).cast("long").alias("bin"), "a", "b")
    placed = materialize(packed.unionAll(large).join(groups, ["a", "b"]), "placed")
    # a large group's bin is told apart by its hashes
    own = lambda c: F.when(F.col("part") < 0, F.col(c)).otherwise(F.lit(0))
    placed = placed.select("a", "b", "bytes", "n", "part", "bin", own("a").alias("ga"), own("b").alias("gb"))
    bins = placed.groupBy("part", "bin", "ga", "gb").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    # at most about 2 * shards * BINS_PER_SHARD + parts rows
    found = bins.orderBy(F.desc("bytes"), "part", "bin", "ga", "gb").collect()
    shard = fewest_even([r["bytes"] for r in found], shards)
    blocks, at = [], [0] * shards
    for r, s in zip(found, shard):
        blocks.append((r["part"], r["bin"], r["ga"], r["gb"], s, at[s], -(-r["n"] // BLOCK)))
        at[s] += r["n"]
    plan = spark.createDataFrame(blocks, "part long, bin long, ga long, gb long, shard int, first long, salts long")
    named = placed.join(plan, ["part", "bin", "ga", "gb"]).select("a", "b", "part", "bin", "ga", "gb", "shard", "first", "salts")
    return _numbered(rows.join(named, ["a", "b"]), id_col)


def _numbered(rows: DataFrame, id_col: str) -> DataFrame:
    """Slots: a bin's first slot is known; its rows are numbered in salted blocks, so a large bin is many tasks."""
    block = ["shard", "part", "bin", "ga", "gb", "salt"]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "size"), F.col("salts")))
    counts = salted.groupBy(*block).agg(F.count("*").alias("rows"))
    ahead = Window.partitionBy(*block[:-1]).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("ahead", F.coalesce(F.sum("rows").over(ahead), F.lit(0))).drop("rows")
    inside = Window.partitionBy(*block).orderBy(F.col("id").asc_nulls_last(), "size", "a", "b")
    slot = F.col("first") + F.col("ahead") + F.row_number().over(inside) - 1
    return salted.join(counts, block).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

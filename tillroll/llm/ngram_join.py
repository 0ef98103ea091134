"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Documents with equal shingle sets form one class; a class is one row of the matrix. Two classes link when
`den * overlap >= num * union`. The product runs over prefixes of the rows, which is exact: under any one order of
the shingles, two linked rows share a shingle among the first `n - ceil(num * n / den) + 1` of each.

* The order puts shingles first that occur in one document only, then rare ones, then very frequent ones, so that
  most prefixes hold nothing that another document has. Shingles of the lowest part of the hash range are counted
  over all documents for it; what is known of them is kept in two bitmaps of a fixed size. A false bit changes the
  order, never the result.
* Products of a column with few rows are accumulated per pair and a pair is dropped when its count plus all that
  lies behind the shorter prefix cannot reach the bound given by the two sizes.
* Columns with many rows (families of near copies) are put together where they share a row, and cut into blocks of rows.
  Two blocks are multiplied as matrices over the shingles that they share, in one task, which gives back a spanning
  forest of the links and not the pairs.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.graph import connected_components
from tillroll.llm.hashing import mix, shingle_sets, text_runs
from tillroll.llm.workspace import map_arrow, materialize, name_package

#: Shingles whose hash lies in the lowest 1/REGION of the range are counted.
REGION = 4
#: A shingle in more than this many documents is put last; a column with more classes is multiplied in blocks.
FREQUENT = 32
#: Rows of a block, and shingles that a product of two blocks takes at a time.
BLOCK, SLICE = 512, 1 << 12
#: Bits of each of the two bitmaps (2 ** 25 bits are 4 MB).
BITMAP_BITS = 25

_SIGN = np.uint64(1 << 63)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _prefix_length(n: np.ndarray, num: int, den: int) -> np.ndarray:
    return np.where(n > 0, n - (num * n + den - 1) // den + 1, 0)


def document_shingles(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, sig): the size of the shingle set and a hash of it; sig is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, data, offsets in text_runs(batch.column(1)):
                h, begin = shingle_sets(data, offsets, k)
                n = np.diff(begin)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(0x5851F42D4C957F2D)))])
                sig = _signed(mix(sums[begin[1:]] - sums[begin[:-1]] + n.astype(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(n)).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(sig, mask=n == 0)],
                    names=["id", "n_shingles", "sig"],
                )

    columns = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(columns, run, "id long, n_shingles long, sig long")


def _region_counts(docs: DataFrame, k: int, text_col: str) -> DataFrame:
    """(h, n): in how many documents each shingle of the counted part of the hash range occurs."""

    def run(batches):
        for batch in batches:
            for _, data, offsets in text_runs(batch.column(0)):
                h, _ = shingle_sets(data, offsets, k)
                h = h[h < np.uint64((1 << 64) // REGION)]
                h, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(_signed(h)), pa.array(n, pa.int64())], names=["h", "n"])

    counted = map_arrow(docs.select(F.col(text_col).alias("text")), run, "h long, n long")
    return counted.groupBy("h").agg(F.sum("n").alias("n"))


def _bitmaps(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bit arrays (repeated, frequent) over 2 ** BITMAP_BITS buckets of the counted shingles: a fixed size."""
    # the counted part starts with two zero bits; Spark's bitmaps start at 1
    bucket = F.shiftrightunsigned("h", 64 - BITMAP_BITS - 2) + 1
    marked = counts.filter("n > 1").select(bucket.alias("bucket"), (F.col("n") > FREQUENT).alias("frequent"))
    blocks = (
        marked.groupBy((F.bitmap_bucket_number("bucket")).alias("block"), "frequent")
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bucket")).alias("bits"))
    )
    maps = np.zeros((2, (1 << BITMAP_BITS) // 8), dtype=np.uint8)
    for block, frequent, bits in blocks.toLocalIterator():
        at = (block - 1) * 4096
        piece = np.frombuffer(bits, dtype=np.uint8)
        for m in (0, 1) if frequent else (0,):
            maps[m, at : at + len(piece)] |= piece
    return maps[0], maps[1]


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h >> np.uint64(64 - BITMAP_BITS - 2)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _postings(docs: DataFrame, maps, k: int, num: int, den: int, text_col: str) -> DataFrame:
    """(h, sig, n, last): the shingles of each prefix that another document may have; last is the order key of the
    prefix's last shingle."""
    shared = docs.sparkSession.sparkContext.broadcast(maps)
    lowest = np.uint64((1 << 64) // REGION)

    def run(batches):
        repeated, frequent = shared.value
        for batch in batches:
            for _, data, offsets in text_runs(batch.column(0)):
                h, begin = shingle_sets(data, offsets, k)
                n = np.diff(begin)
                if not len(h):
                    continue
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(0x5851F42D4C957F2D)))])
                sig = _signed(mix(sums[begin[1:]] - sums[begin[:-1]] + n.astype(np.uint64)))
                rank = np.full(len(h), 2, dtype=np.uint64)
                low = np.flatnonzero(h < lowest)
                rank[low] = np.where(_has(frequent, h[low]), 3, np.where(_has(repeated, h[low]), 1, 0))
                # the order: two bits of rank, then the hash without its last two bits
                key = (rank << np.uint64(62)) | (h >> np.uint64(2))
                rows = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((key, rows))
                place = np.arange(len(h)) - begin[rows]
                length = _prefix_length(n, num, den)
                last = np.zeros(len(n), dtype=np.uint64)
                full = n > 0
                last[full] = key[order][(begin[:-1] + length - 1)[full]]
                keep = (place < length[rows]) & (rank[order] > 0)
                chosen, of = order[keep], rows[keep]
                table = pa.table({"h": _signed(h[chosen]), "sig": sig[of], "n": n[of], "last": _signed(last[of] ^ _SIGN)})
                # equal sets in one run of documents give each posting once
                table = table.group_by(["h", "sig", "n", "last"]).aggregate([])
                yield from table.to_batches()

    return map_arrow(docs.select(F.col(text_col).alias("text")), run, "h long, sig long, n long, last long")


def _possible(num: int, den: int):
    """Sizes of which one set could still be that similar to the other."""
    return f"{num} * greatest(a.n, b.n) <= {den} * least(a.n, b.n)"


def _candidates(short: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose accumulated overlap can still reach the bound of their sizes."""
    pairs = short.alias("a").join(short.alias("b"), F.expr(f"a.h = b.h and a.sig < b.sig and {_possible(num, den)}"))
    counted = pairs.groupBy(
        F.col("a.sig").alias("a"), F.col("b.sig").alias("b"), F.col("a.n").alias("na"), F.col("b.n").alias("nb"),
        F.col("a.last").alias("la"), F.col("b.last").alias("lb"), F.col("a.long").alias("xa"), F.col("b.long").alias("xb"),
    ).agg(F.count("*").alias("c"))
    # beyond the shorter prefix: one less than the prefix bound; shingles of columns not multiplied out may add to it
    behind = f"case when la <= lb then (({num} * na + {den - 1}) div {den}) - 1 else (({num} * nb + {den - 1}) div {den}) - 1 end"
    return counted.filter(f"({num} + {den}) * (c + least(xa, xb) + {behind}) >= {num} * (na + nb)").select("a", "b")


def _id_bits(ids: DataFrame) -> np.ndarray:
    """Bits of the hashed ids in the only column over 2 ** BITMAP_BITS buckets."""
    bucket = ids.select((_id_bucket(F.col(ids.columns[0])) + 1).alias("bucket"))  # Spark's bitmaps start at 1
    blocks = bucket.groupBy(F.bitmap_bucket_number("bucket").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bucket")).alias("bits")
    )
    bits = np.zeros((1 << BITMAP_BITS) // 8, dtype=np.uint8)
    for block, piece in blocks.toLocalIterator():
        bits[(block - 1) * 4096 :][:4096] = np.frombuffer(piece, dtype=np.uint8)
    return bits


def _id_bucket(ids):
    return F.shiftrightunsigned(F.xxhash64(ids), 64 - BITMAP_BITS)


def _sets(involved: DataFrame, docs: DataFrame, classes: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(sig, items): the sorted shingle hashes of each class in `involved`. Texts stay where they are: those of a class's first id,
    by a bitmap of these ids, give their sets to the shuffle, and a false bit costs a set."""
    chosen = materialize(classes.join(involved, "sig").select("sig", "first_id").filter("first_id is not null"), "chosen")
    shared = docs.sparkSession.sparkContext.broadcast(_id_bits(chosen.select("first_id")))
    texts = docs.select(_id_bucket(F.col(id_col).cast("long")).alias("bucket"), F.col(text_col).alias("text"))

    def run(batches):
        bits = shared.value
        for batch in batches:
            place = batch.column(0).to_numpy(zero_copy_only=False)
            hit = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            for _, data, offsets in text_runs(batch.column(1).filter(pa.array(hit))):
                h, begin = shingle_sets(data, offsets, k)
                n = np.diff(begin)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(0x5851F42D4C957F2D)))])
                sig = _signed(mix(sums[begin[1:]] - sums[begin[:-1]] + n.astype(np.uint64)))
                own = pa.array(np.flatnonzero(n > 0))
                sets = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(_signed(h)))
                yield pa.RecordBatch.from_arrays([pa.array(sig).take(own), sets.take(own)], names=["sig", "items"])

    # rows that share an id may have another text
    return map_arrow(texts, run, "sig long, items array<long>").join(chosen.select("sig"), "sig").dropDuplicates(["sig"])


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    left = sets.select(F.col("sig").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("sig").alias("b"), F.col("items").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").withColumn("o", F.size(F.array_intersect("x", "y")))
    return joined.filter(f"{den} * o >= {num} * (size(x) + size(y) - o)").select("a", "b")


def _product(items: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Overlaps of the sets of two lists of rows, over the shingles that at least two of the rows hold."""
    sizes = np.array([len(x) for x in items])
    shingles, column, count = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    row, place = np.repeat(np.arange(len(items)), sizes)[keep], place[column[keep]]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    overlap = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, int(shared.sum()), SLICE):
        own = slice(*np.searchsorted(place, [at, at + SLICE]))
        matrix = np.zeros((len(items), SLICE), dtype=np.float32)
        matrix[row[own], place[own] - at] = 1
        overlap += matrix[left] @ matrix[right].T
    return overlap


def _block_links(num: int, den: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        sig, side = table.column("sig").to_numpy(), table.column("side").to_numpy()
        column = table.column("items").combine_chunks()
        values, begin = column.flatten().to_numpy(), np.asarray(column.offsets)
        begin = begin - begin[0]
        items = [values[begin[i] : begin[i + 1]] for i in range(len(sig))]
        left = np.flatnonzero(side <= 1)
        right = np.flatnonzero(side != 1)
        if not len(left) or not len(right):
            return schema.empty_table()
        n = np.diff(begin).astype(np.int64)
        overlap = _product(items, left, right)
        a, b = np.nonzero(den * overlap >= num * (n[left][:, None] + n[right][None, :] - overlap))
        a, b = left[a], right[b]
        # the least row that each row reaches by the links found here
        names = np.arange(len(sig))
        while True:
            new = names.copy()
            np.minimum.at(new, a, names[b])
            np.minimum.at(new, b, names[a])
            new = new[new]
            if (new == names).all():
                break
            names = new
        tied = np.flatnonzero(names != np.arange(len(sig)))
        return pa.table({"a": sig[tied], "b": sig[names[tied]]}, schema=schema)

    return run


def _grouped(wide: DataFrame) -> DataFrame:
    """(h, sig, width): columns that have the row of least hash in common become one group, of width rows, named by the least of
    the columns, so that a family of near copies, whose rows share many columns, is multiplied once. Every pair of a column
    is a pair of its group. Where the blocks of a group would take more rows than those of its columns, these stay as they are."""
    cost = lambda width: F.col(width) * F.ceil(F.col(width) / BLOCK)
    columns = wide.groupBy("h").agg(F.min(F.xxhash64("sig")).alias("label"), F.count("*").alias("width"))
    columns = materialize(columns.withColumn("cost", cost("width")), "wide")
    labelled = wide.select("h", "sig").join(columns, "h")
    rows = labelled.select("label", "sig").distinct()
    groups = rows.groupBy("label").agg(F.count("*").alias("width"))
    alone = columns.groupBy("label").agg(F.sum("cost").alias("alone"), F.min("h").alias("h"))
    groups = materialize(groups.join(alone, "label").filter(cost("width") <= F.col("alone")).drop("alone"), "groups")
    joined = rows.join(groups, "label").select("h", "sig", "width")
    return joined.unionAll(labelled.join(groups.select("label"), "label", "left_anti").select("h", "sig", "width"))


def _wide_links(wide: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Ties that connect what links connect among the rows of each wide column, by group of columns and block by block."""
    blocks = F.ceil(F.col("width") / BLOCK)
    own = F.pmod(F.xxhash64("sig"), blocks)
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j")))
    dealt = _grouped(wide).select("h", "sig", own.alias("own"), F.explode(pairs).alias("pair"))
    side = F.when(F.col("pair.i") == F.col("pair.j"), 0).when(F.col("own") == F.col("pair.i"), 1).otherwise(2)
    dealt = dealt.select("h", "sig", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), side.alias("side"))
    name_package(wide.sparkSession)
    return dealt.join(sets, "sig").groupBy("h", "i", "j").applyInArrow(_block_links(num, den), "a long, b long")


def ngram_jaccard_join(
    docs: DataFrame, *, k: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: (id_col, n_shingles, component_id).

    n_shingles is the size of the set of k-word shingles (words: runs of anything but ASCII white space, A-Z as
    a-z; a shorter text is one shingle). Two documents link when 100 * overlap >= 100 * num / den * union;
    component_id is the smallest id that links reach, the own one included.

    Null and white-space texts have no shingles and link with nothing. A null id keeps its row and gets the smallest
    other id of its class, or null. Repeated rows are documents of their own with one id. An empty table gives no
    rows. Other columns of `docs` are not read. Sets are compared through 64-bit hashes.
    """
    rows = materialize(document_shingles(docs, k, id_col, text_col), "sizes")
    classes = rows.filter("sig is not null").groupBy("sig").agg(F.min("id").alias("first_id"))
    maps = _bitmaps(_region_counts(docs, k, text_col))
    postings = materialize(_postings(docs, maps, k, num, den, text_col).dropDuplicates(["h", "sig"]), "columns")
    columns = postings.groupBy("h").agg(F.count("*").alias("width")).filter("width > 1")
    live = materialize(postings.join(columns, "h"), "postings")
    # how many columns of a class are not in the pair counts
    wide = live.filter(F.col("width") > FREQUENT)
    skipped = wide.groupBy("sig").agg(F.count("*").alias("long"))
    short = live.filter(F.col("width") <= FREQUENT).join(skipped, "sig", "left").fillna(0, ["long"])
    pairs = materialize(_candidates(short, num, den), "pairs")
    involved = pairs.select(F.explode(F.array("a", "b")).alias("sig")).unionAll(wide.select("sig")).distinct()
    sets = materialize(_sets(involved, docs, classes, k, id_col, text_col), "sets")
    return _described(rows, classes, connected_components(_ties(pairs, wide, sets, num, den)), id_col)


def _ties(pairs: DataFrame, wide: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links that connect what all links connect. Wide columns and one pair of each class are verified first; then the pairs
    whose ends these have not connected, so that a family of near copies does not move its sets once for every pair."""
    first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    ties = materialize(_verified(first, sets, num, den).unionAll(_wide_links(wide, sets, num, den)), "ties")
    parts = materialize(connected_components(ties), "parts")
    part = lambda end: parts.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
    apart = pairs.join(part("a"), "a", "left").join(part("b"), "b", "left").filter("coalesce(ca, a) != coalesce(cb, b)")
    apart = apart.join(first, ["a", "b"], "left_anti").select("a", "b")
    return ties.unionAll(_verified(apart, sets, num, den))


def _described(rows: DataFrame, classes: DataFrame, parts: DataFrame, id_col: str) -> DataFrame:
    named = classes.join(parts.withColumnRenamed("node", "sig"), "sig", "left")
    named = named.withColumn("component", F.coalesce("component", "sig"))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = named.join(least, "component").select("sig", "component_id")
    out = rows.join(known, "sig", "left")
    return out.select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("sig").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )

"""Document fingerprints: Merkle trees over paragraphs and sections, in DataFrame functions only.

A paragraph is a line. Its leaves are hashes of its pieces of LEAF code points, its node a hash of its leaves. A
section is SECTION paragraphs, its node a hash of theirs, and the root a hash of the section nodes. Equal roots mean
equal texts; where two trees differ, the differing section and paragraph nodes say where the edit is.

The fingerprint is `root|sections|paragraphs|leaves`: 32 hex digits, then the nodes of each level as hex words.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points per leaf, paragraphs per section.
LEAF, SECTION = 16, 8
#: Ranges of ids in which rows look up their next: ranges times ranges, and the documents meant to be in one.
FAN, RANGE_ROWS = 64, 1000


def tree(text: Column) -> Column:
    """Struct (paragraphs, leaves): the nodes of each paragraph and the leaves of all, as 32-bit words."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    pieces = F.transform(
        lines, lambda line: F.transform(F.regexp_extract_all(line, F.lit(f"(?s).{{1,{LEAF}}}"), F.lit(0)), lambda x: F.xxhash64(x))
    )
    return F.struct(F.transform(pieces, lambda p: F.xxhash64(p)).alias("paragraphs"), F.flatten(pieces).alias("leaves"))


def _words(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: F.lpad(F.hex(x.bitwiseAND(0xFFFFFFFF)), 8, "0")), "")


def fingerprint(nodes: Column) -> Column:
    """The text form of a tree."""
    paragraphs = nodes["paragraphs"]
    starts = F.sequence(F.lit(1), F.size(paragraphs), F.lit(SECTION))
    sections = F.transform(starts, lambda i: F.xxhash64(F.slice(paragraphs, i, SECTION)))
    root = F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), sections)), 16, "0") for seed in (1, 2)])
    return F.concat_ws("|", root, _words(sections), _words(paragraphs), _words(nodes["leaves"]))


def likeness(a: Column, b: Column) -> Column:
    """Twice the common leaves by the leaves of both: of the distinct leaves wherever they stand, or of all leaves in
    equal places, whichever is more. Two empty trees are alike."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    shared = 2.0 * F.size(F.array_intersect(x, y)) / F.greatest(F.size(x) + F.size(y), F.lit(1))
    same = F.size(F.filter(F.zip_with(a, b, lambda p, q: p.eqNullSafe(q)), lambda e: e))
    placed = 2.0 * same / F.greatest(F.size(a) + F.size(b), F.lit(1))
    return F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(F.greatest(shared, placed))


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Numbers, from 0, of the paragraphs in which two fingerprints differ, found from the differing sections down."""
    level = lambda x, i: F.split(x, r"\|", -1)[i]
    node = lambda words, i: F.substr(words, i * 8 + 1, F.lit(8))
    n = F.greatest(F.length(level(a, 1)), F.length(level(b, 1))) / 8
    sections = F.filter(
        F.sequence(F.lit(0), n.cast("int") - 1), lambda i: node(level(a, 1), i) != node(level(b, 1), i)
    )
    places = F.flatten(F.transform(sections, lambda i: F.sequence(i * SECTION, i * SECTION + SECTION - 1)))
    inside = F.filter(places, lambda i: node(level(a, 2), i) != node(level(b, 2), i))
    same = F.substring(a, 1, 32) == F.substring(b, 1, 32)
    return F.when(same, F.array().cast("array<int>")).otherwise(inside)


def document_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fingerprint) per row of `docs`. A null text counts as an empty one. Other columns are not read."""
    return docs.select(F.col(id_col), fingerprint(tree(F.col(text_col))).alias("fingerprint"))


def _range_number(docs: DataFrame) -> Column:
    """Column that numbers ranges of ids of like row counts; null ids are a range of their own, before all others."""
    rows = docs.count()
    n = int(min(FAN * FAN, max(1, rows // RANGE_ROWS)))
    cuts = []
    if n > 1:
        at = [i / n for i in range(1, n)]
        cuts = sorted(set(docs.agg(F.percentile_approx("id", at, 20 * FAN * FAN)).first()[0] or []))
    # two levels of at most FAN cuts, so that a row passes few comparisons
    coarse = cuts[FAN - 1 :: FAN]
    fine = [cuts[i : i + FAN - 1] for i in range(0, len(cuts) + 1, FAN)]
    ident = F.col("id")
    above = lambda xs: F.size(F.filter(xs, lambda x: x < ident))
    arrays = lambda xs: F.array(*map(F.lit, xs)).cast("array<long>")
    top = above(arrays(coarse))
    number = top * FAN + above(F.element_at(F.array(*map(arrays, fine)), top + 1))
    return F.when(ident.isNull(), -1).otherwise(number)


def next_document(docs: DataFrame) -> DataFrame:
    """Rows (id, text, nodes) with those of the next row by id as next_text and next_nodes; the last row's next is the
    first. nodes is the tree of the text.

    Rows are dealt by ranges of ids; the first row of each range is also sent to the range before it.
    """
    ranged = docs.withColumn("range", _range_number(docs.select("id")))
    firsts = {r["range"]: r["id"] for r in ranged.groupBy("range").agg(F.min("id").alias("id")).collect()}
    order = sorted(firsts)
    # at most FAN * FAN + 1 rows; the range before the first is the last
    heads = [(firsts[r], order[i - 1]) for i, r in enumerate(order)] or [(0, 0)]
    heads = F.broadcast(docs.sparkSession.createDataFrame(heads, "head long, before int"))
    one = Window.partitionBy("before").orderBy("text")
    sent = docs.join(heads, F.col("id").eqNullSafe(F.col("head"))).withColumn("k", F.row_number().over(one)).filter("k = 1")
    sent = sent.select("id", "text", F.col("before").alias("range"), F.lit(True).alias("sent"))
    both = ranged.select("id", "text", "range", F.lit(False).alias("sent")).unionAll(sent)
    both = both.withColumn("nodes", tree(F.col("text")))
    line = Window.partitionBy("range").orderBy("sent", F.col("id").asc_nulls_first(), "text")
    lead = both.withColumns({"next_text": F.lead("text").over(line), "next_nodes": F.lead("nodes").over(line)})
    return lead.filter("not sent")


def edited_fingerprints(docs: DataFrame, *, share: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: (id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has the last floor(n_chars / share) code points replaced by the first as many (or all) of the next
    document by ascending id; after the last comes the first. near_edited and near_next are the likeness of the
    document's tree to those of the edited text and of the next document. Null texts are empty; an empty text is its
    own edited text; a single document follows itself. Rows with one id are in the order of their texts; null ids come
    first. An empty table gives no rows. Other columns are not read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = next_document(base).withColumn("n_chars", F.length("text").cast("long"))
    moved = F.floor(F.col("n_chars") / share).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - moved), F.substr("next_text", F.lit(1), moved))
    rows = rows.withColumn("edited", edited).withColumn("edited_nodes", tree(F.col("edited")))
    return rows.select(
        F.col("id").alias(id_col), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("nodes")).alias("fingerprint"), fingerprint(F.col("edited_nodes")).alias("edited_fingerprint"),
        likeness(F.col("nodes.leaves"), F.col("edited_nodes.leaves")).alias("near_edited"),
        likeness(F.col("nodes.leaves"), F.col("next_nodes.leaves")).alias("near_next"),
    )

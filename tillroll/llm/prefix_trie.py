"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

1. Turns get their place in a conversation from one range sort of all turns. A place is the turn's offset in its range plus the
   turns of its conversation in earlier ranges, so that a conversation may span any number of tasks.
2. A prefix is told by four running sums of 32-bit hashes of (place, role, text). The sums run in blocks of places.
3. Prefixes are grouped to nodes. A node is named by its smallest member and its depth; no other node has both.
4. Subtree totals come from rounds that rake and compress. A leaf gives its total to its parent and is done. A node with one
   child, whose hash in this round is over those of its parent and its child, is spliced out: the child moves up to the
   grandparent and carries along what the node had gathered. Both are joins on the nodes left, of which every round takes
   a fixed share, so the rounds grow with the logarithm of the trie's size even where it is one long chain. Then the rounds
   are run backwards: a spliced node's total is what it had gathered plus its child's total.
5. The members that end at a node are joined to strings in blocks of ids, and a task streams a node's blocks into one digest:
   SHA-256 is sequential, but neither the ids nor the string are ever held whole.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.workspace import map_arrow, materialize

#: Places in a block of running sums; 2 ** IDS ids in a block of members.
PLACES, IDS = 4096, 12
LANES = ["l0", "l1", "l2", "l3"]
ENDS_NONE = hashlib.sha256(b"").hexdigest()


def places(turns: DataFrame, order: list[str], keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """(the turns with `conv` and `place`, from 1 in the given order, and the columns of `keep`; the turns of each conversation).

    Equal turns are told apart by where they were read, so that a range holds any number of them.
    """
    rows = turns.withColumn("read", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("conv", *order, "read").sortWithinPartitions("conv", *order, "read")
    rows = materialize(rows.select("conv", *keep, F.monotonically_increasing_id().alias("row")), "turns")
    part = F.shiftright("row", 33).alias("part")
    parts = rows.groupBy("conv", part).agg(F.min("row").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    parts = materialize(parts, "parts")
    placed = rows.withColumn("part", part).join(parts.select("conv", "part", "first", "before"), ["conv", "part"])
    placed = placed.select("conv", *keep, (F.col("before") + F.col("row") - F.col("first") + 1).alias("place"))
    return placed, parts.groupBy("conv").agg(F.sum("n").alias("turns"))


def running_sums(rows: DataFrame, values: list[str]) -> DataFrame:
    """`rows` (conv, place, ...) with the running sums of `values` over the places of each conversation, as s_<name>."""
    rows = rows.withColumn("block", F.expr(f"place div {PLACES}"))
    blocks = rows.groupBy("conv", "block").agg(*[F.sum(v).alias(v) for v in values])
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv", "block", *[F.sum(v).over(earlier).alias(f"b_{v}") for v in values]).filter("block > 0")
    within = Window.partitionBy("conv", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.withColumns({f"s_{v}": F.sum(v).over(within) for v in values}).join(blocks, ["conv", "block"], "left")
    total = {f"s_{v}": F.col(f"s_{v}") + F.coalesce(f"b_{v}", F.lit(0)) for v in values}
    return sums.withColumns(total).drop("block", *[f"b_{v}" for v in values])


def rebuilt(conversations: DataFrame, span: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """(conv, place, h0, h1, size) of every rebuilt conversation, and (conv, turns) with turnless ones."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    turns = conversations.filter("conv is not null").select("conv", "turn", role.alias("role"), text.alias("text"))
    turns = turns.withColumns({
        "h0": F.xxhash64("role", "text"), "h1": F.xxhash64(F.lit(1), "text", F.length("role"), "role"), "size": F.octet_length("text").cast("long"),
    })
    placed, lengths = places(turns, ["turn", "role", "text"], ["h0", "h1", "size"])
    placed = materialize(placed, "placed")
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    base = F.col("conv") - F.expr(f"pmod(conv, {span})")
    convs = lengths.select("conv", "turns", head.alias("head"), base.alias("base"))
    bases = lengths.select(F.col("conv").alias("base"), F.col("turns").alias("base_turns"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("head", F.coalesce("base_turns", F.lit(0))))
    convs = materialize(convs.withColumn("own", F.greatest(F.col("turns") - F.col("head"), F.lit(0))), "convs")
    whole = F.col("conv") == F.col("base")
    heads_of = convs.filter(~whole & (F.col("taken") > 0)).select("conv", "base", "taken")
    first = placed.filter(F.col("place") < heads).withColumnRenamed("conv", "base")
    first = heads_of.join(first, "base").filter("place <= taken").select("conv", "place", "h0", "h1", "size")
    # what is moved up by depends on the conversation alone, so its own turns need one number a conversation
    shift = convs.select("conv", F.when(whole, 0).otherwise(F.col("taken") - F.col("head")).alias("shift"), F.when(whole, 0).otherwise(F.col("head")).alias("cut"))
    rest = placed.join(shift, "conv").filter("place > cut").select("conv", (F.col("place") + F.col("shift")).alias("place"), "h0", "h1", "size")
    lengths = convs.select("conv", F.when(whole, F.col("turns")).otherwise(F.col("taken") + F.col("own")).alias("turns"))
    return first.unionAll(rest), lengths


def _ends(members: DataFrame) -> DataFrame:
    """Digest of the ids that end at each key (depth, lanes), ascending and joined by commas."""
    key = ["depth", *LANES]
    block = F.shiftright("conv", IDS).alias("block")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",")
    blocks = members.groupBy(*key, block).agg(ids.alias("ids"))
    blocks = blocks.repartition(*key).sortWithinPartitions(*key, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*key, "ends_sha256"]
        kinds = [pa.int64()] * len(key) + [pa.string()]
        last, digest = None, None
        for batch in batches:
            done = []
            columns = [batch.column(i).to_pylist() for i in range(len(key))]
            for *here, ids in zip(*columns, batch.column(len(key) + 1)):
                if here != last:
                    if last is not None:
                        done.append((*last, digest.hexdigest()))
                    last, digest = here, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.as_py().encode())
            yield _table(done, names, kinds)
        if last is not None:
            yield _table([(*last, digest.hexdigest())], names, kinds)

    return map_arrow(blocks, run, "depth long, " + ", ".join(f"{x} long" for x in LANES) + ", ends_sha256 string")


def _table(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def trie_nodes(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv, depth, parent, n_convs, n_children, size, ends_sha256) of every distinct prefix; `conv` is its smallest member."""
    half = {"a": "h0", "b": "h1"}
    spread = {n: F.xxhash64("place", h, F.lit(k)) for k, (n, h) in enumerate(half.items())}
    mask = F.lit(0xFFFFFFFF)
    rows = rows.withColumns(spread).select(
        "conv", "place", "size", *[(F.shiftright(x, by).bitwiseAND(mask)).alias(n) for (x, by), n in zip([("a", 0), ("a", 32), ("b", 0), ("b", 32)], LANES)]
    )
    sums = running_sums(rows, LANES)
    prefixes = materialize(sums.select(
        "conv", F.col("place").alias("depth"), "size", *[F.col(f"s_{x}").alias(x) for x in LANES], *[(F.col(f"s_{x}") - F.col(x)).alias(f"p{x}") for x in LANES]
    ), "prefixes")
    key = ["depth", *LANES]
    upper = [f"p{x}" for x in LANES]
    nodes = prefixes.groupBy(*key).agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.min("size").alias("size"), *[F.min(x).alias(x) for x in upper]
    )
    zero = F.lit(0).cast("long")
    root = lengths.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(zero.alias("depth"), *[zero.alias(x) for x in LANES], "conv", "n_convs", zero.alias("size"), *[F.lit(None).cast("long").alias(x) for x in upper])
    nodes = materialize(nodes.unionAll(root), "nodes")
    above = (F.col("depth") + 1).alias("depth")
    parents = nodes.select(above, *[F.col(x).alias(f"p{x}") for x in LANES], F.col("conv").alias("parent"))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), *[F.col(f"p{x}").alias(x) for x in LANES]).agg(F.count("*").alias("n_children"))
    last = prefixes.select("conv", *key).join(lengths.select("conv", F.col("turns").alias("depth")), ["conv", "depth"]).select("conv", *key)
    none = lengths.filter("turns = 0").select("conv", *[zero.alias(x) for x in key])
    nodes = nodes.join(children, key, "left").join(_ends(last.unionAll(none)), key, "left").join(parents, ["depth", *upper], "left")
    return nodes.select(
        "conv", "depth", "parent", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "size", F.coalesce("ends_sha256", F.lit(ENDS_NONE)).alias("ends_sha256")
    )


def _coin(conv: Column, depth: Column, step: int) -> Column:
    return F.xxhash64(conv, depth, F.lit(step))


def _round(nodes: DataFrame, values: list[str], step: int) -> DataFrame:
    """One rake and one compress over the nodes left.

    A row is (conv, depth, pconv, pdepth, kids, a_<value>: gathered so far, w_<value>: what its parent gets beside its total,
    vconv, vdepth, v_<value>: the node spliced out above it in this round and what that one had gathered).
    """
    leaf = F.col("kids") == 0
    given = nodes.filter("pconv is not null").groupBy(F.col("pconv").alias("conv"), F.col("pdepth").alias("depth")).agg(
        *[F.sum(F.when(leaf, F.col(f"a_{v}") + F.col(f"w_{v}"))).alias(f"g_{v}") for v in values], F.count_if(leaf).alias("raked"),
        F.min(F.when(~leaf, F.col("conv"))).alias("hconv"), F.min(F.when(~leaf, F.col("depth"))).alias("hdepth"),
    )
    inner = nodes.filter(~leaf).drop("vconv", "vdepth", *[f"v_{v}" for v in values]).join(given, ["conv", "depth"])
    inner = inner.withColumn("kids", F.col("kids") - F.col("raked"))
    inner = inner.withColumns({f"a_{v}": F.col(f"a_{v}") + F.coalesce(f"g_{v}", F.lit(0)) for v in values})
    own, up, down = (_coin(F.col(c), F.col(d), step) for c, d in (("conv", "depth"), ("pconv", "pdepth"), ("hconv", "hdepth")))
    # equal hashes of neighbours keep both
    gone = (F.col("kids") == 1) & F.col("pconv").isNotNull() & (own > up) & (own > down)
    inner = inner.withColumn("gone", gone)
    spliced = inner.filter("gone").select(
        F.col("hconv").alias("conv"), F.col("hdepth").alias("depth"), F.col("conv").alias("vconv"), F.col("depth").alias("vdepth"),
        F.col("pconv").alias("upconv"), F.col("pdepth").alias("updepth"), *[F.col(f"a_{v}").alias(f"x_{v}") for v in values], *[F.col(f"w_{v}").alias(f"y_{v}") for v in values],
    )
    left = inner.filter("not gone").join(spliced, ["conv", "depth"], "left")
    moved = F.col("vconv").isNotNull()
    return left.select(
        "conv", "depth", F.when(moved, F.col("upconv")).otherwise(F.col("pconv")).alias("pconv"), F.when(moved, F.col("updepth")).otherwise(F.col("pdepth")).alias("pdepth"),
        "kids", *[f"a_{v}" for v in values],
        *[F.when(moved, F.col(f"w_{v}") + F.col(f"x_{v}") + F.col(f"y_{v}")).otherwise(F.col(f"w_{v}")).alias(f"w_{v}") for v in values],
        "vconv", "vdepth", *[(F.col(f"x_{v}") + F.col(f"w_{v}")).alias(f"v_{v}") for v in values],
    )


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """(conv, depth, <values>): sums of `values` over the subtree of every node of (conv, depth, pconv, pdepth, kids, <values>)."""
    long = lambda x: F.lit(x).cast("long")
    now = nodes.select(
        "conv", "depth", "pconv", "pdepth", "kids", *[F.col(v).alias(f"a_{v}") for v in values], *[long(0).alias(f"w_{v}") for v in values],
        *[long(None).alias(x) for x in ("vconv", "vdepth", *[f"v_{v}" for v in values])],
    )
    rounds = [materialize(now, "round")]
    while not rounds[-1].filter("kids > 0").isEmpty():
        rounds.append(materialize(_round(rounds[-1], values, len(rounds)), "round"))
    total = None
    for k in range(len(rounds) - 1, -1, -1):
        done = rounds[k].filter("kids = 0").select("conv", "depth", *[F.col(f"a_{v}").alias(v) for v in values])
        if total is not None:
            done = done.unionAll(total)
            spliced = rounds[k + 1].filter("vconv is not null").join(total, ["conv", "depth"])
            done = done.unionAll(spliced.select(F.col("vconv").alias("conv"), F.col("vdepth").alias("depth"), *[(F.col(f"v_{v}") + F.col(v)).alias(v) for v in values]))
        total = materialize(done, "totals")
    return total


def prefix_trie(
    conversations: DataFrame, *, span: int = 5, heads: int = 9, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: (conv_col, depth, parent_<conv_col>, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256).

    Conversation c is rebuilt from the first h = crc32(c) % `heads` turns of c - c % `span` and its own turns after its first h;
    `span` = 1 leaves all as they are. Turns are ordered by turn (null first), then role and text; a null role or text is an empty
    one, repeated turns are turns. Rows without a conversation id belong to none and are left out; remainders are taken as
    not negative. An empty table gives no rows; a conversation whose rebuilt form has no turns ends at the root. Other columns
    are not read. n_leaves counts the childless nodes of the subtree, saved_tokens sums (n_convs - 1) * bytes of the last text.
    """
    turns = conversations.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    nodes = materialize(trie_nodes(*rebuilt(turns, span, heads)), "trie")
    own = nodes.select(
        "conv", "depth", F.col("parent").alias("pconv"), F.when(F.col("parent").isNotNull(), F.col("depth") - 1).alias("pdepth"), F.col("n_children").alias("kids"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
    )
    totals = subtree_totals(own, ["n_leaves", "saved_tokens"])
    return nodes.join(totals, ["conv", "depth"]).select(
        F.col("conv").alias(conv_col), "depth", F.col("parent").alias(f"parent_{conv_col}"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )

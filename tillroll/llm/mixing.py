"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of shuffled documents, read up to `repeats` times. A document's virtual finish time is the
number of tokens its source has given when the document ends, divided by the source's target. The documents of all
sources are taken in the order of finish time until the total budget is spent.

Sources may be very uneven: running totals are made of blocks of about BLOCK documents by ranges of the shuffle key,
block totals first and then inside each block, so no source is one task.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.workspace import materialize

#: Documents per block of a running total.
BLOCK = 4096
#: The cut is found by splitting its range of finish times into STEPS parts until at most LEFT rows are in it.
STEPS, LEFT = 512, 10_000

WORDS = r"[^\x20\x09-\x0D]+"


def source_targets(sources: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """Adds place, weight and target to one row per source (source, source_size): sources by code point, null last,
    get the weights in turn and a share of `share` times all sizes; a target stops at `repeats` times the source's
    size and the excess goes to the others by weight until no target is above."""
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(everything) - 1
    weighted = sources.withColumn("place", place).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    )
    weighted = weighted.withColumn("cap", F.col("source_size") * repeats)
    # sources fill up in the order of cap / weight; from one on none does
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = weighted.withColumn("level", left / F.sum("weight").over(onward))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    # the first that is not filled sets the level of all that are not
    chosen = level.withColumn("common", F.first(fits, ignorenulls=True).over(every))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("common") * F.col("weight"), F.col("cap").cast("double")))
    return chosen.select("source", "source_size", "place", "n", target.alias("target"))


def _queued(sized: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """Rows with `done`: tokens that the source has given in its first reading when the document ends."""
    rows = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    rows = rows.withColumn("key", F.xxhash64(F.lit(seed), "id", "size"))
    blocks = F.ceil(F.col("n") / BLOCK)
    # 53 bits of the key as an unsigned number order a source's documents; blocks are ranges of it
    rows = rows.withColumn("key", F.shiftrightunsigned("key", 11))
    rows = rows.withColumn("block", F.floor(F.col("key") / F.lit(float(1 << 53)) * blocks))
    totals = rows.groupBy("place", "block").agg(F.sum("size").alias("total"))
    ahead = Window.partitionBy("place").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("place", "block", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("place", "block").orderBy("key", F.col("id").asc_nulls_last(), "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.join(totals, ["place", "block"]).withColumn("done", F.col("ahead") + F.sum("size").over(inside))


def _finish(reading: int):
    """Virtual finish time in the given reading; null for documents and sources without tokens."""
    return F.when(
        (F.col("size") > 0) & (F.col("target") > 0), (F.col("done") + F.col("source_size") * reading) / F.col("target")
    )


def _readings(queued: DataFrame, repeats: int) -> DataFrame:
    """(finish, place, key, id, size) of each reading of each document that has tokens."""
    finish = [_finish(e) for e in range(repeats)]
    rows = queued.filter("size > 0 and target > 0")
    return rows.select(F.explode(F.array(*finish)).alias("finish"), "place", "key", "id", "size")


def _cut(readings: DataFrame, budget: float):
    """(finish, place, key, id) of the last reading that the budget covers, or None. The driver sees STEPS sums at a
    time and at last one row."""
    low, high, spent = 0.0, readings.agg(F.max("finish")).first()[0], 0
    if high is None:
        return None
    last = None
    inside = readings
    while True:
        width = (high - low) / STEPS
        step = F.least(F.floor((F.col("finish") - low) / width), F.lit(STEPS - 1)) if width > 0 else F.lit(0)
        parts = inside.groupBy(step.alias("step")).agg(
            F.sum("size").alias("total"), F.count("*").alias("n"), F.min("finish").alias("lo"), F.max("finish").alias("hi")
        ).orderBy("step").collect()
        crossing = None
        for part in parts:
            if spent + part["total"] > budget:
                crossing = part
                break
            spent += part["total"]
            last = part
        if crossing is None:
            break
        low, high = crossing["lo"], crossing["hi"]
        inside = inside.filter(F.col("finish").between(low, high))
        if crossing["n"] <= LEFT or low == high:
            running = F.sum("size").over(Window.orderBy("finish", "place", "key", F.col("id").asc_nulls_last())) + spent
            fitting = inside.withColumn("running", running).filter(F.col("running") <= budget)
            top = fitting.orderBy(
                F.desc("finish"), F.desc("place"), F.desc("key"), F.col("id").desc_nulls_first()
            ).select("finish", "place", "key", "id").first()
            if top:
                return tuple(top)
            break
    # whole parts were taken up to here
    return (last["hi"], None, None, None) if last else None


def mix_sources(
    docs: DataFrame, *, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row per row of `docs`: (id_col, source, size, source_size, target, taken, copies).

    size is the number of runs of anything but ASCII white space in the text, source_size its sum over the source,
    target the source's share (see `source_targets`), taken = size * copies the words that the mix takes. copies is
    between 0 and `repeats`; rows whose text has no word get one copy and take nothing. A null text has no words, a null
    source is a source of its own, the last. Repeated rows are documents of their own. The shuffle is a hash of id,
    size and `seed`, so reruns agree. An empty table gives no rows. Other columns are not read.
    """
    sized = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
    )
    sized = materialize(sized, "sized")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = materialize(source_targets(sources, weights, share, repeats), "targets")
    queued = materialize(_queued(sized, targets, seed), "queued")
    budget = float(sized.agg(F.sum("size")).first()[0] or 0) * share
    cut = _cut(_readings(queued, repeats), budget)
    copies = F.lit(0)
    for e in range(repeats):
        copies = copies + F.when(_within(_finish(e), cut), 1).otherwise(0)
    copies = F.when(F.col("size") == 0, 1).otherwise(copies)
    return queued.select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target",
        (F.col("size") * copies).alias("taken"), copies.alias("copies"),
    )


def _within(finish, cut):
    """finish, place, key, id are not after the cut."""
    if cut is None:
        return F.lit(False)
    at, place, key, ident = cut
    if place is None:
        return finish <= at
    same = (F.col("place") < place) | ((F.col("place") == place) & (
        (F.col("key") < key) | ((F.col("key") == key) & (F.lit(ident is None) | (F.col("id") <= ident)))
    ))
    return (finish < at) | ((finish == at) & same)

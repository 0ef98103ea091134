"""Near-duplicate vectors: spherical k-means cells, blocked cosine products inside them.

Equal vectors of one label are one class. Centroids are fitted on a bounded sample; every class is put into the cell
of its nearest centroid and also sent to those later cells whose boundary is no further than the linking angle, so no
link is lost between cells. A cell is compared in blocks of at most BLOCK by BLOCK vectors, so a crowded cell is many
tasks. A block gives back link counts and a spanning forest of its links, not its pairs.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.graph import connected_components
from tillroll.llm.workspace import map_arrow, materialize, name_package

#: Vectors that the centroids are fitted on, vectors meant for a cell, most cells, steps, vectors per block side.
SAMPLE, CELL, MOST_CELLS, STEPS, BLOCK = 20_000, 2000, 4096, 12, 1024


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def spherical_kmeans(x: np.ndarray, k: int, seed: int = 3) -> np.ndarray:
    """At most k unit centroids of unit vectors."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(STEPS):
        home = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        norms = np.sqrt((sums * sums).sum(axis=1))
        centres = np.where((norms > 1e-9)[:, None], sums / np.maximum(norms, 1e-9)[:, None], centres)
    return np.unique(centres, axis=0)


def cells(x: np.ndarray, centres: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, home) for each unit vector's nearest centroid, and for each later cell within the linking angle.

    A vector and a linked one nearer to another centroid are on two sides of the plane between the two centroids, so
    the first is no further from that plane than the linking angle.
    """
    near = x @ centres.T
    home = near.argmax(axis=1)
    gaps = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))[home]
    margin = near[np.arange(len(x)), home][:, None] - near
    reach = np.sqrt(1 - cosine * cosine) + 1e-9
    also = (margin <= reach * gaps) & (np.arange(len(centres))[None, :] > home[:, None])
    row, cell = np.nonzero(also)
    rows = np.concatenate([np.arange(len(x)), row])
    return rows, np.concatenate([home, cell]), np.concatenate([np.ones(len(x), bool), np.zeros(len(row), bool)])


def _vectors(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _forest(links: np.ndarray) -> np.ndarray:
    """The least node that each node of a symmetric link matrix reaches."""
    names = np.arange(len(links))
    while True:
        seen = np.where(links, names[None, :], len(links)).min(axis=1)
        new = np.minimum(names, seen)
        new = new[new]
        if (new == names).all():
            return names
        names = new


def _block_links(cosine: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        x = unit(_vectors(table.column("vector")))
        ids, copies = table.column("cls").to_numpy(), table.column("copies").to_numpy()
        side = table.column("side").to_numpy()
        if len(x) == 0 or (side == side[0]).all() and side[0] != 0:
            return schema.empty_table()
        links = x @ x.T >= cosine
        np.fill_diagonal(links, False)
        if (side != 0).any():  # two blocks are compared, or a block with visitors: only across
            links &= side[:, None] != side[None, :]
        counts = links @ copies
        forest = _forest(links)
        some = np.flatnonzero(counts)
        tied = np.flatnonzero(forest != np.arange(len(x)))
        return pa.table({
            "a": np.concatenate([ids[some], ids[tied]]),
            "b": pa.array(np.concatenate([ids[some], ids[forest[tied]]]), mask=np.arange(len(some) + len(tied)) < len(some)),
            "n": np.concatenate([counts[some], np.zeros(len(tied), np.int64)]),
        }, schema=schema)

    return run


def embedding_near_duplicates(
    vectors: DataFrame, *, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """One row per row of `vectors`: (id_col, n_links, component_id, kept).

    Vectors with equal labels link when the cosine of the two in double precision is at least `cosine`. n_links counts
    the other rows linked directly, component_id is the least id that links reach, the own one included, and kept says
    that the row has that id. Rows whose vector is null, empty, zero or holds nulls or non-finite numbers, or whose
    label is null, link with nothing, as do vectors of different lengths; nor do rows without an id. Repeated rows are vectors of their own that
    link with each other. An empty table gives no rows. Other columns are not read. No link is missed: cells decide where pairs
    are compared, not whether.
    """
    spark = vectors.sparkSession
    name_package(spark)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = finite & F.exists("vector", lambda v: v != 0) & F.col("label").isNotNull() & F.col("id").isNotNull()
    # the hashes of the vectors' bits tell equal vectors; scaled by the largest so that no square overflows
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    top = F.array_max(F.transform("vector", lambda v: F.abs(v)))
    rows = rows.withColumn("vector", F.when(F.col("usable"), F.transform(F.col("vector"), lambda v: v / top)))
    rows = rows.withColumns({"h": F.xxhash64("vector"), "g": F.xxhash64(F.lit(1), "vector")})
    usable_rows = rows.filter("usable")
    classes = usable_rows.groupBy("label", "h", "g").agg(
        F.min("id").alias("cls"), F.count("*").alias("copies"), F.any_value("vector").alias("vector")
    )
    classes = materialize(classes.withColumn("dim", F.size("vector")), "classes")
    links = materialize(_links(classes, cosine), "links")
    parts = connected_components(links.filter("b is not null").select("a", "b"))
    degree = links.groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    named = classes.drop("vector", "dim").join(degree, "cls", "left").join(parts.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.select(
        "label", "h", "g", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "cls").alias("component_id"),
    )
    ids = rows.select("id", "usable", F.when(F.col("usable"), F.col("label")).alias("label"), "h", "g")
    out = ids.join(named, ["label", "h", "g"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _links(classes: DataFrame, cosine: float) -> DataFrame:
    """(a, null, n): copies linked to class a, by block; (a, b, 0): ties that connect each block's components."""
    spark = classes.sparkSession
    centres = _centres(classes)
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches):
        for batch in batches:
            for dim in np.unique(batch.column("dim").to_numpy()):
                part = batch.filter(pa.compute.equal(batch.column("dim"), int(dim)))
                x = unit(_vectors(part.column("vector")))
                row, cell, home = cells(x, shared.value.get(int(dim), x[:1]), cosine) if int(dim) in shared.value else (
                    np.arange(len(x)), np.zeros(len(x), np.int64), np.ones(len(x), bool))
                table = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*[table.column(c) for c in ("label", "dim", "cls", "copies", "vector")], pa.array(cell), pa.array(home)],
                    names=["label", "dim", "cls", "copies", "vector", "cell", "home"],
                )

    columns = classes.select("label", "dim", "cls", "copies", "vector")
    placed = map_arrow(
        columns, assign, "label string, dim int, cls long, copies long, vector array<double>, cell long, home boolean"
    )
    placed = materialize(placed, "placed")
    place = ["label", "dim", "cell"]
    sizes = placed.groupBy(*place).agg(F.ceil(F.count_if("home") / BLOCK).alias("homes"), F.ceil(F.count_if(~F.col("home")) / BLOCK).alias("visits"))
    dealt = placed.join(sizes.filter("homes > 0"), place)
    own = F.pmod(F.xxhash64("cls"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("visits")))
    # block pairs (i, j): home blocks i <= j; visitors' block j - homes against every home block
    pairs = F.when(
        F.col("home"),
        F.transform(
            F.sequence(F.lit(0), F.col("homes") + F.col("visits") - 1),
            lambda k: F.struct(F.when(k < F.col("homes"), F.least("own", k)).otherwise(F.col("own")).alias("i"),
                               F.when(k < F.col("homes"), F.greatest("own", k)).otherwise(k).alias("j")),
        ),
    ).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("homes") - 1), lambda k: F.struct(k.alias("i"), (F.col("homes") + F.col("own")).alias("j")))
    )
    spread = dealt.withColumn("own", own).withColumn("pair", F.explode(pairs))
    mine = F.when(F.col("home"), F.col("own")).otherwise(F.col("homes") + F.col("own"))
    side = F.when(F.col("pair.i") == F.col("pair.j"), 0).when(mine == F.col("pair.i"), 1).otherwise(2)
    spread = spread.select(*place, "cls", "copies", "vector", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), side.alias("side"))
    return spread.groupBy(*place, "i", "j").applyInArrow(_block_links(cosine), "a long, b long, n long")


def _centres(classes: DataFrame) -> dict[int, np.ndarray]:
    """Centroids for each of the commonest vector lengths, from at most SAMPLE vectors by a hash of the id. Vectors of
    other lengths share one cell per label and length."""
    counts = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(4).collect()
    centres = {}
    for dim, n in ((r["dim"], r["count"]) for r in counts):
        chosen = classes.filter(F.col("dim") == dim).orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE).select("vector")
        x = unit(np.array([r["vector"] for r in chosen.collect()], dtype=float))
        centres[dim] = spherical_kmeans(x, min(MOST_CELLS, max(1, -(-n // CELL))))
    return centres

"""Connected components by alternating large-star and small-star steps over an edge table."""

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.workspace import map_arrow, materialize

#: Edges that are contracted in one task.
PART = 200_000


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u moves to the smallest node that u sees."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours move to the smallest of them. Edges run from the larger to the smaller node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u != v").unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _contract(edges: DataFrame) -> DataFrame:
    """Each partition's edges become the stars of the components that they form by themselves."""

    def run(batches):
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent.setdefault(p, p)
            return x

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                u, v = root(u), root(v)
                if u != v:
                    parent[max(u, v)] = min(u, v)
        nodes = [x for x in parent if root(x) != x]
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["u", "v"]
        )

    return map_arrow(edges, run, "u long, v long")


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of `links`; component is the smallest node reachable.

    Rows with a null end and self links are ignored. First every PART edges are contracted by themselves, which leaves
    short paths; a single part is then done. Each further round is two joins on the edges and is written to the shared
    folder; the number of rounds grows with the logarithm of the graph's diameter.
    """
    x, y = F.col(a), F.col(b)
    edges = links.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    edges = materialize(edges, "edges")
    parts = -(-edges.count() // PART)
    if parts:
        edges = materialize(_contract(edges.coalesce(parts)), "edges")
    state = _state(edges) if parts > 1 else (0,)
    while state[0]:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        now = _state(edges)
        if now == state:
            break
        state = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())

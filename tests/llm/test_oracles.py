"""Queries that SQL can express against their SQL, on given tables and on odd rows."""

import random

import duckdb
import pytest
from compare import compare

from tillroll.llm import oracles, queries

TABLES = ["documents", "embeddings", "conversations"]


def views(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(oracles.SQL))
def test_queries_equal_their_sql(spark, folder, name):
    assert compare(spark, views(folder), folder, queries.queries()[name], oracles.SQL[name]) is None


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Tables of empty, repeated, white, accented and long texts, of vectors that link with nothing, and of uneven conversations."""
    folder, rng = str(tmp_path_factory.mktemp("odd")), random.Random(5)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(4, 8))) for _ in range(9)]
    texts = [" ".join(rng.choice(stems) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += [None, "", " \n\t", "one two", "one two", "A b C d", "a B c D", "x y z w", *texts[:20], *[t + " tail" for t in texts[:20]], "word " * 30_000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    vectors = [[rng.choice([0.0, 1.0, 0.9]) for _ in range(3)] for _ in range(60)] + [None, [], [0.0] * 3, [1.0, None, 0.0], [float("nan"), 1.0, 0.0], [1.0, 1.0]]
    rows = [(i, v, i % 2 if i % 7 else None) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    turns = [(c, t, rng.choice(["u", "a", None]), rng.choice(["", "hé", "hi", None])) for c in range(40) if c % 13 for t in [None, *range(c % 6)]]
    spark.createDataFrame([*turns, *turns[:9]], "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    return folder


@pytest.mark.parametrize("name", list(oracles.SQL))
def test_queries_equal_their_sql_on_odd_rows(spark, odd, name):
    # Spark writes a folder of part files for each table
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{odd}/{t}.parquet/*.parquet'")
    assert compare(spark, con, odd, queries.queries()[name], oracles.SQL[name]) is None

"""Registered queries on the smallest tables, and the pipeline's stages."""

import corpus_pipeline
import pytest

from tillroll.llm import queries as corpus

COLUMNS = {
    "op1": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op2": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op3": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op4": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op6": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op8": {"doc_id": "bigint", "n_lines": "bigint"},
    "op9": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
            "near_edited": "double", "near_next": "double"},
    "op10": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op11": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op12": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
    "op13": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint", "n_leaves": "bigint",
             "saved_tokens": "bigint", "ends_sha256": "string"},
}
#: Tables of which a query returns one row per row; of the others it has results of its own number.
WHOLE = {"op3": "embeddings", "op11": "pages", "op12": None, "op13": None}


def test_all_operators_are_registered():
    assert {name.split("_")[0] for name in corpus.queries()} == set(COLUMNS)


@pytest.mark.parametrize("name", list(corpus.queries()))
def test_query_covers_its_table(spark, folder, name):
    got = corpus.queries()[name](spark, folder)
    kinds = dict(got.dtypes)
    number = name.split("_")[0]
    for column, kind in COLUMNS[number].items():
        assert kinds[column] == kind
    whole = WHOLE.get(number, "documents")
    rows = got.count()
    assert rows == spark.read.parquet(f"{folder}/{whole}.parquet").count() if whole else rows > 0


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder).cache()
        if k < 4:
            assert out.columns == names and dict(out.dtypes) == dict(docs.dtypes)
        if k < 3:
            assert 0 < out.count() <= docs.count()
        docs = out
    assert docs.count() > 0 and "ids" in docs.columns


def test_stages_on_planted_rows(spark, documents, folder):
    base = "every word of this passage is here to be found again in the copy that follows it " * 3
    rows = [(1, base), (2, base), (3, base.replace("found", "seen")), (4, "a short clean text about the weather"), (5, None), (6, "")]
    docs = documents(rows)
    kept = corpus_pipeline.drop_near_copies(spark, docs, folder)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 6] or sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6]
    twice = documents([(1, base), (1, base), (1, "other words"), (None, "x"), (None, "x")]).select(*docs.columns)
    assert sorted(str(r.doc_id) for r in corpus_pipeline.drop_near_copies(spark, twice, folder).collect()) == ["1", "1", "None"]
    lines = corpus_pipeline.drop_repeated_lines(spark, docs, folder).collect()
    assert sorted(r.doc_id for r in lines) == [1, 3, 4, 5, 6]
    mixed = corpus_pipeline.mix(spark, docs, folder).collect()
    assert all(sum(r.doc_id == i for r in mixed) <= 2 for i in range(1, 7))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).collect() == []


def test_rows_without_or_with_shared_ids_are_judged_by_their_text(spark, documents, folder):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    names = spark.read.parquet(f"{folder}/documents.parquet").columns
    learned = [(i, given[i]) for i in labels if i in given]
    kept = {r.text for r in corpus_pipeline.drop_toxic(spark, documents(learned), folder).collect()}
    toxic = next(t for i, t in learned if labels[i] == 1 and t not in kept)
    clean = next(t for i, t in learned if labels[i] == 0 and t in kept)
    odd = [(-1, toxic), (-1, clean), (None, toxic), (None, clean), (None, None)]
    docs = documents([*learned, *odd])
    assert set(names) <= set(docs.columns)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_toxic(spark, docs, folder).collect()]
    assert [x for x in odd if x in got] == [(-1, clean), (None, clean), (None, None)]
    copy = "every word of this passage is here to be found again in the copy that follows it " * 3
    rows = [(None, copy), (7, copy), (7, "something else that has words of its own"), (None, "one of no copies at all here"), (None, None), (8, copy + "end")]
    left = corpus_pipeline.drop_near_copies(spark, documents(rows), folder).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted([rows[1], rows[2], rows[3], rows[4]], key=str)


def test_own_short_lines_keep_a_document(spark, documents, folder):
    shared = "this long line of boilerplate stands in many documents"
    docs = documents([(1, shared), (2, f"{shared}\nmilk\neggs"), (3, f"{shared}\n \u2003\t\n"), (4, f"milk\n{shared}"), (5, " ")])
    lines = corpus_pipeline.drop_repeated_lines(spark, docs, folder).collect()
    assert {r.doc_id: r.text for r in lines} == {1: shared, 2: "milk\neggs", 5: " "}


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0

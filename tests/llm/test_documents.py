"""Per-document operators: exact against the libraries and brute force, held-out accuracy for the models."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import bpe, fingerprints, mixing, quality, sharding, token_counts, toxicity

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

MARKS = list("ab the  \n\t.,'sll é▁ﬁ中👍́\xa0　\x85\x1c\x1d​\x00²½٣ǅ'") + [
    "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "  ", "   ", "the", "ing", " ing", "'re", "▁▁", "🏳️‍🌈",
]


def odd_texts(n=1500, seed=1):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(MARKS) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [None, "", " ", "\n", "a", "x" * 20_000, "many words " * 20_000, texts[0], texts[0], *texts]


@pytest.fixture(scope="module")
def folder_labels(spark, folder):
    read = lambda name: spark.read.parquet(f"{folder.replace('0.001', '0.1')}/{name}.parquet")
    return read("documents"), read("labels")


def test_token_counts_are_the_librarys(documents):
    texts = odd_texts()
    rows = [(i if i != 5 else None, t) for i, t in enumerate(texts)]
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in rows]
    got = token_counts.token_counts(documents(rows).repartition(4), PIECES, limit=100).collect()
    assert sorted((tuple(r)[:3] for r in got), key=str) == sorted(want, key=str)
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    assert token_counts.token_counts(documents([]), PIECES).collect() == []


def test_token_counts_forget_and_go_on(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_counts, "KNOWN", 3)
    monkeypatch.setattr(token_counts, "RUN_BYTES", 10)
    texts = odd_texts(100, seed=4)[7:]
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert token_counts._batch_counts(pa.array(texts), PIECES) == [len(x) for x in model.encode(texts)]


def test_bpe_is_the_librarys(documents):
    texts = odd_texts()
    library = Tokenizer.from_file(BPE)
    want = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    rows = documents(list(enumerate(texts))).repartition(4)
    got = bpe.bpe_round_trip(rows, BPE).collect()
    assert len(got) == len(texts)
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == want[r.doc_id]
        assert r.text == library.decode(want[r.doc_id], skip_special_tokens=False) == (texts[r.doc_id] or "")
    encoded = bpe.bpe_encode(rows, BPE)
    assert {r.doc_id: r.text for r in bpe.bpe_decode(encoded, BPE).collect()} == {r.doc_id: r.text for r in got}
    assert bpe.bpe_encode(documents([]), BPE).collect() == []


def test_bpe_decodes_any_ids():
    library, own = Tokenizer.from_file(BPE), bpe.load(BPE)
    rng = random.Random(3)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(12))]
        assert own.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def water_level(sizes, weights, share, repeats):
    """Targets by resharing the excess until none is above, as stated."""
    budget, caps = share * sum(sizes), [repeats * s for s in sizes]
    full, targets = set(), [0.0] * len(sizes)
    while True:
        left = budget - sum(caps[i] for i in full)
        rest = [i for i in range(len(sizes)) if i not in full]
        for i in rest:
            targets[i] = left * weights[i] / sum(weights[j] for j in rest)
        above = [i for i in rest if targets[i] > caps[i]]
        if not above:
            return [caps[i] if i in full else targets[i] for i in range(len(sizes))]
        full |= set(above)


def test_mix(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    monkeypatch.setattr(mixing, "LEFT", 10)
    rng = random.Random(8)
    names = ["b", "a", "Z", "é", None, "hot", "tiny"]
    rows = [(i, "w " * rng.choice([0, 1, 5, 30, 90]), "hot" if i % 3 == 0 else rng.choice(names)) for i in range(2500)]
    rows += [(5000, "one two", "tiny2"), (5001, None, "empty"), (5002, " ", "empty"), (None, "x y", "a"), (7, "x y", "a"), (7, "x y", "a")]
    table = documents(rows)
    got = mixing.mix_sources(table.repartition(5)).collect()
    again = mixing.mix_sources(table.repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(len((t or "").split()) for _, t, x in rows if x == s) for s in sources]
    targets = water_level(sizes, [(5, 2, 1)[i % 3] for i in range(len(sources))], 1.5, 2)
    largest = 90
    for s, size, target in zip(sources, sizes, targets):
        own = [r for r in got if r.source == s]
        assert {r.source_size for r in own} == {size} and all(abs(r.target - target) < 1e-6 * max(1, target) for r in own)
        assert abs(sum(r.taken for r in own) - target) <= largest
        assert all(r.taken in (0, r.size, 2 * r.size) for r in own)
    assert 0 <= 1.5 * sum(sizes) - sum(r.taken for r in got) <= largest
    sized = table.select(F.col("doc_id").alias("id"), "source", F.size(F.split("text", " ")).cast("long").alias("size"))
    targets = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    queued = mixing._queued(sized, mixing.source_targets(targets, (5, 2, 1), 1.5, 2), 17)
    widest = queued.groupBy("source", "block").count().agg(F.max("count")).first()[0]
    assert widest <= 3 * 16  # a source with a third of the rows is many blocks
    assert mixing.mix_sources(documents([])).collect() == []
    assert [r.taken for r in mixing.mix_sources(documents([(1, None), (2, " ")])).collect()] == [0, 0]


def test_best_fit_decreasing():
    rng = random.Random(4)
    for _ in range(30):
        sizes = sorted((rng.randint(1, 60) for _ in range(rng.randint(1, 200))), reverse=True)
        place, bins = sharding.best_fit_decreasing(sizes, 64)
        room, want = [], []
        for s in sizes:  # the tightest bin by trying all
            able = [(r, k) for k, r in enumerate(room) if r >= s]
            k = min(able)[1] if able else len(room)
            if not able:
                room.append(64)
            room[k] -= s
            want.append(k)
        filled = lambda p: sorted(sum(s for s, q in zip(sizes, p) if q == k) for k in set(p))
        assert filled(place) == filled(want) and bins == len(room)
        even = sharding.fewest_even(sizes, 5)
        assert max(even) < 5 and len(even) == len(sizes)
        loads = [sum(s for s, q in zip(sizes, even) if q == k) for k in range(5)]
        assert max(loads) <= max(sum(sizes) / 5 * 1.35 + 1, sizes[0])


def test_shards(documents, monkeypatch):
    monkeypatch.setattr(sharding, "GROUPS_PER_PART", 100)
    monkeypatch.setattr(sharding, "BLOCK", 16)
    rng = random.Random(6)
    texts = ["t%d " % i + "é" * rng.choice([0, 3, 50, 400]) for i in range(900)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[3]) for i in range(300)]
    rows += [(2000, None), (2001, None), (2002, ""), (2003, ""), (None, "x"), (5, texts[5]), (5, texts[5])]
    got = sharding.shard_groups(documents(rows).repartition(5), 7).collect()
    assert len(got) == len(rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert set(slots) <= set(range(7)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    text = {i: t for i, t in rows}
    place = {}
    for r in got:
        t = text[r.doc_id]
        assert r["size"] == len((t or "").encode()) + 8 and r.text_crc32 == (None if t is None else zlib.crc32(t.encode()))
        place.setdefault(t, set()).add(r.shard)
    assert all(len(s) == 1 for s in place.values())
    load = [sum(r["size"] for r in got if r.shard == s) for s in range(7)]
    assert max(load) <= 1.02 * sum(load) / 7 and min(load) >= 0.95 * sum(load) / 7
    assert sharding.shard_groups(documents([]), 7).collect() == []
    assert {r.shard for r in sharding.shard_groups(documents([(1, "a"), (2, "a")]), 24).collect()} == {0}


def test_fingerprints(documents, spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 7)
    rng = random.Random(2)
    line = lambda: "".join(rng.choice("abcé中👍 ") for _ in range(rng.randint(0, 70)))
    texts = ["\n".join(line() for _ in range(rng.randint(1, 30))) for _ in range(150)] + ["", "a", "\n\n", "x" * 30_000]
    ids = rng.sample(range(-500, 5000), len(texts))
    rows = list(zip(ids, texts)) + [(6000, texts[0]), (6001, None)]
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(documents(rows).repartition(4)).collect()}
    order = sorted(rows)
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 4
        edited = t[: len(t) - n] + following[:n]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[i].fingerprint == got[i].edited_fingerprint) == (t == edited)
        assert 0 <= got[i].near_next <= 1 and 0 <= got[i].near_edited <= 1
        if len(t) > 400 and len(following) > 100:
            assert 0.5 < got[i].near_edited < 0.9 and got[i].near_next < 0.2
    assert got[6000].fingerprint == got[ids[0]].fingerprint and got[6001].fingerprint == got[ids[texts.index("")]].fingerprint
    assert len({r.fingerprint for r in got.values()}) == len(set(t or "" for _, t in rows))
    assert fingerprints.edited_fingerprints(documents([])).collect() == []
    alone = fingerprints.edited_fingerprints(documents([(4, "only one")])).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"only oon").hexdigest()
    same = fingerprints.edited_fingerprints(documents([(1, "p"), (1, "p"), (None, "q")])).collect()
    assert len(same) == 3


def test_fingerprints_locate_edits(spark):
    lines = [f"line {i}" for i in range(40)]
    changed = list(lines)
    changed[3], changed[25] = "other", "another"
    df = spark.createDataFrame([("\n".join(lines), "\n".join(changed)), ("a", "a")], "a string, b string")
    mark = lambda c: fingerprints.fingerprint(fingerprints.tree(F.col(c)))
    marks = df.select(mark("a").alias("x"), mark("b").alias("y"))
    got = marks.select(fingerprints.differing_paragraphs(F.col("x"), F.col("y")).alias("d")).collect()
    assert [r.d for r in got] == [[3, 25], []]


def test_fingerprints_run_no_python(documents):
    plan = fingerprints.edited_fingerprints(documents([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def checksum(i):
    return zlib.crc32(str(i).encode())


@pytest.mark.parametrize(("score", "column", "modulus", "remainder", "least"), [
    (toxicity.toxicity_scores, "toxic", 5, 0, 0.95), (quality.quality_scores, "quality", 4, 2, 0.98),
])
def test_models_on_held_out_labels(spark, folder_labels, score, column, modulus, remainder, least):
    documents, labels = folder_labels
    known = [(r.doc_id, r[column]) for r in labels.collect()]
    fitted = spark.createDataFrame([k for k in known if checksum(k[0]) % modulus != remainder], f"doc_id long, {column} int")
    got = {r.doc_id: r for r in score(documents, fitted).collect()}
    assert len(got) == documents.count() and all(0 <= r.score <= 1 for r in got.values())
    aside = [k for k in known if checksum(k[0]) % modulus == remainder]
    assert np.mean([got[i].predicted == y for i, y in aside]) >= least


@pytest.mark.parametrize(("score", "column"), [(toxicity.toxicity_scores, "toxic"), (quality.quality_scores, "quality")])
def test_models_with_odd_rows(documents, spark, score, column):
    rows = [(i, ("plain words in a row number %d" % i) if i % 2 else "IDIOT!! ### %%% $$$ idiot") for i in range(40)]
    odd = [(100, None), (101, ""), (102, "y" * 50_000), (103, "plain words " * 30_000), (None, "plain words"), (1, "idiot"), (104, "\n\n \t")]
    labels = [(i, int((i % 2 == 0) == (column == "toxic"))) for i in range(40)] + [(None, 1), (3, None), (999, 1), (2, 1)]
    labels = spark.createDataFrame([(*r, "x") for r in labels], f"doc_id long, {column} int, text string")
    table = documents(rows + odd)
    got = score(table, labels).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    assert sorted(map(str, score(table.repartition(3), labels).collect())) == sorted(map(str, got))
    assert score(documents([]), labels).collect() == []
    for few in (labels.limit(0), labels.filter(f"{column} = 0"), labels.filter(f"{column} = 1")):
        assert len({r.score for r in score(table, few).collect()}) == 1


def test_misspelt_words_score_like_the_words():
    rng = random.Random(5)
    plain = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(3, 7))) for _ in range(400)]
    texts = [" ".join(rng.choices(plain, k=60)) for _ in range(300)]
    labels = np.array([i % 3 == 0 for i in range(300)], dtype=float)
    texts = [t + " worthless" + t[::-1] if y else t for t, y in zip(texts, labels)]
    weights, bias = toxicity.fit(texts, labels)
    score = lambda w: toxicity.word_scores([w], weights)[0]
    assert score("worthles") > np.percentile([score(w) for w in plain], 99)


@pytest.mark.parametrize("values", [[(0, 0.5), (0, 1.5), (1, 2.5), (1, 4.0)], [(0, 3.0), (1, 1.0), (1, 2.0)], [(0, 1.0), (1, 1.0)], [(1, 2.0), (0, 1.0)] * 500])
def test_quality_cut_is_the_quantile_of_all_labelled(spark, values):
    """The middle between the largest score of the lowest share of bad ones and the next larger score."""
    labels, raw = np.array([x for x, _ in values]), np.array([x for _, x in values])
    low = np.sort(raw)[int(np.ceil((1 - labels.mean()) * len(raw) - 1e-9)) - 1]
    above = raw[raw > low]
    cut, slope = quality.cut_and_slope(spark.createDataFrame(values, "label int, raw double"))
    assert cut == pytest.approx((low + (above.min() if len(above) else low)) / 2)
    assert slope == pytest.approx(2 / max(1e-6, raw.std()))


def test_preferences_are_fitted_as_by_plain_descent(monkeypatch):
    """Bradley-Terry weights of few pairs against gradient descent on the same loss."""
    monkeypatch.setattr(quality, "PAIRS", 300)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 3))
    labels = (x @ [1.0, -0.5, 0.0] + rng.normal(size=60) > 0).astype(float)
    weights, centre, spread = quality.fit_preferences(x, labels, seed=5, ridge=0.05)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    drawn = np.random.default_rng(5)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    d = z[drawn.choice(good, 300)] - z[drawn.choice(bad, 300)]
    plain = np.zeros(3)
    for _ in range(4000):
        plain += 0.3 * ((d / (1 + np.exp(d @ plain))[:, None]).mean(axis=0) - 0.05 * plain)
    assert np.allclose(weights, plain, atol=1e-3) and np.allclose(centre, x.mean(axis=0)) and np.allclose(spread, x.std(axis=0))


def test_labels_of_absent_documents_use_up_no_sample(spark, documents):
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(3, None), (None, 1)], "doc_id long, quality int")
    texts, found = toxicity.sample(documents([(90, "a"), (91, "b"), (97, "c"), (97, "b2"), (None, "d")]), labels, "quality", 2, "doc_id", "text")
    assert sorted(zip(texts, found)) == [("a", 0.0), ("b", 1.0), ("b2", 1.0)]

"""N-gram join, embeddings, line dedup and components against brute force on small tables."""

import itertools
import random
import time
import tracemalloc
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import edit_distance as edit_distance_bits
from tillroll.llm import embeddings, line_dedup, ngram_join, workspace
from tillroll.llm.graph import connected_components

ODD = [
    (None, "a b c d e f g"), (901, None), (902, ""), (903, " \n\t "), (904, "one two"), (905, "One  TWO\n"), (906, "x" * 5000),
    (907, "word " * 30_000), (907, "word " * 30_000), (907, "another text under the same id"),
]


def components(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) or (frozenset([tuple(words)]) if words else frozenset())


def family(seed=5, members=60):
    """Texts that share a passage, and a family of near copies around the threshold."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    base, passage = [word() for _ in range(90)], [word() for _ in range(40)]
    texts = []
    for _ in range(members):
        text = list(base)
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(len(text))] = word()
        texts.append(" ".join(text))
        texts.append(" ".join([word() for _ in range(rng.randint(0, 80))] + passage))
    return [(i * 3, t) for i, t in enumerate(texts)] + [(1, texts[0].upper()), (2, texts[5])]


@pytest.mark.parametrize(("k", "num", "den"), [(4, 85, 100), (5, 80, 100), (1, 50, 100)])
@pytest.mark.parametrize("frequent", [4, 1000])
def test_ngram_join_is_brute_force(documents, monkeypatch, k, num, den, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rows = family() + ODD[1:7]
    sets = [shingles(t, k) for _, t in rows]
    links = [
        (a, b) for a, b in itertools.combinations(range(len(rows)), 2)
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    assert len(links) > 20
    group = components(len(rows), links)
    least = {g: min(rows[i][0] for i in range(len(rows)) if group[i] == g) for g in group}
    want = sorted((r[0], len(s), least[g]) for r, s, g in zip(rows, sets, group))
    got = ngram_join.ngram_jaccard_join(documents(rows).repartition(5), k=k, num=num, den=den)
    assert sorted(map(tuple, got.collect())) == want


def test_ngram_join_odd_rows(documents):
    got = sorted(map(tuple, ngram_join.ngram_jaccard_join(documents(ODD)).collect()), key=str)
    assert len(got) == len(ODD)
    by = {}
    for r in got:
        by.setdefault(r[0], []).append(r[1:])
    assert by[901] == by[902] == by[903][:1] == [(0, 901)] or by[901] == [(0, 901)]
    assert by[902] == [(0, 902)] and by[903] == [(0, 903)]
    assert by[904] == [(1, 904)] and by[905] == [(1, 904)]
    assert sorted(by[907]) == [(1, 907), (1, 907), (3, 907)]
    assert ngram_join.ngram_jaccard_join(documents([])).collect() == []


@pytest.mark.parametrize("block", [4, 512])
def test_wide_columns_that_share_rows_are_dealt_once(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(6)
    families = [rng.sample(range(10**9), 12) for _ in range(5)]
    columns = [rng.sample(f, rng.randint(2, 12)) for f in families for _ in range(20)] + [rng.sample(sum(families, []), 9) for _ in range(6)]
    rows = [(h, sig, len(c)) for h, c in enumerate(columns) for sig in c]
    got = ngram_join._grouped(spark.createDataFrame(rows, "h long, sig long, width long")).collect()
    groups = {}
    for h, sig, width in got:
        groups.setdefault(h, []).append(sig)
        assert width == sum(r.h == h for r in got)
    assert all(len(set(g)) == len(g) for g in groups.values())
    pairs = {p for g in groups.values() for p in itertools.combinations(sorted(g), 2)}
    assert {p for c in columns for p in itertools.combinations(sorted(c), 2)} <= pairs
    cost = lambda sizes: sum(n * -(-n // block) for n in sizes)
    assert cost(map(len, groups.values())) < cost(map(len, columns)) / (3 if block == 512 else 1)


def test_sets_come_from_the_chosen_rows_only(spark, documents, monkeypatch):
    """Only texts whose id the bitmap holds are read for their sets; a false bit and a shared id add no row."""
    seen = []
    kept = ngram_join.map_arrow
    monkeypatch.setattr(ngram_join, "map_arrow", lambda *a: seen.append(kept(*a)) or seen[-1])
    docs = documents([(i, f"text number {i} has words of its own {i * i}") for i in range(200)] + [(7, "other words under one id"), (None, "no id here at all")])
    sizes = ngram_join.document_shingles(docs, 4, "doc_id", "text")
    classes = sizes.groupBy("sig").agg({"id": "min"}).toDF("sig", "first_id")
    want = {r.sig: r.n_shingles for r in sizes.filter("id in (3, 7)").collect()}
    sets = ngram_join._sets(classes.filter("first_id in (3, 7) or first_id is null").select("sig"), docs, classes, 4, "doc_id", "text")
    assert {r["sig"]: len(r["items"]) for r in sets.collect()} == want and len(want) == 3
    assert seen[-1].count() == 3


def test_components(spark, monkeypatch):
    from tillroll.llm import graph

    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(0, 150)]
    stars = [(1000, 1000 + i) for i in range(1, 60)]
    loose = [(2000 + rng.randrange(80), 2000 + rng.randrange(80)) for _ in range(50)]
    links = chain + stars + loose + [(5, 5), (None, 3), (7, None)]
    rng.shuffle(links)
    kept = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    nodes = sorted({x for p in kept for x in p})
    at = {x: i for i, x in enumerate(nodes)}
    want = {x: nodes[c] for x, c in zip(nodes, components(len(nodes), [(at[a], at[b]) for a, b in kept]))}
    df = spark.createDataFrame(links, "a long, b long")
    for part in (200_000, 25):
        monkeypatch.setattr(graph, "PART", part)
        assert {r[0]: r[1] for r in connected_components(df).collect()} == want
    assert connected_components(df.filter("a = 5 and b = 5")).collect() == []


def test_embeddings_are_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 20)
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(240):
        v = centres[rng.integers(12)] + rng.normal(scale=rng.choice([0.02, 0.12, 0.2]), size=16)
        rows.append((i, [float(x) for x in v], int(rng.integers(3))))
    rows += [(300 + i, rows[i][1], rows[i][2]) for i in range(20)] + [(400, [2 * x for x in rows[3][1]], rows[3][2])]
    bad = [
        (500, None, 1), (501, [], 1), (502, [0.0] * 16, 1), (503, [float("nan")] * 16, 1), (504, [None] * 16, 1),
        (505, [float("inf")] + [0.0] * 15, 1), (506, rows[0][1], None), (507, rows[0][1][:5], rows[0][2]),
    ]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int")
    x = np.array([r[1] for r in rows])
    cos = (x @ x.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(x, axis=1)
    label = np.array([r[2] for r in rows])
    linked = (cos >= 0.98) & (label[:, None] == label) & ~np.eye(len(x), dtype=bool)
    assert 100 < linked.sum() < linked.size / 4
    group = components(len(rows), np.argwhere(linked))
    want = [(r[0], int(linked[i].sum()), rows[group[i]][0], group[i] == i) for i, r in enumerate(rows)]
    want += [(r[0], 0, r[0], True) for r in bad]
    got = embeddings.embedding_near_duplicates(table.repartition(4))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert embeddings.embedding_near_duplicates(table.limit(0)).collect() == []


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, text, k):
    text = list(text)
    for _ in range(k):
        i, kind = rng.randrange(len(text) + 1), rng.randrange(3)
        text[i : i + (kind > 0)] = [rng.choice("abé中")] if kind < 2 else []
    return "".join(text)


@pytest.mark.parametrize("edits", [0, 1, 2, 4])
def test_banded_distance(edits):
    rng = random.Random(edits)
    a = ["".join(rng.choice("abé中") for _ in range(rng.randrange(15))) for _ in range(1500)]
    b = [edited(rng, x, rng.randrange(edits + 3)) for x in a]
    want = [edit_distance(x, y) <= edits for x, y in zip(a, b)]
    assert line_dedup.near_pairs(a, b, edits, 0).tolist() == want


@pytest.mark.parametrize("few", [2, 32])
@pytest.mark.parametrize("edits", [1, 2])
def test_line_dedup_is_brute_force(documents, monkeypatch, few, edits):
    monkeypatch.setattr(line_dedup, "FEW", few)
    monkeypatch.setattr(line_dedup, "BLOCK", 6)
    monkeypatch.setattr(line_dedup, "PIVOTS", few)
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefé ") for _ in range(rng.randint(20, 60))) for _ in range(25)]
    docs = []
    for i in range(60):
        lines = [edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 6])) for _ in range(rng.randint(1, 6))]
        docs.append((i, "\n".join(lines + rng.choice([[], [""], ["short"]]))))
    places = [(i, k, line) for i, text in docs for k, line in enumerate(text.split("\n")) if len(line) >= 20]
    links = [
        (a, b) for a, b in itertools.combinations(range(len(places)), 2) if edit_distance(places[a][2], places[b][2]) <= edits
    ]
    group = components(len(places), links)
    gone = {}
    for p, (i, k, _) in enumerate(places):
        if group[p] != p:
            gone.setdefault(i, []).append(k)
    got = line_dedup.line_dedup(documents(docs).repartition(5), edits=edits, min_chars=20).orderBy("doc_id").collect()
    for (i, text), row in zip(docs, got):
        assert row.removed_lines == gone.get(i, [])
        assert row.text == "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone.get(i, []))
        assert row.n_lines == len(text.split("\n")) and row.n == -1 and row.id == "x"


def test_line_dedup_odd_rows(documents):
    long = "this line is long enough to be compared with others"
    rows = ODD + [(1, long), (2, long + "\n" + long + "!"), (3, "\n".join([long + "\r"] * 3000)), (4, long), (4, long)]
    got = line_dedup.line_dedup(documents(rows)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.text, r.n_lines, r.removed_lines))
    assert by[901] == [(None, 0, [])] and by[902] == [("", 1, [])]
    assert by[1] == [(long, 1, [])] and by[2] == [("", 2, [0, 1])]
    assert by[3][0][0] == "" and len(by[3][0][2]) == 3000
    assert by[4] == [("", 1, [0])] * 2
    assert len(got) == len(rows)
    assert line_dedup.line_dedup(documents([])).collect() == []


def test_line_dedup_equal_short_lines(documents):
    rows = [(1, "Les.\nAnd\n\nown"), (2, "Les.\n\n\nAnt"), (3, "And\nLes."), (4, "x"), (5, "x"), (6, "")]
    table = documents(rows).repartition(3)
    got = line_dedup.line_dedup(table, min_equal=1).collect()
    assert {r.doc_id: (r.text, r.n_compared, r.removed_lines) for r in got} == {
        1: ("Les.\nAnd\n\nown", 3, []), 2: ("\n\nAnt", 2, [0]), 3: ("", 2, [0, 1]), 4: ("x", 1, []), 5: ("", 1, [0]), 6: ("", 0, []),
    }
    assert all(r.removed_lines == [] for r in line_dedup.line_dedup(table).collect())


@pytest.mark.parametrize(("look", "chunk"), [(1, 5000), (16, 1 << 22)])
def test_bounds_of_their_own(monkeypatch, look, chunk):
    """Bands of a word and wider ones, patterns shorter than the band, pairs that end early."""
    monkeypatch.setattr(edit_distance_bits, "LOOK", look)
    monkeypatch.setattr(edit_distance_bits, "CHUNK", chunk)
    rng = random.Random(4)
    for size in (1, 12, 60, 140):
        a = ["".join(rng.choice("abé中" if rng.random() < 0.5 else "abcdefgh") for _ in range(rng.randrange(size))) for _ in range(250)]
        b = [edited(rng, x, rng.randrange(1 + max(3, size // 3))) if rng.random() < 0.8 else rng.choice(a) for x in a]
        bounds = np.array([rng.choice([rng.randrange(32), 31, 32, rng.randrange(32, 60)]) for _ in a])
        assert edit_distance_bits.within_bounds(a, b, bounds).tolist() == [edit_distance(x, y) <= t for x, y, t in zip(a, b, bounds)]
    long = "".join(rng.choice("abcdefgh ") for _ in range(40_000))
    assert edit_distance_bits.within_bounds([long] * 2, [edited(rng, long, 900), long[::-1]], np.array([1600, 1600])).tolist() == [True, False]


@pytest.mark.parametrize("share", [0, 0.001, 0.06, 0.07, 0.5, 1])
def test_blocks_of_bits(share):
    bits = np.packbits(np.random.default_rng(3).random(8 * 4096) < share)
    packed = line_dedup._packed(bits)
    assert (line_dedup._unpacked(packed) == bits).all() and len(packed) <= 4096


def test_line_dedup_odd_rows_with_growing_bound(documents):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    long = " ".join(word() for _ in range(25_000))
    line = " ".join(word() for _ in range(30))
    near = line.replace(" ", "  ", 3)
    rows = ODD + [(1, long), (2, edited(rng, long, 4000) + "\n" + line), (3, near), (4, line), (4, line), (None, near), (5, "\n".join([near] * 2000)), (6, None)]
    got = line_dedup.line_dedup(documents(rows).repartition(3), edits=2, every=25, min_chars=20, min_equal=1).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.text, r.n_lines, r.removed_lines))
    assert by[901] == [(None, 0, [])] and by[902] == [("", 1, [])] and by[6] == [(None, 0, [])]
    assert by[1] == [(long, 1, [])] and by[2] == [("", 2, [0, 1])]
    assert (near, 1, []) in by[None] and by[3] == [("", 1, [0])] and by[4] == [("", 1, [0])] * 2
    assert by[5][0][2] == list(range(2000)) and len(got) == len(rows)


@pytest.mark.parametrize("every", [0, 25])
def test_pairs_of_lines_meet_once_within_their_lengths(spark, every):
    """A pair that many keys give is verified once, and one whose lengths are too far apart moves no text."""
    rng = random.Random(12)
    lengths = [rng.randint(20, 120) for _ in range(40)]
    rows = [(key, i, lengths[i], rng.random() < 0.5) for key in range(30) for i in rng.sample(range(40), 9)]
    under = spark.createDataFrame(rows, "key long, line long, length int, indexed boolean")
    got = line_dedup._pairs(under, under, "a.indexed and (not b.indexed or a.line < b.line)", 2, every).distinct().collect()
    want = set()
    for (k, a, m, x), (q, b, n, y) in itertools.combinations(rows, 2):
        if k == q and (x or y) and abs(m - n) <= (max(2, min(m, n) // every) if every else 2):
            want.add((min(a, b), max(a, b)))
    assert sorted(map(tuple, got)) == sorted(want)
    base = ["".join(rng.choice("abcdefé ") for _ in range(60)) for _ in range(6)]
    texts = [edited(rng, rng.choice(base), rng.choice([0, 1, 2, 4])) for _ in range(40)]
    table = spark.createDataFrame(list(enumerate(texts)), "line long, text string")
    pairs = [(a, b) for a, b in itertools.combinations(range(40), 2)]
    links = line_dedup._pair_links(spark.createDataFrame(pairs * 3, "a long, b long"), table, 2, every).collect()
    assert sorted(map(tuple, links)) == [(a, b) for a, b in pairs if edit_distance(texts[a], texts[b]) <= 2]


def test_crowded_keys_of_one_family_give_their_pairs_once(spark):
    rng = random.Random(7)
    families = [range(100 * f, 100 * f + 60) for f in range(3)]
    many = [(k, line, 50) for k in range(45) for line in rng.sample(families[k % 3], 50)]
    many += [(50 + k, line, 50) for k in range(4) for line in rng.sample([x for f in families for x in f], 40)]
    many = spark.createDataFrame(many, "key long, line long, length int").withColumn("indexed", F.expr("line % 4 > 0"))
    pivots = line_dedup._pivots(many)
    pair = lambda rows: {(a, b) for a, b in map(tuple, rows.collect())}
    alone, joint = line_dedup._pairs(many, pivots, "true", 2, 0), line_dedup._pairs(*line_dedup._grouped(many, pivots), "true", 2, 0)
    assert pair(alone) <= pair(joint) and joint.count() < alone.count() / 2


def test_join_of_marked_rows_is_a_left_join(spark):
    rows = spark.range(3000).selectExpr("id div 2 as id", "xxhash64(id div 2) as __rid").repartition(4)
    for some in ("id % 7 = 0", "false"):
        removed = rows.filter(some).select("__rid").distinct().selectExpr("__rid", "array(cast(__rid % 5 as int)) as __removed")
        want = rows.join(removed, "__rid", "left").select("id", "__rid", "__removed")
        got = line_dedup._joined_where_marked(rows, removed).select("id", "__rid", "__removed")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("few", [2, 32])
def test_line_dedup_of_long_lines_is_brute_force(documents, monkeypatch, few):
    monkeypatch.setattr(line_dedup, "FEW", few)
    monkeypatch.setattr(line_dedup, "BLOCK", 6)
    monkeypatch.setattr(line_dedup, "PIVOTS", few)
    rng = random.Random(21)
    vocabulary = ["".join(rng.choice("abcdefghé中") for _ in range(rng.randint(2, 9))) for _ in range(60)]
    lines = []
    for size in [70, 74, 75, 76, 99, 120, 200, 240, 320]:
        base = ""
        while len(base) < size:
            base += rng.choice(vocabulary) + " "
        base = base[:size]
        for k in range(6):  # one or two words replaced, or edits at the bound and one off it, spread or at one end
            words = base.split(" ")
            for _ in range(1 + k % 2):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            lines.append(" ".join(words))
        bound = max(2, size // 25)
        lines += [base, edited(rng, base, bound - 1), edited(rng, base, bound), edited(rng, base, bound + 1), "q" * bound + base, base[bound:]]
    rng.shuffle(lines)
    docs = [(i, "\n".join(lines[at : at + 3])) for i, at in enumerate(range(0, len(lines), 3))]
    links, far = [], 0
    for a, b in itertools.combinations(range(len(lines)), 2):
        bound = max(2, min(len(lines[a]), len(lines[b])) // 25)
        if abs(len(lines[a]) - len(lines[b])) <= bound and (distance := edit_distance(lines[a], lines[b])) <= bound:
            links.append((a, b))
            far += distance > 2 and len(lines[a]) >= 200
    group = components(len(lines), links)
    assert far > 10
    got = line_dedup.line_dedup(documents(docs).repartition(5), edits=2, every=25, min_chars=20).collect()
    assert {r.doc_id: r.removed_lines for r in got} == {i: [k for k in range(3) if group[3 * i + k] != 3 * i + k] for i, _ in docs}


def test_line_dedup_gives_disk_back(spark, documents):
    """Tables that no later step reads go, as do the shuffle files of a written table."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {p for d in manager.localDirsString() for p in Path(d).glob("*/shuffle_*.data")}
    written = workspace.materialize(spark.range(1000).groupBy(F.expr("id % 7")).count(), "written")
    before, folders = files(), set(Path(workspace.shared_folder(spark)).iterdir())
    assert workspace.materialize(spark.range(1000).repartition(3, "id").groupBy(F.expr("id % 9 as k")).count(), "counts").collect()
    wait_until = time.time() + 20
    while files() - before and time.time() < wait_until:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(workspace.SHUFFLE_CLEANUP) == "false"
    long = "this line is long enough to be compared with others"
    line_dedup.line_dedup(documents([(i, long + "!" * (i % 3)) for i in range(50)])).collect()
    left = {table.name for d in set(Path(workspace.shared_folder(spark)).iterdir()) - folders for table in d.iterdir()}
    assert {"lines", "first", "removed"} <= left and not left & {"keyed", "met", "found", "under", "texts", "links", "marks"}
    workspace.discard(written)
    assert not [d for d in folders for table in d.iterdir() if table.name == "written"]


def test_probes_that_pass_by_chance_are_found_out(spark):
    """Of rows that a crowded bitmap lets pass, a bitmap of other bits keeps those whose key is there, and few others."""
    there = spark.range(1500).select(F.xxhash64("id").alias("key"))
    rows = spark.range(6000).select(F.xxhash64("id").alias("key"), F.col("id").alias("line"), F.lit(1).alias("length"))
    passed = line_dedup._with_bit(rows, line_dedup._marks(there, 15)[0])
    other = line_dedup._with_bit(passed, line_dedup._marks(there, 15, other=True)[0], other=True)
    lines = {r.line for r in other.collect()}
    assert set(range(1500)) <= lines and len(lines) < passed.count()


@pytest.mark.parametrize("part", [3, 1 << 14])
def test_pairs_of_families_over_batches(spark, monkeypatch, part):
    monkeypatch.setattr(line_dedup, "PAIRS", part)
    rng = random.Random(31)
    base = ["".join(rng.choice("abcdefé ") for _ in range(90)) for _ in range(4)]
    texts = [edited(rng, rng.choice(base), rng.choice([0, 1, 3, 5])) for _ in range(36)]
    table = spark.createDataFrame(list(enumerate(texts)), "line long, text string")
    pairs = [(a, b) for a, b in itertools.combinations(range(36), 2) if rng.random() < 0.7]
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        links = line_dedup._pair_links(spark.createDataFrame(pairs * 2, "a long, b long"), table, 2, 25).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    near = lambda x, y: edit_distance(x, y) <= max(2, min(len(x), len(y)) // 25)
    assert sorted(map(tuple, links)) == [(a, b) for a, b in pairs if near(texts[a], texts[b])]


def test_driver_holds_one_bitmap_at_a_time(spark, documents):
    """Bitmaps of the keys, 32 MB each, follow one another on the driver: at most one and the copy that is sent."""
    long = "this line is long enough to be compared with others"
    docs = documents([(i, f"{long} {i % 7}") for i in range(40)])
    tracemalloc.start()
    try:
        rows = line_dedup.line_dedup(docs).collect()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(len(r.removed_lines) for r in rows) == 39
    assert peak < 2.5 * (1 << line_dedup.KEY_BITS) / 8


def test_bits_of_written_blocks(spark):
    keys = spark.range(2000).select(F.xxhash64(F.col("id") % 1500).alias("key"))
    once, twice = line_dedup._marks(keys, 18)
    blocks = line_dedup._mark_blocks(keys, 18)
    assert (line_dedup._bits(blocks, "once", 18) == once).all()
    both = line_dedup._bits(blocks, "twice", 18, once.copy())
    assert (both == once | twice).all() and twice.any() and (once != twice).any()


@pytest.mark.parametrize("every", [0, 25])
def test_pairs_apart_by_their_letters_move_no_texts(spark, every):
    """The letters keep every pair within the bound, and few pairs of lines that only share a passage."""
    rng = random.Random(17)
    text = lambda n: "".join(rng.choice("abcdefghijklmno é") for _ in range(n))
    base = [text(rng.choice([24, 80, 300, 700])) for _ in range(12)]
    texts = [edited(rng, rng.choice(base), rng.choice([0, 1, 2, 3, 8, 12])) for _ in range(40)] + ["", "a" * 700, "a" * 701, "é" * 300, "中" * 300]
    passage = text(24)
    texts += [text(150) + passage + text(150) for _ in range(20)]
    letters = line_dedup._letters(spark.createDataFrame(list(enumerate(texts)), "line long, text string")).collect()
    assert [(r.line, r.length) for r in sorted(letters)] == [(i, len(x)) for i, x in enumerate(texts)]
    by = {r.line: r for r in letters}
    pairs = [(a, b, by[a].length, by[b].length, by[a].counts, by[b].counts) for a, b in itertools.combinations(range(len(texts)), 2)]
    table = spark.createDataFrame(pairs, "a long, b long, m int, n int, x binary, y binary").repartition(3)
    kept = {tuple(r) for r in line_dedup.map_arrow(table, line_dedup._alike(2, every), "a long, b long").collect()}
    near = line_dedup.near_pairs([texts[p[0]] for p in pairs], [texts[p[1]] for p in pairs], 2, every)
    assert {p[:2] for p, close in zip(pairs, near) if close} <= kept
    assert not {(a, b) for a, b in kept if a >= 45}


def test_keys_of_one_label_are_compared_once(spark):
    """Keys whose pivots differ, but whose lines are of one family, become one group by a label."""
    rng = random.Random(5)
    many = [(k, line, line >= 40) for k in range(12) for line in rng.sample(range(60), 50)]
    many = spark.createDataFrame(many, "key long, line long, other boolean").withColumns({"known": F.expr("if(other, line, 0)"), "main": F.expr("not other")})
    labels = many.select("key", F.lit(0).alias("label")).distinct()
    right, left = line_dedup._grouped(many, many.filter("other"), ("known", "main"), labels)
    assert {r.key for r in right.collect()} == {0} == {r.key for r in left.collect()}
    assert sorted(r.line for r in left.collect()) == sorted({r.line for r in many.filter("other").collect()})
    assert right.count() == many.select("line").distinct().count()


@pytest.mark.parametrize("block", [5, 512])
def test_lines_outside_the_main_component(spark, monkeypatch, block):
    """Chains among the lines that no pivot reaches are found, whichever of two lines is indexed, and pairs of them are compared once."""
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    monkeypatch.setattr(line_dedup, "PIVOTS", 2)
    rng = random.Random(23)
    base = "".join(rng.choice("abcdefé ") for _ in range(60))
    texts = [edited(rng, base, rng.choice([0, 1, 3, 5, 6, 7])) for _ in range(40)]
    many = [(key, line, len(texts[line]), rng.random() < 0.6) for key in range(3) for line in rng.sample(range(40), 34)]
    tables = spark.createDataFrame(many, "key long, line long, length int, indexed boolean"), spark.createDataFrame(list(enumerate(texts)), "line long, text string")
    near = lambda a, b: edit_distance(texts[a], texts[b]) <= 2
    meet = {(x[1], y[1]) for x in many for y in many if x[0] == y[0] and x[1] < y[1] and (x[3] or y[3])}
    known = [(a, b) for a, b in meet if near(a, b) and a < 6]
    links = spark.createDataFrame(known, "a long, b long")
    ties = line_dedup._rest_links(tables[0], links, tables[1], 2, 0).collect()
    found = components(40, known + [tuple(sorted(r)) for r in ties])
    least, most = ([(a, b) for a, b in pairs if near(a, b)] for pairs in (meet, itertools.combinations(range(40), 2)))
    least, most = components(40, known + least), components(40, most)
    for a, b in itertools.combinations(range(40), 2):  # all that keys ask for, and nothing that no chain connects
        assert (least[a] != least[b] or found[a] == found[b]) and (found[a] != found[b] or most[a] == most[b])

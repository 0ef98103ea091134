"""Spelling variants and the prefix trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tillroll.llm import prefix_trie, queries, spelling

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(rows):
    counts = Counter()
    for doc, text in rows:
        for run in RUNS.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 5 and k >= 3}
    around = {w: [] for w in n}
    by_length = defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    for w in n:
        around[w] = [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if near(w, v)]
    best = {w: min(around[w], key=lambda v: (-n[v], v), default=None) for w in n}
    form = {w: b if b and n[b] >= 2 * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n[w], len(around[w]), n[form[w]] if form[w] else None) for w in n), key=str)


def misspelt(seed=3, documents=60):
    """Few stems with many variants, in Latin-1 letters and others, with crowded blocks and chains of forms."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeé×") for _ in range(rng.randint(5, 9))) for _ in range(12)] + ["aaaaa", "aaaaaa", "aaaaaaa", "x" * 300]
    rows = []
    for doc in range(documents):
        words = []
        for _ in range(120):
            w = rng.choice(stems[: rng.randint(1, len(stems))])
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcdeé") + w[i + 1 :], w[:i] + rng.choice("abcde") + w[i:]])
            words.append(rng.choice([w, w.upper(), w.title()]))
        rows.append((doc, rng.choice([" ", "\n", "1", "ł", "\U0001f600"]).join(words)))
    return rows


@pytest.mark.parametrize(("homes", "guests", "block"), [(1024, 4096, 128), (7, 11, 1)])
def test_variants_are_brute_force(documents, monkeypatch, homes, guests, block):
    for name, value in (("HOMES", homes), ("GUESTS", guests), ("BLOCK", block), ("HELD", 50 * homes)):
        monkeypatch.setattr(spelling, name, value)
    rows = [*misspelt(), (None, "null id null id null id null idx idx"), (7, None), (8, ""), (9, "123 ÷÷÷÷÷ " * 3), (10, "longer" * 20_000 + " "), (10, "longer" * 20_000)]
    assert sorted(map(tuple, spelling.spelling_variants(documents(rows)).collect()), key=str) == variants(rows)


def test_variants_of_nothing(documents):
    assert spelling.spelling_variants(documents([(1, "a b c")]).limit(0)).collect() == []
    assert spelling.spelling_variants(documents([(1, "few words"), (2, None)])).collect() == []


def test_variants_of_given_documents(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op12_spelling_variants(spark, folder).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, got), key=str) == variants(rows)


def trie(rows, span=5, heads=9):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in turns.items()}
    members = defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % heads
        own = turns[c] if c % span == 0 else turns.get(c - c % span, [])[:h] + turns[c][h:]
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append((c, d == len(own)))
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    total, out = {}, []
    for p in sorted(members, key=len, reverse=True):
        n = len(members[p])
        leaves = sum(total[k][0] for k in children[p]) or 1
        saved = sum(total[k][1] for k in children[p]) + ((n - 1) * len(p[-1][1].encode()) if p else 0)
        total[p] = leaves, saved
        ends = hashlib.sha256(",".join(str(c) for c, e in members[p] if e).encode()).hexdigest()
        out.append((members[p][0][0], len(p), members[p[:-1]][0][0] if p else None, n, len(children[p]), leaves, saved, ends))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string, depth int, conv string, place string, kids string"


@pytest.mark.parametrize(("places", "ids"), [(4096, 12), (8, 1)])
def test_trie_is_brute_force(spark, monkeypatch, places, ids):
    monkeypatch.setattr(prefix_trie, "PLACES", places)
    monkeypatch.setattr(prefix_trie, "IDS", ids)
    rows = [(1, i, "u", f"t{i}") for i in range(60)]  # a long chain
    rows += [(i, j, "u", f"t{j}" if j < i * 3 else f"z{i} {j}") for i in range(2, 24) for j in range(i * 3 + 3)]
    rows += [(c, j, "s", "équal") for c in range(100, 140) for j in range(2)]  # a third of all conversations is one
    rows += [(None, 1, "a", "b"), (40, None, None, None), (40, 0, "", ""), (-3, 1, "x", "y"), (-3, 1, "x", "y"), (-3, 1, "x", "a"), (42, 0, "u", "q"), (43, 0, None, "w" * 200_000)]
    df = spark.createDataFrame([(*r, 0, "c", "p", "k") for r in rows], SCHEMA)
    assert sorted(map(tuple, prefix_trie.prefix_trie(df).collect()), key=str) == trie(rows)


def test_trie_without_rebuilding(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "v", "b"), (2, 0, "u", "a"), (3, 0, "u", "a"), (3, 1, "v", "b"), (3, 2, "u", "c")]
    df = spark.createDataFrame([(*r, 0, "c", "p", "k") for r in rows], SCHEMA)
    assert sorted(map(tuple, prefix_trie.prefix_trie(df, span=1).collect()), key=str) == trie(rows, span=1)
    assert prefix_trie.prefix_trie(df.limit(0)).collect() == []
    assert prefix_trie.prefix_trie(df.filter("conv_id is null")).collect() == []


def test_trie_of_given_conversations(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, queries.op13_prefix_trie(spark, folder).collect()), key=str) == trie(rows)

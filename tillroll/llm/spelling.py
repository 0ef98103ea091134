"""Spelling variants: words one edit apart, found by Gram matrices of blocks of letter counts.

One edit changes a word's letter counts by at most two: the squared distance of two count vectors is 2 for a replaced code
point and 1 for an inserted one. Words lie in blocks by length and by the counts of a few groups of letters, so that a
word's near words lie in its own block, in those of its length that trade one letter of a group for one of another, and in
those of the length below that lack one letter of a group. Each word is at home in one block and a guest in the others.
A task holds one part of a block's homes and one part of its guests, multiplies their letter counts, keeps the pairs whose
squared distance is at most two, and verifies the edit. It gives back sums per word, not pairs.

Block keys are sums of one 64-bit number a group, so a guest's key is a home key plus or minus such numbers. The number of
groups follows the number of words; it decides the size of the blocks and nothing else.
"""

import zlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.hashing import mix
from tillroll.llm.workspace import map_arrow, materialize, name_package

#: Distinct runs whose counts a task holds before it gives them to the shuffle.
HELD = 200_000
#: Homes and guests of one task, and the homes wanted in a block.
HOMES, GUESTS, BLOCK = 1024, 4096, 128
#: Groups of letters, at least and at most.
FEWEST, MOST = 2, 16
#: Letters from common to rare, which are dealt to the groups in turn. Others are dealt by their codes.
COMMON = b"etaoinshrdlucmfwygpbvkjxqz"

_LETTERS = np.zeros(256, np.uint8)
_LETTERS[:] = 32
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[0xC0:0x100] = np.arange(0xC0, 0x100)
_LETTERS = _LETTERS.tobytes()


def _runs(text: str) -> list[bytes]:
    """Maximal runs of letters in Latin-1, with A-Z as a-z. What Latin-1 lacks is not a letter here."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def _damaged(run: bytes, h: int) -> bytes:
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(total: dict[bytes, int], name: bytes, text: str, modulus: int) -> None:
    """Adds a document's runs to `total`; where the modulus divides the checksum of id and run, the run loses a code point."""
    counts: dict[bytes, int] = {}
    for run in _runs(text):
        counts[run] = counts.get(run, 0) + 1
    start, crc = zlib.crc32(name + b":"), zlib.crc32
    ascii_only = text.isascii()
    for run, n in counts.items():
        h = crc(run if ascii_only or run.isascii() else run.decode("latin-1").encode(), start)
        if h % modulus == 0:
            run = _damaged(run, h)
        total[run] = total.get(run, 0) + n


def word_counts(
    docs: DataFrame, *, modulus: int = 97, least_chars: int = 5, least_count: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(word, n) for the distinct runs of at least `least_chars` code points that occur `least_count` times or more. Runs are
    counted in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def flush():
            words = [w for w in total if len(w) >= least_chars]
            out = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in words], pa.string()), pa.array([total[w] for w in words], pa.int64())],
                names=["word", "n"],
            )
            total.clear()
            return out

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                _count(total, (name.as_py() or "").encode(), text.as_py() or "", modulus)
                if len(total) > HELD:
                    yield flush()
        if total:
            yield flush()

    columns = docs.select(F.col(id_col).cast("string").alias("name"), F.col(text_col).alias("text"))
    counts = map_arrow(columns, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least_count)


def groups_for(words: int) -> int:
    """Groups of letters that cut the words of one common length into blocks of about BLOCK."""
    g = FEWEST
    while g < MOST and words > BLOCK * 8 * comb(7 + g, g - 1):
        g += 1
    return g


def _codes(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Latin-1 codes of all words on end, the word of each code, and the words' lengths."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    texts = "".join(words.to_pylist()).encode("latin-1")
    return np.frombuffer(texts, np.uint8), np.repeat(np.arange(len(lengths)), lengths), lengths


def _visits(groups: int):
    """Rows (key, home, word, n): each word in its own block and in the blocks that it visits."""
    marks = mix(np.arange(1, groups + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    group_of = np.arange(256) % groups
    group_of[np.frombuffer(COMMON, np.uint8)] = np.arange(len(COMMON)) % groups
    trades = [(i, j) for i in range(groups) for j in range(i + 1, groups)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                rows = batch.slice(at, 20_000)
                codes, word, lengths = _codes(rows.column(0))
                n = len(lengths)
                counts = np.bincount(word * groups + group_of[codes], minlength=n * groups).reshape(n, groups)
                key = (counts.astype(np.uint64) * marks).sum(axis=1, dtype=np.uint64)
                parts = [(np.arange(n), key, True)]
                for i in range(groups):
                    has = np.flatnonzero(counts[:, i])
                    parts.append((has, key[has] - marks[i], False))
                for i, j in trades:
                    has = np.flatnonzero(counts[:, j])
                    parts.append((has, key[has] - marks[j] + marks[i], False))
                for index, keys, home in parts:
                    taken = rows.take(pa.array(index))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(np.full(len(index), home)), *taken.columns],
                        names=["key", "home", "word", "n"],
                    )

    return run


def _letter_counts(codes: np.ndarray, word: np.ndarray, n: int, index: np.ndarray, letters: int) -> np.ndarray:
    flat = np.bincount(word * letters + index[codes], minlength=n * letters)
    return flat.reshape(n, letters).astype(np.float32)


def _one_edit(padded: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a and b of the padded table are one replaced or inserted code point apart; a is never the shorter."""
    x, y = padded[a], padded[b]
    same = lengths[a] == lengths[b]
    differ = x != y
    replaced = same & (differ.sum(axis=1) == 1)
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])
    # behind the first difference the longer word goes on one place later
    shifted = np.concatenate([x[:, 1:], np.zeros((len(x), 1), x.dtype)], axis=1)
    beyond = np.arange(x.shape[1]) >= first[:, None]
    inserted = (lengths[a] == lengths[b] + 1) & ~((shifted != y) & beyond).any(axis=1)
    return replaced | inserted


def _near_pairs(words: pa.Array, homes: int, own: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (home, guest) of near words; the first `homes` words are the homes. A guest that is at home in the block itself
    (`own`) meets only the homes before it by `order`, a hash of the word, so that a pair is met once."""
    h = homes
    codes, word, lengths = _codes(words)
    present = np.unique(codes)
    index = np.zeros(256, np.int64)
    index[present] = np.arange(len(present))
    counts = _letter_counts(codes, word, len(words), index, len(present))
    norms = np.einsum("ij,ij->i", counts, counts)
    products = counts[:h] @ counts[h:].T
    products -= norms[None, h:] / 2
    # at most two: the squared distance is the home's norm less twice this
    i, j = np.nonzero(products >= norms[:h, None] / 2 - 1.25)
    met = ~own[h + j] | (order[i] < order[h + j])
    i, j = i[met], h + j[met]
    if not len(i):
        return i, j
    used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    start = np.cumsum(lengths) - lengths
    padded = np.zeros((len(used), int(lengths[used].max()) + 1), np.uint8)
    row = np.repeat(np.arange(len(used)), lengths[used])
    column = np.arange(len(row)) - np.repeat(np.cumsum(lengths[used]) - lengths[used], lengths[used])
    padded[row, column] = codes[np.repeat(start[used], lengths[used]) + column]
    longer = lengths[i] < lengths[j]
    a, b = np.where(longer, at[len(i) :], at[: len(i)]), np.where(longer, at[: len(i)], at[len(i) :])
    near = np.zeros(len(i), bool)
    step = max(1, 4_000_000 // padded.shape[1])
    for k in range(0, len(i), step):
        near[k : k + step] = _one_edit(padded, lengths[used], a[k : k + step], b[k : k + step])
    return i[near], j[near]


def _sums(words: pa.Array, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """Per word of `a`: how many words of `b` are near, and the largest of them (the least in code-point order of equals)."""
    names, at = np.unique(b, return_inverse=True)
    place = np.argsort(np.argsort(np.array(words.take(pa.array(names)).to_pylist(), dtype=object), kind="stable"))
    order = np.lexsort((place[at], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    per = np.diff(np.concatenate([first, [len(a)]]))
    columns = [words.take(pa.array(a[first])), pa.array(per), pa.array(n[b[first]]), words.take(pa.array(b[first]))]
    return pa.table(columns, names=["word", "n_near", "best_n", "best"])


def _block(table: pa.Table) -> pa.Table:
    home = table.column("home").to_numpy()
    table = table.take(pa.array(np.argsort(~home, kind="stable")))
    words = pa.concat_arrays([c.cast(pa.string()) for c in table.column("word").chunks])
    own, n, order = (table.column(x).to_numpy() for x in ("own", "n", "h"))
    none = np.zeros(0, np.int64)
    i, j = _near_pairs(words, int(home.sum()), own, order) if home.any() and not home.all() else (none, none)
    if not len(i):
        return pa.table([pa.array([], pa.string()), none, none, pa.array([], pa.string())], names=["word", "n_near", "best_n", "best"])
    return pa.concat_tables([_sums(words, n, i, j), _sums(words, n, j, i)])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) for each word of `words` (word, n) that has a near word."""
    spark = words.sparkSession
    groups = groups_for(words.count())
    visits = materialize(map_arrow(words, _visits(groups), "key long, home boolean, word string, n long"), "visits")
    # a block's homes are its guests too, which compares them with each other
    sizes = visits.groupBy("key").agg(F.count_if("home").alias("homes"), F.count("*").alias("guests")).filter("homes > 0 and guests > 1")
    sizes = sizes.select("key", F.ceil(F.col("homes") / HOMES).cast("int").alias("home_parts"), F.ceil(F.col("guests") / GUESTS).cast("int").alias("guest_parts"))
    rows = visits.join(sizes, "key").withColumn("h", F.xxhash64("word"))
    parts = lambda n: F.pmod("h", n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    hosts = rows.filter("home").select("key", parts("home_parts").alias("i"), every("guest_parts").alias("j"), "home", F.col("home").alias("own"), "word", "n", "h")
    guests = rows.select("key", every("home_parts").alias("i"), parts("guest_parts").alias("j"), F.lit(False).alias("home"), F.col("home").alias("own"), "word", "n", "h")
    name_package(spark)
    met = hosts.unionAll(guests).groupBy("key", "i", "j").applyInArrow(_block, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b")
    sums = met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return sums.select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form: forms are followed to the last, twice as far in each round. A form occurs at least
    twice as often as its word, so chains are short and end."""
    steps = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = steps.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = materialize(moved, "roots")
        if moved.filter("moved").isEmpty():
            return steps
        steps = moved.drop("moved")


def spelling_variants(
    docs: DataFrame, *, modulus: int = 97, least_chars: int = 5, least_count: int = 3, times: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per word: (word, form, root, n, n_near, form_n).

    Words are the letter runs of all texts (A-Z as a-z), of which those whose checksum with the document's id the modulus
    divides have lost one code point, with at least `least_chars` code points and `least_count` occurrences. Near words differ by
    one inserted, deleted or replaced code point. `form` is the near word that occurs most (the least in code-point order of
    equals) if it does so `times` times as often as the word, else null; `root` is the last of the words that forms lead to.

    A null text has no runs; a null id counts as an empty one in the checksum. Repeated rows count each time, an empty table gives no words, other
    columns are not read. Runs and words may be of any length.
    """
    words = materialize(word_counts(docs, modulus=modulus, least_chars=least_chars, least_count=least_count, id_col=id_col, text_col=text_col), "words")
    near = near_words(words)
    leads = (F.col("best_n") >= times * F.col("n"))
    known = words.join(near, "word", "left").select(
        "word", F.when(leads, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(leads, F.col("best_n")).alias("form_n")
    )
    known = materialize(known, "forms")
    roots = _roots(known.filter("form is not null"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

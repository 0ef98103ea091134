"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with marks at both ends) and of itself; each has a vector in a hashed
table, a span of words is the mean of its words' means, and a linear layer with a softmax over two classes scores the
span. A document scores as its most toxic span. Misspelt words share most n-grams with words seen in training.

The model is fitted on a bounded sample of labelled documents, the first `per_class` of each class by a hash of the
id. Scoring needs, for each n-gram, only its vector times the difference of the two class weights: one number.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.hashing import RUN_BYTES, mix
from tillroll.llm.workspace import map_arrow

#: Hashed n-gram vectors, their size, the n-gram lengths, words per span.
BUCKET_BITS, DIM, GRAMS, SPAN = 18, 8, (2, 3, 4, 5), 1
#: Labelled documents of each class that the model is fitted on, and its passes over them.
PER_CLASS, MEAN_PASSES, BEST_PASSES = 2000, 12, 50
#: Words whose n-grams are summed at a time in the fit.
PART = 16_384
#: Rows scored at a time, and distinct words whose scores a worker keeps.
ROWS = 1024
KNOWN = 150_000

_EDGES = " \t\n\r.,;:!?\"'()[]{}<>|*#$%&/\\-_=+~^`…–—„“”«»¿¡"
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def text_words(text: str) -> list[str]:
    """Lower-case words of a text without punctuation at their edges."""
    return [w.strip(_EDGES) for w in text.lower().split()]


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every n-gram, word starts): each word's n-grams and itself, at least one bucket per word."""
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = codes.astype(np.uint64) + np.uint64(1)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(ends, lengths) - np.arange(len(codes))  # characters from here to the end of the word
    hashes, owners = [], []
    rolled = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        # the hash of the n characters from each place
        ahead = np.zeros(len(codes), dtype=np.uint64)
        ahead[: len(codes) - n + 1] = codes[n - 1 :]
        rolled = (rolled + ahead) * _BASE
        rolled ^= rolled >> np.uint64(31)
        if n in GRAMS:
            whole = left >= n
            hashes.append(rolled[whole] + np.uint64(n))
            owners.append(owner[whole])
    # the word itself: a sum over its characters and places
    place = np.arange(len(codes), dtype=np.uint64) - np.repeat(ends - lengths, lengths).astype(np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(codes * _BASE + place))])
    hashes.append(sums[ends] - sums[ends - lengths])
    owners.append(np.arange(len(words)))
    hashes, owners = np.concatenate(hashes), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    buckets = (mix(hashes[order]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    return buckets, np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(words)))[:-1]])


def word_scores(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Mean n-gram weight of each word."""
    if not words:
        return np.zeros(0)
    buckets, starts = word_grams(words)
    counts = np.diff(np.append(starts, len(buckets)))
    return np.add.reduceat(weights[buckets], starts) / counts


def _spans(scores: np.ndarray) -> np.ndarray:
    if SPAN == 1 or len(scores) < 2:
        return scores
    n = min(SPAN, len(scores))
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    return (sums[n:] - sums[:-n]) / n


def train(texts: list[str], labels: np.ndarray, seed: int = 5) -> np.ndarray:
    """Weight of each n-gram bucket: vectors and softmax weights learned together, collapsed for scoring.

    First a document is the mean of its words, then its most toxic word; both with a logistic loss in which the two
    classes weigh the same, and Adagrad steps.
    """
    ids: dict[str, int] = {}
    per = [np.unique([ids.setdefault(w, len(ids)) for w in text_words(t)] or [ids.setdefault("", len(ids))]) for t in texts]
    del texts
    flat = np.concatenate(per).astype(np.int32)
    size = np.array([len(p) for p in per])
    begin = np.concatenate([[0], np.cumsum(size)])[:-1]
    rows = np.repeat(np.arange(len(per), dtype=np.int32), size)
    # n-grams and all sums over them in parts of words, which bounds the memory next to the buckets themselves
    words, parts = list(ids), []
    for at in range(0, len(words), PART):
        parts.append((at, *word_grams(words[at : at + PART])))
    grams = np.concatenate([np.diff(np.append(starts, len(buckets))) for _, buckets, starts in parts])
    n_words = len(words)
    del per, ids, words
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.05, (1 << BUCKET_BITS, DIM))
    layer = np.stack([-np.ones(DIM), np.ones(DIM)]) / np.sqrt(DIM)  # softmax weights of the two classes
    bias = 0.0
    seen, seen_layer = np.full(1 << BUCKET_BITS, 1e-8), np.full(DIM, 1e-8)
    share = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum()) * len(labels)
    for k in range(MEAN_PASSES + BEST_PASSES):
        toward = layer[1] - layer[0]
        weights = vectors @ toward
        scores = np.concatenate([np.add.reduceat(weights[buckets], starts) for _, buckets, starts in parts]) / grams
        if k < MEAN_PASSES:
            document = np.add.reduceat(scores[flat], begin) / size
        else:
            document = np.maximum.reduceat(scores[flat], begin)
        chance = 1 / (1 + np.exp(-np.clip(document + bias, -30, 30)))
        error = (chance - labels) * share
        if k < MEAN_PASSES:
            per_word = np.bincount(flat, weights=(error / size)[rows], minlength=n_words)
        else:
            best = np.flatnonzero(scores[flat] == document[rows])
            best = best[np.unique(rows[best], return_index=True)[1]]
            per_word = np.bincount(flat[best], weights=error, minlength=n_words)
        per_word /= grams
        slope = np.zeros(1 << BUCKET_BITS)
        for at, buckets, starts in parts:
            own = slice(at, at + len(starts))
            if k >= MEAN_PASSES:  # few words are a document's most toxic one
                moving = np.flatnonzero(per_word[own])
                for w in moving:
                    to = starts[w + 1] if w + 1 < len(starts) else len(buckets)
                    np.add.at(slope, buckets[starts[w] : to], per_word[at + w])
            else:
                slope += np.bincount(buckets, weights=np.repeat(per_word[own], grams[own]), minlength=len(slope))
        moved = np.flatnonzero(slope)
        seen[moved] += slope[moved] ** 2
        step = 0.5 * slope[moved] / np.sqrt(seen[moved])
        layer_slope = slope[moved] @ vectors[moved]
        seen_layer += layer_slope**2
        vectors[moved] -= step[:, None] * toward
        change = 0.05 * layer_slope / np.sqrt(seen_layer)
        layer += np.stack([change, -change])
        bias -= 0.5 * error.mean()
    return vectors @ (layer[1] - layer[0])


def calibrate(margins: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """(slope, bias) of a logistic curve through margins of documents that were not trained on. A class weighs as the
    root of its count, between its share and an equal part."""
    centre, spread = margins.mean(), margins.std() or 1.0
    x = np.stack([(margins - centre) / spread, np.ones(len(margins))], axis=1)
    share = np.where(labels == 1, 1 / np.sqrt(max(1, labels.sum())), 1 / np.sqrt(max(1, (1 - labels).sum())))
    share *= len(labels) / share.sum()
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ ((chance - labels) * share) + ridge * theta * [1, 0]
        curve = (x * (chance * (1 - chance) * share)[:, None]).T @ x + np.diag([ridge, 1e-9])
        theta = theta - np.linalg.solve(curve, slope)
    theta[0] = max(theta[0], 1e-3)
    return float(theta[0] / spread), float(theta[1] - theta[0] * centre / spread)


def fit(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """(weight of each n-gram bucket, bias) of the log odds: three quarters of the documents train the vectors, the
    rest place the curve. With one class only, or no documents, the score is constant."""
    labels = np.asarray(labels, dtype=float)
    if not len(labels) or labels.min() == labels.max():
        return np.zeros(1 << BUCKET_BITS), (-5.0 if not len(labels) or labels.max() == 0 else 5.0)
    aside = np.zeros(len(labels), dtype=bool)
    for c in (0, 1):  # every fourth of each class
        aside[np.flatnonzero(labels == c)[3::4]] = True
    if not 0 < labels[aside].sum() < aside.sum():
        aside[:] = False
    weights = train([t for t, a in zip(texts, aside) if not a], labels[~aside])
    scorer, margins = _Scorer(weights, 0.0), []
    for text in (t for t, a in zip(texts, aside) if a or not aside.any()):
        words = text_words(text) or [""]
        scorer.learn(set(words))
        margins.append(_spans(np.fromiter(map(scorer.__getitem__, words), float, len(words))).max())
    slope, bias = calibrate(np.array(margins), labels[aside] if aside.any() else labels)
    return weights * slope, bias


class _Scorer(dict):
    """Scores of words seen so far."""

    def __init__(self, weights: np.ndarray, bias: float):
        super().__init__()
        self.weights, self.bias = weights, bias

    def learn(self, words: set[str]) -> None:
        if len(self) > KNOWN:
            self.clear()
        new = [w for w in words if w not in self]
        self.update(zip(new, word_scores(new, self.weights).tolist()))


def known_labels(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str) -> DataFrame:
    """(id, label) of the labelled ids that `docs` has; of an id's labels the largest."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    return known.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")


def sample(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int, id_col: str, text_col: str) -> tuple[list, np.ndarray]:
    """Texts and labels of at most `per_class` labelled documents of each class, by a hash of the id."""
    known = known_labels(docs, labels, label_col, id_col)
    order = F.xxhash64(F.col("id"))
    picked = [known.filter(F.col("label") == c).orderBy(order, "id").limit(per_class) for c in (0, 1)]
    chosen = F.broadcast(picked[0].unionAll(picked[1]))  # at most 2 * per_class ids
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id")
    first = Window.partitionBy("id").orderBy("text")
    rows = rows.withColumn("k", F.row_number().over(first)).filter("k = 1").drop("k")
    rows = rows.orderBy("id").collect()
    return [r["text"] or "" for r in rows], np.array([r["label"] for r in rows], dtype=float)


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", per_class: int = PER_CLASS, threshold: float = 0.5,
    id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of `docs`: (id_col, score, predicted): the chance of label 1 and whether it reaches `threshold`;
    before the score the columns named in `carry`, by which rows without an id or with a shared one can be told apart.

    `labels` has (id_col, label_col) of the rows that may be learned from; rows with a null in either are left out, as
    are ids that `docs` lacks, before the sample is drawn. Of an id's several texts the first is used, of its labels the largest. Null and empty texts score like
    a word without letters. Whole texts are scored, whatever their length. Repeated rows get the same score, an empty
    table gives no rows. Without labels of both classes the score is constant. Other columns are not read.
    """
    weights, bias = fit(*sample(docs, labels, label_col, per_class, id_col, text_col))
    model = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float32), bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        scorer = _Scorer(weights, bias)
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            out, waiting, held = [], [], 0

            def flush():
                scorer.learn(set().union(*waiting))
                out.extend(_spans(np.fromiter(map(scorer.__getitem__, w), float, len(w))).max() for w in waiting)
                waiting.clear()

            for text in batch.column(1):
                text = text.as_py() or ""
                words = text_words(text) or [""]
                waiting.append(words if SPAN > 1 else set(words))
                held += len(text)
                if held > RUN_BYTES:
                    flush()
                    held = 0
            if waiting:
                flush()
            scores = 1 / (1 + np.exp(-np.clip(np.array(out, dtype=float) + bias, -30, 30)))
            carried = [batch.column(k) for k in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), *carried], names=["id", "score", *extra])

    extra = [f"carry{k}" for k in range(len(carry))]
    columns = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(f"`{c}`").alias(n) for c, n in zip(carry, extra)])
    kinds = {n: columns.schema[n].dataType.simpleString() for n in ("id", *extra)}
    scored = map_arrow(columns, run, ", ".join([f"id {kinds['id']}, score double", *[f"{n} {kinds[n]}" for n in extra]]))
    return scored.select(
        F.col("id").alias(id_col), *[F.col(n).alias(c) for c, n in zip(carry, extra)], "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )

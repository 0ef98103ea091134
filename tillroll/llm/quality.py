"""Quality: Bradley-Terry ranking of documents from preference pairs.

A document's score is a weighted sum of text features. A pair of a good and a bad document is a preference; the
weights are learned by logistic loss on the differences of the two feature vectors, which is the Bradley-Terry model.
Documents are then told apart at a quantile of the scores of all labelled documents: the share of bad ones among them. A logistic curve
that passes `threshold` at this quantile makes chances of the scores.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.hashing import shingle_sets, text_runs, word_hashes
from tillroll.llm.toxicity import known_labels, sample
from tillroll.llm.workspace import map_arrow, materialize

#: Labelled documents of each class that the model is fitted on, and pairs drawn from them.
PER_CLASS, PAIRS = 2000, 50_000
#: The quantile's rank is off by no more than one part in this of the labelled documents.
ACCURACY = 100_000

_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _HIGH, _BAR, _BANG, _STOP, _MARKUP, _ODD, _OTHER = range(12)
_KINDS = 12


def _kinds() -> np.ndarray:
    """Class of each byte."""
    kind = np.full(256, _OTHER, dtype=np.uint8)
    for k, chars in (
        (_LOWER, "abcdefghijklmnopqrstuvwxyz"), (_UPPER, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (_DIGIT, "0123456789"),
        (_SPACE, " \t\r\v\f"), (_LINE, "\n"), (_BAR, "|"), (_BANG, "!"), (_STOP, ".,;:?"), (_MARKUP, "<>{}[]()=/\\_"),
        (_ODD, "#$%&*@^~+"),
    ):
        kind[list(chars.encode())] = k
    kind[128:] = _HIGH
    return kind


_KIND = _kinds()


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features per text, each of them bounded or a logarithm."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    kind = _KIND[data]
    rows = np.repeat(np.arange(n), size)
    counts = np.bincount(rows * _KINDS + kind, minlength=n * _KINDS).reshape(n, _KINDS).astype(float)
    some = np.maximum(size, 1)[:, None]
    share = counts / some
    letters = np.maximum(1, counts[:, [_LOWER, _UPPER, _HIGH]].sum(axis=1))
    words, of = word_hashes(data, offsets)
    n_words = np.bincount(of, minlength=n).astype(float)
    w = np.maximum(n_words, 1)
    one, begin = shingle_sets(data, offsets, 1)
    three, begin3 = shingle_sets(data, offsets, 3)
    after = (words[1:] == words[:-1]) & (of[1:] == of[:-1]) if len(words) else np.zeros(0, bool)
    repeated = np.bincount(of[1:][after], minlength=n) if len(words) else np.zeros(n)
    # lines: hashes of the line's bytes would do; length and first words tell repeated lines well enough here
    line_rows, line_sizes, line_hash = _lines(data, offsets)
    n_lines = np.maximum(1, np.bincount(line_rows, minlength=n)).astype(float)
    distinct = np.unique(np.stack([line_rows.astype(np.uint64), line_hash]), axis=1) if len(line_rows) else np.zeros((2, 0))
    n_distinct = np.bincount(distinct[0].astype(np.int64), minlength=n)
    shorts = np.bincount(line_rows[line_sizes < 30], minlength=n)
    odd = share[:, _ODD] + share[:, _BANG] + share[:, _BAR] + share[:, _MARKUP]
    columns = [
        share[:, _LOWER], counts[:, _UPPER] / letters, share[:, _DIGIT], share[:, _SPACE], share[:, _LINE], share[:, _HIGH],
        share[:, _BAR], share[:, _BANG], share[:, _STOP], share[:, _MARKUP], share[:, _ODD], share[:, _OTHER],
        np.log1p(n_words) / 10, np.log1p(size) / 12, np.minimum(size / w, 40) / 40,
        np.diff(begin) / w, np.minimum(1, np.diff(begin3) / np.maximum(1, n_words - 2)), repeated / w,
        n_distinct / n_lines, shorts / n_lines, np.log1p(size / n_lines) / 12,
        np.tanh(20 * odd), np.tanh(4 * counts[:, _UPPER] / letters), np.tanh(20 * share[:, _BAR]), np.tanh(20 * share[:, _BANG]),
        np.tanh(10 * share[:, _DIGIT]), np.tanh(20 * share[:, _MARKUP]), np.exp(-n_words / 20), np.exp(-n_words / 100),
        np.tanh(10 * repeated / w), (np.diff(begin) / w) ** 2, np.diff(begin) / np.maximum(1, np.sqrt(n_words)) / 30,
    ]
    return np.nan_to_num(np.stack(columns, axis=1))


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bytes, hash of the words) of each line that has bytes."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    cuts = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
    words, of = word_hashes(data, cuts)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words)])
    begin = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(cuts) - 1))])
    rows = np.searchsorted(offsets, cuts[:-1], side="right") - 1
    return rows, np.diff(cuts), sums[begin[1:]] - sums[begin[:-1]]


def text_features(texts: pa.Array) -> np.ndarray:
    return np.concatenate([features(data, offsets) for _, data, offsets in text_runs(texts)] or [np.zeros((0, 32))])


def fit_preferences(x: np.ndarray, labels: np.ndarray, seed: int = 11, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, centre, spread) of the features: PAIRS pairs of a good and a bad document, Newton-like steps on the
    logistic loss of their differences."""
    centre, spread = x.mean(axis=0), x.std(axis=0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = np.clip((x - centre) / spread, -8, 8)
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    rng = np.random.default_rng(seed)
    difference = z[rng.choice(good, PAIRS)] - z[rng.choice(bad, PAIRS)]
    weights = np.zeros(z.shape[1])
    for _ in range(25):
        lost = 1 / (1 + np.exp(np.clip(difference @ weights, -30, 30)))
        slope = -(difference * lost[:, None]).mean(axis=0) + ridge * weights
        curve = (difference * (lost * (1 - lost))[:, None]).T @ difference / len(difference) + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights = weights - step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return weights, centre, spread


def fit(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(weights, centre, spread); None without documents of both classes."""
    if not len(labels) or labels.min() == labels.max():
        return None
    return fit_preferences(text_features(pa.array(texts, pa.string())), labels)


def raw_scores(x: np.ndarray, model: tuple) -> np.ndarray:
    weights, centre, spread = model
    # a row's sum does not depend on the rows beside it, as a matrix product's rounding may
    return (np.clip((x - centre) / spread, -8, 8) * weights).sum(axis=1)


def cut_and_slope(known: DataFrame) -> tuple[float, float]:
    """Over all of (label, raw): the middle between the score below which the share of bad documents lies, to one part
    in ACCURACY of the rows, and the next larger one; and the curve's slope, steeper where scores lie close together."""
    bad, spread = known.agg(F.avg(1 - F.col("label")), F.stddev_pop("raw")).first()
    at = known.agg(F.percentile_approx("raw", float(bad), ACCURACY)).first()[0]
    above = known.filter(F.col("raw") > at).agg(F.min("raw")).first()[0]
    return (at + (at if above is None else above)) / 2, 2.0 / max(1e-6, spread)


def quality_scores(
    docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", per_class: int = PER_CLASS, threshold: float = 0.7,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: (id_col, score, predicted): the chance of label 1 and whether it reaches `threshold`.

    `labels` has (id_col, label_col) of the rows that may be learned from; rows with a null in either and ids that `docs`
    lacks are left out; of an id's several texts the first is used, of its labels the largest. The fit sees at most `per_class` labelled documents of each
    class, chosen by a hash of the id; the share of bad ones and the quantile are taken over all labelled documents. Whole texts are scored; null
    and empty texts have the features of an empty text. Repeated rows get the same score, an empty table gives no rows.
    Without labels of both classes every score is 0.5. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    model = fit(*sample(docs, labels, label_col, per_class, id_col, text_col))
    if model is None:
        return docs.select(F.col(id_col), F.lit(0.5).alias("score"), F.lit(int(0.5 >= threshold)).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_runs(batch.column(1)):
                raw = raw_scores(features(data, offsets), shared.value)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(raw)), pa.array(raw)], names=["id", "raw"])

    columns = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = materialize(map_arrow(columns, run, f"id {kind}, raw double"), "raw-scores")
    known = materialize(scored.join(known_labels(docs, labels, label_col, id_col), "id").select("label", "raw"), "known-scores")
    cut, slope = cut_and_slope(known)
    zero = cut - np.log(threshold / (1 - threshold)) / slope
    steps = F.least(F.greatest(F.lit(float(slope)) * (F.col("raw") - F.lit(float(zero))), F.lit(-30.0)), F.lit(30.0))
    chance = scored.select(F.col("id").alias(id_col), (1 / (1 + F.exp(-steps))).alias("score"))
    return chance.select(id_col, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

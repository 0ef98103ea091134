"""Token counts of whole texts for a SentencePiece model, without keeping token ids.

No piece of the model holds a space mark behind another character, so merges never cross the start of a run of
spaces: a text's tokens are those of its pre-tokens, each a run of spaces and what follows up to the next space.
Pieces are counted once for each distinct pre-token, the counts are joined to each document's pre-token
frequencies, and count times frequency is summed.
"""

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.hashing import RUN_BYTES
from tillroll.llm.workspace import map_arrow

MARK = "▁"
#: Distinct pre-tokens whose counts a worker keeps between runs of documents, and the longest it keeps.
KNOWN, LONGEST = 150_000, 64

_RUNS = re.compile(r" ( *[^ ]*)")
_models: dict[str, tuple] = {}


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, each without one leading space (the model puts one in front of a text)."""
    if not text:
        return []
    text = text.replace(MARK, " ")
    return _RUNS.findall(" " + text) if "  " in text or text[0] == " " else text.split(" ")


def _model(path: str):
    if path not in _models:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        for i in range(model.get_piece_size()):
            if MARK in model.id_to_piece(i).lstrip(MARK):
                raise ValueError(f"{path}: a piece crosses the start of a run of spaces; texts can't be counted by pre-token")
        _models[path] = model, {}
    return _models[path]


def _count_new(model, known: dict[str, int], new: list[str]) -> dict[str, int]:
    """Pieces of each of `new`, and of an empty pre-token (a single space at the end)."""
    counts = {x: len(ids) for x, ids in zip(new, model.encode(new, num_threads=1))}
    if "" in counts:
        counts[""] = 1
    if len(known) > KNOWN:
        known.clear()
    known.update((x, n) for x, n in counts.items() if len(x) <= LONGEST)
    return counts


def _batch_counts(texts: pa.Array, path: str) -> list[int]:
    model, known = _model(path)
    out: list[int] = []
    waiting, held = [], 0

    def flush():
        distinct = set().union(*waiting)
        counts = {x: known[x] for x in distinct if x in known}
        new = [x for x in distinct if x not in counts]
        if new:
            counts |= _count_new(model, known, new)
        out.extend(sum(counts[x] * f for x, f in document.items()) for document in waiting)
        waiting.clear()

    for text in texts:
        text = text.as_py() or ""
        waiting.append(Counter(pre_tokens(text)))
        held += len(text)
        if held > RUN_BYTES:
            flush()
            held = 0
    if waiting:
        flush()
    return out


def token_counts(
    docs: DataFrame, path: str, *, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: (id_col, n_bytes, n_tokens, over_limit = n_tokens > limit).

    `path` names a SentencePiece model file that the executors can read. Counts equal those of encoding the whole
    text without begin or end tokens. A null text counts as an empty one: no bytes, no tokens. Null ids and repeated
    rows keep their rows, an empty table gives none, other columns are not read. A model whose pieces cross the start
    of a run of spaces is refused, since the sum would be wrong.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            n_tokens = pa.array(_batch_counts(texts, path), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, n_tokens], names=["id", "n_bytes", "n_tokens"])

    columns = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = columns.schema["id"].dataType.simpleString()
    counted = map_arrow(columns, run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )

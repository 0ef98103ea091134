"""Byte-level BPE: encoding by a priority queue of merges, decoding by joining vocabulary strings.

Inside a pre-token the symbols form a doubly linked list. The queue holds (rank of the merge, place of its left
symbol); the least entry is taken, skipped if the symbols there have changed since, else the two become one and the
merges with the new neighbours enter the queue. Pre-tokens are encoded once and kept in a bounded table.
"""

import heapq
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.workspace import map_arrow

#: Encoded pre-tokens in each of the two halves of a worker's table, and the longest it keeps.
KNOWN, LONGEST = 200_000, 64

# White space and the pre-token pattern of the byte-level scheme.
_WHITE = r"\t-\r \x85\xa0  -     　"
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d"
    rf"| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)

_loaded: dict[str, "ByteBpe"] = {}


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 256
    for b in range(256):
        letters.append(chr(b if b in own else extra))
        extra += b not in own
    return letters


class ByteBpe(dict):
    """A vocabulary file's encoder. As a dict it maps pre-tokens to their ids as little-endian bytes."""

    def __init__(self, path: str):
        super().__init__()
        self.earlier: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        back = {letter: b for b, letter in enumerate(letters)}
        self.first = [vocab[letter] for letter in letters]
        self.merges: dict[int, tuple[int, int]] = {}  # left id * 2**32 + right id: (rank, id of both)
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            self.merges.setdefault(vocab[a] << 32 | vocab[b], (rank, vocab[a + b]))
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        strings = {i: bytes(back[c] for c in s) for s, i in vocab.items()}
        strings |= {i: s.encode() for s, i in added.items()}
        self.strings = [strings.get(i, b"") for i in range(max(strings) + 1)]
        self.added = {s: struct.pack("<I", i) for s, i in added.items()}
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def piece(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        symbols, merges = [self.first[b] for b in data], self.merges
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            if found := merges.get(symbols[i] << 32 | symbols[i + 1]):
                queue.append(found[0] << 32 | i)
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            i = entry & 0xFFFFFFFF
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            found = merges.get(symbols[i] << 32 | symbols[j])
            if not found or found[0] != entry >> 32:
                continue
            symbols[i], symbols[j] = found[1], -1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                if found := merges.get(symbols[i] << 32 | symbols[j]):
                    heapq.heappush(queue, found[0] << 32 | i)
            if (j := before[i]) >= 0 and (found := merges.get(symbols[j] << 32 | symbols[i])):
                heapq.heappush(queue, found[0] << 32 | j)
        return [s for s in symbols if s >= 0]

    def __missing__(self, token: str) -> bytes:
        if (packed := self.earlier.get(token)) is None:
            ids = self.piece(token.encode())
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(token) <= LONGEST:
            self[token] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit numbers; strings of added tokens become their ids."""
        if len(self) > KNOWN:  # what is still in use moves on from the earlier half
            self.earlier = dict(self)
            self.clear()
        parts = self.split.split(text) if self.split else [text]
        out = []
        for k, part in enumerate(parts):
            out.append(self.added[part] if k % 2 else b"".join(map(self.__getitem__, PRE_TOKEN.findall(part))))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The vocabulary strings of the ids, joined; byte sequences that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def load(path: str) -> ByteBpe:
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def _mapped(df: DataFrame, id_col: str, column: str, out: str, kind: str, one) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = 512  # rows of output held at a time
            for at in range(0, batch.num_rows, step):
                piece = batch.slice(at, step)
                values = pa.array([one(x.as_py()) for x in piece.column(1)], pa.binary() if kind == "binary" else pa.string())
                yield pa.RecordBatch.from_arrays([piece.column(0), values], names=["id", out])

    columns = df.select(F.col(id_col).alias("id"), F.col(column).alias("value"))
    mapped = map_arrow(columns, run, f"id {columns.schema['id'].dataType.simpleString()}, {out} {kind}")
    return mapped.withColumnRenamed("id", id_col)


def bpe_encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids): each whole text's token ids as little-endian unsigned 32-bit numbers in one binary value.

    `path` names a tokenizers JSON file of a byte-level BPE that the executors can read. A null or empty text has no
    ids (an empty value). Null ids and repeated rows keep their rows, an empty table gives none, other columns are
    not read.
    """
    return _mapped(docs, id_col, text_col, "ids", "binary", lambda text: load(path).encode(text or ""))


def bpe_decode(encoded: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text): the text of each list of ids written by `bpe_encode`; a null list gives an empty text."""
    return _mapped(encoded, id_col, ids_col, "text", "string", lambda ids: load(path).decode(ids or b""))


def bpe_round_trip(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids, text): the ids of each text and what they decode to, row by row, with the rules of the two above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                ids = [bpe.encode(x.as_py() or "") for x in piece.column(1)]
                texts = [bpe.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(ids, pa.binary()), pa.array(texts, pa.string())], names=["id", "ids", "text"]
                )

    columns = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("value"))
    kind = columns.schema["id"].dataType.simpleString()
    return map_arrow(columns, run, f"id {kind}, ids binary, text string").withColumnRenamed("id", id_col)

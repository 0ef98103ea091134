"""Word and shingle hashes of whole texts, computed for many texts at once in numpy."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are handled in runs of about this many bytes, which bounds the arrays; one long text is one run.
RUN_BYTES = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=_U) * _BASE)
    values[65:91] = values[97:123]  # A-Z as a-z
    return values


_VALUES = _byte_values()
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_powers = {"up": np.ones(1, dtype=_U), "down": np.ones(1, dtype=_U)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if len(_powers["up"]) < n:
        size = max(n, RUN_BYTES * 2)
        inverse = pow(int(_BASE), -1, 1 << 64)
        for name, base in (("up", int(_BASE)), ("down", inverse)):
            steps = np.full(size, base, dtype=_U)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def text_runs(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) for runs of texts; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + RUN_BYTES, side="right")) - 1)
        to = min(to, n)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, row of each word). Words are runs of bytes other than ASCII white space; A-Z count as a-z."""
    if not len(data):
        return np.zeros(0, _U), np.zeros(0, np.int64)
    space = _SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets[:-1]] = True
    first = first[:-1]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    starts = np.flatnonzero(~space & (before | first))
    after = np.empty_like(space)
    after[-1], after[:-1] = True, space[1:] | first[1:]
    ends = np.flatnonzero(~space & after) + 1
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))
    return hashes, np.searchsorted(offsets, starts, side="right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes sorted within their row and distinct, row starts): the k-word shingles of each row, or its
    whole word sequence if it has fewer words."""
    words, rows = word_hashes(data, offsets)
    n = len(offsets) - 1
    per = np.bincount(rows, minlength=n)
    begin = np.concatenate([[0], np.cumsum(per)])
    h = np.zeros(max(0, len(words) - k + 1), dtype=_U)
    for j in range(k):
        h = (h + words[j : j + len(h)]) * _BASE
        h ^= h >> _U(29)
    inside = rows[: len(h)] == rows[k - 1 :] if len(h) else np.zeros(0, bool)
    out, at = [mix(h[inside])], [rows[: len(h)][inside]]
    for i in np.flatnonzero((per > 0) & (per < k)):
        x = per[i : i + 1].astype(_U)
        for w in range(begin[i], begin[i + 1]):
            x = (x + words[w : w + 1]) * _BASE
            x ^= x >> _U(29)
        out.append(mix(x))
        at.append(np.array([i]))
    h, rows = np.concatenate(out), np.concatenate(at)
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    h, rows = h[keep], rows[keep]
    return h, np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])

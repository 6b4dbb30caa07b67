"""Vectorised text helpers shared by the operators: they run inside tasks, on
one Arrow batch of whole texts at a time.

Words are the runs of bytes outside ``\\x20\\x09-\\x0D`` of the UTF-8 text.
Each word gets a 64-bit polynomial hash; windows of words get a 64-bit
rolling hash of their words' hashes. Both are deterministic constants of the
text, equal in every task, on every executor and after every retry.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_ODD_BYTE = 0x9E3779B97F4A7C15
_ODD_WORD = 0xD1342543DE82EF95
SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x + U64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=U64), 7)
#: Bytes of a text that are hashed at a time, and entries of the tables of powers.
BLOCK = 1 << 16
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _table(odd: int) -> tuple[np.ndarray, np.ndarray]:
    """``odd**i`` and its inverse modulo 2**64 for i <= ``BLOCK`` (kept per process)."""
    if odd not in _tables:
        one = np.ones(1, dtype=U64)
        _tables[odd] = tuple(np.cumprod(np.concatenate([one, np.full(BLOCK, U64(v))]), dtype=U64)
                             for v in (odd, pow(odd, -1, 1 << 64)))
    return _tables[odd]


def powers(odd: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``odd**i`` and its inverse modulo 2**64 for i < n."""
    small = _table(odd)
    if n <= BLOCK:
        return small[0][:n], small[1][:n]
    steps = -(-n // BLOCK)
    out = []
    for base, table in zip((odd, pow(odd, -1, 1 << 64)), small):
        jump = np.cumprod(np.concatenate([np.ones(1, dtype=U64), np.full(steps - 1, U64(pow(base, BLOCK, 1 << 64)))]), dtype=U64)
        out.append(np.multiply.outer(jump, table[:BLOCK]).reshape(-1)[:n])
    return out[0], out[1]


@dataclass
class Words:
    """The words of some texts, one after the other.

    ``starts``/``ends``: byte span of each word in ``data``; ``text``: number of
    the text of each word; ``first``: index of the first word of each text (one
    more entry than texts); ``hashes``: 64-bit hash of each word.
    """
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    first: np.ndarray
    hashes: np.ndarray


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string array into runs of rows of at most ``limit`` bytes (a longer
    text is a run of its own). Yields (first row, end row, bytes, offsets within
    the bytes); a null text has no bytes."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None:
        data = np.zeros(0, dtype=np.uint8)
    else:
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def words_of(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    n = len(data)
    solid = np.zeros(n + 1, dtype=np.int8)
    solid[:n] = ~space[data]
    begins = np.zeros(n + 1, dtype=bool)
    begins[1:] = solid[1:] > solid[:-1]
    if n:
        begins[0] = solid[0] == 1
    # a text boundary also ends a word
    cut = offsets[1:-1]
    begins[cut[solid[cut] == 1]] = True
    starts = np.flatnonzero(begins)
    stop = np.zeros(n + 1, dtype=bool)
    stop[1:] = solid[1:] < solid[:-1]
    inner = cut[(cut > 0)]
    stop[inner[solid[inner - 1] == 1]] = True
    ends = np.flatnonzero(stop)
    first = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, starts, ends, text, first, span_hashes(data, starts, ends))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (equal bytes, equal hash). Spans are hashed in
    blocks of the data, so memory does not grow with it."""
    if np.any(starts[1:] < starts[:-1]):
        order = np.argsort(starts, kind="stable")
        out = np.empty(len(starts), dtype=U64)
        out[order] = span_hashes(data, starts[order], ends[order])
        return out
    reach = np.maximum.accumulate(ends) if len(ends) else ends  # spans may overlap
    up, down = _table(_ODD_BYTE)
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        low = starts[i]
        j = int(np.searchsorted(reach, low + BLOCK, side="right"))
        if j <= i:  # one span over several blocks
            total, factor = 0, 1
            for at in range(low, ends[i], BLOCK):
                part = data[at:min(at + BLOCK, ends[i])]
                total += factor * int(np.sum(_BYTE_VALUE[part] * up[:len(part)], dtype=U64))
                factor = factor * pow(_ODD_BYTE, BLOCK, 1 << 64) & 0xFFFFFFFFFFFFFFFF
            out[i] = total & 0xFFFFFFFFFFFFFFFF
            i += 1
            continue
        part = data[low:reach[j - 1]]
        sums = np.zeros(len(part) + 1, dtype=U64)
        np.cumsum(_BYTE_VALUE[part] * up[:len(part)], dtype=U64, out=sums[1:])
        out[i:j] = (sums[ends[i:j] - low] - sums[starts[i:j] - low]) * down[starts[i:j] - low]
        i = j
    return mix(out, 1)


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words, over text borders too
    (the caller drops those); empty if there are fewer words."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, dtype=U64)
    up, down = powers(_ODD_WORD, n + 1)
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(hashes * up[:n], dtype=U64, out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * down[:n - width + 1], 2)


def range_hashes(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 3) -> np.ndarray:
    """Hash of each word range ``begin[i]:end[i]`` (of any lengths)."""
    n = len(hashes)
    up, down = powers(_ODD_WORD, n + 1)
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(mix(hashes, seed) * up[:n], dtype=U64, out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(U64), seed)


def inside(words: Words, width: int) -> np.ndarray:
    """Which window starts lie wholly in one text."""
    n = len(words.text)
    if n < width:
        return np.zeros(0, dtype=bool)
    return words.text[width - 1:] == words.text[:n - width + 1]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[:have - width], out[width - have:])
    return out


def as_signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return values.view(np.int64)

"""Vectorised text primitives shared by the training-data operators.

Everything works on flat numpy buffers: a chunk of documents is one uint8
buffer plus offsets, words are (start, end) index arrays, and any span of bytes
or words gets a 64-bit fingerprint from a prefix sum (a polynomial over
Z/2^64 of randomised symbols, finished by an avalanche mix).  Two different
spans share a fingerprint with a probability near 2^-64.

Nulls: a null text is the empty text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Text bytes handled at once by the numpy code; a single longer text forms a chunk of its own.
CHUNK_BYTES = 2 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche a uint64 array (the splitmix64 finisher)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_SYMBOL = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
_powers = np.ones(1, U64)
_inverse_powers = np.ones(1, U64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = max(n, 1 << 16)
        out = []
        for base in (_BASE, _INVERSE):
            t = np.full(size, base, U64)
            t[0] = 1
            out.append(np.cumprod(t))
        _powers, _inverse_powers = out
    return _powers, _inverse_powers


def release() -> None:
    """Drops the power tables and gives freed memory back to the system.

    Python workers outlive their tasks, so what a task leaves in the allocators
    (NumPy's and Arrow's) would be held beside all that follows in its executor.
    """
    global _powers, _inverse_powers
    _powers, _inverse_powers = np.ones(1, U64), np.ones(1, U64)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def tidied(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of a task's batches; its memory is released when it is done."""

    def wrapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


class Spans:
    """Fingerprints of arbitrary spans of a symbol sequence in O(1) each."""

    def __init__(self, symbols: np.ndarray):
        symbols = _SYMBOL[symbols] if symbols.dtype == np.uint8 else symbols
        power, _ = _tables(len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, U64)
        np.cumsum(symbols * power[: len(symbols)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, inverse = _tables(len(self.sums))
        x = (self.sums[end] - self.sums[start]) * inverse[start]
        return mix(x + (end - start).astype(U64) * U64(0xA24BAED4963EE407))

    def windows(self, k: int) -> np.ndarray:
        """Fingerprints of all windows of k symbols."""
        n = max(0, len(self.sums) - k)
        _, inverse = _tables(len(self.sums))
        return mix((self.sums[k : k + n] - self.sums[:n]) * inverse[:n] + U64(k))


@dataclass
class Chunk:
    """Some documents: ids (Arrow, any type), buf (uint8) and offs (int64, one more than documents)."""

    ids: pa.Array
    buf: np.ndarray
    offs: np.ndarray

    def __len__(self) -> int:
        return len(self.offs) - 1

    @property
    def id_values(self) -> np.ndarray:
        return self.ids.to_numpy(zero_copy_only=False)

    def texts(self) -> list[str]:
        raw = self.buf.tobytes()
        o = self.offs.tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(o[:-1], o[1:], strict=True)]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buffer and offsets of an Arrow string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    large = column.type in (pa.large_string(), pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    _, offsets, data = column.buffers()
    width = np.int64 if large else np.int32
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def chunks(batches: Iterable[pa.RecordBatch | pa.Table], limit: int = CHUNK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> Iterator[Chunk]:
    """Cut Arrow batches into chunks of whole documents of about ``limit`` bytes."""
    for batch in batches:
        ids, (buf, offs) = batch.column(id_col), utf8(batch.column(text_col))
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.combine_chunks()
        at, n = 0, len(offs) - 1
        while at < n:
            end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
            yield Chunk(ids.slice(at, end - at), buf[offs[at] : offs[end]], offs[at : end + 1] - offs[at])
            at = end


def byte_table(spec: str) -> np.ndarray:
    """A 256-entry boolean table of the bytes that belong to words."""
    t = np.ones(256, bool)
    if spec == "space":  # words are [^\x20\x09-\x0D]+
        t[[0x20, *range(0x09, 0x0E)]] = False
    elif spec == "alnum":  # words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
        t[:0x80] = False
        t[0x30:0x3A] = t[0x61:0x7B] = True
    else:
        raise ValueError(spec)
    return t


SPACE_WORDS, ALNUM_WORDS = byte_table("space"), byte_table("alnum")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def split_words(buf: np.ndarray, offs: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in bytes, and for each document the index of its first word (one more at the end)."""
    n = len(buf)
    inside = member[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = offs[(offs > 0) & (offs < n)]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Spans(buf).hash(starts, ends)


def owner(first: np.ndarray) -> np.ndarray:
    """For each item its document, given each document's first item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and starts of all k-item windows that lie in one document."""
    if len(hashes) < k:
        return np.empty(0, U64), np.empty(0, np.int64)
    of = owner(first)
    starts = np.flatnonzero(of[: len(of) - k + 1] == of[k - 1 :])
    return Spans(hashes).windows(k)[starts], starts


def covered(starts: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    """Boolean array of n items: those inside any span [start, start + length)."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + length, -1)
    return np.cumsum(d[:-1]) > 0


def runs(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flag, [False])).astype(np.int8)))
    return edge[::2], edge[1::2]


def per_document(flag: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of an array over each document's items."""
    total = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of w items, by doubling."""
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:]) if len(x) > span else x[:0]
        span *= 2
    rest = w - span
    return (np.minimum(x[:-rest], x[rest:]) if len(x) > rest else x[:0]) if rest else x


def distinct(keys: np.ndarray) -> np.ndarray:
    """The sorted distinct keys; by sorting, which is far faster for long arrays of integers than hashing."""
    keys = np.sort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new]


def numbered(keys: np.ndarray) -> np.ndarray:
    """For each key its index among the sorted distinct ones."""
    order = np.argsort(keys)
    ordered = keys[order]
    number = np.zeros(len(keys), np.int64)
    number[1:] = ordered[1:] != ordered[:-1]
    del ordered
    np.cumsum(number, out=number)
    out = np.empty(len(keys), np.int64)
    out[order] = number
    return out


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, column after column."""
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpack(payload: bytes | memoryview, *types: type) -> list[np.ndarray]:
    raw = np.frombuffer(payload, np.uint8)
    widths = [np.dtype(t).itemsize for t in types]
    n = len(raw) // sum(widths)
    out, at = [], 0
    for t, w in zip(types, widths, strict=True):
        out.append(raw[at : at + n * w].view(t) if at % w == 0 else np.frombuffer(raw[at : at + n * w].tobytes(), t))
        at += n * w
    return out


def unpack_all(payloads: Iterable[bytes], *types: type) -> list[np.ndarray]:
    parts = [unpack(p, *types) for p in payloads]
    return [np.concatenate([p[i] for p in parts]) if parts else np.empty(0, t) for i, t in enumerate(types)]

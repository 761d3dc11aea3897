"""SentencePiece BPE encoding and decoding with vectorised merge rounds.

The model file is read as the public protobuf wire format; its library is not
used.  Supported: BPE models with byte fallback and identity normalisation, a
dummy prefix, no removal of extra spaces and no user-defined pieces; others are
refused.

Texts are cut where no piece of the vocabulary can cross (checked when the
model is read: no piece holds a space after another symbol, none but a single
one holds a line feed), distinct segments are merged together in
``bpe.merge_rounds``, and a text's ids are those of its segments in order.

Edge cases: a null or empty text has no ids and decodes to the empty text; a
U+2581 in a text encodes as a space does, so it decodes to a space; ids of
bytes that are no UTF-8 decode to U+FFFD; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PairTable, merge_rounds
from .textcore import chunks, tidied

SPACE = "▁"
#: Distinct segments kept by a Python worker before its table starts anew.
TABLE_SEGMENTS = 500_000
#: Bytes that these may take, with about ``ENTRY_BYTES`` for each beside its strings.
TABLE_BYTES = 96 << 20
ENTRY_BYTES = 256
_SEGMENT = re.compile(r"\n| +[^ \n]*|[^ \n]+")


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 0x7F) << shift
        if b < 0x80:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            size = {1: 8, 5: 4}[kind]
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in parts])))


def _gathered(flat: np.ndarray, offs: np.ndarray, ids: np.ndarray, count: np.ndarray) -> list[bytes]:
    """The strings of ids (given as one buffer with offsets), joined for each row of ids."""
    at, size = offs[ids], offs[ids + 1] - offs[ids]
    ends = np.cumsum(size)
    out = flat[np.repeat(at - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
    cut = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(count)))].tolist()
    return [out[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


class Codec:
    """Encoder and decoder of one model file (bytes)."""

    def __init__(self, model: bytes):
        pieces: list[tuple[str, float, int]] = []
        trainer, normalizer = {}, {}
        for tag, value in _fields(model):
            if tag == 1:
                f = dict(_fields(value))
                pieces.append((f[1].decode(), struct.unpack("<f", f.get(2, b"\0" * 4))[0], f.get(3, 1)))
            elif tag == 2:
                trainer = dict(_fields(value))
            elif tag == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3) != 2 or not trainer.get(35) or normalizer.get(2) or not normalizer.get(3, 1) or normalizer.get(4, 1) or any(t in (4, 5) for *_, t in pieces):
            raise ValueError("only BPE models with byte fallback, identity normalisation and a dummy prefix")
        normal = {p: (i, s) for i, (p, s, t) in enumerate(pieces) if t == 1}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) or ("\n" in p and len(p) > 1) for p in normal):
            raise ValueError("a piece crosses segments")
        self.byte_id = np.zeros(256, np.int64)
        for i, (p, _, t) in enumerate(pieces):
            if t == 6:
                self.byte_id[int(p[3:5], 16)] = i
        #: Symbols: the ids of pieces, then further characters met in pieces, then FAR + code point.
        symbol = {p: i for p, (i, _) in normal.items()}
        for p in normal:
            for c in p:
                symbol.setdefault(c, len(pieces) + len(symbol))
        self.far = 1 << 20
        self.of_char = np.arange(0x110000, dtype=np.int32) + self.far
        for p, i in symbol.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        scores = sorted({s for _, s in normal.values()}, reverse=True)
        dense = {s: r for r, s in enumerate(scores)}
        rows, seen, careful = [], set(), np.zeros(len(scores), bool)
        for p, (i, s) in normal.items():
            if len(p) < 2:
                continue
            r = dense[s]
            if r in seen:
                careful[r] = True  # several pieces of one score: strictly from the left
            seen.add(r)
            for k in range(1, len(p)):
                a, b = p[:k], p[k:]
                if a in symbol and b in symbol:
                    rows.append((symbol[a], symbol[b], r, i))
                    for part in (a, b):
                        if len(part) > 1 and dense[normal[part][1]] >= r:
                            careful[dense[normal[part][1]]] = True
        self.table = PairTable(*np.array(rows, np.int64).T, careful, [self.of_char[np.frombuffer(p.encode("utf-32-le"), np.uint32)] for p in normal])
        surface = [p.replace(SPACE, " ").encode() if t == 1 else bytes([int(p[3:5], 16)]) if t == 6 else " ⁇ ".encode() if t == 2 else b"" for p, _, t in pieces]
        self.surface, self.surface_at = _joined(surface)
        self.digits = _joined([b"%d," % i for i in range(len(pieces))])
        self.is_id = np.zeros(self.far + 0x110000, bool)
        self.is_id[: len(pieces)] = True
        self.forget()

    def forget(self) -> None:
        """Starts the table of known segments anew."""
        self.held = 0
        self.known: dict[str, int] = {}
        self.counts = np.empty(0, np.int64)
        self.id_text: list[bytes] = []
        self.plain: list[bytes] = []

    def merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct segments, flat, and their number for each segment."""
        text = "".join(segments).replace(" ", SPACE)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        sym, count = merge_rounds(self.of_char[points], np.array([len(s) for s in segments]), self.table)
        unknown = np.flatnonzero(~self.is_id[sym])
        if not len(unknown):
            return sym, count
        raw = [(chr(c - self.far) if c >= self.far else "�").encode("utf-8", "replace") for c in sym[unknown].tolist()]
        size = np.ones(len(sym), np.int64)
        size[unknown] = [len(x) for x in raw]
        out = np.repeat(sym, size)
        end = np.cumsum(size)
        spots = np.concatenate([np.arange(end[i] - size[i], end[i]) for i in unknown])
        out[spots] = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        of = np.repeat(np.repeat(np.arange(len(count)), count), size)
        return out, np.bincount(of, minlength=len(count))

    def decode_bytes(self, ids: np.ndarray, count: np.ndarray) -> list[bytes]:
        """Surfaces of rows of ids (flat, with their number for each row), before the dummy prefix goes."""
        return _gathered(self.surface, self.surface_at, ids, count)

    def _learn(self, rows: list[list[str]]) -> list[list[str]]:
        if len(self.known) > TABLE_SEGMENTS or self.held > TABLE_BYTES:
            self.forget()
        new = list(set().union(*rows).difference(self.known)) if rows else []
        if new:
            ids, count = self.merge(new)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.counts = np.concatenate((self.counts, count))
            texts, plains = _gathered(*self.digits, ids, count), self.decode_bytes(ids, count)
            self.id_text += texts
            self.plain += plains
            self.held += ENTRY_BYTES * len(new) + sum(sum(map(len, x)) for x in (new, texts, plains))
        return rows

    def _segments(self, texts: list[str]) -> list[list[int]]:
        rows = self._learn([_SEGMENT.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts])
        get = self.known.__getitem__
        return [list(map(get, row)) for row in rows]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        rows = [_SEGMENT.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        distinct = {w: i for i, w in enumerate(set().union(*rows))}
        if not distinct:
            return [np.empty(0, np.int64)] * len(texts)
        ids, count = self.merge(list(distinct))
        parts = np.split(ids, np.cumsum(count)[:-1])
        return [np.concatenate([parts[distinct[w]] for w in row]) if row else np.empty(0, np.int64) for row in rows]

    def decode(self, rows: list[np.ndarray]) -> list[str]:
        count = np.array([len(r) for r in rows], np.int64)
        raw = self.decode_bytes(np.concatenate([np.asarray(r, np.int64) for r in rows]) if rows else np.empty(0, np.int64), count)
        spaced = [len(r) > 0 and self.surface[self.surface_at[r[0]] : self.surface_at[r[0] + 1]][:1].tobytes() == b" " for r in rows]
        return [(x[1:] if s else x).decode("utf-8", "replace") for x, s in zip(raw, spaced, strict=True)]

    def digests(self, texts: list[str]) -> tuple[list[int], list[str], list[bytes]]:
        """For each text: the number of its ids, the SHA-256 of the ids as text, and its decoded bytes."""
        counts, shas, plains = [], [], []
        for row in self._segments(texts):
            counts.append(int(self.counts[row].sum()) if row else 0)
            shas.append(hashlib.sha256(b"".join(map(self.id_text.__getitem__, row))[:-1]).hexdigest())
            plains.append(b"".join(map(self.plain.__getitem__, row))[1:])
        return counts, shas, plains


@lru_cache(1)
def _codec(path: str, model: bytes) -> Codec:
    return Codec(model)


def load(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_decode(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """Ids and decoded text of every row: (id, n_tokens, ids_sha256, decoded, [ids]).

    Scan only, no shuffle.  The model (a vocabulary, a few MB at most) is read
    on the driver and sent with the task.
    """
    model = load(model_path)
    if len(model) > 64 << 20:
        raise ValueError("the model is over 64 MB")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path, model)
        try:
            for c in chunks(batches):
                texts = c.texts()
                counts, shas, plains = codec.digests(texts)
                columns = {"id": c.ids, "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(shas, pa.string()), "decoded": pa.array(plains, pa.binary()).cast(pa.string())}
                if ids:
                    columns["ids"] = pa.array([x.astype(np.int32) for x in codec.encode(texts)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)
        finally:
            codec.forget()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(tidied(run), f"id {kind}, n_tokens long, ids_sha256 string, decoded string" + ", ids array<int>" * ids)
    return out.withColumnRenamed("id", id_col)


def token_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    out = encode_decode(docs, model_path)
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))

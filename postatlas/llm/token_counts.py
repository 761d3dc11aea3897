"""Token counts of a byte-level BPE with a whole-token shortcut.

Offline, every vocabulary string is encoded alone with the merge engine; those
that come out as one token are proven whole.  A pre-token that equals a proven
string counts one directly; only the others are merged (once for each distinct
one in a worker).  A special token's string inside a text is one token and
splits the text, as the library does by default.

Edge cases: a null or empty text has no bytes and no tokens; repeated rows are
counted each; an empty table gives an empty one.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import PairTable, merge_rounds
from .textcore import chunks

#: Distinct merged pre-tokens kept by a Python worker before its table starts anew.
TABLE_WORDS = 500_000
# Fixed value: the pre-tokenizer's pattern of this public vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Counter:
    def __init__(self, spec: str):
        model = json.loads(spec)
        kind = model["model"]
        pre = model.get("pre_tokenizer") or {}
        if kind["type"] != "BPE" or model.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or kind.get("ignore_merges"):
            raise ValueError("only byte-level BPE without normaliser and prefix space")
        self.special = [t["content"] for t in model.get("added_tokens", [])]
        alphabet = byte_alphabet()
        vocab = kind["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in kind["merges"]]
        left, right = (np.array([vocab[m[i]] for m in merges]) for i in (0, 1))
        product = np.array([vocab["".join(m)] for m in merges])
        born = np.full(max(vocab.values()) + 1, -1)
        born[product[::-1]] = np.arange(len(merges))[::-1]
        careful = np.zeros(len(merges), bool)
        early = np.maximum(born[left], born[right]) >= np.arange(len(merges))
        careful[np.concatenate((born[left][early], born[right][early]))] = True
        self.of_byte = np.array([vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])])
        pieces = [self.of_byte[[alphabet[c] for c in s]] for s in vocab if s not in self.special]
        self.table = PairTable(left, right, np.arange(len(merges)), product, careful, pieces)
        strings = []
        for s in vocab:
            if s not in self.special:
                try:
                    strings.append(bytes(alphabet[c] for c in s).decode())
                except UnicodeDecodeError:
                    pass  # no text equals it
        alone = self.merged(strings)
        self.whole = {s: 1 for s, n in zip(strings, alone, strict=True) if n == 1}
        self.find = regex.compile(PATTERN).findall
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))).split if self.special else None
        self.known = dict(self.whole)

    def merged(self, words: list[str]) -> list[int]:
        raw = [w.encode() for w in words]
        symbols = self.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        return merge_rounds(symbols, np.array([len(r) for r in raw]), self.table)[1].tolist()

    def learn(self, words: set[str]) -> None:
        new = list(words.difference(self.known))
        if new:
            self.known.update(zip(new, self.merged(new), strict=True))

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.known) > len(self.whole) + TABLE_WORDS:
            self.known = dict(self.whole)
        extra, rows = [0] * len(texts), []
        for i, t in enumerate(texts):
            if self.split and any(s in t for s in self.special):
                parts = self.split(t)
                extra[i] = len(parts) - 1
                rows.append([w for p in parts for w in self.find(p)])
            else:
                rows.append(self.find(t))
        self.learn(set().union(*rows))
        get = self.known.__getitem__
        return [n + sum(map(get, row)) for n, row in zip(extra, rows, strict=True)]


@lru_cache(1)
def _counter(path: str, spec: str) -> Counter:
    return Counter(spec)


def count_tokens(docs: DataFrame, vocabulary_path: str, *, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.  Scan only, no shuffle."""
    with open(vocabulary_path, encoding="utf-8") as f:
        spec = f.read()
    if len(spec) > 64 << 20:
        raise ValueError("the vocabulary is over 64 MB")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary_path, spec)
        for c in chunks(batches):
            n = np.array(counter.counts(c.texts()), np.int64)
            yield pa.RecordBatch.from_pydict({"id": c.ids, "n_bytes": np.diff(c.offs), "n_tokens": n, "over_limit": n > limit})

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)


__all__ = ["Counter", "count_tokens"]

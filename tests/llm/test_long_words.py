"""Long texts without a break: exact, and in a time that grows with their length alone."""

import random
import time

import numpy as np
import pytest

from postatlas.llm import bpe, queries, sentencepiece_codec, token_counts

rnd = random.Random(9)
MIXED = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def drawn(letters, n):
    return "".join(rnd.choices(letters, k=n))


def texts(n):
    common = ["the", "ing", "tion", "er", "ab", "a", "e", "s", "o", "an"]
    return {
        "lower": drawn("abcdefghijklmnopqrstuvwxyz", n), "few": drawn("etaoin", n), "two": drawn("ab", n), "one": "a" * n, "base64": drawn(MIXED, n), "han": drawn([chr(c) for c in range(0x4E00, 0x4E00 + 3000)], n // 3),
        "kana": drawn("あいうえおかきくけこさしすせそラーメンの", n // 3), "pieces": "".join(rnd.choices(common, k=n // 3)), "dashes": "".join(rnd.choices(["-" * 7, "=", "-", "--=", "___"], k=n // 4)), "digits": drawn("0123456789", n),
    }


@pytest.fixture(scope="module")
def piece():
    import sentencepiece

    path = queries.tokenizer("piece_bpe_32k.model")
    return sentencepiece_codec.Codec(sentencepiece_codec.load(path)), sentencepiece.SentencePieceProcessor(model_file=path)


@pytest.fixture(scope="module")
def byte():
    from tokenizers import Tokenizer

    path = queries.tokenizer("byte_bpe_50k.json")
    return token_counts.Counter(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)


@pytest.mark.parametrize("n", [700, 5000, 60000])
def test_exact(piece, byte, n):
    codec, lib = piece
    counter, other = byte
    for kind, t in texts(n).items():
        for x in (t, f"short {t} words, {t[: n // 2]}"):
            assert codec.encode([x])[0].tolist() == lib.encode(x), kind
            assert counter.counts([x]) == [len(other.encode(x, add_special_tokens=False).ids)], kind


def test_many_small_vocabularies():
    """Local minima give the priority queue's result for any merge list, also where products come late."""

    def queue(word, pairs):
        word = list(word)
        while True:
            best = min(((pairs[p], i) for i, p in enumerate(zip(word, word[1:])) if p in pairs), default=None)
            if best is None:
                return word
            i = best[1]
            word[i : i + 2] = [word[i] + word[i + 1]]

    for trial in range(150):
        letters, made, merges = "abc"[: rnd.randint(1, 3)], [], []
        pool = list(letters)
        for _ in range(rnd.randint(2, 12)):
            a, b = rnd.choice(pool), rnd.choice(pool)
            if len(a + b) <= 6 and a + b not in made:
                made.append(a + b)
                merges.append((a, b))
                pool.append(a + b)
        ranks = list(range(len(merges)))
        if trial % 2:
            rnd.shuffle(ranks)  # a product's pairs may come before its own
        number = {s: i for i, s in enumerate([*letters, *made])}
        born = {a + b: r for (a, b), r in zip(merges, ranks)}
        careful = np.zeros(max(len(merges), 1), bool)
        for (a, b), r in zip(merges, ranks):
            for part in (a, b):
                if born.get(part, -1) >= r:
                    careful[born[part]] = True
        one = lambda s: np.array([number[c] for c in s])
        columns = [np.array(x, np.int64) for x in ([number[a] for a, _ in merges], [number[b] for _, b in merges], ranks, [number[a + b] for a, b in merges])]
        table = bpe.PairTable(*columns, careful, [one(s) for s in [*letters, *made]])
        for n in (40, 400):
            word = drawn(letters, n)
            want = [number[s] for s in queue(word, {p: r for p, r in zip(merges, ranks)})]
            assert bpe.merge_long(one(word), table).tolist() == want
            got, count = bpe.merge_rounds(one(word), np.array([n]), table)
            assert got.tolist() == want and count.tolist() == [len(want)]


def test_a_megabyte_takes_seconds(piece, byte):
    for t in (drawn("abcdefghijklmnopqrstuvwxyz", 1 << 20), drawn(MIXED, 1 << 20)):
        began = time.time()
        piece[0].encode([t])
        byte[0].counts([t])
        assert time.time() - began < 60

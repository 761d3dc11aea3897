"""Plain versions of the operators, for small inputs: rows are (id, text)."""

import hashlib
import re
from collections import Counter

SPACED = r"[^\x20\x09-\x0D]+"


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def suffix(rows, n=100):
    first, out = {}, []
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - n + 1):
            w = b[p : p + n]
            first[w] = min(first.get(w, (i, p)), (i, p))
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if first[b[p : p + n]] < (i, p):
                gone[p : p + n] = b"\1" * n
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(x for x, g in zip(b, gone) if not g))))
    return sorted(out)


def substring(rows, n=50):
    first, out = {}, []
    for i, t in rows:
        w = re.findall(SPACED, t or "")
        for p in range(len(w) - n + 1):
            k = tuple(w[p : p + n])
            first[k] = min(first.get(k, i), i)
    for i, t in rows:
        w = re.findall(SPACED, t or "")
        gone = [0] * len(w)
        for p in range(len(w) - n + 1):
            if first[tuple(w[p : p + n])] < i:
                gone[p : p + n] = [1] * n
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def lines(rows, least=8):
    texts = {i: (t or "").split("\n") if t else [] for i, t in rows}
    places = [((i, k), re.findall(SPACED, x)) for i, t in sorted(texts.items()) for k, x in enumerate(t)]
    places = [(p, w) for p, w in places if w]
    gone = set()
    for x, (p, w) in enumerate(places):
        for q, v in places[:x]:
            if w == v or (max(len(w), len(v)) >= least and abs(len(w) - len(v)) < 2 and distance(w, v) <= 1):
                gone.add(p)
                break
    return sorted((i, len(texts[i]), sum((i, k) in gone for k in range(len(texts[i]))), sha("\n".join(x for k, x in enumerate(texts[i]) if (i, k) not in gone))) for i, _ in rows)


def counts(rows):
    out = []
    for i, t in rows:
        t = t or ""
        w = re.findall(SPACED, t)
        grams = [tuple(w[p : p + 3]) for p in range(len(w) - 2)]
        c, f = Counter(grams), [0] * len(w)
        for p, x in enumerate(grams):
            if c[x] > 1:
                f[p : p + 3] = [1] * 3
        seen, dup = set(), 0
        for x in t.split("\n"):
            if re.search(SPACED, x):
                dup += x in seen
                seen.add(x)
        out.append((i, len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"), dup, sum(f), len(w) < 50 or 100 * sum(f) > 50 * len(w)))
    return out


def matches(rows, items, n=8):
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    known = {}
    for i, t in items:
        w = re.findall(word, lower(t))
        k = min(n, len(w))
        for p in range(len(w) - k + 1 if w else 0):
            known.setdefault(tuple(w[p : p + k]), set()).add(str(i))
    out = []
    for i, t in rows:
        w = re.findall(word, lower(t))
        f, found = [0] * len(w), set()
        for k in {len(x) for x in known}:
            for p in range(len(w) - k + 1):
                if tuple(w[p : p + k]) in known:
                    f[p : p + k] = [1] * k
                    found |= known[tuple(w[p : p + k])]
        out.append((i, len(w), sum(f), len(found), sha(",".join(sorted(found))), len(found) >= 2))
    return out


def components(rows, n=5):
    sets = {}
    for i, t in rows:
        w = re.findall(SPACED, lower(t))
        sets[i] = {tuple(w[p : p + n]) for p in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                p, q = root(a), root(b)
                up[max(p, q)] = min(p, q)
    return sorted((i, len(sets[i]), root(i)) for i, _ in rows)

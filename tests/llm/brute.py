"""Plain versions of the corpus operators."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import xxhash

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LAST = 1 << 63


def data(text):
    return (text or "").encode()


def sha(b):
    return hashlib.sha256(b).hexdigest()


def key(doc_id):
    return LAST if doc_id is None else doc_id


def repeated_bytes(rows, size=100):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, sha)}; rows of one doc_id must have one text."""
    seen, out = set(), {}
    for d, text in sorted(set(rows), key=lambda r: key(r[0])):
        b = data(text)
        hit = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if b[i : i + size] in seen:
                hit[i : i + size] = b"\1" * size
            seen.add(b[i : i + size])
        kept = bytes(x for x, h in zip(b, hit) if not h)
        out[d, text] = (len(b), len(b) - len(kept), len(re.findall(b"\1+", bytes(hit))), sha(kept))
    return out


def repeated_words(rows, size=50):
    first, out = {}, {}
    for d, text in sorted(set(rows), key=lambda r: key(r[0])):
        w = data(text).split()
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), key(d))
    for d, text in set(rows):
        w = data(text).split()
        hit = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < key(d):
                hit[i : i + size] = [True] * size
        out[d, text] = (len(w), sum(hit), sha(b" ".join(x for x, h in zip(w, hit) if not h)))
    return out


def contamination(rows, items, size=13):
    words = lambda t: WORDS.findall((t or "").encode().translate(LOWER).decode())
    windows = collections.defaultdict(set)
    for name, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])] |= {str(name)} if name is not None else set()
    out = {}
    for d, text in rows:
        w, names = words(text), set()
        hit = [False] * len(w)
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    names |= windows[k]
                    hit[i : i + n] = [True] * n
        out[d, text] = (len(w), sum(hit), len(names), sha(",".join(sorted(names)).encode()), 0 < sum(hit) and 20 * sum(hit) >= len(w))
    return out


def base_scores(rows, held):
    tokens = lambda t: [*data(t).translate(LOWER).split(), None]
    c = collections.Counter(w for d, t in rows if not held(d) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return {
        (d, t): (held(d), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)))
        for d, t in rows
    }


def franchise(counts, root, d, theta, sweeps, burn_in, seed):
    """Mean P(word | near, far) of each counted (near, far, word): every customer of two levels leaves and sits down again, one by one."""
    rng = random.Random(seed)
    rest = collections.defaultdict(lambda: collections.defaultdict(list))  # restaurant -> dish -> table sizes

    def p(key, w):
        if not key:
            return root[w]
        tables = rest[key]
        c, t = sum(map(sum, tables.values())), sum(map(len, tables.values()))
        own = tables.get(w, [])
        return (sum(own) - d * len(own) + (theta + d * t) * p(key[:-1], w)) / (theta + c)

    def sit(key, w):
        tables = rest[key]
        own = tables[w]
        weights = [n - d for n in own] + [(theta + d * sum(map(len, tables.values()))) * p(key[:-1], w)]
        i = rng.choices(range(len(weights)), weights)[0]
        if i < len(own):
            own[i] += 1
        else:
            own.append(1)
            if key[:-1]:
                sit(key[:-1], w)

    def leave(key, w):
        own = rest[key][w]
        i = rng.choices(range(len(own)), own)[0]
        own[i] -= 1
        if not own[i]:
            del own[i]
            if key[:-1]:
                leave(key[:-1], w)

    people = [((n, f), w) for (n, f, w), m in counts.items() for _ in range(m)]
    for who in people:
        sit(*who)
    total = collections.Counter()
    for sweep in range(sweeps):
        for who in people:
            leave(*who)
            sit(*who)
        if sweep >= burn_in:
            for n, f, w in counts:
                total[n, f, w] += p((n, f), w) / (sweeps - burn_in)
    return total


def counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = collections.Counter(grams)
    hit = [False] * len(w)
    for i, g in enumerate(grams):
        if often[g] > 1:
            hit[i : i + 3] = [True] * 3
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    failed = len(w) < 50 or 100 * sum(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, sum(hit), failed


def fingerprint(text, size=3):
    w = data(text).translate(LOWER).split()
    grams = [b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, linked):
    label = {i: i for i in ids}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and linked(i, j) and (a := find(i)) != (b := find(j)):
                label[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())

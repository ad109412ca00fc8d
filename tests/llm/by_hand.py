"""Brute-force versions of operators, for small tables."""

import hashlib
import re
from collections import Counter

import xxhash

LAST = 2**63 - 1


def bytes_by_hand(rows, window):
    rows = [(d, (t or "").encode()) for d, t in rows]
    times = Counter(t[i : i + window] for _, t in rows for i in range(len(t) - window + 1))
    out = []
    for d, t in rows:
        gone = [False] * len(t)
        for i in range(len(t) - window + 1):
            if times[t[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return Counter(out)


def words_by_hand(rows, window):
    split = [(LAST if d is None else d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in split:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, (LAST, LAST)), (d, i))
    out = []
    for (doc_id, _), (d, w) in zip(rows, split, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (d, i):
                gone[i : i + window] = [True] * window
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()))
    return Counter(out)


def print_by_hand(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(rows):
    prints = [print_by_hand(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (d, _) in zip(group, rows, strict=True):
        if d is not None:
            least[g] = min(least.get(g, d), d)
    return Counter((d, p, least.get(g)) for (d, _), p, g in zip(rows, prints, group, strict=True))

"""The contracts in plain Python, one row after the other."""

import re
import zlib
from collections import Counter

import regex
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def classes(texts):
    """The place of each text's first class member."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def held_out(doc_id, parts, part):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % parts == part


def simhash(text):
    w = words(text)
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grams(text):
    """Counts of the 1- to 3-grams of letter runs."""
    counts = Counter()
    for run in regex.findall(r"\p{L}[\p{L}\p{M}]*", text.lower()):
        padded = f"_{run}_"
        counts.update(run)
        counts.update(padded[i : i + 2] for i in range(len(padded) - 1))
        counts.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return counts


def most(counts, size=300):
    return sorted(counts, key=lambda g: (-counts[g], g))[:size]


def closest(text, profiles, size=300):
    top = most(grams(text or ""), size)
    if not top or not profiles:
        return "und", 0.0
    away = {}
    for lang in sorted(profiles):
        rank = {g: r for r, g in enumerate(profiles[lang])}
        away[lang] = sum(abs(rank[g] - p) if g in rank else size for p, g in enumerate(top))
    best = min(sorted(away), key=away.get)
    return best, 1 - away[best] / (size * len(top))

"""Brute-force versions of the operators, and a table with everything that is awkward."""

import re

import numpy as np
import xxhash

EXTRA = ["keep_id", "kept", "fingerprint", "component_id", "ids", "offsets", "spans", "key", "lang_pred", "bin", "_row", "_text", "seq", "fp", "node"]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def awkward_rows(rng):
    word = lambda: "".join(rng.choice("aeioubcdfgé") for _ in range(rng.randint(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    texts = [prose(rng.randint(1, 120)) for _ in range(40)]
    texts += ["Same Text for MANY rows, É"] * 30 + ["same text for many rows, É", "same text for many rows, é"] * 3
    near = prose(150).split()
    for _ in range(25):  # one word changed each
        other = list(near)
        other[rng.randrange(len(other))] = word()
        texts.append(" ".join(other))
    texts += [None, None, "", "", " \n\t", "123 456 !!", "a" * 70_000, prose(30_000), "x@y.example 10.0.0.1 x@y.example", "日本語 😀 text"]
    rows = [(i, t, rng.choice(["en", "fr", None]), "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "a row without an id", "en", None, None), (None, None, None, None, None)]
    return rows


def awkward(spark, rng):
    rows = [r + tuple("e" for _ in EXTRA) for r in awkward_rows(rng)]
    return spark.createDataFrame(rows, COLUMNS).repartition(5)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_by(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def near_groups(prints):
    """Group number of each fingerprint, by comparing all pairs."""
    f = np.array(prints, np.uint64)
    return groups_by(len(f), [(i, i + 1 + j) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]) <= 4)])


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    return frozenset(" ".join(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def similar(x, y):
    return len(x & y) >= 0.8 * len(x | y)


def wide_fingerprints(shingles):
    """Both 64-bit fingerprints of a set of shingles, as one number of 128 bits."""
    first = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    full, second = 2**64 - 1, []
    for h in first:
        h = (h ^ h >> 31) * 0x9E3779B97F4A7C15 & full
        h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 & full
        second.append(h ^ h >> 32)
    return sum(1 << 64 * k + b for k, hs in enumerate((first, second)) for b in range(64) if 2 * sum(x >> b & 1 for x in hs) > len(hs))


def similar_groups(texts):
    """Group number of each text: similar shingles, searched among those that near fingerprints connect, by all pairs."""
    sets = [shingle_set(t) for t in texts]
    prints = {s: wide_fingerprints(s) for s in set(sets)}
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 15 and (a ^ b).bit_count() <= 27
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if near(prints[sets[i]], prints[sets[j]])]
    loose = groups_by(len(sets), pairs)
    of = {}
    for i, g in enumerate(loose):
        of.setdefault(g, []).append(i)
    return groups_by(len(sets), [(i, j) for m in of.values() for i in m for j in m if j < i and similar(sets[i], sets[j])])


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def private_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end(), kind))
    return sorted(out)

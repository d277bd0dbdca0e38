"""Plain versions of the operators, for comparison on small inputs."""

import hashlib
import re

import xxhash


def fingerprint(text, words=4):
    listed = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))))
    if not listed:
        return 0
    shingles = [b" ".join(listed[k : k + words]) for k in range(max(1, len(listed) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def components(prints, max_bits=4):
    """Smallest id reachable, for a dict of id to fingerprint."""
    parent = {k: k for k in prints}

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= max_bits:
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {k: top(k) for k in ids}


def local_score(item, passage):
    """Smith-Waterman over words: match 1, mismatch and gap -1."""
    best, row = 0, [0] * (len(passage) + 1)
    for word in item:
        new = [0]
        for j, other in enumerate(passage, 1):
            new.append(max(0, row[j - 1] + (1 if word == other else -1), row[j] - 1, new[j - 1] - 1))
        best, row = max(best, *new), new
    return best


def edited(texts):
    """Edited text of each of the texts, which are in ascending order of their ids."""
    out = []
    for k, text in enumerate(texts):
        following = texts[(k + 1) % len(texts)]
        half = len(text) // 2
        out.append(text[: len(text) - half] + following[:half])
    return out


def shingles(text, words=5):
    listed = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(listed[k : k + words]) for k in range(max(1, len(listed) - words + 1))} if listed else set()


def likeness(a, b):
    """Share of the smaller shingle set that the other one has."""
    a, b = shingles(a), shingles(b)
    return len(a & b) / min(len(a), len(b)) if a and b else float(a == b)


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def water_filling(sizes, weights, cap):
    """Targets by sharing the excess again until none is above."""
    total = sum(sizes.values())
    target, left = {}, dict(sizes)
    while left:
        rest = total - sum(target.values())
        share = {s: rest * weights[s] / sum(weights[x] for x in left) for s in left}
        above = [s for s in left if share[s] > cap * sizes[s]]
        if not above:
            return target | share
        for s in above:
            target[s] = float(cap * sizes[s])
            del left[s]
    return target

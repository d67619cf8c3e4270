"""Plain, slow versions that the operators are held against."""

import hashlib
import re

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))


def shingles(text):
    w = words(text)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def components(texts, percent=85):
    """id -> smallest id that links of at least percent % similarity reach."""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def removed(texts, length=100):
    """id -> (bytes, removed, spans, kept bytes), for ids in ascending order."""
    seen, out = set(), {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            w = data[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), len(data) - len(kept), spans, kept)
    return out


def sha(data):
    return hashlib.sha256(data).hexdigest()

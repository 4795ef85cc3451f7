"""Plain Python versions of what the operators compute."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {a: a + 32 for a in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def shingles(text, k):
    w = [x.translate(LOWER) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(len(w) - k, 0) + 1)) if len(w) >= k else frozenset([tuple(w)])


def groups(rows, k, percent):
    """component per row of [(key, text)]: the smallest key reachable."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((key, len(sets[i]), min(keys) if keys and sets[i] else key))
    return out


def repeats(rows, length):
    """(kept bytes, spans) per row of [(key, text)]; null keys are largest."""
    order = lambda k: float("inf") if k is None else k
    data = [(order(k), (t or "").encode()) for k, t in rows]
    least = {}
    for k, b in data:
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            least[s] = min(least.get(s, k), k)
    out = []
    for k, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if least[b[i : i + length]] < k:
                gone[i : i + length] = b"\1" * length
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        out.append((bytes(x for x, g in zip(b, gone) if not g), spans))
    return out

"""Plain forms of the operators' results, for small inputs."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def repeated_windows(rows, width=50):
    first, words = {}, {d: WORD.findall(t or "") for d, t in rows}
    for d, w in words.items():
        for i in range(len(w) - width + 1):
            k = tuple(w[i:i + width])
            first[k] = min(first.get(k, d), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] < d:
                gone.update(range(i, i + width))
        out[d] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def repeated_bytes(rows, depth=400):
    raw, seen = {d: (t or "").encode() for d, t in rows}, defaultdict(int)
    for x in raw.values():
        for i in range(len(x) - depth + 1):
            seen[x[i:i + depth]] += 1
    out = {}
    for d, x in raw.items():
        gone = bytearray(len(x))
        for i in range(len(x) - depth + 1):
            if seen[x[i:i + depth]] > 1:
                gone[i:i + depth] = b"\1" * depth
        out[d] = (len(x), sum(gone), len(re.findall(b"\1+", gone)), bytes(c for c, g in zip(x, gone) if not g))
    return out


def shingle_sets(rows, n=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = {}
    for d, t in rows:
        w = WORD.findall((t or "").translate(lower))
        out[d] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    return out


def components(rows, percent=80):
    sets, parent = shingle_sets(rows), {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def rule_counts(text):
    w, t = WORD.findall(text or ""), text or ""
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen, later = set(), 0
    for x in lines:
        later += x in seen
        seen.add(x)
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    repeated = {k for v in at.values() if len(v) > 1 for i in v for k in range(i, i + 3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), later, len(repeated))

"""Plain versions of the operators' contracts, for small tables."""

import hashlib
import re

import xxhash


def lower(b: bytes) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in b)


def fingerprint(text, k=4):
    w = re.findall(rb"[^\x20\x09-\x0D]+", lower((text or "").encode()))
    if not w:
        return 0
    sh = [b" ".join(w)] if len(w) < k else [b" ".join(w[i: i + k]) for i in range(len(w) - k + 1)]
    h = [xxhash.xxh64(s, 42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def simhash(rows, bits=4, k=4):
    """{doc_id: (hex, component)} of (doc_id, text) rows with distinct ids."""
    rows = sorted(rows)
    fps = [fingerprint(t, k) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= bits]
    root = components(len(rows), links)
    return {d: (f"{fps[i]:016x}", rows[root[i]][0]) for i, (d, _) in enumerate(rows)}


def bench_words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower((text or "").encode()))


def contamination(docs, items, m=10):
    """{doc_id: (n_words, n_hit, items)}"""
    pats = {}
    for i, t in items:
        w = bench_words(t)
        for s in range(max(1, len(w) - m + 1)) if w else ():
            pats.setdefault(tuple(w[s: s + m]), set()).add(str(i))
    sizes = {len(p) for p in pats}
    out = {}
    for d, t in docs:
        w, hit, own = bench_words(t), set(), set()
        for k in sizes:
            for s in range(len(w) - k + 1):
                if (p := tuple(w[s: s + k])) in pats:
                    hit.update(range(s, s + k))
                    own |= pats[p]
        out[d] = (len(w), len(hit), sorted(own))
    return out


def repeats(texts, size):
    """Per text: (kept bytes, number of removed runs, removed bytes)."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d, x in enumerate(data):
        for s in range(len(x) - size + 1):
            seen.setdefault(x[s: s + size], []).append((d, s))
    gone = [bytearray(len(x)) for x in data]
    for at in seen.values():
        if len(at) > 1:
            for d, s in at:
                gone[d][s: s + size] = b"\1" * size
    return [(bytes(c for c, g in zip(x, m) if not g), len(re.findall(b"\1+", bytes(m))), sum(m)) for x, m in zip(data, gone)]


def sha(b) -> str:
    return hashlib.sha256(b).hexdigest()

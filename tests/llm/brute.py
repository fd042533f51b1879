"""Plain single-process versions of the contracts, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if grams[tuple(words[i:i + 5])] > 1:
            hit.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit),
            len(words) < 10 or 100 * len(hit) > 20 * len(words))


def benchmark_hits(text, items):
    words = ITEM_WORD.findall(lower(text))
    hit, ids = set(), set()
    for item_id, item in items:
        own = ITEM_WORD.findall(lower(item))
        m = min(13, len(own))
        for i in range(len(own) - m + 1) if own else ():
            w = own[i:i + m]
            for j in range(len(words) - m + 1):
                if words[j] == w[0] and words[j:j + m] == w:
                    hit.update(range(j, j + m))
                    ids.add(str(item_id))
    return (len(words), len(hit), len(ids), sha(",".join(sorted(ids))),
            len(hit) > 0 and 20 * len(hit) >= len(words))


def base_secret_spans(text):
    text = text or ""
    out = []
    for m in re.finditer(r"""(?ia:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 18:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 16:
            out.append((m.start(), 2, "hex", m.end()))
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def packed_ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()


def shingles(text):
    words = WORD.findall(lower(text))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def components(rows):
    """doc_id -> (set size, smallest linked doc_id), over (doc_id, text)."""
    sets = {d: shingles(t) for d, t in rows}
    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, s in sets.items():
        both = Counter(b for x in s for b in where[x] if b > a)
        for b, n in both.items():
            if 100 * n >= 75 * (len(s) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def removed_bytes(texts, size=400):
    """(bytes, removed, spans, sha of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i:i + size] for b in data for i in range(len(b) - size + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - size + 1):
            if count[b[i:i + size]] > 1:
                gone[i + 1:i + size + 1] = True
        runs = int((gone[1:] & ~gone[:-1]).sum())
        keep = ~gone[1:-1]
        out.append((len(b), int((~keep).sum()), runs, sha(np.frombuffer(b, np.uint8)[keep].tobytes())))
    return out


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def unigram_base(rows):
    """(held out, tokens, known, N, base score) of each (doc_id, text)."""
    toks = [[*WORD.findall(lower(t)), None] for _, t in rows]
    held = [crc(d) % 10 == 0 for d, _ in rows]
    c = Counter(w for h, ts in zip(held, toks, strict=True) if not h for w in ts)
    n, v = sum(c.values()), len(c)
    return [(h, len(ts), sum(c[w] > 0 for w in ts), n,
             sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ts)) for h, ts in zip(held, toks, strict=True)]

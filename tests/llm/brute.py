"""Plain versions of the operators over lists of (doc_id, text), written from their definitions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from math import log10

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, window=10):
    grams = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall((text or "").translate(FOLD))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            grams[tuple(words[i : i + window])].add(str(item))
    sizes, out = {len(g) for g in grams}, []
    for doc, text in docs:
        words = ALNUM.findall((text or "").translate(FOLD))
        hit, seen = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                own = tuple(words[i : i + n])
                if own in grams:
                    hit.update(range(i, i + n))
                    seen |= grams[own]
        out.append((doc, len(words), len(hit), len(seen), sha(",".join(sorted(seen))), bool(hit)))
    return out


def jaccard(docs, width=4, percent=85):
    sets = {}
    for doc, text in docs:
        words = PLAIN.findall((text or "").translate(FOLD))
        n = min(width, len(words))
        sets[doc] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    lists = defaultdict(list)
    for d in ids:
        for s in sets[d]:
            lists[s].append(d)
    for d in ids:
        shared = Counter(o for s in sets[d] for o in lists[s] if o < d)
        for o, n in shared.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[o]) - n):
                a, b = find(d), find(o)
                up[max(a, b)] = min(a, b)
    return [(d, len(sets[d]), find(d)) for d in ids]


def base_scores(docs, modulus=7, held=2):
    end, counts = object(), Counter()
    tokens = {d: [*PLAIN.findall((t or "").translate(FOLD)), end] for d, t in docs}
    for d, words in tokens.items():
        if zlib.crc32(str(d).encode()) % modulus != held:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    return {
        d: (len(w), sum(counts[x] > 0 for x in w), n, sum(log10((counts[x] + 1) / (n + v + 1)) for x in w))
        for d, w in tokens.items()
    }


def repeats(docs, window=50):
    """Kept words of each document."""
    words = {d: PLAIN.findall(t or "") for d, t in docs}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i : i + window]), d)
    out = []
    for d in sorted(words):
        gone = set()
        for i in range(len(words[d]) - window + 1):
            if first[tuple(words[d][i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = [w for i, w in enumerate(words[d]) if i not in gone]
        out.append((d, len(words[d]), len(gone), sha(" ".join(kept))))
    return out


def line_runs(docs, run=4):
    """Lines kept of each document: windows of ``run`` non-blank lines that occur earlier are deleted."""
    lines = {d: (t or "").split("\n") for d, t in docs}
    first, places = {}, {}
    for d in sorted(lines):
        full = [i for i, x in enumerate(lines[d]) if x.strip(" \t\r")]
        for i in range(len(full) - run + 1):
            key = tuple(lines[d][j] for j in full[i : i + run])
            places[d, i] = key, full[i : i + run]
            first.setdefault(key, (d, i))
    gone = defaultdict(set)
    for (d, i), (key, at) in places.items():
        if first[key] != (d, i):
            gone[d].update(at)
    for d in lines:
        for i, x in enumerate(lines[d]):
            if not x.strip(" \t\r") and i and i - 1 in gone[d]:
                gone[d].add(i)
    return {d: [x for i, x in enumerate(lines[d]) if i not in gone[d]] for d in lines}


def line_passages(docs, least=8):
    """Lines kept of each document: runs of non-blank lines of ``least`` words or more, and whole shorter texts, that occur earlier are deleted."""
    lines = {d: (t or "").split("\n") for d, t in docs}
    size = lambda x: max(len([w for w in re.split(r"[ \t\r]+", x.strip(" \t\r"))]), len(x) // 8)
    seen, kept = set(), {}
    for d in sorted(lines):
        full = [i for i, x in enumerate(lines[d]) if x.strip(" \t\r")]
        cut = set()
        for a in range(len(full)):
            words = 0
            for b in range(a + 1, len(full) + 1):
                words += size(lines[d][full[b - 1]])
                run = tuple(lines[d][i] for i in full[a:b])
                if words >= least or b - a == len(full):
                    if run in seen:
                        cut.update(full[a:b])
                    seen.add(run)
                # A longer run consists of units, which have at most ``least`` lines.
                if words >= least and b - a >= least:
                    break
        cut |= {i for i, x in enumerate(lines[d]) if not x.strip(" \t\r") and i - 1 in cut}
        kept[d] = [x for i, x in enumerate(lines[d]) if i not in cut]
    return kept

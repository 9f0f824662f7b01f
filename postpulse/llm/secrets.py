"""Secrets in texts: fixed patterns, and formats learned from what they find by grammatical inference.

The patterns label credentials. Of each kind, at most ``SAMPLE`` distinct ones (those with the smallest hash) are written as sequences of
character classes into a prefix tree; states whose continuations agree by Hoeffding's bound are merged, the most frequent first, which
gives a small probabilistic automaton of the format. Every run of token characters, and every part of it between marks (= / . and
others), is then scored by the automata if it has a letter and a digit and is not shorter than the shortest labelled credential;
one as likely as the labelled ones is added as kind ``format``, unless a pattern has it. Of overlapping ones the leftmost counts, then the longest.

Defined results: NULL and empty texts have no spans; without labelled credentials only the patterns count; equal rows get their
own result; an empty table gives no rows. Offsets are code points, the end excluded. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log, sqrt

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postpulse.llm.common import map_texts

#: Kinds in their order, and the patterns.
KINDS = ("assign", "access", "hex", "format")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]+")
DIGIT, LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
#: Parts of a token begin after one and end before one.
MARKS = frozenset("+/_.=-")

SAMPLE = 600
ALPHA = 0.05
#: Share of the labelled credentials that may score below the threshold.
LOW = 0.05

CLASSES = {c: "d" for c in "0123456789"} | {c: "h" for c in "abcdef"} | {c: "l" for c in "ghijklmnopqrstuvwxyz"}
CLASSES |= {chr(c): "U" for c in range(65, 91)}


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """start, end, kind and credential of the fixed patterns, in order."""
    found = []
    low = text.encode(errors="replace").lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), m.end(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def symbols(value: str) -> str:
    return "".join([CLASSES.get(c, c) for c in value])


@dataclass
class Automaton:
    """States with counts of their visits, ends and moves."""

    visits: list[int] = field(default_factory=lambda: [0])
    ends: list[int] = field(default_factory=lambda: [0])
    moves: list[dict[str, int]] = field(default_factory=lambda: [{}])
    taken: list[dict[str, int]] = field(default_factory=lambda: [{}])
    threshold: float = 0.0
    least: int = 0

    def add(self, word: str) -> None:
        state = 0
        for s in word:
            self.visits[state] += 1
            self.taken[state][s] = self.taken[state].get(s, 0) + 1
            if s not in self.moves[state]:
                self.moves[state][s] = len(self.visits)
                self.visits.append(0)
                self.ends.append(0)
                self.moves.append({})
                self.taken.append({})
            state = self.moves[state][s]
        self.visits[state] += 1
        self.ends[state] += 1

    def score(self, word: str) -> float:
        """Mean log probability of the steps; a step never seen costs as much as one in ten thousand."""
        state, total = 0, 0.0
        for s in word:
            n = self.taken[state].get(s)
            if not n:
                return min(total / len(word), -9.2)
            total += log(n / self.visits[state])
            state = self.moves[state][s]
        total += log(self.ends[state] / self.visits[state]) if self.ends[state] else -9.2
        return total / (len(word) + 1)


    def ends_of(self, word: str, start: int, ends: set[int]) -> Iterator[int]:
        """The ``ends`` up to which ``word`` from ``start`` on is as likely as the labelled ones, in one pass: ``score`` of each part."""
        state, total = 0, 0.0
        for i in range(start, len(word)):
            n = self.taken[state].get(word[i])
            if not n:
                # A part with a step never seen scores -9.2 or less.
                return
            total += log(n / self.visits[state])
            state = self.moves[state][word[i]]
            if i + 1 in ends and i + 1 - start >= self.least:
                last = log(self.ends[state] / self.visits[state]) if self.ends[state] else -9.2
                if (total + last) / (i + 2 - start) >= self.threshold:
                    yield i + 1


def compatible(m: Automaton, a: int, b: int, alpha: float) -> bool:
    stack = [(a, b)]
    factor = sqrt(0.5 * log(2 / alpha))
    while stack:
        a, b = stack.pop()
        n, k = m.visits[a], m.visits[b]
        if not n or not k:
            continue
        bound = factor * (1 / sqrt(n) + 1 / sqrt(k))
        if abs(m.ends[a] / n - m.ends[b] / k) > bound:
            return False
        for s in m.taken[a].keys() | m.taken[b].keys():
            if abs(m.taken[a].get(s, 0) / n - m.taken[b].get(s, 0) / k) > bound:
                return False
            if s in m.moves[a] and s in m.moves[b]:
                stack.append((m.moves[a][s], m.moves[b][s]))
    return True


def fold(m: Automaton, a: int, b: int) -> None:
    """Add the tree at ``b`` to state ``a``."""
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        m.visits[a] += m.visits[b]
        m.ends[a] += m.ends[b]
        for s, n in m.taken[b].items():
            m.taken[a][s] = m.taken[a].get(s, 0) + n
            if s in m.moves[a]:
                stack.append((m.moves[a][s], m.moves[b][s]))
            else:
                m.moves[a][s] = m.moves[b][s]


def infer(words: list[str], alpha: float = ALPHA, low: float = LOW) -> Automaton:
    """Prefix tree of ``words``, with compatible states merged."""
    m = Automaton()
    for word in words:
        m.add(word)
    kept, edge = [0], {(0, s): c for s, c in m.moves[0].items()}
    while edge:
        (parent, s), blue = max(edge.items(), key=lambda e: (m.visits[e[1]], e[0]))
        for red in kept:
            if compatible(m, red, blue, alpha):
                m.moves[parent][s] = red
                fold(m, red, blue)
                break
        else:
            kept.append(blue)
        known = set(kept)
        edge = {(a, s): c for a in kept for s, c in m.moves[a].items() if c not in known}
    scores = sorted(m.score(w) for w in words)
    m.threshold = scores[int(low * len(scores))]
    m.least = min(map(len, words))
    return m


def learn(docs: DataFrame, sample: int = SAMPLE) -> dict[str, Automaton]:
    """An automaton for each kind that occurs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = {(s[2], s[3]) for text in batch["text"] if text for s in base_spans(text)}
            yield pd.DataFrame(sorted(found), columns=["kind", "value"])

    order = Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value")
    labelled = docs.select("text").mapInPandas(run, "kind string, value string").distinct()
    rows = labelled.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample).collect()
    by_kind = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.kind, r.n)):
        by_kind[r.kind].append(symbols(r["value"]))
    return {kind: infer(words) for kind, words in by_kind.items()}


def learned_spans(text: str, base: list[tuple[int, int, str, str]], automata: dict[str, Automaton]) -> list[tuple[int, int, str, str]]:
    found = []
    least = min((a.least for a in automata.values()), default=0)
    for m in TOKEN.finditer(text) if automata else ():
        token, first = m[0], m.start()
        if len(token) < least or not DIGIT.search(token) or not LETTER.search(token):
            continue
        near = [s for s in base if s[0] < m.end() and first < s[1]]
        word, n = symbols(token), len(token)
        starts = [i for i in range(n) if i == 0 or token[i - 1] in MARKS]
        ends = {i for i in range(1, n + 1) if i == n or token[i] in MARKS}
        done = 0
        for i in starts:
            if i < done:
                continue
            for j in sorted({j for a in automata.values() for j in a.ends_of(word, i, ends)}, reverse=True):
                part = token[i:j]
                if DIGIT.search(part) and LETTER.search(part) and not any(s[0] < first + j and first + i < s[1] for s in near):
                    found.append((first + i, first + j, "format", part))
                    done = j
                    break
    return found


SPANS = (
    "array<struct<kind:string,start:int,end:int>>",
    pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])),
)


def scan(docs: DataFrame, automata: dict[str, Automaton]) -> DataFrame:
    """All spans of each row, by start."""
    shared = docs.sparkSession.sparkContext.broadcast(automata)

    def make(texts: list) -> tuple[list]:
        out = []
        for text in texts:
            base = base_spans(text) if text else []
            every = base + (learned_spans(text, base, shared.value) if text else [])
            every.sort(key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
            out.append([{"kind": s[2], "start": s[0], "end": s[1]} for s in every])
        return (out,)

    return map_texts(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), make, {"spans": SPANS})


def find_secrets(docs: DataFrame) -> DataFrame:
    """Learn the formats from all of ``docs`` and scan it."""
    return scan(docs, learn(docs))

"""The same computations on Python lists, for small fixtures."""

from __future__ import annotations

import math
from collections import Counter, defaultdict


class Index:
    """``docs``: doc id → (pattern tokens, length)."""

    def __init__(self, docs):
        self.dl = {d: n for d, (_, n) in docs.items()}
        self.n = len(docs)
        self.avgdl = sum(self.dl.values()) / self.n
        self.lists = defaultdict(dict)
        for d, (tokens, _) in docs.items():
            for t, tf in Counter(tokens).items():
                self.lists[t][d] = tf

    def idf(self, t):
        return math.log(self.n / len(self.lists[t]))

    def norm(self, d):
        weights = [tf[d] / self.dl[d] * self.idf(t) for t, tf in self.lists.items() if d in tf and self.dl[d]]
        return math.sqrt(sum(w * w for w in weights))

    def bm25(self, tokens, k1, b, linked=None):
        scores = defaultdict(float)
        for t in set(tokens):
            if t not in self.lists:
                continue
            df = len(self.lists[t])
            idf = math.log(1 + (self.n - df + 0.5) / (df + 0.5))
            docs = dict(self.lists[t])
            for d, tf in (linked or {}).get(t, {}).items():
                if d in self.dl:
                    docs.setdefault(d, tf)
            for d, tf in docs.items():
                scores[d] += idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * self.dl[d] / self.avgdl))
        return dict(scores)

    def cosine(self, tokens):
        query = {t: c / len(tokens) * math.log10(self.n / (len(self.lists[t]) + 1e-7))
                 for t, c in Counter(tokens).items() if t in self.lists}
        query_norm = math.sqrt(sum(w * w for w in query.values()))
        scores = defaultdict(float)
        for t, w in query.items():
            for d, tf in self.lists[t].items():
                if self.dl[d]:
                    scores[d] += tf / self.dl[d] * self.idf(t) * w
        return {d: s / (self.norm(d) * query_norm) for d, s in scores.items() if self.norm(d) and query_norm}

    def binary(self, tokens):
        scores = Counter()
        for t in tokens:
            scores.update(self.lists.get(t, {}).keys())
        return dict(scores)


def top(scores, n=None):
    """[(doc, score)] best first, scores rounded before ranking."""
    rounded = [(d, round(s, 6)) for d, s in scores.items()]
    return sorted(rounded, key=lambda x: (-x[1], x[0]))[:n]


def scale(hits):
    low, high = min(s for _, s in hits), max(s for _, s in hits)
    return [(d, (s - low) / (high - low) if high > low else 0.0) for d, s in hits]


def fuse(lists, weights, n, require_all):
    if require_all and not all(lists):
        return []
    total = defaultdict(float)
    for hits, weight in zip(lists, weights):
        for d, s in scale(hits) if hits else []:
            total[d] += weight * s
    return top(total, n)


def average_precision(truth, predicted, k=40, inner=None):
    found = []
    for i, d in enumerate(predicted[:k]):
        if d in truth:
            value = sum(p in truth for p in predicted[:i + 1]) / (i + 1)
            found.append(round(value, inner) if inner else value)
    return sum(found) / len(found) if found else 0.0

"""Quality classifier: an additive model with pairwise interactions.

Every feature is cut into bins, and boosting goes round the features in a
cycle: a tree of a few leaves on one feature takes a small step on what is left
of the error. All trees of a feature add up to one lookup table. Then the pairs
of features that explain most of the rest get tables of their own, by trees
with one cut on each of the two. A score is a sum of looked-up values.

The tables are fitted on at most ``sample`` labelled rows, those with the
smallest hash of their id and text; only their features come to the driver. An
id that repeats in the documents brings no more rows than that. Features and
scores of all rows are made in one pass over the whole texts, without a shuffle.

Defined cases: null text is empty text; empty texts have all features 0 and a
score. Without labelled rows every score is one half. Labels that are null do
not count; a document that is labelled twice counts twice. Repeated rows score
alike. Extra columns are carried along where asked for; names that start with
two underscores are reserved.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import map_batches

FEATURES = [
    "log_bytes", "log_words", "word_length", "word_length_spread", "upper", "lower", "digit", "blank", "beyond_ascii", "exclaim", "bars", "signs",
    "stops", "byte_entropy", "distinct_words", "top_word", "next_same", "distinct_triples", "top_triple", "long_words", "log_lines", "line_length",
    "distinct_lines", "end_marks", "capital_words", "packed_size",
]
_KIND = {name: np.isin(np.arange(256), list(chars)) for name, chars in {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": bytes(range(48, 58)), "blank": b" \t\n\r", "exclaim": b"!", "bars": b"|",
    "signs": b"#$%&*+<=>@^_~{}[]\\/", "stops": b".,;:?"}.items()}


def features(text: bytes | None) -> list[float]:
    """The FEATURES of a whole text."""
    if not text:
        return [0.0] * len(FEATURES)
    n = len(text)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = {k: float(seen[m].sum()) / n for k, m in _KIND.items()}
    p = seen[seen > 0] / n
    raw = text.split()
    words = text.lower().split()
    w = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    tally = Counter(words)
    triples = Counter(zip(words, words[1:], words[2:]))
    t = max(1, len(words) - 2)
    lines = text.split(b"\n")
    return [
        float(np.log1p(n)), float(np.log1p(len(words))), float(sizes.mean()), float(sizes.std()), share["upper"], share["lower"], share["digit"],
        share["blank"], float(seen[128:].sum()) / n, share["exclaim"], share["bars"], share["signs"], share["stops"], float(-(p * np.log2(p)).sum()),
        len(tally) / w, max(tally.values(), default=0) / w, sum(map(eq, words, words[1:])) / w, len(triples) / t,
        max(triples.values(), default=0) / t, float((sizes > 20).sum()) / w, float(np.log1p(len(lines))), n / len(lines), len(set(lines)) / len(lines),
        sum(x.rstrip().endswith((b".", b"?", b"!")) for x in lines) / len(lines), sum(x[:1].isupper() for x in raw) / w,
        len(zlib.compress(text, 1)) / n,
    ]


@dataclass
class Model:
    """Lookup tables: a score is sigmoid(base + one value per feature + one per pair)."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            total += t[np.searchsorted(e, x[:, j], "right")]
        for (i, j), t in self.pairs.items():
            total += t[np.searchsorted(self.pair_edges[i], x[:, i], "right"), np.searchsorted(self.pair_edges[j], x[:, j], "right")]
        return sigmoid(total)


def sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def cuts(x: np.ndarray, bins: int) -> np.ndarray:
    """Inner bin edges: quantiles, each once."""
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)


def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Value of each bin: the bins in order, cut ``leaves`` - 1 times where it gains most."""
    parts = [(0, len(g))]
    for _ in range(leaves - 1):
        best = (1e-9, None, None)
        for a, b in parts:
            cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
            if b - a > 1:
                win = gain(cg[:-1], ch[:-1]) + gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - gain(cg[-1], ch[-1])
                k = int(win.argmax())
                if win[k] > best[0]:
                    best = (win[k], (a, b), a + k + 1)
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def cross_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best tree with one cut on each of two features."""
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def quarters(c):
        a = c[:-1, :-1]
        return a, c[:-1, -1:] - a, c[-1:, :-1] - a, c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + a

    qg, qh = quarters(cg), quarters(ch)
    win = sum(gain(x, y) for x, y in zip(qg, qh)) - gain(cg[-1, -1], ch[-1, -1])
    i, j = np.unravel_index(win.argmax(), win.shape)
    out = np.empty(g.shape)
    for x, y, rows, cols in zip(qg, qh, (slice(0, i + 1), slice(0, i + 1), slice(i + 1, None), slice(i + 1, None)),
                                (slice(0, j + 1), slice(j + 1, None), slice(0, j + 1), slice(j + 1, None))):
        out[rows, cols] = x[i, j] / (y[i, j] + 1.0)
    return float(win[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 150, rate: float = 0.1, leaves: int = 3, pairs: int = 12,
        pair_bins: int = 12, pair_rounds: int = 60) -> Model:
    """Boost cyclically over the features, then over the strongest pairs."""
    k, n = x.shape[1], len(y)
    base = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    edges, wide = [cuts(x[:, j], bins) for j in range(k)], [cuts(x[:, j], pair_bins) for j in range(k)]
    code = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(wide)]
    tables, total = [np.zeros(len(e) + 1) for e in edges], np.full(n, base)
    for _ in range(rounds if n else 0):
        for j in range(k):
            p = sigmoid(total)
            g = np.bincount(code[j], y - p, len(tables[j]))
            h = np.bincount(code[j], p * (1 - p), len(tables[j]))
            step = rate * shallow_tree(g, h, leaves)
            tables[j] += step
            total += step[code[j]]

    def grid(i, j):
        shape = len(wide[i]) + 1, len(wide[j]) + 1
        cell, p = coarse[i] * shape[1] + coarse[j], sigmoid(total)
        size = shape[0] * shape[1]
        return np.bincount(cell, y - p, size).reshape(shape), np.bincount(cell, p * (1 - p), size).reshape(shape)

    ranked = sorted(combinations(range(k), 2), key=lambda ij: -cross_tree(*grid(*ij))[0]) if n else []
    chosen = {ij: np.zeros((len(wide[ij[0]]) + 1, len(wide[ij[1]]) + 1)) for ij in ranked[:pairs]}
    for _ in range(pair_rounds):
        for (i, j), table in chosen.items():
            step = rate * cross_tree(*grid(i, j))[1]
            table += step
            total += step[coarse[i], coarse[j]]
    return Model(base, edges, tables, wide, chosen)


def held_out(id_col: str = "doc_id"):
    """Rows that no model learns from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample: int = 20_000, **how) -> Model:
    """Fit on at most ``sample`` labelled rows outside the held-out fifth."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("__y"))
    known = known.orderBy(F.xxhash64("__id"), "__id", "__y").limit(sample)
    rows = docs.join(F.broadcast(known), docs[id_col] == known["__id"]).select(
        "__id", "__y", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("__sig"), F.col(text_col).cast("binary").alias("__text"))

    def look(batches):
        for batch in batches:
            x = [features(t.as_py()) for t in batch.column("__text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("__id", "__sig", "__y")), pa.array(x, pa.list_(pa.float64()))], ["id", "sig", "y", "x"])

    got = map_batches(rows, look, "id long, sig long, y int, x array<double>")
    got = got.orderBy(F.xxhash64("id"), "id", "sig", "y").limit(sample).select("y", "x").toPandas()
    # the order of rows must not matter to the sums
    x = np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES))
    y = got["y"].to_numpy(float)
    by = np.lexsort((*x.T, y)) if len(y) else slice(None)
    return fit(x[by], y[by], **how)


def score(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (default all) plus __score, between 0 and 1."""
    carry = docs.columns if carry is None else carry
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*carry, F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("__text"))
    out = rows.drop("__text").schema.add("__score", "double")

    def look(batches):
        model = shared.value
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column("__text")], float).reshape(-1, len(FEATURES))
            cols = [batch.column(c) for c in batch.schema.names[:-1]]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(model.score(x))], out.names)

    return map_batches(rows, look, out)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, by a model learned from their own labels."""
    return score(docs, learn(docs, labels, id_col, text_col, **how), text_col).where(F.col("__score") >= threshold).drop("__score")

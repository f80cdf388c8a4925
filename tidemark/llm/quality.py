"""Quality scores from a sparse rule ensemble.

Texts become a few statistics. Shallow trees, boosted on labelled rows,
propose rules: every path from a root to a node is a conjunction of
comparisons. A lasso logistic regression over the rules keeps few of them,
and those are compiled into one Spark column expression.

The statistics of every document are computed; the fit uses at most SAMPLE
labelled rows of them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import key_text, python_stage
from tidemark.llm.language import fold
from tidemark.session import materialize

#: documented bound of the labelled rows that the ensemble is fitted on
SAMPLE = 20_000
TREES, DEPTH, BINS, LEAF = 30, 3, 32, 20
PENALTY = 5e-4

STATISTICS = ("log_words", "word_length", "word_spread", "upper", "digit", "punctuation", "symbol", "space",
              "non_ascii", "distinct_words", "top_word", "same_next", "line_words", "same_lines", "marked_words",
              "symbol_words", "sentence_ends")

#: fixed classes of the bytes: 1 upper, 2 lower, 3 digit, 4 punctuation,
#: 5 symbol, 6 space, 7 part of a non-ASCII character, 0 control
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 7
_CLASS[[ord(c) for c in ".,;:'\"()?-"]] = 4
_CLASS[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 5
_CLASS[[9, 10, 11, 12, 13, 32]] = 6
_SYMBOLS = frozenset(b"!#$%&*+/<=>@[\\]^_`{|}~")


def statistics(text: str) -> list[float]:
    """STATISTICS of one whole text; all 0 for a text without words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    share = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=8) / len(raw)
    lengths = np.fromiter(map(len, words), np.int64, n)
    seen = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [
        float(np.log1p(n)), float(lengths.mean()), float(lengths.std()), *map(float, share[[1, 3, 4, 5, 6, 7]]),
        len(seen) / n, max(seen.values()) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        float(np.log1p(n / len(lines))), 1 - len(set(lines)) / len(lines),
        sum(w[-1] in b".,;:!?" for w in words) / n,
        sum(w[-1] in _SYMBOLS for w in words) / n,
        sum(w[-1] in b".!?" for w in words) / n,
    ]


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the STATISTICS of each text (NULL: empty)."""
    source = key_text(docs, id_col, text_col)
    python_stage(docs.sparkSession)
    schema = T.StructType([source.schema["doc_id"], *[T.StructField(s, T.DoubleType()) for s in STATISTICS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(1)]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(np.ascontiguousarray(c)) for c in x.T]],
                                             schema.names)

    return source.mapInArrow(run, schema)


class Rule(NamedTuple):
    """All of ``(statistic, above, threshold)`` hold."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for s, above, t in self.terms:
            out &= (x[:, s] > t) if above else (x[:, s] <= t)
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for s, above, t in self.terms:
            c = F.col(STATISTICS[s])
            out = out & ((c > F.lit(t)) if above else (c <= F.lit(t)))
        return out


class Ensemble(NamedTuple):
    bias: float
    rules: list[tuple[Rule, float]]

    def column(self) -> Column:
        """The probability of label 1 as a Spark expression."""
        z = F.lit(float(self.bias))
        for rule, weight in self.rules:
            z = z + F.when(rule.column(), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + sum(w * r.holds(x) for r, w in self.rules))))


def _tree(codes: np.ndarray, edges: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, columns: np.ndarray,
          rows: np.ndarray) -> tuple[list[tuple], np.ndarray]:
    """Paths of one tree fitted to the gradient, and its step per row."""
    paths: list[tuple] = []
    step = np.zeros(len(grad))

    def grow(rows: np.ndarray, path: tuple, depth: int) -> None:
        g, h = grad[rows].sum(), hess[rows].sum() + 1
        best = (1e-6, None, None)
        if depth < DEPTH and len(rows) >= 2 * LEAF:
            for c in columns:
                code = codes[rows, c]
                gs = np.bincount(code, grad[rows], minlength=BINS).cumsum()[:-1]
                hs = np.bincount(code, hess[rows], minlength=BINS).cumsum()[:-1]
                ns = np.bincount(code, minlength=BINS).cumsum()[:-1]
                gain = gs ** 2 / (hs + 1) + (g - gs) ** 2 / (h - hs) - g ** 2 / h
                gain[(ns < LEAF) | (len(rows) - ns < LEAF)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0] and k < len(edges[c]):
                    best = (gain[k], int(c), k)
        _, c, k = best
        if c is None:
            step[rows] = g / h
            return
        below = codes[rows, c] <= k
        for side, above in ((rows[below], False), (rows[~below], True)):
            to = (*path, (c, above, float(edges[c][k])))
            paths.append(to)
            grow(side, to, depth + 1)

    grow(rows, (), 0)
    return paths, step


def _simplest(path: tuple) -> tuple:
    """The path with one term for each statistic and direction."""
    tight: dict[tuple[int, bool], float] = {}
    for s, above, t in path:
        old = tight.get((s, above))
        tight[s, above] = t if old is None else (max(old, t) if above else min(old, t))
    return tuple(sorted((s, above, t) for (s, above), t in tight.items()))


def propose(x: np.ndarray, y: np.ndarray, seed: int = 5) -> list[Rule]:
    """Distinct rules from the paths of boosted trees."""
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    codes = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    margin = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    rules: dict[tuple, None] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        columns = rng.choice(x.shape[1], size=max(1, x.shape[1] * 2 // 3), replace=False)
        rows = np.nonzero(rng.random(len(y)) < 0.7)[0]
        paths, step = _tree(codes, edges, y - p, p * (1 - p) + 1e-3, columns, rows)
        margin += 0.3 * step
        rules.update((_simplest(path), None) for path in paths)
    return [Rule(r) for r in rules]


def lasso(r: np.ndarray, y: np.ndarray, penalty: float = PENALTY, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an l1 penalty on the weights (accelerated
    proximal gradient steps)."""
    n = len(y)
    a = np.concatenate([np.ones((n, 1), np.float32), r.astype(np.float32)], axis=1)
    v = np.ones(a.shape[1], np.float32)
    for _ in range(20):  # the largest curvature, by power iteration
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v)
    rate = 4 * n / max(float(np.linalg.norm(a @ v) ** 2), 1e-9) / 1.05
    w = z = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(a @ z.astype(np.float32)).astype(float)))
        new = z - rate * (a.T @ (p - y).astype(np.float32)).astype(float) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """The ensemble for statistics ``x`` and labels ``y``; without both labels
    it answers with the only one (or one half)."""
    if len(y) < 2 * LEAF or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Ensemble(float(np.log(share / (1 - share))), [])
    rules = propose(x, y)
    held = [(r, r.holds(x)) for r in rules]
    held = [(r, h) for r, h in held if LEAF <= h.sum() <= len(y) - LEAF]
    bias, weights = lasso(np.stack([h for _, h in held], axis=1) if held else np.zeros((len(y), 0)), y)
    return Ensemble(bias, [(r, float(w)) for (r, _), w in zip(held, weights) if abs(w) > 1e-4])


def train(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Ensemble:
    """Fits on the labelled rows of ``stats`` (at most SAMPLE, picked by the
    hash of id and label, a repeated label once); NULL ids and labels are left
    out, all labels of an id count."""
    known = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("double").alias("__y")).where(
        "__id is not null and __y is not null").withColumn(
        "__u", F.xxhash64(F.col("__id").cast("string"), F.col("__y").cast("string"), F.lit("sample")))
    # only about the sample leaves the tasks
    share = min(1.0, 1.5 * SAMPLE / max(1, known.agg(F.approx_count_distinct("__u")).first()[0]))
    near = known.where(F.pmod(F.col("__u"), F.lit(1 << 30)) < int(share * (1 << 30))).dropDuplicates(["__u"])
    picked = F.broadcast(near.orderBy("__u", "__id").limit(SAMPLE))
    rows = stats.join(picked, stats.doc_id == picked["__id"]).select("__u", "__y", *STATISTICS)
    rows = rows.orderBy("__u", "__y", *STATISTICS).limit(SAMPLE).toPandas()  # at most SAMPLE rows of numbers
    return fit(rows[list(STATISTICS)].to_numpy(float).reshape(-1, len(STATISTICS)), rows["__y"].to_numpy(float))


def score(stats: DataFrame, model: Ensemble) -> DataFrame:
    """``doc_id, score, predicted`` from the compiled rules alone.

    Defined cases: NULL and wordless texts have statistics 0 and are scored
    like any other; repeated rows and equal statistics get equal scores, and a
    score of exactly one half is label 1; ids may be NULL; statistics cover
    texts of any length whole; other columns are ignored and don't come back;
    an empty table gives an empty result; without usable labels every score is
    the share of label 1 (one half without any).
    """
    s = stats.select("doc_id", model.column().alias("score"))
    return s.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's digest: learns only where crc32(doc_id) mod 3 is not 1."""
    stats = materialize(with_statistics(docs), name="quality-statistics")
    model = train(stats, labels.where(fold(F.col("doc_id"), 3) != 1))
    out = score(stats, model)
    return out.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")

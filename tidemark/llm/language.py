"""Language identification by nearest centroid over TF-IDF character n-grams.

A text becomes a unit vector of log-scaled, IDF-weighted counts of the
letter 1- to 3-grams inside its words (hashed into DIMS columns). Each
language has several centroids, clustered from its training vectors by
spherical k-means. The most similar centroid (cosine) names the language; a
text much farther from it than nearly all held-out training texts of that
language and of its length is rejected.

Document frequencies are counted over all training documents; the clustering
uses a sample of at most SAMPLE documents per language, the rejection other
HELD documents and excerpts of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import python_stage, row_key
from tidemark.operators.lookup import bounded_broadcast
from tidemark.session import materialize

DIMS = 1 << 13
CENTROIDS = 3
#: documented bounds of the clustering sample and of the texts outside it
SAMPLE, HELD = 600, 400
#: centroids that are dense at a time; the others stay sparse
DENSE = 600
#: rejected: less similar than SLACK times this quantile of the held-out
#: training texts of the language and length class; a class with fewer than
#: EVIDENCE of them takes the floor of the next shorter one
QUANTILE, SLACK, EVIDENCE = 0.05, 0.5, 20
CLASSES = 10
UNKNOWN = "und"
_BLOCK = 1 << 18


def _letter_codes() -> np.ndarray:
    """Code point (BMP) -> code of its lower-case letter, 0 for non-letters."""
    table = np.zeros(0x10000, np.uint32)
    for c in range(0x10000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low[0]) if len(low) else c
    return table


_TABLE: list[np.ndarray] = []


def _codes(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_letter_codes())
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    low = _TABLE[0][np.minimum(raw, 0xFFFF)]
    # letters beyond the BMP keep their own code
    beyond = np.nonzero(raw > 0xFFFF)[0]
    if len(beyond):
        low = low.copy()
        for i in beyond:
            low[i] = raw[i] if chr(raw[i]).isalpha() else 0
    return low


def counts(text: str) -> np.ndarray | None:
    """Counts of the hashed letter 1- to 3-grams; word edges count as a
    letter, grams never span two words. NULL without any letter."""
    total = np.zeros(DIMS, np.int64)
    letters = False
    for at in range(0, len(text), _BLOCK):  # whole text, in bounded blocks (two characters overlap)
        c = _codes(text[max(0, at - 2):at + _BLOCK])
        first = 2 if at else 0
        if not c[first:].any():
            continue
        letters = True
        c = c.astype(np.uint64)
        if not at:
            c = np.concatenate([np.zeros(1, np.uint64), c])
            first = 1
        if at + _BLOCK >= len(text):
            c = np.concatenate([c, np.zeros(1, np.uint64)])
        a, b = c[first:], c[first - 1:-1]
        one = a[a > 0]
        two = (b * np.uint64(0x9E3779B1) + a)[(a > 0) | (b > 0)]
        g, h, i = c[:-2], c[1:-1], c[2:]
        inner = h > 0
        three = ((g * np.uint64(0x85EBCA77) + h) * np.uint64(0xC2B2AE3D) + i)[inner]
        for grams, salt in ((one, 1), (two, 2), (three, 3)):
            mixed = (grams + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
            total += np.bincount((mixed >> np.uint64(51)).astype(np.int64), minlength=DIMS)
    return total if letters else None


def _unit(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(x).astype(np.float32) * idf
    return v / max(float(np.linalg.norm(v)), 1e-9)


def _length_class(n: float) -> int:
    """Texts of like numbers of grams share a rejection threshold."""
    return min(CLASSES - 1, int(np.log2(max(1.0, n))) // 2)


def excerpts(text: str) -> Iterator[str]:
    """Parts from the middle of a text, one for each shorter length class."""
    size = 4
    while size < len(text):
        at = (len(text) - size) // 2
        yield text[at:at + size]
        size *= 4


def _floors(sizes: list[int], best: np.ndarray) -> np.ndarray:
    """The floor of each length class from the numbers of grams and the
    similarities of held-out texts; NaN where no text of the class or of a
    shorter one tells."""
    classes = np.array([_length_class(n) for n in sizes], np.int64)
    out = np.full(CLASSES, np.nan)
    for k in range(CLASSES):
        mine = best[classes == k]
        if len(mine) >= EVIDENCE:
            out[k] = SLACK * np.quantile(mine, QUANTILE)
        elif k:  # longer texts are more similar, so the floor holds for them too
            out[k] = out[k - 1]
    return out


def _filled(floors: np.ndarray) -> np.ndarray:
    """``floors`` (one row per centroid) without NaN: a class that a language
    cannot tell takes the least floor of the others; where none can, nothing
    is rejected by distance."""
    least = np.where(np.isnan(floors), np.inf, floors).min(0)
    return np.where(np.isnan(floors), np.where(np.isinf(least), 0.0, least), floors)


class Model:
    """Unit centroids with their languages, IDF weights and, for each centroid
    and length class, the similarity below which a text is rejected. The
    centroids are rows of ``(columns, values)``, as many as there are."""

    def __init__(self, idf: np.ndarray, centroids: list[tuple[np.ndarray, np.ndarray]], languages: list[str], floor: np.ndarray):
        self.idf, self.centroids, self.languages, self.floor = idf, centroids, languages, floor
        self.held: tuple[int, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "held": None}  # dense blocks do not travel

    def _block(self, at: int) -> np.ndarray:
        """Centroids ``at`` to ``at + DENSE``, dense; the last block is kept."""
        if self.held is None or self.held[0] != at:
            rows = self.centroids[at:at + DENSE]
            dense = np.zeros((len(rows), DIMS), np.float32)
            for row, (columns, values) in zip(dense, rows):
                row[columns] = values
            self.held = at, dense
        return self.held[1]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """``(language, score, rejected)``; no letter: unknown, 0, rejected."""
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """:meth:`predict` of several texts, each block of centroids once."""
        out: list[tuple[str, float, bool]] = []
        for at in range(0, len(texts), 256):
            found = [counts(t) if t and self.languages else None for t in texts[at:at + 256]]
            units = [None if x is None else _unit(x, self.idf) for x in found]
            best = [(-1.0, 0)] * len(found)
            for block in range(0, len(self.centroids), DENSE):
                c = self._block(block)
                for i, u in enumerate(units):
                    if u is not None:
                        s = c @ u
                        k = int(s.argmax())
                        if s[k] > best[i][0]:  # equal ones go to the first
                            best[i] = s[k], block + k
            for x, (s, k) in zip(found, best):
                out.append((UNKNOWN, 0.0, True) if x is None else
                           (self.languages[k], float(min(1.0, max(0.0, s))), bool(s < self.floor[k, _length_class(x.sum())])))
        return out


def _kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from spread-out, deterministic starts."""
    mean = x.mean(0)
    centers = [x[int((x @ mean).argmax())]]
    while len(centers) < min(k, len(x)):
        centers.append(x[int(np.max(x @ np.array(centers).T, axis=1).argmin())])
    c = np.array(centers)
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        c = np.array([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c.astype(np.float32)


def document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """Over all training texts: in how many each column occurs. Every task
    sends one row per column at most."""
    python_stage(train.sparkSession)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for t in batch.column(0):
                x = counts(t.as_py())
                if x is not None:
                    df += x > 0
                    n += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMS)), pa.array(np.concatenate([[n], df]))], ["k", "n"])

    parts = train.select("text").mapInArrow(tally, "k bigint, n bigint")
    rows = parts.groupBy("k").agg(F.sum("n").alias("n")).collect()  # DIMS + 1 rows
    out = np.zeros(DIMS, np.int64)
    n = 0
    for r in rows:
        if r.k < 0:
            n = r.n
        else:
            out[r.k] = r.n
    return out, n


def train(labelled: DataFrame) -> Model:
    """Fits on ``(text, lang, doc_id)`` rows; NULL texts and languages are
    left out. The sample is drawn by the hash of id and text, so rows that
    share an id (or have none) are told apart; a repeated row is drawn once.
    Every language that has a text with a letter is learned."""
    known = F.xxhash64(F.col("doc_id").cast("string"), "text")
    rows = labelled.where("text is not null and lang is not null").select(
        "text", F.col("lang").cast("string").alias("lang"),
        (F.pmod(F.xxhash64(known, F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("u"),
        (F.pmod(F.xxhash64(known, F.lit("held")), F.lit(5)) < 2).alias("held"), known.alias("key"))
    spark = labelled.sparkSession
    df, n = document_frequencies(rows)
    idf = (np.log((1 + n) / (1 + df)) + 0.1).astype(np.float32)
    # a share of each language that gives about SAMPLE and HELD rows, cut below;
    # languages that are small enough are taken whole, without a row here
    many = 1.5 * (SAMPLE + HELD)
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("key").alias("n"),
                                     F.max(F.col("text").rlike(r"\p{L}")).alias("letters")).collect()  # a row per language
    shares = spark.createDataFrame([(r.lang, many / r.n) for r in sizes if r.n > many], "lang string, share double")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, u, held, v = [], [], [], []
            for i in range(batch.num_rows):
                text, out = batch.column(0)[i].as_py(), batch.column(3)[i].as_py()
                x = counts(text)
                if x is not None:
                    lang.append(batch.column(1)[i].as_py())
                    u.append(batch.column(2)[i].as_py())
                    held.append(out)
                    parts = [y for e in excerpts(text) if (y := counts(e)) is not None] if out else []
                    v.append([_packed(y) for y in (x, *parts)])
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(u, pa.float64()), pa.array(held, pa.bool_()),
                                              pa.array(v, pa.list_(pa.binary()))], ["lang", "u", "held", "v"])

    picked = rows.join(bounded_broadcast(shares), "lang", "left").where(F.col("u") < F.coalesce("share", F.lit(1.0))).select(*rows.columns)
    weights = spark.sparkContext.broadcast(idf)

    def fit(key: tuple, pdf):  # one language in memory at a time, of SAMPLE and HELD rows at most
        import pandas as pd

        pdf = pdf.sort_values(["held", "r"])
        c, floor = _fit(zip(pdf["held"], pdf["v"]), weights.value)
        return pd.DataFrame({"lang": [key[0]] * len(c), "k": range(len(c)), "c": [_sparse(x) for x in c],
                             "floor": [floor.tolist()] * len(c)})

    def fitted(texts: DataFrame) -> list:
        sample = (texts.dropDuplicates(["lang", "key"]).select("text", "lang", "u", "held")
                  .mapInArrow(vectors, "lang string, u double, held boolean, v array<binary>")
                  .withColumn("r", F.row_number().over(_by_lang()))
                  .where(F.col("r") <= F.when(F.col("held"), HELD).otherwise(SAMPLE)))
        return sample.groupBy("lang").applyInPandas(fit, "lang string, k int, c binary, floor array<double>").collect()

    learned = fitted(picked)  # CENTROIDS sparse rows a language
    missing = {r.lang for r in sizes if r.letters} - {r.lang for r in learned}
    if missing:  # none of the drawn texts had a letter: all texts of these languages are looked at
        learned += fitted(rows.join(bounded_broadcast(spark.createDataFrame([(x,) for x in sorted(missing)], "lang string")), "lang"))
    learned.sort(key=lambda r: (r.lang, r.k))
    if not learned:
        return Model(idf, [], [], np.zeros((0, CLASSES)))
    floors = _filled(np.array([[np.nan if x is None else x for x in r.floor] for r in learned], float))
    return Model(idf, [_columns(r.c) for r in learned], [r.lang for r in learned], floors)


def _sparse(c: np.ndarray) -> bytes:
    at = np.nonzero(c)[0]
    return at.astype("<u4").tobytes() + c[at].astype("<f4").tobytes()


def _columns(v: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw, n = bytes(v), len(v) // 8
    return np.frombuffer(raw, "<u4", n).astype(np.uint16), np.frombuffer(raw, "<f4", n, 4 * n)


def _packed(x: np.ndarray) -> bytes:
    at = np.nonzero(x)[0]  # only the columns that occur travel
    return np.concatenate([at, np.minimum(x[at], 0xFFFFFFFF)]).astype("<u4").tobytes()


def _unpacked(v: bytes) -> np.ndarray:
    pairs = np.frombuffer(bytes(v), "<u4").reshape(2, -1)
    x = np.zeros(DIMS, np.int64)
    x[pairs[0]] = pairs[1]
    return x


def _fit(rows: Iterator[tuple[bool, list[bytes]]], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and floors of one language from its packed texts, those to
    cluster before the held-out ones. With held-out texts alone they are
    clustered, and the floors stay open."""
    sample, held = [], []
    for out, v in rows:
        (held if out else sample).append(v)
    if not sample:
        sample, held = held, []
    unit = np.empty((len(sample), DIMS), np.float32)
    for i, v in enumerate(sample):
        unit[i] = _unit(_unpacked(v[0]), idf)
    c = _kmeans(unit, CENTROIDS)
    sizes, best = [], []
    for v in held:
        for x in map(_unpacked, v):
            sizes.append(int(x.sum()))
            best.append(float((c @ _unit(x, idf)).max()))
    return c, _floors(sizes, np.array(best))


def _by_lang():
    from pyspark.sql import Window

    return Window.partitionBy("lang", "held").orderBy("u", "v")


def fold(doc_id: Column, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; a NULL id counts as empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % folds


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (the columns in ``keep``, by default all) with ``lang_pred``,
    ``score`` and ``rejected``, from the text alone.

    Defined cases: NULL, empty and letterless texts are ``und`` with score 0
    and rejected; equal similarities go to the first centroid; repeated rows
    get equal answers; ids may be NULL or repeat; a text of any length is
    counted whole, in blocks; an empty table gives an empty result; columns
    named like the answers are replaced, others kept whatever their names.
    """
    spark = docs.sparkSession
    python_stage(spark)
    answers = ("lang_pred", "score", "rejected")
    names = [c for c in (keep or docs.columns) if c not in answers]
    # any column name goes through Python under a plain one
    source = docs.select(F.col(text_col).alias("__text"), *[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(names)])
    schema = T.StructType([*source.schema.fields[1:], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    shared = spark.sparkContext.broadcast(model)  # sparse centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = shared.value.predict_all
        for batch in batches:
            got = predict(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_())], schema.names)

    return source.mapInArrow(run, schema).toDF(*names, *answers)


def train_on_fold(docs: DataFrame) -> Model:
    """The contract's split: learns only where crc32(doc_id) mod 4 is not 2."""
    return train(docs.select("text", "lang", "doc_id").where(fold(F.col("doc_id"), 4) != 2))


def op9_language_id(docs: DataFrame) -> DataFrame:
    """The contract's digest of :func:`identify`."""
    out = identify(docs.select("doc_id", "text"), train_on_fold(docs), keep=["doc_id"])
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def drop_rejected(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, without the documents that the model
    trained on their own training fold rejects. Only texts pass through
    Python, and only the keys of rejected rows come back; the rows themselves
    stay where they are.

    Defined cases: as for :func:`identify`; NULL, empty and letterless texts
    go; rows of equal id and text share their answer.
    """
    model = train_on_fold(docs)
    keyed = docs.select(*row_key(F.col("doc_id"), F.coalesce("text", F.lit(""))), "text")
    rejected = identify(keyed, model, keep=["__k1", "__k2"]).where("rejected").select("__k1", "__k2")
    rejected = materialize(rejected.distinct(), name="language-rejected")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    rows = docs.select(whole, *row_key(F.col("doc_id"), F.coalesce("text", F.lit(""))))
    return rows.join(bounded_broadcast(rejected), ["__k1", "__k2"], "left_anti").select("__row.*")

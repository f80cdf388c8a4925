"""Product codes of integer vectors, searched in the Walsh-Hadamard domain.

A vector becomes integers and is cut into parts; each part position has a
small codebook that a few rounds of nearest-entry assignment refine. Parts and
entries are zero-padded to a power of two and go through the unnormalised
integer Walsh-Hadamard transform, which multiplies squared distances by its
length and gathers most of a difference in the first coefficients of sequency
order. Squared differences are summed in that order; an entry is out as soon
as its partial sum exceeds the whole distance of another one. All numbers are
integers, so every decision is exact.

A round is one pass over the vectors: tasks add up parts per entry, Spark adds
up the tasks, and only the codebooks (``entries`` times the dimension) meet on
the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import join_groups, python_stage
from tidemark.session import materialize

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: integers beyond this saturate, and so does an error beyond a long
LIMIT = 1 << 40
_LONG = (1 << 63) - 1
#: rows whose integers one partial sum may hold in 64 bits
_FLUSH = 1 << 20


def sequency(size: int) -> np.ndarray:
    """The places of the natural-order transform by rising number of sign changes."""
    signs = np.ones((1, 1), np.int64)
    while len(signs) < size:
        signs = np.block([[signs, signs], [signs, -signs]])
    return np.argsort((np.diff(signs, axis=1) != 0).sum(axis=1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the rows in sequency order, rows padded
    with zeros to a power of two. Squared lengths grow by that power."""
    n, width = x.shape
    size = 1 << max(0, width - 1).bit_length()
    if size > width:
        x = np.concatenate([x, np.zeros((n, size - width), x.dtype)], axis=1)
    half = 1
    while half < size:
        x = x.reshape(n, size // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        half *= 2
    return x.reshape(n, size)[:, sequency(size)]


def _exact(width: int, *arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays in 64 bits where every sum of squares fits, else in Python's
    unbounded integers."""
    size = 1 << max(0, width - 1).bit_length()
    top = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    return list(arrays) if 4 * top * top * size * size < 1 << 62 else [a.astype(object) for a in arrays]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of every part (rows);
    equal distances go to the lower index."""
    parts, entries = _exact(parts.shape[1], parts, entries)
    x, c = transform(parts), transform(entries)
    n, size = x.shape
    step = max(1, size // 4)

    def more(sums: np.ndarray, rows: np.ndarray, which: np.ndarray, at: int, to: int) -> np.ndarray:
        gap = x[rows, at:to] - c[which, at:to]
        return sums + (gap * gap).sum(axis=1)

    gap = x[:, None, :step] - c[None, :, :step]
    head = (gap * gap).sum(axis=2)
    every = np.arange(n)
    # the whole distance of the entry that leads after the first coefficients
    lead = head.argmin(axis=1)
    bound = more(head[every, lead], every, lead, step, size)
    rows, which = np.nonzero(head <= bound[:, None])
    sums = head[rows, which]
    for at in range(step, size, step):
        sums = more(sums, rows, which, at, at + step)
        stays = sums <= bound[rows]
        rows, which, sums = rows[stays], which[stays], sums[stays]
    # the leading entry itself is among the rest of every row
    starts = np.searchsorted(rows, every)
    best = np.minimum.reduceat(sums, starts)
    first = np.nonzero(sums == best[rows])[0]
    first = first[np.searchsorted(rows[first], every)]
    return which[first], best // size


def _integers(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(column)).flatten()
    return values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1, width)


def _sums(stored: DataFrame, books: np.ndarray) -> DataFrame:
    """``part, entry, place, total, n``: the sums of the parts nearest to each entry."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            p, e, k = np.nonzero(np.broadcast_to(count[:, :, None] > 0, total.shape))
            return pa.RecordBatch.from_arrays(
                [pa.array(a) for a in (p, e, k, total[p, e, k], count[p, e])], ["part", "entry", "place", "total", "n"])

        total, count, rows = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64), 0
        for batch in batches:
            x = _integers(batch, "ints", width)
            for p in range(parts if len(x) else 0):
                which, _ = nearest(x[:, p], books[p])
                np.add.at(total[p], which, x[:, p])
                count[p] += np.bincount(which, minlength=entries)
            rows += len(x)
            if rows >= _FLUSH:
                yield flush()
                total[:], count[:], rows = 0, 0, 0
        yield flush()

    made = stored.select("ints").mapInArrow(run, "part long, entry long, place long, total long, n long")
    return made.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                                                      F.sum("n").alias("n"))


def fit(stored: DataFrame, dimension: int, parts: int, entries: int, rounds: int) -> np.ndarray:
    """The codebooks ``[part, entry, place]`` after ``rounds`` rounds over all rows."""
    seeds = stored.orderBy(F.col("key").asc_nulls_last(), "ints").limit(entries).collect()  # at most ``entries`` rows
    width = dimension // parts
    books = np.array([r.ints for r in seeds], np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for r in _sums(stored, books).collect():  # one number for each number of the codebooks
            books[r.part, r.entry, r.place] = int(r.total) // r.n
    return books


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, code, error, label_error)`` per kept row, and the codebooks.

    ``code`` holds two hex digits per part; ``error`` is the squared distance
    to the chosen entries, ``label_error`` its sum over the label.

    Defined cases: rows whose vector is NULL or holds NULL, NaN or an infinite
    component are left out; ids may be NULL (they come last among the seeds)
    or repeat (seeds are then ordered by their vectors), every row counts;
    NULL labels form one group; with fewer rows than ``entries`` the codebooks
    are that much smaller; vectors of other lengths, empty ones too, count as
    padded with zeros to the longest, and that to a multiple of ``parts``; very
    long vectors only cost their length; integers beyond LIMIT saturate, as do
    errors beyond a long; equal distances go to the lower index; an empty
    table gives an empty result; other columns are ignored.
    """
    value = F.col(vector_col).cast("array<double>")
    top = float(LIMIT)
    whole = lambda x: F.floor(F.greatest(F.lit(-top), F.least(F.lit(top), x * float(scale)))).cast("bigint")
    kept = vectors.where(F.col(vector_col).isNotNull() & F.forall(value, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))
    stored = materialize(kept.select(F.col(id_col).alias("key"), F.col(label_col).alias("label"),
                                     F.transform(value, whole).alias("ints")), name="vector-ints")
    seen = stored.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("ints")).alias("least"),
                      F.max(F.size("ints")).alias("most")).first()
    dimension = -(-max(1, seen.most or 0) // parts) * parts
    if seen.n and seen.least < dimension:
        stored = stored.withColumn("ints", F.concat("ints", F.array_repeat(F.lit(0).cast("bigint"), F.lit(dimension) - F.size("ints"))))
    spark = vectors.sparkSession
    python_stage(spark)
    books = fit(stored, dimension, parts, entries, rounds) if seen.n else np.zeros((parts, 0, dimension // parts), np.int64)
    schema = T.StructType([stored.schema["key"], stored.schema["label"], T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _integers(batch, "ints", books.shape[2])
            found = [nearest(x[:, p], books[p]) for p in range(parts)]
            codes = [bytes(row).hex() for row in np.stack([w for w, _ in found], axis=1).astype(np.uint8)]
            error = sum(d.astype(object) for _, d in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()),
                 pa.array([min(int(e), _LONG) for e in error], pa.int64())], schema.names)

    coded = materialize(stored.mapInArrow(run, schema), name="vector-codes").withColumn(
        "group", F.coalesce(F.concat(F.lit("s"), F.col("label").cast("string")), F.lit("")))
    groups = coded.groupBy("group").agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("bigint").alias("label_error"),
        F.count(F.lit(1)).alias("rows"))
    rows = coded.drop("label").withColumn("at", F.monotonically_increasing_id())
    out = join_groups(rows, groups, ["group"], "rows", seen.n, ["at"])
    return out.select(F.col("key").alias("vec_id"), "code", "error", "label_error"), books


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op11_vector_codes(vectors: DataFrame) -> DataFrame:
    """The contract's digest of :func:`compress`."""
    coded, books = compress(vectors)
    return coded.withColumn("codebooks_sha256", F.lit(books_sha256(books)))


def _op11_sql() -> str:
    """The same rounds in plain SQL, one assignment and one update each."""
    steps = [f"""WITH good AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
ints AS MATERIALIZED (
  SELECT vec_id, label, i // (len(embedding) // {PARTS}) AS part, i % (len(embedding) // {PARTS}) AS place,
         floor({SCALE}::DOUBLE * embedding[i + 1])::BIGINT AS v
  FROM good, unnest(range(len(embedding))) AS u(i)),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM good ORDER BY vec_id LIMIT {ENTRIES}),
book0 AS MATERIALIZED (SELECT part, entry, place, v FROM ints JOIN seeds USING (vec_id))"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
  SELECT vec_id, label, part, d.entry, d.error FROM (
    SELECT vec_id, label, part, arg_min(struct_pack(entry := entry, error := error), error * {ENTRIES} + entry) AS d FROM (
      SELECT x.vec_id, x.label, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v))::BIGINT AS error
      FROM ints x JOIN book{r} b USING (part, place) GROUP BY ALL)
    GROUP BY ALL))""")
        if r < ROUNDS:
            steps.append(f"""book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.place,
         CASE WHEN m.n IS NULL THEN b.v ELSE ((m.s - (((m.s % m.n) + m.n) % m.n)) // m.n)::BIGINT END AS v
  FROM book{r} b LEFT JOIN (
    SELECT x.part, k.entry, x.place, sum(x.v) AS s, count(*) AS n
    FROM ints x JOIN near{r} k USING (vec_id, part) GROUP BY ALL) m USING (part, entry, place))""")
    steps.append(f"""per AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(error)::BIGINT AS error
  FROM near{ROUNDS} GROUP BY ALL)""")
    return ",\n".join(steps) + f"""
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, place)) FROM book{ROUNDS}) AS codebooks_sha256
FROM per"""


OP11_SQL = _op11_sql()

"""Benchmark decontamination by winnowing (DataFrame functions only).

Of every ``w`` consecutive k-gram hashes the smallest is kept. Two texts that
share ``k + w - 1`` words share all hashes of that stretch, hence its
smallest: with k = 5 and w = 6 no shared stretch of 10 words is missed. Test
fingerprints meet training fingerprints in a join on the hash; a hit is then
extended to its whole window and compared word by word, so hash collisions
never count. Items shorter than a window use k = their own length and w = 1.

All window lengths are searched in one pass over the texts, which also counts
the words; fingerprints of different lengths never meet. Windows travel under
a number; the items that have them come last, to the documents that were hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, row_key
from tidemark.operators.lookup import BROADCAST_BYTE_LIMIT, within_rows
from tidemark.session import materialize

WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5
#: tables of at most this many rows, and at most 64 MiB, are broadcast
BROADCAST_ROWS = 500_000
#: a key of a larger table is spread over so many tasks
SALTS = 16


def words(text: Column) -> Column:
    """Lower-cased (A-Z) maximal runs of digits, letters and non-ASCII characters."""
    return F.array_remove(F.split(lower_ascii(text), WORD_BREAK), "")


def _at(array: Column, i: Column, shift: int) -> Column:
    return F.get(array, i + shift)


def gram_hashes(ws: Column, k: int) -> Column:
    """Hash of each k consecutive words (NULL past the end is never reached:
    the array is cut to the starts that have k words)."""
    starts = F.slice(ws, F.lit(1), F.greatest(F.size(ws) - (k - 1), F.lit(0)))
    return F.transform(starts, lambda x, i: F.xxhash64(x, *[_at(ws, i, j) for j in range(1, k)]))


def winnow(hashes: Column, w: int) -> Column:
    """The smallest of each ``w`` consecutive hashes, by start of the window."""
    if w == 1:
        return hashes
    starts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (w - 1), F.lit(0)))
    return F.transform(starts, lambda x, i: F.least(x, *[_at(hashes, i, j) for j in range(1, w)]))


def shape(length: int) -> tuple[int, int]:
    """``(k, w)`` that guarantee shared stretches of ``length`` words."""
    return (GRAM, length - GRAM + 1) if length >= WINDOW else (length, 1)


def _marked(k: int):
    return lambda x: F.xxhash64(F.lit(k), x)


def _fingerprints(df: DataFrame, lengths: list[int]) -> DataFrame:
    """``__m<n>``: the fingerprint of every window of n words, for each length
    n. A length of k words alone gets its hash once more, so that it never
    meets a gram of a longer window."""
    df = df.withColumns({f"__g{k}": gram_hashes(F.col("__w"), k) for k in sorted({shape(n)[0] for n in lengths})})
    out = {}
    for n in lengths:
        k, w = shape(n)
        out[f"__m{n}"] = winnow(F.col(f"__g{k}"), w) if n >= WINDOW else F.transform(f"__g{k}", _marked(k))
    return df.withColumns(out).drop(*[c for c in df.columns if c.startswith("__g")])


def _window_text(ws: Column, start: Column, length: int) -> Column:
    return F.array_join(F.slice(ws, start + 1, length), " ")


def _windows(df: DataFrame, lengths: list[int], keep: Column | None = None) -> Column:
    """The windows of every length as structs: start, length, fingerprint and
    text; with ``keep``, an array of fingerprints, only those that it holds."""
    def found(n: int) -> Column:
        window = lambda m, i: F.struct(i.alias("s"), F.lit(n).alias("n"), m.alias("m"),
                                       _window_text(F.col("__w"), i, n).alias("t"))
        if keep is None:
            return F.transform(f"__m{n}", window)
        held = F.transform(f"__m{n}", lambda m, i: F.when(F.array_contains(keep, m), window(m, i)))
        return F.filter(held, lambda x: x.isNotNull())

    return F.concat(*[found(n) for n in lengths])


def benchmark_windows(benchmark: DataFrame, lengths: list[int], id_col: str = "item_id",
                      text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(__m, __text, __wid)``, each distinct window once, under a number made
    of its text, and ``(__wid, __item)``, the items that have it."""
    b = benchmark.select(F.col(id_col).cast("string").alias("__item"), words(F.coalesce(F.col(text_col), F.lit(""))).alias("__w"))
    # an item is searched at one length: its own, or WINDOW
    b = b.where(F.size("__w") > 0).withColumn("__n", F.least(F.size("__w"), F.lit(WINDOW)))
    b = _fingerprints(b, lengths).withColumn("__x", F.explode(F.filter(_windows(b, lengths), lambda x: x["n"] == F.col("__n"))))
    # equal texts are equal windows: two hashes of one text make its number
    text = F.col("__x.t")
    wid = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
    pairs = materialize(b.select(F.col("__x.m").alias("__m"), text.alias("__text"), wid.alias("__wid"), "__item").distinct(),
                        name="bench-windows")
    return pairs.select("__m", "__text", "__wid").distinct(), pairs.select("__wid", "__item").distinct()


def _meet(rows: DataFrame, table: DataFrame, on: list[str], spread: list[str], how: str = "inner") -> DataFrame:
    """Join with a table that has each key once (or a few times): broadcast
    where rows and bytes are proven small, else by the key and a salt made of
    ``spread``, so that the rows of one key go to SALTS tasks."""
    if within_rows(table, BROADCAST_ROWS, BROADCAST_BYTE_LIMIT):
        return rows.join(F.broadcast(table), on, how)
    salted = table.withColumn("__salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    rows = rows.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    return rows.join(salted, [*on, "__salt"], how).drop("__salt")


def _every(lengths: list[int]) -> Column:
    """The distinct fingerprints of all lengths."""
    parts = [F.col(f"__m{n}") for n in lengths]
    return F.array_distinct(F.concat(*parts) if len(parts) > 1 else parts[0])


class Search:
    """One search of the documents for the windows of a benchmark.

    ``counts`` (with ``count=True``): ``doc_id, __k1, __k2, n_words`` of every
    row. ``found``: ``__k1, __k2, __start, __length, __wid``, every occurrence
    of a window in a document (by its content key). ``items``: ``__wid,
    __item``, the items that have a window.
    """

    def __init__(self, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", count: bool = False):
        sizes = benchmark.select(F.size(words(F.coalesce(F.col(item_text), F.lit("")))).alias("n"))
        lengths = sorted(r.n for r in sizes.where(F.col("n") > 0).select(F.least("n", F.lit(WINDOW)).alias("n")).distinct().collect())
        d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__t"))
        d = d.select("doc_id", *row_key(F.col("doc_id"), F.col("__t")), "__t")
        split = d.select("doc_id", "__k1", "__k2", words(F.col("__t")).alias("__w"))
        n_words = F.size("__w").cast("bigint").alias("n_words")
        if not lengths:  # at most WINDOW of them
            wid = F.struct(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b")).alias("__wid")
            none = d.where(F.lit(False))
            self.counts = split.select("doc_id", "__k1", "__k2", n_words)
            self.found = none.select("__k1", "__k2", F.lit(0).alias("__start"), F.lit(0).alias("__length"), wid)
            self.items = none.select(wid, F.lit("").alias("__item"))
            return
        windows, self.items = benchmark_windows(benchmark, lengths, item_col, item_text)
        # 1: which documents share which fingerprints (hashes only, no text);
        # at place 0 stands a row for the document itself, with its number of words
        prints = windows.select("__m", F.lit(True).alias("__in")).distinct()
        marks = _fingerprints(split, lengths)
        if count:
            itself = F.array(F.xxhash64("__k1", "__k2"))
            marks = marks.select("doc_id", "__k1", "__k2", n_words, F.posexplode(F.concat(itself, _every(lengths))).alias("__p", "__m"))
            kept = _meet(marks, prints, ["__m"], ["__k1", "__k2"], "left").where("__p = 0 OR __in")
            kept = materialize(kept.select("doc_id", "__k1", "__k2", "n_words", "__p", "__m"), name="bench-marks")
            self.counts = kept.where("__p = 0").select("doc_id", "__k1", "__k2", "n_words")
            marks = kept.where("__p > 0")
        else:
            marks = _meet(marks.select("__k1", "__k2", F.explode(_every(lengths)).alias("__m")), prints, ["__m"], ["__k1", "__k2"])
        shared = materialize(marks.groupBy("__k1", "__k2").agg(F.collect_set("__m").alias("__hit")), name="bench-candidates")
        # 2: extend the hits of those documents to whole windows, word by word
        near = _meet(d, shared, ["__k1", "__k2"], ["__k2"])
        near = _fingerprints(near.select("__k1", "__k2", "__hit", words(F.col("__t")).alias("__w")), lengths)
        spots = near.select("__k1", "__k2", F.explode(_windows(near, lengths, F.col("__hit"))).alias("__x"))
        spots = spots.select("__k1", "__k2", F.col("__x.s").alias("__start"), F.col("__x.n").alias("__length"),
                             F.col("__x.m").alias("__m"), F.col("__x.t").alias("__text"))
        found = _meet(spots, windows, ["__m", "__text"], ["__k1", "__k2"])
        self.found = materialize(found.select("__k1", "__k2", "__start", "__length", "__wid"), name="bench-hits")

    def overlaps(self) -> DataFrame:
        """Per document content key: ``__n_hit`` words inside a benchmark
        window and ``__items``, the sorted items; only documents with a hit."""
        spans = self.found.groupBy("__k1", "__k2").agg(F.collect_set(F.struct("__start", "__length")).alias("__spans"))
        covered = F.transform("__spans", lambda s: F.sequence(s["__start"], s["__start"] + s["__length"] - 1))
        counts = spans.select("__k1", "__k2", F.size(F.array_distinct(F.flatten(covered))).cast("bigint").alias("__n_hit"))
        named = _meet(self.found.select("__k1", "__k2", "__wid").distinct(), self.items, ["__wid"], ["__k1", "__k2"])
        lists = named.select("__k1", "__k2", "__item").distinct().groupBy("__k1", "__k2").agg(
            F.sort_array(F.collect_list("__item")).alias("__items"))
        return counts.join(lists, ["__k1", "__k2"])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, items`` (sorted array).

    Defined cases: NULL and wordless texts have no words and no hits; NULL or
    wordless items are never hit; items that share a window or a text are all
    hit by it; repeated rows each get their row; a NULL id is kept; a text of
    any length is searched whole; empty documents give an empty result, an
    empty benchmark no hits; other columns, whatever their names, are ignored.
    """
    search = Search(docs, benchmark, id_col, text_col, item_col, item_text, count=True)
    per_doc = materialize(search.overlaps(), name="bench-overlaps")
    return _meet(search.counts, per_doc, ["__k1", "__k2"], ["__k2"], "left").select(
        "doc_id", "n_words", F.coalesce("__n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("__items", F.array().cast("array<string>")).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, without documents that hold a benchmark
    window (same defined cases as :func:`contamination`)."""
    per_doc = materialize(Search(docs, benchmark, id_col, text_col).found.select("__k1", "__k2").distinct(), name="bench-dirty")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    d = docs.select(whole, F.col(f"`{id_col}`").alias("__id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__t"))
    d = d.select("__row", *row_key(F.col("__id"), F.col("__t")))
    return _meet(d, per_doc, ["__k1", "__k2"], ["__k2"], "left_anti").select("__row.*")


def op7_benchmark_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's digest of :func:`contamination`."""
    c = contamination(docs, benchmark)
    return c.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = (r"[x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> '']")
OP7_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS MATERIALIZED (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
m AS MATERIALIZED (SELECT rid, i, dw.n AS n, item FROM dw JOIN bw ON dw.t = bw.t AND dw.n = bw.n),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM m) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
        FROM (SELECT DISTINCT rid, item FROM m) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""

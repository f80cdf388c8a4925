"""Exact deduplication by progressive refinement (DataFrame functions only).

Texts are equal when identical after deleting ASCII white space. Rows are
grouped by the byte length of the normalised text; groups of one are settled.
The rest is refined by a hash of the first bytes, and only what still shares
both is hashed in full. Each round shuffles counts and narrow keys, never a
text, and each later round reads only rows that the earlier one left open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_SPACE, join_groups
from tidemark.operators.rows import repeat_rows
from tidemark.session import materialize

PREFIX_CHARS = 64
OPEN = ["__len", "__prefix"]
#: key tables of at most this many rows (about 40 bytes each) are broadcast
BROADCAST_ROWS = 500_000


def normalised(text: Column) -> Column:
    """The text without ASCII white space."""
    return F.translate(text, ASCII_SPACE, "")


def _shared(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has (counts are summed map-side first)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")


def _mark(rows: DataFrame, groups: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` with their group's ``__n``, NULL outside all groups. The groups
    are broadcast where their counted number allows it; the rows are not
    shuffled then."""
    if groups.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(groups), keys, "left")
    spread = [c for c in rows.columns if c not in keys][:1] or keys
    return join_groups(rows, groups, keys, "__n", total, spread)


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Id, code points, length and prefix hash, with the normalised text."""
    t = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)
    t = t.withColumn("__t", normalised(F.col("text")))
    return t.select("doc_id", F.length("text").alias("__cp"), "__t", F.octet_length("__t").alias("__len"),
                    F.xxhash64(F.substring("__t", 1, PREFIX_CHARS)).alias("__prefix"),
                    *[c for c in t.columns if c.startswith("__row")])


def refine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, int]:
    """The keyed rows without text, the ``(__len, __prefix)`` groups that
    length and prefix hash leave open (the only rows whose content is
    compared), and the number of rows."""
    narrow = materialize(_keyed(docs, id_col, text_col).drop("__t"), name="dedup-narrow")
    total = narrow.count()
    by_length = materialize(_shared(narrow, ["__len"]), name="dedup-lengths")
    same_length = _mark(narrow.select("__len", "__prefix"), by_length, ["__len"], total).where("__n is not null")
    return narrow, materialize(_shared(same_length, OPEN), name="dedup-open"), total


def _decide(survivors: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """One row per distinct ``(doc_id, __cp, sha256)`` of the survivors, with
    the number of such rows ``__c``, the group's keeper and its size."""
    # repeated rows first collapse to one with a count
    same = materialize(survivors.groupBy("doc_id", "__cp", "sha256").agg(F.count(F.lit(1)).alias("__c")),
                       name="dedup-survivors")
    # most code points, then smallest id, NULL ids last
    order = F.struct(F.col("__cp"), F.col("doc_id").isNotNull(), _descending("doc_id", docs, id_col))
    groups = same.groupBy("sha256").agg(F.max_by(F.struct("doc_id", "__cp"), order).alias("__best"),
                                        F.sum("__c").alias("group_size"), F.count(F.lit(1)).alias("__members"))
    joined = join_groups(same, materialize(groups, name="dedup-groups"), ["sha256"], "__members",
                         same.count(), ["doc_id", "__cp"])
    best = F.col("__best")
    return joined.withColumn("__keeper", F.col("doc_id").eqNullSafe(best["doc_id"]) & (F.col("__cp") == best["__cp"]))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                full_hash: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, sha256``.

    Of equal texts the row with the most code points in its original text
    stays, then the one with the smallest id. ``sha256`` (binary) is the hash
    of the normalised text; it is NULL for rows that length or prefix already
    settled, unless ``full_hash`` asks for it everywhere.

    Defined cases: a NULL text equals the empty text, and both equal any text
    of white space only; a NULL id comes after all others; of repeated rows
    (same id, equal text, same length) exactly one is kept; a text of any length
    is compared by its hash; an empty table gives an empty result; other columns
    are ignored.
    """
    narrow, open_keys, total = refine(docs, id_col, text_col)
    sha = F.unhex(F.sha2(F.col("__t"), 256)).alias("sha256")
    names = ["doc_id", "__cp", *OPEN]
    if full_hash:
        hashed = materialize(_keyed(docs, id_col, text_col).select(*names, sha), name="dedup-hashes")
        marked = _mark(hashed, open_keys, OPEN, total)
        settled, survivors = marked.where("__n is null"), marked.where("__n is not null")
    else:
        settled = (_mark(narrow, open_keys, OPEN, total).where("__n is null")
                   .withColumn("sha256", F.lit(None).cast("binary")))
        survivors = (_mark(_keyed(docs, id_col, text_col), open_keys, OPEN, total)
                     .where("__n is not null").select("doc_id", "__cp", sha))
    decided = materialize(_decide(survivors, docs, id_col), name="dedup-decided")
    found = repeat_rows(decided, "__c", "__i").select(
        "doc_id", F.col("__best")["doc_id"].alias("keep_id"), F.col("group_size").cast("bigint").alias("group_size"),
        (F.col("__keeper") & (F.col("__i") == 1)).alias("kept"), "sha256")
    alone = settled.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
                           F.lit(True).alias("kept"), "sha256")
    return alone.unionByName(found)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, without the rows that
    :func:`exact_dedup` does not keep (same defined cases)."""
    _, open_keys, total = refine(docs, id_col, text_col)
    sha = F.unhex(F.sha2(F.col("__t"), 256))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    survivors = (_mark(_keyed(docs, id_col, text_col), open_keys, OPEN, total)
                 .where("__n is not null").select("doc_id", "__cp", sha.alias("sha256")))
    decided = materialize(_decide(survivors, docs, id_col).select("doc_id", "__cp", "sha256", "__c", "__keeper"),
                          name="dedup-decided")
    # only rows that lose, or that repeat the keeper, need another look
    verdict = decided.where("NOT __keeper OR __c > 1").withColumnRenamed("doc_id", "__vid").select(
        "__vid", F.col("__cp").alias("__vcp"), F.col("sha256").alias("__vsha"), "__keeper")
    if verdict.count() <= BROADCAST_ROWS:
        verdict = F.broadcast(verdict)
    rows = _mark(_keyed(docs, id_col, text_col, whole), open_keys, OPEN, total)
    rows = rows.select("doc_id", "__cp", "__row", F.when(F.col("__n").isNotNull(), sha).alias("__sha"))
    judged = rows.join(verdict, (F.col("__sha") == F.col("__vsha")) & (F.col("__cp") == F.col("__vcp"))
                       & F.col("doc_id").eqNullSafe(F.col("__vid")), "left")
    once = judged.where("__keeper is null").select("__row")
    repeated = judged.where("__keeper").dropDuplicates(["doc_id", "__cp", "__sha"]).select("__row")
    return once.unionByName(repeated).select("__row.*")


def _descending(name: str, docs: DataFrame, id_col: str) -> Column:
    """A value that is larger for smaller ids, for numeric ids; text ids
    cannot be negated, so they compare through their bytes' complement."""
    kind = docs.schema[id_col].dataType.simpleString()
    if kind in ("tinyint", "smallint", "int", "bigint") or kind.startswith("decimal"):
        return -F.col(name).cast("decimal(38,0)")
    flipped = "0123456789ABCDEF"
    return F.concat(F.translate(F.hex(F.encode(F.col(name).cast("string"), "UTF-8")), flipped, flipped[::-1]), F.lit("G"))


def op10_exact_dedup(docs: DataFrame) -> DataFrame:
    """The contract's digest of :func:`exact_dedup`: every row with its hash."""
    out = exact_dedup(docs, full_hash=True)
    return out.select("doc_id", "keep_id", "group_size", "kept",
                      F.lower(F.hex("sha256")).alias("text_sha256"))


OP10_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept,
       h AS text_sha256
FROM n WINDOW w AS (PARTITION BY h ORDER BY cp DESC, doc_id NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""

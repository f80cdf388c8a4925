import zlib
from collections import Counter

from llm_fixtures import SF, documents, empty, texts, whole, with_copies

from tidemark.llm import shards as S
from tidemark.llm.queries import LLM_QUERIES


def _law(rows, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts[k] for k in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    for k in counts:
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(counts[k]))


def test_query(spark):
    docs = texts(spark)
    rows = LLM_QUERIES["op5_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    _law(rows, 40)
    for r in rows:
        raw = docs[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)


def test_awkward_documents(spark):
    docs = documents(spark)
    rows = S.interleave(docs, 4).collect()
    assert len(rows) == docs.count()
    _law(rows, 4)
    assert {r["size"] for r in rows if r.doc_id in (3, 4)} == {16}
    few = S.interleave(docs, 100).collect()
    _law(few, 100)
    assert S.interleave(empty(spark), 4).count() == 0


def test_small_buckets_and_repeated_rows(spark, monkeypatch):
    docs = with_copies(spark)
    docs = docs.unionByName(docs.limit(50)).unionByName(docs.where("doc_id = 10000")).unionByName(docs.where("doc_id = 10000"))
    monkeypatch.setattr(S, "BUCKET_ROWS", 7)
    rows = S.interleave(docs, 9).collect()
    assert len(rows) == docs.count()
    _law(rows, 9)


def test_every_shard_has_the_mixture(spark):
    docs = whole(spark, "/root/testdata/sf0.01", "documents")
    out = S.interleave(docs, 10).join(docs.select("doc_id", "source"), "doc_id").collect()
    n = Counter(r.source for r in out)
    per = Counter((r.source, r.shard) for r in out)
    for s, k in n.items():
        for shard in range(10):
            assert abs(per[s, shard] - k / 10) <= 2, (s, shard)


def test_many_sources_of_one_row(spark):
    from pyspark.sql import functions as F

    docs = whole(spark, SF, "documents").withColumn("source", F.col("doc_id").cast("string"))
    _law(S.interleave(docs, 7).collect(), 7)


def test_places_against_plainly_sorted_ranks(spark, monkeypatch):
    """Ranks, fractions and cuts of a plain sort of all rows."""
    from pyspark.sql import functions as F

    docs = with_copies(spark, 60).unionByName(whole(spark, SF, "documents").where("doc_id < 4")).withColumn(
        "source", F.when(F.col("doc_id") % 11 == 0, F.lit(None)).otherwise(F.col("source")))
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("s"),
                        F.crc32(F.encode(text, "UTF-8")).alias("crc"), F.octet_length(text).alias("n"),
                        F.pmod(F.xxhash64(F.lit(7), F.col("doc_id").cast("string"), text), F.lit(S._HASH_RANGE)).alias("h"))
    phases = {r.s: r.p for r in keyed.select("s").distinct().select(
        "s", ((F.pmod(F.xxhash64(F.lit(7), F.col("s")), F.lit(1 << 20)) + 0.5) / float(1 << 20)).alias("p")).collect()}
    again = lambda h, c: spark.range(1).select(F.pmod(F.xxhash64(F.lit(h), F.lit(c).cast("bigint")), F.lit(S._HASH_RANGE))).head()[0]
    seen, rows = Counter(), []
    for r in keyed.collect():
        seen[tuple(r)] += 1
        copy = seen[tuple(r)]
        rows.append((r.s, r.h if copy == 1 else again(r.h, copy), r.doc_id, r.crc, copy))
    sizes = Counter(r[0] for r in rows)
    ranked, rank = [], Counter()
    for s, h, d, crc, copy in sorted(rows):
        ranked.append(((rank[s] + phases[s]) / sizes[s], s, rank[s], d, crc))
        rank[s] += 1
    shards = 7
    small, extra = divmod(len(rows), shards)
    want, at = [], 0
    for k in range(shards):
        n = small + (k < extra)
        want += [(d, crc, k, i) for i, (*_, d, crc) in enumerate(sorted(ranked)[at:at + n])]
        at += n
    monkeypatch.setattr(S, "BUCKET_ROWS", 13)
    got = [(r.doc_id, r.text_crc32, r.shard, r.slot) for r in S.interleave(docs, shards).collect()]
    assert sorted(got) == sorted(want)


def test_one_row_is_most_of_the_table(spark):
    from pyspark.sql import functions as F

    docs = whole(spark, SF, "documents").select("doc_id", "text", "source")
    same = docs.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3_000)))).drop("n")
    rows = S.interleave(docs.unionByName(same), 5).collect()
    assert len(rows) == docs.count() + 3_000
    _law(rows, 5)
    long = spark.createDataFrame([(1, "x" * 3_000_000, None)], docs.schema)
    assert [r["size"] for r in S.interleave(long, 2).collect()] == [3_000_016]

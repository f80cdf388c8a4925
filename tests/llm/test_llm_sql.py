"""Operators that SQL can express, against DuckDB."""

import duckdb
import pytest
from llm_fixtures import SF, documents, empty, multiset, whole

from tidemark.llm import decontaminate as D
from tidemark.llm import exact_dedup as E
from tidemark.llm.queries import LLM_QUERIES, LLM_SQL


def _duck(docs, benchmark):
    con = duckdb.connect()
    con.register("d0", docs)
    con.register("b0", benchmark)
    con.execute("CREATE VIEW documents AS SELECT * FROM d0; CREATE VIEW benchmark AS SELECT * FROM b0")
    return con


def _check(df, con, sql):
    got = con.execute(sql)
    names = [x[0] for x in got.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted((tuple(r) for r in got.fetchall()), key=repr)
    assert multiset(df.select(*names)) == want


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_queries(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    _check(LLM_QUERIES[name](spark, SF), con, LLM_SQL[name])


def _arrow(df):
    return df.select("doc_id", "text").toArrow()


def _bench(spark):
    shared = " ".join(f"alpha{i}" for i in range(14))
    return spark.createDataFrame([(1, f"x {shared} y"), (2, "one two"), (3, None), (4, "!!"), (5, shared), (6, "river")],
                                 "item_id bigint, text string")


def test_awkward_documents(spark):
    docs, bench = documents(spark), _bench(spark)
    con = _duck(_arrow(docs), bench.toArrow())
    _check(D.op7_benchmark_decontamination(docs, bench), con, LLM_SQL["op7_benchmark_decontamination"])
    _check(E.op10_exact_dedup(docs), con, LLM_SQL["op10_exact_dedup"])


def test_empty_tables(spark):
    docs, bench = documents(spark), _bench(spark)
    assert D.op7_benchmark_decontamination(empty(spark), bench).count() == 0
    assert E.op10_exact_dedup(empty(spark)).count() == 0
    clean = D.op7_benchmark_decontamination(docs, bench.limit(0))
    assert clean.count() == docs.count() and clean.where("contaminated").count() == 0
    assert E.drop_copies(empty(spark)).columns == docs.columns


def test_refinement_hashes_only_open_groups(spark):
    docs = documents(spark)
    lazy = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in E.exact_dedup(docs).collect()}
    full = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in E.exact_dedup(docs, full_hash=True).collect()}
    assert lazy == full
    rows = E.exact_dedup(docs).collect()
    assert any(r.sha256 is None for r in rows) and all(r.sha256 is not None for r in rows if r.group_size > 1)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    docs, bench = documents(spark), _bench(spark)
    want = multiset(E.op10_exact_dedup(docs)), multiset(D.op7_benchmark_decontamination(docs, bench))
    monkeypatch.setattr(E, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert (multiset(E.op10_exact_dedup(docs)), multiset(D.op7_benchmark_decontamination(docs, bench))) == want


def test_drop_copies_keeps_one_row_of_each_text(spark):
    docs = documents(spark)
    kept = E.drop_copies(docs)
    assert kept.columns == docs.columns
    squeeze = lambda t: "".join((t or "").translate(dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))))
    all_texts, left = [squeeze(r.text) for r in docs.collect()], [squeeze(r.text) for r in kept.collect()]
    assert sorted(left) == sorted(set(all_texts))


def test_drop_contaminated(spark):
    docs, bench = documents(spark), _bench(spark)
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    bad = D.contamination(docs, bench).where("n_hit > 0").count()
    assert bad and kept.count() == docs.count() - bad


def test_winnowing_misses_no_shared_stretch(spark):
    """Every 10-word stretch at every offset, in random surroundings."""
    import random

    r = random.Random(1)
    vocab = [f"w{i}" for i in range(30)]
    bench = [" ".join(r.choice(vocab) for _ in range(r.randint(10, 25))) for _ in range(40)]
    docs = []
    for i in range(200):
        b = r.choice(bench).split()
        k = r.randint(0, len(b) - 10)
        docs.append((i, " ".join([r.choice(vocab) for _ in range(r.randint(0, 12))] + b[k:k + 10]
                                 + [r.choice(vocab) for _ in range(r.randint(0, 12))])))
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(list(enumerate(bench)), "item_id bigint, text string")
    out = D.op7_benchmark_decontamination(d, b)
    assert out.where("contaminated").count() == 200
    _check(out, _duck(d.toArrow(), b.toArrow()), LLM_SQL["op7_benchmark_decontamination"])


@pytest.mark.parametrize("name", ["op7_benchmark_decontamination", "op10_exact_dedup"])
def test_native_plans(spark, name):
    plan = LLM_QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_whole_inputs(spark):
    for name in ("op7_benchmark_decontamination", "op10_exact_dedup", "op5_sharding"):
        assert LLM_QUERIES[name](spark, SF).count() == whole(spark, SF, "documents").count()


def test_very_long_text(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    bench = spark.createDataFrame([(1, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14"), (2, "zz " * 12)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, long), (2, long + " ")], "doc_id bigint, text string")
    for r in D.op7_benchmark_decontamination(docs, bench).collect():
        assert (r.n_words, r.n_items) == (60_000, 1) and r.n_hit == 10 * sum(i % 977 == 5 for i in range(60_000))
    assert {(r.doc_id, r.keep_id, r.kept) for r in E.op10_exact_dedup(docs).collect()} == {(1, 2, False), (2, 2, True)}

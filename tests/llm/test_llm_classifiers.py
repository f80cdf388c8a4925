import math
import random
import zlib

import numpy as np
from llm_fixtures import documents, empty, whole

from tidemark.llm import language as L
from tidemark.llm import quality as Q
from tidemark.llm.queries import LLM_QUERIES

MID = "/root/testdata/sf0.01"


def test_language_query(spark):
    rows = LLM_QUERIES["op9_language_id"](spark, MID).join(whole(spark, MID, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == whole(spark, MID, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.lang_pred in {"en", "de", "fr", "es"} for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 200 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert sum(r.rejected for r in rows) <= len(rows) * 0.005


def test_language_of_awkward_documents(spark):
    docs = whole(spark, "/root/testdata/sf0.001", "documents")
    model = L.train_on_fold(docs)
    awkward = documents(spark)
    out = L.identify(awkward, model)
    assert set(out.columns) == set(awkward.columns) | {"lang_pred", "score", "rejected"}
    rows = out.collect()
    assert len(rows) == awkward.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert letters or (r.score == 0 and r.rejected)
    assert L.identify(empty(spark), model).count() == 0
    assert L.drop_rejected(awkward).columns == awkward.columns
    assert L.drop_rejected(empty(spark)).count() == 0


def test_language_ignores_everything_but_the_text(spark):
    from pyspark.sql import functions as F

    docs = whole(spark, "/root/testdata/sf0.001", "documents")
    model = L.train_on_fold(docs)
    a = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(docs, model).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in
         L.identify(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("q")), model).collect()}
    assert a == b


def _script(letters, n, seed=5):
    r = random.Random(seed)
    words = ["".join(r.choices(letters, k=r.randint(2, 9))) for _ in range(400)]
    return " ".join(r.choice(words) for _ in range(n // 5))


def test_distance_rejection_goes_both_ways(spark):
    """Held-out texts of every learned language stay; long texts of an
    unlearned language or script go, one odd training text or not."""
    from pyspark.sql import functions as F

    docs = whole(spark, MID, "documents").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(10**9 + i, _script("qxzwkv", 3_000, i), "en") for i in range(4)], docs.schema)
    for train, gone in ((docs.unionByName(odd), None), (docs.where("lang <> 'de'"), "de"), (docs.where("lang <> 'es'"), "es")):
        model = L.train_on_fold(train)
        rows = [r for r in docs.where(F.length("text") > 0).collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 or r.lang == gone]
        said = {r.doc_id: model.predict(r.text) for r in rows}
        for lang in {"en", "de", "fr", "es"} - {gone}:
            mine = [r for r in rows if r.lang == lang]
            assert len(mine) > 15 and sum(said[r.doc_id][2] for r in mine) <= len(mine) * 0.01, (lang, gone)
        if gone:
            far = [r for r in rows if r.lang == gone and len(r.text) > 1_000]
            assert len(far) > 40 and sum(said[r.doc_id][2] for r in far) >= len(far) * 0.95, gone
        for letters in ("абвгдежзийклмнопрстуфхцчшщыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"):
            assert all(model.predict(_script(letters, n))[2] for n in (1_000, 4_000, 20_000, 100_000))


def test_every_language_is_learned(spark, monkeypatch):
    """230 languages, the rarest with one text: all get their name."""
    letters = [chr(0x4E00 + i) for i in range(230 * 12)]
    rows = [(i * 10 + j, _script(letters[12 * i:12 * i + 12], 300, j), f"l{i:03}") for i in range(230) for j in range(1 + (i < 200))]
    model = L.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert set(model.languages) == {f"l{i:03}" for i in range(230)}
    want = [(lang, False) for _, _, lang in rows]
    got = model.predict_all([text for _, text, _ in rows])
    assert [(lang, gone) for lang, _, gone in got] == want
    monkeypatch.setattr(L, "DENSE", 7)
    model.held = None
    assert [(lang, gone) for lang, _, gone in model.predict_all([text for _, text, _ in rows])] == want


def test_no_language_is_lost_to_repeated_ids(spark):
    """NULL ids, one id for all rows, a text on most rows: all languages are
    learned and held-out texts keep their names."""
    from pyspark.sql import functions as F

    docs = whole(spark, MID, "documents").select("doc_id", "text", "lang")
    for frame in (docs.withColumn("doc_id", F.lit(None).cast("bigint")), docs.withColumn("doc_id", F.lit(7).cast("bigint"))):
        many = frame.unionByName(frame).unionByName(frame).unionByName(frame)
        model = L.train(many)
        assert set(model.languages) == {"en", "de", "fr", "es"}
        rows = docs.where(F.length("text") > 200).limit(200).collect()
        assert sum(model.predict(r.text)[0] == r.lang for r in rows) > 0.97 * len(rows)
    hot = spark.range(6_000).select("id", F.lit("the one text that fills the table").alias("text"), F.lit("xx").alias("lang"))
    few = docs.limit(40).unionByName(hot.toDF("doc_id", "text", "lang"))
    assert set(L.train(few).languages) == {"xx", *[r.lang for r in docs.limit(40).collect()]}
    # a language whose drawn texts have no letter is looked at whole
    blank = spark.range(4_000).select("id", F.concat(F.col("id").cast("string"), F.lit("!")).alias("text"), F.lit("yy").alias("lang"))
    one = spark.createDataFrame([(9_999, "abc def", "yy")], "id bigint, text string, lang string")
    assert L.train(blank.unionByName(one).toDF("doc_id", "text", "lang")).languages == ["yy"]


def test_predictions_against_plain_cosine(spark):
    """Every similarity from dictionaries of grams, one centroid at a time."""
    docs = whole(spark, "/root/testdata/sf0.001", "documents")
    model = L.train_on_fold(docs)
    for r in docs.limit(60).collect():
        x = L.counts(r.text)
        if x is None:
            continue
        v = {k: math.log1p(int(n)) * float(model.idf[k]) for k, n in enumerate(x) if n}
        norm = math.sqrt(sum(a * a for a in v.values()))
        sims = [sum(v.get(int(k), 0.0) * float(w) for k, w in zip(*c)) / norm for c in model.centroids]
        best = max(range(len(sims)), key=lambda k: sims[k])
        lang, score, rejected = model.predict(r.text)
        assert lang == model.languages[best] and math.isclose(score, min(1.0, max(0.0, sims[best])), abs_tol=1e-4)
        floor = model.floor[best, L._length_class(int(x.sum()))]
        assert rejected == (sims[best] < floor) or abs(sims[best] - floor) < 1e-4


def test_counts_in_blocks(monkeypatch):
    text = "Der Über-Fluss, né à  Ñu  123 wörter\n" * 40
    want = L.counts(text)
    monkeypatch.setattr(L, "_BLOCK", 37)
    assert (L.counts(text) == want).all()
    assert L.counts("12 !!") is None and L.counts("") is None


def test_ngram_counts_by_hand():
    x = L.counts("ab")  # grams: a, b; ^a, ab, b$; ^ab, ab$
    assert x.sum() == 7
    assert L.counts("ab ab").sum() == 14 and (L.counts("ab ab") == 2 * x).all() and (L.counts("AB") == x).all()


def test_quality_query(spark):
    rows = LLM_QUERIES["op3_quality_classifier"](spark, MID).collect()
    assert len(rows) == whole(spark, MID, "documents").count()
    labels = {r.doc_id: r.quality for r in whole(spark, MID, "labels").collect()}
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert len(held) > 80 and sum(p == y for _, p, y in held) / len(held) > 0.95


def test_compiled_rules_equal_the_model(spark):
    docs, labels = whole(spark, MID, "documents"), whole(spark, MID, "labels")
    stats = Q.with_statistics(docs).cache()
    model = Q.train(stats, labels)
    assert model.rules
    rows = stats.select("*", model.column().alias("p")).toPandas()
    want = model.score(rows[list(Q.STATISTICS)].to_numpy(float))
    assert np.allclose(rows["p"], want)
    stats.unpersist()


def test_labels_of_one_id_and_very_long_texts(spark):
    from pyspark.sql import functions as F

    docs, labels = whole(spark, MID, "documents"), whole(spark, MID, "labels")
    stats = Q.with_statistics(docs.select("doc_id", "text")).cache()
    hot = spark.range(70_000).select(F.lit(3).cast("bigint").alias("doc_id"), F.lit(1).alias("quality"))
    model = Q.train(stats, labels.select("doc_id", F.col("quality").cast("int").alias("quality")).unionByName(hot))
    assert model.rules  # 70,000 labels of one document are one row
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in Q.score(stats, model).collect() if r.doc_id in known and r.doc_id != 3]
    assert sum(r.predicted == known[r.doc_id] for r in rows) > 0.95 * len(rows)
    stats.unpersist()
    long = spark.createDataFrame([(1, "words of a very long text " * 100_000)], "doc_id bigint, text string")
    assert 0 <= Q.op3_quality_classifier(long, labels).head().score <= 1


def test_paths_are_rules_and_lasso_is_sparse():
    rng = np.random.default_rng(1)
    x = rng.random((600, len(Q.STATISTICS)))
    y = ((x[:, 2] > 0.6) & (x[:, 4] <= 0.5)).astype(float)
    rules = Q.propose(x, y)
    assert all(1 <= len(r.terms) <= Q.DEPTH for r in rules)
    model = Q.fit(x, y)
    assert 0 < len(model.rules) < len(rules) / 2
    assert ((model.score(x) >= 0.5) == (y > 0.5)).mean() > 0.97


def test_quality_of_awkward_documents(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (9, None)], "doc_id bigint, quality int")
    out = Q.op3_quality_classifier(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert Q.op3_quality_classifier(empty(spark), labels).count() == 0
    none = Q.op3_quality_classifier(docs, labels.limit(0)).collect()
    assert all(math.isclose(r.score, 0.5) for r in none)

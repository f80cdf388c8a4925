"""The pipeline against plain Python, stage by stage."""

import re

import corpus_pipeline as CP
from llm_fixtures import SF, documents, empty, whole
from test_llm_packing import _valid
from test_llm_simhash import _fingerprint, _groups

from tidemark.llm import language
from tidemark.llm import packing as P


def _words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def test_stages_against_plain_python(spark):
    import numpy as np
    from tokenizers import Tokenizer

    docs = whole(spark, SF, "documents").collect()
    model = language.train_on_fold(whole(spark, SF, "documents"))
    kept = [d for d in docs if not model.predict(d.text)[2]]
    best = {}
    for d in kept:
        k = re.sub("[\x20\x09-\x0D]", "", d.text or "")
        if k not in best or (-len(d.text or ""), d.doc_id) < (-len(best[k].text or ""), best[k].doc_id):
            best[k] = d
    kept = sorted(best.values(), key=lambda d: d.doc_id)
    groups = _groups([_fingerprint(d.text) for d in kept])
    kept = [d for i, d in enumerate(kept) if groups[i] == i]
    windows = set()
    for b in whole(spark, SF, "benchmark").collect():
        w = _words(b.text)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    lengths = {len(w) for w in windows}
    kept = [d for d in kept if not any(tuple(w[i:i + n]) in windows for w in [_words(d.text)] for n in lengths
                                       for i in range(len(w) - n + 1))]
    rows = CP.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == {d.doc_id for d in kept}
    assert 0 < len(kept) < len(docs)
    tok, text = Tokenizer.from_file(P.tokenizer_path()), {d.doc_id: d.text for d in kept}
    n, total = _valid(rows, lambda d: np.array([*tok.encode(text[d], add_special_tokens=False).ids, 1], "<u4"))
    assert n <= -(-total // P.SEQUENCE) + 3


def test_stages_return_the_columns_of_documents(spark):
    for docs in (documents(spark), empty(spark)):
        for _, stage in CP.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.schema == docs.schema
            assert out.count() <= docs.count()
        assert CP.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_registered():
    import __spark_entry__ as e

    names = set(e.queries())
    assert "pipeline" in names and len([n for n in names if re.match(r"op\d+_", n)]) == 13
    assert [n for n, _ in CP.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination",
                                         "best_fit_packing"]

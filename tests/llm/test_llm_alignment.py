"""Cross-tokenizer alignment against a plain version, and its fragments."""

import hashlib
import random
from collections import Counter
from functools import reduce

import numpy as np
import pytest
from llm_fixtures import SF, documents, empty, multiset, whole
from pyspark.sql import functions as F

from tidemark.llm import alignment
from tidemark.llm.alignment import Fragment, Pair, align, compose, fragment, op12_alignment


@pytest.fixture(scope="module")
def pair():
    return Pair()


class Plain:
    """The contract with the tokenizers themselves, one text at a time."""

    def __init__(self):
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self.byte = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i)))
             for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode())
             for i in self.b.encode(text) for p in [self.b.id_to_piece(i)]]
        data = (" " + text).encode()
        if b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
            return [], []
        return a, b

    def __call__(self, docs):
        rows, counts = [], Counter()
        for doc_id, text in docs:
            a, b = self.tokens(text)
            spans = [[], []]
            for side, tokens in zip(spans, (a, b)):
                at = 0
                for i, x in tokens:
                    side.append((at, at + len(x), i))
                    at += len(x)
            links = [(x[2], y[2]) for x in spans[0] for y in _near(spans[1], x) if x[0] < y[1] and y[0] < x[1]]
            cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
            groups, s = [], 0
            for e in cuts:
                groups.append("|".join(",".join(str(i) for x, y, i in side if s <= x and y <= e) for side in
                                       ([t for t in _near(spans[0], (s, e))], [t for t in _near(spans[1], (s, e))])))
                s = e
            counts.update(links)
            rows.append((doc_id, len(a), len(b), links, groups))
        best = {}
        for (_, b), n in counts.items():
            best[b] = max(best.get(b, 0), n)
        return sorted(((d, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                        sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if links else "")
                       for d, n_a, n_b, links, groups in rows), key=repr)


def _near(spans, x):
    """Spans that may meet bytes x[0] to x[1]."""
    import bisect

    lo = bisect.bisect_right([e for _, e, _ in spans], x[0])
    hi = bisect.bisect_left([s for s, _, _ in spans], x[1])
    return spans[lo:hi]


AWKWARD = ["<|endoftext|> plain </s> <s><unk>", "  two  spaces ", "tab\tnew\n\n line\r\n", "▁marked▁ text", "漢字 and 😀😀 emoji é́",
           "a" * 700, " " * 300 + "x", "1234567890" * 30, " nbsp sep ﻿", "don't we'll I'd", "ﬁ ligature ①", "\x00\x01 control",
           "العربية עברית हिन्दी ไทย"]


def _docs():
    from llm_fixtures import rows

    return [(r[0], r[1] if r[1] is None or len(r[1]) < 6000 else r[1][:6000]) for r in rows()] + \
        [(100 + k, t) for k, t in enumerate(AWKWARD)] + [(101, AWKWARD[1])]


@pytest.mark.parametrize("chunk,fan,hot", [(1 << 15, 8, 1 << 18), (64, 2, 40), (7, 3, 1)])
def test_against_plain_version(spark, chunk, fan, hot):
    docs = _docs()
    frame = spark.createDataFrame([(d, t, "x", "x") for d, t in docs], "doc_id bigint, text string, row string, cold string")
    got = align(frame.repartition(3), chunk=chunk, fan=fan, hot_pairs=hot)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert multiset(got.select(*columns)) == Plain()(docs)


def test_ids_of_long_texts_are_stored_once(spark, monkeypatch):
    stored, write = {}, alignment.materialize

    def materialize(df, **how):
        made = write(df, **how)
        ids = [c for c in made.columns if c in ("a", "b", "pre_a", "pre_b", "suf_a", "suf_b")]
        for name in {how["name"]} if ids else ():
            size = sum(F.octet_length(c) for c in ids)
            stored[name] = stored.get(name, 0) + (made.agg(F.sum(size)).first()[0] or 0)
        return made

    monkeypatch.setattr(alignment, "materialize", materialize)
    r = random.Random(6)
    words = ["river", "unbelievable", "stone,", "naïveté", "12345", "漢字", "walks\n"]
    docs = [(i, " ".join(r.choices(words, k=900))) for i in range(3)] + [(9, "short")]
    got = align(spark.createDataFrame(docs, "doc_id bigint, text string"), chunk=1024)
    assert multiset(got) == Plain()(docs)
    assert sum(stored.values()) < 1.2 * stored["align-tokens"]


def test_as_many_pairs_as_allowed_are_looked_up(spark, monkeypatch):
    seen, count = [], alignment._stretch_counts

    def stretch_counts(stretches, hot, names):
        made = count(stretches, hot, names)
        seen.append((hot.num_rows, made.agg(F.sum(F.size("cold"))).first()[0]))
        return made

    monkeypatch.setattr(alignment, "_stretch_counts", stretch_counts)
    docs = _docs()
    want, frame = Plain()(docs), spark.createDataFrame(docs, "doc_id bigint, text string")
    assert multiset(align(frame)) == want
    (every, cold), = seen
    assert every > 100 and cold == 0
    for allowed in (every, every // 2, 3):
        assert multiset(align(frame, hot_pairs=allowed)) == want
        assert seen[-1][0] <= allowed and (seen[-1][1] == 0) == (allowed == every)


def test_query_against_plain_version(spark):
    docs = whole(spark, SF, "documents").select("doc_id", "text").limit(60)
    assert multiset(op12_alignment(docs)) == Plain()([tuple(r) for r in docs.collect()])


def test_empty_table_and_untouched_columns(spark):
    assert op12_alignment(empty(spark)).collect() == []
    assert op12_alignment(documents(spark)).count() == documents(spark).count()


def test_blocks_encode_as_the_whole(pair, monkeypatch):
    r = random.Random(2)
    text = "".join(r.choice(["word ", "two  ", "\n", "x-", "12", "é ", "漢 ", "   "]) for _ in range(4000))
    want = [x.tolist() for x in pair.encode(text)]
    assert len(want[0]) > 1000
    monkeypatch.setattr(alignment, "BLOCK", 50)
    assert [x.tolist() for x in pair.encode(text)] == want


def test_both_libraries_agree_on_plain_text(pair):
    r = random.Random(3)
    plain = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(161, 592)]]
    for _ in range(300):
        text = "".join(r.choices(plain, k=200)) + " ".join(r.choices(["it's", "we'll", "A1b2", "  ", "...", "\t"], k=30))
        assert pair.fast.encode_ordinary(text) == pair.a.encode(text, add_special_tokens=False).ids


def test_very_long_runs(pair):
    for text in ("a" * 300_000, " " * 300_000, "ab " * 100_000):
        a, b = pair.encode(text)
        assert pair.a_length[a].sum() == pair.b_length[b].sum() == len(text) + 1


def test_composition_is_associative(pair):
    a, b = pair.encode("unbelievable tokenization, naïveté 12345 and supercalifragilistic " * 3)
    ends_a, ends_b = pair.a_length[a].cumsum(), pair.b_length[b].cumsum()
    edges = np.arange(3, ends_a[-1], 5)
    at_a = [0, *np.searchsorted(ends_a, edges, "right"), len(a)]
    at_b = [0, *np.searchsorted(ends_b, edges, "right"), len(b)]
    base = lambda ends, k: int(ends[k - 1]) if k else 0
    parts = [fragment(pair, a[i:j], b[m:n], base(ends_a, i), base(ends_b, m))[0]
             for i, j, m, n in zip(at_a, at_a[1:], at_b, at_b[1:])]
    assert any(not f.cut for f in parts)
    left = reduce(lambda f, g: compose(f, g)[0], parts)
    assert left == reduce(lambda g, f: compose(f, g)[0], reversed(parts))
    assert left.cut and left.last == ends_a[-1] and not left.suf_a
    for f, g, h in zip(parts, parts[1:], parts[2:]):
        one, other = compose(compose(f, g)[0], h), compose(f, compose(g, h)[0])
        seams = {s for s in (compose(f, g)[1], one[1]) if s}, {s for s in (compose(g, h)[1], other[1]) if s}
        assert one[0] == other[0] and seams[0] == seams[1]
    nothing = Fragment(False, 0, b"", b"", b"", b"")
    assert all(compose(nothing, f)[0] == f == compose(f, nothing)[0] for f in parts)

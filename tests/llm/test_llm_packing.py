import random
import zlib

import numpy as np
from llm_fixtures import SF, documents, empty, texts, whole

from tidemark.llm import packing as P
from tidemark.llm.queries import LLM_QUERIES
from tidemark.llm.tokens import TokenIds


def test_ids_equal_the_tokenizer():
    t = TokenIds(P.tokenizer_path())
    r = random.Random(1)
    pool = [chr(c) for c in [*range(1, 0x250), *range(0x300, 0x370), *range(0x2000, 0x2070), 0x1F600, 0x3A3, 0x3C2, 0x212A]]
    odd = ["", " ", "<|startoftext|>hi<|endoftext|> <|STARTOFTEXT|>x", "don't I'LL x's\x1cq\x85z", "naïve CAFÉ Straße ẞ",
           "漢字 かな 😀👍🏽", "\x00\x01a\x7f~!@#", "é é́"]
    odd += ["".join(r.choice(pool) for _ in range(r.randint(1, 40))) for _ in range(1500)]
    for x in odd:
        want = np.array(t.whole.encode(x, add_special_tokens=False).ids, "<u4").tobytes()
        assert t.encode(x) == want, x
    small = TokenIds(P.tokenizer_path(), cache=2)  # a full cache changes nothing
    assert all(small.encode(x) == t.encode(x) for x in odd[-200:])


def _valid(rows, ids_of):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length >= 1
            at += length
        assert at <= P.SEQUENCE
    for d, parts in by_doc.items():
        ids, at = ids_of(d), 0
        for k, r in enumerate(sorted(parts, key=lambda r: r.piece)):
            part = ids[at:at + P.SEQUENCE]
            assert (r.piece, r.start, r.length) == (k, at, len(part))
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
            at += len(part)
        assert at == len(ids)
    return len(by_sequence), sum(r.length for r in rows)


def test_query(spark):
    from tokenizers import Tokenizer

    whole_tokenizer = Tokenizer.from_file(P.tokenizer_path())
    docs = texts(spark)
    ids = lambda d: np.array([*whole_tokenizer.encode(docs[d], add_special_tokens=False).ids, 1], "<u4")
    rows = LLM_QUERIES["op1_best_fit_packing"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(docs)
    n, total = _valid(rows, ids)
    assert n <= -(-total // P.SEQUENCE) + 3


def test_awkward_documents(spark):
    docs = documents(spark)
    pieces = P.token_pieces(docs)
    assert pieces.where("doc_id = 3").head().ids == (1).to_bytes(4, "little")
    packed = P.pack_documents(docs)
    assert packed.count() == pieces.count()
    assert packed.groupBy("doc_id").count().count() == docs.select("doc_id").distinct().count()
    over = packed.groupBy("sequence_id").agg({"length": "sum"}).where(f"`sum(length)` > {P.SEQUENCE}")
    assert over.count() == 0
    assert P.pack_documents(empty(spark)).count() == 0


def test_groups_pack_apart(spark):
    docs = whole(spark, SF, "documents")
    pieces = P.token_pieces(docs).drop("ids")
    packed = P.pack(pieces, group_pieces=40)
    assert packed.count() == pieces.count()
    assert packed.groupBy("sequence_id").agg({"length": "sum"}).where(f"`sum(length)` > {P.SEQUENCE}").count() == 0


def test_sum_of_squares_places_where_the_squares_grow_least():
    r = np.random.default_rng(3)
    lengths = r.integers(1, 21, 120)
    sequence, offset = P.sum_of_squares(lengths, 20)
    gaps = {}  # sequence -> gap, replayed
    for s, q, o in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
        def squares(g):
            values = [v for v in g.values() if v]
            return sum(values.count(v) ** 2 for v in set(values))

        options = [squares({**gaps, k: g - s}) for k, g in gaps.items() if g >= s] + [squares({**gaps, -1: 20 - s})]
        assert gaps.get(q, 20) >= s and o == 20 - gaps.get(q, 20)
        gaps[q] = gaps.get(q, 20) - s
        assert squares(gaps) == min(options)

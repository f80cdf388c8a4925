"""Token files: bits, random access, and whole round trips."""

import glob
import io
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import SF, documents, empty, rows, whole

from tidemark.llm.token_files import (TokenReader, TokenWriter, id_bits, op13_token_files, pack_bits, read_token_files,
                                      unpack_bits, write_token_files)
from tidemark.session import shared_path


@pytest.fixture(scope="module")
def ids_of():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("bits", range(1, 33))
def test_bits_round_trip_without_gaps(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 9, 100):
        ids = rng.integers(0, 1 << bits, n).astype(np.uint32)
        data = pack_bits(ids, bits)
        whole_number = sum(int(x) << (k * bits) for k, x in enumerate(ids))
        assert int.from_bytes(data, "little") == whole_number and len(data) == -(-n * bits // 8)
        assert unpack_bits(data, n, bits).tolist() == ids.tolist()


def test_fewest_bits():
    assert [id_bits(n) for n in (1, 2, 3, 256, 257, 49_408, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


@pytest.mark.parametrize("block", [8, 5, 64])
def test_any_range_is_read_from_its_blocks(block):
    rng = np.random.default_rng(block)
    docs = [rng.integers(0, 5000, n).astype(np.uint32) for n in (3, 0, 40, 1, 130)]
    out = io.BytesIO()
    writer = TokenWriter(out, 5000, pa.string(), block)
    for k, ids in enumerate(docs):
        writer.add(f"d{k}" if k else None, ids.astype("<u4").tobytes())
    writer.close()
    data, every = out.getvalue(), np.concatenate(docs)

    class Watched(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            self.taken += n
            return super().read(n)

    source = Watched(data)
    reader = TokenReader(source, len(data))
    assert reader.bits == 13 and reader.documents()["doc_id"].to_pylist() == [None, "d1", "d2", "d3", "d4"]
    for s in range(0, len(every) + 1, 3):
        for e in range(s, len(every) + 1, 7):
            source.taken = 0
            assert reader.read(s, e).tolist() == every[s:e].tolist()
            assert source.taken <= ((e - s) // block + 2) * -(-block * 13 // 8)
    assert list(reader.checksums(reader.documents())) == [_crc(d) for d in docs]
    with pytest.raises(ValueError):
        bad = TokenWriter(io.BytesIO(), 5000, pa.string(), block)
        bad.add("x", np.array([5000], "<u4").tobytes())
        bad.close()
    with pytest.raises(ValueError):
        TokenReader(io.BytesIO(b"x" * 100), 100)


def _expected(docs, ids_of):
    """``doc_id -> sorted (n_tokens, crc)`` and the start of each id's first row."""
    per, at, starts = {}, 0, {}
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        starts.setdefault(doc_id, at)
        ids = ids_of(text)
        per.setdefault(doc_id, []).append((len(ids), _crc(ids)))
        at += len(ids)
    return {k: sorted(v) for k, v in per.items()}, starts


def _check(got, docs, ids_of):
    want, starts = _expected(docs, ids_of)
    per = {}
    for r in got:
        per.setdefault(r.doc_id, []).append(r)
    assert {k: sorted((r.n_tokens, r.ids_crc32) for r in v) for k, v in per.items()} == want
    assert {k: min(r.start for r in v) for k, v in per.items()} == starts
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *[r.n_tokens for r in ordered]])[:-1].tolist()


def test_query_against_the_tokenizer(spark, ids_of):
    docs = whole(spark, SF, "documents").select("doc_id", "text")
    got = op13_token_files(docs).collect()
    _check(got, [tuple(r) for r in docs.collect()], ids_of)
    starts = [r.start for r in sorted(got, key=lambda r: r.doc_id)]
    assert starts == sorted(starts)


def test_awkward_documents_in_small_files(spark, ids_of):
    docs = [(r[0], r[1]) for r in rows()] + [(3, f"row {k}") for k in range(300)] + [(None, "")] * 50
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id bigint, text string, row string, part string")
    folder = shared_path(spark, "token-file-test")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one task
    try:
        files = write_token_files(table.repartition(3), folder, block=40, file_ids=500, file_docs=30)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    _check(read_token_files(files, table.schema["doc_id"].dataType).collect(), docs, ids_of)
    found = glob.glob(os.path.join(folder.removeprefix("file:"), "*"))
    assert len(found) == files.count() > 12
    assert sum(r.bytes for r in files.collect()) == sum(os.path.getsize(f) for f in found)
    # one id on most rows lies in several parts
    assert len({r.part for r in files.where("docs > 0").collect()}) > 1


def test_bits_on_disk(spark):
    folder = shared_path(spark, "token-file-size")
    docs = whole(spark, SF, "documents")
    files = write_token_files(docs, folder).collect()
    ids, size = sum(f.ids for f in files), sum(f.bytes for f in files)
    assert 2 * ids < size < 2 * ids + 40 * sum(f.docs for f in files) + 4000 * len(files)


def test_empty_table(spark):
    assert op13_token_files(empty(spark)).collect() == []
    assert op13_token_files(documents(spark)).count() == documents(spark).count()

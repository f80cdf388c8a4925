"""Token ids in files of fixed-width bit fields.

Every id takes the fewest bits that hold the vocabulary. Ids are packed in
blocks; a block starts on a byte of its own, and the file lists where each one
starts, so any range of ids is read by itself and unpacked by whole numpy
columns (eight ids always fill as many bytes as an id has bits).

File layout (numbers little-endian)::

    magic       8 bytes
    blocks      ids packed from the lowest bit on, BLOCK ids each (the last one: the rest)
    offsets     unsigned 64-bit byte position of every block, and of their end
    documents   Arrow stream of doc_id, start (ids before it in the file), length
    trailer     ids, position of offsets, position of documents (unsigned 64-bit),
                bits of an id, ids of a block (unsigned 32-bit), magic

Rows are dealt to tasks by ranges of the document id, then of the text's hash
and the row's number, so that one id on very many rows is split too. A task
encodes its rows in order and writes files of bounded size, each under a
temporary name first; a task that runs again writes the same files again.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import key_text, python_stage
from tidemark.session import (TEMP_PREFIX, default_parallelism, materialize, put_in_place, qualify, resolve_path,
                              shared_path)

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: ids of a block; a file takes no further document once it holds so many ids or documents
BLOCK, FILE_IDS, FILE_DOCS = 4096, 1 << 24, 1 << 18
#: words whose ids a worker keeps
WORDS = 500_000
#: blocks that are packed, or fetched by a sequential reader, at once
_RUN = 64
_MAGIC = b"TIDEIDS1"
_TRAILER = struct.Struct("<3Q2I8s")


def id_bits(vocabulary: int) -> int:
    """The fewest bits that tell ``vocabulary`` ids apart."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """The ids in ``bits`` bits each, without gaps, from the lowest bit on."""
    if bits in (8, 16, 32):  # whole bytes
        return ids.astype(f"<u{bits // 8}").tobytes()
    groups = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    groups.ravel()[:len(ids)] = ids
    out = np.zeros((len(groups), bits), np.uint8)
    for lane in range(8):
        byte, shift = divmod(lane * bits, 8)
        value = groups[:, lane] << np.uint64(shift)
        for k in range(-(-(shift + bits) // 8)):
            out[:, byte + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()[:-(-len(ids) * bits // 8)]


def unpack_bits(data: bytes, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of :func:`pack_bits`."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    groups = -(-count // 8)
    packed = np.zeros(groups * bits, np.uint8)
    packed[:len(data)] = np.frombuffer(data, np.uint8)[:groups * bits]
    packed = packed.reshape(groups, bits)
    out = np.empty((groups, 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(8):
        byte, shift = divmod(lane * bits, 8)
        value = np.zeros(groups, np.uint64)
        for k in range(-(-(shift + bits) // 8)):
            value |= packed[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, lane] = (value >> np.uint64(shift)) & mask
    return out.ravel()[:count]


_ENCODERS: dict = {}


def _encoder(path: str):
    """One tokenizer per worker process, with room for more words than the
    stages that hold pieces in memory can spare."""
    from tidemark.llm.tokens import TokenIds

    if path not in _ENCODERS:
        _ENCODERS[path] = TokenIds(path, cache=WORDS)
    return _ENCODERS[path]


class TokenWriter:
    """Writes documents' ids to an open binary file."""

    def __init__(self, out, vocabulary: int, id_type: pa.DataType, block: int = BLOCK):
        self.out, self.bits, self.block, self.vocabulary = out, id_bits(vocabulary), block, vocabulary
        self.id_type = id_type
        self.at = self.out.write(_MAGIC) or len(_MAGIC)
        self.offsets: list[int] = []
        self.ids = 0
        self.open: list[bytes] = []  # ids not yet packed
        self.open_ids = 0
        self.docs: tuple[list, list, list] = ([], [], [])

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _pack(self, last: bool) -> None:
        """Packs the whole blocks that are open, and the rest where it is the last."""
        ids = np.frombuffer(b"".join(self.open), "<u4")
        if len(ids) and int(ids.max()) >= self.vocabulary:
            raise ValueError(f"an id is outside the vocabulary of {self.vocabulary}")
        whole = len(ids) if last else len(ids) // self.block * self.block
        # blocks of a multiple of eight ids end on a byte, so many are packed at once
        step = self.block * (_RUN if self.block % 8 == 0 else 1)
        for k in range(0, whole, step):
            part = ids[k:min(k + step, whole)]
            self.offsets += range(self.at, self.at + len(part) * self.bits // 8 + 1, max(1, self.block * self.bits // 8))[
                :-(-len(part) // self.block)]
            self._write(pack_bits(part, self.bits))
        self.open = [ids[whole:].tobytes()]
        self.open_ids = len(ids) - whole

    def add(self, doc_id, ids: bytes) -> None:
        """One document's ids, as little-endian unsigned 32-bit integers."""
        for column, value in zip(self.docs, (doc_id, self.ids, len(ids) // 4)):
            column.append(value)
        self.ids += len(ids) // 4
        self.open.append(ids)
        self.open_ids += len(ids) // 4
        if self.open_ids >= _RUN * self.block:
            self._pack(False)

    def close(self) -> None:
        """Writes the last block and the lists behind it; the file stays open."""
        self._pack(True)
        offsets_at = self.at
        self._write(np.array([*self.offsets, self.at], "<u8").tobytes())
        docs_at = self.at
        sink = pa.BufferOutputStream()
        table = pa.table([pa.array(self.docs[0], self.id_type), *[pa.array(c, pa.int64()) for c in self.docs[1:]]],
                         ["doc_id", "start", "length"])
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table)
        self._write(sink.getvalue().to_pybytes())
        self._write(_TRAILER.pack(self.ids, offsets_at, docs_at, self.bits, self.block, _MAGIC))


class TokenReader:
    """Random access to a file of :class:`TokenWriter`."""

    def __init__(self, source, size: int):
        self.source = source
        self.ids, self.offsets_at, self.docs_at, self.bits, self.block, magic = _TRAILER.unpack(
            self._bytes(size - _TRAILER.size, size))
        if magic != _MAGIC or self._bytes(0, len(_MAGIC)) != _MAGIC:
            raise ValueError("not a token file")
        self.offsets = np.frombuffer(self._bytes(self.offsets_at, self.docs_at), "<u8")
        self.end = size - _TRAILER.size

    def _bytes(self, start: int, stop: int) -> bytes:
        self.source.seek(start)
        return self.source.read(stop - start)

    def documents(self) -> pa.Table:
        """``doc_id, start, length`` in file order."""
        return pa.ipc.open_stream(self._bytes(self.docs_at, self.end)).read_all()

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``; only the blocks that hold them are read."""
        start, stop = max(0, start), min(stop, self.ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        data, base = self._bytes(int(self.offsets[first]), int(self.offsets[last + 1])), int(self.offsets[first])
        if self.block % 8 == 0:  # whole blocks fill whole bytes, so all are unpacked at once
            found = unpack_bits(data, min(self.ids, (last + 1) * self.block) - first * self.block, self.bits)
        else:
            found = np.concatenate([
                unpack_bits(data[int(self.offsets[k]) - base:int(self.offsets[k + 1]) - base],
                            min(self.block, self.ids - k * self.block), self.bits) for k in range(first, last + 1)])
        return found[start - first * self.block:stop - first * self.block]

    def checksums(self, docs: pa.Table) -> Iterator[int]:
        """CRC-32 of each document's ids as little-endian unsigned 32-bit
        integers; the file is read once, a run of blocks at a time."""
        run, low = np.zeros(0, "<u4"), 0
        for start, length in zip(docs["start"].to_pylist(), docs["length"].to_pylist()):
            crc, at = 0, start
            while at < start + length:
                if not low <= at < low + len(run):
                    low = at // self.block * self.block
                    run = self.read(low, low + _RUN * self.block).astype("<u4", copy=False)
                part = run[at - low:start + length - low]
                crc = zlib.crc32(part, crc)
                at += len(part)
            yield crc


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int | None = END_ID,
                      block: int = BLOCK, file_ids: int = FILE_IDS, file_docs: int = FILE_DOCS, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Encodes all texts and writes their ids to files in ``folder``, by
    ascending document id. Returns the written list of files: ``part, roll,
    path, bytes, docs, ids`` (files follow one another by part and roll)."""
    spark = docs.sparkSession
    python_stage(spark)
    root = qualify(spark, folder)
    order = ["doc_id", "hash", "row"]
    source = key_text(docs, id_col, text_col).select(
        "doc_id", "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    ordered = source.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ddl = "part int, roll int, path string, bytes long, docs long, ids long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from tidemark.llm.packing import tokenizer_path

        store, base = resolve_path(root)
        part = TaskContext.get().partitionId()
        tokens = _encoder(tokenizer_path(tokenizer))
        vocabulary = tokens.whole.get_vocab_size()
        end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
        made, out, writer, temp = [], None, None, None

        def finish() -> None:
            nonlocal out, writer
            writer.close()
            out.close()
            name = f"part-{part:06d}-{len(made):05d}.ids"
            put_in_place(store, temp, f"{base}/{name}")
            size = store.get_file_info(f"{base}/{name}").size
            made.append((part, len(made), f"{root}/{name}", size, len(writer.docs[0]), writer.ids))
            out = writer = None

        try:
            for batch in batches:
                for i in range(batch.num_rows):
                    if writer is None:
                        store.create_dir(base, recursive=True)
                        temp = f"{base}/{TEMP_PREFIX}{uuid.uuid4().hex}"
                        out = store.open_output_stream(temp)
                        writer = TokenWriter(out, vocabulary, batch.column(0).type, block)
                    writer.add(batch.column(0)[i].as_py(), tokens.encode(batch.column(1)[i].as_py()) + end)
                    if writer.ids >= file_ids or len(writer.docs[0]) >= file_docs:
                        finish()
            if writer is not None:
                finish()
        finally:
            if out is not None:  # a failed attempt leaves nothing behind
                out.close()
                store.delete_file(temp)
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[c] for m in made], t) for c, t in enumerate(
                (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
            ["part", "roll", "path", "bytes", "docs", "ids"])

    return materialize(ordered.mapInArrow(run, ddl), name="token-file-list")


def read_token_files(files: DataFrame, id_type: T.DataType) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read from the
    files; ``start`` counts the ids of all documents before it."""
    spark = files.sparkSession
    python_stage(spark)
    # there are as many parts as the writing stage had tasks
    inside = Window.partitionBy("part").orderBy("roll").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    placed = files.join(starts, "part").select(
        "path", "bytes", (F.col("ahead") + F.coalesce(F.sum("ids").over(inside), F.lit(0))).alias("ahead"))
    tasks = max(1, min(files.count(), 16 * default_parallelism(spark)))  # files are of like size
    schema = T.StructType([T.StructField("doc_id", id_type), *[T.StructField(c, T.LongType())
                                                               for c in ("start", "n_tokens", "ids_crc32")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, ahead in zip(*[c.to_pylist() for c in batch.columns]):
                store, name = resolve_path(path)
                with store.open_input_file(name) as source:
                    reader = TokenReader(source, size)
                    docs = reader.documents()
                    yield pa.RecordBatch.from_arrays(
                        [docs["doc_id"].combine_chunks(), pa.array(docs["start"].to_numpy() + ahead, pa.int64()),
                         docs["length"].combine_chunks(), pa.array(list(reader.checksums(docs)), pa.int64())], schema.names)

    return placed.repartition(tasks).mapInArrow(run, schema)


def store_tokens(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the documents' token files (to a fresh shared folder unless one
    is named) and reads them back: ``doc_id, start, n_tokens, ids_crc32``.

    Defined cases: a NULL or empty text is the end id alone; NULL ids come
    first; rows of one id follow one another by the hash of their text, and
    repeated rows are stored each; a text of any length lies in one file,
    which it alone may swell; equal texts give equal checksums; an empty table
    writes no file and gives an empty result; other columns are ignored.
    """
    folder = folder or shared_path(docs.sparkSession, "token-files")
    files = write_token_files(docs, folder, id_col=id_col, text_col=text_col)
    return read_token_files(files, docs.schema[id_col].dataType)


def op13_token_files(docs: DataFrame) -> DataFrame:
    """The contract's digest: :func:`store_tokens`."""
    return store_tokens(docs)

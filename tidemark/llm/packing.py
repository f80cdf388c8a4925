"""Sum-of-squares packing of token pieces into fixed-length sequences.

A piece goes into the open sequence (or a new one) that leaves the sum of the
squared counts of open sequences per residual gap smallest. Pieces come in
decreasing length, so short ones close the last gaps.

Pieces are dealt to groups of about GROUP_PIECES; each group packs by itself
from its own counts, in one task with memory for that many pieces. The waste
is a few sequences a group, whatever the number of groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import key_text, python_stage
from tidemark.session import materialize

SEQUENCE = 4096
END_ID = 1
GROUP_PIECES = 16_000
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed public tokenizer files lie on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, sequence: int = SEQUENCE, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids``: each document's token ids and
    the end id, cut after every ``sequence`` ids. ``ids`` holds little-endian
    unsigned 32-bit integers. A NULL or empty text is the end id alone."""
    source = key_text(docs, id_col, text_col)
    python_stage(docs.sparkSession)
    schema = T.StructType([source.schema["doc_id"], T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids", T.BinaryType())])
    end = int(end_id).to_bytes(4, "little")
    width = 4 * sequence

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tidemark.llm.tokens import loaded

        encode = loaded(tokenizer_path(tokenizer)).encode
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 256):  # bounds the output in memory
                own, piece, start, ids = [], [], [], []
                for i in range(at, min(at + 256, batch.num_rows)):
                    whole = encode(texts[i].as_py()) + end
                    for k in range(0, len(whole), width):
                        own.append(i)
                        piece.append(k // width)
                        start.append(k // 4)
                        ids.append(whole[k:k + width])
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(own, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "piece", "start", "length", "ids"])

    return source.mapInArrow(cut, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, taken in the given order.

    ``count[g]`` is the number of open sequences with gap ``g``. Moving one
    from gap ``g`` to ``g - s`` changes the sum of squares by
    ``2 (count[g - s] - count[g]) + 2``, closing one by ``1 - 2 count[s]``,
    opening one by ``1 + 2 count[capacity - s]``; the smallest change wins, an
    open sequence before a new one, the smaller gap first.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i, s in enumerate(lengths.tolist()):
        best, gap = 1 + 2 * int(count[capacity - s]) if s < capacity else 1, capacity
        if s < capacity:
            now = count[s:capacity]
            change = 2 * (count[:capacity - s] - now) + 2
            change[0] = 1 - 2 * now[0]
            change[now == 0] = np.iinfo(np.int64).max
            j = int(change.argmin())
            if change[j] <= best and now[j]:
                gap = s + j
        if gap == capacity:
            place, made = made, made + 1
        else:
            place = open_at[gap].pop()
            count[gap] -= 1
        sequence[i], offset[i] = place, capacity - gap
        if gap > s:
            count[gap - s] += 1
            open_at[gap - s].append(place)
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (any columns, with ``doc_id, piece, length``; every length
    from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    The pieces are written once and dealt to the groups in turn, so repeated
    rows and equal keys spread evenly. An empty table gives an empty result.
    """
    stored = materialize(pieces, name="pack-pieces")
    groups = max(1, -(-stored.count() // group_pieces))
    dealt = stored.withColumn("__group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
    schema = T.StructType([*stored.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        sequence, offset = sum_of_squares(table["length"].to_numpy(), capacity)
        base = table["__group"][0].as_py() << 32
        return (table.drop_columns(["__group"]).append_column("sequence_id", pa.array(sequence + base))
                .append_column("offset", pa.array(offset)))

    return dealt.groupBy("__group").applyInArrow(place, schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document cut into pieces and packed: ``doc_id, piece, start,
    length, ids_crc32, sequence_id, offset``. The ids themselves come from
    :func:`token_pieces`; here only their checksum travels.

    Defined cases: a NULL text counts as empty (its end id is packed); a NULL
    id is kept; repeated rows are packed each; equal lengths are placed by id;
    other columns are ignored; an empty table gives an empty result.
    """
    pieces = token_pieces(docs, id_col=id_col, text_col=text_col)
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op1_best_fit_packing(docs: DataFrame) -> DataFrame:
    """The contract's digest: :func:`pack_documents`."""
    return pack_documents(docs)

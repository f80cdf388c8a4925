"""Alignment of two tokenizers over the same bytes.

Both tokenizers' tokens cover the bytes of a space and the text. Where a token
of each ends at the same byte, the text is cut; between two cuts lies a group,
and inside it every pair of tokens with overlapping bytes is a link.

A text is held as chunks of a byte range; a token belongs to the chunk it ends
in. A chunk by itself yields a fragment: tokens up to its first cut (open
prefix), closed groups, and tokens after its last cut (open suffix). Fragments
compose: a suffix and the next prefix close into one group, a fragment without
a cut only lengthens its neighbours' open ends. Composition is associative, so
the fragments of a very long text meet in a tree of small groups over Spark
tasks; closed groups stay in their chunk, which is stored once, and only open
ends travel.

Counts of id pairs cover the whole corpus. The most frequent pairs (at most
HOT_PAIRS, and all that hold a HOT_PAIRS-th of the links each) are looked up in
the tasks; the links of all other pairs meet their counts in a join, where no
key is frequent.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import key_text, python_stage
from tidemark.llm.tokens import _byte_symbols
from tidemark.session import materialize

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: bytes of a chunk, and fragments that one step of the tree composes
CHUNK, FAN = 1 << 15, 8
HOT_PAIRS = 1 << 18
#: characters of a block that is encoded at once
BLOCK = 1 << 20
#: pairs that a task counts before it passes them on, and rows it links at once
_PAIRS, _ROWS = 1 << 21, 128

#: characters on which both libraries for A split alike; others go to the tokenizer file's own
_PLAIN = re.compile(r"[\t\n\r -~¡-ɏ]*")
_LONG_SPACE = re.compile(r"\s{2000}")
_BREAK = re.compile(r"(?<=\S) ")


class Pair:
    """Two tokenizers of one text, and the bytes of their tokens."""

    def __init__(self, a: str = TOKENIZER_A, b: str = TOKENIZER_B):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path(a))
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b))
        byte = {c: bytes([i]) for i, c in enumerate(_byte_symbols())}
        special = {i for i, t in self.a.get_added_tokens_decoder().items() if t.special}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            if i not in special:
                self.a_bytes[i] = b"".join([byte[c] for c in token])
        ranks = {t: i for i, t in enumerate(self.a_bytes) if t}
        # the same vocabulary and merges, faster on plain text
        self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        piece = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(piece)]
        self.size_a, self.size_b = len(self.a_bytes), len(self.b_bytes)
        self.kind = np.dtype("<u2" if max(self.size_a, self.size_b) <= 1 << 16 else "<u4")
        self.a_length = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_length = np.array([len(t) for t in self.b_bytes], np.int64)
        self._digits()

    def _digits(self) -> None:
        """Each id's decimal digits and the mark behind it, zero-padded: A ids
        with a comma, A ids with a bar, B ids with a comma, B ids with a semicolon."""
        texts = [f"{i}{mark}".encode() for size, marks in ((self.size_a, ",|"), (self.size_b, ",;"))
                 for mark in marks for i in range(size)]
        width = max(map(len, texts))
        self.text = np.frombuffer(b"".join([t.ljust(width, b"\0") for t in texts]), np.uint8).reshape(-1, width)
        self.text_length = np.array([len(t) for t in texts], np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A over a space and the text and of B, which adds the space
        itself; none where either's bytes differ from these. Both tokenizers
        start anew at a space behind another character, so a very long text
        goes block by block."""
        whole = " " + text
        edges = [0]
        while len(whole) - edges[-1] > BLOCK and (m := _BREAK.search(whole, edges[-1] + BLOCK)):
            edges.append(m.start())
        a, b, a_text, b_text = [], [], [], []
        for s, e in zip(edges, [*edges[1:], len(whole)]) if text else ():
            block = whole[s:e]
            if _PLAIN.fullmatch(block) and not _LONG_SPACE.search(block):
                ids = self.fast.encode_ordinary(block)
            else:
                ids = self.a.encode(block, add_special_tokens=False).ids
            a.append(np.array(ids, self.kind))
            a_text.append(b"".join([self.a_bytes[i] for i in ids]))
            ids = self.b.encode(block[1:], num_threads=1)
            b.append(np.array(ids, self.kind))
            b_text.append(b"".join([self.b_bytes[i] for i in ids]))
        data = whole.encode()
        if not a or b"".join(a_text) != data or b"".join(b_text) != data:
            return np.zeros(0, self.kind), np.zeros(0, self.kind)
        return np.concatenate(a), np.concatenate(b)


_LOADED: dict[tuple[str, str], Pair] = {}


def loaded(a: str, b: str) -> Pair:
    if (a, b) not in _LOADED:
        _LOADED[a, b] = Pair(a, b)
    return _LOADED[a, b]


# -- fragments ----------------------------------------------------------------


class Fragment(NamedTuple):
    """What a stretch of tokens leaves open. Without a cut all tokens are
    prefix; ``last`` is the byte of the last cut. Token ids as bytes."""

    cut: bool
    last: int
    pre_a: bytes
    pre_b: bytes
    suf_a: bytes
    suf_b: bytes


def fragment(pair: Pair, a: np.ndarray, b: np.ndarray, base_a: int, base_b: int) -> tuple[Fragment, int, bytes, bytes]:
    """The fragment of a chunk whose tokens begin at the given bytes, and its
    closed groups: where they start, and their A and B ids."""
    ends_a, ends_b = base_a + pair.a_length[a].cumsum(), base_b + pair.b_length[b].cumsum()
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    if not len(cuts):
        return Fragment(False, 0, a.tobytes(), b.tobytes(), b"", b""), 0, b"", b""
    i, k = np.searchsorted(ends_a, cuts[[0, -1]], "right")
    j, m = np.searchsorted(ends_b, cuts[[0, -1]], "right")
    open_ends = Fragment(True, int(cuts[-1]), a[:i].tobytes(), b[:j].tobytes(), a[k:].tobytes(), b[m:].tobytes())
    return open_ends, int(cuts[0]), a[i:k].tobytes(), b[j:m].tobytes()


def compose(f: Fragment, g: Fragment) -> tuple[Fragment, tuple[int, bytes, bytes] | None]:
    """The fragment of two neighbours, and the group that closes between them."""
    if not f.cut:
        return Fragment(g.cut, g.last, f.pre_a + g.pre_a, f.pre_b + g.pre_b, g.suf_a, g.suf_b), None
    if not g.cut:
        return Fragment(True, f.last, f.pre_a, f.pre_b, f.suf_a + g.pre_a, f.suf_b + g.pre_b), None
    seam = (f.last, f.suf_a + g.pre_a, f.suf_b + g.pre_b)
    return Fragment(True, g.last, f.pre_a, f.pre_b, g.suf_a, g.suf_b), seam


_FRAGMENT = "cut boolean, last long, pre_a binary, pre_b binary, suf_a binary, suf_b binary"


def _open_ends(long: DataFrame, names: tuple[str, str]) -> DataFrame:
    """The fragment of every chunk of the long texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(*names)
        for batch in batches:
            yield pa.RecordBatch.from_pylist(
                [{"row": r["row"], "k": r["chunk"],
                  **fragment(pair, np.frombuffer(r["a"], pair.kind), np.frombuffer(r["b"], pair.kind),
                             r["base_a"], r["base_b"])[0]._asdict()} for r in batch.to_pylist()], schema)

    spark_schema = f"row long, k long, {_FRAGMENT}"
    schema = _arrow(spark_schema)
    return long.mapInArrow(run, spark_schema)


def _closed(pair: Pair, batch: pa.RecordBatch) -> tuple[list[bytes], list[bytes]]:
    """A and B ids of every row's closed groups: a chunk of a longer text (its
    row has the bytes where it begins) goes without its open ends, any other
    row is closed as it is."""
    a, b, base_a, base_b = (batch.column(c).to_pylist() for c in ("a", "b", "base_a", "base_b"))
    for i, base in enumerate(base_a):
        if base is not None:
            a[i], b[i] = fragment(pair, np.frombuffer(a[i], pair.kind), np.frombuffer(b[i], pair.kind), base, base_b[i])[2:]
    return a, b


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def _tree_step(fragments: DataFrame, fan: int) -> DataFrame:
    """Composes ``fan`` neighbours each. Rows with ``closed`` are the groups
    that closed (from ``last``, ids in the prefix), the others the fragments
    of the next step."""
    ddl = f"row long, k long, closed boolean, {_FRAGMENT}"
    schema = _arrow(ddl)

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["k"])
        parts = [Fragment(*[r[c] for c in Fragment._fields]) for r in rows]
        row, k, out = rows[0]["row"], rows[0]["k"] // fan, []
        whole = parts[0]
        for part in parts[1:]:
            whole, seam = compose(whole, part)
            if seam:
                out.append({"row": row, "k": k, "closed": True, "cut": True, "last": seam[0], "pre_a": seam[1],
                            "pre_b": seam[2], "suf_a": b"", "suf_b": b""})
        out.append({"row": row, "k": k, "closed": False, **whole._asdict()})
        return pa.Table.from_pylist(out, schema)

    columns = ["row", "k", *Fragment._fields]
    return fragments.select(*columns).groupBy("row", F.floor(F.col("k") / fan)).applyInArrow(run, ddl)


def _seams(tokens: DataFrame, longest: int, names: tuple[str, str], fan: int) -> DataFrame:
    """``row, start, a, b``: the groups of the texts of more than one chunk
    that no chunk closes by itself, and where they start."""
    made = materialize(_open_ends(tokens.where(F.col("chunks") > 1), names), name="align-fragments", compression="zstd")
    ids = [F.col("pre_a").alias("a"), F.col("pre_b").alias("b")]
    closed = []
    while longest > 1:
        step = materialize(_tree_step(made, fan), name="align-tree", compression="zstd")
        closed.append(step.where("closed").select("row", F.col("last").alias("start"), *ids))
        made, longest = step.where(~F.col("closed")), -(-longest // fan)
    # a text starts and ends at a cut: the root's prefix is its first group, its suffix is empty
    closed.append(made.select("row", F.lit(0).cast("bigint").alias("start"), *ids))
    return reduce(DataFrame.unionAll, closed)


# -- links --------------------------------------------------------------------


class Links:
    """Links and groups of many closed stretches, side by side: every byte
    where a token ends closes exactly one link, of the tokens that hold it."""

    def __init__(self, pair: Pair, a: list[bytes], b: list[bytes]):
        self.pair = pair
        self.a = np.frombuffer(b"".join(a), pair.kind).astype(np.int64)
        self.b = np.frombuffer(b"".join(b), pair.kind).astype(np.int64)
        ends_a, ends_b = pair.a_length[self.a].cumsum(), pair.b_length[self.b].cumsum()
        mark = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, np.uint8)
        mark[ends_a] = 1
        mark[ends_b] |= 2
        at = np.nonzero(mark)[0]
        kind = mark[at]
        self.ends_a, self.ends_b = (kind & 1).astype(bool), (kind & 2).astype(bool)
        self.cut = kind == 3
        self.link_a, self.link_b = self.ends_a.cumsum() - self.ends_a, self.ends_b.cumsum() - self.ends_b
        self.pairs = self.a[self.link_a] * pair.size_b + self.b[self.link_b]
        # of each stretch: tokens and links up to its end
        width = pair.kind.itemsize
        self.to_a = np.array([len(x) // width for x in a], np.int64).cumsum()
        self.to_b = np.array([len(x) // width for x in b], np.int64).cumsum()
        reach = np.concatenate([[0], ends_a])[self.to_a]
        self.to_link = np.searchsorted(at, reach, "right")

    def per_stretch(self, upto: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
        """Sums of the values (or counts) over each stretch."""
        if values is not None:
            upto = np.concatenate([[0], values.astype(np.int64).cumsum()])[upto]
        return np.diff(upto, prepend=0)

    def texts(self) -> list[memoryview]:
        """Of each stretch: its groups, ``a1,a2|b1;a3|b2,b3;``."""
        p = self.pair
        group = self.cut.cumsum() - self.cut
        of_a, of_b = group[self.ends_a], group[self.ends_b]
        n = int(self.cut.sum())
        n_a, n_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + (n_b.cumsum() - n_b)[of_a]] = self.a + p.size_a * self.cut[self.ends_a]
        codes[np.arange(len(self.b)) + n_a.cumsum()[of_b]] = 2 * p.size_a + self.b + p.size_b * self.cut[self.ends_b]
        data = p.text[codes].ravel()
        data = memoryview(data[data != 0])
        ends = np.concatenate([[0], p.text_length[codes].cumsum()])[self.to_a + self.to_b].tolist()
        return [data[s:e] for s, e in zip([0, *ends], ends)]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a few rows each, as a token takes many times its bytes here."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _pair_counts(stretches: DataFrame, names: tuple[str, str]) -> DataFrame:
    """``pair, n``: links per id pair (``a * size_b + b``) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, back = np.unique(np.concatenate([k for k, _ in seen]), return_inverse=True)
            return keys, np.bincount(back, np.concatenate([c for _, c in seen])).astype(np.int64)

        pair = loaded(*names)
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for batch in _slices(batches):
            got = np.unique(Links(pair, *_closed(pair, batch)).pairs, return_counts=True)
            seen.append(got)
            held += len(got[0])
            if held > _PAIRS:
                seen = [merged()]
                held = len(seen[0][0])
                if held > _PAIRS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in seen.pop()], ["pair", "n"])
                    held = 0
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], ["pair", "n"])

    made = stretches.select("a", "b", "base_a", "base_b").mapInArrow(run, "pair long, n long")
    return made.groupBy("pair").agg(F.sum("n").alias("n"))


def _hot_floor(pairs: DataFrame, hot_pairs: int) -> float:
    """The count from which a pair is looked up in the tasks. At most
    ``hot_pairs`` pairs have it, and at least all with a ``hot_pairs``-th of
    the links."""
    # pairs by eighths of an octave of their count: some hundred rows
    steps = pairs.groupBy(F.floor(F.log2("n") * 8).alias("step")).agg(
        F.count("n").alias("pairs"), F.sum("n").alias("links"), F.min("n").alias("least")).collect()
    floor, held = sum(r.links for r in steps) / hot_pairs, 0
    for r in sorted(steps, key=lambda r: -r.step):
        held += r.pairs
        if held > hot_pairs:
            break
        floor = min(floor, r.least)
    return floor


_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _stretch_counts(stretches: DataFrame, hot: pa.Table, names: tuple[str, str]) -> DataFrame:
    """Counts of every stretch with the frequent pairs looked up; ``cold``
    lists the other pairs with their links in the stretch."""
    shared = stretches.sparkSession.sparkContext.broadcast(  # at most HOT_PAIRS rows
        [hot["pair"].to_numpy(), hot["n"].to_numpy(), hot["best"].to_numpy()])
    schema = T.StructType([T.StructField("row", T.LongType()), stretches.schema["doc_id"],
                           *[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("groups_sha256", T.BinaryType()),
                           T.StructField("cold", T.ArrayType(T.StructType([T.StructField("pair", T.LongType()),
                                                                           T.StructField("links", T.LongType())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(*names)
        keys, counts, best = shared.value
        space = pair.size_a * pair.size_b
        for batch in _slices(batches):
            links = Links(pair, *_closed(pair, batch))
            place = np.minimum(np.searchsorted(keys, links.pairs), max(0, len(keys) - 1))
            found = keys[place] == links.pairs if len(keys) else np.zeros(len(links.pairs), bool)
            total = np.where(found, counts[place], 0) if len(keys) else found
            top = found & best[place] if len(keys) else found
            n_links = links.per_stretch(links.to_link)
            owner = np.repeat(np.arange(batch.num_rows), n_links)[~found]
            rare, times = np.unique(owner * space + links.pairs[~found], return_counts=True)
            ends = np.searchsorted(rare // space, np.arange(batch.num_rows + 1))
            cold = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(rare % space), pa.array(times.astype(np.int64))], ["pair", "links"]))
            digests = [hashlib.sha256(t[:-1]).digest() if whole and len(t) else b"" if whole else None
                       for t, whole in zip(links.texts(), batch.column("whole").to_pylist())]
            columns = [links.per_stretch(links.to_a), links.per_stretch(links.to_b),
                       links.per_stretch(links.to_link, links.cut), n_links,
                       links.per_stretch(links.to_link, top), links.per_stretch(links.to_link, total)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns],
                 pa.array(digests, pa.binary()), cold], schema.names)

    return stretches.select("row", "doc_id", "whole", "a", "b", "base_a", "base_b").mapInArrow(run, schema)


def _long_digests(long: DataFrame, names: tuple[str, str]) -> DataFrame:
    """``row, groups_sha256`` of the texts of several chunks. Their stretches
    pass in the order of ``start``; the hash goes on from batch to batch."""
    ddl = "row long, groups_sha256 binary"
    schema = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, row, digest = loaded(*names), None, None
        for batch in _slices(batches):
            out = []
            for r, text in zip(batch.column("row").to_pylist(), Links(pair, *_closed(pair, batch)).texts()):
                if not len(text):  # a chunk that closes no group
                    continue
                if r != row:
                    if digest:
                        out.append({"row": row, "groups_sha256": digest.digest()})
                    row, digest = r, hashlib.sha256()
                else:
                    digest.update(b";")
                digest.update(text[:-1])
            yield pa.RecordBatch.from_pylist(out, schema)
        if digest:
            yield pa.RecordBatch.from_pylist([{"row": row, "groups_sha256": digest.digest()}], schema)

    ordered = long.select("row", "start", "a", "b", "base_a", "base_b").repartition("row").sortWithinPartitions("row", "start")
    return ordered.mapInArrow(run, ddl)


def encode_both(docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B, chunk: int = CHUNK,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id, chunk, chunks, base_a, base_b, a, b``: token ids of every
    text by both tokenizers, cut into chunks of ``chunk`` bytes; ``base_*`` is
    the byte at which the chunk's first token begins. ``row`` numbers the rows."""
    source = key_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    python_stage(docs.sparkSession)
    schema = T.StructType([T.StructField("row", T.LongType()), source.schema["doc_id"],
                           *[T.StructField(c, T.IntegerType()) for c in ("chunk", "chunks")],
                           *[T.StructField(c, T.LongType()) for c in ("base_a", "base_b")],
                           *[T.StructField(c, T.BinaryType()) for c in ("a", "b")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(tokenizer_a, tokenizer_b)

        def cuts(length: np.ndarray, ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            ends = length[ids].cumsum()
            at = np.concatenate([[0], np.searchsorted(ends, edges, "right"), [len(ids)]])
            return at, np.concatenate([[0], ends])[at]

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):  # bounds the output in memory
                own, out = [], []
                for i in range(lo, min(lo + 256, batch.num_rows)):
                    a, b = pair.encode(batch.column(1)[i].as_py())
                    n = max(1, -(-int(pair.a_length[a].sum()) // chunk))
                    edges = np.arange(1, n) * chunk
                    at_a, base_a = cuts(pair.a_length, a, edges)
                    at_b, base_b = cuts(pair.b_length, b, edges)
                    for k in range(n):
                        own.append(i)
                        out.append((k, n, int(base_a[k]), int(base_b[k]), a[at_a[k]:at_a[k + 1]].tobytes(),
                                    b[at_b[k]:at_b[k + 1]].tobytes()))
                own = pa.array(own, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).take(own), batch.column(0).take(own),
                     *[pa.array([o[c] for o in out], t) for c, t in enumerate(
                         (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))]], schema.names)

    return source.mapInArrow(run, schema)


def align(docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B, chunk: int = CHUNK,
          fan: int = FAN, hot_pairs: int = HOT_PAIRS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``
    for every row.

    Defined cases: NULL and empty texts, and texts that a tokenizer doesn't
    give back byte for byte, have no tokens (zeros, an empty hash); special
    tokens' strings are plain text; repeated rows each count and get equal
    answers; ids may be NULL; pairs that share the highest count of a B id
    are all best; texts of any length are composed from chunks; an empty table
    gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    names = (tokenizer_a, tokenizer_b)
    # tokens are written once: encoding is the dear step, and row numbers must not change
    tokens = materialize(encode_both(docs, *names, chunk, id_col, text_col), name="align-tokens", compression="zstd")
    inner = F.col("chunks") > 1
    # the tokens of a chunk end behind its first byte, where the groups that it closes can start
    stretches = tokens.select("row", "doc_id", (~inner).alias("whole"), (F.col("chunk").cast("bigint") * chunk + 1).alias("start"),
                              *[F.when(inner, F.col(c)).alias(c) for c in ("base_a", "base_b")], "a", "b")
    longest = tokens.agg(F.max("chunks")).first()[0] or 0
    parts = []
    if longest > 1:
        seams = _seams(tokens, longest, names, fan).withColumn("whole", F.lit(False))
        stretches = stretches.unionByName(seams, allowMissingColumns=True)
        parts.append(_long_digests(stretches.where(~F.col("whole")), names))
    pairs = materialize(_pair_counts(stretches, names), name="align-pairs", compression="zstd")
    size_b = loaded(*names).size_b
    # one row per id of B: bounded by the vocabulary
    top = pairs.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("highest"))
    pairs = (pairs.join(F.broadcast(top), F.col("pair") % size_b == F.col("b"))
             .select("pair", "n", (F.col("n") == F.col("highest")).alias("best")))
    floor = _hot_floor(pairs, hot_pairs)
    hot = pairs.where(F.col("n") >= floor).orderBy("pair").toArrow()  # at most HOT_PAIRS rows
    counted = materialize(_stretch_counts(stretches, hot, names), name="align-counts", compression="zstd")
    rare = counted.select("row", F.explode("cold").alias("c")).select("row", "c.pair", "c.links").join(
        pairs.where(F.col("n") < floor), "pair")
    zero = F.lit(0).cast("bigint")
    parts.append(counted.drop("cold"))
    parts.append(rare.select("row", F.when(F.col("best"), F.col("links")).otherwise(zero).alias("n_best"),
                             (F.col("links") * F.col("n")).alias("count_sum")))
    every = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return every.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), *[F.coalesce(F.sum(c), zero).alias(c) for c in _COUNTS],
        F.lower(F.hex(F.max("groups_sha256"))).alias("groups_sha256")).drop("row")


def op12_alignment(docs: DataFrame) -> DataFrame:
    """The contract's digest: :func:`align`."""
    return align(docs)

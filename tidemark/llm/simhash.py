"""SimHash near-duplicate groups by tiled exact comparison.

Each text gets a 64-bit fingerprint from the hashes of its word shingles.
Distinct fingerprints are dealt to tiles by the population counts of their bit
blocks. Flipping one bit moves one block's count by one, so fingerprints
within the radius lie in tiles whose block counts differ by the radius at
most in sum; all other tile pairs are skipped, which loses nothing. Tile pairs
are compared whole, with numpy exclusive-or and bit counts, and only a
spanning forest of the links leaves a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import join_groups, key_text, python_stage, row_key
from tidemark.llm.components import components
from tidemark.session import materialize

SHINGLE = 3
RADIUS = 2
SEED = 42
#: most fingerprints that one side of a comparison holds
CHUNK = 4096
#: key tables of at most this many rows (about 40 bytes each) are broadcast
BROADCAST_ROWS = 500_000
#: block counts and how many equally likely tiles they are worth (by the
#: binomial distribution of a block's bit count)
BLOCKS = {4: 2_500, 8: 390_000, 10: 3_500_000, 12: 25_000_000, 16: 600_000_000}


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the lower-cased (A-Z) words' shingles,
    repeats included; fewer words than a shingle count whole, none give 0."""
    from xxhash import xxh64_intdigest

    ws = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not ws:
        return 0
    joined, n = b" ".join(ws), len(ws)
    if n <= shingle:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        start, end, at = [], [], 0
        for w in ws:
            start.append(at)
            at += len(w)
            end.append(at)
            at += 1
        hashes = [xxh64_intdigest(joined[i:j], SEED) for i, j in zip(start, end[shingle - 1:])]
    total = np.zeros(64, np.int64)
    h = np.array(hashes, dtype="<u8")
    for i in range(0, len(h), 65_536):
        part = h[i:i + 65_536]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = 2 * total > len(h)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, __k1, __k2, fp``: ``fp`` holds the 64 bits as a signed long."""
    source = key_text(docs, id_col, text_col)
    source = source.select("doc_id", *row_key(F.col("doc_id"), F.col("text")), "text")
    python_stage(docs.sparkSession)
    schema = T.StructType([*source.schema.fields[:3], T.StructField("fp", T.LongType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.array(fps, np.uint64).view(np.int64))], schema.names)

    return source.mapInArrow(scan, schema)


def _widths(blocks: int) -> list[int]:
    """Bits of each block: as equal as they can be, 64 in all."""
    return [64 // blocks + (i < 64 % blocks) for i in range(blocks)]


def tile_of(fp: Column, blocks: int) -> Column:
    """The population counts of the ``blocks`` bit blocks side by side, each
    in as few bits as hold it."""
    bits, key, low = _count_bits(blocks), F.lit(0).cast("bigint"), 0
    for i, width in enumerate(_widths(blocks)):
        part = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
        key = key + F.shiftleft(F.bit_count(part).cast("bigint"), i * bits)
        low += width
    return key


def _count_bits(blocks: int) -> int:
    return max(_widths(blocks)).bit_length()


def near_tiles(blocks: int, radius: int = RADIUS) -> list[int]:
    """Key differences to the tiles within the radius, one of each opposite
    pair, itself first. A difference only ever leads to an existing tile by
    the right route: keys are looked up, never trusted."""
    bits, widths = _count_bits(blocks), _widths(blocks)
    out = {0}

    def extend(i: int, left: int, delta: int) -> None:
        if i == blocks:
            if delta > 0:
                out.add(delta)
            return
        reach = min(left, widths[i])
        for d in range(-reach, reach + 1):
            extend(i + 1, left - abs(d), delta + (d << (i * bits)))

    extend(0, radius, 0)
    return sorted(out)


def _blocks_for(n: int) -> int:
    """Finer tiles for more fingerprints, so that a tile holds some hundreds.
    Every choice compares all pairs within the radius."""
    return next((b for b, tiles in BLOCKS.items() if n <= 1024 * tiles), 16)


def _forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest (child, smaller root) of the given links."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs.tolist():
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [(x, find(x)) for x in parent if find(x) != x]


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> np.ndarray:
    """Links between two chunks as rows ``(a, b)``, by blocks of rows."""
    found = []
    step = max(1, 1_000_000 // max(1, len(b)))
    for i in range(0, len(a), step):
        near = np.bitwise_count(a[i:i + step, None] ^ b[None, :]) <= radius
        if same:
            near &= np.arange(i, min(i + step, len(a)))[:, None] < np.arange(len(b))[None, :]
        x, y = np.nonzero(near)
        found.append(np.stack([a[i + x], b[y]], axis=1))
    return np.concatenate(found) if found else np.empty((0, 2), np.uint64)


def links(distinct: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """``(a, b)``: links that connect the same fingerprints as all links within
    the radius do. ``distinct`` has one row per fingerprint, in column ``fp``."""
    blocks = _blocks_for(n)
    tiled = distinct.select(tile_of(F.col("fp"), blocks).alias("tile"), "fp")
    sizes = tiled.groupBy("tile").agg(F.count(F.lit(1)).alias("__n"))
    # a large tile is cut into chunks by hash, so no task holds a whole tile
    parts = F.ceil(F.col("__n") / F.lit(CHUNK // 2)).cast("int")
    sized = join_groups(tiled, sizes, ["tile"], "__n", n, ["fp"])
    chunks = materialize(
        sized.withColumn("part", F.pmod(F.xxhash64("fp"), parts).cast("int"))
        .groupBy("tile", "part").agg(F.collect_list("fp").alias("fps")), name="simhash-chunks")
    names = chunks.select("tile", "part")
    offsets = F.array(*[F.lit(d).cast("bigint") for d in near_tiles(blocks, radius)])
    left = names.select(F.col("tile").alias("ta"), F.col("part").alias("pa"),
                        F.explode(offsets).alias("d")).withColumn("tb", F.col("ta") + F.col("d"))
    pairs = left.join(names.select(F.col("tile").alias("tb"), F.col("part").alias("pb")), "tb")
    pairs = pairs.where("d <> 0 OR pa <= pb").select("ta", "pa", "tb", "pb")
    pairs = pairs.join(chunks.select(F.col("tile").alias("ta"), F.col("part").alias("pa"), F.col("fps").alias("fa")), ["ta", "pa"])
    pairs = pairs.join(chunks.select(F.col("tile").alias("tb"), F.col("part").alias("pb"), F.col("fps").alias("fb")), ["tb", "pb"])
    pairs = pairs.select(((F.col("ta") == F.col("tb")) & (F.col("pa") == F.col("pb"))).alias("same"), "fa", "fb")
    python_stage(distinct.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            same, fa, fb = batch.column(0), batch.column(1), batch.column(2)
            for i in range(batch.num_rows):
                a = fa[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                b = fb[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                found = close_pairs(a, b, radius, same[i].as_py())
                if len(found):
                    held.append(found)
                    size += len(found)
                if size > 1_000_000:  # keep what connects, drop what repeats
                    held = [np.array(_forest(np.concatenate(held)), np.uint64).reshape(-1, 2)]
                    if len(held[0]) > 500_000:
                        yield _batch(held[0])
                        held = []
                    size = sum(map(len, held))
        if held:
            yield _batch(np.array(_forest(np.concatenate(held)), np.uint64).reshape(-1, 2))

    return pairs.mapInArrow(compare, "a bigint, b bigint")


def _batch(found: np.ndarray) -> pa.RecordBatch:
    a, b = np.ascontiguousarray(found[:, 0]).view(np.int64), np.ascontiguousarray(found[:, 1]).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def near_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, __k1, __k2, fp, component_id``, the
    smallest id reachable over links of at most ``radius`` differing bits.

    Defined cases: NULL and wordless texts have fingerprint 0 and link like any
    other; repeated rows and equal texts share a group; a NULL id takes part
    but is never the smallest unless all ids of its group are NULL; a bit that
    is set in exactly half of the hashes is 0; a text of any length is read
    whole; an empty table gives an empty result; other columns are ignored.
    """
    rows = materialize(fingerprints(docs, shingle, id_col, text_col), name="simhash-rows")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("__min"), F.count(F.lit(1)).alias("__n")),
                           name="simhash-distinct")
    n = distinct.count()
    found = materialize(links(distinct.select("fp"), n, radius), name="simhash-links")
    roots = components(found)
    member = distinct.join(roots, distinct.fp == roots.v, "left").select(
        "fp", "__min", "__n", F.coalesce("root", "fp").alias("__root"))
    member = materialize(member, name="simhash-members")
    heads = member.groupBy("__root").agg(F.min("__min").alias("component_id"), F.count(F.lit(1)).alias("__m"))
    named = join_groups(member, heads, ["__root"], "__m", n, ["fp"]).select("fp", "__n", "component_id")
    total = rows.count()
    return join_groups(rows, named, ["fp"], "__n", total, ["__k1", "__k2"]).drop("__n")


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns: of each group the rows of its smallest
    id stay, one of them if they repeat (same defined cases)."""
    groups = near_groups(docs, shingle, radius, id_col, text_col)
    keys = groups.withColumn("__head", F.col("doc_id").eqNullSafe(F.col("component_id")))
    # one row per content key; a group's head with the smallest key stays
    keys = materialize(keys.groupBy("component_id", "__k1", "__k2", "__head").agg(F.count(F.lit(1)).alias("__c")),
                       name="simhash-keys")
    heads = (keys.where("__head").groupBy("component_id").agg(F.min(F.struct("__k1", "__k2")).alias("__k"))
             .select(F.col("__k.__k1").alias("__k1"), F.col("__k.__k2").alias("__k2"), F.lit(True).alias("__stays")))
    judged = keys.join(heads, ["__k1", "__k2"], "left")
    # only rows that go, or that repeat the one that stays, need another look
    verdict = materialize(judged.where("__stays IS NULL OR __c > 1")
                          .select("__k1", "__k2", F.col("__stays").isNotNull().alias("__stays")), name="simhash-verdict")
    if verdict.count() <= BROADCAST_ROWS:
        verdict = F.broadcast(verdict)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    keyed = docs.select(whole, F.col(f"`{id_col}`").alias("__id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__t"))
    keyed = keyed.select("__row", *row_key(F.col("__id"), F.col("__t"))).join(verdict, ["__k1", "__k2"], "left")
    once = keyed.where("__stays IS NULL").select("__row")
    repeated = keyed.where("__stays").dropDuplicates(["__k1", "__k2"]).select("__row")
    return once.unionByName(repeated).select("__row.*")


def op8_simhash_near_dedup(docs: DataFrame) -> DataFrame:
    """The contract's digest of :func:`near_groups`."""
    g = near_groups(docs, SHINGLE, RADIUS)
    return g.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

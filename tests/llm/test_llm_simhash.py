import random
import re

import numpy as np
import xxhash
from llm_fixtures import SF, documents, empty, texts, with_copies

from tidemark.llm import simhash as H
from tidemark.llm.components import components
from tidemark.llm.queries import LLM_QUERIES


def _fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split("[\x20\x09-\x0D]+", low) if x]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _groups(fps, radius=2):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius and find(i) != find(j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


def test_query(spark):
    docs = sorted(texts(spark).items())
    rows = {r.doc_id: r for r in LLM_QUERIES["op8_simhash_near_dedup"](spark, SF).collect()}
    fps = [_fingerprint(t) for _, t in docs]
    assert [rows[d].fingerprint for d, _ in docs] == [f"{f:016x}" for f in fps]
    ids = [d for d, _ in docs]  # sorted, so the first of a group has the smallest id
    assert [rows[d].component_id for d, _ in docs] == [ids[g] for g in _groups(fps)]


def test_awkward_documents(spark):
    docs = documents(spark)
    out = H.near_groups(docs).collect()
    assert len(out) == docs.count()
    by = {}
    for r in out:
        by.setdefault(r.fp, set()).add(r.component_id)
    assert all(len(v) == 1 for v in by.values())
    blank = {r.component_id for r in out if r.doc_id in (3, 4, 5)}
    assert blank == {3}
    kept = H.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r.component_id for r in out})
    assert H.near_groups(empty(spark)).count() == 0 and H.drop_near_copies(empty(spark)).count() == 0


def test_drop_keeps_the_smallest_id(spark):
    docs = with_copies(spark)
    want = {r.component_id for r in H.near_groups(docs).collect()}
    assert sorted(r.doc_id for r in H.drop_near_copies(docs).collect()) == sorted(want)


def _brute_links(fps, radius=2):
    a = np.array(fps, np.uint64)
    return {(min(x, y), max(x, y)) for i, x in enumerate(fps) for y in
            (int(v) for v in a[i + 1:][np.bitwise_count(a[i + 1:] ^ a[i]) <= radius])}


def _random_fingerprints(n, seed):
    r = random.Random(seed)
    out = {0, (1 << 64) - 1, 1, 3, 7}
    while len(out) < n:
        f = r.getrandbits(64)
        out.add(f)
        for _ in range(r.randint(0, 4)):
            f ^= 1 << r.randrange(64)
            out.add(f)
    return sorted(out)


def test_tiles_lose_no_link(spark, monkeypatch):
    fps = _random_fingerprints(900, 5)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    want = _groups(fps)
    for blocks in (4, 8, 10, 12, 16):
        monkeypatch.setattr(H, "_blocks_for", lambda n, b=blocks: b)
        monkeypatch.setattr(H, "CHUNK", 8)  # many chunks a tile
        roots = {r.v: r.root for r in components(H.links(df, len(fps))).collect()}
        got = [roots.get(signed(f), signed(f)) for f in fps]
        same = {}
        for w, g in zip(want, got):
            assert same.setdefault(w, g) == g
        assert len(set(got)) == len(set(want)), blocks


def test_close_pairs_and_forest():
    fps = _random_fingerprints(300, 9)
    a = np.array(fps, np.uint64)
    got = {(min(x, y), max(x, y)) for x, y in H.close_pairs(a, a, 2, True).tolist()}
    assert got == _brute_links(fps)
    forest = H._forest(H.close_pairs(a, a, 2, True))
    assert len(forest) <= len(fps) and all(x > y for x, y in forest)


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5000, 4000 + i) for i in range(30)]
    edges += [(r.randrange(2000, 2600), r.randrange(2000, 2600)) for _ in range(400)]
    r.shuffle(edges)
    got = {x.v: x.root for x in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if find(a) != find(b):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0

"""Vector codes: the Walsh-Hadamard search and the rounds against plain integers."""

import hashlib
import math

import numpy as np
import pytest
from llm_fixtures import SF, multiset, whole

from tidemark.llm.vector_codes import books_sha256, compress, nearest, op11_vector_codes, sequency, transform

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, `key` string, ints string, `a.b` string"


def _plain(rows, parts=8, entries=16, rounds=6):
    """The contract in Python integers, one vector at a time."""
    good = [(i, [math.floor(4096 * x) for x in v], g) for i, v, g in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not good:
        return []
    dim = -(-max(1, max(len(v) for _, v, _ in good)) // parts) * parts
    good = [(i, v + [0] * (dim - len(v)), g) for i, v, g in good]
    width = dim // parts
    seeds = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * width:(p + 1) * width] for _, v, _ in seeds] for p in range(parts)]

    def near(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * width:(p + 1) * width], e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            got = [near(p, v)[1] for _, v, _ in good]
            new.append([[sum(c) // len(c) for c in zip(*[v[p * width:(p + 1) * width] for (_, v, _), w in zip(good, got) if w == k])]
                        if k in got else e for k, e in enumerate(books[p])])
        books = new
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, sums = [], {}
    for i, v, g in good:
        found = [near(p, v) for p in range(parts)]
        error = sum(d for d, _ in found)
        sums[g] = sums.get(g, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, g))
    return [(i, c, e, sums[g], digest) for i, c, e, g in out]


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, g, "x", "x", "x", "x") for i, v, g in rows], SCHEMA).repartition(3)


def test_transform_keeps_scaled_distances():
    rng = np.random.default_rng(1)
    for width in (1, 2, 5, 8, 13):
        x = rng.integers(-5000, 5000, (20, width))
        size = 1 << max(0, width - 1).bit_length()
        assert ((transform(x) ** 2).sum(axis=1) == size * (x ** 2).sum(axis=1)).all()
    assert sequency(4).tolist() == [0, 2, 3, 1]


@pytest.mark.parametrize("top", [2, 9000, 1 << 40])
@pytest.mark.parametrize("width", [1, 3, 8, 32])
def test_nearest_entry_with_ties(width, top):
    rng = np.random.default_rng(width)
    x, c = rng.integers(-top, top + 1, (200, width)), rng.integers(-top, top + 1, (16, width))
    c[7], x[:20] = c[3], c[rng.integers(0, 16, 20)]
    which, error = nearest(x, c)
    for k in range(len(x)):
        plain = min((sum((int(a) - int(b)) ** 2 for a, b in zip(x[k], e)), j) for j, e in enumerate(c))
        assert (int(error[k]), int(which[k])) == plain


def test_query_against_plain_integers(spark):
    table = whole(spark, SF, "embeddings")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.select("vec_id", "embedding", "label").collect()]
    assert multiset(op11_vector_codes(table).select("vec_id", "code", "error", "label_error", "codebooks_sha256")) == \
        sorted(_plain(rows), key=repr)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    vec = lambda n=8: [float(np.float32(x)) for x in rng.normal(size=n)]
    same = vec()
    rows = [(1, None, 1), (2, [1.0, None] * 4, 1), (3, [float("nan")] * 8, 1), (4, [float("inf")] + vec(7), None),
            (None, vec(), None), (5, vec(), None), (6, vec(), 2), (6, vec(), 2), (6, same, 3), (7, vec(5), 3), (8, [], 3),
            (9, [-0.0001] * 8, 4), (10, [100000.0] + vec(7), 4), *[(20 + k, same, 5) for k in range(40)], (None, same, 5)]
    got = multiset(op11_vector_codes(_frame(spark, rows)))
    assert got == sorted(_plain(rows), key=repr)
    assert op11_vector_codes(_frame(spark, [])).collect() == []
    assert op11_vector_codes(_frame(spark, rows[:4])).collect() == []


def test_other_sizes_and_saturation(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(size=12)], k % 2) for k in range(60)]
    out, books = compress(_frame(spark, rows), parts=3, entries=5, rounds=2)
    assert books.shape == (3, 5, 4)
    assert [r[1:4] + (books_sha256(books),) for r in multiset(out)] == \
        [r[1:] for r in sorted(_plain(rows, 3, 5, 2), key=repr)]
    huge = [(k, [3e38 * (-1) ** k] * 8, 1) for k in range(20)] + [(30, [1e30] * 8, 1)]
    assert all(r.error == 0 for r in compress(_frame(spark, huge))[0].collect())

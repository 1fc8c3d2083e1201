"""Vector codes against plain distances."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from orefold.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(data, parts=4, entries=256, rounds=4):
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v], label) for i, v, label in data
        if v is not None and len(v) and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return []
    firsts = {}
    for i, v, _ in kept:
        firsts.setdefault(i, v)
    firsts = list(firsts.values())[:entries]
    width = len(kept[0][1]) // parts
    books = [[v[p * width : (p + 1) * width] for v in firsts] for p in range(parts)]

    def nearest(p, v):
        d = [sum((a - b) ** 2 for a, b in zip(e, v)) for e in books[p]]
        return d.index(min(d)), min(d)

    def piece(v, p):
        return v[p * width : (p + 1) * width]

    for _ in range(rounds):
        found = [[nearest(p, piece(v, p))[0] for _, v, _ in kept] for p in range(parts)]
        for p in range(parts):
            for e in range(len(firsts)):
                of = [piece(v, p) for (_, v, _), c in zip(kept, found[p]) if c == e]
                if of:
                    books[p][e] = [sum(x) // len(of) for x in zip(*of)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for i, v, label in kept:
        codes = [nearest(p, piece(v, p)) for p in range(parts)]
        out.append((i, "".join(f"{c:02x}" for c, _ in codes), sum(d for _, d in codes), label))
    sums = {}
    for r in out:
        sums[r[3]] = sums.get(r[3], 0) + r[2]
    return sorted(((*r[:3], sums[r[3]], sha) for r in out), key=str)


def coded(spark, data, schema=SCHEMA, **options):
    kept = vc.kept_vectors(spark.createDataFrame(data, schema))
    found = vc.digest(kept, vc.learned(kept, **options))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def vectors(seed, n, dims=8, step=0.01):
    """Vectors on a coarse grid, so that parts, prefixes and distances repeat."""
    rng = random.Random(seed)
    return [
        (i, [round(rng.gauss(0, 1) / step / 20) * step for _ in range(dims)], rng.choice((None, 1, 2)))
        for i in rng.sample(range(10 * n), n)
    ]


@pytest.mark.parametrize("seed, entries", [(1, 256), (2, 7), (3, 1)])
def test_equals_plain_distances(spark, seed, entries):
    data = vectors(seed, 300)
    assert coded(spark, data, entries=entries) == brute(data, entries=entries)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = vectors(4, 40) + [
        (5000, None, 1), (5001, [], 1), (5002, [1.0] * 7 + [None], 1), (5003, [nan] * 8, 2), (5004, [inf] * 8, 2),
        (5005, [0.5] * 4, 1), (5006, [0.5] * 9, 1), (None, [0.25] * 8, None), (None, [0.25] * 8, None),
        (1, [0.5] * 8, 1), (1, [0.25] * 8, 1), (1, [0.25] * 8, 1), (7000, [-0.0] * 8, 3),
        (7001, [-1e-9] * 8, 3), (7002, [260000.0] * 8, 3),
    ]
    assert coded(spark, data) == brute(data)
    assert coded(spark, data, entries=9) == brute(data, entries=9)


def test_clashing_columns(spark):
    data = vectors(5, 60)
    extra = [(*r, 1, "x", 2) for r in data]
    schema = SCHEMA + ", error long, code string, part int"
    assert coded(spark, extra, schema) == brute(data)


def test_empty_and_single(spark):
    assert coded(spark, []) == []
    assert coded(spark, [(1, None, 2)]) == []
    assert coded(spark, [(None, [0.5] * 4, None)]) == brute([(None, [0.5] * 4, None)])


def test_out_of_range_fails(spark):
    with pytest.raises((PySparkException, Py4JJavaError)):
        coded(spark, [(1, [1e9] * 4, 1)])


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(1, 5), st.integers(1, 9), st.integers(1, 7))
def test_trie_walk(seed, n, width, entries, step):
    """Walks in steps of any size, over sorted rows with shared prefixes and repeats."""
    rng = np.random.default_rng(seed)
    rows = rng.integers(-3, 4, (n, width))
    rows = rows[np.lexsort(rows.T[::-1])]
    book = rng.integers(-4, 5, (entries, width))
    old, vc.STEP = vc.STEP, step
    try:
        walk = vc.Trie(book, 8)
        cut = n // 2
        parts = [walk.nearest(part) for part in (rows[:cut], rows[cut:]) if len(part)]
    finally:
        vc.STEP = old
    distance = ((rows[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert np.concatenate([p[0] for p in parts]).tolist() == distance.argmin(axis=1).tolist()
    assert np.concatenate([p[1] for p in parts]).tolist() == distance.min(axis=1).tolist()


def test_prefixes_are_shared():
    """A node's distances are made once for all parts below it."""
    rows = np.array([[1, 2, x] for x in range(50)] + [[1, 3, x] for x in range(50)])
    made = []

    class Column(np.ndarray):
        def __sub__(self, other):
            made.append(np.size(other))
            return np.asarray(self) - np.asarray(other)

    walk = vc.Trie(np.arange(12).reshape(4, 3), 100)
    walk.columns = walk.columns.view(Column)
    walk.nearest(rows)
    assert made == [1, 2, 100]


def test_restored_vectors(spark):
    data = vectors(6, 80, step=0.001)
    kept = vc.kept_vectors(spark.createDataFrame(data, SCHEMA))
    books = vc.learned(kept, entries=80)
    out = {r["id"]: r["restored"] for r in vc.restored(vc.coded(kept, books), books).collect()}
    for i, v, _ in data:
        assert max(abs(a - b) for a, b in zip(out[i], v)) < 0.6 / 1024 + 1e-6

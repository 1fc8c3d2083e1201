import random

import numpy as np
import pytest
import xxhash

from corpus import frame, odd_rows, rows, text
from orefold.llm import simhash as op
from orefold.llm.components import components


def fingerprint(t):
    """Bit by bit, as the contract words it."""
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def component_ids(fps, ids, radius):
    names = list(range(len(fps)))

    def find(x):
        while names[x] != x:
            x = names[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                names[max(a, b)] = min(a, b)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [least.get(find(k)) for k in range(len(fps))]


def near_copies():
    rng = random.Random(4)
    out = []
    for _ in range(25):
        base = text(rng, rng.randrange(40, 400)).split()
        for _ in range(rng.randrange(1, 6)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = "changed%d" % rng.randrange(99)
            out.append(" ".join(copy))
    return out + out[:5] + ["One two", "ONE two", "one"]


@pytest.mark.parametrize("tile", [op.TILE, 7])
def test_equals_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(op.links, "__defaults__", (op.RADIUS, tile))
    texts = near_copies()
    got = {r.doc_id: r for r in op.digest(op.near_duplicates(frame(spark, rows(texts)))).collect()}
    fps = [fingerprint(t) for t in texts]
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{f:016x}" for f in fps]
    want = component_ids(fps, list(range(len(texts))), 4)
    assert [got[i].component_id for i in range(len(texts))] == want
    assert len(set(want)) < len(set(fps))


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 6])
def test_bit_sliced_links(radius):
    rng = np.random.default_rng(radius)
    fps = rng.integers(0, 1 << 63, 30, dtype=np.uint64).repeat(20)
    flips = rng.integers(0, 64, (len(fps), 4))
    for k in range(4):
        fps ^= np.where(rng.random(len(fps)) < 0.5, np.uint64(1) << flips[:, k].astype(np.uint64), np.uint64(0))
    fps = np.unique(fps)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    index = {int(f): i for i, f in enumerate(fps)}
    key = np.stack([np.arange(len(fps)) // 40, np.zeros(len(fps), int)], axis=1)
    links = {tuple(sorted((index[int(a)], index[int(b)]))) for a, b in op.links_of_runs(key, fps, radius).T}
    same = np.arange(len(fps)) // 40
    assert links == {(i, j) for i, j in zip(*np.nonzero(near)) if i < j and same[i] == same[j]}
    joined = [(index[int(a)], index[int(b)]) for a, b in op.large_links(fps, radius, 16).T]
    assert len(joined) < len(fps)
    assert partition(len(fps), joined) == partition(len(fps), [(i, j) for i, j in zip(*np.nonzero(near)) if i < j])


def partition(n, edges):
    names = list(range(n))
    for a, b in edges:
        old, new = names[a], names[b]
        names = [new if x == old else x for x in names]
    groups = {}
    for i, x in enumerate(names):
        groups.setdefault(x, []).append(i)
    return sorted(groups.values())


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 99), (99, 98), (7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in got} == {(i, 0) for i in range(61)} | {(98, 98), (99, 98), (100, 98)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows_and_empty_tables(spark):
    docs = odd_rows()
    got = op.digest(op.near_duplicates(frame(spark, docs, clash=True))).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((d[0] is None, d[0] or 0) for d in docs)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert {by_id[i].fingerprint for i in (1, 2, 3)} == {"0" * 16}
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert {by_id[i].component_id for i in (5, 6)} == {5}
    assert op.near_duplicates(frame(spark, [])).count() == 0
    kept = op.one_of_each(frame(spark, docs, clash=True))
    assert "signature" in kept.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 7, 8, 9, 10] and ids.count(None) == 2

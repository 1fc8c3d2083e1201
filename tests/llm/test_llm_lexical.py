"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from corpus import frame, odd_rows, rows, text
from orefold.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(t):
    return TERM.findall((t or "").translate(LOWER))


def brute(data, items, top=10):
    docs = [(r[0], Counter(terms(r[1]))) for r in data]
    docs = [d for d in docs if d[1]]
    count, length = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for item, t in items:
        asked.setdefault(item, set()).update(terms(t))
    out = []
    for item, of in asked.items():
        scored = []
        for doc, c in docs:
            n = sum(c.values())
            m = 10 + (90 * n * count) // length
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in of if t in c
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda s: s[:3])
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(scored[:top])]
    return sorted(out, key=str)


def ranked(spark, data, items, clash=False, **options):
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = lexical.ranked(frame(spark, data, clash), asked, **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def corpus(seed, n=400):
    rng = random.Random(seed)
    texts = [text(rng, rng.randint(1, 120)) for _ in range(n)]
    # ties: copies of texts, under higher and lower ids
    texts += [texts[i] for i in rng.sample(range(n), 60)] + [texts[7]] * 30
    rng.shuffle(texts)
    items = [(i, text(rng, rng.randint(1, 30))) for i in range(25)]
    items += [(100 + i, texts[i].upper()) for i in range(10)]
    return rows(texts), items


@pytest.mark.parametrize(
    "seed, options", [(1, {}), (2, {"block_bytes": 2000}), (3, {"block_bytes": 500, "item_bytes": 300}), (4, {"top": 3})]
)
def test_equals_brute_force(spark, seed, options):
    data, items = corpus(seed)
    want = brute(data, items, options.get("top", 10))
    assert ranked(spark, data, items, **options) == want


@pytest.mark.parametrize("leaf, wide", [(1, 1), (3, 2), (50, 64)])
def test_search_at_every_leaf_size(leaf, wide, monkeypatch):
    """Blocks searched one after another, with ties, against all scores."""
    monkeypatch.setattr(lexical, "LEAF", leaf)
    monkeypatch.setattr(lexical, "WIDE", wide)
    rng = np.random.default_rng(leaf)
    for _ in range(20):
        docs, kinds = int(rng.integers(1, 60)), 5
        term, place = np.nonzero(rng.random((kinds, docs)) < 0.4)
        impact = rng.integers(0, 4, len(term))
        best, want = lexical.Best(4), []
        for part in range(3):
            keys = [(0, int(i)) for i in np.sort(rng.choice(1000, docs, False))]
            block = lexical.Block(np.arange(docs), term, place, impact)
            lexical.search(block, keys, np.array([0, 2, 3]), best)
            total = np.bincount(place, impact * np.isin(term, [0, 2, 3]), docs)
            want += [(int(s), k) for s, k in zip(total, keys) if s > 0]
        assert best.rows == sorted(want, key=lambda r: (-r[0], r[1]))[:4]


def test_odd_rows_and_items(spark):
    data = odd_rows()
    items = [(1, "be ke"), (1, "li ÉSS 中文"), (2, None), (3, " .,"), (None, "be 1234"), (5, "xxxx be"), (5, "xxxx be")]
    assert ranked(spark, data, items) == brute(data, items)
    assert ranked(spark, data, items, clash=True) == brute(data, items)


def test_empty(spark):
    assert ranked(spark, [], [(1, "a")]) == []
    assert ranked(spark, rows(["a b"]), []) == []
    assert ranked(spark, rows([None, "", "--"]), [(1, "a")]) == []


def test_a_term_in_every_document_weighs_nothing(spark):
    data = rows(["a"] * 600)
    assert ranked(spark, data, [(1, "a")]) == brute(data, [(1, "a")]) == []


def test_range_maxima():
    """Any interval's largest posting, and the first of equal ones."""
    rng = np.random.default_rng(5)
    docs, kinds = 97, 6
    held = rng.random((kinds, docs)) < np.linspace(0.02, 1, kinds)[:, None]
    term, place = np.nonzero(held)
    impact = rng.integers(0, 9, len(term)) * 10**10
    block = lexical.Block(np.arange(docs), term, place, impact)
    spans = [(a, b) for a in range(0, docs, 3) for b in range(a + 1, docs + 1, 5)]
    found = block.largest(
        *block.spans(np.arange(kinds), np.array([s[0] for s in spans]), np.array([s[1] for s in spans]))
    )
    for row, (a, b) in zip(found, spans):
        for t in range(kinds):
            inside = [(int(i), -int(p)) for u, p, i in zip(term, place, impact) if u == t and a <= p < b]
            if not inside:
                assert row[t] == 0
            else:
                most, first = max(inside)
                assert row[t] >> lexical._PLACE == most
                assert lexical._MASK - (row[t] & lexical._MASK) == -first


def test_bounds_leave_documents_unseen(monkeypatch):
    """With one document far above the rest, most of a block is never scored."""
    seen = []

    class Watched(lexical.Block):
        def scores(self, a, b):
            places, score = super().scores(a, b)
            seen.extend(places.tolist())
            return places, score

    monkeypatch.setattr(lexical, "LEAF", 8)

    docs = 4096
    term, place = np.repeat(np.arange(3), docs), np.tile(np.arange(docs), 3)
    impact = np.ones(3 * docs, np.int64)
    impact[[17, docs + 17, 2 * docs + 17]] = 1000
    block = Watched(np.arange(docs), term, place, impact)
    best = lexical.Best(1)
    lexical.search(block, [(0, i) for i in range(docs)], np.arange(3), best)
    assert best.rows == [(3000, (0, 17))]
    assert len(seen) < 50


def test_large_lengths():
    impact = lexical.impacts(np.array([1]), np.array([1 << 40]), np.array([2]), 1 << 30, 1 << 60)
    m = 10 + (90 * (1 << 40) * (1 << 30)) // (1 << 60)
    assert impact.tolist() == [2 * (1_000_000_000 // (1000 + 8 * m))]

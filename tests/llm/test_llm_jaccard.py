"""Jaccard join against all pairs."""

import random
import re

import pytest

from corpus import frame, odd_rows, rows, text, words
from orefold.llm import jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t, k=5):
    w = WORD.findall((t or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1)))


def brute(data, similarity=80):
    """(doc_id, n, component) of all rows by all pairs."""
    held = [shingles(r[1]) for r in data]
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(held):
        for j in range(i):
            b = held[j]
            if a and b and 100 * len(a & b) >= similarity * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(data):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    out = [(r[0], len(s), least.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(data, held))]
    return sorted(out, key=str)


def joined(spark, data, clash=False, **options):
    found = jaccard.joined(frame(spark, data, clash), **options)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def edited(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.4:
            out[at] = f"new{rng.randrange(10**6)}"
        elif kind < 0.7:
            out.insert(at, f"new{rng.randrange(10**6)}")
        else:
            del out[at]
    return out


def corpus(seed):
    """Near copies at all distances, chains, a shared passage in many documents, copies."""
    rng = random.Random(seed)
    out = []
    for _ in range(6):
        base = words(rng, rng.randint(30, 200))
        for _ in range(rng.randint(1, 12)):
            out.append(" ".join(edited(rng, base, rng.randint(0, 6))))
    chain = words(rng, 100)
    for _ in range(15):
        chain = edited(rng, chain, 1)
        out.append(" ".join(chain))
    passage = text(rng, 60)
    out += [f"{text(rng, rng.randint(5, 60))} {passage} {text(rng, 20)}" for _ in range(25)]
    out += [out[0]] * 5 + [out[3].upper(), "one two", "ONE two", "one two three", "", None, "  "]
    rng.shuffle(out)
    return rows(out)


TIGHT = {"frequent": 1, "group_tokens": 300, "query_tokens": 400}


@pytest.mark.parametrize(
    "seed, options", [(1, {}), (2, TIGHT), (3, {**TIGHT, "most_sent": 20}), (4, {"frequent": 2, "group_tokens": 100})]
)
def test_equals_all_pairs(spark, seed, options):
    data = corpus(seed)
    assert joined(spark, data, **options) == brute(data)


def test_large_component_in_many_groups(spark):
    """One group of near copies far larger than a group, its outsiders, and unlinked ones."""
    rng = random.Random(9)
    base = words(rng, 60)
    near = [" ".join(edited(rng, base, rng.choice((0, 1, 1, 2)))) for _ in range(90)]
    far = [" ".join(edited(rng, base, 3)) for _ in range(40)]
    data = rows(near + far)
    want = brute(data)
    assert max(sum(r[2] == c for r in want) for c in {r[2] for r in want}) > 40
    assert joined(spark, data, frequent=4, group_tokens=400, query_tokens=500) == want


def test_odd_rows(spark):
    data = odd_rows()
    assert joined(spark, data) == brute(data)
    assert joined(spark, data, clash=True) == brute(data)


def test_other_parameters(spark):
    data = corpus(5)
    assert joined(spark, data, similarity=50, **TIGHT) == brute(data, 50)


def test_empty(spark):
    assert joined(spark, []) == []
    assert joined(spark, rows([None, "", " "])) == [(0, 0, 0), (1, 0, 1), (2, 0, 2)]


def test_no_link_is_emitted_for_every_pair(spark):
    """Links stay linear in the members of a group of near copies."""
    rng = random.Random(4)
    base = words(rng, 80)
    data = rows([" ".join(edited(rng, base, 1)) for _ in range(60)])
    _, found = jaccard.links(frame(spark, data), group_tokens=500)
    assert found.count() <= 8 * len(data)

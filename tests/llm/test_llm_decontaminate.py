import random

import numpy as np
import pyarrow as pa

from corpus import frame, odd_rows, rows, text, words
from orefold.llm import decontaminate as op
from orefold.llm.common import binary

ITEMS = "item_id long, text string"


def fewest_edits(item, doc):
    """Sellers' algorithm, cell by cell."""
    row = [0] * (len(doc) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(doc, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def edited(rng, tokens, edits):
    out = list(tokens)
    for _ in range(edits):
        p = rng.randrange(len(out))
        kind = rng.randrange(3)
        out[p : p + (kind > 0)] = ["zzz%d" % rng.randrange(1000)] if kind < 2 else []
    return out


def planted():
    rng = random.Random(1)
    items = [words(rng, rng.randrange(14, 60)) for _ in range(30)] + [words(rng, n) for n in (1, 2, 4, 7, 9)]
    docs = []
    for k in range(120):
        body = words(rng, rng.randrange(60, 300))
        if k % 2:
            item = items[rng.randrange(30)]
            p = rng.randrange(len(body))
            body[p:p] = edited(rng, item, rng.randrange(0, int(len(item) * 0.12) + 1))
        docs.append(body)
    return items, docs


def test_equals_brute_force(spark):
    items, docs = planted()
    long = [i for i in range(len(items)) if len(items[i]) >= 14]
    bench = spark.createDataFrame([(i, " ".join(items[i])) for i in range(len(items))], ITEMS)
    got = op.contaminated(frame(spark, rows([" ".join(d) for d in docs])), bench).collect()
    pairs = {(r.doc_id, r.item_id): r.edits for r in got}
    want = {}
    for d, doc in enumerate(docs):
        for i in range(len(items)):
            edits = fewest_edits(items[i], doc)
            if edits <= int(0.2 * len(items[i])):
                want[d, i] = edits
    assert set(pairs) <= set(want)
    sure = {p for p in want if p[1] in long}
    assert len(sure & set(pairs)) >= 0.98 * len(sure)
    least = {}
    for r in got:
        key = (r.doc_id, r.item_id)
        least[key] = min(r.edits, least.get(key, 99))
        assert fewest_edits(items[r.item_id], docs[r.doc_id][r.start_word : r.end_word]) == r.edits
    assert all(least[p] == want[p] for p in least)
    # short items are exact or nearly so, and all found
    assert {p for p in want if p[1] >= 30 and len(items[p[1]]) <= 4} <= set(pairs)


def test_case_and_punctuation_do_not_hide_an_item(spark):
    rng = random.Random(2)
    item = text(rng, 25)
    shout = "intro, " + "! ".join(item.upper().split()) + "? outro"
    bench = spark.createDataFrame([(1, item)], ITEMS)
    got = op.contaminated(frame(spark, rows([shout, text(rng, 90)])), bench).collect()
    assert [(r.doc_id, r.start_word, r.end_word, r.edits) for r in got] == [(0, 1, 26, 0)]


def test_odd_rows_and_empty_tables(spark):
    docs = odd_rows()
    same = docs[4][1]
    bench = spark.createDataFrame([(1, same), (2, None), (3, ""), (None, "!!"), (1, same)], ITEMS)
    got = op.contaminated(frame(spark, docs, clash=True), bench)
    assert sorted((r.doc_id is None, r.doc_id) for r in got.collect()) == [
        (False, 5), (False, 5), (False, 6), (True, None),
    ]
    clean = op.without_contaminated(frame(spark, docs, clash=True), bench)
    assert clean.count() == len(docs) - 4 and clean.columns[-1] == "part"
    assert op.contaminated(frame(spark, []), bench).count() == 0
    none = spark.createDataFrame([], ITEMS)
    assert op.contaminated(frame(spark, docs), none).count() == 0
    assert op.without_contaminated(frame(spark, docs), none).count() == len(docs)


def test_walks_agree_before_the_first_edit():
    h, first = op.symbols(binary(pa.array(["a b c d e f g h i j k l m n", "a b c d e f g h x j k l m n"])))
    sampling = op.Sampling(4)
    pad = np.zeros(12, np.uint64)
    keys = [
        sampling.keys(np.concatenate([h[first[d] : first[d + 1]], pad]), np.array([0]), 6) for d in range(2)
    ]
    assert all((a == b).all() for a, b in zip(*keys))


def test_recall_of_each_length_with_a_fifth_edited():
    rng = random.Random(4)
    missed = {}
    for n in (5, 6, 7, 10, 12, 15, 20):
        items = [words(rng, n) for _ in range(150)]
        made = op.Items(list(range(150)), [" ".join(i) for i in items], 0.2, 0.99)
        texts = [" ".join(words(rng, 20) + edited(rng, i, n // 5) + words(rng, 20)) for i in items]
        got = {(m[0], m[1]) for m in made.matches(*op.symbols(binary(pa.array(texts))))}
        missed[n] = 150 - sum((k, k) in got for k in range(150))
    assert max(missed.values()) <= 6, missed


def test_every_item_has_keys_in_every_repetition():
    rng = random.Random(5)
    items = [words(rng, n) for n in (4, 4, 5, 5, 6, 6, 7, 7) * 10] + [["the", "the", "the", "the"]]
    made = op.Items(list(range(len(items))), [" ".join(i) for i in items], 0.2, 0.99)
    for repeats in made._anchored(made.sampling).values():
        of_all = set(repeats[0][1].tolist())
        assert all(set(who.tolist()) == of_all for _, who, _ in repeats)
    assert sum(len(set(r[0][1].tolist())) for r in made._anchored(made.sampling).values()) == len(items)


def test_symbols_of_other_scripts():
    texts = ["Ab\u4e2d\u6587c1\u3002x", "", "\u201c\u00c9t\u00e9\u201d \u0e44\u0e17\u0e22\U00020000z", "\u3042"]
    want = [
        ["Ab", "\u4e2d", "\u6587", "c1", "x"], [],
        ["\u00c9t\u00e9", "\u0e44", "\u0e17", "\u0e22", "\U00020000", "z"], ["\u3042"],
    ]
    data, at = op.raw(binary(pa.array(texts)))
    got = op.Symbols(data, at)
    cut = [bytes(data[s:e]).decode() for s, e in zip(got.starts, got.ends)]
    assert [cut[a:b] for a, b in zip(got.first, got.first[1:])] == want


def test_a_passage_inside_a_run_without_spaces():
    rng = random.Random(6)
    run = lambda n: [chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(n)]
    item = run(40)
    near = item[:20] + ["\u4e00"] + item[21:]
    texts = ["".join(run(30) + part + run(25)) for part in (item, near, run(40))]
    made = op.Items([1], ["".join(item)], 0.2, 0.99)
    got = made.matches(*op.symbols(binary(pa.array(texts))))
    assert [(m[0], m[1], m[2], m[3], m[4]) for m in got] == [(0, 0, 30, 70, 0), (1, 0, 30, 70, 1)]

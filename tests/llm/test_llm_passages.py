import random

import numpy as np
import pyarrow as pa

from corpus import frame, odd_rows, rows, text, words
from orefold.llm import passages as op
from orefold.llm.common import mixed


def test_compact_windows_are_the_nodes_of_the_tree():
    rng = np.random.default_rng(0)
    lengths = [0, 5, 46, 200, 333, 47, 1]
    doc = np.repeat(np.arange(len(lengths)), lengths)
    h = mixed(rng.integers(0, 60, len(doc)).astype(np.uint64))
    low = np.uint64(0xFFFF)
    key = (h & ~low) | (mixed(np.arange(len(h), dtype=np.uint64), 77) & low)
    for width in (1, 3, 7, 46):
        want = set()

        def node(a, b):
            if b - a + 1 >= width:
                k = a + int(np.argmin(key[a : b + 1]))
                want.add((k, a, b))
                node(a, k - 1)
                node(k + 1, b)

        begin = 0
        for n in lengths:
            node(begin, begin + n - 1) if n else None
            begin += n
        assert {tuple(map(int, w)) for w in zip(*op.compact_windows(h, doc, width))} == want


def found(spark, texts, **kw):
    return op.passages(frame(spark, rows(texts)), **kw).collect()


def test_planted_passages(spark):
    rng = random.Random(11)
    passage = words(rng, 60)
    near = list(passage)
    near[20] = "changed"
    body = lambda n: words(rng, n)
    docs = [body(100) + passage + body(90), body(30) + passage + body(10), body(80) + near + body(40)]
    docs += [body(200) for _ in range(20)]
    whole = body(150)
    docs += [whole, list(whole), whole + body(60)]
    twice = body(70)
    docs += [twice + body(30) + twice]  # repeats in one document only
    docs += [body(40) + passage[:30] + body(40)]  # too short a part
    got = found(spark, [" ".join(d) for d in docs])
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == {0, 1, 2, 23, 24, 25}
    for d, at in ((0, 100), (1, 30), (2, 80)):
        for r in by_doc[d]:
            assert r.rep_doc_id == 0 and abs(r.start_word - at) <= 10 and abs(r.end_word - at - 60) <= 10
            assert r.similarity >= 0.75
    assert [(r.start_word, r.end_word, r.similarity) for r in by_doc[24]] == [(0, 150, 1.0)]


def test_recall_at_the_least_length_and_similarity(spark):
    """Passages of exactly 50 words, copied or with one word in 46 shingles changed."""
    rng = random.Random(12)
    docs, pairs = [], []
    for k in range(120):
        passage = words(rng, 50)
        other = list(passage)
        if k % 2:
            other[rng.randrange(50)] = "changed"
        pairs.append((len(docs), len(docs) + 1))
        docs += [words(rng, 70) + passage + words(rng, 70), words(rng, 20) + other + words(rng, 120)]
    got = {(r.rep_doc_id, r.doc_id) for r in found(spark, [" ".join(d) for d in docs])}
    clean = {p for p in got if p[0] != p[1]} - set(pairs)
    assert not clean
    assert len(got & set(pairs)) >= 0.97 * len(pairs)


def test_a_first_document_with_less_does_not_hide_a_longer_match(spark):
    rng = random.Random(13)
    line, passage = words(rng, 20), words(rng, 50)
    docs = [words(rng, 60) + line + words(rng, 60)]
    docs += [words(rng, 60) + line + passage + words(rng, 60) for _ in range(4)]
    got = {r.doc_id: r.rep_doc_id for r in found(spark, [" ".join(d) for d in docs]) if r.doc_id != r.rep_doc_id}
    assert 0 not in got and len(got) >= 3


def test_a_more_edited_first_document_does_not_hide_copies(spark):
    rng = random.Random(14)
    docs, pairs = [], []
    for k in range(200):
        passage = words(rng, 50)
        first = list(passage)
        for p in rng.sample(range(5, 45), 2):
            first[p] = "changed%d" % p
        pairs.append((3 * k + 1, 3 * k + 2))
        docs += [words(rng, 40) + p + words(rng, 40) for p in (first, passage, passage)]
    got = {(r.rep_doc_id, r.doc_id) for r in found(spark, [" ".join(d) for d in docs])}
    assert len(set(pairs) - got) <= 4


def test_a_copy_with_words_put_in_is_whole(spark):
    rng = random.Random(15)
    docs, whole = [], []
    for k in range(30):
        passage = words(rng, 250)
        other = [w for i in range(0, 250, 50) for w in [*passage[i : i + 50], "more%d" % i]][:-1]
        docs += [words(rng, 30) + passage + words(rng, 30), words(rng, 45) + other + words(rng, 20)]
        whole.append(2 * k + 1)
    got = {d: set() for d in whole}
    for r in found(spark, [" ".join(d) for d in docs]):
        if r.doc_id in got:
            got[r.doc_id] |= set(range(r.start_word, r.end_word))
    for d in whole:
        assert len(got[d] & set(range(45, 299))) >= 245


def test_two_passages_at_near_shifts_and_a_clean_one_beside_an_edited():
    rng = np.random.default_rng(16)
    fresh = lambda n: rng.integers(0, 1 << 62, n).astype(np.uint64)
    one, two = fresh(60), fresh(60)
    a, b = np.concatenate([one, fresh(40), two]), np.concatenate([one, fresh(43), two])
    got = op.verified(a, b, 0, 159, [-3, 0], 46, 0.8)
    assert [p[:4] for p in got] == [(0, 60, 0, 60), (100, 160, 103, 163)]
    # shingles that moved by one place, beside a run that did not move
    moved = np.concatenate([two[:30], two[31:], fresh(1)])
    a, b = np.concatenate([one, fresh(60), two]), np.concatenate([one, fresh(60), moved])
    got = op.verified(a, b, 0, 179, [0], 46, 0.8)
    assert len(got) == 2 and got[1][0] <= 121 and got[1][1] >= 179


def test_every_row_of_a_repeated_id_is_compared(spark):
    """Unlike texts under one id, and rows without an id, are documents of their own."""
    rng = random.Random(21)
    passage = " ".join(words(rng, 80))
    first = f"{text(rng, 40)} {passage} {text(rng, 30)}"
    data = [
        (1, first), (2, text(rng, 120)), (2, f"{text(rng, 33)} {passage} {text(rng, 12)}"),
        (2, f"{passage} {text(rng, 50)}"), (None, f"{text(rng, 9)} {passage}"), (None, text(rng, 100)), (3, text(rng, 90)),
    ]
    got = op.passages(frame(spark, [(i, t, "en", "a", 1) for i, t in data])).collect()
    assert {(r.doc_id, r.rep_doc_id) for r in got} == {(1, 1), (2, 1), (None, 1)}
    assert sorted((r.start_word, r.end_word) for r in got if r.doc_id == 2) == [(0, 80), (33, 113)]
    assert [(r.start_word, r.end_word) for r in got if r.doc_id is None] == [(9, 89)]


def test_odd_rows_and_empty_tables(spark):
    docs = odd_rows()
    got = op.passages(frame(spark, docs, clash=True)).collect()
    assert {(r.doc_id, r.rep_doc_id) for r in got} == {(5, 5), (6, 5), (None, 5)}
    assert op.passages(frame(spark, [])).count() == 0
    assert op.passages(frame(spark, rows([text(random.Random(1), 20)] * 3))).count() == 0
    many = "\n".join(["be be be"] * 200)
    assert {r.doc_id for r in found(spark, [many, many, "be " * 400])} == {0, 1, 2}


def test_signatures_alone_are_those_of_the_windows(spark):
    rng = random.Random(31)
    data = rows([text(rng, n) for n in (0, 3, 54, 55, 400, 900)] + ["same " * 300])
    df = frame(spark, data).selectExpr("cast(doc_id as long) as doc_id", "text").where("text is not null")
    whole = op.all_windows(df, 46).select("signature", "doc_id")
    alone = op.all_signatures(df, 46)
    assert alone.columns == ["signature", "doc_id"]
    assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, whole.collect())) != []


def test_shingles_near_their_place_as_by_search():
    rng = np.random.default_rng(32)
    for n, m, kinds, shift in [(60, 80, 40, 0), (50, 50, 5, 17), (120, 30, 400, 90), (30, 120, 9, -95), (7, 0, 3, 0), (5, 9, 2, 40)]:
        for kind in (np.uint16, np.uint64):
            a, b = rng.integers(0, kinds, n).astype(kind), rng.integers(0, kinds, m).astype(kind)
            near = [
                any(b[j] == a[i] for j in range(max(i - shift - op.DRIFT, 0), max(min(i - shift + op.DRIFT + 1, m), 0)))
                for i in range(n)
            ]
            assert op._present(a, b, shift).tolist() == near
            assert op._held(a, b).tolist() == np.isin(a, b).tolist()
            both = len(np.intersect1d(a, b))
            assert op._jaccard(a, b) == both / (len(np.unique(a)) + len(np.unique(b)) - both)


def test_shingles_near_their_place_equal_those_found_one_distance_at_a_time():
    rng = np.random.default_rng(3)
    sizes = [(int(n), int(m)) for n, m in rng.integers(0, 90, (300, 2))] + [(20_000, 17_000), (9_000, 40)]
    for n, m in sizes:
        a, b = (rng.integers(0, 60, k).astype(np.uint16) for k in (n, m))
        for shift in (0, 7, -n // 2, m // 3, n + 20, -m - 20):
            near = np.zeros(n, bool)
            for back in range(shift - op.DRIFT, shift + op.DRIFT + 1):
                begin, end = max(0, back), min(n, m + back)
                if begin < end:
                    near[begin:end] |= a[begin:end] == b[begin - back : end - back]
            assert (op._present(a, b, shift) == near).all()
            assert (op._present(a.astype(np.uint64), b.astype(np.uint64), shift) == near).all()


def test_open_windows_meet_the_first_with_their_context_at_each_length(spark):
    rng = random.Random(5)
    lengths, windows = 13, []
    for signature in range(30):
        stems = [rng.getrandbits(52) for _ in range(3)]
        for _ in range(rng.randrange(1, 12)):
            sides = []
            for _ in range(2):
                kept = 4 * rng.randrange(lengths + 1)  # bits of a stem that are changed at the far end
                sides.append(rng.choice(stems) >> kept << kept | rng.getrandbits(kept) if kept else rng.choice(stems))
            at = rng.randrange(500)
            windows.append((signature, rng.randrange(40), at, at - 9, at + 50, *sides))
    # the first one of a signature has the contexts 7 * signature
    apart = lambda w, c: sum((c ^ 7 * w[0]) >> 4 * k != 0 for k in range(lengths))
    windows = [(*w, apart(w, w[5]), apart(w, w[6])) for w in windows]
    names = "signature long, doc_id long, centre int, left int, right int, after long, before long"
    open_ = spark.createDataFrame(windows, names + ", after_apart int, before_apart int")
    groups = {}
    for w in windows:
        for side in (0, 1):
            for k in range(w[7 + side]):
                groups.setdefault((w[0], side, k, w[5 + side] >> 4 * k), []).append(w[1:5])
    want = {(w, min(g)) for g in groups.values() for w in g if min(g)[0] < max(g)[0]}
    got = [tuple(r) for r in op._closer(open_, lengths).collect()]
    assert {(r[:4], r[4:]) for r in got} == want and len(want) > 20


def test_lengths_with_one_link_are_one_row(spark):
    # two open windows that agree at all 13 lengths on both sides
    rows_ = [(1, d, 100, 60, 150, 5 << 48, 9 << 48, 13, 13) for d in (7, 8)]
    names = "signature long, doc_id long, centre int, left int, right int, after long, before long"
    open_ = spark.createDataFrame(rows_, names + ", after_apart int, before_apart int")
    got = op._closer(open_, 13).where("rep_id < doc_id").collect()
    assert [(r.doc_id, r.rep_id) for r in got] == [(8, 7)] * 2  # one for each side


def test_pairs_settled_many_at_a_time_have_the_passages_of_each_alone():
    rng = np.random.default_rng(3)
    records = []
    for _ in range(200):
        a = rng.integers(0, 1 << 16, rng.integers(30, 400)).astype(np.uint16)
        b = np.concatenate([rng.integers(0, 1 << 16, rng.integers(0, 60)).astype(np.uint16), a])
        changed = rng.random(len(b)) < rng.choice([0, 0.05, 0.2, 1])
        b[changed] = rng.integers(0, 1 << 16, changed.sum())
        b = np.delete(b, rng.integers(0, len(b), rng.integers(0, 4)))
        spans = []
        for _ in range(rng.integers(1, 4)):
            low = int(rng.integers(0, len(a)))
            high = int(rng.integers(low, len(a)))
            shifts = sorted({len(a) - len(b) + int(x) for x in rng.integers(-8, 9, rng.integers(1, 4))})
            spans.append({"low": low, "high": high, "shifts": shifts})
        records.append({"spans": spans, "shingles": a.tobytes(), "rep_shingles": b.tobytes()})
    batch = pa.RecordBatch.from_pylist(records)
    alone = {}
    for k, r in enumerate(records):
        a, b = (np.frombuffer(r[c], np.uint16) for c in ("shingles", "rep_shingles"))
        alone[k] = op.of_pair(a, b, [dict(s) for s in r["spans"]], 46, 0.8)
    for skip, n in ((0, 200), (37, 90)):
        got = dict(op.settled(batch.slice(skip, n), 46, 0.8))
        assert [got.get(k, []) for k in range(n)] == [alone[skip + k] for k in range(n)]
    assert 20 < len(dict(op.settled(batch, 46, 0.8))) < 180  # most of those without any are left out


def test_contexts_are_the_hashes_of_the_words_beside():
    rng = np.random.default_rng(4)
    h, size, lengths = rng.integers(0, 1 << 63, 90).astype(np.uint64), 5, op.context_lengths(50)
    for side in (1, -1):
        got = op.Contexts(h, size, lengths, side).at(np.arange(len(h) - size + 1))
        for at in range(len(h) - size + 1):
            own = want = 0
            for k in range(1, lengths[-1] + 1):
                place = at + size - 1 + k if side > 0 else at - k
                own = (own * 0x9E3779B97F4A7C15 + (int(h[place]) if 0 <= place < len(h) else 0)) % (1 << 64)
                if k in lengths:
                    want = want << 4 | int(mixed(np.array([own], np.uint64), k)[0]) >> 60
            assert got[at] == want

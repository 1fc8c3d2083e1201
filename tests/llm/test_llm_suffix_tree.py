"""The suffix tree against one made of plain counts."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus import frame, odd_rows, rows, text
from orefold.llm import common, exchange, suffix_tree

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
OTHER, END = "<other>", "<end>"
SMALL = {"least_context": 12, "least_next": 3, "evidence": 4.0}


def tokenised(t):
    w = "".join(c if c not in "\t\n\x0b\x0c\r" else " " for c in (t or "").translate(LOWER)).split(" ")
    return [x for x in w if x] + [END]


class Plain:
    """Counts, growth, tests and scores as the module words them, with dictionaries."""

    def __init__(self, train, depth=3, least_context=200, least_next=8, evidence=16.0):
        texts = [tokenised(t) for t in train]
        self.depth = depth
        self.counts = Counter(w for t in texts for w in t)
        self.tokens, self.documents = sum(self.counts.values()), len(texts)
        self.whole = self.tokens + 0.5 * (len(self.counts) + 1)
        self.named = {w for w, n in self.counts.items() if n >= least_context and w != END}
        self.root = {w: (self.counts[w] + 0.5) / self.whole for w in self.named | {END}}
        self.root[OTHER] = 1 - sum(self.root.values())
        symbols = [[self.symbol(w) for w in t] for t in texts]
        seen = Counter(s for t in symbols for s in t if s != END)
        candidates = {(s,): n for s, n in seen.items() if n >= least_context}
        levels = []
        for length in range(1, depth + 1):
            after = defaultdict(Counter)
            for t in symbols:
                for i in range(length, len(t)):
                    if tuple(t[i - length : i]) in candidates:
                        after[tuple(t[i - length : i])][t[i]] += 1
            after = {c: {s: n for s, n in f.items() if n >= least_next} for c, f in after.items()}
            levels.append((candidates, after))
            candidates = {
                (*c, s): n for c, f in after.items() for s, n in f.items() if n >= least_context and s != END
            }
            if not candidates:
                break
        kept = []
        for length, (candidates, after) in enumerate(levels, 1):
            kept.append(set())
            for c, total in candidates.items():
                apart = 0.0
                for s, n in after.get(c, {}).items():
                    base = self.root[s]
                    if length > 1:
                        above, above_after = levels[length - 2]
                        if s in above_after.get(c[1:], {}):
                            base = above_after[c[1:]][s] / above[c[1:]]
                    apart += n / total * math.log(n / total / base)
                if after.get(c) and total * apart >= evidence:
                    kept[-1].add(c)
        for length in range(len(kept), 1, -1):
            kept[length - 2] |= {c[1:] for c in kept[length - 1]}
        self.states = {
            c: (levels[length - 1][0][c], levels[length - 1][1].get(c, {})) for length, k in enumerate(kept, 1) for c in k
        }

    def symbol(self, w):
        return w if w in self.named or w == END else OTHER

    def probability(self, before, s):
        p = self.root[s]
        for length in range(1, min(self.depth, len(before)) + 1):
            state = self.states.get(tuple(before[-length:]))
            if state:
                total, after = state
                left = total - sum(after.values()) + suffix_tree.SMOOTHING
                p = (after.get(s, 0) + left * p) / (total + suffix_tree.SMOOTHING)
        return p

    def scores(self, t):
        words = tokenised(t)
        base = sum(math.log10((self.counts[w] + 0.5) / self.whole) for w in words)
        symbols = [self.symbol(w) for w in words]
        own = 0.0
        for i, (w, s) in enumerate(zip(words, symbols)):
            own += math.log10(self.probability(symbols[:i], s))
            if s == OTHER:
                own += math.log10((self.counts[w] + 0.5) / self.whole / self.root[OTHER])
        return len(words), sum(self.counts[w] > 0 for w in words), self.tokens, base, own


def patterned(rng, n):
    """Words that follow one another, so that contexts say something."""
    out = []
    for _ in range(n):
        out += rng.choice(
            [["The", "cat", "sat"], ["the", "dog", "ran", "off"], ["a", "cat", "ran", "home"], ["one", "to", "go", "up"], ["two", "to", "go", "down"], ["a", rng.choice("xyz") + str(rng.randrange(90))]]
        )
    return " ".join(out)


def corpus(seed, n=40):
    rng = random.Random(seed)
    train = [patterned(rng, rng.randrange(5, 120)) for _ in range(n)]
    return train, [patterned(rng, 30), text(rng, 30), "", None, "the the THE", train[0], "a\ta a \n the"]


def check(got, plain, docs):
    assert len(got) == len(docs)
    for i, t in enumerate(docs):
        want, r = plain.scores(t), got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
        assert r.base_score == pytest.approx(want[3])
        assert r.score == pytest.approx(want[4])


@pytest.mark.parametrize("most_sent", [10**6, 0])
def test_growth_retention_and_scores_equal_plain_counts(spark, most_sent):
    """With the tree sent to the tasks, and asked for by joins."""
    train, docs = corpus(7)
    plain = Plain(train, **SMALL)
    assert {len(c) for c in plain.states} == {1, 2, 3}
    model = suffix_tree.learned(frame(spark, rows(train)).select("text"), **SMALL, most_sent=most_sent)
    assert (model.sent is None) == (most_sent == 0)
    assert model.states.count() == len(plain.states)
    stored = sum(len(after) for _, after in plain.states.values())
    assert model.known.count() == len(plain.named) + len(plain.states) + stored
    got = {r.doc_id: r for r in suffix_tree.scored(frame(spark, rows(docs)), model).collect()}
    check(got, plain, docs)
    assert got[0].score > got[0].base_score


def test_cross_scores(spark):
    train, docs = corpus(9, 30)
    data = rows(train + docs)
    df = frame(spark, data, clash=True)
    usable = F.col("doc_id") < len(train)
    got = {r.doc_id: r for r in suffix_tree.cross_scored(df, usable, {"fold": F.col("doc_id") % 3}, **SMALL).collect()}
    assert list(got[0].asDict()) == ["doc_id", "fold", *[c.split()[0] for c in suffix_tree.SCORED.split(", ")]]
    check(got, Plain(train, **SMALL), train + docs)
    assert got[4].fold == 1


def test_next_symbols_sum_to_one(spark):
    train, _ = corpus(8, 25)
    plain = Plain(train, **SMALL)
    for before in ([], ["the"], ["a", "cat"], [OTHER, "the", "cat"], ["cat", "cat", "cat"]):
        assert sum(plain.probability(before, s) for s in plain.root) == pytest.approx(1)


def test_the_tree_grows_with_the_corpus(spark):
    """Four times the text, drawn alike: more symbols, states and next symbols."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]

    def drawn():
        at, out = 0, []
        for _ in range(150):
            at = (at * 7 + int(rng.random() ** 3 * 40)) % 400
            out.append(vocabulary[at])
        return " ".join(out)

    texts = [drawn() for _ in range(160)]
    small = suffix_tree.learned(frame(spark, rows(texts[:40])).select("text"), **SMALL)
    large = suffix_tree.learned(frame(spark, rows(texts)).select("text"), **SMALL)
    assert large.words.symbols.count() > small.words.symbols.count()
    assert large.states.count() > 1.3 * small.states.count()
    assert large.known.count() > 1.3 * small.known.count()


def test_odd_rows(spark):
    docs = odd_rows()
    df = frame(spark, docs, clash=True)
    texts = [d[1] for d in docs]
    model = suffix_tree.learned(df.select("text"), **SMALL)
    got = suffix_tree.scored(df, model).collect()
    plain = Plain(texts, **SMALL)
    assert sorted((r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == sorted(
        (w[0], round(w[3], 6), round(w[4], 6)) for w in map(plain.scores, texts)
    )
    nothing = suffix_tree.learned(frame(spark, []).select("text"), **SMALL)
    got = suffix_tree.scored(df, nothing).collect()
    assert all(r.score == r.base_score and r.n_known == 0 and r.train_tokens == 0 for r in got)
    assert sorted(round(r.base_score, 6) for r in got) == sorted(
        round(len(tokenised(t)) * math.log10(0.5 / 0.5), 6) + 0.0 for t in texts
    )
    assert suffix_tree.scored(frame(spark, []), nothing).count() == 0


def test_words_and_contexts_seen_twice_are_learned(spark):
    """With the limits that the query runs with: a text that occurs twice is known as a whole."""
    rng = random.Random(3)
    twice = " ".join(f"w{i}" for i in range(40))
    train = [twice, twice, *[text(rng, 40) for _ in range(500)]]
    model = suffix_tree.learned(frame(spark, rows(train)).select("text"))
    plain = Plain(train, least_context=2, least_next=2)
    assert {"w0", "w39"} <= plain.named and model.words.symbols.count() == len(plain.named)
    assert ("w0",) in plain.states and model.states.count() == len(plain.states)
    got = {r.doc_id: r for r in suffix_tree.scored(frame(spark, rows([twice])), model).collect()}
    check(got, plain, [twice])
    assert got[0].score > got[0].base_score + 20


def test_nothing_but_pairs_and_counts_travels(spark):
    symbols = np.array([[2, 3, 4, 2, 3, 4, 1], [5, 3, 4, 2, 3, 9, 1]], "<u4")
    rows_ = spark.createDataFrame([(bytearray(s.tobytes()),) for s in symbols], "symbols binary")
    for depth in (1, 2, 3):
        made = suffix_tree.pair_counts(rows_, depth, None, 2)
        assert made.columns == ["ctx", "next", "n"]
        wanted = {}
        for s in symbols.astype(np.uint64):
            at = np.arange(depth, len(s))
            for c, x in zip(suffix_tree.contexts_at(s, at, depth).view(np.int64).tolist(), s[at].tolist()):
                wanted[c, x] = wanted.get((c, x), 0) + 1
        assert {(r.ctx, r.next): r.n for r in made.collect()} == {k: n for k, n in wanted.items() if n >= 2}


def test_shuffles_of_a_stored_table_are_removed(spark, tmp_path):
    from orefold.llm import common

    before = spark.conf.get(common.SHUFFLE_CLEANUP)
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    held = lambda: tracker.shuffleStatuses().size()
    n = held()
    made = common.stored(spark.range(1000).repartition(3, "id").groupBy("id").count(), "removed")
    assert made.count() == 1000
    assert held() <= n + 1  # that of the count here
    assert spark.conf.get(common.SHUFFLE_CLEANUP) == before


def cross(spark, train, docs, **limits):
    df = frame(spark, rows(train + docs)).repartition(3)
    usable = F.col("doc_id") < len(train)
    return {r.doc_id: r for r in suffix_tree.cross_scored(df, usable, **limits).collect()}


@pytest.mark.parametrize("depth, evidence", [(1, 4.0), (2, 4.0), (3, 0.5), (3, 4.0), (3, 30.0), (4, 4.0), (5, 2.0)])
def test_cross_scores_over_chunks_and_buckets(spark, monkeypatch, depth, evidence):
    """What cannot be retained is not counted; nothing else may be missing, at any depth."""
    monkeypatch.setattr(suffix_tree, "CHUNK_TOKENS", 200)
    monkeypatch.setattr(suffix_tree, "SLICE_BYTES", 500)
    monkeypatch.setattr(exchange, "LEAST_TOKENS", 300)
    train, docs = corpus(11, 50)
    limits = {"depth": depth, "least_context": 3, "least_next": 2, "evidence": evidence}
    plain = Plain(train, **limits)
    assert {len(c) for c in plain.states} == set(range(1, depth + 1))
    check(cross(spark, train, docs, **limits), plain, train + docs)


def test_suffixes_of_retained_contexts_are_states(spark, monkeypatch):
    """Contexts that are states only as suffixes of others, which other chunks hold."""
    monkeypatch.setattr(suffix_tree, "CHUNK_TOKENS", 100)
    rng = random.Random(5)
    train = []
    for _ in range(120):
        first = rng.choice(["north", "south"])
        train.append(" ".join([first, "x", "y", {"north": "up", "south": "down"}[first], *rng.choices("abcd", k=12)]))
    plain = Plain(train, least_context=3, least_next=2, evidence=30.0)
    # y follows x alone, so that "x y" says nothing that "y" does not
    assert {("north", "x", "y"), ("x", "y")} <= set(plain.states)
    assert plain.states["x", "y"][1] == plain.states["y",][1]
    docs = ["x y up", "south x y down", "q x y down x y", "y"]
    check(cross(spark, train, docs, least_context=3, least_next=2, evidence=30.0), plain, train + docs)


def test_arrays_are_stored_and_travel_not_rows(spark, monkeypatch, tmp_path):
    """Tables of the stages hold few rows, whatever the number of words, pairs and contexts; those
    that ask are gone once they are answered."""
    monkeypatch.setattr(common, "shared_folder", lambda spark: f"file://{tmp_path}")
    rng = random.Random(8)
    train = [text(rng, 400) for _ in range(40)]
    assert len(cross(spark, train, train[:2])) == 42
    folders = [str(p) for p in tmp_path.iterdir() if any(p.rglob("*.parquet"))]
    assert folders
    assert sum(spark.read.parquet(f).count() for f in folders) < 200
    assert not list(tmp_path.rglob("kind=ask-*"))


def test_words_with_one_32_bit_hash_are_symbols_of_their_own(spark):
    """``w49551`` and ``w124913`` have the same upper half of xxhash64."""
    rng = random.Random(6)
    train = [" ".join(rng.choices(["w49551 up", "w124913 down", "a b", "c"], k=30)) for _ in range(60)]
    docs = ["w49551 up w124913 down", "w124913 up"]
    check(cross(spark, train, docs), Plain(train, least_context=2, least_next=2), train + docs)


def test_cross_scores_of_odd_rows(spark):
    docs = odd_rows()
    df = frame(spark, docs, clash=True)
    texts = [d[1] for d in docs]
    got = suffix_tree.cross_scored(df, F.lit(True), {"part": F.col("part")}, **SMALL).collect()
    plain = Plain(texts, **SMALL)
    assert sorted((r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == sorted(
        (w[0], round(w[3], 6), round(w[4], 6)) for w in map(plain.scores, texts)
    )
    assert {r.part for r in got} == {6}
    for usable in (F.lit(False), F.lit(None).cast("boolean")):
        got = suffix_tree.cross_scored(df, usable, **SMALL).collect()
        assert len(got) == len(docs) and all(r.score == r.base_score == 0 and r.n_known == r.train_tokens == 0 for r in got)
    assert suffix_tree.cross_scored(frame(spark, []), F.lit(True)).count() == 0


def test_arrays_are_packed_and_dealt_whole(monkeypatch):
    rng = np.random.default_rng(2)
    arrays = [rng.integers(0, 1 << 64, 1000, np.uint64), np.zeros(0, np.int64), rng.random(7), rng.random(9) < 0.5, np.arange(5, dtype=np.uint32), np.arange(-3, 600)]
    for a, b in zip(arrays, exchange.unpacked(exchange.packed(*arrays)), strict=True):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()
    for few in (rng.integers(0, 9, 500, np.uint64), arrays[0], arrays[0][:0], arrays[0] % np.uint64(300)):
        for most in (0, 1 << 21):
            monkeypatch.setattr(exchange, "FEW_KEYS", most)
            key, of = exchange.distinct(few)
            assert key.tolist() == np.unique(few).tolist() and key[of].tolist() == few.tolist()
    keys = np.unique(arrays[0])
    asked = exchange.asking(3, 7, "x", keys, np.arange(len(keys)))
    assert {r[0] for r in asked} <= set(range(7)) and all(r[1:3] == ("ask-x", 3) for r in asked)
    parts = [exchange.unpacked(r[-1]) for r in sorted(asked)]
    assert np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]).tolist() == keys.tolist()
    assert np.concatenate([p[1] for p in parts]).tolist() == list(range(len(keys)))

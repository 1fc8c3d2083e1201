"""Language ID and toxicity."""

import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpus import frame, odd_rows, rows, text
from orefold.llm import language, queries, toxicity
from orefold.llm.common import binary

SMALL = "/root/testdata/sf0.01"
#: A tenth of the smaller table's labels are too few for words that only few documents hold.
LABELLED = "/root/testdata/sf0.1"


# language

def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    samples = [("a", bytes(rng.integers(97, 123, 5).tolist()), 1) for _ in range(6)] + [("b", b"xyzzy", 2)]
    net = language.train(samples, steps=3)
    for name in ("tables", "loops"):
        setattr(net, name, [p.astype(np.float64) for p in getattr(net, name)])
    net.out, net.bias = net.out.astype(np.float64), net.bias.astype(np.float64)
    x = np.array([list(s[1]) for s in samples], np.uint8)
    y = np.array([s[0] == "b" for s in samples], int)

    def loss():
        both = np.concatenate([net.states(x, 0), net.states(x, 1)], axis=2)
        p = language._softmax(both @ net.out + net.bias)
        return -np.log(p[:, np.arange(len(y)), y]).mean()

    params = [*net.tables, *net.loops, net.out, net.bias]
    for p, g in zip(params, language._gradients(net, x, y)):
        flat, grad = p.reshape(-1), g.reshape(-1)
        for k in np.argsort(-np.abs(grad))[:4]:
            kept, eps = flat[k], 1e-3
            flat[k] = kept + eps
            up = loss()
            flat[k] = kept - eps
            down = loss()
            flat[k] = kept
            assert (up - down) / (2 * eps) == pytest.approx(grad[k], rel=0.03, abs=2e-5)


def test_more_than_32_languages(spark):
    rng = random.Random(8)
    langs = ["l%02d" % k for k in range(40)]
    made = []
    for k, lang in enumerate(langs):
        # 12 letters of its own script each; the last languages are the rarest
        letters = [chr(0x4E00 + 97 * k + i) for i in range(12)]
        for _ in range(25 if k < 32 else 12):
            body = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 5))) for _ in range(40)]
            made.append((len(made), " ".join(body), lang))
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string")
    net = language.learned(docs, F.lit(True))
    assert net.langs == langs
    got, _ = language.predictions(net, binary(pa.array([m[1] for m in made])))
    rare = [g == m[2] for g, m in zip(got, made) if m[2] >= "l32"]
    assert sum(rare) >= 0.75 * len(rare)


def test_document_shares_equal_word_by_word():
    rng = random.Random(5)
    net = language.train([("a", b"bana", 3), ("b", b"kolo", 2), ("c", b"x" * 40, 1)], steps=20)
    texts = [text(rng, n) for n in (1, 40, 200)] + ["", "a" * 100 + " B2b, ÉÉ", "12 34"]
    got = language.document_shares(net, binary(pa.array(texts)))
    for t, share in zip(texts, got):
        cut = "".join(chr(b) if language.INSIDE[b] else " " for b in t.encode()).encode("latin-1")
        want, n = np.zeros(3), 0
        for w in cut.split():
            w = w.decode().lower().encode()
            for i in range(0, len(w), language.PIECE):
                piece = np.frombuffer(w[i : i + language.PIECE], np.uint8)[None]
                want += net.labels(piece)[0]
            n += len(w)
        assert share == pytest.approx(want / max(n, 1), abs=1e-4)


def test_capitals_of_any_script_read_like_small_letters():
    words = [("ru", w.encode(), 3) for w in "привет дорога молоко зима вода город".split()]
    words += [("bg", w.encode(), 3) for w in "здравей пътят мляко зимата водата градът".split()]
    net = language.train(words, steps=60)
    for text in ("Привет ДОРОГА молоко", "ЗДРАВЕЙ Пътят мляко"):
        texts = [text, text.lower(), text.upper()]
        small = language.document_shares(net, binary(pa.array(texts)))
        assert np.allclose(small[0], small[1]) and np.allclose(small[1], small[2])
    assert language.predictions(net, binary(pa.array(["ПРИВЕТ ДОРОГА ВОДА"])))[0] == ["ru"]


def test_language_held_out(spark):
    got = queries.op6_language(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "text")
    joined = got.join(docs, "doc_id")
    held = joined.where("held_out")
    right = held.where(F.col("lang") == F.col("lang_pred")).count()
    assert right >= 0.95 * held.count()
    assert got.count() == docs.count()
    assert got.where("score < 0 or score > 1").count() == 0


def test_language_odd_rows(spark):
    docs = odd_rows()
    df = frame(spark, docs, clash=True)
    net = language.learned(df, F.lit(True))
    got = {r.doc_id: r for r in language.identified(df, net).collect() if r.doc_id is not None}
    assert {got[i].lang_pred for i in (1, 2, 3, 10)} == {language.UNKNOWN}
    assert got[7].lang_pred in ("en", "fr") and got[4].lang_pred == "en"
    assert language.learned(frame(spark, []), F.lit(True)) is None
    nothing = language.identified(df, None).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {(language.UNKNOWN, 0.0)}
    assert language.accepted(df, None).count() == len(docs)
    kept = language.accepted(df, net)
    assert kept.columns == df.columns
    assert {1, 2, 3, 10}.isdisjoint(r.doc_id for r in kept.collect())


# toxicity

def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 8):
        emission, moves = rng.normal(0, 2, n), rng.normal(0, 2, 3)
        score = {}
        for path in itertools.product((0, 1), repeat=n):
            s = sum(e for e, y in zip(emission, path) if y)
            for a, b in zip(path, path[1:]):
                s += {(0, 0): 0, (0, 1): moves[0], (1, 0): moves[1], (1, 1): moves[2]}[a, b]
            score[path] = math.exp(s)
        whole = sum(score.values())
        want = [sum(v for p, v in score.items() if p[t]) / whole for t in range(n)]
        assert toxicity.marginals(emission[None], moves)[0] == pytest.approx(want)
        ragged = toxicity.ragged_marginals(np.tile(emission, 2), np.array([n, n]), moves)
        assert ragged == pytest.approx(np.tile(want, 2))


def test_toxicity_held_out(spark):
    got = queries.op4_toxicity(spark, LABELLED)
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet").select("doc_id", "toxic")
    held = got.where("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.toxic for r in held)
    assert right >= 0.98 * len(held)
    toxic = [r.score for r in held if r.toxic]
    other = [r.score for r in held if not r.toxic]
    wins = sum((a > b) + 0.5 * (a == b) for a in toxic for b in other)
    assert wins >= 0.95 * len(toxic) * len(other)
    assert any(r.spans for r in held if r.toxic)


def test_toxic_spans_and_odd_rows(spark):
    rng = random.Random(6)
    plain = [text(rng, 60) for _ in range(60)]
    nasty = [t.replace(" ", " grottig ", 3) for t in plain[:30]]
    data = rows(plain + nasty)
    labels = spark.createDataFrame(
        [(i, int(i >= 60)) for i in range(90)] + [(0, None), (None, 1), (70, 0)], "doc_id long, toxic int"
    )
    df = frame(spark, data)
    field = toxicity.fitted(df, labels, F.lit(True))
    odd = odd_rows() + [(20, "É\U0001f600 wow grottig, hm", "en", "a", 1)]
    got = {r.doc_id: r for r in toxicity.scored(frame(spark, odd, clash=True), field).collect()}
    assert got[20].predicted == 1 and got[20].spans == "7:14"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert got[1].score == got[2].score and got[1].predicted == 0
    # a label table with one class, or none: nothing to learn
    assert toxicity.fitted(df, labels.where("toxic = 0"), F.lit(True)) is None
    assert toxicity.fitted(frame(spark, []), labels, F.lit(True)) is None
    assert {r.score for r in toxicity.scored(df, None).collect()} == {0.0}

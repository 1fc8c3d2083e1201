"""Quality rules, mixing and token ids."""

import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from corpus import frame, odd_rows, rows, text
from orefold.llm import mixing, quality, queries, tokens

TINY = "/root/testdata/sf0.001"


# quality

def by_sql(df):
    con = duckdb.connect()
    held = df.select("doc_id", "text", "lang", "source").toArrow()  # noqa: F841
    con.execute("create view documents as select * from held")
    return con.execute(quality.ORACLE_SQL).fetchall()


def compared(got):
    return sorted(got, key=lambda r: [(v is None, v) for v in r])


def test_quality_equals_sql(spark):
    rng = random.Random(1)
    data = [t for n in (60, 200, 900) for t in [text(rng, n) for _ in range(60)]]
    junk = ["# $ % & " * 200, "same line here\n" * 90, "ab " * 300, "wordy" * 40 + " x" * 70]
    lines = ["\n".join([text(rng, 5), "", " ", text(rng, 6)] * k) for k in (1, 3, 20)]
    df = frame(spark, rows(data + junk + lines) + odd_rows())
    got = [tuple(r) for r in quality.judged(df).collect()]
    assert compared(got) == compared(by_sql(df))
    kept = {r[0]: r[-1] for r in got if r[0] is not None}
    assert sum(kept[i] for i in range(len(data)) if i > 10) >= 0.99 * (len(data) - 11)
    assert not any(kept[len(data) + k] for k in range(len(junk)))


def test_quality_on_given_table(spark):
    df = spark.read.parquet(f"{TINY}/documents.parquet")
    assert compared([tuple(r) for r in queries.op5_quality(spark, TINY).collect()]) == compared(by_sql(df))


def test_quality_empty(spark):
    assert quality.judged(frame(spark, [])).count() == 0
    assert quality.judged(frame(spark, odd_rows(), clash=True)).count() == len(odd_rows())


def test_buckets_are_narrow_and_ordered(spark):
    values = [*range(300), 1000, 1023, 1024, 1025, 9999, 10**6, 2**40 - 1, 2**40]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    b = quality.bucket(df["v"])
    got = df.select("v", b.alias("b"), quality.bucket_start(b).alias("start")).orderBy("v").collect()
    assert [r.b for r in got] == sorted(r.b for r in got)
    assert all(r.start <= r.v < r.start + max(1, r.start / 31 + 1e-9) for r in got)


# mixing

def shared_targets(sizes):
    """Water filling, one round after another."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, out, free = sum(sizes.values()), {}, set(order)
    while free:
        rest = total - sum(out.values())
        level = rest / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not full:
            return out | {s: weight[s] * level for s in free}
        out |= {s: 3.0 * sizes[s] for s in full}
        free -= full
    return out


def mixed(spark, data, **kw):
    return [r.asDict() for r in mixing.digest(mixing.mixed_copies(frame(spark, data, **kw))).collect()]


def test_mix_meets_its_targets(spark):
    rng = random.Random(2)
    source = [rng.choice(["a", "a", "a", "a", "a", "b", "é", "Z", None, "tiny"]) for _ in range(2000)]
    source = [s if s != "tiny" or i < 40 else "a" for i, s in enumerate(source)]
    texts = [text(rng, rng.randrange(0, 60)) for _ in range(2000)]
    data = rows(texts, source=source)
    got = mixed(spark, data)
    sizes, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for s, t in zip(source, texts):
        sizes[s] += len(t.split())
        most[s] = max(most[s], len(t.split()))
    want = shared_targets(sizes)
    where = {d[0]: d[3] for d in data}
    for r in got:
        s = where[r["doc_id"]]
        assert r["size"] == len(texts[r["doc_id"]].split()) and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s])
        assert r["taken"] in {r["size"] * k for k in range(4)}
        taken[s] += r["taken"]
    assert len(got) == len(data)
    assert all(abs(taken[s] - want[s]) <= most[s] for s in sizes)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    again = mixed(spark, data[::-1])
    key = lambda r: r["doc_id"]
    assert sorted(again, key=key) == sorted(got, key=key)


def test_fractions_keep_their_odds(spark):
    """Over many sources alike, a document is taken as often as its fraction says."""
    n = 300
    source = [f"s{k:03d}" for k in range(n) for _ in range(3)]
    data = rows([("w " * size).strip() for _ in range(n) for size in (3, 5, 7)], source=source)
    want = shared_targets({f"s{k:03d}": 15 for k in range(n)})
    total = defaultdict(int)
    for r in mixed(spark, data):
        total[r["doc_id"] // 3 % 3, r["doc_id"] % 3] += r["taken"] // r["size"]
    for (weight, _), copies in total.items():
        assert copies / (n / 3) == pytest.approx(want[f"s{weight:03d}"] / 15, abs=0.15)


def test_mix_odd_rows(spark):
    docs = odd_rows()
    got = mixed(spark, docs, clash=True)
    assert len(got) == len(docs)
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixed(spark, []) == []
    assert {r["taken"] for r in mixed(spark, rows([None, "", " "]))} == {0}
    df = frame(spark, docs, clash=True)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    assert sum(len((r.text or "").split()) for r in out.collect()) == sum(r["taken"] for r in got)


def test_mix_runs_no_python(spark):
    plan = mixing.mixed_copies(frame(spark, odd_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# token ids

@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.one_of(st.integers(0, 300), st.integers(0, 49_407), st.integers(0, 2**32 - 1)), max_size=300),
    st.integers(1, 70), st.sampled_from([0.01, 0.5, 0.9, 1.0]),
)
def test_blocks_round_trip(ids, block, fit):
    data = tokens.encode_segment(np.array(ids, np.uint32), block, fit)
    assert tokens.decode_segment(data).tolist() == ids
    for start in range(0, len(ids), 41):
        assert tokens.ids_at(data, start, 50).tolist() == ids[start : start + 50]


def test_outliers_cost_little():
    ids = np.arange(1024, dtype=np.uint32) % 16
    few = ids.copy()
    few[::200] = 49_000
    assert len(tokens.encode_block(few)) < len(tokens.encode_block(ids)) + 6 * 6 + 1
    with pytest.raises(ValueError):
        tokens.decode_segment(b"nope" + bytes(20))


def whole(texts):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(queries.tokenizer_file())
    return [made.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_encoded_equals_whole_texts(spark):
    rng = random.Random(9)
    texts = [text(rng, rng.randrange(1, 300)) for _ in range(40)]
    texts += [
        "Don't stop!! it's 12,5% -- (ok)...", "a <|endoftext|> b <|STARTOFTEXT|> c", "ÀÉ é Å ﬁ ſ İİ K",
        "x y z", "!!!", "a.b.c., d!?; e'", "中文 字 \U0001f600\U0001f600", "'s 'S don'T ''", "\x00\x1f a",
        "Á. B̧, 1st 2nd 3.14 a_b a-b a/b @me #tag", "Σας ΟΔΟΣ ς", "", None, "word" * 3000,
    ]
    order = list(range(len(texts)))
    rng.shuffle(order)
    data = rows(texts)
    got = tokens.encoded(frame(spark, [data[i] for i in order]), queries.tokenizer_file()).collect()
    start = 0
    for r, ids in zip(sorted(got, key=lambda r: r.doc_id), whole(texts)):
        crc = tokens.crc32(np.array(ids, "<u4").tobytes())
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_trailing_punctuation_is_no_new_word():
    import pyarrow as pa

    stems, tails = [f"stem{chr(97 + k % 26)}{k}" for k in range(50)], ["", ".", ",", "!?", "...", "'-"]
    texts = [" ".join(s + t for s in stems) for t in tails] + [" ".join(tails), "é. .é, a.b.", "", "x", "!"]
    encode = tokens.WordEncoder(queries.tokenizer_file())
    ids, counts = encode.texts(pa.array([t.encode() for t in texts], pa.large_binary()))
    made = [encode.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(m) for m in made]
    assert ids.tolist() == [i for m in made for i in m]
    assert len(encode.places) <= len(stems) + len(tails) + 10
    # what a worker forgets and learns again has the same ids
    again = encode.texts(pa.array([t.encode() for t in reversed(texts)], pa.large_binary()))[0]
    assert again.tolist() == [i for m in reversed(made) for i in m]


def test_tokens_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(tokens, "RANGE_BYTES", 4000)
    monkeypatch.setattr(tokens, "SEGMENT_BYTES", 1500)
    rng = random.Random(10)
    texts = [text(rng, rng.randrange(1, 90)) for _ in range(120)]
    got = sorted(tokens.encoded(frame(spark, rows(texts)), queries.tokenizer_file()).collect())
    ends = np.cumsum([len(i) for i in whole(texts)])
    assert [r.start + r.n_tokens for r in got] == ends.tolist()


def test_tokens_odd_rows(spark):
    docs = odd_rows()
    got = tokens.encoded(frame(spark, docs, clash=True), queries.tokenizer_file()).collect()
    lengths = [len(i) for i in whole([d[1] for d in docs])]
    assert sorted(r.n_tokens for r in got) == sorted(lengths)
    assert sorted(r.start for r in got)[-1] == sum(lengths) - max(got, key=lambda r: r.start).n_tokens
    assert {r.doc_id for r in sorted(got, key=lambda r: r.start)[:2]} == {None}
    assert tokens.encoded(frame(spark, []), queries.tokenizer_file()).count() == 0

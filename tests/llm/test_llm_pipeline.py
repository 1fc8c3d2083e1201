import random

import corpus_pipeline
import __spark_entry__ as contract
from corpus import DOCS, text
from orefold.llm import mixing, queries, simhash

SMALL = "/root/testdata/sf0.001"


def write(spark, folder, data, items):
    spark.createDataFrame(data, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_decisions_take_effect(spark, tmp_path):
    rng = random.Random(1)
    texts = [text(rng, 80) for _ in range(60)]
    item = text(rng, 30)
    data = [(i, t, "en", f"s{i % 2}", 1) for i, t in enumerate(texts)]
    data += [(100, texts[3], "en", "s1", 1), (101, "12 34 !!", "en", "s0", 1), (102, None, None, None, None)]
    data += [(103, texts[5] + " tail " + item + " more", "en", "s0", 1)]
    d = write(spark, tmp_path / "in", data, [(1, item)])
    docs, ids = spark.read.parquet(f"{d}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, d)
        assert docs.columns == [c.split()[0] for c in DOCS.split(", ")]
        ids.append(sorted(r.doc_id for r in docs.select("doc_id").collect()))
    assert set(range(60)) | {100, 103} == set(ids[0])
    assert ids[1] == [i for i in ids[0] if i != 100]
    assert ids[2] == [i for i in ids[1] if i != 103]
    sources = {0: "s0", 1: "s1"}
    sizes = {s: sum(len(texts[i].split()) for i in range(60) if i % 2 == k) for k, s in sources.items()}
    want = {"s0": sum(sizes.values()) / 3, "s1": sum(sizes.values()) * 2 / 3}
    for k, s in sources.items():
        taken = sum(len(texts[i].split()) for i in ids[3] if i % 2 == k)
        assert abs(taken - min(want[s], 3 * sizes[s])) <= 80
    out = corpus_pipeline.run(spark, d).collect()
    assert sorted(r.doc_id for r in out) == ids[3]
    assert sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)


CLASHING = ", key long, nth int, of string, copies int, again int, number int, copy int, count long, fp long, score double"


def test_empty_table(spark, tmp_path):
    d = write(spark, tmp_path / "in", [], [(1, "one two three")])
    assert corpus_pipeline.run(spark, d).collect() == []


def test_clashing_columns_and_repeated_rows(spark, tmp_path):
    """Columns with the names that stages use inside pass through them."""
    rng = random.Random(2)
    texts = [text(rng, 60) for _ in range(20)]
    data = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(3, texts[3], "en", "s", 1), (None, texts[4], "en", None, 1)]
    extra = [(*r, 1, 2, "x", 3, 4, 5, 6, 7, 8, 0.5) for r in data]
    folder = tmp_path / "in"
    spark.createDataFrame(extra, DOCS + CLASHING).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, text(rng, 30))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(folder))
        assert docs.columns == columns, name
        row = docs.first()
        assert tuple(row)[5:] == (1, 2, "x", 3, 4, 5, 6, 7, 8, 0.5)
    assert {r.doc_id for r in docs.collect()} <= {*range(20), None}
    out = corpus_pipeline.run(spark, str(folder)).collect()
    assert out and sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)


def test_run_on_given_tables(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0


def test_registered():
    names = contract.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert len(queries.QUERIES) == 13
    assert mixing.MAX_COPIES == 3 and simhash.RADIUS == 4

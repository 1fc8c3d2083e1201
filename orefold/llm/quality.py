"""Quality rules with thresholds that adapt to each language and source.

Each document is measured once. Documents that pass the base rules feed a quantile sketch
per language, source and metric: counts over buckets of a fixed relative width, which add
up in any order, so sketches merge exactly and a rerun gives the same thresholds. A metric
is out of bounds beyond three spreads (upper quartile less lower quartile, but a least
spread each) from the nearer quartile. Groups of fewer than ``MIN_GROUP`` documents use
the merged sketch of their language, or that of all documents where this is small too.
The thresholds, one row per language and source, are joined back and decide.

Metrics are whole numbers: symbols per 10,000 word characters, repeated lines and repeated
words per 1,000, hundredths of characters per word.

Defined results: a null or empty text has zero words and fails the base rules; null
languages and sources are groups of their own; repeated rows are judged one by one; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orefold.llm.common import SPACE, Words, mixed, over_slices, raw, stored
from orefold.operators.joins import size_checked

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_GROUP = 100
SPREADS = 3
#: Least spread of each metric; a lower bound is set for the last one only.
METRICS = {"symbols": 100, "dup_lines": 100, "repeats": 100, "word_length": 50}
#: Buckets for each doubling of a value: a bucket is at most 1/32 of its value wide.
_HALF = 32

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True  # fixed values: the characters that count as symbols
_LINE = np.ones(256, bool)
_LINE[10] = False
_LETTER = (np.arange(256) & 0xC0) != 0x80  # a byte that begins a code point
_WORD_LETTER = _LETTER & ~SPACE

MEASURED = (
    "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, "
    "n_lines long, n_dup_lines long, n_repeat_words long"
)


def per_text(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many bytes of each text are marked."""
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[at])


def repeated_words(hashes: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
    """Words that lie in a 3-word window found twice or more in their text."""
    if len(hashes) < 3:
        return np.zeros(texts, np.int64)
    whole = doc[2:] == doc[:-2]
    one, three = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    window = mixed((hashes[:-2] * one + hashes[1:-1]) * three + hashes[2:]) + mixed(
        doc[:-2].astype(np.uint64), 3
    )
    window = mixed(window)
    at = np.flatnonzero(whole)
    order = at[np.argsort(window[at])]
    same = window[order[1:]] == window[order[:-1]]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(len(hashes), bool)
    for k in range(3):
        covered[order[twice] + k] = True
    return np.bincount(doc[covered], minlength=texts)


def measured(docs: DataFrame) -> DataFrame:
    """The counts of each document, with its language and source."""

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        data, at = raw(texts)
        words = Words(data, at, ~SPACE)
        hashes = words.hashes()
        lines = Words(data, at, _LINE)
        inked = np.concatenate([[0], np.cumsum(~SPACE[data])])
        full = inked[lines.ends] > inked[lines.starts]
        key = mixed(lines.hashes() + mixed(lines.doc.astype(np.uint64), 5))[full]
        of = lines.doc[full]
        _, first = np.unique(key, return_index=True)
        n = len(texts)
        n_lines, distinct = np.bincount(of, minlength=n), np.bincount(of[first], minlength=n)
        counts = [
            words.counts,
            per_text(_WORD_LETTER[data], at),
            per_text(_SYMBOLS[data], at),
            n_lines,
            n_lines - distinct,
            repeated_words(hashes, words.doc, n),
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", "lang", "source")]
            + [pa.array(c.astype(np.int64)) for c in counts],
            names=["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines",
                   "n_dup_lines", "n_repeat_words"],
        )

    wanted = docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), "text"
    )
    return wanted.mapInArrow(over_slices(work), MEASURED)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def metrics() -> dict[str, Column]:
    def share(part: str, whole: str, scale: int) -> Column:
        return F.expr(f"{scale} * {part} div greatest({whole}, 1L)")

    return {
        "symbols": share("n_symbols", "word_chars", 10_000),
        "dup_lines": share("n_dup_lines", "n_lines", 1000),
        "repeats": share("n_repeat_words", "n_words", 1000),
        "word_length": share("word_chars", "n_words", 100),
    }


# the sketch

def bucket(value: Column) -> Column:
    """Buckets rise with the value; below 64 each value has its own."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return (shift * _HALF + F.floor(value / F.pow(F.lit(2), shift))).cast("long")


def bucket_start(b: Column) -> Column:
    shift = F.greatest(F.floor(b / _HALF) - 1, F.lit(0))
    return ((b - shift * _HALF) * F.pow(F.lit(2), shift)).cast("long")


def sketch(rows: DataFrame, by: list[str]) -> DataFrame:
    """Counts per bucket of each metric: ``by, metric, bucket, n``."""
    each = [F.struct(F.lit(k).alias("metric"), bucket(v).alias("bucket")) for k, v in metrics().items()]
    return (
        rows.select(*by, F.explode(F.array(*each)).alias("m"))
        .groupBy(*by, "m.metric", "m.bucket").agg(F.count(F.lit(1)).alias("n"))
    )


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    return sketches.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """``by, metric, size, low, high``: starts of the buckets that hold both quartiles."""
    group = Window.partitionBy(*by, "metric")
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = sketches.withColumn("size", F.sum("n").over(group)).withColumn("seen", F.sum("n").over(upto))
    start = bucket_start(F.col("bucket"))
    return running.groupBy(*by, "metric").agg(
        F.max("size").alias("size"),
        F.min(F.when(F.col("seen") * 4 >= F.col("size"), start)).alias("low"),
        F.min(F.when(F.col("seen") * 4 >= F.col("size") * 3, start)).alias("high"),
    )


def thresholds(rows: DataFrame) -> DataFrame:
    """``lang, source`` and the bounds ``<metric>_low``, ``<metric>_high``."""
    own = stored(sketch(rows, ["lang", "source"]), "quality-sketch")
    levels = [
        quartiles(own, ["lang", "source"]),
        quartiles(merged(own, ["lang"]), ["lang"]),
        quartiles(merged(own, []), []),
    ]
    named = [
        q.select(
            *[F.col(c).alias(f"{c}{i}") for c in q.columns if c in ("lang", "source")],
            F.col("metric").alias(f"metric{i}"), F.struct("size", "low", "high").alias(f"q{i}"),
        )
        for i, q in enumerate(levels)
    ]
    every = named[0].join(
        size_checked(named[1]), F.col("lang0").eqNullSafe(F.col("lang1")) & (F.col("metric0") == F.col("metric1"))
    ).join(F.broadcast(named[2]), F.col("metric0") == F.col("metric2"))
    chosen = (
        F.when(F.col("q0.size") >= MIN_GROUP, F.col("q0"))
        .when(F.col("q1.size") >= MIN_GROUP, F.col("q1"))
        .otherwise(F.col("q2"))
    )
    least = F.create_map(*[F.lit(x) for kv in METRICS.items() for x in kv])
    every = every.select("lang0", "source0", "metric0", chosen.alias("q")).withColumn(
        "reach", SPREADS * F.greatest(F.col("q.high") - F.col("q.low"), least[F.col("metric0")].cast("long"))
    )
    bounds = [
        F.max(F.when(F.col("metric0") == m, bound)).alias(f"{m}_{side}")
        for m in METRICS
        for side, bound in (("low", F.col("q.low") - F.col("reach")), ("high", F.col("q.high") + F.col("reach")))
    ]
    return every.groupBy("lang0", "source0").agg(*bounds)


def judged(docs: DataFrame) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for each document."""
    rows = stored(measured(docs), "quality-measured").withColumn("base_failed", base_failed())
    limits = stored(thresholds(rows.where("not base_failed")), "quality-thresholds")
    fine = F.lit(True)
    for name, value in metrics().items():
        fine &= value <= F.col(f"{name}_high")
    fine &= metrics()["word_length"] >= F.col("word_length_low")
    return (
        rows.join(
            size_checked(limits),
            F.col("lang").eqNullSafe(F.col("lang0")) & F.col("source").eqNullSafe(F.col("source0")),
            "left",
        )
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(fine, F.lit(False)))
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "kept",
        )
    )


ORACLE_SQL = r"""
with texts as (
  select row_number() over () as row_no, doc_id, lang, source, coalesce(text, '') as t from documents
),
split as (
  select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
         [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as ls
  from texts
),
windows as (
  select row_no, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as w
  from split, unnest(range(1, len(ws) - 1)) as r(i)
),
twice as (
  select row_no, i from windows qualify count(*) over (partition by row_no, w) >= 2
),
covered as (
  select row_no, count(distinct i + k) as n from twice, unnest([0, 1, 2]) as o(k) group by row_no
),
measured as (
  select doc_id, lang, source, cast(len(ws) as bigint) as n_words,
         cast(length(array_to_string(ws, '')) as bigint) as word_chars,
         cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols,
         cast(len(ls) as bigint) as n_lines,
         cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
         cast(coalesce(n, 0) as bigint) as n_repeat_words
  from split left join covered using (row_no)
),
rules as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         [10000 * n_symbols // greatest(word_chars, 1), 1000 * n_dup_lines // greatest(n_lines, 1),
          1000 * n_repeat_words // greatest(n_words, 1), 100 * word_chars // greatest(n_words, 1)] as m
  from measured
),
vals as (
  select lang, source, k, m[k] as v, greatest(length(bin(m[k])) - 6, 0) as s
  from rules, unnest([1, 2, 3, 4]) as u(k) where not base_failed
),
starts as (select lang, source, k, cast((v >> s) << s as bigint) as b from vals),
ranked as (
  select 0 as level, lang, source, k, b, row_number() over w as r, count(*) over (partition by lang, source, k) as n
  from starts window w as (partition by lang, source, k order by b)
  union all
  select 1, lang, null, k, b, row_number() over (partition by lang, k order by b), count(*) over (partition by lang, k)
  from starts
  union all
  select 2, null, null, k, b, row_number() over (partition by k order by b), count(*) over (partition by k) from starts
),
quart as (
  select level, lang, source, k, max(n) as n, min(b) filter (r * 4 >= n) as low,
         min(b) filter (r * 4 >= n * 3) as high
  from ranked group by all
),
chosen as (
  select a.lang, a.source, a.k,
         case when a.n >= 100 then a.low when b.n >= 100 then b.low else c.low end as low,
         case when a.n >= 100 then a.high when b.n >= 100 then b.high else c.high end as high
  from quart a join quart b on b.level = 1 and a.lang is not distinct from b.lang and a.k = b.k
  join quart c on c.level = 2 and a.k = c.k where a.level = 0
),
bounds as (
  select lang, source, list(low - 3 * greatest(high - low, [100, 100, 100, 50][k]) order by k) as lo,
         list(high + 3 * greatest(high - low, [100, 100, 100, 50][k]) order by k) as hi
  from chosen group by all
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(not base_failed and m[1] <= hi[1] and m[2] <= hi[2] and m[3] <= hi[3]
                and m[4] <= hi[4] and m[4] >= lo[4], false) as kept
from rules r left join bounds b
  on r.lang is not distinct from b.lang and r.source is not distinct from b.source
"""

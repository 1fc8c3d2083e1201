"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions.

A source's target divided by its size gives each of its documents the same expected
number of copies. The whole part is taken as it is; the fraction is rounded so that the
words taken stay the same: two documents with fractional copies meet, and words are moved
from one to the other, in either direction with the odds that keep both expectations,
until one of them has no fraction left. The other one meets the next document.

This runs as a reduction tree. Documents are dealt by a hash into small groups of one
source; each group is folded by itself and leaves at most one document with a fraction;
these residuals are dealt and folded again, until a source has a single one, which is
rounded by a coin of its own. So a source's words miss its target by less than one
document, no group grows with the data, and a source with a third of all rows is folded
by as many tasks as any other third. Coins are hashes of ids, so reruns agree.

Targets: sources in order of code points, null last, weigh 1, 2, 3, repeating. They share
the words of all documents; a target stops at ``MAX_COPIES`` times its source's words, and
what it leaves is shared by weight among the others, until none is above.

Defined results: a null or empty text has size 0 and takes 0; a source without words has
target 0; a null source is a source of its own; rows equal in id, source and size are told
apart by a running number, so each counts; null ids are an id like any other; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orefold.llm.common import stored
from orefold.operators.cells import unused
from orefold.operators.joins import size_checked

MAX_COPIES = 3
GROUP = 64
WORD = r"[^\x20\x09-\x0D]+"
SEED = 20

#: A fraction this near to 0 or 1 counts as reached: sums of doubles are not exact.
_EPS = 1e-9


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size``: the number of words, 0 for a null text."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long"), "source", size.alias("size"))


def targets(sized: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, source_size, target``, one row per source.

    With sources in order of ``cap / weight`` the stopped ones come first. The words left
    from a source on, shared by weight, grow from row to row as long as sources are
    stopped and fall afterwards, so their maximum is the level that the others get. The
    windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ratio = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    return (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double"))
        .withColumn("cap", F.col("source_size").cast("double") * max_copies)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("left_over", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("share", F.col("left_over") / F.sum("weight").over(onward))
        .withColumn("level", F.max("share").over(everything))
        .select(
            "source", "source_size", F.least("cap", F.col("weight") * F.col("level")).alias("target")
        )
    )


def _coin(unit: Column, level: int) -> Column:
    """A number in [0, 1) that depends on the unit's id only."""
    h = F.xxhash64(F.lit(SEED + level), unit["doc_id"], unit["dup"])
    return F.shiftrightunsigned(h, 11).cast("double") / float(1 << 53)


def _unit(u: Column, part: Column) -> Column:
    return F.struct(
        u["doc_id"].alias("doc_id"), u["dup"].alias("dup"), u["size"].alias("size"),
        u["whole"].alias("whole"), part.alias("part"),
    )


def _meet(acc: Column, unit: Column, level: int) -> Column:
    """One step of the fold: the unit that is carried meets the next one."""
    a, b = acc["carry"], unit
    x, y = a["part"], b["part"]
    to_a = F.least(a["size"] * (1 - x), b["size"] * y)  # words that b can give to a
    to_b = F.least(a["size"] * x, b["size"] * (1 - y))
    up = _coin(b, level) * (to_a + to_b) < to_b
    new_x = F.when(up, x + to_a / a["size"]).otherwise(x - to_b / a["size"])
    new_y = F.when(up, y - to_a / b["size"]).otherwise(y + to_b / b["size"])
    integral = lambda p: (p < _EPS) | (p > 1 - _EPS)
    both = F.struct(_unit(a, new_x).alias("a"), _unit(b, new_y).alias("b"))
    met = F.transform(
        F.array(both),
        lambda m: F.when(
            integral(m["a"]["part"]),
            F.struct(m["b"].alias("carry"), F.array_append(acc["done"], m["a"]).alias("done")),
        ).otherwise(F.struct(m["a"].alias("carry"), F.array_append(acc["done"], m["b"]).alias("done"))),
    )[0]
    return F.when(
        a.isNull(), F.struct(b.alias("carry"), acc["done"].alias("done"))
    ).otherwise(met)


def _folded(units: DataFrame, level: int) -> DataFrame:
    """Deal into groups and fold each: ``source, unit, open``, at most one open per group."""
    n = units.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    dealt = units.join(
        n.select(F.col("source").alias("of"), F.ceil(F.col("n") / GROUP).cast("long").alias("groups")),
        F.col("source").eqNullSafe(F.col("of")),
    ).withColumn("group", F.pmod(F.xxhash64(F.lit(-level), "doc_id", "dup"), F.col("groups")))
    mixed = F.struct(F.xxhash64("doc_id", "dup").alias("by"), "doc_id", "dup", "size", "whole", "part")
    unit_type = "struct<doc_id:bigint,dup:int,size:bigint,whole:bigint,part:double>"
    start = F.struct(
        F.lit(None).cast(unit_type).alias("carry"),
        F.array().cast(f"array<{unit_type}>").alias("done"),
    )
    groups = dealt.groupBy("source", "group").agg(F.array_sort(F.collect_list(mixed)).alias("units"))
    folded = groups.select(
        "source",
        F.aggregate("units", start, lambda acc, u: _meet(acc, _unit(u, u["part"]), level)).alias("f"),
    )
    return folded.select(
        "source",
        F.explode(
            F.concat(
                F.transform("f.done", lambda u: F.struct(u.alias("unit"), F.lit(False).alias("open"))),
                F.array(F.struct(F.col("f.carry").alias("unit"), F.lit(True).alias("open"))),
            )
        ).alias("e"),
    ).select("source", "e.unit", "e.open")


def mixed_copies(docs: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """``doc_id, dup, source, size, source_size, target, copies`` for each document; ``dup``
    numbers rows that are equal in id, source and size."""
    sized = stored(sizes(docs), "mix-sizes")
    goal = stored(targets(sized, max_copies), "mix-targets")
    counted = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("times"))
    numbered = counted.withColumn("dup", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = (
        numbered.join(
            goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
        )
        .withColumn("expected", F.when(F.col("size") > 0, F.least(expected, F.lit(float(max_copies)))).otherwise(F.lit(0.0)))
        .withColumn("whole", F.floor(F.col("expected") + _EPS).cast("long"))
        .withColumn("part", F.greatest(F.col("expected") - F.col("whole"), F.lit(0.0)))
        .select("doc_id", "dup", "source", "size", "whole", "part")
    )
    units = stored(units, "mix-units")
    settled = [units.where(F.col("part") <= _EPS).select("doc_id", "dup", "source", "size", F.col("whole").alias("copies"))]
    open_units, level = units.where(F.col("part") > _EPS), 0
    while True:
        level += 1
        folded = stored(_folded(open_units, level), "mix-level")
        unit = F.col("unit")
        is_open = F.col("open") & (unit["part"] > _EPS) & (unit["part"] < 1 - _EPS)
        rest = folded.where(is_open)
        last = rest.groupBy("source").count().where("count > 1").isEmpty()
        chosen = unit["whole"] + F.when(unit["part"] >= 1 - _EPS, 1).otherwise(0)
        drawn = unit["whole"] + F.when(_coin(unit, 0) < unit["part"], 1).otherwise(0)
        settled.append(_settle(folded.where(~is_open), chosen))
        if last:
            settled.append(_settle(rest, drawn))
            break
        open_units = rest.select("unit.doc_id", "unit.dup", "source", "unit.size", "unit.whole", "unit.part")
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out.join(
        goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    ).drop("of")


def _settle(folded: DataFrame, copies: Column) -> DataFrame:
    return folded.select(
        F.col("unit.doc_id").alias("doc_id"), F.col("unit.dup").alias("dup"), "source",
        F.col("unit.size").alias("size"), copies.cast("long").alias("copies"),
    )


def digest(mixed: DataFrame) -> DataFrame:
    return mixed.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies",
    )


def mixed_documents(docs: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """The documents of the mix, each as often as it is taken, all columns kept. Rows equal
    in id, source and size are numbered in order of their texts' hashes."""
    names = {c: unused(docs, c) for c in ("of", "nth", "copies", "key", "again", "number", "copy")}
    of, nth, copies, key, again, number, copy = (F.col(c) for c in names.values())
    taken = stored(
        mixed_copies(docs, max_copies).where("copies > 0 or dup = 2").select(
            F.struct("doc_id", "source", "size").alias(names["of"]), F.col("dup").alias(names["nth"]),
            F.col("copies").cast("int").alias(names["copies"]),
        ),
        "mix-taken",
    )
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    keyed = docs.withColumn(
        names["key"],
        F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("source"), size.alias("size")),
    )
    repeated = taken.where(nth == 2).select(of.alias(names["again"]))
    if repeated.isEmpty():
        keyed = keyed.withColumn(names["number"], F.lit(1))
    else:
        same = Window.partitionBy(names["key"]).orderBy(F.xxhash64("text"))
        alone = keyed.join(repeated, key.eqNullSafe(again), "left_anti").withColumn(names["number"], F.lit(1))
        keyed = alone.unionByName(
            keyed.join(repeated, key.eqNullSafe(again), "left_semi").withColumn(
                names["number"], F.row_number().over(same)
            )
        )
    return (
        # texts stay where they are while what is taken is small
        keyed.join(size_checked(taken.where(copies > 0)), key.eqNullSafe(of) & (number == nth))
        .withColumn(names["copy"], F.explode(F.sequence(F.lit(1), copies)))
        .select(*docs.columns)
    )

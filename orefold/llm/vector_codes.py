"""Vector codes: product quantization over tries of distinct parts.

Components become integers, ``floor(scale * x)``, and vectors are cut into equal parts. The
distinct parts of each position, with the number of vectors that hold them, are dealt out by
ranges and sorted, so that every task holds a piece of a lexicographic trie. A round of the
codebook walks these tries depth first: a node adds the squared differences of its component
to the distance vector (one number for each codebook entry) of its parent, which all parts
below it share, and a leaf takes the nearest entry and adds its weighted components to that
entry's sums. A step of the walk takes several leaves at once; the stack holds the last node
of every depth, from which the next step goes on. Only the sums of each entry reach the
driver, whose codebooks are of a fixed size. The last assignment walks the tries of the
vectors of a batch and needs no shuffle.

A part that a third of all vectors hold is one row of each batch before the shuffle, and one
leaf afterwards. Vectors are stored once as integers, parts once with their weights.

Defined results: a vector that is null, or holds a null or a component that is not finite, is
dropped; so is one whose length is not a positive multiple of the parts, or other than the
length of the vector of the smallest id. A null id counts as the largest id. Of repeated ids
each row is coded; the least vector stands for the id in the first codebook. With fewer ids
than entries the codebook has as many entries. Null labels are summed together. Components
beyond +-2^18 raise an error, as their distances could leave 64 bits. Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.llm.common import stored
from orefold.operators.joins import size_checked

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Components of larger magnitude could overflow a 64-bit distance.
LIMIT = 1 << 28
#: Leaves of one step of a walk.
STEP = 256


class Trie:
    """A depth-first walk over parts in lexicographic order, for one codebook."""

    def __init__(self, book: np.ndarray, most: int) -> None:
        """``most`` bounds the magnitude of all components, of parts and of the book."""
        self.width = book.shape[1]
        kind = np.int32 if self.width * (2 * most) ** 2 < 1 << 31 else np.int64
        self.columns = np.ascontiguousarray(book.T.astype(kind))
        self.stack = np.zeros((self.width, len(book)), kind)
        self.last: np.ndarray | None = None

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each row; rows follow those of earlier calls in
        order. Equal distances go to the lower index."""
        found = [self._step(parts[i : i + STEP]) for i in range(0, len(parts), STEP)]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _step(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = rows.astype(self.columns.dtype)
        differs = np.ones(rows.shape, bool)
        differs[1:] = rows[1:] != rows[:-1]
        if self.last is not None:
            differs[0] = rows[0] != self.last
        # a row begins a node at a depth if its prefix up to there is new
        fresh = np.logical_or.accumulate(differs, axis=1)
        above, parent = np.zeros((1, self.columns.shape[1]), rows.dtype), np.zeros(len(rows), np.int64)
        for depth in range(self.width):
            new = fresh[:, depth]
            at = np.flatnonzero(new)
            step = self.columns[depth] - rows[at, depth, None]
            step *= step
            if len(at) == len(rows) == len(above):
                above += step
            else:
                step += above[parent[at]]
                above = step if new[0] else np.concatenate([self.stack[depth][None], step])
                parent = np.cumsum(new) - int(new[0])
            self.stack[depth] = above[-1]
        self.last = rows[-1]
        code = above.argmin(axis=1)
        return code[parent], above[np.arange(len(above)), code][parent].astype(np.int64)


class Codebooks:
    """``entries``: integers (part, entry, position); ``scale`` turns components into them."""

    def __init__(self, entries: np.ndarray, scale: int) -> None:
        self.entries, self.scale = entries, scale

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def kept_vectors(
    vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str = "label",
    scale: int = SCALE, parts: int = PARTS,
) -> DataFrame:
    """``id, v, label``: vectors as integers, without those that are dropped; stored."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    whole = F.transform(x, lambda e: _component(e, scale))
    rows = stored(
        vectors.where(finite & (F.size(x) > 0) & (F.size(x) % parts == 0))
        .select(F.col(id_).cast("long").alias("id"), whole.alias("v"), F.col(label).alias("label")),
        "vectors",
    )
    first = rows.orderBy(F.asc_nulls_last("id"), "v").first()
    return rows if first is None else rows.where(F.size("v") == len(first["v"]))


def _component(e: Column, scale: int) -> Column:
    whole = F.floor(e * scale)
    fits = F.abs(e * scale) < LIMIT
    return F.when(fits, whole.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("component out of range: "), e.cast("string"))).cast("int")
    )


def first_entries(kept: DataFrame, parts: int, entries: int) -> np.ndarray:
    """(part, entry, position) of the vectors of the smallest ids."""
    ids = [
        r[0] for r in
        kept.select("id").distinct().orderBy(F.asc_nulls_last("id")).limit(entries).collect()
    ]
    among = F.col("id") <= max((i for i in ids if i is not None), default=0)
    if None in ids:
        among = F.coalesce(among, F.lit(True))
    least = kept.where(among).groupBy("id").agg(F.min("v").alias("v"))
    v = np.array([r["v"] for r in least.orderBy(F.asc_nulls_last("id")).collect()], np.int64)
    width = v.shape[1] // parts if len(v) else 0
    return np.ascontiguousarray(v.reshape(len(v), parts, width).transpose(1, 0, 2))


# parts as bytes whose order is that of the components

def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _keys(values: np.ndarray) -> np.ndarray:
    high = (values.astype(np.int64) + (1 << 31)).astype(">u4")
    return np.ascontiguousarray(high).view(f"S{4 * values.shape[1]}").ravel()


def _values(keys: pa.Array, width: int) -> np.ndarray:
    flat = b"".join(keys.to_pylist())
    return np.frombuffer(flat, ">u4").astype(np.int64).reshape(-1, width) - (1 << 31)


def _pieces(v: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each part: its number, its distinct values in order with their bytes, the number
    of rows of each, and the value of each row."""
    for part, values in enumerate(np.split(v, parts, axis=1)):
        keys, first, of, n = np.unique(_keys(values), return_index=True, return_inverse=True, return_counts=True)
        yield part, keys, values[first], n, of.ravel()


def distinct_parts(kept: DataFrame, parts: int) -> DataFrame:
    """``part, key, weight`` in lexicographic order inside ranges; stored."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for part, _, values, n, _ in _pieces(_matrix(batch.column(0)), parts):
                width = 4 * values.shape[1]
                body = np.ascontiguousarray((values.astype(np.int64) + (1 << 31)).astype(">u4")).tobytes()
                ends = pa.py_buffer(np.arange(len(n) + 1, dtype=np.int32) * width)
                keys = pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, ends, pa.py_buffer(body)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), keys, pa.array(n.astype(np.int64))],
                    names=["part", "key", "weight"],
                )

    rows = kept.select("v").mapInArrow(work, "part int, key binary, weight long")
    # the sum keeps the ranges: one exchange
    ranged = rows.repartitionByRange("part", "key").groupBy("part", "key").agg(F.sum("weight").alias("weight"))
    return stored(ranged.sortWithinPartitions("part", "key"), "vector-parts")


def next_entries(parts: DataFrame, books: np.ndarray, most: int) -> np.ndarray:
    """One round: every part to its nearest entry, entries to the floor of their mean."""
    _, entries, width = books.shape
    sums = [f"s{i}" for i in range(width)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(books), entries, width + 1), np.int64)
        tries: dict[int, Trie] = {}
        for batch in batches:
            part = batch.column("part").to_numpy()
            weight = batch.column("weight").to_numpy()
            values = _values(batch.column("key"), width)
            for p in np.unique(part).tolist():
                here = part == p
                # a task may read several files, each in order: a walk may start anywhere
                walk = tries.setdefault(p, Trie(books[p], most))
                code, _ = walk.nearest(values[here])
                np.add.at(total[p, :, 1:], code, values[here] * weight[here, None])
                np.add.at(total[p, :, 0], code, weight[here])
        p, e = np.nonzero(total[:, :, 0])
        columns = [p.astype(np.int32), e.astype(np.int32), *total[p, e].T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)

    names = ["part", "entry", "n", *sums]
    schema = "part int, entry int, " + ", ".join(f"{c} long" for c in names[2:])
    made = books.copy()
    total = parts.mapInArrow(work, schema).groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in names[2:]])
    for r in total.collect():  # at most one row for each entry of the codebooks
        made[r["part"], r["entry"]] = [r[c] // r["n"] for c in sums]
    return made


def learned(
    kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Codebooks | None:
    """Codebooks of stored ``kept`` vectors (see ``kept_vectors``); None without vectors."""
    books = first_entries(kept, parts, entries)
    if not books.size:
        return None
    pieces = distinct_parts(kept, parts)
    most = _most(kept)
    for _ in range(rounds):
        books = next_entries(pieces, books, most)
    return Codebooks(books, scale)


def _most(kept: DataFrame) -> int:
    """The largest magnitude of a component; means lie within it."""
    high = F.greatest(F.array_max("v"), -F.array_min("v"))
    return max(1, kept.agg(F.max(high)).first()[0])


def coded(kept: DataFrame, books: Codebooks) -> DataFrame:
    """``id, label, code, error``: entries of all parts in hex, summed squared distances."""
    held, most = books.entries, max(int(np.abs(books.entries).max(initial=1)), _most(kept))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = np.zeros((batch.num_rows, len(held)), np.uint8)
            error = np.zeros(batch.num_rows, np.int64)
            for part, _, values, _, of in _pieces(_matrix(batch.column("v")), len(held)):
                code, distance = Trie(held[part], most).nearest(values)
                codes[:, part] = code[of]
                error += distance[of]
            text = codes.tobytes().hex()
            size = 2 * len(held)
            out = [text[i : i + size] for i in range(0, len(text), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(out), pa.array(error)],
                names=["id", "label", "code", "error"],
            )

    label = kept.schema["label"].dataType.simpleString()
    return kept.select("id", "label", "v").mapInArrow(work, f"id long, label {label}, code string, error long")


def restored(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``codes`` with the vector each code stands for, ``restored``: entries over the scale,
    half a step up, the middle of what the floor has taken together."""
    table = [
        (p, f"{e:02x}", [(x + 0.5) / books.scale for x in entry])
        for p, book in enumerate(books.entries.tolist()) for e, entry in enumerate(book)
    ]
    spark = codes.sparkSession
    out, vectors = codes, []
    for p in range(len(books.entries)):
        book = spark.createDataFrame(
            [r[1:] for r in table if r[0] == p], f"__e{p} string, __v{p} array<double>"
        )
        out = out.join(F.broadcast(book), F.substring("code", 2 * p + 1, 2) == F.col(f"__e{p}"))
        vectors.append(f"__v{p}")
    return out.withColumn("restored", F.concat(*vectors)).select(*codes.columns, "restored")


def digest(kept: DataFrame, books: Codebooks | None) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``."""
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    if books is None:
        return kept.sparkSession.createDataFrame([], schema)
    rows = stored(coded(kept, books), "vector-codes")
    sums = stored(
        rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors"
    )
    return rows.join(size_checked(sums), rows["label"].eqNullSafe(sums["of"])).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(books.sha256).alias("codebooks_sha256"),
    )


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in DuckDB SQL: all distances, taken from inner products (exact in doubles)."""
    steps = [f"""
kept as materialized (
  select row_number() over () as r, vec_id, label,
         list_transform(embedding, lambda x: floor({scale} * x::double)) as v
  from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
pieces as materialized (
  select r, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] as v
  from kept, range({parts}) as t(p)
),
firsts as (
  select r, row_number() over (order by vec_id) - 1 as e from kept
  order by vec_id limit {entries}
),
book0 as materialized (select p, e, v from pieces join firsts using (r))"""]
    near = """
near{i} as materialized (
  select a.r, a.p, min((list_inner_product(a.v, a.v) - 2 * list_inner_product(a.v, b.v)
         + list_inner_product(b.v, b.v))::bigint * 256 + b.e) as best
  from pieces a join book{i} b using (p) group by a.r, a.p
)"""
    for i in range(rounds):
        steps.append(near.format(i=i))
        steps.append(f"""
mean{i} as (
  select p, e, list(m order by pos) as v from (
    select n.p, n.best % 256 as e, pos, floor(sum(a.v[pos]) / count(*)) as m
    from near{i} n join pieces a using (r, p), range(1, len(a.v) + 1) as t(pos)
    group by n.p, n.best % 256, pos
  ) group by p, e
),
book{i + 1} as materialized (
  select b.p, b.e, coalesce(m.v, b.v) as v from book{i} b left join mean{i} m using (p, e)
)""")
    steps.append(near.format(i=rounds))
    return f"""
with {",".join(steps)},
codes as (
  select r, string_agg(printf('%02x', best % 256), '' order by p) as code,
         sum(best // 256)::bigint as error
  from near{rounds} group by r
)
select vec_id, code, error,
       (sum(error) over (partition by label))::bigint as label_error,
       (select sha256(string_agg(x::bigint::varchar, ',' order by p, e, pos))
        from (select p, e, generate_subscripts(v, 1) as pos, unnest(v) as x from book{rounds})
       ) as codebooks_sha256
from kept join codes using (r)"""

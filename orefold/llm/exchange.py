"""Chunks of rows ask for what is added up over all chunks, by arrays instead of rows.

A chunk sends its distinct keys, sorted, with its own values of each, as one array to each of a
number of buckets; buckets are ranges of the key. A bucket adds up what all chunks have sent and
returns an answer for every key in the order in which the chunk sent it, so that answers put
together by bucket fit the chunk's sorted keys. Keys are evenly spread 64-bit numbers, and a
chunk sends each once, so that a key that all chunks hold costs its bucket one entry a chunk.

Everything is a row of ``ROWS``: ``to`` is the chunk or bucket, ``kind`` names what ``body``
holds (``ask-`` and ``answer-`` what is asked), ``part`` is the chunk that asks or the bucket
that answers, ``n`` a count.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.llm.common import add_to, forget_all_but, give_back, new_folder, remove

ROWS = "to long, kind string, part long, n long, body binary"
ASK, ANSWER, TOTAL = "ask-", "answer-", "total"
_NAMES = [c.split()[0] for c in ROWS.split(", ")]
_TYPES = pa.schema(list(zip(_NAMES, [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()])))
_COMPRESS = pa.Codec("zstd", 1)

#: Tokens for each bucket, once there are so many; before that more buckets, for more tasks.
BUCKET_TOKENS = 6_000_000
FEW_BUCKETS, LEAST_TOKENS = 24, 100_000

#: Beyond so many, some share their upper bits.
FEW_KEYS = 1 << 21
#: Chunks and buckets can be done in so many turns, so that what is shuffled takes less disk at a time.
PARTS = 2

Row = tuple[int, str, int, int, bytes]


def buckets_for(tokens: int) -> int:
    return max(1, min(FEW_BUCKETS, tokens // LEAST_TOKENS), tokens // BUCKET_TOKENS)


def packed(*arrays: np.ndarray) -> bytes:
    """Compressed, all first bytes of an array's numbers before all second ones, as many as the
    largest needs; before them each type in three letters, that number of bytes and each length."""
    heads, planes = [bytes([len(arrays)])], []
    for a in arrays:
        width = a.itemsize
        if a.dtype.kind in "iu" and len(a) and a.min() >= 0:
            width = (int(a.max()).bit_length() + 7) // 8
        heads.append(a.dtype.str.encode() + bytes([width]) + len(a).to_bytes(8, "little"))
        data = np.ascontiguousarray(a).view(np.uint8)
        planes += [data[i :: a.itemsize].tobytes() for i in range(width)]
    body = b"".join(heads + planes)
    return len(body).to_bytes(8, "little") + _COMPRESS.compress(body, asbytes=True)


def unpacked(body: bytes | pa.Buffer) -> list[np.ndarray]:
    body = memoryview(body)
    body = _COMPRESS.decompress(body[8:], int.from_bytes(body[:8], "little"), asbytes=True)
    heads = [body[i : i + 12] for i in range(1, 1 + 12 * body[0], 12)]
    at, out = 1 + 12 * body[0], []
    for head in heads:
        kind, width, n = np.dtype(head[:3].decode()), head[3], int.from_bytes(head[4:], "little")
        planes = np.frombuffer(body, np.uint8, n * width, at).reshape(width, n)
        if width == kind.itemsize:
            out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        else:
            out.append(np.zeros(n, kind))
            for i in range(width):
                out[-1] |= planes[i].astype(kind) << kind.type(8 * i)
        at += n * width
    return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and which of them each is. Sorting numbers made of the upper bits
    of a key and its place is faster than sorting places, as long as lower bits hardly decide."""
    n = len(keys)
    if not n:
        return keys, np.zeros(0, np.int32)
    ordered = None
    if n < FEW_KEYS:
        bits = np.uint64(max((n - 1).bit_length(), 1))
        order = keys >> bits << bits
        order |= np.arange(n, dtype=np.uint64)
        order.sort()
        order &= (np.uint64(1) << bits) - np.uint64(1)
        order = order.view(np.int64)
        ordered = keys[order]
    if ordered is None or (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    heads = np.ones(n, bool)
    np.not_equal(ordered[1:], ordered[:-1], out=heads[1:])
    of = np.empty(n, np.int32 if n < 1 << 31 else np.int64)
    of[order] = np.cumsum(heads, dtype=of.dtype) - of.dtype.type(1)
    return ordered[heads], of


def table_of(rows: Iterable[Row]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(_NAMES)
    return pa.table([pa.array(c, t) for c, t in zip(columns, _TYPES.types)], schema=_TYPES)


def asking(chunk: int, buckets: int, what: str, keys: np.ndarray, *values: np.ndarray) -> list[Row]:
    """A row for each bucket that the sorted distinct keys reach."""
    of = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    at = np.searchsorted(of, np.arange(buckets + 1, dtype=np.uint64))
    steps = np.diff(keys, prepend=np.uint64(0))  # sorted keys lie close
    out = []
    for b in np.flatnonzero(np.diff(at)):
        lo, hi = at[b], at[b + 1]
        first = steps[lo:hi].copy()
        first[0] = keys[lo]
        out.append((int(b), ASK + what, chunk, int(hi - lo), packed(first, *[v[lo:hi] for v in values])))
    return out


Answer = Callable[..., tuple[tuple[np.ndarray, ...], tuple[int, ...] | None]]


def answers(asks: DataFrame, by: dict[str, Answer]) -> DataFrame:
    """The function of what is asked gets the keys of a bucket and their values, chunk after
    chunk, and returns arrays of the same length, and numbers of the bucket as a whole, if any."""

    def work(group: pa.Table) -> pa.Table:
        forget_all_but(None)
        bucket, what = group.column("to")[0].as_py(), group.column("kind")[0].as_py().removeprefix(ASK)
        group = group.sort_by("part")  # sums do not depend on the order of arrival
        sent = [unpacked(b.as_buffer()) for b in group.column("body")]
        ends = np.cumsum([0, *[len(s[0]) for s in sent]])
        keys = np.concatenate([np.cumsum(s[0], dtype=np.uint64) for s in sent])
        values = [np.concatenate([s[i] for s in sent]) for i in range(1, len(sent[0]))]
        del sent
        made, total = by[what](keys, *values)
        rows = [
            (chunk, ANSWER + what, bucket, int(hi - lo), packed(*[m[lo:hi] for m in made]))
            for chunk, lo, hi in zip(group.column("part").to_pylist(), ends[:-1], ends[1:])
        ]
        if total is not None:
            rows.append((-1, TOTAL, bucket, 0, packed(np.array(total, np.int64))))
        del made, keys, values
        give_back()
        return table_of(rows)

    return asks.groupBy("to", "kind").applyInArrow(work, ROWS)


class Held:
    """What a chunk holds: bodies by kind, and the answers to its last keys."""

    def __init__(self, rows: pa.Table | pa.RecordBatch) -> None:
        self.chunk: int = rows.column("to")[0].as_py()
        self.bodies: dict[str, pa.Buffer | bytes] = {}
        self._answers: dict[str, dict[int, list[np.ndarray]]] = defaultdict(dict)
        for kind, part, body in zip(rows.column("kind").to_pylist(), rows.column("part").to_pylist(), rows.column("body")):
            if kind.startswith(ANSWER):
                self._answers[kind.removeprefix(ANSWER)][part] = unpacked(body.as_buffer())
            else:
                self.bodies[kind] = body.as_buffer()

    def __getitem__(self, kind: str) -> list[np.ndarray]:
        return unpacked(self.bodies[kind])

    def answer(self, what: str, *types: np.dtype | type) -> list[np.ndarray]:
        """One array for each type, in the order of the keys."""
        found = self._answers[what]
        return [np.concatenate([np.zeros(0, t), *[found[p][i] for p in sorted(found)]]) for i, t in enumerate(types)]


class Stage:
    """Rows written to a folder of their own, by kind, so that what has been answered can go;
    tables are written one after another, each without what was shuffled for those before."""

    def __init__(self, name: str, *tables: DataFrame) -> None:
        self.spark = tables[0].sparkSession
        self.folder = new_folder(self.spark, name)
        for rows in tables:
            add_to(self.folder, rows, "kind")
        self.rows = self.spark.read.schema(ROWS).parquet(self.folder).select(*_NAMES)

    def of(self, *kinds: str) -> DataFrame:
        return self.rows.where(F.col("kind").isin(*kinds))

    def asks(self) -> DataFrame:
        return self.rows.where(F.col("kind").startswith(ASK))

    def rest(self) -> DataFrame:
        return self.rows.where(~F.col("kind").startswith(ASK))

    def remove(self, prefix: str = "") -> None:
        """Delete the kinds that begin so, once nothing will read them again."""
        remove(self.spark, self.folder, f"kind={prefix}")


def parts(rows: DataFrame) -> list[DataFrame]:
    """The rows of some chunks or buckets, and those of the others."""
    return [rows.where(F.pmod(F.xxhash64("to"), F.lit(PARTS)) == i) for i in range(PARTS)]


def each(rows: DataFrame, work: Callable[[Held], pa.Table]) -> DataFrame:
    """``work`` done for each row alone, without a shuffle."""

    def rows_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_all_but(None)
        for batch in batches:
            for i in range(batch.num_rows):
                yield from work(Held(batch.slice(i, 1))).to_batches()
                give_back()

    return rows.mapInArrow(rows_, ROWS)


def received(rows: DataFrame, work: Callable[[Held], pa.Table], schema: str = ROWS) -> DataFrame:
    """``work`` done for each chunk with all its rows."""

    def chunk(group: pa.Table) -> pa.Table:
        forget_all_but(None)
        out = work(Held(group))
        give_back()
        return out

    return rows.groupBy("to").applyInArrow(chunk, schema)

"""What the operators share: documents, words of Arrow text columns as arrays, stored tables."""

from __future__ import annotations

import ctypes
import functools
import os
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orefold.session import shared_folder

#: Bytes that Spark hands to a worker at a time, or a single row.
BATCH_BYTES = 8 * 1024 * 1024
#: Rows that a Parquet reader holds at a time, whole texts in one array.
READER_ROWS = 1024
#: Bytes of text that are turned into arrays at a time; one longer text is a slice of its own.
SLICE_BYTES = 2 * 1024 * 1024

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_POWER_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWER_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Powers are made in steps of so many.
_POWERS_MORE = 128 * 1024
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
_LETTERS = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def on_workers(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has it.
    On a cluster it is installed, or passed with ``--py-files``, as any other package. Workers
    take memory from the system's own allocator, and so can give it back."""
    sc = spark.sparkContext
    sc.environment["ARROW_DEFAULT_MEMORY_POOL"] = "system"
    sc.environment["MALLOC_ARENA_MAX"] = "2"
    if sc.master.startswith("local"):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        paths = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            sc.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def with_workers(query: Callable[..., DataFrame], batch_bytes: int = BATCH_BYTES) -> Callable[..., DataFrame]:
    """A query or stage whose first argument is the session, see ``on_workers``; workers get
    batches of bounded size, and so do readers."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        on_workers(spark)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READER_ROWS))
        return query(spark, *args)

    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the one that all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors. What was
    shuffled for it is removed once it is written."""
    path = new_folder(df.sparkSession, name)
    add_to(path, df)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def add_to(path: str, df: DataFrame, *by: str) -> None:
    """Write more rows of a table, into one folder for each value of ``by``."""
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("append").partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def remove(spark: SparkSession, folder: str, prefix: str) -> None:
    """Delete what begins so in a folder that a query has made for itself."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        if status.getPath().getName().startswith(prefix):
            files.delete(status.getPath(), True)


def first_by_hash(rows: DataFrame, by: str, key: str, most: dict) -> DataFrame:
    """At most ``most[value]`` rows for each value of ``by``, those first by a hash of
    ``key``; values without an entry give none.

    A cut by hash leaves about twice the wanted rows of each value, wherever they lie; only
    these are ranked.
    """
    sizes = {r[0]: r[1] for r in rows.where(F.col(by).isin(list(most))).groupBy(by).count().collect()}
    place = F.pmod(F.xxhash64(key), F.lit(1 << 30))
    near, wanted = F.lit(False), F.lit(0)
    for value, n in sorted(sizes.items()):
        near |= (F.col(by) == value) & (place <= int((1 << 30) * min(1.0, 2 * most[value] / n)))
        wanted = F.when(F.col(by) == value, most[value]).otherwise(wanted)
    ranked = Window.partitionBy(by).orderBy(place, key)
    return (
        rows.where(near).withColumn("nth", F.row_number().over(ranked))
        .where(F.col("nth") <= wanted).drop("nth")
    )


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(column).cast("long")), F.lit(0))).first()[0]


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


# texts as arrays

def binary(column: pa.Array) -> pa.Array:
    """A text column as bytes with 64-bit offsets, null as empty."""
    column = column.cast(pa.large_binary())
    return pc.fill_null(column, b"") if column.null_count else column


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a ``large_binary`` array; offsets start at 0."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Pieces of the batches that hold at most ``most`` bytes of text, or a single row."""
    for batch in batches:
        texts = binary(batch.column(column))
        _, at = raw(texts)
        start = 0
        while start < len(texts):
            end = int(np.searchsorted(at, at[start] + most, side="right")) - 1
            end = min(max(end, start + 1), len(texts))
            yield batch.slice(start, end - start), texts.slice(start, end - start)
            start = end


class Words:
    """Where the words of concatenated texts are.

    ``inside`` says for each byte value if it belongs to a word; words never cross texts.
    ``starts`` and ``ends`` are byte positions, ``doc`` the text of each word, ``first``
    the number of words before each text.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> None:
        self.data, self.at = data, at
        word = inside[data]
        head, tail = word.copy(), word.copy()
        if len(data):
            head[1:] &= ~word[:-1]
            tail[:-1] &= ~word[1:]
            begins = at[:-1][at[:-1] < at[1:]]
            head[begins] = word[begins]
            tail[begins[1:] - 1] = word[begins[1:] - 1]
        self.starts, self.ends = np.flatnonzero(head), np.flatnonzero(tail) + 1
        self.first = np.searchsorted(self.starts, at)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(at) - 1), self.counts)

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word's bytes (of ``data`` if given, e.g. in lower case)."""
        return hashed(self.data if data is None else data, self.starts, self.ends)


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes in each stretch of ``data``; none is empty."""
    if not len(data):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data))
    sums = _LETTERS[data]
    sums *= up[: len(data)]
    np.cumsum(sums, out=sums)
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    return mixed((sums[ends - 1] - before) * down[starts])


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least the first ``n``; no more are kept than the slices so far needed, rounded up."""
    if len(_powers["up"]) < n:
        room = -(-n // _POWERS_MORE) * _POWERS_MORE
        for key, base in (("up", _POWER_BASE), ("down", _POWER_INVERSE)):
            steps = np.full(room, base, np.uint64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps, out=steps)
    return _powers["up"], _powers["down"]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``start .. start + length`` of every run, back to back."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit numbers; other seeds give other functions."""
    h = h ^ np.uint64((seed * 0xD6E8FEB86659FD93 + 0x632BE59BD9B4E019) % (1 << 64))
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words `[^\\x20\\x09-\\x0D]+` of a ``large_binary`` array, and the text of each;
    with ``lower``, A-Z in lower case."""
    data, at = raw(texts)
    words = Words(data, at, ~SPACE)
    # bytes of the words alone, back to back
    body = data[~SPACE[data]]
    body = LOWER[body] if lower else body
    ends = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int64)
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(words.starts), [None, pa.py_buffer(ends), pa.py_buffer(body)]
    )
    return flat, words.doc


_remembered: dict = {}


def remembered(key, make: Callable):
    """What a worker keeps between tasks; one thing at a time, so that the operators of a
    pipeline do not add up in it."""
    if key not in _remembered:
        _remembered.clear()
        _remembered[key] = make()
    return _remembered[key]


def forget_all_but(key) -> None:
    """Drop what another operator of a pipeline has left in this worker."""
    if _remembered and key not in _remembered:
        _remembered.clear()
        give_back()


def at_rest() -> None:
    """At the end of a task: idle workers hold no arrays."""
    _powers.update(up=np.ones(1, np.uint64), down=np.ones(1, np.uint64))
    give_back()


def give_back() -> None:
    """Return freed memory to the system: workers live on, and the next operator's needs
    would come on top of what this one has left behind."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def over_slices(
    work: Callable[[pa.RecordBatch, pa.Array], pa.RecordBatch | None], most: int = SLICE_BYTES, keep=None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that handles bounded pieces one after another; ``keep``
    is the key of what the work itself remembers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_all_but(keep)
        for batch, texts in slices(batches, most=most):
            out = work(batch, texts)
            if out is not None and out.num_rows:
                yield out
            del out, batch, texts
            give_back()
        at_rest()

    return run

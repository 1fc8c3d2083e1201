"""SimHash near-dedup with bit-sliced comparison.

A fingerprint has bit i set if over half of a text's shingle hashes (XXH64) have it. Two
fingerprints link if they differ in at most ``radius`` bits.

Distinct fingerprints are cut into ``radius + 2`` blocks of bits. Two that differ in at
most ``radius`` bits agree on two blocks at least, so they meet under one of the pairs of
blocks, whatever their distance within the radius: the search is exact. A key (pair of
blocks, their bits) with very many fingerprints is cut into tiles, and each pair of tiles
is a group of its own, so no group grows with the data.

In a group, bit planes are stored vertically: one packed row per fingerprint bit, one
column per fingerprint. Comparing is the exclusive or of planes; its bits are added up by
carry-save counters, many distances at once, and a block of columns is abandoned as soon
as all its distances exceed the radius. Small groups are compared slot by slot, all groups
at once; in large ones every member asks for its neighbours, and only links that join two
components are emitted, so links stay linear in the members.

Components of the links follow by alternating stars; equal fingerprints share a node.

Defined results: a null or empty text, or one without words, has fingerprint 0 and links
like any other; fewer words than a shingle form one shingle; repeated rows each give a
row; rows with a null id get a fingerprint and a component but name none; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orefold.llm.common import over_slices, stored
from orefold.llm.components import components
from orefold.operators.cells import unused
from orefold.operators.joins import size_checked

SHINGLE = 4
RADIUS = 4
SEED = 42
#: A key with more fingerprints than this is compared in tiles.
TILE = 16_384
#: Groups up to this size are compared slot by slot.
SMALL = 48
_ROWS = 1 << 15
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


# fingerprints

def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = text.lower().split()  # bytes: A-Z only, and white space is x20, x09 to x0D
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist())),
        np.uint64,
        len(words) - shingle + 1,
    )
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _ROWS):
        rows = hashes[i : i + _ROWS].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id, fp``; ``fp`` holds the 64 bits as a signed number."""

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        made = np.array([fingerprint(t, shingle, seed) for t in texts.to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(made.view(np.int64))], names=["doc_id", "fp"]
        )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        over_slices(work), "doc_id long, fp long"
    )


# bit-sliced comparison

def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(64, words): bit j of word w in plane b is bit b of fingerprint 64 w + j."""
    n = len(fps)
    padded = np.zeros(-(-n // 64) * 64, np.uint64)
    padded[:n] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def within(differing, shape: tuple, radius: int) -> np.ndarray:
    """Which of many distances are at most ``radius``, one bit each.

    ``differing(p)`` gives plane p of the exclusive or. Counters hold the running sums
    vertically; an overflow stays set. Planes are added two at a time.
    """
    counters = [np.zeros(shape, np.uint64) for _ in range(max(radius.bit_length(), 1))]
    over = np.zeros(shape, np.uint64)
    for p in range(0, 64, 2):
        x, y = differing(p), differing(p + 1)
        half = counters[0] ^ x
        carry = (counters[0] & x) | (half & y)
        counters[0] = half ^ y
        for c in range(1, len(counters)):
            counters[c], carry = counters[c] ^ carry, counters[c] & carry
        over |= carry
        if p % 8 == 6:
            far = over | _above(counters, radius)
            if (far == _ONES).all():
                break
    return ~far


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    above, equal = np.zeros_like(counters[0]), np.full_like(counters[0], _ONES)
    for c in range(len(counters) - 1, -1, -1):
        if radius >> c & 1:
            equal &= counters[c]
        else:
            above |= equal & counters[c]
            equal &= ~counters[c]
    return above


def columns(bits: np.ndarray) -> np.ndarray:
    """Positions of the set bits of packed words."""
    return np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))


def small_links(fps: np.ndarray, starts: np.ndarray, sizes: np.ndarray, radius: int) -> list:
    """Links inside many small groups: slot i of every group against slot j."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    out = []
    for first in range(0, len(starts), _ROWS):  # blocks of groups, abandoned one by one
        at, size = starts[first : first + _ROWS], sizes[first : first + _ROWS]
        slots = []
        for k in range(int(size[0])):
            held = fps[at[: np.searchsorted(-size, -k, side="left")] + k]
            slots.append((held, bit_planes(held)))
        for j in range(1, len(slots)):
            b, planes = slots[j]
            for i in range(j):
                a, other = slots[i][0], slots[i][1][:, : planes.shape[1]]
                hit = columns(within(lambda p: other[p] ^ planes[p], planes.shape[1:], radius))
                hit = hit[hit < len(b)]
                if len(hit):
                    out.append(np.stack([a[hit], b[hit]]))
    return out


def large_links(fps: np.ndarray, radius: int, queries: int = 128) -> np.ndarray:
    """Links that join one large group: each member asks for all members within the radius.

    A component is named by one of its members; a member only emits a link to each other
    component that it reaches, so there are fewer links than members.
    """
    planes, name, out = bit_planes(fps), np.arange(len(fps)), []
    for first in range(0, len(fps), queries):
        asked = fps[first : first + queries]
        bits = [
            np.where(asked >> np.uint64(p) & np.uint64(1), _ONES, np.uint64(0))[:, None]
            for p in range(64)
        ]
        near = within(lambda p: planes[p] ^ bits[p], (len(asked), planes.shape[1]), radius)
        for row in np.flatnonzero(np.bitwise_count(near).sum(axis=1) > 1).tolist():
            hit = columns(near[row])
            reached, own = name[hit[hit < len(fps)]], name[first + row]
            if (reached == own).all():
                continue
            others = np.unique(reached[reached != own])
            out.append(np.stack([np.full(len(others), asked[row]), fps[others]]))
            name[np.isin(name, others)] = own
    return np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.uint64)


def links_of_runs(key: np.ndarray, fps: np.ndarray, radius: int) -> np.ndarray:
    """Links inside the runs of equal keys of sorted rows, as a (2, n) array."""
    if not len(fps):
        return np.zeros((2, 0), np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
    sizes = np.diff(np.concatenate([starts, [len(fps)]]))
    small = (sizes > 1) & (sizes <= SMALL)
    out = small_links(fps, starts[small], sizes[small], radius) if small.any() else []
    for k in np.flatnonzero(sizes > SMALL):
        out.append(large_links(fps[starts[k] : starts[k] + sizes[k]], radius))
    return np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.uint64)


# the search

def block_keys(fp: Column, radius: int) -> list[Column]:
    """For each pair of blocks: its number and the bits of both blocks."""
    edges = [round(64 * k / (radius + 2)) for k in range(radius + 3)]
    blocks = [
        (F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1)), high - low)
        for low, high in zip(edges, edges[1:])
    ]
    pairs = [(i, j) for i in range(len(blocks)) for j in range(i)]
    return [
        F.struct(
            F.lit(k).alias("pair"),
            F.shiftleft(blocks[i][0], blocks[j][1]).bitwiseOR(blocks[j][0]).alias("bits"),
        )
        for k, (i, j) in enumerate(pairs)
    ]


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links ``a, b`` that join all distinct ``fp`` within the radius, transitively."""
    if not 0 <= radius <= 16:
        raise ValueError("radius must be from 0 to 16")
    keyed = fps.select("fp", F.explode(F.array(*block_keys(F.col("fp"), radius))).alias("k")).select(
        "fp", "k.pair", "k.bits"
    )
    crowded = stored(keyed.groupBy("pair", "bits").count().where(F.col("count") > tile), "crowded")
    if crowded.isEmpty():
        keyed = keyed.select("*", F.lit(0).alias("i"), F.lit(0).alias("j"))
    else:
        tiles = F.coalesce(F.ceil(F.col("count") / tile), F.lit(1)).cast("int")
        keyed = (
            keyed.join(size_checked(crowded), ["pair", "bits"], "left")
            .withColumn("own", F.pmod(F.xxhash64("fp"), tiles).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
            .select("fp", "pair", "bits", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        )
    names = ["pair", "bits", "i", "j"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, held = [], [], 0
        for batch in batches:
            keys.append(np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names], axis=1))
            fps.append(batch.column("fp").to_numpy().view(np.uint64))
            held += len(fps[-1])
            if held < 4 * _ROWS:
                continue
            key, fp = np.concatenate(keys), np.concatenate(fps)
            # the last run may go on in the next batch
            cut = len(key) - int(np.argmax((key[::-1] != key[-1]).any(axis=1)))
            if cut == len(key):
                keys, fps = [key], [fp]
                continue
            yield made(links_of_runs(key[:cut], fp[:cut], radius))
            keys, fps, held = [key[cut:]], [fp[cut:]], len(key) - cut
        if keys:
            yield made(links_of_runs(np.concatenate(keys), np.concatenate(fps), radius))

    def made(found: np.ndarray) -> pa.RecordBatch:
        found = np.ascontiguousarray(found).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])

    return (
        keyed.repartition(*names).sortWithinPartitions(*names).mapInArrow(work, "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED
) -> DataFrame:
    """``doc_id, fp, component_id``: the least id reachable over links, itself included."""
    made = stored(fingerprints(docs, shingle, seed), "fingerprints")
    nodes = stored(made.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-nodes")
    roots = components(stored(links(nodes.select("fp"), radius), "fingerprint-links"))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "fingerprint-roots")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return made.join(named.select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED
) -> DataFrame:
    """The documents whose id names their component, all columns kept; of rows with that
    same id one stays, the first in order of the text. Rows without an id all stay."""
    key, nth = unused(docs, "key"), unused(docs, "nth")
    found = stored(near_duplicates(docs, shingle, radius, seed).select("doc_id", "component_id"), "found")
    ids = docs["doc_id"].cast("long")
    chosen = found.where("doc_id = component_id").select(F.col("doc_id").alias(key)).distinct()
    held = docs.join(size_checked(chosen), ids == F.col(key), "left_semi")
    out = held.unionByName(docs.where(ids.isNull()))
    again = found.where("doc_id is not null").groupBy(F.col("doc_id").alias(key)).count().where("count > 1")
    again = stored(again.select(key), "repeated-ids")
    if again.isEmpty():
        return out
    again = size_checked(again)
    first = Window.partitionBy("doc_id").orderBy("text")
    one = (
        held.join(again, ids == F.col(key), "left_semi")
        .withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1).drop(nth)
    )
    return out.join(again, ids == F.col(key), "left_anti").unionByName(one)

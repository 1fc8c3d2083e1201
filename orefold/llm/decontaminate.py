"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Symbols are runs of letters, digits and marks, ASCII letters in lower case. In scripts that
are written without spaces (Chinese, Japanese, Thai, Lao, Khmer, Burmese and others) each
code point is a symbol. White space, punctuation and signs of any script separate symbols.
The CGK walk reads one symbol a step and moves on if a random bit of that symbol is set,
so two texts that differ by few edits fall into step again and their embeddings agree in
many places. A repetition has a walk of its own and samples a few places of the embedding
as its key. The walk of every window of a document starts at its first symbol; an item is
keyed at several of its own offsets, so a match also says where its window begins. For each
length of items, edits are simulated: it gets the longest walk with which repetitions reach
the target recall, and each walk as many repetitions as any of its lengths needs. Each
candidate window is then aligned exactly (edit distance over symbols, free ends).

The documents are only read, never shuffled; items are taken in blocks of bounded size.

Defined results: null or empty texts and items match nothing; repeated rows are judged
one by one; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.llm.common import LOWER, Words, binary, mixed, over_slices, raw

#: Share of an item's symbols that may be edited.
MAX_EDITS = 0.2
TARGET_RECALL = 0.99
#: Steps of the walk: an item uses the longest that it has symbols for and that finds it.
WALKS = (12, 6, 4, 2, 1)
SAMPLED = 5
UNLIKE = 3
ANCHOR_STRIDE = 1
BLOCK_ITEMS, BLOCK_BYTES = 4_000, 1024 * 1024
#: Bytes of documents that are searched at a time: each window has a walk for each repetition.
READ_BYTES = 512 * 1024
MAX_REPEATS = 32
#: Simulated edits for each length; longer items are tried by their first so many symbols,
#: as recall grows with length at the same share of edits.
TRIALS, TRIED_SYMBOLS = 300, 60
SEED = 1

SYMBOL = np.zeros(256, bool)
SYMBOL[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Bits of a key that look it up: at least 32 places for each key, at most so many bits.
_SPARE_BITS, _TABLE_BITS = 5, 20

SCHEMA = "doc_id long, item_id long, start_word int, end_word int, edits int, item_words int"


def symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Symbol hashes of all texts back to back, and the number before each text."""
    data, at = raw(texts)
    words = Symbols(data, at)
    return words.hashes(LOWER[data]), words.first


#: Scripts without spaces between words: first and last code points.
UNSPACED = (
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF),
    (0x1B00, 0x1B7F), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029), (0x3040, 0x312F),
    (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAADF),
    (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x16FE0, 0x18CFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF),
)
APART, INSIDE, ALONE = 0, 1, 2


@functools.cache
def _kinds() -> np.ndarray:
    """For each code point: separates symbols, is part of one, or is one."""
    out = np.full(0x110000, INSIDE, np.uint8)
    for low, high in UNSPACED:
        out[low : high + 1] = ALONE
    # above 0x1FFFF there are letters, private use and what is not assigned
    signs = [c for c in range(0x20000) if unicodedata.category(chr(c))[0] in "PZS"]
    out[[*signs, 0x200B, 0x2060, 0xFEFF]] = APART
    out[:128] = SYMBOL[:128]
    return out


class Symbols(Words):
    """Where the symbols of concatenated texts are."""

    def __init__(self, data: np.ndarray, at: np.ndarray) -> None:
        super().__init__(data, at, SYMBOL)
        if not len(data) or data.max() < 0x80:
            return
        kind = SYMBOL[data].astype(np.uint8)
        lead = np.flatnonzero(data >= 0xC0)
        after = np.concatenate([data, np.zeros(3, np.uint8)])
        low = [(after[lead + k] & 0x3F).astype(np.int64) for k in range(1, 4)]
        first = data[lead].astype(np.int64)
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        point = np.select(
            [size == 2, size == 3],
            [(first & 0x1F) << 6 | low[0], (first & 0x0F) << 12 | low[0] << 6 | low[1]],
            (first & 0x07) << 18 | low[0] << 12 | low[1] << 6 | low[2],
        )
        of_lead = _kinds()[np.minimum(point, 0x10FFFF)]
        for k in range(4):
            there = (size > k) & (lead + k < len(data))
            kind[lead[there] + k] = of_lead[there]
        inside, alone = kind != APART, kind == ALONE
        begins = at[:-1][at[:-1] < at[1:]]
        head = inside.copy()
        head[1:] &= ~inside[:-1] | ((data[1:] & 0xC0) != 0x80) & (alone[1:] | alone[:-1])
        head[begins] = inside[begins]
        tail = inside.copy()
        tail[:-1] &= ~inside[1:] | head[1:]
        tail[begins[1:] - 1] = inside[begins[1:] - 1]
        self.starts, self.ends = np.flatnonzero(head), np.flatnonzero(tail) + 1
        self.first = np.searchsorted(self.starts, at)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(at) - 1), self.counts)


def edits_allowed(n: int, share: float) -> int:
    return int(n * share + 1e-9)


class Sampling:
    """For each walk length and repetition, a walk and random places of its embedding.

    ``repeats`` has the number of keys for each walk length.
    """

    def __init__(self, repeats: int | dict[int, int], seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.repeats = repeats if isinstance(repeats, dict) else dict.fromkeys(WALKS, repeats)
        places = {
            steps: [
                np.sort(rng.choice(steps, min(SAMPLED, steps), replace=False))
                for _ in range(MAX_REPEATS if steps > 1 else 1)
            ]
            for steps in WALKS
        }
        # the first repetitions are the same, however many there are
        self.places = {steps: p[: self.repeats.get(steps, 0)] for steps, p in places.items()}
        self.weights = rng.integers(1, 1 << 63, (max(WALKS), MAX_REPEATS + 1), dtype=np.uint64) | 1

    def keys(
        self, h: np.ndarray, begin: np.ndarray, steps: int, told: list | None = None
    ) -> list[np.ndarray]:
        """A key for each repetition and start. ``h`` ends in ``steps`` symbols of padding.

        ``told`` gets, for each repetition, how many unlike symbols each key holds: a walk
        that rests on one frequent word says little.
        """
        out, start = [], begin.astype(np.uint32)
        for r, sample in enumerate(self.places[steps]):
            walk = mixed(h, SEED + 1000 * r).astype(np.uint32)
            at, key, seen = start, np.zeros(len(begin), np.uint64), []
            for j in range(sample[-1] + 1):
                symbol = walk[at]
                if j in sample:
                    key += symbol * self.weights[j, r]
                    if told is not None:
                        seen.append(symbol)
                at = at + ((symbol >> np.uint32(j)) & np.uint32(1))
            if told is not None:
                told.append((np.diff(np.sort(np.stack(seen), axis=0), axis=0) != 0).sum(axis=0) + 1)
            out.append(mixed(key, 100 * steps + r))
        return out


def telling(unlike: np.ndarray, who: np.ndarray) -> np.ndarray:
    """Keys with enough unlike symbols, or the most that any key of their item has."""
    most = np.zeros(int(who.max(initial=-1)) + 1, np.int64)
    np.maximum.at(most, who, unlike)
    return unlike >= np.minimum(UNLIKE, most[who])


class Items:
    """A block of benchmark items with their keys."""

    def __init__(
        self, ids: list[int], texts: list[str], max_edits: float, recall: float, seed: int = SEED
    ) -> None:
        h, first = symbols(binary(pa.array(texts, pa.string())))
        self.max_edits = max_edits
        self.ids, self.symbols = [], []
        for k, item in enumerate(ids):
            if first[k + 1] > first[k]:
                self.ids.append(item)
                self.symbols.append(h[first[k] : first[k + 1]])
        self.walks, repeats = self._tuned(recall, seed)
        self.sampling = Sampling(repeats, seed)
        self.tables = self._tables()

    def _walk(self, item: np.ndarray) -> int:
        return self.walks[min(len(item), TRIED_SYMBOLS)]

    def _anchored(self, sampling: Sampling) -> dict[int, list[tuple]]:
        """By walk length and repetition: keys, item numbers, offsets in the item."""
        grouped: dict[int, tuple[list, list, list, list]] = {}
        for k, item in enumerate(self.symbols):
            steps = self._walk(item)
            anchors = np.arange(0, len(item) - steps + 1, ANCHOR_STRIDE)
            flat, begin, who, off = grouped.setdefault(steps, ([], [], [], []))
            begin.append(anchors + sum(map(len, flat)))
            flat.append(np.concatenate([item, np.zeros(steps, np.uint64)]))
            who.append(np.full(len(anchors), k))
            off.append(anchors)
        out = {}
        for steps, (flat, begin, who, off) in grouped.items():
            told: list[np.ndarray] = []
            keys = sampling.keys(np.concatenate(flat), np.concatenate(begin), steps, told)
            who, off = np.concatenate(who), np.concatenate(off)
            out[steps] = [
                (key[use], who[use], off[use]) for key, use in zip(keys, (telling(t, who) for t in told))
            ]
        return out

    def _tuned(self, recall: float, seed: int) -> tuple[dict[int, int], dict[int, int]]:
        """By length of items the walk, and by walk the repetitions, so that simulated items
        of each length with the allowed share of edits are found often enough."""
        by_length: dict[int, list[np.ndarray]] = {}
        for item in self.symbols:
            by_length.setdefault(min(len(item), TRIED_SYMBOLS), []).append(item[:TRIED_SYMBOLS])
        sampling = Sampling(MAX_REPEATS, seed)
        walks, repeats = {}, {}
        for n, some in sorted(by_length.items()):
            edits = edits_allowed(n, self.max_edits)
            for steps in [s for s in WALKS if s <= n]:
                reached = self._recall(sampling, some, steps, edits, seed) >= recall
                if reached.any() or steps == 1:
                    walks[n] = steps
                    needed = int(np.argmax(reached)) + 1 if reached.any() else MAX_REPEATS
                    repeats[steps] = max(repeats.get(steps, 0), needed)
                    break
        return walks, repeats

    def _recall(
        self, sampling: Sampling, some: list[np.ndarray], steps: int, edits: int, seed: int
    ) -> np.ndarray:
        """Share of edited items of one length that are found, by number of repetitions."""
        rng, n, pad = np.random.default_rng(seed), len(some[0]), np.zeros(steps, np.uint64)
        trials = TRIALS if edits else len(some[:TRIALS])
        items, edited = [some[t % len(some)] for t in range(trials)], []
        for item in items:
            out = item
            for _ in range(edits):
                p, kind = rng.integers(0, len(out)), rng.integers(0, 3)
                new = rng.integers(1, 1 << 63, 1, dtype=np.uint64)
                out = np.concatenate([out[:p], new[: int(kind < 2)], out[p + int(kind > 0) :]])
            edited.append(out)
        sizes = np.array([len(e) for e in edited])
        anchors = np.arange(0, n - steps + 1, ANCHOR_STRIDE)
        who = np.repeat(np.arange(trials), len(anchors))
        theirs = np.repeat(np.arange(trials), sizes)
        place = np.arange(sizes.sum()) + theirs * steps
        told: list[np.ndarray] = []
        mine = sampling.keys(
            np.concatenate([x for item in items for x in (item, pad)]),
            (np.arange(trials)[:, None] * (n + steps) + anchors).reshape(-1), steps, told,
        )
        other = sampling.keys(np.concatenate([x for e in edited for x in (e, pad)]), place, steps)
        found = np.zeros((trials, len(mine)), bool)
        for r, (a, b, unlike) in enumerate(zip(mine, other, told)):
            use = telling(unlike, who)
            hit = np.isin(a[use] ^ mixed(who[use].astype(np.uint64)), b ^ mixed(theirs.astype(np.uint64)))
            found[who[use][hit], r] = True
        return np.logical_or.accumulate(found, axis=1).mean(axis=0)

    def _tables(self) -> dict[int, list[tuple]]:
        tables = {}
        for steps, repeats in self._anchored(self.sampling).items():
            tables[steps] = []
            for key, who, off in repeats:
                order = np.argsort(key, kind="stable")
                unused = np.uint64(64 - min(len(key).bit_length() + _SPARE_BITS, _TABLE_BITS))
                seen = np.zeros(1 << (64 - int(unused)), bool)
                seen[(key >> unused).astype(np.int64)] = True
                tables[steps].append((seen, unused, key[order], who[order], off[order]))
        return tables

    def candidates(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Rows (text, item, position in the text where the item would begin), each once."""
        if not len(h) or not self.tables:
            return np.zeros((0, 3), np.int64)
        pad = max(WALKS)
        counts = np.diff(first)
        doc = np.repeat(np.arange(len(counts)), counts)
        begin = np.arange(len(h)) + doc * pad
        padded = np.zeros(len(h) + len(counts) * pad, np.uint64)
        padded[begin] = h
        found = []
        for steps, repeats in self.tables.items():
            keys = self.sampling.keys(padded, begin.astype(np.uint32), steps)
            for key, (seen, unused, sorted_keys, who, off) in zip(keys, repeats):
                hit = np.flatnonzero(seen[(key >> unused).astype(np.int64)])
                low = np.searchsorted(sorted_keys, key[hit], "left")
                n = np.searchsorted(sorted_keys, key[hit], "right") - low
                hit, low, n = hit[n > 0], low[n > 0], n[n > 0]
                if not len(hit):
                    continue
                row = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                hit = np.repeat(hit, n)
                found.append(np.stack([doc[hit], who[row], hit - first[doc[hit]] - off[row]], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def matches(self, h: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Verified (text, item, start, end, edits); of overlapping matches of one item the
        one with fewest edits, the first at ties."""
        rows = self.candidates(h, first)
        if not len(rows):
            return []
        best: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        done: dict[tuple[int, int], int] = {}
        for d, k, at in rows.tolist():  # sorted: by text, item, position
            item, text = self.symbols[k], h[first[d] : first[d + 1]]
            most = edits_allowed(len(item), self.max_edits)
            if done.get((d, k), -1) >= at:
                continue
            # one region for this candidate and those that begin at most the allowed edits on
            low, high = max(at - most, 0), min(at + len(item) + 2 * most + 1, len(text))
            region = text[low:high]
            if np.isin(item, region).sum() < len(item) - most:
                continue
            done[d, k] = at + most
            if found := aligned(item, region, most):
                best.setdefault((d, k), []).append((found[2], low + found[0], low + found[1]))
        out = []
        for (d, k), found in best.items():
            taken: list[tuple[int, int]] = []
            for edits, start, end in sorted(set(found)):
                if all(end <= a or start >= b for a, b in taken):
                    taken.append((start, end))
                    out.append((d, k, start, end, edits))
        return out


def aligned(item: np.ndarray, region: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the part of ``region`` nearest to ``item``, if near enough."""
    cost = _last_row(item, region, free=True)
    end = int(np.argmin(cost))
    if cost[end] > most:
        return None
    back = _last_row(item[::-1], region[:end][::-1], free=False)
    hits = np.flatnonzero(back == cost[end])
    return end - int(hits[np.argmin(np.abs(hits - len(item)))]), end, int(cost[end])


def _last_row(item: np.ndarray, region: np.ndarray, free: bool) -> np.ndarray:
    steps = np.arange(len(region) + 1)
    row = np.zeros_like(steps) if free else steps.copy()
    for symbol in item:
        down = row + 1
        down[1:] = np.minimum(down[1:], row[:-1] + (region != symbol))
        row = np.minimum.accumulate(down - steps) + steps
    return row


def item_blocks(benchmark: DataFrame, max_edits: float, recall: float) -> Iterator[Items]:
    """The benchmark in blocks of bounded size, each with its keys."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null")
    n, size = items.agg(
        F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))
    ).first()
    blocks = max(-(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES), 1)
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        rows = sorted(block.distinct().collect(), key=lambda r: (r[0] is None, r[0], r[1]))
        yield Items([r[0] for r in rows], [r[1] for r in rows], max_edits, recall)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS, recall: float = TARGET_RECALL
) -> DataFrame:
    """A row for each place of a document that holds a benchmark item.

    Positions count symbols, end exclusive; ``edits`` is the exact edit distance.
    """
    out = None
    for items in item_blocks(benchmark, max_edits, recall):

        def work(batch: pa.RecordBatch, texts: pa.Array, items: Items = items) -> pa.RecordBatch:
            ids = batch.column("doc_id").to_pylist()
            rows = [
                (ids[d], items.ids[k], start, end, edits, len(items.symbols[k]))
                for d, k, start, end, edits in items.matches(*symbols(texts))
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], t) for c, t in enumerate([pa.int64()] * 2 + [pa.int32()] * 4)],
                names=["doc_id", "item_id", "start_word", "end_word", "edits", "item_words"],
            )

        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(over_slices(work, READ_BYTES), SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS, recall: float = TARGET_RECALL
) -> DataFrame:
    """The documents that hold no benchmark item, all columns kept, no shuffle."""
    for items in item_blocks(benchmark, max_edits, recall):

        def work(batch: pa.RecordBatch, texts: pa.Array, items: Items = items) -> pa.RecordBatch:
            clean = np.ones(batch.num_rows, bool)
            clean[[m[0] for m in items.matches(*symbols(texts))]] = False
            return batch.filter(pa.array(clean))

        docs = docs.mapInArrow(over_slices(work, READ_BYTES), docs.schema)
    return docs

"""Substring dedup: near-duplicate passages by compact windows.

Tokens are 5-word shingles (words in lower case). Under one random hash of shingles, all
subsequences of a text that share their minimum at the same place form a compact window
``(left, centre, right)``: any start in ``left .. centre`` and end in ``centre .. right``.
The windows wide enough to hold a passage are the nodes of the text's Cartesian tree over
the hashes with at least ``width`` shingles. Such a node is the minimum of some window of
exactly ``width``, so sliding minima find the nodes and a stack over them alone finds their
spans. Windows with the same minimum hold subsequences that share that signature.

A signature is the least shingle and ``BESIDE`` words next to it (after it for every other
function, before it for the rest), so that windows which share no more than a few frequent
words do not meet. Of ``HASHES`` functions one shared signature is enough to be verified.
Windows meet by a join on the signature, each with the first window that has it (by
document, place). That one may hold less of a passage than later ones, or an edited version
of it. So a window that does not agree with it over a whole passage also meets, for each
side and each length of context at which the two depart (``STEPS`` lengths up to a passage),
the first window with its own context there. No pairs are formed within a signature; a
window has at most two links for each length, so links stay linear in the windows.

The links of a pair of documents whose spans overlap, with about the same shift, are
joined as intervals into one candidate. Verification reads both texts: it marks the
windows of ``width`` shingles that have the needed similarity to the other text at that
shift, and reports their union, the passage, with the similarity of its shingle sets.

Result: one row per passage and document, with the passage of the class representative it
equals; representatives have a row of their own. A passage that a document has of several
representatives is reported with the earliest.

Defined results: texts shorter than a passage have none, nor have null texts; equal rows are
one document; rows without an id, and rows of an id that has unlike texts, are documents of
their own, reported under their id (null for none) and after all others in the order that
makes representatives; a passage that repeats within one document only is not reported; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orefold.llm.common import LOWER, SPACE, Words, mixed, over_slices, powers, ragged, raw, stored
from orefold.operators.joins import size_checked

SHINGLE = 5
PASSAGE_WORDS = 50
SIMILARITY = 0.8
HASHES = 4
#: Words on one side of the least shingle that belong to the signature.
BESIDE = 4
#: Lengths of context on each side of a window's least shingle, up to a passage; a hash of
#: four bits each, one number for a side.
STEPS = 15
#: A signature with a larger share of the windows meets its first one by a broadcast.
HOT_SHARE = 0.001
#: Links of two documents go to one candidate if their shifts differ by at most this.
DRIFT = 16
#: Places that are compared with their surroundings at a time.
_PLACES = 8192
#: Places of many pairs that are compared at a time.
_FLAT = 1 << 16
SEED = 9

WINDOWS = "signature long, doc_id long, centre int, left int, right int, after long, before long"
WINDOW = ("doc_id", "centre", "left", "right")
PASSAGES = (
    "doc_id long, start_word int, end_word int, rep_doc_id long, rep_start_word int, "
    "rep_end_word int, similarity double"
)
OWN = ("start_word", "end_word", "rep_doc_id", "rep_start_word", "rep_end_word", "similarity")


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, word hashes, and the hash of the shingle that begins at each word (only those
    that end in the same text are of use)."""
    words, h = _words(texts)
    return words, h, run_hash(h, size)


def _words(texts: pa.Array) -> tuple[Words, np.ndarray]:
    data, at = raw(texts)
    words = Words(data, at, ~SPACE)
    return words, words.hashes(LOWER[data])


def run_hash(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of ``size`` successive hashes, from each place on; zero padded."""
    return run_hashes(h, [size])[0]


def run_hashes(h: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """``run_hash`` of each of ascending sizes."""
    padded = np.concatenate([h, np.zeros(sizes[-1], np.uint64)])
    own, out = np.zeros(len(h), np.uint64), []
    for k in range(sizes[-1]):
        own *= np.uint64(0x9E3779B97F4A7C15)
        own += padded[k : k + len(h)]
        if k + 1 in sizes:
            out.append(mixed(own, SEED))
    return out


def window_centres(h: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The centres of ``compact_windows``, and what the shingles are ordered by."""
    n = len(h)
    if n < width:
        return np.zeros(0, np.int64), h
    low = np.uint64(0xFFFF)
    key = (h & ~low) | (mixed(np.arange(n, dtype=np.uint64), 77) & low)
    least, value, reach = np.arange(n), key, 1
    while reach < width:  # sliding minima and their places, by doubling
        step = min(reach, width - reach)
        least = np.where(value[:-step] <= value[step:], least[:-step], least[step:])
        value = np.minimum(value[:-step], value[step:])
        reach += step
    least = least[doc[: n - width + 1] == doc[width - 1 :]]
    if not len(least):
        return least, key
    return least[np.concatenate([[True], least[1:] != least[:-1]])], key


def compact_windows(
    h: np.ndarray, doc: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres, first and last places of the nodes of at least ``width`` shingles of the
    Cartesian trees of texts back to back; ``doc`` is the text of each shingle.

    Ties go to the place that a hash of it says, which keeps constant runs shallow.
    """
    centres, key = window_centres(h, doc, width)
    if not len(centres):
        return (np.zeros(0, np.int64),) * 3
    of = doc[centres]
    first, last = np.searchsorted(doc, of, "left"), np.searchsorted(doc, of, "right") - 1
    left, right = first.tolist(), last.tolist()
    stack: list[int] = []
    current = -1
    values, places = key[centres].tolist(), centres.tolist()
    for k, (value, d) in enumerate(zip(values, of.tolist())):
        if d != current:
            stack, current = [], d
        while stack and values[stack[-1]] > value:
            right[stack.pop()] = places[k] - 1
        if stack:
            left[k] = places[stack[-1]] + 1
        stack.append(k)
    return centres, np.array(left), np.array(right)


def context_lengths(passage_words: int) -> list[int]:
    """Words of context beyond a shingle; the last length is a passage or more."""
    step = -(-passage_words // STEPS)
    return [step * k for k in range(1, -(-passage_words // step) + 1)]


class Contexts:
    """Hashes of what lies beside shingles of ``size`` words, from running sums of the words by
    powers: that of a run is a difference and a factor."""

    def __init__(self, h: np.ndarray, size: int, lengths: list[int], side: int) -> None:
        self.size, self.lengths, self.side = size, lengths, side
        none = np.zeros(lengths[-1] + size, np.uint64)
        self.sums = np.concatenate([none, h, none])
        self.up, self.down = powers(len(self.sums))
        self.sums *= (self.down if side > 0 else self.up)[: len(self.sums)]
        np.cumsum(self.sums, out=self.sums)

    def at(self, places: np.ndarray) -> np.ndarray:
        """For each place four bits for each length of context, the shortest one first: equal up
        to a length if the words after (``side`` 1) or before (-1) the shingle are."""
        out = np.zeros(len(places), np.uint64)
        edge = places + self.lengths[-1] + self.size + (self.size - 1 if self.side > 0 else 0)
        own = self.sums[edge if self.side > 0 else edge - 1]
        for length in self.lengths:
            if self.side > 0:
                words = (self.sums[edge + length] - own) * self.up[edge + length]
            else:
                words = (own - self.sums[edge - length - 1]) * self.down[edge - length]
            out = (out << np.uint64(4)) | (mixed(words, length) >> np.uint64(60))
        return out.view(np.int64)


def _hashed(texts: pa.Array, size: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]] | None:
    """Words, word hashes, the shingles that end in their own text (their place among all
    words, and hash), and the hashes of what lies after and before each."""
    words, h = _words(texts)
    whole = np.flatnonzero(words.doc[size - 1 :] == words.doc[: len(h) - size + 1])
    if not len(whole):
        return None
    own, after = run_hashes(h, [size, size + BESIDE])
    # the words from so many before a place to the end of its shingle
    before = np.concatenate([mixed(h[:BESIDE], 5), after[: max(len(h) - BESIDE, 0)]])
    return words, h, whole, own[whole], [after[whole], before[whole]]


def _signature(beside: list[np.ndarray], centres: np.ndarray, f: int) -> np.ndarray:
    """The signatures of windows under hash function ``f``."""
    return mixed(beside[f % 2][centres], 2000 + f).view(np.int64)


def all_windows(docs: DataFrame, width: int, hashes: int = HASHES, size: int = SHINGLE) -> DataFrame:
    """Compact windows of every text under every hash function."""
    lengths = context_lengths(width + size - 1)

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch | None:
        hashed = _hashed(texts, size)
        if hashed is None:
            return None
        words, h, whole, mine, beside = hashed
        doc = words.doc[whole]
        ids, place = batch.column("doc_id").to_numpy(), whole - words.first[doc]
        contexts = [Contexts(h, size, lengths, side) for side in (1, -1)]
        parts: list[list[np.ndarray]] = [[] for _ in range(7)]
        for f in range(hashes):
            centres, left, right = compact_windows(mixed(mine, 1000 + f), doc, width)
            for part, column in zip(
                parts,
                (
                    _signature(beside, centres, f), ids[doc[centres]],
                    place[centres], place[left], place[right],
                    *(c.at(whole[centres]) for c in contexts),
                ),
            ):
                part.append(column)
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(p)).cast(t) for p, t in zip(parts, types)],
            names=["signature", "doc_id", "centre", "left", "right", "after", "before"],
        )

    return docs.mapInArrow(over_slices(work), WINDOWS)


def all_signatures(docs: DataFrame, width: int, hashes: int = HASHES, size: int = SHINGLE) -> DataFrame:
    """``signature, doc_id`` of ``all_windows`` alone: spans and contexts are not needed to see
    which signatures several documents have."""

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch | None:
        hashed = _hashed(texts, size)
        if hashed is None:
            return None
        words, _, whole, mine, beside = hashed
        doc = words.doc[whole]
        ids = batch.column("doc_id").to_numpy()[doc]
        centres = [window_centres(mixed(mine, 1000 + f), doc, width)[0] for f in range(hashes)]
        columns = [
            np.concatenate([_signature(beside, c, f) for f, c in enumerate(centres)]),
            np.concatenate([ids[c] for c in centres]),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["signature", "doc_id"])

    return docs.mapInArrow(over_slices(work), "signature long, doc_id long")


def linked(windows: DataFrame, signatures: DataFrame, passage_words: int, size: int = SHINGLE) -> DataFrame:
    """Each window beside the first one with its signature, and beside the first ones with
    its contexts where those differ; windows whose signature is in a single document are
    left out.

    Most windows share nothing, so what is left of the first join is small, and is written.
    """
    shared = (
        signatures.groupBy("signature").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        .where("lo < hi").select("signature")
    )
    held = stored(windows.join(shared, "signature"), "shared-windows")
    met = _beside_first(held)
    lengths = context_lengths(passage_words)
    apart = [_unlike(F.col(side), F.col(f"rep.{side}"), len(lengths)) for side in ("after", "before")]
    # words beside the shingle that agree, less two lengths that four bits may have let pass
    agreed = (2 * len(lengths) - sum(apart) - 2) * lengths[0] + size
    met = met.withColumns({f"{c}_apart": a for c, a in zip(("after", "before"), apart)})
    met = met.withColumn("open", agreed < passage_words)
    met = met.where(F.col("open") | (F.col("rep.doc_id") < F.col("doc_id")))
    beyond = ("signature", "after", "before", "after_apart", "before_apart")
    beyond = [F.when(F.col("open"), F.col(c)).alias(c) for c in beyond]
    met = stored(met.select(*WINDOW, *_of_rep(), "open", *beyond), "met-windows")
    links = met.select(*WINDOW, "rep_id", "rep_centre", "rep_left", "rep_right")
    return links.unionByName(_closer(met.where("open"), len(lengths))).where("rep_id < doc_id")


def _beside_first(windows: DataFrame) -> DataFrame:
    """Each window with the first one that has its signature, as ``rep``.

    Those of a signature with more than ``HOT_SHARE`` of the windows know it by a broadcast and
    are dealt out by place; all others meet in one exchange. ``windows`` is a written table.
    """
    first = F.min(F.struct(*WINDOW, "after", "before"))
    counts = windows.groupBy("signature").agg(F.count(F.lit(1)).alias("n"))
    most = HOT_SHARE * windows.count()
    hot = [r[0] for r in counts.where(F.col("n") > most).select("signature").collect()]
    if not hot:
        return windows.withColumn("rep", first.over(Window.partitionBy("signature")))
    firsts = windows.where(F.col("signature").isin(hot)).groupBy("signature").agg(first.alias("known"))
    known = windows.join(F.broadcast(firsts), "signature", "left")
    cell = F.when(F.col("known").isNotNull(), F.xxhash64("doc_id", "centre"))
    rep = F.coalesce("known", first.over(Window.partitionBy("signature", cell)))
    return known.withColumn("rep", rep).drop("known")


def _unlike(a: Column, b: Column, lengths: int) -> Column:
    """At how many lengths of context two hashes differ: all from the first such on."""
    return sum((F.shiftright(a.bitwiseXOR(b), 4 * k) != 0).cast("int") for k in range(lengths))


def _closer(open_: DataFrame, lengths: int) -> DataFrame:
    """Each open window beside the first ones with its contexts, at the lengths at which it
    departs from the first of its signature.

    What agrees at a length agrees at all shorter ones. So only windows that meet another
    document's at their shortest such length go on, and lengths at which all that meet there
    still agree would give the same link and count as one.
    """
    sides = F.array(
        *[
            F.struct(F.lit(k).alias("side"), F.col(f"{name}_apart").alias("apart"), F.col(name).alias("context"))
            for k, name in enumerate(("after", "before"))
        ]
    )
    rows = open_.select("signature", *WINDOW, F.explode(sides).alias("at")).select("signature", *WINDOW, "at.*")
    rows = rows.where("apart > 0").withColumn("shortest", F.expr("shiftright(context, 4 * (apart - 1))"))
    keys = ["signature", "side", "apart", "shortest"]
    met = rows.groupBy(*keys).agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
        (_unlike(F.min("context"), F.max("context"), lengths) + 1).alias("levels"),
    )
    met = met.where("lo < hi").select(*keys, "levels")
    # a level is how many of the longest lengths are left out, from 1
    flat = (
        rows.join(met, keys)
        .select("signature", "side", *WINDOW, "context", F.explode(F.sequence(F.lit(1), "levels")).alias("level"))
        .withColumn("context", F.expr("shiftright(context, 4 * (level - 1))"))
    )
    flat = stored(flat, "open-contexts")
    keys = ["signature", "side", "level", "context"]
    closer = (
        flat.groupBy(*keys).agg(F.min(F.struct(*WINDOW)).alias("rep"), F.max("doc_id").alias("hi"))
        .where("rep.doc_id < hi").drop("hi")
    )
    return flat.join(closer, keys).select(*WINDOW, *_of_rep())


def _of_rep() -> list[Column]:
    return [
        F.col("rep.doc_id").alias("rep_id"), F.col("rep.centre").alias("rep_centre"),
        F.col("rep.left").alias("rep_left"), F.col("rep.right").alias("rep_right"),
    ]


def candidates(links: DataFrame) -> DataFrame:
    """Interval join of the links of two documents: ``doc_id, rep_id`` and lists of
    ``(low, high, shifts)``, places of shingles that the joined windows cover in both."""
    shift = F.col("centre") - F.col("rep_centre")
    # what both windows cover, in places of the first document
    low = F.greatest(F.col("left"), F.col("rep_left") + shift)
    high = F.least(F.col("right"), F.col("rep_right") + shift)
    spans = links.select(
        "doc_id", "rep_id", F.floor(shift / DRIFT).cast("int").alias("band"),
        low.alias("low"), high.alias("high"), shift.alias("shift"),
    )
    # one row per pair and band of shifts: sums that merge before the shuffle
    return spans.groupBy("doc_id", "rep_id", "band").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.collect_set("shift").alias("shifts"),
    )


# verification

def similar_places(a: np.ndarray, b: np.ndarray, width: int, least: float, shift: int) -> np.ndarray:
    """Starts in ``a`` of windows of ``width`` shingles with the needed Jaccard similarity
    to the window of ``b`` at ``start - shift``.

    Shingles are counted by occurrences; one is shared if the other text has it within
    ``DRIFT`` places of where the shift puts it.
    """
    starts = np.arange(max(0, shift), min(len(a) - width, len(b) - width + shift) + 1)
    if not len(starts):
        return starts
    shared = _sliding(_present(a, b, shift), width)[starts]
    # what one text holds of the other is the most that both share
    enough = shared >= least * (2 * width - shared) - 1e-9
    starts, shared = starts[enough], shared[enough]
    if not len(starts):
        return starts
    shared = np.minimum(shared, _sliding(_present(b, a, -shift), width)[starts - shift])
    return starts[shared >= least * (2 * width - shared) - 1e-9]


def _present(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    """Whether ``b`` has each shingle of ``a`` at most ``DRIFT`` places from where it would be."""
    if len(a) > _PLACES:
        parts = range(0, len(a), _PLACES)
        return np.concatenate([_present(a[i : i + _PLACES], b, shift - i) for i in parts])
    # what lies around each place, one row for each distance
    begin = max(shift + DRIFT, 0)
    end = min(len(a) + 2 * DRIFT, len(b) + shift + DRIFT)
    if not len(a) or begin >= end:
        return np.zeros(len(a), bool)
    around, there = np.zeros(len(a) + 2 * DRIFT, b.dtype), np.zeros(len(a) + 2 * DRIFT, bool)
    around[begin:end] = b[begin - shift - DRIFT : end - shift - DRIFT]
    there[begin:end] = True
    same = _shifted(around, len(a)) == a
    if end - begin < len(there):
        same &= _shifted(there, len(a))
    return same.any(axis=0)


def _shifted(values: np.ndarray, n: int) -> np.ndarray:
    """A view of ``n`` values from each of the first places on, a row for each place."""
    return np.ndarray((len(values) - n + 1, n), values.dtype, values, 0, 2 * values.strides)


def verified(
    a: np.ndarray, b: np.ndarray, low: int, high: int, shifts: list[int], width: int, least: float
) -> list[tuple[int, int, int, int, float]]:
    """Passages (start, end, start in b, end in b, similarity) in places of shingles: unions
    of overlapping similar windows that touch ``low .. high``, with the similarity of their
    sets, at each of ``shifts``. The longest come first; one that has ``DRIFT`` places or
    fewer outside of longer ones is the same passage at another shift.

    Most copies agree place by place at one shift, which is tried first. Where windows that
    this leaves out hold enough shingles that the other text has near them, all are compared
    with shingles that have moved.
    """
    found: list[tuple[int, int, int, int]] = []
    if len(a) < width or len(b) < width:
        return []
    # bounds of what can touch the span
    bounds = {}
    for shift in shifts:
        begin, end = max(0, shift, low - width), min(len(a), len(b) + shift, high + width + 1)
        if end - begin >= width:
            bounds[shift] = begin, end
    covered = np.zeros(len(a), bool)

    def add(starts: np.ndarray, shift: int) -> None:
        starts = starts[(starts + width > low) & (starts <= high)]
        if not len(starts):
            return
        cut = np.flatnonzero(np.diff(starts) > width)
        for i, j in zip(np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(starts) - 1]])):
            s, e = int(starts[i]), int(starts[j]) + width
            covered[s:e] = True
            # without the unlike shingles at either end
            alike = np.flatnonzero(_held(a[s:e], b[s - shift : e - shift]))
            s, e = s + int(alike[0]), s + int(alike[-1]) + 1
            found.append((s, e, s - shift, e - shift))

    for shift, (begin, end) in bounds.items():
        shared = _sliding(a[begin:end] == b[begin - shift : end - shift], width)
        add(begin + np.flatnonzero(shared >= least * (2 * width - shared) - 1e-9), shift)
    for shift, (begin, end) in bounds.items():
        # a similar window holds that many shingles of the other text, wherever they are
        open_ = _sliding(~covered[begin:end], width) > 0
        if not open_.any():
            continue
        near = _held(a[begin:end], b[max(begin - shift - DRIFT, 0) : end - shift + DRIFT])
        shared = _sliding(near, width)
        if not (open_ & (shared >= least * (2 * width - shared) - 1e-9)).any():
            continue
        lead = max(0, begin - DRIFT), max(0, begin - shift - DRIFT)
        starts = lead[0] + similar_places(
            a[lead[0] : end + DRIFT], b[lead[1] : end - shift + DRIFT], width, least, shift - lead[0] + lead[1]
        )
        add(starts[(starts >= begin) & (starts + width <= end)], shift)
    out: list[tuple[int, int, int, int, float]] = []
    taken = np.zeros(len(a), bool)

    def own(p: tuple) -> bool:
        free = int(np.count_nonzero(~taken[p[0] : p[1]]))
        return free == p[1] - p[0] or free > DRIFT

    # longest first, of those the most similar; only what can stay is compared
    found.sort(key=lambda p: p[0] - p[1])
    for _, same in itertools.groupby(found, key=lambda p: p[0] - p[1]):
        like = [(*p, _jaccard(a[p[0] : p[1]], b[p[2] : p[3]])) for p in same if own(p)]
        for p in sorted(like, key=lambda p: (-p[4], p[0])):
            if own(p):
                out.append(p)
                taken[p[0] : p[1]] = True
    return sorted(out)


def _sliding(marks: np.ndarray, width: int) -> np.ndarray:
    """Marks in each window of ``width``."""
    sums = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=sums[1:])
    return sums[width:] - sums[:-width]


def _marked(values: np.ndarray) -> np.ndarray:
    """For each 16-bit number whether it is among ``values``."""
    marks = np.zeros(1 << 16, bool)
    marks[values] = True
    return marks


def _held(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of ``a`` are among ``b``; for 16-bit hashes by a table of all numbers."""
    return _marked(b)[a] if a.dtype == b.dtype == np.uint16 else np.isin(a, b)


def _jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """The similarity of two sets of hashes, given with repeats."""
    if len(a) == len(b) and (a == b).all():
        return 1.0
    if a.dtype == b.dtype == np.uint16:
        x, y = _marked(a), _marked(b)
        both, of_a, of_b = (int(np.count_nonzero(m)) for m in (x & y, x, y))
    else:
        both, of_a, of_b = len(np.intersect1d(a, b)), len(np.unique(a)), len(np.unique(b))
    return both / (of_a + of_b - both)


def of_pair(
    a: np.ndarray, b: np.ndarray, spans: list[dict], width: int, least: float
) -> list[tuple[int, int, int, int, float]]:
    """All passages of two documents. A span that lies in a passage found before is settled.
    Where a span has ``fitting``, those of its shifts that can have a similar window, only these
    are looked at."""
    out: set[tuple[int, int, int, int, float]] = set()
    for s in sorted(spans, key=lambda s: (s["low"] - s["high"], s["low"], s["shifts"])):
        shifts = s.get("fitting", s["shifts"])
        if shifts and not any(p[0] <= s["low"] and s["high"] < p[1] for p in out):
            out.update(verified(a, b, s["low"], s["high"], shifts, width, least))
    return sorted(out)


def fitting(batch: pa.RecordBatch, width: int, least: float) -> np.ndarray:
    """For each shift of each span of each pair (``spans, shingles, rep_shingles``), in order,
    whether any window of ``width`` near the span has the needed similarity by ``similar_places``.

    Most pairs have none, and are settled here, many at a time.
    """
    spans = batch.column("spans")
    flat = spans.flatten()
    shifts = flat.field("shifts")
    pair = np.repeat(np.arange(len(spans)), spans.value_lengths().to_numpy())
    times = shifts.value_lengths().to_numpy()
    pair, shift = np.repeat(pair, times), shifts.flatten().to_numpy().astype(np.int64)
    low, high = (np.repeat(flat.field(c).to_numpy().astype(np.int64), times) for c in ("low", "high"))
    sides = []
    for name in ("shingles", "rep_shingles"):
        data, at = raw(batch.column(name).cast(pa.large_binary()))
        values = np.frombuffer(data.tobytes(), np.uint16).astype(np.int32)
        sides.append((values, at[:-1][pair] // 2, np.diff(at)[pair] // 2))
    (a, a_at, a_len), (b, b_at, b_len) = sides
    begin = np.maximum(np.maximum(shift, low - width), 0)
    end = np.minimum(np.minimum(a_len, b_len + shift), high + width + 1)
    out = np.zeros(len(pair), bool)
    some = np.flatnonzero(end - begin >= width)
    room = end[some] - begin[some] + 2 * DRIFT
    part = np.cumsum(room) // _FLAT
    for k in np.split(np.arange(len(some)), np.flatnonzero(np.diff(part)) + 1) if len(some) else ():
        e, n = some[k], room[k]
        at = np.cumsum(n) - n
        place = ragged(begin[e] - DRIFT, n)
        x = _cut(a, place, np.repeat(a_at[e], n), np.repeat(a_len[e], n), -1)
        y = _cut(b, place - np.repeat(shift[e], n), np.repeat(b_at[e], n), np.repeat(b_len[e], n), -2)
        in_b, in_a = np.zeros(len(x), bool), np.zeros(len(x), bool)
        for d in range(-DRIFT, DRIFT + 1):
            i, j = max(0, -d), max(0, d)  # a place of one and the one at distance d of the other
            same = x[i : len(x) - j] == y[j : len(y) - i]
            in_b[i : len(x) - j] |= same
            in_a[j : len(x) - i] |= same
        shared = np.minimum(_sliding(in_b, width), _sliding(in_a, width))
        ok = np.concatenate([[0], np.cumsum(shared >= least * (2 * width - shared) - 1e-9)])
        first = at + DRIFT
        out[e] = ok[first + n - 2 * DRIFT - width + 1] > ok[first]
    return out


def _cut(values: np.ndarray, place: np.ndarray, at: np.ndarray, n: np.ndarray, none: int) -> np.ndarray:
    """The values at places of texts of ``n`` values from ``at`` on, ``none`` outside of them."""
    inside = (place >= 0) & (place < n)
    out = np.full(len(place), none, values.dtype)
    out[inside] = values[(place + at)[inside]]
    return out


def settled(batch: pa.RecordBatch, width: int, least: float) -> Iterator[tuple[int, list[tuple]]]:
    """The row and passages of each pair of a batch that can have any."""
    fits, spans = fitting(batch, width, least), batch.column("spans")
    times = spans.flatten().field("shifts").value_lengths().to_numpy()
    of_span = np.concatenate([[0], np.cumsum(times)])
    of_pair_ = np.concatenate([[0], np.cumsum(spans.value_lengths().to_numpy())])
    before = np.concatenate([[0], np.cumsum(fits)])
    ends = of_span[of_pair_]
    for k in np.flatnonzero(before[ends[1:]] > before[ends[:-1]]).tolist():
        own = spans[k].as_py()
        for i, s in enumerate(own, of_pair_[k]):
            s["fitting"] = [x for x, fit in zip(s["shifts"], fits[of_span[i] : of_span[i + 1]]) if fit]
        a, b = (np.frombuffer(batch.column(c)[k].as_py(), np.uint16) for c in ("shingles", "rep_shingles"))
        yield k, of_pair(a, b, own, width, least)


def passages(
    docs: DataFrame,
    passage_words: int = PASSAGE_WORDS,
    similarity: float = SIMILARITY,
    hashes: int = HASHES,
    size: int = SHINGLE,
) -> DataFrame:
    """``PASSAGES``: near-duplicate passages, each with that of its representative."""
    width = passage_words - size + 1
    texts, names = _documents(docs)
    out = _passages(texts, passage_words, similarity, hashes, size, width)
    if names is None:
        return out
    for column in ("doc_id", "rep_doc_id"):
        of = names.select(F.col("key").alias(column), F.col("doc_id").alias("named"), F.lit(True).alias("own"))
        named = F.when(F.col("own"), F.col("named")).otherwise(F.col(column))
        out = out.join(of, column, "left").withColumn(column, named).drop("named", "own")
    return out.select(*[c.split()[0] for c in PASSAGES.split(", ")]).distinct()


def _documents(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``doc_id, text`` with an id of its own for each text, and the ids (``key, doc_id``) of
    those that got another one: rows without an id, and those of ids with unlike texts."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).where("text is not null")
    h = F.xxhash64("text")
    unlike = texts.where("doc_id is not null").groupBy("doc_id").agg(F.min(h).alias("a"), F.max(h).alias("b"))
    unlike = stored(unlike.where("a <> b").select("doc_id", F.lit(True).alias("unlike")), "unlike-ids")
    if unlike.isEmpty() and texts.where("doc_id is null").isEmpty():
        return texts, None
    # above all other ids, so that these come last
    key = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2) + F.lit(1 << 62)
    marked = texts.join(size_checked(unlike), "doc_id", "left")
    other = F.col("doc_id").isNull() | F.col("unlike").isNotNull()
    names = stored(marked.where(other).select(key.alias("key"), "doc_id").distinct(), "other-ids")
    return marked.select(F.when(other, key).otherwise(F.col("doc_id")).alias("doc_id"), "text"), size_checked(names)


def _passages(
    texts: DataFrame, passage_words: int, similarity: float, hashes: int, size: int, width: int
) -> DataFrame:
    windows, signatures = (made(texts, width, hashes, size) for made in (all_windows, all_signatures))
    found = stored(candidates(linked(windows, signatures, passage_words, size)), "passage-candidates")
    needed = found.select("doc_id").unionByName(found.select(F.col("rep_id").alias("doc_id"))).distinct()
    wanted = texts.join(size_checked(stored(needed, "passage-documents")), "doc_id", "left_semi")
    held = stored(shingle_rows(wanted, size), "passage-texts")
    held = held.groupBy("doc_id").agg(F.min("shingles").alias("shingles"))
    # of the first text only the part that its spans can reach goes on to the second join
    span = F.struct(
        (F.col("low") - F.col("skip")).alias("low"), (F.col("high") - F.col("skip")).alias("high"),
        F.transform(F.array_sort("shifts"), lambda x: x - F.col("skip")).alias("shifts"),
    )
    margin = 2 * width + DRIFT
    reach = found.groupBy("doc_id", "rep_id").agg(
        F.greatest(F.min("low") - margin, F.lit(0)).alias("skip"), (F.max("high") + margin).alias("until")
    )
    spans = found.join(reach, ["doc_id", "rep_id"]).groupBy("doc_id", "rep_id", "skip", "until").agg(
        F.collect_list(span).alias("spans")
    )
    part = F.expr("substring(shingles, 2 * skip + 1, 2 * (until - skip))")
    rows = (
        spans.join(held, "doc_id").select("doc_id", "rep_id", "skip", "spans", part.alias("shingles"))
        .join(held.select(F.col("doc_id").alias("rep_id"), F.col("shingles").alias("rep_shingles")), "rep_id")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            names = [batch.column(c).to_numpy() for c in ("doc_id", "rep_id", "skip")]
            for k, found in settled(batch, width, similarity):
                doc, rep, skip = (int(c[k]) for c in names)
                for s, e, t, u, j in found:
                    out.append((doc, skip + s, skip + e + size - 1, rep, t, u + size - 1, j))
            yield _passage_batch(out)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, own in zip(batch.column("doc_id").to_pylist(), batch.column("own").to_pylist()):
                for p in of_earliest(own):
                    s, e, rep, t, u, j = (p[c] for c in OWN)
                    out += [(doc, s, e, rep, t, u, j), (rep, t, u, rep, t, u, 1.0)]
            yield _passage_batch(out)

    own = rows.mapInArrow(work, PASSAGES).groupBy("doc_id").agg(F.collect_list(F.struct(*OWN)).alias("own"))
    return own.mapInArrow(settle, PASSAGES).distinct()


def of_earliest(own: list[dict]) -> list[dict]:
    """The passages of one document without those that it already has of earlier
    representatives (all but ``DRIFT`` words of them)."""
    kept: list[dict] = []
    covered: list[tuple[int, int]] = []  # by earlier representatives, apart and in order
    own = sorted(own, key=lambda p: p["rep_doc_id"])
    for _, of_one in itertools.groupby(own, key=lambda p: p["rep_doc_id"]):
        new = []
        for p in of_one:
            s, e = p["start_word"], p["end_word"]
            shared = sum(max(min(e, b) - max(s, a), 0) for a, b in covered)
            if not shared or e - s - shared > DRIFT:
                new.append(p)
        kept += new
        merged: list[tuple[int, int]] = []
        for a, b in sorted(covered + [(p["start_word"], p["end_word"]) for p in new]):
            if merged and a <= merged[-1][1]:
                merged[-1] = merged[-1][0], max(b, merged[-1][1])
            else:
                merged.append((a, b))
        covered = merged
    return kept


def _passage_batch(out: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array([o[i] for o in out], t) for i, t in enumerate(types)],
        names=[c.split()[0] for c in PASSAGES.split(", ")],
    )


def shingle_rows(texts: DataFrame, size: int) -> DataFrame:
    """``doc_id, shingles``: 16-bit hashes of a text's shingles, in order. A shingle is only
    compared with those within ``DRIFT`` places of where it should be, so two unlike ones pass
    for equal with odds of 33 in 65,536; the candidates share 64-bit signatures."""

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        words, _, own = shingles(texts, size)
        kept = [
            own[words.first[d] : max(words.first[d + 1] - size + 1, words.first[d])].astype(np.uint16).tobytes()
            for d in range(len(texts))
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(kept, pa.binary())], names=["doc_id", "shingles"]
        )

    return texts.mapInArrow(over_slices(work), "doc_id long, shingles binary")

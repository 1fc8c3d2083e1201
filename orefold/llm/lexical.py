"""Ranked lexical search by range-maximum tables over posting lists.

The index holds, for each block of documents in order of their ids, the postings of all terms
that the items ask for: position, count, and the length of each document. It is written once,
by one pass over the texts; the counts of documents for each term come from it.

Every task then answers all items over its blocks. A posting carries its impact on the score,
and each list a sparse table, which gives the largest impact and its place in any interval of
documents by two look-ups. An item starts with the interval of the whole block. The sum of
its terms' largest impacts in an interval bounds all scores there; intervals are taken best
bound first, some at a time, and each is split at a document of maximum impact, which is
scored, so that both sides no longer hold it; an interval with few postings left is scored
whole. Search ends when no bound reaches the last of
the best scores so far, which a task carries from block to block. Of an interval whose bound
equals that score only ids below the last one's matter. A task hands on its best documents
for each item, and those of all tasks are ranked: nothing else is shuffled.

The items' terms travel with the tasks, so items come in sets of bounded text size, each of
which reads the texts once more. Blocks are bounded by bytes of text, whatever the documents'
ids or sources; one longer text is a block of its own.

Defined results: a null or empty text has no terms and counts neither as document nor with
its length; items without terms have no rows; rows of one item id are one item with the terms
of all; a null item id is an id like any other. Documents of repeated ids are ranked each,
and a null document id comes last among equals. Extra columns are ignored; empty tables give
no rows. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orefold.llm.common import LOWER, Words, binary, over_slices, ragged, raw, stored

TOP = 10
#: Bytes of text of the items that are answered by one pass.
ITEM_BYTES = 4 * 1024 * 1024
#: Bytes of text of one block of the index.
BLOCK_BYTES = 4 * 1024 * 1024
#: Intervals taken at a time.
WIDE = 64
#: An interval with no more postings of the item's terms than this is scored whole.
LEAF = 2048

TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_PLACE = 23  # bits of a place in a block: more than BLOCK_BYTES, a document has a byte at least
_MASK = (1 << _PLACE) - 1


def term_hashes(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """Terms of a ``large_binary`` array and their 64-bit hashes, A-Z in lower case."""
    data, at = raw(texts)
    words = Words(data, at, TERM)
    return words, words.hashes(LOWER[data])


class Items:
    """Items of one set: ids, and for each the numbers of its terms in ``terms`` (sorted)."""

    def __init__(self, rows: list) -> None:
        by_id: dict = {}
        for item, text in rows:
            by_id.setdefault(item, []).append(text)
        self.ids = list(by_id)
        joined = binary(pa.array([" ".join(t or "" for t in by_id[i]) for i in self.ids], pa.string()))
        words, hashes = term_hashes(joined)
        self.terms = np.unique(hashes)
        self.of = [
            np.unique(np.searchsorted(self.terms, hashes[a:b])) for a, b in zip(words.first, words.first[1:])
        ]


def item_sets(items: DataFrame, item_bytes: int) -> Iterator[Items]:
    """The items in sets of bounded text size; rows of one id stay together."""
    ordered = items.orderBy(F.asc_nulls_first("item_id"))
    held, size, last = [], 0, object()
    for row in ordered.select(F.col("item_id").cast("long"), F.col("text")).toLocalIterator():
        if size >= item_bytes and row[0] != last:
            yield Items(held)
            held, size = [], 0
        held.append((row[0], row[1]))
        size += len(row[1] or "")
        last = row[0]
    if held:
        yield Items(held)


def index(docs: DataFrame, terms: np.ndarray, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each block: ids in order (nulls last), lengths in terms, and postings of the
    given terms, sorted by term and place: number of the term, place, count; stored."""

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        words, hashes = term_hashes(texts)
        number = np.minimum(np.searchsorted(terms, hashes), max(len(terms) - 1, 0))
        asked = terms[number] == hashes if len(terms) else np.zeros(len(hashes), bool)
        ids = batch.column("doc_id")
        # texts without terms are no documents
        holds = np.flatnonzero(words.counts)
        order = holds[
            np.lexsort((ids.fill_null(0).to_numpy()[holds], ids.is_null().to_numpy(zero_copy_only=False)[holds]))
        ]
        place = np.zeros(len(texts), np.int64)
        place[order] = np.arange(len(order))
        key = number[asked].astype(np.int64) << 32 | place[words.doc[asked]]
        key, tf = np.unique(key, return_counts=True)
        columns = [
            ids.take(pa.array(order)), pa.array(words.counts[order]),
            pa.array(key >> 32), pa.array(key & 0xFFFFFFFF), pa.array(tf.astype(np.int64)),
        ]
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns],
            names=["ids", "n", "term", "place", "tf"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(
        over_slices(work, block_bytes),
        "ids array<long>, n array<long>, term array<long>, place array<long>, tf array<long>",
    )
    return stored(rows, "lexical-index")


def figures(blocks: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents, the terms in them, and the documents that hold each asked term."""
    total = blocks.agg(
        F.coalesce(F.sum(F.size("ids")), F.lit(0)),
        F.coalesce(F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0)),
    ).first()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(terms, np.int64)
        for batch in batches:
            df += np.bincount(batch.column("term").flatten().to_numpy(), minlength=terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], names=["term", "df"])

    df = np.zeros(terms, np.int64)
    counts = blocks.select("term").mapInArrow(work, "term long, df long")
    for r in counts.groupBy("term").agg(F.sum("df").alias("df")).collect():  # the items' terms at most
        df[r["term"]] = r["df"]
    return total[0], total[1], df


def weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, weight: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What each posting adds to its document's score."""
    if len(n) and 90 * int(n.max()) * documents >= 1 << 63:
        n = n.astype(object)
    m = (10 + (90 * n * documents) // length).astype(np.int64)
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Block:
    """Posting lists of one block with a range-maximum table over all of them."""

    def __init__(self, ids: np.ndarray, term: np.ndarray, place: np.ndarray, impact: np.ndarray) -> None:
        self.ids = ids
        self.key = term << 32 | place
        self.impact = impact
        # the larger impact wins, of equal ones the earlier place
        level = impact << _PLACE | (_MASK - place)
        self.levels = [level]
        longest = int(np.bincount(term).max(initial=0))
        width = 1
        while 2 * width <= longest:
            level = np.maximum(level[:-width], level[width:])
            self.levels.append(level)
            width *= 2
        self.flat = np.concatenate(self.levels)
        self.starts = np.concatenate([[0], np.cumsum([len(x) for x in self.levels])])[:-1]

    def spans(self, terms: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each interval of places [low, high) and each term: where its postings are."""
        a = np.searchsorted(self.key, terms << 32 | low[:, None])
        return a, np.searchsorted(self.key, terms << 32 | high[:, None])

    def largest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The largest posting of each span, impact and place packed; 0 where there is none."""
        n = b - a
        some = n > 0
        k = np.frexp(np.maximum(n, 1))[1] - 1  # floor of the logarithm
        at = self.starts[k]
        # empty intervals look at 0
        first = np.where(some, at + a, 0)
        second = np.where(some, at + b - (1 << k), 0)
        return np.where(some, np.maximum(self.flat[first], self.flat[second]), 0)

    def scores(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and whole scores of the documents in disjoint intervals, from their spans."""
        at = ragged(a.ravel(), (b - a).ravel())
        places, of = np.unique(self.key[at] & 0xFFFFFFFF, return_inverse=True)
        # sums stay far below 2^53, where doubles are exact
        return places, np.bincount(of, self.impact[at], len(places)).astype(np.int64)


class Best:
    """The best documents of an item so far: score, then the lower id; ids as sort keys."""

    def __init__(self, top: int) -> None:
        self.top, self.rows = top, []

    @property
    def last(self) -> tuple[int, tuple]:
        """What a document must beat: the last one's score and id."""
        return self.rows[-1] if len(self.rows) == self.top else (0, (2, 0))

    def add(self, score: int, doc: tuple) -> None:
        self.rows.append((score, doc))
        self.rows.sort(key=lambda r: (-r[0], r[1]))
        del self.rows[self.top :]


def search(block: Block, keys: list[tuple], terms: np.ndarray, best: Best) -> None:
    """Best-first search of a block: ``keys`` are the documents' sort keys in order."""
    if not len(terms) or not len(block.key):
        return
    terms = terms.astype(np.int64)

    def bounded(low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
        """Intervals with the bound on their scores, their greatest posting, and how many."""
        a, b = block.spans(terms, low, high)
        found = block.largest(a, b)
        return [low, high, (found >> _PLACE).sum(axis=1), found.max(axis=1, initial=0), (b - a).sum(axis=1)]

    def offer(low: np.ndarray, high: np.ndarray) -> None:
        places, score = block.scores(*block.spans(terms, low, high))
        good = np.flatnonzero(score >= max(best.last[0], 1))
        for i in good[np.lexsort((places[good], -score[good]))].tolist():
            doc = keys[places[i]]
            if (-score[i], doc) >= (-best.last[0], best.last[1]):
                break  # the others come after it
            best.add(int(score[i]), doc)

    low, high = np.zeros(1, np.int64), np.array([len(keys)], np.int64)
    a, b = block.spans(terms, low, high)
    terms = terms[a[0] < b[0]]  # the others add nothing in this block
    open_ = bounded(low, high)
    while True:
        low, high, bound, peak, size = open_
        least, doc = best.last
        alive = bound > least
        for i in np.flatnonzero((bound == least) & (bound > 0)).tolist():
            alive[i] = keys[low[i]] < doc
        if not alive.any():
            return
        low, high, bound, peak, size = (x[alive] for x in open_)
        order = np.lexsort((low, -bound))
        taken, rest = order[:WIDE], order[WIDE:]
        whole = taken[size[taken] <= LEAF]
        split = taken[size[taken] > LEAF]
        at = _MASK - (peak[split] & _MASK)
        offer(np.concatenate([low[whole], at]), np.concatenate([high[whole], at + 1]))
        new_low, new_high = np.concatenate([low[split], at + 1]), np.concatenate([at, high[split]])
        some = new_low < new_high
        made = bounded(new_low[some], new_high[some])
        open_ = [np.concatenate([x[rest], y]) for x, y in zip((low, high, bound, peak, size), made)]


def answered(blocks: DataFrame, items: Items, top: int = TOP) -> DataFrame:
    """``item_id, doc_id, score``: the best documents of each item in each task."""
    documents, length, df = figures(blocks, len(items.terms))
    weight, ids, of = weights(documents, df), items.ids, items.of

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in ids]
        for batch in batches:
            for r in range(batch.num_rows):
                docs, n, term, place, tf = (
                    batch.column(c).slice(r, 1).flatten() for c in ("ids", "n", "term", "place", "tf")
                )
                term, place = term.to_numpy(), place.to_numpy()
                n = n.to_numpy()[place]
                block = Block(docs, term, place, impacts(tf.to_numpy(), n, weight[term], documents, length))
                keys = [(0, d) if d is not None else (1, 0) for d in docs.to_pylist()]
                for own, terms in zip(best, of):
                    search(block, keys, terms, own)
        rows = [(i, d, s) for i, own in zip(ids, best) for s, (null, d) in own.rows for d in [None if null else d]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], names=["item_id", "doc_id", "score"]
        )

    return blocks.mapInArrow(work, "item_id long, doc_id long, score long")


def ranked(
    docs: DataFrame, items: DataFrame, top: int = TOP,
    item_bytes: int = ITEM_BYTES, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item (``item_id, text``)."""
    found = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    for part in item_sets(items, item_bytes):
        if len(part.terms):
            found = found.unionByName(answered(index(docs, part.terms, block_bytes), part, top))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        .select("item_id", "rank", "doc_id", "score")
    )


ORACLE_SQL = r"""
with doc_terms as materialized (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents where text is not null
),
lengths as materialized (select r, doc_id, len(terms) as n from doc_terms where len(terms) > 0),
totals as (select count(*) as docs, sum(n)::bigint as total from lengths),
counts as materialized (
  select r, term, count(*) as tf from (select r, unnest(terms) as term from doc_terms) group by r, term
),
item_terms as materialized (
  select distinct item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark where text is not null
),
held as (select term, count(*) as df from counts group by term),
weighed as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w from held, totals
),
scores as (
  select item_id, r, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::bigint as score
  from item_terms join weighed using (term) join counts using (term) join lengths using (r), totals
  group by item_id, r, doc_id
)
select item_id, rank::integer as rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank
  from scores where score > 0
) where rank <= 10"""

"""N-gram Jaccard join by a token-group matrix.

A document's set is its distinct 5-word shingles, as 64-bit hashes. Documents with the same
set are one node. Two nodes link when ``100 * intersection >= similarity * union``; the result
has every document with the component its node belongs to. The search is exact:

1. *Prefixes.* Two sets that link share a token among the first ``n - ceil(s n) + 1`` of each,
   in any order all sets agree on. The order is that of hashes, but tokens that occur in many
   sets (counted over the first tokens of all sets) come last, so that what thousands of
   documents share is looked at only where a document has hardly anything else.
2. *Stars.* Sets of like size that agree on the least tokens under two hash functions are
   compared with the least node among them. This joins most of a large group of near copies
   by as many comparisons as it has members, and gives a first division into components.
3. *Groups.* A component of several nodes is a group, or, if it is too large, several groups
   of its own; other nodes are grouped by their least token, since similar sets mostly share
   it. Groups are bounded by their tokens. The matrix holds a row for each (token, group) of
   the prefixes, with the sizes of the members that have the token and its first place.
4. *Candidates.* Nodes meet the matrix in their prefix tokens, where the tokens that follow on
   both sides leave room for the overlap the sizes demand. Tokens that one component alone has
   are left out, a component's nodes do not ask for tokens of which they are the most, and
   nobody asks the groups of its own component.
5. *Opening.* A group's task has the union of its members' tokens. The tokens a query has in
   it bound every overlap with a member; only if they reach what the similarity demands of the
   smallest fitting member is the group opened, and overlaps with all members are counted.
   Emitted links join components only, so there are fewer than queries and members.

Sets are made again from the texts where they are needed, which is cheaper than keeping them:
they are larger than the texts. Only the sets of nodes that have to be compared are shuffled.
Which tokens come last, and which are worth looking up, is sent to the tasks as arrays of
bounded size; beyond it fewer tokens come last, or all are looked up, with the same result.

No task holds more than one bounded group and a bounded part of its queries, whatever share
of the rows a group of copies, a token or a passage has. Near copies that are *not* linked
with one another though they share nearly everything still cost a look of each at each group
of the others.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; with fewer words
than a shingle the whole sequence is one; a null text or one without words has an empty set,
which links with nothing, and its own id as component. Rows of one id are documents of their
own; a null id names no component, so a component of null ids alone has null. Extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.llm.common import LOWER, SPACE, Words, give_back, mixed, over_slices, ragged, raw, slices, stored
from orefold.llm.components import components
from orefold.operators.joins import measured_size, size_checked

SHINGLE = 5
SIMILARITY = 80
#: A token in the first tokens of more sets than this comes last in the order.
FREQUENT = 32
#: Tokens that are sent to the tasks at most (8 bytes each).
MOST_SENT = 6_000_000
#: Tokens of one group, and of the queries that are compared with it at a time.
GROUP_TOKENS = 40_000
QUERY_TOKENS = 100_000
#: Hash functions for stars, and the pairs of them that have to agree.
STARS = 4
STAR_PAIRS = ((0, 1), (2, 3), (0, 2), (1, 3))
_PAIRS = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)


# sets

def token_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, ascending, back to back, and the number of each."""
    data, at = raw(texts)
    words = Words(data, at, ~SPACE)
    h = words.hashes(LOWER[data])
    made = np.maximum(words.counts - shingle + 1, np.minimum(words.counts, 1))
    ends = np.concatenate([[0], np.cumsum(made)])
    if not len(h):
        return np.zeros(0, np.uint64), made
    padded = np.concatenate([h, np.zeros(shingle, np.uint64)])
    run = np.zeros(len(h), np.uint64)
    for k in range(shingle):
        run = run * _BASE + padded[k : k + len(h)]
    value = run[ragged(words.first[:-1], made)]
    for d in np.flatnonzero((words.counts > 0) & (words.counts < shingle)).tolist():
        own = int(words.counts[d])  # a short sequence is no shingle of the usual length
        for x in h[words.first[d] : words.first[d + 1]].tolist():
            own = (own * int(_BASE) + x) % (1 << 64)
        value[ends[d]] = own
    value = mixed(value, 7)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if b - a > 1:
            value[a:b].sort()
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    new[ends[:-1][made > 0]] = True
    before = np.concatenate([[0], np.cumsum(new)])
    return value[new], before[ends[1:]] - before[ends[:-1]]


def set_names(tokens: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which sets are not empty, and a 64-bit hash of each of those."""
    some = np.flatnonzero(n)
    if not len(some):
        return some, np.zeros(0, np.uint64)
    starts = (np.cumsum(n) - n)[some]
    return some, mixed(np.add.reduceat(mixed(tokens, 1), starts) + n[some].astype(np.uint64), 2)


def sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, node, n, least, keys``: the hash and size of the document's set, its least
    token, and keys that similar sets often share; null but for ``n`` if empty. Stored."""

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        tokens, n = token_sets(texts, shingle)
        some, names = set_names(tokens, n)
        node, least = np.zeros(len(n), np.uint64), np.zeros((STARS, len(n)), np.uint64)
        node[some] = names
        if len(some):
            starts = (np.cumsum(n) - n)[some]
            for k in range(STARS):
                least[k, some] = np.minimum.reduceat(mixed(tokens, 10 + k) if k else tokens, starts)
        # sets that link are of like size
        band = np.floor(np.log(np.maximum(n, 1)) / np.log(1.25)).astype(np.uint64)
        keys = np.stack([mixed(mixed(least[i], j) + least[j] + band, 30 + i) for i, j in STAR_PAIRS], axis=1)
        offsets = pa.array(np.arange(len(n) + 1, dtype=np.int32) * len(STAR_PAIRS))
        columns = [
            batch.column("doc_id"), pa.array(node.view(np.int64), mask=n == 0), pa.array(n.astype(np.int64)),
            pa.array(least[0].view(np.int64), mask=n == 0),
            pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64).ravel())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "n", "least", "keys"])

    rows = _texts(docs).mapInArrow(
        over_slices(work), "doc_id long, node long, n long, least long, keys array<long>"
    )
    return stored(rows, "shingle-sets")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))


def prefix_length(n: np.ndarray, similarity: int) -> np.ndarray:
    return n - (similarity * n + 99) // 100 + 1


# the order of tokens, and prefixes

def _first(tokens: np.ndarray, n: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which tokens are among the first ``most`` of their set."""
    return np.arange(len(tokens)) - np.repeat(np.cumsum(n) - n, n) < np.repeat(most, n)


def frequent_tokens(
    docs: DataFrame, shingle: int, similarity: int, frequent: int, most_sent: int
) -> np.ndarray:
    """Ascending: the tokens among the first tokens (one and a half prefixes) of more than
    ``frequent`` documents; of more, if those were above ``most_sent``."""

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        tokens, n = token_sets(texts, shingle)
        early = tokens[_first(tokens, n, prefix_length(n, similarity) * 3 // 2)]
        value, count = np.unique(early, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(value.view(np.int64)), pa.array(count.astype(np.int64))], names=["token", "count"]
        )

    counts = docs.select("text").mapInArrow(over_slices(work), "token long, count long")
    held = stored(
        counts.groupBy("token").agg(F.sum("count").alias("count")).where(F.col("count") > frequent),
        "frequent-tokens",
    )
    while held.where(F.col("count") > frequent).count() > most_sent:
        frequent *= 2
    return _sent(held.where(F.col("count") > frequent))


def _sent(tokens: DataFrame) -> np.ndarray:
    """A measured number of tokens, ascending, for the tasks."""
    return np.sort(tokens.select("token").toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64))


def _among(tokens: np.ndarray, held: np.ndarray) -> np.ndarray:
    if not len(held):
        return np.zeros(len(tokens), bool)
    return held[np.minimum(np.searchsorted(held, tokens), len(held) - 1)] == tokens


def prefixes(texts: pa.Array, shingle: int, similarity: int, late: np.ndarray) -> tuple[np.ndarray, ...]:
    """(token, node, place from 1) of the prefixes of all sets of a slice, each set once."""
    tokens, n = token_sets(texts, shingle)
    some, names = set_names(tokens, n)
    _, once = np.unique(names, return_index=True)
    keep = np.zeros(len(n), bool)
    keep[some[once]] = True
    tokens, n = tokens[np.repeat(keep, n)], n[keep]
    names = names[np.sort(once)]
    doc = np.repeat(np.arange(len(n)), n)
    last = _among(tokens, late)
    if last.any():  # stable: by hash among the frequent and among the others
        tokens = tokens[np.argsort(2 * doc + last, kind="stable")]
    first = _first(tokens, n, prefix_length(n, similarity))
    place = np.arange(1, len(tokens) + 1) - np.repeat(np.cumsum(n) - n, n)
    return tokens[first], names[doc[first]], place[first]


def shared_tokens(docs: DataFrame, shingle: int, similarity: int, late: np.ndarray) -> DataFrame:
    """``token``: in the prefixes of two sets or more. Stored."""

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        tokens, nodes, _ = prefixes(texts, shingle, similarity, late)
        order = np.argsort(tokens, kind="stable")
        tokens, nodes = tokens[order], nodes[order].view(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else order
        low, high = (f.reduceat(nodes, starts) if len(starts) else nodes for f in (np.minimum, np.maximum))
        # one node alone is written once
        return pa.RecordBatch.from_arrays(
            [pa.array(tokens[starts].view(np.int64)), pa.array(low), pa.array(high, mask=low == high)],
            names=["token", "low", "high"],
        )

    rows = docs.select("text").mapInArrow(over_slices(work), "token long, low long, high long")
    spread = rows.groupBy("token").agg(F.min("low").alias("low"), F.max(F.coalesce("high", "low")).alias("high"))
    return stored(spread.where("low < high").select("token"), "shared-tokens")


def prefix_rows(
    docs: DataFrame, shingle: int, similarity: int, late: np.ndarray, shared: DataFrame, most_sent: int
) -> DataFrame:
    """``token, node, place``, each once, of the shared tokens (of all, if there are too many
    to send: a token that one node alone has makes no candidate). Stored."""
    wanted = _sent(shared) if measured_size(shared)[0] <= most_sent else None

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        found = prefixes(texts, shingle, similarity, late)
        if wanted is not None:
            held = _among(found[0], wanted)
            found = tuple(f[held] for f in found)
        columns = [pa.array(found[0].view(np.int64)), pa.array(found[1].view(np.int64)), pa.array(found[2], pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names=["token", "node", "place"])

    rows = docs.select("text").mapInArrow(over_slices(work), "token long, node long, place int")
    return stored(rows.distinct(), "matrix-rows")


# opening groups

def sets_of(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """``node, tokens`` (as bytes) of ``nodes`` (node, ``rep``: the least id that has it),
    made from the texts of those ids."""
    texts = _texts(docs)
    ids = size_checked(nodes.where("rep is not null").select(F.col("rep").alias("doc_id")).distinct())
    rows = texts.join(ids, "doc_id", "left_semi")
    if not nodes.where("rep is null").isEmpty():
        rows = rows.unionByName(texts.where("doc_id is null"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch, texts in slices(batches):
            tokens, n = token_sets(texts, shingle)
            some, names = set_names(tokens, n)
            ends = np.cumsum(n)
            out: list[tuple[int, bytes]] = []
            for d, name in zip(some.tolist(), names.view(np.int64).tolist()):
                if name not in seen:
                    seen.add(name)
                    out.append((name, tokens[ends[d] - n[d] : ends[d]].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())],
                names=["node", "tokens"],
            )
            del batch, texts, out
            give_back()

    return rows.mapInArrow(work, "node long, tokens binary")


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of a column of sets, and the number of each set."""
    data, at = raw(column.cast(pa.large_binary()))
    return np.frombuffer(data.tobytes(), np.uint64), np.diff(at) // 8


def opened(
    docs: DataFrame, pairs: DataFrame, members: DataFrame, nodes: DataFrame,
    shingle: int, similarity: int, query_tokens: int = QUERY_TOKENS,
) -> DataFrame:
    """Links ``a, b`` that join all queries and members which link, transitively.

    ``pairs``: ``node, n, group``; ``members``: ``group, node``, bounded in tokens; ``nodes``:
    ``node, rep``. A group with more tokens of queries than ``query_tokens`` is compared in
    parts.
    """
    asked = pairs.groupBy("group").agg(F.sum("n").alias("asked")).select(
        "group", F.ceil(F.col("asked") / query_tokens).cast("int").alias("parts")
    )
    asked = size_checked(stored(asked, "asked-groups"))
    pairs = pairs.join(asked, "group").select(
        "node", "group", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role")
    )
    held = members.join(asked, "group").select(
        "node", "group", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role")
    )
    both = stored(pairs.unionByName(held), "asked-members")
    wanted = stored(nodes.select("node", "rep").join(both.select("node").distinct(), "node"), "asked-nodes")
    rows = sets_of(docs, wanted, shingle).join(size_checked(both), "node")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, now = 0, None
        for batch in batches:
            at = 0
            key = np.stack([batch.column("group").to_numpy(), batch.column("part").to_numpy().astype(np.int64)], 1)
            while at < len(key):
                same = (key[at:] == key[at]).all(axis=1)
                end = len(key) if same.all() else at + int(np.argmin(same))
                if now is not None and tuple(key[at]) != now:
                    yield from compared(held, similarity)
                    held, size = [], 0
                now = tuple(key[at])
                held.append(batch.slice(at, end - at))
                at = end
        if held:
            yield from compared(held, similarity)

    return (
        rows.repartition("group", "part").sortWithinPartitions("group", "part", "role", "node")
        .mapInArrow(work, "a long, b long")
    )


def compared(batches: list[pa.RecordBatch], similarity: int) -> Iterator[pa.RecordBatch]:
    """The links of one group's run: members first, then queries."""
    rows = pa.Table.from_batches(batches).combine_chunks()
    role, nodes = rows.column("role").to_numpy(), rows.column("node").to_numpy()
    # rows of a repeated id make a set more than once
    first = np.ones(len(nodes), bool)
    first[1:] = (nodes[1:] != nodes[:-1]) | (role[1:] != role[:-1])
    if not first.all():
        rows, role, nodes = rows.filter(pa.array(first)).combine_chunks(), role[first], nodes[first]
    tokens, n = _tokens(rows.column("tokens").chunk(0))
    split = int(np.searchsorted(role, 1))
    if split in (0, len(role)):
        return
    ends = np.concatenate([[0], np.cumsum(n)])
    union, column = np.unique(tokens[: ends[split]], return_inverse=True)
    owner = np.repeat(np.arange(split), n[:split])
    by_token = np.argsort(column, kind="stable")
    owner = owner[by_token]
    begins = np.searchsorted(column[by_token], np.arange(len(union) + 1))
    degree = np.diff(begins)
    # queries: their tokens in the union bound every overlap
    asked = tokens[ends[split] :]
    query = np.repeat(np.arange(len(n) - split), n[split:])
    at = np.minimum(np.searchsorted(union, asked), len(union) - 1)
    hit = union[at] == asked
    at, query = at[hit], query[hit]
    sizes, own = n[split:], np.sort(n[:split])
    bound = np.bincount(query, minlength=len(sizes))
    # the smallest member whose size can fit
    fitting = np.searchsorted(own, -(-similarity * sizes // 100))
    fits = fitting < split
    smallest = own[np.minimum(fitting, split - 1)]
    fits &= similarity * smallest <= 100 * sizes
    need = -(-similarity * (sizes + smallest) // (100 + similarity))
    qualifies = fits & (bound >= need)
    keep = qualifies[query]
    at, query = at[keep], query[keep]
    if not len(at):
        return
    names, links = np.arange(split), []
    known = {int(v): i for i, v in enumerate(nodes[:split].tolist())}
    work = np.cumsum(degree[at])
    start = 0
    while start < len(at):
        # whole queries, as many as make a bounded number of matches
        end = int(np.searchsorted(work, (work[start - 1] if start else 0) + _PAIRS, side="right"))
        end = max(end, start + 1)
        last = query[min(end, len(query) - 1)]
        cut = int(np.searchsorted(query, last)) if end < len(query) else len(query)
        if cut <= start:
            cut = int(np.searchsorted(query, query[start], side="right"))
        a, q = at[start:cut], query[start:cut]
        times = degree[a]
        flat = np.repeat(begins[a], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        pair, overlap = np.unique(np.repeat(q, times) * split + owner[flat], return_counts=True)
        of, member = pair // split, pair % split
        linked = (100 + similarity) * overlap >= similarity * (n[split:][of] + n[:split][member])
        linked &= nodes[split:][of] != nodes[:split][member]
        of, member = of[linked], member[linked]
        firsts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else of
        for first, reached in zip(firsts.tolist(), np.split(member, firsts[1:])):
            node = int(nodes[split + of[first]])
            others = np.unique(names[reached])
            inside = known.get(node)
            if inside is not None:
                others = others[others != names[inside]]
            if not len(others):
                continue
            links += [(node, int(nodes[m])) for m in others.tolist()]
            names[np.isin(names, others)] = names[inside] if inside is not None else others[0]
        start = cut
    if links:
        ends = [pa.array([link[k] for link in links], pa.int64()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])


# the search

def star_links(docs: DataFrame, nodes: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """Links of nodes with the least node that has one of their keys. Stored."""
    flat = stored(nodes.select("node", "n", F.posexplode("keys").alias("k", "key")), "star-keys")
    centres = flat.groupBy("k", "key").agg(
        F.min(F.struct("node", "n")).alias("centre"), F.count(F.lit(1)).alias("count")
    )
    centres = stored(
        centres.where("count > 1").select("k", "key", F.col("centre.node").alias("group"), F.col("centre.n").alias("of")),
        "stars",
    )
    sized = (100 * F.least("n", "of") >= similarity * F.greatest("n", "of")) & (F.col("node") != F.col("group"))
    pairs = flat.join(size_checked(centres), ["k", "key"]).where(sized).select("node", "n", "group").distinct()
    pairs = stored(pairs, "star-pairs")
    members = pairs.select("group", F.col("group").alias("node")).distinct()
    return stored(opened(docs, pairs, members, nodes, shingle, similarity), "star-links")


def grouped(held: DataFrame, group_tokens: int) -> DataFrame:
    """``node, n, comp, several, group``: nodes of ``held`` (node, n, least, comp) in groups of
    bounded tokens; groups of a component of several nodes (``several``) hold no others.
    Stored."""
    several = held.groupBy("comp").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("count"))
    several = stored(several.where("count > 1").select("comp", "size"), "components-of-several")
    rows = held.join(size_checked(several), "comp", "left").withColumn("several", F.col("size").isNotNull())
    rest = rows.where(~F.col("several")).groupBy("least").agg(F.sum("n").alias("of_least"))
    rest = stored(rest.where(F.col("of_least") > group_tokens), "crowded")
    rows = rows.join(size_checked(rest), "least", "left")
    parts = F.ceil(F.coalesce("size", "of_least", F.lit(1)) / group_tokens)
    salt = F.pmod(F.xxhash64("node"), parts)
    group = F.xxhash64("several", F.when(F.col("several"), F.col("comp")).otherwise(F.col("least")), salt)
    return stored(rows.select("node", "n", "comp", "several", group.alias("group")), "groups")


def candidates(rows: DataFrame, groups: DataFrame, similarity: int) -> DataFrame:
    """``node, n, group``: the groups each node has to be compared with; ``rows`` are the
    (token, node) of prefixes."""
    met = rows.join(size_checked(groups), "node")
    shared = met.groupBy("token").agg(F.min("comp").alias("a"), F.max("comp").alias("b"))
    shared = stored(shared.where("a <> b").select("token"), "met-tokens")
    met = stored(met.join(size_checked(shared), "token", "left_semi"), "met-rows")
    # the matrix: one row for each token and group
    matrix = met.groupBy("token", "group").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("place").alias("first"),
        F.first("several").alias("single"), F.min("comp").alias("of"), F.count(F.lit(1)).alias("many"),
    )
    mains = (
        met.where("several").groupBy("token", "comp").count()
        .groupBy("token").agg(F.max_by("comp", F.struct("count", "comp")).alias("main"))
    )
    asking = met.join(mains, "token", "left").where(~F.col("comp").eqNullSafe(F.col("main"))).select(
        "token", "node", "n", "place", "comp", "main", F.col("group").alias("own")
    )
    foreign = ~(F.col("single") & (F.col("of") == F.col("comp")))
    # of two groups the one of lower number asks, but everyone asks those of the main component
    once = (
        (F.col("single") & F.coalesce(F.col("of") == F.col("main"), F.lit(False)))
        | (F.col("own") < F.col("group")) | ((F.col("own") == F.col("group")) & (F.col("many") > 1))
    )
    # sizes of members that can link, and the overlap that the least and the largest demand;
    # the first token two sets share has this overlap at and after it, on both sides
    low = F.greatest("low", F.ceil(F.col("n") * similarity / 100))
    high = F.least("high", F.floor(F.col("n") * 100 / similarity))

    def demanded(other: Column) -> Column:
        return F.ceil((F.col("n") + other) * similarity / (100 + similarity))

    room = (
        (low <= high) & (F.col("n") - F.col("place") + 1 >= demanded(low))
        & (high - F.col("first") + 1 >= demanded(high))
    )
    return asking.join(matrix, "token").where(foreign & once & room).select("node", "n", "group").distinct()


def links(
    docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY,
    frequent: int = FREQUENT, most_sent: int = MOST_SENT, group_tokens: int = GROUP_TOKENS,
    query_tokens: int = QUERY_TOKENS,
) -> tuple[DataFrame, DataFrame]:
    """The stored sets of documents, and links ``a, b`` that join all nodes that link,
    transitively."""
    made = sets(docs, shingle)
    nodes = made.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("n", "least", "keys")]
    )
    nodes = stored(nodes, "set-nodes")
    stars = star_links(docs, nodes, shingle, similarity)
    roots = size_checked(components(stars).select("node", F.col("root").alias("comp")))
    held = nodes.join(roots, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    groups = grouped(held, group_tokens)
    late = frequent_tokens(docs, shingle, similarity, frequent, most_sent)
    shared = shared_tokens(docs, shingle, similarity, late)
    rows = prefix_rows(docs, shingle, similarity, late, shared, most_sent)
    pairs = stored(candidates(rows, groups, similarity), "candidates")
    wanted = size_checked(pairs.select("group").distinct())
    members = groups.select("group", "node").join(wanted, "group", "left_semi")
    found = opened(docs, pairs, members, nodes, shingle, similarity, query_tokens)
    return made, stars.unionByName(stored(found, "group-links"))


def joined(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_shingles, component_id``; the options are those of ``links``."""
    made, found = links(docs, **options)
    roots = size_checked(components(found))
    of = made.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    of = stored(of.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "set-roots")
    named = of.groupBy("root").agg(F.min("least").alias("component_id"))
    named = size_checked(stored(of.join(named, "root").select("node", "component_id"), "set-components"))
    rows = made.select("doc_id", "node", F.col("n").alias("n_shingles"))
    linked = rows.join(named, "node").select("doc_id", "n_shingles", "component_id")
    return linked.unionByName(
        rows.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    )


ORACLE_SQL = r"""
with recursive words as materialized (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') as w
  from documents
),
shingles as materialized (
  select distinct r, array_to_string(w[i : i + 4], ' ') as s
  from words, range(1, greatest(len(w) - 4, least(len(w), 1)) + 1) as t(i)
),
sizes as materialized (select r, count(*) as n from shingles group by r),
links as materialized (
  select a.r as x, b.r as y from shingles a join shingles b using (s)
  where a.r <> b.r group by a.r, b.r
  having 180 * count(*) >= 80 * ((select n from sizes where r = a.r) + (select n from sizes where r = b.r))
),
reached(r, other) as (
  select r, r from words
  union
  select reached.r, y from reached join links on x = other
)
select w.doc_id, coalesce(n, 0)::bigint as n_shingles, c.component_id
from words w left join sizes using (r) join (
  select reached.r, min(v.doc_id) as component_id from reached join words v on v.r = other group by reached.r
) c using (r)"""

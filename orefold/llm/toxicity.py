"""Toxicity: a linear-chain conditional random field tags toxic tokens of each text.

Tokens are runs of ASCII letters, digits and bytes above 0x7F, in lower case. Their
features are the word and its first 3 to 6 bytes. Labels of tokens come from labels of
documents: a feature counts as a marker if it is many times more frequent, by documents,
among toxic ones; a token with a marker is labelled toxic in a toxic document, every other
token is not. The field has two states, a weight for each marker and for each transition,
and is fitted in numpy by the gradient of the log-likelihood (forward-backward).

Scoring runs forward-backward over every token of every text. The marginals give the
offending spans (``SPAN`` or more) and, by a logistic function fitted on the documents'
labels, the score: of the largest marginal and of the sum of those above ``FAINT``. Tokens
without a marker share one emission, so a text without markers only depends on its number
of tokens, and beyond ``FLAT`` tokens no longer on that.

Fitting uses at most ``SAMPLE`` labelled documents of each class, chosen by a hash of the
id, at most ``MAX_MARKERS`` markers, and windows of ``REACH`` tokens around markers.

Defined results: a null or empty text has the score of a text without tokens; with no
toxic or no other labelled document the score is 0; a document labelled twice is toxic if
one label says so; repeated rows are scored one by one; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.llm.common import LOWER, Words, first_by_hash, over_slices, raw, stored

SAMPLE = {1: 3000, 0: 6000}
MAX_MARKERS = 20_000
PREFIXES = (3, 4, 5, 6)
#: A marker is in at least this many sampled toxic documents, and this share of them.
LEAST_DOCS, LEAST_SHARE = 4, 0.004
#: Its share among other documents is at most this part of that among toxic ones.
MOST_RATIO = 0.02
REACH, STEPS, RATE, DECAY = 8, 120, 0.15, 1e-3
SPAN, FAINT, FLAT = 0.5, 0.1, 256

INSIDE = np.zeros(256, bool)
INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(word: bytes) -> list[bytes]:
    return [b"w" + word, *(b"%d" % n + word[:n] for n in PREFIXES if len(word) > n)]


def tokens(texts: pa.Array) -> tuple[Words, list[bytes], np.ndarray]:
    """Places of all tokens, the distinct ones, and which of these each token is."""
    data, at = raw(texts)
    words = Words(data, at, INSIDE)
    ends = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int64)
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(words.starts),
        [None, pa.py_buffer(ends), pa.py_buffer(LOWER[data[INSIDE[data]]])],
    )
    coded = flat.dictionary_encode()
    return words, coded.dictionary.to_pylist(), coded.indices.to_numpy()


# the field

@dataclass
class Field:
    """Log-potentials of state 1 against state 0: ``weights`` of the markers, ``bias`` of
    any token; ``moves``: 0 to 1, 1 to 0, 1 to 1, against 0 to 0. ``head``: logistic."""

    markers: dict[bytes, int]
    weights: np.ndarray
    bias: float
    moves: np.ndarray
    head: np.ndarray

    def emissions(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of distinct words: the emission, and whether there is a marker."""
        out, marked = np.full(len(words), self.bias), np.zeros(len(words), bool)
        get = self.markers.get
        for k, word in enumerate(words):
            found = [m for f in features(word) if (m := get(f)) is not None]
            if found:
                out[k] += self.weights[found].sum()
                marked[k] = True
        return out, marked


def messages(emission: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages of equally long chains (rows, tokens), as the ratio of
    state 1 to state 0: two states need one number each."""
    n, length = emission.shape
    e = np.exp(np.clip(emission, -30, 30))
    m01, m10, m11 = np.exp(moves)
    ahead, back = np.empty((length, n)), np.empty((length, n))
    r = ahead[0] = e[:, 0]
    for t in range(1, length):
        r = ahead[t] = e[:, t] * (m01 + r * m11) / (1 + r * m10)
    r = back[length - 1] = np.ones(n)
    for t in range(length - 2, -1, -1):
        g = r * e[:, t + 1]
        r = back[t] = (m10 + m11 * g) / (1 + m01 * g)
    return ahead.T, back.T


def marginals(emission: np.ndarray, moves: np.ndarray) -> np.ndarray:
    ahead, back = messages(emission, moves)
    odds = ahead * back
    return odds / (1 + odds)


def ragged_marginals(emission: np.ndarray, counts: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """For chains back to back, all at once: each step moves the chains that are long enough."""
    out = np.zeros(len(emission))
    if not len(emission):
        return out
    order = np.argsort(-counts, kind="stable")
    size = counts[order]
    start = (np.cumsum(counts) - counts)[order]
    e = np.exp(np.clip(emission, -30, 30))
    m01, m10, m11 = np.exp(moves)
    active = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")
    r = np.zeros(0)
    for t, n in enumerate(active.tolist()):
        at = start[:n] + t
        r = out[at] = e[at] if t == 0 else e[at] * (m01 + r[:n] * m11) / (1 + r[:n] * m10)
    stop = start + size - 1
    r = np.zeros(0)
    for t, n in enumerate(active.tolist()):
        if t:
            g = r[:n] * e[stop[:n] - t + 1]
            r = (m10 + m11 * g) / (1 + m01 * g)
        else:
            r = np.ones(n)
        out[stop[:n] - t] *= r
    return out / (1 + out)


def fit_field(markers: list[bytes], docs: list[tuple]) -> Field | None:
    """From sampled documents ``(toxic, n_tokens, positions, markers at each position)``."""
    if len({d[0] for d in docs}) < 2 or not markers:
        return None
    rng = np.random.default_rng(5)
    width, rows, labels, used = 2 * REACH + 1, [], [], []
    for toxic, n, positions, found in docs:
        spots = dict(zip(positions, found))
        centres = positions if positions else [int(rng.integers(0, max(n, 1)))] if n else []
        last = -width
        for c in centres[:: max(len(centres) // 8, 1)]:
            if c - last < REACH:
                continue
            last = c
            window = [spots.get(c - REACH + k, ()) for k in range(width)]
            inside = [0 <= c - REACH + k < n for k in range(width)]
            rows.append(window)
            labels.append([int(bool(w) and toxic) for w in window])
            used.append(inside)
    y, mask = np.array(labels, float), np.array(used)
    where = [(i, t, m) for i, w in enumerate(rows) for t, ms in enumerate(w) for m in ms]
    at = np.array(where, np.int64).reshape(-1, 3)
    field = Field({m: k for k, m in enumerate(markers)}, np.zeros(len(markers)), -2.0, np.zeros(3), np.zeros(3))
    first, second = np.zeros(len(markers) + 4), np.zeros(len(markers) + 4)
    for step in range(1, STEPS + 1):
        emission = np.full(y.shape, field.bias)
        np.add.at(emission, (at[:, 0], at[:, 1]), field.weights[at[:, 2]])
        emission[~mask] = -30.0  # places beyond the text
        ahead, back = messages(emission, field.moves)
        odds = ahead * back
        error = (odds / (1 + odds) - y) * mask
        # pairwise marginals of states at t, t + 1
        left, right = ahead[:, :-1], back[:, 1:] * np.exp(np.clip(emission[:, 1:], -30, 30))
        pair = np.stack([right, left, left * right], axis=2) * np.exp(field.moves)
        pair /= 1 + pair.sum(axis=2, keepdims=True)
        seen = np.stack([(1 - y[:, :-1]) * y[:, 1:], y[:, :-1] * (1 - y[:, 1:]), y[:, :-1] * y[:, 1:]], axis=2)
        both = (mask[:, :-1] & mask[:, 1:])[:, :, None]
        grad = np.concatenate(
            [
                np.bincount(at[:, 2], error[at[:, 0], at[:, 1]], len(markers)),
                [error.sum()],
                ((pair - seen) * both).sum(axis=(0, 1)),
            ]
        ) / len(y)
        params = np.concatenate([field.weights, [field.bias], field.moves])
        grad += DECAY * params / len(params) ** 0.5
        first += 0.1 * (grad - first)
        second += 0.01 * (grad * grad - second)
        params -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        field.weights, field.bias, field.moves = params[:-4], float(params[-4]), params[-3:]
    # the documents' evidence, for the logistic function; texts without markers as in scoring
    sizes = np.array([d[1] if d[2] else min(d[1], FLAT) for d in docs], np.int64)
    start = np.cumsum(sizes) - sizes
    emission = np.full(int(sizes.sum()), field.bias)
    for s, (_, _, positions, found) in zip(start.tolist(), docs):
        for p, ms in zip(positions, found):
            emission[s + p] += field.weights[list(ms)].sum()
    p = ragged_marginals(emission, sizes, field.moves)
    evidence = summary(p, np.repeat(np.arange(len(docs)), sizes), len(docs))
    field.head = logistic(evidence, np.array([d[0] for d in docs], float))
    return field


def summary(p: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """(documents, 3): one, the largest marginal, the logarithm of the sum of clear ones."""
    top = np.zeros(docs)
    np.maximum.at(top, doc, p)
    clear = p >= FAINT
    total = np.bincount(doc[clear], p[clear], docs) if len(p) else np.zeros(docs)
    return np.stack([np.ones(docs), top, np.log1p(total)], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Newton's method; a small ridge keeps separable samples finite. Classes weigh the same."""
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    beta, ridge = np.zeros(x.shape[1]), 1e-2 * np.eye(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge @ beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(curve, grad)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return beta


# fitting on Spark rows

def sampled(docs: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """``text, toxic`` of a bounded number of labelled documents of each class."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("of"), F.col("toxic").cast("int").alias("toxic"))
        .where("toxic in (0, 1) and of is not null").groupBy("of").agg(F.max("toxic").alias("toxic"))
    )
    trained = docs.select("doc_id").where(usable).distinct()
    ids = known.join(trained, F.col("of") == F.col("doc_id").cast("long"), "left_semi")
    # at most the two samples' sizes, whatever the input
    chosen = F.broadcast(first_by_hash(stored(ids, "labelled"), "toxic", "of", SAMPLE))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        chosen, F.col("doc_id") == F.col("of")
    ).select("text", "toxic")


def marker_counts(sample: DataFrame) -> DataFrame:
    """``feature, n_toxic, n_other``: documents of each class that hold a feature."""

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        words, distinct, which = tokens(texts)
        toxic = np.array(batch.column("toxic").to_pylist(), np.int64)
        ids: dict[bytes, int] = {}
        held = [[ids.setdefault(f, len(ids)) for f in features(w)] for w in distinct]
        counts = np.zeros((2, len(ids)), np.int64)
        for d in range(len(texts)):
            own = np.unique(which[words.first[d] : words.first[d + 1]])
            counts[toxic[d], list({f for k in own.tolist() for f in held[k]})] += 1
        return pa.RecordBatch.from_arrays(
            [pa.array(list(ids), pa.binary()), pa.array(counts[1]), pa.array(counts[0])],
            names=["feature", "n_toxic", "n_other"],
        )

    return (
        sample.mapInArrow(over_slices(work), "feature binary, n_toxic long, n_other long")
        .groupBy("feature").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_other").alias("n_other"))
    )


def found_markers(sample: DataFrame, markers: list[bytes]) -> DataFrame:
    """``toxic, n_tokens, positions, found`` of sampled documents: tokens with markers."""
    known = {m: k for k, m in enumerate(markers)}

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        words, distinct, which = tokens(texts)
        held = [[k for f in features(w) if (k := known.get(f)) is not None] for w in distinct]
        some = np.array([bool(h) for h in held], bool)
        places, found = [], []
        for d in range(len(texts)):
            own = which[words.first[d] : words.first[d + 1]]
            spots = np.flatnonzero(some[own]) if len(own) else np.zeros(0, int)
            places.append(spots.tolist())
            found.append([held[k] for k in own[spots].tolist()])
        return pa.RecordBatch.from_arrays(
            [
                batch.column("toxic"), pa.array(words.counts.astype(np.int64)),
                pa.array(places, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.list_(pa.int32()))),
            ],
            names=["toxic", "n_tokens", "positions", "found"],
        )

    return sample.mapInArrow(
        over_slices(work), "toxic int, n_tokens long, positions array<int>, found array<array<int>>"
    )


def fitted(docs: DataFrame, labels: DataFrame, usable: Column) -> Field | None:
    """Fit on labelled documents for which ``usable`` holds."""
    sample = sampled(docs, labels, usable)
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    share = F.col("n_toxic") / sizes[1]
    markers = (
        marker_counts(sample)
        .where(F.col("n_toxic") >= max(LEAST_DOCS, int(LEAST_SHARE * sizes[1])))
        .where(F.col("n_other") / sizes[0] <= MOST_RATIO * share)
        .orderBy(F.desc(F.col("n_toxic") - F.col("n_other")), "feature").limit(MAX_MARKERS)
    )
    names = [bytes(r["feature"]) for r in markers.collect()]
    rows = [tuple(r) for r in found_markers(sample, names).collect()]
    return fit_field(names, sorted(rows, key=repr))


# scoring

def scored_slice(field: Field | None, texts: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Scores, and spans ``start:end`` in code points of runs of toxic tokens."""
    n = len(texts)
    if field is None:
        return np.zeros(n), [""] * n
    words, distinct, which = tokens(texts)
    emission, marked = field.emissions(distinct)
    counts = words.counts
    has = np.bincount(words.doc[marked[which]], minlength=n) > 0 if len(which) else np.zeros(n, bool)
    evidence = np.tile([1.0, 0.0, 0.0], (n, 1))
    # texts without markers, by their number of tokens
    plain = np.minimum(counts, FLAT)
    for size in np.unique(plain[~has]).tolist():
        if size:
            p = marginals(np.full((1, size), field.bias), field.moves)[0]
            evidence[~has & (plain == size)] = summary(p, np.zeros(size, int), 1)[0]
    spans = [""] * n
    if has.any():
        mine = has[words.doc]
        doc = (np.cumsum(has) - 1)[words.doc[mine]]
        p = ragged_marginals(emission[which[mine]], counts[has], field.moves)
        evidence[has] = summary(p, doc, int(has.sum()))
        hot = np.flatnonzero(mine)[p >= SPAN]
        if len(hot):
            begins = np.concatenate([[True], (np.diff(hot) > 1) | (words.doc[hot[1:]] != words.doc[hot[:-1]])])
            first, last = hot[begins], hot[np.concatenate([begins[1:], [True]])]
            data, at = raw(texts)
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            base = points[at[words.doc[first]]]
            for d, a, b in zip(
                words.doc[first].tolist(),
                (points[words.starts[first]] - base).tolist(),
                (points[words.ends[last]] - base).tolist(),
            ):
                spans[d] += f"{',' if spans[d] else ''}{a}:{b}"
    score = 1 / (1 + np.exp(-np.clip(evidence @ field.head, -30, 30)))
    return score, spans


def scored(docs: DataFrame, field: Field | None, extra: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id``, the extra columns, ``score``, ``predicted`` and ``spans`` per document."""
    held = docs.select(F.col("doc_id").cast("long"), "text", *[c.alias(n) for n, c in (extra or {}).items()])
    kept = [c for c in held.columns if c != "text"]
    schema = ", ".join(f"`{c}` {t}" for c, t in held.dtypes if c != "text")

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        score, spans = scored_slice(field, texts)
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in kept]
            + [pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(spans, pa.string())],
            names=[*kept, "score", "predicted", "spans"],
        )

    return held.mapInArrow(over_slices(work), f"{schema}, score double, predicted int, spans string")

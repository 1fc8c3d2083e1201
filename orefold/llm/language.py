"""Language ID with a bidirectional gated recurrent network over bytes.

The network reads a word's bytes from both sides and labels every position; a document's
distribution is the mean of the labels' distributions over all positions of all its words.
States start anew at each word (white space, digits and ASCII punctuation separate words),
so equal words have equal labels: each slice of texts labels its distinct words once and
adds them up by their counts, which is the same sum with a fraction of the work. Learning and
labelling read words in lower case, in every script that has one. Words of more than ``PIECE`` bytes are read in pieces of that size.

Training is numpy on the driver, by backpropagation through time over the words of at most
``SAMPLE`` labelled documents per language, chosen by a hash of the id; of these the most
frequent words are taken, ``MAX_WORDS`` times the number of languages. All languages are
learned, with more steps for more than ``FEW_LANGS``. Everything else covers all rows.

Defined results: ``und`` with score 0 if a text is null or has no letter, or nothing could
be learned; repeated rows are scored one by one; ties go to the first language by name;
null languages are not learned from; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orefold.llm.common import LOWER, Words, over_slices, raw, remembered

UNKNOWN = "und"
HIDDEN = 8
PIECE = 24
SAMPLE, MAX_WORDS = 300, 20_000
#: Languages that ``STEPS`` and the sizes kept in memory are meant for; more get more steps
#: and as much memory.
FEW_LANGS = 32
STEPS, BATCH, RATE, SEED = 900, 192, 0.02, 3
#: A document is rejected below this share for its language, or without any letter.
LEAST_SCORE = 0.35
_ROWS = 4096
#: Distinct words that a worker remembers; beyond it, it starts anew.
REMEMBERED = 150_000
#: Bytes of text labelled at a time: larger slices repeat more words, smaller ones need less.
WHOLE_SLICE = 1024 * 1024

#: What separates words: white space, digits, ASCII punctuation, control characters.
INSIDE = np.zeros(256, bool)
INSIDE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Network:
    """``tables[d]``: gate inputs of each byte (256, 3H) for reading direction d; ``loops[d]``
    (H, 3H) and ``biases[d]`` (H,) for the candidate's own loop; ``out`` (2H, classes)."""

    langs: list[str]
    tables: list[np.ndarray]
    loops: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def states(self, x: np.ndarray, direction: int, keep: list | None = None) -> np.ndarray:
        """(positions, rows, H) of byte matrix ``x`` (rows, positions)."""
        n, length = x.shape
        h = self.loops[0].shape[0]
        table, loop = self.tables[direction], self.loops[direction]
        state = np.zeros((n, h), np.float32)
        made = np.empty((length, n, h), np.float32)
        for t in range(length)[:: 1 - 2 * direction]:
            given = table[x[:, t]]
            own = state @ loop
            gates = _sigmoid(given[:, : 2 * h] + own[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            new = np.tanh(given[:, 2 * h :] + reset * own[:, 2 * h :])
            if keep is not None:
                keep.append((t, state, update, reset, own[:, 2 * h :], new))
            state = new + update * (state - new)
            made[t] = state
        return made

    def labels(self, x: np.ndarray) -> np.ndarray:
        """(rows, classes): the labels' distributions, summed over positions."""
        both = np.concatenate([self.states(x, 0), self.states(x, 1)], axis=2)
        return _softmax(both @ self.out + self.bias).sum(axis=0)


def _sigmoid(a: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * a))


def _softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


# training

def train(samples: list[tuple[str, bytes, int]], steps: int = STEPS, seed: int = SEED) -> Network | None:
    """From (language, word, count); None if there is nothing to learn."""
    langs = sorted({s[0] for s in samples})
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    h, c = HIDDEN, len(langs)
    net = Network(
        langs,
        [rng.normal(0, 0.3, (256, 3 * h)).astype(np.float32) for _ in range(2)],
        [rng.normal(0, 1 / np.sqrt(h), (h, 3 * h)).astype(np.float32) for _ in range(2)],
        rng.normal(0, 0.1, (2 * h, c)).astype(np.float32),
        np.zeros(c, np.float32),
    )
    pieces = [(langs.index(g), w[i : i + PIECE], n) for g, w, n in samples for i in range(0, len(w), PIECE)]
    by_length: dict[int, list] = {}
    for p in pieces:
        by_length.setdefault(len(p[1]), []).append(p)
    groups = []
    for length, some in sorted(by_length.items()):
        x = np.frombuffer(b"".join(p[1] for p in some), np.uint8).reshape(-1, length)
        y = np.array([p[0] for p in some])
        # languages weigh the same; frequent words are damped
        weight = np.array([p[2] for p in some], float) ** 0.75
        groups.append((x, y, weight))
    total = np.zeros(c)
    for x, y, weight in groups:
        np.add.at(total, y, weight * x.shape[1])
    groups = [(x, y, weight / total[y]) for x, y, weight in groups]
    mass = np.array([g[2].sum() * g[0].shape[1] for g in groups])
    params = [*net.tables, *net.loops, net.out, net.bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    cumulative = [np.cumsum(g[2]) / g[2].sum() for g in groups]
    for step in range(1, steps + 1):
        k = rng.choice(len(groups), p=mass / mass.sum())
        x, y, _ = groups[k]
        rows = np.minimum(np.searchsorted(cumulative[k], rng.random(BATCH)), len(x) - 1)
        grads = _gradients(net, x[rows], y[rows])
        rate = RATE * (1 - step / (steps + 1))
        for p, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net


def _gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy over all positions."""
    n, length = x.shape
    h = net.loops[0].shape[0]
    kept: list[list] = [[], []]
    both = np.concatenate([net.states(x, d, kept[d]) for d in range(2)], axis=2)
    error = _softmax(both @ net.out + net.bias)
    error[:, np.arange(n), y] -= 1
    error /= n * length
    d_out = both.reshape(-1, 2 * h).T @ error.reshape(-1, error.shape[2])
    d_bias = error.sum(axis=(0, 1))
    back = error @ net.out.T
    d_tables, d_loops = [], []
    for d in range(2):
        table, loop = np.zeros_like(net.tables[d]), np.zeros_like(net.loops[d])
        carried = np.zeros((n, h), np.float32)
        for t, before, update, reset, own, new in reversed(kept[d]):
            g = carried + back[t][:, d * h : (d + 1) * h]
            g_new = g * (1 - update) * (1 - new * new)
            g_update = g * (before - new) * update * (1 - update)
            g_reset = g_new * own * reset * (1 - reset)
            g_gates = np.concatenate([g_update, g_reset], axis=1)
            np.add.at(table, x[:, t], np.concatenate([g_gates, g_new], axis=1))
            g_own = np.concatenate([g_gates, g_new * reset], axis=1)
            loop += before.T @ g_own
            carried = g * update + g_own @ net.loops[d].T
        d_tables.append(table)
        d_loops.append(loop)
    return [*d_tables, *d_loops, d_out, d_bias]


def training_words(labelled: DataFrame, sample: int = SAMPLE) -> list[tuple[str, bytes, int]]:
    """(language, word, count) of a bounded sample; ``labelled`` has ``doc_id, text, lang``."""
    narrow = labelled.select("doc_id", "lang")
    sizes = narrow.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    langs = sizes.count()
    if not langs:
        return []
    # a cut by hash leaves about twice the wanted rows of each language; only these are ranked
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    near = narrow.join(F.broadcast(sizes), "lang").where(
        place <= (F.least(F.lit(1.0), F.lit(2.0 * sample) / F.col("n")) * (1 << 30)).cast("long")
    )
    ranked = Window.partitionBy("lang").orderBy(place, "doc_id")
    chosen = near.withColumn("nth", F.row_number().over(ranked)).where(F.col("nth") <= sample)
    words = (
        labelled.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
        .select("lang", F.explode(F.split(F.lower("text"), r"[\x00-\x40\x5B-\x60\x7B-\x7F]+")).alias("word"))
        .where("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    )
    rows = words.orderBy(F.desc("n"), "lang", "word").limit(MAX_WORDS * langs).collect()
    # in the lower case of the labelled words: that of Spark may differ for rare letters
    return sorted((r[0], lower_word(r[1].encode()), r[2]) for r in rows)


# labelling

class Labeller:
    """Labels of distinct words, remembered by a worker up to a number of words."""

    def __init__(self, net: Network) -> None:
        self.net, self.places = net, {}
        self.most = _fewer(REMEMBERED, net)
        self.sums = np.zeros((self.most, len(net.langs)), np.float32)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(words) > self.most:
            return word_labels(self.net, words)
        new = [w for w in words if w not in self.places]
        if len(self.places) + len(new) > self.most:
            self.places.clear()
            new = words
        start = len(self.places)
        self.places.update(zip(new, range(start, start + len(new))))
        self.sums[start : start + len(new)] = word_labels(self.net, new)
        return self.sums[[self.places[w] for w in words]]


def _fewer(rows: int, net: Network) -> int:
    """Rows of labels that take no more memory than ``rows`` of ``FEW_LANGS`` languages."""
    return max(rows * FEW_LANGS // max(FEW_LANGS, len(net.langs)), 1)


def labeller(net: Network) -> Labeller:
    """The worker's labeller for this network."""
    return remembered(_key(net), lambda: Labeller(net))


def _key(net: Network | None) -> bytes | None:
    return None if net is None else net.out.tobytes() + net.loops[0].tobytes()


def word_labels(net: Network, words: list[bytes]) -> np.ndarray:
    """For distinct words: labels summed over positions."""
    out = np.zeros((len(words), len(net.langs)), np.float32)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    whole = np.flatnonzero(sizes <= PIECE)
    pieces = [(k, words[k]) for k in whole.tolist()]
    for k in np.flatnonzero(sizes > PIECE).tolist():
        pieces += [(k, words[k][i : i + PIECE]) for i in range(0, sizes[k], PIECE)]
    lengths = np.fromiter((len(p[1]) for p in pieces), np.int64, len(pieces))
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    at_once = _fewer(_ROWS, net)
    for group in np.split(order, cuts):
        for i in range(0, len(group), at_once):
            some = group[i : i + at_once].tolist()
            if not some:
                continue
            x = np.frombuffer(b"".join(pieces[j][1] for j in some), np.uint8)
            made = net.labels(x.reshape(len(some), -1))
            np.add.at(out, [pieces[j][0] for j in some], made)
    return out


def document_shares(net: Network, texts: pa.Array) -> np.ndarray:
    """(texts, classes): mean distribution over all positions; zeros without any."""
    data, at = raw(texts)
    words = Words(data, at, INSIDE)
    body = LOWER[data[INSIDE[data]]]
    ends = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int64)
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(words.starts), [None, pa.py_buffer(ends), pa.py_buffer(body)]
    )
    coded = flat.dictionary_encode()
    distinct = [lower_word(w) for w in coded.dictionary.to_pylist()]
    # capitals of other scripts may make a word that the slice has in lower case too
    place: dict[bytes, int] = {}
    of = np.fromiter((place.setdefault(w, len(place)) for w in distinct), np.int64, len(distinct))
    labels = labeller(net)(list(place))
    which = of[coded.indices.to_numpy()]
    lengths = np.fromiter(map(len, place), np.int64, len(place))
    total = np.zeros((len(texts) + 1, labels.shape[1]))
    for c in range(labels.shape[1]):
        sums = np.concatenate([[0.0], np.cumsum(labels[which, c], dtype=np.float64)])
        total[:-1, c] = np.diff(sums[words.first])
    positions = np.diff(np.concatenate([[0], np.cumsum(lengths[which])])[words.first])
    return total[:-1] / np.maximum(positions, 1)[:, None]


def lower_word(word: bytes) -> bytes:
    """A word in lower case, in any script; A-Z are already."""
    return word if word.isascii() else word.decode("utf-8", "replace").lower().encode()


def has_letter(text: bytes) -> bool:
    """Any letter of any script; ASCII is settled without decoding."""
    if text.isascii():
        return bool(text) and not text.translate(None, _NOT_LETTERS) == b""
    return any(ch.isalpha() for ch in text.decode("utf-8", "replace"))


_NOT_LETTERS = bytes(b for b in range(256) if not (65 <= b < 91 or 97 <= b < 123))


def predictions(net: Network | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    if net is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    shares = document_shares(net, texts)
    best = shares.argmax(axis=1)
    score = np.clip(shares[np.arange(len(best)), best], 0.0, 1.0)
    lettered = np.array([has_letter(t) for t in texts.to_pylist()], bool)
    lang = [net.langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist())]
    return lang, np.where(lettered, score, 0.0)


def learned(docs: DataFrame, usable: Column) -> Network | None:
    """Train on rows where ``usable`` holds and the language is known."""
    rows = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    words = training_words(rows.select("doc_id", "text", F.col("lang").cast("string").alias("lang")))
    return train(words, STEPS * max(-(-len({w[0] for w in words}) // FEW_LANGS), 1))


def identified(docs: DataFrame, net: Network | None, extra: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id``, the extra columns, ``lang_pred`` and ``score`` for each document."""
    held = docs.select(
        F.col("doc_id").cast("long"), "text", *[c.alias(n) for n, c in (extra or {}).items()]
    )
    kept = [c for c in held.columns if c != "text"]
    schema = ", ".join(f"`{c}` {t}" for c, t in held.dtypes if c != "text")

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        lang, score = predictions(net, texts)
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in kept] + [pa.array(lang, pa.string()), pa.array(score)],
            names=[*kept, "lang_pred", "score"],
        )

    return held.mapInArrow(over_slices(work, WHOLE_SLICE, _key(net)), f"{schema}, lang_pred string, score double")


def accepted(docs: DataFrame, net: Network | None, least: float = LEAST_SCORE) -> DataFrame:
    """The documents with a known language and a score of ``least`` or more, unchanged.

    Without anything learned there is no verdict, and all stay.
    """
    if net is None:
        return docs

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        lang, score = predictions(net, texts)
        good = np.array([x != UNKNOWN for x in lang], bool) & (score >= least)
        return batch.filter(pa.array(good))

    return docs.mapInArrow(over_slices(work, WHOLE_SLICE, _key(net)), docs.schema)

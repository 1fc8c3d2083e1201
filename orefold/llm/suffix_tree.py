"""LM scoring with a probabilistic suffix tree that grows with its corpus.

Tokens are the words `[^\\x20\\x09-\\x0D]+` of a text, A-Z in lower case, and one end. The
tree's symbols are all words that training has at least ``LEAST_CONTEXT`` times, the end, and
one symbol for any other word; a word of that class has its share of the class by its own
count, so every word of the corpus counts.

The tree grows level by level. Contexts of up to ``DEPTH`` symbols that occur at least
``LEAST_CONTEXT`` times are candidates; next symbols seen ``LEAST_NEXT`` times after one are
stored. A candidate is retained if its next symbols diverge from those of its suffix: its
tokens times the relative entropy are at least ``EVIDENCE``, a test of likelihoods. Suffixes
of retained contexts are states too. What a state has not stored, and ``SMOOTHING`` more, goes
to the distribution of its suffix. All limits are counts: a larger corpus has more symbols,
longer contexts and more next symbols.

``cross_scored`` scores the texts that make the tree, and others with them. Texts are cut into
chunks of bounded size and stay there as symbols. What is counted over all of training (words,
pairs of a context and a next symbol, evidence of contexts, suffixes of retained ones) is asked
for by ``exchange``: sorted arrays of distinct keys go to buckets and answers come back, so that
no key is a row. Words, contexts and pairs are 64-bit hashes. Contexts that cannot be states, by
a bound that follows from counts at hand, are not counted further.

``learned`` makes a model to be kept, as tables that shuffles make. Chunks of texts ask for the
counts and symbols of their distinct words by a join. A level's candidates and the finished tree
are sent to the tasks as sorted arrays while they have at most ``MOST_SENT`` rows; beyond that
everything is counted and the candidates chosen afterwards, and chunks ask for the states they
need by a join, with the same result. Symbols are 32-bit codes of words there; of words with one
code the most frequent keeps it.

Base: the sum over tokens of log10((c + 0.5) / (N + 0.5 (V + 1))).

Defined results: a null or empty text is the end alone; without training tokens every
count is 0 and N is 0; repeated rows are scored one by one; null ids are a fold like any
other; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.llm import exchange as ex
from orefold.llm.common import (
    SLICE_BYTES, at_rest, binary, forget_all_but, give_back, hashed, mixed, over_slices, raw, slices, split_words, stored,
    text_bytes,
)

DEPTH = 3
#: What occurs once says nothing beyond its own text; all else may be a context.
LEAST_CONTEXT = 2
#: The share of next symbols seen once is what unseen ones get (Good and Turing), by way of the
#: suffix: storing them too scores texts outside training below the base.
LEAST_NEXT = 2
#: Tokens times relative entropy, in nats.
EVIDENCE = 16.0
SMOOTHING = 1.0
CHUNK_BYTES = 8 * 1024 * 1024
#: Bytes of text counted at a time: larger slices repeat more words.
COUNTED_BYTES = 8 * 1024 * 1024
#: Bytes of symbols that are counted or scored at a time, and that ask for their states at once.
SYMBOL_BYTES = 4 * 1024 * 1024
ASKING_BYTES = 1024 * 1024
#: Rows of a sorted array that tasks get (8 bytes each, with values 24).
MOST_SENT = 1_500_000
#: Tokens of a chunk that is scored by the tree it helps to make, or a single text.
CHUNK_TOKENS = 1_200_000
#: Pairs that a task holds before it hands them on.
HELD_PAIRS = 1_500_000

OTHER, END = 0, 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(0)
KNOWN = "key long, a double, b double"
SCORED = "n_tokens long, n_known long, train_tokens long, base_score double, score double"


def lower_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words in lower case, which of them each word is, and words per text."""
    flat, doc = split_words(texts, lower=True)
    coded = flat.dictionary_encode()
    return coded.dictionary.cast(pa.binary()), coded.indices.to_numpy(), np.bincount(doc, minlength=len(texts))


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` over all texts; counted within slices first."""

    def work(batch: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
        words, which, _ = lower_words(texts)
        return pa.RecordBatch.from_arrays(
            [words, pa.array(np.bincount(which, minlength=len(words)))], names=["word", "n"]
        )

    return (
        texts.select("text").mapInArrow(over_slices(work, COUNTED_BYTES), "word binary, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
    )


@dataclass
class Totals:
    """Of training, the end included."""

    tokens: int
    distinct: int
    documents: int
    #: words that are no symbol: their tokens, and the probability of their class
    others: int
    share: float

    @property
    def whole(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)


@dataclass
class Words(Totals):
    """Counts of training: ``counts`` (word, n), ``symbols`` (word, n, code), and totals."""

    counts: DataFrame
    symbols: DataFrame


def totals(n: int, distinct: int, documents: int, held: int, kinds: int) -> Totals:
    """Of ``n`` words in ``documents`` texts, of which ``kinds`` symbols have ``held``."""
    out = Totals(n + documents, distinct + (documents > 0), documents, n - held, 1.0)
    if documents:  # what symbols and the end leave
        out.share = 1 - (held + 0.5 * kinds + documents + 0.5) / out.whole
    return out


def learned_words(texts: DataFrame, least: int = LEAST_CONTEXT) -> Words:
    counts = stored(word_counts(texts), "word-counts")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    code = F.shiftrightunsigned(F.xxhash64("word"), 32)
    first = F.struct(F.col("n"), F.col("word"))
    symbols = stored(
        counts.where(F.col("n") >= least).withColumn("code", code).where(F.col("code") > END)
        .groupBy("code").agg(F.max(first).alias("w")).select("w.word", "w.n", "code"),
        "symbols",
    )
    held, kinds = symbols.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    return Words(**vars(totals(n, v, texts.count(), held, kinds)), counts=counts, symbols=symbols)


# texts as symbols

def symbolized(docs: DataFrame, words: Words, extra: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id``, the extra columns, ``n_tokens``, ``n_known``, ``base_score``, ``rest`` (what
    words of the class add to a score) and ``symbols``, 32 bits each, the end included.
    Stored."""
    chunks = max(-(-text_bytes(docs) // CHUNK_BYTES), 1)
    number = F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")), F.octet_length("text"))
    held = docs.select(
        F.pmod(number, F.lit(chunks)).alias("chunk"),
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text"),
        *[c.alias(n) for n, c in (extra or {}).items()],
    )
    kept = [c for c in held.columns if c not in ("chunk", "text")]
    types = ", ".join(f"`{c}` {t}" for c, t in held.dtypes if c in kept)
    whole, share, documents = words.whole, words.share, words.documents

    def asks(group: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({"chunk": pa.array([], pa.int64()), "word": pa.array([], pa.binary())})
        asked, _, _ = lower_words(binary(group.column("text").combine_chunks()))
        chunk = pa.array(np.full(len(asked), group.column("chunk")[0].as_py(), np.int64))
        return pa.table({"chunk": chunk, "word": asked})

    def answers(texts: pa.Table, known: pa.Table) -> pa.Table:
        distinct, which, counts = lower_words(binary(texts.column("text").combine_chunks()))
        held_words = known.column("word").combine_chunks()
        at = pc.index_in(distinct, value_set=held_words).to_numpy(zero_copy_only=False)
        found = np.isfinite(at)
        at = np.where(found, at, 0).astype(np.int64)
        c, code = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.uint32)
        if len(held_words):
            c[found] = known.column("n").to_numpy()[at[found]]
            code[found] = known.column("code").to_numpy()[at[found]].astype(np.uint32)
        total = counts + 1
        ends = np.cumsum(total)
        inside = np.ones(int(total.sum()), bool)
        inside[ends - 1] = False
        symbols = np.full(len(inside), END, np.uint32)
        symbols[inside] = code[which]
        of_token = np.full(len(inside), documents, np.int64)
        of_token[inside] = c[which]
        base = np.log10((of_token + 0.5) / whole)
        rest = np.where(symbols == OTHER, base - np.log10(share), 0.0)
        starts = ends - total
        per = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
        body = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(total),
            [None, pa.py_buffer(4 * np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(symbols.astype("<u4"))],
        )
        columns = [
            *[texts.column(c) for c in kept], pa.array(total.astype(np.int64)),
            pa.array(per((of_token > 0).astype(np.int64)).astype(np.int64)), pa.array(per(base)), pa.array(per(rest)),
            body.cast(pa.binary()),
        ]
        return pa.table(columns, names=[*kept, "n_tokens", "n_known", "base_score", "rest", "symbols"])

    coded = words.counts.join(words.symbols.select("word", "code"), "word", "left").select(
        "word", "n", F.coalesce("code", F.lit(OTHER)).cast("long").alias("code")
    )
    asked = held.groupBy("chunk").applyInArrow(asks, "chunk long, word binary")
    known = asked.join(coded, "word").select("chunk", "word", "n", "code")
    made = held.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        answers, f"{types}, n_tokens long, n_known long, base_score double, rest double, symbols binary"
    )
    return stored(made, "symbol-rows")


def _symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols back to back, the place of each in its text, and how many each text has."""
    data, at = raw(binary(texts))
    symbols = np.frombuffer(data.tobytes(), "<u4").astype(np.uint64)
    n = np.diff(at) // 4
    return symbols, np.arange(len(symbols)) - np.repeat(np.cumsum(n) - n, n), n


def after(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The hash of a context with one more symbol at its end."""
    return mixed(context * _BASE + symbol.astype(np.uint64) + np.uint64(1), 3)


def contexts_at(symbols: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The hashes of the ``depth`` symbols before each place."""
    out = np.full(len(at), _EMPTY, np.uint64)
    for k in range(depth, 0, -1):
        out = after(out, symbols[at - k])
    return out


def pair_key(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return mixed(after(context, symbol), 5)


def symbol_key(symbol: np.ndarray) -> np.ndarray:
    return mixed(symbol.astype(np.uint64), 11)


def context_key(context: np.ndarray) -> np.ndarray:
    return mixed(context, 13)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


# the tree

PAIRS = "ctx long, next long, n long"


def _merged(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Rows with equal keys added up; other columns are the first row's."""
    key = np.concatenate([h[0] for h in held])
    n = np.concatenate([h[1] for h in held])
    key, first, of = np.unique(key, return_index=True, return_inverse=True)
    rest = (np.concatenate([h[i] for h in held])[first] for i in range(2, len(held[0])))
    return key, np.bincount(of, n, len(key)).astype(np.int64), *rest


def pair_counts(rows: DataFrame, depth: int, wanted: np.ndarray | None, least: int) -> DataFrame:
    """``PAIRS`` of contexts of one length (of ``wanted`` alone, if given) that occur ``least``
    times or more. A task adds up what it can hold before the shuffle; most pairs occur once, so
    nothing travels but the pair and its count."""

    def found(symbols: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
        at = np.flatnonzero(place >= depth)
        if depth == 1:
            # the pair itself is the key, and all that travels
            key, n = np.unique(symbols[at - 1] << np.uint64(32) | symbols[at], return_counts=True)
            return key, n
        context = contexts_at(symbols, at, depth)
        if wanted is not None:
            held = _among(context, wanted)
            at, context = at[held], context[held]
        key, first, n = np.unique(pair_key(context, symbols[at]), return_index=True, return_counts=True)
        at = at[first]
        return key, n, context[first], symbols[at]

    names = ["key", "n"] if depth == 1 else ["n", "ctx", "next"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_all_but(None)
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for _, texts in slices(batches, "symbols", SYMBOL_BYTES):
            symbols, place, _ = _symbols(texts)
            held.append(found(symbols, place))
            size += len(held[-1][0])
            if size > HELD_PAIRS:
                held = [_merged(held)]
                size = len(held[0][0])
                if size > HELD_PAIRS // 2:
                    yield batch_of(held[0])
                    held, size = [], 0
                give_back()
        if held:
            yield batch_of(_merged(held))

    def batch_of(made: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([_signed(c) for c in made[-len(names) :]], names=names)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy().view(np.uint64)
            context = after(np.full(len(key), _EMPTY, np.uint64), key >> np.uint64(32))
            columns = [context, key & np.uint64(0xFFFFFFFF), batch.column("n").to_numpy()]
            yield pa.RecordBatch.from_arrays([_signed(c) for c in columns], names=["ctx", "next", "n"])

    counted = rows.select("symbols").mapInArrow(work, ", ".join(f"{c} long" for c in names))
    keys = [c for c in names if c != "n"]
    counted = counted.groupBy(*keys).agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return counted.mapInArrow(named, PAIRS) if depth == 1 else counted.select("ctx", "next", "n")


def _among(x: np.ndarray, held: np.ndarray) -> np.ndarray:
    if not len(held):
        return np.zeros(len(x), bool)
    return held[np.minimum(np.searchsorted(held, x), len(held) - 1)] == x


def _next_contexts(pairs: DataFrame, depth: int, least: int) -> DataFrame:
    """Candidates of the next length: frequent pairs that do not end a text. Stored."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, suffix, symbol = (batch.column(c).to_numpy().view(np.uint64) for c in ("ctx", "suffix", "next"))
            if depth == 1:
                suffix = np.full(len(context), _EMPTY, np.uint64)
            columns = [after(context, symbol), after(suffix, symbol), batch.column("n").to_numpy()]
            yield pa.RecordBatch.from_arrays([_signed(c) for c in columns], names=["ctx", "suffix", "tokens"])

    frequent = pairs.where((F.col("n") >= least) & (F.col("next") != END))
    return stored(frequent.mapInArrow(work, "ctx long, suffix long, tokens long"), "tree-candidates")


@dataclass
class Model:
    """``known``: a row for each symbol, state and next symbol (key, a, b), stored; ``sent``
    the same as sorted arrays, if small enough."""

    words: Words
    depth: int
    known: DataFrame
    states: DataFrame
    sent: tuple[np.ndarray, np.ndarray, np.ndarray] | None


def grown(
    rows: DataFrame, words: Words, depth: int = DEPTH, least_context: int = LEAST_CONTEXT,
    least_next: int = LEAST_NEXT, evidence: float = EVIDENCE, most_sent: int = MOST_SENT,
) -> Model:
    """The tree of all ``symbolized`` rows given, which the ``words`` were counted in."""
    spark = rows.sparkSession
    first = words.symbols.select("code", F.col("n").alias("tokens")).unionByName(
        spark.createDataFrame([(OTHER, words.others)], "code long, tokens long").where(F.col("tokens") >= least_context)
    )
    roots = words.symbols.select(F.col("code").alias("next"), ((F.col("n") + 0.5) / words.whole).alias("p")).unionByName(
        spark.createDataFrame(
            [(OTHER, words.share), (END, (words.documents + 0.5) / words.whole)], "next long, p double"
        )
    )
    candidates, levels = _first_contexts(first), []
    for length in range(1, depth + 1):
        wanted = None
        if length > 1 and candidates.count() <= most_sent:
            wanted = np.sort(candidates.select("ctx").toArrow().column(0).to_numpy().view(np.uint64))
        pairs = pair_counts(rows, length, wanted, least_next)
        pairs = stored(pairs.join(candidates.select("ctx", "suffix"), "ctx"), "tree-pairs")
        levels.append((candidates, pairs))
        candidates = _next_contexts(pairs, length, least_context)
        if candidates.isEmpty():
            break
    kept: list[DataFrame] = []
    for length, (contexts, pairs) in enumerate(levels, 1):
        own = pairs.join(contexts.select("ctx", "tokens"), "ctx").join(roots, "next")
        base = F.col("p")
        if length > 1:
            above, above_pairs = levels[length - 2]
            own = own.join(
                above_pairs.select(F.col("ctx").alias("suffix"), "next", F.col("n").alias("m")), ["suffix", "next"], "left"
            ).join(above.select(F.col("ctx").alias("suffix"), F.col("tokens").alias("of")), "suffix", "left")
            base = F.coalesce(F.col("m") / F.col("of"), base)
        share = F.col("n") / F.col("tokens")
        tested = own.groupBy("ctx", "suffix", "tokens").agg(F.sum(share * F.ln(share / base)).alias("apart"))
        kept.append(stored(tested.where(F.col("apart") * F.col("tokens") >= evidence).select("ctx", "suffix"), "tree-kept"))
    for length in range(len(kept), 1, -1):  # suffixes of states are states
        suffixes = kept[length - 1].select(F.col("suffix").alias("ctx")).distinct()
        of = levels[length - 2][0].select("ctx", "suffix").join(suffixes, "ctx", "left_semi")
        kept[length - 2] = stored(kept[length - 2].unionByName(of).distinct(), "tree-kept")
    known = _symbol_rows(words.symbols)
    states = None
    for (contexts, pairs), held in zip(levels, kept):
        mine = pairs.join(held.select("ctx"), "ctx", "left_semi")
        held_n = mine.groupBy("ctx").agg(F.sum("n").alias("held"))
        own = contexts.join(held.select("ctx"), "ctx", "left_semi").join(held_n, "ctx", "left").select(
            "ctx", "tokens", (F.col("tokens") - F.coalesce("held", F.lit(0)) + SMOOTHING).alias("left")
        )
        own = stored(own, "tree-states")
        states = own if states is None else states.unionByName(own)
        known = known.unionByName(_state_rows(own)).unionByName(_pair_rows(mine))
    known = stored(known, "tree")
    sent = None
    if known.count() <= most_sent:
        table = known.toArrow()
        key = table.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        sent = (key[order], table.column("a").to_numpy()[order], table.column("b").to_numpy()[order])
    return Model(words, depth, known, states, sent)


def _first_contexts(first: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column("code").to_numpy().view(np.uint64)
            context = after(np.full(len(code), _EMPTY, np.uint64), code)
            columns = [_signed(context), _signed(np.zeros(len(code), np.uint64)), batch.column("tokens")]
            yield pa.RecordBatch.from_arrays(columns, names=["ctx", "suffix", "tokens"])

    return stored(first.mapInArrow(work, "ctx long, suffix long, tokens long"), "tree-candidates")


def _known_rows(df: DataFrame, key, a: str, b: str | None) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(a).to_numpy().astype(np.float64)
            other = batch.column(b).to_numpy().astype(np.float64) if b else np.zeros(len(values))
            yield pa.RecordBatch.from_arrays([_signed(key(batch)), pa.array(values), pa.array(other)], names=["key", "a", "b"])

    return df.mapInArrow(work, KNOWN)


def _unsigned(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy().view(np.uint64)


def _symbol_rows(symbols: DataFrame) -> DataFrame:
    return _known_rows(symbols.select("code", "n"), lambda b: symbol_key(_unsigned(b, "code")), "n", None)


def _state_rows(states: DataFrame) -> DataFrame:
    return _known_rows(states, lambda b: context_key(_unsigned(b, "ctx")), "tokens", "left")


def _pair_rows(pairs: DataFrame) -> DataFrame:
    return _known_rows(
        pairs.select("ctx", "next", "n"), lambda b: pair_key(_unsigned(b, "ctx"), _unsigned(b, "next")), "n", None
    )


# scoring

def _looked_up(known: tuple[np.ndarray, ...], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which keys are known, and their values (0 for others)."""
    key, a, b = known
    if not len(key):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted)), np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
    held = key[at] == wanted
    return held, np.where(held, a[at], 0.0), np.where(held, b[at], 0.0)


def probabilities(
    symbols: np.ndarray, place: np.ndarray, known: tuple[np.ndarray, ...], depth: int, whole: float, share: float, documents: int
) -> np.ndarray:
    """Of each symbol after those before it."""
    distinct, of = np.unique(symbols, return_inverse=True)
    count = _looked_up(known, symbol_key(distinct))[1]
    p = np.where(distinct == OTHER, share, (np.where(distinct == END, documents, count) + 0.5) / whole)[of]
    for length in range(1, depth + 1):
        at = np.flatnonzero(place >= length)
        context = contexts_at(symbols, at, length)
        held, tokens, left = _looked_up(known, context_key(context))
        at, context, tokens, left = at[held], context[held], tokens[held], left[held]
        n = _looked_up(known, pair_key(context, symbols[at]))[1]
        p[at] = (n + left * p[at]) / (tokens + SMOOTHING)
    return p


def _keys(symbols: np.ndarray, place: np.ndarray, depth: int) -> np.ndarray:
    """All keys that scoring may look up."""
    out = [symbol_key(np.unique(symbols))]
    for length in range(1, depth + 1):
        at = np.flatnonzero(place >= length)
        context = contexts_at(symbols, at, length)
        out += [np.unique(context_key(context)), np.unique(pair_key(context, symbols[at]))]
    return np.unique(np.concatenate(out))


def score_rows(rows: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, the extra columns and ``SCORED`` of symbolized rows."""
    words, depth = model.words, model.depth
    kept = [c for c in rows.columns if c not in ("n_tokens", "n_known", "base_score", "rest", "symbols")]
    types = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c in kept)
    out_type = f"{types}, {SCORED}"
    names = [*kept, *[c.split()[0] for c in SCORED.split(", ")]]
    whole, share, documents, tokens = words.whole, words.share, words.documents, words.tokens

    def columns(batch, known: tuple[np.ndarray, ...], symbols_of: pa.Array) -> list:
        symbols, place, n = _symbols(symbols_of)
        base, rest = batch.column("base_score").to_numpy(), batch.column("rest").to_numpy()
        own = base
        if documents:
            p = np.log10(probabilities(symbols, place, known, depth, whole, share, documents))
            own = rest + (np.add.reduceat(p, np.cumsum(n) - n) if len(n) else np.zeros(0))
        return [
            *[batch.column(c) for c in kept], batch.column("n_tokens"), batch.column("n_known"),
            pa.array(np.full(batch.num_rows, tokens, np.int64)), pa.array(base), pa.array(own),
        ]

    if model.sent is not None:
        sent = model.sent

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget_all_but(None)
            for batch, symbols_of in slices(batches, "symbols", SYMBOL_BYTES):
                yield pa.RecordBatch.from_arrays(columns(batch, sent, symbols_of), names=names)
                give_back()

        return rows.mapInArrow(work, out_type)

    chunks = max(-(-text_bytes(rows, "symbols") // ASKING_BYTES), 1)
    held = rows.withColumn("_chunk", F.pmod(F.xxhash64("symbols", "base_score", "doc_id"), F.lit(chunks)))

    def asks(group: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({"_chunk": pa.array([], pa.int64()), "key": pa.array([], pa.int64())})
        symbols, place, _ = _symbols(group.column("symbols").combine_chunks())
        keys = _keys(symbols, place, depth)
        return pa.table({"_chunk": pa.array(np.full(len(keys), group.column("_chunk")[0].as_py(), np.int64)), "key": _signed(keys)})

    def answers(group: pa.Table, known: pa.Table) -> pa.Table:
        key = known.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        found = key[order], known.column("a").to_numpy()[order], known.column("b").to_numpy()[order]
        batch = group.combine_chunks()
        return pa.table(columns(batch, found, batch.column("symbols").combine_chunks()), names=names)

    asked = held.groupBy("_chunk").applyInArrow(asks, "_chunk long, key long")
    known = asked.join(model.known, "key").select("_chunk", "key", "a", "b")
    return held.groupBy("_chunk").cogroup(known.groupBy("_chunk")).applyInArrow(answers, out_type)


def learned(texts: DataFrame, **limits) -> Model:
    """The tree over all given texts; the limits are those of ``grown``."""
    docs = texts.select(F.lit(None).cast("long").alias("doc_id"), "text")
    words = learned_words(docs, limits.get("least_context", LEAST_CONTEXT))
    return grown(symbolized(docs, words), words, **limits)


def scored(docs: DataFrame, model: Model, extra: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id``, the extra columns and ``SCORED`` for each document."""
    return score_rows(symbolized(docs, model.words, extra), model)


# texts scored by the tree that some of them make, chunk by chunk

@dataclass
class Limits:
    depth: int = DEPTH
    least_context: int = LEAST_CONTEXT
    least_next: int = LEAST_NEXT
    evidence: float = EVIDENCE

    @property
    def bound(self) -> float:
        """What an upper bound of the evidence must reach; rounding must not decide."""
        return self.evidence - 1e-6 * max(1.0, abs(self.evidence))


def token_rows(docs: DataFrame, usable: Column, extra: dict[str, Column]) -> ex.Stage:
    """Chunks of texts as rows of ``exchange.ROWS``: ``docs``, the columns to keep, with how many
    texts are ``usable``; ``words``, hashes of the distinct ones and how often usable texts have
    them; ``tokens``, which word each is, and words per text. Stored."""
    held = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *[c.alias(n) for n, c in extra.items()],
        F.coalesce(usable, F.lit(False)).alias("_usable"), F.col("text"),
    )
    kept = [c for c in held.columns if c != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_all_but(None)
        chunk = TaskContext.get().partitionId() << 32
        parts: list[tuple[np.ndarray, ...]] = []
        rows: list[bytes] = []
        for batch, texts in slices(batches, "text", SLICE_BYTES):
            parts.append(_tokens(batch, texts))
            rows.append(_table_bytes(batch.select(kept)))
            if sum(len(p[1]) for p in parts) >= CHUNK_TOKENS:
                yield from _chunk_rows(chunk, parts, rows).to_batches()
                chunk, parts, rows = chunk + 1, [], []
                give_back()
        if parts:
            yield from _chunk_rows(chunk, parts, rows).to_batches()
        at_rest()

    return ex.Stage("token-rows", held.mapInArrow(work, ex.ROWS))


def _tokens(batch: pa.RecordBatch, texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Hashes of distinct words, which of them each word is, words per text, usable texts."""
    words, which, counts = lower_words(texts)
    data, at = raw(words.cast(pa.large_binary()))
    return hashed(data, at[:-1], at[1:]), which, counts, batch.column("_usable").to_numpy(zero_copy_only=False)


def _table_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _chunk_rows(chunk: int, parts: list[tuple[np.ndarray, ...]], rows: list[bytes]) -> pa.Table:
    hashes, first = np.concatenate([p[0] for p in parts]), np.cumsum([0, *[len(p[0]) for p in parts]])
    words, of = ex.distinct(hashes)
    which = np.concatenate([of[at + p[1]] for at, p in zip(first, parts)]).astype(np.uint32)
    counts, usable = (np.concatenate([p[i] for p in parts]) for i in (2, 3))
    n = np.bincount(which[np.repeat(usable, counts)], minlength=len(words)).astype(np.uint32)
    ends = np.cumsum([0, *[len(r) for r in rows]])
    return ex.table_of([
        (chunk, "docs", 0, int(usable.sum()), ex.packed(ends, np.frombuffer(b"".join(rows), np.uint8))),
        (chunk, "words", 0, len(words), ex.packed(words, n)),
        (chunk, "tokens", 0, len(which) + len(counts), ex.packed(which, counts.astype(np.uint32), usable)),
    ])


def _kept_rows(held: ex.Held) -> pa.Table:
    """The table whose batches ``_table_bytes`` has written."""
    ends, data = held["docs"]
    data = pa.py_buffer(data)
    return pa.concat_tables([pa.ipc.open_stream(data.slice(a, b - a)).read_all() for a, b in zip(ends[:-1], ends[1:])])


def word_answers(least: int) -> ex.Answer:
    """How often training has each word, and whether it is a symbol."""

    def answer(words: np.ndarray, n: np.ndarray):
        word, of = ex.distinct(words)
        total = np.bincount(of, n, len(word)).astype(np.int64)
        symbol = (total >= least) & (word > END)
        return (total[of], symbol[of]), (total.sum(), (total > 0).sum(), total[symbol].sum(), symbol.sum())

    return answer


def _small(n: np.ndarray) -> np.ndarray:
    return n.astype(np.uint32) if not len(n) or n.max() < 1 << 32 else n


class Chunk:
    """The symbols of a chunk's texts, back to back, and what training has of them.

    ``seen[k]`` says for each place how often training has the symbols there and at the ``k``
    places before; it is 0 where that cannot matter, and where it is not stored (``least_next``).
    """

    def __init__(self, held: ex.Held, limits: Limits) -> None:
        self.limits = limits
        self.codes, self.count, self.which, total, usable = held["symbols"]
        self.starts = np.cumsum(total, dtype=np.int64) - total
        self.place = np.arange(len(self.which), dtype=np.int32) - np.repeat(self.starts.astype(np.int32), total)
        self.train = np.repeat(usable, total)
        self.single = after(np.full(len(self.codes), _EMPTY, np.uint64), self.codes)
        self.seen = [_small(self.count)[self.which]]
        while f"seen{len(self.seen)}" in held.bodies:
            self.seen += held[f"seen{len(self.seen)}"]

    def contexts(self, at: np.ndarray, length: int) -> np.ndarray:
        """As ``contexts_at``."""
        out = self.single[self.which[at - length]]
        for k in range(length - 1, 0, -1):
            out = after(out, self.codes[self.which[at - k]])
        return out

    def at(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places after contexts of one length that may be candidates: the place, how often
        training has the context, and its suffix (of one symbol: none, the context again)."""
        at = np.flatnonzero(self.place >= length).astype(np.int32)
        tokens = self.seen[length - 1][at - 1]
        held = tokens >= max(self.limits.least_context, 1)
        at, tokens = at[held], tokens[held]
        return at, tokens, self.seen[length - 2][at - 1] if length > 1 else tokens

    def may_be_states(self, length: int, tokens: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        """Contexts that can be retained, or be the suffix of one that is.

        A next symbol that t tokens of a context have n times, and s tokens of its suffix m
        times, has n <= m: ln((n / t) / (m / s)) is at most ln(s / t), and the evidence of the
        whole context at most t ln(s / t). For contexts with this one as suffix s is its own
        count, and x ln(s / x) is at most s / e.
        """
        if length == 1:
            return np.ones(len(tokens), bool)
        own = tokens * np.log(np.maximum(suffix, 1) / tokens) >= self.limits.bound
        return own | (tokens >= np.e * self.limits.bound) if length < self.limits.depth else own

    def asked(self, length: int) -> np.ndarray:
        """Places whose symbol must be counted after the context of this length: the context may
        be a state, or with the symbol the beginning of one. Training has that at most as often
        as the context, and its suffix as often as the suffix's pair, by which its evidence is
        bounded as above."""
        at, tokens, suffix = self.at(length)
        may = self.may_be_states(length, tokens, suffix)
        if 1 < length < self.limits.depth:
            pair = self.seen[length - 1][at]
            most = np.maximum(np.minimum(tokens, pair / np.e), 1e-9)
            may |= (pair > 0) & (most * np.log(np.maximum(pair, 1) / most) >= self.limits.bound)
        return at[may]

    def pairs(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys of contexts and next symbols, which each place has, and the places."""
        at = self.asked(length)
        return *ex.distinct(pair_key(self.contexts(at, length), self.codes[self.which[at]])), at

    def states(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys of contexts that may be states, which each place has, the places, and
        how often training has the context."""
        at, tokens, suffix = self.at(length)
        may = self.may_be_states(length, tokens, suffix)
        at, tokens = at[may], tokens[may]
        if length == 1:
            there = np.bincount(self.which[at - 1], minlength=len(self.codes)) > 0
            key, of = ex.distinct(context_key(self.single[there]))
            return key, of[(np.cumsum(there) - 1)[self.which[at - 1]]], at, tokens
        return *ex.distinct(context_key(self.contexts(at, length))), at, tokens

    def roots(self, whole: float, share: float) -> np.ndarray:
        p = (self.count + 0.5) / whole
        p[self.codes == OTHER] = share
        return p[self.which]


def _pair_asks(held: ex.Held, chunk: Chunk, length: int, buckets: int) -> list[ex.Row]:
    key, of, at = chunk.pairs(length)
    n = np.bincount(of, chunk.train[at], len(key)).astype(np.uint32)
    return ex.asking(held.chunk, buckets, "pairs", key, n)


def _evidence_asks(held: ex.Held, chunk: Chunk, length: int, words: Totals, buckets: int) -> list[ex.Row]:
    """What the chunk's places add to the evidence of contexts, and how many of them have a
    stored next symbol. That counts at each of its places, so as often as training has it."""
    key, of, at, tokens = chunk.states(length)
    n = chunk.seen[length][at]
    counted = np.flatnonzero(chunk.train[at] & (n > 0))
    of, at, tokens, n = of[counted], at[counted], tokens[counted], n[counted]
    base = chunk.roots(words.whole, words.share)[at] if length == 1 else chunk.seen[length - 1][at] / chunk.seen[length - 2][at - 1]
    apart = np.bincount(of, np.log(n / tokens / base), len(key))
    return ex.asking(held.chunk, buckets, f"tests{length}", key, apart, np.bincount(of, minlength=len(key)).astype(np.uint32))


def pair_answers(least: int) -> ex.Answer:
    def answer(key: np.ndarray, n: np.ndarray):
        key, of = ex.distinct(key)
        total = np.bincount(of, n, len(key)).astype(np.int64)
        return (np.where(total >= least, total, 0)[of],), None

    return answer


def _symbol_rows_of(words: Totals):
    """Symbols, base scores and what words of the class add."""
    whole, share, documents, others = words.whole, words.share, words.documents, words.others

    def work(held: ex.Held) -> pa.Table:
        n, symbol = held.answer("words", np.int64, bool)
        distinct, _ = held["words"]
        which, counts, usable = held["tokens"]
        common = np.flatnonzero(symbol)[np.argsort(-n[symbol])]  # small numbers take less room
        codes = np.concatenate([np.array([OTHER, END], np.uint64), distinct[common]])
        count = np.concatenate([np.array([others, documents], np.int64), n[common]])
        of = np.zeros(len(distinct), np.uint32)
        of[common] = np.arange(2, len(codes))
        total = counts.astype(np.int64) + 1
        ends = np.cumsum(total)
        inside = np.ones(int(total.sum()), bool)
        inside[ends - 1] = False
        symbols = np.full(len(inside), END, np.uint32)
        symbols[inside] = of[which]
        of_token = np.full(len(inside), documents, np.int64)
        of_token[inside] = n[which]
        base = np.log10((of_token + 0.5) / whole)
        rest = np.where(symbols == OTHER, base - np.log10(share), 0.0)
        per = lambda x: np.add.reduceat(x, ends - total)
        return ex.table_of([
            (held.chunk, "docs", 0, 0, held.bodies["docs"].to_pybytes()),
            (held.chunk, "symbols", 0, len(symbols), ex.packed(codes, count, symbols, total.astype(np.uint32), usable)),
            (held.chunk, "base", 0, 0, ex.packed(total, per((of_token > 0).astype(np.int64)), per(base), per(rest))),
        ])

    return work


def _first_asks(limits: Limits, buckets: int):
    return lambda held: ex.table_of(_pair_asks(held, Chunk(held, limits), 1, buckets))


def _seen_rows(length: int, words: Totals, limits: Limits, buckets: int):
    """How often training has the pairs of one level; asks for those of the next, and tests
    contexts: those of the level before, and after the last level its own."""

    def work(held: ex.Held) -> pa.Table:
        chunk = Chunk(held, limits)
        _, of, at = chunk.pairs(length)
        seen = np.zeros(len(chunk.which), np.int64)
        seen[at] = held.answer("pairs", np.int64)[0][of]
        chunk.seen.append(_small(seen))
        rows = [(held.chunk, f"seen{length}", 0, len(at), ex.packed(chunk.seen[-1]))]
        del of, at, seen
        if length > 2:
            rows.append((held.chunk, f"tests{length - 2}", 0, 0, ex.packed(*_tests(held, length - 2))))
        if length < limits.depth:
            rows += _pair_asks(held, chunk, length + 1, buckets)
        for k in range(max(length - 1, 1), length + (length == limits.depth)):
            rows += _evidence_asks(held, chunk, k, words, buckets)
        return ex.table_of(rows)

    return work


def _tests(held: ex.Held, length: int) -> list[np.ndarray]:
    """Which contexts are retained, and how many of their tokens have a stored next symbol."""
    return held[f"tests{length}"] if f"tests{length}" in held.bodies else held.answer(f"tests{length}", bool, np.int64)


def evidence_answers(evidence: float) -> ex.Answer:
    """See ``_tests``."""

    def answer(key: np.ndarray, apart: np.ndarray, held: np.ndarray):
        key, of = ex.distinct(key)
        held = np.bincount(of, held, len(key)).astype(np.int64)
        kept = (np.bincount(of, apart, len(key)) >= evidence) & (held > 0)
        return (kept[of], held[of]), None

    return answer


def _tested_rows(limits: Limits, buckets: int):
    """Contexts retained; asks which of the others are suffixes of such a context."""

    def work(held: ex.Held) -> pa.Table:
        chunk = Chunk(held, limits)
        states = [chunk.states(k) for k in range(1, limits.depth + 1)]
        tests = [_tests(held, k) for k in range(1, limits.depth + 1)]
        kept, stored_next = (np.concatenate(x) for x in zip(*tests))
        below = np.zeros(len(chunk.which), bool)  # a longer context is retained here
        suffixes = [np.zeros(len(s[0]), bool) for s in states]
        for (_, of, at, _), (mine, _), suffix in zip(states[::-1], tests[::-1], suffixes[::-1]):
            suffix[of[below[at]]] = True
            below[at[mine[of]]] = True
        keys, at = _open_states(states, kept, limits)
        rows = [(held.chunk, "tests", 0, len(kept), ex.packed(kept, stored_next))]
        return ex.table_of(rows + ex.asking(held.chunk, buckets, "suffixes", keys, np.concatenate(suffixes)[at]))

    return work


def _open_states(states: list, kept: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of contexts that are not retained, but may be suffixes of one that is; the
    place of each among all keys."""
    tokens = []
    for key, of, _, n in states:
        tokens.append(np.zeros(len(key), n.dtype))
        tokens[-1][of] = n
    tokens[-1][:] = 0  # the longest are no suffixes
    keys, tokens = np.concatenate([s[0] for s in states]), np.concatenate(tokens)
    at = np.flatnonzero(~kept & (tokens >= np.e * limits.bound) & (tokens > 0))
    at = at[np.argsort(keys[at])]
    return keys[at], at


def suffix_answers(key: np.ndarray, suffix: np.ndarray):
    key, of = ex.distinct(key)
    return ((np.bincount(of, suffix, len(key)) > 0)[of],), None


def _scored_rows(words: Totals, limits: Limits, kept_columns: list[str]):
    def work(held: ex.Held) -> pa.Table:
        docs = _kept_rows(held)
        n, known, base, rest = held["base"]
        own = base
        if words.documents:
            own = rest + _log_likelihoods(held, words, limits)
        columns = [n, known, np.full(len(n), words.tokens, np.int64), base, own]
        names = [*kept_columns, *[c.split()[0] for c in SCORED.split(", ")]]
        return pa.table([*[docs.column(c) for c in kept_columns], *[pa.array(c) for c in columns]], names=names)

    return work


def _log_likelihoods(held: ex.Held, words: Totals, limits: Limits) -> np.ndarray:
    chunk = Chunk(held, limits)
    states = [chunk.states(k) for k in range(1, limits.depth + 1)]
    state, stored_next = held["tests"]
    state = state.copy()
    _, at = _open_states(states, state, limits)
    state[at] = held.answer("suffixes", bool)[0]
    p, first = chunk.roots(words.whole, words.share), 0
    for k, (key, of, at, tokens) in enumerate(states, 1):
        mine = state[first : first + len(key)][of]
        at, of, tokens = at[mine], of[mine], tokens[mine]
        left = tokens - stored_next[first : first + len(key)][of] + SMOOTHING
        p[at] = (chunk.seen[k][at] + left * p[at]) / (tokens + SMOOTHING)
        first += len(key)
    return np.add.reduceat(np.log10(p), chunk.starts)


def cross_scored(
    docs: DataFrame, usable: Column, extra: dict[str, Column] | None = None, depth: int = DEPTH,
    least_context: int = LEAST_CONTEXT, least_next: int = LEAST_NEXT, evidence: float = EVIDENCE,
) -> DataFrame:
    """As ``scored`` by what is ``learned`` from the rows where ``usable`` holds. All texts are
    turned into symbols once and stay where they are; level by level, chunks send the keys of
    their contexts and next symbols to be added up and get back what scoring needs."""
    limits = Limits(depth, least_context, least_next, evidence)
    kept = ["doc_id", *(extra or {})]
    named = [c.alias(n) for n, c in (extra or {}).items()]
    types = ", ".join(f"`{c}` {t}" for c, t in docs.select(F.col("doc_id").cast("long").alias("doc_id"), *named).dtypes)
    tokens = token_rows(docs, usable, extra or {})
    sizes = {r[0]: r[1] for r in tokens.rows.groupBy("kind").agg(F.sum("n")).collect()}
    buckets = ex.buckets_for(sizes.get("tokens", 0))

    words_asked = lambda held: ex.table_of(ex.asking(held.chunk, buckets, "words", *held["words"]))
    asks = ex.each(tokens.of("words"), words_asked)
    found = ex.Stage("answers", ex.answers(asks, {"words": word_answers(least_context)}))
    sums = sum((ex.unpacked(r.body)[0] for r in found.of(ex.TOTAL).select("body").collect()), np.zeros(4, np.int64))
    n, distinct, held, kinds = (int(x) for x in sums)
    words = totals(n, distinct, sizes.get("docs", 0), held, kinds)
    rows = tokens.rows.unionByName(found.rows.where(F.col("to") >= 0))
    symbols = ex.Stage("symbol-rows", *[ex.received(p, _symbol_rows_of(words)) for p in ex.parts(rows)])
    tokens.remove()
    found.remove()
    last = symbols.of("docs", "base")
    if words.documents:
        by = {"pairs": pair_answers(least_next), "suffixes": suffix_answers}
        by |= {f"tests{k}": evidence_answers(evidence) for k in range(1, depth + 1)}
        found = ex.Stage("answers", ex.answers(ex.each(symbols.of("symbols"), _first_asks(limits, buckets)), by))
        known = symbols.of("symbols")
        for length in range(1, depth + 2):
            work = _seen_rows(length, words, limits, buckets) if length <= depth else _tested_rows(limits, buckets)
            stage = ex.Stage("tree-level", *[ex.received(p, work) for p in ex.parts(known.unionByName(found.rows))])
            found.remove()
            found = ex.Stage("answers", *[ex.answers(p, by) for p in ex.parts(stage.asks())])
            stage.remove(ex.ASK)
            known = known.unionByName(stage.rest())
        last = last.unionByName(known).unionByName(found.rows)
    return ex.received(last, _scored_rows(words, limits, kept), f"{types}, {SCORED}")

"""Token ids in patched frame-of-reference blocks.

Documents are dealt into ranges of ascending ``doc_id`` and encoded with a given
tokenizer; each range is a stream of ids, every document closed by the end id. A stream is
cut into segments, the rows of the written table, at documents' ends; a segment holds
``BLOCK`` ids to a block. A block stores its minimum, the rest of each id minus that
minimum packed at a width that fits the chosen share of them, and the ids that do not fit
as exceptions (position and high bits). The segment's header indexes where each block
starts, so a reader can go to any block without unpacking those before it.

Segment, little endian: magic ``PFR1``; u32 ids, u32 blocks; u32 start of each block, then
the end; blocks. Block: u32 minimum, u8 width, u16 exceptions, u16 ids; packed low bits;
u16 positions and u32 high bits of the exceptions.

Words repeat, so each worker encodes a distinct word once: the tokenizer's own rules never
let a piece cross white space, and trailing punctuation is a piece of its own, split off before
words are looked up. Words of
lower-case Latin letters, which the tokenizer's normal form and splitting leave as they are,
go straight to its merges. Texts that hold ``<|``, which may begin a special token, are
encoded whole. The encoder is made for byte-level vocabularies that lower-case letters.

Defined results: a null or empty text is the end id alone; rows with the same id stay
together in order of the text; null ids come first; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orefold.llm.common import (
    LOWER,
    SPACE,
    Words,
    crc32,
    forget_all_but,
    give_back,
    new_folder,
    ragged,
    raw,
    remembered,
    slices,
    text_bytes,
)

BLOCK = 4096
#: The share of a block's ids that the packed width must fit.
FIT = 0.9
SEGMENT_BYTES = 1024 * 1024
RANGE_BYTES = 32 * 1024 * 1024
END_ID = 1
MAGIC = b"PFR1"
#: Distinct words that a worker remembers; beyond it, it keeps those of the last texts.
REMEMBERED = 350_000
#: Bytes of text that are encoded at a time, and cut into segments afterwards.
ENCODED_BYTES = SEGMENT_BYTES

WRITTEN = "part int, segment int, base long, n_ids long, doc_ids binary, lengths binary, payload binary"
READ = "part int, segment int, doc_id long, offset long, n_tokens long, ids_crc32 long"


# blocks

def _places(n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit word in which each packed value begins, and at which bit."""
    bit = np.arange(n, dtype=np.int64) * width
    return bit >> 6, (bit & 63).astype(np.uint64)


def pack(values: np.ndarray, width: int) -> bytes:
    """Values of ``width`` bits back to back, the lowest bit first."""
    n = len(values)
    if width == 0 or not n:
        return b""
    word, bit = _places(n, width)
    values = values.astype(np.uint64)
    out = np.zeros(int(word[-1]) + 2, np.uint64)
    firsts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out[word[firsts]] = np.bitwise_or.reduceat(values << bit, firsts)
    # what does not fit goes on in the next word; one value at most crosses into it
    over = bit + np.uint64(width) > np.uint64(64)
    out[word[over] + 1] |= values[over] >> (np.uint64(64) - bit[over])
    return out.astype("<u8").tobytes()[: (n * width + 7) // 8]


def unpack(data: np.ndarray, width: int, n: int) -> np.ndarray:
    if width == 0 or not n:
        return np.zeros(n, np.uint32)
    word, bit = _places(n, width)
    held = np.zeros((int(word[-1]) + 2) * 8, np.uint8)
    held[: len(data)] = data
    words = held.view("<u8")
    out = words[word] >> bit
    over = bit + np.uint64(width) > np.uint64(64)
    out[over] |= words[word[over] + 1] << (np.uint64(64) - bit[over])
    return (out & np.uint64((1 << width) - 1)).astype(np.uint32)


def encode_block(ids: np.ndarray, fit: float = FIT) -> bytes:
    low = ids.min()
    rest = ids - low
    at = min(int(np.ceil(fit * len(rest))) - 1, len(rest) - 1)
    width = int(np.partition(rest, at)[at]).bit_length()
    high = (rest.astype(np.uint64) >> np.uint64(width)).astype(np.uint32)
    odd = np.flatnonzero(high)
    mask = np.uint32((1 << width) - 1)
    return b"".join(
        (
            struct.pack("<IBHH", int(low), width, len(odd), len(ids)),
            pack(rest & mask, width),
            odd.astype("<u2").tobytes(),
            high[odd].astype("<u4").tobytes(),
        )
    )


def decode_block(data: memoryview) -> np.ndarray:
    low, width, n_odd, n = struct.unpack_from("<IBHH", data)
    at, packed = 9, (n * width + 7) // 8
    out = unpack(np.frombuffer(data, np.uint8, packed, at), width, n)
    at += packed
    odd = np.frombuffer(data, "<u2", n_odd, at)
    high = np.frombuffer(data, "<u4", n_odd, at + 2 * n_odd)
    out[odd] |= (high.astype(np.uint64) << np.uint64(width)).astype(np.uint32)
    return out + np.uint32(low)


def encode_segment(ids: np.ndarray, block: int = BLOCK, fit: float = FIT) -> bytes:
    ids = ids.astype(np.uint32)
    blocks = [encode_block(ids[i : i + block], fit) for i in range(0, len(ids), block)]
    head = len(MAGIC) + 8 + 4 * (len(blocks) + 1)
    starts = head + np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype(np.int64)
    return b"".join(
        (MAGIC, struct.pack("<II", len(ids), len(blocks)), starts.astype("<u4").tobytes(), *blocks)
    )


def decode_segment(data: bytes) -> np.ndarray:
    if data[:4] != MAGIC:
        raise ValueError("not a segment of token ids")
    n, blocks = struct.unpack_from("<II", data, 4)
    starts = np.frombuffer(data, "<u4", blocks + 1, 12).tolist()
    view = memoryview(data)
    out = [decode_block(view[a:b]) for a, b in zip(starts, starts[1:])]
    ids = np.concatenate(out) if out else np.zeros(0, np.uint32)
    if len(ids) != n:
        raise ValueError("a segment of token ids is cut short")
    return ids


def ids_at(data: bytes, start: int, n: int) -> np.ndarray:
    """Ids ``start`` to ``start + n`` of a segment, from the blocks that hold them alone."""
    total, blocks = struct.unpack_from("<II", data, 4)
    starts = np.frombuffer(data, "<u4", blocks + 1, 12).tolist()
    view, size = memoryview(data), struct.unpack_from("<H", data, starts[0] + 7)[0]
    first, last = start // size, min(-(-(start + n) // size), blocks)
    out = [decode_block(view[starts[b] : starts[b + 1]]) for b in range(first, last)]
    return np.concatenate(out)[start - first * size :][:n] if out else np.zeros(0, np.uint32)


# tokenizer

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_ALPHANUMERIC = np.zeros(256, bool)
_ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


#: Lower-case letters of ASCII and Latin-1: normal forms, one piece, as they are.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+\Z")


def byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies use for bytes: printable ones stand for
    themselves, the others for the letters from 256 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(256 + rest.index(b)) if b in rest else chr(b) for b in range(256)}


def split_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a ``large_binary`` array, A-Z in lower case, and the text of each. The
    punctuation that follows the last letter or digit of a word is a piece of its own, so that
    there are fewer distinct ones."""
    data, at = raw(texts)
    words = Words(data, at, ~SPACE)
    # the last byte of each word that is no punctuation
    last = np.maximum.accumulate(np.where(_PUNCTUATION[data], -1, np.arange(len(data))))[words.ends - 1]
    cut = (last >= words.starts) & (last < words.ends - 1) & _ALPHANUMERIC[data[last]]
    first = np.arange(len(cut)) + np.cumsum(cut) - cut
    lengths = np.zeros(len(cut) + np.count_nonzero(cut), np.int64)
    lengths[first] = np.where(cut, last + 1, words.ends) - words.starts
    lengths[first[cut] + 1] = (words.ends - last - 1)[cut]
    body = LOWER[data[~SPACE[data]]]
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(body)]
    )
    return flat, np.repeat(words.doc, 1 + cut)


def _bytes_of(words: pa.Array) -> list[bytes]:
    """A ``large_binary`` array without nulls as a list, cut from one piece of bytes."""
    data, at = raw(words)
    body, at = data.tobytes(), at.tolist()
    return [body[i:j] for i, j in zip(at, at[1:])]


class WordEncoder:
    """Ids of texts by way of their distinct words, remembered in one array."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.merges = self.whole.model
        self.letters = byte_letters()
        self.forget()

    def forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.starts, self.lengths = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.ids, self.used = np.zeros(1 << 14, np.uint32), 0

    def _keep(self, words: list[bytes], at: np.ndarray) -> None:
        """Forget all words but these, which are at these places."""
        lengths = self.lengths[at]
        ids = self.ids[ragged(self.starts[at], lengths)]
        self.forget()
        self._add(words, ids, lengths)

    def _add(self, words: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, m = len(self.places), len(words)
        self.starts, self.lengths = _room(self.starts, n + m), _room(self.lengths, n + m)
        self.ids = _room(self.ids, self.used + len(ids))
        self.places.update(zip(words, range(n, n + m)))
        self.starts[n : n + m] = self.used + np.cumsum(lengths) - lengths
        self.lengths[n : n + m] = lengths
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def _learn(self, words: list[bytes]) -> None:
        # plain words go straight to the library's merges, the others through all its steps
        tokenize, letters = self.merges.tokenize, self.letters
        plain = [p for p in words if p.isalpha() or _PLAIN.match(p)]
        made = [
            [t.id for t in tokenize(p.decode() if p.isascii() else p.decode("latin-1").translate(letters))]
            for p in plain
        ]
        lengths = np.fromiter(map(len, made), np.int64, len(made))
        self._add(plain, np.fromiter(chain.from_iterable(made), np.uint32, int(lengths.sum())), lengths)
        others = [p for p in words if p not in self.places]
        for i in range(0, len(others), 2048):
            some = others[i : i + 2048]
            # words as given, many to a call; the library says which ids belong to which
            made = self.whole.encode(
                [p.decode() for p in some], is_pretokenized=True, add_special_tokens=False
            )
            of = np.array(made.word_ids, np.int64)
            self._add(some, np.array(made.ids, np.uint32), np.bincount(of, minlength=len(some)))

    def words(self, words: list[bytes]) -> np.ndarray:
        """The places of distinct words; trailing punctuation is a word of its own."""
        at = np.fromiter(map(self.places.get, words, repeat(-1)), np.int64, len(words))
        held, new = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        if not len(new):
            return at
        if len(self.places) + len(new) > REMEMBERED:
            self._keep([words[i] for i in held.tolist()], at[held])
            at[held] = np.arange(len(held))
        unknown = [words[i] for i in new.tolist()]
        self._learn(unknown)
        at[new] = np.fromiter(map(self.places.__getitem__, unknown), np.int64, len(unknown))
        return at

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts back to back, without end ids, and the number for each text."""
        flat, doc = split_pieces(texts)
        coded = flat.dictionary_encode()
        at = self.words(_bytes_of(coded.dictionary))[coded.indices.to_numpy()]
        lengths = self.lengths[at]
        out = self.ids[ragged(self.starts[at], lengths)]
        counts = np.bincount(doc, lengths, len(texts)).astype(np.int64)
        if b"<|" in raw(texts)[0].tobytes():
            parts = np.split(out, np.cumsum(counts)[:-1])
            for k, text in enumerate(texts.to_pylist()):
                if b"<|" in text:
                    made = self.whole.encode(text.decode(), add_special_tokens=False)
                    parts[k] = np.array(made.ids, np.uint32)
                    counts[k] = len(parts[k])
            out = np.concatenate(parts)
        return out, counts


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for this tokenizer."""
    return remembered(path, lambda: WordEncoder(path))


# written table

def with_ends(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.full(len(ids) + len(counts), end_id, np.uint32)
    starts = np.cumsum(counts + 1) - counts - 1
    out[ragged(starts, counts)] = ids
    return out, counts + 1


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Encode all documents and write the segments; returns the table as written."""
    ranges = max(-(-text_bytes(docs) // RANGE_BYTES), 1)
    wanted = docs.select(F.col("doc_id").cast("long"), "text")
    ordered = wanted.repartitionByRange(int(ranges), "doc_id").sortWithinPartitions("doc_id", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_all_but(tokenizer)
        encode, part, segment, base = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        for batch, texts in slices(batches, most=ENCODED_BYTES):
            ids, lengths = with_ends(*encode.texts(texts), end_id)
            doc_ids = batch.column("doc_id")
            missing = np.array(doc_ids.is_null()) if doc_ids.null_count else None
            known = doc_ids.fill_null(0).to_numpy().astype("<i8")
            ends, at = np.cumsum(lengths), raw(texts)[1]
            start = 0
            while start < len(lengths):  # segments end with documents
                stop = max(int(np.searchsorted(at, at[start] + SEGMENT_BYTES, side="right")) - 1, start + 1)
                stop = min(stop, len(lengths))
                own = ids[ends[start] - lengths[start] : ends[stop - 1]]
                held = known[start:stop].tobytes()
                if missing is not None and missing[start:stop].any():
                    held += np.packbits(missing[start:stop]).tobytes()
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part], pa.int32()),
                        "segment": pa.array([segment], pa.int32()),
                        "base": pa.array([base], pa.int64()),
                        "n_ids": pa.array([len(own)], pa.int64()),
                        "doc_ids": pa.array([held], pa.binary()),
                        "lengths": pa.array([encode_segment(lengths[start:stop])], pa.binary()),
                        "payload": pa.array([encode_segment(own)], pa.binary()),
                    }
                )
                segment, base, start = segment + 1, base + len(own), stop
            del ids, lengths, own, held, batch, texts
            give_back()

    made = ordered.mapInArrow(work, WRITTEN)
    made.write.parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


def read_tokens(written: DataFrame) -> DataFrame:
    """One row per document of a written table: place, length and checksum of its ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # one segment at a time
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                lengths = decode_segment(row["lengths"]).astype(np.int64)
                ids = decode_segment(row["payload"])
                n = len(lengths)
                doc_ids = np.frombuffer(row["doc_ids"], "<i8", n)
                rest = np.frombuffer(row["doc_ids"], np.uint8, -1, 8 * n)
                missing = np.unpackbits(rest, count=n).astype(bool) if len(rest) else None
                ends = np.cumsum(lengths)
                data = memoryview(ids.astype("<u4").tobytes())
                sums = [crc32(data[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(np.full(n, row["part"], np.int32)),
                        "segment": pa.array(np.full(n, row["segment"], np.int32)),
                        "doc_id": pa.array(doc_ids, mask=missing),
                        "offset": pa.array(row["base"] + ends - lengths),
                        "n_tokens": pa.array(lengths),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )
                del row, ids, data
            give_back()

    return written.mapInArrow(work, READ)


def token_index(written: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read from the files.

    ``start`` adds the ids of all parts before: one row per part, bounded by the number of
    tasks that wrote, so one window over them is small.
    """
    in_order = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        written.groupBy(F.col("part").alias("of")).agg(F.sum("n_ids").alias("n"))
        .select("of", F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias("before"))
    )
    return read_tokens(written).join(F.broadcast(parts), F.col("part") == F.col("of")).select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write to a new folder below the shared one and return the index of what was written."""
    path = new_folder(docs.sparkSession, "tokens")
    return token_index(write_tokens(docs, path, tokenizer, end_id))

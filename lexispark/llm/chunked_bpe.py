"""BPE encoding with content-defined chunks that documents share (operator 11)."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .hamming_index import ranges
from .hashing import joined
from .segments import pieces, text_of
from .tables import row_key, stored, tasks_for

#: A chunk ends where the low bits of the rolling hash of the last WINDOW bytes are zero: about 2^CUT_BITS bytes apart, LEAST at the least.
WINDOW, CUT_BITS, LEAST = 16, 10, 256
#: Bytes of text of one partition. A bin of more than an even share of a partition is cut in slices, but not below SLICE_BYTES.
TASK_BYTES, SLICE_BYTES = 256 << 20, 256 << 10
#: Tokens of remembered chunks, remembered words, and their bytes.
CHUNK_TOKENS, WORDS, WORD_BYTES = 1 << 22, 1 << 19, 1 << 23
_VALUES = np.random.default_rng(1111).integers(0, 1 << 32, 256, dtype=np.uint32)
_BASE = 0x9E3779B1
_SPACES = (0x20, *range(0x09, 0x0E))
_IS_SPACE = np.isin(np.arange(256), _SPACES)
#: Signs that end a word of letters before them.
STOPS = b",.;:!?"
_IS_STOP = np.isin(np.arange(256), list(STOPS))
_IS_LETTER = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))


# ---- chunks -----------------------------------------------------------------------------

def rolling(data: np.ndarray) -> np.ndarray:
    """At each place the polynomial hash of the WINDOW bytes up to it, by doubling the window."""
    h, done = _VALUES[data], 1
    while done < WINDOW:
        longer = h.copy()
        longer[done:] += h[:-done] * np.uint32(pow(_BASE, done, 1 << 32))
        h, done = longer, 2 * done
    return h


def cuts(data: np.ndarray, bounds: np.ndarray) -> list[list[int]]:
    """For each of the joined texts its chunk bounds within ``data``, both ends included.

    A cut depends on the bytes before it in its text alone, and never divides a character.
    """
    ends = np.flatnonzero(rolling(data) & np.uint32((1 << CUT_BITS) - 1) == 0) + 1
    ends = ends[ends < len(data)]
    ends = ends[data[ends] & 0xC0 != 0x80]
    of_text = np.searchsorted(ends, bounds)
    out = []
    for k, (first, last) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        at = [first]
        for end in ends[of_text[k]:of_text[k + 1]].tolist():
            if end - at[-1] >= LEAST and end < last:
                at.append(end)
        if last > first:
            at.append(last)
        out.append(at)
    return out


def chunk_key(chunk: bytes) -> bytes:
    return blake2b(chunk, digest_size=16).digest()


# ---- encoding ---------------------------------------------------------------------------

@lru_cache(maxsize=4)
def loaded(vocabulary: str) -> Tokenizer:
    """The tokenizer of a vocabulary file's content, without truncation and padding; once per worker."""
    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def separable(tokenizer: Tokenizer) -> bool:
    """True if no token of the tokenizer depends on what lies beyond white space or the end of a word.

    Shown by probes for its pattern; special tokens, which are searched in the raw text, must hold no such place.
    """
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    words = ("ab", "'s", "7", "--", "Été", "語", "x'll")
    special = "|".join(t.content for t in tokenizer.get_added_tokens_decoder().values()).encode()
    whole = not any(_IS_SPACE[c] for c in special) and not any(
        _IS_LETTER[a] and _IS_STOP[b] for a, b in zip(special, special[1:]))
    return (whole and all(ids(f"{a}{chr(s)}{b}") == ids(a) + ids(b) for a in words for b in words for s in _SPACES)
            and all(ids(f"ab{chr(s)}{b}") == ids("ab") + ids(f"{chr(s)}{b}") for b in ("", *words) for s in STOPS))


@dataclass
class Chunk:
    """A chunk as all its documents share it.

    ``ids`` are the tokens between its first and its last white space, where they cannot depend on its
    neighbours; ``head`` and ``tail`` are the text before and after, and all is head if there is no white space.
    ``first`` and ``last`` are the outermost words inside, which a seam has to encode to the same tokens.
    """

    head: bytes
    ids: np.ndarray
    tail: bytes
    first: bytes = b""
    last: bytes = b""
    n_first: int = 0
    n_last: int = 0
    open: bool = False


class Words:
    """Tokens of words, each encoded when it is first met; what is remembered is bounded.

    A word ends at white space, and after a letter a-z before one of STOPS: no token reaches over these.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.forget()

    def forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.bytes, self.ids, self.starts, self.counts = 0, np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def learn(self, words: list[bytes]) -> None:
        """Encode words that are not known, all in one call."""
        made = self.tokenizer.encode([w.decode() for w in words], is_pretokenized=True, add_special_tokens=False)
        counts = np.bincount(np.array(made.word_ids, np.int64), minlength=len(words))
        self.places.update(zip(words, range(len(self.places), len(self.places) + len(words))))
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(counts) - counts)
        self.counts = np.append(self.counts, counts)
        self.ids = np.append(self.ids, np.array(made.ids, np.int32))
        self.bytes += sum(map(len, words))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Tokens of each of several texts that white space or their ends bound."""
        data = np.frombuffer(b" ".join(texts), np.uint8)
        bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
        at = np.flatnonzero(~_IS_SPACE[data])
        solid = data[at]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (_IS_LETTER[solid[:-1]] & _IS_STOP[solid[1:]])
        start = np.flatnonzero(new)
        ends = pa.py_buffer(np.append(start, len(solid)).astype(np.int64))
        coded = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(start), [None, ends, pa.py_buffer(solid)]).dictionary_encode()
        words = coded.dictionary.to_pylist()
        unknown = [w for w in words if w not in self.places]
        if unknown:
            if len(self.places) + len(unknown) > WORDS or self.bytes > WORD_BYTES:
                self.forget()
                unknown = words
            self.learn(unknown)
        place = np.array([self.places[w] for w in words], np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
        counts = self.counts[place]
        ids = self.ids[ranges(self.starts[place], self.starts[place] + counts)]
        sums = np.append(0, np.cumsum(counts))[np.searchsorted(at[start], bounds)]
        return [ids[a:b] for a, b in zip(sums, sums[1:])]


class Encoder:
    """Encodes the documents of one task, every chunk once; what it remembers is bounded."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.words = tokenizer, Words(tokenizer)
        self.chunks: OrderedDict[bytes, Chunk] = OrderedDict()
        self.held = 0

    def made(self, chunks: list[bytes]) -> list[Chunk]:
        """Encode chunks that are not remembered."""
        bounds = []
        for chunk in chunks:
            spaces = np.flatnonzero(_IS_SPACE[np.frombuffer(chunk, np.uint8)])
            bounds.append((int(spaces[0]) + 1, int(spaces[-1]) + 1) if len(spaces) else None)
        insides = [c[at[0]:at[1]] if at else b"" for c, at in zip(chunks, bounds)]
        first = [(i.split(maxsplit=1) or [b""])[0] for i in insides]
        last = [(i.rsplit(maxsplit=1) or [b""])[-1] for i in insides]
        ids = self.words.encode(insides)
        ends = [len(i) for i in self.words.encode(first + last)]
        return [Chunk(c[:at[0]], i.copy(), c[at[1]:], a, b, m, n) if at else Chunk(c, i.copy(), b"", open=True)
                for c, at, i, a, b, m, n in zip(chunks, bounds, ids, first, last, ends, ends[len(chunks):])]

    def remember(self, chunks: Iterable[bytes]) -> dict[bytes, Chunk]:
        """All given chunks, encoded: those met before from memory."""
        keys = {c: chunk_key(c) for c in chunks}
        new = [c for c, key in keys.items() if key not in self.chunks]
        for chunk, made in zip(new, self.made(new)):
            self.chunks[keys[chunk]] = made
            self.held += len(made.ids) + len(made.head) + 16
        found = {}
        for chunk, key in keys.items():
            self.chunks.move_to_end(key)
            found[chunk] = self.chunks[key]
        while self.held > CHUNK_TOKENS and self.chunks:
            _, old = self.chunks.popitem(last=False)
            self.held -= len(old.ids) + len(old.head) + 16
        return found

    def documents(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """Tokens of each text from its chunks: their insides, and between two of them the repaired seam.

        A chunk without white space belongs to the seam as a whole, which then reaches to the next chunk.
        Where a seam does not agree with its neighbours it grows to the whole text.
        """
        known = self.remember(c for chunks in texts for c in chunks)
        seams: list[Seam] = []
        for number, chunks in enumerate(texts):
            left, middle = None, b""
            for chunk in map(known.__getitem__, chunks):
                middle += chunk.head
                if not chunk.open:
                    seams.append(Seam(number, left, middle, chunk))
                    left, middle = chunk, chunk.tail
            seams.append(Seam(number, left, middle, None))
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        broken = set()
        for seam, made in zip(seams, self.tokenizer.encode_batch_fast([s.text() for s in seams], add_special_tokens=False)):
            ids = seam.repaired(np.array(made.ids, np.int32))
            if ids is None:
                broken.add(seam.number)
            else:
                parts[seam.number] += [ids, seam.right.ids] if seam.right else [ids]
        return [self.whole(chunks) if k in broken else np.concatenate(own) for k, (chunks, own) in enumerate(zip(texts, parts))]

    def whole(self, chunks: list[bytes]) -> np.ndarray:
        return np.array(self.tokenizer.encode(b"".join(chunks).decode(), add_special_tokens=False).ids, np.int32)


@dataclass
class Seam:
    """The text from the last white space of one chunk to the first of another; None at an end of the document."""

    number: int
    left: Chunk | None
    middle: bytes
    right: Chunk | None

    def text(self) -> str:
        """What is encoded anew: the seam, and the whole words on both sides of it."""
        return ((self.left.last + b" " if self.left else b"") + self.middle + (self.right.first if self.right else b"")).decode()

    def repaired(self, ids: np.ndarray) -> np.ndarray | None:
        """The seam's own tokens, if the words beside it got the tokens that the chunks have for them; else None."""
        left = self.left.ids[len(self.left.ids) - self.left.n_last:] if self.left else ids[:0]
        right = self.right.ids[:self.right.n_first] if self.right else ids[:0]
        end = len(ids) - len(right)
        agreed = end >= len(left) and np.array_equal(ids[:len(left)], left) and np.array_equal(ids[end:], right)
        return ids[len(left):end] if agreed else None


def decoded(tokenizer: Tokenizer, ids: list[np.ndarray], tokens: pa.Array) -> pa.Array:
    """Texts of lists of tokens; without a decoder the library joins ``tokens`` by spaces."""
    if tokenizer.decoder is not None:
        return pa.array(tokenizer.decode_batch([i.tolist() for i in ids], skip_special_tokens=False), pa.string())
    bounds = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    strings = tokens.take(pa.array(np.concatenate(ids)))
    return pc.binary_join(pa.ListArray.from_arrays(bounds, strings), " ")


# ---- documents --------------------------------------------------------------------------

def _chunks(piece: pa.RecordBatch) -> list[list[bytes]]:
    """The chunks of every text of a piece of a batch."""
    data, bounds = joined(text_of(piece))
    raw = data.tobytes()
    return [[raw[a:b] for a, b in zip(at, at[1:])] for at in cuts(data, bounds)]


def _binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns of each document, and its bin: the smallest key of its chunks, null for an empty text.

    Documents that share most of their chunks share the smallest of them as often.
    """
    for batch in batches:
        for piece in pieces(batch):
            bins = [min((int.from_bytes(chunk_key(c)[:8], "big", signed=True) for c in chunks), default=None)
                    for chunks in _chunks(piece)]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(bins, pa.int64())], names=[*piece.schema.names, "bin"])


def _encoded(vocabulary):
    """Ids and decoded text of the documents of a task, which come bin by bin."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(vocabulary.value)
        encoder = Encoder(tokenizer)
        names = tokenizer.get_vocab(with_added_tokens=True)
        tokens = pa.array(sorted(names, key=names.get), pa.string())
        for batch in batches:
            for piece in pieces(batch):
                ids = encoder.documents(_chunks(piece))
                bounds = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(bounds, np.concatenate(ids))
                yield pa.RecordBatch.from_arrays([piece.column(0), lists, decoded(tokenizer, ids, tokens)],
                                                 names=["doc_id", "ids", "decoded"])
    return encode


def encoded(docs: DataFrame, vocabulary_file: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every whole text, as the tokenizers library encodes and decodes it.

    ``vocabulary_file`` is a file of that library on the driver, for a tokenizer to which white space is only
    a separator; its content goes to the tasks. Special tokens in a text are recognised, none are added.

    Texts are cut where a rolling hash of their bytes says so, hence equal passages into equal chunks. The
    text moves once: documents go to the bin of their smallest chunk key, so that those which share
    chunks meet in a task, and each chunk is encoded there once. Where chunks meet, the broken words are
    encoded anew together with the nearest whole words; their tokens have to agree with the
    chunks' own (``Encoder.seam``). Bins of many documents are dealt out in slices.

    Defined cases: a null or empty text has no tokens and decodes to an empty one; texts without white
    space are one seam; repeated rows and null ids are rows of their own; other columns are ignored; an
    empty table gives an empty one.
    """
    spark = docs.sparkSession
    with open(vocabulary_file, encoding="utf-8") as file:
        vocabulary = file.read()
    if not separable(loaded(vocabulary)):
        raise ValueError(f"white space is part of tokens of {vocabulary_file}")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    binned = texts.mapInArrow(_binned, "doc_id bigint, text string, bin bigint")
    weights = texts.mapInArrow(_weighed, "bin bigint, weight bigint").groupBy("bin").agg(F.sum("weight").alias("weight"))
    n, hot = split_bins(weights)
    own = binned.join(F.broadcast(hot), "bin", "left")
    part = F.pmod(row_key(), F.coalesce("slices", F.lit(1)))
    empty = F.when(F.col("bin").isNull(), row_key())
    dealt = own.select("doc_id", "text", F.coalesce("bin", empty).alias("bin"), part.alias("part")).repartition(n, "bin", "part")
    return dealt.sortWithinPartitions("bin").select("doc_id", "text").mapInArrow(
        _encoded(spark.sparkContext.broadcast(vocabulary)), "doc_id bigint, ids array<int>, decoded string")


def _weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bin and bytes of each document that has text."""
    for batch in _binned(batches):
        sizes = pc.binary_length(batch.column(1)).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(2), sizes], names=["bin", "weight"]).filter(batch.column(2).is_valid())


def split_bins(weights: DataFrame) -> tuple[int, DataFrame]:
    """Partitions to deal the text to, and the slices of each bin above a partition's share: fewer such bins than partitions."""
    weights = stored(weights)
    total = weights.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    n = max(int(weights.sparkSession.conf.get("spark.sql.shuffle.partitions")), tasks_for(total, TASK_BYTES))
    share = max(total // n, SLICE_BYTES)
    return n, weights.where(F.col("weight") > share).select("bin", F.ceil(F.col("weight") / share).alias("slices"))

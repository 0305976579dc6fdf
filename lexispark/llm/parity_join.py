"""Jaccard self-join of documents by parity sketches (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lexispark.settings import broadcast_if_small

from .graph import components
from .hashing import joined, mix, shingle_sets
from .segments import pieces, text_of
from .tables import finished, stored

#: Documents of one word that a task compares with as many others at a time; it changes the work, not the links.
BLOCK_DOCS = 256
#: Bytes of a bit sketch that travel with a document's words, and pairs that are compared at a time.
BRIEF_BYTES, COMPARED = 256, 50_000
#: Centres that a document is compared with before its other candidates; it changes the work, not the links.
CENTRES = 4
#: Bits of a sketch for each token; it changes how many pairs are read in full, not the links.
SKETCH_BITS = 4
#: Tokens from which on sketch words count as equally full; it changes which words are heads, not the links.
FULL_WORD = 15


def _keys(value: np.ndarray, at: np.ndarray, upper: int, held: np.ndarray) -> np.ndarray:
    """Keys of sketch words by value, place and band: 48 bits of a hash below how few tokens a word holds.

    Words agree where all their tokens do, so equal words hold equally many, and order by key is the same for all
    documents. Words of many tokens come first: texts that share passages only, or stock phrases, seldom agree in them.
    """
    few = FULL_WORD - np.minimum(held, FULL_WORD)
    return (few << 48) | (mix(value ^ mix(at + np.uint64(upper << 32))) >> np.uint64(16)).view(np.int64)


def bands(tokens: np.ndarray, percent: int) -> list[tuple[np.ndarray, int]]:
    """For each size band of a set (sorted distinct 64-bit hashes): keys of its sketch words, and how many a link shares.

    Size bands are powers of two. In a band, a sketch is a row of bits, 2^32 for each of its words;
    each token flips one bit, so equal tokens cancel in the XOR of two sketches and the Hamming
    distance is at most the size of the symmetric difference. Sets a, b with a Jaccard index of
    at least ``percent`` differ in at most k = (|a| + |b|) (100 - percent) / (100 + percent)
    tokens, hence in at most k words: of the words of a that are not zero, all but k agree with b.
    The keys are these words, of its own band and, where a partner can be larger than that, of
    the next. If all but k are too few, the keys are all words, zero ones too, which has the same
    guarantee. A word is held as the XOR of hashes of its set bits. Keys of words with more tokens are
    smaller (see ``_keys``).
    """
    n = len(tokens)
    if not n:
        return []
    largest = n * 100 // percent
    if largest == n:  # only equal sets can be linked
        return [(mix(np.array([np.bitwise_xor.reduce(mix(tokens)) + np.uint64(n)], np.uint64)).view(np.int64) >> 16, 1)]
    high = tokens >> np.uint64(32)
    bits = mix(tokens & np.uint64(0xFFFFFFFF))
    out = []
    band = n.bit_length() - 1
    for upper in (2 << band, 4 << band):
        if upper > 2 << band and largest < upper // 2:
            break
        differ = (n + min(largest, upper - 1)) * (100 - percent) // (100 + percent)
        most = 2 * (upper - 1) * (100 - percent) // (100 + percent)
        words = 64 * upper if upper <= 64 else most + most // 8 + 16
        place = (high * np.uint64(words)) >> np.uint64(32)
        begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        value, at, held = np.bitwise_xor.reduceat(bits, begin), place[begin], np.diff(begin, append=n)
        value, at, held = value[value != 0], at[value != 0], held[value != 0]
        need = max(len(value) - differ, 2)
        if len(value) - differ < 2:
            full, tokens_at = np.zeros(words, np.uint64), np.zeros(words, np.int64)
            full[at], tokens_at[at] = value, held
            value, at, held = full, np.arange(words, dtype=np.uint64), tokens_at
        out.append((_keys(value, at, upper, held), need))
    return out


def sketch_words(tokens: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """Keys of all sketch words of a set (see ``bands``), and how many of them a link shares."""
    found = bands(tokens, percent)
    if not found:
        return np.empty(0, np.int64), 0
    return np.concatenate([keys for keys, _ in found]), min(len(tokens), *(need for _, need in found))


def head_words(tokens: np.ndarray, percent: int) -> np.ndarray:
    """The smallest h - m + 1 of the h keys of each band, of which a link shares m: linked sets share one of these."""
    found = [np.sort(keys)[:max(len(keys) - need, 0) + 1] for keys, need in bands(tokens, percent)]
    return np.concatenate(found) if found else np.empty(0, np.int64)


def bit_sketch(tokens: np.ndarray) -> bytes:
    """Parity bits of a set, SKETCH_BITS for each token its band has room for; each token flips one bit."""
    size = SKETCH_BITS << max(len(tokens).bit_length(), 3)
    flips = np.zeros(size, np.uint8)  # wraps at 256, which keeps the parity
    np.add.at(flips, (mix(tokens) & np.uint64(size - 1)).astype(np.int64), np.uint8(1))
    return np.packbits(flips & 1).tobytes()


def brief(sketch: bytes) -> bytes:
    """A bit sketch folded to at most BRIEF_BYTES; distances of folded sketches are bounds of the same kind."""
    bits = np.frombuffer(sketch, np.uint8)
    while len(bits) > BRIEF_BYTES:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits.tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """Hamming distance of two bit sketches, at most the size of the symmetric difference of their sets.

    The longer one is folded: the XOR of its halves is the sketch of half the size.
    """
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for piece in pieces(batch):
            yield piece, shingle_sets(*joined(text_of(piece)))


FACTS = ("doc_id bigint, n_shingles bigint, need bigint, key_a bigint, key_b bigint, sketch binary, brief binary, heads array<bigint>")


def _facts(percent: int):
    """Of each row: size of the set, shared words of a link, 128 bits that equal sets share, bit sketch, head words."""
    def measure(batches):
        for piece, sets in _sets(batches):
            mixed = [mix(s) for s in sets]
            ints = ([len(s) for s in sets], [sketch_words(s, percent)[1] for s in sets],
                    np.array([np.bitwise_xor.reduce(m) for m in mixed], np.uint64).view(np.int64),
                    np.array([m.sum(dtype=np.uint64) for m in mixed], np.uint64).view(np.int64))
            heads = [head_words(s, percent) for s in sets]
            sketches = [bit_sketch(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), *(pa.array(x, pa.int64()) for x in ints), pa.array(sketches, pa.binary()),
                 pa.array([brief(s) for s in sketches], pa.binary()), pa.array(heads, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "need", "key_a", "key_b", "sketch", "brief", "heads"])
    return measure


def _words(percent: int):
    """(doc_id, word): all sketch words of each document."""
    def emit(batches):
        for piece, sets in _sets(batches):
            keys = [sketch_words(s, percent)[0] for s in sets]
            docs = np.repeat(np.array(piece.column(0).to_pylist(), np.int64), [len(k) for k in keys])
            if len(docs):
                yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(np.concatenate(keys))], names=["doc_id", "word"])
    return emit


def _tokens(batches):
    """(doc_id, token): the distinct shingles of each document."""
    for piece, sets in _sets(batches):
        ids = np.repeat(np.array(piece.column(0).to_pylist(), np.int64), [len(s) for s in sets])
        if len(ids):
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(sets).view(np.int64))],
                                             names=["doc_id", "token"])


def _linked(percent: int):
    """Verify pairs on whole texts: distinct shingles of both, compared exactly."""
    def verify(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                piece, good = batch.slice(at, 64), []
                for a, b in zip(shingle_sets(*joined(piece.column(2))), shingle_sets(*joined(piece.column(3)))):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    good.append(both > 0 and 100 * both >= percent * (len(a) + len(b) - both))
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1)], names=["a", "b"]).filter(
                    pa.array(good, pa.bool_()))
    return verify


def _close(percent: int):
    """Pairs whose bit sketches do not rule out a link."""
    def look(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                n, m, x, y = (piece.column(i).to_pylist() for i in range(2, 6))
                good = [least_difference(s, t) * (100 + percent) <= (k + j) * (100 - percent) for k, j, s, t in zip(n, m, x, y)]
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1)], names=["a", "b"]).filter(
                    pa.array(good, pa.bool_()))
    return look


def _verified(texts: DataFrame, facts: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked. Bit sketches are compared first; texts move only for pairs that these leave."""
    left, right = (facts.select(F.col("doc_id").alias(d), F.col("n_shingles").alias(f"n_{d}"), F.col("sketch").alias(f"s_{d}"))
                   for d in "ab")
    close = stored(pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(
        _close(percent), "a bigint, b bigint").distinct())
    ids = stored(close.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    texts = texts.join(broadcast_if_small(ids), "doc_id", "left_semi")
    left = close.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left")), "a")
    both = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(_linked(percent), "a bigint, b bigint")


def similar_documents(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    The set of a document is its distinct runs of five words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased
    (with fewer words, all of them as one). Two documents are linked if 100 * intersection >= percent *
    union; ``component_id`` is the smallest doc_id that links lead to, its own included.

    1. Equal sets are merged. Linked documents share a head word (see ``head_words``), one of the fullest; those that
       share one with nobody are done. Of the others, all sketch words (see ``bands``) are taken;
       words that occur once are dropped, and documents that are left with fewer words than a link needs.
    2. Stars: each document is compared with the first document of the words it shares, the one it
       shares most words with. This connects groups of near copies with one pair each. A second
       round compares what can still have a link with the centres of larger components.
    3. The rest: documents that share a word and are not connected yet. Of its words, each document
       keeps the rarest: with h of them, of which a link shares m, the first h - m + 1 (see ``_firsts``).
       Documents with a word in common are compared in blocks, in the tasks that hold them: only pairs that
       sizes, shared shingles (see ``_able``) and bit sketches leave become rows (see ``_candidates``).
    4. Every pair is verified on the whole texts; the links give the components.

    Defined cases: no words, or a null text: no shingles, linked with nothing; rows that share a doc_id
    are one node, each with its own n_shingles; a null doc_id is no node, its component_id is
    null; other columns are ignored; an empty table gives no rows.
    """
    return finished(lambda: _similar(docs, percent))


def _similar(docs: DataFrame, percent: int) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    facts = stored(texts.mapInArrow(_facts(percent), FACTS))
    sizes = facts.select("doc_id", "n_shingles", "need")
    rows = facts.where("doc_id is not null and n_shingles > 0")
    same = broadcast_if_small(stored(rows.groupBy("key_a", "key_b").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")))
    copies = rows.join(same, ["key_a", "key_b"]).where("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))

    heads = rows.join(same, ["key_a", "key_b"], "left").where("first is null or first = doc_id").select(
        "doc_id", F.explode("heads").alias("word"))
    near = finished(lambda: _near(texts, heads, sizes, percent))
    centre = near.groupBy("word").agg(F.max_by("doc_id", F.struct("degree", -F.col("doc_id"))).alias("first"))
    counted = near.join(centre, "word").where("doc_id <> first").groupBy("doc_id", "first").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("doc_id").agg(F.max_by("first", F.struct("n", -F.col("first"))).alias("first"))
    stars = _verified(texts, facts, best.select(F.least("first", "doc_id").alias("a"), F.greatest("first", "doc_id").alias("b")).distinct(), percent)
    links = stored(stars.unionByName(copies))
    roots = components(links)

    near = near.select("word", "doc_id")
    rest = _rest(near, roots, texts, sizes, percent)
    links = stored(links.unionByName(_verified(texts, facts, stored(_to_centres(rest)), percent)))
    rest = _rest(rest.select("word", "doc_id"), components(links), texts, sizes, percent)
    pairs = _candidates(_firsts(rest), facts, percent).distinct()
    links = links.unionByName(_verified(texts, facts, stored(pairs), percent))
    roots = components(stored(links)).withColumnRenamed("node", "doc_id")
    return sizes.join(roots, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))


def _repeated(words: DataFrame) -> DataFrame:
    """The rows (doc_id, word) whose word several documents have. All rows move once, whatever the number of such words."""
    same = Window.partitionBy("word")
    return words.withColumns({"low": F.min("doc_id").over(same), "high": F.max("doc_id").over(same)}).where(
        "low < high").select("word", "doc_id")


def _near(texts: DataFrame, heads: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(word, doc_id, degree): sketch words that occur twice, of documents that share a head word and hold as many as a link needs."""
    alive = stored(_repeated(heads).select("doc_id").distinct())
    words = texts.join(broadcast_if_small(alive), "doc_id", "left_semi").mapInArrow(_words(percent), "doc_id bigint, word bigint")
    near = stored(_repeated(words))

    # the first document of a word is the one with most shared words, the centre of its near copies
    degree = stored(near.groupBy("doc_id").agg(F.count(F.lit(1)).alias("degree")).join(
        sizes.groupBy("doc_id").agg(F.min("need").alias("need")), "doc_id").where("degree >= need").drop("need"))
    return near.join(broadcast_if_small(degree), "doc_id")


def _rest(near: DataFrame, roots: DataFrame, texts: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Rows of ``near`` (word, doc_id) whose word occurs under several roots, n times in all, of documents that can have a link."""
    rooted = near.join(broadcast_if_small(roots.withColumnRenamed("node", "doc_id")), "doc_id", "left").select(
        "word", "doc_id", F.coalesce("root", "doc_id").alias("root"))
    apart = stored(rooted.groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("word", "n"))
    rest = stored(rooted.join(broadcast_if_small(apart), "word"))
    return stored(rest.drop("root").join(broadcast_if_small(_able(texts, rest, sizes, percent)), "doc_id"))


def _to_centres(rest: DataFrame) -> DataFrame:
    """(a, b): each document with the CENTRES documents of other, larger components that it shares most words with.

    Of each word, the centre is the document nearest to the others of the largest component, by its overlap.
    """
    # rows of documents, not of words, meet their component: one component may hold a large share of all rows
    docs = stored(rest.select("doc_id", "root").distinct())
    members = stored(docs.groupBy("root").agg(F.count(F.lit(1)).alias("members")))
    each = stored(docs.join(broadcast_if_small(members), "root").select("doc_id", "members"))
    sized = stored(rest.join(broadcast_if_small(each), "doc_id"))
    order = F.struct("members", -F.col("root"), F.col("overlap") / F.col("size"), -F.col("doc_id"))
    centre = sized.groupBy("word").agg(F.max_by(F.struct(F.col("doc_id").alias("centre"), F.col("root").alias("other")), order).alias("c"))
    shared = sized.join(centre.select("word", "c.centre", "c.other"), "word").where("root <> other").groupBy(
        "doc_id", "centre").agg(F.count(F.lit(1)).alias("shared"))
    most = Window.partitionBy("doc_id").orderBy(F.desc("shared"), "centre")
    best = shared.withColumn("at", F.row_number().over(most)).where(F.col("at") <= CENTRES)
    return best.select(F.least("doc_id", "centre").alias("a"), F.greatest("doc_id", "centre").alias("b")).distinct()


def _able(texts: DataFrame, rest: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(doc_id, root, need, size, words, overlap) of the documents of ``rest`` that can still have a link.

    ``words`` counts their rows. ``overlap`` counts their shingles that a document of another root
    has too: no intersection is larger, so one below ``percent`` of the own size rules out every link.
    """
    facts = sizes.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("need").alias("need"), F.min("n_shingles").alias("size"))
    docs = stored(rest.groupBy("doc_id", "root").agg(
        F.count(F.lit(1)).alias("words")).join(
        facts, "doc_id").where("words >= need"))
    few = broadcast_if_small(docs.select("doc_id", "root"))
    tokens = texts.join(few.select("doc_id"), "doc_id", "left_semi").mapInArrow(
        _tokens, "doc_id bigint, token bigint").join(few, "doc_id")
    apart = tokens.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(
        "low < high").select("token")
    overlap = tokens.join(apart, "token").groupBy("doc_id").agg(F.count(F.lit(1)).alias("overlap"))
    return stored(docs.join(overlap, "doc_id").where(100 * F.col("overlap") >= percent * F.col("size")).select(
        "doc_id", "root", "need", "size", "words", "overlap"))


def _firsts(rest: DataFrame) -> DataFrame:
    """The rows of the rarest words of each document, as many as make sure that linked documents share one.

    All documents order words by (n, word). Of the h words of a document a link shares at least m = ``need``, so m - 1
    of them come after the first that is shared: that is one of the first h - m + 1, on both sides. Rows that
    repeat a word only make the list longer.
    """
    rare = Window.partitionBy("doc_id").orderBy("n", "word")
    return rest.withColumn("at", F.row_number().over(rare)).where("at <= words - need + 1").select(
        "word", "doc_id", "root", "size", "overlap").distinct()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that come sorted by (word, low, high), in tables that end where a group ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in ("word", "low", "high")]
        last = np.logical_and.reduce([k == k[-1] for k in keys])
        begin = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if held and (begin or any(held[-1].column(c)[-1].as_py() != k[0] for c, k in zip(("word", "low", "high"), keys))):
            whole = [*held, batch.slice(0, begin)]
            yield pa.Table.from_batches(whole)
            held = []
        elif begin:
            yield pa.Table.from_batches([batch.slice(0, begin)])
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def _folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches of ``size`` bytes or more, folded to that size, as rows of 32-bit words; zero for shorter ones."""
    out = np.zeros((len(sketches), size), np.uint8)
    for i, sketch in enumerate(sketches):
        bits = np.frombuffer(sketch, np.uint8)
        if len(bits) >= size:
            out[i] = np.bitwise_xor.reduce(bits.reshape(-1, size), 0)
    return out.view(np.uint32)


def _compare(percent: int):
    """Of rows sorted by (word, low, high): the pairs of each group that can be linked."""
    def compare(batches):
        for table in _groups(batches):
            word, low, high, own, doc, root, size, overlap = (
                table.column(c).to_numpy() for c in ("word", "low", "high", "own", "doc_id", "root", "size", "overlap"))
            sketches = table.column("brief").to_pylist()
            length = np.array([len(s) for s in sketches])
            folded = {}
            change = (word[1:] != word[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
            ends = np.append(np.flatnonzero(change) + 1, len(word))
            end = ends[np.searchsorted(ends, np.arange(len(word)), side="right")]
            partners = end - np.arange(len(word)) - 1
            begin = np.concatenate([[0], np.cumsum(partners)])
            for at in range(0, int(begin[-1]), COMPARED):
                pair = np.arange(at, min(at + COMPARED, int(begin[-1])))
                i = np.searchsorted(begin, pair, side="right") - 1
                j = i + 1 + pair - begin[i]
                both = size[i] + size[j]
                good = (root[i] != root[j]) & (doc[i] != doc[j]) & ((low[i] == high[i]) | (own[i] != own[j]))
                good &= np.minimum(overlap[i], overlap[j]) * (100 + percent) >= percent * both
                i, j, both = i[good], j[good], both[good]
                least = np.minimum(length[i], length[j])
                near = np.zeros(len(i), bool)
                for width in np.unique(least).tolist():
                    if width not in folded:
                        folded[width] = _folded(sketches, width)
                    of = least == width
                    far = np.bitwise_count(folded[width][i[of]] ^ folded[width][j[of]]).sum(1, dtype=np.int64)
                    near[of] = far * (100 + percent) <= both[of] * (100 - percent)
                found = np.unique(np.sort(np.stack([doc[i[near]], doc[j[near]]], 1), 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])
    return compare


def _candidates(rows: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of different roots that share a word of ``rows`` and that sizes, overlaps and sketches do not rule out.

    The documents of a word are cut by a hash into blocks of about BLOCK_DOCS. Two blocks, or one by itself, meet in a
    group, which a task goes through with a bounded number of pairs at a time; only what is left becomes rows.
    """
    rows = stored(rows)
    blocks = rows.groupBy("word").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1").select(
        "word", F.ceil(F.col("docs") / BLOCK_DOCS).cast("int").alias("blocks"))
    briefs = facts.where("doc_id is not null").groupBy("doc_id", "n_shingles", "brief").agg(F.lit(1).alias("one")).drop("one")
    dealt = rows.join(blocks, "word").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(briefs, "doc_id").select(
        "word", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "doc_id", "root",
        F.col("n_shingles").alias("size"), "overlap", "brief")
    order = ["word", "low", "high"]
    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(_compare(percent), "a bigint, b bigint")

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from lexispark.llm import chunked_bpe
from lexispark.llm.chunked_bpe import Encoder, cuts, separable, loaded
from lexispark.llm.hashing import joined

FILE = path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, lang string, ids string, bin int"
ODD = ["<|endoftext|>", "<|startoftext|>x", "<|endof", "it's", "I'LL", "ΣΑΣ", "İı", "a,'s", "end.'t", "x;<|endoftext|>", "y.≠≠", "é", "́a", "​", " ", "　",
       "\x85", "\x1c", "语言模型", "ﬁ", "🙂🙂", "--'--", "½²", "٣٤", "a\x00b", "\t", "\r\n", " ", "  \x0b\x0c"]


def library():
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def odd_texts(seed, n):
    """Texts of odd pieces and shared passages, with and without white space between them."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéñ'0") for _ in range(rng.randint(1, 9)))
    shared = [" ".join(word() for _ in range(600)) for _ in range(4)]
    texts = []
    for _ in range(n):
        gap = rng.choice([" ", "", "\n", " \t "])
        parts = [rng.choice(ODD) if rng.random() < 0.2 else word() for _ in range(rng.randint(0, 900))]
        parts.insert(rng.randint(0, len(parts)), rng.choice(shared))
        texts.append(gap.join(parts))
    return texts


def chunked(texts):
    data, bounds = joined(pa.array(texts))
    return [[data[a:b].tobytes() for a, b in zip(at, at[1:])] for at in cuts(data, bounds)]


def test_chunks_follow_content():
    texts = odd_texts(1, 60)
    parts = chunked(texts)
    assert ["".join(c.decode() for c in chunks) for chunks in parts] == texts
    assert max(map(len, parts)) > 3
    alone = [chunked([t])[0] for t in texts]
    assert alone == parts  # whatever is processed with a text


def test_encoder_equals_the_library(monkeypatch):
    want = library()
    monkeypatch.setattr(chunked_bpe, "WORDS", 700)
    monkeypatch.setattr(chunked_bpe, "CHUNK_TOKENS", 9000)
    encoder = Encoder(loaded(open(FILE, encoding="utf-8").read()))
    for seed in range(12):
        texts = odd_texts(seed, 10)
        got = encoder.documents(chunked(texts))
        assert [g.tolist() for g in got] == [want.encode(t, add_special_tokens=False).ids for t in texts]
        assert encoder.held <= 9000


def test_any_cut_is_repaired():
    """Cuts anywhere between characters, inside special tokens and runs of white space too."""
    rng, want = random.Random(9), library()
    encoder = Encoder(loaded(open(FILE, encoding="utf-8").read()))
    for _ in range(300):
        text = rng.choice(["", " "]).join(rng.choice(ODD + ["don't", "abc", "x1"]) for _ in range(rng.randint(1, 12)))
        at = sorted({0, len(text), *(rng.randint(0, len(text)) for _ in range(rng.randint(0, 6)))})
        chunks = [text[a:b].encode() for a, b in zip(at, at[1:])]
        assert encoder.documents([chunks])[0].tolist() == want.encode(text, add_special_tokens=False).ids


def test_every_character_beside_white_space():
    """White space separates whatever stands next to it."""
    want, encoder = library(), Encoder(loaded(open(FILE, encoding="utf-8").read()))
    letters = [chr(c) for c in range(0x3100) if c not in range(0xD800, 0xE000)]
    for first in range(0, len(letters), 64):
        text = " ".join(letters[first:first + 64]) + "\n" + "\t".join(f"a{c}b" for c in letters[first:first + 64])
        text += " " + " ".join(f"ab{s}{c}" for c in letters[first:first + 64] for s in ",.;:!?")
        assert encoder.words.encode([text.encode()])[0].tolist() == want.encode(text, add_special_tokens=False).ids


def test_disagreement_falls_back_to_the_whole_text(monkeypatch):
    monkeypatch.setattr(chunked_bpe.Seam, "repaired", lambda *_: None)
    encoder, text = Encoder(loaded(open(FILE, encoding="utf-8").read())), "one two three"
    assert encoder.documents([[b"one t", b"wo three"]])[0].tolist() == library().encode(text, add_special_tokens=False).ids


def test_tokenizers_with_space_in_tokens_are_refused(spark):
    assert separable(library())
    with pytest.raises(ValueError, match="white space"):
        chunked_bpe.encoded(spark.createDataFrame([], SCHEMA), path("byte_bpe_50k.json"))


def test_documents(spark, monkeypatch):
    """Null, empty and long texts, repeated rows, null ids, hot bins, clashing columns, an empty table."""
    monkeypatch.setattr(chunked_bpe, "SLICE_BYTES", 100)
    texts = odd_texts(5, 40)
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(texts)] + [(100 + i, texts[0], "x", "y", 1) for i in range(60)]
    rows += [(300, None, None, None, None), (301, "", None, None, None), (None, "a b", None, None, None), rows[3], rows[3],
             (302, "é" * 300_000, None, None, None), (303, "w " * 200_000, None, None, None), (304, " ", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted((r["doc_id"] or -1, tuple(r["ids"]), r["decoded"]) for r in chunked_bpe.encoded(df, FILE).collect())
    tokenizer, want = library(), []
    for i, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want.append((i or -1, tuple(ids), tokenizer.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    _, hot = chunked_bpe.split_bins(df.select("doc_id", "text").na.fill("").mapInArrow(chunked_bpe._weighed, "bin bigint, weight bigint")
                                    .groupBy("bin").agg({"weight": "sum"}).withColumnRenamed("sum(weight)", "weight"))
    assert hot.count() >= 1 and min(r["slices"] for r in hot.collect()) > 1
    assert chunked_bpe.encoded(df.where("false"), FILE).count() == 0

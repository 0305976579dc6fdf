import random
import re

import duckdb
from pyspark.sql import functions as F

from catalog.oracle import words
from lexispark.functions.stemming import stem, stem_tokens, stem_word
from lexispark.functions.text import (
    ENGLISH_STOPWORDS, STOPWORDS, regex_tokens, remove_stopwords, word_count, word_tokens)

PYTHON_PATTERN = re.compile(r"[\#\@\w](?:['\-]?\w){,24}", re.UNICODE)


def tokens(spark, column, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r[0] for r in df.select("i", column("text").alias("t")).orderBy("i").select("t").collect()]


def random_texts(pieces, n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_stopword_lists():
    assert len(ENGLISH_STOPWORDS) == 179 and len(set(STOPWORDS)) == 200


def test_pattern_tokens_by_hand(spark):
    long_run = "x" * 60
    texts = ["#tag @user state-of-the-art don't x_1 été ½", long_run, "", "the Java java"]
    assert tokens(spark, regex_tokens, texts) == [
        ["#tag", "@user", "state-of-the-art", "x_1", "été", "½"],
        ["x" * 25, "x" * 25, "x" * 10], [], ["java", "java"]]


def test_pattern_tokens_agree_with_the_unicode_pattern(spark):
    pieces = ["a", "Bé", "ß", "9", "_", "-", "'", "#", "@", " ", ".", "--", "ñandú", "the", "x" * 20, "\n"]
    texts = random_texts(pieces, 2000, 1)
    want = [[t for t in PYTHON_PATTERN.findall(x.lower()) if t not in STOPWORDS] for x in texts]
    assert tokens(spark, regex_tokens, texts) == want


def test_word_tokens_by_hand(spark):
    text = ("I don't know, can't go. It's John's state-of-the-art U.S. plan: cannot 'quote' a/b (x) end. "
            "gonna gonna 3,5 née")
    want = "know ca go john plan quote x end gon na gon na née".split()
    assert tokens(spark, word_tokens, [text, "", "12 34"]) == [want, [], []]
    assert tokens(spark, word_count, [text, "", None, "12"]) == [len(want), 0, 0, 0]


def test_word_tokens_agree_with_the_rule_chain(spark):
    pieces = ["ab", "c", "n", "don", "n't", "'s", "'ll", "'t", "'", ".", ",", ":", ";", "-", "--", " ", " ", "\n",
              "5", "(", "“", "é", "can", "not", "gonna", "/", "$"]
    texts = random_texts(pieces, 20000, 2)
    connection = duckdb.connect()
    connection.execute("CREATE TABLE t (i INT, text VARCHAR)")
    connection.executemany("INSERT INTO t VALUES (?, ?)", [(i, x) for i, x in enumerate(texts[:8000])])
    want = [r[0] for r in connection.execute(f"SELECT {words('text')} FROM t ORDER BY i").fetchall()]
    got = tokens(spark, word_tokens, texts[:8000])
    assert [(x, g, w) for x, g, w in zip(texts, got, want) if g != w][:9] == []


def test_stopword_removal_keeps_duplicates(spark):
    df = spark.createDataFrame([(["java", "the", "java", "also"],)], "w array<string>")
    assert df.select(remove_stopwords("w")).first()[0] == ["java", "java"]


def test_stems_of_the_published_vocabulary():
    pairs = """
    consign consign consigned consign consigning consign consignment consign consist consist
    consistency consist consistently consist consolation consol consolatory consolatori
    consolidate consolid knack knack knackeries knackeri knavish knavish kneaded knead
    knightly knight knitting knit knotted knot knowledge knowledg skies sky dying die news news
    happily happili relational relat hopping hop hoping hope generously generous
    communication communic proceeding proceed ties tie cries cri gas gas gaps gap kiwis kiwi
    herring herring yes yes saying say by by singly singl
    """.split()
    words_, stems = pairs[::2], pairs[1::2]
    assert [stem(w) for w in words_] == stems


def test_stemming_columns(spark):
    df = spark.createDataFrame([(1, ["running", "cats", "cats"]), (2, []), (3, None)], "i int, w array<string>")
    got = df.select("i", stem_tokens("w").alias("s")).orderBy("i").collect()
    assert [r.s for r in got] == [["run", "cat", "cat"], [], None]
    exploded = df.select(F.explode("w").alias("w")).select(stem_word("w").alias("s"))
    assert sorted(r.s for r in exploded.collect()) == ["cat", "cat", "run"]

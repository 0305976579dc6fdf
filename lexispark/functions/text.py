"""Tokenisers and stopwords as column expressions (no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The token pattern, the English stopword list and the corpus words.
TOKEN_PATTERN = r"[#@\p{L}\p{N}_](?:['\-]?[\p{L}\p{N}_]){0,24}"

ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against
between into through during before after above below to from up down in out on off
over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can
will just don don't should should've now d ll m o re ve y ain aren aren't couldn
couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't
ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn
wasn't weren weren't won won't wouldn wouldn't
""".split()

CORPUS_STOPWORDS = """
category references also external links may first see history people one two part
thumb including second following many however would became
""".split()

STOPWORDS = ENGLISH_STOPWORDS + CORPUS_STOPWORDS

# Penn Treebank word splitting. What separates words, besides blanks:
_GAP = r"""[\s;@#$%&?!()\[\]{}<>"“”«»…]"""
_GAP_OR_END = rf"(?:{_GAP}|\z)"
_NEGATION = r"n't(?:\P{L}|\z)"
_CLITIC = rf"'(?:s|m|d|ll|re|ve)(?:\P{{L}}|\z|{_NEGATION})"
# A word is a run of letters that starts after a gap, with or without an opening quote, and is
# followed by a gap, a closing quote, a clitic, the n't of a negation (its n is not part of the
# word) or, with two letters or more, by a full stop.
WORD_IN_TEXT = (
    rf"(?:(?<={_GAP})|\A)'?(\p{{L}}+)(?:(?={_GAP_OR_END}|'{_GAP_OR_END}|{_CLITIC})"
    rf"|(?<=[a-z])(?={_NEGATION})|(?<=\p{{L}}\p{{L}})(?=\.(?:{_GAP_OR_END}|{_CLITIC})))")
# A colon or comma separates unless a digit follows.
_COLON_OR_COMMA = r"[:,]([^0-9]|$)"
FUSED_WORDS = [("can", "not"), ("gon", "na"), ("wan", "na"), ("got", "ta"), ("gim", "me"), ("lem", "me")]


def _as_column(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def not_stopword(term: Column | str) -> Column:
    return ~_as_column(term).isin(STOPWORDS)


def remove_stopwords(tokens: Column | str) -> Column:
    """Drop stopwords from a token array; duplicates of other tokens stay."""
    return F.filter(_as_column(tokens), not_stopword)


def regex_tokens(text: Column | str) -> Column:
    """Tokens used for postings and for TF-IDF and binary queries."""
    lowered = F.lower(_as_column(text))
    return remove_stopwords(F.regexp_extract_all(lowered, F.lit(TOKEN_PATTERN), F.lit(0)))


def word_tokens(text: Column | str) -> Column:
    """All-letter word tokens used for document lengths and BM25 queries."""
    lowered = F.lower(_as_column(text))
    spaced = F.regexp_replace(F.replace(lowered, F.lit("--"), F.lit(" ")), _COLON_OR_COMMA, " $1")
    words = F.regexp_extract_all(spaced, F.lit(WORD_IN_TEXT), F.lit(1))
    # "cannot" and the like are two words; most texts have none of them.
    fused = [a + b for a, b in FUSED_WORDS]
    return remove_stopwords(F.when(lowered.rlike("|".join(fused)), _split_fused(words)).otherwise(words))


def _split_fused(words: Column) -> Column:
    def parts(word: Column) -> Column:
        pieces = F.array(word)
        for a, b in FUSED_WORDS:
            pieces = F.when(word == a + b, F.array(F.lit(a), F.lit(b))).otherwise(pieces)
        return pieces
    return F.flatten(F.transform(words, parts))


def word_count(text: Column | str) -> Column:
    """Document length: number of word tokens, 0 for empty or missing text."""
    return F.coalesce(F.size(word_tokens(text)), F.lit(0)).cast("bigint")

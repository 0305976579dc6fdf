"""URL filter: allow and block rules, and a weighted vocabulary (operator 6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

#: Weight of a strict and of a soft term; a url is rejected at LIMIT.
STRICT, SOFT, LIMIT = 2, 1, 2
STRICT_TERMS = ("adult", "porn", "porno", "xxx", "hentai", "milf", "camgirl", "camgirls", "escort", "escorts", "casino",
                "spam", "warez", "viagra", "cialis", "torrent", "torrents", "keygen")
SOFT_TERMS = ("ads", "bet", "bets", "betting", "bonus", "cheap", "click", "cracked", "dating", "free", "gambling", "jackpot",
              "loan", "loans", "naked", "nude", "pills", "poker", "replica", "sex", "sexy", "slots", "track", "win", "winner")
#: Every term with its weight.
VOCABULARY = {**{t: STRICT for t in STRICT_TERMS}, **{t: SOFT for t in SOFT_TERMS}}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LOWER = str.maketrans(UPPER, LOWER)
_SIGNS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#``, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct<rule, verdict> of the longest of ``rules`` (verdict, host, path) that fits, else null.

    A rule fits its host and all subdomains if the path starts with the rule's. Rules are a short
    list written by hand; of two equally long ones the first wins.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in reversed(sorted(rules, key=lambda r: -len(r[1] + r[2]))):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _automaton(vocabulary: Mapping[str, int]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for term, weight in vocabulary.items():
        automaton.add_word(term, (term, weight))
    automaton.make_automaton()
    return automaton


def term_hits(url: Column, vocabulary: Mapping[str, int] = VOCABULARY) -> Column:
    """struct<strict, soft, weight>: distinct terms in the whole url and the sum of their weights.

    One Aho-Corasick pass finds all terms; a hit counts if neither neighbour is one of a-z, 0-9 after
    A-Z is lower-cased. Null and empty urls have none.
    """
    @F.pandas_udf(StructType().add("strict", "integer").add("soft", "integer").add("weight", "integer"))
    def count(urls: pd.Series) -> pd.DataFrame:
        automaton = _automaton(vocabulary)
        out = []
        for url in urls:
            text = "" if url is None else url.translate(_LOWER)
            hits = set()
            for last, (term, weight) in automaton.iter(text):
                before, after = last - len(term), last + 1
                if (before < 0 or text[before] not in _SIGNS) and (after == len(text) or text[after] not in _SIGNS):
                    hits.add((term, weight))
            strict = sum(w >= STRICT for _, w in hits)
            out.append((strict, len(hits) - strict, sum(w for _, w in hits)))
        return pd.DataFrame(out, columns=["strict", "soft", "weight"])

    return count(url)


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]], vocabulary: Mapping[str, int] = VOCABULARY) -> DataFrame:
    """(page_id, host, path, rule, verdict, n_strict, n_soft) of every url of ``pages``.

    The verdict is that of the fitting rule; without one the url is blocked if the weights of its distinct
    terms reach LIMIT: one strict term, or two soft ones.

    Defined cases: a null url, or one without ``://``, has an empty host and path and fits no rule;
    its words are still judged (null: allowed). Repeated rows give repeated rows, a null page_id
    is kept, other columns are ignored.
    """
    parts = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
                         term_hits(F.col("url"), vocabulary).alias("hits"))
    ruled = parts.withColumn("found", fitting_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("hits.weight") >= LIMIT, "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                        F.coalesce("found.verdict", own).alias("verdict"),
                        F.col("hits.strict").alias("n_strict"), F.col("hits.soft").alias("n_soft"))

"""English (Porter2) stemming as an Arrow UDF over token arrays.

Within each Arrow batch the words are dictionary encoded, so Python sees every
distinct word once and the rest is an Arrow ``take``. Stemming is local to a row:
no vocabulary shuffle and no join back on a skewed term.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

# Fixed values of the published algorithm.
VOWELS = frozenset("aeiouy")
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = frozenset("cdeghkmnrt")
IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli",
    "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
KEPT_AFTER_PLURAL = frozenset(
    ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"])
R1_PREFIXES = ("gener", "commun", "arsen")
STEP2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous",
    "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "", "ative": "",
}
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
         "ism", "ate", "iti", "ous", "ive", "ize", "ion")

# Words that a task remembers: some 120 MB of Python objects.
MEMO_LIMIT = 500_000


def _longest_suffix(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _region_start(word: str, start: int) -> int:
    """Index just after the first non-vowel that follows a vowel, from ``start`` on."""
    for i in range(start + 1, len(word)):
        if word[i] not in VOWELS and word[i - 1] in VOWELS:
            return i + 1
    return len(word)


def _ends_in_short_syllable(word: str) -> bool:
    if len(word) == 2:
        return word[0] in VOWELS and word[1] not in VOWELS
    return (len(word) > 2 and word[-1] not in VOWELS and word[-1] not in "wxY"
            and word[-2] in VOWELS and word[-3] not in VOWELS)


def _has_vowel(part: str) -> bool:
    return any(c in VOWELS for c in part)


def _plural(word: str) -> str:
    suffix = _longest_suffix(word, ("sses", "ied", "ies", "us", "ss", "s"))
    if suffix == "sses":
        return word[:-2]
    if suffix in ("ied", "ies"):
        return word[:-2] if len(word) > 4 else word[:-1]
    if suffix == "s" and _has_vowel(word[:-2]):
        return word[:-1]
    return word


def _past_and_gerund(word: str, r1: int) -> str:
    suffix = _longest_suffix(word, ("eedly", "ingly", "edly", "eed", "ing", "ed"))
    if suffix is None:
        return word
    base = word[:-len(suffix)]
    if suffix in ("eed", "eedly"):
        return base + "ee" if len(base) >= r1 else word
    if not _has_vowel(base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if base.endswith(DOUBLES):
        return base[:-1]
    if r1 >= len(base) and _ends_in_short_syllable(base):
        return base + "e"
    return base


def _derivational(word: str, r1: int, r2: int) -> str:
    suffix = _longest_suffix(word, STEP2)
    if suffix and len(word) - len(suffix) >= r1:
        before = word[:-len(suffix)]
        allowed = {"ogi": before.endswith("l"),
                   "li": before[-1:] in LI_ENDINGS}.get(suffix, True)
        if allowed:
            word = before + STEP2[suffix]
    suffix = _longest_suffix(word, STEP3)
    if suffix and len(word) - len(suffix) >= r1:
        if suffix != "ative" or len(word) - len(suffix) >= r2:
            word = word[:-len(suffix)] + STEP3[suffix]
    suffix = _longest_suffix(word, STEP4)
    if suffix and len(word) - len(suffix) >= r2:
        before = word[:-len(suffix)]
        if suffix != "ion" or before.endswith(("s", "t")):
            word = before
    return word


def _final_letter(word: str, r1: int, r2: int) -> str:
    last = len(word) - 1
    if word.endswith("e"):
        if last >= r2 or (last >= r1 and not _ends_in_short_syllable(word[:-1])):
            return word[:-1]
    elif word.endswith("ll") and last >= r2:
        return word[:-1]
    return word


def stem(word: str) -> str:
    """Stem of one lower-case word."""
    word = word.replace("’", "'").replace("‘", "'").replace("‛", "'")
    if len(word) <= 2:
        return word
    if word in IRREGULAR:
        return IRREGULAR[word]
    word = word.removeprefix("'")
    letters = list(word)
    for i, c in enumerate(letters):
        if c == "y" and (i == 0 or letters[i - 1] in VOWELS):
            letters[i] = "Y"
    word = "".join(letters)

    prefix = next((p for p in R1_PREFIXES if word.startswith(p)), None)
    r1 = len(prefix) if prefix else _region_start(word, 0)
    r2 = _region_start(word, r1)

    suffix = _longest_suffix(word, ("'", "'s", "'s'"))
    if suffix:
        word = word[:-len(suffix)]
    word = _plural(word)
    if word in KEPT_AFTER_PLURAL:
        return word
    word = _past_and_gerund(word, r1)
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in VOWELS:
        word = word[:-1] + "i"
    word = _derivational(word, r1, r2)
    return _final_letter(word, r1, r2).replace("Y", "y")


def stem_values(values: pa.Array, memo: dict[str, str]) -> pa.Array:
    """Stem of each value; ``memo`` keeps what was stemmed before, up to MEMO_LIMIT words."""
    encoded = values.dictionary_encode()
    stems = []
    for word in encoded.dictionary.to_pylist():
        found = memo.get(word)
        if found is None:
            if len(memo) >= MEMO_LIMIT:
                memo.clear()
            found = memo[word] = stem(word)
        stems.append(found)
    return pa.array(stems, type=values.type).take(encoded.indices)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _stem_arrays(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    memo: dict[str, str] = {}
    for tokens in batches:
        # A null row has no tokens; give it an empty slot and put the null back.
        stems = stem_values(tokens.flatten(), memo)
        sizes = pc.fill_null(pc.list_value_length(tokens), 0)
        ends = pc.cumulative_sum(sizes.cast(pa.int32()))
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
        yield pa.ListArray.from_arrays(offsets, stems, mask=tokens.is_null())


@F.arrow_udf(T.StringType())
def _stem_words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    memo: dict[str, str] = {}
    for words in batches:
        yield stem_values(words, memo)


def stem_tokens(tokens: Column | str) -> Column:
    """Stem every token of an array column, order and duplicates kept."""
    return _stem_arrays(tokens)


def stem_word(word: Column | str) -> Column:
    """Stem of a single-word column."""
    return _stem_words(word)


# Ship the functions of this module inside the UDF, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

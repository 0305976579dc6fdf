"""Porter2 stemming of English as one chain of DuckDB CTEs, from the published description.

One step of the algorithm is one CTE over the distinct words. ``r1`` and ``r2`` are the lengths before the two
regions; a suffix lies in a region if as many letters are left without it. The longest suffix of a
list is what an alternation finds at the end of a word, as the leftmost match.
"""

from __future__ import annotations

from lexispark.functions.stemming import (
    DOUBLES, IRREGULAR, KEPT_AFTER_PLURAL, LI_ENDINGS, R1_PREFIXES, STEP2, STEP3, STEP4)

VOWEL, OTHER = "[aeiouy]", "[^aeiouy]"
SHORT = f"(^{VOWEL}{OTHER}|{OTHER}{VOWEL}[^aeiouywxY])$"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _case(word: str, table: dict[str, str], other: str) -> str:
    return f"CASE {word} " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in table.items()) + f" ELSE {other} END"


def _ending(word: str, suffixes) -> str:
    """The longest of ``suffixes`` that ends ``word``, '' if none does."""
    return f"regexp_extract({word}, {_q('(' + '|'.join(suffixes) + ')$')})"


def _start(word: str, first: str) -> str:
    """Letters of ``word`` up to the first consonant after a vowel, from place ``first`` on; all if there is none."""
    pair = f"regexp_extract(substr({word}, {first} + 1), '^.*?{VOWEL}{OTHER}')"
    return f"CASE WHEN {pair} = '' THEN length({word}) ELSE {first} + length({pair}) END"


def _cut(word: str, suffix: str) -> str:
    return f"left({word}, length({word}) - length({suffix}))"


def stem_ctes(terms: str) -> dict[str, str]:
    """CTEs that end in ``stems(term, stem)`` for the distinct words of ``terms(term)``."""
    prefixes = "|".join(R1_PREFIXES)
    doubles = "|".join(DOUBLES)
    left = "length(w) - length(suffix)"
    return {
        "stem_words": f"SELECT DISTINCT term, regexp_replace(term, '[’‘‛]', '''', 'g') AS plain FROM {terms}",
        "stem_marked": f"""
SELECT term, plain, regexp_replace(regexp_replace(regexp_replace(plain, '^''', ''), '^y', 'Y'), '({VOWEL})y', '\\1Y', 'g') AS w
FROM stem_words WHERE length(plain) > 2 AND plain NOT IN ({', '.join(map(_q, IRREGULAR))})""",
        "stem_r1": f"""
SELECT term, w, CASE WHEN regexp_matches(w, '^({prefixes})') THEN length(regexp_extract(w, '^({prefixes})'))
  ELSE {_start('w', '0')} END AS r1 FROM stem_marked""",
        "stem_r2": f"""
SELECT term, regexp_replace(w, '(''s''|''s|'')$', '') AS w, r1, {_start('w', 'r1')} AS r2 FROM stem_r1""",
        "stem_plural": f"""
SELECT term, r1, r2, CASE
  WHEN w LIKE '%sses' THEN left(w, -2)
  WHEN w LIKE '%ied' OR w LIKE '%ies' THEN left(w, CASE WHEN length(w) > 4 THEN -2 ELSE -1 END)
  WHEN w LIKE '%us' OR w LIKE '%ss' THEN w
  WHEN w LIKE '%s' AND regexp_matches(left(w, -2), '{VOWEL}') THEN left(w, -1)
  ELSE w END AS w FROM stem_r2""",
        "stem_past_suffix": f"""
SELECT term, r1, r2, w, {_ending('w', ('eedly', 'ingly', 'edly', 'eed', 'ing', 'ed'))} AS suffix
FROM stem_plural WHERE w NOT IN ({', '.join(sorted(map(_q, KEPT_AFTER_PLURAL)))})""",
        "stem_past": f"""
SELECT term, r1, r2, CASE
  WHEN suffix = '' THEN w
  WHEN suffix IN ('eed', 'eedly') THEN CASE WHEN {left} >= r1 THEN base || 'ee' ELSE w END
  WHEN NOT regexp_matches(base, '{VOWEL}') THEN w
  WHEN regexp_matches(base, '(at|bl|iz)$') THEN base || 'e'
  WHEN regexp_matches(base, '({doubles})$') THEN left(base, -1)
  WHEN r1 >= length(base) AND regexp_matches(base, '{SHORT}') THEN base || 'e'
  ELSE base END AS w FROM (SELECT *, {_cut('w', 'suffix')} AS base FROM stem_past_suffix)""",
        "stem_y": f"SELECT term, r1, r2, regexp_replace(w, '^(.+{OTHER})[yY]$', '\\1i') AS w FROM stem_past",
        "stem_two": f"""
SELECT term, r1, r2, CASE
  WHEN suffix = '' OR {left} < r1 OR (suffix = 'ogi' AND base NOT LIKE '%l')
    OR (suffix = 'li' AND NOT regexp_matches(base, '[{''.join(sorted(LI_ENDINGS))}]$')) THEN w
  ELSE base || {_case('suffix', STEP2, "''")} END AS w
FROM (SELECT *, {_cut('w', 'suffix')} AS base FROM (SELECT *, {_ending('w', STEP2)} AS suffix FROM stem_y))""",
        "stem_three": f"""
SELECT term, r1, r2, CASE WHEN suffix = '' OR {left} < r1 OR (suffix = 'ative' AND {left} < r2) THEN w
  ELSE {_cut('w', 'suffix')} || {_case('suffix', STEP3, "''")} END AS w
FROM (SELECT *, {_ending('w', STEP3)} AS suffix FROM stem_two)""",
        "stem_four": f"""
SELECT term, r1, r2, CASE WHEN suffix = '' OR {left} < r2 OR (suffix = 'ion' AND NOT regexp_matches(base, '[st]$')) THEN w
  ELSE base END AS w
FROM (SELECT *, {_cut('w', 'suffix')} AS base FROM (SELECT *, {_ending('w', STEP4)} AS suffix FROM stem_three))""",
        "stem_five": f"""
SELECT term, replace(CASE
  WHEN w LIKE '%e' AND (length(w) - 1 >= r2 OR (length(w) - 1 >= r1 AND NOT regexp_matches(left(w, -1), '{SHORT}'))) THEN left(w, -1)
  WHEN w LIKE '%ll' AND length(w) - 1 >= r2 THEN left(w, -1) ELSE w END, 'Y', 'y') AS stem FROM stem_four""",
        "stems": f"""
SELECT term, stem FROM stem_five
UNION ALL SELECT term, w FROM stem_plural WHERE w IN ({', '.join(sorted(map(_q, KEPT_AFTER_PLURAL)))})
UNION ALL SELECT term, {_case('plain', IRREGULAR, 'plain')} FROM stem_words
WHERE length(plain) <= 2 OR plain IN ({', '.join(map(_q, IRREGULAR))})""",
    }

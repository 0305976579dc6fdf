"""License scan: known sentences and ordered rules over their identifiers (operator 9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Where sentences end: at punctuation before a blank or the end of a line, and at a line without words.
SENTENCE_END = r"(?<![.!?;:])[.!?;:]++(?=[ \t\r\n]|$)|(?>\r\n|[\r\n])[^a-z0-9\r\n]*(?=[\r\n])"
#: Stands for the end of a sentence in a normalised text.
_END = "\x01"
#: What is not part of a word; the same pattern works in DuckDB.
NOT_WORD = "[^a-z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Normalised sentences of published licences and notices, and their identifiers.
SENTENCES = {
    "all rights reserved": "rights",
    "released under the mit license": "mit_notice",
    "licensed under the mit license": "mit_notice",
    "the mit license": "mit_title",
    "mit license": "mit_title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit_condition",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit_warranty",
    "licensed under the apache license version 2 0": "apache_notice",
    "licensed under the apache license version 2 0 the license": "apache_notice",
    "you may not use this file except in compliance with the license": "apache_use",
    "you may obtain a copy of the license at": "apache_copy",
    "this work is licensed under the gnu general public license version 3": "gpl3_notice",
    "this program is free software": "gpl_free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl_terms",
    "either version 3 of the license or at your option any later version": "gpl_version3",
    "either version 2 of the license or at your option any later version": "gpl_version2",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl_hope",
    "licensed under cc by nc 4 0": "ccbync_notice",
    "licensed under cc by 4 0": "ccby_notice",
    "licensed under cc by sa 4 0": "ccbysa_notice",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby_notice",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "ccbync_notice",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "ccbysa_notice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd_binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd_names",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl_notice",
    "this is free and unencumbered software released into the public domain": "unlicense_notice",
}
# Licence, category, ordered identifiers. A longer rule goes before its parts.
RULES = (
    ("MIT", "permissive", ("mit_title", "mit_grant", "mit_condition", "mit_warranty")),
    ("MIT", "permissive", ("mit_grant", "mit_condition", "mit_warranty")),
    ("MIT", "permissive", ("mit_grant", "mit_condition")),
    ("MIT", "permissive", ("mit_notice",)),
    ("BSD-3-Clause", "permissive", ("bsd_grant", "bsd_source", "bsd_binary", "bsd_names")),
    ("BSD-2-Clause", "permissive", ("bsd_grant", "bsd_source", "bsd_binary")),
    ("Apache-2.0", "permissive", ("apache_notice", "apache_use", "apache_copy")),
    ("Apache-2.0", "permissive", ("apache_notice",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl_free", "gpl_terms", "gpl_version3", "gpl_hope")),
    ("GPL-3.0-or-later", "copyleft", ("gpl_terms", "gpl_version3")),
    ("GPL-2.0-or-later", "copyleft", ("gpl_free", "gpl_terms", "gpl_version2", "gpl_hope")),
    ("GPL-2.0-or-later", "copyleft", ("gpl_terms", "gpl_version2")),
    ("GPL-3.0", "copyleft", ("gpl3_notice",)),
    ("MPL-2.0", "copyleft", ("mpl_notice",)),
    ("CC-BY-4.0", "permissive", ("ccby_notice",)),
    ("CC-BY-SA-4.0", "copyleft", ("ccbysa_notice",)),
    ("CC-BY-NC-4.0", "noncommercial", ("ccbync_notice",)),
    ("Unlicense", "permissive", ("unlicense_notice",)),
    ("Proprietary", "reserved", ("rights",)),
)
# The comma form of the GPL headers, one sentence. The SQL does not have them.
COMMA_SENTENCES = {
    f"you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version {n} of the license or at your option any later version": f"gpl_terms_version{n}"
    for n in (2, 3)
}
COMMA_RULES = tuple(
    (f"GPL-{n}.0-or-later", "copyleft", ids)
    for n in (2, 3) for ids in (("gpl_free", f"gpl_terms_version{n}", "gpl_hope"), (f"gpl_terms_version{n}",)))
CATEGORIES = ("reserved", "noncommercial", "copyleft", "permissive")


def rule_pattern(rules: tuple[tuple[str, str, tuple[str, ...]], ...] = RULES) -> str:
    """A pattern over identifier sequences (each identifier ends with a blank), longest rules first."""
    ordered = sorted(rules, key=lambda r: -len(r[2]))
    return "|".join("".join(f"{i} " for i in ids) for _, _, ids in ordered)


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order; unknown sentences are left out.

    A sentence may be wrapped: from one line start or sentence end on, the longest known sentence that ends at a
    line or sentence end is taken. So a title or notice also counts if it is only one line of a longer sentence.
    """
    sentences = {**SENTENCES, **COMMA_SENTENCES}
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    normal = F.translate(text, UPPER + _END, LOWER + " ")
    for pattern, to in ((SENTENCE_END, _END), (f"[^a-z0-9\r\n{_END}]+", " ")):
        normal = F.regexp_replace(normal, pattern, to)
    normal = F.concat(F.lit(_END), normal, F.lit(_END))
    for pattern, to in ((f"[ \r\n]*+{_END}[ \r\n{_END}]*+", _END), ("[ ]*+[\r\n][ \r\n]*+", "\n")):
        normal = F.regexp_replace(normal, pattern, to)
    wrapped = "|".join(s.replace(" ", "[ \n]") for s in sorted(sentences, key=len, reverse=True))
    found = F.regexp_extract_all(normal, F.lit(f"(?<=[\n{_END}])({wrapped})(?=[\n{_END}])"), F.lit(1))
    return F.transform(found, lambda s: F.element_at(known, F.translate(s, "\n", " ")))


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, n_sentences, licenses, category) of every document.

    Whole texts are cut into sentences, each normalised to lower-case ASCII words; known ones become
    identifiers, also where they are wrapped over several lines. Going left to right over the identifiers, the longest rule that starts
    there is taken. ``licenses`` lists the licences found, each once and by name, with commas between;
    ``category`` is the most restrictive one of them, or ``none``; ``n_sentences`` counts the
    identifiers, recognised by a rule or not.

    Defined cases: null and empty texts have none; repeated rows give repeated rows; a null doc_id
    is kept; other columns are ignored.
    """
    rules = (*RULES, *COMMA_RULES)
    name = F.create_map(*[F.lit(x) for n, _, ids in rules for x in ("".join(f"{i} " for i in ids), n)])
    kind = F.create_map(*[F.lit(x) for n, c in {n: c for n, c, _ in RULES}.items() for x in (n, c)])
    ids = F.coalesce(sentence_ids(F.col("text")), F.array().cast("array<string>"))
    found = docs.select(F.col("doc_id"), ids.alias("ids")).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_sentences"),
        F.sort_array(F.array_distinct(F.transform(F.regexp_extract_all(
            F.concat(F.array_join("ids", " "), F.lit(" ")), F.lit(f"({rule_pattern(rules)})"), F.lit(1)), lambda m: name[m]))).alias("names"))
    category = F.lit("none")
    for c in reversed(CATEGORIES):
        category = F.when(F.array_contains(F.transform("names", lambda n: kind[n]), c), c).otherwise(category)
    return found.select("doc_id", "n_sentences", F.array_join("names", ",").alias("licenses"), category.alias("category"))


def scan_sql() -> str:
    """The same in DuckDB SQL over ``documents``."""
    quoted = lambda s: "'" + s + "'"
    sentences = f"MAP {{{', '.join(f'{quoted(k)}: {quoted(v)}' for k, v in SENTENCES.items())}}}"
    names = {"".join(f"{i} " for i in ids): n for n, _, ids in RULES}
    kinds = {n: c for n, c, _ in RULES}
    branches = " ".join(f"WHEN list_contains(kinds, '{c}') THEN '{c}'" for c in CATEGORIES)
    as_map = lambda d: "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in d.items()) + "}"
    return f"""
WITH cut AS (
  SELECT doc_id, unnest(list_append(string_split_regex(coalesce(text, ''), '[.!?;:]+[ \\t]+|[\\r\\n]+'), NULL)) AS s,
         generate_subscripts(list_append(string_split_regex(coalesce(text, ''), '[.!?;:]+[ \\t]+|[\\r\\n]+'), NULL), 1) AS pos,
         row_number() OVER () AS r FROM documents),
ids AS (
  SELECT r, pos, doc_id, {sentences}[trim(regexp_replace(translate(s, '{UPPER}', '{LOWER}'), '{NOT_WORD}', ' ', 'g'))] AS id FROM cut),
seqs AS (
  SELECT r, any_value(doc_id) AS doc_id, count(id) AS n_sentences,
         coalesce(string_agg(id, ' ' ORDER BY pos) FILTER (WHERE id IS NOT NULL), '') || ' ' AS seq FROM ids GROUP BY r),
named AS (
  SELECT doc_id, n_sentences, list_sort(list_distinct(list_transform(
    regexp_extract_all(seq, '{rule_pattern()}'), lambda m: {as_map(names)}[m]))) AS names FROM seqs),
kinded AS (SELECT *, list_transform(names, lambda n: {as_map(kinds)}[n]) AS kinds FROM named)
SELECT doc_id, n_sentences, array_to_string(names, ',') AS licenses, CASE {branches} ELSE 'none' END AS category FROM kinded"""

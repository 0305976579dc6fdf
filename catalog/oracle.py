"""DuckDB SQL with the same results as the queries of :mod:`catalog.queries`.

Named CTEs are declared once with ``cte`` and pulled in, with what they need, by name.
"""

from __future__ import annotations

import re

from lexispark.functions.text import FUSED_WORDS, STOPWORDS, TOKEN_PATTERN

from catalog.fixtures import COVERAGE, LINK
from catalog.porter2 import stem_ctes


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STOP = ", ".join(quoted(w) for w in STOPWORDS)

WORD_RULES = [
    (r"[;@#$%&?!()\[\]{}<>\"“”«»…]", " "),
    (r"--", " "),
    (r"([:,])([^0-9])", r" \2"),
    (r"[:,]$", " "),
    (r"([a-z])n't([^\p{L}]|$)", r"\1 n't\2"),
    (r"([^' ])('s|'m|'d|'ll|'re|'ve)([^\p{L}]|$)", r"\1 \2\3"),
    (r"(\p{L}{2,})\.(\s|$)", r"\1 . \2"),
    (r"'(\s|$)", r" \1"),
    (r"(^|\s)'", r"\1 "),
]


def pattern_tokens(text: str) -> str:
    """Pattern tokens without stopwords."""
    return (f"list_filter(regexp_extract_all(lower({text}), {quoted(TOKEN_PATTERN)}), "
            f"lambda t: t NOT IN ({STOP}))")


def words(text: str) -> str:
    """Word tokens without stopwords."""
    expression = f"lower({text})"
    for pattern, replacement in WORD_RULES:
        expression = f"regexp_replace({expression}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
    pieces = f"list_filter(string_split_regex({expression}, '\\s+'), lambda t: regexp_matches(t, '^\\p{{L}}+$'))"
    cases = " ".join(f"WHEN '{a}{b}' THEN ['{a}', '{b}']" for a, b in FUSED_WORDS)
    return (f"list_filter(flatten(list_transform({pieces}, lambda t: CASE t {cases} ELSE [t] END)), "
            f"lambda t: t NOT IN ({STOP}))")


def bucket(term: str, n: int | str) -> str:
    return f"('0x' || substr(md5({term}), 1, 10))::BIGINT % {n}"


CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> str:
    CTES[name] = sql
    return name


def with_ctes(sql: str) -> str:
    """Prepend the CTEs that ``sql`` mentions, directly or through other CTEs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_0-9]+\b", text)):
            if word in CTES and word not in needed:
                visit(CTES[word])
                needed.append(word)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{name} AS (\n{CTES[name]}\n)" for name in needed) + "\n" + sql


# ---- fixtures ---------------------------------------------------------------------------

cte("body_docs", "SELECT doc_id, text FROM documents")
cte("title_docs", "SELECT doc_id, split_part(text, chr(10), 1) AS text FROM documents")
cte("titled", "SELECT doc_id, text AS title FROM title_docs")
cte("asked", "SELECT item_id AS query_id, text AS query FROM benchmark WHERE length(text) > 0")
cte("link_lists", f"SELECT page_id, regexp_extract_all(html, {quoted(LINK)}, 1) AS texts FROM pages")
cte("links", """
SELECT page_id AS source_id, (pos - 1)::INTEGER AS pos,
       (page_id * 7 + pos - 1) % (SELECT count(*) FROM documents) AS doc_id, text
FROM (SELECT page_id, unnest(texts) AS text, generate_subscripts(texts, 1) AS pos FROM link_lists)""")
cte("views_by_doc", "SELECT user_id AS doc_id, count(*)::BIGINT AS views FROM events GROUP BY user_id")
cte("rank_by_doc", "SELECT c_custkey AS doc_id, c_acctbal AS page_rank FROM customer")



def statistics_sql(field: str) -> str:
    return f"""
SELECT term, count(*)::BIGINT AS df, sum(tf)::BIGINT AS term_total,
       ln((SELECT n_docs FROM {field}_corpus) / count(*)) AS idf
FROM {field}_postings GROUP BY term"""


def norms_sql(field: str) -> str:
    return f"""
SELECT doc_id, sqrt(sum((tf / dl * idf) * (tf / dl * idf))) AS norm
FROM {field}_postings JOIN {field}_stats USING (term) JOIN {field}_lengths USING (doc_id)
WHERE dl > 0 GROUP BY doc_id"""


for field in ("body", "title"):
    cte(f"{field}_postings", f"""
SELECT term, doc_id, count(*)::BIGINT AS tf
FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), {quoted(TOKEN_PATTERN)})) AS term FROM {field}_docs)
WHERE term NOT IN ({STOP}) GROUP BY ALL""")
    cte(f"{field}_lengths", f"SELECT doc_id, len({words('text')})::BIGINT AS dl FROM {field}_docs")
    cte(f"{field}_corpus", f"SELECT count(*)::BIGINT AS n_docs, avg(dl) AS avgdl FROM {field}_lengths")
    cte(f"{field}_stats", statistics_sql(field))
    cte(f"{field}_norms", norms_sql(field))

cte("link_counts", f"""
SELECT source_id, pos, doc_id, term, count(*)::BIGINT AS tf
FROM (SELECT source_id, pos, doc_id, unnest(regexp_extract_all(lower(text), {quoted(TOKEN_PATTERN)})) AS term
      FROM links)
WHERE term NOT IN ({STOP}) GROUP BY ALL""")
cte("link_postings", "SELECT DISTINCT term, doc_id, tf FROM link_counts")

cte("asked_words", f"SELECT query_id, {words('query')} AS tokens FROM asked")
cte("asked_patterns", f"SELECT query_id, {pattern_tokens('query')} AS tokens FROM asked")
for kind in ("words", "patterns"):
    cte(f"query_{kind}", f"""
SELECT query_id, unnest(tokens) AS term, (generate_subscripts(tokens, 1) - 1)::INTEGER AS pos
FROM asked_{kind}""")

# ---- the same, stemmed ------------------------------------------------------------------

cte("words_to_stem", "SELECT term FROM body_postings UNION SELECT term FROM title_postings "
    "UNION SELECT term FROM query_words UNION SELECT term FROM query_patterns")
for name, text in stem_ctes("words_to_stem").items():
    cte(name, text)
for kind in ("words", "patterns"):
    cte(f"query_{kind}_stemmed", f"SELECT query_id, stem AS term, pos FROM query_{kind} JOIN stems USING (term)")
for field in ("body", "title"):
    cte(f"{field}_stemmed_postings", f"SELECT stem AS term, doc_id, sum(tf)::BIGINT AS tf FROM {field}_postings "
        "JOIN stems USING (term) GROUP BY ALL")
    cte(f"{field}_stemmed_lengths", f"SELECT * FROM {field}_lengths")
    cte(f"{field}_stemmed_corpus", f"SELECT * FROM {field}_corpus")
    cte(f"{field}_stemmed_stats", statistics_sql(f"{field}_stemmed"))
    cte(f"{field}_stemmed_norms", norms_sql(f"{field}_stemmed"))

cte("relevant", f"""
SELECT query_id, doc_id
FROM pattern_counts JOIN body_postings USING (term)
JOIN (SELECT query_id, count(*) AS n_words FROM pattern_counts GROUP BY ALL) USING (query_id)
GROUP BY query_id, doc_id, n_words HAVING count(*) >= {COVERAGE} * n_words""")

cte("named_terms", f"""
SELECT vec_id, term FROM (
  SELECT {bucket('term', '(SELECT count(*) FROM embeddings)')} AS vec_id, term,
         row_number() OVER (PARTITION BY {bucket('term', '(SELECT count(*) FROM embeddings)')}
                            ORDER BY df DESC, term DESC) AS r
  FROM (SELECT term, count(*) AS df FROM body_postings GROUP BY term)) WHERE r = 1""")
cte("vectors", "SELECT term, embedding::DOUBLE[] AS vec FROM named_terms JOIN embeddings USING (vec_id)")

# ---- scores -----------------------------------------------------------------------------


def ranked(hits: str, n: int | None, score: str = "score") -> str:
    cut = f" QUALIFY rank <= {n}" if n else ""
    kind = "INTEGER" if n else "BIGINT"
    return (f"SELECT query_id, doc_id, {score} AS score, row_number() OVER (PARTITION BY query_id "
            f"ORDER BY {score} DESC, doc_id)::{kind} AS rank FROM ({hits}){cut}")


def tfidf_weights(field: str, patterns: str) -> str:
    return f"""
SELECT query_id, doc_id, term, sum(tf / dl * idf) AS w_d
FROM (SELECT DISTINCT query_id, term FROM {patterns}) JOIN {field}_postings USING (term)
JOIN {field}_lengths USING (doc_id) JOIN {field}_stats USING (term)
WHERE dl > 0 GROUP BY ALL"""


for field, patterns, tag in (("body", "query_patterns", ""), ("body_stemmed", "query_patterns_stemmed", "_stemmed")):
    cte(f"pattern_counts{tag}", f"SELECT query_id, term, count(*)::BIGINT AS qtf FROM {patterns} GROUP BY ALL")
    cte(f"pattern_lengths{tag}", f"SELECT query_id, sum(qtf)::BIGINT AS length FROM pattern_counts{tag} GROUP BY ALL")
    cte(f"document_weights{tag}", tfidf_weights(field, patterns))
    cte(f"query_weights{tag}", f"""
SELECT query_id, term, qtf / length * log10((SELECT n_docs FROM body_corpus) / (df + 0.0000001)) AS w_q
FROM pattern_counts{tag} JOIN pattern_lengths{tag} USING (query_id) JOIN {field}_stats USING (term)""")
    cte(f"cosines{tag}", f"""
SELECT query_id, doc_id, round(sum(w_d * w_q) / (any_value(norm) * any_value(query_norm)), 6) AS score
FROM document_weights{tag} JOIN query_weights{tag} USING (query_id, term)
JOIN (SELECT query_id, sqrt(sum(w_q * w_q)) AS query_norm FROM query_weights{tag} GROUP BY ALL) USING (query_id)
JOIN {field}_norms USING (doc_id) GROUP BY query_id, doc_id""")
    cte(f"{field}_tfidf_100", ranked(f"SELECT * FROM cosines{tag}", 100))


def bm25(field: str, k1: float, b: float, terms: str = "query_words", extra: str = "") -> str:
    """BM25 scores; ``extra`` adds candidate rows (query_id, term, doc_id, tf)."""
    return f"""
SELECT query_id, doc_id,
       round(sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * ({k1} + 1)
                 / (tf + {k1} * (1 - {b} + {b} * dl / avgdl))), 6) AS score
FROM (SELECT query_id, term, doc_id, tf FROM {field}_postings
      JOIN (SELECT DISTINCT query_id, term FROM {terms}) USING (term) {extra})
JOIN {field}_stats USING (term) JOIN {field}_lengths USING (doc_id), {field}_corpus
GROUP BY query_id, doc_id"""


for name, k1, b in (("default", "2.0::DOUBLE", "0.75::DOUBLE"), ("tuned", "1.5::DOUBLE", "0.2::DOUBLE")):
    for field in ("body", "title"):
        cte(f"{field}_bm25_{name}", bm25(field, k1, b))
        cte(f"{field}_bm25_{name}_100", ranked(f"SELECT * FROM {field}_bm25_{name}", 100))
        cte(f"{field}_stemmed_bm25_{name}", bm25(f"{field}_stemmed", k1, b, "query_words_stemmed"))
        cte(f"{field}_stemmed_bm25_{name}_100", ranked(f"SELECT * FROM {field}_stemmed_bm25_{name}", 100))


def with_links(field: str) -> str:
    """Candidates by link text that the field itself does not have for the term."""
    return f"""
UNION ALL
SELECT query_id, term, doc_id, max(tf) AS tf FROM link_postings
JOIN (SELECT DISTINCT query_id, term FROM query_words) USING (term)
WHERE term IN (SELECT term FROM {field}_postings)
  AND (term, doc_id) NOT IN (SELECT (term, doc_id) FROM {field}_postings) GROUP BY ALL"""


cte("title_bm25_linked", bm25("title", "1.5::DOUBLE", "0.2::DOUBLE", extra=with_links("title")))
cte("body_bm25_linked", bm25("body", "1.5::DOUBLE", "0.2::DOUBLE", extra=with_links("body")))
cte("title_bm25_linked_100", ranked("SELECT * FROM title_bm25_linked", 100))
cte("body_bm25_linked_100", ranked("SELECT * FROM body_bm25_linked", 100))

cte("title_matches", "SELECT query_id, doc_id, sum(qtf)::BIGINT AS score FROM pattern_counts "
    "JOIN title_postings USING (term) GROUP BY query_id, doc_id")
cte("link_matches", "SELECT query_id, doc_id, sum(qtf)::BIGINT AS score FROM pattern_counts "
    "JOIN link_postings USING (term) GROUP BY query_id, doc_id")


def scaled(hits: str, source: str) -> str:
    return f"""
SELECT query_id, doc_id, '{source}' AS source,
       coalesce((score - min(score) OVER q) / nullif(max(score) OVER q - min(score) OVER q, 0), 0) AS score
FROM {hits} WINDOW q AS (PARTITION BY query_id)"""


def merged(sources: dict[str, float], n: int, require_all: bool) -> str:
    lists = " UNION ALL ".join(
        f"SELECT *, {weight}::DOUBLE AS weight FROM ({scaled(hits, f's{i}')})"
        for i, (hits, weight) in enumerate(sources.items()))
    kept = f"""
WHERE query_id IN (SELECT query_id FROM ({lists}) GROUP BY query_id
                   HAVING count(DISTINCT source) = {len(sources)})""" if require_all else ""
    return ranked(f"SELECT query_id, doc_id, round(sum(weight * score), 6) AS merged "
                  f"FROM ({lists}) {kept} GROUP BY query_id, doc_id", n, "merged")


def signals(name: str, body: str, title: str) -> None:
    cte(f"{name}_ids", f"SELECT query_id, doc_id FROM {body} UNION SELECT query_id, doc_id FROM {title}")
    cte(f"{name}_ranks", f"SELECT query_id, doc_id, coalesce(page_rank, 0) AS score "
        f"FROM {name}_ids LEFT JOIN rank_by_doc USING (doc_id)")
    cte(f"{name}_views", f"SELECT query_id, doc_id, coalesce(views, 0)::DOUBLE AS score "
        f"FROM {name}_ids LEFT JOIN views_by_doc USING (doc_id)")


signals("fused", "body_bm25_tuned_100", "title_bm25_tuned_100")
signals("stemmed", "body_stemmed_bm25_tuned_100", "title_stemmed_bm25_tuned_100")
cte("ultimate_stemmed", merged({"body_stemmed_bm25_tuned_100": 0.8, "title_stemmed_bm25_tuned_100": 0.8,
                                "stemmed_ranks": 0.5, "stemmed_views": 0.5}, 5, True))
signals("linked", "body_bm25_linked_100", "title_bm25_linked_100")
cte("both_bm25", merged({"body_bm25_default_100": 0.5, "title_bm25_default_100": 0.5}, 20, False))
cte("tfidf_and_title", merged({"body_tfidf_100": 0.5, "title_bm25_default_100": 0.5}, 20, False))
cte("ultimate", merged({"body_bm25_tuned_100": 0.8, "title_bm25_tuned_100": 0.8,
                        "fused_ranks": 0.5, "fused_views": 0.5}, 5, True))
cte("ultimate_linked", merged({"body_bm25_linked_100": 0.8, "title_bm25_linked_100": 0.8,
                               "linked_ranks": 0.5, "linked_views": 0.5}, 5, True))


def titled_hits(hits: str) -> str:
    return f"SELECT query_id, rank, doc_id, title, score FROM {hits} JOIN titled USING (doc_id)"


def hit_rows(hits: str) -> str:
    return f"SELECT query_id, rank, doc_id, score FROM {hits}"


# ---- evaluation of body_bm25_default_100 against relevant --------------------------------

cte("n_relevant", "SELECT query_id, count(*)::BIGINT AS n_true FROM relevant GROUP BY query_id")


def judged_hits(hits: str) -> str:
    return f"""
SELECT h.query_id, h.rank, h.doc_id, n_true, r.doc_id IS NOT NULL AS hit,
       sum((r.doc_id IS NOT NULL)::INT) OVER (PARTITION BY h.query_id ORDER BY h.rank) AS so_far
FROM {hits} h JOIN n_relevant USING (query_id)
LEFT JOIN relevant r ON r.query_id = h.query_id AND r.doc_id = h.doc_id"""


def places(value: str) -> str:
    return f"round_even(({value})::DOUBLE, 3)::DOUBLE"


def measured(judged: str, k: int = 40) -> str:
    """All counts and means, one row per labelled query."""
    return f"""
SELECT query_id, n_true,
       count(*) FILTER (rank <= {k}) AS n_predicted,
       count(*) FILTER (hit AND rank <= {k}) AS n_hits,
       count(DISTINCT doc_id) FILTER (hit AND rank <= {k}) AS n_distinct_hits,
       count(DISTINCT doc_id) FILTER (hit AND rank <= n_true) AS n_r_hits,
       count(DISTINCT doc_id) FILTER (hit) AS n_common,
       min(rank) FILTER (hit AND rank <= {k}) AS first_hit,
       count(rank) > 0 AS answered,
       coalesce(round_even(avg(round({places('so_far / rank')} * 1000)) FILTER (hit AND rank <= {k}), 0) / 1000, 0) AS map,
       coalesce({places(f'avg(so_far / rank) FILTER (hit AND rank <= {k})')}, 0) AS ap
FROM n_relevant LEFT JOIN {judged} USING (query_id, n_true) GROUP BY query_id, n_true"""


cte("judged", judged_hits("body_bm25_default_100"))
cte("measures", measured("judged"))
RECALL = places("n_hits / n_true")
PRECISION = places("n_hits / 40")
UNIVERSE = "(SELECT count(*) FROM documents)"
FALLOUT = places(f"(n_predicted - n_distinct_hits)::DOUBLE / nullif({UNIVERSE} - n_true, 0)")
F_SCORE = (f"CASE WHEN {PRECISION} = 0 THEN 0.0::DOUBLE ELSE "
           f"{places(f'2 * {PRECISION} / ({PRECISION} + {RECALL})')} END")
F1 = (f"CASE WHEN {PRECISION} = 0 THEN 0.0::DOUBLE ELSE "
      f"{places(f'2 * {PRECISION} * {RECALL} / ({PRECISION} + {RECALL})')} END")

# ---- splits and grid ---------------------------------------------------------------------

cte("labelled", "SELECT DISTINCT query_id FROM relevant")
cte("splits", """
SELECT fold, query_id,
       row_number() OVER (PARTITION BY fold ORDER BY md5(query_id || ':' || fold), query_id)
         <= floor(0.8::DOUBLE * (SELECT count(*) FROM labelled)) AS is_train
FROM labelled, (SELECT unnest(range(5))::INTEGER AS fold)""")
cte("grid_small", measured("(" + judged_hits("(SELECT * FROM body_bm25_default_100 WHERE rank <= 10)") + ")"))
cte("grid_maps", "SELECT 10 AS num_results, query_id, map FROM grid_small "
    "UNION ALL SELECT 100, query_id, map FROM measures")
cte("grid_results", """
SELECT fold, num_results::INTEGER AS num_results, false AS expand, 6::INTEGER AS similar_words,
       0.7::DOUBLE AS min_similarity, false AS stemming,
       round(coalesce(avg(map) FILTER (is_train), 0), 6) AS train_map,
       round(coalesce(avg(map) FILTER (NOT is_train), 0), 6) AS test_map
FROM grid_maps JOIN splits USING (query_id) GROUP BY fold, num_results""")

# ---- neighbours --------------------------------------------------------------------------


def neighbours(queries: str, vectors: str, n: int) -> str:
    return f"""
SELECT q.id AS query, v.id AS id, round(list_cosine_similarity(q.vec, v.vec), 6) AS similarity,
       row_number() OVER (PARTITION BY q.id
                          ORDER BY round(list_cosine_similarity(q.vec, v.vec), 6) DESC, v.id)::INTEGER AS rank
FROM {queries} q JOIN {vectors} v ON q.id <> v.id QUALIFY rank <= {n}"""


cte("embedded", "SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings")
cte("embedded_terms", "SELECT term AS id, vec FROM vectors")
cte("asked_vectors", "SELECT id, vec FROM embedded_terms WHERE id IN (SELECT term FROM query_words) "
    "OR id IN (SELECT term FROM query_words_stemmed)")
cte("near_words", neighbours("asked_vectors", "embedded_terms", 6))
for tag, field in (("", "body"), ("_stemmed", "body_stemmed")):
    for n in (3, 6):
        cte(f"expansions{tag}_{n}", f"""
SELECT query_id, pos, rank, near_word FROM query_words{tag} q
JOIN (SELECT query, rank, ({words('id')})[1] AS near_word FROM near_words WHERE similarity > 0.3 AND rank <= {n}) n
  ON n.query = q.term WHERE near_word IS NOT NULL""")
        cte(f"expanded_terms{tag}_{n}", f"SELECT query_id, term FROM query_words{tag} "
            f"UNION ALL SELECT query_id, near_word FROM expansions{tag}_{n}")
        cte(f"expanded_bm25{tag}_{n}", bm25(field, "2.0::DOUBLE", "0.75::DOUBLE", f"expanded_terms{tag}_{n}"))
        cte(f"expanded_bm25{tag}_{n}_100", ranked(f"SELECT * FROM expanded_bm25{tag}_{n}", 100))


# ---- the grid over every parameter ------------------------------------------------------

GRID_RUNS = [("body_bm25_default_100", False, (3, 6), False), ("body_stemmed_bm25_default_100", False, (3, 6), True),
             *[(f"expanded_bm25{'_stemmed' * stemming}_{n}_100", True, (n,), stemming) for stemming in (False, True) for n in (3, 6)]]
grid_rows = []
for i, (hits, expand, similar, stemming) in enumerate(GRID_RUNS):
    for n in (10, 100):
        cte(f"grid_{i}_{n}", measured("(" + judged_hits(f"(SELECT * FROM {hits} WHERE rank <= {n})") + ")"))
        grid_rows += [f"SELECT {n} AS num_results, {expand} AS expand, {w} AS similar_words, {stemming} AS stemming, query_id, map "
                      f"FROM grid_{i}_{n}" for w in similar]
cte("grid_all", f"""
SELECT fold, num_results::INTEGER AS num_results, expand, similar_words::INTEGER AS similar_words,
       0.3::DOUBLE AS min_similarity, stemming,
       round(coalesce(avg(map) FILTER (is_train), 0), 6) AS train_map,
       round(coalesce(avg(map) FILTER (NOT is_train), 0), 6) AS test_map
FROM ({" UNION ALL ".join(grid_rows)}) JOIN splits USING (query_id) GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY fold, num_results, expand, similar_words, stemming"))

bm25_rows = []
for i, (k1, b) in enumerate((k1, b) for k1 in (1.2, 1.5, 2.0) for b in (0.2, 0.75)):
    cte(f"grid_bm25_{i}", bm25("body", f"{k1}::DOUBLE", f"{b}::DOUBLE"))
    for n in (10, 100):
        cte(f"grid_bm25_{i}_{n}", measured("(" + judged_hits("(" + ranked(f"SELECT * FROM grid_bm25_{i}", n) + ")") + ")"))
        bm25_rows.append(f"SELECT {n} AS num_results, {k1}::DOUBLE AS k1, {b}::DOUBLE AS b, query_id, map FROM grid_bm25_{i}_{n}")
cte("grid_bm25", f"""
SELECT fold, num_results::INTEGER AS num_results, false AS expand, 6::INTEGER AS similar_words,
       0.7::DOUBLE AS min_similarity, false AS stemming, k1, b,
       round(coalesce(avg(map) FILTER (is_train), 0), 6) AS train_map,
       round(coalesce(avg(map) FILTER (NOT is_train), 0), 6) AS test_map
FROM ({" UNION ALL ".join(bm25_rows)}) JOIN splits USING (query_id) GROUP BY fold, num_results, k1, b""")


def posting_list_sql(postings: str, block_docs: int) -> str:
    return f"""
SELECT term, doc_id // {block_docs} AS block,
       string_agg(doc_id || ':' || tf, ' ' ORDER BY doc_id, tf) AS postings
FROM {postings} GROUP BY ALL"""


def statements() -> dict[str, str]:
    """Query name → SQL."""
    joined_tokens = "array_to_string({}, ' ')"
    sql = {
        "read_corpus": "SELECT doc_id, text FROM documents",
        "count_documents": "SELECT count(*)::BIGINT AS n_docs FROM documents",
        "read_corpus_sample": "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 1000",
        "read_page_rank": "SELECT doc_id, page_rank FROM rank_by_doc",
        "read_page_views": "SELECT doc_id, views FROM views_by_doc",
        "read_titles": "SELECT doc_id, title FROM titled",
        "read_qrels": "SELECT query, (row_number() OVER (PARTITION BY query, doc_id // 65536 ORDER BY doc_id) - 1)::INTEGER AS pos, "
                      "doc_id FROM relevant JOIN asked USING (query_id)",
        "write_index": f"SELECT ({bucket('term', 124)})::INTEGER AS bucket, count(*)::BIGINT AS n_postings, "
                       "count(DISTINCT term)::BIGINT AS n_terms FROM body_postings GROUP BY ALL",
        "write_stats": "SELECT term, df, term_total, round(idf, 6) AS idf FROM body_stats",
        "read_index": "SELECT doc_id, dl, round(norm, 6) AS norm, n_docs, round(avgdl, 6) AS avgdl "
                      "FROM body_lengths LEFT JOIN body_norms USING (doc_id), body_corpus",
        "scan_posting_lists": posting_list_sql("body_postings", 65536),
        "lookup_postings": "SELECT query_id, term, doc_id, tf FROM pattern_counts JOIN body_postings USING (term)",
        "tokenize_regex": f"SELECT doc_id, {joined_tokens.format(pattern_tokens('text'))} AS tokens FROM documents",
        "tokenize_words": f"SELECT doc_id, {joined_tokens.format(words('text'))} AS tokens FROM documents",
        "remove_stopwords": "SELECT doc_id, array_to_string(list_filter(string_split_regex(lower(text), '\\s+'), "
                            f"lambda t: t NOT IN ({STOP})), ' ') AS tokens FROM documents",
        "count_words": "SELECT term, doc_id, tf FROM body_postings",
        "explode_anchors": "SELECT source_id, pos, doc_id, text FROM links",
        "posting_lists": posting_list_sql("body_postings", 256),
        "anchor_postings": "SELECT term, doc_id, tf FROM link_postings",
        "document_frequency": "SELECT term, df FROM body_stats",
        "anchor_document_frequency": "SELECT term, count(*)::BIGINT AS df FROM link_postings GROUP BY term",
        "idf_natural": "SELECT term, df, round(idf, 6) AS idf FROM body_stats",
        "idf_log10": "SELECT term, df, round(log10((SELECT count(*) FROM documents) / df), 6) AS idf FROM body_stats",
        "tfidf_postings": "SELECT term, doc_id, tf, round(tf * idf, 6) AS tfidf "
                          "FROM body_postings JOIN body_stats USING (term)",
        "term_total": "SELECT term, term_total FROM body_stats",
        "doc_length": "SELECT doc_id, dl FROM body_lengths",
        "corpus_stats": "SELECT n_docs, round(avgdl, 6) AS avgdl FROM body_corpus",
        "doc_norm": "SELECT doc_id, round(norm, 6) AS norm FROM body_norms",
        "term_bucket": f"SELECT term, ({bucket('term', 124)})::INTEGER AS bucket FROM body_stats",
        "merge_index_shards": posting_list_sql("body_postings", 65536),
        "add_documents": "SELECT term, doc_id, tf, df, term_total, round(idf, 6) AS idf "
                         "FROM body_postings JOIN body_stats USING (term)",
        "process_queries": "SELECT query_id, pos, term FROM query_words",
        "re_process_queries": "SELECT query_id, pos, term FROM query_patterns",
        "query_tfidf": "SELECT query_id, term, round(w_q, 6) AS w_q FROM query_weights",
        "expand_query": "SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY pos, rank)::INTEGER AS pos, "
                        "near_word AS term FROM expansions_6",
        "most_similar": f"SELECT query, id, similarity, rank FROM ({neighbours('embedded', 'embedded', 6)})",
        "candidate_documents": "SELECT DISTINCT query_id, doc_id FROM pattern_counts JOIN body_postings USING (term)",
        "candidate_tfidf": "SELECT query_id, doc_id, term, round(w_d, 6) AS w_d FROM document_weights",
        "document_tfidf_matrix": "SELECT query_id, doc_id, string_agg(term || ':' || round(w_d * 1000000)::BIGINT, ' ' ORDER BY term) "
                                 "AS weights FROM document_weights GROUP BY ALL",
        "document_tfidf_dense": "SELECT f.query_id, f.doc_id, string_agg(round(coalesce(w_d, 0) * 1000000)::BIGINT::VARCHAR, ' ' "
                                "ORDER BY p.term) AS weights FROM (SELECT DISTINCT query_id, doc_id FROM document_weights) f "
                                "JOIN (SELECT DISTINCT query_id, term FROM document_weights) p USING (query_id) "
                                "LEFT JOIN document_weights c ON c.query_id = f.query_id AND c.doc_id = f.doc_id "
                                "AND c.term = p.term GROUP BY f.query_id, f.doc_id",
        "cosine_similarity": "SELECT query_id, doc_id, score FROM cosines",
        "top_n": hit_rows("body_tfidf_100"),
        "binary_ranking": "SELECT query_id, doc_id, score FROM title_matches",
        "binary_ranking_distinct": "SELECT query_id, doc_id, count(*)::BIGINT AS score FROM pattern_counts "
                                   "JOIN title_postings USING (term) GROUP BY ALL",
        "bm25_idf": "SELECT query_id, term, round(ln(1 + (n_docs - df + 0.5) / (df + 0.5)), 6) AS idf "
                    "FROM (SELECT DISTINCT query_id, term FROM query_words) JOIN body_stats USING (term), body_corpus",
        "term_candidates": "SELECT query_id, term, doc_id, tf FROM (SELECT DISTINCT query_id, term FROM query_words) "
                           "JOIN body_postings USING (term)",
        "term_candidates_anchor": "SELECT query_id, term, doc_id, tf FROM (SELECT query_id, term, doc_id, tf FROM "
                                  "(SELECT DISTINCT query_id, term FROM query_words) JOIN title_postings USING (term)"
                                  f"{with_links('title')})",
        "bm25_score": "SELECT query_id, doc_id, score FROM body_bm25_tuned",
        "bm25_search": hit_rows("(" + ranked("SELECT * FROM body_bm25_tuned", 3) + ")"),
        "page_rank_lookup": "SELECT doc_id, pos, coalesce(page_rank, 0) AS page_rank FROM "
                            "(SELECT doc_id, pos, page_rank FROM links LEFT JOIN rank_by_doc USING (doc_id))",
        "page_views_lookup": "SELECT doc_id, pos, coalesce(views, 0)::BIGINT AS views FROM links "
                             "LEFT JOIN views_by_doc USING (doc_id)",
        "min_max_scale": "SELECT query_id, doc_id, round(score, 6) AS score "
                         f"FROM ({scaled('body_bm25_tuned', 'body')})",
        "merge_two": hit_rows("both_bm25"),
        "merge_title_rank_views": hit_rows("(" + merged(
            {"title_bm25_tuned_100": 0.5, "title_ranks": 0.25, "title_views": 0.25}, 10, True) + ")"),
        "merge_all": hit_rows("(" + merged(
            {"body_bm25_tuned_100": 0.25, "title_bm25_tuned_100": 0.25,
             "fused_ranks": 0.25, "fused_views": 0.25}, 10, True) + ")"),
        "attach_titles": titled_hits("body_bm25_tuned_100"),
        "union_candidates": "SELECT query_id, doc_id FROM fused_ids",
        "search_body_tfidf": hit_rows("body_tfidf_100"),
        "search_body_bm25": hit_rows("body_bm25_default_100"),
        "search_body_bm25_expanded": hit_rows("expanded_bm25_6_100"),
        "search_body": titled_hits("body_tfidf_100"),
        "search_body_type_bm25": titled_hits("body_bm25_default_100"),
        "search_title_bm25": hit_rows("title_bm25_default_100"),
        "search_title_binary": titled_hits("(" + ranked("SELECT * FROM title_matches", None) + ")"),
        "search_title": titled_hits("(" + ranked("SELECT * FROM title_matches", None) + ")"),
        "search_title_type_bm25": titled_hits("title_bm25_default_100"),
        "search_body_and_title_bm25": titled_hits("both_bm25"),
        "search_body_tfidf_and_title_bm25": titled_hits("tfidf_and_title"),
        "search_anchor": titled_hits("(" + ranked(
            "SELECT * FROM link_matches WHERE doc_id IN (SELECT doc_id FROM titled)", None) + ")"),
        "ultimate_search_unstemmed": titled_hits("ultimate"),
        "ultimate_search_anchor": titled_hits("ultimate_linked"),
        "drop_empty_queries": "SELECT query_id, query FROM (SELECT conv_id * 1000 + turn AS query_id, "
                              "CASE WHEN role = 'user' THEN text ELSE '' END AS query FROM conversations) "
                              "WHERE length(query) > 0",
        "hits_at_k": "SELECT query_id, n_hits FROM measures",
        "intersect": "SELECT query_id, n_common FROM measures",
        "intersect_ids": "SELECT DISTINCT query_id, doc_id FROM judged WHERE hit",
        "recall_at_k": f"SELECT query_id, {RECALL} AS recall FROM measures",
        "precision_at_k": f"SELECT query_id, {PRECISION} AS precision FROM measures",
        "r_precision": f"SELECT query_id, {places('n_r_hits / n_true')} AS r_precision FROM measures",
        "reciprocal_rank_at_k": f"SELECT query_id, coalesce({places('1 / first_hit')}, 0) AS reciprocal_rank FROM measures",
        "fallout_rate": f"SELECT query_id, {FALLOUT} AS fallout_rate FROM measures",
        "f_score": f"SELECT query_id, {F_SCORE} AS f_score, {F1} AS f1 FROM measures",
        "map_at_k": "SELECT query_id, map FROM measures",
        "average_precision": "SELECT query_id, ap FROM measures",
        "evaluate": f"SELECT query_id, map, map AS average_precision_at_k, {RECALL} AS recall, {PRECISION} AS precision, "
                    f"{places('n_r_hits / n_true')} AS r_precision, "
                    f"coalesce({places('1 / first_hit')}, 0) AS reciprocal_rank, {FALLOUT} AS fallout_rate, "
                    f"{F_SCORE} AS f_score, {F1} AS f1 FROM measures",
        "evaluate_run": "SELECT query_id, CASE WHEN answered THEN ap END AS ap FROM measures",
        "summarize_run": "SELECT count(*)::BIGINT AS n_queries, count(*) FILTER (NOT answered)::BIGINT AS n_failed, "
                         "round(avg(ap) FILTER (answered), 6) AS mean_ap FROM measures",
        "shuffle_split": "SELECT fold, query_id, is_train FROM splits",
        "grid_search": "SELECT * FROM grid_results",
        "grid_search_all": "SELECT * FROM grid_all",
        "grid_search_bm25": "SELECT * FROM grid_bm25",
        "stem_terms": "SELECT DISTINCT term, stem FROM body_postings JOIN stems USING (term)",
        "posting_lists_stemmed": posting_list_sql("body_stemmed_postings", 65536),
        "process_queries_stemmed": "SELECT query_id, pos, term FROM query_words_stemmed",
        "re_process_queries_stemmed": "SELECT query_id, pos, term FROM query_patterns_stemmed",
        "search_body_tfidf_stemmed": hit_rows("body_stemmed_tfidf_100"),
        "search_body_bm25_stemmed": hit_rows("body_stemmed_bm25_default_100"),
        "ultimate_search": titled_hits("ultimate_stemmed"),
        "best_params": "SELECT num_results, expand, similar_words, min_similarity, stemming, "
                       "round(avg(train_map), 6) AS train_map, round(avg(test_map), 6) AS test_map "
                       "FROM grid_results GROUP BY ALL ORDER BY train_map DESC, num_results LIMIT 1",
        "best_params_average": "SELECT round(avg(num_results), 6) AS num_results, 0.0::DOUBLE AS expand, "
                               "6.0::DOUBLE AS similar_words, 0.7::DOUBLE AS min_similarity, 0.0::DOUBLE AS stemming "
                               "FROM grid_results WHERE train_map > 0",
    }
    for name in ("add_documents_stream", "add_documents_stream_steps", "rebuild_index", "add_documents_repeated", "compact_index"):
        sql[name] = sql["add_documents"]
    return {name: with_ctes(text) for name, text in sql.items()}


cte("title_ids", "SELECT query_id, doc_id FROM title_bm25_tuned_100")
cte("title_ranks", "SELECT query_id, doc_id, coalesce(page_rank, 0) AS score "
    "FROM title_ids LEFT JOIN rank_by_doc USING (doc_id)")
cte("title_views", "SELECT query_id, doc_id, coalesce(views, 0)::DOUBLE AS score "
    "FROM title_ids LEFT JOIN views_by_doc USING (doc_id)")

"""The registered queries of these operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltwork.llm.collocations import collocations
from siltwork.llm.decontamination import benchmark_matches
from siltwork.llm.exact import DigestIndex
from siltwork.llm.language import identify
from siltwork.llm.lexical import ranked_search
from siltwork.llm.licences import BREAK, STOP, TEMPLATES, THRESHOLD, bigrams_of, licence_scan
from siltwork.llm.lines import drop_repeated_lines
from siltwork.llm.near import near_duplicates
from siltwork.llm.packing import pack_documents
from siltwork.llm.secrets import secret_scan
from siltwork.llm.shards import shard_rows
from siltwork.llm.shipping import ship
from siltwork.llm.topk import top_k
from siltwork.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]

LLM_QUERIES: dict[str, Query] = {}
LLM_ORACLES: dict[str, str] = {}

SHARDS = 24


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with SQL that must give the same rows."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return function(spark, folder)

        LLM_QUERIES[function.__name__] = run
        if oracle is not None:
            LLM_ORACLES[function.__name__] = oracle
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


JUMP = f"""
WITH RECURSIVE crc(n, k, c) AS (
    SELECT n, 0, n FROM range(256) t(n)
    UNION ALL
    SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY n) AS t FROM crc WHERE k = 8),
sums AS (
    SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS bytes,
        xor(list_reduce(
            list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST(('0x' || h) AS BIGINT))),
            lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) AS text_crc32
    FROM documents, crc_table
),
jumps(doc_id, shards, state, shard, ahead) AS (
    SELECT doc_id, s, CAST(coalesce(doc_id, 0) AS HUGEINT), CAST(-1 AS BIGINT), CAST(0 AS BIGINT) FROM documents, (VALUES ({SHARDS}), ({SHARDS + 1})) v(s)
    UNION ALL
    SELECT doc_id, shards, next, ahead, CAST(floor((ahead + 1) * (2147483648.0::DOUBLE / CAST((next >> 33) + 1 AS DOUBLE))) AS BIGINT)
    FROM (SELECT *, (state * 2862933555777941757 + 1) % 18446744073709551616 AS next FROM jumps WHERE ahead < shards)
),
placed AS (
    SELECT doc_id, CAST(max(shard) FILTER (shards = {SHARDS}) AS INTEGER) AS shard, CAST(max(shard) FILTER (shards = {SHARDS + 1}) AS INTEGER) AS grown_shard
    FROM jumps GROUP BY doc_id
)
SELECT doc_id, bytes + 8 AS size, text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, bytes) - 1 AS slot, grown_shard
FROM sums JOIN placed USING (doc_id)
"""


@query(JUMP)
def op2_jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shard_rows(table(spark, folder, "documents"), SHARDS)


NEAR = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, list_sort(list_distinct(CASE
        WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, CAST(len(w) AS BIGINT) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END)) AS shingles
    FROM worded
),
classed AS (SELECT doc_id, shingles, md5(array_to_string(shingles, chr(10))) AS class FROM sets),
classes AS (SELECT class, min(doc_id) AS doc, any_value(shingles) AS shingles, CAST(len(any_value(shingles)) AS BIGINT) AS n FROM classed WHERE len(shingles) > 0 GROUP BY class),
held AS (SELECT class, n, unnest(shingles) AS shingle FROM classes),
met AS (
    SELECT x.class AS a, y.class AS b, x.n AS na, y.n AS nb, count(*) AS common
    FROM held x JOIN held y ON x.shingle = y.shingle AND x.class < y.class AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n) GROUP BY ALL
),
links AS (SELECT a, b FROM met WHERE 100 * common >= 80 * (na + nb - common)),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT class, class FROM classes UNION SELECT r.a, l.b FROM reach r JOIN ends l ON r.b = l.a),
named AS (SELECT r.a AS class, min(c.doc) AS component_id FROM reach r JOIN classes c ON c.class = r.b GROUP BY r.a)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM classed LEFT JOIN named USING (class)
"""


@query(NEAR)
def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@query(r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (
    SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM d
)
""")
def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return DigestIndex(spark).absorb(table(spark, folder, "documents"))


@query()
def op4_ecoc_language(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"))


@query()
def op9_toxic_segments(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(r"""
WITH lines AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents
),
full_lines AS (
    SELECT doc_id, pos, regexp_replace(line, '^[ \t\r]+|[ \t\r]+$', '', 'g') AS line FROM lines WHERE regexp_matches(line, '[^ \t\r]')
),
windows AS (
    SELECT doc_id, pos AS first, lead(pos, 2) OVER w AS last, line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS win
    FROM full_lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
),
placed AS (
    SELECT *, count(*) OVER (PARTITION BY win) AS places, first_value(doc_id) OVER o AS lead_doc, first_value(first) OVER o AS lead_first, first_value(last) OVER o AS lead_last
    FROM windows WHERE last IS NOT NULL WINDOW o AS (PARTITION BY win ORDER BY doc_id, first)
),
later AS (
    SELECT doc_id, CASE WHEN doc_id = lead_doc THEN greatest(first, lead_last + 1) ELSE first END AS first, last
    FROM placed WHERE places > 1 AND NOT (doc_id = lead_doc AND first = lead_first)
),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS pos FROM later WHERE first <= last)
SELECT d.doc_id, CAST(len(string_split(d.text, chr(10))) AS INTEGER) AS n_lines, CAST(coalesce(g.n, 0) AS INTEGER) AS removed_lines,
    CASE WHEN g.n IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text
FROM documents d
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)
LEFT JOIN (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM lines WHERE (doc_id, pos) NOT IN (SELECT doc_id, pos FROM gone) GROUP BY doc_id
) k USING (doc_id)
""")
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeated_lines(table(spark, folder, "documents"))


def _licence_sql() -> str:
    rows = [(name, g) for name, texts in sorted(TEMPLATES.items()) for text in texts for g in [bigrams_of(text)]]
    values = ", ".join(f"('{name}', [{', '.join(repr(x) for x in grams)}])" for name, grams in rows)
    return rf"""
WITH templates(licence, grams) AS (VALUES {values}),
lines AS (SELECT doc_id, 'line' AS unit, unnest(string_split(text, chr(10))) AS span, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place FROM documents),
paragraphs AS (
    SELECT doc_id, 'paragraph' AS unit, unnest(regexp_split_to_array(text, '{BREAK}')) AS span, generate_subscripts(regexp_split_to_array(text, '{BREAK}'), 1) - 1 AS place
    FROM documents
),
sentences AS (
    SELECT doc_id, 'sentence' AS unit, unnest(regexp_split_to_array(text, '{STOP}|{BREAK}')) AS span, generate_subscripts(regexp_split_to_array(text, '{STOP}|{BREAK}'), 1) - 1 AS place
    FROM documents WHERE regexp_matches(text, '{STOP}')
),
texts AS (SELECT doc_id, 'text' AS unit, text AS span, 0 AS place FROM documents WHERE regexp_matches(text, '{BREAK}')),
units AS (SELECT * FROM lines UNION ALL SELECT * FROM sentences UNION ALL SELECT * FROM paragraphs WHERE contains(span, chr(10)) UNION ALL SELECT * FROM texts),
plain AS (SELECT *, string_split(trim(regexp_replace(lower(span), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS words FROM units),
grams AS (
    SELECT doc_id, unit, place, span, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS grams
    FROM plain WHERE len(words) > 1
),
compared AS (
    SELECT doc_id, unit, CAST(place AS INTEGER) AS place, t.licence, round(2.0::DOUBLE * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)), 6) AS dice,
        CAST(len(g.grams) AS INTEGER) AS n_bigrams, span
    FROM grams g JOIN templates t ON len(g.grams) BETWEEN len(t.grams) * {THRESHOLD} / (2 - {THRESHOLD}) AND len(t.grams) * (2 - {THRESHOLD}) / {THRESHOLD}
)
SELECT * FROM compared WHERE dice >= {THRESHOLD}
QUALIFY row_number() OVER (PARTITION BY doc_id, unit, place ORDER BY dice DESC, licence) = 1
"""


@query(_licence_sql())
def op1_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licence_scan(table(spark, folder, "documents"))


@query()
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"))


@query()
def op8_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return benchmark_matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan(table(spark, folder, "documents"))


MAX_SCORE = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


@query(MAX_SCORE)
def op11_max_score_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"))


COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, k, unnest(list_transform(range(1, CAST(len(w) AS BIGINT) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
    FROM worded, (VALUES (1), (2), (3)) widths(k)
),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cuts AS (
    SELECT lang, c.phrase, c.k AS width, a, cut, array_to_string(string_split(c.phrase, ' ')[1 : cut], ' ') AS head, array_to_string(string_split(c.phrase, ' ')[cut + 1 :], ' ') AS rest
    FROM f c, (VALUES (1), (2)) places(cut) WHERE c.k > 1 AND a >= 10 AND cut < c.k
),
scored AS (
    SELECT c.lang, c.phrase, width, c.a, h.a AS l, t.a AS r, CAST((1000000::HUGEINT * c.a * c.a) // (h.a::HUGEINT * t.a) AS BIGINT) AS score
    FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.phrase = c.rest
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1
),
longer AS (
    SELECT lang, inner_phrase, max(a) AS a FROM (
        SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS inner_phrase FROM scored WHERE width = 3
    ) GROUP BY ALL
),
kept AS (SELECT s.* FROM scored s LEFT JOIN longer g ON width = 2 AND g.lang = s.lang AND inner_phrase = phrase WHERE g.a IS NULL OR 100 * g.a < 50 * s.a)
SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, n, score FROM kept JOIN totals USING (lang)
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) QUALIFY row_number() OVER o <= 2000
"""


@query(COLLOCATIONS)
def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


RANKED = r"""
WITH held AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
),
tf AS (SELECT doc_id, term, count(*) AS tf FROM held GROUP BY ALL),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
size AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, size GROUP BY term, documents),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
),
scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * documents) // terms)))) AS BIGINT) AS score
    FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), size GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""


@query(RANKED)
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))

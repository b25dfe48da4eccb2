"""One query per operator over the whole of its table, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.llm import chat, codes, embeddings, langid, linededup, mixing, packing, quality, sharding, simhash, tokencount, toxicity, variants
from creaseline.llm.common import read

#: A conversation whose texts hold the template's look of other tools; it is formatted with all others.
PROBE_ID, PROBE_TEXT = -7, r"\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"),
    )
    return chat.chat_digests(chat.format_chats(turns.unionByName(probe)))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(read(spark, sf_dir, "documents"), match_added=True)


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs).select(
        "doc_id", "source", F.col("_epoch").alias("epoch"), F.col("_block").alias("block"),
        F.col("_slot").alias("slot"), F.col("_position").alias("position"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(read(spark, sf_dir, "documents")).drop("rejected_by")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokencount.count_document_tokens(read(spark, sf_dir, "documents"))
    return counted.select(
        "doc_id", F.regexp_extract("file", r"part-(\d+)-[^/]*-c(\d+)", 1).cast("int").alias("file"),
        F.regexp_extract("file", r"part-(\d+)-[^/]*-c(\d+)", 2).cast("int").alias("chunk"),
        "ordinal", "n_tokens", "closed",
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(read(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compressed_vectors(read(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedupe_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(variants.word_counts(read(spark, sf_dir, "documents"), damage=97))


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_best_fit_packing, op3_source_mixing, op4_simhash, op5_quality_rules, op6_token_counts,
        op7_language_id, op8_embedding_dedup, op9_toxicity, op10_sharding, op11_vector_codes, op12_line_dedup,
        op13_spelling_variants,
    )
}

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"



def _codes_sql(parts: int = codes.PARTS, entries: int = codes.ENTRIES, rounds: int = codes.ROUNDS, scale: int = codes.SCALE) -> str:
    """Every round over all entries: assignment by least distance, then floors of the means."""
    steps = [f"""WITH v AS MATERIALIZED (SELECT vec_id, label, [floor(x * {scale})::BIGINT FOR x IN embedding::DOUBLE[]] AS e FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
p AS MATERIALIZED (SELECT vec_id, label, p, e[p * (len(e) // {parts}) + 1 : (p + 1) * (len(e) // {parts})] AS e FROM v, (SELECT unnest(range({parts})) AS p)),
c0 AS MATERIALIZED (SELECT p, rank() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS j, e AS c FROM p QUALIFY j < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, label, p, min({{'d': d, 'j': j}}) AS m, any_value(e) AS e FROM
    (SELECT vec_id, label, p.p, j, e, list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(e, c)])::BIGINT AS d FROM p JOIN c{r} c ON p.p = c.p)
    GROUP BY vec_id, label, p)""")
        if r < rounds:
            steps.append(f"""s{r} AS (SELECT p, j, i, sum(x) AS s, count(*) AS n FROM (SELECT p, m.j AS j, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{r}) GROUP BY p, j, i),
n{r} AS (SELECT p, j, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM s{r} GROUP BY p, j),
c{r + 1} AS MATERIALIZED (SELECT o.p, o.j, coalesce(n.c, o.c) AS c FROM c{r} o LEFT JOIN n{r} n ON o.p = n.p AND o.j = n.j)""")
    return ",\n".join(steps) + f""",
b AS (SELECT vec_id, label, string_agg(format('{{:02x}}', m.j), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, j)) FROM c{rounds}) AS codebooks_sha256 FROM b"""


ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES ({PROBE_ID}, 0, 'user', '{PROBE_TEXT}'), ({PROBE_ID}, 1, 'assistant', '{PROBE_TEXT}')),
e AS (SELECT *, length(role) + length(text) + len(regexp_extract_all(role || text, '[\\<]')) + 24 AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op5_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, {_WORDS} AS words, string_split(text, chr(10)) AS lines FROM d),
p AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS times
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM p, (SELECT unnest([0, 1, 2]) AS k) WHERE times > 1 GROUP BY doc_id),
b AS (SELECT doc_id, text, len(lines) AS n_lines, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN c USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR n_symbols * 5 > n_words
    OR word_chars > 25 * n_words OR word_chars < 2 * n_words OR n_repeat_words * 20 > 9 * n_words OR n_dup_lines * 10 > 6 * n_lines
    OR len(regexp_extract_all(text, '!')) * 5 > n_words OR len(regexp_extract_all(text, '\p{{Lu}}')) * 10 > 4 * word_chars
    OR len(regexp_extract_all(text, '[0-9]')) * 10 > 3 * word_chars) AS kept FROM f""",
    # All pairs; the operator finds what hashing finds of them.
    "op8_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id, vec_id AS reach FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.reach = l.a),
c AS (SELECT vec_id, min(reach) AS component_id FROM r GROUP BY vec_id)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM c""",
    "op11_vector_codes": _codes_sql(),
    "op12_line_dedup": r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (last <> doc_id) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (last IS NULL OR last = doc_id), '')) AS kept_sha256
FROM k LEFT JOIN s USING (key) GROUP BY doc_id""",
}

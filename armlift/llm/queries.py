"""One registered query per training-data operator, with its DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from armlift.llm import (
    decontaminate,
    hard_negatives,
    licenses,
    mixing,
    ppm,
    prefix_counts,
    quality,
    sanitise,
    sentence_spans,
    simhash,
    spelling,
    top_k,
    wavelet,
)
from armlift.sources.tables import new_path

Run = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file; every operator takes the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: No source is repeated more than twice, and every source is used in full.
MIX = mixing.Target(passes=2.0)
MIX_SEED = 17


def op1_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.draw(_table(spark, sf_dir, "documents"), MIX, seed=MIX_SEED)
    return drawn.withColumns({c: F.round(c, 9) for c in ("weight", "slot")})


def op2_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "wavelet")
    wavelet.write(_table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return wavelet.documents(spark, path)


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.deduplicate(_table(spark, sf_dir, "documents"))


def op4_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumn("similarity", F.round("similarity", 9))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op8_disclosing_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.personal_data(_table(spark, sf_dir, "documents"))


def op9_partial_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(_table(spark, sf_dir, "documents"))


def op10_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts.count_tokens(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op11_multi_index_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"))


def op12_asymmetric_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_block_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Run] = {
    "op1_temperature_mix": op1_temperature_mix,
    "op2_wavelet_shards": op2_wavelet_shards,
    "op3_sentence_spans": op3_sentence_spans,
    "op4_benchmark_windows": op4_benchmark_windows,
    "op5_quality_rules": op5_quality_rules,
    "op6_simhash_variants": op6_simhash_variants,
    "op7_license_templates": op7_license_templates,
    "op8_disclosing_terms": op8_disclosing_terms,
    "op9_partial_matching": op9_partial_matching,
    "op10_prefix_counts": op10_prefix_counts,
    "op11_multi_index_negatives": op11_multi_index_negatives,
    "op12_asymmetric_chunks": op12_asymmetric_chunks,
    "op13_block_pruning": op13_block_pruning,
}


def _rules_sql() -> str:
    bounds = []
    for rule in quality.RULES:
        ratio = f"{rule.numerator}::DOUBLE / nullif({rule.denominator}, 0)"
        if rule.low is not None:
            bounds.append(f"coalesce({ratio} >= {rule.low}, true)")
        if rule.high is not None:
            bounds.append(f"coalesce({ratio} <= {rule.high}, true)")
    return " AND ".join(bounds)


_MARKS = quality.MARKS.replace("'", "''")
_STOPS = " OR ".join(
    "(lang = '{}' AND lower(trim(x, '{}')) IN ({}))".format(lang, _MARKS, ", ".join(f"'{w}'" for w in listed))
    for lang, listed in quality.STOP_WORDS.items()
)
_SERVED = ", ".join(f"'{lang}'" for lang in quality.STOP_WORDS)

OP5_BODY = rf"""
split AS (
  SELECT *, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM source),
grams AS (
  SELECT row_no, i, w[i:i + 4] AS g FROM (SELECT row_no, w, unnest(range(1, len(w) - 3)) AS i FROM split)),
repeated AS (
  SELECT row_no, count(DISTINCT i + k) AS n
  FROM (SELECT row_no, i, count(*) OVER (PARTITION BY row_no, g) AS c FROM grams), range(5) AS r(k)
  WHERE c > 1 GROUP BY row_no),
counted AS (
  SELECT split.*, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    len(list_filter(w, lambda x: {_STOPS})) AS n_stop_words,
    CASE WHEN lang IN ({_SERVED}) THEN len(w) ELSE 0 END AS n_served_words,
    len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^\s*[-*•]'))) AS n_bullet_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS n_ellipsis_lines,
    coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN repeated USING (row_no)),
judged AS (
  SELECT *, n_words < {quality.MIN_WORDS}
    OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted)
"""

def _place(*keys: str) -> str:
    text = " || ':' || ".join([f"'{MIX_SEED}'", *keys])
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


MIX_SQL = f"""
WITH rows AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS s,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n,
    {_place("coalesce(doc_id::VARCHAR, '')", "'block'")} % {mixing.BLOCKS} AS block
  FROM documents),
mass AS (SELECT s, block, sum(n)::BIGINT AS m FROM rows GROUP BY ALL),
totals AS (SELECT s, sum(m)::BIGINT AS tokens FROM mass GROUP BY s HAVING sum(m) > 0),
shares AS (SELECT *, tokens / sum(tokens) OVER () AS share FROM totals),
temperature AS (
  SELECT CASE WHEN max(share) / min(share) <= {MIX.passes} THEN CASE WHEN max(share) = min(share) THEN 1.0 ELSE 0.0 END
    ELSE 1 - ln({MIX.passes}) / ln(max(share) / min(share)) END AS a FROM shares),
raised AS (SELECT *, pow(share, a) AS r FROM shares, temperature),
budgets AS (
  SELECT *, r / sum(r) OVER () AS weight,
    greatest(tokens, round(r / sum(r) OVER () * (sum(tokens) OVER () * max(share / r) OVER () * sum(r) OVER ()))::BIGINT) AS budget
  FROM raised),
plans AS (SELECT s, weight, budget // tokens AS passes, budget - tokens * (budget // tokens) AS rest FROM budgets),
placed AS (
  SELECT *, {_place("s", "passes::VARCHAR", "block::VARCHAR")} AS place FROM mass JOIN plans USING (s)),
drawn AS (
  SELECT *, coalesce(sum(m) OVER (PARTITION BY s ORDER BY place, block
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed),
cuts AS (
  SELECT s, any_value(weight) AS weight, any_value(passes) AS passes,
    coalesce(max(CASE WHEN (rest - before) * 2 > m THEN place END), -1) AS cut FROM drawn GROUP BY s),
passed AS (
  SELECT *, unnest(range(passes + CASE WHEN {_place("s", "passes::VARCHAR", "block::VARCHAR")} <= cut THEN 1 ELSE 0 END)) AS pass
  FROM rows JOIN cuts USING (s))
SELECT doc_id, source, n AS n_tokens, round(weight, 9) AS weight, pass, block,
  round((pass + {_place("s", "pass::VARCHAR", "block::VARCHAR")} / pow(2, {mixing.HASH_BITS}))
    / (passes + CASE WHEN cut >= 0 THEN 1 ELSE 0 END), 9) AS slot
FROM passed"""

def _vectors_sql(factor: int, columns: str = "") -> str:
    """Rows of whole-number vectors."""
    return f"""
  SELECT DISTINCT vec_id{columns}, list_transform(embedding, lambda x: floor({factor} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


NEGATIVES_SQL = f"""
WITH rows AS ({_vectors_sql(256, ", CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label")} AND label IS NOT NULL),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows AS a JOIN rows AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, p.other_id AS positive_id,
  row_number() OVER (PARTITION BY anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)::INTEGER AS rank,
  n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives AS p JOIN scored AS n USING (anchor_id)
WHERE NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3"""

TOP_K_SQL = f"""
WITH rows AS ({_vectors_sql(64)}),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM rows AS q JOIN rows AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20"""

#: CRC-32 has no function in DuckDB: its table by the polynomial's rule, and a fold over the bytes.
SPELLING_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, count(*) AS n, run FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{spelling.RUN}')) AS run
    FROM documents) GROUP BY doc_id, run),
bytes AS (
  SELECT run, n, list_transform(range(1, strlen(doc || ':' || run) + 1),
    lambda i: ('0x' || substr(hex(doc || ':' || run), 2 * i - 1, 2))::BIGINT) AS b FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, b),
    lambda acc, x: xor(acc >> 8, t[(xor(acc, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % {spelling.SLIP} = 0
      THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  GROUP BY word HAVING length(word) >= {spelling.MIN_LETTERS} AND sum(n) >= {spelling.MIN_COUNT}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
masked AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM masked AS a JOIN masked AS b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM masked AS a JOIN words AS b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM masked AS a JOIN words AS b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(m := -m, other := hex(other), name := other)) AS b FROM near GROUP BY word),
judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -b.m >= {spelling.DOMINANCE} * n THEN b.name END AS form,
    CASE WHEN -b.m >= {spelling.DOMINANCE} * n THEN -b.m END AS form_n
  FROM words LEFT JOIN best USING (word)),
chains AS (
  SELECT word, coalesce(form, word) AS root, 0 AS step FROM judged
  UNION ALL SELECT c.word, j.form, step + 1 FROM chains AS c JOIN judged AS j ON c.root = j.word WHERE j.form IS NOT NULL)
SELECT word, form, arg_max(root, step) AS root, any_value(n) AS n, any_value(n_near) AS n_near, any_value(form_n) AS form_n
FROM chains JOIN judged USING (word) GROUP BY word, form"""

SQL: dict[str, str] = {
    "op11_multi_index_negatives": NEGATIVES_SQL,
    "op12_asymmetric_chunks": SPELLING_SQL,
    "op13_block_pruning": TOP_K_SQL,
    "op1_temperature_mix": MIX_SQL,
    "op5_quality_rules": f"""
WITH source AS (SELECT *, row_number() OVER () AS row_no FROM documents), {OP5_BODY}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {_rules_sql()} AS kept
FROM judged""",
}

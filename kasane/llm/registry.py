"""Queries of the corpus operators over the tables of a folder, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kasane.llm import centroids, langid, licenses, linededup, mainhtml, quality, ranked, secrets, sentencepiece, simhash, syncmers, warc, winnow
from kasane.llm.keyed import small_batches
from kasane.plans.staging import fresh_path

#: The vocabulary file of op9 and of the pipeline; another is chosen by the environment.
MODEL_FILE = os.environ.get("KASANE_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = secrets.scan_documents(_table(spark, sf_dir, "documents"))
    counts = [f"bigint(size(filter(spans, s -> s.kind = '{k}'))) AS n_{k}" for k in secrets.BASE]
    base = "filter(spans, s -> s.kind in ('assign', 'access', 'hex'))"
    return found.selectExpr("doc_id", *counts, f"sha2({_joined(base)}, 256) AS base_sha256", f"{_joined('spans')} AS spans")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = winnow.contaminated_spans(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.selectExpr("doc_id", "n_words", "n_hit", "bigint(size(items)) AS n_items", "sha2(array_join(items, ','), 256) AS items_sha256", "n_hit > 0 AS contaminated")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score: the best share of a template in place."""
    found = licenses.licenses(_table(spark, sf_dir, "documents")).withColumn("own", F.expr("filter(places, p -> p.base)"))
    labels = "array_join(array_sort(array_distinct(transform({0}, p -> p.label))), ',')"
    return found.selectExpr(
        "doc_id",
        "n_words",
        "bigint(size(own)) AS n_base",
        "array_min(own.start) AS first_word",
        "array_max(own.start) AS last_word",
        f"{labels.format('own')} AS base_labels",
        f"{labels.format('places')} AS labels",
        "coalesce(array_max(places.score), 0D) AS score",
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, read back from the archives."""
    path = fresh_path(spark, "warc")
    warc.write_bundles(_table(spark, sf_dir, "pages"), path)
    return warc.read_bundles(spark, path, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars."""
    return mainhtml.extract(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score."""
    trusted = _table(spark, sf_dir, "labels").where("quality = 1")
    return quality.judged(_table(spark, sf_dir, "documents"), trusted).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages (the chosen set with shares)."""
    docs = _table(spark, sf_dir, "documents")
    langs, model = langid.learn(docs.where(~langid.held_out()))
    found = langid.identify(docs, langs, model).withColumn("held_out", langid.held_out())
    text = F.array_join(F.transform("languages", lambda x: F.concat_ws(":", x["lang"], F.round(x["share"], 3))), ",")
    return found.select("doc_id", "held_out", "lang_pred", "score", text.alias("languages"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, exact."""
    return sentencepiece.encode(_table(spark, sf_dir, "documents"), MODEL_FILE)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text without later repeats of passages, n_words of the text as it was, n_deleted of them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    words = docs.withColumn("n_words", F.expr("bigint(regexp_count(coalesce(text, ''), '[^\\\\x20\\\\x09-\\\\x0D]+'))"))
    found = linededup.dedup_lines(words)
    return found.selectExpr("doc_id", "text", "n_words", "aggregate(coalesce(deleted_runs, array()), 0L, (n, r) -> n + r.end - r.start) AS n_deleted")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    return centroids.kmeans(_table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, rank, doc_id, score."""
    return ranked.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    return syncmers.fingerprints(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_secret_scan,
        op3_benchmark_decontamination,
        op4_license_scan,
        op5_warc,
        op6_html_extraction,
        op7_quality_rules,
        op8_language_id,
        op9_sentencepiece,
        op10_line_dedup,
        op11_centroid_clustering,
        op12_ranked_search,
        op13_document_fingerprints,
    )
}


def _spans_sql(rule: secrets.Rule) -> str:
    """DuckDB list of a rule's spans in t.text: places are running lengths of gaps and matches."""
    p = rule.pattern.replace("'", "''")
    good = f"length(part[i]) >= {rule.least}"
    return f"""(SELECT list({{'start': CAST(list_sum(list_transform(gap[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hit[1:i-1], lambda x: length(x))), 0) AS BIGINT),
        'kind': '{rule.kind}', 'size': length(hit[i])}} ORDER BY i)
      FROM (SELECT string_split_regex(t.text, '{p}') AS gap, regexp_extract_all(t.text, '{p}', 0) AS hit, regexp_extract_all(t.text, '{p}', {rule.group}) AS part) m,
        unnest(range(1, len(hit) + 1)) AS u(i) WHERE {good})"""


def _secrets_sql() -> str:
    every = ", ".join(f"coalesce({_spans_sql(r)}, [])" for r in secrets.RULES)
    rank = "list_position([" + ", ".join(f"'{r.kind}'" for r in secrets.RULES) + "], s.kind)"
    text = "s.kind || ':' || s.start || ':' || (s.start + s.size)"
    joined = f"coalesce(string_agg({text}, ',' ORDER BY s.start, {rank}, s.size)"
    base = "s.kind IN ('assign', 'access', 'hex')"
    counts = ", ".join(f"count(*) FILTER (WHERE s.kind = '{k}') AS n_{k}" for k in secrets.BASE)
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
found AS (SELECT r, unnest(flatten([{every}])) AS s FROM t)
SELECT any_value(t.doc_id) AS doc_id, {counts},
  sha256({joined} FILTER (WHERE {base}), '')) AS base_sha256, {joined} FILTER (WHERE s IS NOT NULL), '') AS spans
FROM t LEFT JOIN found USING (r) GROUP BY t.r"""


def _clusters_sql() -> str:
    """Every round spelled out: all distances, the nearest centroid, floored means. Integer division truncates, so the remainder is taken off first."""
    squared = "list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v.x, c.x)])"
    steps = [
        """v AS (SELECT row_number() OVER () AS r, vec_id, [CAST(floor(64 * CAST(y AS DOUBLE)) AS HUGEINT) FOR y IN embedding] AS x FROM embeddings
  WHERE len(embedding) = 64 AND len([y FOR y IN embedding IF y IS NULL OR NOT isfinite(y)]) = 0)""",
        """c0 AS (SELECT row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS k, x FROM
  (SELECT x, sha256('1:' || CAST(vec_id AS VARCHAR)) AS h FROM v ORDER BY h NULLS LAST, x LIMIT 16))""",
    ]
    for n in range(centroids.ROUNDS + 1):
        steps.append(f"a{n} AS (SELECT r, vec_id, v.x, arg_min(k, {{'d': {squared}, 'k': k}}) AS k, min({squared}) AS d FROM v, c{n} AS c GROUP BY r, vec_id, v.x)")
        if n < centroids.ROUNDS:
            steps.append(f"""m{n} AS (SELECT k, i, sum(x[i]) AS s, count(*) AS n FROM a{n}, unnest(range(1, 65)) AS u(i) GROUP BY k, i),
c{n + 1} AS (SELECT c.k, coalesce(y.x, c.x) AS x FROM c{n} AS c LEFT JOIN
  (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS HUGEINT) ORDER BY i) AS x FROM m{n} GROUP BY k) AS y ON c.k = y.k)""")
    last = centroids.ROUNDS
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{last} AS a JOIN c{last} AS c ON a.k = c.k"""


_WORDS = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES = {
    "op12_ranked_search": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format('text')} AS w FROM documents),
all_of AS (SELECT count(*) AS n, sum(len(w)) AS l FROM d WHERE len(w) > 0),
tf AS (SELECT r, word, count(*) AS tf FROM (SELECT r, unnest(w) AS word FROM d) GROUP BY r, word),
i AS (SELECT q, item_id, unnest(list_distinct(w)) AS word FROM (SELECT row_number() OVER () AS q, item_id, {_WORDS.format('text')} AS w FROM benchmark)),
weight AS (SELECT word, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, all_of GROUP BY word, n),
docs AS (SELECT r, doc_id, 50 + (50 * len(w) * n) // l AS m FROM d, all_of WHERE len(w) > 0),
scores AS (SELECT q, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM i JOIN weight USING (word) JOIN tf USING (word) JOIN docs USING (r) GROUP BY q, r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50""",
    "op11_centroid_clustering": _clusters_sql(),
    "op2_secret_scan": _secrets_sql(),
    "op3_benchmark_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format('text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format('text')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(i)),
hits AS (SELECT r, i, dw.n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
words AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, n)) AS u(k) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)""",
    "op5_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
q AS (SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first FROM q WHERE n >= 100 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, q.digest AS payload_digest,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM q LEFT JOIN f ON q.digest = f.digest""",
}

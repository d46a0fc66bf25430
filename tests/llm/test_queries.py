"""The registered queries, over a small folder of tables: columns, rows and the values that the contracts fix."""

import re
import zlib

import pytest
from pyspark.sql import functions as F

from kasane.llm import registry

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLUMNS = {
    "op1_simhash_near_dedup": "doc_id fingerprint component_id",
    "op2_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op3_benchmark_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op4_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op5_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op6_html_extraction": "page_id url text n_chars",
    "op7_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op8_language_id": "doc_id held_out lang_pred score",
    "op9_sentencepiece": "doc_id ids n_tokens exact",
    "op10_line_dedup": "doc_id text n_words n_deleted",
    "op11_centroid_clustering": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    "op12_ranked_search": "item_id rank doc_id score",
    "op13_document_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
}
NOTICE = "Released under the MIT license, or Apache License; version 2. cc-by-nc CC by NC"


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('sf')}"
    more = [(300, NOTICE + " x"), (301, NOTICE), (302, "under the mit license" * 2)]
    docs = [(i, t, "en" if (i or 0) % 3 else "fr", "src", len(t or "")) for i, t in [*rows, *more]]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, "u", "<p>a &amp; é</p>"), (2, "v", None)], "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
    spark.createDataFrame([(1, rows[0][1])], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    vectors = [(i, [float(i % 7 + j) / 9 for j in range(64)], i) for i in range(30)] + [(30, [1.0], 0), (31, None, 0)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{root}/embeddings.parquet")
    return root, [(d, t) for d, t, *_ in docs]


@pytest.mark.parametrize("name", registry.QUERIES)
def test_query(spark, folder, name):
    root, docs = folder
    found = registry.QUERIES[name](spark, root)
    got = found.collect()
    assert found.columns[: len(COLUMNS[name].split())] == COLUMNS[name].split()
    assert len(got) == {"page_id": 2, "vec_id": 30, "item_id": 50}.get(found.columns[0], len(docs))
    if name.startswith("op4"):
        phrases = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
        want = []
        for d, t in docs:
            w = ALNUM.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
            at = sorted((i, k) for k, p in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
            want.append((d, len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({k for _, k in at}))))
        assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == sorted(want, key=str)
        assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    if name.startswith("op6"):
        assert sorted((r.page_id, r.text, r.n_chars) for r in got) == [(1, "a & é", 5), (2, "", 0)]
    if name.startswith("op8"):
        assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
        assert {r.lang_pred for r in got} == {"en", "fr", "und"} or {r.lang_pred for r in got} == {"en", "und"}
    if name.startswith("op9"):
        assert all(r.n_tokens == len(r.ids) and r.exact for r in got)
    if name.startswith("op10"):
        words = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in docs if d is not None}
        assert all(r.n_words == words[r.doc_id] for r in got if r.doc_id in words and r.doc_id != 71)
        left = found.withColumn("left", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))
        assert left.where("coalesce(left, 0) <> n_words - n_deleted").count() == 0

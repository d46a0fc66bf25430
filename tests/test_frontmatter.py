"""Front matter of every document, whatever its text holds."""

from kasane.plans import queries


def test_frontmatter_reads_all_documents(spark, tmp_path):
    rows = [(1, "plain", "en", "web"), (2, "a\n---\nb: c\n---\nd", "de", "x"), (3, None, "ja", "y"), (4, "---\nlang: zz\n---\n", None, "z"), (5, "-----BEGIN KEY-----", "fr", None), (6, "", "en", "w")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in queries.q_frontmatter(spark, str(tmp_path)).collect())
    assert got == [(d, lang, source, "lang,tier" if lang is None else "tier") for d, _, lang, source in rows]

"""What a task or a Python worker holds does not grow with the tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from kasane.functions import frontmatter as Y
from kasane.operators import structure
from kasane.plans import oracles, queries


def _nodes(plan: str) -> list[str]:
    return [line.lstrip(" :+-").split("(")[0].split(" ")[0] for line in plan.splitlines()]


def test_references_within_hold_a_part_of_the_members_and_sort_nothing(spark):
    edges = spark.createDataFrame([(1, 2, "refs"), (1, 2, "refs"), (2, 3, "refs"), (1, 4, "refs"), (3, 3, "refs"), (1, 9, "refs"), (None, 1, "refs"), (1, 2, "contains")], "source long, target long, type string")
    members = spark.createDataFrame([("g", 1), ("g", 2), ("h", 3), ("h", 2), (None, 4), (None, 1), ("g", None)], "`group` string, node long")
    rows = structure.references_within(edges, members)
    assert sorted(map(tuple, rows.collect())) == [("g", 1, 2), ("g", 1, 2), ("h", 2, 3), ("h", 3, 3)]
    nodes = _nodes(rows._jdf.queryExecution().sparkPlan().toString())
    assert nodes.count("ShuffledHashJoin") == 2 and not {"BroadcastHashJoin", "SortMergeJoin", "CartesianProduct"} & set(nodes)


def test_references_within_a_chapter_of_repeated_parts(spark, tmp_path):
    parts = spark.range(40).selectExpr("id AS p_partkey", "'x' AS p_name", "if(id = 7, null, int(id % 3)) AS p_size")
    parts.union(parts.where("p_partkey % 5 = 0")).write.parquet(f"{tmp_path}/part.parquet")
    lines = spark.range(400).selectExpr("if(id % 50 = 0, null, id % 40) AS l_partkey", "if(id % 60 = 1, 99, (id % 40 + 8 * (id % 3)) % 40) AS l_suppkey")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = queries.q_refs_in_chapter(spark, str(tmp_path))
    with duckdb.connect() as db:
        for name in ("part", "lineitem"):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
        wanted = db.execute(oracles.ORACLES["q_refs_in_chapter"]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(wanted) and wanted
    assert got.columns == ["group", "n", "targets"] and got.agg(F.sum("n")).first()[0] > len(wanted)


@pytest.mark.parametrize("name", ["q_nested_front", "q_amend_front"])
def test_front_matter_goes_to_python_in_few_rows(spark, name):
    nodes = _nodes(queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString())
    assert nodes.count("BatchEvalPython") == 2 and not {"ArrowEvalPython", "MapInArrow", "MapInPandas"} & set(nodes)


@pytest.mark.parametrize("arrow", ["false", "true"])
def test_front_matter_of_odd_texts_comes_back_whatever_the_session_prefers(spark, arrow):
    key = "spark.sql.execution.pythonUDF.arrow.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, arrow)
    try:
        texts = ["", None, "\0", "😀\u2028\ufeff", "---\n---", "x" * 300_000, "法\r\n: #"] * 40
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
        rows = rows.withColumn("x", Y.parsed(Y.document(F.when(F.col("i") != 3, F.to_json(F.struct("t", "i"))), F.lit("b"))))
        assert "ArrowEvalPython" not in rows._jdf.queryExecution().sparkPlan().toString()
        got = [tuple(r) for r in rows.select("i", F.try_variant_get("x.front", "$.t", "string"), F.try_variant_get("x.front", "$.i", "int"), "x.body").orderBy("i").collect()]
    finally:
        spark.conf.set(key, before)
    assert got == [(i, None if i == 3 else t, None if i == 3 else i, "b") for i, t in enumerate(texts)]

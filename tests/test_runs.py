"""Runs that are repeated, broken off and taken up again; requests asked once; files written in order."""

import json
import os

import pytest
from pyspark.sql import functions as F

from kasane.operators import catalogue, incremental, integrity
from kasane.sources import landing, readthrough


def test_incremental_runs(spark, tmp_path):
    folder, seen = f"file://{tmp_path}/c", []
    table = lambda rows: spark.createDataFrame(rows, "path string, body string")

    def repair(rows):
        seen.append(sorted(r.path for r in rows.collect()))
        return rows.select("path", F.upper("body").alias("body"))

    first = [("a", "x"), ("b", "y"), ("c", None), (None, "z")]
    assert incremental.run(table(first), folder, repair) == {"new": 3, "changed": 0, "same": 0, "deleted": 0}
    assert incremental.run(table(first), folder, repair) == {"new": 0, "changed": 0, "same": 3, "deleted": 0}
    assert seen == [["a", "b", "c"], []]
    second = [("a", "x"), ("b", "changed"), ("d", "new")]
    broken = lambda rows: rows.select("path", F.when(F.col("path") == "d", F.raise_error(F.lit("lost"))).otherwise(F.col("body")).alias("body"))
    with pytest.raises(Exception, match="lost"):
        incremental.run(table(second), folder, broken)
    assert sorted(map(tuple, incremental.current(spark, folder).collect())) == [("a", "X", 1), ("b", "Y", 1), ("c", None, 1)]
    assert incremental.run(table(second), folder, repair) == {"new": 1, "changed": 1, "same": 1, "deleted": 1}
    assert sorted(map(tuple, incremental.current(spark, folder).collect())) == [("a", "X", 1), ("b", "CHANGED", 2), ("d", "NEW", 2)]
    assert incremental.run(table([*second, ("c", None)]), folder, repair) == {"new": 1, "changed": 0, "same": 3, "deleted": 0}  # a deleted path comes back
    assert incremental.run(table(second), folder, repair, rules="2") == {"new": 0, "changed": 3, "same": 0, "deleted": 1}
    assert incremental.run(table([]), folder, repair) == {"new": 0, "changed": 0, "same": 0, "deleted": 3}
    assert incremental.current(spark, folder).count() == 0


def test_client_is_asked_for_the_rest_alone(spark, tmp_path):
    path, calls = f"file://{tmp_path}/log", str(tmp_path / "calls")
    rows = spark.createDataFrame([(i, f"q{i}") for i in range(20)] + [(20, None), (21, "q3")], "i int, request string")
    broken = {"q5", "q6"}

    def client(prompts, broken=frozenset(broken)):
        with open(calls, "a") as f:
            f.write("".join(f"{p}\n" for p in prompts))
        if broken & set(prompts):
            raise OSError("down")
        return [f"a{p}" for p in prompts]

    got = {r.i: r.response for r in readthrough.asked(rows, path, client, batch=4, waves=3, tasks=2).collect()}
    assert got == {i: None if i in (5, 6, 20) else f"aq{3 if i == 21 else i}" for i in range(22)}
    errors = [r.error for r in readthrough.log(spark, path).where("error is not null").collect()]
    assert errors == ["OSError: down"] * 2
    os.remove(calls)
    again = {r.i: r.response for r in readthrough.asked(rows, path, lambda prompts: client(prompts, frozenset()), batch=4).collect()}
    assert again == {i: None if i == 20 else f"aq{3 if i == 21 else i}" for i in range(22)}
    assert sorted(open(calls).read().split()) == ["q5", "q6"]
    os.remove(calls)
    readthrough.asked(rows, path, client).collect()
    assert not os.path.exists(calls)
    short = readthrough.asked(spark.createDataFrame([("r1",), ("r2",)], "request string"), path, lambda p: p[1:]).collect()
    assert all(r.response is None for r in short)


def test_broken_records_are_misses(spark, tmp_path):
    path = f"file://{tmp_path}/cache"
    rows = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "request string")
    answers = lambda x: spark.createDataFrame(x, "request string, response string")
    first = readthrough.landed(rows, path, answers([("a", '{"n": 1}'), ("b", '{"n": '), ("z", "{}")]))
    assert {r.request: r.response for r in first.collect()} == {"a": '{"n": 1}', "b": None, "c": None, "d": None}
    second = readthrough.landed(rows, path, answers([("a", '{"n": 9}'), ("b", "[2]"), ("c", None)]))
    assert {r.request: r.response for r in second.collect()} == {"a": '{"n": 1}', "b": "[2]", "c": None, "d": None}
    assert readthrough.missing(rows, readthrough.log(spark, path)).count() == 2


def test_edges_and_mapping_in_order(spark, tmp_path):
    rows = [(f"f{i % 7}", i, f"s{i % 3}", f"t{i % 2}") for i in range(500)] + [("f0", 0, "s0", "t0")]
    edges = spark.createDataFrame(rows, "file string, pos int, `from` string, `to` string").repartition(6)
    out = tmp_path / "edges"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    landing.write_edges(edges, f"file://{out}", ["file", "pos"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(out.glob("part-*"))
    lines = [json.loads(x) for p in parts for x in p.read_text().splitlines()]
    assert len(parts) > 1 and lines == [{"from": a, "to": b} for _, _, a, b in sorted(rows)]
    mapping = spark.createDataFrame([("b", "B"), ("a", "A")], "old_path string, new_path string")
    landing.write_mapping(mapping, f"file://{tmp_path}/m", spark.createDataFrame([("a", 7)], "path string, length long"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "m").glob("part-*"))).splitlines() == ["旧パス,新パス,サイズ(bytes)", "a,A,7", "b,B,0"]


def test_domains_from_files(spark, tmp_path):
    (tmp_path / "o.yaml").write_text("# kept by hand\nL1: [特別, 海事法]\nL2:\n- 民事法\nL3: []\n")
    (tmp_path / "c.yaml").write_text("民事: 私法\n税務: 税法 # note\n")
    laws = spark.createDataFrame([("L1", ["民事"]), ("L2", ["税務"]), ("L3", ["民事", "税務", "刑事"]), ("L4", None)], "law_id string, classes array<string>").selectExpr("*", "'n' AS law_name", "'' AS law_num", "'' AS promulgation_date")
    rows = catalogue.entries(laws, landing.domain_overrides(spark, f"file://{tmp_path}/o.yaml"), landing.class_map(spark, f"file://{tmp_path}/c.yaml"))
    assert {r.law_id: r.domain for r in rows.collect()} == {"L1": ["特別", "海事法"], "L2": ["民事法"], "L3": ["その他", "私法", "税法"], "L4": []}
    assert landing.domain_overrides(spark, f"file://{tmp_path}/none.yaml").count() == 0 and landing.class_map(spark, f"file://{tmp_path}/none.yaml") == {}


def test_markdown_of_no_broken_links(spark):
    none = spark.createDataFrame([], "path string, line_no int, shown string")
    assert integrity.report_markdown(none).first().text.endswith("**ユニークなターゲット数**: 0\n\n空リンクはありません。\n")

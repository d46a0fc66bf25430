"""Bodies with very many matches: results right to the last, time in proportion to them."""

import random
import time

import pytest
from pyspark.sql import functions as F

from kasane.functions import arrays as A
from kasane.operators import explicit, repair, rewrite

ONE = "民法と第三条、同条第二項。[[laws/民法/本文/第5条.md|第五条]]及び第七条の二"


def _rows(spark, n):
    return spark.range(1).select(F.col("id").alias("text_id"), F.lit("民法").alias("law_name"), F.repeat(F.lit(ONE), n).alias("text"), F.lit(4).alias("article"))


def _explicit(spark, n):
    found = explicit.found(_rows(spark, n)).groupBy("type").agg(F.count("*").alias("n")).collect()
    assert {r.type: r.n for r in found} == {"absolute": 4 * n, "relative": n}


def _unlinked(spark, n):
    row = rewrite.unlinked(_rows(spark, n).withColumnRenamed("text", "body")).select("n_unlinked", "n_kept", F.length("body").alias("size")).first()
    assert row.n_unlinked + row.n_kept == n and row.n_kept == n


def _relinked(spark, n):
    row = rewrite.relinked(_rows(spark, n).withColumnRenamed("text", "body")).select("n_linked").first()
    assert row.n_linked == n  # 第七条の二 stands after a full stop, and no name before it


def _put_back(spark, n):
    bodies = _rows(spark, n).select(F.lit("p").alias("path"), F.concat("text", F.lit("尾" * 120 + "第三条乙")).alias("body"))
    entries = spark.createDataFrame([("p", "i", "第三条", "", "乙", "t")], "path string, id string, anchor_text string, context_before string, context_after string, target string")
    row = repair.put_back(bodies, entries).select("method", F.right("body", F.lit(12)).alias("end")).first()
    assert (row.method, row.end) == ("context", "尾尾尾[[t|第三条]]乙"[-12:])


def _applied(spark, n):
    body = "".join(f"第{i}条と" for i in range(n)) + "[[x|第5条]]"
    refs = spark.range(n).selectExpr("1L AS text_id", "int(id) AS ord", "concat('a', id) AS target_id", "concat('第', id, '条') AS original", "true AS resolved")
    row = repair.applied(spark.createDataFrame([(1, body)], "text_id long, body string"), refs).first()
    assert row.n_applied == n - (n > 5) and row.body.startswith("[[a0]]と[[a1]]と") and ("と第5条と" in row.body) == (n > 5)


@pytest.mark.parametrize("run", [_explicit, _unlinked, _relinked, _put_back, _applied])
def test_time_in_proportion(spark, run):
    run(spark, 5)
    took = {}
    for n in (1_000, 8_000):
        at = time.time()
        run(spark, n)
        took[n] = time.time() - at
    assert took[8_000] < 3 + 16 * took[1_000]


def test_arrays_against_plain(spark):
    rows = [(["a", "", "cc", "dddd"], ["x", "yy", "z"]), ([""], []), (["", ""], ["w" * 9]), (["q" * 9, "", "", "", "r"], ["1", "2", "3", "4"])]
    df = spark.createDataFrame(rows, "g array<string>, m array<string>")
    got = df.select(A.ends(F.col("g"), F.col("m")).alias("e"), A.texts_before(F.col("g"), F.col("m"), 3).alias("b"), A.texts_after(F.col("g"), F.col("m"), 3).alias("a"), A.running(F.transform("m", F.length), F.greatest).alias("r")).collect()
    for (g, m), r in zip(rows, got, strict=True):
        whole, e, b, a, most = "".join(x + y for x, y in zip(g, [*m, ""], strict=True)), [], [], [], []
        at = 0
        for x, y in zip(g, m):
            at += len(x)
            b.append(whole[max(0, at - 3) : at])
            at += len(y)
            e.append(at)
            a.append(whole[at : at + 3])
            most.append(max([len(y), *most[-1:]]))
        assert (r.e, r.b, r.a, r.r) == (e, b, a, most)


def test_applied_is_one_reference_after_the_other():
    rng = random.Random(2)
    bits = ["第3条", "第3条の2", "第13条", "前条", "x", "[[", "]]", "[", "]", "|", "\n", "と", "[[a|第3条]]"]
    for _ in range(4000):
        body = "".join(rng.choices(bits, k=rng.randint(0, 14)))
        good = [(rng.choice(["第3条", "第3条の2", "3条", "前条", "第13条"]), rng.choice(["第3条", "T", "第13条#x"])) for _ in range(rng.randint(0, 5))]
        refs = [{"ord": i, "original": w, "target_id": t, "resolved": True} for i, (w, t) in enumerate(good)]
        assert repair.linked(body, refs) == repair._one_by_one(body, good)

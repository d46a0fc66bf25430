"""A statute corpus derived from the driver's tables by fixed integer formulas, for the queries and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kasane.functions.numerals import to_kanji

# Names and identifiers of laws.
LAWS = (
    ("刑法", "140AC0000000045"),
    ("民法", "129AC0000000089"),
    ("日本国憲法", "321CONSTITUTION"),
    ("刑事訴訟法", "323AC0000000131"),
    ("民事訴訟法", "408AC0000000109"),
    ("会社法", "417AC0000000086"),
    ("行政事件訴訟法", "337AC0000000139"),
    ("所有者不明土地の利用の円滑化等に関する特別措置法", "430AC0000000049"),
)
OUTSIDE = "港湾荷役法（昭和三十年法律第七十号）"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: str, at: int) -> str:
    return "element_at(array(" + ", ".join(f"'{x[at]}'" for x in LAWS) + f"), cast({index} AS int) + 1)"


def corpus(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, i, True) for n, i in LAWS], "law_name string, law_id string, has_main boolean")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article a part: law, number, chapter, section, node_id, pos."""
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS pos", "p_name AS heading", f"{_pick('p_partkey % 8', 0)} AS law_name", f"{_pick('p_partkey % 8', 1)} AS law_id",
        "concat(p_partkey div 8 + 1, if(p_partkey % 7 = 0, '_2', '')) AS article_num", "int(p_size % 12 + 1) AS chapter_num", "nullif(int(p_size % 3), 0) AS section_num",
    )
    titled = rows.withColumns({"chapter_title": F.expr("if(pos % 5 = 0, '第章の二', '第章')"), "section_title": F.expr("if(pos % 4 = 0, '第節の二', null)")})
    return titled.withColumn("node_id", F.concat(F.lit("JPLAW:"), "law_id", F.lit("#main#"), "article_num"))


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row an (order, line), for the table repeats some of them. Spread over all cores: reading a text costs far more than its bytes."""
    keys = ["l_orderkey", "l_linenumber"]
    rows = table(spark, sf_dir, "lineitem").select(*keys, "l_partkey", "l_suppkey").repartition(3 * spark.sparkContext.defaultParallelism, *keys)
    return rows.groupBy(*keys).agg(F.min("l_partkey").alias("l_partkey"), F.min("l_suppkey").alias("l_suppkey"))  # within the partitions, which one shuffle makes


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text a line item, by five templates (l_linenumber % 5): bare, another law, a law outside, self with two articles, bare in a fragment."""
    n = F.expr("(l_partkey * 7 + l_orderkey) % 9000 + 1")
    kanji, after = to_kanji(n), to_kanji(n + 1)
    rows = line_items(spark, sf_dir).selectExpr(
        "l_orderkey * 10 + l_linenumber AS text_id", "l_linenumber % 5 AS template", "l_orderkey", "l_partkey", "l_linenumber", f"{_pick('l_orderkey % 8', 0)} AS law_name", f"{_pick('l_orderkey % 8', 1)} AS law_id", f"{_pick('(l_orderkey + 1) % 8', 0)} AS next_law",
    )
    text = (
        F.when(F.col("template") == 0, F.concat(F.lit("係員は、第"), kanji, F.lit("条により記録を作る。")))
        .when(F.col("template") == 1, F.concat("next_law", F.lit("第"), kanji, F.lit("条の二の規定は、")))
        .when(F.col("template") == 2, F.concat(F.lit(OUTSIDE + "第"), kanji, F.lit("条において")))
        .when(F.col("template") == 3, F.concat(F.lit("本法第"), kanji, F.lit("条、第"), after, F.lit("条の規定")))
        .otherwise(F.concat(F.lit("第"), kanji, F.lit("条に見出しを付ける。")))
    )
    source = F.concat(F.lit("JPLAW:"), "law_id", F.lit("#main#"), F.expr("l_orderkey % 9000 + 1").cast("string"))
    return rows.select("text_id", text.alias("text"), "law_name", "law_id", source.alias("node_id"), (F.col("template") == 4).alias("fragment"))

"""Secret scans over an incremental ledger of contents, with DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content. The ledger holds, for each content, the
rules (name and version) it was scanned with and the spans found. A scan takes only the contents for which the
ledger lacks a rule version, each once however many paths hold it, and only with the rules that are missing;
findings are then joined back to all paths. A ledger is a folder of Parquet tables to which each run appends:
``blobs`` (blob, rules, spans) and, for the history of files, ``paths`` (path, version, blob).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kasane.plans.staging import fresh_path, sized, stage


class Rule(NamedTuple):
    """A pattern and what a match must have: group ``group`` of at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1
    #: What every match contains, in a form that is cheap to look for.
    hint: str = ""

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base rules are given, the others are the public formats of common credentials.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, hint="(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]"),
    Rule("access", r"AKIA[A-Z0-9]{16,}", hint="AKIA"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", hint="gh[pousr]_"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}", hint="AIza"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", hint="eyJ"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", hint="PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", hint="xox[abprs]-"),
)
BASE = ("assign", "access", "hex")
_SPANS = "array<struct<kind: string, start: int, end: int>>"
BLOBS = f"blob string, rules array<string>, spans {_SPANS}"
PATHS = "path string, version string, blob string"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(sizes: Column) -> Column:
    """Running sums of an array, by doubling: round d adds to each the sum that ends 2^d places before, so n sums take log2(n) rounds over the array."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(sizes), F.lit(1)))).cast("int"))
    return F.aggregate(rounds, sizes, lambda sums, d: F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - F.pow(F.lit(2), d).cast("int")), F.lit(0))))


def spans_of(text: Column, rule: Rule) -> Column:
    """Spans of a rule's leftmost, non-overlapping matches, in code points, end exclusive.

    Spark gives the matches and the gaps between them; their running lengths are the places. Time is in proportion to the text, but for
    the rounds of the running sums.
    """
    p = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, p, F.lit(0))
    found = F.struct(F.split(text, rule.pattern, -1).alias("gaps"), whole.alias("all"), *([F.regexp_extract_all(text, p, F.lit(rule.group)).alias("parts")] if rule.group else []))

    def spans(x: Column) -> Column:
        sizes = F.zip_with(F.slice(x["gaps"], 1, F.size(x["all"])), x["all"], lambda gap, match: F.length(gap) + F.length(match))
        each = F.arrays_zip(x["all"].alias("match"), x["parts" if rule.group else "all"].alias("part"), _running(sizes).alias("end"))
        good = F.filter(each, lambda m: F.length(m["part"]) >= rule.least)
        return F.transform(good, lambda m: F.struct(F.lit(rule.kind).alias("kind"), (m["end"] - F.length(m["match"])).alias("start"), m["end"].alias("end")))

    return _let(found, spans)


def _scanned(text: Column, missing: Column, rules: tuple[Rule, ...]) -> Column:
    none = F.array().cast(_SPANS)
    found = [F.when(F.array_contains(missing, r.key) & text.rlike(r.hint or r.pattern), spans_of(text, r)).otherwise(none) for r in rules]
    return F.flatten(F.array(*found))


def scan(versions: DataFrame, ledger: DataFrame | None = None, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows (blob, rules, spans) for what ``ledger`` lacks: one row for each content that was scanned now.

    ``versions``: rows with a text, any path and version columns are ignored. A null text is the empty content; repeated rows are one
    content; an empty table gives no rows.
    """
    blobs = versions.select(_blob(text_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("content"))
    every = F.array(*(F.lit(r.key) for r in rules))
    if ledger is None:
        todo = blobs.groupBy("blob").agg(F.first("content").alias("content")).withColumn("missing", every)
    else:
        seen = ledger.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        missing = F.array_except(every, F.coalesce(F.col("seen"), F.array().cast("array<string>")))
        todo = blobs.join(seen, "blob", "left").withColumn("missing", missing).where("size(missing) > 0")
        todo = todo.groupBy("blob").agg(F.first("content").alias("content"), F.first("missing").alias("missing"))
    return todo.select("blob", F.col("missing").alias("rules"), _scanned(F.col("content"), F.col("missing"), rules).alias("spans"))


def _blob(text_col: str) -> Column:
    return F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256).alias("blob")


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A table of a ledger as it is now; None if no run has written it yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def update(versions: DataFrame, ledger_path: str, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Append to the ledger what it lacks for ``versions``, and return its table of blobs. A run that was broken off is repeated without harm; an empty table appends nothing."""
    spark, path = versions.sparkSession, f"{ledger_path}/blobs"
    scan(versions, read_table(spark, path, BLOBS), text_col, rules).write.mode("append").parquet(path)
    return read_table(spark, path, BLOBS)


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``paths``, which has a column blob, with the column spans: what the ledger holds for each content under the current ``rules``, by start, then rule order.

    Repeated paths are each answered; a blob that the ledger lacks, or that is null, has no spans; spans that two runs found are one. Other columns stay.
    Contents with findings are few; they are staged, and go to every task if they weigh little, so that a content with many paths gathers nowhere.
    """
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    current = F.array(*(F.lit(r.key) for r in rules))
    ran = F.transform(F.array_intersect("rules", current), lambda r: F.substring_index(r, "@", 1))
    live = F.filter("spans", lambda s: F.array_contains(ran, s["kind"]))
    known = ledger.select("blob", live.alias("spans")).where("size(spans) > 0").groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    keyed = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    once = _let(F.array_sort(keyed), lambda x: F.filter(x, lambda s, i: (i == 0) | (s != F.get(x, i - 1))))
    in_order = F.transform(once, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    joined = paths.join(sized(stage(known, "findings"), weight="1 + size(spans)"), "blob", "left")
    return joined.withColumn("spans", F.coalesce(in_order, F.array().cast(_SPANS)))


def scan_documents(docs: DataFrame, ledger_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, spans): all findings of every row of ``docs``, one row each, repeated rows included.

    What the ledger at ``ledger_path`` holds is not scanned again, and what it lacks is appended to it; without a path
    the ledger is a new one in the session's shared folder. An empty table gives an empty table.
    Nulls: a null text is empty and has no spans; a null id is returned as null. Other columns are ignored.
    """
    ledger = update(docs, ledger_path or fresh_path(docs.sparkSession, "ledger"), text_col, rules)
    return findings(docs.select(F.col(id_col).alias("doc_id"), _blob(text_col)), ledger, rules).select("doc_id", "blob", "spans")


def scan_history(versions: DataFrame, ledger_path: str, path_col: str = "path", version_col: str = "version", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, version, blob, spans): all findings of every version that this run or an earlier one has recorded in the ledger, one row each.

    ``versions`` may be the new ones only: a raised rule version is applied to the contents given, and findings of a
    rule that did not see a content in its current version are left out. Repeated rows are one version; null paths and versions are
    values like others; a null text is the empty content; an empty table records nothing. Other columns are ignored.
    """
    spark, place = versions.sparkSession, f"{ledger_path}/paths"
    given = versions.select(F.col(path_col).cast("string").alias("path"), F.col(version_col).cast("string").alias("version"), _blob(text_col)).distinct()
    ledger = update(versions, ledger_path, text_col, rules)
    recorded = read_table(spark, place, PATHS)
    if recorded is not None:
        old = recorded.withColumnsRenamed({"path": "old_path", "version": "old_version", "blob": "old_blob"})
        given = given.join(old, (given["blob"] == old["old_blob"]) & given["path"].eqNullSafe(old["old_path"]) & given["version"].eqNullSafe(old["old_version"]), "left_anti")
    given.write.mode("append").parquet(place)
    return findings(read_table(spark, place, PATHS), ledger, rules).select("path", "version", "blob", "spans")

"""Requests answered from a log where it has the answer, and from outside where it has not.

The log is a folder of Parquet to which every run appends: key (md5 of the request), request, response, error. A record without a response, or with one that
does not hold, counts as no answer, so it is asked for again; of several answers the latest run's counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "key string, request string, response string, error string, run int"


def is_json(response: Column) -> Column:
    """Whether a response is JSON: the check of landed API answers; a broken download is none."""
    return F.try_parse_json(response).isNotNull()


def log(spark: SparkSession, path: str) -> DataFrame:
    """All records; none before the first run."""
    try:
        return spark.read.schema(LOG).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def answers(records: DataFrame, holds: Callable[[Column], Column] = is_json) -> DataFrame:
    """(key, response): the latest answer of each key that holds."""
    good = records.where(F.col("response").isNotNull() & F.coalesce(holds(F.col("response")), F.lit(False)))
    return good.groupBy("key").agg(F.max_by("response", F.struct("run", "response")).alias("response"))


def missing(requests: DataFrame, records: DataFrame, holds: Callable[[Column], Column] = is_json) -> DataFrame:
    """(key, request) of ``requests`` (request) without an answer, each once; null requests are none."""
    asked = requests.where("request is not null").select(F.md5(F.col("request").cast("binary")).alias("key"), "request").distinct()
    return asked.join(answers(records, holds).select("key"), "key", "left_anti")


def answered(requests: DataFrame, records: DataFrame, holds: Callable[[Column], Column] = is_json) -> DataFrame:
    """``requests`` with their response; null where there is none."""
    found = answers(records, holds).withColumnRenamed("key", "__key")
    return requests.join(found, F.md5(F.col("request").cast("binary")) == F.col("__key"), "left").drop("__key")


def _next(records: DataFrame) -> int:
    return (records.agg(F.max("run")).first()[0] or 0) + 1


def landed(requests: DataFrame, path: str, responses: DataFrame, holds: Callable[[Column], Column] = is_json) -> DataFrame:
    """``requests`` answered by the log, after what it lacked was appended from ``responses`` (request, response): what was fetched outside, any rows of it."""
    spark = requests.sparkSession
    records = log(spark, path)
    found = missing(requests, records, holds).join(responses, "request").select("key", "request", "response", F.lit(None).cast("string").alias("error"), F.lit(_next(records)).alias("run"))
    found.write.mode("append").parquet(path)
    return answered(requests, log(spark, path), holds)


def asked(requests: DataFrame, path: str, client: Callable[[Sequence[str]], Sequence[str]], holds: Callable[[Column], Column] = lambda x: x != "", batch: int = 16, waves: int = 1, tasks: int = 8) -> DataFrame:
    """``requests`` answered by the log, after ``client`` was asked for what it lacked, ``batch`` at a time, by ``tasks`` tasks at once.

    ``client`` is sent to the tasks. If it fails, the batch is asked one by one, and what fails again is logged with its error and asked for in the next run. The requests go in ``waves``, each
    appended when it is done: a run that is broken off has to ask only for the rest.
    """
    spark = requests.sparkSession
    number = _next(log(spark, path))

    def calls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for lo in range(0, given.num_rows, batch):
                part = given.slice(lo, batch)
                out = _called(client, part.column("request").to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array([x[i] for x in out], pa.string()) for i in (0, 1))], ["key", "request", "response", "error"])

    for wave in range(waves):
        todo = missing(requests, log(spark, path), holds).where(F.pmod(F.xxhash64("key"), F.lit(waves)) == wave).repartition(tasks, "key")
        done = todo.mapInArrow(calls, "key string, request string, response string, error string")
        done.withColumn("run", F.lit(number)).write.mode("append").parquet(path)
    return answered(requests, log(spark, path), holds)


def _called(client: Callable, prompts: list[str]) -> list[tuple[str | None, str | None]]:
    """(response, error) of each prompt; a batch that fails is asked one by one."""
    try:
        got = list(client(prompts))
        if len(got) != len(prompts):
            raise ValueError(f"{len(got)} answers to {len(prompts)} prompts")
        return [(x, None) for x in got]
    except Exception as error:  # a client may fail in any way; what it says is kept
        return [(None, f"{type(error).__name__}: {error}")] if len(prompts) == 1 else [x for p in prompts for x in _called(client, [p])]

"""Sinks: upserts by version, retention, penalties, and writers for foreachBatch."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RESULT_KEY = ("ruleId", "windowStart", "groupKey")
DEFAULT_PENALTY_SECONDS = 3600
BATCH_ROWS, BACKOFF_S = 5_000, (0.5, 1.0, 2.0, 4.0)


def result_table_rows(results: DataFrame) -> DataFrame:
    """Result rows as the result table has them: id is ruleId, entityValue goes, rows without an id are skipped."""
    return results.where("id is not null").select(F.col("id").alias("ruleId"), "windowStart", "windowEnd", "entityName", "groupKey", "aggResult", "producedAt", "thresholdBreached", "isFinal")


def upsert_latest(rows: DataFrame, key: tuple[str, ...] = RESULT_KEY, version: str = "producedAt", tie: tuple[str, ...] = ()) -> DataFrame:
    """Of rows with the same key, the newest version: what a replacing table shows after its merges."""
    order = W.partitionBy(*key).orderBy(F.col(version).desc(), *[F.col(t).desc() for t in tie])
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def retained(rows: DataFrame, day: str, days: int, today: str) -> DataFrame:
    """Rows of the last ``days`` days; a partition filter where ``day`` is the partition column."""
    return rows.where(F.col(day) >= F.date_sub(F.lit(today).cast("date"), days))


def penalties(anomalies: DataFrame, at_ms: int | None = None) -> DataFrame:
    """rule_id, entity, produced_ms, expires_ms from anomalies (rule_id, entity, produced_ms, penalty_ttl_seconds).

    The newest anomaly sets the penalty. 0 seconds stands for the default, a negative number for no end. With ``at_ms``: those active then.
    """
    last = anomalies.groupBy("rule_id", "entity").agg(F.max(F.struct("produced_ms", "penalty_ttl_seconds")).alias("l"))
    ttl = F.when(F.col("l.penalty_ttl_seconds") == 0, DEFAULT_PENALTY_SECONDS).otherwise(F.col("l.penalty_ttl_seconds"))
    out = last.select("rule_id", "entity", "l.produced_ms", F.when(ttl > 0, F.col("l.produced_ms") + ttl * 1000).alias("expires_ms"))
    return out if at_ms is None else out.where(F.col("expires_ms").isNull() | (F.col("expires_ms") > at_ms))


def create_tables(spark: SparkSession, database: str) -> None:
    """The result and anomaly tables, partitioned by day, if they don't exist."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.results (ruleId STRING, windowStart STRING, windowEnd STRING, entityName STRING, groupKey STRING, aggResult STRING, producedAt STRING, thresholdBreached BOOLEAN, isFinal BOOLEAN, window_date DATE) USING parquet PARTITIONED BY (window_date)")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.anomalies (ruleId STRING, entityValue STRING, producedAt STRING, penaltyTtlSeconds INT, produced_date DATE) USING parquet PARTITIONED BY (produced_date)")


def retrying(send: Callable[[list[str]], None], fatal: tuple[type[Exception], ...] = (), waits: tuple[float, ...] = BACKOFF_S, sleep=time.sleep) -> Callable[[list[str]], None]:
    """``send`` with a try more than there are waits; errors of a ``fatal`` kind, and the last one, are raised."""

    def go(rows: list[str]) -> None:
        for wait in (*waits, None):
            try:
                return send(rows)
            except Exception as e:
                if isinstance(e, fatal) or wait is None:
                    raise
                sleep(wait)

    return go


def in_batches(rows: Iterator[str], send: Callable[[list[str]], None], size: int = BATCH_ROWS) -> int:
    """Sends rows in batches; how many there were."""
    held: list[str] = []
    n = 0
    for row in rows:
        held.append(row)
        n += 1
        if len(held) >= size:
            send(held)
            held = []
    if held:
        send(held)
    return n


def json_lines_sink(send_factory: Callable[[], Callable[[list[str]], None]]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that sends each row as a JSON line from the executors, at least once."""

    def write(batch: DataFrame, _: int) -> None:
        def part(rows) -> None:
            in_batches((r[0] for r in rows), retrying(send_factory()))

        batch.select(F.to_json(F.struct("*"))).foreachPartition(part)

    return write


def kafka_sink(rows: DataFrame, servers: str, topic: str, key: str, checkpoint: str):
    """A stream of JSON values keyed by ``key``; needs Spark's Kafka connector."""
    out = rows.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
    return out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("checkpointLocation", checkpoint).start()


def table_sink(path: str, day: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes each batch under its own id, so that a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", day).parquet(path)

    return write

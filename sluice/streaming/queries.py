"""Streaming operators as queries: the test events replayed as a stream of files, run to its end, and read as a table."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fields import extract
from .stateful import OUTPUT, dedup_stream, evaluate_stream, use_rocksdb


def scratch(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        import tempfile

        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")

        root = "file://" + tempfile.mkdtemp(prefix="sluice-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/stream-{uuid.uuid4().hex}"


def replay(spark: SparkSession, sf_dir: str, parts: int = 3) -> tuple[DataFrame, str]:
    """The canonical frame of the test events as a file stream of ``parts`` micro-batches in order of ingestion, and its folder."""
    from ..catalog import frame

    at = scratch(spark)
    rows = frame(spark, sf_dir)
    rows.repartitionByRange(parts, "ingest_ms").sortWithinPartitions("ingest_ms").write.parquet(f"{at}/in")
    stamp_in_order(spark, f"{at}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(f"{at}/in")
    return stream, at


def stamp_in_order(spark: SparkSession, folder: str) -> None:
    """Gives a folder's data files modification times a second apart in order of their names, which is the order of their ranges: the file
    source goes by these, and the tasks that write them end in any order. Raises where the store does not keep the times."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((x.getPath() for x in fs.listStatus(path) if x.getPath().getName().startswith("part-")), key=lambda x: x.getName())
    start = int(time.time()) - len(files)
    for k, file in enumerate(files):
        fs.setTimes(file, 1000 * (start + k), -1)
        if fs.getFileStatus(file).getModificationTime() != 1000 * (start + k):
            raise RuntimeError(f"modification times can't be set in {folder}: the order of the replay would be arbitrary")


def finish(stream: DataFrame, at: str, processing: bool = False) -> None:
    """Runs a stream until all files of ``at``/in are used up, however long that takes; a processing-time operator never ends by itself and is
    stopped then. Raises if the stream failed or ended before."""
    files = len(stream.sparkSession.read.schema("offset long").parquet(f"{at}/in").inputFiles())
    run = stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/ck").outputMode("append")
    query = (run.trigger(processingTime="1 second") if processing else run.trigger(availableNow=True)).start()
    try:
        settle(query, files) if processing else query.awaitTermination()
        if query.exception():
            raise query.exception()
        if taken(query) < files:
            raise RuntimeError(f"the stream ended after {taken(query)} of {files} files")
    finally:
        query.stop()


def taken(query) -> int:
    """Files whose batches are committed, of a stream that takes one at a time."""
    progress = query.lastProgress
    end = progress and progress["sources"][0]["endOffset"]
    return int(re.search(r"logOffset\W+(-?\d+)", str(end))[1]) + 1 if end else 0


def settle(query, files: int) -> None:
    """Until the batch of the last file is committed or the query has ended."""
    while query.isActive and taken(query) < files:
        time.sleep(0.5)


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final rows of the windows that the watermark has closed."""
    from ..catalog import DAY, VALUE, rule

    use_rocksdb(spark)
    stream, at = replay(spark, sf_dir)
    r = rule("s", keys=("event_type",), size=DAY, aggs=(("cnt", "COUNT", None), ("total", "SUM", VALUE)), having="cnt > 3")
    finish(evaluate_stream(stream, r, early_interval_ms=None), at)
    out = spark.read.schema(OUTPUT).parquet(f"{at}/out")
    return out.where("kind = 'result' and is_final").select("rule_id", "group_key", "window_start_ms", "window_end_ms", F.get_json_object("aggregates", "$.cnt").cast("double").alias("cnt"), "breached")


def stream_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early and final anomalies."""
    from ..catalog import HOUR, rule

    use_rocksdb(spark)
    stream, at = replay(spark, sf_dir)
    r = rule("s", keys=("event_type",), size=6 * HOUR, having="cnt >= 5", entity_field="_data.user_id")
    finish(evaluate_stream(stream, r, early_interval_ms=None), at)
    return spark.read.schema(OUTPUT).parquet(f"{at}/out").where("kind = 'anomaly'").select("rule_id", "group_key", "entity", "window_start_ms", "is_final")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user and type: the replay takes less than the TTL."""
    use_rocksdb(spark)
    stream, at = replay(spark, sf_dir)
    out = dedup_stream(stream, extract("_data.code"))
    finish(out, at, processing=True)
    return spark.read.schema(out.schema).parquet(f"{at}/out").select(F.col("offset").alias("event_id"))


def oracle_sql() -> dict[str, str]:
    """The same from tables: windows that end before the watermark (the last ingestion less 60 s), and events in the order of ingestion."""
    from ..catalog import DAY, EV, HOUR, early_sql, windowed_sql

    return {
        "stream_tumbling": f"""SELECT * FROM ({windowed_sql("CAST(count(*) AS DOUBLE) AS cnt", "cnt > 3", "s", size=DAY, slide=DAY, key="kind")}) WHERE window_end_ms <= (SELECT max(ingest_ms) - 60000 FROM ({EV} SELECT ingest_ms FROM ev))""",
        "stream_anomalies": f"""{early_sql(6 * HOUR, 6 * HOUR, "count(*) OVER o AS cnt", "cnt >= 5")} SELECT 's' AS rule_id, group_key, uid AS entity, pane AS window_start_ms, FALSE AS is_final FROM e WHERE n = 1""",
        "stream_dedup": f"""{EV}, o AS (SELECT event_id, row_number() OVER (PARTITION BY uid, topic ORDER BY ingest_ms, event_id) AS n FROM ev) SELECT event_id FROM o WHERE n = 1""",
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (stream_tumbling, stream_anomalies, stream_dedup)}

"""Event-time windows, the same for tables and streams."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from brambling.runtime import shared_dir
from brambling.sources.files import found, is_folder


def _timed(events: DataFrame, late: str) -> DataFrame:
    """Events with a time. A stream gets a watermark, which needs an instant: times without zone are taken as UTC there."""
    e = events.where("ts IS NOT NULL")
    if not e.isStreaming:
        return e
    if dict(e.dtypes)["ts"] == "timestamp_ntz":
        e = e.withColumn("ts", F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp"))
    return e.withWatermark("ts", late)


def _plain(df: DataFrame, c: str) -> Column:
    """A time as timestamp without zone; instants in UTC."""
    if dict(df.select(c).dtypes)[c.rpartition(".")[2]] == "timestamp_ntz":
        return F.col(c)
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(c).cast("timestamp_ntz"))


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window_start, event_type, n, total): events per window and type. Null times are left out. On a stream, windows close `late` after
    the greatest time seen."""
    g = _timed(events, late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return g.select(_plain(g, "window.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """(user_id, session_start, session_end, n): runs of a user's events with less than `gap` between neighbours."""
    g = _timed(events, late).where("user_id IS NOT NULL").groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("n"))
    return g.select("user_id", _plain(g, "session_window.start").alias("session_start"), _plain(g, "session_window.end").alias("session_end"), "n")


def first_seen(events: DataFrame, key: str = "event_id", late: str = "2 hours") -> DataFrame:
    """Events without repeats of `key`; a stream forgets keys `late` after their time."""
    e = _timed(events, late)
    return e.dropDuplicatesWithinWatermark([key]) if e.isStreaming else e.dropDuplicates([key])


def streamed(spark: SparkSession, path: str, step: Callable[[DataFrame], DataFrame], keys: Sequence[str], files_per_batch: int | None = None) -> DataFrame:
    """The result of `step` over the files at `path` read as a stream, run to the end of what is there, as a table.

    A batch writes the rows that changed in it (output mode update), under its number, so that a batch run again replaces itself; of
    each of the columns `keys` the row of the last batch counts. State is kept for open windows only: the watermark of `step` drops the others,
    and rows later than that. The stream's checkpoint and output lie in the shared folder, so that a lost executor or driver can resume.
    """
    base = f"{shared_dir(spark)}/brambling/stream-{uuid.uuid4().hex}"
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    where, pattern = (path, "*.parquet") if is_folder(spark, path) else (folder, name)
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    out = step(reader.parquet(where))

    def save(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={n}")

    q = out.writeStream.outputMode("update").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(save).start()
    q.awaitTermination()
    if not found(spark, f"{base}/out/batch=*"):
        return out.sparkSession.createDataFrame([], out.schema)
    rows = spark.read.schema(StructType([*out.schema.fields, StructField("batch", LongType())])).option("basePath", f"{base}/out").parquet(f"{base}/out")
    rest = [c for c in out.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*[F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in out.columns])

"""Incremental forms on Structured Streaming: S1-S5."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from stridelake.functions.clock import micros
from stridelake.sources.tables import upsert


def gps_stream(spark: SparkSession, path: str, schema, keys: Sequence[str], ts: str, delay: str = "10 minutes", max_files: int | None = None) -> DataFrame:
    """Points of a Parquet feed as a stream; a key that comes again within the delay is dropped."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_profile(points: DataFrame, keys: Sequence[str], ts: str, speed: str, width: str, slide: str | None = None) -> DataFrame:
    """Speed profile per series and window; works on a batch and, with a watermark, on a stream."""
    at = F.window(ts, width, slide or width)
    out = points.groupBy(at.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.avg(speed).alias("mean_speed"), F.min(speed).alias("min_speed"), F.max(speed).alias("max_speed"))
    return out.select(micros("w.start").alias("window_start_us"), *keys, "n", "mean_speed", "min_speed", "max_speed")


def stream_sessions(points: DataFrame, keys: Sequence[str], ts: str, gap: str) -> DataFrame:
    """Sessions: a gap without points closes one."""
    out = points.groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.min(micros(ts)).alias("first_us"), F.max(micros(ts)).alias("last_us"))
    return out.drop("w")


def stream_upsert(stream: DataFrame, target: str, keys: Sequence[str], order: Sequence, checkpoint: str, name: str = "table") -> StreamingQuery:
    """Put each micro-batch into a Parquet table by key, all that is there now, then stop.

    Each batch writes a version of its own number beside the one before, which is
    only read, so a batch that runs again gives the same table. A missing version
    is an error and not an empty table. Versions before the last two are deleted.
    ``current_version`` reads the table.
    """
    return stream_merge(stream, target, lambda before, batch: upsert(batch.limit(0) if before is None else before, batch, keys, order), checkpoint, name)


def stream_merge(stream: DataFrame, target: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame], checkpoint: str, name: str = "table") -> StreamingQuery:
    """Versions of a table as in ``stream_upsert``, where ``merge`` gives the next of the one before, None at first, and a micro-batch."""
    spark = stream.sparkSession

    def put(batch: DataFrame, epoch: int) -> None:
        if epoch and not _there(spark, f"{target}/{name}-v{epoch - 1}/_SUCCESS"):
            raise ValueError(f"version {epoch - 1} of {target} is not there")
        before = batch.sparkSession.read.parquet(f"{target}/{name}-v{epoch - 1}") if epoch else None
        merge(before, batch).write.mode("overwrite").parquet(f"{target}/{name}-v{epoch}")
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{name}-v{epoch - 2}")
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_version(spark: SparkSession, target: str, name: str = "table") -> DataFrame:
    """The table that ``stream_upsert`` keeps, as of its last whole version."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{name}-v*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    versions = [int(f.getPath().getParent().getName().rpartition("-v")[2]) for f in found]
    if not versions:
        raise ValueError(f"there is no version of {target}")
    return spark.read.parquet(f"{target}/{name}-v{max(versions)}")


def _there(spark: SparkSession, file: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


class LastPoint(StatefulProcessor):
    """Kinematics of each series against the last point of the batch before.

    Within a micro-batch points are sorted by time; a feed of bounded files per
    trigger bounds what a series brings at once.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "ts_us long, speed double, acceleration double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(["ts_us", "id"], kind="stable")
        seen = self.last.get() if self.last.exists() else None
        ts, speed = frame["ts_us"].to_numpy(), frame["speed"].to_numpy(dtype=float)
        before_ts = pd.Series([seen[0] if seen else None, *ts[:-1]], dtype="float64")
        before_speed = pd.Series([seen[1] if seen else None, *speed[:-1]], dtype="float64")
        dt = (pd.Series(ts, dtype="float64") - before_ts) / 1e6
        acceleration = (pd.Series(speed) - before_speed) / dt.where(dt != 0)
        earlier = pd.Series([seen[2] if seen else None, *acceleration[:-1]], dtype="float64")
        jerk = (acceleration - earlier) / dt.where(dt != 0)
        end = acceleration.iloc[-1]
        self.last.update((int(ts[-1]), float(speed[-1]), None if pd.isna(end) else float(end)))
        yield pd.DataFrame({"runner": [key[0]] * len(frame), "id": frame["id"].to_numpy(), "dt": dt, "acceleration": acceleration, "jerk": jerk})

    def close(self) -> None:
        pass


def stream_kinematics(points: DataFrame, key: str = "runner") -> DataFrame:
    """Steps, accelerations and jerks of a stream of (runner, id, ts_us, speed), over batches."""
    return points.groupBy(key).transformWithStateInPandas(
        statefulProcessor=LastPoint(), outputStructType="runner long, id long, dt double, acceleration double, jerk double", outputMode="Append", timeMode="None"
    )

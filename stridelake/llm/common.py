"""Shared pieces: the shared scratch folder and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table by a path that only Spark needs to understand."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    A local session without the setting falls back to ``/tmp/checkpoints``; on a
    cluster a missing setting is an error, as local disks are not shared.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        return "file:///tmp/checkpoints"
    raise ValueError("spark.checkpoint.dir must name a folder that all executors share")


@contextmanager
def _shuffles_go(spark: SparkSession):
    """Queries that run within have their shuffle files deleted at their end, not when the driver next collects its garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before) if before else spark.conf.unset(setting)


class Scratch:
    """Intermediate tables as Parquet in the shared folder; they survive lost executors."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        """Write a frame once and return a frame that reads it, with its lineage cut; so its shuffles are not read again."""
        with _shuffles_go(self.spark):
            frame.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(frame.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table that no later plan reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Schemes by which Spark knows a store that Arrow knows by another one.
ARROW_SCHEMES = (("s3a://", "s3://"), ("s3n://", "s3://"), ("dbfs:/", "file:///dbfs/"))


def arrow_uri(folder: str) -> str:
    """A folder's URI by the scheme that Arrow knows; hdfs, gs, abfss and file are the same for both."""
    for spark_scheme, arrow_scheme in ARROW_SCHEMES:
        if folder.startswith(spark_scheme):
            return arrow_scheme + folder[len(spark_scheme) :].lstrip("/")
    return folder


def file_store(folder: str):
    """Arrow's file system of a shared folder, and the folder's path in it; for tasks that write or read files of their own."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(arrow_uri(folder))


def quoted(name: str) -> str:
    """A column's name for an expression, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def keep_rows(docs: DataFrame, text: str, decide: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, list[bool]]]]) -> DataFrame:
    """The rows whose own text a task keeps, with all their columns; nothing shuffles and no id is needed.

    ``decide`` takes batches with one column, the texts, and gives each batch
    back with a mark for each row; it may hold batches back. Columns keep their
    order; their types must be ones that Arrow can hold.
    """
    at = docs.columns.index(text)
    # As one struct, so that any name can pass.
    rows = docs.select(F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def texts() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held.append(batch)
                yield pa.RecordBatch.from_arrays([batch.column(0).field(at)], names=["text"])

        for _, marks in decide(texts()):
            yield held.pop(0).filter(pa.array(marks, pa.bool_()))

    return rows.mapInArrow(task, rows.schema).select("row.*")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def connected_components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    Alternating large-star and small-star steps: each keeps at most one edge per
    input edge, so no step grows, and a hub's edges are reduced map-side before
    its minimum is joined back (a join that adaptive execution can split). The
    loop ends when a round changes nothing; its state lives in the shared folder.

    Nulls and self-loops in ``edges`` are ignored; no edges gives no rows.
    Returns ``node`` and ``component``.
    """
    nodes = (F.col(a).alias("u"), F.col(b).alias("v"))
    now = (
        edges.select(*nodes)
        .filter("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    now, turn = scratch.save(now, "cc-0"), 0
    print_of = F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"))
    before = now.agg(print_of.alias("p")).head()["p"]
    while before["n"]:
        after = _small_star(_large_star(now))
        saved = scratch.save(after, f"cc-{turn + 1}")
        scratch.drop(f"cc-{turn}")
        turn += 1
        seen = saved.agg(print_of.alias("p")).head()["p"]
        now = saved
        if seen == before:
            break
        before = seen
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest of the node's circle."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return linked.unionByName(own).filter("u <> v").distinct()

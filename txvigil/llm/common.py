"""What the operators share: shared-folder tables, batches in Python, words, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# A word is a run of characters other than ASCII white space; bytes.split() cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir, removed when the session's JVM ends.

    Only a local session may do without that setting; it gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="txvigil-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stored(rows: DataFrame, free: bool = False) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends here and outlives executors.

    Spark removes the files of a shuffle once the driver has collected what refers to it.
    ``free`` asks for that now, after a large shuffle that ends here.
    """
    path = shared_path(rows.sparkSession)
    rows.write.option("compression", "zstd").parquet(path)
    if free:
        rows.sparkSession._jvm.System.gc()
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def discard(rows: DataFrame) -> None:
    """Removes a table that ``stored`` made and nothing reads any more."""
    spark = rows.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in rows.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(file)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def with_columns(
    rows: DataFrame, needs: list[str], added: str, work: Callable[..., list[pa.Array]]
) -> DataFrame:
    """Adds columns that Python computes a batch at a time; ``work`` gets the needed columns.

    ``added`` is their schema as DDL. A column of the same name is replaced.
    """
    new = T._parse_datatype_string(added)
    rows = rows.select([c for c in rows.columns if c not in new.names])
    at = [rows.columns.index(c) for c in needs]
    names = [*rows.columns, *new.names]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            arrays = work(*[part.column(i) for i in at])
            yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=names)

    return rows.mapInArrow(batches, T.StructType([*rows.schema.fields, *new.fields]))


def unused(name: str, columns: list[str]) -> str:
    """The name, longer if a column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def one_row(rows: DataFrame, single: DataFrame) -> DataFrame:
    """Adds the columns of a table of exactly one row, an aggregate without keys."""
    key: Column = F.lit(1).alias("_one")
    joined = rows.withColumn("_one", F.lit(1)).join(
        F.broadcast(single.select("*", key)), "_one", "left"
    )
    return joined.drop("_one")


def components(links: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """Connected components: (node, component) for every node of ``links``(a, b).

    Every round a node takes the smallest label around it and then the label of that label;
    sums of a hub's rows are combined before the shuffle, and rounds end when nothing moves.
    """
    edges = stored(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct()
    )
    labels = stored(
        edges.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.first("a")).alias("component")
        )
    )
    while True:
        around = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        nearest = labels.join(around, "node").select(
            "node", "component", F.least("component", "near").alias("next")
        )
        step = stored(nearest)
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("jumped"))
        moved = stored(
            step.join(jump, "next", "left").select(
                "node", "component", F.least("next", F.coalesce("jumped", "next")).alias("next")
            )
        )
        changed = moved.filter("component <> next").isEmpty()
        discard(step)
        discard(labels)
        labels = moved.select("node", F.col("next").alias("component"))
        if changed:
            discard(edges)
            return labels


# A side of a join with at most so many rows, in files of so many bytes, is sent to every executor.
BESIDE, BESIDE_BYTES = 1_000_000, 32 << 20


def stored_bytes(rows: DataFrame) -> int:
    """Bytes of the files that a stored table is read from, as Spark estimates plans by them."""
    return int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def beside(rows: DataFrame, most: int = BESIDE, size: int = BESIDE_BYTES) -> DataFrame:
    """Rows of a stored table, to be broadcast if they are few and short; shuffled like any if not."""
    return F.broadcast(rows) if stored_bytes(rows) <= size and rows.count() <= most else rows

"""Helpers that the operators of this package share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acctrecon.plans.cut import checkpoint_root, ensure_checkpoint_dir, materialize

#: Bytes of text that one Arrow batch yielded by a Python stage may stand for.
BATCH_BYTES = 4 << 20
#: Short rows (a few numbers) that one file of a cut is worth.
FILE_ROWS = 1 << 18


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it.  A
    single-process session without one (tests) gets a folder of its own; any
    other session without one is an error."""
    root = checkpoint_root(spark)
    if root is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="llm-shared-"))
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    With ``most``, a bound on its rows, which are short, it is written in one
    file for each FILE_ROWS of them, or as many as tasks run at once: each file
    costs a few calls of the file system, some of them processes of their own.
    Only for what a grouping ends in, as the tasks of that step are joined."""
    if most is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-most // FILE_ROWS)))
    return materialize(df, "rows", new_folder(df.sparkSession, name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str):
    """A string column as UTF-8 bytes; null is the empty text."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def batches(rows: Iterable[tuple], schema: pa.Schema, weigh=None, most: int = BATCH_BYTES,
            count: int = 4096) -> Iterator[pa.RecordBatch]:
    """Row tuples as record batches of bounded bytes and length."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weigh(row) if weigh else 64
        if size >= most or len(held) >= count:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def rows_of(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of record batches; slices keep few Python objects alive."""
    for batch in stream:
        for at in range(0, batch.num_rows, 256):
            yield from zip(*[c.to_pylist() for c in batch.slice(at, 256).columns])


def positions(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with a 0-based ``name``: the row's place in its group by
    ``order``.  Rows are dealt by range, so a group of any size spreads over
    many tasks; only one count per group and task meets in a window."""
    keys = [group, *[c for c in order if c != group]]
    ranked = cut(df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in keys])
                 .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in keys])
                 .withColumn("_at", F.monotonically_increasing_id())
                 .withColumn("_task", F.shiftright("_at", 33)), "ranked")
    runs = ranked.groupBy(group, "_task").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = cut(runs.select(F.col(group).alias("_group"), F.col("_task").alias("_run"), "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "runs")
    return (ranked.join(runs, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_task") == F.col("_run")))
            .withColumn(name, F.col("_before") + F.col("_at") - F.col("_first"))
            .drop("_at", "_task", "_group", "_run", "_first", "_before"))

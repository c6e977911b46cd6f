"""Idempotent stage writes with a distribution key and a sort order -- the
Spark form of drop-and-rebuild tables with a distribution and sort key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BY_TARGET = (("merchant",), ("merchant", "roster_studioid", "roster_locationid"))
#: Stage -> distribution and sort columns of its table.  The location stages
#: carry no merchant and use the store id.
LAYOUT: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "facts": (("merchant",), ("merchant",)),
    "report_month": (("reportdate",), ("reportdate",)),
    "active_locations": (("mid",), ("mid", "ho_mid", "studioid", "locationid")),
    **{stage: (("storeid",), ("storeid", "studioid", "locationid"))
       for stage in ("single_location", "unmatched_store", "multi_location")},
    "master_list": (("merchant",), ("merchant", "studioid", "locationid")),
    "catch_all": (("merchant",), ("merchant",)),
    **{stage: _BY_TARGET
       for stage in ("exact_roster_match", "parent_studio_match", "merchant_id_match", "even_distribution",
                     "exclusive_location", "shared_location", "all_mappings", "multi_mapped",
                     "merged_mappings", "final_list")},
}


#: Stage -> columns that its table has folders by: readers of one value list
#: and open no other.
FOLDERS: dict[str, tuple[str, ...]] = {"facts": ("month",)}


def write_stage(df: DataFrame, path: str, *, distribute_by: Sequence[str] = (), sort_by: Sequence[str] = (),
                partition_by: Sequence[str] = (), partitions: int | None = None) -> None:
    """Overwrite ``path`` with ``df`` distributed on ``distribute_by`` and
    sorted within each file by ``sort_by`` (min/max statistics of the sorted
    columns then prune row groups on read), in a folder for each value of
    ``partition_by``.  Adaptive execution may split a key that outgrows a
    partition over several files."""
    out = df
    if distribute_by or partition_by:
        by = [*partition_by, *[c for c in distribute_by if c not in partition_by]]
        out = out.hint("rebalance", *([partitions] if partitions else []), *by)
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    writer = out.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_clustered(df: DataFrame, path: str, *, cluster_by: Sequence[str], files: int | None = None) -> None:
    """Overwrite ``path`` with files that hold ranges of the ``cluster_by``
    columns, split at sampled quantiles and sorted inside, so that a value
    occurs in few files.  A value that many rows share can't be split by the
    columns alone, so a hash of the row breaks ties; without ``files`` the
    session's number of shuffle partitions is taken."""
    by = [F.col(c).asc_nulls_first() for c in cluster_by]
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    out = df.repartitionByRange(files, *by, tie) if files else df.repartitionByRange(*by, tie)
    out.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, *, buckets: int, bucket_by: Sequence[str],
                   sort_by: Sequence[str] = (), path: str | None = None) -> None:
    """Bucketed table so later joins on ``bucket_by`` skip the shuffle.  Rows
    are shuffled by bucket first, so each bucket is one file.  A bucket holds
    a key whole by definition: ``copartition`` keeps hot keys apart.  With
    ``path`` the files lie there and not in the warehouse."""
    w = df.repartition(buckets, *bucket_by).write.mode("overwrite").bucketBy(buckets, *bucket_by)
    if sort_by:
        w = w.sortBy(*sort_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def copartition(df: DataFrame, key: str, *, table: str, path: str, buckets: int, most: int) -> list[DataFrame]:
    """``df``, a written table, as parts that share no ``key``: the rows of
    most keys bucketed by it, so that readers who group or join by it need no
    exchange; and the rows of hot keys, those with over ``most`` rows, plain,
    so that readers deal them as they do otherwise.  Rows without a key are
    with the hot ones.

    There are at most rows / ``most`` hot keys; they are joined, not
    collected.  ``table`` is the name of the bucketed part in the catalog,
    files of both lie under ``path``."""
    spark = df.sparkSession
    hot = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    hot.select(F.col(key).alias("_hot")).write.mode("overwrite").parquet(f"{path}/hot_keys")
    hot = spark.read.parquet(f"{path}/hot_keys")
    same = F.col(key) == F.col("_hot")
    write_bucketed(df.where(F.col(key).isNotNull()).join(hot, same, "left_anti"), table, buckets=buckets,
                   bucket_by=[key], path=f"{path}/buckets")
    apart = df.where(F.col(key).isNull()).unionByName(df.join(hot, same, "left_semi"))
    apart.write.mode("overwrite").parquet(f"{path}/apart")
    return [spark.table(table), spark.read.parquet(f"{path}/apart")]

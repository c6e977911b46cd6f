"""Session settings the pipeline is tuned for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans are designed for.  AQE re-plans at every
# shuffle boundary: it turns a sort-merge join into a broadcast when the
# measured output of the finished shuffle stage is under the adaptive
# threshold, splits skewed join partitions (a hot store, name or sentinel
# key) and coalesces small shuffle partitions.  Partial aggregation is on by
# default.  The planner itself broadcasts a side only when the true size of
# its files, times a compression factor, is under a small bound: the large
# side of such a join is then never shuffled.
RUNTIME_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(16 * 1024 * 1024),
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # scan splits: 256 MB keeps a 100 TB payments scan near 400k tasks
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.exchange.reuse": "true",
}
PIPELINE_CONF = {
    **RUNTIME_SQL_CONF,
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


#: Bytes that a shuffle partition starts with, about (adaptive execution then
#: joins small ones), and partitions, at most.
START_BYTES, MOST_PARTITIONS = 128 << 20, 1 << 15


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size of what ``df`` reads: its files' bytes, times the
    factor for compression."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def start_partitions(input_bytes: int, least: int) -> int:
    """Shuffle partitions to start with for an input of ``input_bytes``."""
    return max(least, min(MOST_PARTITIONS, -(-input_bytes // START_BYTES)))


def apply_runtime_conf(spark: SparkSession, inputs: Iterable[DataFrame] = ()) -> None:
    """Set those of the runtime SQL settings above that the session has
    otherwise, and start shuffles with as many partitions as the largest of
    ``inputs`` asks for (a fixed number would leave a large input with
    partitions of hundreds of GB).  They stay set: results are lazy and
    planned later."""
    settings = dict(RUNTIME_SQL_CONF)
    sizes = [planned_bytes(df) for df in inputs]
    if sizes:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            start_partitions(max(sizes), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    for k, v in settings.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def build_session(master: str = "local[8]", app: str = "acctrecon",
                  shuffle_partitions: int = 8, extra: dict | None = None,
                  driver_memory: str = "16g") -> SparkSession:
    """Local sessions (tests, bench).  On a cluster the submitter's settings
    apply; only the SQL settings above matter to the plans."""
    b = SparkSession.builder.master(master).appName(app).config("spark.driver.memory", driver_memory)
    for k, v in {**PIPELINE_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions),
                 **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

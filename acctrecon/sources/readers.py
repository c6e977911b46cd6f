"""Parquet and CSV readers with explicit schemas."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctrecon import schemas as S
from acctrecon.plans.cut import remove_at_exit, run_folder


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_inputs(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """payments / accounts / locations / roster stored as parquet under root."""
    return {name: read_table(spark, f"{root}/{name}")
            for name in ("payments", "accounts", "locations", "roster")}


def read_accounts_csv(spark: SparkSession, path: str) -> DataFrame:
    """The account file: header row, UTF-8 (a BOM is stripped by the reader),
    CRLF or LF, 11 positional columns.  The credential and contact columns are
    never selected, so the CSV parser does not even convert them.  A damaged
    enabled date (e.g. only ``mm:ss.0``) becomes NULL instead of failing."""
    raw = (spark.read.schema(S.ACCOUNTS_CSV)
           .option("header", True)
           .option("mode", "PERMISSIVE")
           .option("encoding", "UTF-8")
           .csv(path))
    return raw.select(
        F.col("account_name"),
        F.col("account_id").try_cast("bigint").alias("account_id"),
        F.try_to_timestamp(F.col("enabled_date"), F.lit(S.ACCOUNTS_CSV_TS_FORMAT)).alias("enabled_date"),
        F.col("store_id"),
        F.col("currency"),
        F.col("sales_region"),
        F.col("service_user_number"),
        F.col("processing_type"),
        F.col("related_account"),
    )


#: A field: quoted, with doubled quotes inside, or plain; and why a row can't
#: be read.
_FIELD = '(?:"[^"]*(?:""[^"]*)*"|[^",][^,]*|)'
_WIDTH = len(S.ACCOUNTS_CSV.fields)
TOO_FEW, TOO_MANY, BAD_QUOTE = "too few fields", "too many fields", "quote without end"
#: Rows that are kept, with a NULL in place of what can't be read.
NO_DATE, NO_ID = "enabled date unreadable", "account id unreadable"
#: Place of the first field that is never kept.
_SECRET = [f.name for f in S.ACCOUNTS_CSV.fields].index("_unread_5")


def ingest_accounts(spark: SparkSession, path: str, *, header: bool = True,
                    folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The account file, and what is wrong with it: (accounts, rejected).

    Every line is read once and judged: one that has not the file's number of
    fields, or a quote without an end, goes to ``rejected`` (file, reason,
    n_fields, line); the others are accounts, with NULL for a date or an id
    that can't be read.  Both are written to ``folder`` (by default one that
    goes with the session) side by side.

    ``line`` is what stands before the credential and contact columns: fields
    that may have slipped there because others are missing are cut as well.
    Lines end in LF or CRLF, a byte order mark is dropped, records do not span
    lines.  With ``header`` the first line, wherever it occurs, is no record.
    Empty lines are none either; an empty file gives two empty tables."""
    lines = spark.read.text(path).select(
        F.regexp_replace("value", "^\ufeff|\r$", "").alias("line"), F.col("_metadata.file_name").alias("file"))
    lines = lines.where(F.length("line") > 0)
    first = lines.first() if header else None
    if first is not None:
        lines = lines.where(F.col("line") != F.lit(first.line))
    some = lambda n: F.col("line").rlike(f"^(?:{_FIELD},){{{n}}}{_FIELD}$")
    reason = (F.when(some(_WIDTH - 1), F.lit(None).cast("string")).when(some(f"0,{_WIDTH - 2}"), F.lit(TOO_FEW))
              .when(some(f"{_WIDTH},"), F.lit(TOO_MANY)).otherwise(F.lit(BAD_QUOTE)))
    split = F.split("line", ",")
    n_split = F.size(split)
    safe = F.greatest(F.lit(0), F.lit(_SECRET) - F.greatest(F.lit(0), F.lit(_WIDTH) - n_split))
    kept = [f for f in S.ACCOUNTS_CSV.fields if not f.name.startswith("_")]
    row = F.from_csv("line", S.ACCOUNTS_CSV.simpleString()[len("struct<"):-1].replace(":", " "),
                     {"escape": '"', "mode": "PERMISSIVE"})
    judged = lines.select("file", reason.alias("reason"), n_split.alias("n_fields"),
                          F.array_join(F.slice(split, F.lit(1), safe), ",").alias("line"), row.alias("row"))
    bad = F.col("reason").isNotNull()
    table = judged.select(
        "file", "reason", F.when(bad, F.col("n_fields")).alias("n_fields"), F.when(bad, F.col("line")).alias("line"),
        *[F.when(~bad, F.col(f"row.{f.name}")).alias(f.name) for f in kept], bad.alias("rejected"))
    if folder is None:
        folder = f"{run_folder(spark)}/accounts-{uuid.uuid4().hex}"
    table.write.partitionBy("rejected").mode("overwrite").parquet(folder)
    remove_at_exit(spark, folder)
    back = spark.read.schema(table.schema).parquet(folder)
    accounts = back.where(~F.col("rejected")).select(*[
        F.col("account_id").try_cast("bigint").alias("account_id") if f.name == "account_id"
        else F.try_to_timestamp(F.col("enabled_date"), F.lit(S.ACCOUNTS_CSV_TS_FORMAT)).alias("enabled_date")
        if f.name == "enabled_date" else F.col(f.name) for f in kept])
    return accounts, back.where("rejected").select("file", "reason", "n_fields", "line")


def ingest_report(accounts: DataFrame, rejected: DataFrame) -> DataFrame:
    """(reason, n_rows): the rejected lines by reason, and the accounts that
    are kept with a NULL date or id."""
    remarks = F.explode(F.filter(F.array(F.when(F.col("enabled_date").isNull(), F.lit(NO_DATE)),
                                         F.when(F.col("account_id").isNull(), F.lit(NO_ID))), lambda r: r.isNotNull()))
    return (rejected.select("reason").unionByName(accounts.select(remarks.alias("reason")))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")))


def related_accounts(accounts: DataFrame) -> DataFrame:
    """(account_id, related_account_id) pairs from the '; ' separated list."""
    return (accounts.where(F.col("related_account").isNotNull())
            .select("account_id",
                    F.explode(F.split(F.col("related_account"), r";\s*")).alias("related"))
            .select("account_id", F.trim("related").try_cast("bigint").alias("related_account_id")))

"""Input schemas, amount types and the fixed status vocabulary."""

from __future__ import annotations

from pyspark.sql import types as T

# Amount handling -----------------------------------------------------------
# Payments arrive as DECIMAL(18,4).  Shares produced by even allocation are
# exact quotients rounded half-up to SHARE_SCALE places and carried as
# DECIMAL(28, SHARE_SCALE) so that every later sum is exact; reports cast to
# DOUBLE at the very end.
AMOUNT_IN = T.DecimalType(18, 4)
SHARE_SCALE = 10
SHARE = T.DecimalType(28, SHARE_SCALE)
AMOUNT_COLS = ("txn_volume", "txn_count", "revenues", "net_commission")

# Column sets shared by the stages ------------------------------------------
PAYMENT_COLS = (
    "month", "account_name", "merchant", "agent", "cur",
    "txn_volume", "txn_count", "revenues", "net_commission", "source_file",
)
# what the master list carries of a payment row (month is not carried)
FACT_COLS = (
    "reportdate", "storeid", "agent", "merchant", "cur", "account_name",
    "txn_volume", "txn_count", "revenues", "net_commission", "source_file",
)
MAPPING_COLS = (
    "reportdate", "storeid", "agent", "merchant", "cur", "account_name",
    "txn_volume", "txn_count", "revenues", "net_commission",
    "map", "roster_studioid", "roster_locationid",
)

PAYMENTS = T.StructType([
    T.StructField("month", T.StringType(), False),          # yyyyMM
    T.StructField("account_name", T.StringType(), True),
    T.StructField("merchant", T.StringType(), True),
    T.StructField("agent", T.StringType(), True),
    T.StructField("cur", T.StringType(), True),
    T.StructField("txn_volume", AMOUNT_IN, True),
    T.StructField("txn_count", T.LongType(), True),
    T.StructField("revenues", AMOUNT_IN, True),
    T.StructField("net_commission", AMOUNT_IN, True),
    T.StructField("source_file", T.StringType(), True),
])

ACCOUNTS = T.StructType([
    T.StructField("account_name", T.StringType(), True),
    T.StructField("account_id", T.LongType(), True),
    T.StructField("enabled_date", T.TimestampType(), True),
    T.StructField("store_id", T.StringType(), True),
    T.StructField("currency", T.StringType(), True),
    T.StructField("sales_region", T.StringType(), True),
    T.StructField("service_user_number", T.StringType(), True),
    T.StructField("processing_type", T.StringType(), True),
    T.StructField("related_account", T.StringType(), True),
])

# The account file is positional: 11 text columns.  Columns 5 and 6 hold a
# credential and a personal name; they are declared only so that the
# positions line up and are never selected (the CSV parser prunes them).
ACCOUNTS_CSV = T.StructType([
    T.StructField("account_name", T.StringType(), True),
    T.StructField("account_id", T.StringType(), True),
    T.StructField("enabled_date", T.StringType(), True),
    T.StructField("store_id", T.StringType(), True),
    T.StructField("_unread_5", T.StringType(), True),
    T.StructField("_unread_6", T.StringType(), True),
    T.StructField("currency", T.StringType(), True),
    T.StructField("sales_region", T.StringType(), True),
    T.StructField("service_user_number", T.StringType(), True),
    T.StructField("processing_type", T.StringType(), True),
    T.StructField("related_account", T.StringType(), True),
])
ACCOUNTS_CSV_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.S"

LOCATIONS = T.StructType([
    T.StructField("studioid", T.IntegerType(), True),
    T.StructField("locationid", T.IntegerType(), True),
    T.StructField("account_number", T.StringType(), True),
    T.StructField("mid", T.StringType(), True),
    T.StructField("location_name", T.StringType(), True),
])

ROSTER = T.StructType([
    T.StructField("client_id", T.LongType(), True),
    T.StructField("as_of", T.DateType(), True),             # month start
    T.StructField("studioid", T.IntegerType(), True),
    T.StructField("locationid", T.IntegerType(), True),
    T.StructField("old_client_id", T.IntegerType(), True),
    T.StructField("roster_mid", T.StringType(), True),
])


# Fixed values ---------------------------------------------------------------
# The status codes, the head-office location id and the catch-all sentinel
# must equal the original pipeline's.  Stages carry the code alone.
HEAD_OFFICE_LOCATION = 98
CATCH_ALL_ID = 123456789
DEFAULT_REPORT_DATE = "2019-06-01"


class Status:
    SINGLE_LOCATION = 3
    NO_LOCATION = 4
    MULTI_LOCATION = 5
    CUSTOMER_MATCH = 6
    SINGLE_MATCHED = 7
    PARENT_STUDIO = 8
    SHARED_PARENT = 9
    DISTRIBUTED = 10
    EXCLUSIVE_PARENT = 12
    CATCH_ALL = 13
    MERGED = 14
    MERCHANT_ID = 15


#: What a reader of a report sees beside a code.
STATUS_TEXT = {
    Status.SINGLE_LOCATION: "store found at one location",
    Status.NO_LOCATION: "store found nowhere",
    Status.MULTI_LOCATION: "store found more than once",
    Status.CUSTOMER_MATCH: "location is in the roster",
    Status.SINGLE_MATCHED: "paid to the location itself",
    Status.PARENT_STUDIO: "only the studio is in the roster",
    Status.SHARED_PARENT: "share at a location other merchants use too",
    Status.DISTRIBUTED: "amount shared out over the studio",
    Status.EXCLUSIVE_PARENT: "share at a location of one merchant",
    Status.CATCH_ALL: "no customer known",
    Status.MERGED: "several rows of one target, added up",
    Status.MERCHANT_ID: "merchant id is in the roster",
}

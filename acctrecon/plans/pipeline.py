"""The whole reconciliation as one object of lazily built stages.

Each attribute is a DataFrame; nothing runs until an action, except the
lineage cuts when ``cut=True`` and a checkpoint folder is configured.  The
cuts are the stages read by three or more later readers: the master list
(S7), the exact and parent-studio cascade levels (S8, S9, each also a NOT IN
set twice), the union of mappings (S15) and its repeated keys.  Without them each reader would
carry its own copy of the upstream plan.  The pairs of the merchant-id level
(S10), which a merchant that is hot on both sides makes as many as the square
of the rows, are written nowhere: S15-S18 take its two sides, and pairs are
formed for a result alone.  Any stage can be taken alone:

    rec = Reconciliation(payments, accounts, locations, roster, "2019-06-01")
    rec.final_list.write.parquet(...)
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctrecon.operators import allocate, attach, cascade, classify, combine, locations, reports
from acctrecon.operators import roster as roster_ops
from acctrecon.operators.pairs import Pairs, Parts
from acctrecon.plans.cut import folder_bytes, materialize, remove_at_exit, remove_folder, run_folder
from acctrecon.plans.layout import FOLDERS, LAYOUT, copartition, write_stage
from acctrecon.plans.versions import StageTable, Version
from acctrecon.schemas import DEFAULT_REPORT_DATE

#: A master list of at least this many bytes is bucketed by merchant for its
#: readers: it is written once more, and dealt out once instead of per reader.
COPARTITION_BYTES = 1 << 30
#: Bytes of a bucket's file, about.
BUCKET_BYTES = 64 << 20


class Reconciliation:
    def __init__(self, payments: DataFrame, accounts: DataFrame, locations: DataFrame,
                 roster: DataFrame, report_date: str = DEFAULT_REPORT_DATE, *,
                 strict_merchant_ids: bool = False, cut: bool = True,
                 copartition_bytes: int = COPARTITION_BYTES, bucket_bytes: int = BUCKET_BYTES):
        self.payments = payments
        self.accounts = accounts
        self.locations = locations
        self.roster = roster
        self.report_date = report_date
        self.strict_merchant_ids = strict_merchant_ids
        self.cut = cut
        self.copartition_bytes, self.bucket_bytes = copartition_bytes, bucket_bytes
        self._tables: list[str] = []
        # without cuts the later stages' plans grow out of hand, so a missing
        # folder is an error; ``cut=False`` is for single early stages
        self._folder = run_folder(payments.sparkSession) if cut else None

    def _cut(self, df: DataFrame, name: str) -> DataFrame:
        if self._folder is None:
            return df
        return materialize(df, name, self._folder)

    def close(self) -> None:
        """Remove this run's cut files.  Call it once every result read
        from this object has been written or collected."""
        spark = self.payments.sparkSession
        while self._tables:
            spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop()}")
        if self._folder is not None:
            remove_folder(spark, self._folder)

    def __enter__(self) -> "Reconciliation":
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    # S1-S7: payments to locations ------------------------------------------
    @cached_property
    def facts(self) -> DataFrame:
        return attach.attach_by_name(self.payments, self.accounts)

    @cached_property
    def facts_by_month(self) -> DataFrame:
        """S1 as a table with a folder for each month."""
        if self._folder is None:
            return self.facts
        spark, path = self.payments.sparkSession, f"{self._folder}/facts"
        write_stage(self.facts, path, partition_by=FOLDERS["facts"])
        remove_at_exit(spark, self._folder)
        # a month is text, though the folder's name reads like a number
        return spark.read.schema(self.facts.schema).parquet(path).select(*self.facts.columns)

    @cached_property
    def report_month(self) -> DataFrame:
        return attach.report_month(self.facts_by_month, self.report_date)

    @cached_property
    def active_locations(self) -> DataFrame:
        return locations.active_locations(self.locations)

    @cached_property
    def fact_rows(self) -> DataFrame:
        return classify.fact_rows(self.facts)

    @cached_property
    def store_stats(self) -> DataFrame:
        return classify.store_stats(self.fact_rows, self.active_locations)

    @cached_property
    def single_location(self) -> DataFrame:
        return classify.single_location(self.store_stats, self.active_locations, self.report_date)

    @cached_property
    def unmatched_store(self) -> DataFrame:
        return classify.unmatched_store(self.facts, self.store_stats, self.active_locations, self.report_date)

    @cached_property
    def multi_location(self) -> DataFrame:
        return classify.multi_location(self.facts, self.store_stats, self.active_locations,
                                       self.report_date)

    @cached_property
    def match_status(self) -> DataFrame:
        return classify.match_status(self.facts, self.store_stats, self.report_date)

    def _build_master_list(self) -> DataFrame:
        smap = classify.store_map(self.store_stats, self.active_locations)
        return classify.master_list(self.fact_rows, smap, self.report_date)

    @cached_property
    def master_list(self) -> DataFrame:
        return self._cut(self._build_master_list(), "master_list")

    @cached_property
    def master_parts(self) -> list[DataFrame]:
        """The master list as its readers by merchant take it: whole, or once
        it is large, bucketed by merchant with hot merchants apart."""
        master = self.master_list
        if self._folder is None:
            return [master]
        spark = self.payments.sparkSession
        size = folder_bytes(spark, f"{self._folder}/master_list")
        if size < self.copartition_bytes:
            return [master]
        buckets = max(2, -(-size // self.bucket_bytes))
        table = f"acctrecon_master_{self._folder.rsplit('/', 1)[-1]}"
        self._tables.append(table)
        # a key of more rows than a bucket's share is hot
        return copartition(master, "merchant", table=table, path=f"{self._folder}/master_parts", buckets=buckets,
                           most=max(1, master.count() // buckets))

    # S8-S11: the customer cascade ----------------------------------------------
    @cached_property
    def roster_backfilled(self) -> DataFrame:
        return roster_ops.backfill_prior_period(self.roster)

    @cached_property
    def roster_merchant_ids(self) -> DataFrame:
        return roster_ops.roster_merchant_ids(self.roster, strict=self.strict_merchant_ids)

    @cached_property
    def parent_locations(self) -> DataFrame:
        return cascade.parent_locations(self.roster, self.roster_backfilled)

    @cached_property
    def cascade(self) -> cascade.Cascade:
        levels = cascade.customer_levels(self.roster, self.roster_backfilled, self.parent_locations,
                                         self.roster_merchant_ids, cut=self._cut)
        return cascade.match_cascade(self.master_parts, levels, cut=self._cut)

    @cached_property
    def exact_roster_match(self) -> DataFrame:
        return self.cascade["exact_roster_match"]

    @cached_property
    def parent_studio_match(self) -> DataFrame:
        return self.cascade["parent_studio_match"]

    @cached_property
    def merchant_id_match(self) -> DataFrame:
        return self.cascade["merchant_id_match"]

    @cached_property
    def catch_all(self) -> DataFrame:
        return self.cascade["catch_all"]

    # S12-S14: allocation -------------------------------------------------------
    @cached_property
    def even_distribution(self) -> DataFrame:
        return allocate.allocate_evenly(self.parent_studio_match)

    @cached_property
    def settled_targets(self) -> DataFrame:
        return allocate.settle_targets(self.even_distribution, of=self.parent_studio_match)

    @cached_property
    def exclusive_location(self) -> DataFrame:
        return allocate.exclusive_location(self.settled_targets)

    @cached_property
    def shared_location(self) -> DataFrame:
        return allocate.shared_location(self.settled_targets)

    # S15-S18: combine ----------------------------------------------------------
    @cached_property
    def merchant_id_pairs(self) -> Pairs:
        return self.cascade.pairs("merchant_id_match")

    def _build_mapping_parts(self) -> Parts:
        return combine.mapping_parts(self.exact_roster_match, self.catch_all,
                                     self.merchant_id_pairs, self.settled_targets)

    @cached_property
    def mapping_parts(self) -> Parts:
        """S15 with its pairs not formed; its other rows are cut."""
        parts = self._build_mapping_parts()
        return Parts(self._cut(parts.plain, "all_mappings"), parts.pairs)

    @cached_property
    def all_mappings(self) -> DataFrame:
        return self.mapping_parts.rows()

    def _parts(self, name: str) -> Parts | None:
        """Stage ``name`` as a final result, if it holds pairs."""
        if name == "merchant_id_match":
            return Parts(None, (self.merchant_id_pairs,))
        if name == "all_mappings":
            return self._build_mapping_parts()
        return {"multi_mapped": lambda: self.multi_mapped_parts, "merged_mappings": lambda: self.merged_parts,
                "final_list": lambda: self.final_parts}.get(name, lambda: None)()

    def report(self, name: str) -> DataFrame:
        """``result(name)`` with amounts as ``as_report`` has them.  Those of
        pairs are changed before the pairs are formed, once for each payment."""
        parts = self._parts(name)
        return as_report(self.result(name)) if parts is None else parts.rows(as_report)

    def result(self, name: str) -> DataFrame:
        """Stage ``name`` as a final result: everything it reads is cut as
        usual, but a cut stage is not written only to be read straight back
        when nothing downstream will reuse it."""
        if name in ("exact_roster_match", "parent_studio_match"):
            return self.cascade.build(name)
        if name == "all_mappings":
            return self._build_mapping_parts().rows()
        build = getattr(self, f"_build_{name}", None)
        return build() if build is not None else getattr(self, name)

    def write(self, name: str, root: str, *, cluster: bool = False, files: int | None = None) -> Version:
        """Rebuild stage ``name`` as the table at ``root`` (``StageTable``),
        distributed and sorted as ``layout.LAYOUT`` says (stages it does not
        list: as they come).  Readers see the old version until the new one
        is complete, and keep it if the rebuild fails.  With ``cluster`` its
        files hold ranges of the sort columns."""
        distribute_by, sort_by = LAYOUT.get(name, ((), ()))
        table = StageTable(self.payments.sparkSession, root)
        return table.rebuild(self.result(name), distribute_by=distribute_by, sort_by=sort_by,
                             partition_by=FOLDERS.get(name, ()), cluster=cluster, files=files)

    @cached_property
    def multi_keys(self) -> DataFrame:
        return self._cut(combine.multi_keys(self.mapping_parts), "multi_keys")

    @cached_property
    def multi_mapped_parts(self) -> Parts:
        return combine.multi_mapped_parts(self.mapping_parts, self.multi_keys)

    @cached_property
    def multi_mapped(self) -> DataFrame:
        return self.multi_mapped_parts.rows()

    @cached_property
    def merged_parts(self) -> Parts:
        return combine.merged_parts(self.mapping_parts, self.multi_keys, cut=self._cut)

    @cached_property
    def merged_mappings(self) -> DataFrame:
        return self.merged_parts.rows()

    @cached_property
    def final_parts(self) -> Parts:
        return combine.final_parts(self.mapping_parts, self.multi_keys, self.merged_parts, cut=self._cut)

    @cached_property
    def final_list(self) -> DataFrame:
        return self.final_parts.rows()

    # reports -------------------------------------------------------------------
    @cached_property
    def unmatched_report(self) -> DataFrame:
        return reports.unmatched_report(self.all_mappings, self.master_parts)

    @cached_property
    def unmatched_by_reason(self) -> DataFrame:
        return reports.unmatched_by_reason(self.all_mappings, self.master_parts)

    @cached_property
    def accounts_in_locations(self) -> DataFrame:
        return reports.accounts_in_locations(self.accounts, self.locations)


def as_report(df: DataFrame) -> DataFrame:
    """Decimal amounts become DOUBLE for presentation (exact sums first)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])

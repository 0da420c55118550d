"""The whole layered build over the fixture batches, table by table.

``Warehouse(spark, sf_dir)`` exposes every layer as a lazily built, memoised
DataFrame: staging -> ODS history -> dimensions -> facts -> daily pivot ->
reports. The dimensions are materialised (reliable checkpoint) because each feeds
many later steps; the ODS snapshots lie in stored tables already (rows and flags,
see ``operators.history``) and are not written again. Everything else stays a
lazy plan for Catalyst to optimise end to end.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import specs
from ..operators import gate, history
from ..operators.spine import date_spine, plan_by_day
from ..session import materialize
from ..sources import fixtures as fx
from . import dims as D
from . import facts, reports


def batch_clock(batch_col: str = "batch"):
    """effective_from of each request row from its batch number."""
    expr = None
    for n, ts in sorted(fx.BATCH_TS.items()):
        expr = (F.when(F.col(batch_col) == n, F.lit(ts)) if expr is None
                else expr.when(F.col(batch_col) == n, F.lit(ts)))
    return F.to_timestamp_ntz(expr)


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, start=fx.SPINE_START, as_of=fx.AS_OF,
                 window=fx.WINDOW, checkpoint: bool = True):
        self.spark, self.sf_dir = spark, sf_dir
        self.start, self.as_of, self.window = start, as_of, window
        self._checkpoint = checkpoint

    def _keep(self, df: DataFrame) -> DataFrame:
        return materialize(df) if self._checkpoint else df

    # --- staging ---------------------------------------------------------
    @cached_property
    def stg_case(self) -> DataFrame:
        return fx.stg_case(self.spark, self.sf_dir, 1)

    @cached_property
    def stg_case_edited(self) -> DataFrame:
        return fx.stg_case(self.spark, self.sf_dir, 2)

    @cached_property
    def stg_request(self) -> DataFrame:
        return fx.stg_request(self.spark, self.sf_dir)

    @cached_property
    def stg_address(self) -> DataFrame:
        return fx.stg_address(self.spark, self.sf_dir, 1)

    @cached_property
    def stg_rso_plan(self) -> DataFrame:
        return fx.stg_rso_plan(self.spark, self.sf_dir)

    @cached_property
    def stg_currency(self) -> DataFrame:
        """The reference list: taken from HTML pages, saved as a staging table, read back."""
        from ..sources.html_tables import extract_tables, reference_list
        from ..sources.store import load_layer, scratch_dir
        base = scratch_dir(self.spark, "layer")
        codes = reference_list(extract_tables(fx.nation_pages(self.spark, self.sf_dir)))
        load_layer(codes, "currency", base)
        return self.spark.read.parquet(f"{base}/stg_currency")

    # --- ODS -------------------------------------------------------------
    def ods_case_batches(self, n: int = 3) -> DataFrame:
        """Cases loaded batch by batch: base export, edited export, base again."""
        ods = history.empty_ods(self.spark, specs.CASE)
        batches = [self.stg_case, self.stg_case_edited, self.stg_case][:n]
        for i, stg in enumerate(batches, start=1):
            # each load leaves a stored snapshot, from which the next one starts
            ods = self._keep(history.load_history(ods, stg, specs.CASE, fx.BATCH_TS[i]))
        return ods

    @cached_property
    def ods_case(self) -> DataFrame:
        # same result as ods_case_batches(3) (tests check it): dedupe and flag
        # depend only on the union of the stamped batches, so one pass suffices
        stamped = None
        for i, stg in enumerate([self.stg_case, self.stg_case_edited, self.stg_case], start=1):
            part = history.stamp(gate.valid_rows(stg, specs.CASE.required), specs.CASE,
                                 fx.BATCH_TS[i])
            stamped = part if stamped is None else stamped.unionByName(part)
        return history.merge_stored(history.empty_ods(self.spark, specs.CASE), stamped, specs.CASE)

    @cached_property
    def ods_request(self) -> DataFrame:
        # the three request batches merge in one pass: each row carries its
        # batch clock, and version dedupe / current flag are order-free
        valid = gate.valid_rows(self.stg_request, specs.REQUEST.required)
        stamped = history.stamp(valid, specs.REQUEST, batch_clock())
        return history.merge_stored(history.empty_ods(self.spark, specs.REQUEST), stamped, specs.REQUEST)

    @cached_property
    def ods_address(self) -> DataFrame:
        return history.load_history(history.empty_ods(self.spark, specs.ADDRESS), self.stg_address,
                                    specs.ADDRESS, fx.BATCH_TS[1])

    @property
    def ods(self) -> dict[str, DataFrame]:
        return {"case": self.ods_case, "request": self.ods_request, "address": self.ods_address}

    # --- dimensions -------------------------------------------------------
    @cached_property
    def values(self) -> D.ColumnValues:
        return D.ColumnValues(self.ods, keep=self._keep)

    @cached_property
    def enums(self) -> DataFrame:
        """All enumeration dimensions, built together (dim, id, value)."""
        return self._keep(D.enum_dims(self.values))

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        return _LazyDims(self)

    # dependency stages of the dimension build; members of a stage are independent
    DIM_STAGES = (
        ("spr_client", "_values_case", "_values_request", "_values_address"),
        ("_enums", "spr_agent", "spr_currency", "spr_country"),
        ("spr_city", "spr_customer"),
        ("spr_phone", "spr_email"),
    )

    def build_dims(self, threads: int = 4) -> dict[str, DataFrame]:
        """Build every dimension, submitting independent ones concurrently.

        Each dimension is a handful of small jobs; run one after another they
        leave most executors idle. Spark schedules jobs from several driver
        threads side by side, so each stage of independent dimensions runs at
        once (the ODS snapshots are built first).
        """
        from concurrent.futures import ThreadPoolExecutor
        self.ods_request, self.ods_case, self.ods_address      # noqa: B018
        # memoised holders are created here, before any thread can race on them
        self.values, self.dims                                  # noqa: B018

        def one(name):
            if name.startswith("_values_"):
                self.values.table(name[len("_values_"):])
            elif name == "_enums":
                self.enums                                      # noqa: B018
            else:
                self.dims[name]                                 # noqa: B018

        from pyspark import inheritable_thread_target
        # the caller's job group / local properties follow the jobs into the threads
        task = inheritable_thread_target(self.spark)(one)
        with ThreadPoolExecutor(max_workers=threads) as pool:
            for stage in self.DIM_STAGES:
                list(pool.map(task, stage))
        for name in D.ENUMS:
            self.dims[name]                                     # noqa: B018
        return self.dims

    # --- facts ------------------------------------------------------------
    @cached_property
    def fct_request_loaded(self) -> DataFrame:
        return facts.build_request_fact(self.ods_request, self.dims)

    @cached_property
    def fct_request_blanked(self) -> DataFrame:
        # a lazy plan, for what reads the fact once
        return facts.blank_rso(self.fct_request_loaded, self.dims["spr_request_type"])

    @cached_property
    def fct_request(self) -> DataFrame:
        # stored: for what reads it more than once
        return self._keep(self.fct_request_blanked)

    def _fact_read_once(self) -> DataFrame:
        """The request fact: the stored one if there is one, else its plan, of which only the columns read are made."""
        return self.__dict__.get("fct_request", self.fct_request_blanked)

    @cached_property
    def fct_case(self) -> DataFrame:
        return facts.build_case_fact(self.ods_case, self._fact_read_once(), self.dims)

    # second load of the facts: a late batch onto the stored ones
    @cached_property
    def ods_request_late(self) -> DataFrame:
        return self._keep(history.load_history(
            self.ods_request, fx.stg_request_late(self.spark, self.sf_dir), specs.REQUEST, fx.BATCH_TS[4],
            touched_only=True))

    @cached_property
    def ods_case_late(self) -> DataFrame:
        return self._keep(history.load_history(
            self.ods_case, fx.stg_case_late(self.spark, self.sf_dir), specs.CASE, fx.BATCH_TS[4],
            touched_only=True))

    @cached_property
    def dims_second(self) -> dict[str, DataFrame]:
        """The dimensions after the late batches: old members keep their ids, new ones get the next."""
        ods = {**self.ods, "case": self.ods_case_late, "request": self.ods_request_late}
        values, first = D.ColumnValues(ods, keep=self._keep), self.dims
        enums = self._keep(D.enum_dims(values, self.enums))
        out = {n: D.split_enum(enums, n) for n in D.ENUMS}
        out["spr_client"] = self._keep(D.client_dim(ods["case"], first["spr_client"]))
        out["spr_agent"] = self._keep(D.agent_dim(values, first["spr_agent"]))
        out["spr_customer"] = self._keep(D.customer_dim(ods["address"], out["spr_client"], out["spr_customer_type"],
                                                        out["spr_agent"], first["spr_customer"]))
        out["spr_currency"] = self._keep(D.currency_dim(self.stg_currency, values, first["spr_currency"]))
        out["spr_country"] = self._keep(D.country_dim(values, first["spr_country"]))
        out["spr_city"] = self._keep(D.city_dim(values, out["spr_country"], first["spr_city"]))
        return out

    @cached_property
    def fct_request_second(self) -> DataFrame:
        # loaded onto the facts before their blanking, so that it covers old rows too. A lazy plan, as what it
        # is loaded onto: of either only the keys, the rows that stay and the columns read are made
        loaded = facts.build_request_fact(self.ods_request_late, self.dims_second, self.fct_request_loaded)
        return facts.blank_rso(loaded, self.dims_second["spr_request_type"])

    @cached_property
    def fct_case_second(self) -> DataFrame:
        return facts.build_case_fact(self.ods_case_late, self.fct_request_second, self.dims_second,
                                     self._keep(self.fct_case))

    # --- reports ----------------------------------------------------------
    @cached_property
    def _fact_feed(self) -> DataFrame:
        """The columns of the request fact that the pivot is kept up from, stored: they are read twice."""
        from . import incremental
        return self._keep(self._fact_read_once().select(*incremental.FEED))

    @cached_property
    def pivot_state(self):
        from . import incremental
        return incremental.build(self._fact_feed, self.dims["spr_client"], self.dims["spr_act"], self.stg_rso_plan,
                                 self.start, self.as_of)

    @cached_property
    def pivot_state_second(self):
        """The pivot after the second load, kept up from the fact's changes."""
        from . import incremental
        feed = self._keep(incremental.row_changes(self._fact_feed, self.fct_request_second, "request_number",
                                                  incremental.FEED))
        return incremental.apply(self.pivot_state, feed, self.dims_second["spr_client"],
                                 self.dims_second["spr_act"], self.stg_rso_plan)

    @cached_property
    def spine(self) -> DataFrame:
        return date_spine(self.spark, self.start, self.as_of)

    @cached_property
    def plan_days(self) -> DataFrame:
        return plan_by_day(self.stg_rso_plan, self.start, self.as_of)

    @cached_property
    def metrics(self) -> DataFrame:
        # stored (one row per client and day): the pivot reads it on both sides
        # of its join with the monthly totals, and the fact is scanned once
        return self._keep(reports.daily_metrics(self._fact_read_once(), self.dims["spr_client"],
                                                self.dims["spr_act"], self.start, self.as_of))

    @cached_property
    def pivot(self) -> DataFrame:
        return reports.daily_pivot(self.metrics, self.stg_rso_plan)

    def client_summary(self) -> DataFrame:
        return reports.client_summary(self.pivot, self.window, self.as_of)

    def daily_stats(self) -> DataFrame:
        return reports.daily_stats(self.pivot, self.window)

    def plan_fact(self) -> DataFrame:
        return reports.plan_fact(self.pivot, self.dims["spr_client"], self.window, self.as_of)


class _LazyDims(dict):
    """Dimension tables built on first access, in dependency order."""

    def __init__(self, wh: Warehouse):
        super().__init__()
        self._wh = wh

    def __missing__(self, name: str) -> DataFrame:
        wh = self._wh
        if name in D.ENUMS:
            df = self[name] = D.split_enum(wh.enums, name)
            return df
        elif name == "spr_client":
            df = D.client_dim(wh.ods_case)
        elif name == "spr_agent":
            df = D.agent_dim(wh.values)
        elif name == "spr_customer":
            df = D.customer_dim(wh.ods_address, self["spr_client"], self["spr_customer_type"],
                                self["spr_agent"])
        elif name == "spr_phone":
            df = D.phone_dim(wh.ods_address, self["spr_customer"], self["spr_client"])
        elif name == "spr_email":
            df = D.email_dim(wh.ods_address, self["spr_customer"], self["spr_client"])
        elif name == "spr_currency":
            df = D.currency_dim(wh.stg_currency, wh.values)
        elif name == "spr_country":
            df = D.country_dim(wh.values)
        elif name == "spr_city":
            df = D.city_dim(wh.values, self["spr_country"])
        else:
            raise KeyError(name)
        df = wh._keep(df)
        self[name] = df
        return df

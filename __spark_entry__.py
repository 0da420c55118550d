"""

Every query reads the driver tables of ``sf_dir`` (through the staging
fixtures derived from ``orders``, ``lineitem`` and ``customer``) and runs the
library operators over the whole tables; the oracle twin is the same build
written as plain SQL (``oracle_sql.py``).
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from tierwell import specs  # noqa: E402
from tierwell.operators import gate  # noqa: E402
from tierwell.operators.frames import previous_group_first  # noqa: E402
from tierwell.plans import dims as D  # noqa: E402
from tierwell.plans import facts as FA  # noqa: E402
from tierwell.plans.warehouse import Warehouse  # noqa: E402
from tierwell.sources import fixtures as fx  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"


def _present(name: str) -> bool:
    """Whether a module's own file is there (a left-over cache folder is not)."""
    spec = importlib.util.find_spec(name)
    return spec is not None and spec.origin is not None


# the corpus operators and their pipeline are optional: without them the rest works
_LLM = _present("tierwell.llm")
_PIPELINE = _LLM and _present("corpus_pipeline")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: daily stats report (R3) built end to end from the sf0.001 tables."""
    return Warehouse(spark, SF_SMOKE).daily_stats()


def _valid(stg, spec):
    return lambda s, d: gate.valid_rows(stg(s, d), spec.required).select(*spec.columns)


def _rejected(stg, spec):
    return lambda s, d: gate.rejected_rows(stg(s, d), spec.required).select(*spec.columns)


def _dim(name):
    return lambda s, d: Warehouse(s, d).dims[name]


def _enums(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = Warehouse(spark, sf_dir)
    out = None
    for name, (value, _) in D.ENUMS.items():
        df = wh.dims[name].select(F.lit(name).alias("dim"), "id", F.col(value).alias("value"))
        out = df if out is None else out.unionByName(df)
    return out


def _prev_group_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    # W3 on the detail rows with the general GROUPS-frame helper
    pivot = Warehouse(spark, sf_dir).pivot.select("client", "month", "total")
    return (previous_group_first(pivot, "client", "month", ["total"], suffix="_prev")
            .select("client", "month", "total", F.col("total_prev").alias("prev_month_total"))
            .distinct())


def _ods_case_sequential(spark, sf_dir):
    return Warehouse(spark, sf_dir).ods_case_batches(3).select(*specs.CASE.ods_columns)


def _ods_request_touched_only(spark, sf_dir):
    from tierwell.operators import history
    from tierwell.plans.warehouse import batch_clock
    from tierwell.session import materialize
    spec = specs.REQUEST
    stg = fx.stg_request(spark, sf_dir)
    valid = gate.valid_rows(stg, spec.required)
    first = materialize(history.merge_stored(
        history.empty_ods(spark, spec),
        history.stamp(valid.filter(F.col("batch") < 3), spec, batch_clock()), spec))
    third = stg.filter(F.col("batch") == 3).drop("batch")
    return history.load_history(first, third, spec, fx.BATCH_TS[3], touched_only=True)


def _ods_address_2(spark, sf_dir):
    from tierwell.operators import history
    wh = Warehouse(spark, sf_dir)
    return history.load_history(wh.ods_address, fx.stg_address(spark, sf_dir, 2), specs.ADDRESS,
                                fx.BATCH_TS[2])


def _upsert_update(spark, sf_dir):
    # agents of the case table first, then every role column: new accounts get
    # the next ids, existing ones keep theirs and have their name refreshed
    from tierwell.session import materialize
    wh = Warehouse(spark, sf_dir)
    case_only = D.ColumnValues({"case": wh.ods_case}, columns={"case": D.AGENT_COLUMNS["case"]})
    first = materialize(D.upsert_accounts(case_only.of("case", *D.AGENT_COLUMNS["case"]), None))
    return D.agent_dim(wh.values, first)


def _upsert_insert_only(spark, sf_dir):
    from tierwell.session import materialize
    wh = Warehouse(spark, sf_dir)
    first = materialize(wh.dims["spr_customer"])
    ods2 = materialize(_ods_address_2(spark, sf_dir))
    agents = D.agent_dim(D.ColumnValues({**wh.ods, "address": ods2}))
    return D.customer_dim(ods2, wh.dims["spr_client"], wh.dims["spr_customer_type"], agents, first)


def _ingest_union(spark, sf_dir):
    from tierwell.sources.ingest import read_files
    from tierwell.sources.store import scratch_dir
    folder = scratch_dir(spark, "ingest")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    head = {"c_custkey": "Customer Key", "c_name": "Customer/Name", "c_nationkey": "Nation Key"}
    west = customer.filter(F.col("c_nationkey") < 12).select(
        *[F.col(c).alias(head[c]) for c in ("c_custkey", "c_name")])
    east = customer.filter(F.col("c_nationkey") >= 12).select(
        *[F.col(c).alias(head[c]) for c in ("c_custkey", "c_name", "c_nationkey")])
    west.write.option("header", "true").csv(f"{folder}/file1")
    east.write.option("header", "true").csv(f"{folder}/file2")
    return read_files(spark, f"{folder}/*/*.csv", "csv").select(
        "customer_key", "customer_name", "nation_key")


def _strip_citations(spark, sf_dir):
    from tierwell.functions.text import strip_citations
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marked = F.concat(F.col("text"), F.lit(" ["), F.col("doc_id").cast("string"), F.lit("]"))
    return docs.select("doc_id", strip_citations(marked).alias("text"))


def _html_tables(spark, sf_dir):
    from tierwell.sources.html_tables import extract_tables
    t = extract_tables(fx.customer_pages(spark, sf_dir))
    return t.select("page_id", "table_no", "row_no", "is_header",
                    F.array_join("cells", "|").alias("cells"))


def _reference_list(spark, sf_dir):
    from tierwell.sources.html_tables import extract_tables, reference_list
    return reference_list(extract_tables(fx.customer_pages(spark, sf_dir)))


def _rejects_two_batches(spark, sf_dir):
    # the second batch is stored twice, as a rerun would: its rows are replaced
    from tierwell.sources.store import read_batches, scratch_dir, write_batch
    base, C = scratch_dir(spark, "rejects"), specs.CASE
    for batch, number in (("a/b", 1), ("a:b", 2), ("a:b", 2), ("007", 2)):
        write_batch(gate.rejected_rows(fx.stg_case(spark, sf_dir, number), C.required).select(*C.columns),
                    base, "rejected_stg_case", batch)
    return read_batches(spark, base, "rejected_stg_case").select(*C.columns, "batch")


def _bucketed(spec, batches):
    # load after load onto the stored, bucketed history
    def run(spark, sf_dir):
        from tierwell.operators.bucketed_history import BucketedHistory
        from tierwell.sources.store import scratch_dir
        held = BucketedHistory(spark, scratch_dir(spark, "ranges"), spec, ranges=4)
        for staging, as_of in batches(spark, sf_dir):
            out = held.load(staging, as_of)
        return out
    return run


def _request_batches(spark, sf_dir):
    from tierwell.plans.warehouse import batch_clock
    stg = fx.stg_request(spark, sf_dir)
    return [(stg.filter(F.col("batch") < 3), batch_clock()),
            (stg.filter(F.col("batch") == 3), fx.BATCH_TS[3]), (fx.stg_request_late(spark, sf_dir), fx.BATCH_TS[4])]


def _case_batches(spark, sf_dir):
    return [(fx.stg_case(spark, sf_dir, n), fx.BATCH_TS[n]) for n in (1, 2, 3)] + [
        (fx.stg_case_late(spark, sf_dir), fx.BATCH_TS[4])]


def _plan_on_spine(spark, sf_dir):
    from tierwell.plans.reports import plan_on_spine
    wh = Warehouse(spark, sf_dir)
    return plan_on_spine(wh.spine, wh.stg_rso_plan)


def _orders_in_plan_periods(spark, sf_dir):
    from tierwell.operators.intervals import interval_join
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderdate").cast("date").alias("day"))
    pairs = interval_join(orders, F.unix_date("day"), fx.stg_rso_plan(spark, sf_dir),
                          F.unix_date("effective_from"), F.unix_date("effective_to"))
    return pairs.groupBy("client", "target").agg(F.count(F.lit(1)).alias("n_orders"), F.min("day").alias("first_day"))


def _groups_frame(preceding, following, first):
    def run(spark, sf_dir):
        from tierwell.operators.frames import groups_frame
        # one partition holds a third of all rows; many orders share a day
        part = F.when(F.col("o_orderkey") % 3 == 0, "hot").otherwise(F.col("o_orderpriority"))
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
            "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"), part.alias("p"))
        outs = {"s": ("sum", "o_custkey"), "n": ("count", "o_orderkey"), "last_key": ("last", "o_orderkey", ["o_orderkey"])}
        if first:
            outs["first_key"] = ("first", "o_orderkey", ["o_orderkey"])
        return groups_frame(orders, "p", "day", outs, preceding, following, block=500).drop("o_custkey")
    return run


def _date_spine(spark, sf_dir):
    from tierwell.operators.spine import spine_of
    return spine_of(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderdate")


def _pivot_view(spark, sf_dir):
    from tierwell.plans.reports import register_pivot_view
    name = register_pivot_view(Warehouse(spark, sf_dir).pivot)
    return spark.sql(f"select client, count(*) as n_days, sum(total) as totals from {name} group by client")


def _ingest_xlsx(spark, sf_dir):
    from tierwell.sources.ingest import read_files
    from tierwell.sources.store import scratch_dir
    books = fx.nation_workbooks(spark, sf_dir, scratch_dir(spark, "xlsx"))
    return read_files(spark, books, "xlsx", usecols="A:D", sheet="Nations").select(
        "nation_key", "nation_name", "is_even", "region_key")


def _reference_list_saved(spark, sf_dir):
    from tierwell.sources.html_tables import extract_tables, reference_list
    from tierwell.sources.store import load_layer, scratch_dir
    return load_layer(reference_list(extract_tables(fx.customer_pages(spark, sf_dir))), "currency",
                      scratch_dir(spark, "layer"))


def _table_copy_other_store(spark, sf_dir):
    from tierwell.sources.copy import copy_tables
    from tierwell.sources.store import scratch_dir
    return copy_tables(spark, ["customer", "orders"], sf_dir, scratch_dir(spark, "copy"), dst_fmt="csv",
                       dst_options={"header": "true", "sep": "|"})


COPY_TABLES = ["region", "nation", "customer", "orders", "lineitem"]


def _table_copy_counts(spark, sf_dir):
    from tierwell.sources.copy import copy_tables
    from tierwell.sources.store import scratch_dir
    return copy_tables(spark, COPY_TABLES, sf_dir, scratch_dir(spark, "copy"))


def _table_copy_content(spark, sf_dir):
    from tierwell.sources.copy import copy_tables_checked
    from tierwell.sources.store import scratch_dir
    base = scratch_dir(spark, "copy")
    same = copy_tables_checked(spark, COPY_TABLES, sf_dir, f"{base}/parquet")
    other = copy_tables_checked(spark, ["customer", "orders"], sf_dir, f"{base}/csv", dst_fmt="csv",
                                dst_options={"header": "true", "sep": "|"})
    return same.withColumn("store", F.lit("parquet")).unionByName(other.withColumn("store", F.lit("csv")))


_stg_case = lambda s, d: fx.stg_case(s, d)
_stg_request = lambda s, d: fx.stg_request(s, d)
_stg_address = lambda s, d: fx.stg_address(s, d)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    C, R, A = specs.CASE, specs.REQUEST, specs.ADDRESS
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # Completeness gate and reject split
        "case_valid": _valid(_stg_case, C),
        "case_rejected": _rejected(_stg_case, C),
        "request_valid": _valid(_stg_request, R),
        "request_rejected": _rejected(_stg_request, R),
        "address_valid": _valid(_stg_address, A),
        "address_rejected": _rejected(_stg_address, A),
        "rejects_two_batches": _rejects_two_batches,
        # M1 (W1 W2 M4): versioned history
        "ods_case": lambda s, d: Warehouse(s, d).ods_case.select(*C.ods_columns),
        "ods_request": lambda s, d: Warehouse(s, d).ods_request.select(*R.ods_columns),
        "ods_address": lambda s, d: Warehouse(s, d).ods_address.select(*A.ods_columns),
        "ods_case_sequential": _ods_case_sequential,
        "ods_request_touched_only": _ods_request_touched_only,
        "ods_request_bucketed": _bucketed(R, _request_batches),
        "ods_case_bucketed": _bucketed(C, _case_batches),
        "ods_address_two_batches": lambda s, d: _ods_address_2(s, d).select(*A.ods_columns),
        "upsert_update": _upsert_update,
        "upsert_insert_only_column": _upsert_insert_only,
        # Dimensions (M2 M3 M7)
        "dim_client": _dim("spr_client"),
        "dim_agent": _dim("spr_agent"),
        "dim_enums": _enums,
        "dim_customer": _dim("spr_customer"),
        "dim_phone": _dim("spr_phone"),
        "dim_email": _dim("spr_email"),
        "dim_currency": _dim("spr_currency"),
        "dim_country": _dim("spr_country"),
        "dim_city": _dim("spr_city"),
        # Facts (J4-J8, M6)
        "fact_request": lambda s, d: Warehouse(s, d).fct_request_loaded.select(
            *FA.REQUEST_FACT_COLUMNS),
        "fact_request_rso_blanked": lambda s, d: Warehouse(s, d).fct_request_blanked.select(
            *FA.REQUEST_FACT_COLUMNS),
        "fact_case": lambda s, d: Warehouse(s, d).fct_case.select(*FA.CASE_FACT_COLUMNS),
        "fact_request_second_load": lambda s, d: Warehouse(s, d).fct_request_second.select(
            *FA.REQUEST_FACT_COLUMNS),
        "fact_case_second_load": lambda s, d: Warehouse(s, d).fct_case_second.select(
            *FA.CASE_FACT_COLUMNS),
        # reports
        "date_spine": _date_spine,
        "plan_by_day": lambda s, d: Warehouse(s, d).plan_days,
        "plan_on_spine": _plan_on_spine,
        "orders_in_plan_periods": _orders_in_plan_periods,
        "groups_frame": _groups_frame(2, 1, True),
        "groups_frame_running": _groups_frame(None, 1, False),
        "daily_metrics": lambda s, d: Warehouse(s, d).metrics,
        "prev_group_first": _prev_group_first,
        "daily_pivot": lambda s, d: Warehouse(s, d).pivot,
        "daily_pivot_after_second_load": lambda s, d: Warehouse(s, d).pivot_state_second.pivot,
        "pivot_view": _pivot_view,
        "client_summary": lambda s, d: Warehouse(s, d).client_summary(),
        "daily_stats": lambda s, d: Warehouse(s, d).daily_stats(),
        "plan_fact": lambda s, d: Warehouse(s, d).plan_fact(),
        # Sources and sinks
        "ingest_union": _ingest_union,
        "strip_citations": _strip_citations,
        "html_tables": _html_tables,
        "reference_list": _reference_list,
        "reference_list_saved": _reference_list_saved,
        "ingest_xlsx": _ingest_xlsx,
        "table_copy_counts": _table_copy_counts,
        "table_copy_other_store": _table_copy_other_store,
        "table_copy_content": _table_copy_content,
    }
    if _LLM:
        from tierwell.llm.queries import queries as llm_queries
        q |= llm_queries()
    if _PIPELINE:
        import corpus_pipeline
        q["pipeline"] = corpus_pipeline.run
    return q


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query over the pre-registered driver views."""
    import oracle_sql as oracle
    sql = dict(oracle.queries())
    if _LLM:
        from tierwell.llm.queries import oracle_sql as llm_oracle
        sql |= llm_oracle()
    if _PIPELINE:
        import corpus_pipeline
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql

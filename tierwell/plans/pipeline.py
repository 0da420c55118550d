"""Ordered pipeline run (S14): staging batch -> ODS -> dimensions -> facts.

``run_batch`` performs one load in the order the data dependencies impose
and writes every table as a new snapshot of a :class:`SnapshotStore`:

1. ODS per entity: gate, rejects kept per batch, touched-keys-only history load;
2. dimensions: all enumerations in one plan, then client, agent, customer,
   phone, e-mail, currency, country, city (upserts keep existing ids);
3. facts: request fact upsert, RSO blanking over the whole fact, case fact.

The load is one :class:`Run`: its tables become current together, when its
manifest is committed last, and a run that stopped is taken up where it
stopped if it is started again under the same batch id. The currency list is passed,
or read from the stored ``stg_currency``. Reports are read from the facts and dimensions
of one committed run with :func:`reports_from_store`. Each stored table is
read back from its snapshot, which cuts the lineage between steps (a lost
executor recomputes from the last written table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import specs
from ..operators import gate, history
from ..session import materialize
from ..sources.store import Run, RunView, SnapshotStore, write_batch
from . import dims as D
from . import facts, reports

DIM_ORDER = ["spr_client", "spr_agent", "spr_customer", "spr_phone", "spr_email", "spr_currency",
             "spr_country", "spr_city"]


def run_batch(spark: SparkSession, store: SnapshotStore, batch: dict[str, DataFrame], as_of,
              stg_currency: DataFrame | None = None,
              touched_only: bool = True, batch_id: str | None = None) -> dict[str, DataFrame]:
    run = Run(store, batch_id or str(as_of))
    tables: dict[str, DataFrame] = {}
    # 1. ODS
    for entity, spec in specs.ENTITIES.items():
        current = run.before(f"ods_{entity}")
        stg = batch.get(entity)
        if stg is None:
            tables[f"ods_{entity}"] = current if current is not None else history.empty_ods(spark, spec)
            continue
        stg = stg.select(*spec.columns)
        base = current if current is not None else history.empty_ods(spark, spec)

        def load(stg=stg, spec=spec, entity=entity, base=base, touched=touched_only and current is not None):
            # under the batch's own name (its clock, if it has none): a batch that is run again replaces its rejects
            write_batch(gate.rejected_rows(stg, spec.required), store.base, f"rejected_stg_{entity}", run.run_id)
            return history.load_history(base, stg, spec, as_of, touched_only=touched)
        tables[f"ods_{entity}"] = run.write(f"ods_{entity}", load)
    ods = {e: tables[f"ods_{e}"] for e in specs.ENTITIES}

    # 2. dimensions
    values = D.ColumnValues(ods, keep=materialize)
    enums = run.write("spr_enums", lambda: D.enum_dims(values, run.before("spr_enums")))
    dims = {n: D.split_enum(enums, n) for n in D.ENUMS}
    if stg_currency is None:
        stg_currency = store.read("stg_currency")
        if stg_currency is None:
            raise ValueError("no currency list: pass stg_currency, or store one as 'stg_currency'")
    build = {
        "spr_client": lambda cur: D.client_dim(ods["case"], cur),
        "spr_agent": lambda cur: D.agent_dim(values, cur),
        "spr_customer": lambda cur: D.customer_dim(ods["address"], dims["spr_client"],
                                                   dims["spr_customer_type"], dims["spr_agent"], cur),
        "spr_phone": lambda cur: D.phone_dim(ods["address"], dims["spr_customer"],
                                             dims["spr_client"], cur),
        "spr_email": lambda cur: D.email_dim(ods["address"], dims["spr_customer"],
                                             dims["spr_client"], cur),
        "spr_currency": lambda cur: D.currency_dim(stg_currency, values, cur),
        "spr_country": lambda cur: D.country_dim(values, cur),
        "spr_city": lambda cur: D.city_dim(values, dims["spr_country"], cur),
    }
    for name in DIM_ORDER:
        dims[name] = run.write(name, lambda name=name: build[name](run.before(name)))
    tables.update(dims)

    # 3. facts
    fct_request = run.write("fct_request", lambda: facts.blank_rso(
        facts.build_request_fact(ods["request"], dims, run.before("fct_request")), dims["spr_request_type"]))
    fct_case = run.write("fct_case", lambda: facts.build_case_fact(
        ods["case"], fct_request, dims, run.before("fct_case")))
    tables.update({"fct_request": fct_request, "fct_case": fct_case})
    run.commit()
    return tables


def reports_from_store(store: SnapshotStore, plan: DataFrame, start, as_of, window):
    """R1-R4 over the request fact and dimensions of the last committed run."""
    current = RunView(store)
    enums, client = current.read("spr_enums"), current.read("spr_client")
    metrics = materialize(reports.daily_metrics(current.read("fct_request"), client,
                                                D.split_enum(enums, "spr_act"), start, as_of))
    pivot = reports.daily_pivot(metrics, plan)
    return {
        "daily_pivot": pivot,
        "client_summary": reports.client_summary(pivot, window, as_of),
        "daily_stats": reports.daily_stats(pivot, window),
        "plan_fact": reports.plan_fact(pivot, client, window, as_of),
    }

"""Fact builds D23 (request fact), D24 (RSO blanking) and D25 (case fact).

The request fact is a star lookup: every dimension is reduced to a two-column
(key, id) table. Those below Spark's broadcast threshold are looked up without
shuffling the fact, all larger ones together in one pass over the unpivoted
codes. The upsert keys of the facts are their natural keys; facts carry no sequential
id (that would need one global numbering of the largest table).

The fact keys drop the prefix of the business key, so two active entities can
share a fact key (K20). The newest delivery wins: latest ``effective_from``,
then change timestamp, then business key. That is settled before the lookups,
on the keys alone; the wide rows are only filtered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import specs
from ..functions import keys as K
from ..operators import merge
from ..operators.bloom import bloom_semi_join
from ..operators.lookup import dim_pairs, lookup, star_lookup
from ..session import materialize
from ..specs import EFFECTIVE_FROM, IS_ACTIVE

REQUEST_FACT_COLUMNS = [
    "added_dt", "booking_channel", "changed_dt", "commission_charged", "confirmation_number",
    "closed_dt", "event_city_other", "event_end_dt", "event_start_dt", "followup_method",
    "hotel_chain", "nights", "promised_dt", "reporting_amount", "response_dt",
    "request_details", "request_number", "service_provider", "situation", "spr_act_id",
    "spr_active_id", "spr_added_by_id", "spr_assigned_to_id", "spr_card_brand_id",
    "spr_commission_currency_id", "spr_currency_id", "spr_event_city_id",
    "spr_iata_provided_id", "spr_fulfillment_outcome_id", "spr_fulfillment_method_id",
    "spr_popular_provider_id", "spr_popular_channel_id", "spr_request_type_id", "spr_rso_id",
    "spr_service_type_id", "spr_subtype_id", "spr_status_id", "stars", "vendor_contact",
]

# request column -> (dimension, dimension key column, fact id column)
REQUEST_LOOKUPS = [
    ("act", "spr_act", "act_type", "spr_act_id"),
    ("request_active_or_not_active", "spr_request_active", "active_type", "spr_active_id"),
    ("issue_added_by_user_code", "spr_agent", "username", "spr_added_by_id"),
    ("assigned_to_agent", "spr_agent", "username", "spr_assigned_to_id"),
    ("credit_card_brand", "spr_card_brand", "card_type", "spr_card_brand_id"),
    ("commission_currency", "spr_currency", "code", "spr_commission_currency_id"),
    ("reporting_currency", "spr_currency", "code", "spr_currency_id"),
    # raw 'CCC-City' text against the bare city name: matches mainly 'OTHER',
    # which exists per country, so the highest city id wins
    ("event_city", "spr_city", "name_eng", "spr_event_city_id"),
    ("iata_provided", "spr_iata", "provided", "spr_iata_provided_id"),
    ("fulfillment_outcome", "spr_fulfillment_outcome", "outcome", "spr_fulfillment_outcome_id"),
    ("fulfillment_method", "spr_fulfillment_method", "method", "spr_fulfillment_method_id"),
    ("popular_service_provider", "spr_popular_provider", "provider", "spr_popular_provider_id"),
    ("popular_booking_channel", "spr_popular_provider", "provider", "spr_popular_channel_id"),
    ("request_type", "spr_request_type", "type", "spr_request_type_id"),
    # an uptake value that never occurred as a request type stays NULL
    ("rso_uptake", "spr_request_type", "type", "spr_rso_id"),
    ("service_type", "spr_service_type", "type", "spr_service_type_id"),
    ("request_subtype", "spr_request_subtype", "subtype", "spr_subtype_id"),
    # statuses come from cases only: request-only statuses stay NULL
    ("issue_status", "spr_status", "status", "spr_status_id"),
]

_RENAMES = {
    "issue_date_added": "added_dt", "issue_date_changed": "changed_dt",
    "confirmation_num": "confirmation_number", "closed_issue_date": "closed_dt",
    "event_end_date_time": "event_end_dt", "event_start_date_time": "event_start_dt",
    "follow_up_method": "followup_method", "customer_promise_date": "promised_dt",
    "actual_response_date": "response_dt",
}


def request_fact_source_schema(spark: SparkSession) -> T.StructType:
    types = {f.name: f.dataType for f in specs.REQUEST_SCHEMA.fields}
    back = {v: k for k, v in _RENAMES.items()}
    fields = []
    for c in REQUEST_FACT_COLUMNS:
        if c == "request_number":
            t = T.StringType()
        elif c.startswith("spr_"):
            t = T.LongType()
        else:
            t = types[back.get(c, c)]
        fields.append(T.StructField(c, t, True))
    return T.StructType(fields)


def empty_request_fact(spark: SparkSession) -> DataFrame:
    from ..session import empty_frame
    return empty_frame(spark, request_fact_source_schema(spark))


def request_fact_source(ods_request: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Active requests (not of an 'O ...' type) with all 18 dimension ids."""
    base = ods_request.filter((F.col(IS_ACTIVE) == 1)
                              & ~K.ilike_prefix("request_type", specs.EXCLUDED_TYPE_LIKE))
    # one key column for the collisions and for the lookups: both find the rows in one place
    base = base.withColumn("request_number", K.request_number("global_request_number"))
    base = merge.newest_of_colliding(
        base, {"request_number": F.col("request_number")},
        [EFFECTIVE_FROM, specs.REQUEST.change_ts, "global_request_number"])
    pairs = {f"{dim}.{key}": dim_pairs(dims[dim], key, reduce_max=True)
             for _, dim, key, _ in REQUEST_LOOKUPS}
    out = star_lookup(base, "request_number",
                      [(col, f"{dim}.{key}", id_col) for col, dim, key, id_col in REQUEST_LOOKUPS], pairs)
    for src, dst in _RENAMES.items():
        out = out.withColumnRenamed(src, dst)
    return out.select(*REQUEST_FACT_COLUMNS)


def build_request_fact(ods_request: DataFrame, dims: dict[str, DataFrame],
                       current: DataFrame | None = None) -> DataFrame:
    """Upsert by ``request_number``, every other column is updated.

    Rows absent from the batch (e.g. requests that later became 'O ...')
    keep their old values.
    """
    spark = ods_request.sparkSession
    src = request_fact_source(ods_request, dims)
    dst = empty_request_fact(spark) if current is None else current
    update = [c for c in REQUEST_FACT_COLUMNS if c != "request_number"]
    return merge.upsert(dst, src, ["request_number"], update, id_col=None, src_unique=True)


def blank_rso(fct_request: DataFrame, spr_request_type: DataFrame) -> DataFrame:
    """``spr_rso_id = NULL`` where it points to a blacklisted type.

    Applies to every fact row (old ones too). The blacklisted ids come from
    the request-type dimension; Spark picks the join from its stored bytes.
    """
    bad = spr_request_type.filter(
        F.col("type").isin(*specs.RSO_BLACKLIST)
        | K.ilike_prefix("type", specs.RSO_BLACKLIST_LIKE)
    ).select(F.col("id").alias("_bad_id"), F.lit(True).alias("_bad"))
    cols = fct_request.columns
    return (fct_request.join(bad, fct_request["spr_rso_id"] == bad["_bad_id"], "left")
            .withColumn("spr_rso_id", F.when(F.col("_bad"), F.lit(None).cast("long"))
                        .otherwise(F.col("spr_rso_id")))
            .select(*cols))


CASE_FACT_COLUMNS = ["added_dt", "case_number", "changed_dt", "closed_dt", "current_location",
                     "current_phone", "received_dt", "spr_client_id", "spr_customer_id",
                     "spr_init_conc_id", "spr_method_id", "spr_resp_conc_id", "spr_source_id",
                     "spr_status_id"]


def empty_case_fact(spark: SparkSession) -> DataFrame:
    ts, s, lg = T.TimestampNTZType(), T.StringType(), T.LongType()
    types = {"added_dt": ts, "case_number": s, "changed_dt": ts, "closed_dt": ts,
             "current_location": s, "current_phone": s, "received_dt": ts}
    from ..session import empty_frame
    return empty_frame(spark, T.StructType(
        [T.StructField(c, types.get(c, lg), True) for c in CASE_FACT_COLUMNS]))


def case_fact_source(ods_case: DataFrame, fct_request: DataFrame, dims: dict[str, DataFrame],
                     source_from: str = "method") -> DataFrame:
    """Active cases that some request fact points to, with 7 dimension ids.

    ``source_from="method"`` fills ``spr_source_id`` from the contact-method
    dimension, as the original load did; ``"source"`` uses the source one.
    """
    active = merge.newest_of_colliding(
        ods_case.filter(F.col(IS_ACTIVE) == 1),
        {"case_number": K.case_number("global_case_number"),
         "case_client": K.client_of_case("global_case_number")},
        [EFFECTIVE_FROM, specs.CASE.change_ts, "global_case_number"])
    cases = (active
             .select(K.case_number("global_case_number").alias("case_number"),
                     K.client_of_case("global_case_number").alias("client"),
                     K.case_key("global_case_number").alias("_case_key"),
                     "case_address_id",
                     F.col("received_date").alias("received_dt"),
                     F.col("case_date_added").alias("added_dt"),
                     F.col("case_date_changed").alias("changed_dt"),
                     F.col("closed_case_date").alias("closed_dt"),
                     "case_status", "initial_agent", "responsible_agent", "contact_method",
                     "contact_source", "current_location", "current_phone"))
    # distinct first: duplicates (one case, many requests) collapse map-side
    referenced = materialize(fct_request.select(K.case_key_of_request("request_number").alias("_case_key"))
                             .distinct())
    # cases that no request points to are dropped before the shuffle
    cases = bloom_semi_join(cases, referenced, "_case_key")

    out = lookup(cases, dim_pairs(dims["spr_client"], "client"), "client", "spr_client_id")
    customers = (dims["spr_customer"]
                 .join(dim_pairs(dims["spr_client"], "id", "client"),
                       F.col("spr_client_id") == F.col("_k"))
                 .select(F.col("_v").alias("_c_client"), F.col("address_id").alias("_c_addr"),
                         F.col("id").alias("spr_customer_id")))
    out = out.join(customers, (out["client"] == customers["_c_client"])
                   & (out["case_address_id"] == customers["_c_addr"]), "left")
    out = lookup(out, dim_pairs(dims["spr_status"], "status"), "case_status", "spr_status_id")
    agent = dim_pairs(dims["spr_agent"], "username")
    out = lookup(out, agent, "initial_agent", "spr_init_conc_id")
    out = lookup(out, agent, "responsible_agent", "spr_resp_conc_id")
    out = lookup(out, dim_pairs(dims["spr_contact_method"], "method"), "contact_method",
                 "spr_method_id")
    if source_from == "method":
        out = out.withColumn("spr_source_id", F.col("spr_method_id"))
    else:
        out = lookup(out, dim_pairs(dims["spr_contact_source"], "source"), "contact_source",
                     "spr_source_id")
    return out.select(*CASE_FACT_COLUMNS)


def build_case_fact(ods_case: DataFrame, fct_request: DataFrame, dims: dict[str, DataFrame],
                    current: DataFrame | None = None, source_from: str = "method") -> DataFrame:
    """Upsert by (case_number, spr_client_id); all other columns update."""
    spark = ods_case.sparkSession
    src = case_fact_source(ods_case, fct_request, dims, source_from)
    if current is not None:
        src = materialize(src)      # an upsert reads it twice, and its rows have been shuffled
    dst = empty_case_fact(spark) if current is None else current
    keys = ["case_number", "spr_client_id"]
    return merge.upsert(dst, src, keys, [c for c in CASE_FACT_COLUMNS if c not in keys],
                        id_col=None, src_unique=True)

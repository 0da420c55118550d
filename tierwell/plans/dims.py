"""Dimension builds D1-D22: each returns the new dimension table.

Every builder takes the current ODS snapshots and the dimension's current
state (``None`` = empty, first load) and applies an upsert, so existing
surrogate ids never change and new members get the next ids in natural-key
order. Sources read all history versions unless stated otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import specs
from ..functions import keys as K
from ..functions.names import account_fullname
from ..operators import merge
from ..operators.bloom import bloom_filter, maybe_in
from ..session import materialize
from ..specs import EFFECTIVE_FROM, IS_ACTIVE

L, S, I, D, TS = T.LongType(), T.StringType(), T.IntegerType(), T.DateType(), T.TimestampNTZType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# enumeration dimensions: name -> (value column, [(entity, source column), ...])
ENUMS = {
    "spr_contact_method": ("method", [("case", "contact_method")]),
    "spr_contact_source": ("source", [("case", "contact_source")]),
    "spr_customer_type": ("type", [("address", "address_type")]),
    "spr_status": ("status", [("case", "case_status")]),
    "spr_service_type": ("type", [("request", "service_type")]),
    "spr_request_type": ("type", [("request", "request_type")]),
    "spr_request_subtype": ("subtype", [("request", "request_subtype")]),
    "spr_act": ("act_type", [("request", "act")]),
    "spr_request_active": ("active_type", [("request", "request_active_or_not_active")]),
    "spr_popular_provider": ("provider", [("request", "popular_service_provider"),
                                          ("request", "popular_booking_channel")]),
    "spr_fulfillment_outcome": ("outcome", [("request", "fulfillment_outcome")]),
    "spr_fulfillment_method": ("method", [("request", "fulfillment_method")]),
    "spr_card_brand": ("card_type", [("request", "credit_card_brand")]),
    "spr_iata": ("provided", [("request", "iata_provided")]),
}

SCHEMAS = {name: _schema(("id", L), (value, S)) for name, (value, _) in ENUMS.items()}
SCHEMAS.update({
    "spr_client": _schema(("id", L), ("client", S), ("client_name", S), ("is_util", I),
                          ("is_active", I)),
    "spr_agent": _schema(("id", L), ("username", S), ("fullname", S)),
    "spr_customer": _schema(("id", L), ("address_id", L), ("spr_client_id", L),
                            ("spr_customer_type_id", L), ("last_name", S), ("first_name", S),
                            ("middle_name", S), ("preferred_name", S), ("dob", D),
                            ("added_by_id", L), ("changed_by_id", L), ("added_dt", TS),
                            ("changed_dt", TS), ("last_contacted_dt", TS)),
    "spr_phone": _schema(("id", L), ("type", S), ("phone", S), ("spr_customer_id", L)),
    "spr_email": _schema(("id", L), ("spr_customer_id", L), ("type", S), ("email", S)),
    "spr_currency": _schema(("id", L), ("code", S), ("eng_name", S), ("rus_name", S)),
    "spr_country": _schema(("id", L), ("code", S), ("name_eng", S), ("name_rus", S)),
    "spr_city": _schema(("id", L), ("name_eng", S), ("name_rus", S), ("spr_country_id", L)),
})


def empty(spark: SparkSession, name: str) -> DataFrame:
    from ..session import empty_frame
    return empty_frame(spark, SCHEMAS[name])


def _state(spark: SparkSession, name: str, current: DataFrame | None) -> DataFrame:
    return empty(spark, name) if current is None else current


def _values(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _start(current: DataFrame | None):
    # empty target: ids start at 0 without reading it
    return 0 if current is None else None


# string columns whose distinct values feed dimensions, per ODS table
VALUE_COLUMNS: dict[str, list[str]] = {}
for _name, (_v, _sources) in ENUMS.items():
    for _e, _c in _sources:
        VALUE_COLUMNS.setdefault(_e, []).append(_c)
VALUE_COLUMNS["request"] += ["commission_currency", "reporting_currency", "event_country",
                             "event_city"]
for _e, _cols in {"case": ["initial_agent", "responsible_agent"],
                  "request": ["assigned_to_agent", "issue_added_by_user_code"],
                  "address": ["added_by", "changed_by"]}.items():
    VALUE_COLUMNS[_e] += _cols


class ColumnValues:
    """Distinct non-NULL values of many string columns, one scan per table.

    ``table(entity)`` is a small (column, value) table built with a single
    aggregation over the ODS snapshot (map-side partial distinct, then one
    shuffle of the distinct pairs); every enumeration, the agents, currencies,
    countries and cities read it instead of rescanning the ODS per dimension.
    """

    def __init__(self, ods: dict[str, DataFrame], columns=None, keep=None):
        self._ods = ods
        self._columns = columns or VALUE_COLUMNS
        self._keep = keep or (lambda df: df)
        self._tables: dict[str, DataFrame] = {}

    def table(self, entity: str) -> DataFrame:
        if entity not in self._tables:
            cols = list(dict.fromkeys(self._columns[entity]))
            pairs = F.explode(F.array(*[
                F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                for c in cols]))
            t = (self._ods[entity].select(pairs.alias("_p")).select("_p.*")
                 .filter(F.col("value").isNotNull()).distinct())
            self._tables[entity] = self._keep(t)
        return self._tables[entity]

    def of(self, entity: str, *cols: str) -> DataFrame:
        """Distinct non-NULL values of the union of ``cols`` as column ``value``."""
        t = self.table(entity)
        return t.filter(F.col("column").isin(*cols)).select("value").distinct()

    @property
    def spark(self) -> SparkSession:
        return next(iter(self._ods.values())).sparkSession


def _as_values(src) -> ColumnValues:
    return src if isinstance(src, ColumnValues) else ColumnValues(src)


def enum_dim(name: str, values, current: DataFrame | None = None) -> DataFrame:
    """Distinct non-NULL values, insert if unseen.

    ``values`` is a :class:`ColumnValues` (or a dict of ODS frames).
    """
    values = _as_values(values)
    value, sources = ENUMS[name]
    frames = [values.of(entity, col) for entity, col in sources]
    vals = _values(frames).distinct().select(F.col("value").alias(value))
    return merge.insert_new(_state(values.spark, name, current), vals, [value],
                            src_unique=True, start=_start(current))


def enum_dims(values, current: DataFrame | None = None) -> DataFrame:
    """All enumeration dimensions in one plan, as one (dim, id, value) table.

    Same result per dimension as :func:`enum_dim`: values not yet present
    (``current`` is the joint table so far) get ids after that dimension's
    current maximum, in value order. The new values of all dimensions are
    numbered at once by the distributed numbering over (dim, value); a
    dimension's first number (one row per dimension) is then subtracted.
    """
    values = _as_values(values)
    frames = [values.table(entity).filter(F.col("column") == col)
              .select(F.lit(name).alias("dim"), "value")
              for name, (_, sources) in ENUMS.items() for entity, col in sources]
    vals = _values(frames).distinct()
    if current is not None:
        vals = vals.join(current.select("dim", "value"), ["dim", "value"], "left_anti")
    placed = merge.numbered(vals, ["dim", "value"], "_at")
    first = placed.groupBy("dim").agg((F.min("_at") - 1).alias("_before"))
    if current is not None:
        last = current.groupBy("dim").agg(F.max("id").alias("_last"))
        first = first.join(last, "dim", "left").select(
            "dim", (F.col("_before") - F.coalesce("_last", F.lit(0))).alias("_before"))
    new = placed.join(first, "dim").select(
        "dim", (F.col("_at") - F.col("_before")).cast("long").alias("id"), "value")
    return new if current is None else current.select("dim", "id", "value").unionByName(new)


def split_enum(all_enums: DataFrame, name: str) -> DataFrame:
    """One enumeration dimension out of the joint table of :func:`enum_dims`."""
    return (all_enums.filter(F.col("dim") == name)
            .select("id", F.col("value").alias(ENUMS[name][0])))


def client_dim(ods_case: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """One row per client code from its newest case row (any version)."""
    spark = ods_case.sparkSession
    code = K.client_of_case("global_case_number")
    # the two columns that nearly always decide are compared on their own, so that the
    # whole rows are read, and moved, for a client's newest ones only
    first = F.struct(EFFECTIVE_FROM, specs.CASE.change_ts)
    top = materialize(ods_case.groupBy(code.alias("_code")).agg(F.max(first).alias("_at")))
    order = [c for c in specs.CASE.columns if c != specs.CASE.change_ts]
    newest = (maybe_in(ods_case, F.xxhash64(code, EFFECTIVE_FROM, specs.CASE.change_ts),
                       bloom_filter(top, F.xxhash64("_code", f"_at.{EFFECTIVE_FROM}", f"_at.{specs.CASE.change_ts}")))
              .join(top, code.eqNullSafe(F.col("_code")) & first.eqNullSafe(F.col("_at")))
              .groupBy(F.col("_code").alias("_client"))
              .agg(F.max(F.struct(*order)).alias("_n"))
              .select(F.col("_client").alias("client"), F.col("_n.client").alias("name")))
    src = newest.select(
        "client",
        F.coalesce(F.col("name"), F.col("client")).alias("client_name"),
        F.when(F.col("client").isin(*specs.UTIL_CLIENTS), 1).otherwise(0).alias("is_util"),
        F.when(F.col("client").isin(*specs.INACTIVE_CLIENTS)
               | F.lower(F.col("name")).like(specs.INACTIVE_NAME_PATTERN), 0)
        .otherwise(1).alias("is_active"),
    )
    return merge.upsert(_state(spark, "spr_client", current), src, ["client"],
                        ["client_name", "is_util", "is_active"], src_unique=True,
                        start=_start(current))


AGENT_COLUMNS = {"case": ["initial_agent", "responsible_agent"],
                 "request": ["assigned_to_agent", "issue_added_by_user_code"],
                 "address": ["added_by", "changed_by"]}


def agent_dim(values, current: DataFrame | None = None) -> DataFrame:
    """Every account named in any role column, with its derived full name."""
    values = _as_values(values)
    accounts = _values([values.of(e, *cols) for e, cols in AGENT_COLUMNS.items()])
    return upsert_accounts(accounts, current, values.spark)


def upsert_accounts(accounts: DataFrame, current: DataFrame | None = None,
                    spark: SparkSession | None = None) -> DataFrame:
    """Upsert distinct account names (column ``value``) into the agent dimension."""
    spark = spark or accounts.sparkSession
    src = (accounts.distinct().select(F.col("value").alias("username"))
           .withColumn("fullname", account_fullname("username")))
    return merge.upsert(_state(spark, "spr_agent", current), src, ["username"],
                        ["fullname"], src_unique=True, start=_start(current))


CUSTOMER_UPDATE = ["spr_customer_type_id", "last_name", "first_name", "middle_name",
                   "preferred_name", "dob", "changed_by_id", "added_dt", "changed_dt",
                   "last_contacted_dt"]   # added_by_id is insert-only


def customer_dim(ods_address: DataFrame, spr_client: DataFrame, spr_customer_type: DataFrame,
                 spr_agent: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Active profiles with client, type and both agents resolved (inner joins).

    A profile whose client has no case (not in ``spr_client``) is dropped.
    """
    from ..operators.lookup import dim_pairs
    spark = ods_address.sparkSession
    a = ods_address.filter(F.col(IS_ACTIVE) == 1)
    client = dim_pairs(spr_client, "client")
    ctype = dim_pairs(spr_customer_type, "type")
    agent = dim_pairs(spr_agent, "username")

    def inner(df, pairs, col, out):
        p = pairs.select(F.col("_k").alias(f"_k_{out}"), F.col("_v").alias(out))
        return df.join(p, df[col] == p[f"_k_{out}"], "inner").drop(f"_k_{out}")

    a = inner(a, client, "client_id", "spr_client_id")
    a = inner(a, ctype, "address_type", "spr_customer_type_id")
    a = inner(a, agent, "added_by", "added_by_id")
    a = inner(a, agent, "changed_by", "changed_by_id")
    src = a.select(
        "address_id", "spr_client_id", "spr_customer_type_id",
        F.col("surname").alias("last_name"), "first_name", "middle_name", "preferred_name",
        "dob", "added_by_id", "changed_by_id",
        F.col("address_date_added").alias("added_dt"),
        F.col("address_date_changed").alias("changed_dt"),
        F.col("last_contact_dt").alias("last_contacted_dt"),
    )
    return merge.upsert(_state(spark, "spr_customer", current), src,
                        ["spr_client_id", "address_id"], CUSTOMER_UPDATE, start=_start(current))


def customer_addresses(spr_customer: DataFrame, spr_client: DataFrame) -> DataFrame:
    """(spr_customer_id, address_id, client) of every customer."""
    clients = spr_client.select(F.col("id").alias("spr_client_id"), "client")
    return (spr_customer.select(F.col("id").alias("spr_customer_id"), "address_id", "spr_client_id")
            .join(clients, "spr_client_id").drop("spr_client_id"))


def _profile_contacts(ods_address: DataFrame, spr_customer: DataFrame, spr_client: DataFrame,
                      contacts: DataFrame) -> DataFrame:
    ca = customer_addresses(spr_customer, spr_client)
    return contacts.join(ca, (contacts["address_id"] == ca["address_id"])
                         & (contacts["client_id"] == ca["client"]), "inner")


def phone_dim(ods_address: DataFrame, spr_customer: DataFrame, spr_client: DataFrame,
              current: DataFrame | None = None) -> DataFrame:
    """Phones of all profile versions; default type; NULL and 'tba' dropped."""
    spark = ods_address.sparkSession
    contacts = ods_address.select(
        "address_id", "client_id",
        F.coalesce(F.col("phone_type"), F.lit(specs.DEFAULT_PHONE_TYPE)).alias("type"), "phone")
    src = (_profile_contacts(ods_address, spr_customer, spr_client, contacts)
           .filter(F.col("phone").isNotNull() & (F.col("phone") != specs.TBA))
           .select("type", "phone", "spr_customer_id").distinct())
    return merge.insert_new(_state(spark, "spr_phone", current), src,
                            ["type", "phone", "spr_customer_id"], src_unique=True,
                            start=_start(current))


def email_dim(ods_address: DataFrame, spr_customer: DataFrame, spr_client: DataFrame,
              current: DataFrame | None = None) -> DataFrame:
    """Personal and work e-mails (unpivot) of all versions; NULL and 'tba' dropped."""
    spark = ods_address.sparkSession
    contacts = ods_address.select(
        "address_id", "client_id",
        F.explode(F.array(
            F.struct(F.lit(specs.EMAIL_PERSONAL).alias("type"), F.col("pers_email").alias("email")),
            F.struct(F.lit(specs.EMAIL_WORKING).alias("type"), F.col("work_email").alias("email")),
        )).alias("_e")).select("address_id", "client_id", "_e.type", "_e.email")
    src = (_profile_contacts(ods_address, spr_customer, spr_client, contacts)
           .filter(F.col("email").isNotNull() & (F.col("email") != specs.TBA))
           .select("spr_customer_id", "type", "email").distinct())
    return merge.insert_new(_state(spark, "spr_email", current), src,
                            ["type", "email", "spr_customer_id"], src_unique=True,
                            start=_start(current))


def currency_dim(stg_currency: DataFrame, values,
                 current: DataFrame | None = None) -> DataFrame:
    """Reference list plus the fixed extra code, then codes seen in requests.

    A code listed twice keeps its smallest (English, Russian) name pair.
    """
    values = _as_values(values)
    spark = values.spark
    code, eng, rus = specs.EXTRA_CURRENCY
    listed = (stg_currency.select("code", F.col("name_en").alias("eng_name"),
                                  F.col("name_ru").alias("rus_name"))
              .unionByName(spark.range(1).select(F.lit(code).alias("code"),
                                                 F.lit(eng).alias("eng_name"),
                                                 F.lit(rus).alias("rus_name"))))
    listed = (listed.groupBy("code").agg(F.min(F.struct("eng_name", "rus_name")).alias("_n"))
              .select("code", "_n.eng_name", "_n.rus_name"))
    dim = merge.insert_new(_state(spark, "spr_currency", current), listed, ["code"],
                           src_unique=True, start=_start(current))
    seen = (values.of("request", "commission_currency", "reporting_currency")
            .select(F.col("value").alias("code"), F.lit(None).cast("string").alias("eng_name"),
                    F.lit(None).cast("string").alias("rus_name")))
    return merge.insert_new(dim, seen, ["code"], src_unique=True)


def country_dim(values, current: DataFrame | None = None) -> DataFrame:
    """Event countries, then the fixed 'OTH' and every city prefix."""
    values = _as_values(values)
    spark = values.spark
    none = F.lit(None).cast("string")
    first = (values.of("request", "event_country")
             .select(F.col("value").alias("code"), none.alias("name_eng"), none.alias("name_rus")))
    dim = merge.insert_new(_state(spark, "spr_country", current), first, ["code"],
                           src_unique=True, start=_start(current))
    prefixes = (values.of("request", "event_city")
                .select(F.col("value").substr(1, 3).alias("code"))
                .unionByName(spark.range(1).select(F.lit(specs.OTHER_COUNTRY).alias("code")))
                .distinct()
                .select("code", none.alias("name_eng"), none.alias("name_rus")))
    return merge.insert_new(dim, prefixes, ["code"], src_unique=True)


def city_dim(values, spr_country: DataFrame,
             current: DataFrame | None = None) -> DataFrame:
    """(city, country) split of ``event_city`` with the 'OTHER' rule."""
    from ..operators.lookup import dim_pairs
    values = _as_values(values)
    spark = values.spark
    cities = (values.of("request", "event_city")
              .select(K.city_country("value").alias("country"),
                      K.city_name("value").alias("name_eng"))
              .distinct())
    country = dim_pairs(spr_country, "code")
    src = (cities.join(country, cities["country"] == country["_k"], "inner")
           .select("name_eng", F.lit(None).cast("string").alias("name_rus"),
                   F.col("_v").alias("spr_country_id")))
    return merge.insert_new(_state(spark, "spr_city", current), src,
                            ["name_eng", "spr_country_id"], src_unique=True,
                            start=_start(current))

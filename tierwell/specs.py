"""Entity specs, schemas and fixed values of the layered warehouse.

An *entity spec* tells the generic operators (gate, history load) which
columns are required, which columns define a distinct version, which column
is the business key of the entity and which column carries the source-side
change timestamp used to break ties deterministically.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S, TS, L, D, DT, I = (T.StringType(), T.TimestampNTZType(), T.LongType(),
                      T.DoubleType(), T.DateType(), T.IntegerType())

EFFECTIVE_FROM = "effective_from"
IS_ACTIVE = "is_active"


@dataclass(frozen=True)
class EntitySpec:
    name: str
    schema: T.StructType            # staging schema, business columns in order
    required: tuple[str, ...]       # completeness gate
    dedupe: tuple[str, ...]         # columns that define a distinct version
    key: str                        # business key of the entity
    change_ts: str                  # source-side change timestamp (tie-break)
    derived: dict = field(default_factory=dict)  # extra ODS columns: name -> builder

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def ods_columns(self) -> list[str]:
        return self.columns + list(self.derived) + [EFFECTIVE_FROM, IS_ACTIVE]


def _schema(cols: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


CASE_SCHEMA = _schema([
    ("case_date_added", TS), ("case_address_id", L), ("case_date_changed", TS),
    ("case_status", S), ("client", S), ("closed_case_date", TS),
    ("contact_method", S), ("contact_source", S), ("current_location", S),
    ("current_phone", S), ("department", S), ("global_case_number", S),
    ("initial_agent", S), ("received_date", TS), ("responsible_agent", S),
])

REQUEST_SCHEMA = _schema([
    ("act", S), ("actual_response_date", TS), ("assigned_to_agent", S),
    ("booking_channel", S), ("closed_issue_date", TS), ("commission_charged", D),
    ("commission_currency", S), ("confirmation_num", S), ("credit_card_brand", S),
    ("customer_promise_date", TS), ("event_city", S), ("event_city_other", S),
    ("event_country", S), ("event_end_date_time", TS), ("event_start_date_time", TS),
    ("follow_up_method", S), ("fulfillment_method", S), ("fulfillment_outcome", S),
    ("global_request_number", S), ("hotel_chain", S), ("iata_provided", S),
    ("issue_added_by_user_code", S), ("issue_date_added", TS), ("issue_date_changed", TS),
    ("issue_status", S), ("nights", L), ("number_of_adults", L),
    ("number_of_children", L), ("popular_booking_channel", S),
    ("popular_service_provider", S), ("reporting_amount", D), ("reporting_currency", S),
    ("request_active_or_not_active", S), ("request_details", S), ("request_subtype", S),
    ("request_type", S), ("rso_uptake", S), ("service_provider", S), ("service_type", S),
    ("situation", S), ("stars", L), ("vendor_contact", S),
])

ADDRESS_SCHEMA = _schema([
    ("added_by", S), ("address_date_added", TS), ("address_date_changed", TS),
    ("address_id", L), ("address_type", S), ("changed_by", S), ("client_id", S),
    ("dob", DT), ("first_name", S), ("last_contact_dt", TS), ("member_ref_1", S),
    ("member_ref_2", S), ("member_ref_3", S), ("member_ref_4", S), ("member_ref_5", S),
    ("member_ref_6", S), ("middle_name", S), ("pers_email", S), ("phone_type", S),
    ("phone", S), ("preferred_name", S), ("surname", S), ("work_email", S),
])

PLAN_SCHEMA = _schema([("client", S), ("target", L), ("effective_from", DT),
                       ("effective_to", DT)])

CURRENCY_SCHEMA = _schema([("code", S), ("name_ru", S), ("name_en", S)])


def _client_address_id():
    # client_id || cast(address_id as string): NULL-propagating concatenation
    from pyspark.sql import functions as F
    return F.concat(F.col("client_id"), F.col("address_id").cast("string"))


CASE = EntitySpec(
    name="case",
    schema=CASE_SCHEMA,
    required=("case_date_added", "case_address_id", "case_date_changed", "case_status",
              "global_case_number", "initial_agent", "received_date", "responsible_agent"),
    # every column except case_address_id: two versions that differ only there
    # collapse into one and the newest wins
    dedupe=tuple(c for c in CASE_SCHEMA.fieldNames() if c != "case_address_id"),
    key="global_case_number",
    change_ts="case_date_changed",
)

REQUEST = EntitySpec(
    name="request",
    schema=REQUEST_SCHEMA,
    required=("assigned_to_agent", "global_request_number", "issue_added_by_user_code",
              "issue_date_added", "issue_date_changed", "issue_status", "request_type",
              "service_type"),
    dedupe=tuple(REQUEST_SCHEMA.fieldNames()),
    key="global_request_number",
    change_ts="issue_date_changed",
)

ADDRESS = EntitySpec(
    name="address",
    schema=ADDRESS_SCHEMA,
    required=("added_by", "address_date_added", "address_date_changed", "address_id",
              "address_type", "changed_by", "client_id", "last_contact_dt"),
    dedupe=tuple(ADDRESS_SCHEMA.fieldNames()),
    key="client_address_id",
    change_ts="address_date_changed",
    derived={"client_address_id": _client_address_id},
)

ENTITIES = {"case": CASE, "request": REQUEST, "address": ADDRESS}


# --- fixed values: must equal the original warehouse's for right results -----
# Client codes counted as "utilisation" clients.
UTIL_CLIENTS = ("BLB", "CIP", "HBC", "HPB", "KKB", "PSP", "RBA", "RPB", "SBN", "SBP",
                "SDB", "SGS", "UBK", "VSM", "YPO")
# Client codes that are always inactive.
INACTIVE_CLIENTS = ("SDB", "ICC", "CBM")
# Substring (lower case) of a client name that marks it inactive.
INACTIVE_NAME_PATTERN = "%inactive%"
# Request types whose RSO reference is blanked, plus every type like 'O %'.
RSO_BLACKLIST = ("N\\A", "I agent PROGRAM", "I AIRPORT SERVICES")
RSO_BLACKLIST_LIKE = "o %"          # compared against lower(type)
# Request types excluded from the request fact (compared against lower(type)).
EXCLUDED_TYPE_LIKE = "o %"
# act_type values counted by the daily report.
ACT_YES = "Yes"
ACT_DRAGON_PASS = "Free Dragon Pass"
# Currency always present in the currency dimension.
EXTRA_CURRENCY = ("BYR", "Belarusian ruble", "Белорусский рубль")
# Country code used for cities without a country prefix, and that city name.
OTHER_COUNTRY = "OTH"
OTHER_CITY = "OTHER"
# Default phone type, sentinel for "to be announced" contact values.
DEFAULT_PHONE_TYPE = "Mobile"
TBA = "tba"
# E-mail kinds of the unpivoted address columns.
EMAIL_PERSONAL = "Personal"
EMAIL_WORKING = "Working"
# Forecast horizon of the daily report in days.
FORECAST_DAYS = 30

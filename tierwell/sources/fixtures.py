"""Staging batches derived from the driver tables.

The warehouse is fed by operational exports (cases, requests, client
profiles). The test tables are TPC-H shaped, so the staging inputs are
derived from ``orders``, ``lineitem``, ``customer`` and ``region`` with plain
SQL that both Spark and DuckDB run identically. Each fixture is written once
as a template and rendered for either engine:

* Spark: ``spark.sql(text, orders=<DataFrame>, ...)`` (DataFrames bound as
  arguments, no global views);
* DuckDB (oracle): the same text with the pre-registered view names.

NULLs are injected by key arithmetic because the driver tables have none.
Batches are complete re-deliveries of the source table (never subsets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import specs

# the client codes that rows are spread over, by key: the utilisation clients,
# two inactive ones, and one that has no plan
CODES = [*specs.UTIL_CLIENTS, "ICC", "CBM", "ZZZ"]

# batch stamps (effective_from of batch n)
BATCH_TS = {1: "2002-01-01 00:00:00", 2: "2002-01-02 00:00:00", 3: "2002-01-03 00:00:00"}

# report parameters matching the span of the test orders (1995-01-01..2001-08-01)
SPINE_START = "1995-01-01"
AS_OF = "2001-08-15"
WINDOW = ("2001-07-01", "2001-08-01")


def code(k: str) -> str:
    return f"substr('{''.join(CODES)}', cast(1+3*(({k})%{len(CODES)}) as int), 3)"


def _s(x: str) -> str:
    return f"cast({x} as string)"


CASE_SQL = f"""
select
  case when o_orderkey%97=0 then null else o_orderdate end as case_date_added,
  case when o_orderkey%89=0 then null else o_custkey end as case_address_id,
  o_orderdate as case_date_changed,
  case o_orderstatus when 'F' then 'Closed' when 'O' then 'Open' else 'Pending' end as case_status,
  case when o_custkey%18=0 then null when o_custkey%18=17 then 'Zeta (Inactive)'
       else 'Client ' || {code('o_custkey')} end as client,
  case when o_orderstatus='F' then o_orderdate + interval '3' day end as closed_case_date,
  case o_orderpriority when '1-URGENT' then 'Phone' when '2-HIGH' then 'E-mail'
       when '3-MEDIUM' then 'Chat' when '5-LOW' then 'App' else null end as contact_method,
  case o_orderkey%3 when 0 then 'Web' when 1 then 'Mobile' else null end as contact_source,
  'LOC' || {_s('o_custkey%25')} as current_location,
  case when o_orderkey%3=0 then null else '+7' || lpad({_s('o_orderkey')},9,'0') end as current_phone,
  'DEP' || {_s('o_orderkey%3')} as department,
  'GLB' || {code('o_custkey')} || lpad({_s('o_orderkey')},7,'0') as global_case_number,
  case when o_orderkey%101=0 then null when o_orderkey%5=0 then 'john.smith'
       when o_orderkey%5=1 then 'anna.lee' when o_orderkey%5=2 then 'admin'
       when o_orderkey%5=3 then 'a.b.c' else 'mark.' end as initial_agent,
  o_orderdate as received_date,
  case o_orderkey%4 when 0 then 'anna.lee' when 1 then 'rob.mcDonald' when 2 then 'admin'
       else 'zoe.king' end as responsible_agent
from {{orders}}
"""

# Batch 2 re-delivers every case: every 10th gets a new status (new version),
# every 20th+15 only a new address id (collapses with the old one), the rest
# is unchanged (its effective_from moves forward).
CASE_BATCH2_SQL = f"""
select case_date_added,
  case when k%20=15 then case_address_id+1 else case_address_id end as case_address_id,
  case when k%10=0 then case_date_changed + interval '1' day else case_date_changed end as case_date_changed,
  case when k%10=0 then 'Reopened' else case_status end as case_status,
  client, closed_case_date, contact_method, contact_source, current_location, current_phone,
  department, global_case_number, initial_agent, received_date, responsible_agent
from (select c.*, cast(substr(global_case_number,7) as bigint) as k from ({CASE_SQL}) c) x
"""

REQUEST_SQL = f"""
select
  case l_linenumber when 1 then 'No' when 2 then 'Yes' when 3 then 'Free Dragon Pass' else null end as act,
  l_shipdate as actual_response_date,
  case when (l_orderkey+l_linenumber)%83=0 then null when l_suppkey%2=0 then 'john.smith'
       else 'zoe.king' end as assigned_to_agent,
  case when l_partkey%2=0 then 'Direct' else 'Agency' end as booking_channel,
  case when l_linestatus='F' then l_shipdate end as closed_issue_date,
  l_discount as commission_charged,
  case l_partkey%4 when 0 then 'USD' when 1 then 'EUR' when 2 then 'QQQ' else null end as commission_currency,
  'CN' || {_s('l_partkey')} as confirmation_num,
  case l_suppkey%3 when 0 then 'VISA' when 1 then 'MIR' else null end as credit_card_brand,
  l_shipdate as customer_promise_date,
  case l_partkey%6 when 0 then 'RUS-Moscow' when 1 then 'FRA-Paris' when 2 then 'OTHER'
       when 3 then 'USA-OTHER' when 4 then null else 'GBR-London' end as event_city,
  case when l_partkey%6=2 then 'Suzdal' end as event_city_other,
  case l_partkey%6 when 0 then 'RUS' when 1 then 'FRA' when 3 then 'USA' when 5 then 'GBR'
       else null end as event_country,
  l_shipdate + interval '2' day as event_end_date_time,
  l_shipdate as event_start_date_time,
  case when l_suppkey%2=0 then 'Call' else null end as follow_up_method,
  case l_suppkey%3 when 0 then 'Online' when 1 then 'Offline' else null end as fulfillment_method,
  case l_partkey%3 when 0 then 'Done' when 1 then 'Cancelled' else null end as fulfillment_outcome,
  'GLB' || {code('o_custkey')} || lpad({_s('l_orderkey')},7,'0') || '.' || {_s('l_linenumber')}
       as global_request_number,
  case when l_partkey%8=5 then 'Chain A' else null end as hotel_chain,
  case l_suppkey%4 when 0 then 'Y' when 1 then 'N' else null end as iata_provided,
  case when l_partkey%2=0 then 'anna.lee' else 'rob.mcDonald' end as issue_added_by_user_code,
  case when l_orderkey%79=0 then null else o_orderdate end as issue_date_added,
  l_shipdate as issue_date_changed,
  case when l_partkey%9=0 then 'Waiting' when l_linestatus='F' then 'Closed' else 'Open' end as issue_status,
  cast(l_linenumber as bigint) as nights,
  cast(1+l_linenumber%3 as bigint) as number_of_adults,
  cast(l_linenumber%2 as bigint) as number_of_children,
  case l_suppkey%5 when 0 then 'Provider 1' when 1 then 'Channel 1' else null end as popular_booking_channel,
  case l_suppkey%5 when 2 then 'Provider 1' when 3 then 'Provider 2' else null end as popular_service_provider,
  l_extendedprice as reporting_amount,
  case l_partkey%3 when 0 then 'RUB' when 1 then 'BYR' else null end as reporting_currency,
  case when l_linestatus='O' then 'Active' else 'Not active' end as request_active_or_not_active,
  'req ' || {_s('l_partkey')} as request_details,
  case l_partkey%5 when 0 then null when 1 then 'Flight' else 'Stay' end as request_subtype,
  case l_partkey%8 when 0 then 'O OTHER' when 1 then 'o misc' when 2 then 'N' || chr(92) || 'A'
       when 3 then 'I agent PROGRAM' when 4 then 'I AIRPORT SERVICES' when 5 then 'I HOTEL'
       when 6 then 'I RESTAURANT' else 'I EVENT' end as request_type,
  case when l_linenumber=5 then 'I HOTEL' when l_linenumber=6 then 'N' || chr(92) || 'A'
       when l_linenumber=7 then 'O OTHER' when l_linenumber=2 and l_suppkey%2=0 then 'I RESTAURANT'
       when l_linenumber=4 and l_suppkey%3=0 then 'X UNKNOWN' else null end as rso_uptake,
  'SP' || {_s('l_suppkey')} as service_provider,
  case when l_linestatus='O' then 'Travel' else 'Lifestyle' end as service_type,
  case when l_partkey%7=0 then 'Urgent' else null end as situation,
  cast(3+l_linenumber%3 as bigint) as stars,
  cast(null as string) as vendor_contact,
  case l_returnflag when 'N' then 1 when 'A' then 2 else 3 end as batch
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
"""

ADDRESS_SQL = f"""
select
  case when c_custkey%2=0 then 'anna.lee' else 'it.support' end as added_by,
  {{TS}} '1995-01-01 00:00:00' as address_date_added,
  {{TS}} '1996-01-01 00:00:00' as address_date_changed,
  case when c_custkey%53=0 then null else c_custkey end as address_id,
  c_mktsegment as address_type,
  'zoe.king' as changed_by,
  case when c_custkey%47=0 then 'QQQ' else {code('c_custkey')} end as client_id,
  case when c_custkey%3=0 then null else date '1980-01-01' end as dob,
  'First' || {_s('c_custkey')} as first_name,
  case when c_custkey%59=0 then null else {{TS}} '2000-01-01 00:00:00' end as last_contact_dt,
  case when c_custkey%7=1 then 'M1' else null end as member_ref_1,
  case when c_custkey%7=2 then 'M2' else null end as member_ref_2,
  case when c_custkey%7=3 then 'M3' else null end as member_ref_3,
  case when c_custkey%7=4 then 'M4' else null end as member_ref_4,
  case when c_custkey%7=5 then 'M5' else null end as member_ref_5,
  case when c_custkey%7=6 then 'M6' else null end as member_ref_6,
  cast(null as string) as middle_name,
  case c_custkey%4 when 0 then null when 1 then 'tba'
       else 'p' || {_s('c_custkey')} || '@example.com' end as pers_email,
  case c_custkey%3 when 0 then null when 1 then 'Home' else 'Work' end as phone_type,
  case c_custkey%5 when 0 then null when 1 then 'tba' when 2 then 'TBA'
       else '+7' || lpad({_s('c_custkey')},9,'0') end as phone,
  cast(null as string) as preferred_name,
  c_name as surname,
  case when c_custkey%2=0 then 'w' || {_s('c_custkey')} || '@example.com' else null end as work_email
from {{customer}}
"""

# Batch 2 of the profiles: every 5th profile is edited by another user, the
# rest is re-delivered unchanged.
ADDRESS_BATCH2_SQL = f"""
select case when address_id%5=0 then 'zoe.king' else added_by end as added_by,
  address_date_added,
  case when address_id%5=0 then address_date_changed + interval '1' day
       else address_date_changed end as address_date_changed,
  address_id, address_type, changed_by, client_id, dob, first_name, last_contact_dt,
  member_ref_1, member_ref_2, member_ref_3, member_ref_4, member_ref_5, member_ref_6,
  middle_name, pers_email, phone_type, phone, preferred_name,
  case when address_id%5=0 then surname || '-2' else surname end as surname,
  work_email
from ({ADDRESS_SQL}) a
"""

# Two plan periods per client seen in the customer table: 1995..1999 and
# 1999..2002 (ICC open-ended, CBM with target 0, ZZZ without plan).
PLAN_SQL = f"""
select client, cast(case when client='CBM' then 0 else 20 end as bigint) as target,
  date '1995-01-01' as effective_from, date '1999-01-01' as effective_to
from (select distinct {code('c_custkey')} as client from {{customer}}) c
where client <> 'ZZZ'
union all
select client, cast(case when client='CBM' then 0 else 21 end as bigint) as target,
  date '1999-01-01' as effective_from,
  case when client='ICC' then null else date '2002-01-01' end as effective_to
from (select distinct {code('c_custkey')} as client from {{customer}}) c
where client <> 'ZZZ'
"""

# fixed values: the currency reference list (code, Russian name, English name);
# EUR is listed twice on purpose (the smaller name pair wins).
CURRENCY_ROWS = [
    ("USD", "Доллар США", "US dollar"),
    ("EUR", "Евро", "Euro"),
    ("RUB", "Рубль", "Russian ruble"),
    ("EUR", "Евро", "Euro (2)"),
]

TABLES = ("orders", "lineitem", "customer")


def render_duckdb(template: str) -> str:
    """The fixture text with DuckDB's pre-registered table names."""
    text = template.replace("{TS}", "timestamp")
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text


def _spark(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    text = template.replace("{TS}", "timestamp_ntz")
    args = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
            for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **args)


def stg_case(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    """Staging cases; batch 1 and 3 are the base export, batch 2 the edited one."""
    return _spark(spark, sf_dir, CASE_BATCH2_SQL if batch == 2 else CASE_SQL)


def stg_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging requests of all three batches; column ``batch`` tells which."""
    return _spark(spark, sf_dir, REQUEST_SQL)


def stg_address(spark: SparkSession, sf_dir: str, batch: int = 1) -> DataFrame:
    return _spark(spark, sf_dir, ADDRESS_BATCH2_SQL if batch == 2 else ADDRESS_SQL)


def stg_rso_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark(spark, sf_dir, PLAN_SQL)


def listed_currencies(spark: SparkSession) -> DataFrame:
    """A small list with a repeated code, for tests."""
    return spark.createDataFrame(CURRENCY_ROWS, specs.CURRENCY_SCHEMA)


#: Customers on one page of the pages that grow with the data.
PAGE_ROWS = 50


def nation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One HTML page per region built from ``nation`` (the currency list's source)."""
    from pyspark.sql import functions as F
    key = F.col("n_nationkey")
    return _pages(spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        F.col("n_regionkey").cast("long").alias("page_id"), key.alias("key"),
        F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0")).alias("code"), F.col("n_name").alias("name")))


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One HTML page per ``PAGE_ROWS`` customers: pages that grow with the data."""
    from pyspark.sql import functions as F
    key = F.col("c_custkey")
    return _pages(spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.expr(f"c_custkey div {PAGE_ROWS}").cast("long").alias("page_id"), key.alias("key"),
        F.concat(F.lit("C"), F.lpad(key.cast("string"), 9, "0")).alias("code"), F.col("c_name").alias("name")))


def _pages(rows: DataFrame) -> DataFrame:
    """HTML pages of (page_id, key, code, name); the driver's own pages have no tables.

    Table 1: code, number and English name with a citation marker, without any
    end tags of cells and rows, the code as a row header. Table 2: a two-level
    header over code, local and short name and a note, with spans; every fifth
    row has a nested table in its note; last a row without information.
    """
    from pyspark.sql import functions as F
    key, code = F.col("key").cast("string"), F.col("code")
    row1 = F.concat(F.lit("<tr><th scope=row>"), code, F.lit("<td>"), key, F.lit("<td>"), F.col("name"),
                    F.lit(" ["), key, F.lit("]\n"))
    note = F.when(F.col("key") % 5 == 0,
                  F.concat(F.lit("see <table><tr><td>inner "), code, F.lit("</td></tr></table>below"))) \
        .otherwise(F.lit("-"))
    row2 = F.concat(F.lit("<tr><td>"), code, F.lit("</td><td>"), F.lower("name"), F.lit("</td><td>"),
                    F.lower("name").substr(1, 3), F.lit("</td><td>"), note, F.lit("</td></tr>"))
    # one page is one document: its few rows are gathered by key order
    pages = rows.select("page_id", "key", row1.alias("r1"), row2.alias("r2")).groupBy("page_id").agg(
        F.array_sort(F.collect_list(F.struct("key", "r1", "r2"))).alias("rs"))
    html = F.concat(
        F.lit("<html><body><h1>Page "), F.col("page_id").cast("string"), F.lit("</h1>"),
        F.lit("<table><tr><th>Code<th>Num<th>Name"),
        F.array_join(F.col("rs.r1"), ""), F.lit("</table><p>Notes &amp; more</p>"),
        F.lit("<table><thead><tr><th rowspan=2>Code</th><th colspan=2>Names</th><th rowspan=2>Note</th></tr>"
              "<tr><th>Local</th><th>Short</th></tr></thead><tbody>"),
        F.array_join(F.col("rs.r2"), ""), F.lit("<tr><td colspan=4></td></tr></table>"),
        F.lit("</body></html>"))
    return pages.select("page_id", html.alias("html"))


# Batch 4 of the requests re-delivers them with edits: every tenth became of an
# excluded type (its fact row must stay as it was), every tenth has another
# type and more nights, every tenth comes under a second prefix that shares
# the fact key of the old one and changed later, and every tenth has codes that no
# dimension has yet.
REQUEST_BATCH4_SQL = f"""
select case when k%10=3 then 'Perhaps' else act end as act, actual_response_date,
  case when k%10=3 then 'late.comer' else assigned_to_agent end as assigned_to_agent, booking_channel,
  closed_issue_date, commission_charged,
  case when k%10=3 then 'ARS' else commission_currency end as commission_currency, confirmation_num,
  credit_card_brand, customer_promise_date, case when k%10=3 then 'ITA-Rome' else event_city end as event_city,
  event_city_other, case when k%10=3 then 'SMR' else event_country end as event_country, event_end_date_time,
  event_start_date_time, follow_up_method, fulfillment_method, fulfillment_outcome,
  case when k%10=2 then 'GLC' || substr(global_request_number,4) else global_request_number end
       as global_request_number,
  hotel_chain, iata_provided, issue_added_by_user_code, issue_date_added,
  issue_date_changed + interval '1' day as issue_date_changed,
  issue_status, case when k%10=1 then nights+10 else nights end as nights,
  number_of_adults, number_of_children, popular_booking_channel, popular_service_provider,
  reporting_amount, reporting_currency, request_active_or_not_active,
  case when k%10=2 then 'later prefix' else request_details end as request_details,
  request_subtype,
  case when k%10=0 then 'O OTHER' when k%10=1 then 'I EVENT' else request_type end as request_type,
  case when k%10=1 then 'O OTHER' else rso_uptake end as rso_uptake,
  service_provider, service_type, situation, stars, vendor_contact
from (select r.*, cast(substr(global_request_number,7,7) as bigint) as k from ({REQUEST_SQL}) r) x
where batch = 1 and k%10 < 4
"""

# Batch 4 of the cases: every tenth gets another status and agent, and every
# tenth comes under a second prefix that shares its fact key.
CASE_BATCH4_SQL = f"""
select case_date_added, case_address_id,
  case_date_changed + interval '2' day as case_date_changed,
  case when k%10=1 then 'Closed' when k%10=3 then 'Escalated' else case_status end as case_status,
  client, closed_case_date, contact_method, contact_source, current_location,
  case when k%10=2 then 'later prefix' else current_phone end as current_phone,
  department,
  case when k%10=2 then 'GLC' || substr(global_case_number,4) else global_case_number end
       as global_case_number,
  initial_agent, received_date,
  case when k%10=1 then 'zoe.king' else responsible_agent end as responsible_agent
from (select c.*, cast(substr(global_case_number,7) as bigint) as k from ({CASE_SQL}) c) x
where k%10 < 4
"""

BATCH_TS[4] = "2002-01-04 00:00:00"


def stg_request_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark(spark, sf_dir, REQUEST_BATCH4_SQL)


def stg_case_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark(spark, sf_dir, CASE_BATCH4_SQL)


def nation_workbooks(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Write one workbook per region from ``nation`` (a table of fixed size); returns their glob.

    Sheet 'Notes' comes first in every workbook, 'Nations' second. The first
    two regions' sheets have no region column.
    """
    from .ingest import write_xlsx_bytes
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    by_region: dict[int, list] = {}
    for r in spark.read.parquet(f"{sf_dir}/nation.parquet").collect():
        by_region.setdefault(r["n_regionkey"], []).append(r)
    for region, nations in by_region.items():
        head = ["Nation Key", "Nation/Name", "Is Even"] + (["Region Key"] if region > 1 else [])
        body = [[r["n_nationkey"], r["n_name"], r["n_nationkey"] % 2 == 0]
                + ([region] if region > 1 else []) for r in nations]
        data = write_xlsx_bytes(None, None, sheets={"Notes": [["Note"], ["none"]], "Nations": [head, *body]})
        path = hadoop.Path(f"{folder}/region{region}.xlsx")
        out = path.getFileSystem(conf).create(path, True)
        out.write(bytearray(data))
        out.close()
    return f"{folder}/*.xlsx"

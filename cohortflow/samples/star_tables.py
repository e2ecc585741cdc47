"""The five raw tables, derived from the star-schema tables.

Customers become patients, orders encounters, and every line item a condition, a
medication and an observation. The text below runs in Spark and in ANSI engines
alike, so both sides of a check start from the same rows. It plants what the
models must cope with: missing stops, codes and names, encounters without a
patient, encounters observed under two patients, text that is not a number, measures
a hair above a threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2001-09-01"

# {ntz} is the engine's name for a timestamp without zone.
RAW_SQL = {
    "raw_patients": """
select concat('pt-', cast(c_custkey as string)) as id,
  DATE '1930-01-01' + cast(c_custkey * 7919 % 20000 as int) as birthdate,
  case when c_custkey % 20 = 7 then DATE '1998-01-01' + cast(c_custkey % 1000 as int) end as deathdate,
  concat('999-', cast(c_custkey as string)) as ssn,
  case c_custkey % 4 when 0 then 'JAMES' when 1 then 'mary-ANN' when 2 then 'd''arcy' else 'Linda' end as first,
  case when c_custkey % 97 = 0 then null else concat('o''', lower(c_mktsegment)) end as last,
  case c_custkey % 3 when 0 then 'M' when 1 then 'S' end as marital,
  concat('race ', cast(c_nationkey % 5 as string)) as race,
  case when c_nationkey < 12 then 'nonhispanic' else 'hispanic' end as ethnicity,
  case c_custkey % 2 when 0 then 'M' else 'F' end as gender,
  concat(lower(c_mktsegment), ' town, "', cast(c_nationkey as string), '"') as city,
  concat('state ', cast(c_nationkey as string)) as state,
  lpad(cast(c_custkey % 100000 as string), 5, '0') as zip,
  cast(concat('42.', lpad(cast(c_custkey * 37 % 1000000 as string), 6, '0')) as decimal(9,6)) as lat,
  cast(concat('-71.', lpad(cast(c_custkey * 53 % 1000000 as string), 6, '0')) as decimal(9,6)) as lon,
  cast(c_acctbal as decimal(18,2)) as healthcare_expenses,
  cast(cast(c_acctbal as decimal(18,2)) * 0.5 as decimal(18,3)) as healthcare_coverage,
  cast('2001-08-31 02:00:00' as {ntz}) as loaded_at
from {customer}""",
    "raw_encounters": """
select concat('enc-', cast(o_orderkey as string)) as id,
  o_orderdate + INTERVAL '1' MINUTE * (o_orderkey % 1440) as start,
  o_orderdate + INTERVAL '1' MINUTE * (o_orderkey % 1440 + 15 + o_orderkey % 286) as stop,
  case when o_orderkey % 211 = 5 then null else concat('pt-', cast(o_custkey as string)) end as patient,
  concat('org-', cast(o_custkey % 50 as string)) as organization,
  concat('prov-', cast(o_orderkey % 400 as string)) as provider,
  concat('payer-', cast(o_custkey % 9 as string)) as payer,
  o_orderpriority as encounterclass,
  cast(185349000 + o_orderkey % 7 as string) as code,
  concat('Encounter ', lower(o_orderpriority)) as description,
  cast(cast(o_totalprice as decimal(18,2)) * 0.1 as decimal(18,3)) as base_encounter_cost,
  cast(o_totalprice as decimal(18,2)) as total_claim_cost,
  case when o_orderkey % 50 = 0 then null
       else cast(cast(o_totalprice as decimal(18,2)) * 0.5 as decimal(18,3)) end as payer_coverage,
  case when o_orderstatus = 'O' then null else o_orderstatus end as reasoncode,
  case o_orderstatus when 'F' then 'follow-up' when 'P' then 'pending' end as reasondescription,
  cast('2001-08-31 02:00:00' as {ntz}) as loaded_at
from {orders}""",
    "raw_conditions": """
select cast(l_shipdate as date) as start,
  case when l_returnflag = 'A' then null else cast(l_shipdate as date) + 90 end as stop,
  concat('pt-', cast(o_custkey as string)) as patient,
  concat('enc-', cast(l_orderkey as string)) as encounter,
  case when l_partkey % 37 = 1 then null else cast(l_partkey % 10 as string) end as code,
  concat('cond ', cast(l_partkey % 12 as string)) as description
from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "raw_observations": """
select date, patient, encounter, code, coalesce(fine, value) as value from (
select l_shipdate as date,
  case when l_suppkey % 40 = 3 then concat('pt-', cast(l_suppkey as string))
       else concat('pt-', cast(o_custkey as string)) end as patient,
  concat('enc-', cast(l_orderkey as string)) as encounter,
  case l_linenumber when 1 then '55284-4' when 2 then '8462-4' when 3 then '39156-5'
                    when 4 then '2339-0' when 5 then '8867-4' when 6 then '8310-5' else 'text' end as code,
  case when l_linenumber = 3 and l_orderkey % 61 = 9 then '40.00004'
       when l_linenumber = 4 and l_orderkey % 67 = 5 then '300.0000000001' end as fine,
  case l_linenumber when 3 then cast(cast(18 + l_quantity * 0.5 as decimal(10,1)) as string)
                    when 4 then cast(cast(70 + l_quantity * 6 as int) as string)
                    when 7 then 'n/a' else cast(cast(80 + l_quantity * 2 as int) as string) end as value
from {lineitem} join {orders} on l_orderkey = o_orderkey) measured""",
    "raw_medications": """
select cast(cast(l_shipdate as date) as string) as start,
  case when l_discount > 0.03 then cast(cast(l_shipdate as date) + 400 as string) end as stop,
  concat('pt-', cast(o_custkey as string)) as patient,
  case when l_quantity = 13 then null else p_name end as description
from {lineitem} join {orders} on l_orderkey = o_orderkey join {part} on p_partkey = l_partkey""",
    # Scorer answers of every kind, one per patient: usable, misshapen, not JSON at all.
    "raw_responses": """
select concat('pt-', cast(c_custkey as string)) as patient_id,
  case c_custkey % 13
    when 0 then 'no JSON here {{'
    when 1 then concat('{"risk_score": 2, "risk_label": "', c_mktsegment, '"}')
    when 2 then concat('{"risk_score": "', cast(c_nationkey as string), '", "risk_label": "LOW", "summary": null}')
    when 3 then concat('{"risk_score": ', cast(c_nationkey as string), '.5, "risk_label": 7, "summary": "half"}')
    when 4 then concat('{"risk_score": 1, "risk_label": "LOW", "summary": "', c_name, '"} and more')
    when 5 then '[1, 2, 3]'
    when 6 then '{"risk_score": true, "risk_label": "LOW", "summary": "flag"}'
    when 7 then '{"risk_score": null, "risk_label": "LOW", "summary": "no score"}'
    when 8 then '{"risk_score": 99999999999, "risk_label": "LOW", "summary": "too big"}'
    when 9 then '{"risk_score": "4.5", "risk_label": "LOW", "summary": "text score"}'
    else concat(' {"risk_score": ', cast(c_nationkey % 5 + 1 as string), ', "risk_label": "', c_mktsegment,
                '", "summary": "Patient ', c_name, ' at ', cast(c_nationkey as string), '."} ')
  end as raw_response,
  case when c_custkey % 29 = 4 then 'Timeout: no answer' end as scorer_error,
  'sample' as model_used,
  cast(40 + c_nationkey as int) as prompt_tokens,
  cast(c_custkey % 7 as int) as completion_tokens
from {customer}""",
}
STAR_TABLES = ("customer", "orders", "lineitem", "part")


def _filled(name: str, ntz: str, tables: dict[str, str]) -> str:
    text = RAW_SQL[name].replace("{ntz}", ntz)
    for table, source in tables.items():
        text = text.replace("{" + table + "}", source)
    return text


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw table as a DataFrame over the parquet files in sf_dir."""
    text = _filled(name, "timestamp_ntz", {})
    views = {table: f"_star_{table}" for table in STAR_TABLES if "{" + table + "}" in text}
    for table, view in views.items():
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(view)
    return spark.sql(_filled(name, "timestamp_ntz", views))


def raw_cte(name: str) -> str:
    """The same table as a common table expression for the checking engine."""
    return f"{name} as ({_filled(name, 'timestamp', {t: t for t in STAR_TABLES})})"

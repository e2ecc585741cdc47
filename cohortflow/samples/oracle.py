"""The same results in plain SQL for an independent engine.

Written as the definitions read (window functions, ordered string aggregation,
joins before ranking), not as the Spark plans are built. Each query pulls in the
table expressions it needs.
"""

from __future__ import annotations

import re

from cohortflow.samples.star_tables import RAW_SQL, raw_cte

# Fixed values, written out here and not taken from the engine: a change there must show.
TODAY = "DATE '2001-09-01'"
LOADED_BEFORE = "1996-01-01"
TRIAGED_CLASS = "1-URGENT"
SAMPLE_SEED = "7"
VITALS = {
    "55284-4": "systolic_bp",
    "8462-4": "diastolic_bp",
    "39156-5": "bmi",
    "2339-0": "glucose_mgdl",
    "8867-4": "heart_rate",
    "8310-5": "body_temp_c",
}
CANDIDATE_COLUMNS = [
    "patient_id", "full_name", "age", "gender", "active_conditions", "current_medications",
    "recent_encounter_type", "days_since_last_encounter", "latest_systolic_bp", "latest_diastolic_bp",
    "latest_bmi", "latest_glucose",
]
# Table, column, rule.
RUN_CHECKS = [
    ("raw_patients", "id", "unique"),
    ("raw_patients", "id", "not_null"),
    ("raw_encounters", "id", "unique"),
    ("raw_encounters", "id", "not_null"),
    ("raw_encounters", "patient", "not_null"),
    ("stg_patients", "patient_id", "unique"),
    ("stg_patients", "patient_id", "not_null"),
    ("stg_patients", "age", "not_null"),
    ("stg_patients", "age", ">= 0"),
    ("stg_encounters", "encounter_id", "unique"),
    ("stg_encounters", "encounter_id", "not_null"),
    ("stg_encounters", "patient_id", "not_null"),
    ("dim_patients", "patient_id", "unique"),
    ("dim_patients", "patient_id", "not_null"),
    ("dim_patients", "total_encounters", ">= 0"),
    ("fct_clinical_events", "event_id", "unique"),
    ("fct_clinical_events", "event_id", "not_null"),
    ("fct_clinical_events", "encounter_id", "not_null"),
    ("high_risk_flag", "patient_id", "unique"),
    ("high_risk_flag", "patient_id", "not_null"),
]


def _title(text: str) -> str:
    runs = rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+')"
    return f"array_to_string(list_transform({runs}, lambda x: upper(x[1]) || x[2:]), '')"


def _plain(number: str) -> str:
    return f"coalesce(cast(cast({number} as double) as varchar), 'None')"


RISK_TESTS = [
    "active_condition_count >= 3",
    "latest_systolic_bp > 160",
    "latest_glucose > 300",
    "latest_bmi > 40",
    "(days_since_last_encounter > 365 and active_condition_count >= 1)",
]

# What counts as white space around a response.
_SPACE = (
    r"\x{9}\x{a}\x{b}\x{c}\x{d}\x{1c}\x{1d}\x{1e}\x{1f}\x{20}\x{85}\x{a0}\x{1680}\x{2000}\x{2001}\x{2002}\x{2003}"
    r"\x{2004}\x{2005}\x{2006}\x{2007}\x{2008}\x{2009}\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

CTES = {
    "stg_patients": rf"""
select id as patient_id, lower(first) as first_name, lower(last) as last_name,
  {_title("first")} || ' ' || {_title("last")} as full_name,
  birthdate, deathdate,
  cast(extract(year from age(cast(coalesce(deathdate, {TODAY}) as timestamp),
                             cast(birthdate as timestamp))) as int) as age,
  gender, race, ethnicity, marital, city, state, zip, lat, lon,
  healthcare_expenses, healthcare_coverage, deathdate is not null as is_deceased, loaded_at
from raw_patients where id is not null""",
    "stg_encounters": """
select id as encounter_id, patient as patient_id, organization, provider, payer,
  encounterclass as encounter_class, code as encounter_code, description as encounter_description,
  reasoncode, reasondescription, start as encounter_start, stop as encounter_stop,
  epoch_us(stop - start) / 60000000.0::double as duration_minutes,
  base_encounter_cost, total_claim_cost, payer_coverage,
  total_claim_cost - payer_coverage as patient_out_of_pocket, loaded_at
from raw_encounters where id is not null and patient is not null and start is not null""",
    "encounter_stats": """
select patient_id, count(*) as total_encounters, max(encounter_start) as last_encounter_at,
  min(encounter_start) as first_encounter_at, sum(total_claim_cost) as total_claim_cost,
  sum(patient_out_of_pocket) as total_out_of_pocket
from stg_encounters group by patient_id""",
    "dim_patients": f"""
select p.patient_id, full_name, first_name, last_name, birthdate, deathdate, age, gender, race,
  ethnicity, marital, city, state, zip, lat, lon, is_deceased, healthcare_expenses, healthcare_coverage,
  coalesce(total_encounters, 0) as total_encounters, last_encounter_at, first_encounter_at,
  cast({TODAY} - cast(last_encounter_at as date) as int) as days_since_last_encounter,
  coalesce(total_claim_cost, 0) as total_claim_cost,
  coalesce(total_out_of_pocket, 0) as total_out_of_pocket
from stg_patients p left join encounter_stats e on p.patient_id = e.patient_id""",
    "conditions_distinct": """
select distinct encounter as encounter_id, patient as patient_id, start as condition_start,
  stop as condition_stop, code as condition_code, description as condition_description,
  stop is null as is_active
from raw_conditions""",
    "observations_wide": "\nselect encounter as encounter_id, patient as patient_id, "
    + ", ".join(
        f"max(case when code = '{code}' then cast(value as decimal(38,10)) end) as {name}"
        for code, name in VITALS.items()
    )
    + "\nfrom raw_observations group by 1, 2",
    "fct_ranked": f"""
select md5(e.encounter_id) as event_id, e.encounter_id, e.patient_id, encounter_start, encounter_stop,
  encounter_class, encounter_description, reasondescription, total_claim_cost, patient_out_of_pocket,
  condition_code, condition_description, coalesce(is_active, false) as condition_is_active,
  {", ".join(VITALS.values())},
  row_number() over (partition by e.encounter_id
    order by condition_code nulls last, condition_description nulls last, condition_start nulls last,
             condition_stop nulls last, o.patient_id nulls last) as rn
from stg_encounters e
left join conditions_distinct c on c.encounter_id = e.encounter_id
left join observations_wide o on o.encounter_id = e.encounter_id""",
    "fct_clinical_events": "\nselect * exclude (rn) from fct_ranked where rn = 1",
    "active_conditions": """
select patient_id, count(distinct condition_code) as active_condition_count,
  string_agg(distinct condition_description, '; ' order by condition_description) as active_conditions
from fct_clinical_events where condition_is_active group by patient_id""",
    "latest_vitals": """
select patient_id, systolic_bp as latest_systolic_bp, diastolic_bp as latest_diastolic_bp,
  bmi as latest_bmi, glucose_mgdl as latest_glucose, encounter_start as vitals_recorded_at
from (select *, row_number() over (partition by patient_id
        order by encounter_start desc nulls first, encounter_id desc) as k
      from fct_clinical_events
      where systolic_bp is not null or bmi is not null or glucose_mgdl is not null)
where k = 1""",
    "latest_encounter": """
select patient_id, encounter_class as recent_encounter_type, encounter_start as last_encounter_at
from (select *, row_number() over (partition by patient_id
        order by encounter_start desc nulls first, encounter_id desc) as k
      from fct_clinical_events)
where k = 1""",
    "current_medications": f"""
select patient as patient_id,
  string_agg(description, '; ' order by start desc nulls first, description)
    filter (where stop is null or stop > cast({TODAY} as varchar)) as current_medications
from raw_medications group by patient""",
    "risk_flags": f"""
select p.patient_id, full_name, age, gender, is_deceased, days_since_last_encounter,
  active_condition_count, active_conditions, latest_systolic_bp, latest_diastolic_bp, latest_bmi,
  latest_glucose, recent_encounter_type, current_medications,
  coalesce(list_bool_or([{", ".join(RISK_TESTS)}]), false) as is_high_risk
from dim_patients p
left join active_conditions a on a.patient_id = p.patient_id
left join latest_vitals v on v.patient_id = p.patient_id
left join latest_encounter l on l.patient_id = p.patient_id
left join current_medications m on m.patient_id = p.patient_id
where is_deceased = false""",
    "high_risk_flag": "\nselect * from risk_flags where is_high_risk",
    "done": f"""
select patient_id from (select *, row_number() over (partition by patient_id
        order by encounter_start desc, encounter_id desc) as k from stg_encounters)
where k = 1 and encounter_class = '{TRIAGED_CLASS}'""",
    "candidates": f"""
select {", ".join(CANDIDATE_COLUMNS)} from high_risk_flag
order by age desc nulls first, patient_id limit 50""",
    "prompts": f"""
select patient_id, 'Patient profile:' || chr(10)
  || '- Name: ' || coalesce(full_name, 'None') || chr(10)
  || '- Age: ' || coalesce(cast(age as varchar), 'None') || ' | Gender: ' || coalesce(gender, 'None') || chr(10)
  || '- Active conditions: ' || coalesce(nullif(active_conditions, ''), 'None documented') || chr(10)
  || '- Current medications: ' || coalesce(nullif(current_medications, ''), 'None documented') || chr(10)
  || '- Recent encounter type: ' || coalesce(recent_encounter_type, 'None') || chr(10)
  || '- Days since last encounter: ' || coalesce(cast(days_since_last_encounter as varchar), 'None') || chr(10)
  || chr(10) || 'Latest vitals:' || chr(10)
  || '- Blood pressure: ' || {_plain("latest_systolic_bp")} || '/' || {_plain("latest_diastolic_bp")} || ' mmHg' || chr(10)
  || '- BMI: ' || {_plain("latest_bmi")} || chr(10)
  || '- Glucose: ' || {_plain("latest_glucose")} || ' mg/dL' || chr(10)
  || chr(10) || 'Provide a clinical triage assessment.' || chr(10) as prompt
from high_risk_flag""",
    "met": """
select h.patient_id, prompt,
  coalesce(cast(latest_systolic_bp > 160 as int), 0) + coalesce(cast(latest_glucose > 300 as int), 0)
  + coalesce(cast(latest_bmi > 40 as int), 0)
  + cast(len(string_split(coalesce(active_conditions, ''), '; ')) >= 3 as int) as n
from high_risk_flag h join prompts p on p.patient_id = h.patient_id""",
    "scored": r"""
select patient_id, prompt, n,
  '{"risk_score": ' || (n + 1) || ', "risk_label": "'
    || ['LOW', 'MODERATE', 'HIGH', 'VERY HIGH', 'CRITICAL'][n + 1]
    || '", "summary": "' || n || ' of 4 rules met."}' as raw_response,
  'rules' as model_used,
  cast(len(regexp_extract_all(prompt, '\S+')) as int) as prompt_tokens,
  cast(len(regexp_extract_all(raw_response, '\S+')) as int) as completion_tokens,
  cast(null as varchar) as scorer_error
from met""",
    "documents_read": f"""
select *, regexp_replace(raw_response, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g') as body,
  case when json_valid(body) then json(body) end as j,
  json_type(j, '$.risk_score') as kind
from raw_responses""",
    "scores_read": r"""
select *, case
    when kind in ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE')
      then try_cast(round(try_cast(j->>'$.risk_score' as decimal(38,10)), 0) as int)
    when kind = 'VARCHAR' and regexp_full_match(trim(j->>'$.risk_score'), '[+-]?[0-9]+')
      then try_cast(j->>'$.risk_score' as int) end as score
from documents_read""",
    "parsed": """
select patient_id,
  case when problem is null then score end as risk_score,
  case when problem is null then j->>'$.risk_label' end as risk_label,
  case when problem is null then j->>'$.summary' end as summary,
  model_used, prompt_tokens, completion_tokens,
  case when problem is null and scorer_error is null then 'processed' else 'error' end as status,
  coalesce(scorer_error, problem) as problem
from (select *, case
        when j is null then 'response is not one JSON document'
        when json_type(j) <> 'OBJECT' then 'response is not a JSON object'
        when not (json_exists(j, '$.risk_score') and json_exists(j, '$.risk_label') and json_exists(j, '$.summary'))
          then 'response lacks a required key'
        when score is null and kind <> 'NULL' then 'risk_score is not an integer'
        when json_type(j, '$.risk_label') in ('OBJECT', 'ARRAY') or json_type(j, '$.summary') in ('OBJECT', 'ARRAY')
          then 'risk_label or summary is not a scalar' end as problem
      from scores_read)""",
}


def _with(body: str) -> str:
    """Put in front of body the table expressions it uses, directly or through others."""
    known = {**{name: raw_cte(name) for name in RAW_SQL}, **{n: f"{n} as ({t}\n)" for n, t in CTES.items()}}
    ordered: list[str] = []

    def visit(text: str, owner: str = "") -> None:
        for name in re.findall(r"\b[a-z_]+\b", text):
            if name in known and name != owner and name not in ordered:
                visit(known[name], name)
                ordered.append(name)

    visit(body)
    inner = body.startswith("with ")
    return "with " + ",\n".join(known[name] for name in ordered) + ("," + body[4:] if inner else "\n" + body)


def _as_doubles(table: str, *columns: str) -> str:
    casts = ", ".join(f"cast({c} as double) as {c}" for c in columns)
    return f"select * replace ({casts}) from {table}"


def _check(table: str, column: str, rule: str) -> str:
    if rule == "unique":
        failing = f"(select {column} from {table} where {column} is not null group by {column} having count(*) > 1)"
    elif rule == "not_null":
        failing = f"{table} where {column} is null"
    else:
        failing = f"{table} where not ({column} {rule})"
    return (
        f"select '{table}' as \"table\", '{column}' as \"column\", '{rule}' as \"check\", "
        f"count(*) as failures from {failing}"
    )


def _checks(checks: list[tuple[str, str, str]]) -> str:
    return "\nunion all ".join(_check(*c) for c in checks)


def _rules(keep, extra: list[tuple[str, str, str]]) -> str:
    return _checks([c for c in RUN_CHECKS if keep(c[2])] + extra)


_PATIENT_MONEY = ("lat", "lon", "healthcare_expenses", "healthcare_coverage")
_LATEST = ("latest_systolic_bp", "latest_diastolic_bp", "latest_bmi", "latest_glucose")
# Columns of the raw tables, and the types in which numbers are kept.
CSV_COLUMNS = {
    "patients": """id, birthdate, deathdate, ssn, first, last, marital, race, ethnicity, gender, city, state, zip,
        lat decimal(28,20), lon decimal(28,20), healthcare_expenses decimal(28,10),
        healthcare_coverage decimal(28,10), loaded_at""",
    "encounters": """id, start, stop, patient, organization, provider, payer, encounterclass, code, description,
        base_encounter_cost decimal(28,10), total_claim_cost decimal(28,10), payer_coverage decimal(28,10),
        reasoncode, reasondescription, loaded_at""",
    "conditions": "start, stop, patient, encounter, code, description",
    "observations": "date timestamp, patient, encounter, code, value",
    "medications": "start, stop, patient, description",
}
CSV_PLANTED = {
    "patients": ("id", "city"),
    "encounters": ("id", "description"),
    "conditions": ("encounter", "description"),
    "observations": ("encounter", "value"),
    "medications": ("patient", "description"),
}


def _lines(name: str, columns: str) -> str:
    """Every row as one text. The planted text is what the files held; an empty text reads as missing."""
    key, text = CSV_PLANTED[name]
    planted = (
        f"case length({key}) % 3 when 0 then 'a' || chr(10) || ', \"' || {text} || '\"' "
        f"when 1 then null else '\"' || {text} || chr(10) end"
    )
    parts = []
    for column in re.split(r",\s*(?![0-9])", columns):
        column, _, kind = column.strip().partition(" ")
        value = planted if column == text else column
        parts.append(f"coalesce(cast({f'cast({value} as {kind})' if kind else value} as varchar), '~')")
    return f"select '{name}' as name, {' || chr(124) || '.join(parts)} as line from raw_{name}"


# Table, naming column, column, rule: a run's checks and some that many rows fail.
ROW_KEYS = {
    "raw_patients": "id", "raw_encounters": "id", "raw_conditions": "encounter", "stg_patients": "patient_id",
    "stg_encounters": "encounter_id", "dim_patients": "patient_id", "fct_clinical_events": "event_id",
    "high_risk_flag": "patient_id",
}
FAILING_EXTRA = [
    ("raw_encounters", "patient", "unique"), ("raw_conditions", "code", "not_null"), ("stg_patients", "age", ">= 40"),
]


def _failing(table: str, column: str, rule: str) -> str:
    if rule == "unique":
        test = f"{column} in (select {column} from {table} group by {column} having count(*) > 1)"
    elif rule == "not_null":
        test = f"{column} is null"
    else:
        test = f"not ({column} {rule})"
    return (
        f"select '{table}' as \"table\", '{column}' as \"column\", '{rule}' as \"check\", "
        f"cast({ROW_KEYS[table]} as varchar) as row_key, cast({column} as varchar) as value from {table} where {test}"
    )


# Last digits of the ids in the first three loads.
LOADS = {1: "012", 2: "345", 3: "6789"}


def _loads(name: str) -> str:
    """What the four loads of a keyed table read, insert, skip and leave stored."""
    ends = {n: "right(id, 1) in (" + ", ".join(f"'{d}'" for d in digits) + ")" for n, digits in LOADS.items()}
    counts = [f"count(*) filter (where {rule}) as n{n}" for n, rule in ends.items()]
    counts += [f"count(*) filter (where id like '%{end}') as n{end}" for end in (77, 88)]
    lines = [(n, f"n{n}", f"n{n}", "0", " + ".join(f"n{i}" for i in range(1, n + 1))) for n in LOADS]
    lines.append((4, "n77 + n88", "n88", "n77", "n1 + n2 + n3 + n88"))
    return "\nunion all ".join(
        f"select '{name}' as name, {n} as load_number, {read} as read, {new} as inserted, "
        f"cast({old} as bigint) as skipped, {stored} as stored from (select {', '.join(counts)} from raw_{name})"
        for n, read, new, old, stored in lines
    )


def _framed(text: str) -> str:
    return f"coalesce(length({text}) || ':' || {text}, '-')"


_PICK = " union all ".join(f"select '{code}' as code" for code in VITALS)

BODIES = {
    "stg_patients": _as_doubles("stg_patients", *_PATIENT_MONEY),
    "stg_encounters": _as_doubles(
        "stg_encounters", "base_encounter_cost", "total_claim_cost", "payer_coverage", "patient_out_of_pocket"
    ),
    "encounter_stats": _as_doubles("encounter_stats", "total_claim_cost", "total_out_of_pocket"),
    "dim_patients": _as_doubles("dim_patients", *_PATIENT_MONEY, "total_claim_cost", "total_out_of_pocket"),
    "conditions_distinct": "select * from conditions_distinct",
    "observations_wide": _as_doubles("observations_wide", *VITALS.values()),
    "first_condition": """select encounter_id, condition_code, condition_description, is_active
from (select *, row_number() over (partition by encounter_id
        order by condition_code nulls last, condition_description nulls last,
                 condition_start nulls last, condition_stop nulls last) as k from conditions_distinct)
where k = 1""",
    "fct_clinical_events": _as_doubles(
        "fct_clinical_events", "total_claim_cost", "patient_out_of_pocket", *VITALS.values()
    ),
    "active_conditions": "select * from active_conditions",
    "latest_vitals": _as_doubles("latest_vitals", *_LATEST),
    "latest_encounter": "select * from latest_encounter",
    "current_medications": "select * from current_medications",
    "risk_rules": _as_doubles("risk_flags", *_LATEST),
    "high_risk_flag": _as_doubles("high_risk_flag", *_LATEST),
    "high_risk_from": _as_doubles("high_risk_flag", *_LATEST),
    "new_patients_only": f"""select id, birthdate, first, last from raw_patients
where id not in (select patient_id from stg_encounters where encounter_start < DATE '{LOADED_BEFORE}')""",
    "csv_roundtrip": "\nunion all ".join(_lines(*x) for x in CSV_COLUMNS.items()),
    "load_twice": " union all ".join(
        f"select '{name}' as name, count(*) as inserted, {again} as inserted_again, {skipped} as skipped, "
        f"{stored} as stored from raw_{name}"
        for name, again, skipped, stored in [
            ("patients", "0::bigint", "count(*)", "count(*)"),
            ("encounters", "0::bigint", "count(*)", "count(*)"),
            ("conditions", "count(*)", "0::bigint", "2 * count(*)"),
            ("observations", "count(*)", "0::bigint", "2 * count(*)"),
            ("medications", "count(*)", "0::bigint", "2 * count(*)"),
        ]
    ),
    "triage_candidates": _as_doubles("candidates", *_LATEST),
    "triage_pending": _as_doubles("candidates", *_LATEST)
    + " where patient_id not in (select patient_id from done)",
    "triage_skipped": _as_doubles("candidates", *_LATEST) + " where patient_id in (select patient_id from done)",
    "triage_prompts": "select * from prompts",
    "triage_parsed": "select * from parsed",
    "triage_scored": "select * exclude (n) from scored",
    "triage_day": """select patient_id, cast(n + 1 as int) as risk_score,
  ['LOW', 'MODERATE', 'HIGH', 'VERY HIGH', 'CRITICAL'][n + 1] as risk_label,
  n || ' of 4 rules met.' as summary, model_used, prompt_tokens, completion_tokens,
  'processed' as status, cast(null as varchar) as problem
from scored where patient_id in (select patient_id from candidates)
  and patient_id not in (select patient_id from done)""",
    "triage_log": f"""select patient_id, cast(n + 1 as int) as risk_score,
  ['LOW', 'MODERATE', 'HIGH', 'VERY HIGH', 'CRITICAL'][n + 1] as risk_label,
  n || ' of 4 rules met.' as summary, model_used, prompt_tokens, completion_tokens, {TODAY} as run_date,
  'Triage complete. Processed=' || count(*) over () || ', Skipped=0, Errors=0' as first_run,
  'Triage complete. Processed=0, Skipped=' || count(*) over () || ', Errors=0' as second_run
from scored where patient_id in (select patient_id from candidates)""",
    "triage_report": """select count(*) filter (where status = 'processed') as processed,
  count(*) filter (where status = 'skipped') as skipped, count(*) filter (where status = 'error') as errors
from (select case when d.patient_id is not null then 'skipped' else q.status end as status
      from high_risk_flag h left join done d on d.patient_id = h.patient_id
      left join parsed q on q.patient_id = h.patient_id)""",
    "triage_preview": """select patient_id, risk_score, risk_label from parsed
where status = 'processed' order by patient_id limit 10""",
    "quality_unique": _rules(
        lambda rule: rule == "unique",
        [("raw_encounters", "patient", "unique"), ("raw_conditions", "encounter", "unique")],
    ),
    "quality_not_null": _rules(
        lambda rule: rule == "not_null",
        [("raw_conditions", "code", "not_null"), ("fct_clinical_events", "bmi", "not_null")],
    ),
    "quality_expression": _rules(
        lambda rule: rule not in ("unique", "not_null"),
        [("stg_patients", "age", ">= 40"), ("stg_encounters", "patient_out_of_pocket", "> 1000")],
    ),
    "quality_report": _checks(RUN_CHECKS),
    "quality_log": """with logged as (
  select patient_id from parsed where status = 'processed'
  union all select patient_id from parsed where status = 'processed' and patient_id like '%3'
  union all select null from parsed where status = 'processed' and patient_id like '%7')
select 'triage_summaries' as "table", 'patient_id' as "column", 'not_null' as "check",
  count(*) filter (where patient_id is null) as failures from logged
union all select 'triage_summaries', 'run_date', 'not_null', 0::bigint
union all select 'triage_summaries', 'patient_id, run_date', 'unique', count(*)
from (select patient_id from logged where patient_id is not null group by patient_id having count(*) > 1)""",
    "hash_sample": f"""select id, patient, start from raw_encounters
where substr(md5('{SAMPLE_SEED}' || coalesce(patient, '')), 1, 8) < printf('%08x', cast(floor(0.6 * 4294967296) as bigint))""",
    "exact_sample": f"""select id, patient, start from (
  select *, count(*) over () as n, row_number() over (order by md5('{SAMPLE_SEED}' || coalesce(patient, '')),
    md5(coalesce(id, '~') || '|' || coalesce(patient, '~') || '|' || coalesce(cast(start as varchar), '~'))) as place
  from raw_encounters)
where place <= round(0.6 * n)""",
    "load_repeat_proof": " union all ".join(
        f"select '{name}' as name, count(*) as inserted, count(*) filter (where patient like '%7') as inserted_again, "
        f"count(*) as skipped, count(*) + count(*) filter (where patient like '%7') as stored from raw_{name}"
        for name in ("conditions", "observations", "medications")
    ),
    "load_indexed": "\nunion all ".join(_loads(name) for name in ("patients", "encounters")),
    "triage_resumed": f"""with keyed as (
  select *, sha256({_framed("patient_id")} || {_framed(f"cast({TODAY} as varchar)")} || {_framed("prompt")}) as answer_key,
    count(*) over () as total from scored),
numbered as (
  select *, ceil(total / 8.0) as batch_rows, cast('0x' || substr(answer_key, 1, 8) as bigint) as place from keyed)
select patient_id, answer_key, raw_response,
  case when place % cast(ceil(total / batch_rows) as bigint) < 3 then 'first' else 'second' end as model_used
from numbered""",
    "quality_failures": "\nunion all ".join(_failing(*c) for c in RUN_CHECKS + FAILING_EXTRA),
    "k_of_n": f"""select encounter, patient, code from (
  select e.id as encounter, e.patient, c.code,
    row_number() over (partition by e.id order by md5(c.code || coalesce(e.patient, '')), c.code) as place,
    2 + cast('0x' || substr(md5(coalesce(e.patient, '')), 1, 8) as bigint) % 5 as k
  from raw_encounters e, ({_PICK}) c)
where place <= k""",
}


def sql() -> dict[str, str]:
    return {name: _with(body) for name, body in BODIES.items()}

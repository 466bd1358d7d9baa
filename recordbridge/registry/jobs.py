"""The transfer jobs on the test tables.

The tables are given the shape of the source systems' tables (``events`` as answers,
``orders`` as sub-records and enrolments, ``lineitem`` as their answers and services,
``supplier`` as providers); the jobs themselves are those of ``plans``.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from ..functions import codes, dates
from ..operators import joins
from ..plans import assessments, clients, cohort, extract, helpers, import_tables, notes, services
from ..session import materialise
from ..sources import buckets
from ..sources.readers import literal_table
from .base import ORACLE, Tables, money, nullif, query
from .basics import CROSSWALK_SQL, crosswalk_tables, provider_table


def stamp(text: str):
    return F.lit(text).cast("timestamp_ntz")


# --- cohort and extract -----------------------------------------------------------


def entries(t: Tables):
    """Orders as enrolments; the priority digit is the provider, open orders have no exit."""
    return t.orders.select(
        F.col("o_orderkey").alias("entry_exit_id"), F.col("o_custkey").alias("client_id"),
        F.substring("o_orderpriority", 1, 1).cast("long").alias("provider_id"),
        F.col("o_orderdate").alias("entry_date"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.expr("INTERVAL 40 DAYS")).alias("exit_date"),
        (F.col("o_totalprice") > 50000).alias("active"),
    )


ENTRIES_SQL = """entries AS (SELECT o_orderkey AS entry_exit_id, o_custkey AS client_id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS provider_id,
  o_orderdate AS entry_date, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 40 DAY END AS exit_date, o_totalprice > 50000 AS active FROM orders)"""
COHORT_SQL = ENTRIES_SQL + """, cohort AS (SELECT DISTINCT client_id FROM entries WHERE active AND client_id NOT IN (5, 42) AND provider_id IN (1, 3)
  AND (exit_date IS NULL OR exit_date >= TIMESTAMP '2000-06-01') AND client_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))"""


def scope(t: Tables):
    """Providers 1 and 3, as the priorities that name them."""
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "3-MEDIUM")).select(
        F.substring("o_orderpriority", 1, 1).cast("long").alias("Legacy_ProgramID")
    ).distinct()


def cohort_of(t: Tables):
    people = t.customer.select(F.col("c_custkey").alias("client_id"), (F.col("c_acctbal") >= 0).alias("active"))
    return cohort.client_cohort(entries(t), scope(t), people, "2000-06-01", (5, 42))


@query("client_cohort", f"WITH {COHORT_SQL} SELECT client_id FROM cohort")
def client_cohort(t: Tables):
    return cohort_of(t)


@query("dump_projects", """
WITH p AS (SELECT c_custkey AS id, c_name AS name, c_acctbal > 0 AS active, CASE WHEN c_custkey % 20 = 0 THEN 5 WHEN c_custkey % 3 = 0 THEN 2999 WHEN c_custkey % 7 = 0 THEN 3000 ELSE c_custkey - c_custkey % 10 END AS agency FROM customer)
SELECT p.id AS "Legacy_ProgramID", CASE p.id WHEN 85 THEN 'Columbiana - Family Recovery Center - Fleming House - TH' WHEN 416 THEN 'zzScioto - Counseling Center - Transitional Living - TH' ELSE p.name END AS "Legacy_ProgramName",
 agency AS "Legacy_AgencyID", CASE agency WHEN 2999 THEN 'COORDINATED ENTRY - BoSCoC (OH-507)' WHEN 3000 THEN 'COORDINATED ENTRY - MCHCOC (OH-504)' ELSE c_name END AS "Legacy_AgencyName"
FROM p LEFT JOIN customer ON c_custkey = agency WHERE active""")
def dump_projects(t: Tables):
    k = F.col("c_custkey")
    agency = F.when(k % 3 == 0, 2999).when(k % 7 == 0, 3000).otherwise(k - k % 10)
    provider = t.customer.select(k.alias("provider_id"), F.col("c_name").alias("name"), (F.col("c_acctbal") > 0).alias("active"), agency.alias("hud_organization_id"))
    moves = t.customer.where("c_custkey % 20 = 0").select(k.alias("Legacy_ProgramID"), F.lit(5).cast("long").alias("correct_Legacy_AgencyID"))
    return cohort.dump_projects(provider, moves)


@query("household_move_in", """
WITH x AS (SELECT l_orderkey AS id, min(l_shipdate) AS moved, max(l_shipdate) AS gone FROM lineitem GROUP BY 1),
 e AS (SELECT o_orderkey AS id, o_custkey AS hh, o_orderdate AS entry, CASE WHEN o_orderstatus <> 'P' THEN moved END AS moved,
   least(coalesce(CASE WHEN o_orderstatus <> 'O' THEN gone END, TIMESTAMP '2001-06-01'), TIMESTAMP '2001-06-01') AS shut,
   CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 3 WHEN '2' THEN 9 WHEN '3' THEN 13 ELSE 1 END AS kind FROM orders LEFT JOIN x ON x.id = o_orderkey),
 v AS (SELECT hh, min(CASE WHEN kind IN (3, 9) AND entry < TIMESTAMP '1998-01-01' THEN entry WHEN kind IN (3, 9) AND entry <= moved AND moved < shut THEN moved
   WHEN kind = 13 AND moved BETWEEN entry AND shut THEN moved END) AS hm FROM e GROUP BY 1)
SELECT id AS "EnrollmentID", CAST(e.hh AS VARCHAR) AS "HouseholdID", strftime(entry, '%Y-%m-%d') AS "EntryDate",
 strftime(CASE WHEN hm <= shut THEN greatest(hm, entry) END, '%Y-%m-%d') AS "MoveInDate" FROM e JOIN v ON v.hh = e.hh""")
def household_move_in(t: Tables):
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    shipped = t.lineitem.groupBy(F.col("l_orderkey").alias("EnrollmentID")).agg(
        F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last")
    )
    enrolled = joins.ns_join(
        t.orders.select(
            F.col("o_orderkey").alias("EnrollmentID"), digit.alias("ProjectID"), F.col("o_custkey").cast("string").alias("HouseholdID"),
            F.col("o_orderdate").alias("EntryDate"), "o_orderstatus",
        ), shipped, "EnrollmentID", "left", nulls_match=False,
    )
    moved = F.when(F.col("o_orderstatus") != "P", F.col("first"))
    enrollment = enrolled.select("EnrollmentID", "ProjectID", "HouseholdID", "EntryDate", moved.alias("MoveInDate"))
    exits = enrolled.where("o_orderstatus <> 'O' AND last IS NOT NULL").select("EnrollmentID", F.col("last").alias("ExitDate"))
    kinds = codes.recode_literal(F.col("ProjectID"), {1: 3, 2: 9, 3: 13, 4: 1, 5: 1})
    project = t.orders.select(digit.alias("ProjectID")).distinct().select("ProjectID", kinds.alias("ProjectType"))
    out = extract.household_move_in(enrollment, exits, project, stamp("2001-06-01"), "1998-01-01")
    return out.select("EnrollmentID", "HouseholdID", *[dates.as_day_text(F.col(c)).alias(c) for c in ("EntryDate", "MoveInDate")])


@query("hud_names", """
SELECT p_partkey AS "ProjectID", s_name AS "ProjectName", n_name AS "ProjectCommonName", p_size AS "OrganizationID", p_type AS "TargetPopulation"
FROM part LEFT JOIN supplier ON s_suppkey = p_partkey LEFT JOIN nation ON n_nationkey = s_nationkey""")
def hud_names(t: Tables):
    project = t.part.select(
        F.col("p_partkey").alias("ProjectID"), F.col("p_name").alias("ProjectName"), F.col("p_brand").alias("ProjectCommonName"),
        F.col("p_size").alias("OrganizationID"), F.col("p_type").alias("TargetPopulation"),
    )
    organization = t.part.select(F.col("p_size").alias("OrganizationID"), F.col("p_type").alias("OrganizationName")).distinct()
    names = joins.left_chain(t.supplier, (t.nation, [("s_nationkey", "n_nationkey")])).select(
        F.col("s_suppkey").alias("ProjectID"), F.col("s_name").alias("ProjectName"), F.col("n_name").alias("ProjectAKA")
    )
    return extract.hud_names(project, organization, names)[0]


# --- assessments ------------------------------------------------------------------


def answers(t: Tables):
    """Events as answers: yes or no for clicks and views, a day for some sign-ups, a number for the rest."""
    two_days_before = F.date_format(F.col("ts") - F.expr("INTERVAL 2 DAYS"), "yyyy-MM-dd HH:mm:ss")
    yes_no = F.when(F.col("value") >= 10, "Y").otherwise("N")
    cents = F.round(F.col("value") * 100).cast("long").cast("string")
    return t.events.select(
        F.col("user_id").alias("client_id"), F.col("event_type").alias("question_code"),
        F.when(F.col("event_type").isin("click", "view"), yes_no).when((F.col("event_type") == "signup") & (F.col("value") >= 10), two_days_before).otherwise(cents).alias("val"),
        F.date_trunc("hour", "ts").alias("date_effective"), F.col("ts").alias("date_added"),
        (F.col("user_id") % 100).alias("provider_id"), (F.col("user_id") % 7).alias("user_id"), (F.col("value") > 1).alias("active"),
    )


ANSWERS_SQL = """answers AS (SELECT user_id AS client_id, event_type AS question_code,
  CASE WHEN event_type IN ('click', 'view') THEN CASE WHEN value >= 10 THEN 'Y' ELSE 'N' END
  WHEN event_type = 'signup' AND value >= 10 THEN strftime(ts - INTERVAL 2 DAY, '%Y-%m-%d %H:%M:%S') ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS val,
  date_trunc('hour', ts) AS date_effective, ts AS date_added, user_id % 100 AS provider_id, user_id % 7 AS user_id, value > 1 AS active FROM events)"""
PEOPLE_SQL = "people AS (SELECT c_custkey AS client_id FROM customer WHERE c_acctbal > 500)"


def people(t: Tables):
    return t.customer.where("c_acctbal > 500").select(F.col("c_custkey").alias("client_id"))


def agency_crosswalk(t: Tables):
    return t.supplier.where("s_acctbal > 2000").select(
        F.col("s_suppkey").alias("Legacy_ProgramID"), F.col("s_name").alias("Legacy_ProgramName"),
        (F.col("s_nationkey") + 100).alias("Target_AgencyID"),
    )


SCREENING = {
    "click": "c_symptom_click", "view": "c_covid19_risk_view", "error": "c_covid19_notes",
    "purchase": "c_covid19_test_date",
}
SCREENING_SQL = f"""{ANSWERS_SQL}, {PEOPLE_SQL},
 r AS (SELECT *, strftime(date_effective, '%Y-%m-%d') AS day, rank() OVER (PARTITION BY client_id, strftime(date_effective, '%Y-%m-%d'), provider_id, user_id
   ORDER BY date_effective DESC) AS i FROM answers WHERE active AND client_id IN (SELECT client_id FROM people)),
 w AS (SELECT client_id, day, provider_id, user_id, """ + ", ".join(f"max(CASE WHEN question_code = '{q}' THEN val END) AS {q}" for q in [*SCREENING, "signup"]) + """
   FROM r WHERE i = 1 GROUP BY ALL),
 screening AS (SELECT 178 AS "AssessmentID", 'COVID-19 Screening Tool' AS "AssessmentName", client_id AS "PersonalID",
   CASE WHEN s_acctbal > 2000 THEN s_nationkey + 100 ELSE 299 END AS "AgencyID", day AS "InformationDate", CASE WHEN contains(signup, '-') THEN substr(signup, 1, 10) END AS assessment_date, user_id AS "UserID",
   CASE click WHEN 'N' THEN 0 WHEN 'Y' THEN 1 END AS c_symptom_click, CASE "view" WHEN 'N' THEN 0 WHEN 'Y' THEN 1 END AS c_covid19_risk_view,
   error AS c_covid19_notes, purchase AS c_covid19_test_date
  FROM w LEFT JOIN supplier ON s_suppkey = provider_id)"""
SCREENING_SQL = SCREENING_SQL.replace(" AS view", ' AS "view"')


@query("covid_screening", f"""
WITH {SCREENING_SQL} SELECT row_number() OVER (ORDER BY "PersonalID", "InformationDate") AS "AssessmentCustomID", * FROM screening""")
def covid_screening(t: Tables):
    return assessments.covid_screening(answers(t), people(t), agency_crosswalk(t), SCREENING, date_question="signup")


CLIENT_QUESTIONS = {"click": "c_list", "error": "c_when", "purchase": "c_amount"}


@query("client_custom", f"""
WITH {ANSWERS_SQL}, {PEOPLE_SQL},
 r AS (SELECT *, rank() OVER (PARTITION BY client_id, question_code ORDER BY date_effective DESC, date_added DESC) AS i FROM answers
  WHERE active AND question_code IN ('click', 'error', 'purchase') AND client_id IN (SELECT client_id FROM people)),
 w AS (SELECT client_id, max(CASE WHEN question_code = 'click' AND i = 1 THEN val END) AS c_list, max(CASE WHEN question_code = 'purchase' AND i = 1 THEN val END) AS c_amount
  FROM r GROUP BY 1)
SELECT row_number() OVER (ORDER BY client_id) AS "ClientCustomID", client_id AS "PersonalID", 20210607 AS "ExportID",
 CASE c_list WHEN 'Y' THEN 1 WHEN 'N' THEN 8 END AS c_list, CAST(NULL AS VARCHAR) AS c_when, c_amount FROM w""")
def client_custom(t: Tables):
    return clients.client_custom(
        answers(t), people(t), dates.day("2021-06-07"), CLIENT_QUESTIONS, ["c_when"], {"c_list": {"Y": 1, "N": 8}}
    )


@query("client_custom_bucketed", ORACLE["client_custom"])
def client_custom_bucketed(t: Tables):
    """The same from answers and clients in buckets by client: nothing is shuffled before the ids."""
    kept = buckets.bucketed_dump(t.spark, {"answers": answers(t), "people": people(t)}, "client_id", 8)
    return clients.client_custom(
        kept["answers"], kept["people"], dates.day("2021-06-07"), CLIENT_QUESTIONS, ["c_when"], {"c_list": {"Y": 1, "N": 8}}
    )


@query("covid_screening_bucketed", ORACLE["covid_screening"])
def covid_screening_bucketed(t: Tables):
    kept = buckets.bucketed_dump(t.spark, {"answers": answers(t), "people": people(t)}, "client_id", 8)
    return assessments.covid_screening(kept["answers"], kept["people"], agency_crosswalk(t), SCREENING, date_question="signup")


@query("stray_answers", f"""
WITH {ANSWERS_SQL}, why AS (SELECT o_custkey AS client_id FROM orders WHERE o_orderstatus = 'P' INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 500),
 made AS (SELECT o_custkey AS client_id, min(o_orderdate) AS date_added FROM orders GROUP BY 1),
 r AS (SELECT *, rank() OVER (PARTITION BY client_id, question_code ORDER BY date_effective DESC, date_added DESC) AS i FROM answers
   WHERE active AND question_code IN ('click', 'error') AND client_id IN (SELECT client_id FROM why)),
 s AS (SELECT client_id, max(date_added) AS hi, min(date_added) AS lo FROM r WHERE i = 1 GROUP BY 1)
SELECT why.client_id, strftime(made.date_added, '%Y-%m-%d %H:%M:%S') AS date_added, strftime(hi, '%Y-%m-%d %H:%M:%S') AS max_added, strftime(lo, '%Y-%m-%d %H:%M:%S') AS min_added, CASE WHEN made.date_added >= TIMESTAMP '1996-01-10' THEN 'client created after file created' END AS created_why,
 CASE WHEN s.client_id IS NULL THEN NULL WHEN hi < TIMESTAMP '2024-01-20' OR lo >= TIMESTAMP '1996-01-10' THEN 'answers added before or after window' ELSE 'don''t know' END AS answer_why
FROM why LEFT JOIN made ON made.client_id = why.client_id LEFT JOIN s ON s.client_id = why.client_id""")
def stray_answers(t: Tables):
    strays = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("client_id"))
    made = t.orders.groupBy(F.col("o_custkey").alias("client_id")).agg(F.min("o_orderdate").alias("date_added"))
    out = clients.stray_answers(strays, people(t), made, answers(t), ["click", "error"], "1996-01-10", "2024-01-20")
    return out.withColumns({c: dates.as_time_text(F.col(c)) for c in ("date_added", "max_added", "min_added")})


def recordsets(t: Tables):
    """Orders as sub-records; the priority is the kind."""
    return t.orders.select(
        F.col("o_orderkey").alias("recordset_id"), F.col("o_custkey").alias("client_id"), F.col("o_orderpriority").alias("question"),
        (F.col("o_orderstatus") != "P").alias("active"), F.col("o_orderdate").alias("date_added"), F.col("o_orderdate").alias("date_effective"),
        (F.col("o_custkey") % 100).alias("provider_creating_id"), (F.col("o_custkey") % 7).alias("user_creating_id"),
    )


def recordset_answers(t: Tables, question, val):
    """Lines as answers to their order."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("recordset_id"), question.alias("question"), val.alias("val"), (F.col("l_discount") < 0.09).alias("active"),
        F.col("l_shipdate").alias("date_added"), F.lit(1).alias("provider_creating_id"),
        F.when(F.col("l_suppkey") < 50, 1).otherwise(2).alias("user_creating_id"),
    )


RECORDSETS_SQL = f"""{PEOPLE_SQL}, subs AS (SELECT o_orderkey AS rid, o_custkey AS client_id, o_orderpriority AS kind, o_orderdate AS added, o_custkey % 100 AS provider
  FROM orders WHERE o_orderstatus <> 'P' AND o_custkey IN (SELECT client_id FROM people)),
 lines AS (SELECT *, CASE WHEN l_suppkey < 50 THEN 1 ELSE 2 END AS usr, l_returnflag || l_linestatus AS flag FROM lineitem WHERE l_discount < 0.09)"""


def line_flag():
    return F.concat("l_returnflag", "l_linestatus")



def doses_val():
    q = F.col("l_quantity")
    maker = F.when(q < 15, "Moderna").when(q < 30, "Pfizer").otherwise("Unheard of")
    proof = F.when(q < 25, "Self-report").otherwise("Vaccine card")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    return F.when(line_flag() == "AF", maker).when(line_flag() == "AO", proof).when(line_flag() == "NF", day).otherwise(line_flag())


DOSES = {
    "AF": "c_covid19_vaccine_manufacturer", "AO": "c_covid19_vaccine_documentation",
    "NF": "c_covid19_date_vaccine_administered", "NO": "c_covid19_client_contact_info",
}
PIVOT_SQL = """a AS (SELECT l_orderkey AS rid, usr, flag, val, rank() OVER (PARTITION BY l_orderkey, flag ORDER BY l_shipdate DESC) AS i FROM vals WHERE flag IN ('AF', 'AO', 'NF', 'NO')),
 w AS (SELECT rid, usr, max(CASE flag WHEN 'AF' THEN val END) AS af, max(CASE flag WHEN 'AO' THEN val END) AS ao, max(CASE flag WHEN 'NF' THEN val END) AS nf,
  max(CASE flag WHEN 'NO' THEN val END) AS no_ FROM a WHERE i = 1 GROUP BY 1, 2)"""


def numbered_sql(rows: str, *order: str) -> str:
    """Rows with ids in an order that is ended by all that may differ; ``rid`` is left out."""
    return f"SELECT row_number() OVER (ORDER BY {', '.join(f'{c} NULLS LAST' for c in order)}) AS \"AssessmentCustomID\", * EXCLUDE (rid) FROM ({rows})"


DOSES_SQL = f"""
WITH {CROSSWALK_SQL}, {RECORDSETS_SQL},
 vals AS (SELECT *, CASE flag WHEN 'AF' THEN CASE WHEN l_quantity < 15 THEN 'Moderna' WHEN l_quantity < 30 THEN 'Pfizer' ELSE 'Unheard of' END
   WHEN 'AO' THEN CASE WHEN l_quantity < 25 THEN 'Self-report' ELSE 'Vaccine card' END WHEN 'NF' THEN strftime(l_shipdate, '%Y-%m-%d') ELSE flag END AS val FROM lines), {PIVOT_SQL},
 ag AS (SELECT DISTINCT "Legacy_AgencyID" AS la, "Target_AgencyID" AS ta FROM crosswalk),
 pa AS (SELECT provider_id, ta FROM provider LEFT JOIN ag ON la IS NOT DISTINCT FROM hud_organization_id)
SELECT subs.rid, 195 AS "AssessmentID", 'COVID-19 Vaccine Doses' AS "AssessmentName", client_id AS "PersonalID", ta AS "AgencyID", strftime(added, '%Y-%m-%d') AS "InformationDate",
 nf AS assessment_date, no_ AS c_covid19_client_contact_info, CASE af WHEN 'Moderna' THEN 2 WHEN 'Pfizer' THEN 3 END AS c_covid19_vaccine_manufacturer,
 CASE ao WHEN 'Self-report' THEN 2 WHEN 'Vaccine card' THEN 3 END AS c_covid19_vaccine_documentation
FROM subs LEFT JOIN w ON w.rid = subs.rid LEFT JOIN pa ON pa.provider_id = subs.provider WHERE kind = '1-URGENT'"""


@query("vaccine_doses", numbered_sql(DOSES_SQL, '"PersonalID"', '"InformationDate"', "rid", "assessment_date", "c_covid19_client_contact_info", "c_covid19_vaccine_manufacturer", "c_covid19_vaccine_documentation", '"AgencyID"'))
def vaccine_doses(t: Tables):
    return assessments.vaccine_doses(
        recordsets(t), recordset_answers(t, line_flag(), doses_val()), people(t), provider_table(t), crosswalk_tables(t)[0], "1-URGENT", DOSES
    )


def offers_val():
    q, day = F.col("l_quantity"), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    return (
        F.when(line_flag() == "AF", F.when(q < 25, "Y").otherwise("N"))
        .when(line_flag() == "AO", F.when(q < 15, "HUD VASH").when(q < 30, "Other RRH").otherwise("Unheard of"))
        .when(line_flag() == "NF", F.when(q < 25, day).otherwise("soon")).otherwise(day)
    )


OFFERS = {"AF": "c_offer_accepted", "AO": "c_offer_type", "NF": "offer_date", "NO": "c_offer_accept_decline_date"}


OFFERS_SQL = f"""
WITH {CROSSWALK_SQL}, {RECORDSETS_SQL},
 vals AS (SELECT *, CASE flag WHEN 'AF' THEN CASE WHEN l_quantity < 25 THEN 'Y' ELSE 'N' END
   WHEN 'AO' THEN CASE WHEN l_quantity < 15 THEN 'HUD VASH' WHEN l_quantity < 30 THEN 'Other RRH' ELSE 'Unheard of' END
   WHEN 'NF' THEN CASE WHEN l_quantity < 25 THEN strftime(l_shipdate, '%Y-%m-%d') ELSE 'soon' END ELSE strftime(l_shipdate, '%Y-%m-%d') END AS val FROM lines), {PIVOT_SQL},
 ag AS (SELECT DISTINCT "Legacy_AgencyID" AS la, "Target_AgencyID" AS ta FROM crosswalk),
 pa AS (SELECT provider_id, ta FROM provider LEFT JOIN ag ON la IS NOT DISTINCT FROM hud_organization_id)
SELECT subs.rid, 194 AS "AssessmentID", 'Offers of Permanent Housing' AS "AssessmentName", client_id AS "PersonalID", coalesce(ta, 299) AS "AgencyID",
 strftime(added, '%Y-%m-%d') AS "InformationDate", coalesce(nullif(nf, 'soon'), strftime(added, '%Y-%m-%d')) AS assessment_date,
 CASE ao WHEN 'HUD VASH' THEN 1 WHEN 'Other RRH' THEN 3 END AS c_offer_type, CASE af WHEN 'N' THEN 0 WHEN 'Y' THEN 1 END AS c_offer_accepted, no_ AS c_offer_accept_decline_date
FROM subs LEFT JOIN w ON w.rid = subs.rid LEFT JOIN pa ON pa.provider_id = subs.provider WHERE kind = '2-HIGH'"""


@query("housing_offers", numbered_sql(OFFERS_SQL, '"PersonalID"', '"InformationDate"', "rid", "assessment_date", "c_offer_type", "c_offer_accepted", "c_offer_accept_decline_date", '"AgencyID"'))
def housing_offers(t: Tables):
    return assessments.housing_offers(
        recordsets(t), recordset_answers(t, line_flag(), offers_val()), people(t), provider_table(t), crosswalk_tables(t)[0], "2-HIGH", OFFERS
    )


SCORES_SQL = f"""
WITH {RECORDSETS_SQL},
 starts AS (SELECT DISTINCT l_orderkey AS rid, l_shipdate AS d, CASE WHEN l_quantity > 45 THEN NULL ELSE l_shipdate END AS ok FROM lines WHERE l_returnflag = 'R'),
 dated AS (SELECT DISTINCT subs.rid, client_id, kind, added, provider, strftime(ok, '%Y-%m-%d') AS day FROM subs LEFT JOIN starts ON starts.rid = subs.rid WHERE kind IN ('3-MEDIUM', '5-LOW')),
 newest AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY client_id, day, kind ORDER BY added DESC) AS i FROM dated) WHERE i = 1 AND day IS NOT NULL),
 totals AS (SELECT rid, val FROM (SELECT l_orderkey AS rid, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS val, rank() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC) AS i FROM lines WHERE l_returnflag = 'A') WHERE i = 1)
SELECT newest.rid, 193 AS "AssessmentID", 'ServicePoint VI-SPDAT Assessment' AS "AssessmentName", client_id AS "PersonalID", CASE WHEN provider < 25 THEN 300 ELSE 299 END AS "AgencyID",
 day AS "InformationDate", day AS assessment_date, 1 AS assessment_type, 2 AS assessment_level, 0 AS assessment_location, CASE kind WHEN '3-MEDIUM' THEN 1 ELSE 3 END AS c_vispdat_type,
 CASE WHEN s_acctbal > 2000 THEN s_name END AS c_vispdat_program_name, val AS c_vispdat_score
FROM newest JOIN totals ON totals.rid = newest.rid LEFT JOIN supplier ON s_suppkey = provider"""


@query("vulnerability_scores", numbered_sql(SCORES_SQL, '"PersonalID"', '"InformationDate"', "rid", "c_vispdat_score", '"AgencyID"', "c_vispdat_type", "c_vispdat_program_name"))
def vulnerability_scores(t: Tables):
    return assessments.vulnerability_scores(
        recordsets(t), recordset_answers(t, F.col("l_returnflag"), scores_val()), people(t), agency_crosswalk(t), county_providers(t), SCORE_KINDS, "A", "R"
    )


SCORE_KINDS = {"3-MEDIUM": 1, "5-LOW": 3}


def scores_val():
    start = F.when(F.col("l_quantity") > 45, "unknown").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    return F.when(F.col("l_returnflag") == "R", start).otherwise(F.col("l_quantity").cast("long").cast("string"))


def county_providers(t: Tables):
    return t.nation.select(F.col("n_nationkey").cast("long").alias("provider_id"))


def answers_of_all_kinds(t: Tables):
    """Lines as answers in the form of their order's kind, as all kinds' answers lie in one table."""
    kind = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    scored = F.col("o_orderpriority").isin(*SCORE_KINDS)
    question = F.when(scored, F.col("l_returnflag")).otherwise(line_flag())
    val = F.when(F.col("o_orderpriority") == "1-URGENT", doses_val()).when(F.col("o_orderpriority") == "2-HIGH", offers_val()).when(scored, scores_val())
    lines = t.lineitem.join(kind, "l_orderkey").select("l_orderkey", "l_discount", "l_shipdate", "l_suppkey", question.alias("question"), val.alias("val"))
    return recordset_answers(SimpleNamespace(lineitem=lines), F.col("question"), F.col("val"))


ALL_KINDS = (
    "AssessmentID", "PersonalID", "InformationDate", "AgencyID", "UserID", "assessment_date", "c_covid19_client_contact_info", "c_covid19_notes", "c_covid19_risk_view", "c_covid19_test_date",
    "c_covid19_vaccine_documentation", "c_covid19_vaccine_manufacturer", "c_offer_accept_decline_date", "c_offer_accepted", "c_offer_type", "c_symptom_click", "c_vispdat_program_name", "c_vispdat_score", "c_vispdat_type",
)


@query("combined_assessments", f"""
WITH {SCREENING_SQL},
 u AS (SELECT * FROM screening UNION ALL BY NAME SELECT * EXCLUDE (rid) FROM ({DOSES_SQL}) UNION ALL BY NAME SELECT * EXCLUDE (rid) FROM ({OFFERS_SQL}) UNION ALL BY NAME SELECT * EXCLUDE (rid) FROM ({SCORES_SQL})),
 d AS (SELECT * REPLACE (CASE WHEN assessment_date IS NULL THEN "InformationDate" ELSE strftime(try_cast(assessment_date AS DATE), '%Y-%m-%d') END AS assessment_date, CAST(NULL AS VARCHAR) AS c_covid19_test_date) FROM u)
SELECT * FROM (SELECT row_number() OVER (ORDER BY {", ".join(f'"{c}" NULLS LAST' for c in ALL_KINDS)}) AS "AssessmentCustomID", * FROM d) WHERE "PersonalID" NOT IN (13, 14)""")
def combined_assessments(t: Tables):
    screening = assessments.covid_screening(answers(t), people(t), agency_crosswalk(t), SCREENING, numbered=False, date_question="signup")
    kinds = {
        assessments.DOSES: assessments.dose_kind("1-URGENT", DOSES), assessments.OFFERS: assessments.offer_kind("2-HIGH", OFFERS),
        assessments.SCORES: assessments.score_kind(SCORE_KINDS, "A", "R"),
    }
    # Written once, so that the answers are read once for all three kinds.
    rows = materialise(assessments.subrecords(recordsets(t), answers_of_all_kinds(t), people(t), kinds), "subrecords")
    doses, offers = (of(rows, provider_table(t), crosswalk_tables(t)[0], numbered=False) for of in (assessments.doses_of, assessments.offers_of))
    scores = assessments.scores_of(rows, agency_crosswalk(t), county_providers(t), SCORE_KINDS, numbered=False)
    return assessments.combined_assessments(screening, doses, offers, scores, order=ALL_KINDS, skip_clients=(13, 14))


# --- clients ----------------------------------------------------------------------


@query("enrollment_counties", """
WITH p AS (SELECT c_custkey AS pid, c_custkey AS eid, 41000 + c_nationkey AS d, 1 AS stage, 'NATION_' || (c_custkey % 30) AS served, nullif('NATION_' || c_nationkey, 'NATION_7') AS prior FROM customer
 UNION ALL SELECT s_suppkey, s_suppkey, 42000 + s_nationkey, 3, 'NATION_' || (s_suppkey % 30), nullif('NATION_' || s_nationkey, 'NATION_7') FROM supplier)
SELECT row_number() OVER (ORDER BY eid, stage) AS "EnrollmentCustomID", pid AS "PersonalID", eid AS "EnrollmentID", strftime(DATE '1899-12-30' + CAST(d AS INTEGER), '%Y-%m-%d') AS "InformationDate",
 stage AS "DataCollectionStage", 20210607 AS "ExportID", CASE WHEN served = 'NATION_3' THEN '0' ELSE CAST(a.n_nationkey AS VARCHAR) END AS c_county_served,
 CASE WHEN prior = 'NATION_3' THEN '0' ELSE CAST(b.n_nationkey AS VARCHAR) END AS c_county_prior
FROM p LEFT JOIN nation a ON a.n_name = served LEFT JOIN nation b ON b.n_name = prior""")
def enrollment_counties(t: Tables):
    def stage(df, key, nation, day, number):
        return df.select(
            F.col(key).alias("PersonalID"), F.col(key).alias("EnrollmentID"), (F.col(nation) + day).alias("InformationDate"), F.lit(number).alias("DataCollectionStage"),
            F.concat(F.lit("NATION_"), (F.col(key) % 30).cast("string")).alias("CountyServed"),
            F.nullif(F.concat(F.lit("NATION_"), F.col(nation).cast("string")), F.lit("NATION_7")).alias("CountyPrior"),
        )

    counties = t.nation.select(F.col("n_name").alias("County"), F.col("n_nationkey").alias("Geocode"))
    return clients.enrollment_counties(
        stage(t.customer, "c_custkey", "c_nationkey", 41000, 1), stage(t.supplier, "s_suppkey", "s_nationkey", 42000, 3),
        counties, dates.day("2021-06-07"), outside="NATION_3",
    )


FILE_FIXES = {7: 134, 12: 9}


@query("client_files", f"""
WITH {PEOPLE_SQL}, f AS (SELECT 'f' || l_partkey AS fid, o_custkey AS pid, l_suppkey AS prog, l_shipdate AS d, l_linenumber AS usr, l_returnflag AS fn, rank() OVER (PARTITION BY l_partkey ORDER BY o_custkey) AS i
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linestatus = 'O' AND l_shipdate >= TIMESTAMP '1997-06-01' AND o_custkey IN (SELECT client_id FROM people))
SELECT * FROM (SELECT fid AS "FileID", pid AS "PersonalID", CASE prog WHEN 7 THEN 134 WHEN 12 THEN 9 ELSE CASE WHEN s_acctbal > 2000 THEN s_nationkey + 100 END END AS "AgencyID",
 13 AS "Category", 'Other' AS "FileName", fn AS "OtherName", strftime(d, '%Y-%m-%d %H:%M:%S') AS "DateCreated", strftime(d, '%Y-%m-%d %H:%M:%S') AS "DateUpdated", usr AS "UserID", 20210607 AS "ExportID"
FROM f LEFT JOIN supplier ON s_suppkey = prog WHERE i = 1) WHERE "AgencyID" IS NOT NULL""")
def client_files(t: Tables):
    lines = joins.ns_join(t.lineitem, t.orders.select("o_orderkey", "o_custkey"), [("l_orderkey", "o_orderkey")], nulls_match=False)
    attached = lines.select(
        F.concat(F.lit("f"), F.col("l_partkey").cast("string")).alias("server_filename"), F.col("o_custkey").alias("client_id"),
        F.col("l_suppkey").alias("provider_creating_id"), F.col("l_linenumber").alias("user_creating_id"), F.col("l_returnflag").alias("file_name"),
        (F.col("l_linestatus") == "O").alias("active"), F.col("l_shipdate").alias("date_added"), F.col("l_shipdate").alias("date_created"), F.col("l_shipdate").alias("date_updated"),
    )
    return clients.client_files(attached, people(t), agency_crosswalk(t), dates.day("2021-06-07"), FILE_FIXES, "1997-06-01")


# --- notes ------------------------------------------------------------------------


def note_sources(t: Tables):
    """Turns as client, goal and service notes by role, documents as needs (some of an unreadable provider), enrolments as exits."""
    said = t.conversations.select(
        F.col("conv_id").alias("client_id"), F.lit(True).alias("active"), F.col("text").alias("note"), "role", (F.col("conv_id") * 100 + F.col("turn")).alias("need_service_id"),
        (F.col("conv_id") % 100).alias("provider_id"), (F.col("conv_id") % 100).alias("provider_creating_id"),
        *[F.date_add(dates.day("2021-01-01"), F.col("turn").cast("int")).cast("timestamp_ntz").alias(c) for c in ("note_date", "date_added", "date_updated")],
    )
    wanted = t.documents.select(
        F.col("doc_id").alias("client_id"), F.lit(True).alias("active"), F.col("text").alias("note"), F.col("lang").alias("status"),
        nullif("source", "src1").alias("outcome"), F.lit(None).cast("string").alias("reason_unmet"), F.when(F.col("doc_id") % 97 == 5, "none").otherwise((F.col("doc_id") % 100).cast("string")).alias("provider_id"),
        *[stamp("2021-02-03 04:05:06").alias(c) for c in ("date_set", "date_added", "date_updated")],
    )
    left = entries(t).withColumns({"notes": F.concat(F.lit("left \r\n "), F.col("entry_exit_id").cast("string")), "date_added": F.col("entry_date"), "date_updated": F.col("exit_date")})
    given = said.where("role = 'system'").withColumnsRenamed({"note": "service_note", "provider_id": "provide_provider_id", "note_date": "provide_start_date"})
    return notes.note_rows(
        people(t), agency_crosswalk(t), client_notes=said.where("role = 'user'"), goals=said.where("role = 'assistant'"), needs=wanted, services=given,
        exits=left, cutoff="2000-06-01",
    )


SQUISH = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"
NOTES_SQL = f"""{PEOPLE_SQL}, {ENTRIES_SQL}, cw AS (SELECT s_suppkey AS prog, s_name AS pname, s_nationkey + 100 AS agency FROM supplier WHERE s_acctbal > 2000),
 n AS (SELECT conv_id AS pid, conv_id % 100 AS prog, '' AS eid, CASE role WHEN 'user' THEN 'imported from Client' WHEN 'system' THEN 'imported from ServicePoint Service' ELSE 'imported from Goals' END AS title,
   strftime(DATE '2021-01-01' + CAST(turn AS INTEGER), '%Y-%m-%d') AS day, {SQUISH.format('text')} AS note, strftime(DATE '2021-01-01' + CAST(turn AS INTEGER), '%Y-%m-%d') || ' 00:00:00' AS made,
   strftime(DATE '2021-01-01' + CAST(turn AS INTEGER), '%Y-%m-%d') || ' 00:00:00' AS changed,
   CASE WHEN role = 'system' THEN CAST(conv_id * 100 + turn AS VARCHAR) ELSE '' END AS sid FROM conversations WHERE role IN ('user', 'assistant', 'system')
  UNION ALL SELECT doc_id, CASE WHEN doc_id % 97 <> 5 THEN doc_id % 100 END, '', 'imported from ServicePoint Need', '2021-02-03', {SQUISH.format("'Note: ' || text || ' Status: ' || lang || ' Outcome: ' || coalesce(nullif(source, 'src1'), 'NA') || ' Reason Unmet: NA'")},
   '2021-02-03 04:05:06', '2021-02-03 04:05:06', '' FROM documents
  UNION ALL SELECT client_id, provider_id, CAST(entry_exit_id AS VARCHAR), 'Exit note: Exited ' || coalesce(pname, 'NA') || ' on ' || strftime(exit_date, '%Y-%m-%d %H:%M:%S'), strftime(exit_date, '%Y-%m-%d'),
   'left ' || entry_exit_id, strftime(entry_date, '%Y-%m-%d %H:%M:%S'), strftime(exit_date, '%Y-%m-%d %H:%M:%S'), '' FROM entries LEFT JOIN cw ON prog = provider_id WHERE active AND exit_date >= TIMESTAMP '2000-06-01'),
 placed AS (SELECT n.*, CASE n.prog WHEN 7 THEN 134 WHEN 12 THEN 9 ELSE agency END AS aid FROM n LEFT JOIN cw ON cw.prog = n.prog WHERE pid IN (SELECT client_id FROM people))"""


@query("all_notes", f"""
WITH {NOTES_SQL} SELECT row_number() OVER (ORDER BY pid, day, title, eid, sid, made, note, aid, changed) AS "NoteID", pid AS "PersonalID", aid AS "AgencyID", eid AS "EnrollmentID", sid AS "ServicesID",
 title AS "Title", day AS "Date", note AS "Note", made AS "DateCreated", changed AS "DateUpdated" FROM placed WHERE aid IS NOT NULL""")
def all_notes(t: Tables):
    return notes.all_notes(note_sources(t), agency_crosswalk(t), FILE_FIXES)


@query("notes_missing_agency", f"""
WITH {NOTES_SQL} SELECT prog AS "Legacy_ProgramID", n, s_name AS name FROM (SELECT prog, count(*) AS n FROM placed WHERE aid IS NULL GROUP BY 1) LEFT JOIN supplier ON s_suppkey = prog""")
def notes_missing_agency(t: Tables):
    providers = t.supplier.select(F.col("s_suppkey").alias("provider_id"), F.col("s_name").alias("name"))
    return notes.notes_missing_agency(note_sources(t), agency_crosswalk(t), providers, FILE_FIXES)


# --- services ---------------------------------------------------------------------

SERVICE_RULES = {"1-URGENT": ("A", "R"), "2-HIGH": ("N",), "5-LOW": ("A",)}


def need_services(t: Tables):
    """Lines as services of their order's customer and priority."""
    lines = joins.ns_join(
        t.lineitem, t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), [("l_orderkey", "o_orderkey")], nulls_match=False
    )
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("need_service_id"), F.col("l_orderkey").alias("need_service_group_id"),
        F.col("o_custkey").alias("client_id"), F.substring("o_orderpriority", 1, 1).cast("long").alias("provide_provider_id"),
        F.col("l_shipdate").alias("provide_start_date"), F.col("l_returnflag").alias("code"), (F.col("l_discount") < 0.09).alias("active"),
        F.col("l_suppkey").alias("user_creating_id"), F.col("l_shipdate").alias("date_added"), F.col("l_shipdate").alias("date_updated"),
        F.when(F.col("l_tax") > 0.07, "federal").alias("path_service_type"),
    )


def priorities(t: Tables):
    return t.orders.select("o_orderpriority").distinct().select(
        F.substring("o_orderpriority", 1, 1).cast("long").alias("id"), "o_orderpriority"
    )


def translated(t: Tables):
    providers = priorities(t).select(F.col("id").alias("provider_id"), F.col("o_orderpriority").alias("program_type_code"))
    crosswalk = priorities(t).select(
        F.col("id").alias("Legacy_ProgramID"), F.when(F.col("id") == 5, "Low YHDP").otherwise(F.col("o_orderpriority")).alias("Legacy_ProgramName"),
        (F.col("id") + 100).alias("Target_AgencyID"), (F.col("id") + 1000).alias("Target_ProgramID"), F.col("o_orderpriority").alias("Target_ProgramName"),
    )
    kept = services.cohort_services(need_services(t), providers, people(t), SERVICE_RULES, ["path_service_type"], "1996-01-01")
    connected = services.connected_services(kept, crosswalk, entries(t), dates.day("2001-12-31"))
    translator = literal_table(t.spark, [("A", "Aid", "Case Management"), ("R", "Rent", "Rental Assistance"), ("N", "Move", "Moving Cost Assistance")], "sp_code string, sp_desc string, item_desc string")
    items = literal_table(t.spark, [
        (1001, "1-URGENT", "Case management services", 501), (1002, "2-HIGH", "Moving costs", 502), (1005, "5-LOW", "Rental Assistance", 503), (None, "1-URGENT", "Rental Assistance", 504),
    ], "Target_ProgramID long, Target_ProgramName string, ServiceItemName string, ServiceItemID long")
    return services.translated_services(connected, services.service_items(items), translator)


SERVICES_SQL = f"""{PEOPLE_SQL}, {ENTRIES_SQL},
 sv AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS sid, l_orderkey AS gid, o_custkey AS pid, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS prog, o_orderpriority AS prio,
   l_shipdate AS d, l_returnflag AS code, l_suppkey AS usr FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_discount < 0.09 AND l_tax <= 0.07 AND l_shipdate > TIMESTAMP '1996-01-01'
   AND o_custkey IN (SELECT client_id FROM people) AND ((o_orderpriority = '1-URGENT' AND l_returnflag IN ('A', 'R')) OR (o_orderpriority = '2-HIGH' AND l_returnflag = 'N') OR (o_orderpriority = '5-LOW' AND l_returnflag = 'A'))),
 tr AS (SELECT DISTINCT sv.*, entry_exit_id AS eid, CASE WHEN prog = 5 THEN 'Low YHDP' ELSE prio END AS lname, CASE WHEN prio = '1-URGENT' AND code = 'A' THEN 501 WHEN prio = '2-HIGH' THEN 502 END AS item
  FROM sv JOIN entries e ON e.active AND e.client_id = pid AND e.provider_id = prog AND d BETWEEN entry_date AND coalesce(exit_date, TIMESTAMP '2001-12-31'))"""


@query("services_not_connecting", f"""
WITH {SERVICES_SQL} SELECT sid AS "ServicesID", eid AS "EnrollmentID", pid AS "PersonalID", code AS sp_code, lname AS "Legacy_ProgramName" FROM tr
WHERE item IS NULL AND NOT contains(lname, 'YHDP')""")
def services_not_connecting(t: Tables):
    return services.services_not_connecting(translated(t)).select("ServicesID", "EnrollmentID", "PersonalID", "sp_code", "Legacy_ProgramName")


@query("services_not_coming", f"""
WITH {SERVICES_SQL} SELECT sid AS "ServicesID", eid AS "EnrollmentID", pid AS "PersonalID", code AS sp_code, lname AS "Legacy_ProgramName" FROM tr
WHERE item IS NULL AND contains(lname, 'YHDP')""")
def services_not_coming(t: Tables):
    return services.services_not_coming(translated(t)).select("ServicesID", "EnrollmentID", "PersonalID", "sp_code", "Legacy_ProgramName")


@query("projects_not_done", f"""
WITH {SERVICES_SQL} SELECT lname AS "Legacy_ProgramName", CASE code WHEN 'A' THEN 'Aid' WHEN 'R' THEN 'Rent' ELSE 'Move' END AS sp_desc,
 CASE code WHEN 'A' THEN 'Case Management' WHEN 'R' THEN 'Rental Assistance' ELSE 'Moving Cost Assistance' END AS item_desc, count(*) AS n, CASE WHEN contains(lname, 'YHDP') THEN 'ok' ELSE 'not ok' END AS ok
FROM tr WHERE item IS NULL GROUP BY ALL""")
def projects_not_done(t: Tables):
    return services.projects_not_done(translated(t))


def funded(t: Tables):
    funds = t.orders.select(
        F.col("o_orderkey").alias("need_service_group_id"), money("o_totalprice").alias("cost"),
        F.when(F.col("o_totalprice") > 400000, "Diversion").when(F.col("o_totalprice") > 200000, "City").otherwise("State").alias("source"),
        F.when(F.col("o_orderstatus") == "P", "Deleted").otherwise("Modified").alias("last_action"), F.lit(True).alias("active"), F.col("o_orderdate").alias("date_added"),
    )
    amounts = services.fund_amounts(funds, "1996-01-01")
    spark = t.spark
    changes = literal_table(spark, [(1002, "2-HIGH", "City", "Federal")], "Target_ProgramID long, Target_ProgramName string, source string, NewSource string")
    fund_codes = literal_table(spark, [("City", 46, 2, "Local"), ("State", 46, 6, "Other"), ("Federal", 3, None, "CoC")], "source string, funding_source int, funding_source_other int, FundingSource string")
    target_funds = literal_table(spark, [
        (1001, 46, 2, "Town", "Yes", 71), (1001, 46, 2, "Town two", "Yes", 70), (1001, 46, 6, "State", "No", 72), (1002, 3, 9, "x", "Yes", 73), (1002, 46, 6, "State", "Yes", 74),
    ], "Target_ProgramID long, FundingSourceID int, FundingOtherID int, FundingOther string, Active string, TargetFundingSourceID long")
    return services.funded_services(translated(t), amounts, changes, fund_codes, target_funds)


FUNDED_SQL = SERVICES_SQL + """, fa AS (SELECT DISTINCT sv2.sid, CAST(o_totalprice AS DECIMAL(12,2)) AS amt, CASE WHEN o_totalprice > 200000 THEN 'City' ELSE 'State' END AS source
  FROM orders JOIN (SELECT DISTINCT l_orderkey, l_orderkey * 10 + l_linenumber AS sid FROM lineitem) sv2 ON sv2.l_orderkey = o_orderkey
  WHERE o_totalprice <= 400000 AND o_orderstatus <> 'P' AND o_orderdate >= TIMESTAMP '1996-01-01'),
 fd AS (SELECT tr.*, amt, CASE WHEN prog = 2 AND source = 'City' THEN 'Federal' ELSE source END AS src FROM tr LEFT JOIN fa ON fa.sid = tr.sid WHERE item IS NOT NULL),
 ff AS (SELECT *, CASE WHEN prog = 1 AND src = 'City' THEN 70 WHEN prog = 2 AND src = 'Federal' THEN 73 WHEN prog = 2 AND src = 'State' THEN 74 END AS fund,
   CASE WHEN prog = 1 AND src = 'City' THEN 'Local' WHEN prog = 2 AND src = 'State' THEN 'Other' WHEN prog = 2 AND src = 'Federal' THEN 'CoC' END AS fsource,
   CASE WHEN prog = 1 AND src = 'City' THEN 'Town two' WHEN prog = 2 AND src = 'State' THEN 'State' END AS fother FROM fd)"""


@query("custom_services", f"""
WITH {FUNDED_SQL} SELECT row_number() OVER (ORDER BY sid, pid, prog, eid, item, d, fund NULLS LAST, fsource NULLS LAST, fother NULLS LAST, amt NULLS LAST, usr) AS "ServicesID", pid AS "PersonalID", prog + 100 AS "AgencyID",
 eid AS "EnrollmentID", item AS "ServiceItemID", strftime(d, '%Y-%m-%d') AS "DateProvided", fund AS "FundingSourceID", fsource AS "FundingSource", fother AS "FundingOther", CAST(amt AS DOUBLE) AS "FAAmount",
 strftime(d, '%Y-%m-%d %H:%M:%S') AS "DateCreated", strftime(d, '%Y-%m-%d %H:%M:%S') AS "DateUpdated", usr AS "UserID" FROM ff""")
def custom_services(t: Tables):
    return services.custom_services(funded(t)).withColumn("FAAmount", F.col("FAAmount").cast("double"))


@query("missing_funding", f"""
WITH {FUNDED_SQL} SELECT prog + 1000 AS "Target_ProgramID", prio AS "Target_ProgramName", src AS source, fsource AS "FundingSource", count(*) AS n FROM ff
WHERE src IS NOT NULL AND fund IS NULL GROUP BY ALL""")
def missing_funding(t: Tables):
    return services.missing_funding(funded(t))


# --- reports ----------------------------------------------------------------------


@query("shared_addresses", """
WITH a AS (SELECT p_partkey, p_name AS a1, nullif(p_type, 'PROMO') AS a2, p_brand AS city, CAST(p_size AS VARCHAR) AS zip FROM part),
 u AS (SELECT DISTINCT a1, a2, city, zip FROM a), d AS (SELECT *, count(*) OVER (PARTITION BY zip, city) AS n FROM u)
SELECT d.a1 AS "Address1", d.a2 AS "Address2", d.city AS "City", 'OH' AS "State", d.zip AS "ZIP", count(*) AS "ProjectCount",
 string_agg(CAST(p_partkey AS VARCHAR), ', ' ORDER BY CAST(p_partkey AS VARCHAR)) AS "ProjectIDs"
FROM d JOIN a ON a.a1 = d.a1 AND a.a2 IS NOT DISTINCT FROM d.a2 AND a.city = d.city AND a.zip = d.zip WHERE n > 1 GROUP BY ALL""")
def shared_addresses(t: Tables):
    return import_tables.shared_addresses(t.part.select(
        F.col("p_partkey").alias("ProjectID"), F.col("p_name").alias("Address1"), nullif("p_type", "PROMO").alias("Address2"),
        F.col("p_brand").alias("City"), F.lit("OH").alias("State"), F.col("p_size").cast("string").alias("ZIP"),
    ))


def inventory(t: Tables):
    """Quantities of an order by line kind as bed counts; the seventh kind is not known."""
    def beds(flag):
        return F.sum(F.when(line_flag() == flag, F.col("l_quantity").cast("int"))).cast("int")

    kinds = {"YouthVetBedInventory": "AF", "VetBedInventory": "AO", "YouthBedInventory": "NF", "OtherBedInventory": "NO", "CHVetBedInventory": "RF", "CHYouthBedInventory": "RO"}
    known = F.sum(F.when(F.col("l_linenumber") < 7, F.col("l_quantity").cast("int"))).cast("int")
    total = F.when(F.max("l_quantity") < 50, known).alias("BedInventory")
    out = t.lineitem.groupBy(F.col("l_orderkey").alias("InventoryID")).agg(*[beds(f).alias(k) for k, f in kinds.items()], total)
    return out.withColumns({
        "CHBedInventory": F.lit(None).cast("int"), "ProjectID": F.col("InventoryID"), "UnitInventory": F.lit(1), "ESBedType": F.lit(1), "Availability": F.lit(1), "HouseholdType": F.lit(1),
        "CoCCode": F.lit("OH-507"), **{c: dates.day("2020-01-01") for c in ("DateCreated", "DateUpdated", "InventoryStartDate", "InventoryEndDate")},
    })


BEDS_SQL = """i AS (SELECT l_orderkey AS id, """ + ", ".join(
    f"CAST(sum(CASE WHEN l_returnflag || l_linestatus = '{f}' THEN CAST(l_quantity AS INTEGER) END) AS INTEGER) AS {f.lower()}_" for f in ("AF", "AO", "NF", "NO", "RF", "RO")) + """,
  CASE WHEN max(l_quantity) < 50 THEN CAST(sum(CASE WHEN l_linenumber < 7 THEN CAST(l_quantity AS INTEGER) END) AS INTEGER) END AS total FROM lineitem GROUP BY 1),
 z AS (SELECT id, coalesce(af_, 0) AS af, coalesce(ao_, 0) AS ao, coalesce(nf_, 0) AS nf, coalesce(no_, 0) AS no_, coalesce(rf_, 0) AS rf, coalesce(ro_, 0) AS ro, total FROM i),
 b AS (SELECT id, af AS bed_youth_veteran, CAST(af > 0 AS INTEGER) AS is_bed_youth_veteran, ao AS bed_other_veteran, CAST(ao > 0 AS INTEGER) AS is_bed_other_veteran,
  nf AS bed_other_youth, CAST(nf <> 0 AS INTEGER) AS is_bed_other_youth, CASE WHEN total IS NULL THEN NULL WHEN af + ao + nf + no_ + rf + ro = total THEN no_ ELSE total END AS bed_non_dedicated,
  CAST(no_ > 0 AS INTEGER) AS is_bed_non_dedicated, rf AS bed_ch_veteran, CAST(rf > 0 AS INTEGER) AS is_bed_ch_veteran, ro AS bed_ch_youth, CAST(ro > 0 AS INTEGER) AS is_bed_ch_youth,
  0 AS bed_ch_other, 0 AS is_bed_ch_other, total AS bed_inventory FROM z)"""


@query("bed_flags", f"WITH {BEDS_SQL} SELECT * FROM b")
def bed_flags(t: Tables):
    return inventory(t).select(F.col("InventoryID").alias("id"), *[c.alias(n) for n, c in codes.bed_flags().items()])


@query("program_inventory", f"""WITH {BEDS_SQL}, named AS (SELECT id AS bed_id, {", ".join(f"{c} AS program_inventory__{c}" for kind in ("youth_veteran", "other_veteran", "other_youth", "non_dedicated", "ch_veteran", "ch_youth", "ch_other") for c in (f"bed_{kind}", f"is_bed_{kind}"))}, bed_inventory AS program_inventory__bed_inventory FROM b)
SELECT bed_id AS id, bed_id AS ref_program, * EXCLUDE (bed_id), 'OH-507' AS program_inventory__coc, 1 AS program_inventory__unit_inventory, 1 AS program_inventory__ref_household_type, 1 AS program_inventory__ref_bed_type, 1 AS program_inventory__availability,
 '2020-01-01' AS program_inventory__information_date, '2020-01-01' AS program_inventory__start_date, '2020-01-01' AS program_inventory__end_date, '2020-01-01' AS added_date, '2020-01-01' AS last_updated FROM named""")
def program_inventory(t: Tables):
    out = import_tables.program_inventory(inventory(t))
    return out.withColumns({f.name: dates.as_day_text(F.col(f.name)) for f in out.schema if f.dataType.typeName() in ("date", "timestamp")})


@query("inventory_not_adding_up", f"""WITH {BEDS_SQL} SELECT id, bed_non_dedicated, bed_inventory FROM b
WHERE bed_youth_veteran + bed_other_veteran + bed_other_youth + bed_non_dedicated + bed_ch_veteran + bed_ch_youth + bed_ch_other <> bed_inventory""")
def inventory_not_adding_up(t: Tables):
    out = import_tables.inventory_not_adding_up(import_tables.program_inventory(inventory(t)))
    return out.select("id", *[F.col(f"program_inventory__{c}").alias(c) for c in ("bed_non_dedicated", "bed_inventory")])


@query("access_points", """
WITH p AS (SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_acctbal > 5000 THEN 'day' END AS hours, CASE WHEN s_acctbal > 7000 THEN s_name END AS web FROM supplier WHERE s_nationkey < 15),
 g AS (SELECT id, string_agg(seg, ', ' ORDER BY seg) AS general_service_area FROM (SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS id, c_mktsegment AS seg FROM customer) JOIN p USING (id) GROUP BY 1),
 sc AS (SELECT DISTINCT l_suppkey AS id, l_returnflag AS code, CASE WHEN l_tax < 0.04 THEN l_linestatus END AS area FROM lineitem JOIN p ON p.id = l_suppkey),
 v AS (SELECT id, area AS veteran_service_area FROM sc WHERE code = 'A'), y AS (SELECT id, area AS youth_service_area FROM sc WHERE code = 'N' AND area IS NOT NULL),
 d AS (SELECT id, area AS dv_service_area FROM sc WHERE code = 'R' AND area IS NOT NULL), h AS (SELECT id, hours, web AS website_address FROM p WHERE hours IS NOT NULL OR web IS NOT NULL)
SELECT s_name AS "SP_ProjectName", CASE WHEN s_acctbal > 2000 THEN 'Agency ' || s_nationkey END AS "Target_AgencyName", CASE WHEN s_acctbal > 2000 THEN s_name END AS "Target_ProgramName",
 id AS "SP_ProjectID", general_service_area, veteran_service_area, youth_service_area, dv_service_area, hours, website_address
FROM g FULL JOIN v USING (id) FULL JOIN y USING (id) FULL JOIN d USING (id) FULL JOIN h USING (id) LEFT JOIN supplier ON s_suppkey = id""")
def access_points(t: Tables):
    providers = t.supplier.select(
        F.col("s_suppkey").alias("provider_id"), F.col("s_name").alias("name"), F.when(F.col("s_nationkey") < 15, "access").alias("program_type_code"),
        F.when(F.col("s_acctbal") > 5000, "day").alias("hours"), F.when(F.col("s_acctbal") > 7000, F.col("s_name")).alias("website_address"),
    )
    counties = t.customer.select(F.col("c_nationkey").cast("long").alias("provider_id"), F.col("c_mktsegment").alias("county"))
    offered = t.lineitem.select(
        F.col("l_suppkey").alias("provider_id"), F.col("l_returnflag").alias("service_code"), F.when(F.col("l_tax") < 0.04, F.col("l_linestatus")).alias("service_area")
    ).distinct()
    crosswalk = t.supplier.where("s_acctbal > 2000").select(
        F.col("s_suppkey").alias("Legacy_ProgramID"), F.concat(F.lit("Agency "), F.col("s_nationkey").cast("string")).alias("Target_AgencyName"), F.col("s_name").alias("Target_ProgramName")
    )
    kinds = {"A": ("veteran_service_area", False), "N": ("youth_service_area", True), "R": ("dv_service_area", True)}
    return helpers.access_points(providers, counties, offered, crosswalk, "access", kinds)


@query("inventory_diff", """
WITH a AS (SELECT p_partkey, p_size AS "ProjectID", p_brand AS kind, nullif(p_type, 'PROMO') AS beds FROM part WHERE p_retailprice < 1000),
 b AS (SELECT p_partkey, p_size AS "ProjectID", p_brand AS kind, nullif(p_type, 'PROMO') AS beds FROM part WHERE p_retailprice > 950),
 pr AS (SELECT n_nationkey AS "ProjectID", n_name AS "ProjectName" FROM nation)
SELECT 'missing' AS side, b.*, "ProjectName" FROM b LEFT JOIN pr USING ("ProjectID") WHERE NOT EXISTS (SELECT 1 FROM a WHERE a."ProjectID" IN (SELECT "ProjectID" FROM pr) AND a."ProjectID" = b."ProjectID" AND a.kind = b.kind AND a.beds IS NOT DISTINCT FROM b.beds)
UNION ALL SELECT 'different', a.*, "ProjectName" FROM a JOIN pr USING ("ProjectID") WHERE NOT EXISTS (SELECT 1 FROM b WHERE a."ProjectID" = b."ProjectID" AND a.kind = b.kind AND a.beds IS NOT DISTINCT FROM b.beds)""")
def inventory_diff(t: Tables):
    beds = t.part.select("p_partkey", F.col("p_size").alias("ProjectID"), F.col("p_brand").alias("kind"), nullif("p_type", "PROMO").alias("beds"), "p_retailprice")
    earlier, later = beds.where("p_retailprice < 1000").drop("p_retailprice"), beds.where("p_retailprice > 950").drop("p_retailprice")
    projects = t.nation.select(F.col("n_nationkey").alias("ProjectID"), F.col("n_name").alias("ProjectName"))
    missing, different = helpers.inventory_diff(earlier, later, projects, ["ProjectID", "kind", "beds"])
    return missing.withColumn("side", F.lit("missing")).unionByName(different.withColumn("side", F.lit("different")))


@query("org_classify", """
WITH p AS (SELECT o_custkey AS "Org", CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS mx, o_orderdate AS mn, CASE WHEN o_orderstatus = 'O' AND o_totalprice > 300000 THEN 1 ELSE 0 END AS oe,
   CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 250000 THEN 1 ELSE 0 END AS op, CASE WHEN o_totalprice > 450000 THEN 1 ELSE 0 END AS pa, CASE WHEN o_orderpriority = '2-HIGH' AND o_totalprice > 400000 THEN 1 ELSE 0 END AS ce FROM orders),
 g AS (SELECT "Org", min(mn) AS mn, max(coalesce(mx, TIMESTAMP '2004-01-01')) AS mx0, max(coalesce(mx, TIMESTAMP '1990-01-01')) AS mx, CAST(sum(oe) AS BIGINT) AS oe, max(op) AS op, max(pa) AS pa, max(ce) AS ce FROM p GROUP BY 1)
SELECT "Org", strftime(mn, '%Y-%m-%d') AS "minEntry", strftime(mx0, '%Y-%m-%d') AS "maxExit", oe AS "openEEs", op AS "maxOperating", pa AS "maxParticipating", ce AS "CEorVASH",
 CASE WHEN oe = 0 AND pa = 0 AND ce = 0 AND op = 0 AND mx0 <= TIMESTAMP '2000-01-01' THEN 'not migrating' WHEN oe = 0 AND pa = 0 AND ce = 0 THEN 'migrating inactive' ELSE 'migrating active' END AS status FROM g""")
def org_classify(t: Tables):
    price, prio = F.col("o_totalprice"), F.col("o_orderpriority")
    profile = t.orders.select(
        F.col("o_custkey").alias("Org"), (F.col("o_orderkey") + 2).alias("ProjectID"), F.when((prio == "2-HIGH") & (price > 400000), "Home VASH").otherwise(prio).alias("Project"), prio.alias("ptc"),
        F.col("o_orderdate").cast("date").alias("MinEntry"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate").cast("date")).alias("MaxExit"),
        F.when((F.col("o_orderstatus") == "O") & (price > 300000), 1).alias("OpenEEs"),
        F.when((prio == "1-URGENT") & (price > 250000), "Yes").otherwise("No").alias("operating"), F.when(price > 450000, "Yes").otherwise("No").alias("participating"),
    )
    out = helpers.org_classify(helpers.org_profile(helpers.project_flags(profile)), "2000-01-01")
    return out.withColumns({c: dates.as_day_text(F.col(c)) for c in ("minEntry", "maxExit")})


@query("mapping_gaps", """
WITH n AS (SELECT p_name, nullif(p_brand, 'Brand#1') AS brand, p_type, count(*) AS parts FROM part GROUP BY 1, 2, 3),
 o AS (SELECT DISTINCT p_name, nullif(p_brand, 'Brand#1') AS brand, p_type FROM part WHERE p_size > 10)
SELECT p_name, brand, p_type, parts, CAST(NULL AS INTEGER) AS program FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.p_name = n.p_name AND o.brand IS NOT DISTINCT FROM n.brand AND o.p_type = n.p_type)""")
def mapping_gaps(t: Tables):
    p = t.part.select("p_name", nullif("p_brand", "Brand#1").alias("brand"), "p_type", "p_size")
    new = p.groupBy("p_name", "brand", "p_type").agg(F.count("*").alias("parts"))
    original = p.where("p_size > 10").groupBy("p_name", "brand", "p_type").agg(F.max("p_size").alias("program"))
    return helpers.mapping_gaps(new, original, ["p_name", "brand", "p_type"], "program")

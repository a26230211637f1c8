"""Employee data: lookups, joins, assets."""

from pyspark.sql import functions as F

from logweir.operators.enrich import (
    add_mapped_name,
    add_person_name,
    clean_names,
    enrich,
    person_lookup,
    valid_departments,
    with_department,
)
from logweir.operators.ordinal import assign_assets
from logweir.workload.tables import table

_RULES = [("user_id", "account"), ("emp_name", "mapped_name")]


def _lookup(spark, folder):
    """Suppliers in the role of the employees that are known; some users are not."""
    people = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("EMP_ID "), F.col("s_name").alias(" Emp_Name")
    )
    return person_lookup(people)


def _events(spark, folder):
    kept = F.when(F.col("event_type") == "view", F.concat(F.lit("kept "), F.col("event_type")))
    return table(spark, folder, "events").select(
        "event_id", "user_id", F.col("user_id").alias("account"), kept.alias("mapped_name")
    )


def clean_column_names(spark, folder):
    people = table(spark, folder, "customer").select(
        F.col("c_custkey").alias(" EMP_ID"), F.col("c_name").alias("Emp_Name ")
    )
    return clean_names(people)


def lookup_last_wins(spark, folder):
    """Many rows per id, a hot id included: the last one by event id stands."""
    people = table(spark, folder, "events").select(
        F.col("user_id").alias("Employee_ID"),
        F.concat_ws("-", "event_type", "event_id").alias("NAME_KR"),
        F.col("event_id").alias("position"),
    )
    return person_lookup(people, order_col="position")


def enrich_names(spark, folder):
    rows = add_person_name(_events(spark, folder), _lookup(spark, folder))
    return rows.select("event_id", "emp_name")


def enrich_fill_null(spark, folder):
    rows = add_mapped_name(_events(spark, folder), _lookup(spark, folder), _RULES)
    return rows.select("event_id", "mapped_name")


def enrich_both(spark, folder):
    rules = [("user_id", "user_id"), ("emp_name", "mapped_name")]
    rows = enrich(_events(spark, folder), _lookup(spark, folder), rules)
    return rows.select("event_id", "emp_name", "mapped_name")


def _employees(spark, folder):
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("employee_id"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name_kr"),
        F.col("c_nationkey").alias("department_id"),
    )


def _departments(spark, folder):
    africa = table(spark, folder, "region").filter("r_name <> 'AFRICA'")
    nations = table(spark, folder, "nation")
    kept = nations.join(africa, nations["n_regionkey"] == africa["r_regionkey"], "left_semi")
    return kept.select(
        F.col("n_nationkey").alias("department_id"), F.col("n_name").alias("department_name")
    )


def employee_department(spark, folder):
    return with_department(_employees(spark, folder), _departments(spark, folder))


def assign_addresses(spark, folder):
    staff = with_department(_employees(spark, folder), _departments(spark, folder))
    return assign_assets(staff)


def people_with_department(spark, folder):
    segment = F.col("c_mktsegment")
    dept = (
        F.when(segment == "BUILDING", "")
        .when(segment == "MACHINERY", "Unknown_Dept")
        .when(segment != "HOUSEHOLD", segment)
    )
    people = table(spark, folder, "customer").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("emp_id"),
        dept.alias("dept_name"),
        F.concat(F.lit("10.0.0."), F.col("c_nationkey").cast("string")).alias("static_ip"),
    )
    return valid_departments(people)


QUERIES = {
    "clean_column_names": clean_column_names,
    "lookup_last_wins": lookup_last_wins,
    "enrich_names": enrich_names,
    "enrich_fill_null": enrich_fill_null,
    "enrich_both": enrich_both,
    "employee_department": employee_department,
    "assign_addresses": assign_addresses,
    "people_with_department": people_with_department,
}

_JOIN = "FROM events LEFT JOIN supplier ON user_id = s_suppkey"
_STAFF = """e AS (SELECT c_custkey AS emp_id, c_name AS user_name, coalesce(n_name, 'Unknown') AS dept_name
 FROM customer LEFT JOIN (SELECT n_nationkey, n_name FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name <> 'AFRICA') ON c_nationkey = n_nationkey WHERE c_acctbal >= 0)"""

SQL = {
    "clean_column_names": "SELECT c_custkey AS emp_id, c_name AS emp_name FROM customer",
    "lookup_last_wins": """SELECT CAST(user_id AS VARCHAR) AS person_id,
 arg_max(event_type || '-' || event_id, event_id) AS person_name FROM events GROUP BY user_id""",
    "enrich_names": f"SELECT event_id, coalesce(s_name, 'Unknown_User') AS emp_name {_JOIN}",
    "enrich_fill_null": f"""SELECT event_id, CASE WHEN event_type = 'view' THEN 'kept view'
 ELSE coalesce(s_name, 'Unknown_User') END AS mapped_name {_JOIN}""",
    "enrich_both": f"""SELECT event_id, coalesce(s_name, 'Unknown_User') AS emp_name,
 CASE WHEN event_type = 'view' THEN 'kept view' ELSE coalesce(s_name, 'Unknown_User') END AS mapped_name {_JOIN}""",
    "employee_department": f"WITH {_STAFF} SELECT * FROM e",
    "assign_addresses": f"""WITH {_STAFF}, n AS (SELECT *, row_number() OVER (ORDER BY emp_id) - 1 AS i FROM e)
SELECT emp_id AS user_id, user_name AS "user", dept_name AS dept,
 '192.168.' || (i % 20 + 10) || '.' || (i % 250 + 1) AS ip, 'WS-' || emp_id AS device_id FROM n""",
    "people_with_department": """SELECT c_name AS user_id, c_mktsegment AS department,
 '10.0.0.' || c_nationkey AS src_ip FROM customer
WHERE c_acctbal >= 0 AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')""",
}

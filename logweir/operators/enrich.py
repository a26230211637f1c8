"""Names and departments from employee data."""

from pyspark.sql import DataFrame, functions as F

from logweir.constants import UNKNOWN_DEPARTMENT, UNKNOWN_PERSON
from logweir.operators.mapping import source_of

def clean_names(df: DataFrame) -> DataFrame:
    """Lower-case column names without surrounding blanks."""
    return df.toDF(*[c.lower().strip() for c in df.columns])


def person_lookup(people: DataFrame, order_col: str | None = None) -> DataFrame:
    """(person_id, person_name): id and name by column role, last row of an id wins.

    Spark rows have no order, so `order_col` says which row is last; without it the
    greatest name is taken, which at least is always the same one.
    """
    people = clean_names(people)
    columns = [c for c in people.columns if c != order_col]
    id_col = next((c for c in ("employee_id", "emp_id") if c in columns), columns[0])
    name_col = next(
        (c for c in ("name_kr", "emp_name") if c in columns), columns[min(1, len(columns) - 1)]
    )
    last = F.struct(F.col(order_col), F.col(name_col)) if order_col else F.col(name_col)
    return (
        people.groupBy(F.col(id_col).cast("string").alias("person_id"))
        .agg(F.max_by(F.col(name_col).cast("string"), last).alias("person_name"))
        .filter(F.col("person_id").isNotNull())
    )


def _look_up(events, lookup, key, out, keep_existing):
    found = lookup.select(
        F.col("person_id").alias("_id"), F.col("person_name").alias("_name")
    )
    joined = events.join(found, events[key].cast("string") == F.col("_id"), "left")
    own = [F.col(out)] if keep_existing else []
    value = F.coalesce(*own, F.col("_name"), F.lit(UNKNOWN_PERSON))
    return joined.withColumn(out, value).drop("_id", "_name")


def add_person_name(events: DataFrame, lookup: DataFrame) -> DataFrame:
    """`emp_name` by `user_id`; a miss is the unknown person."""
    if "user_id" not in events.columns:
        return events
    return _look_up(events, lookup, "user_id", "emp_name", keep_existing=False)


def add_mapped_name(events: DataFrame, lookup: DataFrame, rules) -> DataFrame:
    """Name by the mapped id column into the mapped name column, filling only its nulls."""
    key, out = source_of(rules, "user_id"), source_of(rules, "emp_name")
    if key not in events.columns:
        return events
    return _look_up(events, lookup, key, out, keep_existing=out in events.columns)


def enrich(events: DataFrame, lookup: DataFrame | None, rules) -> DataFrame:
    """Both name steps. With the same key column one join serves both."""
    if lookup is None:
        return events
    key, out = source_of(rules, "user_id"), source_of(rules, "emp_name")
    if key != "user_id" or "user_id" not in events.columns:
        return add_mapped_name(add_person_name(events, lookup), lookup, rules)
    named = add_person_name(events, lookup)
    if out == "emp_name":
        return named
    own = [F.col(out)] if out in events.columns else []
    return named.withColumn(out, F.coalesce(*own, F.col("emp_name")))


def with_department(employees: DataFrame, departments: DataFrame) -> DataFrame:
    """Employees with id and name, and their department or the unknown one."""
    named = departments.select(
        F.col("department_id").alias("_dept"), F.col("department_name").alias("_dept_name")
    )
    valid = employees.filter(F.col("employee_id").isNotNull() & F.col("name_kr").isNotNull())
    joined = valid.join(named, valid["department_id"] == F.col("_dept"), "left")
    return joined.select(
        F.col("employee_id").alias("emp_id"),
        F.col("name_kr").alias("user_name"),
        F.coalesce("_dept_name", F.lit(UNKNOWN_DEPARTMENT)).alias("dept_name"),
    )


def valid_departments(people: DataFrame) -> DataFrame:
    """People with an id and a real department, in event column names."""
    dept = F.col("dept_name")
    return people.filter(
        F.col("emp_id").isNotNull() & dept.isNotNull() & (dept != "Unknown_Dept") & (dept != "")
    ).select(
        F.col("emp_id").alias("user_id"),
        dept.alias("department"),
        F.col("static_ip").alias("src_ip"),
    )

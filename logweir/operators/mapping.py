"""Field mapping: apply rules, find them, look them up."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from logweir.constants import KEY_SYNONYMS, PERSON_RULE
from logweir.functions.text import literal, quoted

POLICIES = ("last", "last_present", "first_present")


def mapped_columns(types: dict, rules, policy="last_present") -> dict[str, Column]:
    """Expression per target, all over the original columns, for one projection.

    last           the last listed source that exists as a column, even where it is null
    last_present   the last listed source with a value in the row, else the target's own
    first_present  the first listed source with a value in the row, else the target's own

    `types` maps the columns to their types; values of different types meet as text.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown mapping policy {policy}")
    current, types = {c: F.col(c) for c in types}, dict(types)
    listed = {}
    for target, source in rules:
        listed.setdefault(target, []).append(source)
    changed = {}
    for target, sources in listed.items():
        if policy == "last":
            sources = sources[-1:]
        elif policy == "last_present":
            sources = sources[::-1]
        if policy != "last":
            sources = [*sources, target]
        present = [s for s in dict.fromkeys(sources) if s in current]
        if not present or present == [target]:
            continue
        kinds = {types[s] for s in present}
        values = [current[s] if len(kinds) == 1 else current[s].cast("string") for s in present]
        changed[target] = current[target] = F.coalesce(*values) if len(values) > 1 else values[0]
        types[target] = kinds.pop() if len(kinds) == 1 else T.StringType()
    return changed


def apply_rules(df: DataFrame, rules, policy="last_present") -> DataFrame:
    """`rules` is a list of (target, source)."""
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns(mapped_columns(types, rules, policy))


def apply_rules_by_source(
    df: DataFrame, rules: DataFrame, source_col="log_source", map_col="fields"
) -> DataFrame:
    """Rules as data for rows of many sources: adds `mapped`, a map target -> value.

    One row per source is joined. The last rule whose source key is in the row wins.
    """
    ordered = F.reverse(F.array_sort(F.collect_list(F.struct("pos", "source"))))["source"]
    per_target = rules.groupBy(F.col("log_source").alias("_rule_source"), "target").agg(
        ordered.alias("sources")
    )
    per_source = per_target.groupBy("_rule_source").agg(
        F.collect_list(F.struct("target", "sources")).alias("_rules")
    )
    joined = df.join(per_source, F.col(source_col) == F.col("_rule_source"), "left")
    fields = quoted(map_col)
    usable = f"get(filter(r.sources, s -> map_contains_key({fields}, s)), 0)"
    pairs = f"transform(_rules, r -> named_struct('key', r.target, 'source', {usable}))"
    present = f"filter({pairs}, p -> p.source IS NOT NULL)"
    mapped = f"map_from_entries(transform({present}, p -> struct(p.key, {fields}[p.source])))"
    empty = "CAST(map() AS MAP<STRING, STRING>)"
    mapped = F.expr(f"coalesce({mapped}, {empty})")
    return joined.withColumn("mapped", mapped).drop("_rules", "_rule_source")


def infer_rules(
    records: DataFrame, by="log_source", map_col="fields", synonyms=KEY_SYNONYMS
) -> DataFrame:
    """Mapping rules (log_source, pos, target, source) from the keys seen per source.

    Keys are cut to the synonym list before anything is shuffled, so a group holds at
    most that many rows whatever the input.
    """
    known = F.create_map(*[F.lit(x) for pair in synonyms.items() for x in pair])
    keys = records.select(
        F.col(by).alias("log_source"), F.posexplode(F.map_keys(map_col)).alias("place", "source")
    ).filter(F.col("source").isin(list(synonyms)))
    seen = keys.groupBy("log_source", "source").agg(F.min("place").alias("place"))
    listed = seen.groupBy("log_source").agg(
        F.array_sort(
            F.collect_list(F.struct("place", "source", known[F.col("source")].alias("target")))
        ).alias("rules")
    )
    target, source = (literal(x) for x in PERSON_RULE)
    person = f"named_struct('place', 0, 'source', {source}, 'target', {target})"
    has_user = "exists(rules, r -> r.target = 'user_id')"
    rules = F.expr(f"concat(rules, IF({has_user}, array({person}), array()))")
    return listed.select("log_source", F.posexplode(rules).alias("pos", "rule")).select(
        "log_source", "pos", "rule.target", "rule.source"
    )


def first_source(rules: DataFrame) -> DataFrame:
    """First listed source per (log_source, target)."""
    return rules.groupBy("log_source", "target").agg(F.min_by("source", "pos").alias("source"))


def source_of(rules, target: str) -> str:
    """First listed source of a target, else the target itself; rules of one source."""
    return next((s for t, s in rules if t == target), target)


def rules_as_xml(rules: DataFrame) -> DataFrame:
    """One mapping document per source: (source_name, parser_xml)."""
    fields = F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "target", "source"))),
        lambda r: F.struct(r["target"].alias("_target"), r["source"].alias("_source")),
    )
    documents = rules.groupBy(F.col("log_source").alias("source_name")).agg(fields.alias("field"))
    record = F.struct(F.col("source_name").alias("_name"), F.col("field"))
    return documents.select("source_name", F.to_xml(record, {"rowTag": "parser"}).alias("parser_xml"))

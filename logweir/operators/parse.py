"""Log lines to columns: JSON object first, then the source's pattern, then fallback."""

from pyspark.sql import DataFrame, functions as F

from logweir.constants import ANY_TIME_PATTERN, BLANK, EPOCH_TEXT
from logweir.functions.patterns import line_pattern
from logweir.functions.text import (
    json_object,
    last_key_wins,
    literal,
    not_blank,
    quoted,
    strip,
)

_WORK = ["_json", "_groups", "_text_time"]


def nonblank_lines(df: DataFrame, line_col: str = "value") -> DataFrame:
    """Strip each line and drop the blank ones; the result is in `line`."""
    value = quoted(line_col)
    return df.filter(not_blank(value)).withColumn("line", strip(value))


def any_time(line: str) -> str:
    """SQL text of the first time found anywhere in the text, else the epoch."""
    found = f"regexp_extract({line}, {literal('(?U)' + ANY_TIME_PATTERN)}, 1)"
    return f"coalesce(nullif(replace({found}, 'T', ' '), ''), {literal(EPOCH_TEXT)})"


class LineParser:
    """Parses `line` with one optional named-group pattern.

    `tokens` runs the JSON reader once and the pattern once per line; `field` then picks
    a value by name, so columns nobody asks for cost nothing. Fields are SQL text: a plan
    with many of them is built with few calls into the JVM.
    """

    def __init__(self, pattern: str | None = None):
        self.pattern = line_pattern(pattern) if pattern else None
        self.groups = self.pattern.names if self.pattern else []

    def tokens(self, df: DataFrame, line_col: str = "value", blank: bool = False) -> DataFrame:
        """Adds `parse_kind`, the JSON map and the pattern's groups.

        All three come out of an inline of one struct, none for a blank line unless asked for. Spark moves
        no filter on generated columns, and so on no field, below it, where a line would
        be parsed a second time for the filter.
        """
        groups, size = "CAST(NULL AS ARRAY<STRING>)", 0
        if self.pattern:
            groups, size = self.pattern.values("line"), self.pattern.count + 1
        lines = df.withColumn("line", strip(quoted(line_col)))
        lines = lines.withColumn("_obj", json_object("line"))
        lines = lines.withColumn("_obj", last_key_wins("_obj"))
        lines = lines.withColumn("_parts", F.expr(f"IF(_obj IS NULL, {groups}, NULL)"))
        kind = (
            f"CASE WHEN coalesce(length(line), 0) = 0 THEN {literal(BLANK)} WHEN _obj IS NOT NULL THEN 'json' "
            f"WHEN size(_parts) = {size} THEN 'regex' ELSE 'fallback' END"
        )
        parsed = f"named_struct('parse_kind', {kind}, '_json', _obj, '_groups', _parts)"
        lines = lines.selectExpr(
            *[quoted(c) for c in df.columns if c not in ("line", "parse_kind")],
            "line",
            f"inline(IF(coalesce(length(line), 0) >= {0 if blank else 1}, array({parsed}), array()))",
        )
        time = f"IF(parse_kind = 'fallback', {any_time('line')}, NULL)"
        return lines.withColumn("_text_time", F.expr(time))

    def _from_json(self, name) -> str:
        value = f"_json[{literal(name)}]"
        if name != "final_ts":
            return value
        stamp = "replace(_json['timestamp'], 'T', ' ')"
        return f"IF(map_contains_key(_json, 'timestamp'), {stamp}, {value})"

    def _from_groups(self, name) -> str:
        source = "timestamp" if name == "final_ts" and "timestamp" in self.groups else name
        return self.pattern.value_sql("_groups", source) if source in self.groups else "NULL"

    def field(self, name: str) -> str:
        """SQL text of one field of a tokenised line, null where the line lacks it."""
        from_text = {"final_ts": "_text_time", "raw_message": "line"}.get(name, "NULL")
        return (
            f"CAST(CASE parse_kind WHEN 'json' THEN {self._from_json(name)} "
            f"WHEN 'regex' THEN {self._from_groups(name)} ELSE {from_text} END AS STRING)"
        )

    def fields_except(self, known: list[str]) -> str:
        """SQL text of the map of all fields of a line but the known ones."""
        hidden = ", ".join(literal(k) for k in known)
        from_json = "_json"
        if "final_ts" not in known:
            stamped = f"map('final_ts', {self._from_json('final_ts')})"
            others = "map_filter(_json, (k, v) -> k <> 'final_ts')"
            from_json = (
                f"IF(map_contains_key(_json, 'timestamp'), map_concat({others}, {stamped}), _json)"
            )
        if known:
            from_json = f"map_filter({from_json}, (k, v) -> NOT k IN ({hidden}))"
        timed = ["final_ts"] if "timestamp" in self.groups else []
        names = [n for n in dict.fromkeys([*self.groups, *timed]) if n not in known]
        in_groups = ", ".join(f"{literal(n)}, {self._from_groups(n)}" for n in names)
        texts = {"final_ts": "_text_time", "raw_message": "line"}
        in_text = ", ".join(f"{literal(n)}, {v}" for n, v in texts.items() if n not in known)
        return (
            f"CAST(CASE parse_kind WHEN 'json' THEN {from_json} WHEN 'regex' THEN map({in_groups}) "
            f"ELSE map({in_text}) END AS MAP<STRING, STRING>)"
        )


def parse_lines(
    df: DataFrame, pattern: str | None = None, line_col: str = "value"
) -> DataFrame:
    """Open form: the input columns, `line`, `parse_kind` and `fields` (a map of all keys)."""
    parser = LineParser(pattern)
    fields = F.expr(parser.fields_except([]))
    return parser.tokens(df, line_col).withColumn("fields", fields).drop(*_WORK)


def parse_columns(
    df: DataFrame,
    names: list[str],
    pattern: str | None = None,
    line_col: str = "value",
    extras: bool = False,
    blank: bool = False,
) -> DataFrame:
    """Fixed form: one text column per name and, if asked, the other keys in `extras`.

    With `blank` a blank line is a row of that kind without fields.
    """
    parser = LineParser(pattern)
    passed = [c for c in df.columns if c != line_col and c not in names]
    columns = [f"{parser.field(n)} AS {quoted(n)}" for n in names]
    if extras:
        columns.append(f"{parser.fields_except(names)} AS extras")
    return parser.tokens(df, line_col, blank).selectExpr(
        *[quoted(c) for c in passed], "parse_kind", *columns
    )


def widen(df: DataFrame, keys: list[str], map_col: str = "fields") -> DataFrame:
    """Columns from a map of fields; columns that exist already are left alone."""
    missing = [k for k in keys if k not in df.columns]
    return df.withColumns({k: F.col(map_col)[k] for k in missing})


def field_keys(df: DataFrame, by: list[str], map_col: str = "fields") -> DataFrame:
    """Distinct keys per group; partial aggregation keeps the shuffle at keys x tasks."""
    return df.select(*by, F.explode(F.map_keys(map_col)).alias("key")).distinct()


def union_of_keys(df: DataFrame, map_col: str = "fields") -> DataFrame:
    """(key): all keys of a batch, however many. Which of them become columns is declared."""
    return field_keys(df, [], map_col)


def infer_field_types(df: DataFrame, line_col: str = "line") -> DataFrame:
    """(key, type): the merged type of each top-level key of all JSON object lines.

    A key that holds values of types that do not merge is a VARIANT, one of only nulls VOID.
    """
    values = df.select(F.try_parse_json(F.col(line_col)).alias("_v"))
    parts = values.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    return parts.filter("key IS NOT NULL").groupBy("key").agg(F.schema_of_variant_agg("value").alias("type"))


def first_lines(df: DataFrame) -> DataFrame:
    """First line of each file of a text scan, stripped; files that start blank are left out.

    Only the block at offset 0 of a file can hold its first line.
    """
    meta = F.col("_metadata")
    head = df.select(
        meta["file_path"].alias("file_path"),
        meta["file_name"].alias("file_name"),
        meta["file_block_start"].alias("start"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    ).filter(F.col("start") == 0)
    first = head.groupBy("file_path", "file_name").agg(F.min_by("value", "pos").alias("value"))
    return nonblank_lines(first).drop("value")

"""Detection stages: each takes and returns a DataFrame."""

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, functions as F

from logweir.constants import (
    DEFAULT_ALERT_MESSAGE,
    DEFAULT_RISK_SCORE,
    DETECTION_RULES,
    NOTIFY_SCORE,
)
from logweir.functions.text import literal, quoted


def with_defaults(df: DataFrame) -> DataFrame:
    """Rows with a score and a message, those of ordinary work where they bring none."""
    if "risk_score" not in df.columns:
        df = df.withColumn("risk_score", F.lit(DEFAULT_RISK_SCORE))
    if "alert_message" not in df.columns:
        df = df.withColumn("alert_message", F.lit(DEFAULT_ALERT_MESSAGE))
    return df


def score_rules(df: DataFrame, rules=DETECTION_RULES, match_col="action") -> DataFrame:
    """Risk score and message by equality on one column; other rows keep theirs."""
    df = with_defaults(df)
    column = quoted(match_col)
    scores = " ".join(f"WHEN {literal(v)} THEN {float(risk)!r}D" for v, risk, _ in rules)
    texts = " ".join(f"WHEN {literal(v)} THEN {literal(text)}" for v, _, text in rules)
    return df.withColumns(
        {
            "risk_score": F.expr(f"CASE {column} {scores} ELSE risk_score END"),
            "alert_message": F.expr(f"CASE {column} {texts} ELSE alert_message END"),
        }
    )


def score_rule_table(df: DataFrame, rules: DataFrame, match_col="action") -> DataFrame:
    """The same with rules as data (match_value, risk_score, alert_message), one per value."""
    df = with_defaults(df)
    table = rules.groupBy(F.col("match_value").alias("_value")).agg(
        F.max(F.struct("risk_score", "alert_message")).alias("_rule")
    )
    joined = df.join(table, df[match_col] == F.col("_value"), "left")
    rule = F.col("_rule")
    return joined.withColumns(
        {
            "risk_score": F.coalesce(rule["risk_score"], F.col("risk_score")),
            "alert_message": F.coalesce(rule["alert_message"], F.col("alert_message")),
        }
    ).drop("_rule", "_value")


def score_model(
    df: DataFrame, predict: Callable[[Iterator], Iterator] | None = None, schema=None
) -> DataFrame:
    """Slot for a model: rows pass through until a batch function over pandas is given."""
    return df if predict is None else df.mapInPandas(predict, schema or df.schema)


def to_notify(df: DataFrame, threshold: float = NOTIFY_SCORE) -> DataFrame:
    """Rows that go to notification."""
    return df.filter(F.col("risk_score") >= threshold)

"""Sources brought together, and totals over them."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from logweir.constants import HISTORY_PAGE


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; a column that one input lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def source_totals(df: DataFrame, source_col="log_source") -> DataFrame:
    """Rows per source, and over all sources in the row without a source."""
    return df.rollup(source_col).agg(F.count(F.lit(1)).alias("row_count"))


def latest_runs(history: DataFrame, limit: int = HISTORY_PAGE) -> DataFrame:
    """The newest runs; the id settles equal times."""
    return history.orderBy(F.col("collect_time").desc(), F.col("id").desc()).limit(limit)


def run_report(history: DataFrame, limit: int = HISTORY_PAGE) -> DataFrame:
    """The monitor's table: newest runs with formatted count and status label."""
    label = F.when(F.col("status") == "SUCCESS", "✅ 성공").otherwise("❌ 실패")
    return latest_runs(history, limit).select(
        "id",
        "collect_time",
        "source_name",
        "target_index",
        F.concat(F.format_number("processed_count", 0), F.lit(" 건")).alias("processed"),
        label.alias("status_label"),
    )

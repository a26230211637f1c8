"""Ordered chains of `DataFrame -> DataFrame` stages."""

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame

from logweir.operators.detect import score_rules

log = logging.getLogger(__name__)

Stage = Callable[[DataFrame], DataFrame]

DETECTION: list[Stage] = [score_rules]


def run_stages(df: DataFrame, stages: list[Stage]) -> DataFrame:
    """Apply the stages in order; one that cannot be planned is logged and skipped.

    Spark is lazy, so only planning errors show here; looking at the schema forces them.
    """
    for stage in stages:
        try:
            after = df.transform(stage)
            after.schema
        except Exception as error:
            log.error("stage %s skipped: %s", getattr(stage, "__name__", stage), error)
            continue
        df = after
    return df

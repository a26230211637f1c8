"""A model of behaviour: what a user did on a day against what the same user did before.

Profiles hold sketches, so those of many loads and days add up without going back to the rows:
distinct kinds of action by an HLL sketch, amounts by a KLL sketch. Of few values both are exact;
beyond, the distinct count is within some 3 % and a rank within some 1.5 % of the amounts (one
standard error and a 99 % bound of Spark's default sizes).
"""

from pyspark.sql import DataFrame, Window, functions as F

from logweir.constants import BEHAVIOUR_MESSAGE, BEHAVIOUR_SCORE
from logweir.operators.detect import with_defaults

KEYS = ["user_id", "event_date"]
#: Ranks at which the amounts before are looked up: the steps of `amount_rank`.
LEVELS = [n / 64 for n in range(1, 65)]


def day_profiles(events: DataFrame, kind: str = "action", amount: str = "bytes_total") -> DataFrame:
    """(user_id, event_date, n, kinds, amounts, top): a row per user and day of scored events.

    Events without a user or a day have no profile. Amounts that are null or not numbers are left out of
    the sketch; tasks sketch their own rows before the shuffle, so a busy user is no hot key.
    """
    number = F.nanvl(F.col(amount).cast("double"), F.lit(None).cast("double"))
    known = events.filter(F.col("user_id").isNotNull() & F.col("event_date").isNotNull())
    return known.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(F.col(kind).cast("string")).alias("kinds"),
        F.kll_sketch_agg_double(number).alias("amounts"),
        F.max(number).alias("top"),
    )


def merged_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles of several loads as one per user and day.

    An event that two loads hold counts twice: what is new or high does not change by that.
    """
    return profiles.groupBy(*KEYS).agg(
        F.sum("n").alias("n"),
        F.hll_union_agg("kinds").alias("kinds"),
        F.kll_merge_agg_double("amounts").alias("amounts"),
        F.max("top").alias("top"),
    )


def behaviour_scores(profiles: DataFrame, days: int = 14) -> DataFrame:
    """One row per user and day: what is new and how high it reaches, against the `days` days before.

    `new_kinds` are kinds of action of the day that the user's days before lack, `amount_rank` is
    the share of the amounts before that the day's highest reaches, in steps of 1/64. The score, from 0 to 100, is
    the mean of the share of new kinds and the rank; null where there is nothing to compare with.
    """
    day = F.datediff("event_date", F.lit("1970-01-01").cast("date"))
    before = Window.partitionBy("user_id").orderBy("_day").rangeBetween(-days, -1)
    rows = profiles.withColumn("_day", day).withColumns(
        {
            "base_n": F.coalesce(F.sum("n").over(before), F.lit(0)),
            "_kinds": F.hll_union_agg("kinds").over(before),
            "_amounts": F.kll_merge_agg_double("amounts").over(before),
        }
    )
    seen = F.hll_sketch_estimate("_kinds")
    filled = F.kll_sketch_get_n_double("_amounts") > 0
    rows = rows.withColumns(
        {
            "n_kinds": F.hll_sketch_estimate("kinds"),
            "new_kinds": F.when(
                F.col("base_n") > 0, F.greatest(F.hll_sketch_estimate(F.hll_union("kinds", "_kinds")) - seen, F.lit(0))
            ).cast("double"),
            "_levels": F.when(filled, F.kll_sketch_get_quantile_double("_amounts", F.array(*map(F.lit, LEVELS)))),
        }
    )
    reached = F.size(F.filter("_levels", lambda level: level <= F.col("top"))) / len(LEVELS)
    rows = rows.withColumn("amount_rank", F.when(F.col("_levels").isNotNull() & F.col("top").isNotNull(), reached))
    share = F.least(F.col("new_kinds") / F.greatest("n_kinds", F.lit(1)), F.lit(1.0))
    score = F.when(F.col("base_n") > 0, 50 * share + 50 * F.coalesce("amount_rank", F.lit(0.0)))
    return rows.withColumn("behaviour_score", score).select(
        *KEYS, "n", "base_n", "n_kinds", "new_kinds", "amount_rank", "behaviour_score"
    )


def score_behaviour(events: DataFrame, scores: DataFrame, threshold: float = BEHAVIOUR_SCORE) -> DataFrame:
    """The model's place among the detections: days that stand out raise the score of their events.

    Neither side is broadcast by hint: there is a row per user and day, and AQE splits a busy one.
    An event scored higher by a rule keeps its score and message.
    """
    high = scores.filter(F.col("behaviour_score") >= threshold).select(*KEYS, "behaviour_score")
    rows = with_defaults(events).join(high, KEYS, "left")
    above = F.col("behaviour_score") > F.col("risk_score")
    return rows.withColumns(
        {
            "alert_message": F.when(above, F.lit(BEHAVIOUR_MESSAGE)).otherwise(F.col("alert_message")),
            "risk_score": F.when(above, F.col("behaviour_score")).otherwise(F.col("risk_score")),
        }
    ).drop("behaviour_score")

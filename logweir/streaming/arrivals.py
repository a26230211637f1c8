"""Equal lines that a stream meets again, left out before they are stored."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logweir.plans.events import clean_events
from logweir.session import ship
from logweir.sources.spec import SourceSpec

_KEYED = "value string, place string, line_key binary"


def _first_of_batch(batches):
    """The first row of each key of an Arrow batch: a line that fills a file leaves a task as a few rows."""
    for batch in batches:
        codes = batch.column("line_key").dictionary_encode().indices.to_numpy()
        _, firsts = np.unique(codes, return_index=True)
        yield batch.take(pa.array(np.sort(firsts)))


def first_arrivals(lines: DataFrame, spec: SourceSpec) -> DataFrame:
    """(value, place) of the lines of which no equal one has arrived within `distinct_within` before.

    Two lines are equal when their text is and it holds a time. Without a time of its own, or
    with one that cannot be read, a line is told by its place too, so that none is left out. The
    delay is counted from the arrival, not by the time in the line: no line is too late for the
    state, which holds a digest of each line of that delay and no others. A line that comes again
    later is stored again; the index shows one of the two. Lines left out reach no load and so
    no history: the progress of the stream counts them (numDroppedDuplicateRows).

    Lines are parsed here for their time, and once more in the load.
    """
    ship(lines.sparkSession)
    # this policy looks at no other row of the batch
    alone = replace(spec, mapping_policy="last_present")
    timed = clean_events(lines.withColumn("arrived_line", F.col("value")), alone, blank=True)
    own = F.concat_ws("\n", "arrived_line", F.when(F.col("time_inferred"), F.col("place")))
    keyed = timed.select(F.col("arrived_line").alias("value"), "place", F.unhex(F.sha2(own, 256)).alias("line_key"))
    once = keyed.mapInArrow(_first_of_batch, _KEYED).withColumn("arrived", F.current_timestamp())
    held = once.withWatermark("arrived", spec.distinct_within).dropDuplicatesWithinWatermark(["line_key"])
    return held.select("value", "place")

"""Which of day and month comes first: settled for a column by all its values.

``1/2/2021`` reads two ways. Values like ``25/12/2021`` read only one way, so they vote, and the majority of a
column decides for all its values; without a majority the month comes first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.temporal import SLASHED_MONTH_FIRST, parse_timestamp
from tidepool.functions.text import strip_ws
from tidepool.session import stored

_SLASHED = r"^(\d{1,2})/(\d{1,2})/\d{4}(?: .*)?$"
assert SLASHED_MONTH_FIRST == "M/d/yyyy"  # the layout that the votes are about


def order_votes(long: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` + slashed, day_votes, month_votes, day_first of long data ``keys + value``, in one combined aggregate."""
    first, second = (F.regexp_extract(strip_ws(F.col("value")), _SLASHED, i).try_cast("int") for i in (1, 2))
    rows = long.select(*keys, first.alias("_a"), second.alias("_b"))
    votes = rows.groupBy(*keys).agg(
        F.count("_a").alias("slashed"), F.count_if((F.col("_a") > 12) & (F.col("_b") <= 12)).alias("day_votes"),
        F.count_if((F.col("_b") > 12) & (F.col("_a") <= 12)).alias("month_votes"))
    return votes.withColumn("day_first", F.col("day_votes") > F.col("month_votes"))


def parse_by_vote(long: DataFrame, keys: list[str], mixed: bool = False) -> DataFrame:
    """``long`` with ``ts`` and ``day_first``: every value parsed in the order its column voted for.

    Values that the order cannot read are null (T2); ``mixed`` reads them the other way round (T3). A column is a
    group of ``keys``; the votes are one row a column, written, so that they are broadcast only where small.
    """
    votes = stored(order_votes(long, keys).select(*(F.col(k).alias(f"_v{i}") for i, k in enumerate(keys)), "day_first"))
    on = [F.col(k).eqNullSafe(F.col(f"_v{i}")) for i, k in enumerate(keys)]
    rows = long.join(votes, on, "left").drop(*(f"_v{i}" for i in range(len(keys))))
    ts = parse_timestamp(F.col("value"), day_first=F.col("day_first"))
    if mixed:
        ts = F.coalesce(ts, parse_timestamp(F.col("value"), day_first=~F.col("day_first")))
    return rows.withColumn("ts", ts)

"""Bounded samples by hash, sized by distinct hashes, so that copies of a row change nothing."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 8  # of the hash range, for every halving of what is left of it


def _step(mark: Column) -> Column:
    """How near a 64-bit hash is to the lower end of its range: 0 in the upper part, 480 at most."""
    share = F.greatest(mark.cast("double") / F.lit(2.0**64) + 0.5, F.lit(2.0**-60))
    return F.floor(F.log2(share) * -STEPS).cast("int")


def smallest(rows: DataFrame, group: str, size: int) -> DataFrame:
    """The rows with the smallest values of the hash `mark` in each group.

    At least `size` distinct marks of a group get through, or all it has, and seldom many more than a
    tenth above `size`: distinct marks are counted per step of the hash range, and the cut is at a step.
    Tasks drop copies before they are counted; the driver gets 481 counts for a group at most.
    """
    step = _step(F.col("mark"))
    counted = rows.select(group, "mark").distinct().groupBy(group, step.alias("step")).count()
    counts: dict = defaultdict(dict)
    for row in counted.collect():
        counts[row[group]][row["step"]] = row["count"]
    if not counts:
        return rows.limit(0)
    pairs = []
    for value, own in counts.items():
        cut, total = 0, 0
        for at in sorted(own, reverse=True):
            total += own[at]
            if total >= size:
                cut = at
                break
        pairs += [F.lit(value), F.lit(cut)]
    return rows.where(step >= F.create_map(*pairs)[F.col(group)])

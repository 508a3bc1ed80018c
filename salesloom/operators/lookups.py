"""Lookup joins and referential integrity."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from salesloom.operators import skew
from salesloom.operators.single_rows import side_by_side
from salesloom.session import stored

# A table with no more rows, and no more bytes of keys, is broadcast: it takes about 60 MB then.
BROADCAST_ROWS, BROADCAST_BYTES = 400_000, 16 * 2**20


def lookup(
    rows: DataFrame, table: DataFrame, on: dict[str, str], spread_by: list[str], dealt: bool = False
) -> DataFrame:
    """Left join of `rows` to a table that is unique on the joined columns; keeps every row.

    `on` maps columns of `rows` to columns of `table`; the latter are not in the result. No
    broadcast is forced: Spark broadcasts a table that its statistics show to be small, and
    shuffles otherwise. Rows with a NULL key match nothing, so for a shuffle they are spread over
    the partitions by a hash of `spread_by`; a hot non-null key is split by adaptive execution. Rows that are
    `dealt` out by their keys already stay where they are.
    """
    missing = reduce(Column.__or__, [F.col(here).isNull() for here in on])
    salt = F.when(missing, F.xxhash64(*spread_by)).otherwise(F.lit(0))
    # Always 0, but not a constant to the optimizer, which would take a constant out of the keys.
    no_salt = F.pmod(F.xxhash64(*on.values()), F.lit(1))
    keys = {there: f"_on_{here}" for here, there in on.items()}
    added = [c for c in table.columns if c not in keys]
    right = table.select(
        *added, *[F.col(c).alias(k) for c, k in keys.items()], no_salt.alias("_no_salt")
    )
    matches = [F.col(here) == F.col(f"_on_{here}") for here in on]
    if not dealt:
        matches = [F.col("_salt") == F.col("_no_salt"), *matches]
    joined = rows.select("*", salt.alias("_salt")).join(right, matches, "left")
    return joined.select(*rows.columns, *added)


def resolve(
    rows: DataFrame, table: DataFrame, on: dict[str, str], spread_by: list[str], found: str
) -> tuple[DataFrame, DataFrame]:
    """Rows whose lookup found a key, and a one-row report of how many did not, with five of their keys.

    `found` is the column that the lookup table adds.
    """
    joined = lookup(rows, table, on, spread_by)
    missed = joined.where(F.col(found).isNull())
    return joined.where(F.col(found).isNotNull()), _report(missed, next(iter(on)))


def resolve_all(
    rows: DataFrame,
    lookups: list[tuple[DataFrame, dict[str, str], str]],
    spread_by: list[str],
    keep: Callable[[DataFrame], DataFrame] | None = None,
    dealt: bool = False,
) -> tuple[DataFrame, list[DataFrame]]:
    """Rows for which every lookup found a key, and the report of each lookup over the rows that it got.

    `lookups` are the table, `on` and `found` of `resolve`; a lookup gets the rows for which all before it
    found a key. Rows that are `dealt` out by the keys of the first lookup stay there for it. A table that
    counts as small is broadcast; after a lookup by another one, the rows are stored before they are dealt out
    again, which frees the shuffle files so far. The joined rows are stored once in the shared folder, from where
    the result and the reports are read; `keep` deals them out and stores them in its own way, and may add
    columns. A joined key stays only in the row that it was not found for, so that no more than the found one
    travels on; in the returned rows these columns are NULL.
    """
    spread_by = list(spread_by)
    joined = rows
    small = [_is_small(table, list(on.values())) for table, on, _ in lookups]
    for i, (table, on, found) in enumerate(lookups):
        known = F.col(found).isNotNull()
        later = [here for _, more, _ in lookups[i + 1:] for here in more if here not in on]
        held = F.broadcast(table) if small[i] else table
        joined = lookup(joined, held, on, spread_by, dealt and not i).withColumns({
            **{here: F.when(~known, F.col(here)) for here in on},
            **{here: F.when(known, F.col(here)) for here in later},
        })
        spread_by.append(found)
        if not small[i] and (keep or not all(small[i + 1:])):
            joined = stored(joined, "looked_up")
    kept = keep(joined) if keep else stored(joined, "resolved")
    reports = []
    for _, on, found in lookups:
        reports.append(_report(kept.where(F.col(found).isNull()), next(iter(on))))
        kept = kept.where(F.col(found).isNotNull())
    return kept, reports


def _is_small(table: DataFrame, keys: list[str]) -> bool:
    """Whether a lookup table is within the bounds for a broadcast, by its rows and the bytes of its keys."""
    if table.count() > BROADCAST_ROWS:
        return False
    length = F.octet_length(F.concat_ws("", *[F.col(c).cast("string") for c in keys]))
    return (table.agg(F.sum(length)).first()[0] or 0) <= BROADCAST_BYTES


def _report(missed: DataFrame, key: str) -> DataFrame:
    """One row: how many rows a lookup by `key` did not find, with five of their keys."""
    # Distinct keys are aggregated before the five smallest are taken.
    by_key = missed.groupBy(F.col(key).cast("string").alias("key")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    total = by_key.agg(
        F.lit(key).alias("key_column"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("missing_rows")
    )
    # Five keys at most.
    sample = by_key.select("key").orderBy("key").limit(5)
    keys = sample.agg(F.sort_array(F.collect_list("key")).alias("sample_keys"))
    return side_by_side(total, keys)


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Fact rows without a dimension row. A NULL foreign key is an orphan, a NULL key in the dimension is no match."""
    keys = dim.select(F.col(pk).alias("_pk")).where("_pk is not null")
    return fact.join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def count_orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str, nulls_count: bool) -> DataFrame:
    """One row with the number of orphan rows. The fact is reduced to its distinct keys first."""
    per_key = fact.groupBy(F.col(fk).alias("_fk")).agg(F.count(F.lit(1)).alias("_rows"))
    if not nulls_count:
        per_key = per_key.where("_fk is not null")
    keys = dim.select(F.col(pk).alias("_pk")).where("_pk is not null")
    return per_key.join(keys, F.col("_fk") == F.col("_pk"), "left_anti").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_count")
    )


def only_known(
    rows: DataFrame, table: DataFrame, key: str, hot: dict[int, int] | None = None, spread_by: list[str] | None = None
) -> DataFrame:
    """Rows whose key exists in the table. `hot` keys, from `skew.hot_keys`, are spread by `spread_by`."""
    return skew.join(rows, table.select(key), [key], hot or {}, spread_by or [key], "left_semi")


def only_unknown(
    rows: DataFrame, table: DataFrame, key: str, hot: dict[int, int] | None = None, spread_by: list[str] | None = None
) -> DataFrame:
    """Rows whose key does not exist in the table; otherwise as `only_known`."""
    return skew.join(rows, table.select(key), [key], hot or {}, spread_by or [key], "left_anti")


def visible_to(rows: DataFrame, grants: DataFrame, user: Column, column: str) -> DataFrame:
    """Rows whose `column` value is granted to the user; grants are (user_email, column) rows."""
    allowed = grants.where(F.col("user_email") == user).select(column)
    return rows.join(allowed, column, "left_semi")

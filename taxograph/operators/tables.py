"""Order-dependent table operations, made deterministic by an order column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def last_wins(df: DataFrame, key: str, values: list[str], order: str | Column = "row_id") -> DataFrame:
    """(key, values...): of rows with equal keys the last; null and empty keys are dropped."""
    rows = df.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    last = rows.groupBy(key).agg(F.max_by(F.struct(*values), order).alias("__last"))
    return last.select(key, *[F.col(f"__last.{v}").alias(v) for v in values])


def first_seen(df: DataFrame, key: str, values: list[str], order: str | Column = "row_id") -> DataFrame:
    """(key, values...): of rows with equal keys the first; null keys are dropped."""
    first = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*values), order).alias("__first"))
    return first.select(key, *[F.col(f"__first.{v}").alias(v) for v in values])


def melted(df: DataFrame, keys: list[str], keep: list[str], order: str = "row_id") -> DataFrame:
    """(key, keep..., at): a row per key column that is not null; at orders by column, then by row."""
    columns = F.array(*[F.struct(F.lit(k).alias("column"), F.col(c).alias("key")) for k, c in enumerate(keys)])
    rows = df.select(*keep, order, F.explode(columns).alias("__c"))
    return rows.filter("__c.key is not null").select(F.col("__c.key").alias("key"), *keep, F.struct("__c.column", order).alias("at"))


def in_either(df: DataFrame, columns: list[str], keys: DataFrame, key: str) -> DataFrame:
    """Rows any of whose columns is among the keys; each row once, the keys looked up by hash joins."""
    wanted = keys.select(F.col(key).alias("__k")).filter("__k is not null").distinct()
    out = df
    for n, c in enumerate(columns):
        out = out.join(wanted.select(F.col("__k").alias(f"__k{n}")), F.col(c) == F.col(f"__k{n}"), "left")
    hit = reduce(lambda a, b: a | b, (F.col(f"__k{n}").isNotNull() for n in range(len(columns))))
    return out.filter(hit).select(*df.columns)


def any_in(df: DataFrame, allowed: dict[str, list[str]]) -> DataFrame:
    """Rows where some column's value is among the values listed for it."""
    return df.filter(reduce(lambda a, b: a | b, (F.coalesce(F.col(c).isin(v), F.lit(False)) for c, v in allowed.items())))


def duplicate_groups(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """All members of groups with several rows of one non-null key, sorted by it.

    The groups are found by an aggregate and joined back, so that no task sorts a hot group's rows. It is
    a semi join, of which Spark never broadcasts the rows' side, however small their files are.
    """
    several = df.groupBy(key).count().filter(F.col(key).isNotNull() & (F.col("count") > 1)).select(key)
    return df.join(several, key, "left_semi").select(*df.columns).orderBy(key, *(order or []))


def with_columns_in_order(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with just these columns; those it lacks are null."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def top(df: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    """The k rows with the largest value; ties by the given columns."""
    return df.orderBy(F.col(by).desc(), *ties).limit(k)


def running_sum(df: DataFrame, value: str, order: str, out: str) -> DataFrame:
    """A cumulative sum over a table of a few rows (all go to one task)."""
    return df.withColumn(out, F.sum(value).over(W.orderBy(order).rowsBetween(W.unboundedPreceding, 0)))

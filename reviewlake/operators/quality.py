"""Data-quality flags and their summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.functions import any_of, is_blank, lossy_cast


def flag_nulls(df: DataFrame, columns: Sequence[str], name: str = "is_null_issue") -> DataFrame:
    """Mark rows where one of the columns is NULL or blank; absent columns are ignored."""
    return df.withColumn(name, null_issue(df, columns))


def null_issue(df: DataFrame, columns: Sequence[str]) -> Column:
    return any_of(is_blank(F.col(c)) for c in columns if c in df.columns)


def flag_type_issues(
    df: DataFrame, types: Mapping[str, T.DataType], name: str = "is_type_issue"
) -> DataFrame:
    """Mark rows that hold a value which cannot be read as its declared type."""
    return df.withColumn(
        name, any_of(lossy_cast(F.col(c), t) for c, t in types.items() if c in df.columns)
    )


def flag_duplicates(
    df: DataFrame, primary_key: Sequence[str], name: str = "is_duplicate"
) -> DataFrame:
    """Mark every row whose key occurs more than once; NULL keys count as equal.

    Counts are combined before the shuffle and joined back. A join, unlike a window over the key,
    may be split: AQE divides the rows of a hot key over tasks, and turns it into a broadcast join
    when the repeated keys prove small at run time. Without a (complete) key nothing is a duplicate.
    """
    if not primary_key or any(c not in df.columns for c in primary_key):
        return df.withColumn(name, F.lit(False))
    keys = {f"__key_{i}": column for i, column in enumerate(primary_key)}
    repeated = (
        df.groupBy(*[F.col(column).alias(alias) for alias, column in keys.items()])
        .agg(F.count("*").alias("__rows"))
        .filter(F.col("__rows") > 1)
    )
    same_key = reduce(and_, [df[column].eqNullSafe(repeated[alias]) for alias, column in keys.items()])
    return df.join(repeated, same_key, "left").select(
        *[df[c] for c in df.columns], F.col("__rows").isNotNull().alias(name)
    )


def quality_summary(
    df: DataFrame,
    primary_key: Sequence[str] = (),
    required: Sequence[str] = (),
    *,
    type_issue: str | None = None,
    type_issues_seen: int = 0,
    by: Sequence[str] = (),
) -> DataFrame:
    """Counts of rows, duplicates, nulls and type issues; one row, or one per ``by`` group.

    ``valid_count`` subtracts the three counts, so a row with two issues is subtracted twice;
    ``distinct_invalid`` counts rows with any issue once. Every column but key, required and flag
    columns is pruned. The key is counted in a two-step aggregation: both steps combine before the
    shuffle, so neither a hot key nor a hot group gathers in one task.
    """
    has_key = bool(primary_key) and all(c in df.columns for c in primary_key)
    flags = df.select(
        *[F.col(c) for c in by],
        *[F.col(c).alias(f"__key_{i}") for i, c in enumerate(primary_key if has_key else ())],
        null_issue(df, required).alias("__null"),
        (F.coalesce(F.col(type_issue), F.lit(False)) if type_issue else F.lit(False)).alias("__type"),
    )
    counts = {
        "total_records": F.count("*"),
        "null_count": F.count_if("__null"),
        "type_count": F.count_if("__type"),
        "any_issue": F.count_if(F.col("__null") | F.col("__type")),
    }
    if has_key:
        key_columns = [f"__key_{i}" for i in range(len(primary_key))]
        per_key = flags.groupBy(*by, *key_columns).agg(
            *[column.alias(name) for name, column in counts.items()]
        )
        repeated = F.col("total_records") > 1
        summary = per_key.groupBy(*by).agg(
            *[F.coalesce(F.sum(name), F.lit(0)).alias(name)
              for name in ("total_records", "null_count", "type_count")],
            F.coalesce(F.sum(F.when(repeated, F.col("total_records")).otherwise(0)), F.lit(0))
            .alias("duplicate_count"),
            F.coalesce(
                F.sum(F.when(repeated, F.col("total_records")).otherwise(F.col("any_issue"))),
                F.lit(0),
            ).alias("distinct_invalid"),
        )
    else:
        summary = flags.groupBy(*by).agg(
            *[column.alias(name) for name, column in counts.items()]
        ).withColumns({
            "duplicate_count": F.lit(0).cast("bigint"),
            "distinct_invalid": F.col("any_issue"),
        })
    if type_issues_seen:
        # Counted while the rows were written: afterwards the bad values are NULL.
        summary = summary.withColumn("type_count", F.col("type_count") + F.lit(type_issues_seen))
    total = F.col("total_records")
    issues = F.col("duplicate_count") + F.col("null_count") + F.col("type_count")

    def percentage(count: Column) -> Column:
        return F.when(total > 0, count / total * 100).otherwise(F.lit(0.0))

    return summary.select(
        *by,
        "total_records",
        "duplicate_count",
        "null_count",
        "type_count",
        (total - issues).alias("valid_count"),
        percentage(total - issues).alias("valid_percentage"),
        issues.alias("invalid_count"),
        percentage(issues).alias("invalid_percentage"),
        "distinct_invalid",
    )

"""Business rules on unified reviews: one row per key, ratings within range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.config import FlowConfig

REVIEW_KEY = ("review_id", "client_id", "source_system", "app_reference")
# Newest first; every further column only settles ties, so the survivor never depends on file order.
SURVIVOR_ORDER = ("review_date", "date_load", "ingestion_ts", "review_rating", "review_text",
                  "review_title", "review_version", "source_channel", "segment", "service_type",
                  "source_agent", "user_agent")

_RANK = "__rank"
_ANONYMOUS = "__anonymous"


def dedup_reviews(
    df: DataFrame,
    keys: Sequence[str] = REVIEW_KEY,
    order: Sequence[str] = SURVIVOR_ORDER,
    *,
    null_clients: str = "collapse",
) -> DataFrame:
    """The newest row of every key; NULL keys group together.

    ``row_number() = 1`` is a group limit: each task keeps only its best row of a key before the
    shuffle, so a key that holds a third of all rows sends one row per task.

    Rows without a client share the hash of their app as id. ``null_clients`` says what that means:
    ``collapse`` them like any key, ``keep`` them unless they are equal in every column, or
    ``reject`` them.
    """
    if null_clients not in ("collapse", "keep", "reject"):
        raise ValueError(f"unknown treatment of rows without client: {null_clients!r}")
    partition = [F.col(name) for name in keys]
    if null_clients == "reject":
        df = df.filter(F.col("client_id").isNotNull())
    elif null_clients == "keep":
        content = F.to_json(F.struct(*df.columns))
        df = df.withColumn(_ANONYMOUS, F.when(F.col("client_id").isNull(), F.sha2(content, 256)))
        partition.append(F.col(_ANONYMOUS))
    newest_first = [F.col(name).desc_nulls_last() for name in order if name in df.columns]
    ranked = df.withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*partition).orderBy(*newest_first))
    )
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK, _ANONYMOUS)


def filter_rating(df: DataFrame, low: int = 1, high: int = 5) -> DataFrame:
    """Ratings within the range; NULL ratings drop out."""
    return df.filter(F.col("review_rating").between(low, high))


def apply_review_rules(
    df: DataFrame,
    config: FlowConfig,
    *,
    filter_first: bool = False,
    null_clients: str = "collapse",
) -> DataFrame:
    """Deduplicate, then filter by rating.

    ``filter_first`` shuffles fewer rows but changes the result where a key has ratings on both
    sides of the range: an older valid row then survives instead of none.
    """
    low, high = int(config.rule("min_value", "1")), int(config.rule("max_value", "5"))
    if filter_first:
        return dedup_reviews(filter_rating(df, low, high), null_clients=null_clients)
    return filter_rating(dedup_reviews(df, null_clients=null_clients), low, high)

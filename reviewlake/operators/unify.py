"""Both review sources in one layout, and the cleaning of their text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.functions import (
    anonymize,
    clean_category,
    clean_identifier,
    clean_text,
    fold_accents,
    tidy,
)

# Defaults and constants of the unified table.
NO_TEXT = "NAO_INFORMADO"
NO_TITLE = "NAO_IDENTIFICADO"
NOT_APPLICABLE = "NA"
FIRST_VERSION = "1.0.0"
USER_AGENT = "REVIEWS"
EXTERNAL_CHANNEL = "external"
EXTERNAL_AGENT = "Itunes"
EXTERNAL_SYSTEM = "apple_reviews"
INTERNAL_SYSTEM = "internaldb_reviews"
FEED_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"

# Columns of the unified layout, in order.
UNIFIED_COLUMNS = (
    "review_id", "client_id", "review_date", "review_rating", "review_title", "review_text",
    "review_version", "source_channel", "source_system", "segment", "service_type",
    "source_agent", "ingestion_ts", "date_load", "user_agent", "app_reference",
)


def _or(name: str, default: str) -> Column:
    return F.coalesce(F.col(name), F.lit(default))


def _in_layout(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*[columns.get(name, F.col(name)).alias(name) for name in UNIFIED_COLUMNS])


def unify_external(df: DataFrame) -> DataFrame:
    """App-store reviews in the unified layout; ids are hashed, unreadable times become NULL."""
    return _in_layout(df, {
        "review_id": F.sha2("review_id", 256),
        "client_id": F.col("author_name"),
        "review_date": F.try_to_timestamp("updated_at", F.lit(FEED_TIME_FORMAT)),
        "review_rating": F.col("rating"),
        "review_title": _or("title", NO_TITLE),
        "review_text": _or("content", NO_TEXT),
        "review_version": _or("version", FIRST_VERSION),
        "source_channel": F.lit(EXTERNAL_CHANNEL),
        "source_system": F.lit(EXTERNAL_SYSTEM),
        "segment": F.lit(NOT_APPLICABLE),
        "service_type": F.lit(NOT_APPLICABLE),
        "source_agent": F.lit(EXTERNAL_AGENT),
        "user_agent": F.lit(USER_AGENT),
        "app_reference": F.upper(_or("app_reference", NO_TEXT)),
    })


def unify_internal(df: DataFrame) -> DataFrame:
    """Internal feedback in the unified layout; the id is a hash of client and app."""
    submitted = F.col("submission_date")
    if not isinstance(df.schema["submission_date"].dataType, T.TimestampType):
        submitted = F.try_to_timestamp(submitted.cast("string"))
    comment = F.col("feedback_comment")
    return _in_layout(df, {
        "review_id": F.sha2(F.concat_ws(":", "client_identification", "app_reference"), 256),
        "client_id": F.col("client_identification"),
        "review_date": submitted,
        "review_rating": F.coalesce(F.col("feedback_rating"), F.lit(0)).try_cast("int"),
        "review_title": F.lit(NO_TITLE),
        "review_text": F.when(comment != "", comment).otherwise(F.lit(NO_TEXT)),
        "review_version": F.coalesce(F.col("source_id").cast("string"), F.lit(FIRST_VERSION)),
        "source_system": F.lit(INTERNAL_SYSTEM),
        "segment": F.upper(_or("client_segment", NOT_APPLICABLE)),
        "service_type": _or("service_type", NOT_APPLICABLE),
        "source_agent": _or("source_user_agent", NO_TEXT),
        "user_agent": F.lit(USER_AGENT),
        "app_reference": F.upper(_or("app_reference", NO_TEXT)),
    })


def union_sources(*sources: DataFrame) -> DataFrame:
    """All rows of all sources, matched by column name; a column a source lacks is NULL there."""
    first, *others = sources
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def clean_reviews(
    df: DataFrame,
    *,
    legacy_map: bool = False,
    anonymize_client: bool = False,
    salt: str = "",
) -> DataFrame:
    """Cleaned text columns of the unified layout, in one projection.

    The client id is only normalised by default; ``anonymize_client`` replaces it by its digest.
    """

    def folded(name: str) -> Column:
        return fold_accents(F.col(name), legacy_map)

    client = clean_identifier(folded("client_id"))
    return df.withColumns({
        "review_text": clean_text(F.col("review_text"), legacy_map),
        "review_title": clean_text(F.col("review_title"), legacy_map),
        "source_channel": tidy(folded("source_channel")),
        "source_system": tidy(folded("source_system")),
        "client_id": anonymize(client, salt) if anonymize_client else client,
        "service_type": clean_category(folded("service_type")),
    })

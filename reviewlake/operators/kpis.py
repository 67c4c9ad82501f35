"""Monthly indicators on unified reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KPI_DIMENSIONS = ("review_year", "review_month", "review_version", "segment", "service_type",
                  "app_reference")
# Ratings that count for and against the promoter score.
PROMOTER = 5
DETRACTOR_UP_TO = 3
# Ratings of positive and negative sentiment.
POSITIVE_FROM = 4
NEGATIVE_UP_TO = 2


def prepare_for_kpis(df: DataFrame) -> DataFrame:
    """The columns the indicators need, with year and month as text; undated rows drop out."""
    dated = df.select("review_date", "review_rating", "review_version", "segment", "service_type",
                      "app_reference").na.drop(subset=["review_date", "review_rating"])
    return dated.withColumns({
        "review_year": F.date_format("review_date", "yyyy"),
        "review_month": F.date_format("review_date", "MM"),
    })


def review_kpis(df: DataFrame) -> DataFrame:
    """Count, mean, extremes and promoter score (-1..1) per month, version, segment, service, app.

    One hash aggregation with one shuffle.
    """
    rating = F.col("review_rating")
    score = (F.count_if(rating == PROMOTER) - F.count_if(rating <= DETRACTOR_UP_TO)) / F.count("*")
    return df.groupBy(*KPI_DIMENSIONS).agg(
        F.count("*").alias("review_count"),
        F.round(F.avg(rating), 1).alias("average_rating"),
        F.min(rating).cast("double").alias("min_rating"),
        F.max(rating).cast("double").alias("max_rating"),
        F.round(score, 2).alias("nps_score"),
    )


def sentiment_kpis(df: DataFrame) -> DataFrame:
    """Positive, negative and neutral reviews and their balance per month (``yyyyMM``)."""
    rating = F.col("review_rating")
    positive = F.count_if(rating >= POSITIVE_FROM)
    negative = F.count_if(rating <= NEGATIVE_UP_TO)
    dated = df.na.drop(subset=["review_date", "review_rating"])
    return dated.groupBy(
        F.date_format("review_date", "yyyyMM").alias("review_month"), "service_type", "app_reference"
    ).agg(
        F.count("*").alias("total_reviews"),
        positive.alias("positive_reviews"),
        negative.alias("negative_reviews"),
        F.count_if((rating > NEGATIVE_UP_TO) & (rating < POSITIVE_FROM)).alias("neutral_reviews"),
        F.round(F.avg(rating), 1).alias("avg_rating"),
        F.round((positive - negative) / F.count("*"), 2).alias("sentiment_score"),
    )

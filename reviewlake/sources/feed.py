"""App-store feed pages: nested documents to one flat row per review."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.config import ColumnSpec, build_schema

# Output columns and where an entry of the feed holds them. Every leaf is text.
FEED_FIELDS: dict[str, str] = {
    "author_uri": "author.uri.label",
    "author_name": "author.name.label",
    "author_label": "author.label",
    "updated_at": "updated.label",
    "rating": "im:rating.label",
    "version": "im:version.label",
    "review_id": "id.label",
    "title": "title.label",
    "content": "content.label",
    "content_type_attribute": "content.attributes.type",
    "link_rel": "link.attributes.rel",
    "link_href": "link.attributes.href",
    "vote_sum": "im:voteSum.label",
    "content_term": "im:contentType.attributes.term",
    "content_label": "im:contentType.attributes.label",
    "vote_count": "im:voteCount.label",
}

ENTRY_SCHEMA = build_schema(ColumnSpec(path) for path in FEED_FIELDS.values())
# Column in which Spark keeps the text of a page that it cannot parse.
CORRUPT = "_corrupt_record"
# A page with several reviews holds an array of entries, a page with one review a bare entry. Read
# as text, the node takes either form, and from_json turns a bare object into an array of one.
PAGE_SCHEMA = T.StructType([
    T.StructField("feed", T.StructType([T.StructField("entry", T.StringType())])),
    T.StructField(CORRUPT, T.StringType()),
])


def read_feed_pages(spark: SparkSession, paths: list[str] | str, multiline: bool = False) -> DataFrame:
    """All pages below the given folders; of readable ones only ``feed.entry`` is materialised."""
    reader = (spark.read.schema(PAGE_SCHEMA).option("recursiveFileLookup", "true")
              .option("columnNameOfCorruptRecord", CORRUPT))
    return reader.option("multiLine", str(multiline).lower()).json(paths)


def page_entries(pages: DataFrame) -> tuple[Column, Column]:
    """The reviews of a page, and whether the page is unreadable as a whole or in its entries."""
    entries = F.from_json(F.col("feed.entry"), T.ArrayType(ENTRY_SCHEMA))
    broken = F.col("feed.entry").isNotNull() & entries.isNull()
    return entries, broken | F.col(CORRUPT).isNotNull() if CORRUPT in pages.columns else broken


def flatten_feed(pages: DataFrame, on_corrupt: str = "error") -> DataFrame:
    """One row per review, in the declared column order. A page without entries gives no row.

    An unreadable page is an error, unless ``on_corrupt`` is ``"quarantine"``: then its reviews are left
    out here and the page is among ``unreadable_pages``.
    """
    if on_corrupt not in ("error", "quarantine"):
        raise ValueError(f"unknown treatment of unreadable pages: {on_corrupt!r}")

    entries, broken = page_entries(pages)
    if on_corrupt == "error":
        failure = F.raise_error(F.lit("unreadable feed page")).cast(T.ArrayType(ENTRY_SCHEMA))
        entries = F.when(broken, failure).otherwise(entries)
    return pages.select(F.explode(entries).alias("entry")).select(*review_fields())


def review_fields() -> list[Column]:
    """The declared columns of a review, from its ``entry``."""

    def leaf(path: str) -> Column:
        return reduce(lambda node, name: node.getField(name), path.split("."), F.col("entry"))

    return [leaf(path).alias(name) for name, path in FEED_FIELDS.items()]


def unreadable_pages(pages: DataFrame) -> DataFrame:
    """(page): the text of every page, or of its entries, that cannot be parsed."""
    _, broken = page_entries(pages)
    whole = F.col(CORRUPT) if CORRUPT in pages.columns else F.lit(None).cast("string")
    return pages.filter(broken).select(F.coalesce(whole, F.col("feed.entry")).alias("page"))

"""The corpus pipeline: toxicity, near copies, repeated passages, mixture, encoding.

Each stage takes all that the one before kept, written as Parquet and read again; the result of a stage
is what its decision leaves of the documents, in their own columns. The last stage gives tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.bpe import encoded, ids_text, vocabulary
from reviewlake.llm.common import cut, table
from reviewlake.llm.mixing import mix_sources
from reviewlake.llm.neardup import one_of_each
from reviewlake.llm.suffixes import remove_repeats
from reviewlake.llm.toxicity import fit_toxicity, toxicity_score

# Texts at least as similar are copies; passages at least as long are kept where they come first.
SIMILAR_PERCENT = 80
PASSAGE_BYTES = 200
WEIGHTS = (5, 2, 1)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the model learns from labelled ones among them.

    Each row is judged by its text alone, null as an empty one, of any length; repeated rows and ids stay or
    go alike. Without labels of both kinds all score the share of toxic labels. An empty table gives an empty result.
    """
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity_score(F.col("text"), model) < 0.5)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; see ``one_of_each``.

    Null, empty and blank texts, and rows without an id, all stay; of equal rows one stays. Rows that share an
    id but not their text are documents of their own.
    """
    return one_of_each(docs, SIMILAR_PERCENT)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without passages that an earlier document or an earlier part of it holds.

    All rows stay. Null text stays null; texts shorter than a passage stay whole; long ones are read whole.
    Rows that share an id are not before each other, those without an id come after all others. Columns
    of the input may have any name. An empty table gives an empty result.
    """
    whole = docs.select(F.struct("*").alias("doc"), "doc_id", "text")
    done = remove_repeats(whole, PASSAGE_BYTES, keep="first", as_text=True)
    cuts = F.size("repeats.removed") > 0
    changed = {"text": F.when(cuts, F.col("repeats.kept")).otherwise(F.col("doc.text")),
               "n_chars": F.when(cuts, F.length("repeats.kept").cast("long")).otherwise(F.col("doc.n_chars"))}
    return done.select(*(changed.get(c, F.col(f"doc.{c}")).alias(c) for c in docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it.

    Documents without words (null, empty or blank text) weigh nothing and are taken as ``mix_sources`` says;
    a null source is a source. Rows of one source with the same id, or with none, are taken alike. An empty
    table gives an empty result.
    """
    mixed = mix_sources(docs.select(F.struct("*").alias("doc"), "doc_id", "source", "text"), WEIGHTS)
    times = F.explode(F.sequence(F.lit(1), F.col("mix.repeats").cast("int")))
    return mixed.filter("mix.repeats > 0").select("doc", times.alias("time")).select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, their number, and digests of ids and of the text decoded from them.

    Null text is empty: no ids. Every row gives a row, repeated ones too, whatever their length.
    """
    tokens = docs.select("doc_id", "lang", "source", encoded(F.col("text"), vocabulary()).alias("tokens"))
    return tokens.select(
        "doc_id", "lang", "source", F.size("tokens.ids").cast("long").alias("n_tokens"), F.col("tokens.ids").alias("ids"),
        F.sha2(ids_text(F.col("tokens.ids")), 256).alias("ids_sha256"),
        F.sha2("tokens.decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("repeated passages", drop_passages),
    ("mixture", mix),
    ("encoding", encode),
]
# SQL cannot express the trained model or the tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

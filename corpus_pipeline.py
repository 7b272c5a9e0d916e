"""From raw documents to mixed, tokenized training shards, in stages.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)``
and returns a DataFrame, which is written as Parquet and read again for the next one.
All but the last return the columns of ``documents``. A document without an id cannot
be told from another such one: decisions about a null id hold for all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardledger.llm import decontamination, jaccard, language_id, mixing, repair
from wardledger.llm.shared import shared_path

#: Near duplicates: shingles of five words, similarity 0.8 or more.
NEAR = jaccard.Rule(words=5, num=80, den=100)

#: The language model has no SQL form, so neither has the whole; tests compare each stage with a plain version.
ORACLE_SQL = None


def _as_one(docs: DataFrame) -> DataFrame:
    """The rows as one column ``row``, so that their names meet no others; columns of any type may be among them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without letters (null or empty texts too) have none and go.

    Rows are judged one by one, whatever their ids; an empty table gives no rows.
    """
    found = language_id.identify(docs, language_id.fit(docs))
    return found.where(F.col("lang_pred") != language_id.UNKNOWN).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id, once.

    Texts are grouped, not ids: rows of one id with unlike texts are judged each on its
    own, and of rows of one id and text the one with the least hash stays. Texts without
    words are like no other. Rows with a null id stay; an empty table gives no rows.
    """
    rows = _as_one(docs)
    named = rows.where("row.doc_id IS NOT NULL").select(
        "row", F.col("row.doc_id").alias("id"), F.col("row.text").alias("text"), F.md5(F.coalesce("row.text", F.lit(""))).alias("text_id")
    )
    groups = jaccard.jaccard_components(named, id_col="text_id", rule=NEAR).distinct()
    # Texts without words are linked with nothing, so each id keeps its own.
    alone = F.when(F.col("n_shingles") == 0, F.col("id")).alias("alone")
    judged = named.select("id", "text_id").join(groups, "text_id")
    stay = judged.groupBy("component_id", alone).agg(F.min(F.struct("id", "text_id")).alias("least")).select("least.*")
    one = F.min_by("row", F.md5(F.to_json("row"))).alias("row")  # of repeated rows always the same one
    kept = named.join(stay, ["id", "text_id"], "left_semi").groupBy("id", "text_id").agg(one)
    return kept.select("row.*").unionAll(docs.where("doc_id IS NULL"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item.

    Texts without words (null ones too) stay. Rows of one id go together if one of them
    is hit, rows with a null id likewise; an empty table gives no rows.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = decontamination.decontaminate(docs, items).where("contaminated")
    hit = judged.select(F.col("doc_id").alias("hit_id")).distinct()
    return _as_one(docs).join(hit, F.col("row.doc_id").eqNullSafe(F.col("hit_id")), "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole: see ``mixing.mixed_rows`` for nulls, ties and empty tables."""
    return mixing.mixed_rows(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix, read back: a row for each document that was written.

    A null text is empty, rows of one id are written one after the other, null ids come
    first; an empty table gives no rows.
    """
    return repair.encode_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Training-data pipeline: quality rules, toxicity, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``.  All stages but the last
return the columns of their input, rows unchanged.

* ``quality``: documents that the rules of operator 2 reject go.
* ``toxicity``: documents that score ``THRESHOLD`` or more go; the model is fitted
  on the labelled documents among the stage's input.
* ``near_dedup``: of each group of near-duplicates by the measure of operator 9
  (80% of the shingles of four words) the document with the smallest id stays.  Of exact copies that share an id
  one row stays, and so of exact copies without one, unless a row with an id has
  their text.  Other rows without an id stay, and so do null texts.
* ``mixing``: every source keeps the token-prefix of its first seeded epoch that
  its share of the budget (90% of the tokens that are left) allows; no document is
  repeated.
* ``packing``: the pieces of all documents that are left.

Rows, stage by stage.  Null and empty texts, and texts of white space, fail the base rules of ``quality`` and
go there; a stage that is given them by itself scores them 0 (``toxicity``), links them with
nothing (``near_dedup``), gives them no tokens and lets their place in the epoch decide (``mixing``) and packs them as
one end token (``packing``).  Null languages have no reference in ``quality`` and are a leaf of their own in ``mixing``, as
null sources are; null ids are never linked.  Equal scores and places are treated alike; repeated rows are one
in ``near_dedup`` and judged alike elsewhere.  Texts are read whole, however long.  Empty input gives empty output.  Extra
columns go along with their rows, whatever their names.
SQL has no tokenizer and no segment search, so there is no oracle; the tests hold
the stages against brute-force versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cardmart.llm import mixing, neardup, packing, quality, toxicity
from cardmart.llm.common import Scratch, plain, table

ORACLE_SQL = None
SCORE = "__cm_toxicity"


def named(stage):
    """A stage that meets its extra columns under names that clash with nothing."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return plain(docs, lambda rows: stage(spark, rows, sf_dir))
    return run


@named
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality.judge_documents(docs)
    return judged.where(F.col(quality.QUALITY)["kept"]).select(*docs.columns)


@named
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_score(docs, model, SCORE).where(F.col(SCORE) < toxicity.THRESHOLD).select(*docs.columns)


@named
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What goes is decided from ids and hashes of texts; the texts go through one anti join.

    The key of a text is its md5, that of a null text is empty.  Keys whose rows all go are those of
    dropped ids, and those without an id whose text a row with an id has.  Of other keys
    with several rows one row is kept; null texts stay.
    """
    scratch = Scratch(spark, "copies")
    key = F.coalesce(F.md5("text"), F.lit(""))
    found = neardup.near_duplicates(docs)
    dropped = found.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    keys = scratch.cut(docs.groupBy(F.col("doc_id").alias("gone_id"), key.alias("gone_text"))
                       .agg((F.count(F.lit(1)) > 1).alias("several")), "keys")
    texts = keys.where("gone_id is not null and gone_text <> ''").select("gone_text").distinct()
    whole = (keys.join(dropped, "gone_id", "left_semi").select("gone_id", "gone_text").unionByName(
        keys.where("gone_id is null").join(texts, "gone_text", "left_semi").select("gone_id", "gone_text")))
    whole = scratch.cut(whole, "whole")
    same = (F.col("a.gone_id").eqNullSafe(F.col("b.gone_id"))) & (F.col("a.gone_text") == F.col("b.gone_text"))
    several = scratch.cut(keys.where("several and gone_text <> ''").alias("a").join(whole.alias("b"), same, "left_anti")
                          .select("gone_id", "gone_text"), "several")
    scratch.drop("keys")

    here = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (key == F.col("gone_text"))
    # Of equal rows the first is kept before the exchange, so a large group is no large partition.
    order = F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind])
    place = F.row_number().over(Window.partitionBy("gone_id", "gone_text").orderBy(order))
    one = docs.join(several, here).withColumn("gone_place", place).where("gone_place = 1").select(*docs.columns)
    return docs.join(whole.unionByName(several), here, "left_anti").unionByName(one)


@named
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    taken = mixing.mix(docs, budget_share=0.9, max_epochs=1).where("epochs > 0").select(
        F.col("doc_id").alias("__cm_id"), F.col("text_md5").alias("__cm_md5")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("__cm_id")) & (F.md5(F.coalesce(docs["text"], F.lit(""))) == F.col("__cm_md5"))
    return docs.join(taken, same, "left_semi").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", quality_stage), ("toxicity", toxicity_stage), ("near_dedup", near_dedup_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.cut(stage(spark, docs, sf_dir), name)
    return docs

"""Corpus pipeline: toxicity, quality, line de-duplication, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and calls one operator of :mod:`baobab.llm`; all but the last return the columns
of ``docs``.  :func:`run` writes every stage as Parquet into the shared folder of
``spark.checkpoint.dir`` and reads it again for the next one, so that a lost
executor costs at most a stage.  Nulls, empty texts, repeated rows, empty tables
and further columns follow the operators' docstrings; what they mean for a stage
is said at the stage.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baobab.llm import lines, packing, quality, simhash, toxicity
from baobab.llm.common import cut, table
from baobab.session import ensure_checkpoint_dir

#: Not expressible in SQL (trained models, fingerprints, tokenizers): tests compare
#: every stage with a brute-force version instead.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents of a toxicity score of 0.7 or more go.

    Learns from the labels of ``sf_dir`` outside the held-out fold and the texts
    of ``docs``.  Documents with a null or empty text are scored like any other."""
    scorer = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.scored(docs, scorer, out="__p_score")
    return scored.where(F.col("__p_score") < toxicity.REJECT).drop("__p_score")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that fail the base rules or diverge from their language go.

    Null and empty texts have no words and go; references are those of ``docs``."""
    return quality.measure(docs, out="__p_quality").where("__p_quality.kept").drop("__p_quality")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: lines of later occurrences of three-line windows go; n_chars
    follows the text.  Documents stay, even if their text becomes empty."""
    columns = docs.columns
    done = lines.dedup_lines(docs, lines_col="__p_lines", removed_col="__p_removed")
    if "n_chars" in columns:
        changed = F.col("__p_removed") > 0
        n_chars = F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
        done = done.withColumn("n_chars", n_chars)
    return done.select(*columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of every group of near-duplicates the document of the smallest
    id stays, once.

    Rows are told apart by id and content, so one id on unrelated texts is a
    document of each of their groups.  Rows without an id come after all others of
    their group; of rows of one id, and of those without any, the smallest hash
    of all columns decides."""
    kept = docs.columns
    name = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id"), F.xxhash64(*kept).alias("content"))
    named = docs.withColumn("__p_id", name)
    found = simhash.near_duplicates(named.select("__p_id", "text"), id_col="__p_id", shingle=3, radius=2)
    first = cut(found.where("__p_id = component_id").groupBy("__p_id").agg(F.count("*").alias("__p_n")))
    once = named.join(first.where("__p_n = 1"), "__p_id", "left_semi").select(*kept)
    # repeated rows: ids and contents are nearly always unique, so few are grouped as a whole
    several = named.join(first.where("__p_n > 1"), "__p_id", "left_semi")
    several = several.groupBy("__p_id").agg(F.min(F.struct(*kept)).alias("__p_row")).select("__p_row.*")
    return once.unionByName(several)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the token pieces of all documents that are left, packed best fit
    into sequences of at most 2048 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(docs, path, capacity=2048, end_id=0).drop("ids")


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; the rows of the last one."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs

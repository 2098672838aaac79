"""A training corpus from the table ``documents``, stage by stage.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as
the next one's ``docs``. All but the last return the columns of ``documents``.

1. ``quality``: documents that the quality classifier scores below 0.7 go.
2. ``near_duplicates``: of each group linked by 5-word shingles at similarity
   0.8 the document with the smallest id stays.
3. ``decontaminate``: words in windows shared with a benchmark item are cut out;
   a document that is mostly such words goes.
4. ``mix``: rows are repeated or left out so that sources meet their weights.
5. ``tokens``: token ids in training order, in fixed-stride binary shards; the
   result has one row for each sequence, read back from the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, materialise, mixing, ngram_join, quality
from tessera.llm.common import prepare, scratch_path, table

#: the classifier and the stages that depend on it are not expressible in SQL
ORACLE_SQL = None

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIN_QUALITY = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and empty texts are scored like any other; without labels every document scores 0.5 and stays."""
    labels = table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, usable=F.lit(True))
    return quality.filter_quality(docs.select(*COLUMNS), model, MIN_QUALITY if model.slope else 0.0)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words are in no group and stay."""
    return ngram_join.keep_one(docs.select(*COLUMNS), width=5, percent=80)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark windows stay as they are; ``n_chars`` follows the text where it is cut."""
    clean = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), keep=("lang", "source", "n_chars"))
    chars = F.when(F.col("n_hit") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", chars).select(*COLUMNS)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words have nothing to mix and go."""
    return mixing.mixed_rows(docs.select(*COLUMNS))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``slot, shard, doc_id, seq_no, n_tokens, ids_crc32`` of every sequence."""
    prepare(spark)
    out = materialise.fresh_output(spark)
    manifest = materialise.materialise(docs, out, stable=True)
    if not manifest.limit(1).count():
        return spark.createDataFrame([], "slot long, shard int, doc_id long, seq_no long, n_tokens long, ids_crc32 long")
    return materialise.read_shards(spark, out)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix_stage),
    ("tokens", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is written to the shared folder and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training corpus in five stages, each a Spark job over all that its predecessor kept.

toxicity        documents that the classifier rejects go
near_duplicates one document of each group of near-duplicates (0.8 of the shingles of five words) stays
decontamination documents that cover a benchmark item go
personal_data   spans of personal data give way to their kind in brackets
packing         the texts' ids in windows of 2048

A stage is ``(spark, docs, sf_dir) -> DataFrame``; all but the last return the columns of ``docs``.
The classifiers learn from what the stage itself is given: the toxicity classifier from
labelled rows of its documents (and of the ``labels`` table), the span classifier from its
candidates. Null and empty texts pass every stage (as near-duplicates of nothing). Near-duplicates and
decontamination tell rows apart by a 64-bit hash of doc_id and text, so rows that share a doc_id and rows without
one are treated like all others; of rows equal in both one stays. Of a group the row of the smallest doc_id stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.llm import decontamination, near_duplicates, packing, pii, toxicity
from lathework.registry.tables import table
from lathework.session import scratch_folder

SHINGLE = 5  # words; the two words of op10's query are its own contract
BATCH_BYTES = 4 << 20
CACHED_WORDS = 150_000  # the table outlives its stage in Python workers that the other stages use too


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of a few MB: with the default of 10,000 rows a task holds several copies of tens of MB.

    The setting is read when a stage's result is written, so it stays set.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = toxicity.fit_on(docs, table(spark, sf_dir, "labels"))
    mark = "_toxic_score" + "_" * max(map(len, docs.columns), default=0)  # a name no column has
    return toxicity.scored(docs, model, mark).where(F.col(mark) < 0.5).select(*docs.columns)


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row's doc_id and text, and the key's name, which no column had."""
    name = "_row_key" + "_" * max(map(len, docs.columns), default=0)
    parts = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), F.col("text")]
    return docs.withColumn(name, F.xxhash64(*parts)), name


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    rows, key = keyed(docs)
    groups = near_duplicates.near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), size=SHINGLE)
    members = groups.select(F.col("doc_id").alias(key), "component_id").distinct().join(rows.select(key, "doc_id").distinct(), key)
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", F.col(key).alias("key"))
    first = members.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.key").alias(key))
    return rows.join(first, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    rows, key = keyed(docs)
    found = decontamination.contaminated(rows.select(F.col(key).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    found = decontamination.kept(found.select(F.col("doc_id").alias(key)).distinct())
    return rows.join(found, key, "left_anti").select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    _, classifier = pii.found(docs.select("doc_id", "text"))
    clean = pii.redacted(docs, classifier)
    return clean.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else clean


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.packed_documents(docs.select("doc_id", "text"), cached_words=CACHED_WORDS)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", decontaminate),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]

ORACLE_SQL = None  # the classifiers, the tiling and the packing have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; every result is a table below the shared folder and the next stage's input."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        folder = scratch_folder(spark)
        result = stage(spark, docs, sf_dir)
        result.write.parquet(folder)
        docs = spark.read.schema(result.schema).parquet(folder)
    return docs

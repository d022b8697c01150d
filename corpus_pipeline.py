"""The corpus pipeline: five stages over documents, each on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquarry.llm import decontaminate, packing, quality, simhash, suffixes
from skyquarry.llm.common import scratch_path
from skyquarry.llm.queries import QUALITY_CUT, crc_mod, table, tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least the cut. Labels teach as in op1: only the rows that are not held out.

    Every row is judged by its own text, so repeated rows stay or go together; null and empty texts are scored like any
    other. Other columns, whatever their names, are kept as they are.
    """
    net = quality.trained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)
    mark = unused("quality", docs)
    return quality.scored(docs, net, score_col=mark).where(F.col(mark) >= QUALITY_CUT).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set connected by a similarity of 0.8 or more of 5-word shingles: that of the least id.

    Null, empty and blank texts are copies of each other. Rows that repeat count once; of rows with one id and different
    texts each is judged by its text. A null id is the greatest.
    """
    return simhash.without_near_copies(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that repeat; n_chars follows where there is such a column. A document of which nothing is left goes, unless it was null or empty before.

    Rows that repeat are repeats of one another, and go where nothing else is in them.
    """
    empty = unused("was_empty", docs)
    cut = suffixes.deduplicated(docs.withColumn(empty, F.coalesce(F.length("text"), F.lit(0)) == 0))
    kept = cut.where(F.col(empty) | (F.length("text") > 0))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs. Null and empty texts stay; every row is judged by its own text, whatever its id."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document that is left, with its token ids. A null or empty text is its end token; rows that repeat are packed each."""
    return packing.packed(docs, tokenizer_path(), keep_ids=True).withColumnRenamed("id", "doc_id")


def unused(name: str, docs: DataFrame) -> str:
    """name, made longer until no column of docs has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


STAGES = [("quality", keep_quality), ("near_copies", drop_near_copies), ("repeats", cut_repeats), ("contamination", drop_contaminated), ("packing", pack)]
#: A learned classifier and a tokenizer have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

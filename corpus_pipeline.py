"""From raw documents to packed training sequences.

Every stage takes (spark, docs, folder of the tables) and works on all that the one before
kept; the first four return the columns of the documents, the last one packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from txvigil.llm import jaccard, lines, mixing, packing, quality
from txvigil.llm.common import beside, stored, table, unused

# Near copies share this much of their runs of so many words.
WORDS, THRESHOLD = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules themselves and are on a host that mostly does.

    Null and empty texts fail; documents without a source are on one host; equal rows are
    judged alike. Columns of any name keep their values. An empty table stays empty.
    """
    other = [c for c in docs.columns if c not in ("text", "source")]
    own = {c: f"_own_{number}" for number, c in enumerate(other)}
    measured = quality.measured(docs.withColumnsRenamed(own))
    rates = stored(quality.host_rates(measured.select("source", "base_failed")))
    kept = quality.with_verdicts(measured, rates).filter("kept")
    return kept.select([F.col(own.get(c, c)).alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines like earlier ones; those without any line left go.

    Null and empty texts lose nothing and stay; rows with the same id, or none, are one place,
    and lose the same lines. An empty table stays empty.
    """
    kept = lines.deduped(docs).filter("n_removed = 0 OR n_removed < n_lines AND text RLIKE '[^ \\t-\\r]'")
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Rows are told apart by a number of their own, so texts that share an id, or have none, are
    grouped by what they say; a row without id stays only where no other of its group has one.
    Rows without words are like no other and stay. An empty table stays empty.
    """
    row = unused("_row", docs.columns)
    # What the stage before has shuffled is not needed any more; it may be large.
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), free=True)
    texts = numbered.select(F.col(row).alias("doc_id"), "text")
    groups = stored(jaccard.grouped(texts, words=WORDS, threshold=THRESHOLD))
    # Few rows are in a group with others; only of these the ids are looked up.
    alone = F.col("n") == 1
    sizes = groups.groupBy("component_id").agg(F.count("*").alias("n"))
    shared = groups.join(sizes.filter(~alone).select("component_id"), "component_id")
    named = shared.select(F.col("doc_id").alias(row), "component_id").join(numbered.select(row, "doc_id"), row)
    first = F.min_by(F.col(row), F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("first")
    firsts = named.groupBy("component_id").agg(first)
    others = named.join(firsts, "component_id").filter(F.col(row) != F.col("first")).select(row)
    return numbered.join(beside(stored(others)), row, "left_anti").select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix of sources takes, as rows; none of some.

    Null and empty texts have no words, so nothing takes them; documents without a source are
    one source. Rows with the same id, or none, are taken alike. An empty table stays empty.
    """
    key, times, copy = (unused(name, docs.columns) for name in ("_id", "_copies", "_copy"))
    taken, _ = mixing.mix(docs.select("doc_id", "text", "source"), F.array("source"))
    copies = taken.filter("copies > 0").select(F.col("doc_id").alias(key), F.col("copies").alias(times))
    copies = beside(stored(copies.dropDuplicates([key])))
    mixed = docs.join(copies, F.col("doc_id").eqNullSafe(F.col(key)))
    repeated = F.explode(F.array_repeat(F.lit(1), F.col(times).cast("int")))
    return mixed.withColumn(copy, repeated).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("source mix", source_mix),
    ("packing", packing_stage),
]

# Tokenising and grouping are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each one returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs

"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession, functions as F

from txvigil.llm import (
    chats,
    gnat,
    jaccard,
    lines,
    manifest,
    mixing,
    packing,
    projections,
    quality,
    repeats,
    urls,
    winnowing,
    wrappers,
)
from txvigil.llm.common import stored, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query
def op1_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return wrappers.extracted(table(spark, sf_dir, "pages"))


@query
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by shared 4-word shingles, 85 % or more of them."""
    return jaccard.grouped(table(spark, sf_dir, "documents"))


# A conversation whose texts hold the template's own marks.
_MARKED = r"\### Assistant: </turn> ok"


@query
def op3_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one full of control strings, digested from the tree."""
    columns = "conv_id", "turn", "role", "text"
    marked = spark.createDataFrame(
        [(-7, n, role, _MARKED) for n, role in enumerate(("user", "assistant"))],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, sf_dir, "conversations").select(*columns).unionByName(marked)
    nodes, steps, ends = chats.prefix_tree(rows)
    return chats.read_back(stored(nodes), steps, ends)


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all texts without strings of 50 bytes that an earlier document has."""
    found = repeats.deduped(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("kept")


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that are like an earlier one (80 % of the words)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return lines.deduped(docs).select("doc_id", "n_lines", "n_removed", kept)


@query
def op6_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages: by rule, or by what the host graph says of the host."""
    pages = urls.judged(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "host", "path", "rule", "verdict")


@query
def op7_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdicts; a document's host is its source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    docs = stored(quality.measured(docs).drop("text"))
    judged = quality.with_verdicts(docs, quality.host_rates(docs))
    measures = [m.split()[0] for m in quality.MEASURES.split(", ")]
    return judged.select("doc_id", *measures, "kept")


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the start of the following one."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _compared(row: dict, following: dict) -> dict:
    text, after = row["text"] or "", following["text"] or ""
    changed = edited(text, after)
    own, new, other = (winnowing.fingerprint(t)[0] for t in (text, changed, after))
    return {
        "n_chars": len(text),
        "edited_sha256": sha256(changed.encode()).hexdigest(),
        "fingerprint": winnowing.as_text(own),
        "edited_fingerprint": winnowing.as_text(new),
        "near_edited": winnowing.likeness(own, new),
        "near_next": winnowing.likeness(own, other),
    }


@query
def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts, of their edited form, and how alike they and neighbours are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    added = (
        "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return winnowing.next_rows(docs, "doc_id", added, _compared, tasks(spark), drop=["text"])


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all documents takes; each belongs to the one source of its row."""
    docs = table(spark, sf_dir, "documents")
    taken, sources = mixing.mix(docs, F.array("source"))
    keyed = taken.withColumn("key", F.element_at("pattern", 1))
    columns = "doc_id", "size", "source_size", "target"
    return keyed.join(sources, "key").select(
        *columns, (F.col("size") * F.col("copies")).alias("taken")
    )


@query
def op11_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of a label, linked from a cosine of 0.98."""
    return projections.linked(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents by language; of a third of the ids the text was tampered with."""
    docs = table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    tampered = F.when(changed, F.translate("text", _UPPER, _UPPER.lower())).otherwise(F.col("text"))
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf, claim = (manifest.leaf_digest([*fields, text]) for text in (F.col("text"), tampered))
    return manifest.manifest(docs, "lang", "doc_id", leaf, claim).withColumnRenamed("id", "doc_id")


@query
def op13_gnat_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the positives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return gnat.mined(table(spark, sf_dir, "embeddings"), lambda key: key % 100 == 0, label=label)

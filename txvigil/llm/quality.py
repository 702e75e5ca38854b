"""Quality rules with verdicts per host.

Every document is measured on its own. The rates at which a host's documents fail are
shrunk towards a beta prior fitted to all hosts, so that a host with few documents is not
judged by them alone, and a host that mostly fails is rejected as a whole.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txvigil.llm.common import one_row, unused, with_columns

MIN_WORDS = 50
MAX_REPEATED = 50
# A host is rejected when its shrunk failure rate is above this.
MAX_RATE = 0.5

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean"
)
_SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three words that occur at least twice."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    seen: set[tuple] = set()
    twice = {w for w in windows if w in seen or seen.add(w)}
    if not twice:
        return 0
    covered, end = 0, 0
    for start, window in enumerate(windows):
        if window in twice:
            covered += start + 3 - max(start, end)
            end = start + 3
    return covered


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, duplicate lines, repeated words of a text."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()
    spaces = len(raw) - sum(map(len, words))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated_words(words)
    )


def _measured(texts: pa.Array) -> list[pa.Array]:
    found = [measure(text.as_py()) for text in texts]
    failed = [
        words < MIN_WORDS or 100 * repeated > MAX_REPEATED * words
        for words, _, _, _, repeated in found
    ]
    columns = list(zip(*found, strict=True)) or [()] * 5
    return [*[pa.array(c, pa.int64()) for c in columns], pa.array(failed, pa.bool_())]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measures of ``MEASURES``; a null or empty text has no words and fails."""
    return with_columns(docs, [text], MEASURES, _measured)


def host_rates(docs: DataFrame, host: str = "source") -> DataFrame:
    """Per host: documents, failures, and the failure rate shrunk by the empirical prior.

    The prior has the mean of all documents and the strength that the method of moments
    gives from the spread of the rates between hosts beyond what chance explains. No
    documents without a host are judged together, as one host.
    """
    hosts = docs.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")
    )
    rate = F.col("failed") / F.col("n")
    moments = hosts.agg(
        F.sum("n").alias("_n"),
        F.sum("failed").alias("_failed"),
        F.sum(F.col("failed") * rate).alias("_squares"),
        F.count("*").alias("_hosts"),
        F.sum(F.col("n") * F.col("n")).alias("_sizes"),
    )
    mean = F.col("_failed") / F.col("_n")
    within = mean * (1 - mean)
    # Weighted between-host sum of squares, less what binomial noise alone would give.
    between = (F.col("_squares") - F.col("_n") * mean * mean - (F.col("_hosts") - 1) * within) / (
        F.col("_n") - F.col("_sizes") / F.col("_n")
    )
    strength = F.when(within == 0, 1.0).when(
        (F.col("_hosts") > 1) & (between > 0), F.greatest(within / between - 1, F.lit(1.0))
    )
    # Rates no further apart than chance: the prior outweighs any single host.
    strength = F.coalesce(strength, F.col("_n").cast("double"))
    prior = moments.select(mean.alias("prior_mean"), strength.alias("prior_strength"))
    shrunk = (F.col("failed") + F.col("prior_mean") * F.col("prior_strength")) / (
        F.col("n") + F.col("prior_strength")
    )
    return one_row(hosts, prior).withColumn("rate", shrunk)


def with_verdicts(
    docs: DataFrame, rates: DataFrame, host: str = "source", max_rate: float = MAX_RATE
) -> DataFrame:
    """Adds ``kept``: false where a document fails itself or its host is rejected.

    The host's rate comes back by an equi-join with one row per host; null hosts match. A host
    without a rate rejects nothing; a column ``kept`` is replaced; an empty table stays empty.
    """
    own, good = unused("_host", docs.columns), unused("_host_kept", docs.columns)
    verdicts = rates.select(F.col("host").alias(own), (F.col("rate") <= max_rate).alias(good))
    joined = docs.join(verdicts, F.col(host).eqNullSafe(F.col(own)), "left")
    kept = ~F.col("base_failed") & F.coalesce(good, F.lit(True))
    return joined.withColumn("kept", kept).drop(own, good)

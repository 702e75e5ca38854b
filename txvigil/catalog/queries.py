"""One query per operator. Each takes (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from txvigil.catalog.views import AS_OF, AS_OF_ORDERS, emit, transactions
from txvigil.functions import parse_timestamp, stamp
from txvigil.operators import deltas, filters, flags, keys, ordering, pairs, rolling
from txvigil.plans.families import CCW, LISTRIK, RULES, TF_ONLINE, Family
from txvigil.plans.jobs import ingest, output_refs, run_family, update_flags
from txvigil.plans.rules import Rule, evaluate, flagged_refs
from txvigil.schema import ACCOUNT, AMOUNT, AT, CATEGORY, CHANNEL, REF, STATE, STATUS, TRANSACTION
from txvigil.sources import drops, tables
from txvigil.sources.files import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# Added to a closed span, the shortest stretch it can be grouped by.
TICK = timedelta(microseconds=1)


def hours(n: float) -> timedelta:
    return timedelta(hours=n)


def days(n: float) -> timedelta:
    return timedelta(days=n)


# Thresholds that single out a part of the given tables; the shapes are the rules' own.
# rule -> (table, span, threshold, lookback)
TUNED = {
    "ccw": ("events", hours(6), 3, 20),
    "tf_online_5min": ("events", hours(1), 2, 15),
    "tf_online_10min": ("events", hours(6), 4, 15),
    "tf_online_50mio": ("events", hours(24), 200, 15),
    "tf_online_50mio_early": ("events", hours(24), 100, 15),
    "ewallet_10min": ("orders", days(30), 3, 2000),
    "ewallet_5mio": ("orders", days(30), 500_000, 2000),
    "listrik_10min": ("events", hours(24), 5, 12),
    "listrik_5mio": ("events", hours(24), 300, 12),
    "pulsa_10min": ("orders", days(60), 4, 2000),
    "pulsa_5mio": ("lineitem", days(2), 200_000, 2000),
    "qr_10min": ("events", timedelta(minutes=10), 2, None),
    "qr_5mio": ("lineitem", days(2), 150_000, None),
    "non_qr_10min": ("lineitem", days(2), 4, None),
    "non_qr_5mio": ("orders", days(30), 400_000, None),
}



def tuned(name: str) -> Rule:
    _, span, at_least, lookback = TUNED[name]
    return replace(RULES[name], span=span, at_least=at_least, lookback=lookback)


def as_of(table: str) -> date:
    return AS_OF if table == "events" else AS_OF_ORDERS


def rule_query(name: str) -> Query:
    table = TUNED[name][0]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return emit(evaluate(tuned(name), transactions(spark, sf_dir, table), as_of(table)))

    return run


for _name in TUNED:
    QUERIES[f"rule_{_name}"] = rule_query(_name)


@query
def rule_ccw_warmup(spark, sf_dir):
    rows = transactions(spark, sf_dir)
    return emit(evaluate(tuned("ccw"), rows, AS_OF, warmup=True))


# Sources and sinks


def write_drops(rows: DataFrame, prefix: str = "drop=") -> drops.Drops:
    """The transactions as delimited daily drops in a new folder."""
    folder, name = shared_folder(rows.sparkSession), prefix.rstrip("=")
    texts = [F.col(c).cast("string").alias(c) for c in rows.columns]
    (
        rows.select(*texts, stamp(F.to_date(AT)).alias(name))
        .write.partitionBy(name)
        .option("sep", "|")
        .option("header", True)
        .csv(folder)
    )
    return drops.Drops(folder, prefix=prefix, suffix="")


@query
def read_daily_drops(spark, sf_dir):
    source = write_drops(transactions(spark, sf_dir))
    return emit(drops.read_daily_drops(spark, source, AS_OF, 31))


@query
def null_tokens(spark, sf_dir):
    token = F.col(CATEGORY)
    for category, text in (("view", "null"), ("click", "NULL"), ("error", ""), ("signup", "None")):
        token = F.when(F.col(CATEGORY) == category, F.lit(text)).otherwise(token)
    rows = transactions(spark, sf_dir).withColumn("to_bank_name", token)
    return emit(drops.normalise_nulls(rows))


@query
def typed_scan(spark, sf_dir):
    rows = transactions(spark, sf_dir)
    return emit(drops.typed(rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])))


@query
def positional_rename(spark, sf_dir):
    rows = transactions(spark, sf_dir)
    nameless = rows.toDF(*[f"_c{i}" for i in range(len(rows.columns))])
    return emit(drops.rename_by_position(nameless, TRANSACTION.names))


@query
def glob_scan(spark, sf_dir):
    source = write_drops(transactions(spark, sf_dir))
    rows = drops.read_all(spark, f"{source.folder}/*/*.csv")
    return rows.withColumn(AT, F.date_format(AT, "yyyy-MM-dd HH:mm:ss"))


@query
def staged_overwrite(spark, sf_dir):
    path = shared_folder(spark)
    tables.replace_table(flags.add_missing_flags(transactions(spark, sf_dir), ["flag"]), path)
    stored = tables.read_table(spark, path)
    raised = F.when(F.col(AMOUNT) >= 100, 1).otherwise(F.col("flag")).cast("tinyint")
    tables.replace_table(stored.withColumn("flag", raised), path)
    return emit(tables.read_table(spark, path))


@query
def typed_empty(spark, sf_dir):
    rows, path = transactions(spark, sf_dir), shared_folder(spark)
    nothing = evaluate(replace(tuned("ccw"), at_least=10**9), rows, AS_OF)
    tables.replace_table(nothing, path)
    output = tables.read_table(spark, path)
    marked = flags.mark_by_keys(flags.add_missing_flags(rows, ["flag"]), output, "flag")
    return emit(marked)


@query
def append_unique(spark, sf_dir):
    rows, path = transactions(spark, sf_dir), shared_folder(spark)
    tables.append_table(rows.filter(F.col(CHANNEL) == "MB"), path)
    tables.append_table(rows.filter(F.col(CHANNEL) != "MB"), path)
    return emit(tables.read_table(spark, path))


# Projections and filters


@query
def filter_eligible(spark, sf_dir):
    rows = transactions(spark, sf_dir)
    return emit(filters.filter_eligible(rows, ["click", "purchase", "error"]))


@query
def filter_cutoff(spark, sf_dir):
    return emit(filters.filter_cutoff(transactions(spark, sf_dir), AS_OF, 10))


@query
def filter_hours(spark, sf_dir):
    return emit(filters.filter_hours(transactions(spark, sf_dir), 0, 6))


@query
def filter_adhoc(spark, sf_dir):
    return emit(
        transactions(spark, sf_dir).filter(
            (F.col(STATE) == 1) & (F.col(CHANNEL) == "MB") & (F.col(AMOUNT) > 50)
        )
    )


@query
def filter_day(spark, sf_dir):
    on_day = F.to_date(AT) == F.lit(date(2024, 1, 5))
    return emit(transactions(spark, sf_dir).filter(on_day & (F.col(AMOUNT) >= 20)))


@query
def add_missing_flags(spark, sf_dir):
    rows = transactions(spark, sf_dir).withColumn("flag_5min", F.col(STATUS))
    return emit(flags.add_missing_flags(rows, TF_ONLINE.flags))


@query
def normalise_flags(spark, sf_dir):
    rows = transactions(spark, sf_dir).withColumns(
        {"flag_5min": F.col(AMOUNT) > 100, "flag_10min": F.col(STATUS)}
    )
    return emit(flags.normalise_flags(rows, TF_ONLINE.flags))


# Joins, deltas, keys


def _flagged_history(spark, sf_dir) -> DataFrame:
    return transactions(spark, sf_dir).withColumn("flag", F.col(STATUS))


def _earlier(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(AT) < F.lit("2024-01-21").cast("timestamp_ntz"))


def _later(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(AT) >= F.lit("2024-01-16").cast("timestamp_ntz"))


@query
def mark_by_composite_key(spark, sf_dir):
    history = _flagged_history(spark, sf_dir)
    return emit(flags.mark_by_keys(history, history.filter(F.col(AMOUNT) >= 100), "flag"))


@query
def delta_new(spark, sf_dir):
    rows = transactions(spark, sf_dir)
    return emit(deltas.delta_new(_later(rows), _earlier(rows)))


@query
def delta_old(spark, sf_dir):
    rows = transactions(spark, sf_dir)
    return emit(deltas.delta_old(_later(rows), _earlier(rows)))


@query
def symmetric_difference(spark, sf_dir):
    rows = transactions(spark, sf_dir)
    return emit(deltas.symmetric_difference(_later(rows), _earlier(rows)))


@query
def append_delta(spark, sf_dir):
    rows = transactions(spark, sf_dir)
    history = _earlier(rows)
    return emit(deltas.append_delta(history, deltas.delta_new(_later(rows), history)))


@query
def semi_by_keys(spark, sf_dir):
    rows = transactions(spark, sf_dir, "lineitem")
    return emit(keys.semi_by_keys(rows, rows.filter(F.col(AMOUNT) >= 90_000)))


@query
def dedupe_ref(spark, sf_dir):
    return emit(keys.dedupe(transactions(spark, sf_dir, "lineitem"), REF, [AT]))


@query
def distinct_keys(spark, sf_dir):
    return emit(keys.distinct_keys(transactions(spark, sf_dir, "lineitem")))


@query
def find_duplicates(spark, sf_dir):
    return emit(keys.find_duplicates(transactions(spark, sf_dir, "lineitem"), [REF, ACCOUNT]))


@query
def merge_flags_max(spark, sf_dir):
    rows = transactions(spark, sf_dir, "lineitem").withColumns(
        {
            "flag_5min": (F.col(CATEGORY) == "A").cast("tinyint"),
            "flag_10min": F.when(F.col(AMOUNT) >= 50_000, 1).cast("tinyint"),
        }
    )
    merged = keys.merge_by_max(rows, [ACCOUNT, REF], ["flag_5min", "flag_10min"])
    return emit(merged.na.fill(0, ["flag_10min"]))


@query
def count_rows(spark, sf_dir):
    return transactions(spark, sf_dir, "lineitem").agg(F.count("*").alias("rows"))


# Trailing totals and bursts


@query
def rolling_count(spark, sf_dir):
    return emit(rolling.rolling_count(transactions(spark, sf_dir), hours(6)))


@query
def rolling_count_ties(spark, sf_dir):
    return emit(rolling.rolling_count(transactions(spark, sf_dir, "orders"), days(30)))


@query
def rolling_sum_24h(spark, sf_dir):
    return emit(rolling.rolling_sum(transactions(spark, sf_dir), hours(24)))


@query
def self_range_join(spark, sf_dir):
    return emit(rolling.rolling_sum(transactions(spark, sf_dir, "lineitem"), days(2)))


@query
def sum24h_by_ref(spark, sf_dir):
    return emit(rolling.sum_by_ref(transactions(spark, sf_dir, "lineitem"), days(2)))


@query
def burst_flag(spark, sf_dir):
    rows = rolling.burst_rows(transactions(spark, sf_dir), hours(6), 3)
    return emit(flags.set_flag(keys.dedupe(rows, REF, [AT, "transaction_date_right"])))


@query
def burst_interval_join(spark, sf_dir):
    return emit(rolling.burst_rows(transactions(spark, sf_dir, "orders"), days(30), 2))


@query
def sliced_count(spark, sf_dir):
    rows = transactions(spark, sf_dir, "orders")
    return emit(rolling.rolling_count(rows, days(30), stretch=days(30)))


@query
def sliced_sum(spark, sf_dir):
    rows = transactions(spark, sf_dir, "lineitem")
    return emit(rolling.rolling_sum(rows, days(2), stretch=days(2) + TICK))


@query
def sliced_burst(spark, sf_dir):
    rows = transactions(spark, sf_dir)
    return emit(rolling.burst_rows(rows, hours(6), 3, stretch=hours(6)))


# What is behind a flag


@query
def burst_interval_pairs(spark, sf_dir):
    return emit(pairs.burst_pairs(transactions(spark, sf_dir, "orders"), days(60), 3))


@query
def burst_interval_pairs_dense(spark, sf_dir):
    return emit(pairs.burst_pairs(transactions(spark, sf_dir), hours(6), 2))


@query
def sum_contributors(spark, sf_dir):
    rows = transactions(spark, sf_dir, "lineitem")
    return emit(pairs.contributors(rows, days(2), 200_000))


@query
def sum_contributors_early(spark, sf_dir):
    rows = filters.filter_hours(transactions(spark, sf_dir), 0, 6)
    return emit(pairs.contributors(rows, hours(24), 100))


# Sorted tables


@query
def sort_history(spark, sf_dir):
    return emit(ordering.sort_history(transactions(spark, sf_dir)))


@query
def latest_top_k(spark, sf_dir):
    return emit(ordering.latest(transactions(spark, sf_dir), 20))


@query
def page_slice(spark, sf_dir):
    return emit(ordering.page(transactions(spark, sf_dir), 10, 30))


@query
def page_slice_middle(spark, sf_dir):
    rows = transactions(spark, sf_dir, "lineitem")
    return emit(ordering.page(rows, rows.count() // 2, 30))


# Scalar functions


@query
def scalar_time(spark, sf_dir):
    text = F.date_format(AT, "yyyy-MM-dd HH:mm:ss")
    return emit(
        transactions(spark, sf_dir).select(
            REF,
            F.to_date(AT).alias("day"),
            F.hour(AT).alias("hour"),
            (F.col(AT) - timedelta(minutes=10)).alias("ten_minutes_before"),
            (F.col(AT) - timedelta(hours=24)).alias("day_before"),
            parse_timestamp(text, "yyyy-MM-dd HH:mm:ss").alias("parsed"),
            parse_timestamp(F.col(AT).cast("string")).alias("parsed_iso"),
            stamp(F.to_date(AT)).alias("stamp"),
            (F.to_date(AT) >= F.lit(date(2024, 1, 16))).cast("int").alias("second_half"),
        )
    )


@query
def scalar_logic(spark, sf_dir):
    maybe_date = F.when(F.col(STATUS) == 1, F.lit("no date")).otherwise(F.col(AT).cast("string"))
    maybe_amount = F.when(F.col(CHANNEL) == "MB", F.col(AMOUNT))
    return emit(
        transactions(spark, sf_dir).select(
            REF,
            F.coalesce(maybe_date.try_cast("date"), F.lit(date(1970, 1, 1))).alias("lenient_date"),
            F.coalesce(maybe_amount, F.lit(0.0)).alias("filled"),
            F.when(maybe_amount.isNotNull(), 1).otherwise(F.col(STATUS)).cast("tinyint").alias("set"),
            F.col(AMOUNT).between(20, 50).cast("int").alias("between"),
            ((F.col(STATUS) == 1) | (F.col(AMOUNT) > 100)).cast("int").alias("either"),
            F.col(AMOUNT).cast("long").alias("whole"),
        )
    )


# Flag merges


def _hits(spark, sf_dir) -> DataFrame:
    return flagged_refs([tuned("ccw")], transactions(spark, sf_dir), AS_OF)


@query
def flag_merge(spark, sf_dir):
    return emit(flags.merge_flags(_flagged_history(spark, sf_dir), _hits(spark, sf_dir), ["flag"]))


@query
def flag_merge_cutoff(spark, sf_dir):
    path = shared_folder(spark)
    tables.replace_table(evaluate(tuned("ccw"), transactions(spark, sf_dir), AS_OF), path)
    hits = output_refs(spark, {"flag": path}, AS_OF, 10)
    return emit(flags.merge_flags(_flagged_history(spark, sf_dir), hits, ["flag"]))


def _stored(rows: DataFrame) -> str:
    """A history that other means have written: plain Parquet by day."""
    path = shared_folder(rows.sparkSession)
    rows.withColumn("event_date", F.to_date(AT)).write.partitionBy("event_date").parquet(path)
    return path


def _merge_days(spark, sf_dir, path: str, flag: str, *days: date) -> DataFrame:
    """The history after merging a flag, one day after the other."""
    for day in days:
        rows = transactions(spark, sf_dir).filter((F.to_date(AT) == F.lit(day)) & (F.col(AMOUNT) >= 100))
        hits = rows.select(REF, F.to_date(AT).alias("event_date"), F.lit(1).cast("tinyint").alias(flag))
        update_flags(spark, TF_ONLINE, path, hits)
    return emit(tables.read_history(spark, path, TF_ONLINE.flags))


@query
def flag_merge_evolved(spark, sf_dir):
    path = _stored(transactions(spark, sf_dir).withColumn("flag_5min", F.col(STATUS)))
    return _merge_days(spark, sf_dir, path, "flag_10min", date(2024, 1, 15), date(2024, 1, 20))


@query
def flag_merge_boolean(spark, sf_dir):
    path = _stored(transactions(spark, sf_dir).withColumn("flag_5min", F.col(AMOUNT) >= 150))
    return _merge_days(spark, sf_dir, path, "flag_5min", date(2024, 1, 15), date(2024, 1, 20))


@query
def unflagged_count(spark, sf_dir):
    return flags.unflagged_count(_flagged_history(spark, sf_dir), _hits(spark, sf_dir), "flag")


@query
def all_flagged(spark, sf_dir):
    history = _flagged_history(spark, sf_dir)
    kinds = [
        flags.all_flagged(history, history.filter(F.col(CATEGORY) == kind), "flag")
        .select(F.lit(kind).alias("kind"), F.col("all_flagged").cast("int").alias("all_flagged"))
        for kind in ("error", "click", "none of them")
    ]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


@query
def family_refs(spark, sf_dir):
    rules = [tuned(rule.name) for rule in TF_ONLINE.rules]
    return emit(flagged_refs(rules, transactions(spark, sf_dir), AS_OF))


# Table maintenance


RUNS = ((date(2024, 1, 20), 20), (AS_OF, 16))
MERGE_DAYS = 5


def _family(base: Family = TF_ONLINE, **changes) -> Family:
    rules = tuple(tuned(rule.name) for rule in base.rules)
    categories = ("click", "purchase", "signup", "view")
    return replace(base, categories=categories, rules=rules, **changes)


def _runs(spark, sf_dir, family: Family, outputs: bool) -> DataFrame:
    """The history after two runs of the family on overlapping drops."""
    source, path = write_drops(transactions(spark, sf_dir)), shared_folder(spark)
    for day, n_days in RUNS:
        run_family(spark, family, source, f"{path}/history", path, day, n_days, outputs=outputs)
    return emit(tables.read_table(spark, f"{path}/history"))


@query
def ingest_append(spark, sf_dir):
    source, path = write_drops(transactions(spark, sf_dir)), shared_folder(spark)
    for day, n_days in RUNS:
        ingest(spark, _family(), source, path, day, n_days=n_days)
    return emit(tables.read_table(spark, path))


@query
def family_pipeline(spark, sf_dir):
    return _runs(spark, sf_dir, _family(), outputs=True)


@query
def family_pipeline_refs(spark, sf_dir):
    return _runs(spark, sf_dir, _family(), outputs=False)


@query
def family_pipeline_ccw(spark, sf_dir):
    return _runs(spark, sf_dir, _family(CCW, merge_days=MERGE_DAYS), outputs=True)


@query
def family_pipeline_ccw_refs(spark, sf_dir):
    return _runs(spark, sf_dir, _family(CCW, merge_days=MERGE_DAYS), outputs=False)


@query
def family_pipeline_position(spark, sf_dir):
    return _runs(spark, sf_dir, _family(LISTRIK), outputs=True)


@query
def family_pipeline_continued(spark, sf_dir):
    """A run after every few days, each of which looks only at what has come since."""
    source, path = write_drops(transactions(spark, sf_dir)), shared_folder(spark)
    for day, n_days in (*RUNS[:1], (date(2024, 1, 25), 9), *RUNS[1:]):
        run_family(
            spark, _family(), source, f"{path}/history", path, day, n_days,
            outputs=False, continued=True,
        )
    return emit(tables.read_table(spark, f"{path}/history"))


@query
def history_compaction(spark, sf_dir):
    """A day at a time appended in two pieces, flags merged beside them, then all folded."""
    rows, path = transactions(spark, sf_dir), shared_folder(spark)
    for channel in ("MB", "IB"):
        part = rows.filter(F.col(CHANNEL) == channel)
        tables.append_history(flags.add_missing_flags(part, TF_ONLINE.flags), path)
    _merge_days(spark, sf_dir, path, "flag_10min", date(2024, 1, 15), date(2024, 1, 20))
    tables.compact_history(spark, path)
    return emit(tables.read_history(spark, path, TF_ONLINE.flags))

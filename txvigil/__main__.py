"""The jobs as commands, for spark-submit or ``python -m txvigil``.

    run FAMILY      ingest, all rules, one flag merge
    ingest FAMILY   add the new transactions of the last drops to the history
    rule NAME       write the flagged transactions of one rule
    merge FAMILY    merge the rules' outputs into the history
    compact FAMILY  put the parts of each day of the history together
"""

from __future__ import annotations

import argparse
import logging
from datetime import date

from pyspark.sql import SparkSession

from txvigil.plans.families import FAMILIES, RULES
from txvigil.plans.jobs import ingest, output_refs, run_family, run_rule, update_flags
from txvigil.session import settings
from txvigil.sources.drops import Drops
from txvigil.sources.files import size
from txvigil.sources.tables import compact_history


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(
        "txvigil", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    parser.add_argument("command", choices=["run", "ingest", "rule", "merge", "compact"])
    parser.add_argument("name", choices=sorted({*FAMILIES, *RULES}), metavar="FAMILY|NAME")
    parser.add_argument("--history", required=True, help="history table")
    parser.add_argument("--outputs", help="folder of the rule outputs")
    parser.add_argument("--drops", help="folder of the daily drops")
    parser.add_argument("--rejects", help="table for transactions without reference number")
    parser.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    parser.add_argument("--days", type=int, help="drops to read; days of outputs to merge")
    parser.add_argument(
        "--refs-only", action="store_true", help="run: no outputs, all rules in one pass"
    )
    parser.add_argument(
        "--continued", action="store_true", help="run: evaluate only what came since the last run"
    )
    parser.add_argument(
        "--warmup", action="store_true", help="rule: read the span before the lookback too"
    )
    parser.add_argument(
        "--cores", type=int, help="executor cores, default what the session starts with"
    )
    options = parser.parse_args(argv)
    known = RULES if options.command == "rule" else FAMILIES
    if options.name not in known:
        parser.error(f"{options.command} takes one of {', '.join(known)}")
    needs = {"run": ["drops", "outputs"], "ingest": ["drops"], "compact": []}
    needed = needs.get(options.command, ["outputs"])
    for name in needed:
        if getattr(options, name) is None:
            parser.error(f"{options.command} needs --{name}")
    return options


def main(argv: list[str] | None = None) -> None:
    options = arguments(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = SparkSession.builder.appName(f"txvigil {options.command} {options.name}").getOrCreate()
    read = [path for path in (options.history, options.drops) if path]
    cores = options.cores or spark.sparkContext.defaultParallelism
    given = spark.sparkContext.getConf()
    for key, value in settings(sum(size(spark, path) for path in read), cores).items():
        if not given.contains(key):
            spark.conf.set(key, value)
    if options.command == "rule":
        rule = RULES[options.name]
        family = next(f for f in FAMILIES.values() if rule in f.rules)
        output = f"{options.outputs}/{rule.name}"
        run_rule(spark, rule, family, options.history, output, options.as_of, options.warmup)
        return
    family = FAMILIES[options.name]
    if options.command == "run":
        run_family(
            spark, family, Drops(options.drops), options.history, options.outputs,
            options.as_of, options.days, outputs=not options.refs_only,
            rejects_path=options.rejects, continued=options.continued,
        )
    elif options.command == "compact":
        compact_history(spark, options.history)
    elif options.command == "ingest":
        ingest(
            spark, family, Drops(options.drops), options.history,
            options.as_of, options.days, options.rejects,
        )
    else:
        paths = {rule.flag: f"{options.outputs}/{rule.name}" for rule in family.rules}
        days = family.merge_days if options.days is None else options.days
        hits = output_refs(spark, paths, options.as_of, days, dated=True)
        if hits is not None:
            update_flags(spark, family, options.history, hits)


if __name__ == "__main__":
    main()

"""Transaction flagging on Spark: ingest dated drops, run account rules, merge flags."""

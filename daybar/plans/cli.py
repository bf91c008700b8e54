"""``spark-submit`` entry point: run the daily report job from a YAML config.

    spark-submit --py-files daybar.zip daybar/plans/cli.py config.yml [--as-of YYYY-MM-DD]
        [--source-root PATH] [--target-root PATH] [--recover] [--stream --checkpoint PATH]

The session comes from ``spark-submit`` (cluster settings, ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import logging
import logging.config

from pyspark.sql import SparkSession

from daybar.config import job_config_from_mapping
from daybar.plans.job import run


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Run the daily report job")
    ap.add_argument("config", help="YAML file with source / target / meta / s3 sections")
    ap.add_argument("--as-of", default=None, help="run date (default: today)")
    ap.add_argument("--source-root", default=None)
    ap.add_argument("--target-root", default=None)
    ap.add_argument("--recover", action="store_true",
                    help="end a run that died (its report recorded or dropped) before this one starts")
    ap.add_argument("--stream", action="store_true",
                    help="process new files with the Structured Streaming trigger instead of the ledger")
    ap.add_argument("--checkpoint", default=None, help="stream checkpoint folder (required with --stream)")
    args = ap.parse_args(argv)
    if args.stream and not args.checkpoint:
        ap.error("--stream needs --checkpoint (a shared folder kept between runs)")
    import yaml
    with open(args.config) as fh:
        raw = yaml.safe_load(fh)
    if "logging" in raw:
        logging.config.dictConfig(raw["logging"])
    cfg = job_config_from_mapping(raw, source_root=args.source_root, target_root=args.target_root)
    spark = SparkSession.builder.appName("daybar-report1").getOrCreate()
    if args.stream:
        from daybar.streaming import start_report_stream
        start_report_stream(spark, cfg, args.checkpoint).awaitTermination()
        return
    res = run(spark, cfg, args.as_of, recover=args.recover)
    logging.getLogger(__name__).info("cutoff %s, published %s, recorded %d day(s)",
                                     res.plan.cutoff, res.target, len(res.recorded))


if __name__ == "__main__":
    main()

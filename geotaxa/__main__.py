"""Run a job from the command line (also through ``spark-submit``).

  python -m geotaxa read    --records R --out O [--threshold 200] [--tie-break a,b]
  python -m geotaxa harvest --records R --history H --names N --out O
                            [--observed-after 2015-01-01] [--observed-before 2019-01-01]
                            [--sources a,b] [--families x,y] [--modified-before T]
                            [--marks-out M]
  python -m geotaxa enrich  --records R --stored S (--lookup L | --fetch module:function)
                            --store-path P --out O

All inputs and outputs are Parquet folders except the harvest output (JSON
lines).  The session comes from ``SparkSession.builder.getOrCreate()``, so
master, memory and ``spark.checkpoint.dir`` are whatever spark-submit set.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="geotaxa")
    sub = p.add_subparsers(dest="job", required=True)
    r = sub.add_parser("read", help="latest version -> dedup -> taxa filter")
    r.add_argument("--records", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--threshold", type=int, default=200)
    r.add_argument("--tie-break", help="comma-separated columns that settle versions of one time")
    h = sub.add_parser("harvest", help="incremental pull -> names -> JSON lines")
    h.add_argument("--records", required=True)
    h.add_argument("--history", required=True)
    h.add_argument("--names", required=True)
    h.add_argument("--out", required=True)
    h.add_argument("--observed-after", default="2015-01-01 00:00:00")
    h.add_argument("--observed-before", default="2019-01-01 00:00:00")
    h.add_argument("--marks-out", help="write the next high-water marks here (Parquet)")
    h.add_argument("--sources", help="comma-separated sources to pull (default: all with a mark)")
    h.add_argument("--families", help="comma-separated families to pull")
    h.add_argument("--modified-before", help="only records updated before this time")
    e = sub.add_parser("enrich", help="features: join stored, fetch missing, append, merge")
    e.add_argument("--records", required=True)
    e.add_argument("--stored", required=True)
    src = e.add_mutually_exclusive_group(required=True)
    src.add_argument("--lookup", help="Parquet table with the feature values per key")
    src.add_argument("--fetch", help="module:function taking a pandas frame of keys")
    e.add_argument("--store-path", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--feature", default="landcover")
    return p


def run(argv: list[str], spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"geotaxa-{args.job}").getOrCreate()
    read = spark.read.parquet
    if args.job == "read":
        from geotaxa.plans.jobs import read_occurrences
        observations: list = []
        read_occurrences(read(args.records), args.threshold, observations=observations,
                         tie_break=_split(args.tie_break) or ()).write.mode("overwrite").parquet(args.out)
        counters: dict = {}
        for obs in observations:
            counters.update(obs.get)
        return counters
    if args.job == "harvest":
        from pyspark.sql import functions as F

        from geotaxa.plans.jobs import harvest
        from geotaxa.sources.sync import next_marks
        observations = []
        history = read(args.history)
        pulled = harvest(read(args.records), history, read(args.names), out_path=args.out,
                         observations=observations,
                         observed_after=args.observed_after, observed_before=args.observed_before,
                         modified_before=args.modified_before,
                         restrict_sources=_split(args.sources), restrict_families=_split(args.families))
        if args.marks_out:
            next_marks(pulled, history, F.col("scientific_name").isNull()).write.mode("overwrite").parquet(args.marks_out)
        return observations[0].get
    from geotaxa.operators.features import FeatureSpec
    from geotaxa.plans.jobs import enrich_features
    if args.lookup:
        spec = FeatureSpec(name=args.feature, lookup=read(args.lookup))
    else:
        spec = FeatureSpec(name=args.feature, fetch=_load_function(args.fetch))
    result = enrich_features(read(args.records), read(args.stored), spec, store_path=args.store_path)
    result.merged.write.mode("overwrite").parquet(args.out)
    return result.counters()


def _split(text: str | None) -> list[str] | None:
    return [x.strip() for x in text.split(",") if x.strip()] if text else None


def _load_function(path: str):
    import importlib

    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def main() -> None:
    counters = run(sys.argv[1:])
    print(json.dumps(counters, sort_keys=True, default=str))


if __name__ == "__main__":
    main()

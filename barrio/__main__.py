"""Command line for the zone stages (run with ``spark-submit -m`` or ``python -m barrio``).

    python -m barrio format-prices    --landing L --formatted F --ledger G
    python -m barrio format-incidents --landing L --formatted F --ledger G
    python -m barrio format-sites     --landing L --formatted F --ledger G [--documents]
    python -m barrio exploit          --prices P --incidents I --sites S --out O --as-of 2024-01-01
    python -m barrio extend-history   --source S --out O [--end-year 2025]
    python -m barrio train            --table T --models M [--registry R]

The session comes from the submitting environment (cluster settings,
``spark.checkpoint.dir``); only a bare local run falls back to local defaults.
Each command prints a small JSON summary (ledger rows, row counts, metrics).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName("barrio")
    spark = builder.getOrCreate()
    if spark.sparkContext.master.startswith("local"):
        from barrio.session import LOCAL_DEFAULTS
        for k, v in LOCAL_DEFAULTS.items():
            if not k.startswith("spark.ui"):
                spark.conf.set(k, v)
    from barrio.session import scratch_root
    scratch_root(spark)
    return spark


def _ledger_summary(df) -> dict:
    rows = [r.asDict() for r in df.select("path", "rows", "last_year", "status").collect()]
    return {"files": len(rows), "entries": rows}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="barrio")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("format-prices", "format-incidents", "format-sites"):
        s = sub.add_parser(name)
        s.add_argument("--landing", required=True)
        s.add_argument("--formatted", required=True)
        s.add_argument("--ledger", required=True)
        if name == "format-sites":
            s.add_argument("--documents", action="store_true", help="whole-file JSON arrays")
    s = sub.add_parser("exploit")
    for a in ("--prices", "--incidents", "--sites", "--out"):
        s.add_argument(a, required=True)
    s.add_argument("--as-of", default=str(dt.date.today()))
    s.add_argument("--flags", action="store_true")
    s = sub.add_parser("extend-history")
    s.add_argument("--source", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--end-year", type=int, default=2025)
    s = sub.add_parser("train")
    s.add_argument("--table", required=True, help="exploitation table (parquet)")
    s.add_argument("--models", required=True, help="folder for the fitted pipelines")
    s.add_argument("--registry", help="leaderboard table to append to")
    args = p.parse_args(argv)

    spark = _session()
    from barrio import zones
    if args.cmd == "format-prices":
        out = _ledger_summary(zones.format_price_files(spark, args.landing, args.formatted, args.ledger))
    elif args.cmd == "format-incidents":
        out = _ledger_summary(zones.format_incident_files(spark, args.landing, args.formatted, args.ledger))
    elif args.cmd == "format-sites":
        out = _ledger_summary(zones.format_site_files(spark, args.landing, args.formatted, args.ledger,
                                                      documents=args.documents))
    elif args.cmd == "exploit":
        t = zones.build_exploitation(spark, args.prices, args.incidents, args.sites, args.out, args.as_of,
                                     flags=args.flags)
        out = {"rows": t.count(), "path": args.out}
    elif args.cmd == "extend-history":
        t = zones.extend_history_files(spark, args.source, args.out, end_year=args.end_year)
        out = {"documents": t.count(), "path": args.out}
    else:
        out = _train(spark, args.table, args.models, args.registry)
    print(json.dumps(out, default=str))
    return 0


def _train(spark: SparkSession, table: str, models: str, registry: str | None) -> dict:
    """M1-M16 + L1: label, split, tune the three families, rank, persist."""
    from pyspark.ml import PipelineModel
    from pyspark.sql import functions as F

    from barrio.operators.models import TRAIN_ORDER, WEIGHT, tune
    from barrio.operators.registry import champion, leaderboard, register, save_model
    from barrio.plans.ml import prepare
    frame = spark.read.parquet(table).withColumn("_row_key", F.concat_ws("|", "neighborhood_name", "year"))
    p = prepare(frame, ["_row_key"])
    results, paths = [], {}
    for fam in TRAIN_ORDER:
        r = tune(fam, p.train, p.validation, weight=WEIGHT)
        paths[fam] = save_model(PipelineModel(stages=[*p.prep.stages, *r.model.stages]), f"{models}/{fam}")
        results.append(r)
    board = leaderboard(spark, results, paths)
    if registry:
        board = register(spark, board, registry)
    best = champion(board).first()
    p.release()
    return {"champion": best["model"], "accuracy": best["value"], "path": best["path"],
            "metrics": {r.family: r.metrics for r in results},
            "training_seconds": {r.family: r.training_time for r in results}}


if __name__ == "__main__":
    sys.exit(main())

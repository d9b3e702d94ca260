"""Jobs from the command line: ``python -m basketspark <job> --csv-path raw --out bronze``; options are the job's parameters."""

from __future__ import annotations

import argparse
import inspect
import logging
import sys

from pyspark.sql import SparkSession

from .plans import jobs

JOBS = {f.__name__.replace("_", "-"): f for f in (jobs.bronze, jobs.order_products, jobs.user_data, jobs.product_history, jobs.product_training, jobs.aisle_history, jobs.aisle_training, jobs.reorder_size_training, jobs.user_product_count, jobs.gold, jobs.bucketed_lines, jobs.sample)}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser("basketspark", description="Basket jobs; each writes only what its contract lets through.")
    sub = out.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        one = sub.add_parser(name, help=(job.__doc__ or "").split("\n")[0] or None)
        for p in list(inspect.signature(job).parameters.values())[1:]:
            needed = p.default is p.empty
            kind = {"int": int, "float": float}.get(str(p.annotation), str)
            one.add_argument(f"--{p.name.replace('_', '-')}", dest=p.name, required=needed, type=kind, **({} if needed else {"default": p.default}))
    return out


def main(argv: list[str] | None = None) -> int:
    """0 if the job went through; its error, logged, if not."""
    options = vars(parser().parse_args(argv))
    name = options.pop("job")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    log, running = logging.getLogger("basketspark"), SparkSession.getActiveSession()
    spark = running or SparkSession.builder.appName(f"basketspark {name}").getOrCreate()
    try:
        JOBS[name](spark, **options)
        log.info("%s is done", name)
        return 0
    except Exception:
        log.exception("%s failed", name)
        raise
    finally:
        if running is None:
            spark.stop()


if __name__ == "__main__":
    sys.exit(main())

"""Extract, transform and publish as one job, timed per stage: ``python -m starbazaar.plans.pipeline``."""

from __future__ import annotations

import argparse
import logging
import sys
import time
from collections.abc import Callable, Collection
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from starbazaar.plans.quality import SEVERITIES, gate, issues
from starbazaar.plans.star import transform
from starbazaar.session import short_shuffles, work_scope
from starbazaar.sources.csv_files import load_raw_data
from starbazaar.sources.warehouse import StarWriter, drop_superseded

log = logging.getLogger(__name__)


@contextmanager
def _stage(name: str, seconds: dict[str, float]):
    begin = time.perf_counter()
    yield
    seconds[name] = time.perf_counter() - begin
    log.info("%s done in %.1f s", name, seconds[name])


def run_pipeline(
    spark: SparkSession, extract: Callable[[], dict[str, DataFrame]], base: str, *,
    blocking: str | None = None, keep: int | None = None, metrics: list[dict] | None = None,
    tolerated: Collection[tuple[str, str, str]] = (),
) -> tuple[dict[str, DataFrame], dict[str, float]]:
    """Publish a new version of the star under ``base``. Returns its tables and the seconds per stage.

    Any failure leaves the version published before in place. Intermediate tables, those that ``extract`` lands among them, are gone when it
    returns, and shuffle files as soon as they are used. ``blocking`` names a severity: audit findings of it
    in the raw tables stop the load. ``keep`` is the number of published versions to keep, all if not given. ``metrics`` is what the
    extraction has noted of its tables; it is published with what the load notes, see ``warehouse.load_metrics``. ``tolerated``: see ``warehouse.StarWriter``.
    """
    seconds: dict[str, float] = {}
    writer = StarWriter(spark, base, own_keys=True, tolerated=tolerated)
    with work_scope(spark), short_shuffles(spark):
        with _stage("extract", seconds):
            raw = extract()
        if blocking:
            with _stage("audit", seconds):
                gate(issues(raw), blocking)
        with _stage("transform", seconds):
            transform(spark, raw, writer)
        with _stage("publish", seconds):
            star = writer.publish(metrics or [])
    if keep is not None:
        drop_superseded(spark, base, keep)
    return star, seconds


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Load the raw CSV files into the star schema.")
    parser.add_argument("--raw", help="folder with the CSV files (default: RAW_DATA_PATH or data/raw)")
    parser.add_argument("--star", required=True, help="folder of the published star")
    parser.add_argument("--blocking", choices=SEVERITIES, help="stop on audit findings of this severity")
    parser.add_argument("--keep", type=int, help="number of published versions to keep (default: all)")
    parser.add_argument("--prefix", help="prefix of the files, if the folder holds several data sets")
    parser.add_argument("--on-problem", choices=("refuse", "report"), default="refuse",
                        help="what to do about rows and values that cannot be read (default: refuse the load)")
    args = parser.parse_args(argv)
    if args.keep is not None and args.keep < 1:
        parser.error("--keep must be at least 1")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark = SparkSession.builder.appName("starbazaar-pipeline").getOrCreate()
    metrics: list[dict] = []
    try:
        run_pipeline(spark, lambda: load_raw_data(spark, args.raw, prefix=args.prefix, on_problem=args.on_problem, metrics=metrics), args.star,
                     blocking=args.blocking, keep=args.keep, metrics=metrics)
    except Exception:
        log.exception("load failed, the published star is unchanged")
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())

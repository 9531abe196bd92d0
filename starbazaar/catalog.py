"""Every query of the package over the given tables, by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbazaar.operators.constraints import validate
from starbazaar.operators.dedupe import dominant_payment, first_per_key, latest_review
from starbazaar.operators.numbering import tile
from starbazaar.functions.scalars import revenue
from starbazaar.plans import profile, quality, range_reports
from starbazaar.plans.kpis import KPIS, score_by_lateness, state_share
from starbazaar.plans.pipeline import run_pipeline
from starbazaar.plans.star import transform
from starbazaar.session import app_dir, remove_work, short_shuffles, work_path, work_table
from starbazaar.sources.csv_files import load_raw_data, problems, read_with_problems, write_csv_tables
from starbazaar.sources.given_tables import marketplace
from starbazaar.sources.schemas import STAR
from starbazaar.sources.warehouse import StarWriter, load_metrics, load_star, read_rejects, register_views, run_query

Query = Callable[[SparkSession, str], DataFrame]
CHOSEN_PERIOD = (date(1996, 3, 15), date(1998, 10, 20))
FILE_ROWS = 5_000
# A compressed file is read by one task; so many records are some 50 MB of it.
CSV_RECORDS = 2_000_000
# The given tables have no zips of sellers. Their numbers stand for them, which have more than a zip's five digits from 100,000 sellers on.
NUMBERS_AS_ZIPS = (("dim_seller", "max_length", "zip_code_prefix"),)

_loads: dict[tuple[str, str, bool], tuple[StarWriter, dict[str, DataFrame]]] = {}
_loading = Lock()


def _load(spark: SparkSession, sf_dir: str, damaged: bool = False) -> tuple[StarWriter, dict[str, DataFrame]]:
    """The star of these tables, built once per application into the shared folder.

    The damaged variant breaks the star's rules, so it is built but not published.
    """
    key = (spark.sparkContext.applicationId, sf_dir, damaged)
    with _loading:
        if key not in _loads:
            writer = StarWriter(spark, f"{app_dir(spark)}/star", own_keys=True, tolerated=NUMBERS_AS_ZIPS)
            star = transform(spark, marketplace(spark, sf_dir, damaged), writer)
            if not damaged:
                writer.publish()
            _loads[key] = (writer, star)
        return _loads[key]


def star_of(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _load(spark, sf_dir)[1]


@contextmanager
def _csv_files(spark: SparkSession, sf_dir: str) -> Iterator[str]:
    """A folder with the raw tables as CSV files. It is gone at the end: what is read of them has been landed by then."""
    name, tables = f"csv-{uuid.uuid4().hex}", marketplace(spark, sf_dir)
    try:
        with short_shuffles(spark):
            # A column that no schema names is kept as well.
            write_csv_tables(tables | {"orders": tables["orders"].withColumn("note", F.col("order_status"))}, work_path(spark, name),
                             compression="gzip", max_records_per_file=CSV_RECORDS)
        yield work_path(spark, name)
    finally:
        remove_work(spark, name)


def _raw_from_csv(spark: SparkSession, sf_dir: str, metrics: list[dict] | None = None) -> dict[str, DataFrame]:
    with _csv_files(spark, sf_dir) as folder:
        return load_raw_data(spark, folder, metrics=metrics)


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and decimals as double, so that results compare by value across engines."""
    def widened(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(f"`{field.name}`").cast("double").alias(field.name)
        if isinstance(field.dataType, T.IntegralType):
            return F.col(f"`{field.name}`").cast("bigint").alias(field.name)
        return F.col(f"`{field.name}`")
    return df.select(*(widened(f) for f in df.schema))


def _on_star(build: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(build(star_of(spark, sf_dir)))


def _on_raw(build: Callable[[dict[str, DataFrame]], DataFrame], damaged: bool = False) -> Query:
    return lambda spark, sf_dir: plain(build(marketplace(spark, sf_dir, damaged)))


def _surrogate_keys(star: dict[str, DataFrame]) -> DataFrame:
    parts = None
    for name in ("dim_customer", "dim_product", "dim_seller", "dim_location"):
        table = STAR[name]
        rows = star[name].select(
            F.lit(name).alias("table"), F.col(table.unique[0]).alias("natural_key"),
            F.col(table.primary_key).alias("surrogate_key"))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def _order_quarters(star: dict[str, DataFrame]) -> DataFrame:
    if "totals_by_order" not in star:
        star["totals_by_order"] = work_table(
            star["fact_orders"].groupBy("order_id").agg(F.sum(revenue()).alias("order_total")), "order-totals")
    totals = star["totals_by_order"]
    order = {"total": -F.col("order_total"), "order": F.col("order_id")}
    return totals.withColumn("quarter_by_total", tile(totals, 4, order))


def _parameterised_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as SQL, its period bound as parameters."""
    first, last = (int(f"{day:%Y%m%d}") for day in CHOSEN_PERIOD)
    return plain(run_query(spark, star_of(spark, sf_dir), """
        SELECT order_status, count(*) AS items, sum(price + freight_value) AS revenue
        FROM fact_orders WHERE date_key BETWEEN :first AND :last
        GROUP BY order_status""", {"first": first, "last": last}))


def _csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine tables written as CSV and read back: filled values per column."""
    parts = None
    for name, df in _raw_from_csv(spark, sf_dir).items():
        filled = df.agg(*(F.count(c).alias(c) for c in df.columns))
        rows = filled.select(F.explode(F.array(*(
            F.struct(F.lit(name).alias("table"), F.lit(c).alias("column"), F.col(c).alias("filled"))
            for c in df.columns))).alias("line")).select("line.*")
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def _job_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: CSV files, landed, audited, built, published, older versions dropped, read through the catalog's view."""
    base, database = f"{app_dir(spark)}/job-{uuid.uuid4().hex}", f"job_{uuid.uuid4().hex}"
    run_pipeline(spark, lambda: _raw_from_csv(spark, sf_dir), base, keep=1, tolerated=NUMBERS_AS_ZIPS)
    register_views(spark, base, database)
    return plain(spark.table(f"{database}.fact_orders").select(STAR["fact_orders"].names[1:]))


def _load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load from CSV files noted of the tables it read and wrote, from the manifest of what it published."""
    base, noted = f"{app_dir(spark)}/job-{uuid.uuid4().hex}", []
    run_pipeline(spark, lambda: _raw_from_csv(spark, sf_dir, noted), base, metrics=noted, tolerated=NUMBERS_AS_ZIPS)
    return plain(load_metrics(spark, base).select("stage", "table", "rows", "columns", "problems"))


def _ready_made_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ready-made star tables loaded without locations, which are skipped, and without freight, which is 0 then; no file has more than
    ``FILE_ROWS`` rows."""
    tables = {name: df for name, df in star_of(spark, sf_dir).items() if name in STAR and name != "dim_location"}
    tables["fact_orders"] = tables["fact_orders"].drop("freight_value", "purchase_month")
    stored = load_star(spark, tables, f"{app_dir(spark)}/ready-{uuid.uuid4().hex}", max_records_per_file=FILE_ROWS, tolerated=NUMBERS_AS_ZIPS)
    parts = []
    for name in tables:
        freight = F.sum("freight_value") if name == "fact_orders" else F.lit(None)
        per_file = stored[name].groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"), freight.cast("double").alias("freight"))
        parts.append(per_file.agg(F.sum("n").alias("rows"), F.sum("freight").alias("freight"), (F.max("n") <= FILE_ROWS).alias("in_small_files")).select(
            F.lit(name).alias("table"), "rows", "freight", "in_small_files"))
    return plain(reduce(DataFrame.unionByName, parts))


def _csv_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews written as spoiled CSV text: scores that are no whole numbers, surplus and missing fields, quoted line breaks, bytes that
    are not UTF-8, and a file that ends inside a quote."""
    reviews = marketplace(spark, sf_dir)["reviews"]
    score, fields = F.col("review_score"), ["review_id", "order_id", "review_score", "review_creation_date", "review_answer_timestamp"]
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    texts[2] = F.when(score == 5, "abc").when(score == 4, "4.9").otherwise(texts[2])
    line = F.concat_ws(",", *texts, F.when(score == 1, F.unhex(F.lit("E9")).cast("string")).otherwise(F.lit('"two ""quoted""\nlines"')))
    line = F.when(score == 3, F.concat(line, F.lit(",surplus"))).when(score == 2, F.concat_ws(",", *texts[:2])).otherwise(line)
    path = f"{app_dir(spark)}/spoiled-{uuid.uuid4().hex}"
    # A text file is written with one column, whose name stands in no file; the header is the first line of every part.
    header = ",".join([*fields, "comment"])
    lines = reviews.select(line.alias("value")).sortWithinPartitions("value")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines.select(F.when(first, F.concat(F.lit(header + "\n"), "value")).otherwise(F.col("value")).alias("value")).write.text(
        f"{path}/x_order_reviews_dataset.csv")
    reviews.agg(F.max("order_id").alias("order_id")).select(F.concat(F.lit(header + "\nlast,"), "order_id", F.lit(',1,,,"open\nto the end, ""x""\n')).alias("value")).write.mode("append").text(
        f"{path}/x_order_reviews_dataset.csv")
    found = problems({"reviews": read_with_problems(spark, f"{path}/x_order_reviews_dataset.csv", "reviews")})
    return plain(found.select("table", F.coalesce("column", F.lit("*")).alias("column"), "problem", "n"))


def _in_period(report: Callable, period: tuple[date, date] | None = None) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = star_of(spark, sf_dir)
        return plain(report(star, *(period or range_reports.whole_period(star))))
    return build


def _shown() -> dict[str, Query]:
    def headline(star, start, end):
        return range_reports.shown_headline(range_reports.range_headline(star, start, end), start, end)

    def shown(show: Callable, report: Callable):
        return lambda star, start, end: show(report(star, start, end))

    return {
        "shown_headline": _in_period(headline),
        "shown_monthly": _in_period(shown(range_reports.shown_monthly, range_reports.range_monthly)),
        "shown_categories": _in_period(shown(range_reports.shown_categories, range_reports.range_categories)),
        "shown_payments": _in_period(shown(range_reports.shown_payments, range_reports.range_payments)),
        "shown_sellers": _in_period(shown(range_reports.shown_sellers, range_reports.range_sellers)),
    }


def _audits(suffix: str, damaged: bool) -> dict[str, Query]:
    builds = {
        "null_profile": profile.null_profile,
        "critical_nulls": quality.critical_nulls,
        "duplicate_keys": quality.duplicate_keys,
        "duplicate_rows": lambda raw: quality.duplicate_order_rows(raw["orders"]),
        "orphans": quality.orphans,
        "orphan_sample": lambda raw: quality.orphan_sample(raw["order_items"], raw["orders"]),
        "date_span": lambda raw: quality.date_span(raw["orders"]),
        "missing_months": lambda raw: quality.missing_months(raw["orders"]),
        "issue_summary": lambda raw: quality.issue_summary(quality.issues(raw)),
        "severity_counts": lambda raw: quality.severity_counts(quality.issues(raw)),
    }
    return {f"{name}{suffix}": _on_raw(build, damaged) for name, build in builds.items()}


def queries() -> dict[str, Query]:
    fact_names = STAR["fact_orders"].names[1:]
    return {
        "date_dimension": _on_star(lambda star: star["dim_date"]),
        "customer_dim": _on_star(lambda star: star["dim_customer"]),
        "product_dim": _on_star(lambda star: star["dim_product"]),
        "seller_dim": _on_star(lambda star: star["dim_seller"]),
        "location_dim": _on_star(lambda star: star["dim_location"]),
        "surrogate_keys": _on_star(_surrogate_keys),
        "dominant_payment": _on_raw(lambda raw: dominant_payment(raw["payments"])),
        "latest_review": _on_raw(lambda raw: latest_review(raw["reviews"])),
        "order_item_fact": _on_star(lambda star: star["fact_orders"].select(fact_names)),
        "order_item_fact_damaged": lambda spark, sf: plain(
            _load(spark, sf, damaged=True)[1]["fact_orders"].select(fact_names)),
        "constraint_report": _on_star(validate),
        "constraint_report_damaged": lambda spark, sf: plain(_load(spark, sf, damaged=True)[0].report()),
        "rejects": lambda spark, sf: read_rejects(spark, _load(spark, sf)[0].path),
        "rejects_damaged": lambda spark, sf: read_rejects(spark, _load(spark, sf, damaged=True)[0].path),
        **{name: _on_star(report) for name, report in KPIS.items()},
        "ntile_scalable": _on_star(_order_quarters),
        "state_share": _on_star(state_share),
        "score_by_lateness": _on_star(score_by_lateness),
        "parameterised_sql": _parameterised_sql,
        "range_bounds": _on_star(range_reports.range_bounds),
        **{name: _in_period(report) for name, report in range_reports.RANGE_REPORTS.items()},
        **{f"{name}_chosen": _in_period(report, CHOSEN_PERIOD)
           for name, report in range_reports.RANGE_REPORTS.items()},
        **_shown(),
        "csv_scan": _csv_scan,
        "csv_problems": _csv_problems,
        "job_from_csv": _job_from_csv,
        "load_metrics": _load_metrics,
        "ready_made_load": _ready_made_load,
        "order_keys": _on_star(lambda star: star["fact_orders"].agg(
            F.count("*").alias("rows"), F.count_distinct("order_key").alias("distinct_keys"),
            F.count_if(F.col("order_key").isNull()).alias("missing"))),
        "table_shapes": _on_raw(profile.table_shapes),
        "table_preview": _on_raw(lambda raw: profile.table_preview(raw["orders"], ["order_id"])),
        "table_previews": _on_raw(profile.table_previews),
        "fullest_orders_damaged": _on_raw(lambda raw: first_per_key(raw["orders"], "order_id", fullest=True), damaged=True),
        "orders_per_month": _on_raw(lambda raw: profile.orders_per_month(raw["orders"])),
        "top_states": _on_raw(lambda raw: profile.top_states(raw["orders"], raw["customers"])),
        "duplicate_line_numbers": _on_raw(
            lambda raw: quality.duplicate_count(raw["order_items"], ["order_id", "order_item_id"])),
        **_audits("", damaged=False),
        **_audits("_damaged", damaged=True),
    }

"""The published star: versioned Parquet tables, a manifest that names the current version, catalog views.

A load writes a new version folder, checks it, and only then adds an entry to the manifest. Readers follow the
manifest's last entry, so a failed load changes nothing for them.

The manifest asks little of its store: no exclusive create, no rename, no whole writes. An entry is a file of its own, named by a number and a
random part, so two loads never write the same file; it holds a checksum, so a reader passes over one that is not whole yet. A load
takes the number after the last and looks again afterwards: if an entry of a later number has come meanwhile, it moves behind that. Loads at the
very same time may share a number; then the random part puts them in an order that all readers agree on.

Versions that registered views show, and those that readers have leased, are not deleted.
"""

from __future__ import annotations

import hashlib
import json
import logging
import re
import time
import uuid
from collections.abc import Collection
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starbazaar.operators.constraints import broken_counts, broken_rules, key_report, row_rules
from starbazaar.operators.numbering import with_surrogate_key
from starbazaar.plans.fact import order_spans, order_totals
from starbazaar.sources.schemas import KEPT, LOAD_ORDER, REJECT_KEYS, STAR, conform

log = logging.getLogger(__name__)

FACT, TOTALS, TURNED_AWAY = "fact_orders", "order_totals", "turned_away"
#: The fact's rows of its first and its last month; which those are, the names of the partitions tell.
ENDS = "fact_ends"
MONTH, MONTH_COMMENT = "purchase_month", "Month of purchase as YYYYMM; the rows are stored by it."
FACT_LAYOUT = ["reject_reason", MONTH]
#: Columns that tell rows of one natural key apart: a second translation of a category repeats its products.
KEY_TIES = {"dim_product": ("category_name_en",)}
ENTRY_NAME = re.compile(r"(\d{10})(-[0-9a-f]{32})?\.json")
MANIFEST, LEASES, SHOWN = "_manifest", "_leases", "_views"
VERSION_NAME = re.compile(r"\d{8}T\d{12}-[0-9a-f]{8}")
#: The raw keys stored with a rejected item; those of the dimensions only where the lookup failed.
STORED_KEYS = ("order_id", "product_id", "seller_id")
LOOKED_UP = ("dim_product", "dim_seller")


class ConstraintViolation(RuntimeError):
    """A load broke the star's rules; nothing was published. ``violations`` holds (table, constraint, column, n)."""

    def __init__(self, violations: list[tuple[str, str, str, int]]):
        super().__init__("; ".join(f"{t}.{c}: {rule} x{n}" for t, rule, c, n in violations))
        self.violations = violations


class StarWriter:
    """Writes one version of the star. Each table is written once, and that write watches its row rules.

    ``own_keys`` says that the surrogate keys come from this package (see ``constraints.key_report``). ``tolerated`` names rules, each as (table,
    constraint, column), that are counted like all others but do not keep a version from being published.
    """

    def __init__(self, spark: SparkSession, base: str, max_records_per_file: int = 0, own_keys: bool = False,
                 tolerated: Collection[tuple[str, str, str]] = ()):
        self.spark, self.base = spark, base.rstrip("/")
        self.version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        self.path = f"{self.base}/{self.version}"
        self.max_records = max_records_per_file
        self.own_keys = own_keys
        self.tolerated = set(tolerated)
        self.rows: dict[str, int] = {}
        self.metrics: list[dict] = []
        self.broken: dict[str, dict[str, int]] = {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write a star table and return it as stored. A table without its generated key gets one."""
        table, seen, begin = STAR[name], Observation(name), time.perf_counter()
        if name == FACT:
            df = _with_layout(df)
            given = table.primary_key in df.columns
            judged = _stored_columns(df, table.primary_key if not given else None)
            # Files of a ready-made fact that hold so many rows at most need no gathering: a task cuts the months of its own rows.
            if not (given and self.max_records):
                judged = judged.hint("rebalance", *(F.col(c) for c in FACT_LAYOUT))
            if not given:
                # Unique without a second pass over the fact; nothing needs these numbers to be dense.
                judged = judged.withColumn(table.primary_key, (F.monotonically_increasing_id() + 1).cast(table.schema[table.primary_key].dataType))
        else:
            if table.generated_key and table.primary_key not in df.columns:
                df = with_surrogate_key(df, table.unique[0], table.primary_key, KEY_TIES.get(name, ()))
            judged = df.withColumn("_broken", broken_rules(table))
        watched = judged.observe(seen, F.count("_broken").alias("rows"), *broken_counts(table, "_broken"))
        if name == FACT:
            self._save(watched.select(*table.names, *(k for k in STORED_KEYS if k not in table.names), *FACT_LAYOUT), name, FACT_LAYOUT)
        else:
            self._save(conform(watched, table), name)
        self.rows[name] = seen.get["rows"]
        counts = {rule: n for rule, n in seen.get.items() if rule != "rows"}
        self.broken[name] = counts if any(counts.values()) else {}
        log.info("%-14s rows=%d", name, self.rows[name])
        for rule, count in self.broken[name].items():
            if count:  # a value that does not fit its column is stored as NULL; publish() refuses such a version unless it is told to tolerate the rule
                log.warning("%s: %d rows break %s", name, count, rule)
        if name == FACT:
            self._save_totals(read_table(self.spark, self.path, FACT))
        borne = sum(n for rule, n in self.broken[name].items() if (name, *rule.split(":")) in self.tolerated)
        self.metrics.append(metric(
            "load", name, self.rows[name], len(table.names), sum(self.broken[name].values()) - borne, time.perf_counter() - begin, borne))
        return read_table(self.spark, self.path, name)

    def write_rejects(self, df: DataFrame) -> None:
        """Raw rows turned away before they reached the star, as ``plans.fact.turned_away`` lists them."""
        self._save(df, TURNED_AWAY)

    def _save_totals(self, fact: DataFrame) -> None:
        """Orders with all their items in one month need one grouping; the others, if there are any, follow."""
        seen, spans = Observation(TOTALS), order_spans(fact)
        watched = spans.observe(seen, F.count_if(~F.col("one_month")).alias("others"))
        self._save(watched.where("one_month").drop("one_month"), TOTALS, [MONTH])
        if seen.get["others"]:
            others = spans.where("NOT one_month").select(F.col("order_id").alias("_order"))
            self._save(order_totals(fact.join(others, F.col("order_id").eqNullSafe(F.col("_order")), "left_semi")), TOTALS, [MONTH], "append")

    def _save(self, df: DataFrame, name: str, partition_by: list[str] | None = None, mode: str = "errorifexists") -> None:
        writer = df.write.mode(mode).option("maxRecordsPerFile", self.max_records)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/{name}")

    def stored(self) -> dict[str, DataFrame]:
        """This version's tables as they were written."""
        return read_tables(self.spark, self.path, list(self.rows))

    def violations(self) -> list[tuple[str, str, str, int]]:
        """Row rules as the writes saw them, uniqueness and references from the stored keys."""
        found = [(name, *rule.split(":"), n) for name, counts in self.broken.items() for rule, n in counts.items() if n]
        # One line per constraint: a fixed, small number.
        for row in key_report(self.stored(), own_keys=self.own_keys).where("violations > 0").collect():
            found.append((row["table"], row["constraint"], row["column"], row["violations"]))
        return found

    def report(self) -> DataFrame:
        """Every rule of this version with its count, as ``constraints.validate`` gives it for stored tables.

        The row rules were judged before values were cast to their column types, so the report also shows
        values that did not fit.
        """
        rows = [
            (name, *rule, self.broken[name].get(":".join(rule), 0))
            for name in self.rows for rule in row_rules(STAR[name])
        ]
        schema = "table string, constraint string, column string, violations bigint"
        return self.spark.createDataFrame(rows, schema).unionByName(key_report(self.stored()))

    def publish(self, metrics: list[dict] = ()) -> dict[str, DataFrame]:
        """Check the version and make it the current one, or raise and leave the old one in place. Returns this
        version's tables, also if another load has published since. The entry keeps the metrics of the writes, and those given."""
        found = [v for v in self.violations() if v[:3] not in self.tolerated]
        if found:
            raise ConstraintViolation(found)
        _append_entry(self.spark, self.base, {
            "version": self.version, "tables": list(self.rows), "metrics": [*metrics, *self.metrics]})
        return self.stored()


def metric(stage: str, table: str, rows: int, columns: int, problems: int, seconds: float, tolerated: int = 0) -> dict:
    """What a stage says of a table it has written. ``tolerated`` counts the broken rules that the load was told to tolerate; they are no problems."""
    return {"stage": stage, "table": table, "rows": rows, "columns": columns, "problems": problems, "seconds": round(seconds, 3), "tolerated": tolerated}


def load_metrics(spark: SparkSession, base: str) -> DataFrame:
    """version, stage, table, rows, columns, problems, seconds and tolerated of every table that a published load has read or written, as its
    stages observed them. Versions whose tables are deleted are still listed; a few rows a load."""
    lines = [(e["version"], *(m[c] for c in ("stage", "table", "rows", "columns", "problems", "seconds")), m.get("tolerated", 0))
             for e in _entries(spark, base.rstrip("/")) for m in e.get("metrics", [])]
    return spark.createDataFrame(
        lines, "version string, stage string, table string, rows bigint, columns int, problems bigint, seconds double, tolerated bigint")


def _with_layout(df: DataFrame) -> DataFrame:
    """Add what a ready-made fact may lack: the layout columns (the month follows from the day key) and freight,
    which is 0 unless given."""
    if "reject_reason" in df.columns:
        return df
    if "freight_value" not in df.columns:
        df = df.withColumn("freight_value", F.lit(0))
    return df.withColumns({
        "reject_reason": F.lit(KEPT), "purchase_month": F.expr("date_key div 100").cast("int"),
        "product_id": F.lit(None).cast("string"), "seller_id": F.lit(None).cast("string"),
    })


def _stored_columns(df: DataFrame, without: str | None) -> DataFrame:
    """Fact rows and rejected items go into one table in one pass, told apart by the first layout column; ``_broken`` has the rules a fact row
    breaks, judged before its values are cast. The column ``without`` is yet to come.

    The rebalance after it gathers each month into files of the advisory size and splits a month that is too
    big; it moves only what is stored. Item keys are kept for rejected rows only, and only those that no dimension has; other rows carry surrogate keys instead.
    """
    table, kept = STAR[FACT], F.col("reject_reason") == KEPT
    return df.select(
        *(F.col(c.name).try_cast(c.type).alias(c.name) for c in table.columns if c.name != without),
        *(F.when(~kept, F.col(c)).alias(c) for c in STORED_KEYS if c not in table.names),
        *FACT_LAYOUT, F.when(kept, broken_rules(table, without)).alias("_broken"),
    )


def read_tables(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    found = {name: read_table(spark, path, name) for name in names}
    if FACT in found:
        found[TOTALS] = spark.read.schema(f"order_id string, order_total decimal(32,2), {MONTH} int").parquet(f"{path}/{TOTALS}")
        months = _stored_months(spark, path)
        found[ENDS] = found[FACT].where(F.col(MONTH).isin(sorted({*months[:1], *months[-1:]})))
    return found


def _stored_months(spark: SparkSession, path: str) -> list[int]:
    """The months that have a partition of fact rows, in order; no file is opened."""
    fs, place = _folder(spark, f"{path}/{FACT}/{FACT_LAYOUT[0]}={KEPT}")
    if not fs.exists(place):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(place))
    return sorted(int(n.split("=")[1]) for n in names if re.fullmatch(rf"{MONTH}=\d+", n))


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    table = STAR[name]
    if name != FACT:
        return spark.read.schema(table.schema).parquet(f"{path}/{name}")
    rows = _stored_items(spark, path).where(F.col("reject_reason").eqNullSafe(KEPT))
    return rows.select(*table.names, "purchase_month")


def _stored_items(spark: SparkSession, path: str) -> DataFrame:
    schema = STAR[FACT].schema
    for column in ("product_id", "seller_id", "reject_reason"):
        schema = schema.add(column, "string")
    return spark.read.schema(schema.add("purchase_month", "integer")).parquet(f"{path}/{FACT}")


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _read_text(spark: SparkSession, path) -> str:
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8", "replace")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path, text: str) -> None:
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    out.write(bytearray(text.encode()))
    out.close()


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, place = _folder(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _checksum(entry: dict) -> str:
    return hashlib.sha256(json.dumps({k: v for k, v in entry.items() if k != "sha256"}, sort_keys=True).encode()).hexdigest()


def _whole(text: str, sealed: bool) -> dict | None:
    """An entry, or None if its file is not whole. Entries of earlier releases have no checksum."""
    try:
        entry = json.loads(text)
    except ValueError:
        return None
    return entry if not sealed or entry.get("sha256") == _checksum(entry) else None


def _entries(spark: SparkSession, base: str) -> list[dict]:
    """The manifest's entries in the order of publishing, one for each version; as many as there were loads."""
    found = {}
    for name in _names(spark, f"{base}/{MANIFEST}"):
        named = ENTRY_NAME.fullmatch(name)
        entry = named and _whole(_read_text(spark, _path(spark, base, MANIFEST, name)), named.group(2) is not None)
        if entry:
            found.pop(entry["version"], None)  # an entry that is moving stands in two places for a moment
            found[entry["version"]] = entry
    return list(found.values())


def _last_number(spark: SparkSession, base: str, but: str = "") -> int:
    return max((int(n[:10]) for n in _names(spark, f"{base}/{MANIFEST}") if ENTRY_NAME.fullmatch(n) and n != but), default=0)


def _append_entry(spark: SparkSession, base: str, entry: dict) -> None:
    sealed = json.dumps(entry | {"sha256": _checksum(entry)})
    number, own = _last_number(spark, base) + 1, uuid.uuid4().hex
    while True:
        name = f"{number:010d}-{own}.json"
        _write_text(spark, _path(spark, base, MANIFEST, name), sealed)
        last = _last_number(spark, base, name)
        if last <= number:
            return
        # Loads that listed the manifest later were faster. The new place comes first, so that the entry is never missing.
        former, number = name, last + 1
        _write_text(spark, _path(spark, base, MANIFEST, f"{number:010d}-{own}.json"), sealed)
        fs, place = _folder(spark, f"{base}/{MANIFEST}/{former}")
        fs.delete(place, False)


def _in_use(spark: SparkSession, base: str) -> set[str]:
    """The versions that views show or that a lease still holds. Leases that have run out are removed."""
    used = {_read_text(spark, _path(spark, base, SHOWN, name)) for name in _names(spark, f"{base}/{SHOWN}")}
    now = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}"
    for name in _names(spark, f"{base}/{LEASES}"):
        until, version, _ = name.split("_")
        if until >= now:
            used.add(version)
        else:
            fs, place = _folder(spark, f"{base}/{LEASES}/{name}")
            fs.delete(place, False)
    return used


def _current(spark: SparkSession, base: str) -> tuple[str, list[str]]:
    entries = _entries(spark, base)
    if not entries:
        raise FileNotFoundError(f"nothing has been published under {base}")
    return f"{base}/{entries[-1]['version']}", entries[-1]["tables"]


def open_star(spark: SparkSession, base: str, lease: timedelta | None = None) -> dict[str, DataFrame]:
    """The current version's tables by name. For the time of a ``lease`` the version is not deleted, whatever is published meanwhile."""
    base = base.rstrip("/")
    while True:
        path, tables = _current(spark, base)
        if lease is None:
            return read_tables(spark, path, tables)
        version = path.rsplit("/", 1)[1]
        until = f"{datetime.now(timezone.utc) + lease:%Y%m%dT%H%M%S}"
        _write_text(spark, _path(spark, base, LEASES, f"{until}_{version}_{uuid.uuid4().hex}"), "")
        fs, place = _folder(spark, path)
        if fs.exists(place):  # else it was deleted just before
            return read_tables(spark, path, tables)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """All raw rows a version turned away: source_table, reason, the raw keys, and the number of rows a line stands for."""
    keys = ", ".join(f"{k} string" for k in REJECT_KEYS)
    early = spark.read.schema(f"source_table string, reason string, {keys}, rows bigint").parquet(f"{path}/{TURNED_AWAY}")
    late = _stored_items(spark, path).where(F.col("reject_reason") != KEPT)
    # A key that was looked up stands in its dimension.
    for name in LOOKED_UP:
        key, table = STAR[name].unique[0], read_table(spark, path, name)
        late = late.join(table.select(STAR[name].primary_key, F.col(key).alias("_known")), STAR[name].primary_key, "left").withColumn(
            key, F.coalesce(key, "_known")).drop("_known")
    return early.unionByName(late.select(
        F.lit("order_items").alias("source_table"), F.col("reject_reason").alias("reason"),
        *(F.col(k) if k in STORED_KEYS else F.lit(None).cast("string").alias(k) for k in REJECT_KEYS),
        F.lit(1).cast("bigint").alias("rows")))


def open_rejects(spark: SparkSession, base: str) -> DataFrame:
    return read_rejects(spark, _current(spark, base.rstrip("/"))[0])


def load_star(spark: SparkSession, tables: dict[str, DataFrame], base: str, max_records_per_file: int = 0,
              tolerated: Collection[tuple[str, str, str]] = ()) -> dict[str, DataFrame]:
    """Full refresh from ready-made star tables, dimensions first. A missing table is skipped with a warning."""
    writer = StarWriter(spark, base, max_records_per_file, tolerated=tolerated)
    for name in LOAD_ORDER:
        if name in tables:
            writer.write(name, tables[name])
        else:
            log.warning("%s is not among the given tables, skipped", name)
    return writer.publish()


def drop_superseded(spark: SparkSession, base: str, keep: int = 2, abandoned_after: timedelta = timedelta(days=2)) -> list[str]:
    """Delete the versions published before the newest ``keep`` ones, and folders of loads that never published and
    began longer ago than ``abandoned_after``; return the names. Versions that views show or leases hold stay. Touches only
    folders named like a version: a load still running is not published, so it is safe for that long."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    base = base.rstrip("/")
    published = [e["version"] for e in _entries(spark, base)]
    current = set(published[-keep:]) | _in_use(spark, base)
    oldest = f"{datetime.now(timezone.utc) - abandoned_after:%Y%m%dT%H%M%S%f}"
    fs, root = _folder(spark, base)
    dropped = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if VERSION_NAME.fullmatch(name) and name not in current and (name in published or name < oldest):
            fs.delete(status.getPath(), True)
            dropped.append(name)
    return sorted(dropped)


def register_views(spark: SparkSession, base: str, database: str = "market_dw") -> None:
    """Publish the current version in the catalog with table and column comments. Can be run again any time.

    The version is noted as shown before the first view changes, beside the one shown so far, and that one is given up after the last: retention
    deletes neither while views of both may be in use.
    """
    base = base.rstrip("/")
    path, tables = _current(spark, base)
    version = path.rsplit("/", 1)[1]
    former = [n for n in _names(spark, f"{base}/{SHOWN}") if n.startswith(f"{database}.")]
    note = f"{database}.{uuid.uuid4().hex}"
    _write_text(spark, _path(spark, base, SHOWN, note), version)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in tables:
        table = STAR[name]
        columns = ", ".join(c.name + (f" COMMENT {_quoted(c.comment)}" if c.comment else "") for c in table.columns)
        names = table.names
        if name == FACT:  # a condition on the month reads only its partitions
            columns, names = columns + f", {MONTH} COMMENT {_quoted(MONTH_COMMENT)}", [*names, MONTH]
        kept = f" WHERE reject_reason = '{KEPT}'" if name == FACT else ""
        spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{name} ({columns}) COMMENT {_quoted(table.comment)} AS "
            f"SELECT {', '.join(names)} FROM parquet.`{path}/{name}`{kept}")
    for name in former:
        fs, place = _folder(spark, f"{base}/{SHOWN}/{name}")
        fs.delete(place, False)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def run_query(spark: SparkSession, star: dict[str, DataFrame], sql: str, params: dict | None = None) -> DataFrame:
    """SQL over the star's tables by name, with ``:name`` parameters bound by Spark. The names are given back afterwards:
    temporary views of the session that were called the same stay what they were."""
    before = {name: spark.table(name) for name in star if spark.catalog.tableExists(name) and _is_temporary(spark, name)}
    for name, df in star.items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(sql, args=params or {})
    finally:
        for name in star:
            spark.catalog.dropTempView(name)
        for name, df in before.items():
            df.createOrReplaceTempView(name)


def _is_temporary(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).isTemporary

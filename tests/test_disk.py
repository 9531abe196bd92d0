"""What a load leaves on disk, and what it holds there while it runs."""

import gzip
import os
import threading

import pytest
from pyspark.sql import functions as F

from test_many_sellers import many  # noqa: F401
from starbazaar import catalog
from starbazaar.plans.pipeline import run_pipeline
from starbazaar.session import SHUFFLE_CLEANUP_CONF, app_dir, short_shuffles, work_scope
from starbazaar.sources.csv_files import CsvProblems, load_raw_data, read_csv_table, read_with_problems, write_csv_tables

HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def files(folder):
    return {os.path.join(at, name) for at, _, names in os.walk(folder) for name in names if not name.startswith((".", "_"))}


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in files(str(d)) if os.path.basename(f).startswith("shuffle_") and f.endswith(".data")}


def shuffled(spark, path):
    before = shuffle_files(spark)
    spark.range(1000).groupBy(F.col("id") % 7).count().write.parquet(path)
    return shuffle_files(spark) - before


@pytest.fixture(scope="module")
def sound(raw):
    """Raw tables whose star obeys every rule."""
    return raw | {"customers": raw["customers"].replace("123456", "12345", "customer_zip_code_prefix")}


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    given = spark.conf.get(SHUFFLE_CLEANUP_CONF)
    with short_shuffles(spark):
        with short_shuffles(spark):
            assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == "true"
        assert not shuffled(spark, str(tmp_path / "inside"))
        assert spark.read.parquet(str(tmp_path / "inside")).count() == 7
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == given == "false"
    assert shuffled(spark, str(tmp_path / "outside"))


def test_overlapping_loads_give_the_setting_back(spark):
    entered, leave = threading.Event(), threading.Event()

    def other():
        with short_shuffles(spark):
            entered.set()
            leave.wait(30)

    thread = threading.Thread(target=other)
    with short_shuffles(spark):
        thread.start()
        assert entered.wait(30)
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == "true"
    leave.set()
    thread.join()
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == "false"


def test_a_load_from_csv_leaves_its_star_only(spark, sound, tmp_path):
    write_csv_tables(sound, str(tmp_path / "raw"))
    before, seen = files(app_dir(spark)), []

    def extract():
        found = load_raw_data(spark, str(tmp_path / "raw"))
        seen.append(files(app_dir(spark)) - before)
        return found

    shuffles = shuffle_files(spark)
    star, _ = run_pipeline(spark, extract, str(tmp_path / "star"))
    assert star["fact_orders"].count() == 4
    assert seen[0] and files(app_dir(spark)) == before
    # The reads of its results above are no part of the load.
    assert len(shuffle_files(spark) - shuffles) <= 8


def test_landed_tables_stay_outside_of_a_load(spark, sound, tmp_path):
    write_csv_tables(sound, str(tmp_path / "raw"))
    found = load_raw_data(spark, str(tmp_path / "raw"))
    assert found["sellers"].count() == 1
    with work_scope(spark):
        inside = load_raw_data(spark, str(tmp_path / "raw"))["sellers"].inputFiles()
    assert found["sellers"].count() == 1 and not any(os.path.exists(f.removeprefix("file://")) for f in inside)


def test_the_csv_files_of_a_query_go_when_they_are_landed(spark, many):  # noqa: F811
    with catalog._csv_files(spark, many) as folder:
        written = files(folder)
        assert written and all(f.endswith(".csv.gz") for f in written)
    assert not os.path.exists(folder)
    found = catalog.queries()["csv_scan"](spark, many)
    assert {(r["table"], r["column"]): r["filled"] for r in found.collect()}["order_items", "order_id"] == 80
    assert not [f for f in files(app_dir(spark)) if f.endswith((".csv", ".csv.gz"))]


def test_compressed_files_are_read_with_their_problems(spark, tmp_path):
    folder = tmp_path / "market_sellers_dataset.csv"
    folder.mkdir()
    with gzip.open(folder / "part-0.csv.gz", "wt") as out:
        out.write(HEADER + "s1,01037,sao paulo,SP\ns2,20000,rio,RJ\n")
    with gzip.open(folder / "part-1.csv.gz", "wt") as out:
        out.write(HEADER + 's3,30000,"belo\nhorizonte",MG\ns4\n')
    (folder / "part-2.csv").write_text("seller_state,seller_id,seller_city,seller_zip_code_prefix\nBA,s5,salvador,40000\n")
    rows = {r["seller_id"]: (r["seller_zip_code_prefix"], r["seller_city"], r["seller_state"]) for r in read_csv_table(spark, str(folder), "sellers").collect()}
    assert rows == {"s1": ("01037", "sao paulo", "SP"), "s2": ("20000", "rio", "RJ"), "s3": ("30000", "belo\nhorizonte", "MG"), "s5": ("40000", "salvador", "BA")}
    found = read_with_problems(spark, str(folder), "sellers").select(F.explode("_problems").alias("p")).select("p.problem", "p.value").collect()
    assert [tuple(r) for r in found] == [("wrong_width", "s4")]


def test_a_compressed_data_set_is_refused_like_any_other(spark, sound, tmp_path):
    base = str(tmp_path / "raw")
    write_csv_tables(sound, base, compression="gzip", max_records_per_file=2)
    assert len(files(f"{base}/market_orders_dataset.csv")) >= 4 and load_raw_data(spark, base)["orders"].count() == 7
    with gzip.open(f"{base}/market_sellers_dataset.csv/part-9.csv.gz", "wt") as out:
        out.write(HEADER + "s9\n")
    with pytest.raises(CsvProblems) as refused:
        load_raw_data(spark, base)
    assert [f[:4] for f in refused.value.found] == [("sellers", None, "wrong_width", 1)]

import csv
import io
import random

import pytest

from starbazaar.sources import csv_records
from starbazaar.sources.csv_files import (
    CsvProblems, FILES, load_raw_data, problems, read_csv_table, read_with_problems, write_csv_tables)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_quoted_line_breaks_and_quotes_stay_in_one_row(spark, tmp_path):
    path = write(tmp_path / "x_order_reviews_dataset.csv", (
        "review_id,order_id,review_score,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,"good, ""very"" good\nnext line",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
        "r2,o2,1,,2018-03-10 00:00:00,\n"))
    rows = read_csv_table(spark, path, "reviews").orderBy("review_id").collect()
    assert [(r["review_id"], r["review_score"]) for r in rows] == [("r1", 5), ("r2", 1)]
    assert str(rows[0]["review_answer_timestamp"]) == "2018-01-18 21:46:59"
    assert rows[1]["review_answer_timestamp"] is None


def test_columns_go_by_name_and_missing_texts_are_null(spark, tmp_path):
    path = write(tmp_path / "x_products_dataset.csv", (
        '﻿product_weight_g,product_id,product_name_lenght,product_category_name,product_length_cm,'
        "product_height_cm,product_width_cm\n"
        "225.0,p1,40,nan,16,10,14\nNA,p2,,cama,,,\n"))
    rows = read_csv_table(spark, path, "products").orderBy("product_id").collect()
    assert (rows[0]["product_weight_g"], rows[0]["product_category_name"]) == (225.0, None)
    assert (rows[1]["product_weight_g"], rows[1]["product_category_name"]) == (None, "cama")


def test_zip_codes_keep_their_zeros(spark, tmp_path):
    path = write(tmp_path / "x_sellers_dataset.csv",
                 "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01037,sao paulo,SP\n")
    assert read_csv_table(spark, path, "sellers").first()["seller_zip_code_prefix"] == "01037"


def test_a_missing_column_is_named(spark, tmp_path):
    path = write(tmp_path / "x_sellers_dataset.csv", "seller_id\ns1\n")
    with pytest.raises(ValueError, match="seller_state"):
        read_csv_table(spark, path, "sellers")


def test_all_tables_round_trip(spark, raw, tmp_path, monkeypatch):
    write_csv_tables(raw, str(tmp_path))
    monkeypatch.setenv("RAW_DATA_PATH", str(tmp_path))
    read = load_raw_data(spark)
    assert set(read) == set(FILES)
    for name, df in read.items():
        assert df.schema == raw[name].schema
        assert df.exceptAll(raw[name]).count() == 0 and raw[name].exceptAll(df).count() == 0, name


def test_a_quoted_line_break_is_kept_in_any_table(spark, tmp_path):
    path = write(tmp_path / "x_sellers_dataset.csv",
                 'seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01037,"sao\npaulo",SP\n')
    assert [tuple(r) for r in read_csv_table(spark, path, "sellers").collect()] == [("s1", "01037", "sao\npaulo", "SP")]


def test_what_cannot_be_read_is_counted(spark, tmp_path):
    path = write(tmp_path / "x_order_reviews_dataset.csv", (
        "review_id,order_id,review_score,review_creation_date,review_answer_timestamp\n"
        "r1,o1,abc,2018-01-18 00:00:00,soon\nr2,o2,4.9,,\nr3,o3,4.0,,\nr4,o4\nr5,o5,1,,,surplus\n"))
    rows = read_with_problems(spark, path, "reviews")
    found = {(r["column"], r["problem"]): (r["n"], r["sample"]) for r in problems({"reviews": rows}).collect()}
    assert found == {("review_score", "unreadable"): (2, "4.9"), ("review_answer_timestamp", "unreadable"): (1, "soon"),
                     (None, "wrong_width"): (2, "r4,o4")}
    assert {r["review_id"]: r["review_score"] for r in read_csv_table(spark, path, "reviews").collect()} == {"r1": None, "r2": None, "r3": 4}


def test_columns_go_by_each_files_own_header(spark, tmp_path):
    folder = tmp_path / "x_sellers_dataset.csv"
    folder.mkdir()
    write(folder / "part-0.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,10000,a,SP\n")
    write(folder / "part-1.csv", "seller_state,seller_id,note,seller_zip_code_prefix,seller_city\nRJ,s2,new,20000,b\n")
    write(folder / "part-2.csv", "")
    rows = read_csv_table(spark, str(folder), "sellers").orderBy("seller_id")
    assert rows.columns == ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state", "note"]
    assert [tuple(r) for r in rows.collect()] == [("s1", "10000", "a", "SP", None), ("s2", "20000", "b", "RJ", "new")]


def test_a_load_refuses_or_reports(spark, raw, tmp_path):
    base = str(tmp_path)
    write_csv_tables(raw, base)
    write(tmp_path / "market_sellers_dataset.csv" / "part-9.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns9\n")
    with pytest.raises(CsvProblems) as refused:
        load_raw_data(spark, base)
    assert refused.value.found == [("sellers", None, "wrong_width", 1, "s9")]
    assert load_raw_data(spark, base, on_problem="report")["sellers"].count() == 1


def test_one_data_set_at_a_time(spark, raw, tmp_path):
    base = str(tmp_path)
    write_csv_tables(raw, base, "one")
    write_csv_tables({k: df.limit(1) for k, df in raw.items() if k != "category_xlat"}, base, "two")
    with pytest.raises(ValueError, match="one, two"):
        load_raw_data(spark, base)
    assert load_raw_data(spark, base, prefix="two")["orders"].count() == 1


HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def spoiled_lines(seed, n):
    """Fields with quotes, commas and line breaks of all kinds, as CSV text and as what they say."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        city = "".join(draw.choice(["a", "é", ",", '"', "\n", "\n\n", "x y", "\r\n"]) for _ in range(draw.randint(0, 6)))
        rows.append((f"s{i:05}", "1" * draw.randint(0, 5), city.strip(), draw.choice(["SP", "RJ"])))
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator="\n").writerows(rows)
    return out.getvalue(), rows


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of 200 bytes, as large files have ranges of many megabytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", [1, 2])
def test_records_over_byte_ranges_equal_the_whole_file_read(spark, tmp_path, small_ranges, seed):
    text, rows = spoiled_lines(seed, 120)
    path = write(tmp_path / "x y%20_sellers_dataset.csv", HEADER + text)
    assert len(list(tmp_path.iterdir())) == 1
    found = read_with_problems(spark, path, "sellers")
    assert all(r["_problems"] == [] for r in found.collect())
    got = sorted(tuple(r)[:4] for r in found.collect())
    missing = {"", "NA"}
    assert got == sorted(tuple(None if v in missing else v for v in r) for r in rows)


def test_stray_quotes_do_not_move_records(spark, tmp_path, small_ranges):
    lines = [f's{i},5" pipe,"a ""b"" {i}",SP' if i % 3 else f's{i},1,"line\nbreak, {i}",SP' for i in range(100)]
    found = read_csv_table(spark, write(tmp_path / "x_sellers_dataset.csv", HEADER + "\n".join(lines)), "sellers").collect()
    assert {r.seller_id: (r.seller_zip_code_prefix, r.seller_city) for r in found} == {
        f"s{i}": ('5" pipe', f'a "b" {i}') if i % 3 else ("1", f"line\nbreak, {i}") for i in range(100)}


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_records_over_stretches_of_a_range_equal_the_whole_file_read(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(csv_records, "STRETCH", bits)
    text, rows = spoiled_lines(3, 120)
    path = write(tmp_path / "x_sellers_dataset.csv", HEADER + text)
    got = sorted(tuple(r)[:4] for r in read_with_problems(spark, path, "sellers").collect())
    assert got == sorted(tuple(v or None for v in r) for r in rows)


def test_no_condition_parses_records_again(spark, tmp_path):
    path = write(tmp_path / "x_sellers_dataset.csv", HEADER + 's1,1,"ci\nty",SP\ns2,2\n')
    found = problems({"sellers": read_with_problems(spark, path, "sellers")})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "from_csv" in plan
    assert not [line for line in plan.splitlines() if "Filter" in line and "from_csv" in line]
    assert [(r["problem"], r["n"]) for r in found.collect()] == [("wrong_width", 1)]


def _tasks(df):
    return df.rdd.getNumPartitions()


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    plain = write(tmp_path / "a_sellers_dataset.csv", HEADER + "".join(f"s{i},1,city,SP\n" for i in range(60)))
    assert _tasks(read_csv_table(spark, plain, "sellers")) > 5
    quoted = write(tmp_path / "b_sellers_dataset.csv", HEADER + "".join(f's{i},1,"ci\nty",SP\n' for i in range(60)))
    assert _tasks(csv_records.lines(spark, [quoted])) > 5
    assert read_csv_table(spark, plain, "sellers").count() == read_csv_table(spark, quoted, "sellers").count() == 60


def test_a_file_without_quoted_line_breaks_is_not_shuffled(spark, tmp_path):
    path = write(tmp_path / "a_sellers_dataset.csv", HEADER + 's1,1,"a ""quoted"", city",SP\n')
    plan = read_csv_table(spark, path, "sellers")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FileScan csv" in plan


@pytest.mark.parametrize("tail", ['s2,1,"never closed,SP\n', 's2,1,"never ""closed"",SP\ns3,1,x,SP\ns4,1,y,RJ\n', 's2,1,"'])
def test_an_open_quote_refuses_the_load(spark, raw, tmp_path, small_ranges, tail):
    write_csv_tables(raw, str(tmp_path))
    write(tmp_path / "market_sellers_dataset.csv" / "part-9.csv", HEADER + 's1,1,"a\nb",SP\n' + tail)
    with pytest.raises(CsvProblems) as refused:
        load_raw_data(spark, str(tmp_path))
    assert refused.value.found == [("sellers", None, "open_quote", 1, tail.split("\n")[0])]
    sellers = load_raw_data(spark, str(tmp_path), on_problem="report")["sellers"]
    assert sorted(r.seller_city for r in sellers.collect()) == ["a\nb", "y"]


def test_bytes_that_are_not_utf8_refuse_the_load(spark, raw, tmp_path):
    write_csv_tables(raw, str(tmp_path))
    (tmp_path / "market_sellers_dataset.csv" / "part-9.csv").write_bytes(HEADER.encode() + "s1,1,são,SP\ns2,1,s".encode() + b"\xe3o,SP\r\ns3,1,x\xff\n")
    with pytest.raises(CsvProblems) as refused:
        load_raw_data(spark, str(tmp_path))
    assert [(t, c, p, n) for t, c, p, n, _ in refused.value.found] == [("sellers", None, "not_utf8", 2), ("sellers", None, "wrong_width", 1)]
    sellers = load_raw_data(spark, str(tmp_path), on_problem="report")["sellers"]
    assert sorted(r.seller_city for r in sellers.collect()) == ["são", "s�o", "y"]


def test_a_header_may_hold_a_line_break(spark, tmp_path):
    path = write(tmp_path / "x_sellers_dataset.csv", '"a\nnote",' + HEADER + "n1,s1,1,c,SP\n")
    rows = read_csv_table(spark, path, "sellers")
    assert rows.columns[-1] == "a\nnote" and [tuple(r) for r in rows.collect()] == [("s1", "1", "c", "SP", "n1")]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_line_ends(spark, tmp_path, small_ranges, end):
    rows = [("s1", "1", "a"), ("s2", "2", "b,c"), ("s3", "3", 'd"e')]
    for quoted in (False, True):
        lines = HEADER + "".join(f'{i},{z},"{c.replace(chr(34), chr(34) * 2)}{chr(10) * quoted}",SP\n' for i, z, c in rows) + "\n"
        path = tmp_path / f"{quoted}_sellers_dataset.csv"
        path.write_bytes(lines.replace("\n", end).encode())
        found = read_csv_table(spark, str(path), "sellers").orderBy("seller_id").collect()
        assert [(r.seller_id, r.seller_zip_code_prefix, r.seller_city.replace("\r\n", "\n").replace("\r", "\n")) for r in found] == [
            (i, z, c + "\n" * quoted) for i, z, c in rows]

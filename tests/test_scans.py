"""Scans of delivered files: broken lines, folders, bundles, and that the queries really read files."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from skycat.operators import jobs
from skycat.plans.queries import QUERIES
from skycat.sources import readers
from tests.compare import TESTDATA


@pytest.mark.parametrize("name", ["scan_ascii_catalog", "scan_psf_catalog_pair", "scan_positions", "scan_injection_json", "scan_csv_schedule", "row_checksum",
                                  "parse_job_logs", "parse_product_configs"])
def test_queries_scan_files(spark, name):
    plan = io.StringIO()
    with redirect_stdout(plan):
        QUERIES[name](spark, f"{TESTDATA}/sf0.001").explain("formatted")
    assert any(f"Scan {kind}" in plan.getvalue() for kind in ("text", "csv", "binaryFile")), plan.getvalue()[:2000]


def test_broken_catalogue_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# head\n1 2.5 x\n\n2 y x\n3 4.5\n4 5.5 x z\nfive 6.5 x\n")
    rows = readers.read_ascii_catalog(spark, str(tmp_path / "a.txt"), ["id", "v", "w"], {"id": "int", "v": "double"}, "broken").collect()
    assert [(r["id"], r["v"], r["broken"]) for r in rows] == [(1, 2.5, None), (2, None, "2 y x"), (3, 4.5, "3 4.5"), (4, 5.5, "4 5.5 x z"), (None, 6.5, "five 6.5 x")]
    assert {r["file"].rsplit("/", 1)[1] for r in rows} == {"a.txt"}


def test_broken_requests_are_kept_apart(spark, tmp_path):
    (tmp_path / "r.csv").write_text("# reqid,ra,dec\n1,2.0,3.0\n2,north,3.0\n3,4.0\n4,5.0,6.0,7.0\n")
    rows = {r["reqid"]: r for r in readers.read_positions(spark, str(tmp_path / "r.csv"), "broken").collect()}
    assert {k for k, r in rows.items() if r["broken"] is None} == {1} and rows[2]["broken"] == "2,north,3.0"
    assert sorted(r["broken"] for r in rows.values() if r["broken"]) == ["2,north,3.0", "3,4.0", "4,5.0,6.0,7.0"]


def test_names_of_folders(spark, tmp_path):
    df = spark.createDataFrame([("a b.ini", "x"), ("c%d=e", "y")], "name string, value string")
    df.write.partitionBy("name").text(str(tmp_path / "t"))
    got = readers.read_lines(spark, str(tmp_path / "t")).select(readers.folder_name(F.col("file")).alias("n"), "value").collect()
    assert ("a b.ini", "x") in {tuple(r) for r in got}


def test_bundles(spark, tmp_path):
    (tmp_path / "b.txt").write_text("job_1.ini\t0\t[A]\njob_1.ini\t1\tk = v\tw\nno bundle line\njob_2.ini\tx\ty\n")
    assert {tuple(r) for r in readers.read_bundled_lines(spark, str(tmp_path / "b.txt")).collect()} == {("job_1.ini", 0, "[A]"), ("job_1.ini", 1, "k = v\tw")}


def test_loads_know_null_keys_and_repeated_ones(spark, tmp_path):
    from skycat.sources import writers

    schema = "pid long, id int, flux double, proc_date string, sca int"
    rows = [(1, 1, 1.0, "2020", 1), (1, 1, 0.5, "2020", 1), (None, 2, 2.0, "2020", 1), (None, 2, 1.0, "2020", 1), (3, None, 1.0, "2021", 2), (4, 4, 4.0, "2021", 2)]
    positive, negative = spark.createDataFrame(rows, schema), spark.createDataFrame(rows[:1], schema)
    path = str(tmp_path / "sources")
    assert writers.bulk_load_sources(positive, negative, path) == 5
    assert writers.bulk_load_sources(positive, negative, path) == 0
    assert writers.bulk_load_sources(spark.createDataFrame([(None, 9, 1.0, "2021", 2), (3, None, 9.0, "2021", 2)], schema), negative, path) == 1
    got = {(r["pid"], r["id"], r["isdiffpos"]): r["flux"] for r in spark.read.parquet(path).collect()}
    assert got == {(1, 1, True): 0.5, (None, 2, True): 1.0, (3, None, True): 1.0, (4, 4, True): 4.0, (1, 1, False): 1.0, (None, 9, True): 1.0}


def test_folder_names_are_cut_not_searched(spark):
    """The name is cut at the slashes: the pattern of before tried every letter of the path on every line."""
    paths = ["file:/a/b=c/d%20e/part-0.txt", "s3://x/file=017_plan.ecsv/part-1", "/only", "x/y", "no slash", "a=/f", "a=b=c/f", "a//f", "", "tail/", None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    name = readers.folder_name(F.col("p"))
    before = F.url_decode(F.regexp_extract("p", r"([^/=]+)/[^/]*$", 1))
    assert [r[0] for r in df.orderBy("i").select(name).collect()] == [r[0] for r in df.orderBy("i").select(before).collect()]
    assert "regexp" not in df.select(name)._jdf.queryExecution().toString().lower()


def test_exposure_plan_lines(spark):
    lines = ["# %ECSV 1.0", "PLAN PASS NAME", " PLAN 1 x", "PLANS 2 star", "3 4 <no name>", "5 6 <no name> ", "7 8 a <no name> b", "", "   ", "9 10 star", "\tPLAN 11"]
    df = spark.createDataFrame([("x/017_plan.ecsv", v) for v in lines] + [("x/017_plan.ecsv", None)], "file string, value string")
    plans = readers.parse_exposure_plan(df, ["PLAN", "PASS", "NAME"], {"PLAN": "string", "PASS": "bigint", "NAME": "string"})
    got = sorted((r["PLAN"], r["PASS"], r["NAME"], r["program"]) for r in plans.filter("PASS IS NOT NULL").collect())
    assert got == [("3", 4, "<no_name>", 17), ("5", 6, "<no_name>", 17), ("7", 8, "a", 17), ("9", 10, "star", 17), ("PLANS", 2, "star", 17)]
    text = plans._jdf.queryExecution().optimizedPlan().toString().lower()
    assert text.count("regexp_replace") == text.count("contains(") > 0  # the pattern is tried only on lines that can match


def test_config_lines_are_dealt_to_many_tasks(spark):
    rows = [(f"job_{i}.ini", n, v) for i in range(40) for n, v in enumerate(["[A]", "x = 1", f"x = {i}", "[B]", "y = z"])]
    lines = spark.createDataFrame(rows, "file string, line_no int, value string")
    dealt = jobs.parse_product_configs(lines, 7)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, jobs.parse_product_configs(lines).collect()))
    assert dealt.rdd.getNumPartitions() == 7 and dealt.count() == 80

import os
from datetime import date

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import NumberFormatException, PySparkException
from pyspark.sql import functions as F

from martwright.schemas import SOURCES, conform
from martwright.sources import landing, raw


def put(root, table, day, text, name=None):
    folder = f"{root}/{table}/{day}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name or table}.csv", "w") as f:
        f.write(text)


def scans(plan) -> list[tuple[str, int]]:
    """Kind and number of files of all scans that a plan has run."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    leaves, out = plan.collectLeaves(), []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName().startswith("Scan"):
            out.append((leaf.nodeName(), leaf.metrics().apply("numFiles").value()))
        elif "QueryStage" in leaf.nodeName():
            out += scans(leaf.plan())
    return out


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def test_columns_are_matched_by_name(spark, root):
    put(root, "t", "2024-01-01", "id,status\n0101,old\n")
    put(root, "t", "2024-01-02", "status,id,extra\nnew,0102,\n")
    put(root, "t", "2024-01-03", "id,status\n0103,x\n")
    rows = landing.scan_extracts(spark, root, "t").drop("filename").orderBy("id").collect()
    assert [tuple(r[c] for c in ("id", "status", "extra", "extract_date")) for r in rows] == [
        ("0101", "old", None, "2024-01-01"),
        ("0102", "new", None, "2024-01-02"),
        ("0103", "x", None, "2024-01-03"),
    ]


def test_one_scan_per_header_not_per_day(spark, root):
    for day in range(1, 10):
        put(root, "t", f"2024-01-0{day}", "id,status\n1,a\n" if day != 5 else "status,id\na,1\n")
    df = landing.scan_extracts(spark, root, "t")
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2
    assert df.count() == 9


def test_headers_that_drift(spark, root):
    headers = {"01": "id,a,b", "02": "id,a,b", "03": "id,b,a", "05": "id,b,c", "06": "", "07": "id,b,c", "08": "id,a,b"}
    for day, header in headers.items():
        put(root, "t", f"2024-01-{day}", f"{header}\n" if header else "")
    found = landing.header_drift(spark, root, "t").orderBy("from_day").collect()
    assert [(r.from_day[-2:], r.to_day[-2:], r.days, r.came, r.went, r.moved) for r in found] == [
        ("01", "02", 2, [], [], []),
        ("03", "03", 1, [], [], ["b", "a"]),
        ("05", "07", 2, ["c"], ["a"], []),
        ("08", "08", 1, ["a"], ["c"], []),
    ]


def test_files_of_a_day_must_share_their_header(spark, root):
    put(root, "t", "2024-01-01", "id,status\n1,a\n", "part-0")
    put(root, "t", "2024-01-01", "status,id\na,2\n", "part-1")
    with pytest.raises((PySparkException, Py4JJavaError)):
        landing.scan_extracts(spark, root, "t").collect()


def test_latest_is_the_latest_day_with_rows(spark, root):
    put(root, "t", "2024-01-01", "id\n1\n")
    put(root, "t", "2024-01-02", "id\n2\n")
    put(root, "t", "2024-01-03", "id\n")
    assert [r.id for r in landing.scan_latest(spark, root, "t").collect()] == ["2"]
    assert [r.id for r in landing.latest_only(landing.scan_extracts(spark, root, "t")).collect()] == ["2"]


def test_latest_reads_one_day(spark, root):
    for day in range(1, 6):
        put(root, "t", f"2024-01-0{day}", f"id\n{day}\n")
    assert len(landing.scan_latest(spark, root, "t").inputFiles()) == 1
    filtered = landing.latest_only(landing.scan_extracts(spark, root, "t"))
    filtered.collect()
    found = scans(filtered._jdf.queryExecution().executedPlan())
    assert found == [("Scan csv ", 1)]


def test_only_header_days_give_an_empty_extract(spark, root):
    put(root, "t", "2024-01-01", "id,status\n")
    df = landing.scan_latest(spark, root, "t")
    assert df.columns[:2] == ["id", "status"] and df.count() == 0


def test_path_without_a_day_sorts_lowest(spark, root):
    put(root, "t", "misc", "id\n0\n")
    assert landing.scan_latest(spark, root, "t").first().extract_date == ""
    put(root, "t", "2024-01-01", "id\n1\n")
    assert {r.extract_date for r in landing.scan_extracts(spark, root, "t").collect()} == {"", "2024-01-01"}
    assert [r.id for r in landing.scan_latest(spark, root, "t").collect()] == ["1"]


def test_missing_extracts_raise(spark, root):
    with pytest.raises(FileNotFoundError):
        landing.extract_days(spark, root, "t")
    os.makedirs(f"{root}/t/2024-01-02")
    put(root, "t", "2024-01-01", "")
    with pytest.raises(FileNotFoundError):
        landing.scan_extracts(spark, root, "t")
    with pytest.raises(FileNotFoundError):
        landing.scan_latest(spark, root, "t")


def test_empty_files_and_folders_are_passed_over(spark, root):
    put(root, "t", "2024-01-01", "id\n1\n")
    put(root, "t", "2024-01-02", "", "part-0")
    put(root, "t", "2024-01-02", "id\n2\n", "part-1")
    put(root, "t", "2024-01-03", "")
    os.makedirs(f"{root}/t/2024-01-04")
    assert [r.id for r in landing.scan_latest(spark, root, "t").collect()] == ["2"]
    assert sorted(r.id for r in landing.scan_extracts(spark, root, "t").collect()) == ["1", "2"]


def test_text_survives_landing(spark, root):
    rows = [("1", ' spaced "quoted" ', "0101"), ("2", "two\nlines, and a comma", None), ("3", "back\\slash", "é")]
    df = spark.createDataFrame(rows, "id string, text string, code string")
    landing.land(df, root, "t", date(2024, 1, 1))
    back = landing.scan_latest(spark, root, "t").select("id", "text", "code").orderBy("id").collect()
    assert [tuple(r) for r in back] == rows
    assert [tuple(r) for r in landing.landed_counts(spark, root, "t").collect()] == [("2024-01-01", 3)]


def test_same_day_is_replaced_and_other_days_stay(spark, root):
    for day, n in (("2024-01-01", 3), ("2024-01-02", 5), ("2024-01-02", 4)):
        landing.land(spark.range(n).select(F.col("id").cast("string")), root, "t", day)
    counts = {r.extract_date: r.row_count for r in landing.landed_counts(spark, root, "t").collect()}
    assert counts == {"2024-01-01": 3, "2024-01-02": 4}
    assert landing.landed_counts(spark, root, "t", ["2024-01-01"]).count() == 1


def test_empty_extract_keeps_its_header(spark, root):
    landing.land(spark.range(0).select(F.col("id").cast("string")), root, "t", "2024-01-01")
    assert landing.scan_latest(spark, root, "t").columns[0] == "id"


def test_files_stay_small(spark, root):
    landing.land(spark.range(0, 1000, 1, 1), root, "t", "2024-01-01", rows_per_file=100)
    assert len(landing.scan_latest(spark, root, "t").inputFiles()) == 10
    assert landing.scan_latest(spark, root, "t").count() == 1000


def test_files_are_split_unless_a_record_in_them_spans_lines(spark, root):
    plain = "".join(f'{i},"quoted ""{i}"", text"\n' for i in range(5000))
    put(root, "t", "2024-01-01", "id,text\n" + plain, "plain")
    put(root, "t", "2024-01-01", 'id,text\n5000,"two\nlines"\n5001,"a\rb"\n', "with space")
    whole = landing.scan_latest(spark, root, "t").collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        split = landing.scan_latest(spark, root, "t")
        assert split.rdd.getNumPartitions() > 4
        assert sorted(map(str, split.collect())) == sorted(map(str, whole)) and len(whole) == 5002
        assert split.filter("text = 'quoted \"7\", text'").count() == 1
        assert split.filter("text = 'two\nlines'").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_rule_of_parsing_whatever_the_splits(spark, root):
    odd = ['1,"a\r\nb",x\n', "2,a\rb,x\n", "3,a,x\r\n", "\n", '4,st"ray,x\n', '5,"a"junk,x\n', '6,"q""q",x\n']
    for n, line in enumerate(odd):
        put(root, "t", "2024-01-01", "id,a,b\n" + line, f"f{n}")
    first = sorted(map(str, landing.scan_latest(spark, root, "t").collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4")
    try:
        assert sorted(map(str, landing.scan_latest(spark, root, "t").collect())) == first
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert any("'a\\rb'" in r for r in first) and len(first) == 6


def test_an_older_day_is_taken_with_a_warning(spark, root):
    put(root, "t", "2024-01-01", "id\n1\n")
    put(root, "t", "2024-01-02", "id\n2\n", "z")
    os.rename(f"{root}/t/2024-01-02/z.csv", f"{root}/t/2024-01-02/z.CSV")
    with pytest.warns(UserWarning, match="2024-01-02"):
        assert [r.id for r in landing.scan_latest(spark, root, "t").collect()] == ["1"]


def test_conform_types_once_and_fills_missing_columns(spark, root):
    put(
        root,
        "policies",
        "2024-01-01",
        "policy_id,has_pif,term_years,contribution_amount,start_date\n007,True,5,1.255,2024-01-02\n008,f,,,\n",
    )
    df = conform(landing.scan_latest(spark, root, "policies"), SOURCES["policies"])
    assert df.schema.names == SOURCES["policies"].names
    assert [f.dataType for f in df.schema] == [f.dataType for f in SOURCES["policies"]]
    first, second = df.orderBy("policy_id").collect()
    assert (first.policy_id, first.has_pif, first.term_years, str(first.contribution_amount)) == ("007", True, 5, "1.26")
    assert first.start_date == date(2024, 1, 2) and first.branch is None
    assert (second.has_pif, second.term_years, second.contribution_amount, second.start_date) == (False, None, None, None)


def test_malformed_values_raise_in_staging_and_dates_only_are_tolerated_in_raw(spark):
    good = {"claim_id": "1", "policy_id": "p", "claim_type": "x", "claim_date": "2024-13-01", "claim_amount": "1", "fund_type": "PRF", "status": "s", "approval_date": "n/a"}
    df = spark.createDataFrame([tuple(good.values())], ", ".join(f"{c} string" for c in good))
    with pytest.raises(PySparkException):
        conform(df, SOURCES["claims"]).collect()
    row = raw.load_raw(df, SOURCES["claims"]).first()
    assert row.claim_date is None and row.approval_date is None and row.claim_id == "1"
    with pytest.raises(NumberFormatException):
        raw.load_raw(df.withColumn("claim_amount", F.lit("much")), SOURCES["claims"]).collect()


def test_extract_date_of_a_path(spark):
    paths = ["s3://zone/t/2024-01-02/t.csv", "s3://zone/2024-01-01/t/t.csv", "t.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(landing.extract_date(F.col("p"))).collect()] == ["2024-01-02", "", ""]



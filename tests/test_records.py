"""Records that span lines, in files cut at any byte, against Python's own reader of CSV."""

import csv
import io
import os
import random

import pytest

from martwright.sources import landing, records

HEADER = "id,text,last"


def put(root, day, content: str, name="f"):
    folder = f"{root}/t/{day}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w", newline="") as f:
        f.write(content)


def made(seed: int, rows: int, newline: str) -> str:
    """A file with quoted values of all kinds."""
    rng, out = random.Random(seed), [HEADER]
    pieces = ["a", " ", "ü", "\n", "\r\n", "\r", '""', ",", '""a""', "\n\n", "x" * 30, '"",""', "\n,"]
    for i in range(rows):
        value = "".join(rng.choices(pieces, k=rng.randint(0, 9)))
        plain = not set(value) & set('",\r\n')
        out.append(f'{i},{value if plain else chr(34) + value + chr(34)},{rng.choice(["", "z", chr(34) + "q,q" + chr(34)])}')
        if rng.random() < 0.1:
            out.append("")
    return newline.join(out) + (newline if rng.random() < 0.5 else "")


def plain(content: str) -> list[tuple]:
    """An unquoted empty cell is NULL; so is a quoted one, as Spark reads it."""
    rows = [r for r in csv.reader(io.StringIO(content, newline=""), strict=True) if r][1:]
    return sorted(tuple(c or None for c in r) for r in rows)


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few bytes, so that values span several of them."""

    def use(size: int):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def scanned(spark, root) -> list[tuple]:
    df = landing.scan_extracts(spark, root, "t")
    return sorted(((r.id, r.text, r.last) for r in df.collect()), key=str)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [13, 97, 1 << 20])
def test_any_cut_gives_the_records_of_the_file(spark, tmp_path, small_ranges, newline, size):
    files = [made(seed, 60, newline) for seed in range(4)]
    for n, content in enumerate(files):
        put(str(tmp_path), "2024-01-01", content, f"f{n}")
    small_ranges(size)
    assert scanned(spark, str(tmp_path)) == sorted((row for f in files for row in plain(f)), key=str)


def test_files_with_spanning_records_are_split(spark, tmp_path, small_ranges):
    body = "".join(f'{i},"two\nlines of {i}",z\n' for i in range(3000))
    put(str(tmp_path), "2024-01-01", f"{HEADER}\n{body}")
    small_ranges(4096)
    lines = records.raw_lines(spark, [f"{tmp_path}/t/2024-01-01"])
    ranges = records.spanning_ranges(lines)
    assert ranges.count() > 10 and lines.rdd.getNumPartitions() > 10
    assert records.spanning_records(lines, ranges).count() == 3000
    assert len(scanned(spark, str(tmp_path))) == 3000


def test_one_value_over_many_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(f"line {i}, with a comma" for i in range(500))
    put(str(tmp_path), "2024-01-01", f'{HEADER}\n1,a,b\n2,"{long}",c\n3,d,e\n')
    small_ranges(50)
    assert scanned(spark, str(tmp_path)) == [("1", "a", "b"), ("2", long, "c"), ("3", "d", "e")]


def test_stray_quotes_are_text(spark, tmp_path, small_ranges):
    put(str(tmp_path), "2024-01-01", f'{HEADER}\n1,5\' 10" tall,x\n2,"two\nlines",y\n3,a"b"c,z\n')
    for size in (9, 1 << 20):
        small_ranges(size)
        assert scanned(spark, str(tmp_path)) == [("1", "5' 10\" tall", "x"), ("2", "two\nlines", "y"), ("3", 'a"b"c', "z")]


def test_an_open_quote_reaches_to_the_end_of_its_file_only(spark, tmp_path):
    put(str(tmp_path), "2024-01-01", f'{HEADER}\n1,a,b\n2,"never closed\n3,c,d\n', "open")
    put(str(tmp_path), "2024-01-01", f"{HEADER}\n4,e,f\n", "fine")
    found = scanned(spark, str(tmp_path))
    assert [r[0] for r in found] == ["1", "2", "4"] and "3,c,d" in found[1][1]


def test_no_file_is_listed_and_none_read_whole(spark, tmp_path):
    put(str(tmp_path), "2024-01-01", f'{HEADER}\n1,"a\nb",c\n')
    plan = landing.scan_latest(spark, str(tmp_path), "t")._jdf.queryExecution().executedPlan().toString()
    assert "multiLine" not in plan and "f.csv" not in plan.replace("Location", "")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_without_spanning_records_lines_are_read_once_more_only_to_count(spark, tmp_path):
    put(str(tmp_path), "2024-01-01", f"{HEADER}\n" + "".join(f'{i},"q, ""{i}""",z\n' for i in range(50)))
    df = landing.scan_latest(spark, str(tmp_path), "t")
    assert df.filter("text = 'q, \"7\"'").count() == 1 and df.count() == 50
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Window" not in final or "from_csv" not in final


def test_a_header_that_differs_raises_in_spanning_files_too(spark, tmp_path):
    put(str(tmp_path), "2024-01-01", f'{HEADER}\n1,"a\nb",c\n', "one")
    put(str(tmp_path), "2024-01-01", 'text,id,last\n"a\nb",1,c\n', "two")
    with pytest.raises(Exception, match="(?i)header"):
        landing.scan_latest(spark, str(tmp_path), "t").collect()


def test_without_spanning_records_rows_come_from_one_scan(spark, tmp_path):
    put(str(tmp_path), "2024-01-01", f"{HEADER}\n1,a\r\n2,\"b, \"\"c\"\"\",d\n")
    plan = landing.scan_latest(spark, str(tmp_path), "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


@pytest.mark.parametrize("line", ['1,"a', "1,a\rb,c", '1,"a\nb",c'])
def test_a_line_that_spans_is_seen_in_any_file(spark, tmp_path, line):
    put(str(tmp_path), "2024-01-01", f"{HEADER}\n1,a,b\n", "plain")
    assert not records.any_spanning(records.raw_lines(spark, [f"{tmp_path}/t/2024-01-01"]))
    put(str(tmp_path), "2024-01-01", f"{HEADER}\n{line}\n", "odd")
    lines = records.raw_lines(spark, [f"{tmp_path}/t/2024-01-01"])
    assert records.any_spanning(lines) and records.spanning_ranges(lines).count() == 1

"""CSV with quoted line breaks in many tasks, against the CSV source, which reads a file in one."""

import random

import pytest

from helpers import rows
from loomgraph.sources import csv_records

OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": "", "mode": "FAILFAST", "multiLine": "true"}
SCHEMA = "id long, title string, label string"


def field(x):
    return '"' + x.replace('"', '""') + '"' if any(c in x for c in '",\n\r') else x


def written(path, items, end="\n"):
    path.write_text("id,title,label" + end + "".join(f"{i},{field(t)},P{end}" for i, t in items), newline="")


def plain(spark, files):
    return rows(spark.read.options(**OPTIONS, header=True, enforceSchema=True).schema(SCHEMA).csv(files))


@pytest.fixture
def splits(spark):
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("size", [64, 777, 20_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_are_those_of_the_csv_source(spark, tmp_path, splits, size, end):
    rng = random.Random(size)
    words = ["a", 'say "hi"', "x,y", "line\nbreak", "\n\n", "two\nmore\nbreaks", "é日", " lead", '"', "long " * 40, "long\n" * 60, '""\n"']
    files = []
    for n in range(3):
        items = [(100 * n + i, "".join(rng.choices(words, k=rng.choice([1, 1, 3])))) for i in range(60 if size > 64 else 12)]
        files.append(tmp_path / f"f {n}.csv")
        written(files[-1], items, end)
    written(tmp_path / "empty.csv", [], end)
    files = [str(f) for f in files] + [str(tmp_path / "empty.csv")]
    want = plain(spark, files)
    splits(size)
    got = csv_records.table(spark, files, SCHEMA, OPTIONS, placed=True)
    assert got.rdd.getNumPartitions() >= (3 if size > 777 else 12)
    assert rows(got.drop("place")) == want
    assert [r.id for r in got.orderBy("place").collect()] == sorted(r[0] for r in want)


def test_a_break_that_no_quotes_surround_and_bad_rows(spark, tmp_path, splits):
    (tmp_path / "a.csv").write_text("id,title,label\n1,a,P\n\n2,b,P\n")
    splits(10)
    assert rows(csv_records.table(spark, [str(tmp_path / "a.csv")], SCHEMA, OPTIONS)) == [(1, "a", "P"), (2, "b", "P")]
    for bad in ("x,a,P", "1,a,P,more", "1,a"):
        (tmp_path / "b.csv").write_text(f"id,title,label\n{bad}\n")
        with pytest.raises(Exception, match="(?i)malformed"):
            csv_records.table(spark, [str(tmp_path / "b.csv")], SCHEMA, OPTIONS).collect()

"""CSV records with line breaks, against Spark's own reader of whole files."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T
from test_scale import settings

from pricewright.sources import records
from pricewright.sources.star import read_csv_table

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "b", "c")])
PIECES = ["x", "word", '""', "\n", "\r\n", ",", "é漢", " ", "\n\n", '"",""', "1"]


def value(rng: random.Random) -> str:
    kind = rng.randrange(4)
    if kind == 0:
        return rng.choice(["", "plain", "12", "with space", "é"])
    return '"' + "".join(rng.choice(PIECES) for _ in range(rng.randrange(12))) + '"'


def write(folder, seed: int, rows: int = 60, end: str = "\n") -> None:
    rng = random.Random(seed)
    lines = ["a,b,c"]
    for _ in range(rows):
        lines.append(",".join([rng.choice(["k", "key"]), value(rng), value(rng)]))
        if rng.random() < 0.1:
            lines.append("")
    text = end.join(lines) + (end if seed % 2 or end == "\r\n" else "")
    (folder / f"part{seed}.csv").write_bytes(text.encode())


def whole_files(spark, path):
    options = records.CSV_OPTIONS | {"header": "true", "mode": "FAILFAST", "multiLine": "true"}
    return spark.read.schema(SCHEMA).options(**options).csv(path)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: [(v is not None, v) for v in r])


@pytest.mark.parametrize("size", [16, 57, 200, 100_000])
def test_same_rows_as_the_reader_of_whole_files(spark, tmp_path, size):
    for seed in range(6):
        write(tmp_path, seed, end="\r\n" if seed % 3 == 0 else "\n")
    expected = rows_of(whole_files(spark, str(tmp_path)))
    with settings(spark, spark__sql__files__maxPartitionBytes=str(size)):
        got = rows_of(records.read_records(spark, str(tmp_path), SCHEMA))
    assert got == expected and len(got) == 360


def test_a_value_over_many_blocks(spark, tmp_path):
    long = "line\n" * 400 + '""quoted""\n' * 50
    (tmp_path / "a.csv").write_text(f'a,b,c\nk,"{long}",z\nk,"x",y\nlast,"{long}","{long}"\n')
    with settings(spark, spark__sql__files__maxPartitionBytes="64"):
        got = rows_of(records.read_records(spark, str(tmp_path), SCHEMA))
    assert got == rows_of(whole_files(spark, str(tmp_path))) and len(got) == 3


def test_tasks_grow_with_the_file(spark, tmp_path):
    write(tmp_path, 1, rows=4000)
    path = str(tmp_path / "part1.csv")
    with settings(spark, spark__sql__files__maxPartitionBytes="4096"):
        parts = records.lines(spark, path).rdd.getNumPartitions()
        got = records.read_records(spark, path, SCHEMA)
        assert got.count() == 4000
        plan = got._jdf.queryExecution().executedPlan().toString()
    assert parts > 10
    assert whole_files(spark, path).rdd.getNumPartitions() == 1
    # Lines are never shuffled: only parities, and the fragments of records that cross a border.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_quotes_that_do_not_pair_up_name_the_file(spark, tmp_path):
    write(tmp_path, 2)
    (tmp_path / "broken.csv").write_text('a,b,c\nk,"open,z\n')
    with pytest.raises(Exception, match="do not pair up in .*broken.csv"):
        records.read_records(spark, str(tmp_path), SCHEMA).collect()


def test_another_header_is_refused(spark, tmp_path):
    write(tmp_path, 2)
    (tmp_path / "other.csv").write_text("b,a,c\nk,x,z\n")
    with pytest.raises(Exception, match="header"):
        records.read_records(spark, str(tmp_path), SCHEMA).collect()


def test_empty_files_and_headers_alone(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("\ufeffa,b,c\r\n")
    assert records.read_records(spark, str(tmp_path), SCHEMA).collect() == []
    (tmp_path / "row.csv").write_text("a,b,c\nk,,")
    assert records.read_records(spark, str(tmp_path), SCHEMA).collect() == [("k", None, None)]


def test_reviews_that_do_not_parse(spark, tmp_path):
    header = "review_id,order_id,review_score,note,review_creation_date\n"
    path = tmp_path / "r.csv"
    path.write_text(header + 'r1,o1,4,"a\nb",2018-01-18 00:00:00\nr2,o2,many,x,2018-01-18 00:00:00\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv_table(spark, "reviews", str(path)).collect()
    kept = read_csv_table(spark, "reviews", str(path), "PERMISSIVE").collect()
    assert sorted((r.review_id, r.review_score) for r in kept) == [("r1", 4), ("r2", None)]

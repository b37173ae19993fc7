"""The reader of quoted line ends against the second engine, cut into many small blocks."""

import csv
import random

import duckdb
import pytest
from pyspark.sql import types as T

from metricloom.sources import files, quarantine, schemas
from metricloom.sources.quoted_csv import read_quoted_csv, records

NAMES = ["id", "note", "more"]
SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in NAMES])


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def write(path, rows, end="\n"):
    with open(path, "w", newline="") as f:
        csv.writer(f, lineterminator=end).writerows([NAMES, *rows])
    return str(path)


def drawn(n, seed):
    draw = random.Random(seed)
    bits = ["plain", "a,b", 'say "so"', "two\nlines", "x\n\n\ny", "\r\nin", "é𝄞", '"\n"', " end"]
    rows = [[str(i), "".join(draw.choices(bits, k=draw.randint(1, 4))), draw.choice(bits)] for i in range(n)]
    rows[n // 2][1] = "line\n" * 900 + "last"
    return rows


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_equal_the_second_engine(small_blocks, tmp_path, end):
    rows = drawn(400, 3)
    path = write(tmp_path / "a.csv", rows, end)
    df = read_quoted_csv(small_blocks, path, SCHEMA)
    assert records(small_blocks, path).sparkSession.read.text(path).rdd.getNumPartitions() > 10
    assert got(df) == sorted(map(tuple, rows))
    quote = "quote='\"', escape='\"', header=true, all_varchar=true, parallel=false"
    second = duckdb.sql(f"select * from read_csv('{path}', delim=',', {quote})").fetchall()
    assert got(df) == sorted(second)


def test_several_files_blank_lines_and_an_empty_file(small_blocks, tmp_path):
    one, two = drawn(60, 4), [["x" + r[0], *r[1:]] for r in drawn(70, 5)]
    write(tmp_path / "a.csv", one)
    path = write(tmp_path / "b.csv", two)
    with open(path, "a", newline="") as f:
        f.write('\n  \n"z","last\none",q')
    (tmp_path / "c.csv").write_text("id,note,more\n")
    df = read_quoted_csv(small_blocks, str(tmp_path), SCHEMA)
    assert got(df) == sorted(map(tuple, [*one, *two, ["z", "last\none", "q"]]))


def test_bad_headers_open_quotes_and_bad_rows(spark, tmp_path):
    for header in ("id,other,more", "id,note", "id,note,more,yet"):
        (tmp_path / "h.csv").write_text(f"{header}\n1,2,3\n")
        with pytest.raises(Exception, match="wrong header"):
            read_quoted_csv(spark, str(tmp_path / "h.csv"), SCHEMA).collect()
    (tmp_path / "q.csv").write_text('id,note,more\n1,"2,3\n')
    with pytest.raises(Exception, match="not closed"):
        read_quoted_csv(spark, str(tmp_path / "q.csv"), SCHEMA).collect()
    (tmp_path / "r.csv").write_text('id,note,more\n1,"2\n2",3\n4,"5\n5"\n')
    rows = read_quoted_csv(spark, str(tmp_path / "r.csv"), SCHEMA, keep_bad=True).collect()
    bad = {r["id"]: r[quarantine.BAD_ROW] for r in rows}
    assert bad == {"1": None, "4": '4,"5\n5"'}


def test_raw_sources_are_read_the_same_by_both_readers(spark, tmp_path):
    for name, schema in schemas.RAW.items():
        columns = schema.fieldNames()
        with open(tmp_path / f"{name}.csv", "w", newline="") as f:
            csv.writer(f).writerows([columns, *[[f"{c} {i}, x" for c in columns] for i in range(9)]])
    plain, quoted = (files.read_raw(spark, str(tmp_path), quoted_line_ends=q) for q in (False, True))
    for name in schemas.RAW:
        assert plain[name].columns == quoted[name].columns
        assert sorted(map(str, plain[name].collect())) == sorted(map(str, quoted[name].collect()))

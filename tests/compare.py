"""Row comparison between the two engines, in any order."""

import datetime
import math
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in records), key=repr)


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def assert_same(df, con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    assert dict(df.dtypes) == kinds
    expected = rows(names, result.fetchall())
    assert sorted(df.columns) == sorted(names)
    actual = rows(df.columns, [tuple(r) for r in df.collect()])
    assert len(actual) == len(expected)
    different = [(a, e) for a, e in zip(actual, expected) if a != e]
    assert not different, different[:3]

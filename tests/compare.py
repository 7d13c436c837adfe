"""Order-free comparison of a Spark frame with a DuckDB query."""

import math


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows(table, names):
    return sorted((tuple(plain(x) for x in r) for r in zip(*[table.column(c).to_pylist() for c in names])), key=repr)


def same(df, con, sql):
    got, want = df.toArrow(), con.sql(sql).to_arrow_table()
    names = sorted(got.column_names)
    assert names == sorted(want.column_names)
    assert rows(got, names) == rows(want, names)

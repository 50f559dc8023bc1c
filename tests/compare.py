"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import datetime as dt
import decimal


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if v != v else round(v, 6) + 0.0
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_norm(r[i]) for i in order] for r in rows), key=lambda r: [(x is not None, str(x)) for x in r])


def assert_same(df, con, sql):
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = rows_of(want_names, cur.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(df.columns) == sorted(want_names)
    assert len(got) == len(want), f"{len(got)} rows from Spark, {len(want)} from the oracle"
    for g, w in zip(got, want):
        assert g == w, f"\nspark  {dict(zip(sorted(df.columns), g))}\noracle {dict(zip(sorted(df.columns), w))}"
    return len(want)

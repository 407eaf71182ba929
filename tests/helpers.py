"""Compare a query with its oracle the way the driver does: columns by name, rows in any order."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    if hasattr(x, "asDict"):
        return tuple(sorted((k, norm(v)) for k, v in x.asDict().items()))
    if isinstance(x, dict):
        return tuple(sorted((k, norm(v)) for k, v in x.items()))
    if isinstance(x, list | tuple):
        return tuple(norm(v) for v in x)
    if type(x).__name__ == "Decimal":
        return round(float(x), 6)
    return x


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(norm(r[c]) for c in names) for r in df.collect()), key=repr)


def duck_rows(sql, sf=None, **tables):
    con = duckdb.connect()
    if sf:
        for t in TABLES:
            con.sql(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    for name, table in tables.items():
        con.register(name, table)
    r = con.execute(sql)
    cols = [d[0] for d in r.description]
    names = sorted(cols)
    return names, sorted((tuple(norm(dict(zip(cols, row, strict=True))[c]) for c in names) for row in r.fetchall()), key=repr)

import duckdb
import pandas as pd


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def duck(sql, **tables):
    """Rows of a query over Spark tables, with columns in its own order."""
    c = duckdb.connect()
    for name, df in tables.items():
        frame = df.toPandas()  # noqa: F841
        for col, kind in df.dtypes:
            if kind in ("bigint", "int"):
                frame[col] = frame[col].astype("Int64")
            elif kind == "string":
                frame[col] = frame[col].astype(pd.StringDtype())
        c.register(f"f_{name}", frame)
        c.sql(f"create table {name} as select * from f_{name}")
    r = c.sql(sql)
    return [d[0] for d in r.description], sorted((tuple(x) for x in r.fetchall()), key=str)


def same_as_sql(df, sql, **tables):
    names, want = duck(sql, **tables)
    assert sorted(names) == sorted(df.columns)
    assert plain(df.select(*names)) == want

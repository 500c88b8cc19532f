"""Spark rows against DuckDB rows, whatever their order."""

import glob
import os

import duckdb


def plain(v):
    if hasattr(v, "asDict"):
        v = v.asDict(True)
    if isinstance(v, float):
        return "nan" if v != v else round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return v


def database(folder):
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        files = path + "/*.parquet" if os.path.isdir(path) else path
        db.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{files}'")
    return db


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(repr(tuple(plain(r[n]) for n in names)) for r in df.collect())


def duck_rows(db, sql):
    got = db.execute(sql)
    names = [d[0] for d in got.description]
    order = sorted(range(len(names)), key=lambda k: names[k])
    return [names[k] for k in order], sorted(repr(tuple(plain(r[k]) for k in order)) for r in got.fetchall())

"""Rows of Spark and of DuckDB in one form."""

import decimal
import math


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.isoformat() if hasattr(v, "isoformat") else v


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in found), key=repr)


def assert_same(df, duck, sql):
    result = duck.execute(sql)
    assert rows(df.columns, df.collect()) == rows([d[0] for d in result.description], result.fetchall())

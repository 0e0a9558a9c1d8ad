"""Rows of the two engines in one comparable form."""

import datetime
import decimal


def _plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return None if v != v else round(float(v), 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(repr(tuple(_plain(r[k]) for k in order)) for r in rows)


def same(df, db, sql):
    result = db.execute(sql)
    names = [x[0] for x in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())

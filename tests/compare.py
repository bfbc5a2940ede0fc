"""Rows of a Spark query and of its SQL, in one comparable form."""

from __future__ import annotations

import datetime
import decimal


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


def agree(df, relation) -> None:
    names = sorted(df.columns)
    assert names == sorted(relation.columns)
    at = [relation.columns.index(n) for n in names]
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    want = sorted((tuple(plain(r[i]) for i in at) for r in relation.fetchall()), key=repr)
    assert got == want

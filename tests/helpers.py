"""Small builders for hand-made fixture rows."""

from __future__ import annotations

import datetime as dt

from shelfspark import schemas


def df(spark, table: str, rows: list[dict]):
    schema = schemas.DOMAIN[table]
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(frame, *cols, order=None):
    out = [tuple(r[c] for c in cols) for r in frame.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))

from __future__ import annotations

import json

from pyspark.sql import functions as F

from millrace.schemas import TOPIC_RECORD


FIELDS = {"id": "e-1", "dt": "2026-03-04T05:06:07Z", "domain": "en.wikipedia.org", "user": "ann", "bot": False, "title": "Start"}


def event(**given):
    """A raw event; anything that is no field of it is set at the top level as it is."""
    f = {**FIELDS, **given}
    whole = {"meta": {k: f[k] for k in ("id", "dt", "domain")}, "performer": {"user_text": f["user"], "user_is_bot": f["bot"]}}
    whole["page_title"] = f["title"]
    return {**whole, **{k: v for k, v in given.items() if k not in FIELDS}}


def topic(spark, values, name="input", partitions=2):
    """Values (text, or objects to encode) as topic records, in order."""
    import datetime as dt

    start = dt.datetime(2026, 5, 1, tzinfo=dt.timezone.utc)
    rows = [
        (
            None,
            None if v is None else (v if isinstance(v, str) else json.dumps(v)).encode("utf-8"),
            name,
            i % partitions,
            i // partitions,
            start + dt.timedelta(seconds=i),
        )
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, TOPIC_RECORD)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str) if columns else sorted(map(tuple, df.collect()), key=str)


def texts(df):
    """Rows as text, for comparisons of whole results."""
    return sorted(r[0] for r in df.select(F.to_json(F.struct(*sorted(df.columns)))).collect())

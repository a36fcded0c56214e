"""The edits table as a dictionary that takes one write after the other: what the merge must equal."""

from __future__ import annotations

import datetime as dt
import random

from millrace.schemas import EDIT_LOG, UPSERT

START = dt.datetime(2026, 5, 1, tzinfo=dt.timezone.utc)


def random_writes(n, seed=1, keys=40, domains=("a", "b", "123"), days=3):
    """Log rows as dictionaries, `seq` unique except for some deletes at the place of an upsert."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        at = START + dt.timedelta(days=rng.randrange(days), milliseconds=rng.randrange(2))
        key = (rng.choice(domains), at, f"u{rng.randrange(keys // 4)}")
        seq = (START + dt.timedelta(seconds=i // 3), i % 3, i)
        if rng.random() < 0.2:
            out.append((key, "del", seq, None, None))
        else:
            title = rng.choice([None, "t%d" % rng.randrange(9)])
            out.append((key, UPSERT, seq, title, rng.choice([None, True, False])))
            if rng.random() < 0.1:
                out.append((key, "del", seq, None, None))
    return out


def replay(writes):
    """Current rows as a sorted list. Writes are applied in order of `seq`, a delete after an upsert."""
    table = {}
    for key, op, _, title, bot in sorted(writes, key=lambda w: (w[2], w[1] == "del")):
        if op == "del":
            table.pop(key, None)
        else:
            old = table.get(key, (None, None))
            table[key] = (old[0] if title is None else title, old[1] if bot is None else bot)
    return sorted(((k[0], k[1], k[2], *cells) for k, cells in table.items()), key=str)


def log_rows(spark, writes):
    rows = [
        (key[1], key[2], title, bot, op, seq, "w", None, 0, key[0], key[1].date()) for key, op, seq, title, bot in writes
    ]
    return spark.createDataFrame(rows, EDIT_LOG)


def collected(rows):
    got = rows.select("domain", "created_at", "user_id", "page_title", "user_is_bot").collect()
    return sorted(((r[0], r[1].astimezone(dt.timezone.utc), *r[2:]) for r in got), key=str)

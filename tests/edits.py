"""Small edit tables for the tests."""

import datetime as dt
import random

SCHEMA = (
    "event_id bigint, ts timestamp, user string, is_bot boolean, is_suspicious boolean, title string, "
    "wiki_lang string, length_diff int, comment string, revision_id bigint, lat double, lon double"
)
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
T0 = dt.datetime(2026, 5, 28, 18, 10, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def edit(event_id, seconds=0, **fields):
    base = {
        "event_id": event_id, "ts": at(seconds), "user": "u", "is_bot": False, "is_suspicious": False,
        "title": "T", "wiki_lang": "en", "length_diff": 1, "comment": "c", "revision_id": event_id,
        "lat": None, "lon": None,
    }
    row = {**base, **fields}
    return tuple(row[n] for n in NAMES)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def random_edits(seed=0, count=400, span=1500):
    """A third of the edits on one page by one account, the rest spread out."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        hot = rng.random() < 0.33
        rows.append(
            edit(
                i,
                rng.uniform(0, span),
                user="hot" if hot else rng.choice([None] + [f"u{k}" for k in range(12)]),
                title="Hot page" if hot else rng.choice(["A_1", "A_2", "A 3", "B 1", "File:x y", "File:z"]),
                is_bot=rng.random() < 0.2,
                wiki_lang=rng.choice(["en", "de", None]),
                length_diff=rng.choice([None, -5, 0, 12]),
                comment=rng.choice([None, "Reverted", "typo", "undo that"]),
                lat=rng.choice([None, 1.5]),
                lon=rng.choice([None, 2.5]),
            )
        )
    return rows

"""The sweep over beginnings and ends, against counting them one by one."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from roadpulse.operators import open_incidents

SCHEMA = "state string, start_time string, end_time string"
DAY = datetime(2024, 3, 30)


def incidents(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = DAY + timedelta(minutes=rng.randint(0, 600) if i % 3 else 95, seconds=rng.choice([0, 0, 30]))
        b = a + timedelta(minutes=rng.choice([0, 1, 45, 60, 300, -5]))
        state = rng.choice(["A", "B", None]) if i % 3 else "A"
        rows.append((state, None if i % 23 == 0 else str(a), "bad" if i % 29 == 0 else str(b)))
    return rows


def usable(rows):
    out = []
    for state, s, e in rows:
        if s and e != "bad" and datetime.fromisoformat(e) >= datetime.fromisoformat(s):
            out.append((state, datetime.fromisoformat(s), datetime.fromisoformat(e)))
    return out


@pytest.mark.parametrize("partitions", [1, 3, 40])
@pytest.mark.parametrize("by", [None, "state"])
def test_open_at_every_moment(spark, partitions, by):
    rows = incidents(1, 300)
    want = {}
    for value in ["A", "B", None] if by else [0]:
        own = [r for r in usable(rows) if not by or r[0] == value]
        for m in {t for r in own for t in r[1:]}:
            want[(value, m) if by else (m,)] = sum(s <= m < e for _, s, e in own)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {tuple(r)[:-1]: r["open"] for r in open_incidents.open_at(df, by=by, partitions=partitions).collect()}
    assert got == want
    assert open_incidents.unusable(df).first()["unusable"] == len(rows) - len(usable(rows))


@pytest.mark.parametrize("partitions", [1, 7])
def test_hours(spark, partitions):
    rows = incidents(2, 60) + [("A", str(DAY + timedelta(hours=20)), str(DAY + timedelta(hours=22)))]
    own = usable(rows)
    began, minutes = defaultdict(int), defaultdict(float)
    first, last = min(s for _, s, _ in own), max(e for _, _, e in own)
    hours = []
    h = first.replace(minute=0, second=0)
    while h <= last:
        hours.append(h)
        h += timedelta(hours=1)
    moments = {t for r in own for t in r[1:]} | set(hours)
    want = {}
    for h in hours:
        end = h + timedelta(hours=1)
        began = sum(h <= s < end for _, s, _ in own)
        before = sum(s < h <= e for _, s, e in own)
        most = max(sum(s <= m < e for _, s, e in own) for m in moments if h <= m < end)
        minutes = sum(max(0.0, (min(e, end) - max(s, h)).total_seconds()) for _, s, e in own) / 60
        want[h] = (began, before, most, pytest.approx(minutes))
    got = {r["hour"]: tuple(r)[1:] for r in open_incidents.open_by_hour(spark.createDataFrame(rows, SCHEMA), partitions=partitions).collect()}
    assert got == want
    assert sum(v[:3] == (0, 0, 0) for v in got.values()) >= 1


def test_nothing_usable(spark):
    df = spark.createDataFrame([("A", None, "2024-01-01 00:00:00"), ("A", "2024-01-02 00:00:00", "2024-01-01 00:00:00")], SCHEMA)
    assert open_incidents.open_by_hour(df).collect() == []
    assert open_incidents.open_at(df, by="state").collect() == []
    assert open_incidents.unusable(df).first()["unusable"] == 2

"""Running totals that a stream's state carries from run to run, and spines made in stretches."""

from __future__ import annotations

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import distributions
from tidewater.streaming import hourly


def totals(rows):
    """(hour, cnt, cancelled, cum_cnt, cum_cancelled) by a plain loop."""
    hours = {}
    for at, status in rows:
        one = hours.setdefault(at.replace(minute=0, second=0), [0, 0])
        one[status == "Cancelled"] += 1
    out, cum, cancelled = [], 0, 0
    for hour in sorted(hours):
        cum, cancelled = cum + hours[hour][0], cancelled + hours[hour][1]
        out.append((hour, *hours[hour], cum, cancelled))
    return out


def test_totals_survive_runs(spark, tmp_path):
    """Four deliveries, each with events of the two hours before; totals equal those of one batch over everything."""
    rng, start, given = random.Random(4), datetime.datetime(2024, 1, 1), []
    (tmp_path / "events").mkdir()
    for delivery in range(4):
        first = delivery * 30
        rows = [(start + datetime.timedelta(hours=first + rng.randrange(30), minutes=rng.randrange(60)), rng.choice(["ok", "Cancelled"])) for _ in range(200)]
        if delivery:
            rows += [(start + datetime.timedelta(hours=first - 1, minutes=rng.randrange(60)), "ok") for _ in range(5)]
        rows.append((start + datetime.timedelta(hours=first + 29, minutes=30), "ok"))
        given += rows
        lines = "".join(json.dumps({"ts": at.isoformat(" "), "status": status}) + "\n" for at, status in rows)
        (tmp_path / "events" / f"{delivery}.json").write_text(lines)
        stream = spark.readStream.schema("ts timestamp_ntz, status string").json(str(tmp_path / "events"))
        hourly.run_to_folder(hourly.hourly_counts(stream, "ts", F.col("status") == "Cancelled"), str(tmp_path / "hours"), str(tmp_path / "cp"))
        got = hourly.running_totals_to_folder(spark, str(tmp_path / "hours"), str(tmp_path / "totals"), str(tmp_path / "state"))
        assert sorted(tuple(r)[:1] + tuple(r)[2:] for r in got.collect()) == totals(given)
    written = spark.read.parquet(str(tmp_path / "totals")).groupBy("batch").count()
    assert max(r["count"] for r in written.collect()) <= 33  # new hours and the open ones, never all 120
    state = spark.read.format("statestore").load(str(tmp_path / "state")).select("value.*").collect()
    assert len(state) == 1  # one series


def test_state_holds_open_hours_only():
    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    import pandas as pd

    state = State()
    for batch in range(3):
        at = [h * 3600 for h in range(batch * 1000, batch * 1000 + 1000)]
        out = list(hourly._carry((0,), iter([pd.DataFrame({"at": at, "cnt": 1, "cancelled_cnt": 2, "batch": batch})]), state, 3600))
        assert len(json.loads(state.get[3])) <= 2 and len(out[0]) <= 1002
    assert out[0].iloc[-1].tolist() == [2999 * 3600, 1, 2, 3000, 6000]
    again = list(hourly._carry((0,), iter([pd.DataFrame({"at": [0, 2999 * 3600], "cnt": [9, 5], "cancelled_cnt": [9, 2], "batch": [3, 3]})]), state, 3600))
    assert again[0].values.tolist() == [[2999 * 3600, 5, 2, 3004, 6000]]  # hour 0 is closed


@pytest.mark.parametrize("last", [0, 5, 65_535, 65_536, 200_000])
def test_spine_has_every_bin_once(spark, last):
    one = spark.createDataFrame([(last,)], "k long")
    got = distributions._spine(one, F.col("k")).agg(F.count("*"), F.min("bin"), F.max("bin"), F.count_distinct("bin")).head()
    assert tuple(got) == (last + 1, 0, last, last + 1)

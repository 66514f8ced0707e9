"""Leases with timers: renewal, late finish, order, restart."""

import datetime as dt

import pytest

from mapledger.session import fresh_folder
from mapledger.streaming import leases

KIND = "attempt_id string, kind string, at timestamp, dataset_id string, run_id string"
T0 = dt.datetime(2024, 1, 1)


def event(attempt, kind, minutes):
    return (attempt, kind, T0 + dt.timedelta(minutes=minutes), f"d-{attempt}", "r")


class Stream:
    def __init__(self, spark, lease=3600, delay="0 seconds"):
        self.spark, self.folder, self.lease, self.delay = spark, fresh_folder(spark, "leases"), lease, delay

    def feed(self, *events):
        """One file, one run of the stream from its checkpoint."""
        frame = self.spark.createDataFrame(list(events), KIND)
        frame.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        source = self.spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/in")
        with leases.state_with_timers(self.spark):
            leases.abandoned(source, self.lease, self.delay).writeStream.format("parquet").option("path", f"{self.folder}/out").option(
                "checkpointLocation", f"{self.folder}/check").outputMode("append").trigger(availableNow=True).start().awaitTermination()
        rows = self.spark.read.schema(leases.ABANDONED).parquet(f"{self.folder}/out").collect()
        return {r.attempt_id: (r.expired_at - T0).total_seconds() / 60 for r in rows}


def test_renewals_and_late_finishes_over_restarts(spark):
    stream = Stream(spark)
    assert stream.feed(event("renewed", "START", 0), event("lost", "START", 0), event("done", "START", 0), event("broken", "START", 0),
                       event("done", "FINISH", 59)) == {}
    # The watermark stands at minute 59: beats that come now keep a lease, the others run out.
    assert stream.feed(event("renewed", "HEARTBEAT", 60), event("broken", "HEARTBEAT", 61), event("clock", "START", 62)) == {"lost": 60, "broken": 60}
    assert stream.feed(event("renewed", "FINISH", 119), event("lost", "FINISH", 119), event("clock", "HEARTBEAT", 119)) == {"lost": 60, "broken": 60}
    found = stream.feed(event("z", "START", 1000))
    assert found == {"lost": 60, "broken": 60, "clock": 179}


def test_order_inside_the_delay_does_not_matter(spark):
    stream = Stream(spark, delay="3 hours")
    assert stream.feed(event("a", "FINISH", 130), event("b", "HEARTBEAT", 100)) == {}
    assert stream.feed(event("a", "HEARTBEAT", 90), event("b", "START", 0)) == {}
    assert stream.feed(event("a", "HEARTBEAT", 45), event("a", "START", 0)) == {}
    # b's beat at 100 came after its lease; a's two beats carry it to its finish at 130.
    assert stream.feed(event("z", "START", 1000)) == {"b": 60}


def test_a_beat_that_fills_a_gap_counts_for_later_ones():
    assert leases.chained(60, [100, 50], 60) == (160, [])
    assert leases.chained(60, [100], 60) == (60, [100])
    assert leases.chained(60, [60], 60) == (120, [])


@pytest.mark.parametrize("bad", [(None, "START", T0, "d", "r"), ("x", "START", None, "d", "r"), ("x", "OTHER", T0, "d", "r")])
def test_rows_without_key_time_or_meaning(spark, bad):
    assert Stream(spark).feed(bad, event("z", "START", 1)) == {}


def test_attempts_of_a_lot_share_state_and_timer_but_end_on_their_own(spark, monkeypatch):
    monkeypatch.setattr(leases, "LOTS", 2, raising=False)
    stream = Stream(spark)
    started = [event(f"a{n}", "START", n) for n in range(200)] + [event(f"a{n}", "FINISH", n + 10) for n in range(0, 200, 4)]
    found = [stream.feed(*started), stream.feed(event("b", "START", 239)), stream.feed(event("z", "START", 1000))]
    left = [n for n in range(200) if n % 4]
    # The watermark stands at minutes 206, 239 and 1000 (an end has to be passed by a millisecond).
    for rows, now in zip(found, (206, 239, 1000), strict=True):
        assert rows == {f"a{n}": n + 60 for n in left if n + 60 < now} | ({"b": 299} if now == 1000 else {})


def test_state_is_reached_by_lot(spark, monkeypatch):
    monkeypatch.setattr(leases, "LOTS", 2, raising=False)
    folder = fresh_folder(spark, "leases")
    spark.createDataFrame([event(f"a{n}", "START", n) for n in range(100)], KIND).coalesce(1).write.parquet(f"{folder}/in")
    source = spark.readStream.schema(KIND).parquet(f"{folder}/in")
    with leases.state_with_timers(spark):
        query = leases.abandoned(source, 3600, "1 day").writeStream.format("noop").option("checkpointLocation", f"{folder}/check").outputMode(
            "append").trigger(availableNow=True).start()
        query.awaitTermination()
    # A value and a timer with its index for each lot, not for each of 100 attempts.
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators) <= 6

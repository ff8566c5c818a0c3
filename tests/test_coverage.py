import random

import pytest
from builders import curated, utc
from pyspark.sql import functions as F

from gaugeline.operators.coverage import gaps, merged_ranges, offset_stretches, overlaps
from gaugeline.operators.quarantine import merged_intervals, quarantined, trusted
from gaugeline.operators.reconcile import differences, unaccounted
from gaugeline.operators.windows import corrected_averages, window_averages

RANGE = "topic string, kafka_partition int, first_offset bigint, last_offset bigint"


def ranges(spark, rows):
    return spark.createDataFrame([("t", *r) for r in rows], RANGE)


def places(spark, rows):
    schema = "topic string, kafka_partition int, kafka_offset bigint, value string"
    return spark.createDataFrame([("t", *r) for r in rows], schema)


def covered(rows):
    return {(p, o) for p, a, b in rows for o in range(a, b + 1)}


def plain(frame):
    return sorted((r.kafka_partition, r.first_offset, r.last_offset) for r in frame.collect())


@pytest.mark.parametrize("block", [1, 7, 1_000_000])
def test_merged_ranges_gaps_and_overlaps(spark, block):
    rng = random.Random(block)
    rows = []
    for partition in range(3):
        for _ in range(40):
            first = rng.randrange(200)
            rows.append((partition, first, first + rng.randrange(-1, 9)))
    merged = merged_ranges(ranges(spark, rows), block=block)
    found = plain(merged)
    assert covered(found) == covered(rows)
    assert all(p != q or b + 1 < c for (p, a, b), (q, c, d) in zip(found, found[1:]))
    missing = covered(plain(gaps(merged)))
    ends = {p: (min(a for q, a, _ in found if q == p), max(b for q, _, b in found if q == p)) for p in range(3)}
    everything = {(p, o) for p, (a, b) in ends.items() for o in range(a, b + 1)}
    assert missing == everything - covered(rows) and missing
    times = {}
    for r in overlaps(ranges(spark, rows), block=block).collect():
        times |= {(r.kafka_partition, o): r.times for o in range(r.first_offset, r.last_offset + 1)}
    expected = {}
    for p, a, b in rows:
        for o in range(a, b + 1):
            expected[p, o] = expected.get((p, o), 0) + 1
    assert times == {k: n for k, n in expected.items() if n > 1}


def test_stretches_of_stored_offsets(spark):
    rng = random.Random(4)
    rows = [(p, rng.randrange(300), "x") for p in (0, 1) for _ in range(500)]
    rows += [(2, 5, "x"), (2, 5, "x"), (3, None, "x")]
    for block in (10, 1000):
        found = plain(offset_stretches(places(spark, rows), block=block))
        assert covered(found) == {(p, o) for p, o, _ in rows if o is not None}
        assert all(p != q or b + 1 < c for (p, a, b), (q, c, d) in zip(found, found[1:]))
    assert offset_stretches(places(spark, [])).count() == 0
    assert gaps(ranges(spark, [])).count() == overlaps(ranges(spark, [])).count() == 0


@pytest.mark.parametrize("bound", [0, 3, 1000])
def test_differences_are_found_step_by_step(spark, bound):
    left = [(p, o, "v") for p in (0, 1) for o in range(1000)]
    right = [r for r in left if r[1] not in (3, 500)] + [(0, 7, "v"), (1, 2000, "v")]
    right = [(p, o, "other") if o == 42 else (p, o, v) for p, o, v in right]
    how = {"steps": (100, 10, 1), "broadcast_ranges": bound}
    names = ["kafka_partition", "kafka_offset", "left_messages", "right_messages"]
    found = differences(places(spark, left), places(spark, right), **how)
    expected = [(p, o, 1, 0) for p in (0, 1) for o in (3, 500)] + [(0, 7, 1, 2), (1, 2000, 0, 1)]
    assert sorted(map(tuple, found.select(names).collect())) == sorted(expected)
    content = {"left_content": ["value"], "right_content": ["value"]}
    found = differences(places(spark, left), places(spark, right), **content, **how)
    expected += [(0, 42, 1, 1), (1, 42, 1, 1)]
    assert sorted(map(tuple, found.select(names).collect())) == sorted(expected)
    same = differences(places(spark, left), places(spark, list(reversed(left))), **how)
    assert same.count() == 0


def test_every_message_is_curated_or_rejected_once(spark):
    raw = places(spark, [(0, o, "v") for o in range(50)])
    even = F.col("kafka_offset") % 2 == 0
    assert unaccounted(raw, raw.where(even), raw.where(~even)).count() == 0
    lost = unaccounted(raw, raw.where(even & (F.col("kafka_offset") > 5)), raw.where(~even))
    assert [r.kafka_offset for r in lost.orderBy("kafka_offset").collect()] == [0, 2, 4]


# ---- intervals of time

def spans(spark, rows):
    data = [(s, *(None if t is None else utc(2024, 1, 1 + t // 24, t % 24) for t in r)) for s, *r in rows]
    return spark.createDataFrame(data, "sensor_type string, begin timestamp, end timestamp")


@pytest.mark.parametrize("bin_seconds", [1800, 7200, 86_400])
def test_readings_in_merged_intervals(spark, bin_seconds):
    rng = random.Random(bin_seconds)
    rows = []
    for sensor in ("humidity", "pressure"):
        for _ in range(15):
            begin = rng.randrange(200)
            rows.append((sensor, begin, begin + rng.choice([-1, 0, 1, 3, 60])))
    rows += [("humidity", None, 5), ("pressure", 3, None)]
    bad = {(s, h) for s, a, b in rows if None not in (a, b) for h in range(a, b)}
    intervals = spans(spark, rows)
    merged = merged_intervals(intervals, bin_seconds=bin_seconds).orderBy("sensor_type", "begin").collect()
    for one, two in zip(merged, merged[1:]):
        assert one.sensor_type != two.sensor_type or one.end < two.begin
    readings = curated(spark, [(s, 1.0, utc(2024, 1, 1 + h // 24, h % 24), False) for s in ("humidity", "pressure", "other") for h in range(300)])
    nulls = readings.limit(1).withColumn("event_time", F.lit(None).cast("timestamp"))
    everything = readings.union(nulls)
    found = quarantined(everything, intervals, bin_seconds=bin_seconds)
    assert found.columns == readings.columns
    hours = {(r.sensor_type, (r.event_time.day - 1) * 24 + r.event_time.hour) for r in found.collect()}
    assert hours == {(s, h) for s, h in bad if h < 300} and found.count() == len(hours) > 20
    rest = trusted(everything, intervals, bin_seconds=bin_seconds)
    assert rest.count() == 901 - len(hours)
    assert quarantined(everything, intervals.where("false")).count() == 0


def test_only_windows_of_late_rows_are_made_anew(spark):
    rows = [("humidity", float(n), utc(2024, 1, 1 + n // 200, (n // 12) % 24, n % 60), n % 9 == 0) for n in range(600)]
    frame = curated(spark, rows)
    late = frame.where("kafka_offset % 50 = 7")
    found = corrected_averages(frame, late)
    keys = lambda f: {(r.sensor_type, r.window_start): r.asDict() for r in f.collect()}
    full, got, hit = keys(window_averages(frame)), keys(found), keys(window_averages(late))
    assert set(got) == set(hit) and len(got) < len(full) / 3
    assert all(full[k] == v for k, v in got.items())
    plain = frame.drop("year", "month", "day")
    assert keys(corrected_averages(plain, late)) == got
    assert corrected_averages(frame, late.where("false")).count() == 0

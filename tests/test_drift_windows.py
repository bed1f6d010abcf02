"""Drift by windows: several batches, a restart from the checkpoint, and the sketches against plain counts."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from quillspark.streaming import drift_windows as D, monitor as MO

DDL = "ts timestamp, value double, kind string"
NUMERIC, CATEGORIES = {"value": 10.0}, ["kind"]
DAY = dt.datetime(2024, 3, 1)


def rows_of(day, n, shift, rng):
    kinds = ["a", "b", None] if not shift else ["a", "c", "c"]
    return [(DAY + dt.timedelta(days=day, minutes=rng.randrange(1440)), rng.choice([None, float("nan"), rng.gauss(shift, 3), rng.gauss(shift, 300)]), rng.choice(kinds)) for _ in range(n)]


def bucket(v):
    if v is None or math.isnan(v):
        return None
    x = math.floor(abs(v) * 10.0)
    cut = max(len(bin(x)) - 2 - 8, 0)
    return (-1 if v < 0 else 1) * (x >> cut << cut)


def expected(rows, ref):
    out = {}
    numbers = lambda part: [b for _, v, _ in part if (b := bucket(v)) is not None]
    for day in {r[0].date() for r in rows}:
        mine = [r for r in rows if r[0].date() == day]
        a, c = numbers(ref), numbers(mine)
        ks = max(abs(sum(x <= k for x in a) / len(a) - sum(x <= k for x in c) / len(c)) for k in {*a, *c})
        drifted = [ks > 1.3581 * math.sqrt((len(a) + len(c)) / (len(a) * len(c)))]
        js = 0.0
        for kind in {r[2] for r in [*ref, *mine]}:
            p, q = (sum(r[2] == kind for r in part) / len(part) for part in (ref, mine))
            js += sum(x * math.log(x / ((p + q) / 2)) for x in (p, q) if x > 0) / 2
        drifted.append(math.sqrt(max(js / math.log(2), 0)) > 0.1)
        out[day] = (len(mine), sum(drifted) / 2, sum(drifted), "WARNING" if sum(drifted) else "OK")
    return out


def test_batches_restart_and_windows(spark, tmp_path):
    rng = random.Random(1)
    ref = rows_of(-5, 400, 0, rng)
    days = [rows_of(i, 150, 40 if i in (2, 3) else 0, rng) for i in range(6)]
    sketch = D.reference_sketch(spark.createDataFrame(ref, DDL), NUMERIC, CATEGORIES)
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))

    def run(parts):
        for part in parts:
            spark.createDataFrame(part, DDL).coalesce(1).write.mode("append").parquet(folder)
        stream = MO.file_stream(spark, folder, spark.createDataFrame([], DDL).schema, files_per_batch=1)
        D.windowed_drift(stream, sketch, NUMERIC, CATEGORIES, out, checkpoint).awaitTermination()
        return {r["window_start"].date(): (r["n_rows"], r["drift_share"], r["n_drifted"], r["status"]) for r in spark.read.schema(D.SCHEMA).parquet(f"{out}/batch_id=*").collect()}

    # a day that is cut between batches, and one that is cut by the restart
    first = run([days[0][:70], days[0][70:], days[1], days[2][:60]])
    assert first == expected(days[0] + days[1], ref)
    second = run([days[2][60:], days[3], days[4], days[5]])
    want = expected([r for d in days[:5] for r in d], ref)
    assert second == want and {x[3] for x in want.values()} == {"OK", "WARNING"}
    assert run([]) == want


def test_sketches_merge_and_odd_values(spark):
    rng = random.Random(2)
    rows = rows_of(0, 60, 0, rng) + [(DAY, float("inf"), None), (DAY, -0.0, "a"), (DAY, -1e300, "b"), (DAY, 1e-9, "")]
    d = spark.createDataFrame(rows, DDL)
    whole, parts = (D.reference_sketch(x, NUMERIC, CATEGORIES) for x in (d, d.limit(0)))
    assert parts.count() == 0
    two = [D.reference_sketch(spark.createDataFrame(x, DDL), NUMERIC, CATEGORIES) for x in (rows[:30], rows[30:])]
    merged = two[0].union(two[1]).groupBy("column", "num", "cat").agg(F.sum("n").alias("n"))
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))
    # against an empty reference nothing can be said
    got = D.window_status(D.window_sketches(d, NUMERIC, CATEGORIES), parts, list(NUMERIC), CATEGORIES).first()
    assert got["n_rows"] == len(rows) and got["drift_share"] is None and got["status"] == "OK"

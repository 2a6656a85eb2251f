"""Detectors on hand-made signals with hand-computed frames, equality at each threshold included."""

import numpy as np
from pyspark.sql import functions as F

from tracecut.operators import detect as D

LEAST, K = 0.006, 15


def ramp(n, *parts, hold=True):
    """zeros(n), with (first, last, step, base): base + 0, step, 2*step, … and the last value held behind."""
    x = np.zeros(n)
    for a, b, s, base in parts:
        x[a : b + 1] = base + s * np.arange(b - a + 1)
        if hold:
            x[b + 1 :] = x[b]
    return x


def frames(spark, **signals):
    n = len(next(iter(signals.values())))
    rows = [(1, i, *(float(s[i]) for s in signals.values())) for i in range(n)]
    return spark.createDataFrame(rows, "ep long, f long, " + ", ".join(f"{k} double" for k in signals))


def one(df, *columns):
    rows = df.collect()
    return tuple(rows[0][c] for c in columns) if rows else None


def test_discontinuity_boundaries(spark):
    for state, action, frame in ((0.25, 0.0, None), (0.4, 0.1, None), (0.3, 0.06, 0), (0.4, 0.0, 0)):
        f = frames(spark, s=[0, state], a=[0, action])
        got = one(D.discontinuity(f, ["s"], ["a"], 0.3, 5.0), "frame")
        assert got == (None if frame is None else (frame,)), (state, action)


def test_closures(spark):
    state = [0.8, 0.8, 0.8, 0.6, 0.07, 0.07, 0.3, 0.8, 0.8, 0.5, 0, 0, 0.3, 0.8, 0.8, 0.5, 0.07, 0.07, 0.3, 0.8, 0.8, 0.5, 0]
    action = [0 if i in (4, 5, 16, 17) else v for i, v in enumerate(state)]
    got = one(D.closures(frames(spark, s=state, a=action), "s", "a", 0.12, 0.12, 0.01, 0.12, 0.02), "closures", "contacts", "releases")
    assert got == ([2, 8, 14, 20], [2, 14], [6, 18])
    partial = frames(spark, s=[0.8, 0.8, 0.6, 0.2, 0.2, 0.4, 0.8], a=[0.8, 0.8, 0.6, 0.18, 0.18, 0.4, 0.8])
    assert one(D.closures(partial, "s", "a", 0.12, 0.12, 0.01, 0.12, 0.02), "closures", "contacts") == ([1], [])


def test_release_distance(spark):
    x = ramp(40, (11, 39, 0.02, 0))
    f = frames(spark, x=x, y=np.zeros(40), z=np.zeros(40))
    assert one(D.release_distance(f, ["x", "y", "z"], F.lit(10), 0.1, 30), "cut") == (16,)
    late = np.zeros(60)
    late[41:] = 0.2
    f = frames(spark, x=late, y=np.zeros(60), z=np.zeros(60))
    assert one(D.release_distance(f, ["x", "y", "z"], F.lit(10), 0.1, 30), "cut") == (None,)


def test_early_overlap(spark):
    for first, last, lead in ((10, 60, 40), (20, 60, None)):
        found = D.motion_runs(frames(spark, a=ramp(100, (first, last, 0.02, 0))), ["a"], LEAST, K)
        stable = spark.createDataFrame([(1, 50, 0)], "ep long, stable long, search_start long")
        assert one(D.early_overlap(found, stable, 30), "lead") == (None if lead is None else (lead,))


def test_motion_start(spark):
    drift = 0.002 * np.arange(100)
    drift[30] += 0.02
    drift[50:71] += 0.02 * np.arange(21)
    drift[71:] += 0.4
    f = frames(spark, m0=drift, m1=np.zeros(100))
    assert one(D.motion_start(f, ["m0", "m1"], LEAST, K, F.lit(10)), "motion", "channel") == (50, "m0")
    x = ramp(100, (20, 28, 0.02, 0), (40, 60, 0.02, 0.16))
    f = frames(spark, m0=x, m1=np.zeros(100))
    assert one(D.motion_start(f, ["m0", "m1"], LEAST, K, F.lit(10)), "motion", "channel") == (40, "m0")


def test_arm_stop(spark):
    cases = [
        (ramp(120, (5, 25, 0.02, 0)), ramp(120, (8, 29, 0.02, 0)), 0, 40, 44),
        (ramp(100, (10, 40, 0.02, 0)), ramp(100, (10, 40, 0.02, 0)), 20, 30, 55),
        (ramp(120, (10, 30, 0.02, 0), (50, 55, 0.02, 0.4)), ramp(120, (10, 30, 0.02, 0), (50, 55, 0.02, 0.4)), 0, 80, 45),
        (ramp(120, (10, 30, 0.02, 0)), ramp(120, (10, 30, 0.02, 0), (40, 46, 0.02, 0.4)), 0, 80, 61),
        (ramp(120, (50, 70, 0.02, 0)), ramp(120, (53, 74, 0.02, 0)), 41, 120, 89),
        (ramp(80, (50, 79, 0.02, 0)), ramp(80, (50, 79, 0.02, 0)), 41, 80, None),
    ]
    for action, state, lo, hi, stop in cases:
        got = one(D.arm_stop(frames(spark, a=action, s=state), ["a"], ["s"], LEAST, K, F.lit(lo), F.lit(hi)), "stop", "channels")
        assert got == (None if stop is None else (stop, "s")), stop


def test_onset_and_pause_edges(spark):
    f = frames(spark, x=[0, 1, 1, 0, 2, 2, 2])
    assert one(D.sustained_onset(f, ["x"], 1.0, 3), "onset") == (4,)
    assert one(D.sustained_onset(f, ["x"], 2.0, 3), "onset") == (None,)
    single = frames(spark, x=[1.0])
    assert one(D.trim_points(single, {"x": (["x"], 0.5)}), "trim", "trigger") == (0, "none")
    assert one(D.release_frame(single, "x", 0.1, 3), "release") == (0,)
    assert one(D.mutation(single, ["x"], 0.5, 0.1), "x") is None

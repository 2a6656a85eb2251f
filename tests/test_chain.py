"""The cut chain on hand-made episodes: one sound, and one for every way to fail."""

import re
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest

from tracecut.operators import cuts as C

CHANNELS = [f"{s}{k}{i}" for s in "lr" for k in "sa" for i in range(6)] + ["grip", "grip_action", "x", "y", "z"]
N = 620


def move(x, first, last, step=0.02):
    """A channel moves by `step` a frame from first to last, and stays there."""
    x = x.copy()
    x[first : last + 1] += step * np.arange(last - first + 1)
    x[last + 1 :] += step * (last - first)
    return x


def episode(n=N, jump=False, right=((10, 60), (200, 230), (520, 545)), left=((215, 300),), contacts=2, away=True, lag=3, settle=True):
    """The right arm moves, grips twice, goes away from the place of release and returns; the left arm moves, and the right one once more at the end.

    States follow actions `lag` frames later.
    """
    own = {c: np.zeros(n) for c in CHANNELS}
    for a, b in right:
        own["ra0"], own["rs0"] = move(own["ra0"], a, b), move(own["rs0"], a + lag, b + lag)
    for a, b in left:
        own["la0"], own["ls0"] = move(own["la0"], a, b), move(own["ls0"], a + lag, b + lag)
    if not settle:
        own["ls1"][left[-1][0] :] = 0.02 * (np.arange(n - left[-1][0]) % 2)
    grip = np.full(n, 0.8)
    for k in range(contacts):
        grip[80 + 40 * k : 100 + 40 * k] = 0.05
    own["grip"], own["grip_action"] = grip, np.where(grip < 0.1, 0.0, grip)
    if away:
        own["x"] = move(own["x"], 145, 165)
    if jump:
        own["rs5"][400:] = 0.5
    return own


def found_all(spark, episodes, **config):
    """Results of several episodes, in their order."""
    parts = [pd.DataFrame({"ep": k, "f": np.arange(len(own["x"])), **{c: own[c] for c in CHANNELS}}) for k, own in enumerate(episodes)]
    frames = spark.createDataFrame(pd.concat(parts), "ep long, f long, " + ", ".join(f"{c} double" for c in CHANNELS))
    return C.find_cuts(frames, replace(C.Config(), **config)).orderBy("ep").collect()


def found(spark, own, **config):
    return found_all(spark, [own], **config)[0]


@pytest.mark.parametrize("smooth", [1, 5])
def test_sound_episode(spark, smooth):
    r = found(spark, episode(), smooth_frames=smooth)
    assert (r.status, r.reason, r.error) == ("ok", "", "")
    assert r.n_closures == 2 and (r.cut1_channel, r.left_start_channel, r.cut3_channels, r.cut4_channels, r.task_end_channels, r.task_end_error) == ("rs0", "la0", "rs0", "ls0", "rs0", "")
    if smooth == 1:
        # motion begins at state step 13, and the mutation is seen 3 steps on; the gripper opens at 140, and 0.1 m are reached 5 steps behind 145
        assert (r.cut1, r.cut2, r.left_start) == (13, 150, 215)
        # the last state steps are 232, 302 and 547: the stop counts from the next, 15 frames on
        assert (r.cut3, r.cut4, r.task_end) == (233 + 15, 303 + 15, 548 + 15)


CASES = {
    "discontinuity": (dict(jump=True), {}, "rejected", r"joint-state jump 0\.500000, max single-joint jump 0\.500000, action jump 0\.000000 \(ratio inf\) at frame 399->400"),
    "no mutation": (dict(right=()), {}, "error", "ValueError: no motor mutation found"),
    "contacts": (dict(contacts=1), {}, "error", "ValueError: right gripper: found 1 object-contact closures, need 2"),
    "release_distance": (dict(away=False), {}, "rejected", r"right arm: does not move 0\.100m away from bread within 1\.000s after release"),
    "no left motion": (dict(left=()), {}, "error", "ValueError: arm: no sustained motion found"),
    "no right stop": (dict(right=((10, 60), (500, 530))), {}, "error", "ValueError: arm: no sustained action motion found in the search window"),
    "early_left": (dict(left=((155, 300),), right=((10, 60), (152, 230))), {}, "rejected", r"left arm starts 2\.600s before right arm return stability \(frames 155->233\), exceeds 1\.000s"),
    "short tail": (dict(n=400, right=((10, 60), (200, 230))), {}, "error", "ValueError: episode is too short for cut4 tail exclusion"),
    "no left stop": (dict(settle=False), {}, "error", "ValueError: arm: state has no sustained stop after action motion"),
    "early_right": (dict(right=((10, 60), (200, 230), (253, 330), (520, 545))), {}, "rejected", r"right arm starts 1\.667s before left arm return stability \(frames 253->303\)"),
    "order": (dict(right=((180, 195), (200, 230), (520, 545))), dict(mutation_change=0.5), "error", r"ValueError: cut points are not strictly increasing: \["),
}


@pytest.fixture(scope="module")
def outcomes(spark):
    """Results by reason: the cases without thresholds of their own at once."""
    plain = [k for k, case in CASES.items() if not case[1]]
    out = dict(zip(plain, found_all(spark, [episode(**CASES[k][0]) for k in plain], smooth_frames=1), strict=True))
    return out | {k: found(spark, episode(**own), smooth_frames=1, **config) for k, (own, config, _, _) in CASES.items() if config}


@pytest.mark.parametrize("reason", CASES)
def test_every_outcome(outcomes, reason):
    _, _, status, text = CASES[reason]
    r = outcomes[reason]
    assert (r.status, r.reason) == (status, reason), r
    assert re.match(text, r.error), r.error
    assert r.cut1 is None and r.task_end is None and r.cut3_channels is None


def test_optional_task_end(spark):
    r = found(spark, episode(right=((10, 60), (200, 230))), smooth_frames=1)
    assert (r.status, r.task_end, r.task_end_channels, r.task_end_error) == ("ok", None, "", "arm: no sustained action motion found in the search window")
    r = found(spark, episode(n=560), smooth_frames=1)
    assert (r.status, r.task_end, r.task_end_error) == ("error", None, None) or r.task_end_error.startswith("arm: ")


def test_durations_are_separate(spark):
    base = found(spark, episode(), smooth_frames=1)
    assert found(spark, episode(), smooth_frames=1, delay_seconds=1.0).cut3 == base.cut3 + 15
    assert found(spark, episode(), smooth_frames=1, start_seconds=3.0).reason == "no left motion"
    assert found(spark, episode(), smooth_frames=1, motion_seconds=2.9).reason == "no right stop"
    # at one frame a second every duration is one frame at least, and nothing breaks
    assert found(spark, episode(), smooth_frames=1, fps=1.0, tail_seconds=5.0).status in ("ok", "rejected", "error")


def test_empty_and_single_frames(spark):
    short = {c: np.zeros(1) for c in CHANNELS}
    assert found(spark, short).reason == "no mutation"
    frames = spark.createDataFrame([], "ep long, f long, " + ", ".join(f"{c} double" for c in CHANNELS))
    assert C.find_cuts(frames, C.Config()).count() == 0
    assert [(r.status, r.n) for r in C.status_counts(C.find_cuts(frames, C.Config())).collect()] == [("ok", 0), ("rejected", 0), ("error", 0)]

"""Small datasets on disk through all workflows, down to the files that they write."""

import csv
import json
import os
import shutil
import stat

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tests.test_chain import CHANNELS, episode
from tracecut import cli
from tracecut.plans import workflows as W

NAMES = [f"j{i}_{s}" for s in ("left", "right") for i in range(6)]
CAMERAS = ["observation.images.top", "observation.images.left"]


def dataset(root, episodes=None, lengths=(60, 80), fps=30, still=20, cameras=False):
    """A dataset of episodes by channel, or of ones whose left joint 3 moves behind `still` frames."""
    (root / "meta").mkdir(parents=True)
    (root / "data/chunk-000").mkdir(parents=True)
    at, sizes = 0, []
    for ep, own in enumerate(episodes or [None] * len(lengths)):
        n = lengths[ep] if own is None else len(next(iter(own.values())))
        own = {c: np.zeros(n) for c in CHANNELS} | (own or {})
        if not episodes:
            own["ls3"] = np.where(np.arange(n) >= still, 0.1, 0.0)
        joint = np.stack([own[f"{s}s{i}"] for s in "lr" for i in range(6)], 1)
        action = np.zeros((n, 14))
        action[:, :6], action[:, 7:13] = np.stack([own[f"la{i}"] for i in range(6)], 1), np.stack([own[f"ra{i}"] for i in range(6)], 1)
        action[:, 13] = own["grip_action"]
        end = np.zeros((n, 12))
        end[:, 6:9] = np.stack([own[c] for c in "xyz"], 1)
        f32 = lambda x: list(x.astype(np.float32))
        columns = {
            "timestamp": pa.array(np.arange(n, dtype=np.float32) / fps), "frame_index": np.arange(n), "episode_index": np.full(n, ep), "index": np.arange(at, at + n), "task_index": np.zeros(n, int),
            "observation.state.joint": f32(joint), "observation.gripper_position": f32(np.stack([np.zeros(n), own["grip"]], 1)), "observation.state.end": f32(end), "actions": f32(action),
        }
        pq.write_table(pa.table(columns), root / f"data/chunk-000/episode_{ep:06d}.parquet")
        at += n
        sizes.append(n)
    features = {
        "observation.state.joint": {"dtype": "float32", "names": NAMES}, "observation.gripper_position": {"dtype": "float32", "names": ["left_gripper_percent", "right_gripper_percent"]},
        "actions": {"dtype": "float32"}, "timestamp": {"dtype": "float32"}, "frame_index": {"dtype": "int64"}, "note": {"dtype": "string"},
    }
    stats = {}
    if cameras:
        features |= {c: {"dtype": "video", "info": {"video.codec": "av1"}} for c in CAMERAS}
        stats = {c: {"min": [[[0.5]]], "count": [7]} for c in CAMERAS}
        for c in CAMERAS:
            (root / f"videos/chunk-000/{c}").mkdir(parents=True)
            for ep, n in enumerate(sizes):
                (root / f"videos/chunk-000/{c}/episode_{ep:06d}.mp4").write_text(f"{n}\n")
    put = lambda name, rows: (root / f"meta/{name}.jsonl").write_text("\n\n".join(json.dumps(r) for r in rows))
    (root / "meta/info.json").write_text(json.dumps({"fps": fps, "chunks_size": 1000, "features": features, "total_episodes": len(sizes), "total_frames": at}))
    put("episodes", [{"episode_index": i, "tasks": [f"t{i}"], "length": n} for i, n in enumerate(sizes)])
    put("episodes_stats", [{"episode_index": i, "stats": stats | {"actions": {"min": [0.0]}}} for i in range(len(sizes))])
    put("tasks", [{"task_index": 0, "task": "t"}])


def lines(path):
    return [json.loads(x) for x in path.read_text().splitlines() if x.strip()]


def table(path):
    with open(path, newline="") as f:
        return list(csv.DictReader(f))


def sound(spark, path):
    return not any(W.validate(spark, str(path)).values())


@pytest.fixture
def fake_ffmpeg(tmp_path, monkeypatch):
    """Videos are text files with their number of frames: ffprobe prints it, ffmpeg writes what -frames:v asks for."""
    bin_ = tmp_path / "bin"
    bin_.mkdir()
    scripts = {"ffprobe": 'for a in "$@"; do last="$a"; done; head -1 "$last"', "ffmpeg": 'n=0; prev=""; for a in "$@"; do [ "$prev" = "-frames:v" ] && n="$a"; prev="$a"; last="$a"; done; echo "$n" > "$last"'}
    for name, body in scripts.items():
        (bin_ / name).write_text(f"#!/bin/sh\n{body}\n")
        (bin_ / name).chmod((bin_ / name).stat().st_mode | stat.S_IEXEC)
        monkeypatch.setenv(f"TRACECUT_{name.upper()}", str(bin_ / name))
    return bin_


def test_trim_writes_a_whole_dataset(spark, tmp_path):
    source = tmp_path / "source"
    dataset(source, cameras=True)
    assert sound(spark, source)
    out = W.trim(spark, str(source), str(tmp_path / "out"), report=str(tmp_path / "points.csv"))
    assert out == {"episodes": 2, "source_frames": 140, "removed_frames": 34, "removed_seconds": 34 / 30, "output_frames": 106, "median_trim_frames": 17.0, "output": str(tmp_path / "out")}
    assert sound(spark, tmp_path / "out")
    t = pq.read_table(tmp_path / "out/data/chunk-000/episode_000001.parquet")
    assert t.num_rows == 63 and t["index"].to_pylist() == list(range(43, 106)) and t.schema.field("timestamp").type == pa.float32() and t.column_names == pq.read_table(source / "data/chunk-000/episode_000001.parquet").column_names
    info = json.loads((tmp_path / "out/meta/info.json").read_text())
    assert (info["total_frames"], info["total_videos"], info["splits"]) == (106, 0, {"train": "0:2"}) and not set(CAMERAS) & set(info["features"])
    stats = lines(tmp_path / "out/meta/episodes_stats.jsonl")[1]["stats"]
    assert stats["observation.state.joint"]["count"] == [63] and len(stats["observation.state.joint"]["mean"]) == 12 and stats["frame_index"] == {"min": [0], "max": [62], "mean": [31.0], "std": [pytest.approx(np.std(np.arange(63)))], "count": [63]}
    assert stats["observation.state.joint"]["max"][3] == pytest.approx(0.1) and "note" not in stats
    assert lines(tmp_path / "out/meta/source_mapping.jsonl")[0] == {"episode_index": 0, "source_episode_index": 0, "source_start_frame": 17, "source_end_frame": 60, "source_length": 60, "length": 43, "trigger": "observation_joint", "cut_source": "auto"}
    assert lines(tmp_path / "out/meta/episodes.jsonl") == [{"episode_index": 0, "tasks": ["t0"], "length": 43}, {"episode_index": 1, "tasks": ["t1"], "length": 63}]
    assert lines(tmp_path / "out/meta/tasks.jsonl") == [{"task_index": 0, "task": "t"}]
    report = table(tmp_path / "out/meta/trim_points.csv")
    assert report == table(tmp_path / "points.csv") and report[0]["cut_source"] == "auto" and report[0]["motion_frame"] == "20"
    with pytest.raises(FileExistsError):
        W.trim(spark, str(source), str(tmp_path / "out"))
    with pytest.raises(ValueError, match="lies in its source"):
        W.trim(spark, str(source), str(source / "out"))


def test_trim_by_an_edited_report(spark, tmp_path):
    source, cuts = tmp_path / "source", tmp_path / "cuts.csv"
    dataset(source)
    head = "episode_index,trim_frame\n"
    for body, problem in (("0,1\n", "missing"), ("0,1\n1,80\n", "out of range"), ("0,1\n0,2\n1,3\n", "duplicate")):
        cuts.write_text(head + body)
        with pytest.raises(ValueError, match=problem):
            W.trim(spark, str(source), str(tmp_path / "out"), overrides=W.overrides_of(spark, str(cuts)))
    cuts.write_text(head + "0,1\n1,5\n9,9\n")
    assert cli.main(["trim", "--source", str(source), "--output", str(tmp_path / "out"), "--cuts", str(cuts)]) == 0
    assert [(m["source_start_frame"], m["cut_source"]) for m in lines(tmp_path / "out/meta/source_mapping.jsonl")] == [(1, "csv"), (5, "csv")]
    assert {r["cut_source"] for r in table(tmp_path / "out/meta/trim_points.csv")} == {"csv"}


def test_filter_keeps_provenance(spark, tmp_path):
    """The episode with a pause goes; the others keep their tasks, their earlier mapping and their videos."""
    n = 90
    lift = {"z": np.concatenate([np.linspace(0, 0.5, 10), np.full(60, 0.5), np.linspace(0.5, 0.9, 20)]), "grip": np.where(np.arange(n) >= 80, 0.5, 0.0)}
    moving = {"z": np.linspace(1.0, 0.0, n), "grip": lift["grip"]}
    still = {"z": np.concatenate([[0.9], np.linspace(0.5, 0.4, 20), np.full(n - 41, 0.4), np.linspace(0.4, 0, 20)]), "grip": lift["grip"]}
    source = tmp_path / "source"
    dataset(source, [moving, still, moving], cameras=True)
    (source / "meta/source_mapping.jsonl").write_text("\n".join(json.dumps({"episode_index": i, "source_episode_index": 10 + i, "trigger": "x"}) for i in range(3)))
    out = W.filter_pauses(spark, str(source), str(tmp_path / "out"), report=str(tmp_path / "r.csv"), media="carry")
    assert out["removed_episodes"] == [1] and out["kept_episodes"] == 2 and sound(spark, tmp_path / "out")
    assert lines(tmp_path / "out/meta/source_mapping.jsonl") == [{"episode_index": i, "source_episode_index": 10 + old, "trigger": "x", "filtered_source_episode_index": old} for i, old in ((0, 0), (1, 2))]
    assert [e["tasks"] for e in lines(tmp_path / "out/meta/episodes.jsonl")] == [["t0"], ["t2"]]
    stats = lines(tmp_path / "out/meta/episodes_stats.jsonl")[1]["stats"]
    assert stats[CAMERAS[0]] == {"min": [[[0.5]]], "count": [7]}
    assert json.loads((tmp_path / "out/meta/info.json").read_text())["total_videos"] == 4
    assert os.stat(tmp_path / f"out/videos/chunk-000/{CAMERAS[1]}/episode_000001.mp4").st_ino == os.stat(source / f"videos/chunk-000/{CAMERAS[1]}/episode_000002.mp4").st_ino
    assert [r["episode_index"] for r in table(tmp_path / "r.csv")] == ["1"]
    os.remove(tmp_path / f"out/videos/chunk-000/{CAMERAS[1]}/episode_000001.mp4")
    assert W.validate(spark, str(tmp_path / "out"))["videos"] == 1
    with pytest.raises(ValueError, match="odd"):
        W.filter_pauses(spark, str(source), str(tmp_path / "no"), smooth=4)


def note(root, ep, starts, stops, texts=("a", "b")):
    root.mkdir(exist_ok=True)
    sub = {"subtask": list(texts), "start_time": [0.0] * len(starts), "end_time": [1.0] * len(stops), "start_frame": starts, "end_frame": stops}
    (root / f"episode_{ep:06d}.json").write_text(json.dumps({"index": ep, "name": "x", "sub_task": sub}))


def test_convert_and_cut_videos(spark, tmp_path, fake_ffmpeg):
    source, spec, notes = tmp_path / "source", tmp_path / "spec.json", tmp_path / "notes"
    dataset(source, cameras=True)
    spec.write_text(json.dumps({"task_id": "t", "global_task": "g", "sub_tasks": [{"id": "1", "description": "a"}, {"id": "2", "description": "b"}]}))
    for ep, starts, stops, texts, problem in ((0, [5, 31], [30, 60], "ab", "gap"), (0, [5, 30], [30, 61], "ab", "range"), (0, [5, 30], [30, 60], "ac", "text"), (0, [5], [30], "a", "expected 2"), (7, [5, 30], [30, 60], "ab", "no episode"), (0, [], [], "", "expected 2")):
        note(notes, ep, starts, stops, texts)
        with pytest.raises(ValueError, match=problem):
            W.convert(spark, str(source), str(tmp_path / "out"), str(spec), str(notes))
        shutil.rmtree(notes)
    note(notes, 0, [5, 30], [30, 60])
    note(notes, 1, [0, 10], [10, 70])
    plan = W.convert(spark, str(source), str(tmp_path / "out"), str(spec), str(notes), media="cut").orderBy("new_ep").collect()
    assert [(r.new_ep, r.base, r.length) for r in plan] == [(0, 0, 25), (1, 25, 30), (2, 55, 10), (3, 65, 60)]
    assert sound(spark, tmp_path / "out") and W.validate(spark, str(tmp_path / "out"), decode_samples=3)["samples"] == 0
    info = json.loads((tmp_path / "out/meta/info.json").read_text())
    assert (info["total_tasks"], info["total_videos"]) == (2, 8) and info["features"][CAMERAS[0]]["info"] == {"video.codec": "h264", "video.pix_fmt": "yuv420p", "video.fps": 30}
    assert lines(tmp_path / "out/meta/episodes_stats.jsonl")[3]["stats"][CAMERAS[0]]["count"] == [60]
    assert (tmp_path / f"out/videos/chunk-000/{CAMERAS[0]}/episode_000003.mp4").read_text() == "60\n"
    assert lines(tmp_path / "out/meta/tasks.jsonl") == [{"task_index": 0, "task": "a"}, {"task_index": 1, "task": "b"}]
    # a stopped run goes on with the videos that are whole
    building = tmp_path / ".again.building"
    shutil.copytree(tmp_path / "out/videos", building / "videos")
    (building / f"videos/chunk-000/{CAMERAS[0]}/episode_000003.mp4").write_text("1\n")
    with pytest.raises(FileExistsError):
        W.convert(spark, str(source), str(tmp_path / "again"), str(spec), str(notes), media="cut")
    W.convert(spark, str(source), str(tmp_path / "again"), str(spec), str(notes), media="cut", resume=True)
    assert (tmp_path / f"again/videos/chunk-000/{CAMERAS[0]}/episode_000003.mp4").read_text() == "60\n" and sound(spark, tmp_path / "again")
    # task faults are found
    meta = tmp_path / "again/meta/tasks.jsonl"
    meta.write_text(meta.read_text().replace('"a"', '"z"'))
    assert W.validate(spark, str(tmp_path / "again"))["task_text"] == 2


def test_clean(spark, tmp_path, fake_ffmpeg):
    dataset(tmp_path / "source", cameras=True)
    out = W.clean(spark, str(tmp_path / "source"), str(tmp_path / "out"), media="cut")
    assert out["trim"]["removed_frames"] == 34 and not (tmp_path / "out.trimmed").exists() and sound(spark, tmp_path / "out")
    assert set(lines(tmp_path / "out/meta/source_mapping.jsonl")[0]) >= {"source_start_frame", "trigger", "filtered_source_episode_index"}
    assert (tmp_path / f"out/videos/chunk-000/{CAMERAS[0]}/episode_000001.mp4").read_text() == "63\n"


def test_ids_must_be_dense(spark, tmp_path):
    dataset(tmp_path / "source")
    os.rename(tmp_path / "source/data/chunk-000/episode_000001.parquet", tmp_path / "source/data/chunk-000/episode_000004.parquet")
    with pytest.raises(ValueError, match="episode ids"):
        W.trim(spark, str(tmp_path / "source"), str(tmp_path / "out"))
    faults = W.validate(spark, str(tmp_path / "source"))
    assert faults["lengths"] == 2 and faults["episode_index"] == 80


def test_split_and_sync(spark, tmp_path):
    """The report, the summary, annotations and segments of a sound and a rejected episode; then hand-edited times."""
    source, out = tmp_path / "source", tmp_path / "out"
    dataset(source, [episode(), episode(jump=True)])
    assert cli.main(["pipeline", "--dataset", str(source), "--output", str(out)]) == 0
    rows = table(out / "cut_points.csv")
    assert list(rows[0]) == W.W.CUT_FIELDS and [r["status"] for r in rows] == ["ok", "rejected"]
    assert rows[0]["cut1_motor"] == "j0_right" and rows[0]["cut3_left_start_motor"] == "j0_left" and rows[0]["task_end_status"] == "ok" and "joint-state jump" in rows[1]["error"] and rows[1]["cut1_frame"] == ""
    summary = json.loads((out / "split_summary.json").read_text())
    frames = summary["episodes"][0]["cut_frames"]
    assert frames == [int(rows[0][f"cut{i}_frame"]) for i in range(1, 5)] and frames == sorted(set(frames)) and summary["rejected"][0]["episode_index"] == 1 and summary["config"]["smooth_frames"] == 5
    assert summary["episodes"][0]["source"].endswith("data/chunk-000/episode_000000.parquet")
    n = pq.read_table(source / "data/chunk-000/episode_000000.parquet").num_rows
    sizes = lambda: [pq.read_table(out / f"parquet/episode_000000/segment_{i:02d}.parquet").num_rows for i in range(1, 6)]
    assert sizes() == np.diff([0, *frames, n]).tolist() and not (out / "parquet/episode_000001").exists()
    doc = json.loads((out / "split/episode_000000.json").read_text())
    assert doc["sub_task"]["start_frame"] == frames and doc["sub_task"]["end_frame"] == [*frames[1:], n] and doc["task_end"]["status"] == "ok" and doc["sub_task"]["subtask"] == W.SUBTASKS
    with pytest.raises(FileExistsError):
        W.split(spark, str(source), str(out))
    # edited by hand: only then does anything change
    summary["episodes"][0]["cut_times"][1] += 4.2 / 30
    (out / "split_summary.json").write_text(json.dumps(summary))
    assert [r.changed for r in W.sync(spark, str(source), str(out), dry_run=True).collect()] == [True] and sizes() == np.diff([0, *frames, n]).tolist()
    assert cli.main(["pipeline", "--dataset", str(source), "--output", str(out), "--reuse-summary"]) == 0
    frames[1] += 4
    assert sizes() == np.diff([0, *frames, n]).tolist() and json.loads((out / "split_summary.json").read_text())["episodes"][0]["cut_frames"] == frames
    row = table(out / "cut_points.csv")[0]
    assert int(row["cut2_frame"]) == frames[1] and float(row["cut2_time"]) == summary["episodes"][0]["cut_times"][1]
    backups = [sorted(os.listdir(p)) for p in (out / "manual_sync_backups").iterdir()]
    assert ["cut_points.csv", "episode_000000.json", "split_summary.json"] in [[f for f in b if not f.endswith(".crc")] for b in backups]
    assert [r.changed for r in W.sync(spark, str(source), str(out), dry_run=True).collect()] == [False]
    # a time in the report alone counts too
    text = (out / "cut_points.csv").read_text().replace(row["cut1_time"], str(float(row["cut1_time"]) + 0.001), 1)
    (out / "cut_points.csv").write_text(text)
    assert [r.changed for r in W.sync(spark, str(source), str(out), dry_run=True).collect()] == [True]
    summary["episodes"][0]["cut_times"][1] = summary["episodes"][0]["cut_times"][2]
    (out / "split_summary.json").write_text(json.dumps(summary))
    with pytest.raises(ValueError, match="do not increase"):
        W.sync(spark, str(source), str(out))


@pytest.mark.parametrize("argv", [["trim", "--source", "x"], ["trim", "--source", "x", "--detect-only"], ["filter", "--source", "x", "--detect-only", "--report", "r", "--output", "o"], ["split", "--source", "x"], ["convert", "--source", "x", "--output", "o"], ["split", "--source", "x", "--output", "o", "--max-episodes", "0"], ["no"]])
def test_arguments(argv):
    with pytest.raises(SystemExit):
        cli.check(cli.parser(), cli.parser().parse_args(argv))


def test_command_line(spark, tmp_path, capsys):
    dataset(tmp_path / "source")
    assert cli.main(["validate", "--source", str(tmp_path / "source")]) == 0
    assert cli.main(["trim", "--source", str(tmp_path / "source"), "--detect-only", "--report", str(tmp_path / "r.csv")]) == 0
    assert json.loads(capsys.readouterr().out.split("}\n")[1] + "}")["removed_frames"] == 34 and len(table(tmp_path / "r.csv")) == 2
    assert cli.main(["split", "--source", str(tmp_path / "nothing"), "--output", str(tmp_path / "o")]) == 2
    assert cli.main(["split", "--source", str(tmp_path / "source"), "--output", str(tmp_path / "o")]) == 1
    assert [r["status"] for r in table(tmp_path / "o/cut_points.csv")] == ["error", "error"]

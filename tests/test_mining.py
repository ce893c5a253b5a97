"""The whole run on synthetic frames: index, main, teacher, segments, publication."""

import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from framesieve import cli, config
from framesieve.operators import records
from framesieve.plans import mining
from framesieve.sources import frames, sinks


def square(value, lo=16, hi=48, size=64):
    image = np.zeros((size, size, 3), np.uint8)
    image[lo:hi, lo:hi] = value
    return image


def ramp(root, values=(0, 64, 128, 192, 255), **kw):
    for i, v in enumerate(values, 1):
        sinks.write_png(f"{root}/01{i:05d}.png", square(v, **kw))


def settings(root, run, **more):
    mock = {"factory": "mock", "input_height": 64, "input_width": 64, "factory_kwargs": {"output_scale": 2, "endpoint_copy_box": [0.25, 0.25, 0.75, 0.75]}}
    thresholds = {"wrong_reject_below": 0.10, "wrong_accept_at": 0.20, "solvable_reject_below": 0.20, "solvable_accept_at": 0.50, "missing_metrics_to_review": False}
    return config.parse({"data": {"root": str(root), "frame_regex": None, "frame_digits": 5}, "model": mock, "thresholds": thresholds, "runtime": {"run_dir": str(run)}} | more)


def test_ramp_video_end_to_end(spark, tmp_path):
    ramp(tmp_path / "in")
    cfg = settings(tmp_path / "in", tmp_path / "run")
    out = cli.run(spark, cfg)
    assert out["index"]["triplets"] == 3 and out["main"]["accept"] == 3
    assert out["final"]["segments"] == 1 and out["final"]["frames"] == 5 and out["final"]["selected"] == 3
    lines = [json.loads(x) for x in (tmp_path / "in" / cfg.output.manifest_name).read_text().splitlines()]
    assert len(lines) == 3 and all("endpoint_copy" in x["reasons"] and x["covered_by_segment"] for x in lines)
    assert len(list((tmp_path / "in" / cfg.output.hard_case_dir).rglob("*.png"))) == 5
    images = list((tmp_path / "in" / cfg.output.visualization_dir).glob("*.png"))
    assert out["final"]["images"] == len(images) == 3 and len(out["final"]["execution_id"]) == 24
    assert cli.index(spark, cfg)["triplets"] == 3  # the published copies are not scanned


def test_a_killed_run_does_only_the_missing_waves(spark, tmp_path, monkeypatch):
    ramp(tmp_path / "in" / "a", (0, 64, 128, 192, 255))
    ramp(tmp_path / "in" / "b", (0, 128, 255, 64))
    cfg = settings(tmp_path / "in", tmp_path / "run", runtime={"run_dir": str(tmp_path / "run"), "chunk_triplets": 2})
    whole = {tuple(r["frame_indices"]): r["p_wrong"] for r in mining.mine(spark, mining.build_index(spark, cfg), cfg).collect()}
    monkeypatch.setattr(cli, "_wave", lambda spark: 1)
    done, real = [], mining.mine

    def dying(spark, part, config):
        if len(done) == 2:
            raise RuntimeError("killed")
        done.append(sorted((r["video_id"], r["frame_indices"][0]) for r in part.collect()))
        return real(spark, part, config)

    monkeypatch.setattr(mining, "mine", dying)
    with pytest.raises(RuntimeError, match="killed"):
        cli.mine(spark, cfg)
    first = list(done)
    done.clear()
    monkeypatch.setattr(mining, "mine", lambda *a: (done.append(sorted((r["video_id"], r["frame_indices"][0]) for r in a[1].collect())), real(*a))[1])
    assert sum(cli.mine(spark, cfg).values()) == 5
    assert sorted(x for part in first + done for x in part) == [("a::01", 1), ("a::01", 2), ("a::01", 3), ("b::01", 1), ("b::01", 2)]  # each once
    rows = spark.read.parquet(cli._path(cfg, "main")).collect()
    assert {tuple(r["frame_indices"]): r["p_wrong"] for r in rows if r["video_id"] == "b::01"}.items() <= whole.items() and len({r["execution_id"] for r in rows}) == 1
    done.clear()
    cli.mine(spark, cfg)
    assert done == []


class Stacked:
    """A model that takes stacks of images and counts them."""

    batched = True
    sizes: list = []

    def __call__(self, a, b):
        n = len(a)
        flow = np.zeros((n, 32, 32, 2), np.float32)
        return {"flow_t0": flow, "flow_t1": flow, "mask0": np.full((n, 32, 32), 0.5, np.float32), "mask1": np.zeros((n, 32, 32), np.float32)}


def stacked(checkpoint=None):
    return Stacked()


def test_models_take_batches():
    model = config.Model("tests.test_mining:stacked", input_height=64, input_width=64, batch_size=2)
    pairs = [(np.full((64, 64, 3), i / 9, np.float32), np.full((64, 64, 3), i / 3, np.float32)) for i in range(5)]
    many, one = mining.predictor(model)(pairs), [mining.predictor(config.Model("mock", input_height=64, input_width=64, factory_kwargs={"output_scale": 2}))([p])[0] for p in pairs]
    assert all(np.allclose(a["prediction"], b["prediction"]) for a, b in zip(many, one, strict=True)) and len(many) == 5


def test_changed_frames_stop_a_run(spark, tmp_path):
    ramp(tmp_path / "in", (0, 9, 99))
    cfg = settings(tmp_path / "in", tmp_path / "run")
    cli.index(spark, cfg)
    sinks.write_png(tmp_path / "in" / "0100002.png", np.ones((64, 64, 3)))
    with pytest.raises(ValueError, match="changed"):
        cli.index(spark, cfg)


def test_teacher_and_unreadable_frames(spark, tmp_path):
    ramp(tmp_path / "in" / "a", (0, 128, 255))
    ramp(tmp_path / "in" / "b", (0, 128, 255, 255))
    (tmp_path / "in" / "b" / "0100004.png").write_bytes(b"not a png")
    plain = {"factory": "mock", "input_height": 64, "input_width": 64}
    cfg = settings(tmp_path / "in", tmp_path / "run", teacher=plain)
    out = cli.teacher(spark, cfg)
    rows = {tuple(r["frame_indices"]): r for r in spark.read.parquet(cli._path(cfg, "teacher")).where("video_id = 'b::01'").collect()}
    assert out["invalid"] == 1 and rows[2, 3, 4]["reasons"] == ["invalid_decode_or_shape"]
    good = rows[1, 2, 3]
    assert good["teacher_error"] < good["p_wrong"] and good["p_solvable"] > 0.5 and good["main_decision"]["p_wrong"] == good["p_wrong"]


def test_scan_groups_prunes_and_parses(spark, tmp_path):
    names = ["a/0100001.png", "a/0100002.PNG", "a/0100003.jpg", "a/0100005.png", "a/0200001.jpeg", "b/0100001.png", "a/notes.txt", "a/12.png", "skip/0100001.png", ".hid/0100001.png", "extremely_hard_case/0100001.png"]
    for n in names:
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_bytes(b"x")
    got = frames.scan_frames(spark, str(tmp_path), digits=5, exclude=("skip",)).collect()
    assert {(r["video_id"], r["frame_index"]) for r in got} == {("a::01", 1), ("a::01", 2), ("a::01", 3), ("a::01", 5), ("a::02", 1), ("b::01", 1)}
    assert {r["relative_path"] for r in got if r["video_id"] == "a::02"} == {"a/0200001.jpeg"}


def test_scan_leaves_out_absolute_and_nested_paths(spark, tmp_path):
    for n in ("a/x/0100001.png", "a/y/0100002.png", "b/0100003.png", "c/0100004.png", "_d/0100005.png"):
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_bytes(b"x")
    left = lambda *out: {r["frame_index"] for r in frames.scan_frames(spark, str(tmp_path), digits=5, exclude=out).collect()}
    assert left() == {1, 2, 3, 4, 5} or left() == {1, 2, 3, 4}
    assert left(str(tmp_path / "b")) & {1, 2, 3, 4} == {1, 2, 4}
    assert left(f"file://{tmp_path}/a/x", "c") & {1, 2, 3, 4} == {2, 3} and left("a/y", "/elsewhere/b") & {1, 2, 3, 4} == {1, 3, 4}


def test_images_are_normalised():
    grey = np.linspace(0, 1, 10).reshape(2, 5)
    want = np.repeat(grey[..., None], 3, axis=-1).astype(np.float32)
    rgba = np.concatenate([want, np.zeros((2, 5, 1))], axis=-1)
    for image in (grey, grey[..., None], want, rgba, np.moveaxis(rgba, -1, 0), want[None]):
        assert np.allclose(mining.kernels.as_rgb(image), want)
    assert mining.kernels.as_rgb(np.full((2, 2), 255, np.uint8)).max() == 1 and mining.kernels.as_rgb(grey * 1.00005).max() == 1
    for bad in (grey + 0.1, grey * np.nan, np.zeros((2, 2, 2, 3)), np.zeros((5, 6, 7)), np.zeros((0, 3, 3))):
        with pytest.raises(ValueError):
            mining.kernels.as_rgb(bad)


def test_scan_fails_at_a_repeated_frame(spark, tmp_path):
    for n in ("0100001.png", "0100001.jpg"):
        (tmp_path / n).write_bytes(b"x")
    with pytest.raises(Exception, match="duplicate frame index 1"):
        frames.scan_frames(spark, str(tmp_path), digits=5).collect()


def test_publish_rolls_back_and_refuses_strangers(tmp_path):
    (tmp_path / "s1").mkdir()
    (tmp_path / "s1" / "new").write_text("2")
    root = tmp_path / "out"
    first = tmp_path / "s0"
    first.mkdir()
    (first / "old").write_text("1")
    sinks.publish(root, {"dir": first}, {"n": 1})
    with pytest.raises(FileNotFoundError):
        sinks.publish(root, {"dir": tmp_path / "s1", "other": tmp_path / "absent"}, {"n": 2})
    assert (root / "dir" / "old").read_text() == "1" and json.loads((root / "CURRENT.json").read_text()) == {"n": 1}
    (root / "foreign").mkdir()
    (root / "foreign" / "x").write_text("x")
    (tmp_path / "s2").mkdir()
    with pytest.raises(sinks.OutputCollision):
        sinks.publish(root, {"foreign": tmp_path / "s2"}, {"n": 3})


def test_link_or_copy(tmp_path):
    (tmp_path / "a").write_text("1")
    assert sinks.link_or_copy(tmp_path / "a", tmp_path / "d" / "b") == "hardlink"
    assert sinks.link_or_copy(tmp_path / "a", tmp_path / "d" / "b") == "existing"
    assert sinks.link_or_copy(tmp_path / "a", tmp_path / "c", "copy") == "copy"
    (tmp_path / "c").write_text("2")
    with pytest.raises(sinks.OutputCollision):
        sinks.link_or_copy(tmp_path / "a", tmp_path / "c")
    for bad in ("/x", "../x", ""):
        with pytest.raises(ValueError):
            sinks.safe_path(tmp_path, bad)


def test_images_are_rgb_and_corrupt_ones_stay(spark, tmp_path):
    image = np.zeros((2, 3, 3), np.uint8)
    image[0, 0] = (10, 20, 30)
    sinks.write_png(tmp_path / "x.png", image)
    (tmp_path / "y.png").write_bytes(b"no")
    rows = {Path(r["path"]).name: r for r in frames.read_images(spark, str(tmp_path)).collect()}
    assert (mining._rgb(type("R", (), rows["x.png"].asDict())) * 255).round()[0, 0].tolist() == [10, 20, 30]
    assert rows["y.png"]["height"] == -1 and rows["y.png"]["bgr"] is None


def test_sorted_jsonl(spark, tmp_path):
    df = spark.createDataFrame([("b", 2, None), ("a", 1, "é"), ("b", 1, "x")], "video_id string, n int, t string")
    assert sinks.jsonl_file(df, tmp_path / "m.jsonl", ["video_id", "n"]) == 3
    assert (tmp_path / "m.jsonl").read_text() == '{"n":1,"t":"é","video_id":"a"}\n{"n":1,"t":"x","video_id":"b"}\n{"n":2,"t":null,"video_id":"b"}\n'
    back = frames.read_jsonl(spark, str(tmp_path / "m.jsonl"), df.schema)
    assert back.count() == 3
    (tmp_path / "bad.jsonl").write_text('{"n":1}\n{"n":\n')
    with pytest.raises(Exception):
        frames.read_jsonl(spark, str(tmp_path / "bad.jsonl"), df.schema).collect()


def test_bundle(spark, tmp_path):
    import hashlib

    root = tmp_path / "bundle"
    root.mkdir()
    (root / "w.bin").write_bytes(b"weights")
    row = {"path": "w.bin", "name": "w", "kind": "checkpoint", "source": "s", "version": "1", "license": "x", "size": 7, "sha256": hashlib.sha256(b"weights").hexdigest()}
    (root / "resources.jsonl").write_text(json.dumps(row) + "\n")
    assert cli.verify_bundle(spark, str(root))["problems"] == {}
    assert cli.build_bundle(spark, str(root), str(tmp_path / "b.tar.gz"))["files"] == 2
    (root / "w.bin").write_bytes(b"changed")
    assert cli.verify_bundle(spark, str(root))["problems"] == {"w.bin": "hash"}


def test_resource_rules(spark):
    row = ("w.bin", "w", "k", "s", "1", "x", 7, "a" * 64)
    df = spark.createDataFrame([row, ("../x", *row[1:]), ("y", *row[1:7], "A" * 64), ("z", None, *row[2:])], frames.RESOURCE_SCHEMA)
    assert {tuple(r) for r in frames.bad_resources(df).collect()} == {("../x", "unsafe path"), ("y", "sha256"), ("z", "field missing")}
    newer = frames.upsert_resources(df.where("path = 'w.bin'"), spark.createDataFrame([(*row[:4], "2", *row[5:]), ("a", *row[1:])], frames.RESOURCE_SCHEMA))
    assert [(r["path"], r["version"]) for r in newer.collect()] == [("a", "1"), ("w.bin", "2")]
    lines = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "line int, k string")
    assert records.checked_order(lines.where("line < 3"), "line", "k").count() == 2
    with pytest.raises(Exception, match="not sorted at 3"):
        records.checked_order(lines, "line", "k")


def test_config_is_strict(tmp_path):
    base = {"data": {"root": "/x"}, "model": {"factory": "mock"}}
    assert config.parse(base).run_hash() == config.parse(json.loads(json.dumps(base))).run_hash()
    for broken, text in (
        ({"bogus": 1}, "unknown keys"), ({"data": {"root": "/x", "frame_digits": 5}}, "not both"), ({"model": {}}, "incomplete"),
        ({"thresholds": {"scene_cut_review_at": 0.9}}, "scene_cut"), ({"runtime": {"lease_seconds": 5}}, "lease"), ({"output": {"hard_case_dir": "../x"}}, "below the root"),
        ({"model": {"factory": "a b"}}, "factory"), ({"runtime": {"backend": "tpu"}}, "one of"), ({"data": []}, "object"),
        ({"data": {"root": "/x", "stride": 0}}, "data.stride"), ({"thresholds": {"wrong_accept_at": 1.5}}, "wrong_accept_at"), ({"thresholds": {"wrong_reject_below": 0.9}}, "wrong_accept_at"),
        ({"thresholds": {"max_regions": 1, "non_ui_region_reserve": 2}}, "max_regions"), ({"runtime": {"backend": "cuda", "workers": 2}}, "device"), ({"model": {"factory": "mock", "output_order": ["mask0"] * 4}}, "each once"),
    ):
        with pytest.raises(config.ConfigError, match=text):
            config.parse(base | broken)


def test_command_line_errors(capsys, tmp_path, spark):
    assert cli.main(["status", "--config", str(tmp_path / "none.json")]) == 2
    assert "error" in capsys.readouterr().err


def test_factories():
    assert mining.load_factory("framesieve.operators.kernels:mock_model") is mining.load_factory("mock")
    for bad in ("nope", "framesieve.operators.kernels:LARGE_MOTION"):
        with pytest.raises((ValueError, TypeError)):
            mining.load_factory(bad)
    ok = {"flow_t0": np.zeros((2, 2, 2)), "flow_t1": np.zeros((2, 2, 2)), "mask0": np.zeros((2, 2)), "mask1": np.ones((2, 2))}
    assert set(mining.checked_outputs(list(ok.values()), ("flow_t0", "flow_t1", "mask0", "mask1"))) == set(ok)
    with pytest.raises(ValueError):
        mining.checked_outputs(ok | {"mask1": np.full((2, 2), 2.0)}, ())


def test_index_ids_do_not_depend_on_the_root(spark, tmp_path):
    ids = []
    for name in ("x", "y"):
        ramp(tmp_path / name / "v", (0, 1, 2))
        ids.append(mining.build_index(spark, settings(tmp_path / name, tmp_path / "r")).select("sample_id").collect())
    assert ids[0] == ids[1] and len(ids[0]) == 1
    assert F is not None

"""Operators against golden cases, brute force, and each other."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framesieve.functions import maps as m
from framesieve.operators import diagnosis, gates, intervals, kernels, ledger, records
from framesieve.operators import triplets as tr


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- intervals


def segments(spark, items):
    return spark.createDataFrame([(v, s, e, [i]) for v, s, e, i in items], "video_id string, start long, end long, sample_ids array<string>")


def plain(df):
    return sorted((r["video_id"], r["start"], r["end"], tuple(r["sample_ids"])) for r in df.collect())


def test_union_and_provenance(spark):
    got = intervals.union(segments(spark, [("a", 4, 6, "s3"), ("b", 1, 3, "other"), ("a", 1, 3, "s1"), ("a", 2, 4, "s2")]))
    assert plain(got) == [("a", 1, 6, ("s1", "s2", "s3")), ("b", 1, 3, ("other",))]
    apart = intervals.union(segments(spark, [("a", 1, 3, "x"), ("a", 4, 5, "y")]), adjacent=False)
    assert plain(apart) == [("a", 1, 3, ("x",)), ("a", 4, 5, ("y",))]


def test_barriers_cut_and_never_bridge(spark):
    wide = segments(spark, [("v", 1, 8, "wide")])
    assert plain(intervals.merge(wide, segments(spark, [("v", 4, 5, "b")]))) == [("v", 1, 3, ("wide",)), ("v", 6, 8, ("wide",))]
    two = segments(spark, [("a", 1, 5, "x"), ("b", 1, 5, "y")])
    assert plain(intervals.merge(two, segments(spark, [("a", 2, 4, "b")]), min_length=2)) == [("b", 1, 5, ("y",))]


def test_classified_merge(spark):
    d = spark.createDataFrame([("v", 1, 3, "accept", ["s1"]), ("v", 3, 5, "hard", ["s2"]), ("v", 4, 4, "invalid", ["x"]), ("v", 7, 9, "review", ["y"]), ("v", 10, 12, "out_of_scope", ["z"])], "video_id string, start long, end long, status string, sample_ids array<string>")
    assert plain(intervals.merge_classified(d)) == [("v", 1, 3, ("s1", "s2")), ("v", 5, 5, ("s2",))]


def test_random_merges_equal_frame_sets(spark):
    rng = random.Random(1)
    hard = [("v", s := rng.randrange(60), s + rng.randrange(6), f"h{i}") for i in range(25)]
    bars = [("v", s := rng.randrange(60), s + rng.randrange(3), "b") for _ in range(8)]
    blocked = {f for _, s, e, _ in bars for f in range(s, e + 1)}
    owners = {}
    for _, s, e, i in hard:
        for f in set(range(s, e + 1)) - blocked:
            owners.setdefault(f, set()).add(i)
    want, run = [], []
    for f in range(80):
        if f in owners:
            run.append(f)
        elif run:
            want.append(("v", run[0], run[-1], tuple(sorted(set().union(*[owners[x] for x in run])))))
            run = []
    assert plain(intervals.merge(segments(spark, hard), segments(spark, bars))) == want
    far = [("v", s * 997, e * 997, i) for _, s, e, i in hard]  # over many blocks
    cut = intervals.subtract(segments(spark, far), segments(spark, [("v", s * 997, e * 997, "b") for _, s, e, _ in bars]))
    assert all(not (r["start"] <= b * 997 <= r["end"]) for r in cut.collect() for b in blocked & {s for _, s, _, _ in bars})
    once = intervals.union(segments(spark, hard))
    assert plain(intervals.union(segments(spark, hard), block=3)) == plain(once)
    t = spark.createDataFrame([("v", s, e) for _, s, e, _ in hard[:6]], "video_id string, start long, end long")
    assert plain(intervals.with_hard_centre(once, t, block=3)) == plain(intervals.with_hard_centre(once, t))


def test_hard_centre_and_checks(spark):
    s = segments(spark, [("v", 1, 3, "a"), ("v", 7, 11, "b")])
    t = spark.createDataFrame([("v", 1, 5), ("v", 8, 10)], "video_id string, start long, end long")
    assert plain(intervals.with_hard_centre(s, t)) == [("v", 7, 11, ("b",))]
    with pytest.raises(Exception, match="start > end"):
        intervals.checked(segments(spark, [("v", 3, 1, "a")])).collect()
    with pytest.raises(ValueError):
        intervals.merge(s, s, min_length=0)


# --- triplets


def test_names_and_patterns(spark):
    names = spark.createDataFrame([("clip-alpha-001.png",), ("take_0017.png",), ("0100001.png",), ("x.png",), ("CLIP-beta-002.JPG",)], "n string")
    regex = tr.parse_frame_name(F.col("n"), pattern=r"^clip-(?P<video>[a-z]+)-(?P<frame>\d{3})\.(?P<ext>png|jpg)$")
    stem = tr.parse_frame_name(F.col("n"), pattern=r"^take_(?P<frame>\d{4})$")
    digits = tr.parse_frame_name(F.col("n"), digits=5)
    got = names.select("n", regex.alias("r"), stem.alias("s"), digits.alias("d")).collect()
    by = {r["n"]: r for r in got}
    assert tuple(by["clip-alpha-001.png"]["r"]) == ("alpha", 1) and tuple(by["CLIP-beta-002.JPG"]["r"]) == ("beta", 2)
    assert tuple(by["take_0017.png"]["s"]) == ("take_", 17) and tuple(by["0100001.png"]["d"]) == ("01", 1) and by["x.png"]["d"] is None
    with pytest.raises(ValueError):
        tr.parse_frame_name(F.col("n"), pattern="(?P<video>x)")


def test_triplets_runs_chunks(spark):
    f = spark.createDataFrame([("a", i) for i in (1, 2, 3, 5, 7, 9)] + [("b", 1), ("b", 2)], "video_id string, frame_index long")
    assert rows(tr.triplets(f)) == [("a", 1, 2, 3)]
    assert rows(tr.triplets(f, stride=2)) == [("a", 1, 3, 5), ("a", 3, 5, 7), ("a", 5, 7, 9)]
    assert rows(tr.consecutive_runs(f)) == [("a", 1, 3, 3), ("a", 5, 5, 1), ("a", 7, 7, 1), ("a", 9, 9, 1), ("b", 1, 2, 2)]
    got = {(r["video_id"], r["frame_index"]): r["chunk"] for r in tr.chunks(f, 4).collect()}
    assert [got["a", i] for i in (1, 2, 3, 5, 7, 9)] == [0, 0, 0, 0, 1, 1] and got["b", 1] == 2
    for block in (2, 3):  # long videos in blocks
        assert rows(tr.triplets(f, stride=2, block=block)) == rows(tr.triplets(f, stride=2))
        assert rows(tr.consecutive_runs(f, block=block)) == rows(tr.consecutive_runs(f))
        assert rows(tr.consecutive_runs(f, step=2, block=block)) == rows(tr.consecutive_runs(f, step=2))
        assert rows(tr.chunks(f, 4, block=block)) == rows(tr.chunks(f, 4))
    assert tr.dynamic_chunk_size(100, 4, 256) == 7 and tr.dynamic_chunk_size(0, 4, 256) == 1


# --- maps and kernels


@pytest.fixture(scope="module")
def images():
    rng = np.random.default_rng(2)
    return rng.random((6, 12, 10)), rng.random((6, 12, 10))


def test_columns_equal_kernels(spark, images):
    a, b = images
    df = spark.createDataFrame([(i, x.ravel().tolist(), y.ravel().tolist()) for i, (x, y) in enumerate(zip(a, b, strict=True))], "i int, a array<double>, b array<double>")
    s = m.summary(F.col("a"), (0.01, 0.1))
    e = m.error_maps(F.col("a"), F.col("b"), 12, 10)
    got = df.select("i", m.sobel(F.col("a"), 12, 10).alias("sobel"), m.robust_score(F.col("a")).alias("robust"), m.histogram_distance(F.col("a"), F.col("b")).alias("h"), m.repeat_distance(F.col("a"), F.col("b")).alias("r"), m.window_means(F.col("a"), 12, 10, 4).alias("w"), e["structure"].alias("structure"), *[v.alias(k) for k, v in s.items()]).orderBy("i").collect()
    for r, x, y in zip(got, a, b, strict=True):
        assert np.allclose(np.array(r["sobel"]).reshape(12, 10), kernels.sobel(x), atol=1e-6)
        assert math.isclose(r["robust"], kernels.robust_score(x), abs_tol=1e-6)
        assert math.isclose(r["h"], kernels.histogram_distance(x, y), abs_tol=1e-9) and math.isclose(r["r"], kernels.repeat_distance(x, y), abs_tol=1e-9)
        assert math.isclose(r["q99"], np.quantile(x, 0.99), abs_tol=1e-12) and math.isclose(r["top_10pct_mean"], kernels.top_mean(x, 0.1), abs_tol=1e-6)
        means, ys, xs, _, _ = kernels.window_grid(x, 4)
        assert np.allclose([c["mean"] for c in r["w"]], means.ravel(), atol=1e-6) and [c["y"] for c in r["w"]][:: len(xs)] == ys.tolist()
        grey = lambda z: np.repeat(z[..., None], 3, axis=-1).astype(np.float32)
        assert np.allclose(np.array(r["structure"]).reshape(12, 10), kernels.error_maps(grey(x), grey(y))["structure"], atol=1e-5)


@pytest.mark.parametrize("density", [0.05, 0.2, 0.5, 0.8])
def test_components_equal_flood_fill(density):
    rng = np.random.default_rng(3)
    mask, values = rng.random((23, 31)) < density, rng.random((23, 31))
    seen, want = set(), []
    for y, x in zip(*np.nonzero(mask), strict=True):
        if (y, x) in seen:
            continue
        stack, cells = [(y, x)], []
        seen.add((y, x))
        while stack:
            cy, cx = stack.pop()
            cells.append((cy, cx))
            for ny in range(cy - 1, cy + 2):
                for nx in range(cx - 1, cx + 2):
                    if 0 <= ny < 23 and 0 <= nx < 31 and mask[ny, nx] and (ny, nx) not in seen:
                        seen.add((ny, nx))
                        stack.append((ny, nx))
        inside = set(cells)
        edge = sum((cy + dy, cx + dx) not in inside for cy, cx in cells for dy, dx in ((0, 1), (1, 0), (0, -1), (-1, 0)))
        ys, xs = zip(*cells, strict=True)
        want.append((min(xs), min(ys), max(xs) + 1, max(ys) + 1, len(cells), edge, round(max(values[c] for c in cells), 9)))
    got = [(c.x0, c.y0, c.x1, c.y1, c.area, int(c.perimeter), round(c.peak, 9)) for c in kernels.components(mask, values)]
    assert sorted(got) == sorted(want)


def test_top_mean_keeps_a_tiny_peak():
    a = np.zeros((100, 100))
    a[0, 0] = 1
    assert kernels.top_mean(a, 1e-4) == 1.0 and abs(float(a.mean()) - 1e-4) < 1e-12


def test_warp_and_resize_cases():
    image = np.linspace(0, 1, 60).reshape(4, 5, 3).astype(np.float32)
    for padding in ("zeros", "border", "reflection"):
        for corners in (True, False):
            assert np.allclose(kernels.backward_warp(image, np.zeros((4, 5, 2)), padding, corners), image, atol=2e-6)
    dot = np.zeros((3, 4, 3), np.float32)
    dot[1, 1] = 1
    flow = np.zeros((3, 4, 2), np.float32)
    flow[..., 0] = -1
    assert kernels.backward_warp(dot, flow, "zeros")[1, 2, 0] == 1
    far = np.zeros((3, 4, 2), np.float32)
    far[..., 0] = -10
    assert kernels.backward_warp(np.ones((3, 4, 3), np.float32), far, "zeros").max() == 0 and kernels.backward_warp(np.ones((3, 4, 3), np.float32), far, "border").min() == 1
    big = kernels.resize_flow(np.array([[[1.0, 2.0]]], np.float32), 4, 6, (2, 2))
    assert np.allclose(big[..., 0], 3) and np.allclose(big[..., 1], 4)
    up = kernels.resize(np.array([[0, 1]], np.float32), 1, 4)
    assert np.allclose(up, [[0, 0.25, 0.75, 1]])
    assert np.allclose(kernels.resize(np.array([[0, 1]], np.float32), 1, 3, True), [[0, 0.5, 1]])


@pytest.mark.parametrize(("role", "mask1", "want"), [("warp0_weight", 0, 0.65), ("warp1_weight", 0, 0.35), ("warp1_weight", 1, 0.8)])
def test_reconstruction_roles(role, mask1, want):
    out = {"flow_t0": np.zeros((2, 2, 2), np.float32), "flow_t1": np.zeros((2, 2, 2), np.float32), "mask0": np.full((2, 2), 0.25, np.float32), "mask1": np.full((2, 2), mask1, np.float32)}
    made = kernels.reconstruct(np.full((4, 4, 3), 0.2, np.float32), np.full((4, 4, 3), 0.8, np.float32), out, (4, 4), role)
    assert np.allclose(made["prediction"], want, atol=1e-6)


def test_scoring_ignores_endpoints_in_raw_wrongness():
    rng = np.random.default_rng(4)
    truth, prediction = rng.random((64, 64, 3)).astype(np.float32), rng.random((64, 64, 3)).astype(np.float32)
    _, _, alone = kernels.score(prediction, truth)
    _, regions, with_ends = kernels.score(prediction, truth, img0=truth, img1=truth)
    assert alone["p_wrong"] == with_ends["p_wrong"] and with_ends["mining_p_wrong"] <= alone["p_wrong"] and len(regions) <= 8


def test_suppression_prefers_natives_and_separate_boxes():
    r = lambda box, score, native=True, **k: kernels.Region(box, score, native, **k)
    kept = kernels.suppress([r((0, 0, 10, 10), 0.5), r((1, 1, 11, 11), 0.9), r((0, 0, 40, 40), 1.0, False), r((50, 50, 60, 60), 0.1)], 8, 0, 0.55)
    assert [k.box for k in kept] == [(1, 1, 11, 11), (50, 50, 60, 60)]
    reserved = kernels.suppress([r((0, 0, 5, 5), 0.9, ui=0.9, weight=0.4), r((20, 20, 25, 25), 0.1)], 1, 1, 0.55)
    assert [k.box for k in reserved] == [(20, 20, 25, 25)]


def test_overlay_and_cut_metrics():
    y, x = np.mgrid[:100, :120]
    base = np.repeat((0.1 + 0.2 * x / 119)[..., None], 3, axis=-1).astype(np.float32)
    menu = base.copy()
    menu[70:, 8:112] = 0.9
    got = kernels.validity_metrics(base, menu, np.clip(menu + 0.02, 0, 1))
    back = kernels.validity_metrics(np.clip(menu + 0.02, 0, 1), menu, base)
    assert got["menu_transition_score"] >= 0.70 and abs(got["menu_transition_score"] - back["menu_transition_score"]) < 1e-6
    black, white = np.zeros((32, 32, 3), np.float32), np.ones((32, 32, 3), np.float32)
    assert kernels.validity_metrics(black, white, white)["scene_cut_score"] > 0.9


def test_scope_metrics_cases():
    pan = np.zeros((64, 96, 2), np.float32)
    pan[..., 0] = 18
    s = kernels.scope_metrics(pan, -pan)
    assert s["foreground_large_motion_ratio"] == 0 and s["background_motion"] > 0.1 and s["out_of_bounds_ratio"] == 0
    part = np.zeros((100, 100, 2), np.float32)
    part[..., 0] = 5
    part[:, 30:70, 0] = 25
    assert abs(kernels.scope_metrics(part, -part)["foreground_large_motion_ratio"] - 0.40) < 1e-6
    same = np.full((100, 100, 2), 0, np.float32)
    same[..., 0] = 10
    assert kernels.scope_metrics(same, same)["occlusion_ratio"] == 1.0
    masked = kernels.scope_metrics(same, same, foreground=np.zeros((100, 100)), occlusion=np.zeros((100, 100)))
    assert masked["occlusion_ratio"] == 0 and masked["foreground_large_motion_ratio"] == 0 and kernels.scope_metrics(same)["occlusion_ratio"] is None


# --- gates and diagnosis


def gate(spark, build):
    return spark.range(1).select(build.alias("g")).first()["g"]


@pytest.mark.parametrize(
    ("change", "label", "reasons"),
    [
        ({}, "accept", []), ({"duplicate_distance": 0.0}, "reject", ["duplicate_frame"]), ({"duplicate_distance": 0.004}, "review", ["possible_duplicate_frame"]),
        ({"sequence_contiguous": False}, "reject", ["invalid_sequence_gap"]), ({"scene_cut_score": 0.52}, "review", ["possible_scene_cut"]), ({"scene_cut_score": 0.9}, "reject", ["scene_cut"]),
        ({"temporal_asymmetry": 0.95}, "reject", ["temporal_discontinuity"]), ({"temporal_asymmetry": 0.95, "max_adjacent_difference": 0.001}, "accept", []),
        ({"menu_transition_score": 0.5}, "review", ["possible_menu_transition"]), ({"scene_cut_score": float("nan")}, "review", ["validity_metrics_missing"]), ({"decode_ok": None}, "review", ["validity_metrics_missing"]),
    ],
)
def test_validity_gate(spark, change, label, reasons):
    base = {"decode_ok": True, "finite": True, "sequence_contiguous": True, "duplicate_distance": 0.1, "scene_cut_score": 0.1, "temporal_asymmetry": 0.1, "max_adjacent_difference": 0.1, "menu_transition_score": 0.1} | change
    kinds = {"decode_ok": "boolean", "finite": "boolean", "sequence_contiguous": "boolean"}
    g = gate(spark, gates.validity_gate({k: F.lit(v).cast(kinds.get(k, "double")) for k, v in base.items()}))
    assert (g["label"], g["reasons"]) == (label, reasons)


@pytest.mark.parametrize(("wrong", "solvable", "label", "reasons"), [(0.8, 0.8, "accept", []), (0.3, 0.8, "review", ["wrongness_gray_zone"]), (0.1, 0.8, "reject", ["prediction_not_wrong"]), (0.9, 0.05, "review", ["solvability_low"]), (0.9, 0.4, "review", ["solvability_gray_zone"])])
def test_decision_gate(spark, wrong, solvable, label, reasons):
    ok = F.struct(F.lit("accept").alias("label"), F.array().cast("array<string>").alias("reasons"))
    g = gate(spark, gates.decision_gate(ok, ok, F.lit(wrong), F.lit(solvable)))
    assert (g["label"], g["reasons"]) == (label, reasons)


def test_threshold_resolution():
    t = gates.GateThresholds.of({"reject_duplicate": 0.01, "reject_scene_cut": 0.4, "scene_cut_review_at": None, "unknown": 1})
    assert (t.duplicate_reject_at, t.duplicate_review_at, t.scene_cut_review_at) == (0.01, 0.03, pytest.approx(0.3))


@pytest.mark.parametrize(("current", "teacher", "warps", "low", "high", "reason"), [(0.8, 0.05, (), 0.8, 1.0, "teacher_recovers"), (0.8, 0.9, (), 0.0, 0.5, "solvability_uncertain"), (0.75, None, (0.08, 0.7, 0.6), 0.75, 1.0, "warp_branch_recovers"), (0.5, None, (), 0.5, 0.5, "solvability_evidence_missing"), (0.01, 0.0, (), 0.0, 0.5, "wrongness_too_low_for_solvability")])
def test_solvability(spark, current, teacher, warps, low, high, reason):
    s = gate(spark, diagnosis.solvability(F.lit(current), None if teacher is None else F.lit(teacher), tuple(map(F.lit, warps))))
    assert low <= s["p_solvable"] <= high and reason in s["reasons"]


# --- records and ledger


def test_union_keeps_one_and_fails_at_conflicts(spark):
    a = spark.createDataFrame([("s1", 1), ("s2", 2), (None, 5), (None, 5)], "sample_id string, n int")
    b = spark.createDataFrame([("s2", 2), ("s3", 3)], "sample_id string, n int")
    assert sorted(records.union_records([a, b]).collect(), key=str) == sorted(records.union_records([b, a]).collect(), key=str)
    assert records.union_records([a, b]).count() == 5
    with pytest.raises(Exception, match="conflicting records for sample_id:s2"):
        records.union_records([a, spark.createDataFrame([("s2", 9)], "sample_id string, n int")]).collect()


def test_checked_overlay(spark):
    main = spark.createDataFrame([("a", "accept", 1), ("b", "reject", 2), ("c", "review", 3)], "id string, status string, k int")
    good = spark.createDataFrame([("a", "reject", 1), ("c", "accept", 3)], "id string, status string, k int")
    cand = F.col("status").isin("accept", "review")
    assert rows(records.checked_overlay(main, good, "id", ["status"], cand, ("k",)).select("id", "status")) == [("a", "reject"), ("b", "reject"), ("c", "accept")]
    for bad, text in ((good.where("id = 'a'"), "no update for c"), (good.unionAll(good), "duplicate update"), (good.withColumn("k", F.lit(7)), "changed k")):
        with pytest.raises(ValueError, match=text):
            records.checked_overlay(main, bad, "id", ["status"], cand, ("k",))


def fold(spark, events):
    df = spark.createDataFrame([("t", i, *e) for i, e in enumerate(events)], "task_id string, seq long, at double, kind string, owner string, lease_seconds double")
    r = ledger.fold(df).first()
    return r["status"], r["attempt"], r["owner"], r["lease_expires"]


def test_ledger_leases_and_fencing(spark):
    new, claim = (0.0, "enqueue", None, None), (10.0, "claim", "a", 30.0)
    assert fold(spark, [new, claim, (20.0, "heartbeat", "a", 50.0)]) == ("running", 1, "a", 70.0)
    assert fold(spark, [new, (10.0, "claim", "a", 5.0), (14.9, "claim", "b", 5.0)]) == ("running", 1, "a", 15.0)
    assert fold(spark, [new, (10.0, "claim", "a", 5.0), (15.0, "claim", "b", 5.0)]) == ("running", 2, "b", 20.0)
    assert fold(spark, [new, claim, (15.0, "complete", "b", None)]) == ("running", 1, "a", 40.0)
    assert fold(spark, [new, claim, (15.0, "complete", "a", None)]) == ("done", 1, "a", None)
    assert fold(spark, [new, claim, (15.0, "retry", "a", None), (16.0, "claim", "a", 9.0), (17.0, "retry", "a", None)]) == ("failed", 2, "a", None)
    assert fold(spark, [new, claim, (15.0, "retry", "a", None)]) == ("pending", 1, None, None)
    assert fold(spark, [new, claim, (15.0, "fail", "a", None)]) == ("failed", 1, "a", None)
    assert fold(spark, [new, claim, (99.0, "orphan", "b", None)]) == ("running", 1, "a", 40.0)
    assert fold(spark, [new, claim, (99.0, "orphan", "a", None)]) == ("pending", 1, None, None)
    assert fold(spark, [new, claim, (15.0, "fail", "a", None), (16.0, "requeue", None, None)])[:2] == ("pending", 1)


def test_ledger_results_errors_and_refusals(spark):
    schema = "task_id string, seq long, at double, kind string, owner string, lease_seconds double, result_path string, error string"
    begin = [("enqueue", None, None, None), ("claim", "a", None, None)]

    def run(*more):
        events = [("t", i, float(i), kind, owner, 50.0, result, error) for i, (kind, owner, result, error) in enumerate([*begin, *more])]
        df = spark.createDataFrame(events, schema)
        r = ledger.fold(df).first()
        return r["status"], r["owner"], r["result_path"], r["error"], ledger.refused(df).first()["refused"]

    done, other = ("complete", "a", "x", None), ("complete", "a", "y", None)
    assert run(done, done, ("complete", "b", None, None)) == ("done", "a", "x", None, 0)  # repeats change nothing
    assert run(done, other) == ("done", "a", "x", None, 1)
    assert run(("fail", "a", None, "no"), ("fail", "a", None, "no")) == ("failed", "a", None, "no", 0)
    assert run(("fail", "a", None, "no"), ("fail", "a", None, "another")) == ("failed", "a", None, "no", 1)
    assert run(("retry", "a", None, "no")) == ("pending", None, None, "no", 0)
    assert run(("retry", "a", None, "no"), ("claim", "b", None, None)) == ("running", "b", None, None, 0)
    assert run(done, ("requeue", None, None, None)) == ("pending", None, None, None, 0)
    assert run(("orphan", "a", None, None)) == ("pending", None, None, ledger.ORPHANED, 0)
    assert run(("heartbeat", "b", None, None)) == ("running", "a", None, None, 1)


def test_ledger_listing(spark):
    tasks = spark.createDataFrame([("b", "done", 1), ("a", "done", 1), ("c", "pending", 0)], "task_id string, status string, created_at int")
    assert [r["task_id"] for r in ledger.listed(tasks).collect()] == ["c", "a", "b"]
    assert [r["task_id"] for r in ledger.listed(tasks, "done").collect()] == ["a", "b"]
    assert ledger.get(tasks, "c") == {"task_id": "c", "status": "pending", "created_at": 0} and ledger.get(tasks, "d") is None
    with pytest.raises(ValueError):
        ledger.listed(tasks, "gone")


def test_canonical_json_sorts_inside_arrays_and_maps(spark):
    df = spark.sql("SELECT array(named_struct('b', 1, 'a', named_struct('d', 2, 'c', 3))) AS z, map('y', named_struct('q', 1, 'p', 2), 'x', null) AS m")
    text = df.select(records.canonical_json(df).alias("j")).first()["j"]
    assert text == '{"m":{"x":null,"y":{"p":2,"q":1}},"z":[{"a":{"c":3,"d":2},"b":1}]}'


def test_places_and_order_over_ranges(spark):
    df = spark.range(5000).selectExpr("id", "(id * 7919) % 5000 AS k", "CASE WHEN id % 9 = 0 THEN NULL ELSE 'x' END AS s")
    got = records.numbered(df, [F.col("k").desc()]).collect()
    assert all(r["place"] == 5000 - r["k"] for r in got) and len(got) == 5000
    before = records.running_before(df, [F.col("k")], "k", "sum").collect()
    assert all(r["sum"] == r["k"] * (r["k"] - 1) // 2 for r in before)
    assert records.checked_order(df.selectExpr("id", "id DIV 3 AS v"), "id", "v").count() == 5000
    for n in (1, 2500, 4999):  # one value out of order, wherever a range may end
        with pytest.raises(ValueError, match="not sorted at"):
            records.checked_order(df.selectExpr("id", f"if(id = {n}, id - 3, id) AS v"), "id", "v")
    assert records.numbered(df.limit(0), [F.col("k")]).count() == 0 and records.checked_order(df.limit(0), "id", "k").count() == 0


def test_statuses_are_checked(spark):
    df = spark.createDataFrame([("accept",), ("review",)], "status string")
    assert records.checked_status(df, ("accept", "review")).count() == 2
    for bad in ("odd", None):
        with pytest.raises(Exception, match="status not allowed"):
            records.checked_status(spark.createDataFrame([(bad,)], "status string"), ("accept",)).collect()


def test_subtract_keeps_repeated_rows(spark):
    iv = spark.createDataFrame([("v", 0, 9000, ["a"]), ("v", 0, 9000, ["a"]), ("v", 5, 6, ["b"])], "video_id string, start long, end long, sample_ids array<string>")
    bars = spark.createDataFrame([("v", 100, 100), ("v", 4095, 4097)], "video_id string, start long, end long")
    got = sorted((r["start"], r["end"], r["sample_ids"][0]) for r in intervals.subtract(iv, bars).collect())
    assert got == sorted([(0, 99, "a"), (101, 4094, "a"), (4098, 9000, "a")] * 2 + [(5, 6, "b")])


def test_enqueue_is_idempotent_and_all_or_nothing(spark):
    t = spark.createDataFrame([("a", "{}", 1)], "task_id string, payload_json string, priority int")
    assert ledger.enqueue(t, t).count() == 1
    assert ledger.enqueue(t, spark.createDataFrame([("b", "{}", 1)], t.schema)).count() == 2
    with pytest.raises(ValueError):
        ledger.enqueue(t, spark.createDataFrame([("a", "{}", 2)], t.schema))
    state = spark.createDataFrame([("a", "running", "o", 10.0), ("b", "running", "o", 11.0)], "task_id string, status string, owner string, lease_expires double")
    assert rows(ledger.recover_expired(state, 10.0).select("task_id", "status")) == [("a", "pending"), ("b", "running")]


# --- labellers and suppression


def test_both_labellers_agree():
    rng = np.random.default_rng(30)
    for density in (0.1, 0.4, 0.6, 0.9):
        values = rng.random((23, 31))
        mask = values >= 1 - density
        key = lambda c: (c.y0, c.x0, c.y1, c.x1, c.area, round(c.total, 9), c.peak, c.perimeter)
        assert sorted(map(key, kernels.components(mask, values))) == sorted(map(key, kernels.filled_components(mask, values)))


def test_suppression_reserves_a_place_and_leaves_no_free_box():
    rng = np.random.default_rng(31)
    for _ in range(50):
        regions = []
        for _ in range(30):
            x, y, w, h = rng.integers(0, 40, 2).tolist() + rng.integers(2, 20, 2).tolist()
            regions.append(kernels.Region((x, y, x + w, y + h), float(rng.random()), bool(rng.random() < 0.4), ui=float(rng.random()), weight=float(rng.choice([0.5, 1.0])), area_fraction=float(rng.random())))
        chosen = kernels.suppress(regions, 8, 1, 0.55)
        clash = lambda a, b: (lambda i, c: i >= 0.5 or c >= 0.85)(*kernels.overlap(a.box, b.box))
        assert len(chosen) <= 8 and not any(clash(a, b) for i, a in enumerate(chosen) for b in chosen[:i])
        if len(chosen) < 8:  # what was left out meets a chosen box
            assert all(any(clash(r, c) for c in chosen) for r in regions if not any(r is c for c in chosen))
        plain = [r for r in regions if r.ui < 0.55 and (r.native or (r.weight >= 0.95 and r.area_fraction <= 0.35))]
        if plain:
            best = next((g for g in ([r for r in plain if r.native], plain) if g), [])
            assert chosen[0] is min(best, key=lambda r: (-(r.score * r.weight), -r.weight, -r.score, r.box[1], r.box[0], r.box[3], r.box[2]))
    assert kernels.suppress(regions, 0, 1, 0.55) and len(kernels.suppress(regions, 0, 1, 0.55)) >= len(chosen)


# --- checks of records


def test_one_to_one_and_binding_fail_at_what_is_off(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "sample_id string, n int")
    b = spark.createDataFrame([("x", 3), ("y", 4)], "sample_id string, m int")
    assert records.one_to_one(a, b, "sample_id").count() == 2
    for left, right, text in ((a.unionAll(a), b, "repeated"), (a, b.where("m = 3"), "unmatched y"), (a.where("n = 1"), b, "unmatched y")):
        with pytest.raises(ValueError, match=text):
            records.one_to_one(left, right, "sample_id")
    tasks = spark.createDataFrame([("t", ["x"]), ("u", ["y"])], "task_id string, sample_ids array<string>")
    assert rows(records.bound(tasks, a)) == [("t", "x"), ("u", "y")]
    for bad in ([("t", ["x", "y"]), ("u", ["y"])], [("t", ["x"])], [("t", ["x", "y", "z"])]):
        with pytest.raises(ValueError):
            records.bound(spark.createDataFrame(bad, tasks.schema), a)


def test_runs_and_paths_are_checked(spark):
    df = spark.createDataFrame([("r", "main"), ("r", "main")], "run_hash string, stage string")
    assert records.checked_run(df, run_hash="r", stage="main").count() == 2
    for bad in ({"run_hash": "q"}, {"stage": "teacher"}):
        with pytest.raises(Exception, match="of another run"):
            records.checked_run(df, **bad).collect()
    f = spark.createDataFrame([("v", 1, "a"), ("v", 1, "a"), ("v", 2, "b")], "video_id string, frame_index int, path string")
    assert rows(records.unique_paths(f)) == [("v", 1, "a"), ("v", 2, "b")]
    with pytest.raises(Exception, match="two paths"):
        records.unique_paths(f.unionAll(spark.createDataFrame([("v", 2, "c")], f.schema))).collect()
    assert [r[0] for r in spark.createDataFrame([("b",), ("A",), ("a",), (None,)], "n string").orderBy(*records.fold_order("n")).collect()] == [None, "A", "a", "b"]


# --- the scorer against plain loops


def plain_score(truth, prediction):
    """(p_wrong, regions) of two 8x8 grey maps, by the definitions."""
    n = 8
    at = lambda m, y, x: m[min(max(y, 0), n - 1)][min(max(x, 0), n - 1)]

    def edges(m):
        out = [[0.0] * n for _ in range(n)]
        for y in range(n):
            for x in range(n):
                gx = sum(w * (at(m, y + d, x + 1) - at(m, y + d, x - 1)) for d, w in ((-1, 1), (0, 2), (1, 1)))
                gy = sum(w * (at(m, y + 1, x + d) - at(m, y - 1, x + d)) for d, w in ((-1, 1), (0, 2), (1, 1)))
                out[y][x] = min((gx * gx + gy * gy) ** 0.5 / 4, 1.0)
        return out

    def quantile(values, q):
        v = sorted(values)
        place = q * (len(v) - 1)
        low = int(place)
        return v[low] + (place - low) * (v[min(low + 1, len(v) - 1)] - v[low])

    def robust(values):
        v = sorted(values, reverse=True)
        top = lambda f: sum(v[: max(1, math.ceil(len(v) * f))]) / max(1, math.ceil(len(v) * f))
        return min(max(sum(v) / len(v), 0.9 * top(0.1), 0.95 * top(0.01), 0.85 * v[0]), 1.0)

    et, ep = edges(truth), edges(prediction)
    gap = [[abs(truth[y][x] - prediction[y][x]) for x in range(n)] for y in range(n)]
    structure = [[max(gap[y][x], min(1.25 * abs(et[y][x] - ep[y][x]), 1.0)) for x in range(n)] for y in range(n)]
    flat = [v for row in structure for v in row]
    bar = max(0.12, quantile(flat, 0.96))
    inner = max(0.12, quantile([structure[y][x] for y in range(2, 6) for x in range(2, 6)], 0.96))
    on = {(y, x) for y in range(n) for x in range(n) if structure[y][x] >= bar or (2 <= y < 6 and 2 <= x < 6 and structure[y][x] >= inner)}
    found = []
    while on:
        part, stack = set(), [on.pop()]
        while stack:
            y, x = stack.pop()
            part.add((y, x))
            near = {(y + j, x + i) for j in (-1, 0, 1) for i in (-1, 0, 1)} & on
            on -= near
            stack += near
        ys, xs = [p[0] for p in part], [p[1] for p in part]
        backed = sum(gap[y][x] >= 0.12 for y in range(min(ys), max(ys) + 1) for x in range(min(xs), max(xs) + 1))
        small = len(part) >= 2 and max(structure[y][x] for y, x in part) >= 0.5
        if backed >= 2 and (len(part) >= 9 or small):
            found.append((True, (max(0, min(xs) - 2), max(0, min(ys) - 2), min(n, max(xs) + 3), min(n, max(ys) + 3))))
    if sum(flat) / 64 >= 0.10:
        found.append((False, (0, 0, n, n)))
    scored = [(native, robust([structure[y][x] for y in range(b[1], b[3]) for x in range(b[0], b[2])]), b) for native, b in found]
    kept = []
    for native, score, b in sorted(scored, key=lambda r: (not r[0], -r[1], r[2][1], r[2][0], r[2][3], r[2][2])):
        area = lambda r: (r[2] - r[0]) * (r[3] - r[1])
        both = [max(0, min(b[2], k[2]) - max(b[0], k[0])) * max(0, min(b[3], k[3]) - max(b[1], k[1])) for _, k in kept]
        if len(kept) < 8 and all(2 * i < area(b) + area(k) - i and i < 0.85 * min(area(b), area(k)) for i, (_, k) in zip(both, kept, strict=True)):
            kept.append((score, b))
    raw = max((s for s, _ in kept), default=0.0)
    wrong = max(max(flat), raw) if raw > 0 else max(quantile(flat, 0.99), sum(flat) / 64)
    return min(max(wrong, 0.0), 1.0), len(kept)


def test_score_samples_equals_plain_loops(spark):
    from framesieve.plans import map_queries

    sf = "/root/testdata/sf0.01"
    maps = {r["vec_id"]: np.asarray(r["luma"]).reshape(8, 8).tolist() for r in map_queries.luma_maps(spark, sf).collect()}
    got = map_queries.score_samples(spark, sf).collect()
    assert len(got) == len(maps) // 2
    counts = set()
    for r in got:
        wrong, regions = plain_score(maps[2 * r["pair"]], maps[2 * r["pair"] + 1])
        counts.add(regions)
        assert (r["p_wrong"], r["n_regions"]) == (pytest.approx(wrong, abs=2e-6), regions), r["pair"]
        assert r["mining_p_wrong"] == pytest.approx(wrong, abs=2e-6)
    assert len(counts) > 1

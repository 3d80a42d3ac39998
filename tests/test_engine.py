"""Detectors on generated production: statistical bounds, state rules and the streaming twin."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from wafertide.config import Autoencoder, Config, Coupling, Inter, Intra, Lookback, Multivariate, Reference, Spectrum, Spike
from wafertide.functions import arrays as A
from wafertide.operators import detectors as D
from wafertide.operators import models as M
from wafertide.operators import reference as R
from wafertide.plans.pipeline import Analysis
from wafertide.scratch import materialize
from wafertide.sources import ingest, simulate, sinks
from wafertide.streaming import stateful

CFG = Config(
    reference=Reference(alpha=0.3, separation=0.1),
    intra=Intra(0.5, 3.0, 5),
    inter=Inter(0.2, 2.5, 5),
    spike=Spike(4.0, 2.5),
    coupling=Coupling(2.5, 5, 0.3),
    multivariate=Multivariate(0.3, 0.05, 5),
    autoencoder=Autoencoder(length=10, hidden=8, bottleneck=2, baseline=5, epochs=80, rate=0.05),
    spectrum=Spectrum(length=20, baseline=5),
)
SIZE = {"n_chips": 64, "n_points": 200}


def run(spark, plan, cfg=CFG, two=True):
    return Analysis(materialize(simulate.wafers(spark, plan), "chips"), cfg, two)


@pytest.fixture(scope="module")
def normal(spark):
    return run(spark, simulate.normal(20, seed=0, **SIZE))


def test_few_false_alarms(normal):
    wafers = 20
    assert normal.ewma("resist").where("is_alarm").count() <= 2 and normal.ewma("temp").where("is_alarm").count() <= 2
    assert D.intra(normal.cusum("temp")).where("is_alarm").count() <= 2
    assert normal.t2().where("is_alarm").count() <= 2
    assert normal.coupling().where("is_alarm").count() <= 1
    assert normal.spikes().where("is_alarm").count() <= 0.01 * wafers * 64
    deep = normal.autoencoder()
    assert deep.where("is_alarm").count() <= 0.05 * deep.count()
    scores = normal.spectrum("temp")
    assert scores.where("is_alarm").count() <= 0.05 * scores.count() and scores.count() == 14 * 64
    profile = np.array(normal.refs.orderBy(F.desc("wafer_seq")).first().temp_ref)
    assert np.sqrt(np.mean((profile - simulate.temperature(200)) ** 2)) < 20


def test_drift_is_found(spark):
    a = run(spark, simulate.drift(12, 10, 5.0, seed=3, **SIZE))
    assert a.ewma("resist").where("is_alarm and wafer_seq > 12").count() >= 1
    assert a.t2().where("is_alarm and wafer_seq > 12").count() >= 1
    kinds = {r.anomaly_type for r in a.events(models=False).select("anomaly_type").distinct().collect()}
    assert {"inter_drift", "inter_drift_mv"} <= kinds


def test_vibration_and_spikes_are_found(spark):
    plan = simulate.normal(8, seed=4, **SIZE)
    plan.append(simulate.Wafer("VIB", 9, noise=8.0, onset=0.4, seed=5, **SIZE))
    plan.append(simulate.Wafer("SPK", 10, spike_share=0.2, spike_height=8.0, seed=6, **SIZE))
    a = run(spark, plan)
    vib = {r.wafer_id: r for r in D.intra(a.cusum("temp")).where("is_alarm").collect()}["VIB"]
    assert vib.alarm_chip_index > 0.3 * 64
    hits = a.spikes().where("is_alarm").groupBy("wafer_id").count().collect()
    assert {r.wafer_id: r["count"] for r in hits}["SPK"] >= 10
    assert {r.wafer_id for r in a.spike_rates().where("is_alarm").collect()} >= {"SPK"}
    table = a.events()
    one = table.where("anomaly_type = 'spike' and chip_x is not null").first()
    assert {"chip_x", "spike_value", "threshold"} <= set(json.loads(one.details))
    text = D.event_text(table.where("anomaly_type = 'intra_drift'")).first().text
    assert text.startswith("[INTRA_DRIFT] wafer=") and "EQ01/R001/H1" in text
    errors = {r.wafer_id: r.e for r in a.autoencoder().groupBy("wafer_id").agg(F.avg("reconstruction_error").alias("e")).collect()}
    assert errors["VIB"] > errors["W007"]


def test_broken_coupling_is_found(spark):
    a = run(spark, simulate.coupling_breakdown(12, 6, 20.0, seed=7, **SIZE))
    assert a.coupling().where("is_alarm and wafer_seq > 12").count() >= 1
    assert a.coupling().where("is_alarm and wafer_seq <= 12").count() <= 1


def test_cold_start_maintenance_and_learning(spark):
    from dataclasses import replace

    plan = simulate.normal(9, seed=8, **SIZE)
    plan[5] = replace(plan[5], pm_event=True)
    chips = simulate.wafers(spark, plan)
    a = Analysis(chips, CFG, two=False)
    assert [(r.wafer_seq, r.epoch, r.n) for r in a.ewma().orderBy("wafer_seq").collect()] == [
        (2, 0, 1), (3, 0, 2), (4, 0, 3), (5, 0, 4), (7, 1, 1), (8, 1, 2), (9, 1, 3)
    ]
    still = chips.withColumn("learn", F.col("wafer_seq") <= 2).withColumn("pm_event", F.lit(False))
    b = Analysis(still, CFG, two=False)
    assert b.refs.count() == 2 and b.wafers.count() == 8


def test_ragged_chips(spark):
    chips = simulate.wafers(spark, simulate.normal(3, n_chips=8, n_points=40))
    short = F.when((F.col("bond_order") == 3) & (F.col("wafer_seq") == 2), F.slice("temp_series", 1, 30)).otherwise(F.col("temp_series"))
    ragged = chips.withColumn("temp_series", short)
    with pytest.raises(Exception, match="too few points"):
        Analysis(ragged, CFG, two=False).chips
    cfg = Config(reference=Reference(on_ragged="drop"))
    assert Analysis(ragged, cfg, two=False).features.count() == 15


def test_stream_equals_batch(spark, tmp_path):
    from dataclasses import replace

    plan = simulate.drift(8, 4, 4.0, seed=9, **SIZE) + simulate.normal(6, seed=10, equipment_id="EQ02", **SIZE)
    plan[6] = replace(plan[6], pm_event=True)
    chips = materialize(simulate.wafers(spark, plan), "chips")
    paths = [str(tmp_path / x) for x in ("in", "out", "mark")]
    for low, high in ((0, 4), (4, 5), (5, 99)):
        chips.where((F.col("wafer_seq") > low) & (F.col("wafer_seq") <= high)).write.mode("append").parquet(paths[0])
        stateful.run_available(stateful.track(spark.readStream.schema(chips.schema).parquet(paths[0]), CFG), *paths[1:])
    got = {(r.equipment_id, r.wafer_seq): r for r in spark.read.schema(stateful.CHART).parquet(paths[1]).collect()}
    a = Analysis(chips, CFG, two=False)
    peaks = {(r.equipment_id, r.wafer_seq): r for r in D.intra(a.cusum()).collect()}
    want = a.ewma().collect()
    assert len(got) == len(want) == 15
    for r in want:
        s, p = got[r.equipment_id, r.wafer_seq], peaks[r.equipment_id, r.wafer_seq]
        assert (s.roughness, s.ewma, s.baseline_mean, s.baseline_std) == pytest.approx(
            (r.temp_roughness, r.ewma, r.baseline_mean, r.baseline_std), rel=1e-9
        )
        assert (s.inter_alarm, s.intra_alarm, s.alarm_chip_index) == (r.is_alarm, p.is_alarm, p.alarm_chip_index)
        assert s.cusum_peak == pytest.approx(p.cusum_peak, abs=1e-9)


def test_baseline_document(spark, tmp_path):
    chips = materialize(simulate.wafers(spark, simulate.normal(7, seed=11, **SIZE)), "chips")
    a, path = Analysis(chips, CFG, two=False), str(tmp_path / "baseline")
    sinks.baseline_json(a.states(), path, CFG)
    (g,) = sinks.load_baseline(spark, path).collect()
    doc = json.loads(spark.read.text(path).first()[0])
    assert doc["version"] == "1.0" and doc["config"]["inter_wafer"]["baseline_wafers"] == 5
    tracker = stateful.GroupTracker(CFG)
    for seq in range(1, 8):
        series = [np.array(r.temp_series) for r in chips.where(F.col("wafer_seq") == seq).orderBy("bond_order").collect()]
        tracker.process(series)
    assert g.reference.n_wafers_seen == 7 and g.reference.temp_ref == pytest.approx(tracker.profile.tolist())
    s = g.inter_wafer_state
    assert (s.ewma_value, s.baseline_mean, s.baseline_std, s.m2) == pytest.approx((tracker.ewma, tracker.mean, tracker.std, tracker.m2))
    assert (s.n_samples, s.initialized, s.baseline_frozen) == (5, True, True)
    again = stateful.GroupTracker.load(tracker.dump(), CFG)
    assert again.process(series)["ewma"] == tracker.process(series)["ewma"]


def test_going_on_from_a_document(spark, tmp_path):
    """Seven wafers, a document, then the rest, in a batch and in a stream, equal one run."""
    from dataclasses import replace

    from wafertide.plans import baseline as B

    plan = simulate.drift(10, 4, 4.0, seed=16, **SIZE) + simulate.normal(5, seed=17, equipment_id="EQ02", **SIZE) + simulate.normal(1, seed=18, equipment_id="EQ03", **SIZE)
    plan[11] = replace(plan[11], pm_event=True)
    chips = materialize(simulate.wafers(spark, plan), "chips")
    old = (F.col("wafer_seq") <= 7) & (F.col("equipment_id") != "EQ02")
    path = str(tmp_path / "doc")
    sinks.baseline_json(B.initialize(chips.where(old), CFG), path, CFG)
    start = sinks.load_baseline(spark, path)
    names = ["equipment_id", "wafer_seq", "temp_roughness", "ewma", "baseline_mean", "baseline_std", "is_alarm"]
    whole = Analysis(chips, CFG, two=False)
    want = {r[:2]: r for r in map(tuple, whole.ewma().select(*names).collect()) if r[0] != "EQ01" or r[1] > 7}
    again = B.resume(chips.where(~old), start, CFG)
    got = {r[:2]: r for r in map(tuple, again.ewma().select(*names).collect())}
    assert got.keys() == want.keys() and len(want) == 10
    for k in want:
        assert got[k][2:6] == pytest.approx(want[k][2:6], rel=1e-9) and got[k][6] == want[k][6]
    peaks = [sorted((r.equipment_id, r.wafer_seq, r.cusum_peak) for r in D.intra(a.cusum()).collect()) for a in (whole, again)]
    before = [p for p in peaks[0] if p[0] != "EQ01" or p[1] > 7]
    assert [p[:2] for p in before] == [p[:2] for p in peaks[1]] and [p[2] for p in before] == pytest.approx([p[2] for p in peaks[1]])
    ends = [{r.equipment_id: r for r in a.states().collect()} for a in (whole, again)]
    for e in ("EQ01", "EQ02", "EQ03"):
        assert ends[0][e].reference.n_wafers_seen == ends[1][e].reference.n_wafers_seen
        assert ends[0][e].reference.temp_ref == pytest.approx(ends[1][e].reference.temp_ref)
    assert ends[1]["EQ03"].reference.n_wafers_seen == 1 and ends[1]["EQ03"].inter_wafer_state is None
    paths = [str(tmp_path / x) for x in ("in", "out", "mark")]
    chips.where(~old).write.parquet(paths[0])
    stateful.run_available(stateful.track(spark.readStream.schema(chips.schema).parquet(paths[0]), CFG, start), *paths[1:])
    rows = {(r.equipment_id, r.wafer_seq): r for r in spark.read.schema(stateful.CHART).parquet(paths[1]).collect()}
    assert rows.keys() == want.keys()
    for k, r in rows.items():
        assert (r.roughness, r.ewma, r.baseline_mean, r.baseline_std) == pytest.approx(want[k][2:6], rel=1e-9) and r.inter_alarm == want[k][6]


def test_baseline_routes(spark):
    """A full history alone, a partial one with today's wafers for the reference only, and today alone."""
    from wafertide.plans import baseline as B

    plan = [w for e, n in (("A", 8), ("B", 5), ("C", 2)) for w in simulate.normal(n, n_chips=12, n_points=40, equipment_id=e, seed=ord(e))]
    chips = materialize(simulate.wafers(spark, plan).drop("resist_series"), "chips")
    old = F.col("wafer_seq") <= F.when(F.col("equipment_id") == "A", 6).when(F.col("equipment_id") == "B", 3).otherwise(0)
    got = {r.equipment_id: r for r in B.build(chips.where(old), chips.where(~old), CFG, 5).collect()}
    assert {e: r.reference.n_wafers_seen for e, r in got.items()} == {"A": 6, "B": 5, "C": 2}
    assert {e: r.inter_wafer_state and r.inter_wafer_state.n_samples for e, r in got.items()} == {"A": 5, "B": 2, "C": None}
    for e, learned, tracked in (("A", 6, 6), ("B", 5, 3), ("C", 2, 0)):
        tracker = stateful.GroupTracker(CFG)
        for seq in range(1, learned + 1):
            wafer = [np.array(r.temp_series) for r in chips.where((F.col("equipment_id") == e) & (F.col("wafer_seq") == seq)).orderBy("bond_order").collect()]
            if seq <= tracked:
                tracker.process(wafer)
            else:
                tracker.profile = np.median(wafer, axis=0) if tracker.profile is None else 0.7 * tracker.profile + 0.3 * np.median(wafer, axis=0)
        assert got[e].reference.temp_ref == pytest.approx(tracker.profile.tolist())
        if tracked:
            assert got[e].inter_wafer_state.ewma_value == pytest.approx(tracker.ewma)


def _streamed(spark, chips, paths, **kw):
    stateful.run_available(stateful.track(stateful.chips_of(spark, paths[0], chips.schema, 1), CFG, **kw), *paths[1:])
    return sorted((r.equipment_id, r.wafer_seq, r.n_chips, round(r.ewma, 9)) for r in spark.read.schema(stateful.CHART).parquet(paths[1]).collect())


def test_event_time_closes_wafers(spark, tmp_path):
    """Wafers spread over files wait for their gap; late chips are left out; a silent group is forgotten."""
    chips = materialize(simulate.wafers(spark, simulate.normal(6, seed=19, **SIZE)).drop("resist_series"), "chips")
    paths = [str(tmp_path / x) for x in ("in", "out", "mark")]
    place = F.col("wafer_seq") + F.col("bond_order") / 64.0
    for low, high in ((0, 2.5), (2.5, 4.2), (4.2, 5.9)):
        chips.where((place >= low) & (place < high)).coalesce(1).write.mode("append").parquet(paths[0])
    got = _streamed(spark, chips, paths, gap="12 hours", forget="300 days")
    want = sorted((r.equipment_id, r.wafer_seq, r.n_chips, round(r.ewma, 9)) for r in Analysis(chips, CFG, two=False).ewma().collect())
    assert got == [w for w in want if w[1] <= 4]  # wafer 5 is still open
    chips.where("wafer_seq = 3").coalesce(1).write.mode("append").parquet(paths[0])
    chips.where(place >= 5.9).coalesce(1).write.mode("append").parquet(paths[0])
    assert _streamed(spark, chips, paths, gap="12 hours", forget="300 days") == [w for w in want if w[1] <= 5]
    later = chips.where("wafer_seq <= 2").withColumn("first_ts", F.col("first_ts") + F.expr("interval 400 days")).withColumn("wafer_seq", F.col("wafer_seq") + 400)
    other = later.limit(1).withColumns({"equipment_id": F.lit("none"), "first_ts": F.lit(dt.datetime(2100, 1, 1))})
    other.withColumn("first_ts", F.lit(dt.datetime(2025, 1, 15))).coalesce(1).write.mode("append").parquet(paths[0])
    later.coalesce(1).write.mode("append").parquet(paths[0])
    other.coalesce(1).write.mode("append").parquet(paths[0])
    rows = [r for r in _streamed(spark, chips, paths, gap="12 hours", forget="300 days") if r[0] == "EQ01"]
    assert [r[1] for r in rows] == [2, 3, 4, 5, 6, 402]  # wafer 401 is a cold start again


def test_stream_restarts_after_a_crash(spark, tmp_path):
    """A batch that fails leaves no trace: the next start does it again, and neither loses nor repeats a wafer."""
    chips = materialize(simulate.wafers(spark, simulate.normal(7, seed=20, **SIZE)).drop("resist_series"), "chips")
    paths = [str(tmp_path / x) for x in ("in", "out", "mark")]
    for low, high in ((0, 3), (3, 5), (5, 7)):
        chips.where((F.col("wafer_seq") > low) & (F.col("wafer_seq") <= high)).coalesce(1).write.mode("append").parquet(paths[0])
    stream = stateful.chips_of(spark, paths[0], chips.schema, 1)
    crash = F.when(F.col("wafer_seq") == 5, F.raise_error(F.lit("power cut")).cast("int")).otherwise(F.col("x"))
    with pytest.raises(Exception, match="power cut"):
        stateful.run_available(stateful.track(stream.withColumn("x", crash).where("x is not null"), CFG), *paths[1:])
    assert 0 < spark.read.schema(stateful.CHART).parquet(paths[1]).count() < 6
    got = _streamed(spark, chips.withColumn("x", F.col("x")), paths)
    assert got == sorted((r.equipment_id, r.wafer_seq, r.n_chips, round(r.ewma, 9)) for r in Analysis(chips, CFG, two=False).ewma().collect())


def test_stream_drops_ragged_chips(spark, tmp_path):
    from dataclasses import replace

    chips = simulate.wafers(spark, simulate.normal(3, n_chips=8, n_points=40)).drop("resist_series")
    short = F.when((F.col("bond_order") == 3) & (F.col("wafer_seq") == 2), F.slice("temp_series", 1, 30)).otherwise(F.col("temp_series"))
    chips = materialize(chips.withColumn("temp_series", short), "chips")
    paths = [str(tmp_path / x) for x in ("in", "out", "mark")]
    chips.write.parquet(paths[0])
    cfg = replace(CFG, reference=replace(CFG.reference, on_ragged="drop"))
    stateful.run_available(stateful.track(stateful.chips_of(spark, paths[0], chips.schema), cfg), *paths[1:])
    got = {r.wafer_seq: (r.n_chips, r.ewma) for r in spark.read.schema(stateful.CHART).parquet(paths[1]).collect()}
    assert got == {r.wafer_seq: (r.n_chips, pytest.approx(r.ewma)) for r in Analysis(chips, cfg, two=False).ewma().collect()} and got[2][0] == 7
    with pytest.raises(Exception, match="too few points"):
        stateful.run_available(stateful.track(stateful.chips_of(spark, paths[0], chips.schema), CFG), str(tmp_path / "o2"), str(tmp_path / "m2"))


def test_generators():
    x = simulate.two_peaks(500)
    assert x[:155].tolist() == [0.5] * 155 and x[155] == pytest.approx(0.5 + 2 * np.exp(-4)) and x[194] == pytest.approx(0.5 + 2 * np.exp(-4))
    assert 2.49 < x[174:176].max() <= 2.5 and (x > 0.5).sum() == 80
    quiet = simulate.Wafer("V", 1, n_chips=10, n_points=4000, noise=5.0, onset=0.4, temp_noise=1.0)
    spread = [np.std(r[8] - simulate.temperature(4000)) for r in simulate.chips_of(quiet)]
    assert spread == pytest.approx([1] * 5 + [1 + 4 * k / 6 for k in range(1, 6)], rel=0.1)
    spiked = simulate.chips_of(simulate.Wafer("S", 1, n_chips=10, spike_share=0.19, spike_height=9.0))
    assert sum(r[9].max() > 6 for r in spiked) == 1


def test_failed_equipment_is_set_apart(spark):
    """Equipment with ragged chips gets a status; the run goes on with the others."""
    chips = simulate.wafers(spark, simulate.normal(4, n_chips=12, n_points=40) + simulate.normal(4, n_chips=12, n_points=40, equipment_id="EQ02")).drop("resist_series")
    cut = (F.col("equipment_id") == "EQ02") & (F.col("wafer_seq") == 3) & (F.col("bond_order") == 5)
    chips = materialize(chips.withColumn("temp_series", F.when(cut, F.slice("temp_series", 1, 30)).otherwise(F.col("temp_series"))), "chips")
    failed = R.ragged_equipment(chips)
    good = chips.join(failed.select(F.col("eqp_id").alias("equipment_id")), "equipment_id", "left_anti")
    known = spark.createDataFrame([("EQ01",), ("EQ02",), ("EQ09",)], "eqp_id string")
    rows = chips.withColumnRenamed("equipment_id", "eqp_id")
    found = Analysis(good, CFG, two=False).ewma()
    summary = sinks.run_summary(known, rows, good, found, failed)
    got = {r.eqp_id: r for r in summary.collect()}
    assert {e: r.status for e, r in got.items()} == {"EQ01": "success", "EQ02": "error", "EQ09": "no_data"}
    assert "W002" in got["EQ02"].error and got["EQ01"].n_anomalies == 3 and got["EQ02"].n_rows == 0
    assert sinks.run_totals(summary).first().n_chips == 48


def test_cusum_golden(spark):
    z = [0.0, 2.0, 1.0, 1.0, -3.0, 2.0, 2.0]  # the first two are the warm-up: mean 1, sample spread sqrt(2)
    rows = [("e", "r", "h", 0, 1, "w", i, 1 + v * 2**0.5 if i > 1 else v) for i, v in enumerate(z)]
    table = spark.createDataFrame(rows, "equipment_id string, recipe string, head string, epoch int, wafer_seq long, wafer_id string, bond_order int, v double")
    chart = D.cusum(table, "v", Intra(k=0.5, h=1.0, warmup=2, least_cv=0.0)).orderBy("bond_order").collect()
    assert [r.s for r in chart] == pytest.approx([0.5, 1.0, 0, 1.5, 3.0])
    (wafer,) = D.intra(D.cusum(table, "v", Intra(0.5, 1.0, 2, 0.0))).collect()
    assert (wafer.alarm_chip_index, wafer.cusum_peak) == (5, pytest.approx(3.0))


def test_spectrum_model(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(0, 2, (500, 20))
    centre, precision, rank = M.fit_profile(x, 2)
    score = np.einsum("ij,jk,ik->i", x - centre, precision, x - centre)
    assert abs(score.mean() / rank - 1) < 0.2
    assert (np.array(M.chi2_limits(spark, 0.01, 20)) > 0).all()
    assert M.chi2_limits(spark, 0.05, 2)[1] == pytest.approx(5.9914645471)
    assert M.chi2_limits(spark, 0.01, 20)[19] == pytest.approx(37.566234787)
    assert M.fit_profile(np.ones((5, 4)), 2)[2] >= 2


def test_network_gradient():
    """Every gradient equals the finite difference of the loss, and training lowers the loss."""
    cfg = Autoencoder(length=3, hidden=4, bottleneck=2, seed=1)
    net, x = M.Network(6, cfg), np.random.default_rng(2).normal(size=(9, 6))
    params, grads = [*net.weights, *net.biases], net.gradients(x)
    for p, g in zip(params, grads):
        for at in np.ndindex(p.shape):
            old, losses = p[at], []
            for step in (1e-6, -1e-6):
                p[at] = old + step
                losses.append(net.errors(x).mean())
            p[at] = old
            assert g[at] == pytest.approx((losses[0] - losses[1]) / 2e-6, abs=1e-7)
    before = net.errors(x).mean()
    net.train(x, 60, 0.02)
    assert net.errors(x).mean() < before
    assert np.allclose(M.Network.restored(6, cfg, np.array(net.flat())).errors(x), net.errors(x))


def plain_network(train, x, cfg):
    """Errors of ``x`` by a network written out layer by layer, and the threshold on the training errors."""
    rng, d, h, b = np.random.default_rng(cfg.seed), train.shape[1], cfg.hidden, cfg.bottleneck
    w1, w2, w3, w4 = (rng.normal(0, (2 / i) ** 0.5, (i, o)) for i, o in ((d, h), (h, b), (b, h), (h, d)))
    p = {"w1": w1, "w2": w2, "w3": w3, "w4": w4, "b1": np.zeros(h), "b2": np.zeros(b), "b3": np.zeros(h), "b4": np.zeros(d)}
    m, v = ({k: np.zeros(a.shape) for k, a in p.items()} for _ in range(2))

    def forward(x):
        a1 = np.tanh(x @ p["w1"] + p["b1"])
        a2 = np.tanh(a1 @ p["w2"] + p["b2"])
        a3 = np.tanh(a2 @ p["w3"] + p["b3"])
        return a1, a2, a3, a3 @ p["w4"] + p["b4"]

    for t in range(1, cfg.epochs + 1):
        a1, a2, a3, y = forward(train)
        d4 = 2 * (y - train) / train.size
        d3 = d4 @ p["w4"].T * (1 - a3**2)
        d2 = d3 @ p["w3"].T * (1 - a2**2)
        d1 = d2 @ p["w2"].T * (1 - a1**2)
        g = {"w4": a3.T @ d4, "w3": a2.T @ d3, "w2": a1.T @ d2, "w1": train.T @ d1, "b4": d4.sum(0), "b3": d3.sum(0), "b2": d2.sum(0), "b1": d1.sum(0)}
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            p[k] = p[k] - cfg.rate * (m[k] / (1 - 0.9**t)) / ((v[k] / (1 - 0.999**t)) ** 0.5 + 1e-8)
    error = lambda x: ((forward(x)[-1] - x) ** 2).mean(axis=1)
    return error(x), np.percentile(error(train), cfg.percentile)


def test_models_equal_plain_numpy(spark):
    """Scores, thresholds and ranks of both models, with retraining, against plain numpy on the same vectors."""
    cfg = Config(
        reference=Reference(alpha=0.3),
        autoencoder=Autoencoder(length=5, hidden=4, bottleneck=2, baseline=3, epochs=25, rate=0.05, percentile=90, retrain=2),
        spectrum=Spectrum(length=6, baseline=3, alpha=0.05, retrain=2),
    )
    plan = simulate.normal(9, n_chips=12, n_points=60, seed=14) + simulate.normal(6, n_chips=9, n_points=60, seed=15, equipment_id="EQ02")
    a = run(spark, plan, cfg)
    groups = {}
    for r in a.tracked().select("equipment_id", "n", "bond_order", "temp_residual", "resist_residual").collect():
        groups.setdefault(r.equipment_id, []).append((r.n, r.bond_order, np.array(r.temp_residual), np.array(r.resist_residual)))
    shrink = lambda s, length: [s[int(i * len(s) / length) : int((i + 1) * len(s) / length)].mean() for i in range(length)]
    deep = {(r.equipment_id, r.n, r.bond_order): r for r in a.autoencoder().collect()}
    noise = {(r.equipment_id, r.n, r.bond_order): r for r in a.spectrum("temp").collect()}
    limits, seen = M.chi2_limits(spark, 0.05, 6), 0
    for equipment, rows in groups.items():
        rows.sort(key=lambda r: r[:2])
        last = max(r[0] for r in rows)
        for model in range(3):
            own = range(1, 4) if model == 0 else range(2 + 2 * model, 4 + 2 * model)
            if own[-1] > last:
                continue
            scored = [r for r in rows if 4 + 2 * model <= r[0] < 6 + 2 * model]
            both = [np.array([shrink(r[2], 5) + shrink(r[3], 5) for r in rows if r[0] in own]), np.array([shrink(r[2], 5) + shrink(r[3], 5) for r in scored]).reshape(-1, 10)]
            scale = np.repeat([both[0][:, :5].std(), both[0][:, 5:].std()], 5)
            errors, limit = plain_network(both[0] / scale, both[1] / scale, cfg.autoencoder)
            x, y = (np.array([shrink(r[2], 6) for r in some]).reshape(-1, 6) for some in ([r for r in rows if r[0] in own], scored))
            values, axes = np.linalg.eigh(np.cov(x.T))
            keep = values <= values.mean() * (1 + (6 / len(x)) ** 0.5) ** 2
            scores = [sum(((z - x.mean(0)) @ axes[:, i]) ** 2 / values[i] for i in np.flatnonzero(keep)) for z in y]
            for r, e, s in zip(scored, errors, scores):
                d, q = deep[equipment, r[0], r[1]], noise[equipment, r[0], r[1]]
                assert (d.model, d.reconstruction_error, d.threshold) == (model, pytest.approx(e, rel=1e-6), pytest.approx(limit, rel=1e-6))
                assert (q.model, q.mp_score, q.k_noise) == (model, pytest.approx(s, rel=1e-6), int(keep.sum()))
                assert q.threshold == pytest.approx(limits[q.k_noise - 1]) and (d.is_alarm, q.is_alarm) == (e > limit, s > q.threshold)
                seen += 1
    assert seen == len(deep) == len(noise) > 60


def test_chi_square_limits(spark):
    """The distribution function at each limit, by its series."""
    import math

    for alpha in (0.01, 0.05):
        for df, x in enumerate(M.chi2_limits(spark, alpha, 25), 1):
            term = total = 1 / math.gamma(df / 2 + 1)
            for k in range(1, 400):
                term *= (x / 2) / (df / 2 + k)
                total += term
            assert total * (x / 2) ** (df / 2) * math.exp(-x / 2) == pytest.approx(1 - alpha, abs=1e-9)


def test_retrain_blocks(spark):
    n = spark.range(1, 16).select(F.col("id").alias("n"))
    got = n.select("n", M.model_number(F.col("n"), 4, 3).alias("m"), M.trains(F.col("n"), 4, 3).alias("t")).orderBy("n").collect()
    assert [r.m for r in got] == [None] * 4 + [0, 0, 0, 1, 1, 1, 2, 2, 2, 3, 3]
    assert [r.t for r in got] == [0] * 4 + [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4]
    once = n.select(M.model_number(F.col("n"), 4, 0).alias("m"), M.trains(F.col("n"), 4, 0).alias("t")).where("n > 4").distinct().collect()
    assert [(r.m, r.t) for r in once] == [(0, None)]


def test_wafer_assembly(spark):
    ts = lambda h: dt.datetime(2024, 1, 1, h)
    rows = [
        ("E", "P", "M", "w2", 1, 0, "0000803f", ts(5)), ("E", "P", "M", "w1", 0, 0, None, ts(1)), ("E", "P", "M", "w1", 2, 0, "0000803f", ts(9)),
        ("E", "P", "M", "w1", 1, 0, "00000040", ts(9)), (None, "P", "M", "w1", 1, 0, "00000040", ts(2)), ("E", "P", "M", "w0", 1, 0, "zz", ts(0)),
    ]
    raw = spark.createDataFrame(rows, "eqp_id string, product string, module_id string, wafer_id string, x int, y int, temp_raw string, event_tmstp timestamp")
    got = ingest.chips_from_rows(raw).orderBy("wafer_seq", "bond_order").collect()
    assert [(r.wafer_id, r.wafer_seq, r.bond_order, r.x, r.temp_series) for r in got] == [
        ("w1", 1, 0, 1, [2.0]), ("w1", 1, 1, 2, [1.0]), ("w2", 2, 0, 1, [1.0])
    ]
    assert got[0].first_ts == ts(1)
    bare = ingest.chips_from_rows(raw.drop("module_id", "x").withColumn("head", F.lit("H"))).first()
    assert (bare.head, bare.x) == ("H", 0)


def test_lookback_and_policy(spark):
    today = dt.date(2024, 3, 1)
    day = lambda n: dt.datetime(2024, 3, 1) - dt.timedelta(days=n) + dt.timedelta(hours=3)
    rows = [("A", "r", "h", f"a{n}", day(n)) for n in range(0, 12)] + [("B", "r", "h", f"b{n}", day(n)) for n in (2, 9, 10, 16, 25, 40)]
    wafers = spark.createDataFrame(rows, "equipment_id string, recipe string, head string, wafer_id string, first_ts timestamp")
    cfg = Lookback(least_wafers=3, days=30, chunk_days=7)
    got = {r.wafer_id for r in ingest.lookback(wafers, today, cfg).collect()}
    assert got == {f"a{n}" for n in range(1, 12)} | {"b2", "b9", "b10"}
    deep = {r.wafer_id for r in ingest.lookback(wafers, today, Lookback(5, 30, 7)).collect()}
    assert "b25" in deep and "b40" not in deep
    policy = ingest.baseline_policy(ingest.lookback(wafers, today, cfg), wafers.where("wafer_id like 'a0' or wafer_id = 'b2'").replace("B", "C"), 5)
    assert {r.equipment_id: r.route for r in policy.collect()} == {"A": "full", "B": "partial", "C": "today"}


def test_sinks(spark, tmp_path):
    a = run(spark, simulate.drift(8, 4, 6.0, seed=13, n_chips=30, n_points=80), two=False)
    found = a.events()
    assert sinks.write_events(found, str(tmp_path / "e"), by_equipment=True)
    assert spark.read.csv(str(tmp_path / "e"), header=True).count() == found.count()
    assert not sinks.write_events(found.where("false"), str(tmp_path / "none")) and not (tmp_path / "none").exists()
    (row,) = sinks.group_summary(a.chips, found, 5, new_after=10).collect()
    assert (row.group_key, row.status, row.n_wafers_seen_total, row.n_new_wafers_this_run) == ("EQ01|R001|H1", "ready", 12, 2)
    assert row.anomalies_this_run == found.count() and row.n_ready_this_run == 2

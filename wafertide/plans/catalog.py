"""Registered queries over the generic tables, with their SQL where DuckDB can express them.

Chart queries return all rows with ``is_alarm``; doubles are rounded alike on both sides.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Autoencoder, Config, Coupling, Inter, Intra, Lookback, Multivariate, Reference, Spectrum, Spike
from ..functions import arrays as A
from ..operators import detectors as D
from ..operators import models as M
from ..operators import reference as R
from ..schema import GROUP
from ..scratch import materialize, new_path
from ..sources import ingest, simulate, sinks
from ..streaming import stateful
from . import baseline as B
from . import fixtures as X
from . import oracles as O
from .pipeline import Analysis

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Loose limits and short baselines, so that a few stationary wafers give alarms; models have their full size.
CFG = Config(
    reference=Reference(alpha=0.3),
    intra=Intra(k=0.25, h=1.0, warmup=5),
    inter=Inter(weight=0.3, sigma=0.5, baseline=5),
    spike=Spike(sigma=1.5, rate_sigma=0.5),
    coupling=Coupling(sigma=0.3, baseline=5, weight=0.3),
    multivariate=Multivariate(weight=0.3, alpha=0.5, baseline=5),
    autoencoder=Autoencoder(baseline=4, percentile=90),
    spectrum=Spectrum(baseline=4, alpha=0.2),
)
WAVES = O.waveform_ctes(CFG.reference.alpha)
MEANS = O.two_means_ctes()
FEAT = f"{WAVES},{MEANS},{O.cluster_ctes(CFG.reference.alpha)}"
START, END = "2024-01-05 12:00:00", "2024-02-10 00:00:00"
RAW_SQL = """raw as (select (user_id % 2)::varchar eqp_id, event_type product, 'H1' module_id, strftime(ts, '%Y-%m-%d') wafer_id,
  (event_id % 10)::int x, (event_id % 7)::int y,
  case when value >= 2 then case when event_id % 2 = 0 then '0000803f000000c0ff' else '000000410000c8c1' end end temp_raw, ts event_tmstp from events)"""
CHIP_SQL = f"""{RAW_SQL},
fw as (select eqp_id, product, module_id, wafer_id, min(event_tmstp) first_ts, bool_or(temp_raw is not null) any_chip from raw group by all),
ws as (select * exclude any_chip, row_number() over (partition by eqp_id, product, module_id order by first_ts, wafer_id) wafer_seq from fw where any_chip),
ck as (select r.eqp_id equipment_id, r.product recipe, r.module_id head, r.wafer_id, wafer_seq, first_ts, x, y,
  (row_number() over (partition by r.eqp_id, r.product, r.module_id, r.wafer_id order by event_tmstp, x, y) - 1)::int bond_order,
  case when temp_raw like '0000803f%' then 1.0 else 8.0 end v1, case when temp_raw like '0000803f%' then -2.0 else -25.0 end v2
  from raw r join ws using (eqp_id, product, module_id, wafer_id) where temp_raw is not null)"""


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """All doubles rounded; -0.0 becomes 0.0."""
    return df.select(*[(F.round(F.col(c), digits) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def q(expr: str, digits: int = 4) -> str:
    return f"round({expr}, {digits}) + 0.0"


def analysis(spark: SparkSession, sf_dir: str, cfg: Config = CFG, once: bool = True, **kw) -> Analysis:
    """A run over the derived chips, which are stored first, as ingestion would store them; ``once`` for a single chart."""
    return Analysis(materialize(X.waveforms(spark, sf_dir, **kw), "chips"), cfg, stored=True, once=once)


def shown(df: DataFrame, *columns) -> DataFrame:
    return rounded(df.select(F.col("equipment_id").alias("g"), F.col("wafer_seq").alias("wi"), *columns))


# sources -----------------------------------------------------------------------------------------------------------


@query("scan_window_halfopen", f"with {RAW_SQL} select * from raw where event_tmstp > timestamp '{START}' and event_tmstp <= timestamp '{END}'")
def scan_window_halfopen(spark, sf_dir):
    return ingest.scan_after(X.raw_rows(spark, sf_dir), START, END)


@query("scan_window_between", f"with {RAW_SQL} select * from raw where event_tmstp between timestamp '{START}' and timestamp '{END}'")
def scan_window_between(spark, sf_dir):
    return ingest.scan_between(X.raw_rows(spark, sf_dir), START, END)


@query(
    "scan_filtered",
    f"with {RAW_SQL} select * from raw where event_tmstp between timestamp '{START}' and timestamp '{END}' and eqp_id = '1' and product = 'click'",
)
def scan_filtered(spark, sf_dir):
    return ingest.scan_between(X.raw_rows(spark, sf_dir), START, END, eqp_id="1", product="click", module_id=None)


@query("distinct_equipment", f"with {RAW_SQL} select distinct eqp_id from raw where event_tmstp between timestamp '{START}' and timestamp '{END}'")
def distinct_equipment(spark, sf_dir):
    return ingest.equipment(X.raw_rows(spark, sf_dir), START, END)


@query("chips_from_rows", f"with {CHIP_SQL} select equipment_id, recipe, head, wafer_id, wafer_seq, first_ts, x, y, bond_order, v1::double v1, v2::double v2 from ck")
def chips_from_rows(spark, sf_dir):
    chips = ingest.chips_from_rows(X.raw_rows(spark, sf_dir))
    return chips.select(
        *GROUP, "wafer_id", "wafer_seq", "first_ts", "x", "y", "bond_order", F.get("temp_series", F.lit(0)).alias("v1"), F.get("temp_series", F.lit(1)).alias("v2")
    )


@query("wafer_sequence", f"with {CHIP_SQL} select equipment_id, recipe, head, wafer_id, wafer_seq, count(*) n_chips from ck group by all")
def wafer_sequence(spark, sf_dir):
    chips = ingest.chips_from_rows(X.raw_rows(spark, sf_dir))
    return chips.groupBy(*GROUP, "wafer_id", "wafer_seq").agg(F.count("*").alias("n_chips"))


HEX_SQL = "select vec_id, pos::int pos, e::double v from (select vec_id, unnest(embedding) e, generate_subscripts(embedding, 1) - 1 pos from embeddings)"


@query("hex_decode_roundtrip", HEX_SQL)
def hex_decode_roundtrip(spark, sf_dir):
    """Encodes each vector as little-endian hex words with SQL functions and decodes it again."""
    bits = """transform(embedding, f -> case when f = 0 then 0L else
      if(f < 0, 2147483648L, 0L) + (cast(floor(log2(abs(cast(f as double)))) as bigint) + 127) * 8388608
      + cast(abs(cast(f as double)) / pow(2D, floor(log2(abs(cast(f as double))))) * 8388608 as bigint) - 8388608 end)"""
    word = "transform(b, x -> transform(array(lpad(hex(x), 8, '0')), h -> concat(substr(h,7,2), substr(h,5,2), substr(h,3,2), substr(h,1,2)))[0])"
    rows = X.table(spark, sf_dir, "embeddings").select("vec_id", F.expr(bits).alias("b"))
    rows = rows.select("vec_id", F.array_join(F.expr(word), "").alias("h"))
    return rows.select("vec_id", F.posexplode(A.decode_hex("h")).alias("pos", "v"))


# projections -------------------------------------------------------------------------------------------------------


@query("residual_points", f"with recursive {FEAT} select g, wi, ch bond_order, (p - 1)::int pos, {q('xt')} temp, {q('xr')} resist from res")
def residual_points(spark, sf_dir):
    both = F.arrays_zip(F.col("temp_residual").alias("t"), F.col("resist_residual").alias("r"))
    rows = analysis(spark, sf_dir).at.select("equipment_id", "wafer_seq", "bond_order", F.posexplode(both).alias("pos", "v"))
    return shown(rows, "bond_order", "pos", F.col("v.t").alias("temp"), F.col("v.r").alias("resist"))


@query(
    "first_diff",
    f"with {WAVES} select g, wi, ch bond_order, (p - 2)::int pos, {q('dx')} v from (select *, t - lag(t) over (partition by g, wi, ch order by p) dx from c) where p > 1",
)
def first_diff(spark, sf_dir):
    chips = X.waveforms(spark, sf_dir)
    return shown(chips.select("*", F.posexplode(A.first_diff(F.col("temp_series"))).alias("pos", "v")), "bond_order", "pos", "v")


@query("roughness", f"with recursive {FEAT} select g, wi, ch bond_order, {q('rt')} temp, {q('rr')} resist from feat")
def roughness(spark, sf_dir):
    return shown(analysis(spark, sf_dir).slim, "bond_order", F.col("temp_roughness").alias("temp"), F.col("resist_roughness").alias("resist"))


@query("raw_roughness", f"with {WAVES}, d as (select *, t - lag(t) over (partition by g, wi, ch order by p) dt from c) select g, wi, ch bond_order, {q('stddev_pop(dt)')} temp from d group by g, wi, ch")
def raw_roughness(spark, sf_dir):
    """Roughness of the series itself, which the plots of a wafer show."""
    return shown(X.waveforms(spark, sf_dir).withColumn("temp", A.roughness(F.col("temp_series"))), "bond_order", "temp")


@query(
    "roughness_walkthrough",
    f"""with recursive {FEAT}, x as (select res.*, xt - lag(xt) over (partition by g, wi, ch order by p) dt from res)
    select x.g, x.wi, x.ch bond_order, (x.p - 1)::int pos, {q('c.t')} raw, {q('xt')} residual, {q('dt')} diff, {q('f.rt')} roughness
    from x join c on c.g = x.g and c.wi = x.wi and c.ch = x.ch and c.p = x.p join feat f on f.g = x.g and f.wi = x.wi and f.ch = x.ch""",
)
def roughness_walkthrough(spark, sf_dir):
    """A chip's way to its roughness in one table: raw value, residual, difference from the last one, and their spread."""
    at = R.features(analysis(spark, sf_dir).at, CFG.feature)
    diff = F.concat(F.array(F.lit(None).cast("double")), A.first_diff(F.col("temp_residual")))
    points = F.arrays_zip(F.col("temp_series").alias("a"), F.col("temp_residual").alias("b"), diff.alias("c"))
    rows = at.select("equipment_id", "wafer_seq", "bond_order", "temp_roughness", F.posexplode(points).alias("pos", "v"))
    return shown(rows, "bond_order", "pos", F.col("v.a").alias("raw"), F.col("v.b").alias("residual"), F.col("v.c").alias("diff"), F.col("temp_roughness").alias("roughness"))


@query(
    "roughness_normalized",
    f"""with recursive {FEAT} select g, wi, ch bond_order, {q('(rt - avg(rt) over w) / (stddev_pop(rt) over w + 1e-9)')} z from feat window w as (partition by g, wi)""",
)
def roughness_normalized(spark, sf_dir):
    rows = analysis(spark, sf_dir).slim
    return shown(rows.withColumn("z", A.normalized(F.col("temp_roughness"), Window.partitionBy("equipment_id", "wafer_seq"))), "bond_order", "z")


@query("spike", f"with recursive {FEAT} select g, wi, ch bond_order, {q('st')} temp, {q('sr')} resist from feat")
def spike(spark, sf_dir):
    return shown(analysis(spark, sf_dir).slim, "bond_order", F.col("temp_spike").alias("temp"), F.col("resist_spike").alias("resist"))


@query(
    "min_points_guard",
    f"""with {WAVES}, cut as (select g, wi, ch, case when ch % 2 = 0 then p - 1 else (p - 1) // 2 end p, avg(t) t from c group by all),
    dd as (select *, t - lag(t) over (partition by g, wi, ch order by p) dt from cut)
    select g, wi, ch bond_order, {q('case when ch % 2 = 1 then 0 else stddev_pop(dt) end')} rough from dd group by g, wi, ch""",
)
def min_points_guard(spark, sf_dir):
    """Odd chips are averaged to 8 points, which are too few for a roughness."""
    series = F.when(F.col("bond_order") % 2 == 0, F.col("temp_series")).otherwise(A.downsample(F.col("temp_series"), 8))
    chips = X.waveforms(spark, sf_dir).withColumn("temp_series", series).withColumn("temp_residual", F.col("temp_series"))
    return shown(R.features(chips, CFG.feature, two=False), "bond_order", F.col("temp_roughness").alias("rough"))


@query(
    "downsample",
    f"""with v as (select vec_id, unnest(embedding)::double e, generate_subscripts(embedding, 1) - 1 pos, len(embedding) n from embeddings),
    k as (select range i, case when range = 25 then 64 else (range * (64::double / 25))::double end e0 from range(0, 26)),
    edge as (select i, floor(e0)::int lo, lead(floor(e0)::int) over (order by i) hi from k)
    select vec_id, i::int pos, {q('avg(e)', 6)} v from v join edge on pos >= lo and pos < greatest(lo + 1, hi) where i < 25 group by vec_id, i""",
)
def downsample(spark, sf_dir):
    rows = X.table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    return rounded(rows.select("vec_id", F.posexplode(A.downsample(F.col("e"), 25)).alias("pos", "v")), 6)


@query(
    "residual_vector",
    f"""with recursive {FEAT}, b as (select g, wi, ch, ((p - 1) // 2)::int i, avg(xt) xt, avg(xr) xr from res group by all)
    select g, wi, ch bond_order, i pos, {q('xt')} v from b union all select g, wi, ch, i + 8, {q('xr')} from b""",
)
def residual_vector(spark, sf_dir):
    rows = M.vectors(analysis(spark, sf_dir).at, 8)
    return shown(rows.select("*", F.posexplode("vector").alias("pos", "v")), "bond_order", "pos", "v")


# references --------------------------------------------------------------------------------------------------------


def ready(spark, sf_dir):
    return R.chip_levels(R.pinned(R.with_epochs(X.waveforms(spark, sf_dir)), CFG.reference))


@query("pointwise_median_profile", f"with {WAVES} select g, wi, (p - 1)::int pos, {q('mt')} t, {q('mr')} r from med")
def pointwise_median_profile(spark, sf_dir):
    return shown(R.medians(ready(spark, sf_dir), [], True), "pos", "t", "r")


@query("mean_profile", f"with {WAVES} select g, wi, (p - 1)::int pos, {q('avg(t)')} t from c group by g, wi, p")
def mean_profile(spark, sf_dir):
    points = X.waveforms(spark, sf_dir).select("equipment_id", "wafer_seq", F.posexplode("temp_series").alias("pos", "v"))
    return shown(points.groupBy("equipment_id", "wafer_seq", "pos").agg(F.avg("v").alias("t")), "pos", "t")


@query("reference_ewma", f"with {WAVES} select g, wi, (p - 1)::int pos, {q('rt')} t, {q('rr')} r from ref")
def reference_ewma(spark, sf_dir):
    return shown(R.smoothed(R.medians(ready(spark, sf_dir), [], True), [], CFG.reference.alpha), "pos", "t", "r")


@query(
    "reference_asof_join",
    f"""with {WAVES} select a.g, a.wi, a.ch bond_order, (a.p - 1)::int pos, {q('a.t')} v, {q('ref.rt')} was from c a
    join ref on ref.g = a.g and ref.ep = a.ep and ref.k = a.k - 1 and ref.p = a.p""",
)
def reference_asof_join(spark, sf_dir):
    chips = ready(spark, sf_dir)
    at = R.with_reference(chips, R.references(chips, CFG.reference, two=False), two=False)
    both = F.arrays_zip(F.col("temp_series").alias("v"), F.col("temp_ref").alias("was"))
    return shown(at.select("*", F.posexplode(both).alias("pos", "b")), "bond_order", "pos", F.col("b.v").alias("v"), F.col("b.was").alias("was"))


@query("kmeans2_levels", f"with recursive {WAVES},{MEANS} select g, wi, {q('a')} a, {q('b')} b, {q('la')} la, {q('lb')} lb from bim")
def kmeans2_levels(spark, sf_dir):
    return shown(R.clusters(ready(spark, sf_dir)), "a", "b", "la", "lb")


@query("bimodal_flag", f"with recursive {WAVES},{MEANS} select g, wi, n::int n_chips, {q('sd')} spread, {q('sep')} separation, flag is_bimodal from bim")
def bimodal_flag(spark, sf_dir):
    return shown(R.clusters(ready(spark, sf_dir)), "n_chips", "spread", "separation", "is_bimodal")


@query("cluster_assign", f"with recursive {FEAT} select g, wi, ch bond_order, cl::int as cluster from own")
def cluster_assign(spark, sf_dir):
    return shown(analysis(spark, sf_dir).slim, "bond_order", "cluster")


@query("cluster_reference_ewma", f"with recursive {FEAT} select g, wi, cl::int as cluster, (p - 1)::int pos, {q('rt')} t, {q('rr')} r from cref")
def cluster_reference_ewma(spark, sf_dir):
    rows = R.references(ready(spark, sf_dir), CFG.reference).select("*", F.explode("cluster_refs").alias("c"))
    both = F.arrays_zip(F.col("c.temp_ref").alias("t"), F.col("c.resist_ref").alias("r"))
    rows = rows.select("*", F.posexplode(both).alias("pos", "v"))
    return shown(rows, F.col("c.cluster").alias("cluster"), "pos", F.col("v.t").alias("t"), F.col("v.r").alias("r"))


@query(
    "wafer_summary_stats",
    f"with recursive {FEAT} select g, wi, {q('avg(rr)')} mean, {q('max(rr)')} \"max\", {q('quantile_cont(rr, 0.9)')} p90 from feat group by g, wi",
)
def wafer_summary_stats(spark, sf_dir):
    return shown(D.summary_stats(analysis(spark, sf_dir).slim, "resist_roughness"), "mean", "max", "p90")


NOW = "over (partition by g, ep order by n rows unbounded preceding)"


@query(
    "roughness_baseline",
    f"""with recursive {FEAT} select g, wi, {q(f'avg(rt) {NOW}')} temp_mean, {q(f'case when count(*) {NOW} < 2 then 1 else greatest(stddev_samp(rt) {NOW}, 1e-9) end')} temp_std,
    {q(f'avg(rr) {NOW}')} resist_mean, {q(f'case when count(*) {NOW} < 2 then 1 else greatest(stddev_samp(rr) {NOW}, 1e-9) end')} resist_std from wf""",
)
def roughness_baseline(spark, sf_dir):
    return shown(analysis(spark, sf_dir).roughness_baseline(), "temp_mean", "temp_std", "resist_mean", "resist_std")


# detectors ---------------------------------------------------------------------------------------------------------

def cusum_ctes(v: str) -> str:
    return f"""o as (select *, row_number() over (partition by g, wi order by ch) rn, count(*) over (partition by g, wi) n from feat),
wu as (select g, wi, avg({v}) m, greatest(stddev_samp({v}), avg({v}) * 0.15e0, 1e-9) sd from o where rn <= 5 and n >= 10 group by g, wi),
zz as (select o.g, o.wi, o.wafer, o.ch, rn, n, m, sd, ({v} - m) / sd z from o join wu using (g, wi) where rn > 5),
pp as (select *, sum(z - 0.25e0) over (partition by g, wi order by rn rows unbounded preceding) tot from zz),
cu as (select *, tot - least(0, min(tot) over (partition by g, wi order by rn rows unbounded preceding)) s from pp)"""


CUSUM_SQL = f"{FEAT},\n{cusum_ctes('rr')}"


@query("cusum_chart", f"with recursive {CUSUM_SQL} select g, wi, ch bond_order, {q('z')} z, {q('s')} s, s > 1 is_alarm from cu")
def cusum_chart(spark, sf_dir):
    return shown(analysis(spark, sf_dir).cusum("resist"), "bond_order", "z", "s", "is_alarm")


@query(
    "intra_drift_events",
    f"""with recursive {CUSUM_SQL} select g, wi, wafer wafer_id, {q('max(s)')} severity, min(case when s > 1 then rn - 1 end)::int alarm_chip_index,
    any_value(n) n_chips, {q('any_value(m)')} warmup_mean, {q('any_value(sd)')} effective_std from cu group by g, wi, wafer having max(s) > 1""",
)
def intra_drift_events(spark, sf_dir):
    rows = D.intra(analysis(spark, sf_dir).cusum("resist")).where("is_alarm")
    return shown(rows, "wafer_id", F.col("cusum_peak").alias("severity"), "alarm_chip_index", "n_chips", "warmup_mean", "effective_std")


def inter_ctes(v: str) -> str:
    return f"""e as {O.ewma_sql('wf', v, 0.3, 'e')}, bl as (select *, {O.baseline_sql(v, 5)} from wf),
ch as (select bl.g, bl.wi, bl.wafer, bl.ep, n, {v} x, e, bm, bs, bm + 0.5e0 * bs lim, (e - bm) / bs sev, n >= 5 and e > bm + 0.5e0 * bs al from bl join e using (g, ep, n))"""


def ewma_ctes(feat: str) -> str:
    return f"{feat}, {inter_ctes('rt')}"


EWMA_SQL = ewma_ctes(FEAT)
EWMA_OUT = f"g, wi, n, {q('x')} x, {q('e')} ewma, {q('bm')} baseline_mean, {q('bs')} baseline_std, {q('lim')} control_limit, al is_alarm from ch"


def ewma_rows(a: Analysis) -> DataFrame:
    rows = a.ewma("temp").withColumn("n", F.col("n").cast("bigint"))
    return shown(rows, "n", F.col("temp_roughness").alias("x"), "ewma", "baseline_mean", "baseline_std", "control_limit", "is_alarm")


@query("ewma_chart", f"with recursive {EWMA_SQL} select {EWMA_OUT}")
def ewma_chart(spark, sf_dir):
    return ewma_rows(analysis(spark, sf_dir))


@query("inter_drift_events", f"with recursive {EWMA_SQL} select g, wi, wafer wafer_id, {q('sev')} severity from ch where al")
def inter_drift_events(spark, sf_dir):
    return shown(analysis(spark, sf_dir).ewma("temp").where("is_alarm"), "wafer_id", "severity")


PM_SQL = ewma_ctes(f"{O.waveform_ctes(CFG.reference.alpha, pm=True)},{MEANS},{O.cluster_ctes(CFG.reference.alpha)}")


@query("pm_reset_chart", f"with recursive {PM_SQL} select ep::bigint epoch, {EWMA_OUT}")
def pm_reset_chart(spark, sf_dir):
    rows = analysis(spark, sf_dir, pm=True).ewma("temp").withColumn("n", F.col("n").cast("bigint"))
    return shown(rows, "epoch", "n", F.col("temp_roughness").alias("x"), "ewma", "baseline_mean", "baseline_std", "control_limit", "is_alarm")


def _first(v: str) -> str:
    return f"case when n <= 5 then {v} end"


T2_CTES = f"""et as {O.ewma_sql('wf', 'rt', 0.3, 'et')}, er as {O.ewma_sql('wf', 'rr', 0.3, 'er')},
bl as (select *, avg({_first('rt')}) {NOW} mt, avg({_first('rr')}) {NOW} mr, coalesce(var_samp({_first('rt')}) {NOW}, 1) + 1e-6 a,
  coalesce(var_samp({_first('rr')}) {NOW}, 1) + 1e-6 c, coalesce(covar_samp({_first('rt')}, {_first('rr')}) {NOW}, 0) b from wf),
t2 as (select bl.g, bl.wi, bl.wafer, n, (c * (et - mt) ** 2 - 2 * b * (et - mt) * (er - mr) + a * (er - mr) ** 2) / (a * c - b * b) v
  from bl join et using (g, ep, n) join er using (g, ep, n)),
t as (select *, -2 * ln(0.5e0) lim, n >= 5 and v > -2 * ln(0.5e0) al from t2)"""
T2_SQL = f"{FEAT}, {T2_CTES}"


@query("t2_chart", f"with recursive {T2_SQL} select g, wi, {q('v')} t2, {q('lim')} control_limit, al is_alarm from t where n >= 3")
def t2_chart(spark, sf_dir):
    return shown(analysis(spark, sf_dir).t2().where("n >= 3"), "t2", "control_limit", "is_alarm")


@query("inter_drift_mv_events", f"with recursive {T2_SQL} select g, wi, wafer wafer_id, {q('v')} severity from t where al")
def inter_drift_mv_events(spark, sf_dir):
    return shown(analysis(spark, sf_dir).t2().where("is_alarm"), "wafer_id", F.col("t2").alias("severity"))


SPIKE_CTES = f"""md as (select g, wi, median(sr) med from feat group by g, wi),
th as (select feat.g, feat.wi, any_value(med) med, median(abs(sr - med)) mad from feat join md using (g, wi) group by feat.g, feat.wi),
tt as (select *, med + 1.5e0 * greatest(1.4826e0 * mad, 1e-9) lim from th),
sp as (select feat.*, lim, sr > lim al from feat join tt using (g, wi)),
rate as (select g, ep, wi, wafer, avg(al::int) v from sp group by all),
rz as (select *, count(*) over b nh, avg(v) over b hm, greatest(stddev_pop(v) over b, 1e-9) hs from rate
  window b as (partition by g, ep order by wi rows between unbounded preceding and 1 preceding)),
ra as (select *, (v - hm) / hs z, nh >= 4 and coalesce((v - hm) / hs > 0.5e0, false) al from rz)"""
SPIKE_SQL = f"{FEAT}, {SPIKE_CTES}"


@query("mad_threshold", f"with recursive {SPIKE_SQL} select g, wi, {q('med')} med, {q('mad')} mad, {q('lim')} threshold from tt")
def mad_threshold(spark, sf_dir):
    return shown(D.mad_thresholds(analysis(spark, sf_dir).features, CFG.spike), "med", "mad", "threshold")


@query("chip_spike_events", f"with recursive {SPIKE_SQL} select g, wi, wafer wafer_id, ch bond_order, (ch % 8)::int chip_x, (ch // 8)::int chip_y, {q('sr')} severity, {q('lim')} threshold from sp where al")
def chip_spike_events(spark, sf_dir):
    rows = analysis(spark, sf_dir).spikes().where("is_alarm")
    return shown(rows, "wafer_id", "bond_order", F.col("x").alias("chip_x"), F.col("y").alias("chip_y"), F.col("resist_spike").alias("severity"), "threshold")


@query("spike_rate_chart", f"with recursive {SPIKE_SQL} select g, wi, {q('v')} spike_rate, {q('hm')} historical_mean_rate, nh n_history, al is_alarm from ra")
def spike_rate_chart(spark, sf_dir):
    return shown(analysis(spark, sf_dir).spike_rates(), "spike_rate", "historical_mean_rate", "n_history", "is_alarm")


@query("spike_rate_events", f"with recursive {SPIKE_SQL} select g, wi, wafer wafer_id, {q('z')} severity from ra where al")
def spike_rate_events(spark, sf_dir):
    return shown(analysis(spark, sf_dir).spike_rates().where("is_alarm"), "wafer_id", F.col("z_score").alias("severity"))


DIST_CTES = f"""ok as (select * from bim where n >= 10 and sd >= 1e-9 and sep > 0.15e0 and k > 1),
pr as (select c.g, c.ep, c.wi, c.wafer, c.p, avg(t) filter (where not abs(level - lb) < abs(level - la)) p0, avg(t) filter (where abs(level - lb) < abs(level - la)) p1
  from c join ok on ok.g = c.g and ok.wi = c.wi join lev on lev.g = c.g and lev.wi = c.wi and lev.ch = c.ch group by all),
ds as (select g, ep, wi, wafer, sqrt(avg((p0 - p1) ** 2)) x, row_number() over (partition by g, ep order by wi) n from pr group by g, ep, wi, wafer),
e as {O.ewma_sql('ds', 'x', 0.3, 'e')}, bl as (select *, {O.baseline_sql('x', 5)} from ds),
cp as (select bl.*, e, (e - bm) / bs z, n >= 5 and (e - bm) / bs > 0.3e0 al from bl join e using (g, ep, n))"""
DIST_SQL = f"{WAVES},{MEANS}, {DIST_CTES}"


@query("coupling_distance", f"with recursive {DIST_SQL} select g, wi, {q('x')} distance from ds")
def coupling_distance(spark, sf_dir):
    chips = ready(spark, sf_dir)
    return shown(D.coupling_distances(chips, R.clusters(chips)), "distance")


@query("coupling_chart", f"with recursive {DIST_SQL} select g, wi, {q('e')} ewma_distance, {q('bm')} baseline_mean, {q('bs')} baseline_std, {q('z')} z_score, al is_alarm from cp")
def coupling_chart(spark, sf_dir):
    chips = ready(spark, sf_dir)
    rows = D.coupling_chart(D.coupling_distances(chips, R.clusters(chips)), CFG.coupling)
    return shown(rows, "ewma_distance", "baseline_mean", "baseline_std", "z_score", "is_alarm")


# models ------------------------------------------------------------------------------------------------------------


def _vectors(spark, sf_dir, cfg: Config) -> Analysis:
    return Analysis(materialize(X.vectors(spark, sf_dir), "chips"), cfg, stored=True)


@query("autoencoder_fit_score")
def autoencoder_fit_score(spark, sf_dir):
    return shown(_vectors(spark, sf_dir, CFG).autoencoder(), "model", "bond_order", "reconstruction_error", "threshold", "is_alarm")


@query("autoencoder_retrain")
def autoencoder_retrain(spark, sf_dir):
    from dataclasses import replace

    cfg = replace(CFG, autoencoder=replace(CFG.autoencoder, retrain=3))
    return shown(_vectors(spark, sf_dir, cfg).autoencoder(), "model", "bond_order", "reconstruction_error", "threshold", "is_alarm")


@query("mp_fit_score")
def mp_fit_score(spark, sf_dir):
    return shown(_vectors(spark, sf_dir, CFG).spectrum("temp"), "model", "bond_order", "mp_score", "threshold", "k_signal", "k_noise", "is_alarm")


@query("mp_retrain")
def mp_retrain(spark, sf_dir):
    from dataclasses import replace

    cfg = replace(CFG, spectrum=replace(CFG.spectrum, retrain=3))
    return shown(_vectors(spark, sf_dir, cfg).spectrum("resist"), "model", "bond_order", "mp_score", "threshold", "is_alarm")


@query("chi2_threshold", "select a alpha, round(-2 * ln(a), 6) + 0.0 as \"limit\" from (values (0.01e0), (0.05e0), (0.2e0)) v(a)")
def chi2_threshold(spark, sf_dir):
    rows = [(a, M.chi2_limits(spark, a, 2)[1]) for a in (0.01, 0.05, 0.2)]
    return rounded(spark.createDataFrame(rows, "alpha double, limit double"), 6)


# runs --------------------------------------------------------------------------------------------------------------

TODAY = dt.date(2024, 2, 20)
RUN_TS = dt.datetime(2024, 2, 20, 9, 30)
LOOK = Lookback(least_wafers=9, days=30, chunk_days=7)
ROUTE = 14
LOOK_SQL = f"""{CHIP_SQL}, wl as (select distinct equipment_id, recipe, head, wafer_id, first_ts from ck),
ag as (select *, date_diff('day', first_ts::date, date '{TODAY - dt.timedelta(days=1)}') age from wl),
cn as (select *, (age // 7)::int as chunk from ag where age >= 0 and first_ts::date >= date '{TODAY - dt.timedelta(days=30)}'),
st as (select r.range c from range(0, 6) r where exists (select 1 from cn where chunk <= r.range) and not exists (
  select 1 from (select equipment_id, recipe, head, count(*) n from cn where chunk <= r.range group by all) where n < 9)),
hist as (select * from cn where chunk <= coalesce((select min(c) from st), 99))"""


def _wafers(spark, sf_dir):
    return ingest.chips_from_rows(X.raw_rows(spark, sf_dir)).select(*GROUP, "wafer_id", "wafer_seq", "first_ts").distinct()


@query("lookback_selection", f"with {LOOK_SQL} select equipment_id, recipe, head, wafer_id, chunk from hist")
def lookback_selection(spark, sf_dir):
    return ingest.lookback(_wafers(spark, sf_dir), TODAY, LOOK).select(*GROUP, "wafer_id", "chunk")


BOOT_SQL = LOOK_SQL.replace(f"date '{TODAY - dt.timedelta(days=1)}') age from wl", f"date '{TODAY}') age from wl where first_ts <= timestamp '{RUN_TS}'")


@query("bootstrap_selection", f"with {BOOT_SQL} select equipment_id, recipe, head, wafer_id, chunk from hist")
def bootstrap_selection(spark, sf_dir):
    """A first run's history: today is part of it, up to the time of the run."""
    return ingest.lookback(_wafers(spark, sf_dir), TODAY, LOOK, RUN_TS).select(*GROUP, "wafer_id", "chunk")


@query(
    "baseline_policy",
    f"""with {LOOK_SQL}, h as (select equipment_id, recipe, head, count(*) n from hist group by all),
    t as (select equipment_id, recipe, head, count(*) n from wl where first_ts::date = date '{TODAY}' group by all)
    select equipment_id, recipe, head, coalesce(h.n, 0)::bigint n_history, coalesce(t.n, 0)::bigint n_today,
    case when coalesce(h.n, 0) >= {ROUTE} then 'full' when h.n > 0 then 'partial' else 'today' end route from h full join t using (equipment_id, recipe, head)""",
)
def baseline_policy(spark, sf_dir):
    wafers = _wafers(spark, sf_dir)
    return ingest.baseline_policy(ingest.lookback(wafers, TODAY, LOOK), wafers.where(F.to_date("first_ts") == F.lit(TODAY)), ROUTE)


@query("building_ready_gate", f"with recursive {EWMA_SQL} select g, wi, wafer wafer_id, {q('sev')} severity from ch where al and wi > 8")
def building_ready_gate(spark, sf_dir):
    a = analysis(spark, sf_dir)
    found = a.ewma("temp").where("is_alarm")
    return shown(ingest.ready_only(found, X.waveforms(spark, sf_dir), 8), "wafer_id", "severity")


@query(
    "group_summary",
    f"""with recursive {EWMA_SQL}, w as (select g, wi from wo), n as (select g, count(*) a from ch where al group by g)
    select g || '|R1|H1' group_key, case when count(*) >= 5 then 'ready' else 'building' end status, count(*) n_wafers_seen_total,
    count(*) filter (where wi > 2) n_new_wafers_this_run, count(*) filter (where wi > 2 and wi <= 5) n_building_this_run,
    count(*) filter (where wi > 5) n_ready_this_run, coalesce(any_value(a), 0)::bigint anomalies_this_run from w left join n using (g) group by g""",
)
def group_summary(spark, sf_dir):
    return sinks.group_summary(X.waveforms(spark, sf_dir), analysis(spark, sf_dir).ewma("temp").where("is_alarm"), 5, new_after=2)


RUN_SQL = f"""{EWMA_SQL}, known(eqp_id) as (values ('F0'), ('O0'), ('Z9')), r as (select g eqp_id, count(*) n_rows from pts group by 1),
  gg as (select g eqp_id, count(distinct (wi, ch)) n_chips, count(distinct wi) n_wafers from c group by 1), a as (select g eqp_id, count(*) n from ch where al group by 1),
  rs as (select eqp_id, coalesce(n_rows, 0)::bigint n_rows, coalesce(n_chips, 0)::bigint n_chips, coalesce(n_wafers, 0)::bigint n_wafers,
    coalesce(n, 0)::bigint n_anomalies, case when n_rows is null then 'no_data' else 'success' end status
    from known left join r using (eqp_id) left join gg using (eqp_id) left join a using (eqp_id))"""


def _summary(spark, sf_dir):
    """Each line item is a raw row; the equipment Z9 has none."""
    a = analysis(spark, sf_dir)
    raw = X.table(spark, sf_dir, "lineitem").select(X.equipment().alias("eqp_id"), F.col("l_extendedprice").alias("temp_raw"))
    return sinks.run_summary(spark.createDataFrame([("F0",), ("O0",), ("Z9",)], "eqp_id string"), raw, a.source, a.ewma("temp").where("is_alarm"))


@query("run_summary", f"with recursive {RUN_SQL} select * from rs")
def run_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@query("run_totals", f"with recursive {RUN_SQL} select count(*) n_equipment, sum(n_wafers)::bigint n_wafers, sum(n_chips)::bigint n_chips, sum(n_anomalies)::bigint n_anomalies from rs")
def run_totals(spark, sf_dir):
    return sinks.run_totals(_summary(spark, sf_dir))


def _stream(ctes: str, kind: str, channel: str, value: str, rest: str) -> str:
    return f"select * from (with {ctes} select g, wi, wafer, '{kind}' k, '{channel}' c, {value} v from {rest})"


#: The nine streams of a run but for the last, the autoencoder's, which SQL cannot fit.
UNION_SQL = f"{FEAT}, ev as ({' union all '.join([
    *[_stream(cusum_ctes(v), 'intra_drift', c, 'max(s)', 'cu group by g, wi, wafer having max(s) > 1') for v, c in (('rt', 'temp'), ('rr', 'resist'))],
    _stream(SPIKE_CTES, 'spike', 'resist', 'sr', 'sp where al'), _stream(SPIKE_CTES, 'spike', 'resist', 'z', 'ra where al'),
    *[_stream(inter_ctes(v), 'inter_drift', c, 'sev', 'ch where al') for v, c in (('rr', 'resist'), ('rt', 'temp'))],
    _stream(T2_CTES, 'inter_drift_mv', 'both', 'v', 't where al'), _stream(DIST_CTES, 'coupling', 'both', 'z', 'cp where al'),
])})"


def _events(spark, sf_dir):
    return analysis(spark, sf_dir, once=False).events(models=False)


@query("event_union", f"with recursive {UNION_SQL} select g, wi, wafer wafer_id, k anomaly_type, c channel, {q('v')} severity from ev")
def event_union(spark, sf_dir):
    return shown(_events(spark, sf_dir), "wafer_id", "anomaly_type", "channel", "severity")


@query(
    "event_string",
    f"with recursive {UNION_SQL} select format('[{{}}] wafer={{}} group={{}}/R1/H1 channel={{}} severity={{:.3f}}', upper(k), wafer, g, c, v) as text from ev",
)
def event_string(spark, sf_dir):
    return D.event_text(_events(spark, sf_dir)).select("text")


@query(
    "first_anomalies",
    f"""with recursive {EWMA_SQL}, x as (select *, row_number() over (partition by g order by wi) as rank from ch where al)
    select g, wi, wafer wafer_id, rank::int as rank, {q('sev')} severity from x where rank <= 5""",
)
def first_anomalies(spark, sf_dir):
    rows = D.events(analysis(spark, sf_dir).ewma("temp"), "inter_drift", "temp", "severity", ["ewma"])
    return shown(sinks.first_events(rows), "wafer_id", "rank", "severity")


@query("group_key_string", f"with {CHIP_SQL} select distinct equipment_id || '|' || recipe || '|' || head group_key from ck")
def group_key_string(spark, sf_dir):
    return ingest.chips_from_rows(X.raw_rows(spark, sf_dir)).select(ingest.group_text().alias("group_key")).distinct()


def _temperature(spark, sf_dir) -> DataFrame:
    return materialize(X.waveforms(spark, sf_dir).drop("resist_series"), "chips")


def _loaded(spark, states: DataFrame) -> DataFrame:
    path = new_path(spark, "baseline")
    sinks.baseline_json(states, path, CFG)
    return sinks.load_baseline(spark, path)


HALF = 14  # wafers before the baseline document is written, or that are its history


def baseline_out(rows: DataFrame) -> DataFrame:
    rows = rows.select(F.col("equipment_id").alias("g"), "reference", "inter_wafer_state", F.posexplode("reference.temp_ref").alias("pos", "v"))
    kept = [f"inter_wafer_state.{c}" for c in ("ewma_value", "baseline_mean", "baseline_std", "n_samples")]
    return rounded(rows.select("g", "pos", "v", "reference.n_wafers_seen", *kept))


@query(
    "baseline_json_roundtrip",
    f"""with recursive {ewma_ctes(f"{O.waveform_ctes(CFG.reference.alpha)},{MEANS},{O.cluster_ctes(CFG.reference.alpha)}")},
    l as (select g, max(wi) wi, count(*) nw from wo group by g), lastch as (select ch.* from ch join l using (g, wi))
    select l.g, (ref.p - 1)::int pos, {q('ref.rt')} v, nw::int n_wafers_seen, {q('e')} ewma_value, {q('bm')} baseline_mean, {q('bs')} baseline_std, 5 n_samples
    from l join ref on ref.g = l.g and ref.wi = l.wi join lastch on lastch.g = l.g""",
)
def baseline_json_roundtrip(spark, sf_dir):
    return baseline_out(_loaded(spark, analysis(spark, sf_dir, once=False).states()))


@query("csv_sink_roundtrip", f"with recursive {UNION_SQL} select g eqp_id, 'R1' recipe, 'H1' head, wafer wafer_id, k anomaly_type, {q('v')} severity from ev")
def csv_sink_roundtrip(spark, sf_dir):
    path = new_path(spark, "events-csv")
    sinks.write_events(_events(spark, sf_dir), path)
    schema = "eqp_id string, recipe string, head string, wafer_id string, anomaly_type string, severity double, details string"
    return rounded(spark.read.csv(path, schema=schema, header=True, escape='"').drop("details"))


# streaming ---------------------------------------------------------------------------------------------------------

TEMP_SQL = f"""{WAVES},
res as (select c.g, c.ep, c.wi, c.k, c.wafer, c.ch, c.p, c.t - ref.rt xt from c join ref on ref.g = c.g and ref.k = c.k - 1 and ref.p = c.p),
d as (select *, xt - lag(xt) over (partition by g, wi, ch order by p) dt from res),
feat as (select g, ep, wi, k, wafer, ch, stddev_pop(dt) rt from d group by all),
wf as (select g, ep, wi, k - 1 n, wafer, avg(rt) rt, count(*) nc from feat group by all),
e as {O.ewma_sql('wf', 'rt', 0.3, 'e')}, bl as (select *, {O.baseline_sql('rt', 5)} from wf),
ch as (select bl.g, bl.wi, bl.wafer, n, nc, rt x, e, bm, bs, n >= 5 and e > bm + 0.5e0 * bs al from bl join e using (g, ep, n))"""
STREAM_OUT = f"g, wi, wafer wafer_id, nc::int n_chips, {q('x')} roughness, {q('e')} ewma, {q('bm')} baseline_mean, {q('bs')} baseline_std, al inter_alarm from ch"


def _streamed(spark, sf_dir, runs: int, files: int | None = None, gap: str | None = None) -> DataFrame:
    """Chips arrive in ``runs`` files; each run starts a query anew from the checkpoint.

    With a ``gap`` a file may end within a wafer, and a last row of another equipment, a gap later, closes what is open.
    """
    source, out, mark = (new_path(spark, f"stream-{x}") for x in ("source", "out", "checkpoint"))
    chips = materialize(X.waveforms(spark, sf_dir).drop("resist_series"), "chips")
    last = chips.agg(F.max("wafer_seq")).first()[0] or 0
    half = 0.5 if gap else 0.0
    place = F.col("wafer_seq") + F.when(F.col("bond_order") % 2 == 1, 0.0).otherwise(half)
    for i in range(runs):
        low, high = last * i // runs + half, last * (i + 1) // runs + (half if i < runs - 1 else 1.0)
        part = chips.where((place > (low if i else 0)) & (place <= high))
        if gap and i == runs - 1:
            close = chips.limit(1).withColumns({"equipment_id": F.lit("none"), "first_ts": F.lit(dt.datetime(2100, 1, 1)), "temp_series": F.array().cast("array<double>")})
            part = part.unionByName(close)
        part.coalesce(1 if gap else 4).write.mode("append").parquet(source)
        if not gap:
            stateful.run_available(stateful.track(stateful.chips_of(spark, source, chips.schema, files), CFG), out, mark)
    if gap:
        stateful.run_available(stateful.track(stateful.chips_of(spark, source, chips.schema, files), CFG, gap=gap), out, mark)
    rows = spark.read.schema(stateful.CHART).parquet(out)
    return shown(rows, "wafer_id", "n_chips", "roughness", "ewma", "baseline_mean", "baseline_std", "inter_alarm")


@query("baseline_resume", f"with {TEMP_SQL} select g, wi, wafer wafer_id, {q('x')} roughness, {q('e')} ewma, {q('bm')} baseline_mean, {q('bs')} baseline_std, al is_alarm from ch where wi > {HALF}")
def baseline_resume(spark, sf_dir):
    """Half of the wafers make a baseline document; a second run loads it and goes on, as one run would."""
    chips = _temperature(spark, sf_dir)
    start = _loaded(spark, B.initialize(chips.where(F.col("wafer_seq") <= HALF), CFG))
    rows = B.resume(chips.where(F.col("wafer_seq") > HALF), start, CFG, once=True).ewma()
    return shown(rows, "wafer_id", F.col("temp_roughness").alias("roughness"), "ewma", "baseline_mean", "baseline_std", "is_alarm")


@query(
    "baseline_build",
    f"""with {TEMP_SQL}, last as (select g, max(wi) filter (where g <> 'F0' or wi <= 3) wi from wo group by g),
    tr as (select ch.* from ch join (select ch.g, max(ch.wi) wi from ch join last using (g) where ch.wi <= case when ch.g = 'F0' then 3 else {HALF} end group by 1) m using (g, wi))
    select r.g, (r.p - 1)::int pos, {q('r.rt')} v, (case when r.g = 'F0' then nw else {HALF} end)::int n_wafers_seen, {q('tr.e')} ewma_value, {q('tr.bm')} baseline_mean,
    {q('tr.bs')} baseline_std, least(5, tr.n)::int n_samples
    from (select g, count(*) nw from wo group by g) l join ref r on r.g = l.g and r.wi = case when l.g = 'F0' then nw else {HALF} end left join tr on tr.g = l.g""",
)
def baseline_build(spark, sf_dir):
    """A baseline by route: F0 has three wafers of history, so today's later ones go into its reference only."""
    chips = _temperature(spark, sf_dir)
    few = F.col("equipment_id") == "F0"
    old = F.col("wafer_seq") <= F.when(few, 3).otherwise(HALF)
    return baseline_out(_loaded(spark, B.build(chips.where(old), chips.where(~old), CFG, 5)))


@query("stream_state_pipeline", f"with {TEMP_SQL} select {STREAM_OUT}")
def stream_state_pipeline(spark, sf_dir):
    return _streamed(spark, sf_dir, 1)


@query("stream_watermark_incremental", f"with {TEMP_SQL} select {STREAM_OUT}")
def stream_watermark_incremental(spark, sf_dir):
    return _streamed(spark, sf_dir, 3)


@query("stream_event_time", f"with {TEMP_SQL} select {STREAM_OUT}")
def stream_event_time(spark, sf_dir):
    """One file to a batch, wafers spread over files: event time closes them."""
    return _streamed(spark, sf_dir, 4, files=1, gap="1 day")


# generators --------------------------------------------------------------------------------------------------------

SIM = Config()


def _simulated(spark, plan) -> DataFrame:
    """All detectors' events at the defaults, on generated production."""
    return Analysis(simulate.wafers(spark, plan), SIM).events().drop("details")


@query("sim_normal")
def sim_normal(spark, sf_dir):
    return _simulated(spark, simulate.normal(20))


@query("sim_drift")
def sim_drift(spark, sf_dir):
    return _simulated(spark, simulate.drift())


@query("sim_coupling")
def sim_coupling(spark, sf_dir):
    return _simulated(spark, simulate.coupling_breakdown())


@query("sim_vibration")
def sim_vibration(spark, sf_dir):
    return _simulated(spark, simulate.vibration())


@query("sim_spikes")
def sim_spikes(spark, sf_dir):
    return _simulated(spark, simulate.spikes())


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EWMA chart of the mean temperature roughness over yearly wafers."""
    from dataclasses import replace

    cfg = replace(CFG, inter=Inter(0.3, 0.5, 3))
    return ewma_rows(Analysis(materialize(X.waveforms(spark, sf_dir, "year"), "chips"), cfg, stored=True, once=True))

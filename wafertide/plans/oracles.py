"""DuckDB SQL for the catalog: common table expressions that restate the operators over exploded points."""

from __future__ import annotations

from .fixtures import POINTS, SCALE, SUPPLIERS


def waveform_ctes(alpha: float, pm: bool = False) -> str:
    """Exploded chips ``c``, levels ``lev``, epochs ``wo`` and whole-wafer references ``ref``."""
    epoch = "sum(case when wi % 9 = 0 then 1 else 0 end) over (partition by g order by wi)" if pm else "0"
    keep = 1 - alpha
    return f"""
pts as (select g, w, part, t, r, row_number() over (partition by g, w, part
    order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 rn, count(*) over (partition by g, w, part) n
  from (select *, l_linestatus || (l_suppkey // {SUPPLIERS})::varchar g, date_trunc('quarter', l_shipdate) w, (l_partkey % 32)::int part,
    l_extendedprice * {SCALE}e0 t, l_quantity * {SCALE}e0 r from lineitem)),
sl as (select *, part + 32 * ((rn * greatest(1, n // {POINTS})) // n)::int ch from pts),
sq as (select g, w, ch, t, r, row_number() over (partition by g, w, ch order by rn) - 1 q, count(*) over (partition by g, w, ch) m from sl),
bl16 as (select *, (i * m) // {POINTS} lo, greatest((i * m) // {POINTS} + 1, ((i + 1) * m) // {POINTS}) hi
  from (select *, unnest(range(0, {POINTS})) i from (select distinct g, w, ch, m from sq))),
s as (select g, w, ch, i + 1 p, avg(t) t, avg(r) r from bl16 join sq using (g, w, ch) where q >= lo and q < hi group by g, w, ch, i),
wn as (select g, w, row_number() over (partition by g order by w) wi from (select distinct g, w from s)),
wo as (select g, w, wi, ep, row_number() over (partition by g, ep order by wi) k from (select *, {epoch} ep from wn)),
c as (select s.g, ep, wi, k, strftime(s.w, '%Y-%m-%d') wafer, ch, p, t, r from s join wo on s.g = wo.g and s.w = wo.w),
med as (select g, ep, wi, k, p, median(t) mt, median(r) mr from c group by all),
ref as (select a.g, a.ep, a.wi, a.k, a.p,
  sum(b.mt * case when b.k = 1 then power({keep}e0, a.k - 1) else {alpha}e0 * power({keep}e0, a.k - b.k) end) rt,
  sum(b.mr * case when b.k = 1 then power({keep}e0, a.k - 1) else {alpha}e0 * power({keep}e0, a.k - b.k) end) rr
  from med a join med b on a.g = b.g and a.ep = b.ep and a.p = b.p and b.k <= a.k group by all),
lev as (select g, ep, wi, k, wafer, ch, avg(r) level from c group by all)"""


def two_means_ctes(least: int = 10, separation: float = 0.15) -> str:
    """Final centres ``km`` (a, b) and label centres (la, lb) by wafer, with ``bim``; and cluster references' inputs."""
    return f"""
km0 as (select g, ep, wi, k, min(level) + (max(level) - min(level)) * 0.33e0 a, min(level) + (max(level) - min(level)) * 0.66e0 b,
  stddev_pop(level) sd, count(*) n from lev group by all),
it(g, wi, i, a, b, la, lb, done) as (
  select g, wi, 0, a, b, a, b, false from km0
  union all
  select g, wi, i + 1, case when still then a else x end, case when still then b else y end, a, b, still from (
    select *, abs(x - a) < 1e-9 and abs(y - b) < 1e-9 still from (
      select it.g, it.wi, it.i, it.a, it.b,
        coalesce(avg(level) filter (where not abs(level - it.b) < abs(level - it.a)), it.a) x,
        coalesce(avg(level) filter (where abs(level - it.b) < abs(level - it.a)), it.b) y
      from it join lev on it.g = lev.g and it.wi = lev.wi where not it.done and it.i < 50 group by it.g, it.wi, it.i, it.a, it.b))),
km as (select g, wi, arg_max(a, i) a, arg_max(b, i) b, arg_max(la, i) la, arg_max(lb, i) lb from it group by g, wi),
bim as (select km0.g, ep, km0.wi, k, n, sd, km.a, km.b, la, lb, (km.b - km.a) / (sd + 1e-9) sep,
  n >= {least} and (km.b - km.a) / (sd + 1e-9) > {separation}e0 flag from km0 join km on km0.g = km.g and km0.wi = km.wi)"""


def cluster_ctes(alpha: float) -> str:
    keep = 1 - alpha
    return f"""
lab as (select lev.*, case when abs(level - lb) < abs(level - la) then 1 else 0 end cl from lev join bim using (g, wi) where flag),
bk as (select g, ep, wi, row_number() over (partition by g, ep order by wi) bn from bim where flag),
cmed as (select c.g, c.ep, c.wi, bn, cl, p, median(t) mt, median(r) mr
  from c join lab on c.g = lab.g and c.wi = lab.wi and c.ch = lab.ch join bk on bk.g = c.g and bk.wi = c.wi group by all),
cref as (select a.g, a.ep, a.wi, a.cl, a.p,
  sum(b.mt * case when b.bn = 1 then power({keep}e0, a.bn - 1) else {alpha}e0 * power({keep}e0, a.bn - b.bn) end) rt,
  sum(b.mr * case when b.bn = 1 then power({keep}e0, a.bn - 1) else {alpha}e0 * power({keep}e0, a.bn - b.bn) end) rr
  from cmed a join cmed b on a.g = b.g and a.ep = b.ep and a.cl = b.cl and a.p = b.p and b.bn <= a.bn group by all),
own as (select lev.g, lev.ep, lev.wi, lev.k, lev.wafer, lev.ch, prev.wi pw, prev.flag,
  case when prev.flag and abs(level - prev.b) < abs(level - prev.a) then 1 else 0 end cl
  from lev join bim prev on prev.g = lev.g and prev.ep = lev.ep and prev.k = lev.k - 1),
res as (select c.g, c.ep, c.wi, c.k, c.wafer, c.ch, c.p, own.cl, c.t - coalesce(cref.rt, ref.rt) xt, c.r - coalesce(cref.rr, ref.rr) xr
  from c join own on c.g = own.g and c.wi = own.wi and c.ch = own.ch
  join ref on ref.g = own.g and ref.wi = own.pw and ref.p = c.p
  left join cref on own.flag and cref.g = own.g and cref.wi = own.pw and cref.cl = own.cl and cref.p = c.p),
d as (select *, xt - lag(xt) over o dt, xr - lag(xr) over o dr from res window o as (partition by g, wi, ch order by p)),
feat as (select g, ep, wi, k, wafer, ch, cl, stddev_pop(dt) rt, stddev_pop(dr) rr, max(abs(xt)) st, max(abs(xr)) sr from d group by all),
wf as (select g, ep, wi, k - 1 n, wafer, avg(rt) rt, avg(rr) rr, count(*) nc from feat group by all)"""


def ewma_sql(source: str, value: str, weight: float, out: str, keys: str = "g, ep", order: str = "n") -> str:
    """A table of the exponentially weighted mean of ``value`` along ``order``, which counts from 1."""
    on = " and ".join(f"a.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    share = f"case when b.{order} = 1 then power({1 - weight}e0, a.{order} - 1) else {weight}e0 * power({1 - weight}e0, a.{order} - b.{order}) end"
    cols = ", ".join(f"a.{k.strip()}" for k in keys.split(","))
    return f"(select {cols}, a.{order}, sum(b.{value} * {share}) {out} from {source} a join {source} b on {on} and b.{order} <= a.{order} group by all)"


def baseline_sql(value: str, size: int) -> str:
    """Columns bm and bs: mean and floored sample spread of the first ``size`` values so far."""
    now = "over (partition by g, ep order by n rows unbounded preceding)"
    first = f"case when n <= {size} then {value} end"
    return f"avg({first}) {now} bm, case when count({first}) {now} < 2 then 1.0 else greatest(stddev_samp({first}) {now}, 1e-9) end bs"

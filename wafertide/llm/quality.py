"""Quality rules with host verdicts, in DataFrame functions only.

Per document: counts over its words and lines and a base verdict.  Per host (the ``source`` column): failures are
counted, the rate is shrunk with a beta prior fitted to all hosts by moments, and a host whose shrunk rate passes
``most`` is rejected; the verdict is joined back to its documents.  Counts combine before their shuffle, so a hot
host costs no more than another, and only ids and counts are shuffled, never texts.

Words are runs of characters other than space and U+0009-U+000D.  Repeated 3-word windows are compared by a 64-bit
hash of the three words.

Defined results: a null text has no word and no line, so it fails.  Documents without a host have no host verdict.
Repeated rows are judged and counted each for itself.  An empty table gives no row.  Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, written

SPACES = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class Settings:
    least_words: int = 50
    most_repeated: int = 50  # percent of the words
    most: float = 0.5  # a host is rejected above this shrunk failure rate
    strongest: float = 1e6  # of the prior, in documents, where hosts do not differ


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def let(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once for ``body``; an alias of a projection may be inlined into a lambda instead."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def repeated_words(w: str) -> str:
    """SQL for the number of words of the array ``w`` in 3-word windows that occur twice or more.

    Windows sorted by hash stand beside their equals; only texts with a repeated window are sorted.
    """
    hashes = (
        f"case when size({w}) < 3 then cast(array() as array<bigint>) else transform(sequence(0, size({w}) - 3), "
        f"i -> xxhash64(get({w}, i), get({w}, i + 1), get({w}, i + 2))) end"
    )
    sort = "sort_array(transform(h, (x, i) -> struct(x as x, i as i)))"
    beside = "filter(s, (e, i) -> e.x <=> get(s, i - 1).x or e.x <=> get(s, i + 1).x)"
    covered = "aggregate(transform(p, (e, i) -> if(i = 0, 3, least(3, e - get(p, i - 1)))), 0, (a, e) -> a + e)"
    places = let("s", sort, let("p", f"sort_array(transform({beside}, e -> e.i))", covered))
    return let("h", hashes, f"case when size(array_distinct(h)) = size(h) then 0 else {places} end")


def word_counts(cfg: Settings) -> Column:
    """A struct of the counts over the words of the column ``text`` and the base verdict."""
    failed = f"n < {cfg.least_words} or 100L * r > {cfg.most_repeated}L * n"
    found = (
        "named_struct('n_words', cast(n as bigint), 'word_chars', cast(length(array_join(w, '')) as bigint), "
        f"'n_repeat_words', cast(r as bigint), 'base_failed', {failed})"
    )
    spaced = "translate(coalesce(text, ''), ' \\t\\n\\u000B\\u000C\\r', '      ')"
    split = f"array_remove(split({spaced}, ' '), '')"
    return F.expr(let("w", split, let("n", "size(w)", let("r", repeated_words("w"), found))))


def repeated_lines() -> Column:
    blank = "' \\t\\n\\u000B\\u000C\\r'"
    lines = f"filter(split(coalesce(text, ''), '\\n'), x -> length(btrim(x, {blank})) > 0)"
    return F.expr(let("l", lines, "cast(size(l) - size(array_distinct(l)) as bigint)"))


def rejected_hosts(judged: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """``host`` of the rejected hosts, from ``host, base_failed`` rows.

    The prior's mean is the overall rate m; its strength M solves m(1 - m) / (M + 1) = the variance between hosts,
    estimated from the weighted squares of the host rates.  A host's shrunk rate is (failed + mM) / (documents + M).
    """
    hosts = (
        judged.where(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").cast("double").alias("n"), F.sum(F.col("base_failed").cast("double")).alias("failed"))
    )
    total = hosts.agg(
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
        F.sum("failed").alias("failed"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("rr"),
    )
    m = F.col("failed") / F.col("n")
    spread = F.col("rr") - F.col("n") * m * m
    room = F.col("n") - F.col("nn") / F.col("n") - (F.col("k") - 1)
    between = F.when(room > 0, (spread - (F.col("k") - 1) * m * (1 - m)) / room).otherwise(F.lit(0.0))
    strength = F.when(between <= 0, F.lit(cfg.strongest)).otherwise(
        F.least(F.lit(cfg.strongest), F.greatest(F.lit(1.0), m * (1 - m) / between - 1))
    )
    prior = total.where("n > 0").select(m.alias("m"), strength.alias("s")).first()  # two numbers
    if prior is None:
        return hosts.select("host").where("false")
    shrunk = (F.col("failed") + prior["m"] * prior["s"]) / (F.col("n") + prior["s"])
    return hosts.where(shrunk > cfg.most).select("host")


def judge(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """One row per document: its id, the counts, ``base_failed`` and ``kept``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    symbols = (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long")
    rows = docs.select(
        "doc_id",
        F.col("source").alias("host"),
        word_counts(cfg).alias("m"),
        symbols.alias("n_symbols"),
        repeated_lines().alias("n_dup_lines"),
    )
    rows = written(rows.select("doc_id", "host", "m.*", "n_symbols", "n_dup_lines"), "quality")
    bad = written(rejected_hosts(rows, cfg), "hosts").withColumn("rejected", F.lit(True))
    return rows.join(bad, "host", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("rejected").isNull()).alias("kept"),
    )


def keep_good(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """The documents, all columns, that pass their own rules and whose host is not rejected.

    The rows are written once with their base verdict, so the words of each text are counted once; hosts read two slim
    columns of that table.  Of a failed row only those are kept.
    """
    host, of, failed = fresh(docs, "__host", "__of", "__failed")
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(*names, F.col("source").alias(of), F.explode(F.array(word_counts(cfg)["base_failed"])).alias(failed))
    rows = written(rows.select(*[F.when(~F.col(failed), c).alias(c_) for c, c_ in zip(names, docs.columns)], of, failed), "judged")
    bad = rejected_hosts(rows.select(F.col(of).alias("host"), F.col(failed).alias("base_failed")), cfg)
    bad = written(bad.select(F.col("host").alias(host)), "hosts")  # its size on disk decides how it is joined
    return rows.where(~F.col(failed)).join(bad, F.col("source") == F.col(host), "left_anti").select(*names)


ORACLE = r"""
with d as (select doc_id, source, coalesce(text, '') t, row_number() over () rid from documents),
a as (select *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) l from d),
u as (select rid, unnest(w) x, generate_subscripts(w, 1) i from a),
win as (select rid, i, x || ' ' || lead(x) over o || ' ' || lead(x, 2) over o g from u window o as (partition by rid order by i)),
rep as (select rid, i from (select rid, i, count(*) over (partition by rid, g) c from win where g is not null) where c > 1),
cov as (select rid, count(*) c from (select distinct rid, i + k p from rep, (values (0), (1), (2)) v(k)) group by rid),
m as (select doc_id, source, len(w)::bigint n_words, coalesce(length(list_aggregate(w, 'string_agg', '')), 0)::bigint word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint n_symbols,
             (len(l) - len(list_distinct(l)))::bigint n_dup_lines, coalesce(c, 0)::bigint n_repeat_words
      from a left join cov using (rid)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from m),
h as (select source, count(*)::double n, sum(base_failed::int)::double f from b where source is not null group by source),
s as (select count(*) k, sum(n) n, sum(f) / sum(n) m, sum(n * n) nn, sum(f * f / n) rr from h),
v as (select m, case when n - nn / n - (k - 1) > 0
             then (rr - n * m * m - (k - 1) * m * (1 - m)) / (n - nn / n - (k - 1)) else 0 end bt from s),
p as (select m, case when bt <= 0 then 1e6 else least(1e6, greatest(1, m * (1 - m) / bt - 1)) end st from v),
r as (select source, (f + m * st) / (n + st) > 0.5 bad from h, p)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not coalesce(bad, false) kept
from b left join r using (source)
"""

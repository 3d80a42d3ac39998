"""URL rules through a cascade of Bloom filters, in DataFrame functions only.

A rule is a host and a path prefix; its key is their concatenation.  A url's candidate keys are all suffixes of its
host at label borders, up to the longest rule's labels, joined with the prefixes of its path that are as long as some
rule's.  The first filter holds the listed keys, the second the unlisted candidates of the whole corpus that pass the
first, the third the listed keys that pass the second, and so on until a level lets nothing through that it should
not.  For every key of the corpus, membership is then exact, and judging a url needs no join.

A second cascade over the rules alone tells the blocking ones.  Each filter travels with the plan as one binary value, so
a url's candidates are tested in one expression over their array, however many there are.  A list that needs more
than ``most_bits`` is refused, so a filter's size is bounded.

Defined results: null urls and those without ``://`` have an empty host and path, which no rule fits.  A url that no
rule fits is not on the list and gets ``allow``.  Of the fitting rules the longest wins, then the one with the longer
host.  Repeated rows are judged alike, very long urls whole.  An empty table gives no row, an empty list no rule.  Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", ALLOW),
    Rule("example.com", "/en/", BLOCK),
    Rule("www.example.com", "/en/", ALLOW),
    Rule("net", "/es/", BLOCK),
    Rule("net", "/fr/", BLOCK),
)


@dataclass(frozen=True)
class Settings:
    bits_per_key: int = 12
    hashes: int = 6
    least_bits: int = 1024
    most_bits: int = 1 << 26  # 8 MB for one filter
    most_levels: int = 40


class Bloom:
    """One filter: its bits as a binary value, and the test for a key."""

    def __init__(self, keys: DataFrame, n: int, salt: int, cfg: Settings):
        self.bits = max(cfg.least_bits, 1 << math.ceil(math.log2(max(1, n) * cfg.bits_per_key)))
        if self.bits > cfg.most_bits:
            raise ValueError(f"{n} keys need {self.bits} bits; at most {cfg.most_bits} are sent to every task")
        self.salt, self.hashes = salt, cfg.hashes
        places = keys.select(F.explode(F.array(*self._places(F.col("key")))).alias("place"))
        words = places.groupBy(F.shiftright("place", 6).alias("id")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")
        )
        dense, got = np.zeros(self.bits // 64, "<i8"), words.toArrow()  # at most one row for each 64 bits
        dense[got.column("id").to_numpy()] = got.column("bits").to_numpy()
        self.bytes = F.lit(dense.tobytes())

    def _places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.salt * self.hashes + i)), F.lit(self.bits)) for i in range(self.hashes)]

    def has(self, key: Column) -> Column:
        def bit(place: Column) -> Column:
            byte = F.conv(F.hex(F.substring(self.bytes, F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            return F.getbit(byte, place.bitwiseAND(7).cast("int")) == 1

        return key.isNotNull() & F.forall(F.array(*self._places(key)), bit)


class Cascade:
    """Exact membership of the keys of ``universe`` in ``listed``; both are one column ``key``."""

    def __init__(self, listed: DataFrame, universe: DataFrame, cfg: Settings = Settings()):
        listed = written(listed.select("key").where("key is not null").distinct(), "listed")
        self.levels: list[Bloom] = []
        inside, outside = listed, None
        while (n := inside.count()) and len(self.levels) < cfg.most_levels:
            level = Bloom(inside, n, len(self.levels), cfg)
            self.levels.append(level)
            others = universe.select("key").where("key is not null") if outside is None else outside
            passing = others.where(level.has(F.col("key"))).distinct()
            if outside is None:
                passing = passing.join(listed, "key", "left_anti")
            inside, outside = written(passing, "level"), inside
        if n:
            raise RuntimeError("the cascade has not ended; allow more bits for each key")

    def has(self, key: Column) -> Column:
        """Whether a key of the universe is listed: it fails an even level only if it truly is, and so on."""
        test = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            passed = self.levels[i].has(key)
            test = (passed & test) if i % 2 == 0 else (~passed | test)
        return test


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    upper = "".join(map(chr, range(65, 91)))
    url = F.coalesce(url, F.lit(""))
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), upper, upper.lower())
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def candidates(labels: int, lengths: list[int]) -> Column:
    """Structs (length, host length, key) of the keys that a rule for the url of columns ``host, path`` could have."""
    suffixes = f"transform(sequence(1, least(size(split(host, '[.]')), {labels})), i -> substring_index(host, '.', -i))"
    prefixes = f"filter(array({', '.join(map(str, lengths))}), n -> n <= length(path))"
    key = "struct(length(s) + n as length, length(s) as host, concat(s, substring(path, 1, n)) as key)"
    return F.expr(f"flatten(transform({suffixes}, s -> transform({prefixes}, n -> {key})))")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, cfg: Settings = Settings()) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``."""
    spark = pages.sparkSession
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    if not rules:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(ALLOW)})
    keys = spark.createDataFrame([(r.key, r.verdict) for r in rules], "key string, verdict string")
    labels, lengths = max(r.host.count(".") + 1 for r in rules), sorted({len(r.path) for r in rules})
    rows = rows.withColumn("keys", candidates(labels, lengths))
    listed = Cascade(keys, rows.select(F.explode("keys.key").alias("key")), cfg)
    blocking = Cascade(keys.where(F.col("verdict") == BLOCK), keys, cfg)
    fitting = F.array_max(F.filter("keys", lambda k: listed.has(k["key"])))
    rows = rows.select("page_id", "host", "path", fitting["key"].alias("rule"))
    return rows.withColumn("verdict", F.when(F.col("rule").isNotNull() & blocking.has(F.col("rule")), BLOCK).otherwise(ALLOW))


ORACLE = r"""
with p as (select page_id, case when contains(coalesce(url, ''), '://') then substr(url, instr(url, '://') + 3) else '' end a from pages),
u as (select page_id, translate(regexp_extract(a, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
             regexp_extract(a, '^[^/?#]*([^?#]*)', 1) path, row_number() over () rid from p),
r(rhost, rpath, v) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                              ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m as (select rid, max(struct_pack(n := length(rhost || rpath), h := length(rhost), rule := rhost || rpath, v := v)) best
      from u join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by rid)
select page_id, host, path, best.rule as rule, coalesce(best.v, 'allow') verdict from u left join m using (rid)
"""

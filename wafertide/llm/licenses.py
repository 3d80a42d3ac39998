"""License notices by MinHash over overlapping windows, in DataFrame functions only.

Templates fall into size classes.  A class of up to n words looks at windows of 2n words that start every n words, so
each notice lies wholly in some window.  A window is retrieved for a template where one of their bands agrees, that is,
where all MinHash values of the band are equal.  How many bands a template needs follows from ``chance`` and from the
least Jaccard similarity of a window that holds ``least`` of its shingles (with ``need`` of its t shingles in a window of
``wide`` ones it is need / (wide + t - need)).  A class computes as many hash functions as its smallest template needs with bands
of one row; a template that needs fewer uses them for bands of more rows, which let fewer other windows through.
Retrieved pairs are verified by exact containment of the template's five-word shingles.

The join of windows and templates is evaluated from the templates' side: a band can agree only in a window that holds
the very shingles that are the template's minima in it, so windows without any such minimum are dropped before their
own minima are computed.  This drops no agreeing band; ``minima_first`` switches it off.

Words are lower-cased (A-Z), split at space and U+0009-U+000D and stripped of punctuation at both ends; empty ones
are left out; templates are treated alike.  Defined results: null, empty and short texts have no shingle and no match.
Very long texts are scanned whole, window by window.  The result has one row per document id and template, so repeated
rows count once.  An empty table gives no row.  Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .quality import let, words

EDGE = ".,;:!?()[]{}\"'`*#"

#: The notices looked for, by name.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction'
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    least: float = 0.8
    chance: float = 1 - 1e-6
    classes: tuple[int, ...] = (16, 64, 256)
    most_keys: int = 200_000  # template bands that may be broadcast
    minima_first: bool = True


def normal_words(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    lowered = F.translate(text, upper, upper.lower())
    return F.array_remove(F.transform(words(lowered), lambda w: F.btrim(w, F.lit(EDGE))), "")


def plain_words(text: str) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [w for w in (x.strip(EDGE) for x in re.split(r"[\x20\x09-\x0D]+", lowered)) if w]


def bands(cfg: Settings, size: int, shingles: int, rows: int = 1) -> int:
    """Bands of ``rows`` that retrieve, with ``chance``, a window of ``2 * size`` words with ``least`` of a template."""
    wide, need = 2 * size - cfg.shingle + 1, math.ceil(cfg.least * shingles - 1e-9)
    return math.ceil(math.log(1 - cfg.chance) / math.log1p(-((need / (wide + shingles - need)) ** rows)))


def shape(cfg: Settings, size: int, counts: list[int]) -> tuple[int, list[tuple[int, int]]]:
    """Hash functions of a class, and (rows, bands) of each of its templates, given their shingle counts."""
    functions = max(bands(cfg, size, n) for n in counts)
    found = []
    for n in counts:
        rows = 1
        while bands(cfg, size, n, rows + 1) * (rows + 1) <= functions:
            rows += 1
        found.append((rows, bands(cfg, size, n, rows)))
    return functions, found


def grams(w: str, k: int) -> str:
    """SQL for the hashes of all ``k`` words in a row of the array ``w``; each word is hashed once."""
    five = ", ".join(f"get(g, i + {n})" if n else "get(g, i)" for n in range(k))
    hashes = f"transform(sequence(0, size(g) - {k}), i -> xxhash64({five}))"
    return let("g", f"transform({w}, x -> xxhash64(x))", f"case when size(g) >= {k} then {hashes} else cast(array() as array<bigint>) end")


def banded(functions: int, shapes: set[int]) -> str:
    """SQL for an array of (rows, band, value) over the array ``hashes``, for bands of each number of rows in ``shapes``."""
    parts = []
    for rows in sorted(shapes):
        value = ", ".join(f"get(m, b * {rows} + {n})" for n in range(rows))
        value = value if rows == 1 else f"xxhash64({value})"
        parts.append(f"transform(sequence(0, {functions // rows - 1}), b -> struct({rows} as n, b as band, {value} as value))")
    minima = f"transform(sequence(0, {functions - 1}), f -> array_min(transform(hashes, x -> xxhash64(x, f))))"
    return let("m", minima, f"concat({', '.join(parts)})")


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, cfg: Settings = Settings()) -> DataFrame:
    """One row per document id and template found: ``doc_id, template, containment, first_window``."""
    spark, k = docs.sparkSession, cfg.shingle
    split = {name: plain_words(text) for name, text in templates.items()}
    shingles = {name: sorted({" ".join(w[i : i + k]) for i in range(len(w) - k + 1)}) for name, w in split.items()}
    if not all(shingles.values()):
        raise ValueError(f"a template needs {k} words at least")
    classes = []
    for at, size in enumerate(cfg.classes):
        low = cfg.classes[at - 1] if at else 0
        names = [n for n, w in split.items() if low < len(w) <= size or at == len(cfg.classes) - 1 and len(w) > size]
        if names:
            size = max(size, *(len(split[n]) for n in names))
            functions, shapes = shape(cfg, size, [len(shingles[n]) for n in names])
            if sum(b for _, b in shapes) > cfg.most_keys:
                raise ValueError(f"{len(names)} templates exceed {cfg.most_keys} broadcast keys")
            rows = [(n, shingles[n], split[n], r, b) for n, (r, b) in zip(names, shapes, strict=True)]
            table = spark.createDataFrame(rows, "template string, shingles array<string>, w array<string>, rows int, bands int")
            table = table.withColumn("hashes", F.array_distinct(F.expr(grams("w", k)))).drop("w")
            classes.append((size, functions, {r for r, _ in shapes}, table))
    # explode keeps the words a column of their own: inlined into the lambda below, texts would be split for each shingle
    rows = docs.select("doc_id", F.explode(F.array(normal_words(F.col("text")))).alias("w")).withColumn("h", F.expr(grams("w", k)))
    if cfg.minima_first:
        known = sorted({x for _, _, _, table in classes for x in _minima(table)})
        hit = F.transform("h", lambda x, i: F.when(x.isin(known), i))
        rows = rows.withColumn("hits", F.filter(hit, lambda i: i.isNotNull())).where(F.size("hits") > 0)
    else:
        rows = rows.where(F.size("h") > 0).withColumn("hits", F.sequence(F.lit(0), F.size("h") - 1))
    rows = written(rows, "notices")
    found = None
    for size, functions, shapes, table in classes:
        part = _class(rows, table, size, functions, shapes, cfg)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "template").agg(F.max("containment").alias("containment"), F.min("start").alias("first_window"))


def _minima(table: DataFrame) -> list[int]:
    """Hashes of the shingles that are a minimum in a band of their template; as few as the templates' shingles."""
    least = "transform(sequence(0, rows * bands - 1), f -> array_min(transform(hashes, x -> struct(xxhash64(x, f) as v, x as x))).x)"
    return [r[0] for r in table.select(F.explode(F.expr(f"array_distinct({least})"))).distinct().collect()]


def _class(rows: DataFrame, table: DataFrame, size: int, functions: int, shapes: set[int], cfg: Settings) -> DataFrame:
    k, wide = cfg.shingle, 2 * size - cfg.shingle + 1  # shingles of a window
    values = banded(functions, shapes)
    keyed = table.select("template", "shingles", "rows", "bands", F.explode(F.expr(values)).alias("b"))
    keyed = keyed.where("b.n = rows and b.band < bands").select("template", "shingles", "b")
    first = f"cast(greatest(0, ceil((i - {wide - 1}) / {size})) as int)"
    spots = rows.withColumn(
        "j", F.explode(F.expr(f"array_distinct(flatten(transform(hits, i -> sequence({first}, cast(floor(i / {size}) as int)))))"))
    )
    spots = spots.select(
        "doc_id",
        (F.col("j") * size).alias("start"),
        F.expr(f"slice(w, j * {size} + 1, {2 * size})").alias("w"),
        F.expr(f"slice(h, j * {size} + 1, {wide})").alias("hashes"),
    )
    probes = spots.select("doc_id", "start", "w", F.explode(F.expr(values)).alias("b"))
    met = probes.join(F.broadcast(keyed), "b")
    pairs = met.groupBy("doc_id", "start", "template", "w", "shingles").agg(F.count("*").alias("agreeing"))
    own = F.expr(f"transform(sequence(0, size(w) - {k}), i -> concat_ws(' ', slice(w, i + 1, {k})))")
    share = F.size(F.array_intersect("shingles", own)) / F.size("shingles")
    return pairs.select("doc_id", "template", "start", share.alias("containment")).where(F.col("containment") >= cfg.least)


def oracle(templates: dict[str, str] = TEMPLATES, cfg: Settings = Settings()) -> str:
    """DuckDB SQL for ``scan``: containment in every window, without any index."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    k = cfg.shingle
    rows = []
    for name, text in templates.items():
        w = plain_words(text)
        size = next((s for s in cfg.classes if len(w) <= s), None) or max(len(plain_words(t)) for t in templates.values())
        grams = sorted({" ".join(w[i : i + k]) for i in range(len(w) - k + 1)})
        rows += [f"({quote(name)}, {size}, {len(grams)}, {quote(g)})" for g in grams]
    return rf"""
with t(template, size, n, g) as (values {", ".join(rows)}),
a as (select doc_id, row_number() over () rid, list_filter(list_transform(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: trim(x, {quote(EDGE)})), lambda x: x <> '') w
      from documents),
u as (select doc_id, rid, unnest(w) x, generate_subscripts(w, 1) - 1 i from a),
s as (select doc_id, rid, i, {" || ' ' || ".join(["x"] + [f"lead(x, {n}) over o" for n in range(1, k)])} g
      from u window o as (partition by rid order by i)),
h as (select distinct doc_id, rid, template, size, n, g, i from s join t using (g)),
x as (select *, unnest(range(greatest(0, ceil((i - (2 * size - {k})) / size))::bigint, (i // size)::bigint + 1)) j from h),
c as (select doc_id, rid, template, j * size start, count(distinct g) / any_value(n)::double share from x group by all)
select doc_id, template, max(share) containment, min(start)::int first_window from c where share >= {cfg.least} group by doc_id, template
"""

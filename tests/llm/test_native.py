"""The operators that run on DataFrame functions alone, against DuckDB and plain Python."""

import random
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wafertide.llm import licenses, quality, urlfilter

from .helpers import AWKWARD, frame, prose


def duck(sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        columns, data = rows
        con.register(name + "_df", pd.DataFrame(data, columns=columns).astype(object))
        con.sql(f"create view {name} as select * from {name}_df")
    return con.sql(sql).fetchall(), [d[0] for d in con.sql(sql).description]


def same(df, sql, **tables):
    rows, names = duck(sql, **tables)
    assert sorted(names) == sorted(df.columns)
    got = [tuple(r[n] for n in names) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(rows, key=repr)
    return got


def plain_repeats(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    return len(w), len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)})


def texts(rng):
    rows = [(i, t, "en", f"s{i % 3}" if i else "s0", 1) for i, t in AWKWARD]
    for i in range(60):
        words = prose(rng, rng.randrange(30, 200)).split()
        if i % 3 == 0:
            at = rng.randrange(len(words))
            words += words[at : at + rng.randrange(2, 9)] * rng.randrange(1, 4)
        lines = "\n".join(" ".join(words[j : j + 12]) for j in range(0, len(words), 12))
        rows.append((100 + i, lines + ("\n#a & <b>\n#a & <b>\n \n \n" if i % 4 == 0 else ""), "en", f"s{i % 5}", 1))
    rows += [(200 + i, "bad", "en", "junk", 1) for i in range(30)] + [(300, prose(rng, 80), "en", "junk", 1)]
    rows += [(301, prose(rng, 80), "en", None, 1), (302, "\f\x0bfn\tr t n\x85 f", "en", None, 1)]
    return rows


def test_quality(spark):
    rows = texts(random.Random(1))
    docs = frame(spark, rows).withColumns({"host": F.lit("clash"), "n_words": F.lit(-1), "w": F.lit(0)})
    got = quality.judge(docs)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, r)
    for i, t, *_ in rows:
        assert (by[i].n_words, by[i].n_repeat_words) == plain_repeats(t)
    assert not by[300].kept and not by[300].base_failed  # its host is rejected
    assert by[301].kept
    plain = [r for r in rows if "\x00" not in (r[1] or "")]  # DuckDB's frame scan ends strings at NUL
    same(quality.judge(frame(spark, plain)), quality.ORACLE, documents=(columns, plain))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    want = sorted(r.doc_id for r in got.collect() if r.kept and r.doc_id is not None)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want


def test_quality_of_nothing(spark):
    assert quality.judge(frame(spark, [])).count() == 0
    assert quality.keep_good(frame(spark, [])).count() == 0


URLS = [
    "http://a.example.com/en/1", "https://www.example.com/en/x?y#z", "https://b.www.EXAMPLE.com/en/", "http://example.com/EN/", "http://x.net/fr/q",
    "http://net/es/", "http://xnet/es/", "ftp://e.net/es", "http://foo.com", "http://foo.com/", "http://com/", "nothing", "", None, "://", ":///",
    "a://b://c.com/", "http://foo.com?x=/", "http://foo.com#/en/", "http://user@foo.com:80/", "http://com./", "http://.com/", "HTTP://É.Com/é/",
    "http://" + "a." * 500 + "com/en/", "http://example.com/en/" + "p" * 50_000, "http://foo.com\n/x", "http://b.example.com/en/\n?x",
]


def test_urls(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(3, URLS[3]), (None, URLS[0])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("clash"), "key": F.lit(1), "keys": F.lit(1)})
    got = {r[0]: r for r in same(urlfilter.judge(pages), urlfilter.ORACLE, pages=(["page_id", "url"], rows))}
    assert got[0][3:] == ("example.com/en/", "block") and got[2][3:] == ("www.example.com/en/", "allow")
    empty = urlfilter.judge(pages.where("false"))
    assert empty.columns == ["page_id", "host", "path", "rule", "verdict"] and empty.count() == 0
    assert {r.rule for r in urlfilter.judge(pages, ()).collect()} == {None}


def test_many_rules_are_no_larger_plan(spark):
    """Rules of a hundred path lengths: one expression over a url's candidates, and the verdicts of a plain lookup."""
    rules = tuple(urlfilter.Rule("a.org", "/" + "p" * n, urlfilter.BLOCK if n % 3 else urlfilter.ALLOW) for n in range(2, 102))
    pages = spark.createDataFrame([(i, f"http://w{i % 3}.a.org/{'p' * i}{'/x' if i % 2 else ''}") for i in range(110)], "page_id long, url string")
    judged = urlfilter.judge(pages, rules)
    assert len(judged._jdf.queryExecution().optimizedPlan().toString()) < 40_000
    for r in judged.collect():
        best = min(r.page_id, 101)
        assert r.rule == (f"a.org/{'p' * best}" if best >= 2 else None)
        assert r.verdict == ("block" if best >= 2 and best % 3 else "allow")


def test_cascade_is_exact_where_filters_are_poor(spark):
    rng = random.Random(2)
    keys = [f"k{i}" for i in range(3000)]
    listed = set(rng.sample(keys, 300))
    cfg = urlfilter.Settings(bits_per_key=2, hashes=2, least_bits=64)
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    cascade = urlfilter.Cascade(spark.createDataFrame([(k,) for k in listed], "key string"), universe, cfg)
    assert len(cascade.levels) > 2
    assert {r.key for r in universe.where(cascade.has(F.col("key"))).collect()} == listed
    with pytest.raises(ValueError):
        urlfilter.Cascade(universe, universe, urlfilter.Settings(most_bits=1024))


def test_licenses(spark):
    rng = random.Random(3)
    rows = [(i, t) for i, t in AWKWARD]
    for i, (name, text) in enumerate(licenses.TEMPLATES.items()):
        for k in range(6):
            words = text.split()
            if k % 3 == 2 and len(words) > 20:
                words[rng.randrange(len(words))] = "different"
            rows.append((100 + 10 * i + k, f"{prose(rng, 37 * k)} {' '.join(words).upper() if k == 1 else ' '.join(words)}\n{prose(rng, 20)}"))
    rows.append((900, " ".join([licenses.TEMPLATES["mit"]] * 300)))
    docs = frame(spark, rows).withColumns({"template": F.lit(1), "w": F.lit(1)})
    plain = [(i, t) for i, t in rows if "\x00" not in (t or "")]
    got = same(licenses.scan(docs), licenses.oracle(), documents=(["doc_id", "text"], plain))
    for i, name in enumerate(licenses.TEMPLATES):
        assert {(100 + 10 * i + k, name) for k in (0, 1, 3, 4)} <= {(r[0], r[1]) for r in got}
    assert licenses.scan(frame(spark, [])).count() == 0


def test_bands_retrieve_alone(spark):
    """Evaluated for every window, without looking for the templates' minima first, the bands give the same rows."""
    rng, whole = random.Random(4), {"mit": licenses.TEMPLATES["mit"], "mpl-2.0": licenses.TEMPLATES["mpl-2.0"], "mit-permission": licenses.TEMPLATES["mit-permission"]}
    rows = []
    for i in range(24):
        words = licenses.plain_words(list(whole.values())[i % 3])
        if i % 2 and len(words) > 12:
            words[rng.randrange(len(words))] = "other"
        if i % 4 == 3:
            words = words[: len(words) // 3]
        rows.append((i, f"{prose(rng, 20)} {' '.join(words)} {prose(rng, 30)}"))
    docs, found = frame(spark, rows), []
    for first in (True, False):
        found.append(sorted(tuple(r) for r in licenses.scan(docs, whole, licenses.Settings(minima_first=first)).collect()))
    assert found[0] == found[1] and len(found[0]) >= 12


def test_band_numbers():
    cfg = licenses.Settings()
    assert licenses.bands(cfg, 64, 25) == 83  # 20 shingles of 25 in a window of 124
    functions, shapes = licenses.shape(cfg, 16, [1, 11, 12])
    assert functions == licenses.bands(cfg, 16, 1) and shapes[0][0] == 1 and shapes[1][0] == shapes[2][0] == 2
    for n, (rows, bands) in zip([1, 11, 12], shapes):
        need = -(-4 * n // 5)
        assert (1 - (need / (28 + n - need)) ** rows) ** bands <= 1e-6 * 1.0001


def test_templates_are_read_like_texts(spark):
    notice = {"own": "Éditions SARL, tous droits réservés pour ÉTÉ toujours"}
    rows = [(1, f"avant {notice['own']} après"), (2, notice["own"].lower())]
    got = {r.doc_id for r in licenses.scan(frame(spark, rows), notice).collect()}
    assert got == {1}  # only A-Z is lower-cased, and a no-break space parts no words

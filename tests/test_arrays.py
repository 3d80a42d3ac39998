"""Column functions against hand-computed values and numpy."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from wafertide.functions import arrays as A


def column(spark, values, make):
    rows = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(values)], "i int, v array<double>")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("v"))).collect()]


def test_roughness_and_spike(spark):
    got = column(spark, [[0, 1, 0, 1], [5.0], [3, 7], []], A.roughness)
    assert got == pytest.approx([0.9428090416, 0, 0, 0])
    assert column(spark, [[1, -4, 2], []], A.spike) == [4, 0]
    rng = np.random.default_rng(1)
    x = [rng.normal(size=n).tolist() for n in (2, 3, 50, 400)]
    assert column(spark, x, A.roughness) == pytest.approx([np.std(np.diff(v)) for v in x])
    assert column(spark, [[v + 7 for v in x[3]]], A.roughness) == pytest.approx([np.std(np.diff(x[3]))])


def test_downsample(spark):
    got = column(spark, [list(map(float, range(100))), [float(i) for i in range(10)]], lambda v: A.downsample(v, 10))
    assert got[0][0] == 4.5 and got[0][-1] == 94.5 and got[1] == list(range(10))
    short = column(spark, [[1.0, 2.0], []], lambda v: A.downsample(v, 4))
    assert short[0] == [1, 1, 2, 2] and all(map(math.isnan, short[1]))
    for n in (7, 26, 63, 299):
        v = np.random.default_rng(n).normal(size=n)
        e = np.linspace(0, n, 26).astype(int)
        want = [v[a : max(a + 1, b)].mean() for a, b in zip(e, e[1:])]
        assert column(spark, [v.tolist()], lambda c: A.downsample(c, 25))[0] == pytest.approx(want)


def test_decode_hex(spark):
    rng = random.Random(2)
    words = [rng.choice([rng.uniform(-1e5, 1e5), 0.0, -0.0, 1e-42, 3.0e38]) for _ in range(40)]
    texts = ["0000803f000000c0ff", "", None, "zz", "412", "41", " 00 00\t80\n3f", struct.pack("<40f", *words).hex(), "0000807F000080FF"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, h string")
    got = [r[0] for r in rows.orderBy("i").select(A.decode_hex("h")).collect()]
    assert got[:7] == [[1.0, -2.0], [], [], [], [], [], [1.0]]
    assert got[7] == list(struct.unpack("<40f", struct.pack("<40f", *words))) and got[8] == [math.inf, -math.inf]


@pytest.mark.parametrize("weight", [0.1, 0.3, 1.0])
def test_ewma_equals_the_recursion(spark, weight):
    x = np.random.default_rng(3).normal(size=900)
    rows = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(x)] + [("b", 0, 10.0), ("b", 1, 20.0), ("c", 0, 1.0), ("c", 1, math.nan), ("c", 2, 2.0)], "g string, n int, x double")
    got = rows.withColumn("e", A.ewma(F.col("x"), weight, ["g"], ["n"])).orderBy("g", "n").collect()
    e, want = None, []
    for v in x:
        e = v if e is None else (1 - weight) * e + weight * v
        want.append(e)
    assert [r.e for r in got[:900]] == pytest.approx(want, rel=1e-12)
    assert [r.e for r in got[900:902]] == pytest.approx([10, 10 + 10 * weight])
    if weight < 1:
        assert math.isnan(got[903].e) and math.isnan(got[904].e)


def plain_two_means(v):
    v = np.array(v)
    a, b = v.min() + (v.max() - v.min()) * 0.33, v.min() + (v.max() - v.min()) * 0.66
    la, lb = a, b
    for _ in range(50):
        second = np.abs(v - b) < np.abs(v - a)
        la, lb = a, b
        x, y = (v[~second].mean() if (~second).any() else a), (v[second].mean() if second.any() else b)
        if abs(x - a) < 1e-9 and abs(y - b) < 1e-9:
            break
        a, b = x, y
    return [a, b, la, lb]


def test_two_means(spark):
    rng = np.random.default_rng(4)
    sets = [rng.normal(size=n).tolist() for n in (2, 5, 40, 200)] + [[3.0] * 12, [1.0]] + [[*rng.normal(0, 1, 30), *rng.normal(9, 1, 20)]]
    got = column(spark, sets, A.two_means)
    for r, v in zip(got, sets):
        assert [r.a, r.b, r.la, r.lb] == pytest.approx(plain_two_means(v), rel=1e-12)


def test_alarms_ignore_nan(spark):
    rows = spark.createDataFrame([(math.nan, 1.0), (2.0, 1.0), (1.0, 1.0), (2.0, math.nan), (None, 1.0)], "a double, b double")
    assert [r[0] for r in rows.select(A.exceeds(F.col("a"), F.col("b"))).collect()] == [False, True, False, False, False]

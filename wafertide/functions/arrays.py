"""Column functions over waveform arrays; all run in the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, whatever the optimizer inlines."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)


def std_pop(values: Column) -> Column:
    """Population standard deviation in two passes."""
    return let(values, lambda v: let(mean(v), lambda m: F.sqrt(mean(F.transform(v, lambda x: (x - m) * (x - m))))))


def residual(series: Column, reference: Column, length: Column) -> Column:
    return F.zip_with(F.slice(series, F.lit(1), length), F.slice(reference, F.lit(1), length), lambda a, b: a - b)


def first_diff(values: Column) -> Column:
    n = F.greatest(F.size(values) - 1, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(2), n), F.slice(values, F.lit(1), n), lambda a, b: a - b)


def roughness(values: Column) -> Column:
    """Spread of the first differences; 0 below two points."""
    return let(values, lambda v: F.when(F.size(v) < 2, F.lit(0.0)).otherwise(std_pop(first_diff(v))))


def normalized(value: Column, within: WindowSpec) -> Column:
    """Distance from the mean of a window in its population standard deviations."""
    return (value - F.avg(value).over(within)) / (F.stddev_pop(value).over(within) + 1e-9)


def spike(values: Column) -> Column:
    """Largest magnitude; 0 if empty."""
    return F.coalesce(F.array_max(F.transform(values, F.abs)), F.lit(0.0))


def downsample(values: Column, length: int) -> Column:
    """Block means between ``length + 1`` even edges; a series of that length stays as it is.

    Blocks hold one point at least, so those of a shorter series overlap; of an empty one they are NaN.
    """

    def edge(n, i):
        return F.when(i == length, n).otherwise((i * (n.cast("double") / length)).cast("int"))

    def block(v, i):
        start, end = edge(F.size(v), i), edge(F.size(v), i + 1)
        part = F.slice(v, start + 1, F.greatest(end - start, F.lit(1)))
        return F.when(F.size(v) == 0, F.lit(float("nan"))).otherwise(mean(part))

    blocks = lambda v: F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: block(v, i))
    return let(values, lambda v: F.when(F.size(v) == length, v).otherwise(blocks(v)))


def decode_hex(column: str) -> Column:
    """Little-endian 32-bit floats of a hex string column as doubles.

    White space is skipped and a trailing partial word dropped; null, odd-length and invalid strings are empty.
    """
    number = "cast(conv(concat(substr(h, i*8+7, 2), substr(h, i*8+5, 2), substr(h, i*8+3, 2), substr(h, i*8+1, 2)), 16, 10) as bigint)"
    value = (
        "if(b >= 2147483648, -1D, 1D) * case when e = 255 and m = 0 then double('Infinity') when e = 255 then double('NaN') "
        "when e = 0 then m * pow(2D, -149D) else (1D + m / 8388608D) * pow(2D, e - 127D) end"
    )
    word = f"transform(array({number}), b -> get(transform(array(b & 8388607), m -> get(transform(array(shiftright(b & 2139095040, 23)), e -> {value}), 0)), 0))"
    body = f"transform(sequence(0, cast(length(h) div 8 as int) - 1), i -> get({word}, 0))"
    good = "length(h) >= 8 and length(h) % 2 = 0 and h rlike '^[0-9a-fA-F]*$'"
    text = f"regexp_replace(coalesce(`{column}`, ''), '[ \\\\t\\\\n\\\\r]', '')"
    return F.expr(f"get(transform(array({text}), h -> case when {good} then {body} else cast(array() as array<double>) end), 0)")


def ewma(value: Column, weight: float, keys: list, order: list) -> Column:
    """Exponentially weighted mean along ``order`` within ``keys``, started by the first value.

    The frame reaches back until a value's weight is below 1e-18, which no double can tell from the full recursion, so
    a group's history needs no unbounded state.  Once a NaN came in, all later means are NaN.
    """
    if weight >= 1:
        return value
    back = math.ceil(math.log(1e-18) / math.log(1 - weight))
    frame = Window.partitionBy(*keys).orderBy(*order)
    start = F.lit(None).cast("double")
    fold = F.aggregate(
        F.collect_list(value).over(frame.rowsBetween(-back, 0)),
        start,
        lambda e, x: F.when(e.isNull(), x).otherwise((1 - weight) * e + weight * x),
    )
    spoiled = F.max(F.isnan(value)).over(frame.rowsBetween(Window.unboundedPreceding, 0))
    return F.when(spoiled, F.lit(float("nan"))).otherwise(fold)


def up_to_now(keys: list, order: list) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def exceeds(value: Column, limit: Column) -> Column:
    """Strictly above; a NaN on either side is no alarm (Spark orders NaN above all numbers)."""
    return F.coalesce((value > limit) & ~F.isnan(value) & ~F.isnan(limit), F.lit(False))


def two_means(levels: Column) -> Column:
    """Struct ``a, b, la, lb``: final centres of one-dimensional 2-means, and those that the final labels came from.

    Centres start at 33 and 66 percent of the range; a value on the border belongs to the first.  When both centres
    move less than 1e-9 the ones before the move are final; after 50 rounds the labels lag one round behind.
    """

    def part(v, a, b, second):
        own = F.filter(v, lambda x: (F.abs(x - b) < F.abs(x - a)) == second)
        return let(own, lambda o: F.when(F.size(o) == 0, b if second else a).otherwise(mean(o)))

    def state(a, b, la, lb, done):
        return F.struct(a.alias("a"), b.alias("b"), la.alias("la"), lb.alias("lb"), done.alias("done"))

    def step(v, s):
        def moved(n):
            still = (F.abs(n["x"] - s["a"]) < 1e-9) & (F.abs(n["y"] - s["b"]) < 1e-9)
            return F.when(still, state(s["a"], s["b"], s["a"], s["b"], F.lit(True))).otherwise(
                state(n["x"], n["y"], s["a"], s["b"], F.lit(False))
            )

        new = F.struct(part(v, s["a"], s["b"], False).alias("x"), part(v, s["a"], s["b"], True).alias("y"))
        return F.when(s["done"], s).otherwise(let(new, moved))

    def run(v):
        low, span = F.array_min(v), F.array_max(v) - F.array_min(v)
        a, b = low + span * 0.33, low + span * 0.66
        return F.aggregate(F.sequence(F.lit(1), F.lit(50)), state(a, b, a, b, F.lit(False)), lambda s, _: step(v, s))

    return let(levels, run)

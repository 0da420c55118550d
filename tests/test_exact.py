"""Exact sums of doubles against ``math.fsum``."""

import math
import random

from pyspark.sql import functions as F

from tierwell.operators.exact import exact_sums


def bits(x):
    return None if x is None else "nan" if math.isnan(x) else float(x).hex()


def fsum(values):
    values = [v for v in values if v is not None]
    if not values:
        return None
    try:
        return math.fsum(values)
    except ValueError:                  # both infinities
        return math.nan
    except OverflowError:
        return math.copysign(math.inf, sum(v * 2.0 ** -60 for v in values))


def test_equals_fsum_in_any_order(spark):
    rnd = random.Random(7)
    tiny, huge = 5e-324, 1.7976931348623157e308
    groups = {
        "mixed": [rnd.uniform(-1, 1) * 10 ** rnd.randint(-300, 300) for _ in range(400)],
        "shares": [rnd.randint(0, 9) / rnd.randint(1, 999) for _ in range(500)],
        "cancel": [1e16, 1.0, -1e16, 1e-16, huge, -huge, tiny], "tiny": [tiny] * 3 + [2.2250738585072014e-308, -tiny],
        "powers": [s * 2.0 ** k for k in range(-1074, 1023) for s in (1, -1) if k % 3 or s > 0],
        "next to powers": [math.nextafter(2.0 ** k, d) for k in range(-1000, 1000, 7) for d in (0, math.inf)],
        "zeros": [0.0, -0.0], "nulls": [None, None], "some": [None, 0.1, 0.2], "nan": [1.0, math.nan],
        "inf": [1.0, math.inf], "both": [math.inf, -math.inf], "minus": [-math.inf, 5.0], "over": [huge, huge],
        "hot": [0.1] * 4000}
    rows = [(k, v, i) for k, vs in groups.items() for i, v in enumerate(vs)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, x double, n long")
    for parts in (1, 7):
        got = exact_sums(df.repartition(parts), ["k"], {"s": F.col("x"), "h": F.col("x") / 2}, sums=["n"])
        found = {r.k: r for r in got.collect()}
        for k, values in groups.items():
            assert bits(found[k].s) == bits(fsum(values)), k
            assert found[k].n == sum(range(len(values)))
        assert bits(found["shares"].h) == bits(fsum([v / 2 for v in groups["shares"]]))
    assert exact_sums(df.where("false"), ["k"], {"s": F.col("x")}).collect() == []

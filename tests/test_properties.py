"""Property tests: integer half-up helpers equal Decimal ROUND_HALF_UP."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions.money import avg_amount, half_up_div, pct_2dp

pairs = st.lists(st.tuples(st.integers(0, 10**15), st.integers(1, 10**9)),
                 min_size=1, max_size=200)


def _hu(n, d, scale=0):
    q = Decimal(n) / Decimal(d)
    return q.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)


@settings(max_examples=5, deadline=None)
@given(pairs)
def test_half_up_helpers_match_decimal(spark, rows):
    df = spark.createDataFrame(rows, "n long, d long")
    got = df.select("n", "d", half_up_div("n", "d").alias("h"),
                    avg_amount("n", "d").alias("a"),
                    pct_2dp(F.least("n", "d"), "d").alias("p")).collect()
    for r in got:
        assert r.h == int(_hu(r.n, r.d))
        assert r.a == float(_hu(r.n, r.d) / 100)
        assert r.p == float(_hu(min(r.n, r.d) * 100, r.d, 2))

"""Derived columns, NULL rules and exact money arithmetic on literal rows."""

import datetime as dt


from tillroll.functions import calendar as cal
from tillroll.functions import formatting as fmt
from tillroll.functions.money import avg_amount, half_up_div, pct_2dp, to_cents


def test_revenue_bands_bounds_and_null(spark):
    rows = [(19.99,), (20.00,), (99.99,), (100.00,), (None,)]
    df = spark.createDataFrame(rows, "amt double")
    out = df.select(cal.revenue_category("amt", 20.0, 100.0).alias("b")).collect()
    assert [r.b for r in out] == ["Low", "Medium", "Medium", "High", "High"]


def test_season_for_every_month_and_null(spark):
    dates = [(dt.date(2025, m, 10),) for m in range(1, 13)] + [(None,)]
    df = spark.createDataFrame(dates, "d date")
    got = [r.s for r in df.select(cal.australian_season("d").alias("s")).collect()]
    assert got == ["Summer", "Summer", "Autumn", "Autumn", "Autumn", "Winter", "Winter",
                   "Winter", "Spring", "Spring", "Spring", "Summer", None]


def test_weekend_flag_day_type_and_null(spark):
    # 2025-03-01 is a Saturday
    df = spark.createDataFrame([(dt.date(2025, 3, 1),), (dt.date(2025, 3, 2),),
                                (dt.date(2025, 3, 3),), (None,)], "d date")
    out = df.select(cal.is_weekend("d").alias("w"), cal.day_name("d").alias("n"),
                    cal.day_type(cal.is_weekend("d")).alias("t")).collect()
    assert [r.w for r in out] == [True, True, False, False]
    assert [r.n for r in out] == ["Saturday", "Sunday", "Monday", None]
    assert [r.t for r in out] == ["Weekend", "Weekend", "Weekday", "Weekday"]


def test_day_type_null_flag_is_weekday(spark):
    df = spark.createDataFrame([(None,), (True,), (False,)], "w boolean")
    assert [r.t for r in df.select(cal.day_type("w").alias("t")).collect()] == \
        ["Weekday", "Weekend", "Weekday"]


def test_half_up_division_exact(spark):
    df = spark.createDataFrame([(5, 2), (7, 2), (1, 3), (2, 3), (10, 0), (None, 4)],
                               "n long, d long")
    got = [r.h for r in df.select(half_up_div("n", "d").alias("h")).collect()]
    assert got == [3, 4, 0, 1, None, None]


def test_avg_and_pct_match_round_half_up(spark):
    # 1.005 is a tie that binary doubles get wrong; cents are exact
    df = spark.createDataFrame([(201, 2, 1, 3)], "s long, n long, a long, b long")
    r = df.select(avg_amount("s", "n").alias("avg"), pct_2dp("a", "b").alias("p")).first()
    assert r.avg == 1.01          # 201 cents / 2 = 100.5 → 101 cents
    assert r.p == 33.33


def test_to_cents_handles_float_noise(spark):
    df = spark.createDataFrame([(901.82,), (0.29,), (104997.88,)], "x double")
    assert [r.c for r in df.select(to_cents("x").alias("c")).collect()] == \
        [90182, 29, 10499788]


def test_demand_factor(spark):
    d = [(dt.date(2025, 12, 20),),   # Saturday in late December: 14 * 18 * 10
         (dt.date(2026, 4, 5),),     # Sunday in April: 13 * 10 * 12
         (dt.date(2025, 3, 3),)]     # Monday: 10 * 10 * 10
    df = spark.createDataFrame(d, "d date")
    assert [r.f for r in df.select(cal.demand_factor_thousandths("d").alias("f")).collect()] \
        == [2520, 1560, 1000]


def test_display_formats(spark):
    df = spark.createDataFrame([("Harbour Fresh Groceries", 108345650, 12345, 4871)],
                               "name string, cents long, n long, pct_h long")
    r = df.select(fmt.first_space_to_newline("name").alias("a"),
                  fmt.currency_0dp("cents").alias("b"),
                  fmt.thousands("n").alias("c"),
                  fmt.thousands_label("cents").alias("d"),
                  fmt.percent_1dp("pct_h").alias("e")).first()
    assert r.a == "Harbour\nFresh Groceries"
    assert r.b == "$1,083,457"
    assert r.c == "12,345"
    assert r.d == "$1083K"
    assert r.e == "48.7%"


def test_padded_id_never_truncates(spark):
    df = spark.createDataFrame([(7,), (123456,), (1234567,)], "n long")
    assert [r.s for r in df.select(fmt.padded_id("SHOP", "n").alias("s")).collect()] == \
        ["SHOP000007", "SHOP123456", "SHOP1234567"]

"""Scalar functions on hand-computed values."""

import math

import pytest
from pyspark.sql import functions as F

from shoal.functions import dates, nested, numeric, sql, text
from shoal.functions.draws import draw_below, uniform


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_wilson_at_the_ends(spark):
    assert value(spark, numeric.wilson(F.lit(0), F.lit(0))) == 0
    assert value(spark, numeric.wilson(F.lit(0), F.lit(10))) == pytest.approx(0, abs=1e-12)
    n, z = 10, 1.96
    assert value(spark, numeric.wilson(F.lit(10), F.lit(10))) == pytest.approx(n / (n + z * z))


def test_round_step_is_half_up_for_negatives(spark):
    assert value(spark, numeric.round_step(F.lit(-0.125), 100)) == -0.12
    assert value(spark, numeric.round_step(F.lit(0.125), 100)) == 0.13


def test_ratios_and_zero_vectors(spark):
    assert value(spark, numeric.safe_ratio(F.lit(1), F.lit(0))) == 0
    assert value(spark, numeric.ratio(F.lit(1), F.lit(0))) is None
    zero, one = F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(0.0))
    assert value(spark, numeric.cosine(zero, one)) == 0
    assert value(spark, numeric.euclidean(zero, one)) == 1


def test_finite_drops_nan_and_infinity(spark):
    rows = spark.createDataFrame([(1.0,), (math.nan,), (math.inf,), (-math.inf,), (None,)], "v double")
    assert [r.v for r in rows.where(numeric.finite("v")).collect()] == [1.0]


def test_dates_at_year_ends(spark):
    assert value(spark, dates.shift(F.lit("20240101"), -1)) == "20231231"
    assert value(spark, dates.shift(F.lit("20231231"), 1)) == "20240101"
    assert value(spark, dates.gap(F.lit("20231231"), F.lit("20240301"))) == 61
    assert value(spark, dates.sequence_up(F.lit("20231231"), F.lit("20240101"))) == ["20231231", "20240101"]
    assert value(spark, dates.sequence_down(F.lit("20240101"), 1)) == ["20240101", "20231231"]
    assert value(spark, dates.iso_weekday(F.lit("20240107"))) == 7.0
    assert dates.day_shift("20240301", -1) == "20240229"


def test_instants_do_not_depend_on_the_session_zone(spark):
    ms = 1_704_067_199_999  # 2023-12-31 23:59:59.999 UTC
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Shanghai"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert value(spark, dates.stamp_of(F.lit(ms))) == "2023-12-31 23:59:59"
            assert value(spark, dates.quarter_of_day(F.lit(ms))) == 95
            assert value(spark, dates.day_of(F.lit(ms))) == "20231231"
            assert value(spark, dates.stamp_to_ms(F.lit("20231231235959"))) == ms - 999
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_text_functions(spark):
    assert value(spark, text.ngram_jaccard(F.lit("A b"), F.lit("abc"), 2)) == 0.5
    assert value(spark, text.ngram_jaccard(F.lit("a"), F.lit("b"), 2)) == 0
    assert value(spark, text.level_set(F.lit("S,AS"))) == ["S", "A"]
    assert value(spark, text.delimited_union(F.lit("a,,b"), F.lit(None).cast("string"), F.lit("b,c"))) == ["a", "b", "c"]
    assert value(spark, text.region_bucket(F.lit("zz9"))) == 1295
    assert value(spark, text.salted_key(F.lit("app"), F.lit(" "), F.lit("user"), F.lit("1")))[3:] == "app.user.1"
    assert value(spark, text.multi_split(F.lit("a_b-a"), ["_", "-"])) == ["a", "b"]


def test_nested_functions(spark):
    pairs = value(spark, nested.combinations(F.array(F.lit("a"), F.lit("b"), F.lit("a"))))
    assert {(p.a, p.b) for p in pairs} == {("a", "b"), ("b", "a")}
    from pyspark.sql import types as T

    assert value(spark, nested.json_map(F.lit("not json"), T.LongType())) == {}
    assert value(spark, nested.json_text(F.lit('{"a":1}'), "$.b", "none")) == "none"


def test_feature_typing(spark):
    rows = spark.sql("""SELECT 'x' AS id, 2 AS i, 1.5D AS d, array(1, 2) AS a, array() AS e, map('k', 1.5D, 'n', CAST(NULL AS DOUBLE)) AS m,
        CAST(array() AS ARRAY<DOUBLE>) AS z, true AS dropped""")
    row = nested.normalise_features(rows, keep=("id",)).first().asDict()
    assert row == {"id": "x", "i": [2.0], "d": [1.5], "a": [1.0, 2.0], "m": {"k": 1.5}, "z": None}


def test_draws_repeat_and_stay_in_range(spark):
    rows = spark.range(2000).select(uniform("s", "id").alias("u"), draw_below(15, "s", "id").alias("n"))
    again = spark.range(2000).repartition(7).select(uniform("s", "id").alias("u"))
    us = sorted(r.u for r in rows.collect())
    assert us == sorted(r.u for r in again.collect())
    assert 0 <= us[0] and us[-1] < 1 and abs(sum(us) / len(us) - 0.5) < 0.03
    assert {r.n for r in rows.collect()} == set(range(15))


def test_sql_functions(spark):
    sql.register(spark)
    row = spark.sql("""SELECT shoal_wilson(3D, 10D) AS w, shoal_safe_ratio(1D, 0D) AS r, shoal_round_step(-0.125D, 100) AS s,
        shoal_cosine(array(1D, 0D), array(0D, 0D)) AS c, shoal_ngram_jaccard('A b', 'abc', 2) AS j""").first()
    assert row.w == pytest.approx(value(spark, numeric.wilson(F.lit(3), F.lit(10))))
    assert (row.r, row.s, row.c, row.j) == (0, -0.12, 0, 0.5)

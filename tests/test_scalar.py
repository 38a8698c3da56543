from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from telemetry_ops.functions import fixed_text, lcg, nan_to_null, python_round


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.floats(-1e6, 1e6), st.integers(-10 ** 6, 10 ** 6).map(lambda i: i / 100 + 0.005),
                          st.integers(-10 ** 5, 10 ** 5).map(lambda i: i / 20)), min_size=50, max_size=200))
def test_rounds_as_python(spark, values):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i long, v double")
    rows = df.select("i", "v", *[python_round(F.col("v"), d).alias(f"r{d}") for d in (0, 1, 2, 4)],
                     fixed_text(F.abs("v"), 1).alias("t")).collect()
    for r in rows:
        assert all(r[f"r{d}"] == round(r["v"], d) for d in (0, 1, 2, 4)), r
        assert r["t"] == f"{abs(r['v']):.1f}"


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    assert [r[0] for r in df.select(nan_to_null("v")).collect()] == [None, 1.0, None]


def test_draws_repeat_and_take_any_id(spark):
    df = spark.createDataFrame([(i,) for i in (0, 5, -3, 2 ** 62, -2 ** 63)], "id long")
    once, again = (sorted(r[0] for r in df.select(lcg("id", 42)).collect()) for _ in range(2))
    assert once == again and all(0 <= v < 2147483647 for v in once)

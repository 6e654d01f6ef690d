from pyspark.sql import functions as F

from reelmart.operators import profile, quality


def test_rules(spark):
    df = spark.createDataFrame([(1, "F", -1.0, 5.0), (1, "X", 2.0, None), (None, None, None, 11.0)],
                               "k long, s string, m double, r double")
    assert quality.failing(df, quality.NotNull("k")).count() == 1
    assert [tuple(r) for r in quality.failing(df, quality.Unique("k")).collect()] == [(1, 2)]
    assert quality.failing(df, quality.UniqueCombination(("k",))).count() == 1
    assert [tuple(r) for r in quality.failing(df, quality.AcceptedValues("s", ("F",))).collect()] == [("X", 1)]
    assert quality.failing(df, quality.NonNegative("m")).count() == 1
    assert quality.failing(df, quality.AcceptedRange("r", 0, 10)).count() == 1
    parent = spark.createDataFrame([(1,)], "pk long")
    child = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    assert [r.k for r in quality.failing(child, quality.Relationship("k", parent, "pk")).collect()] == [2]


def test_run_checks(spark):
    df = spark.createDataFrame([(1, -1.0), (1, None)], "k long, m double")
    out = {(r.check_name, r.column_name): r.failures for r in quality.run_checks([
        ("t", df, quality.NotNull("m")), ("t", df, quality.NonNegative("m")),
        ("t", df, quality.Unique("k"))]).collect()}
    assert out == {("not_null", "m"): 1, ("non_negative", "m"): 1, ("unique", "k"): 1}


def test_coverage_and_stats(spark):
    df = spark.createDataFrame([(0.0, ""), (2.0, "x"), (4.0, None), (None, "y")], "a double, b string")
    cov = {r.rule: (r.k, r.n, r.rate) for r in profile.coverage(df, {
        "a present": profile.truthy("a"), "b present": profile.truthy("b"),
        "a > 1": F.col("a") > 1}).collect()}
    assert cov == {"a present": (2, 4, 0.5), "b present": (2, 4, 0.5), "a > 1": (2, 4, 0.5)}
    st = profile.numeric_stats(df, ["a"]).first()
    assert (st["min"], st["max"], st["mean"], st["median"], st["n"]) == (2.0, 4.0, 3.0, 3.0, 2)
    empty = spark.createDataFrame([], "a double, b string")
    assert profile.coverage(empty, {"a": profile.truthy("a")}).first()["rate"] == 0.0

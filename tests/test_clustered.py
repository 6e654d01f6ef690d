"""Tables by range: files pruned by statistics, positions in the total order."""

from pyspark.sql import functions as F

from reelmart.operators.clustered import clustered, with_position
from reelmart.sources import as_table


def _hot(spark, n=20_000):
    """A third of the rows in one tier, some with none."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, F.lit("m")).when(i % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("t"), i % 40)).alias("tier"),
        i, (i * 7919 % 1000).alias("v"))


def _scanned(df) -> int:
    """Rows that the file scan of an executed plan gave."""
    qe = df._jdf.queryExecution()
    qe.executedPlan().executeCollect()
    plan = qe.executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_filter_reads_few_files(spark, scratch):
    stored = as_table(clustered(_hot(spark), ["tier"], ["id"], 32), f"{scratch}/t")
    per_file = [r[0] for r in stored.groupBy("_metadata.file_path").count().select("count").collect()]
    assert len(per_file) == 32 and max(per_file) < 2 * 20_000 / 32  # the hot tier is split
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        one = stored.filter("tier = 't7'")
        assert 0 < _scanned(one) <= 3 * max(per_file)
        assert _scanned(stored.filter("tier = 'm' AND id BETWEEN 0 AND 100")) <= 2 * max(per_file)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert one.count() == _hot(spark).filter("tier = 't7'").count()


def test_positions(spark, scratch):
    df = _hot(spark, 5_000)
    stored = as_table(clustered(df, ["tier", "v"], ["id"], 16), f"{scratch}/t")
    got = {r.id: r.position for r in with_position(stored, ["tier", "v"], ["id"]).collect()}
    rows = sorted(df.collect(), key=lambda r: (r.tier is not None, r.tier or "", r.v, r.id))
    assert got == {r.id: i for i, r in enumerate(rows, 1)}


def test_ties_and_empty(spark, scratch):
    same = spark.range(100).select(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"))
    stored = as_table(clustered(same, ["a"], ["b"], 8), f"{scratch}/same")
    assert sorted(r.position for r in with_position(stored, ["a"], ["b"]).collect()) == list(range(1, 101))
    empty = as_table(clustered(same.limit(0), ["a"], ["b"], 8), f"{scratch}/empty")
    assert with_position(empty, ["a"], ["b"]).count() == 0

"""Tables stored by the buckets of one key, so that joins on it need no shuffle.

The fact, the bridges and the snapshot all meet on ``movie_id``. Stored with
Spark's bucketing on that key, and with equally many buckets, two of them join
bucket by bucket: neither side is exchanged, whatever the number of marts that
read them.

A bucket is read by one task, so a key that holds much more than a bucket's
share must not stay in one. Writing splits such a key over tasks (a rebalance by
the key), and the keys with more than ``factor`` times the mean bucket are noted
(by counting, at most ``buckets / factor`` of them). ``join`` takes these keys'
rows out of the bucketed join and joins them as ordinary scans, which Spark
splits; ``frame`` gives a table that has such keys as an ordinary scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.session import checkpoint_dir


class CoStored:
    """Tables of one key in one bucketing, in the session's catalog.

    ``buckets``: about one per GB of the largest table. Every ``put`` writes a
    new folder under ``path`` (the shared checkpoint folder by default); nothing
    is overwritten, and a table put again replaces the old one for later reads.
    """

    def __init__(self, spark: SparkSession, key: str, buckets: int = 64, factor: float = 4.0,
                 path: str | None = None):
        self.spark, self.key, self.buckets, self.factor = spark, key, buckets, factor
        self.path = (path or f"{checkpoint_dir(spark)}/costored-{uuid.uuid4().hex}").rstrip("/")
        self.tables: dict[str, tuple[str, str, list]] = {}

    def put(self, label: str, df: DataFrame) -> DataFrame:
        """Store ``df`` under ``label`` and return it as ``frame`` does.

        ``df`` is evaluated once. Rows with a NULL key are stored as well.
        """
        name = f"{label}_{uuid.uuid4().hex}"
        folder = f"{self.path}/{name}"
        # a bucket to a task; a partition that is too large is split, its bucket gets several files
        (df.hint("rebalance", self.buckets, self.key)
         .write.bucketBy(self.buckets, self.key).sortBy(self.key)
         .option("path", folder).saveAsTable(name))
        # key counts from the plain files, combined before they are shuffled
        per_key = self.spark.read.schema(df.schema).parquet(folder).groupBy(self.key).count()
        total = F.broadcast(per_key.agg(F.sum("count").alias("total")))
        limit = F.col("total") * F.lit(self.factor / self.buckets)
        # each has over factor / buckets of the rows: at most buckets / factor keys
        hot = per_key.join(total, F.col("count") > limit, "inner").filter(F.col("count") > 1)
        self.tables[label] = (name, folder, [r[0] for r in hot.select(self.key).collect()])
        return self.frame(label)

    def hot_keys(self, label: str) -> list:
        """Keys (NULL possibly among them) beyond a bucket's share."""
        return self.tables[label][2]

    def bucketed(self, label: str) -> DataFrame:
        """The stored table as Spark's bucketed table."""
        return self.spark.table(self.tables[label][0])

    def plain(self, label: str) -> DataFrame:
        """The same rows as an ordinary Parquet scan."""
        return self.spark.read.schema(self.bucketed(label).schema).parquet(self.tables[label][1])

    def frame(self, label: str) -> DataFrame:
        """The table for any plan: bucketed, or plain where a key is hot.

        Frames of two tables without hot keys join without a shuffle; a plain
        one is shuffled, and AQE splits its large partitions.
        """
        return self.plain(label) if self.hot_keys(label) else self.bucketed(label)

    def join(self, left: str, right: str) -> DataFrame:
        """Inner join of two tables on the key.

        All but the hot keys of either side join bucket by bucket. The rows of
        the hot keys, found by a pushed-down filter, join beside them. A NULL
        key matches nothing.
        """
        hot = [k for k in {*self.hot_keys(left), *self.hot_keys(right)} if k is not None]
        if not hot:
            return self.bucketed(left).join(self.bucketed(right), self.key, "inner")

        is_hot = F.col(self.key).isin(hot)
        level = self.bucketed(left).filter(~is_hot).join(self.bucketed(right).filter(~is_hot), self.key, "inner")
        apart = self.plain(left).filter(is_hot).join(self.plain(right).filter(is_hot), self.key, "inner")
        return level.unionByName(apart)

"""Helpers shared by the operators: clean input columns and shared tables.

Intermediate tables are written as Parquet under the folder the session
names in ``spark.checkpoint.dir`` (a local scratch folder only where that is
unset, as in tests). They cut lineage, survive lost executors and, unlike a
cached frame, keep column pruning and size statistics.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.session import checkpoint_dir

#: Characters that separate words: space, and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"


def find_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from its place.

    A cluster gets the package as any other (``--py-files`` or installed).
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, null taken as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The maximal runs of non-separator characters, in order; [] if none."""
    body = F.trim(text, F.lit(SPACE_CHARS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(
        F.split(body, r"[\x20\x09-\x0D]+"))


def row_key(id_col: str, text: Column) -> Column:
    """16 bytes that stand for a row's id and text; equal rows share them."""
    half = lambda k: F.lpad(F.hex(F.xxhash64(F.lit(k), F.col(id_col), text)), 16, "0")
    return F.unhex(F.concat(half(1), half(2)))


#: Bytes up to which a table of known row width is broadcast.
SMALL = 64 << 20


def if_small(df: DataFrame, row_bytes: int, most: int = SMALL) -> DataFrame:
    """``df``, a stored table, to be broadcast if its rows take ``most`` bytes at most."""
    return F.broadcast(df) if df.count() * row_bytes <= most else df


#: Text that a Python worker turns into objects at a time, in bytes.
PIECE = 4 << 20


def pieces(batches, most: int = PIECE):
    """Slices of Arrow batches of about ``most`` bytes, at least one row each.

    A batch may hold thousands of long texts; as Python objects at once they
    would take a worker several hundred megabytes.
    """
    for b in batches:
        rows = max(1, b.num_rows * most // max(b.nbytes, 1))
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


#: Lets a finished write remove the shuffle files that only it has read.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Shared:
    """Tables written once to the shared folder and read back.

    ``drop`` deletes a table that nothing will read again; the rest goes with
    the application's checkpoint folder.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        self.paths: dict[int, str] = {}

    def table(self, df: DataFrame, name: str, observe=None) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        out = df.observe(observe[0], *observe[1]) if observe else df
        before = self.spark.conf.get(CLEAN, "false")
        self.spark.conf.set(CLEAN, "true")
        try:
            out.write.parquet(path)
        finally:
            self.spark.conf.set(CLEAN, before)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        return back

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for t in tables:
            path = self.paths.pop(id(t), None)
            if path:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

"""Parquet tables in shared folders: written once, or versioned with a manifest.

``write_once`` stores a model that several plans of a job read. ``Versioned``
is a table that is never overwritten in place: every commit writes new data
folders and then a manifest that names the folders in force. A manifest is
written aside and renamed to its number, which fails if the number is taken:
readers see whole commits only, a run that dies at any point leaves the old
version, and of two writers one fails instead of undoing the other.

A keyed table is a base, split into key buckets, and a few deltas. ``merge``
writes its updates as one more delta, so its cost follows the updates and not
the table; reading takes the newest row of each key. ``compact`` folds the
deltas into the buckets that they touch, one file each, once they are many or
large. ``add`` appends rows in a folder per value of a column (a day), and
``vacuum`` deletes folders that no recent manifest names.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelmart.operators.incremental import assert_unique
from reelmart.operators.windows import latest_per_key
from reelmart.session import checkpoint_dir


#: The number of parts of a shuffle, before adaptive execution joins small ones.
SHUFFLES = "spark.sql.shuffle.partitions"
#: Whether the shuffle files of a statement are deleted when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Whether a VARIANT is written as a column per field instead of as one value.
SHREDDING = "spark.sql.variant.writeShredding.enabled"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """The named settings of this module held at ``values``, then as before."""
    before = {key: spark.conf.get(key) for key in (globals()[name] for name in values)}
    for name, value in values.items():
        spark.conf.set(globals()[name], value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def write_once(df: DataFrame, label: str, parts: int = 0, shredded: bool = True) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back.

    Its shuffles deal the rows into ``parts`` at least, if the session names
    fewer: what a task sorts then stays in memory instead of being spilled. They
    are deleted once the rows are stored. ``shredded`` False keeps a VARIANT in
    one piece: larger files, but no payload is taken apart and put together
    again, which pays where readers take most of it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    shuffles = str(max(int(spark.conf.get(SHUFFLES)), parts))
    shredding = "false" if not shredded else spark.conf.get(SHREDDING)
    with settings(spark, SHUFFLES=shuffles, CLEANUP="true", SHREDDING=shredding):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A merge compacts from so many deltas on, or once they hold this share of the base's rows.
MAX_DELTAS, DELTA_SHARE = 8, 0.25


class Versioned:
    """A versioned Parquet table at ``path``.

    Layout: ``data/<commit>/[__part=<value>/]*.parquet`` and
    ``manifest/<number>.json`` = {"schema", "folders", "rows", "deltas", "keys",
    "buckets", "streams", "notes"}; the highest number is in force. ``folders``
    maps a bucket, or a commit's partition value, to its folder; ``deltas`` lists
    the merges since the last compaction. A manifest lists a folder per bucket,
    or per added partition.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _numbers(self) -> list[int]:
        fs, p = self._fs(f"{self.path}/manifest")
        if not fs.exists(p):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _manifest(self, number: int) -> dict:
        fs, p = self._fs(f"{self.path}/manifest/{number}.json")
        stream = fs.open(p)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text) | {"version": number}

    def manifest(self) -> dict | None:
        """The manifest in force; None for a table that was never written.

        Anything else that goes wrong is raised: an unreadable table is not an
        empty one. Files of an unfinished commit are not looked at.
        """
        numbers = self._numbers()
        return self._manifest(numbers[-1]) if numbers else None

    def _publish(self, manifest: dict) -> int:
        number = (manifest.pop("version", 0) or 0) + 1
        fs, aside = self._fs(f"{self.path}/manifest/.{uuid.uuid4().hex}.tmp")
        _, final = self._fs(f"{self.path}/manifest/{number}.json")
        out = fs.create(aside, False)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        jvm = self.spark._jvm
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(aside).toUri(),
                                                                    self.spark._jsc.hadoopConfiguration())
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        never = self.spark.sparkContext._gateway.new_array(kind, 1)
        never[0] = kind.NONE  # a taken number is not overwritten
        try:
            files.rename(fs.makeQualified(aside), fs.makeQualified(final), never)
        except Exception:
            fs.delete(aside, False)
            raise
        return number

    def _write(self, df: DataFrame, part: str | None = None) -> tuple[str, int, dict[str, str]]:
        """(folder, rows, partition value -> folder) of ``df`` in a new data folder."""
        folder = f"data/{uuid.uuid4().hex}"
        writer = lambda d: (d.write.partitionBy(part) if part else d.write).option("compression", "zstd")
        with settings(self.spark, CLEANUP="true"):
            rows = write_counted(lambda d: lambda: writer(d).parquet(f"{self.path}/{folder}"), df)
        fs, p = self._fs(f"{self.path}/{folder}")
        names = [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()] if part else []
        return folder, rows, {n.split("=", 1)[1]: f"{folder}/{n}" for n in names if n.startswith(f"{part}=")}

    def _load(self, folders: Sequence[str], schema: StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, parts: Callable[[str], bool] | None = None) -> DataFrame | None:
        """The table in force; None if never written. ``parts`` tells which
        partition values (as in folder names) are read, of the base's folders."""
        m = self.manifest()
        return None if m is None else self._state(m, parts)

    def _state(self, m: dict, parts=None) -> DataFrame:
        schema = StructType.fromJson(m["schema"])
        base = self._load([f for k, f in m["folders"].items() if parts is None or parts(k.split("#")[0])], schema)
        return _newest(base, self._deltas(m, schema), m["keys"])

    def _deltas(self, m: dict, schema: StructType) -> DataFrame | None:
        """All delta rows with the number of their delta."""
        out = None
        for i, delta in enumerate(m["deltas"]):
            rows = self._load([delta["folder"]], schema).withColumn("__delta", F.lit(i))
            out = rows if out is None else out.unionByName(rows)
        return out

    def _new(self, schema: StructType, m: dict | None, **changes) -> dict:
        empty = {"folders": {}, "rows": 0, "deltas": [], "keys": [], "buckets": 1, "streams": {}, "notes": {}, "version": 0}
        return empty | (m or {}) | {"schema": schema.jsonValue()} | changes

    def replace(self, df: DataFrame) -> int:
        """A full rebuild as a new version; ``df`` may read the old one."""
        m = self.manifest()
        folder, rows, _ = self._write(df)
        return self._publish(self._new(df.schema, m, folders={"0": folder}, rows=rows, deltas=[], keys=[], buckets=1))

    def add(self, df: DataFrame, part: str, notes: dict | None = None) -> int:
        """Append rows in a folder per value of ``part``, all in one commit.

        ``notes`` are stored with the commit. Returns the number of rows. A
        first ``add`` of no rows makes an empty table.
        """
        m = self.manifest()
        # a file or few per value; values of many rows are split over tasks
        parted = df.withColumn("__part", F.col(part)).hint("rebalance", "__part")
        folder, rows, made = self._write(parted, "__part")
        if not rows and m and not notes:
            self._fs(f"{self.path}/{folder}")[0].delete(self._fs(f"{self.path}/{folder}")[1], True)
            return 0
        commit = folder.rsplit("/", 1)[1]
        folders = (m["folders"] if m else {}) | {f"{k}#{commit}": f for k, f in made.items()}
        self._publish(self._new(df.schema, m, folders=folders, rows=(m["rows"] if m else 0) + rows,
                                notes=(m["notes"] if m else {}) | (notes or {})))
        return rows

    def merge(self, updates: DataFrame, keys: Sequence[str], buckets: int = 64,
              stream: tuple[str, int] | None = None, check_unique: bool = True) -> int | None:
        """Merge ``updates`` by key, as a delta of only these rows.

        ``buckets`` holds for a new table and is kept by an old one. ``stream``
        = (stream id, batch id): a batch that is in the table already, as a
        replayed one, changes nothing. Returns the version written, None if
        nothing was.
        """
        keys, m = list(keys), self.manifest()
        if stream and m and m["streams"].get(stream[0], -1) >= stream[1]:
            return None
        if m and m["keys"] != keys:
            raise ValueError(f"the table is keyed by {m['keys']}, not {keys}")
        streams = (m["streams"] if m else {}) | ({stream[0]: stream[1]} if stream else {})
        if m:
            updates = updates.select(*[f["name"] for f in m["schema"]["fields"]])
        if check_unique:
            updates = assert_unique(updates, keys)
        if m is None:
            folder, rows, made = self._write(_bucketed(updates, keys, buckets), "__part")
            return self._publish(self._new(updates.schema, None, folders=made, rows=rows, keys=keys, buckets=buckets,
                                           streams=streams))
        folder, rows, _ = self._write(updates)
        if not rows:
            self._fs(f"{self.path}/{folder}")[0].delete(self._fs(f"{self.path}/{folder}")[1], True)
            return None
        m = m | {"deltas": [*m["deltas"], {"folder": folder, "rows": rows}], "streams": streams}
        many = sum(d["rows"] for d in m["deltas"]) > DELTA_SHARE * m["rows"]
        return self._publish(self._folded(m) if many or len(m["deltas"]) > MAX_DELTAS else m)

    def compact(self) -> int | None:
        """Fold the deltas into the buckets that they touch; None without deltas."""
        m = self.manifest()
        return self._publish(self._folded(m)) if m and m["deltas"] else None

    def _folded(self, m: dict) -> dict:
        schema, keys = StructType.fromJson(m["schema"]), m["keys"]
        bucket = F.pmod(F.xxhash64(*keys), F.lit(m["buckets"])).cast("int")
        deltas = self._deltas(m, schema)
        touched = {str(r[0]) for r in deltas.select(bucket).distinct().collect()}  # at most ``buckets``
        old = self._load([f for k, f in m["folders"].items() if k in touched], schema)
        held = old.count()
        _, rows, made = self._write(_bucketed(_newest(old, deltas, keys), keys, m["buckets"]), "__part")
        return m | {"folders": m["folders"] | made, "rows": m["rows"] - held + rows, "deltas": []}

    def vacuum(self, keep: int = 2, older_than: float = 7 * 86400.0) -> int:
        """Delete data folders that none of the newest ``keep`` manifests names
        and that are ``older_than`` seconds old (a commit may be under way).
        Returns how many went."""
        named = set()
        for number in self._numbers()[-keep:]:
            m = self._manifest(number)
            paths = [*m["folders"].values(), *(d["folder"] for d in m["deltas"]), *m["notes"].values()]
            named |= {"/".join(str(x).split("/")[:2]) for x in paths}
        fs, data = self._fs(f"{self.path}/data")
        gone = 0
        for f in fs.listStatus(data) if fs.exists(data) else []:
            old = f.getModificationTime() / 1000 < time.time() - older_than
            if old and f"data/{f.getPath().getName()}" not in named:
                gone += bool(fs.delete(f.getPath(), True))
        return gone


def _bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` dealt by its key bucket, a bucket to a task: one file each."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    return df.withColumn("__part", bucket).repartition(buckets, "__part")


def _newest(base: DataFrame, deltas: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """The base under its deltas: each key's row of the last delta that has it.

    The deltas' few keys are joined away from the base, which Spark broadcasts
    by their size, so the base is scanned and not shuffled.
    """
    if deltas is None:
        return base
    last = latest_per_key(deltas, list(keys), [F.col("__delta").desc()]).select(*base.columns)
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    own = last.select(*[F.col(k).alias(f"__{k}") for k in keys])
    return base.join(own, reduce(and_, same), "left_anti").unionByName(last)


def write_counted(writer_of, df: DataFrame) -> int:
    """Write ``df`` with ``writer_of(df)`` and count its rows in the same job."""
    seen = Observation()
    writer_of(df.observe(seen, F.count(F.lit(1)).alias("n")))()
    return seen.get["n"]

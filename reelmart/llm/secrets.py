"""Secret scans over an incremental blob ledger.

Every historical version of every path is content-addressed by its SHA-256.
The ledger records which (blob, rule, rule version) pairs have been scanned;
``scan`` asks the ledger by hash alone, moves the texts of blobs with unseen
pairs, runs these once per distinct blob however many paths hold it, appends their findings, and ``report`` joins all findings back to all
paths. A run's findings are written before its ledger entries, and findings
count only once their run is in the ledger, so a run that dies half-way is
simply scanned again.

Findings hold positions and the hash of the matched value, never the value.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.llm import spans as sp
from reelmart.llm._common import SMALL, Shared, text_of


@dataclass(frozen=True)
class Rule:
    """A pattern, a check of each match, and a version to raise on any change."""
    kind: str
    pattern: str
    version: int = 1
    needs: str | None = None
    value: str = r"^(.*)$"  # what of the match is the secret
    least: int = 1  # characters of the secret
    base: bool = False


# fixed values: the formats of the scanned secrets
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
         value=r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$""",
         least=6, base=True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", needs="AKIA", least=20, base=True),
    Rule("hex", r"[0-9a-f]{24,}", least=24, base=True),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----", needs="PRIVATE KEY-----"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+",
         needs="eyJ"),
    Rule("hub_token", r"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("chat_token", r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}+", needs="xox"),
    Rule("api_id", r"(?<![A-Za-z0-9_-])AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])", needs="AIza"),
)


def value_of(rule: Rule, match: Column) -> Column:
    return F.regexp_extract(match, rule.value, 1) if rule.value != r"^(.*)$" else match


class Ledger:
    """The scanned (blob, rule, version) pairs and their findings at a path."""

    SCANNED = "run string, blob string, kind string, version int"
    FINDINGS = ("run string, blob string, kind string, version int, is_base boolean, "
                "start bigint, end bigint, value_sha256 string")

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        return self.spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        return self._read("scanned", self.SCANNED)

    def findings(self) -> DataFrame:
        """Findings of finished runs."""
        runs = self.scanned().select("run").distinct()
        return self._read("findings", self.FINDINGS).join(runs, "run", "left_semi").drop("run")

    def append(self, run: str, findings: DataFrame, scanned: DataFrame) -> None:
        findings.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{self.path}/findings")
        scanned.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{self.path}/scanned")


def blob_of(text_col: str = "text") -> Column:
    return F.sha2(text_of(text_col), 256)


#: Bytes of an unseen blob's hash and rule versions, broadcast.
TODO_BYTES = 400


def unseen(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES,
           text_col: str = "text") -> DataFrame:
    """``blob, todo``: the rule versions (kind@version) that each blob still lacks.

    Hashes only; blobs that lack none are left out.
    """
    hashes = versions.select(blob_of(text_col).alias("blob")).distinct()
    keys = [f"{r.kind}@{r.version}" for r in rules]
    key = F.concat_ws("@", "kind", "version")
    seen = (ledger.scanned().select("blob", key.alias("key")).filter(F.col("key").isin(keys))
            .groupBy("blob").agg(F.collect_set("key").alias("seen")))  # at most one per rule
    todo = F.array_except(F.array(*[F.lit(k) for k in keys]), F.coalesce("seen", F.array().cast("array<string>")))
    return hashes.join(seen, "blob", "left").select("blob", todo.alias("todo")).filter(F.size("todo") > 0)


def scan(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES,
         text_col: str = "text", small: int = SMALL) -> None:
    """Scan the unseen (blob, rule version) pairs of ``versions`` into the ledger.

    The ledger is asked by hash first. While the unseen blobs' hashes take at
    most ``small`` bytes they are broadcast, and texts without an unseen pair
    never leave their task; beyond, texts meet them by a shuffle join. Copies
    of a blob are collapsed on the map side before the text moves, so a blob
    with a third of all rows is scanned once. A blob that some rules have seen
    is scanned by the others only. Null texts are the empty blob. Without an
    unseen pair the ledger stays as it is.
    """
    run, shared = uuid.uuid4().hex, Shared(ledger.spark, "secrets")
    wanted = {r.kind: r for r in rules}
    pairs = shared.table(unseen(versions, ledger, rules, text_col), "todo")
    n = pairs.count()
    if n == 0:
        shared.drop(pairs)
        return
    texts = versions.select(blob_of(text_col).alias("blob"), text_of(text_col).alias("text"))
    few = n * TODO_BYTES <= small
    if few:
        texts = texts.join(F.broadcast(pairs.select("blob")), "blob", "left_semi")
    blobs = texts.groupBy("blob").agg(F.first("text").alias("text"))
    todo = blobs.join(F.broadcast(pairs) if few else pairs, "blob")
    kind = "array<struct<gap:int,match:string,before:string,after:string>>"
    arrays = []
    for r in rules:
        pending = F.array_contains("todo", f"{r.kind}@{r.version}")
        arrays.append(F.when(pending, sp.found(F.col("text"), r.pattern, r.needs))
                      .otherwise(F.array().cast(kind)).alias(f"at_{r.kind}"))
    scanned = shared.table(todo.select("blob", "todo", *arrays), "scanned")
    at = sp.positions(scanned, "blob", list(wanted))
    value, least = F.col("match"), F.lit(1)
    base, version = F.lit(False), F.lit(0)
    for r in rules:
        here = F.col("kind") == r.kind
        value = F.when(here, value_of(r, F.col("match"))).otherwise(value)
        least = F.when(here, r.least).otherwise(least)
        base = F.when(here, r.base).otherwise(base)
        version = F.when(here, r.version).otherwise(version)
    findings = (at.withColumn("value", value).filter(F.length("value") >= least)
                .select("blob", "kind", version.alias("version"), base.alias("is_base"), "start", "end",
                        F.sha2("value", 256).alias("value_sha256")))
    done = scanned.select("blob", F.explode("todo").alias("key")).select(
        "blob", F.split_part("key", F.lit("@"), F.lit(1)).alias("kind"),
        F.split_part("key", F.lit("@"), F.lit(2)).cast("int").alias("version"))
    ledger.append(run, findings, done)
    shared.drop(scanned, pairs)


def current(ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of the given rule versions, each once."""
    key = F.concat_ws("@", "kind", "version")
    return (ledger.findings().filter(key.isin([f"{r.kind}@{r.version}" for r in rules]))
            .dropDuplicates(["blob", "kind", "start", "end"]))


def totals(ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob, n_findings`` of the blobs with findings of the given rule versions."""
    return current(ledger, rules).groupBy("blob").agg(F.count(F.lit(1)).alias("n_findings"))


def report(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES,
           id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Findings of the given rule versions for every path: one row per version.

    Columns: ``id, blob, keep..., n_<base kind>..., base_sha256, spans``. A
    version without findings has zeros and an empty list; an empty table gives
    no rows.
    """
    base = [r.kind for r in rules if r.base]
    order = [*base, *[r.kind for r in rules if not r.base]]
    paths = versions.select(F.col(id_col).alias("id"), blob_of(text_col).alias("blob"), *keep)
    # a table of its own, so that the join may split a blob with many paths
    digests = Shared(ledger.spark, "secrets").table(sp.digest(current(ledger, rules), "blob", base, order), "digests")
    return sp.with_digest(paths, digests, "blob", base)

"""Incremental secret scans over every historical version of a set of files.

Each version's text is content-addressed; a ledger of (blob, rule version) pairs tells which
blobs a rule set has seen, only unseen pairs are scanned, and the findings are joined back to
all paths that ever held the blob. Built-in functions only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.llm.common import small_side, written


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, the group whose length counts, and its least length."""

    kind: str
    pattern: str
    group: int
    least: int


# The patterns and least lengths of the base rules, in their order. Keywords are
# spelled with both cases of each ASCII letter.
_KEYWORDS = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token", "api_?key"))
RULES = (
    Rule("assign", rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", "AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", "[0-9a-f]{16,}", 0, 16),
)
RULE_VERSION = "base-1"
FINDING = "blob string, rule_version string, kind string, kind_order int, start long, end long"
LEDGER = "blob string, rule_version string"


def blob_id(text: Column) -> Column:
    """Content address of a version: lower-case SHA-256; a null text is an empty one."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def unseen_blobs(versions: DataFrame, ledger: DataFrame | None, rule_version: str = RULE_VERSION,
                 text_col: str = "text") -> DataFrame:
    """Distinct (blob, text) that the ledger lacks for this rule version."""
    blobs = versions.select(blob_id(F.col(text_col)).alias("blob"),
                            F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == rule_version).select("blob").distinct()
        blobs = blobs.join(seen, "blob", "left_anti")
    return blobs.dropDuplicates(["blob"])


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES,
               rule_version: str = RULE_VERSION) -> DataFrame:
    """One row per finding: blob, rule version, kind, its order, start and end.

    Matches are leftmost and do not overlap within a kind; those whose group is too short are
    dropped after matching. Offsets are code points, the end exclusive. They come from the
    lengths of the pieces between matches, added up in order.
    """
    none = F.array().cast("array<struct<kind:string,kind_order:int,least:int,place:int,"
                          "gap:int,match:int,counted:int>>")

    def matched(order: int, rule: Rule) -> Column:
        pattern = F.lit(rule.pattern)
        gaps = F.split("text", rule.pattern, -1)
        matches = F.regexp_extract_all("text", pattern, F.lit(0))
        counted = F.regexp_extract_all("text", pattern, F.lit(rule.group)) if rule.group else matches
        zipped = F.arrays_zip(gaps.alias("gap"), matches.alias("match"), counted.alias("counted"))
        found = F.transform(zipped, lambda p, i: F.struct(
            F.lit(rule.kind).alias("kind"), F.lit(order).alias("kind_order"),
            F.lit(rule.least).alias("least"), i.alias("place"),
            F.length(p["gap"]).alias("gap"), F.length(p["match"]).alias("match"),
            F.length(p["counted"]).alias("counted")))
        return F.when(F.col("text").rlike(rule.pattern), found).otherwise(none)

    pieces = (blobs.select("blob", F.explode(F.concat(
        *[matched(order, rule) for order, rule in enumerate(rules)])).alias("piece"))
        .select("blob", "piece.*").where(F.col("match").isNotNull()))
    so_far = (Window.partitionBy("blob", "kind").orderBy("place")
              .rowsBetween(Window.unboundedPreceding, 0))
    end = F.sum(F.col("gap") + F.col("match")).over(so_far)
    return (pieces.withColumn("end", end).where(F.col("counted") >= F.col("least"))
            .select("blob", F.lit(rule_version).alias("rule_version"), "kind", "kind_order",
                    (F.col("end") - F.col("match")).cast("long").alias("start"),
                    F.col("end").cast("long").alias("end")))


def ledger_rows(blobs: DataFrame, rule_version: str = RULE_VERSION) -> DataFrame:
    """Ledger entries for scanned blobs; append them once their findings are stored."""
    return blobs.select("blob", F.lit(rule_version).alias("rule_version"))


def blob_reports(findings: DataFrame) -> DataFrame:
    """One row per blob with findings: counts per base kind and its spans as text."""
    spans = F.array_sort(F.collect_list(F.struct("start", "kind_order", "end", "kind")))
    text = F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.count_if(F.col("kind") == rule.kind).cast("long").alias(f"n_{rule.kind}") for rule in RULES]
    return findings.groupBy("blob").agg(*counts, text.alias("spans"))


def located(versions: DataFrame, findings: DataFrame, text_col: str = "text") -> DataFrame:
    """Every version row with its blob, its counts and its spans (empty if it holds none).

    Repeated rows, null and empty texts each keep their row. Reports exist for blobs with
    findings only; they are stored, and broadcast while their counted bytes allow it, so a blob
    that most paths hold is no hot key.
    """
    added = ("blob", "spans", *(f"n_{rule.kind}" for rule in RULES))
    kept = [c for c in versions.columns if c not in added]
    rows = versions.withColumn("blob", blob_id(F.col(text_col))).select(*kept, "blob")
    reports = written(blob_reports(findings), "reports")
    n_bytes = reports.agg(F.sum(F.octet_length("spans") + 160)).first()[0] or 0
    joined = rows.join(small_side(reports, n_bytes, 1), "blob", "left")
    return joined.select(*kept, "blob",
                         *[F.coalesce(F.col(f"n_{rule.kind}"), F.lit(0)).cast("long").alias(f"n_{rule.kind}")
                           for rule in RULES], F.coalesce("spans", F.lit("")).alias("spans"))


class Ledger:
    """Findings and scanned blobs of all runs, below one shared folder.

    A run stores its findings first and then the blobs it has scanned. A run that ends between
    the two has not happened: its blobs are scanned again and its findings are not read.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _stored(self, kind: str, schema: str) -> DataFrame:
        """Rows of all finished runs, with their ``run``."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/scanned")
        system = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        runs = [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []
        done = [r for r in runs if system.exists(self._under(path, r))]
        if not done:
            return self.spark.createDataFrame([], f"{schema}, run string")
        return (self.spark.read.schema(f"{schema}, run string").option("basePath", f"{self.folder}/{kind}")
                .parquet(*[f"{self.folder}/{kind}/{r}" for r in sorted(done)]))

    def _under(self, path, run: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, f"{run}/_SUCCESS")

    def scanned(self) -> DataFrame:
        """(blob, rule_version, run) of what has been scanned."""
        return self._stored("scanned", LEDGER)

    def findings(self, rule_version: str = RULE_VERSION) -> DataFrame:
        """Findings of the rule version in all blobs scanned so far, each once."""
        found = self._stored("findings", FINDING).where(F.col("rule_version") == rule_version)
        return found.drop("run").distinct()

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION,
             text_col: str = "text") -> int:
        """Scans the blobs of ``versions`` that the ledger lacks for the rule version; returns how many."""
        run = f"run={uuid.uuid4().hex[:16]}"
        seen = self.scanned()
        ids = versions.select(blob_id(F.col(text_col)).alias("blob")).distinct().join(
            seen.where(F.col("rule_version") == rule_version).select("blob"), "blob", "left_anti")
        fresh = written(ids, "fresh-blobs")
        n = fresh.count()
        if n:
            blobs = unseen_blobs(versions, seen, rule_version, text_col)
            scan_blobs(blobs, rules, rule_version).write.parquet(f"{self.folder}/findings/{run}")
            ledger_rows(fresh, rule_version).write.parquet(f"{self.folder}/scanned/{run}")
        return n

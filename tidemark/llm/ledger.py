"""Secret scans over an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its text. The ledger keeps each text once, which paths carried
it, which rule versions have scanned it, and what they found. An update stores only unseen blobs and scans only unseen
pairs of blob and rule version: a new path with a known text costs no scan, and a changed rule scans the stored blobs with
that rule alone. Findings are joined back to all paths.

An update is numbered and writes its folders in the order blobs, paths, findings, scans. Only updates whose scans are there
count, so an update that failed leaves nothing behind, and its next run replaces its folders. One writer at a time.

All of it is DataFrame functions. A match's place follows from the lengths of the pieces before it, summed over its text in
order, so a text costs in proportion to its length. Prefilters are texts that every match of a rule holds.

Defined results: a null text is the empty text; a null path is a path; repeated rows are paths of their own; positions count
code points, ends are exclusive; matches of a rule are leftmost, do not overlap, and those that are too short are dropped
after they have taken their place; matches of different rules may overlap; an empty table gives no rows; extra columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.streaming import batches


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters; each holds one of ``gates`` in some letter case."""

    kind: str
    pattern: str
    gates: tuple[str, ...] = ()
    group: int = 0
    least: int = 0

    @property
    def version(self) -> str:
        return hashlib.sha256(f"{self.kind}\n{self.pattern}\n{self.group}\n{self.least}".encode()).hexdigest()[:16]


# Kinds and patterns of the contract, in its order. A run of hex digits or of capitals after AKIA is greedy, so
# a least length within the pattern finds the same places as a least length asked of the match.
BASE = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        2,
        8,
    ),
    Rule("access", "AKIA[A-Z0-9]{12,}", ("akia",)),
    Rule("hex", "[0-9a-f]{32,}"),
)
# Public formats of keys and tokens.
MORE = (
    Rule("github", "gh[oprsu]_[A-Za-z0-9]{36}", ("gho_", "ghp_", "ghr_", "ghs_", "ghu_")),
    Rule("google", "AIza[A-Za-z0-9_-]{35}", ("aiza",)),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", ("xox",)),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]{16,}", ("k_live_",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,1000}\.eyJ[A-Za-z0-9_-]{8,1000}\.[A-Za-z0-9_-]{8,}", ("eyj",)),
    Rule("pem", "-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----", ("private key-----",)),
    Rule("login", r"""://[^\x00-\x20/@:"']{1,64}:[^\x00-\x20/@:"']{3,128}@""", ("://",)),
)
RULES = (*BASE, *MORE)


def blob_id(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def found_by(rule: Rule, text: Column, low: Column, todo: Column) -> Column:
    """All matches of a rule, or null where it need not look."""
    gate = F.lit(not rule.gates)
    for part in rule.gates:
        gate = gate | F.contains(low, F.lit(part))
    wanted = F.array_contains(todo, rule.version) & gate
    return F.when(wanted, F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)))


def pieces_of(rule: Rule, place: int, found: Column, text: Column) -> Column:
    """For each match: the length of the text before it since the last match, its own length, and whether it counts."""
    gaps = F.slice(F.split(text, rule.pattern, -1), 1, F.size(found))

    def row(match: Column, gap: Column) -> Column:
        long_enough = F.length(F.regexp_extract(match, rule.pattern, rule.group)) >= rule.least if rule.least else F.lit(True)
        return F.struct(F.length(gap).alias("gap"), F.length(match).alias("size"), long_enough.alias("counts"))

    return F.when(
        F.size(found) > 0,
        F.struct(
            F.lit(place).alias("place"),
            F.lit(rule.version).alias("rule"),
            F.lit(rule.kind).alias("kind"),
            F.zip_with(found, gaps, row).alias("rows"),
        ),
    )


def scan(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """blob_id, rule, kind, place, start, end of all findings in ``blobs`` (blob_id, text, todo: rule versions)."""
    low = blobs.select("blob_id", "todo", "text", F.lower("text").alias("low"))
    text = F.col("text")
    found = low.select(
        "blob_id",
        "text",
        *[found_by(rule, text, F.col("low"), F.col("todo")).alias(f"found_{i}") for i, rule in enumerate(rules)],
    )
    by_rule = F.array(*[pieces_of(rule, i, F.col(f"found_{i}"), text) for i, rule in enumerate(rules)])
    some = found.where(" OR ".join(f"size(found_{i}) > 0" for i in range(len(rules))))
    each = some.select("blob_id", F.explode(F.filter(by_rule, lambda x: x.isNotNull())).alias("r"))
    matches = each.select("blob_id", "r.place", "r.rule", "r.kind", F.posexplode("r.rows").alias("i", "m"))
    matches = matches.select("blob_id", "place", "rule", "kind", "i", "m.*")
    in_order = Window.partitionBy("blob_id", "place").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = matches.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("size")).over(in_order)).where("counts")
    return placed.select("blob_id", "rule", "kind", "place", (F.col("end") - F.col("size")).alias("start"), "end")


class Ledger:
    """Blobs, paths, scans and findings below one folder all executors can reach."""

    def __init__(self, spark: SparkSession, folder: str, rules: Sequence[Rule] = RULES):
        if len({rule.kind for rule in rules}) < len(rules):
            raise ValueError("two rules of one kind")
        self.spark, self.folder, self.rules = spark, folder, tuple(rules)

    def updates(self) -> list[int]:
        """Numbers of the updates that are complete."""
        path, files = batches._hadoop(self.spark, f"{self.folder}/scans")
        if not files.exists(path):
            return []
        done = batches.batch_ids(self.spark, f"{self.folder}/scans")
        return [i for i in done if files.exists(path.suffix(f"/{batches.BATCH}={i}/_SUCCESS"))]

    def read(self, part: str, schema: str, updates: list[int] | None = None) -> DataFrame:
        updates = self.updates() if updates is None else updates
        if not updates:
            return self.spark.createDataFrame([], schema)
        paths = [batches.batch_path(f"{self.folder}/{part}", i) for i in updates]
        return self.spark.read.schema(schema).parquet(*paths)

    def blobs(self) -> DataFrame:
        return self.read("blobs", "blob_id binary, text string")

    def scans(self) -> DataFrame:
        """Pairs of blob and rule version that are done, as one list a blob and update."""
        return self.read("scans", "blob_id binary, todo array<string>")

    def update(self, versions: DataFrame, path_col: str = "doc_id", text_col: str = "text") -> int:
        """Take in versions of paths and scan what is new in blobs or rules; returns the number of the update."""
        done = self.updates()
        number = max(done, default=-1) + 1
        text = F.coalesce(F.col(text_col), F.lit(""))
        incoming = versions.select(F.col(path_col).alias("path"), text.alias("text")).withColumn("blob_id", blob_id(F.col("text")))
        wanted = F.array(*[F.lit(rule.version) for rule in self.rules])

        new = incoming.groupBy("blob_id").agg(F.first("text").alias("text"))
        seen = self.scans().groupBy("blob_id").agg(F.array_distinct(F.flatten(F.collect_list("todo"))).alias("seen"))
        if done:
            new = new.join(seen, "blob_id", "left_anti")
        batches.write_batch(new, f"{self.folder}/blobs", number)
        batches.write_batch(incoming.select("path", "blob_id"), f"{self.folder}/paths", number)

        work = self.read("blobs", "blob_id binary, text string", [number]).withColumn("todo", wanted)
        if done:
            left = seen.select("blob_id", F.array_except(wanted, "seen").alias("todo")).where(F.size("todo") > 0)
            if not left.isEmpty():
                work = work.union(self.blobs().join(left, "blob_id").select("blob_id", "text", "todo"))
        batches.write_batch(scan(work, self.rules), f"{self.folder}/findings", number)
        batches.write_batch(work.select("blob_id", "todo"), f"{self.folder}/scans", number)
        return number

    def findings(self) -> DataFrame:
        """blob_id, rule, kind, place, start, end, by the present versions of the rules."""
        found = self.read("findings", "blob_id binary, rule string, kind string, place int, start long, end long")
        return found.where(F.col("rule").isin([rule.version for rule in self.rules]))

    def paths(self) -> DataFrame:
        """Every version of every path taken in, with its blob."""
        return self.read("paths", "path long, blob_id binary")

    def report(self) -> DataFrame:
        """Of every path version: path, blob_id and its findings in order (start, place, end, kind)."""
        place = F.create_map(*[F.lit(x) for i, rule in enumerate(self.rules) for x in (rule.kind, i)])
        one = F.struct("start", place[F.col("kind")].alias("place"), "end", "kind")
        by_blob = self.findings().groupBy("blob_id").agg(F.sort_array(F.collect_list(one)).alias("found"))
        empty = F.array().cast(by_blob.schema["found"].dataType)
        return self.paths().join(by_blob, "blob_id", "left").select("path", "blob_id", F.coalesce("found", empty).alias("found"))


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(report: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base kinds, and all spans, of every path of a report."""
    found = F.col("found")
    of = lambda *kinds: F.filter(found, lambda x: x["kind"].isin(*kinds))
    return report.select(
        F.col("path").alias("doc_id"),
        *[F.size(of(rule.kind)).cast("long").alias(f"n_{rule.kind}") for rule in BASE],
        F.sha2(joined(of(*[rule.kind for rule in BASE])), 256).alias("base_sha256"),
        joined(found).alias("spans"),
    )

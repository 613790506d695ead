"""Secret scanning with an incremental blob ledger (operator 5).

Plain DataFrame functions throughout. Every version of every path is a blob, addressed by the
SHA-256 of its content. The ledger says which rule in which version has scanned which blob, and
what it found. A run scans a blob once, however many paths hold it, and only with rules
whose current version the ledger lacks for it; findings then go back to all paths by address.

A ledger row is (blob, scanned, found): scanned holds "rule:version" names, found holds
struct<kind, version, start, end>. A blob may have several rows, one per run that had something
left to do.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from salesloom.llm.common import stage, text_or_empty
from salesloom.llm.spans import matches, written

FOUND = "array<struct<kind:string,version:int,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """A pattern that never matches the empty text, and what a match must also satisfy."""

    kind: str
    version: int
    pattern: str
    keep: Callable[[Column], Column] = field(default=lambda found: F.lit(True))
    only_if: Callable[[Column], Column] | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.version}"


# Possessive repeats and look-behinds keep patterns linear; they accept the same leftmost
# matches as the plain forms.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)"
)
BASE = ("assign", "access", "hex")
RULES = (
    Rule("assign", 1, ASSIGN, lambda found: F.length(F.regexp_extract(found, ASSIGN, 2)) >= 6),
    Rule("access", 1, "AKIA[A-Z0-9]++", lambda found: F.length(found) >= 20,
         lambda text: text.contains("AKIA")),
    Rule("hex", 1, "(?<![0-9a-f])[0-9a-f]{24,}+"),
    Rule("private_key", 1, "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----",
         only_if=lambda text: text.contains("PRIVATE KEY")),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
         only_if=lambda text: text.contains("eyJ")),
    Rule("service_token", 1, "(?:gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+)",
         only_if=lambda text: text.contains("gh") | text.contains("xox")),
    Rule("url_login", 1, r"://[^\x00-\x20/:@]{1,64}+:[^\x00-\x20/:@]{1,64}+@",
         only_if=lambda text: text.contains("://")),
)

# Buckets of the filter that spares texts without unseen blobs the shuffle: a bound on what
# is broadcast, whatever the input.
FILTER_BUCKETS = 1 << 20


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _scan(text: Column, todo: Column, rules: Sequence[Rule]) -> Column:
    """What the rules named in ``todo`` find."""
    def run(rule: Rule) -> Column:
        found = matches(text, rule.pattern, rule.only_if and rule.only_if(text))
        kept = F.transform(F.filter(found, lambda m: rule.keep(m["found"])), lambda m: F.struct(
            F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"),
            m["start"].alias("start"), m["end"].alias("end"),
        ))
        none = F.array().cast(FOUND)
        return F.when(F.array_contains(todo, rule.name), kept).otherwise(none)

    return F.concat(*map(run, rules))


def address(versions: DataFrame, path: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The path columns of every version with the address of its blob, as a table."""
    return stage(versions.select(*path, blob_of(text_or_empty(text)).alias("blob")), "blobs")


def scan(
    versions: DataFrame, addressed: DataFrame, ledger: DataFrame | None = None,
    rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """New ledger rows: unseen (blob, rule version) pairs only, one row per blob.

    One version stands for its blob, that with the smallest key. Repeated rows are scanned
    again and count once; a NULL text is the empty blob, a NULL key is a key like others.
    """
    current = F.array(*[F.lit(r.name) for r in rules])
    wanted = addressed.groupBy("blob").agg(F.min(key).alias("_key"))
    if ledger is not None:
        seen = ledger.groupBy("blob").agg(
            F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("seen")
        )
        wanted = wanted.join(seen, "blob", "left")
        current = F.array_except(current, F.coalesce("seen", F.array().cast("array<string>")))
    wanted = wanted.select("blob", "_key", current.alias("todo")).where(F.size("todo") > 0)

    bucket = F.pmod(F.xxhash64("blob"), F.lit(FILTER_BUCKETS))
    rows = versions.select(
        F.col(key).alias("_own"), text_or_empty(text).alias("_text"),
    ).withColumn("blob", blob_of(F.col("_text")))
    if ledger is not None:
        buckets = wanted.select(bucket.alias("_bucket")).distinct()
        rows = rows.withColumn("_bucket", bucket).join(
            F.broadcast(buckets), "_bucket", "left_semi"
        )
    wanted = wanted.withColumnRenamed("blob", "_blob")
    unseen = rows.join(
        wanted, (F.col("blob") == F.col("_blob")) & F.col("_own").eqNullSafe(F.col("_key"))
    )
    found = unseen.select(
        "blob", F.col("todo").alias("scanned"), _scan(F.col("_text"), F.col("todo"), rules).alias("found")
    )
    return stage(found.dropDuplicates(["blob"]), "ledger")


def findings(addressed: DataFrame, *ledgers: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every path with ``found``: what the current rule versions found in its blob."""
    names = F.array(*[F.lit(r.name) for r in rules])
    every = ledgers[0]
    for more in ledgers[1:]:
        every = every.unionByName(more)
    hits = every.select("blob", F.filter("found", lambda s: F.array_contains(
        names, F.concat_ws(":", s["kind"], s["version"].cast("string"))
    )).alias("found")).where(F.size("found") > 0)
    if len(ledgers) > 1:
        hits = hits.groupBy("blob").agg(F.flatten(F.collect_list("found")).alias("found"))
    none = F.array().cast(FOUND)
    return addressed.drop("found").join(hits, "blob", "left").withColumn("found", F.coalesce("found", none))


def report(found: DataFrame, doc_id: str = "doc_id", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Counts and written spans, by start, then kind in the order of the rules."""
    order = F.array(*[F.lit(r.kind) for r in rules])
    ordered = F.array_sort(F.transform("found", lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, s["kind"]).alias("order"),
        s["end"].alias("end"), s["kind"].alias("kind"),
    )))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(ordered, lambda s: s["order"] <= len(BASE))
    return found.select(
        F.col(doc_id).alias("doc_id"), *[count(k) for k in BASE],
        F.sha2(written(base), 256).alias("base_sha256"), written(ordered).alias("spans"),
    )

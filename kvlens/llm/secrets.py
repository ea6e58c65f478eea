"""Secret scans over an incremental blob ledger.

Versions (any rows with a text) are content-addressed by SHA-256. The ledger is
a table of (blob, rule_version, findings): a blob is scanned once for each
version of the rules, however many paths or versions hold it, and a later run
scans only the pairs that the ledger lacks. Findings then join back to all rows.

Rules (``RULES``): kinds in this order, spans in code points, end exclusive,
leftmost and non-overlapping for each kind.

Defined cases: null text is the empty blob (redacted, it stays null); repeated rows
each get a row; a blob without findings is in the ledger with an empty string, so
it isn't scanned again; other columns may have any names; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import pieces, with_columns
from .storage import fresh

# The kinds of secrets, their patterns, the group that is measured and its least length.
RULES = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII, 2, 8),
    ("access", r"AKIA[A-Z0-9]+", re.ASCII, 0, 16),
    ("hex", r"[0-9a-f]{32,}", re.ASCII, 0, 32),
)
KINDS = tuple(r[0] for r in RULES)


def find(text: str, rules=None) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of every secret, by start and kind."""
    out = []
    for no, (pattern, group, least) in enumerate(rules or _compiled()):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), no, m.end()))
    out.sort()
    return out


def _compiled(rules: tuple = RULES):
    return [(re.compile(p, flags), group, least) for _, p, flags, group, least in rules]


def _scan(blobs: DataFrame, rules: tuple) -> DataFrame:
    def make():
        compiled, kinds = _compiled(rules), [r[0] for r in rules]

        def call(rows: list[str]) -> list:
            return [[",".join(f"{kinds[no]}:{a}:{b}" for a, no, b in find(t, compiled)) for t in rows]]

        return call

    return with_columns(blobs, "text", [T.StructField("findings", T.StringType())], make, ["blob"])


def version_of(rules: tuple) -> str:
    """What stands for a set of rules in the ledger: changes with any of them."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def _joined(versions: DataFrame, text: str, keep: list[str], ledger: str | None, rules: tuple) -> DataFrame:
    """Every version: its ``keep`` columns as the struct ``kept``, its blob, and its findings."""
    spark = versions.sparkSession
    ledger = ledger or fresh(spark, "secret-ledger")
    kept = F.struct(*[versions[c] for c in keep]) if keep else F.lit(None).cast("struct<none: int>")
    rows = versions.select(kept.alias("kept"), F.coalesce(versions[text], F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
    known = lambda: spark.read.schema(LEDGER).parquet(ledger).where(F.col("rule_version") == version_of(rules))
    blobs = rows.groupBy("blob").agg(F.first("text").alias("text"))
    if _exists(spark, ledger):
        blobs = blobs.join(known().select(F.col("blob").alias("seen")), F.col("blob") == F.col("seen"), "left_anti")
    _scan(blobs, rules).select("blob", F.lit(version_of(rules)).alias("rule_version"), "findings").write.mode("append").partitionBy("rule_version").parquet(ledger)
    # Most blobs hold nothing: only findings travel, and hot blobs are split by the skew join. Runs side by side may both have scanned a blob.
    found = known().where("findings <> ''").select(F.col("blob").alias("b"), F.col("findings").alias("f")).distinct()
    return rows.drop("text").join(found, F.col("blob") == F.col("b"), "left").select("kept", "blob", F.coalesce("f", F.lit("")).alias("findings"))


def scan(versions: DataFrame, text: str = "text", keep: list[str] | None = None, ledger: str | None = None, rules: tuple = RULES) -> DataFrame:
    """``keep`` columns of every version, its blob, and its findings ("kind:start:end,...").

    ``ledger`` is the folder of a Parquet ledger that earlier runs left and this one adds to; None: a new one.
    A kept column named blob or findings gives way to the new one.
    """
    keep = [c for c in keep or [] if c not in ("blob", "findings")]
    found = _joined(versions, text, keep, ledger, rules)
    return found.select(*[F.col("kept").getField(c).alias(c) for c in keep], "blob", "findings")


LEDGER = "blob string, rule_version string, findings string"


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan(docs, keep=["doc_id"])
    each = F.filter(F.split("findings", ","), lambda x: x != "")
    of = lambda kind: F.size(F.filter(each, lambda x: x.startswith(f"{kind}:"))).cast("long")
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in KINDS], F.sha2("findings", 256).alias("base_sha256"), F.col("findings").alias("spans"))


def without(text: str, findings: str) -> str:
    """text with the spans of its findings replaced by ``<kind>``; where spans overlap, the first one's kind stands for all."""
    parts, at = [], 0
    for kind, a, b in (x.split(":") for x in findings.split(",") if x):
        if int(a) >= at:
            parts += [text[at : int(a)], f"<{kind}>"]
        at = max(at, int(b))
    return "".join([*parts, text[at:]])


def redact(df: DataFrame, text: str = "text", ledger: str | None = None, rules: tuple = RULES) -> DataFrame:
    """df with each secret's span replaced by ``<kind>``, from the ledger's spans; texts without one are as they were."""
    found = _joined(df, text, df.columns, ledger, rules).select("kept", "findings")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            fixed = [without(t, f) if f else t for t, f in zip(piece["text"].to_pylist(), piece["findings"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([piece["kept"], pa.array(fixed, pa.string())], names=["kept", "fixed"])

    columns = [c for c in df.columns if c != text]
    rest = F.struct(*[F.col("kept").getField(c).alias(c) for c in columns]) if columns else F.lit(None).cast("struct<none: int>")
    dirty = found.select(rest.alias("kept"), F.col("kept").getField(text).alias("text"), "findings")
    out = dirty.mapInArrow(run, T.StructType([dirty.schema["kept"], T.StructField("fixed", T.StringType())]))
    return out.select(*[F.col("fixed").alias(c) if c == text else F.col("kept").getField(c).alias(c) for c in df.columns])

"""Secret scanning with an incremental blob ledger.

Versions of files repeat the same content over paths and time.  Each historical
version is addressed by the SHA-256 of its content (a blob); the ledger records
which blobs have been scanned under which rule version, with their findings:

1. distinct blobs of the versions, by a map-side combined aggregate on digests;
2. blobs whose (blob, rule version) pair is in the ledger are set aside;
3. one version of each unseen blob is read and scanned whole, once;
4. the scan's rows, also those without findings, are appended to the ledger;
5. findings are joined back to all versions, so every path gets them.

The ledger is a Parquet table partitioned by rule version.  A scan appends only
complete batches: a lost executor repeats its own tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrel.llm.common import scratch_path, stored

RULES_VERSION = "1"

#: Kinds in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "private_key", "web_token")
BASE = KINDS[:3]

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")       # whole runs, so short ones just do not match
_HEX = re.compile(r"[0-9a-f]{32,}")
_KEY = re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+-----END [A-Z ]{0,30}PRIVATE KEY-----")
#: The first of a web token's three runs is looked at from its start only, and what follows it ahead.
_WEB = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?=\.eyJ[A-Za-z0-9_-]{8,}+(\.[A-Za-z0-9_-]{8,}+))")

#: Texts that cannot match anything are told apart by a linear-time search first.
_ANY = r"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{32}|-----BEGIN|eyJ"

LEDGER = ("blob string, findings array<struct<kind:string,start:int,end:int>>, rules string")


def _web_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Spans of ``eyJ`` and 8 or more characters, the same again, and 8 or more, with points between."""
    done = 0
    for m in _WEB.finditer(text):
        start = text.find("eyJ", max(done, m.start()), m.end())
        if start >= 0 and m.end() - start >= 11:
            done = m.end(1)
            yield start, done


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret of a whole text, by start, then kind.

    Offsets count code points, ends are exclusive; the matches of a kind do not
    overlap and are the leftmost ones.
    """
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    for kind, rule in (("access", _ACCESS), ("hex", _HEX), ("private_key", _KEY)):
        out += [(kind, *m.span()) for m in rule.finditer(text)]
    out += [("web_token", *span) for span in _web_tokens(text)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def _scan(blobs: DataFrame) -> DataFrame:
    """(blob, findings) of rows (blob, content)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(1)
            maybe = pc.match_substring_regex(text, _ANY).to_pylist()
            found = [[{"kind": k, "start": a, "end": z} for k, a, z in find(text[i].as_py())] if hit else []
                     for i, hit in enumerate(maybe)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)],
                                             names=["blob", "findings"])

    return blobs.select("blob", "content").mapInArrow(
        run, "blob string, findings array<struct<kind:string,start:int,end:int>>")


def read_ledger(spark: SparkSession, path: str, rules: str) -> DataFrame:
    """The ledger's rows for one rule version; none if nothing is written yet."""
    try:
        table = spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], LEDGER)
    # scans at the same time, or a batch appended twice, may have left a blob's row more than once
    return table.filter(F.col("rules") == rules).groupBy("blob").agg(F.first("findings").alias("findings"))


def scan_versions(versions: DataFrame, ledger: str, *, path_cols: list[str], content_col: str = "text",
                  rules: str = RULES_VERSION) -> DataFrame:
    """Bring the ledger at path ``ledger`` up to date; ``path_cols``, blob and findings
    of every version.

    Null content counts as empty and has no findings; null or repeated paths are
    versions like others.  Empty table: no rows, nothing appended.
    """
    spark = versions.sparkSession
    content = F.coalesce(F.col(content_col), F.lit(""))
    keyed = versions.select(*path_cols, content.alias("content"),
                            F.sha2(F.encode(content, "UTF-8"), 256).alias("blob"))
    ids = stored(keyed.select(*path_cols, "blob"), "versions")
    seen = read_ledger(spark, ledger, rules).select("blob")
    # one version stands for each unseen blob: that with the smallest path
    first = F.min(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in path_cols]))
    unseen = ids.groupBy("blob").agg(first.alias("at")).join(seen, "blob", "left_anti")
    at = [F.coalesce(F.col(f"k.{c}").cast("string"), F.lit("")) == F.col(f"u.at.{c}") for c in path_cols]
    todo = keyed.alias("k").join(unseen.alias("u"), [F.col("k.blob") == F.col("u.blob"), *at], "left_semi")
    # a path may repeat its version; the ledger needs it once
    fresh_rows = _scan(todo.select("blob", "content")).groupBy("blob").agg(F.first("findings").alias("findings"))
    fresh_rows.withColumn("rules", F.lit(rules)).write.mode("append").partitionBy("rules").parquet(ledger)
    known = read_ledger(spark, ledger, rules)
    hits = known.filter(F.size("findings") > 0)
    return ids.join(hits, "blob", "left").select(
        *path_cols, "blob", F.coalesce("findings", F.array().cast(known.schema["findings"].dataType))
        .alias("findings"))


def _joined(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           ledger: str | None = None) -> DataFrame:
    """id, counts of the base kinds, the digest of the base spans and all spans,
    for every row of ``df``; a new ledger unless one is given."""
    ledger = ledger or scratch_path(df.sparkSession, "ledger")
    got = scan_versions(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("body")), ledger,
                        path_cols=["id"], content_col="body")
    count = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("findings", lambda x: x["kind"].isin(*BASE))
    return got.select(F.col("id").alias(id_col), *[count(k).alias(f"n_{k}") for k in BASE],
                      F.sha2(F.encode(_joined(base), "UTF-8"), 256).alias("base_sha256"),
                      _joined(F.col("findings")).alias("spans"))

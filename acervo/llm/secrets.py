"""Secret scans with linking of multipart credentials.

Arrow batches find the base secrets of each text, and parts that alone say
little: identifiers, endpoints and weak secrets (short assigned values, long
mixed tokens).  An interval join within each scope (a paragraph) then tells
which complementary parts are at most REACH code points apart, from the end of
one to the start of the other.  It is a sweep in order of place, with the
furthest end so far and the next start of each role, so it takes time in
proportion to the parts and emits no pairs.  A weak secret is reported if an
identifier or an endpoint is that near, a weak identifier if a secret is, an
endpoint if both are.  REACH is about four lines: parts of one credential
stand together, and a paragraph may be a whole document.

Defined results: a null or empty text has no spans; rows with the same
identifier are scanned apart; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acervo.llm import text as tx

#: The base kinds in their order, patterns and least lengths. (?a) keeps ignored case to A-Z.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

#: The method's own parts.
IDENTIFIER = re.compile(r"""(?ai)\b(?:client_?id|access_?key_?id|account_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""")
ENDPOINT = re.compile(r"""(?ai)\b(?:https?|ftp|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[^\s"'<>]+|\b(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[a-z0-9.-]{4,}""")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WEAK_LEAST = 6
PARAGRAPH = re.compile(r"\n[\x20\t\r]*\n")
REACH = 300

PARTS = "array<struct<kind:string,role:string,strong:boolean,start:long,end:long,scope:long>>"
PART_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("role", pa.string()), ("strong", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("scope", pa.int64())]))


def found_in(t: str) -> tuple[list[tuple], list[tuple]]:
    """(kind, start, end) of the base secrets, in order, and (kind, role, strong, start, end) of all parts."""
    spans, weak = [], []
    for m in ASSIGN.finditer(t) if ":" in t or "=" in t else ():
        if len(m[2]) >= ASSIGN_LEAST:
            spans.append(("assign", *m.span()))
        elif len(m[2]) >= WEAK_LEAST:
            weak.append(("weak_secret", "secret", False, *m.span()))
    spans += [("access", *m.span()) for m in ACCESS.finditer(t)]
    spans += [("hex", *m.span()) for m in HEX.finditer(t)]
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    taken = [(a, b) for _, a, b in spans]
    for m in TOKEN.finditer(t):
        s = m[0]
        if any(c.isdigit() for c in s) and any(c.isupper() for c in s) and any(c.islower() for c in s):
            weak.append(("weak_secret", "secret", False, *m.span()))
    if ":" in t or "=" in t:
        weak += [("weak_id", "id", False, *m.span()) for m in IDENTIFIER.finditer(t)]
        weak += [("endpoint", "endpoint", False, *m.span()) for m in ENDPOINT.finditer(t)]
    starts = [a for a, _ in taken]
    ends = []  # the furthest end so far
    for _, b in taken:
        ends.append(max(b, ends[-1] if ends else 0))

    def free(a: int, b: int) -> bool:
        i = bisect_right(starts, b - 1)
        return not i or ends[i - 1] <= a

    parts = [(k, "id" if k == "access" else "secret", True, a, b) for k, a, b in spans]
    return spans, parts + [w for w in dict.fromkeys(weak) if free(*w[3:])]


def parts(docs: DataFrame) -> DataFrame:
    """Every document's base results and all its parts, with the paragraph that each begins in."""
    schema = f"doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, parts {PARTS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.sliced(batches):
            rows = []
            for t in tx.texts(b.column("text")).to_pylist():
                spans, found = found_in(t)
                breaks = [m.end() for m in PARAGRAPH.finditer(t)] if any(not p[2] for p in found) else []
                said = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
                kinds = [s[0] for s in spans]
                rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(said.encode()).hexdigest(), [dict(zip(("kind", "role", "strong", "start", "end"), p, strict=True)) | {"scope": bisect_right(breaks, p[3])} for p in found]))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()), pa.array(cols[4], PART_TYPE)], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "parts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def linked(found: DataFrame) -> DataFrame:
    """Joins the parts of each row and paragraph by place; gives each row back with the spans that hold."""
    base = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    each = found.withColumn("row", F.monotonically_increasing_id()).select("row", *base, F.explode_outer("parts").alias("p")).repartition("row")
    here = Window.partitionBy("row", "p.scope")
    back = here.orderBy("p.start", "p.end", "p.kind").rowsBetween(Window.unboundedPreceding, -1)
    ahead = here.orderBy(F.desc("p.start"), F.desc("p.end"), F.desc("p.kind")).rowsBetween(Window.unboundedPreceding, -1)

    def near(role: str):
        """Whether a part of this role begins or ends within reach: the furthest end before and the next start."""
        of = lambda c: F.when(F.col("p.role") == role, F.col(c))
        return F.coalesce(F.col("p.start") - F.max(of("p.end")).over(back) <= REACH, F.lit(False)) | F.coalesce(F.last(of("p.start"), ignorenulls=True).over(ahead) - F.col("p.end") <= REACH, F.lit(False))

    by = each.select("*", *[near(r).alias(f"near_{r}") for r in ("id", "secret", "endpoint")])
    role = F.col("p.role")
    holds = F.col("p.strong") | F.when(role == "secret", F.col("near_id") | F.col("near_endpoint")).when(role == "id", F.col("near_secret")).otherwise(F.col("near_id") & F.col("near_secret"))
    order = F.coalesce(F.array_position(F.array(*map(F.lit, KINDS)), F.col("p.kind")), F.lit(0))
    span = F.when(holds, F.struct(F.col("p.start").alias("start"), F.when(order == 0, 9).otherwise(order).alias("order"), F.col("p.kind").alias("kind"), F.col("p.end").alias("end")))
    spans = F.array_join(F.transform(F.array_sort(F.collect_list(span)), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return by.groupBy("row").agg(*[F.first(c).alias(c) for c in base], F.count_if(holds & ~F.col("p.strong")).alias("n_linked"), spans.alias("spans")).drop("row")


def scanned(docs: DataFrame) -> DataFrame:
    """Every document's base counts and digest, and all its spans."""
    return linked(parts(docs))

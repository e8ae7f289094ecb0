"""Secret scans with multipart linking, in DataFrame functions only.

*Base* matches stand by themselves: assigned secrets, access identifiers and long
hexadecimal runs.  *Weak* matches say little alone: mixed-character tokens, logins and
endpoints.  Parts lie on one line of code points per document; a weak part is reported
only if the parts that make it a credential begin within its scope (range frames over
the sorted parts, so the join of intervals never lists pairs):

    token     an access identifier or a login in scope
    login     an assigned secret, a hexadecimal run or a token in scope
    endpoint  both one of the former and one of the latter in scope
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis.session import materialise

# The base patterns.  A run of at least n is what is left of all maximal
# runs when shorter ones are dropped.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
BASE = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
ASSIGN_LEAST = 12

TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
LOGIN = r"""(?i:(user_?name|user_?id|user|login|client_?id|account_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]{3,})"""
ENDPOINT = r"""(https?|ftp|ssh|postgres|postgresql|mysql|mongodb|redis|amqp|s3)://[^\x20\x09-\x0D"'<>]+"""
WEAK = {"token": TOKEN, "login": LOGIN, "endpoint": ENDPOINT}
KINDS = [*BASE, *WEAK]
SCOPE = 200


def _keeps(kind: str, match: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(match, ASSIGN, 2)) >= ASSIGN_LEAST
    if kind == "token":
        return match.rlike("[0-9]") & match.rlike("[A-Z]") & match.rlike("[a-z]")
    return F.lit(True)


def _parts(found: DataFrame) -> DataFrame:
    """One row per match: _row, kind as its place in KINDS, start and end in code points."""
    lists = [F.arrays_zip(F.col(f"m_{k}").alias("m"), F.col(f"g_{k}").alias("g")) for k in KINDS]
    each = None
    for at, (kind, pairs) in enumerate(zip(KINDS, lists, strict=True)):
        rows = found.filter(F.size(f"m_{kind}") > 0).select("_row", F.posexplode(pairs).alias("_i", "_p"))
        rows = rows.filter(F.col("_p.m").isNotNull()).select("_row", F.lit(at).alias("kind"), "_i", F.col("_p.m").alias("match"), F.col("_p.g").alias("gap"))
        each = rows if each is None else each.unionAll(rows)
    long = F.length("match")
    end = F.sum(F.col("gap") + long).over(Window.partitionBy("_row", "kind").orderBy("_i"))
    keep = F.lit(False)
    for at, kind in enumerate(KINDS):
        keep = keep | ((F.col("kind") == at) & _keeps(kind, F.col("match")))
    return each.withColumn("end", end).filter(keep).select("_row", "kind", (F.col("end") - long).cast("long").alias("start"), F.col("end").cast("long"))


def find_credentials(docs: DataFrame, *, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """docs without the text, each row with `spans`: array of (kind, start, end, base),
    sorted by start and then kind; code points, end exclusive, base tells base matches.

    A null or empty text has none.  Rows are told apart by position, not by an id, so ids
    may repeat or be null.  A weak match that overlaps a base match is part of that match.
    Documents are read once; what is shuffled is the matches.
    """
    others = [c for c in docs.columns if c != text]
    whole = F.coalesce(F.col(text), F.lit(""))
    lists = docs.select(
        F.struct(*others).alias("_doc") if others else F.struct(F.lit(1).alias("_none")).alias("_doc"), whole.alias("_text"),
        *[F.regexp_extract_all(whole, F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in (BASE | WEAK).items()])
    gaps = [F.when(F.size(f"m_{k}") > 0, F.transform(F.split("_text", p, -1), F.length)).otherwise(F.array().cast("array<int>")).alias(f"g_{k}")
            for k, p in (BASE | WEAK).items()]
    found = materialise(
        lists.select("_doc", *[f"m_{k}" for k in KINDS], *gaps).withColumn("_row", F.monotonically_increasing_id()), "matches")

    first_weak = len(BASE)
    base = F.col("kind") < first_weak
    order = Window.partitionBy("_row").orderBy("start", "kind")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    clear = (
        (F.coalesce(F.max(F.when(base, F.col("end"))).over(before), F.lit(0)) <= F.col("start"))
        & (F.coalesce(F.min(F.when(base, F.col("start"))).over(after), F.col("end")) >= F.col("end")))
    parts = _parts(found).withColumn("_clear", clear).filter(base | F.col("_clear")).drop("_clear")
    near = Window.partitionBy("_row").orderBy("start").rangeBetween(-scope, scope)
    kind = {k: F.col("kind") == at for at, k in enumerate(KINDS)}
    who = F.max(kind["access"] | kind["login"]).over(near)
    what = F.max(kind["assign"] | kind["hex"] | kind["token"]).over(near)
    linked = parts.withColumns({"_who": who, "_what": what}).filter(
        base | (kind["token"] & F.col("_who")) | (kind["login"] & F.col("_what")) | (kind["endpoint"] & F.col("_who") & F.col("_what")))
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = linked.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("_s"))
    as_span = lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), (s["kind"] < first_weak).alias("base"))
    spans = spans.select("_row", F.transform("_s", as_span).alias("spans"))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")
    out = found.select("_row", "_doc").join(spans, "_row", "left")
    return out.select(*[F.col("_doc")[c].alias(c) for c in others if c != "spans"], F.coalesce("spans", none).alias("spans"))


def digest(spans: DataFrame) -> DataFrame:
    """Counts of base matches, a digest of them and the list of all spans."""
    each = F.col("spans")
    listed = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter(each, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter(each, lambda s: s["base"])
    return spans.select("doc_id", *[count(k) for k in BASE], F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(each).alias("spans"))

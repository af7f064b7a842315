"""Secret scans over content-addressed blobs, each scanned once per rule version."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions.ordering import attach
from tillmark.llm.common import joined, table, text_of
from tillmark.session import materialised, run_dir


@dataclass(frozen=True)
class Rule:
    """One kind of secret.

    Matches of ``pattern`` are taken leftmost and without overlap; those whose group
    ``group`` is shorter than ``least`` code points are dropped afterwards.  ``hints``
    are lower-case strings one of which every match contains; texts without any are
    not searched.  A changed rule gets a new ``version``, and only it is scanned again.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()


ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
RULES = (
    Rule("assign", 1, ASSIGN, 2, 6, ("password", "passwd", "secret", "token", "api_key", "apikey")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, ("akia",)),
    # Shorter runs fail the base rule, and a run's match is the whole run, so the length can stand in the pattern.
    Rule("hex", 1, r"[0-9a-f]{24,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("private key-----",)),
    Rule("vcs", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("chat", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", hints=("xox",)),
)
BASE = ("assign", "access", "hex")
ENTRY = "blob string, kind string, version int, places array<struct<start:bigint,stop:bigint>>"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """What has been scanned so far: one row per blob, kind and rule version, with the places found."""
    try:
        return spark.read.schema(ENTRY).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing.getCondition()):
            raise
        fields = T.StructType.fromDDL(ENTRY).fields
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def _matches(rule: Rule) -> Column:
    """Lengths of the gaps before the matches, of the matches, and of the tested groups."""
    text, pattern = F.col("_text"), F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    wanted = F.array_contains("_todo", rule.kind)
    if rule.hints:
        wanted = wanted & reduce(lambda a, b: a | b, [F.contains(F.col("_low"), F.lit(h)) for h in rule.hints])
    tested = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    lengths = lambda strings: F.transform(strings, F.length)
    hits = F.arrays_zip(
        lengths(F.slice(F.split(text, rule.pattern, -1), 1, F.size(found))), lengths(found), lengths(tested)
    ).cast("array<struct<gap:int,size:int,tested:int>>")
    return F.when(wanted & F.rlike(text, pattern), hits)


def scan_new(versions: DataFrame, ledger_path: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Scan what the ledger does not hold yet, append it, and return (doc_id, blob) of all versions.

    ``versions`` has doc_id and text, every historical version a row.  Its blob is the
    SHA-256 of the text.  Only pairs of a blob and a rule version that are missing in
    the ledger are scanned, on one document of each blob, however many have it.
    """
    spark = versions.sparkSession
    keyed = versions.select("doc_id", text_of().alias("_text")).withColumn("blob", F.sha2("_text", 256))
    paths = materialised(keyed.select("doc_id", "blob"), "paths")

    known = read_ledger(spark, ledger_path).select("blob", "kind", "version")
    pairs = (
        paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
        .withColumn("_rule", F.explode(F.array(*[
            F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])))
        .select("blob", "doc_id", "_rule.*")
        .join(known, ["blob", "kind", "version"], "left_anti")
    )
    todo = pairs.groupBy("blob", "doc_id").agg(F.collect_list("kind").alias("_todo"))

    lowered = attach(keyed, todo, ["blob", "doc_id"]).withColumn("_low", F.lower("_text"))
    scanned = materialised(lowered.select("blob", F.explode(F.array(*[
        F.when(F.array_contains("_todo", r.kind), F.struct(
            F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.lit(r.least).alias("least"),
            _matches(r).alias("hits"))) for r in rules])).alias("_scan"))
        .filter(F.col("_scan").isNotNull()).select("blob", "_scan.*"), "scanned")

    # The rows of one text's matches: everything before a match is the gaps and matches up to it.
    rows = (
        scanned.filter("hits is not null")
        .select("blob", "kind", "version", "least", F.posexplode("hits").alias("nth", "hit"))
        .groupBy("blob", "kind", "version", "least", "nth").agg(F.first("hit").alias("hit"))
        .select("blob", "kind", "version", "least", "nth", "hit.*")
    )
    through = Window.partitionBy("blob", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    places = (
        rows.withColumn("stop", F.sum(F.col("gap") + F.col("size")).over(through))
        .filter("tested >= least")
        .select("blob", "kind", F.struct((F.col("stop") - F.col("size")).alias("start"), "stop").alias("place"))
        .groupBy("blob", "kind").agg(F.array_sort(F.collect_list("place")).alias("places"))
    )
    entries = (
        scanned.select("blob", "kind", "version").distinct().join(places, ["blob", "kind"], "left")
        .withColumn("places", F.coalesce("places", F.array().cast("array<struct<start:bigint,stop:bigint>>")))
    )
    entries.select("blob", "kind", "version", "places").write.mode("append").parquet(ledger_path)
    return paths


def findings(paths: DataFrame, ledger_path: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every document with its spans (kind, start, stop; code points), in order of start, then of the rules.

    Found places are joined back to all documents of a blob.  Documents without any have an empty list.
    """
    spark = paths.sparkSession
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    current = reduce(lambda a, b: a | b, [
        (F.col("kind") == r.kind) & (F.col("version") == r.version) for r in rules])
    spans = (
        read_ledger(spark, ledger_path).filter(current & (F.size("places") > 0))
        .dropDuplicates(["blob", "kind", "version"])
        .select("blob", "kind", F.explode("places").alias("place"))
        .groupBy("blob").agg(F.array_sort(F.collect_list(F.struct(
            F.col("place.start").alias("start"), order[F.col("kind")].alias("rank"), F.col("place.stop").alias("stop"),
            "kind"))).alias("spans"))
    )
    nothing = F.array().cast("array<struct<start:bigint,rank:int,stop:bigint,kind:string>>")
    return paths.join(spans, "blob", "left").withColumn("spans", F.coalesce("spans", nothing))


def scan(docs: DataFrame, ledger_path: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Documents with blob and spans, scanning only what the ledger at ``ledger_path`` lacks.

    Null texts count as empty; repeated rows come back as often as they came; a null
    id is an id like any other; other columns are ignored; no rows give no rows.  Where
    two matches of different kinds overlap, both are listed.
    """
    return findings(scan_new(docs, ledger_path, rules), ledger_path, rules)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), run_dir(spark, "ledger"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def _spans_sql(rule: Rule, rank: int) -> str:
    """Places of one rule: the pieces between matches give the gaps, as the matches give the lengths."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, '{rule.kind}' AS kind, {rank} AS rank, unnest(places) AS p FROM (
    SELECT doc_id, [{{
      'stop': list_sum([length(x) for x in s[1:i]]) + list_sum([length(x) for x in m[1:i]]),
      'size': length(m[i]), 'tested': length(g[i])}} for i in range(1, len(m) + 1)] AS places
    FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS g,
                 string_split_regex(t, '{pattern}') AS s FROM d))
  """


def _op4_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT * FROM ({_spans_sql(r, i)}) WHERE p.tested >= {r.least}" for i, r in enumerate(RULES))
    base = ", ".join(f"'{k}'" for k in BASE)
    shown = "kind || ':' || CAST(p.stop - p.size AS BIGINT) || ':' || CAST(p.stop AS BIGINT)"
    agg = f"string_agg({shown}, ',' ORDER BY p.stop - p.size, rank)"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)
    zeros = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ({parts}),
g AS (SELECT doc_id, {counts}, {agg} FILTER (kind IN ({base})) AS b, {agg} AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, {zeros}, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


OP4_SQL = _op4_sql()

"""Secret scan over a ledger of blobs.

Every version of a text is a blob, addressed by its SHA-256. The ledger keeps
the spans found in a blob by each version of each rule. A scan looks at the
pairs of blob and rule version that the ledger lacks, once per blob however
many paths hold it, appends them, and joins the findings back to all paths.
DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.llm.common import free_name, materialise

LEDGER = "blob string, rule string, version int, spans array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A pattern in Java's syntax; of its matches, those count whose ``group`` has ``least`` characters."""

    name: str
    version: int
    pattern: str
    group: int
    least: int


#: Kinds in the order in which they are listed, patterns and lengths.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
)


def _prefilter(rule: Rule, text: Column) -> Column:
    """Whether a match long enough can be there at all; cheap, and never false for a text with one."""
    if rule.name == "hex":
        return text.rlike("[0-9a-f]{%d}" % rule.least)
    if rule.name == "access":
        return text.rlike("AKIA[A-Z0-9]{%d}" % (rule.least - 4))
    return text.rlike("[:=]") & text.rlike(rule.pattern)


def matches(rule: Rule, text: Column) -> Column:
    """The matches in order, as ``before`` (characters since the match before), ``n`` and ``shown`` (characters of the group).

    Matches are leftmost and do not overlap, as a plain scan finds them; the
    text between them, from the same pattern, tells how far they are apart.
    """
    # Runs of the hex class shorter than the least length neither count nor
    # stand in for longer ones, so only long runs need be matched.
    pattern = "[0-9a-f]{%d,}" % rule.least if rule.name == "hex" else rule.pattern
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    shown = F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)) if rule.group else whole
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    found = F.zip_with(F.zip_with(whole, shown, lambda w, g: F.struct(F.length(w).alias("n"), F.length(g).alias("shown"))), between,
                       lambda m, b: F.struct(F.length(b).alias("before"), m.n.alias("n"), m.shown.alias("shown")))
    return F.when(_prefilter(rule, text), found).otherwise(F.array().cast("array<struct<before:int,n:int,shown:int>>"))


def with_spans(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob``, ``rule``, ``version``, ``spans`` (code points, end exclusive) of the rules in ``lacking``.

    The places are running sums over a blob's matches, a row for each match, so
    that work and memory are in proportion to the matches of a text. ``texts``
    has one row per blob; its partitioning by ``blob`` serves all steps.
    """
    found = texts.select("blob", F.explode(F.filter(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), F.lit(r.least).alias("least"),
                 F.when(F.array_contains("lacking", r.name), matches(r, F.col("text"))).alias("found"))
        for r in rules]), lambda x: x.found.isNotNull())).alias("f")).select("blob", "f.*")
    each = found.select("blob", "rule", "version", "least", F.posexplode_outer("found").alias("at", "m"))
    so_far = Window.partitionBy("blob", "rule", "version").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = each.withColumn("end", F.sum(F.col("m.before") + F.col("m.n")).over(so_far).cast("int"))
    span = F.struct((F.col("end") - F.col("m.n")).alias("start"), F.col("end").alias("end"))
    return ended.groupBy("blob", "rule", "version").agg(F.array_sort(F.collect_list(F.when(F.col("m.shown") >= F.col("least"), span))).alias("spans"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger's rows, or None before the first scan."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan(versions: DataFrame, ledger_path: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Append to the ledger what the blobs of ``versions`` lack, and return the ledger's rows of the rules.

    A null text is the empty blob. Equal texts are one blob. Each scan writes
    its own files, so one that is repeated after a failure only adds pairs that
    are still missing; reading takes one row per pair.
    """
    spark = versions.sparkSession
    blobs = versions.select(blob_id(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = read_ledger(spark, ledger_path)
    if known is not None:
        pairs = blobs.select("blob").distinct().select("blob", F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules])).alias("p")).select("blob", "p.*")
        lacking = pairs.join(known.select("blob", "rule", "version"), ["blob", "rule", "version"], "left_anti").groupBy("blob").agg(F.collect_set("rule").alias("lacking"))
        todo = blobs.join(lacking, "blob")
    else:
        todo = blobs.withColumn("lacking", F.array(*[F.lit(r.name) for r in rules]))
    once = todo.groupBy("blob").agg(F.first("text").alias("text"), F.first("lacking").alias("lacking"))
    found = with_spans(once, rules)
    found.write.mode("append").option("compression", "zstd").parquet(ledger_path)
    return current(spark, ledger_path, rules)


def current(spark: SparkSession, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per blob: its spans by each rule, as columns named by the rules."""
    ledger = read_ledger(spark, ledger_path)
    at = [F.max(F.when((F.col("rule") == r.name) & (F.col("version") == r.version), F.col("spans"))).alias(r.name) for r in rules]
    return ledger.groupBy("blob").agg(*at)


def findings(versions: DataFrame, ledger_path: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan, and give every path its findings: carried columns, ``blob``, and per rule an array of spans.

    Every row of ``versions`` is a path: repeated rows and null numbers each
    get their findings. An empty table gives none. A carried column with the
    name of a rule or ``blob`` gives way.
    """
    names = {r.name for r in rules} | {"blob"}
    # As a table, so that Spark can split a blob that very many paths hold.
    rows = materialise(scan(versions, ledger_path, text, rules), "secret-findings")
    paths = versions.select(*[c for c in carry if c not in names], blob_id(F.col(text)).alias("blob"))
    return paths.join(rows, "blob").select(*paths.columns, *[F.coalesce(F.col(r.name), F.array()).alias(r.name) for r in rules])


def listing(rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of all spans by start, then kind as listed, comma-joined."""
    def marked(kind: int, rule: Rule) -> Column:
        return F.transform(rule.name, lambda s: F.struct(s.start.alias("start"), F.lit(kind).alias("kind"), s.end.alias("end"), F.lit(rule.name).alias("name")))

    every = F.concat(*[marked(i, r) for i, r in enumerate(rules)])
    return F.array_join(F.transform(F.array_sort(every), lambda s: F.concat_ws(":", s["name"], s.start, s.end)), ",")


def redact(versions: DataFrame, ledger_path: str, text: str = "text", mark: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` with each span of a finding replaced by ``mark``; spans that overlap are replaced together.

    The text is rebuilt per blob and joined to its paths only where the blob
    has findings; null texts stay null, all other columns stay as they are.
    """
    rows = scan(versions, ledger_path, text, rules)
    blob, gaps = free_name(versions, "_blob"), free_name(versions, "_gaps")
    # Text that stays lies between the furthest end so far and the next span's start.
    each = rows.select("blob", F.explode(F.concat(*[F.coalesce(F.col(r.name), F.array()) for r in rules])).alias("s"))
    earlier = Window.partitionBy("blob").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ended = each.withColumn("since", F.coalesce(F.max("s.end").over(earlier), F.lit(0)))
    gap = F.struct(F.col("since").alias("since"), F.col("s.start").alias("start"))
    hit = ended.groupBy(F.col("blob").alias(blob)).agg(
        F.struct(F.array_sort(F.collect_list(F.when(F.col("s.start") >= F.col("since"), gap))).alias("kept"), F.max("s.end").alias("end")).alias(gaps))
    hit = materialise(hit, "secret-findings")  # as a table: Spark broadcasts it if small, or splits a blob of very many paths
    pieces = F.transform(F.col(gaps)["kept"], lambda g: F.concat(F.substring(F.col(text), g.since + 1, g.start - g.since), F.lit(mark)))
    whole = F.concat(F.array_join(pieces, ""), F.substr(F.col(text), F.col(gaps)["end"] + 1))
    joined = versions.withColumn(blob, blob_id(F.col(text))).join(hit, blob, "left")
    clean = F.when(F.col(gaps).isNull(), F.col(text)).otherwise(whole)
    return joined.select(*[clean.alias(text) if c == text else F.col(c) for c in versions.columns])

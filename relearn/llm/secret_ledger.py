"""Operator 13: secret scans by an incremental blob ledger (DataFrame and SQL functions only).

Every version of every path is content-addressed: its blob is the SHA-256 of its text.  The ledger, two append-only
tables in a shared folder, remembers which (blob, kind, rule version) triples have been scanned (``seen``) and what was
found (``findings``).  A run looks only at the triples that the ledger lacks: texts of known blobs are not scanned
again, a new version of one rule scans with that rule alone.  Findings are then joined back to all paths and versions
that hold the blob.

Findings are written before ``seen``; a run that is lost between the two scans these blobs again, and findings are
read without repeats.  One writer per ledger is assumed.

A text is scanned once however many versions share it: copies meet in a map-side combined aggregate by blob, so a
group of copies that holds a third of all rows leaves each task as one row.  If the unseen blobs are at most
``BROADCAST_BLOBS`` (counted before), they are broadcast and known texts never leave their task.  Start and end of a
match are running sums of the lengths that ``split`` and ``regexp_extract_all`` give, taken in a window over the
matches of one blob: the work is linear in the text however many matches it has.

Nulls: a null text is an empty one.  Empty texts have a blob and no findings.  Rows that repeat a path are versions of
their own and each gets its findings.  Very long texts are scanned whole (no pattern is quadratic).  Extra columns are
ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from relearn.llm.common import cut

#: Unseen blobs that are broadcast at most, 40 bytes each.
BROADCAST_BLOBS = 100_000


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches, leftmost and not overlapping, count if group ``group`` has ``least`` characters.

    ``has`` is a string that every match contains: texts without it are passed over."""
    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    has: str = ""


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
#: The base rules.  Runs shorter than 18 and 16 can't become longer by starting later, so these bounds are in the pattern.
BASE = (
    Rule("assign", 1, f"""({_NAMES})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, "AKIA[A-Z0-9]{14,}", has="AKIA"),
    Rule("hex", 1, "[0-9a-f]{16,}"),
)
#: Public formats of credentials.
MORE = (
    Rule("pem", 1, "-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----", has="PRIVATE KEY-----"),
    Rule("jwt", 1, "eyJ[A-Za-z0-9_-]{10,1000}[.]eyJ[A-Za-z0-9_-]{10,1000}[.][A-Za-z0-9_-]{10,1000}", has="eyJ"),
    Rule("github", 1, "gh[pousr]_[A-Za-z0-9]{36,}", has="gh"),
    Rule("slack", 1, "xox[abeprs]-[A-Za-z0-9-]{10,}", has="xox"),
    Rule("google", 1, "AIza[A-Za-z0-9_-]{35}", has="AIza"),
    Rule("stripe", 1, "[rs]k_live_[A-Za-z0-9]{24,}", has="k_live_"),
    Rule("login", 1, "://[^\\x00-\\x20/:@]{1,64}:[^\\x00-\\x20/:@]{1,64}@", has="://"),
)
RULES = BASE + MORE
KINDS = [r.kind for r in RULES]

SEEN = "blob binary, kind string, version int"
FINDINGS = "blob binary, kind string, version int, spans array<struct<start:int,end:int>>"


def blob_of(text: Column) -> Column:
    """The content address of a text: SHA-256 of its bytes."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


def _rows(spark: SparkSession, rows: list[Column]) -> DataFrame:
    """A small table of structs."""
    return spark.range(1).select(F.inline(F.array(*rows)))


def read_ledger(spark: SparkSession, ledger: str, table: str, schema: str) -> DataFrame:
    """The ledger's table, without rows where nothing has been written yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ledger}/{table}")
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema(schema).parquet(f"{ledger}/{table}")
    return spark.range(0).select(F.from_json(F.lit("{}"), schema).alias("r")).select("r.*")


def _matches(rule: Rule, text: Column) -> Column:
    """For each match: the characters since the match before, its length, and whether it counts."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found

    def rows(m: Column) -> Column:
        return F.zip_with(F.arrays_zip(m.alias("m"), judged.alias("g")), F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(m)),
                          lambda x, gap: F.struct(F.length(gap).alias("gap"), F.length(x["m"]).alias("size"), (F.length(x["g"]) >= rule.least).alias("counts")))
    one = F.transform(F.array(found), lambda m: F.when(F.size(m) > 0, rows(m)))[0]
    return F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), one.alias("matches"))


def scan(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings of ``texts`` (blob, text, kinds): one row per blob and kind that has one; ``kinds`` are those to look for."""
    text = F.col("text")
    each = [F.when(F.array_contains("kinds", r.kind) & F.contains(text, F.lit(r.has)), _matches(r, text)) for r in rules]
    hits = texts.select("blob", F.explode(F.filter(F.array(*each), lambda x: x.isNotNull() & x["matches"].isNotNull())).alias("h"))
    rows = hits.select("blob", "h.kind", "h.version", F.posexplode("h.matches").alias("k", "m"))
    upto = F.sum(F.col("m.gap") + F.col("m.size")).over(Window.partitionBy("blob", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumn("end", upto.cast("int")).where("m.counts")
    span = F.struct((F.col("end") - F.col("m.size")).alias("start"), F.col("end"))
    return placed.groupBy("blob", "kind", "version").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def unseen(spark: SparkSession, blobs: DataFrame, ledger: str, rules: tuple[Rule, ...]) -> DataFrame:
    """``(blob, kinds)``: the kinds of rules, in their present versions, that the ledger lacks for a blob."""
    now = _rows(spark, [F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    seen = read_ledger(spark, ledger, "seen", SEEN).join(F.broadcast(now), ["kind", "version"], "left_semi")
    known = seen.groupBy("blob").agg(F.collect_set("kind").alias("known"))
    every = F.array(*[F.lit(r.kind) for r in rules])
    kinds = F.array_except(every, F.coalesce("known", F.array().cast("array<string>")))
    return blobs.join(known, "blob", "left").select("blob", kinds.alias("kinds")).where(F.size("kinds") > 0)


def update(versions: DataFrame, blobs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> int:
    """Scans what the ledger lacks of ``versions`` (text) and appends it; returns how many blobs were scanned.

    ``blobs`` are the distinct blobs of ``versions``."""
    spark = versions.sparkSession
    wanted = cut(unseen(spark, blobs, ledger, rules))
    count = wanted.count()
    if not count:
        return 0
    held = versions.select(blob_of(F.col("text")).alias("blob"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if count <= BROADCAST_BLOBS:
        held = held.join(F.broadcast(wanted.select("blob")), "blob", "left_semi")
    texts = held.groupBy("blob").agg(F.first("text").alias("text")).join(wanted, "blob")
    scan(texts, rules).write.mode("append").parquet(f"{ledger}/findings")
    done = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    scanned = wanted.select("blob", F.explode(F.filter(done, lambda r: F.array_contains("kinds", r["kind"]))).alias("r"))
    scanned.select("blob", "r.kind", "r.version").write.mode("append").parquet(f"{ledger}/seen")
    return count


def scan_history(versions: DataFrame, ledger: str, path: tuple[str, ...] = ("path",), rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``path`` columns, blob and ``findings`` (array of start, rank, kind, version, end by start and the rules' order) per row.

    ``versions`` has the ``path`` columns and ``text``; ``ledger`` is a folder that all executors share.  Start and end
    count code points from 0, the end is exclusive."""
    spark = versions.sparkSession
    held = cut(versions.select(*path, blob_of(F.col("text")).alias("blob")))
    update(versions, held.select("blob").distinct(), ledger, rules)
    now = _rows(spark, [F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.lit(i).alias("rank")) for i, r in enumerate(rules)])
    found = read_ledger(spark, ledger, "findings", FINDINGS).join(F.broadcast(now), ["kind", "version"]).dropDuplicates(["blob", "kind"])
    each = found.select("blob", F.explode("spans").alias("s"), "kind", "version", "rank")
    row = F.struct("s.start", "rank", "kind", "version", "s.end")
    by_blob = each.groupBy("blob").agg(F.array_sort(F.collect_list(row)).alias("findings"))
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,version:int,end:int>>")
    return held.join(by_blob, "blob", "left").select(*path, "blob", F.coalesce("findings", none).alias("findings"))

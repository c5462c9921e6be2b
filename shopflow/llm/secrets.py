"""Secret scan with an incremental ledger of blobs.

Every version of every path is addressed by its content: the SHA-256 of its text is its blob. A ledger in shared storage
lists which blobs were scanned with which version of which rule, and what was found. A scan reads one path per blob, and
only the blobs that some present rule version has not seen; a changed rule is a new version and scans again. Findings are
then joined back from blobs to all paths that hold them.

Matches and their places come from column functions only: the text between the matches and the matches themselves have
lengths, and a running sum of both gives the places in code points.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.llm.common import with_text_digest
from shopflow.plans.storage import materialize, scratch_path


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # every match has at least one character
    group: int = 0  # the part whose length decides
    least: int = 1  # code points of that part
    version: int = 1

    @property
    def tag(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules. A run of the hex alphabet or of key characters that is too short fails as a whole, so the
# least length can stand in the pattern; for assignments it cannot, as a failing match still uses up its text.
BASE_RULES = (
    Rule(
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Further public formats: private key headers and prefixed service tokens.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("prefixed", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,})"),
)
LEDGER = "blob binary, rules array<string>, found array<struct<kind:string,version:int,start:bigint,end:bigint>>"


def _matches(text: Column, rule: Rule, wanted: Column) -> Column:
    """Per match, in order: code points before it since the match before, of it, and of its deciding part."""
    pattern = F.lit(rule.pattern)
    pieces = F.transform(F.split(text, rule.pattern, -1), lambda p: F.length(p).cast("long"))
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.length(m).cast("long"))
    part = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda m: F.length(m)) if rule.group else whole
    hit = F.arrays_zip(pieces.alias("gap"), whole.alias("size"), part.cast("array<bigint>").alias("part"))
    named = F.transform(
        hit,
        lambda h, i: F.struct(
            F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), F.lit(rule.least).alias("least"), i.alias("i"),
            h["gap"].alias("gap"), h["size"].alias("size"), h["part"].alias("part"),
        ),
    )
    return F.when(wanted & text.rlike(rule.pattern), F.filter(named, lambda h: h["size"].isNotNull()))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings (blob, kind, version, start, end) of texts (blob, text, rules still to apply)."""
    each = [F.coalesce(_matches(F.col("text"), r, F.array_contains("rules", r.tag)), F.array()) for r in rules]
    hits = blobs.select("blob", F.explode(F.concat(*each)).alias("h")).select("blob", "h.*")
    so_far = Window.partitionBy("blob", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        hits.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far))
        .filter(F.col("part") >= F.col("least"))
        .select("blob", "kind", "version", (F.col("end") - F.col("size")).alias("start"), "end")
    )


def scan(
    versions: DataFrame, ledger: str, path: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES
) -> DataFrame:
    """Scan what the ledger (a folder in shared storage) lacks, note it there, and return one row per version of a path.

    Returns _path, blob and found: the findings of the given rule versions, by start and then by the rules' order. A null
    text is empty and a null path is a path. Rows that repeat a path with the same text repeat their result. A version
    that an earlier run has scanned is not read for matches again.
    """
    spark = versions.sparkSession
    paths = materialize(with_text_digest(versions.select(F.col(path).alias("_path"), F.col(text).alias("_text")), "_text", "blob").drop("_text"), "paths")
    tags = F.array(*[F.lit(r.tag) for r in rules])
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)
    noted = spark.read.schema(LEDGER).parquet(ledger)
    done = noted.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("_done"))
    chosen = paths.groupBy("blob").agg(F.min(F.struct(F.col("_path").isNull().alias("n"), F.col("_path").alias("p")))["p"].alias("_chosen"))
    unseen = materialize(
        chosen.join(done, "blob", "left")
        .withColumn("rules", F.array_except(tags, F.coalesce("_done", F.array().cast("array<string>"))))
        .filter(F.size("rules") > 0)
        .select("blob", "_chosen", "rules"),
        "unseen-blobs",
    )
    whole = with_text_digest(versions.select(F.col(path).alias("_path"), F.coalesce(F.col(text), F.lit("")).alias("text")), "text", "_blob")
    reading = whole.join(unseen.hint("shuffle_hash"), (whole["_blob"] == unseen["blob"]) & whole["_path"].eqNullSafe(unseen["_chosen"]))
    once = reading.select("blob", "text", "rules").dropDuplicates(["blob"])  # rows may repeat the chosen path
    hits = scan_blobs(once, rules)
    found = hits.groupBy("blob").agg(F.collect_list(F.struct("kind", "version", "start", "end")).alias("found"))
    nothing = F.array().cast("array<struct<kind:string,version:int,start:bigint,end:bigint>>")
    news = unseen.select("blob", "rules").join(found, "blob", "left").withColumn("found", F.coalesce("found", nothing))
    news.write.mode("append").parquet(ledger)
    noted = spark.read.schema(LEDGER).parquet(ledger)
    place = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.tag), F.lit(i))])
    known = (
        noted.filter(F.size("found") > 0)
        .select("blob", F.explode("found").alias("f"))
        .withColumn("_place", place[F.concat("f.kind", F.lit("@"), F.col("f.version").cast("string"))])
        .filter(F.col("_place").isNotNull())
        .groupBy("blob")
        .agg(F.array_sort(F.collect_set(F.struct(F.col("f.start").alias("start"), F.col("_place").alias("place"), F.col("f.kind").alias("kind"), F.col("f.end").alias("end")))).alias("found"))
    )
    return paths.join(known, "blob", "left").select(
        "_path", "blob", F.coalesce("found", F.array().cast(known.schema["found"].dataType)).alias("found")
    )


def scan_report(versions: DataFrame, ledger: str | None = None, path: str = "doc_id", text: str = "text") -> DataFrame:
    """Per version of a path: counts of the base kinds, digest of the base spans, and all spans."""
    found = scan(versions, ledger or scratch_path(versions.sparkSession, "blob-ledger"), path, text)
    base = [r.kind for r in BASE_RULES]

    def line(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("_path").alias(path),
        *[count(k) for k in base],
        F.sha2(line(F.filter("found", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"),
        line(F.col("found")).alias("spans"),
    )

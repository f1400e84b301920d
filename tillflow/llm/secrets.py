"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text. The ledger says which blob was
scanned with which rule version, and what was found; only pairs it does not hold are scanned, one
text per blob, and findings are joined back to all paths that hold the blob. Everything is DataFrame
functions; positions come from the pieces between the matches.

Defined results: NULL text is the empty text; NULL paths and repeated rows are kept, one result row
per input row; empty tables give empty tables; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.common import before_each, bind, quoted, staged
from tillflow.session import work_folder


@dataclass(frozen=True)
class Rule:
    """Leftmost, non-overlapping matches of `pattern` whose `group` has `least` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: Kinds in the order in which spans with the same start are listed.
BASE = (
    Rule(
        "assign", 1,
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6,
    ),
    # A longest run that is long enough is found alike with its least length in the pattern.
    Rule("access", 1, "AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, "[0-9a-f]{24,}"),
)
RULES = (
    *BASE,
    Rule("pem", 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
_FINDINGS = "array<struct<start:bigint,place:int,stop:bigint,kind:string>>"
LEDGER = f"blob string, scanned array<string>, findings {_FINDINGS}"


def _found(text: Column, rule: Rule, place: int) -> Column:
    """Findings of one rule as structs; computed only where the pattern occurs at all. A hit begins
    where the gaps and hits before it end."""
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    lengths = lambda part: F.struct(
        F.char_length(part["gap"]).cast("long").alias("gap"),
        F.coalesce(F.char_length(part["hit"]), F.lit(0)).cast("long").alias("hit"),
        F.coalesce(F.char_length(part["checked"]) >= rule.least, F.lit(False)).alias("kept"),
    )
    parts = F.transform(F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), hits.alias("hit"), checked.alias("checked")), lengths)

    def placed(parts: Column) -> Column:
        begins = before_each(F.transform(parts, lambda part: part["gap"] + part["hit"]), lambda a, b: a + b, F.lit(0).cast("long"))
        spans = F.zip_with(
            parts, begins,
            lambda part, at: F.struct(
                (at + part["gap"]).alias("start"), F.lit(place).alias("place"), (at + part["gap"] + part["hit"]).alias("stop"),
                F.lit(rule.kind).alias("kind"), part["kept"].alias("kept"),
            ),
        )
        kept = F.filter(spans, lambda span: span["kept"])
        return F.transform(kept, lambda span: F.struct(*[span[name].alias(name) for name in ("start", "place", "stop", "kind")]))

    return F.when(text.rlike(rule.pattern), bind(parts, placed)).otherwise(F.array().cast(_FINDINGS))


def find_spans(text: Column, rules: Sequence[Rule], wanted: Column | None = None) -> Column:
    """All findings of the rules in one text; `wanted` limits them to an array of rule keys."""
    none = F.array().cast(_FINDINGS)
    each = [
        found if wanted is None else F.when(F.array_contains(wanted, rule.key), found).otherwise(none)
        for place, rule in enumerate(rules)
        for found in [_found(text, rule, place)]
    ]
    return F.concat(*each)


def scan_unseen(
    versions: DataFrame, ledger: DataFrame | None = None, rules: Sequence[Rule] = RULES, path: str = "doc_id"
) -> tuple[DataFrame, DataFrame]:
    """What the ledger lacks, as new ledger rows, and the address of every version (path, blob).

    Both are written tables. A blob is read from the least of its paths, so hot blobs are one text.
    """
    content = F.coalesce(F.col("text"), F.lit(""))
    blob = F.sha2(content.cast("binary"), 256)
    addresses = staged(versions.select(F.col(path).alias("path"), blob.alias("blob")))
    todo = addresses.groupBy("blob").agg(F.min("path").alias("path"))
    keys = F.array(*[F.lit(rule.key) for rule in rules])
    if ledger is None:
        todo = todo.withColumn("wanted", keys)
    else:
        seen = ledger.select("blob", F.explode("scanned").alias("key")).groupBy("blob")
        seen = seen.agg(F.collect_set("key").alias("seen"))  # as many as there are rule versions
        unseen = F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>")))
        todo = todo.join(seen, "blob", "left").withColumn("wanted", unseen).where(F.size("wanted") > 0)
    texts = versions.select(F.col(path).alias("text_path"), content.alias("content"), blob.alias("text_blob"))
    same = (F.col("text_path").eqNullSafe(F.col("path"))) & (F.col("text_blob") == F.col("blob"))
    scanned = texts.join(todo.hint("shuffle_hash"), same).select(
        "blob", F.col("wanted").alias("scanned"), find_spans(F.col("content"), rules, F.col("wanted")).alias("findings")
    )
    # A path may hold the same blob in several rows.
    fresh = scanned.groupBy("blob").agg(F.first("scanned").alias("scanned"), F.first("findings").alias("findings"))
    return staged(fresh), addresses


def path_findings(addresses: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per version: path, blob, findings by start and kind, of the given rule versions."""
    current = F.array(*[F.lit(rule.key) for rule in rules])
    places = F.array(*[F.lit(rule.kind) for rule in rules])
    held = ledger.where(F.size("findings") > 0).select("blob", F.explode("findings").alias("finding"), "scanned")
    valid = held.where(
        F.exists("scanned", lambda key: F.array_contains(current, key) & F.startswith(key, F.concat("finding.kind", F.lit("@"))))
    )
    finding = F.struct("finding.start", (F.array_position(places, F.col("finding.kind")) - 1).cast("int").alias("place"), "finding.stop", "finding.kind")
    by_blob = valid.groupBy("blob").agg(F.sort_array(F.collect_list(finding)).alias("findings"))
    # A hot blob is one row here and many there: a plain join, whose skewed side Spark splits.
    joined = addresses.join(by_blob, "blob", "left")
    return joined.select("path", "blob", F.coalesce("findings", F.array().cast(_FINDINGS)).alias("findings"))


class BlobLedger:
    """A ledger kept as Parquet: each scan adds a folder, none is ever changed."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.folder = spark, folder or work_folder(spark)

    def rows(self) -> DataFrame:
        spark = self.spark
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            return spark.createDataFrame([], LEDGER)
        return spark.read.schema(LEDGER).parquet(self.folder)

    def scan(self, versions: DataFrame, rules: Sequence[Rule] = RULES, path: str = "doc_id") -> DataFrame:
        """Scan what is new, record it, and return the findings of every version given."""
        fresh, addresses = scan_unseen(versions, self.rows(), rules, path)
        fresh.write.mode("append").parquet(self.folder)
        return path_findings(addresses, self.rows(), rules)


def spans_text(findings: Column, kinds: Sequence[str] | None = None) -> Column:
    """kind:start:end of the findings, comma-joined."""
    if kinds is not None:
        findings = F.filter(findings, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def _count(findings: Column, kind: str) -> Column:
    return F.size(F.filter(findings, lambda x: x["kind"] == kind)).cast("long")


def scan_documents(documents: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per document: doc_id, the count of each base kind, base_sha256, spans, n_spans, blob."""
    fresh, addresses = scan_unseen(documents, None, rules)
    found = path_findings(addresses, fresh, rules)
    kinds = [rule.kind for rule in BASE]
    counts = [_count(F.col("findings"), kind).alias(f"n_{kind}") for kind in kinds]
    return found.select(
        F.col("path").alias("doc_id"),
        *counts,
        F.sha2(spans_text(F.col("findings"), kinds).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("findings")).alias("spans"),
        "blob",
    )


#: Characters of a text that are looked through to cut a piece out of it.
BLOCK_CHARS = 4096


def _marked(text: Column, findings: Column, mark: str) -> Column:
    """The text with a mark for every run of overlapping findings, which come by start. Pieces are cut out
    of blocks: cutting them out of the text would count its characters from the first every time."""
    length = F.char_length(text).cast("long")
    block = lambda n: F.substring(text, (n * BLOCK_CHARS + 1).cast("int"), F.lit(BLOCK_CHARS))
    blocks = F.transform(F.sequence(F.lit(0).cast("long"), F.floor(length / BLOCK_CHARS)), block)

    def of_blocks(blocks: Column) -> Column:
        def piece(begin: Column, end: Column) -> Column:
            first = F.floor(begin / BLOCK_CHARS)
            some = F.slice(blocks, (first + 1).cast("int"), (F.floor(end / BLOCK_CHARS) - first + 1).cast("int"))
            return F.substring(F.array_join(some, ""), (begin - first * BLOCK_CHARS + 1).cast("int"), (end - begin).cast("int"))

        # What lies before the last stop so far is in a mark already.
        done = before_each(F.transform(findings, lambda x: x["stop"]), lambda a, b: F.greatest(a, b), F.lit(0).cast("long"))
        gaps = F.zip_with(findings, done, lambda x, at: F.when(x["start"] >= at, F.concat(piece(at, x["start"]), F.lit(mark))).otherwise(F.lit("")))
        last = F.array_max(F.transform(findings, lambda x: x["stop"]))
        return F.concat(F.array_join(gaps, ""), piece(last, length))

    return bind(blocks, of_blocks)


def redacted(documents: DataFrame, rules: Sequence[Rule] = RULES, mark: str = "[secret]") -> DataFrame:
    """The documents with every span of a finding replaced by the mark; n_chars follows the text.

    The ledger keeps the rows of one text together only by address, so texts are redacted where they
    are read and only those with findings meet them: the join is by content address.
    """
    fresh, _ = scan_unseen(documents, None, rules)
    hits = fresh.where(F.size("findings") > 0).select(F.col("blob").alias("hit_blob"), F.sort_array("findings").alias("hit_findings"))
    names = documents.columns
    rows = documents.select(F.struct(*quoted(names)).alias("row"), F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("row_blob"))
    joined = rows.join(hits, F.col("row_blob") == F.col("hit_blob"), "left")
    text = F.col("row")["text"]
    marked = _marked(text, F.col("hit_findings"), mark)
    clean = F.when(F.col("hit_findings").isNull(), text).otherwise(marked)
    columns = {name: F.col("row").getField(name) for name in names} | {"text": clean}
    if "n_chars" in names:
        length = F.char_length(clean).cast(documents.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("hit_findings").isNull(), F.col("row")["n_chars"]).otherwise(length)
    return joined.select(*[columns[name].alias(name) for name in names])

"""WARC derivatives: a metadata and a plain-text conversion record for every response record.

Both records refer to the response by its identifier, carry its target URI and date, and name the
source's digests; the metadata record keeps the source's HTTP headers, the title and the links. All
identifiers are derived from content, so that a repeated task writes the same records.

Defined results: NULL payload is an empty one and NULL URI an empty URI; repeated responses give
repeated records; an empty table gives no records; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import SPACE

DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"
#: What is not text, what ends a line of text, and named characters.
UNSEEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
BREAKS = r"(?i)</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|article|section|header|footer|nav|aside|main|form|blockquote|pre|title|head|body|html)\b[^>]*>"
TAGS = r"<[a-zA-Z/!?][^>]*>"
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&nbsp;": " ",
    "&copy;": "©",
    "&middot;": "·",
    "&amp;": "&",
}
LINKS = r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"'>]*)["']"""
TITLE = r"(?is)<title[^>]*>(.*?)</title\s*>"


def _urn(*parts: Column) -> Column:
    """A name-based identifier of the parts."""
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    pieces = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 3), (16, 3), (19, 12))]
    a, b, c, d, e = pieces
    return F.concat(F.lit("<urn:uuid:"), a, F.lit("-"), b, F.lit("-8"), c, F.lit("-a"), d, F.lit("-"), e, F.lit(">"))


def _sha256(column: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(column.cast("binary"), 256))


def plain_text(html: Column) -> Column:
    """Visible text, a line for each block."""
    text = F.regexp_replace(html, UNSEEN, "")
    text = F.regexp_replace(F.regexp_replace(text, BREAKS, "\n"), TAGS, "")
    for name, value in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(value))
    text = F.regexp_replace(text, r"[\x20\t\x0B\f\r]+", " ")
    return F.regexp_replace(F.regexp_replace(text, r" ?\n[ \n]*", "\n"), r"^[ \n]+|[ \n]+$", "")


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Pages as response records: page_id, record_id, target_uri, date, http_headers, payload."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    uri = F.coalesce(F.col("url"), F.lit(""))
    length = F.octet_length(payload)
    headers = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), length)
    return pages.select(
        "page_id",
        _urn(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), uri, F.sha2(payload.cast("binary"), 256)).alias("record_id"),
        uri.alias("target_uri"),
        F.lit(date).alias("date"),
        headers.alias("http_headers"),
        payload.alias("payload"),
    )


def derive(source: DataFrame) -> DataFrame:
    """Two records per response: page_id, record_type, record_id, refers_to, target_uri,
    content_type, content_length, block_digest, payload_digest, record (header and block)."""
    title = F.trim(F.regexp_replace(F.regexp_extract("payload", TITLE, 1), SPACE + "+", " "))
    links = F.regexp_extract_all("payload", F.lit(LINKS), F.lit(1))
    kept = source.select(
        "page_id", "record_id", "target_uri", "date", "http_headers",
        _sha256(F.col("payload")).alias("payload_digest"),
        plain_text(F.col("payload")).alias("text"),
        title.alias("title"),
        links.alias("links"),
    )
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    outlinks = F.array_join(F.transform("links", lambda link: F.concat(F.lit("outlink: "), F.regexp_replace(link, r"[\r\n]+", " "), F.lit(CRLF))), "")
    source_headers = F.array_join(F.transform(F.split("http_headers", CRLF), lambda line: F.concat(F.lit("source-header: "), line, F.lit(CRLF))), "")
    facts = F.concat(
        source_headers, field("source-payload-digest", F.col("payload_digest")), field("title", F.col("title")),
        field("outlinks", F.size("links").cast("string")), outlinks,
    )
    blocks = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"), facts.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")),
    )
    rows = kept.select("page_id", "record_id", "target_uri", "date", "payload_digest", F.inline(blocks))
    own = rows.select(
        "*",
        _urn(F.col("record_type"), F.col("record_id")).alias("own_id"),
        _sha256(F.col("block")).alias("block_digest"),
        F.octet_length("block").cast("long").alias("content_length"),
    )
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), field("WARC-Type", F.col("record_type")), field("WARC-Record-ID", F.col("own_id")),
        field("WARC-Refers-To", F.col("record_id")), field("WARC-Target-URI", F.col("target_uri")), field("WARC-Date", F.col("date")),
        field("WARC-Block-Digest", F.col("block_digest")), field("WARC-Source-Payload-Digest", F.col("payload_digest")),
        field("Content-Type", F.col("content_type")), field("Content-Length", F.col("content_length").cast("string")),
    )
    return own.select(
        "page_id", "record_type", F.col("own_id").alias("record_id"), F.col("record_id").alias("refers_to"), "target_uri",
        "content_type", "content_length", "block_digest", "payload_digest",
        F.concat(header, F.lit(CRLF), F.col("block")).alias("record"),
    )


def write_warc(records: DataFrame, folder: str, compression: str = "gzip") -> None:
    """Records as WARC files, one per task; two line ends close each record."""
    lines = records.select("record").write.option("lineSep", CRLF * 2).option("compression", compression)
    lines.text(folder)

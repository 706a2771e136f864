"""WARC derivatives: linked metadata and plain-text conversion records of responses.

Each response gives two records. Both carry ``WARC-Refers-To`` with the response's id,
its target address and date; the metadata record keeps the source's headers, payload
digest and length; the conversion record holds the text. Ids and digests follow from the
content, so a repeated job writes the same records. Everything is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm.common import read

#: Named references that are decoded; the ampersand is last, so that
#: nothing is decoded twice.
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&nbsp;": " ",
    "&copy;": "©",
    "&reg;": "®",
    "&middot;": "·",
    "&hellip;": "…",
    "&ndash;": "–",
    "&mdash;": "—",
    "&euro;": "€",
    "&amp;": "&",
}
HIDDEN = "(?is)<!--.*?-->|<(?:script|style)\\b[^>]*>.*?</(?:script|style)\\s*>"
BREAKS = "(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|nav|article|section|header|footer|title|head|body|html)\\b[^>]*>"
TAGS = "<[^>]*>"
DATE = "1970-01-01T00:00:00Z"


def record_id(*parts: Column | str) -> Column:
    """A name-based id: the md5 of the parts in the form of a UUID."""
    digest = F.md5(F.concat_ws("|", *parts))
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cut]), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def plain_text(html: Column) -> Column:
    """Visible text, one line per block; lines are trimmed and blank ones dropped."""
    text = F.regexp_replace(html, HIDDEN, "")
    text = F.regexp_replace(F.regexp_replace(text, BREAKS, "\n"), TAGS, "")
    for name, char in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(char))
    text = F.regexp_replace(text, "[ \\t\\r]+", " ")
    return F.regexp_replace(F.regexp_replace(text, " ?\n[ \n]*", "\n"), "^[ \n]+|[ \n]+$", "")


def responses(pages: DataFrame) -> DataFrame:
    """Pages as response records. Null addresses and bodies are empty."""
    url, html = (F.coalesce(F.col(c), F.lit("")) for c in ("url", "html"))
    return pages.select(
        "page_id",
        record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), url, F.md5(html)).alias("record_id"),
        url.alias("target_uri"),
        F.lit(DATE).alias("date"),
        F.lit("HTTP/1.1 200 OK").alias("status"),
        F.array(
            F.lit("Content-Type: text/html; charset=utf-8"),
            F.concat(F.lit("Content-Length: "), F.octet_length(html).cast("string")),
        ).alias("headers"),
        html.alias("payload"),
    )


def _serialised(kind: Column, rid: Column, refers: Column, content: Column, block: Column) -> Column:
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", rid),
        line("WARC-Refers-To", refers),
        line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Date", F.col("date")),
        line("WARC-Block-Digest", digest(block)),
        line("Content-Type", content),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    return F.concat(head, F.lit("\r\n\r\n"), block, F.lit("\r\n\r\n"))


def derive(found: DataFrame) -> DataFrame:
    """Two rows per response: ``metadata`` and ``conversion``, with the record as written.

    No response, no rows; repeated responses give repeated records with the same ids.
    """
    metadata = F.concat(
        F.concat_ws(
            "\r\n",
            F.concat(F.lit("source-status: "), F.col("status")),
            F.transform("headers", lambda h: F.concat(F.lit("source-header: "), h)),
            F.concat(F.lit("source-payload-digest: "), digest(F.col("payload"))),
            F.concat(F.lit("source-payload-length: "), F.octet_length("payload").cast("string")),
        ),
        F.lit("\r\n"),
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("kind"), F.lit("application/warc-fields").alias("content"), metadata.alias("block")),
        F.struct(F.lit("conversion").alias("kind"), F.lit("text/plain; charset=utf-8").alias("content"), plain_text(F.col("payload")).alias("block")),
    )
    rows = found.withColumn("r", F.explode(kinds)).select("*", "r.kind", "r.content", "r.block")
    rid = record_id(F.col("kind"), F.col("record_id"), F.md5("block"))
    return rows.select(
        "page_id",
        F.col("kind").alias("record_type"),
        rid.alias("record_id"),
        F.col("record_id").alias("refers_to"),
        "target_uri",
        F.col("content").alias("content_type"),
        F.octet_length("block").cast("long").alias("content_length"),
        digest(F.col("block")).alias("block_digest"),
        digest(F.col("payload")).alias("source_digest"),
        F.col("block"),
        _serialised(F.col("kind"), rid, F.col("record_id"), F.col("content"), F.col("block")).alias("record"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both derivatives of every page; the record itself as its digest."""
    rows = derive(responses(read(spark, sf_dir, "pages")))
    return rows.drop("block").withColumn("record", F.sha2("record", 256)).withColumnRenamed("record", "record_sha256")


def _oracle() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    text = f"regexp_replace(html, {q(HIDDEN)}, '', 'g')"
    text = f"regexp_replace(regexp_replace({text}, {q(BREAKS)}, chr(10), 'g'), {q(TAGS)}, '', 'g')"
    for name, char in ENTITIES.items():
        text = f"replace({text}, {q(name)}, {q(char)})"
    text = f"regexp_replace({text}, '[ \\t\\r]+', ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, ' ?\\n[ \\n]*', chr(10), 'g'), '^[ \\n]+|[ \\n]+$', '', 'g')"
    rid = lambda x: f"'<urn:uuid:' || substr({x},1,8) || '-' || substr({x},9,4) || '-' || substr({x},13,4) || '-' || substr({x},17,4) || '-' || substr({x},21,12) || '>'"
    nl = "chr(13) || chr(10)"
    return f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
r AS (SELECT *, md5('response|' || coalesce(CAST(page_id AS VARCHAR), '') || '|' || url || '|' || md5(html)) AS h FROM p),
b AS (
  SELECT *, 'metadata' AS kind, 'application/warc-fields' AS content,
    'source-status: HTTP/1.1 200 OK' || {nl} || 'source-header: Content-Type: text/html; charset=utf-8' || {nl}
    || 'source-header: Content-Length: ' || strlen(html) || {nl} || 'source-payload-digest: sha256:' || sha256(html) || {nl}
    || 'source-payload-length: ' || strlen(html) || {nl} AS block FROM r
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8', {text} FROM r),
d AS (SELECT *, {rid('h')} AS refers, md5(kind || '|' || {rid('h')} || '|' || md5(block)) AS g FROM b)
SELECT page_id, kind AS record_type, {rid('g')} AS record_id, refers AS refers_to, url AS target_uri,
  content AS content_type, CAST(strlen(block) AS BIGINT) AS content_length, 'sha256:' || sha256(block) AS block_digest,
  'sha256:' || sha256(html) AS source_digest,
  sha256('WARC/1.1' || {nl} || 'WARC-Type: ' || kind || {nl} || 'WARC-Record-ID: ' || {rid('g')} || {nl} || 'WARC-Refers-To: ' || refers || {nl}
    || 'WARC-Target-URI: ' || url || {nl} || 'WARC-Date: {DATE}' || {nl} || 'WARC-Block-Digest: sha256:' || sha256(block) || {nl}
    || 'Content-Type: ' || content || {nl} || 'Content-Length: ' || strlen(block) || {nl} || {nl} || block || {nl} || {nl}) AS record_sha256
FROM d"""


ORACLE = _oracle()

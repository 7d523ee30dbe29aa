"""WARC derivatives: each response record gives a metadata record and a plain-text conversion record."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
# WARC wants a capture date; a table of pages without one gets this.
DATE = "2024-01-01T00:00:00Z"

# What becomes of markup, in this order: pattern, replacement.
MARKUP = [
    (r"(?is)<!--.*?-->", " "),
    (r"(?is)<script\b.*?</script\s*>", " "),
    (r"(?is)<style\b.*?</style\s*>", " "),
    (r"(?is)<head\b.*?</head\s*>", " "),
    (r"(?i)<(?:br|/?p|/?div|/?li|/?ul|/?ol|/?tr|/?table|/?h[1-6]|/?article|/?section|/?nav|/?header|/?footer)\b[^>]*>", "\n"),
    (r"(?s)<[/!a-zA-Z][^>]*>", ""),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
    (r"[ \t\r]+", " "),
    (r" ?\n[ \n]*", "\n"),
    (r"^[ \n]+|[ \n]+$", ""),
]

RECORD = (
    "warc_type string, record_id string, refers_to string, target_uri string, warc_date string, "
    "content_type string, content_length long, block_digest string, headers string, block string"
)


def plain_text(html: Column) -> Column:
    """Visible text: no comments, scripts, styles or head; a line per block element."""
    text = html
    for pattern, replacement in MARKUP:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def digest(block: Column) -> Column:
    """A labelled digest of a string's UTF-8 bytes."""
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def record_id(kind: str, *parts: Column) -> Column:
    """A record id that is the same in every run: a UUID made of the MD5 of what the record is about."""
    md5 = F.md5(F.concat_ws("|", F.lit(kind), *parts))
    cuts = [F.substring(md5, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _headers(kind: Column, refers_to: Column, extra: list[tuple[str, Column]]) -> Column:
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", F.col("record_id")),
        ("WARC-Refers-To", refers_to),
        ("WARC-Target-URI", F.col("target_uri")),
        ("WARC-Date", F.col("warc_date")),
        *extra,
        ("WARC-Block-Digest", F.col("block_digest")),
        ("Content-Type", F.col("content_type")),
        ("Content-Length", F.col("content_length").cast("string")),
    ]
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    return F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines)


def responses(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE
) -> DataFrame:
    """Pages as response records, with their id beside them.

    A null page counts as an empty one; a page without a URL has no ``WARC-Target-URI``. Pages with
    equal id and URL get equal record ids. Other columns are not looked at.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(html).cast("string"),
        F.lit(CRLF + CRLF),
    )
    rows = pages.select(
        F.col(id_col).alias("id"),
        record_id("response", F.col(id_col).cast("string"), F.col(url_col)).alias("record_id"),
        F.col(url_col).alias("target_uri"),
        F.lit(date).alias("warc_date"),
        F.lit("application/http; msgtype=response").alias("content_type"),
        digest(html).alias("payload_digest"),
        F.concat(http, html).alias("block"),
    )
    rows = rows.withColumn("content_length", F.octet_length("block").cast("long"))
    rows = rows.withColumn("block_digest", digest(F.col("block")))
    headers = _headers(
        F.lit("response"), F.lit(None).cast("string"), [("WARC-Payload-Digest", F.col("payload_digest"))]
    )
    return rows.select(
        "id", F.lit("response").alias("warc_type"), "record_id", F.lit(None).cast("string").alias("refers_to"),
        "target_uri", "warc_date", "content_type", "content_length", "block_digest", headers.alias("headers"), "block",
    )


def header(headers: Column, name: str) -> Column:
    """A field of a header block, null where it is absent."""
    found = F.regexp_extract(headers, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def derivatives(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A metadata and a conversion record for each response; other records give none.

    Both refer to the response by its record id and carry its URI and date. The metadata record's
    fields are the response's status line and HTTP header, its block and payload digests, the title,
    the conversion record's id, and every link in order. The payload digest is the response's own
    where it states one, else computed. ``keep`` names columns to carry. A response without a header
    end is all payload; nulls count as empty.
    """
    block = F.coalesce(F.col("block"), F.lit(""))
    split = F.instr(block, CRLF + CRLF)
    rows = records.where(F.col("warc_type") == "response").select(
        *keep,
        F.col("record_id").alias("source_id"), "target_uri", "warc_date",
        F.col("block_digest").alias("source_digest"), F.col("headers").alias("source_headers"),
        F.when(split > 0, F.substr(block, F.lit(1), split - 1)).otherwise(F.lit("")).alias("http"),
        F.when(split > 0, F.substr(block, split + 4)).otherwise(block).alias("payload"),
    )
    stated = header(F.col("source_headers"), "WARC-Payload-Digest")
    rows = rows.withColumn("payload_digest", F.coalesce(stated, digest(F.col("payload"))))
    # The two ids depend on the source's id alone, so each can name the other.
    rows = rows.withColumn("conversion_id", record_id("conversion", F.col("source_id")))
    rows = rows.withColumn("metadata_id", record_id("metadata", F.col("source_id")))
    title = F.regexp_replace(
        F.regexp_extract("payload", r"(?is)<title\b[^>]*>(.*?)</title", 1), r"\s+", " "
    )
    links = F.regexp_extract_all("payload", F.lit(r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"'\r\n]*)["']"""), F.lit(1))
    fields = F.concat_ws(
        CRLF,
        F.concat(F.lit("source-status: "), F.split_part("http", F.lit(CRLF), F.lit(1))),
        F.concat(F.lit("source-content-type: "), header(F.col("http"), "Content-Type")),
        F.concat(F.lit("source-content-length: "), header(F.col("http"), "Content-Length")),
        F.concat(F.lit("source-block-digest: "), F.col("source_digest")),
        F.concat(F.lit("source-payload-digest: "), F.col("payload_digest")),
        F.concat(F.lit("conversion-record: "), F.col("conversion_id")),
        F.concat(F.lit("title: "), title),
        F.transform(links, lambda link: F.concat(F.lit("outlink: "), link)),
    )
    made = F.array(
        F.struct(
            F.lit("metadata").alias("warc_type"), F.col("metadata_id").alias("record_id"),
            F.lit("application/warc-fields").alias("content_type"), F.concat(fields, F.lit(CRLF)).alias("block"),
        ),
        F.struct(
            F.lit("conversion").alias("warc_type"), F.col("conversion_id").alias("record_id"),
            F.lit("text/plain; charset=utf-8").alias("content_type"), plain_text(F.col("payload")).alias("block"),
        ),
    )
    rows = rows.withColumn("made", F.explode(made)).select(
        *keep, "made.*", F.col("source_id").alias("refers_to"), "target_uri", "warc_date",
        "payload_digest",
    )
    rows = rows.withColumn("content_length", F.octet_length("block").cast("long"))
    rows = rows.withColumn("block_digest", digest(F.col("block")))
    source = [("WARC-Source-Payload-Digest", F.col("payload_digest"))]
    return rows.select(
        *keep, "warc_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "content_length",
        "block_digest", "payload_digest", _headers(F.col("warc_type"), F.col("refers_to"), source).alias("headers"),
        "block",
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Records as WARC files, a file for each partition.

    A record is its headers, an empty line, the block and an empty line; the text writer's line feed
    is the last byte of that.
    """
    end = F.lit("\r\n\r")
    row = F.concat(F.col("headers"), F.lit(CRLF + CRLF), F.coalesce(F.col("block"), F.lit("")), end)
    records.select(row.alias("value")).write.text(path)


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of a WARC file's bytes, by their stated lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end].decode("utf-8")
        lines = [line.split(":", 1) for line in head.split(CRLF)[1:]]
        fields = {name.strip().lower(): value.strip() for name, value in lines}
        size = int(fields["content-length"])
        yield {
            "warc_type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"),
            "refers_to": fields.get("warc-refers-to"), "target_uri": fields.get("warc-target-uri"),
            "warc_date": fields.get("warc-date"), "content_type": fields.get("content-type"),
            "content_length": size, "block_digest": fields.get("warc-block-digest"), "headers": head,
            "block": data[end + 4 : end + 4 + size].decode("utf-8", "replace"),
        }
        at = end + 4 + size + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of uncompressed WARC files; each file is read by one task."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                held, size = [], 0
                for record in parse_records(data.as_py()):
                    held.append(record)
                    size += record["content_length"]
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    schema = pa.schema(
        [(name, pa.int64() if kind == "long" else pa.string()) for name, kind in (x.split() for x in RECORD.split(", "))]
    )
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(parse, RECORD)

"""WARC archives without repeated payloads: revisit records refer to the first response."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shutterlake.llm.common import checkpointed, materialized

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
RFC4648 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
DATE = "2024-01-01T00:00:00Z"
ID = "urn:page:"
LONGEST = 1 << 30  # bytes of a payload


def base32_sha1(payload: Column) -> Column:
    """Base-32 text of the SHA-1 of a string's UTF-8 bytes."""
    digits = F.sha1(payload)
    # 20 bits, five hexadecimal digits, are four digits of base 32
    four = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*four), DIGITS, RFC4648)


def headers(pages: DataFrame, id_column: str = "page_id", html: str = "html") -> DataFrame:
    """``(page_id, payload_bytes, payload_digest)``: no payload is in it."""
    payload = F.coalesce(F.col(html), F.lit(""))
    return pages.select(
        F.col(id_column).alias("page_id"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        base32_sha1(payload).alias("payload_digest"),
    )


def originals(heads: DataFrame, least_bytes: int) -> DataFrame:
    """``(payload_bytes, payload_digest, original)`` of payloads that occur more than once.

    Headers are shuffled by digest after tasks have combined them, so a payload that is on a
    third of all pages is a few rows.
    """
    return (
        heads.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.min("page_id").alias("original"), F.count("*").alias("_times"))
        .where("_times > 1")
        .drop("_times")
    )


def write(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
    archive_records: int = 2000,
    archive_bytes: int = 128 << 20,
) -> None:
    """Writes ``pages`` as WARC files below ``path``, one record a row.

    Of records with equal payloads of at least ``least_bytes`` bytes, the one with the smallest
    id is a response with the payload; the others are revisit records without it that refer
    to the response by its record id. Smaller payloads are all responses. Records that repeat
    an id are all responses if that id is the original. Rows without an id are responses (they
    can not be told apart by revisits). A null payload is empty, a null url is left out. Line
    breaks in a url are escaped. Other columns are not read.

    Spark's text writer writes the files: a record ends with two line breaks, which is its line
    separator. Every file holds at most ``archive_records`` records and about ``archive_bytes``
    bytes, or one record that is longer: records are written by size, those up to twice as long
    with half as many to a file, each size below a folder of its own. A payload over 1 GB is
    refused, as no reader could take its archive.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(id_column).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("bytes"),
        base32_sha1(payload).alias("digest"),
    )
    # a table, so that Spark knows its size and need not shuffle payloads to a small one
    first = materialized(originals(headers(pages, id_column, html), least_bytes), "originals")
    joined = rows.join(
        first,
        (F.col("digest") == F.col("payload_digest")) & (F.col("bytes") == F.col("payload_bytes")),
        "left",
    )
    revisit = F.col("original").isNotNull() & (F.col("page_id") != F.col("original"))
    revisit = F.coalesce(revisit, F.lit(False))

    def record_id(page: str) -> Column:
        """The id and the payload's digest, as one id may come with several payloads."""
        return F.concat(F.lit(f"<{ID}"), F.col(page).cast("string"), F.lit(":"), "digest", F.lit(">"))

    lines = [
        F.lit(VERSION),
        F.when(revisit, "WARC-Type: revisit").otherwise("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: "), F.coalesce(record_id("page_id"), F.lit(f"<{ID}>"))),
        F.concat(
            F.lit("WARC-Target-URI: "),
            F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")),
        ),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, f"WARC-Profile: {PROFILE}"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_id("original"))),
        F.concat(
            F.lit("Content-Length: "),
            F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string"),
        ),
    ]
    head = F.concat_ws("\r\n", *lines)  # leaves out what is null
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    least = max(1, archive_bytes // archive_records)
    size = F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    # 0 for the records of which a file may hold the full number, one more for each doubling
    step = F.greatest(F.ceil(F.log2(size / F.lit(least))), F.lit(0)).cast("int")
    step = F.when(size > least, step).otherwise(0)
    records = joined.select(F.concat(head, F.lit(END), body).alias("value"), step.alias("step"))
    steps = [r["step"] for r in _steps(pages, html, least).collect()]
    if least << max(steps, default=0) > 2 * LONGEST:
        raise ValueError(f"a payload is longer than {LONGEST} bytes")
    for number in steps or [0]:
        (
            records.where(F.col("step") == number).select("value")
            .write.option("lineSep", END)
            .option("maxRecordsPerFile", max(1, archive_records >> number))
            .text(f"{path}/step={number}")
        )


def _steps(pages: DataFrame, html: str, least: int) -> DataFrame:
    """The doublings of ``least`` bytes that pages reach, one row each."""
    size = F.octet_length(F.coalesce(F.col(html), F.lit("")))
    step = F.when(size > least, F.ceil(F.log2(size / F.lit(least)))).otherwise(0).cast("int")
    return pages.select(step.alias("step")).union(
        pages.sparkSession.range(1).select(F.lit(0))  # revisits have no payload
    ).distinct().orderBy("step")


RECORD = re.compile(rb"WARC/1\.[01]\r\n(.*?)\r\n\r\n", re.DOTALL)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and content of every record, by their content length."""
    at = 0
    while at < len(archive):
        match = RECORD.match(archive, at)
        if match is None:
            raise ValueError(f"no record at byte {at}")
        pairs = (line.split(b":", 1) for line in match[1].split(b"\r\n") if b":" in line)
        head = {k.strip().decode().lower(): v.strip().decode() for k, v in pairs}
        start = match.end()
        end = start + int(head["content-length"])
        if archive[end : end + 4] != END.encode():
            raise ValueError(f"the record at byte {at} does not end where it should")
        yield head, archive[start:end]
        at = end + 4


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(record_type, record_id, refers_to, url, digest, payload)``: one row for every record.

    A file is read whole by one task; ``write`` bounds its records.
    """
    names = ["record_type", "record_id", "refers_to", "url", "digest", "payload"]
    kinds = [pa.string()] * 5 + [pa.binary()]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = [
                    (
                        head["warc-type"],
                        head.get("warc-record-id"),
                        head.get("warc-refers-to"),
                        head.get("warc-target-uri"),
                        head.get("warc-payload-digest", "").removeprefix("sha1:"),
                        content,
                    )
                    for head, content in parse(batch.column(0)[i].as_py())
                ]
                if rows:
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
                    )

    schema = ", ".join(f"{n} string" for n in names[:-1]) + ", payload binary"
    return files.mapInArrow(run, schema)


def resolve(records: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of read records.

    Length and digest of a response are taken anew from its content. A revisit gets those of the
    response it refers to; it has none if that is missing. A response that many revisits name
    is one row of the smaller side, and Spark splits the larger.
    """
    heads = checkpointed(
        records.select(
            "record_type", "record_id", "refers_to",
            F.octet_length("payload").cast("bigint").alias("own_bytes"),
            base32_sha1(F.col("payload")).alias("own_digest"),
        )
    )
    is_revisit = F.col("record_type") == "revisit"
    named = (
        heads.where(~is_revisit)
        .groupBy(F.col("record_id").alias("named"))
        .agg(F.min("own_bytes").alias("bytes"), F.min("own_digest").alias("digest"))
    )

    def page(reference: str) -> Column:
        return F.regexp_extract(reference, f"^<{ID}(-?[0-9]+):", 1).try_cast("bigint")

    plain = heads.where(~is_revisit).select(
        page("record_id").alias("page_id"), F.col("own_bytes").alias("payload_bytes"),
        F.col("own_digest").alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"),
    )
    joined = heads.where(is_revisit).join(named, F.col("refers_to") == F.col("named"), "left")
    revisits = joined.select(
        page("record_id").alias("page_id"), F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"),
    )
    return plain.unionByName(revisits)

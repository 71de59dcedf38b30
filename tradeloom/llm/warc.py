"""WARC archives: written with an index, read back by byte ranges from the index.

Each partition of the input becomes one archive, whose size follows from `spark.sql.files.maxPartitionBytes`.
An archive's records get their offsets from a running sum of record lengths before anything is written;
that is the index (archive, offset, length, URL, digest per record), stored first. The archives themselves
are plain text files whose lines are whole records ended by the two line breaks that WARC asks for, so
Spark's own writer commits them whole or not at all, on any file system. A reader takes index rows, sorts the wanted ranges of an
archive, joins neighbouring ones into one read, and parses the records.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.llm.scratch import new_path, save
from tradeloom.operators.matching import join_side_keys

END = "\r\n\r\n"
BROADCAST_ROWS = 500_000
_DATE = "2000-01-01T00:00:00Z"
_BASE32_HEX = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of a binary or string column in bare upper-case base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _BASE32_HEX, _BASE32)


def describe(pages: DataFrame, min_bytes: int = 0) -> tuple[DataFrame, bool]:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to and row of each row of `pages`, and
    whether the rows still lie in the partitions in which they were read.

    refers_to is the smallest page_id with the same payload, for all others with it; NULL for that page
    itself, for payloads below `min_bytes`, and for pages without page_id, which nothing can refer to.
    """
    known = pages.select(
        "page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
        F.monotonically_increasing_id().alias("row"),
    )
    known = known.withColumns(
        {"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": base32_sha1(F.col("payload"))}
    )
    first = (
        known.filter((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
        .groupBy(*join_side_keys("payload_digest"))
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .select("payload_digest", "first_id")
    )
    # Stored and counted: only a small table is broadcast, which leaves the payloads where they are.
    first, _ = save(first, "first-payloads")
    in_place = first.count() <= BROADCAST_ROWS
    if in_place:
        first = F.broadcast(first)
    refers = (F.col("page_id") > F.col("first_id")) & (F.col("payload_bytes") >= min_bytes)
    described = known.join(first, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(refers, F.col("first_id")).alias("refers_to"), "row",
    )
    return described, in_place


def _head(revisit: Column) -> Column:
    """The header of a record with the empty line behind it."""
    # A line break in a URL would end the header.
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"\r\nWARC-Date: {_DATE}\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(
            revisit,
            F.concat(
                F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"),
                F.lit("\r\nX-Payload-Length: "), F.col("payload_bytes").cast("string"),
            ),
        ).otherwise(""),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(revisit, "0").otherwise(F.col("payload_bytes").cast("string")),
        F.lit(END),
    )


def write(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Writes the archives under `folder`/archives and their index under `folder`/index; gives the index.

    `pages` has page_id, url, html (NULL: an empty payload). Every row becomes one record, repeated rows
    too. Of records with equal payloads of at least `min_bytes` bytes that with the smallest page_id is a
    response; those with a larger page_id revisit it and carry no payload. Other columns are not read.
    Index columns: archive, offset, length, url, payload_digest, page_id.
    """
    spark = pages.sparkSession
    revisit = F.col("refers_to").isNotNull()
    records, in_place = describe(pages, min_bytes)
    records = records.select(
        F.shiftright("row", 33).alias("archive"),  # the input partition, in the upper bits of the id
        "row", "page_id", "url", "payload_digest", _head(revisit).alias("head"),
        F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).alias("body_bytes"),
        F.when(revisit, "").otherwise(F.col("payload")).alias("body"),
    )
    length = F.octet_length("head") + F.col("body_bytes")
    behind = Window.partitionBy("archive").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    index = (
        records.select("archive", "row", "page_id", "url", "payload_digest", length.alias("length"))
        .withColumn("offset", F.sum(F.col("length") + len(END)).over(behind) - F.col("length") - len(END))
        .select("archive", "offset", "length", "url", "payload_digest", "page_id")
    )
    index.write.option("compression", "zstd").parquet(f"{folder}/index")
    stored = records.select("archive", "row", F.concat("head", "body").alias("record"))
    if not in_place:
        stored = stored.repartition("archive")
    stored = stored.sortWithinPartitions("archive", "row").select("archive", "record")
    stored.write.partitionBy("archive").option("lineSep", END).text(f"{folder}/archives")
    return spark.read.schema(index.schema).parquet(f"{folder}/index")


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """(archive, path): the file of each archive."""
    files = spark.read.format("binaryFile").load(f"{folder}/archives")
    # From the path, for a folder without archives has no such column.
    return files.select(F.regexp_extract("path", r"archive=(\d+)", 1).cast("bigint").alias("archive"), "path")


def _ranges(wanted: list[tuple[int, int]], gap: int, most: int) -> list[tuple[int, int]]:
    """Sorted (offset, length) ranges joined into reads: neighbours at most `gap` bytes apart, up to
    `most` bytes together unless one range alone is longer."""
    reads: list[list[int]] = []
    for offset, length in wanted:
        if reads and offset - reads[-1][1] <= gap and offset + length - reads[-1][0] <= most:
            reads[-1][1] = max(reads[-1][1], offset + length)
        else:
            reads.append([offset, offset + length])
    return [(begin, end - begin) for begin, end in reads]


def parse(record: bytes) -> dict:
    """Header fields and payload of one record."""
    head, _, payload = record.partition(END.encode())
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    if int(fields["Content-Length"]) != len(payload):
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    return {"fields": fields, "payload": payload}


def _page_id(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


_READ = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def _read(gap: int, most: int, with_payload: bool):
    def run(batches):
        from pyarrow import fs

        path = source = None
        for batch in batches:
            rows = batch.to_pylist()
            begin = 0
            while begin < len(rows):
                end = begin
                while end < len(rows) and rows[end]["path"] == rows[begin]["path"]:
                    end += 1
                if rows[begin]["path"] != path:
                    path = rows[begin]["path"]
                    store, inner = fs.FileSystem.from_uri(path)
                    source = store.open_input_file(inner)
                wanted = [(r["offset"], r["length"]) for r in rows[begin:end]]
                at = 0
                for offset, length in _ranges(wanted, gap, most):
                    chunk = source.read_at(length, offset)
                    out = []
                    while at < len(wanted) and wanted[at][0] + wanted[at][1] <= offset + length:
                        o, n = wanted[at]
                        out.append(_described(chunk[o - offset : o - offset + n], with_payload))
                        at += 1
                    yield _table(out)
                begin = end

    return run


def _described(record: bytes, with_payload: bool) -> tuple:
    import base64
    import hashlib

    parsed = parse(record)
    fields, payload = parsed["fields"], parsed["payload"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    size = int(fields["X-Payload-Length"]) if kind == "revisit" else len(payload)
    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return (
        _page_id(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], kind, _page_id(fields.get("WARC-Refers-To")),
        size, digest, payload if with_payload and kind == "response" else None,
    )


def _table(rows: list[tuple]) -> pa.RecordBatch:
    types = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in _READ.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields]
    )


def read(
    wanted: DataFrame, folder: str, gap: int = 64 << 10, most: int = 8 << 20, with_payload: bool = True
) -> DataFrame:
    """The records that the index rows `wanted` (archive, offset, length) name, read from `folder`.

    Ranges of an archive are sorted and joined into reads of up to `most` bytes over gaps of up to `gap`.
    Columns: page_id, url, record_type, refers_to, payload_bytes, payload_digest (both of the full
    payload, also for revisits), payload (NULL for revisits, or without `with_payload`). Payloads of
    responses are checked against their digests; damaged records raise.
    """
    files = archive_files(wanted.sparkSession, folder)
    placed = wanted.select("archive", "offset", "length").join(files, "archive")
    ordered = placed.repartition("archive").sortWithinPartitions("archive", "offset")
    return ordered.select("path", "offset", "length").mapInArrow(_read(gap, most, with_payload), _READ)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """All pages written to a fresh folder and read back through the index, without payloads."""
    folder = new_path(pages.sparkSession, "warc")
    index = write(pages, folder, min_bytes)
    return read(index, folder, with_payload=False).drop("payload")

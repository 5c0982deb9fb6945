"""WARC archives as a table of chunks.

A payload is written in segments of a bounded size: a ``response`` record and ``continuation`` records of
the same origin, each a row of its own, with the digest of the payload up to its end. No segment
holds the line that opens a record, so archives can be split and read by that line alone. Reading
gives rows (record, chunk number, bytes); digests are summed up chunk by chunk and a
record is never put together.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .common import map_rows, stored

OPENING = "\r\n\r\nWARC/1.1\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 16
# Names of standard header fields, and two of our own for the key and the size.
FIELDS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "origin": "WARC-Segment-Origin-ID", "chunk": "WARC-Segment-Number",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "X-Refers-To-Key", "key": "X-Key", "payload_bytes": "X-Payload-Length",
    "running_digest": "X-Running-Digest", "length": "Content-Length",
}


def revisits(pages: DataFrame, id_col: str, payload: Column, least: int = 100) -> DataFrame:
    """``pages`` with ``payload``, ``payload_digest`` and ``refers_to``.

    Of equal payloads of at least ``least`` bytes the row with the smallest id is the response; ``refers_to``
    names it in the others. A row without id never is one's response, so it revisits if another row has an id.
    """
    told = pages.select(F.col(id_col).cast("long").alias("key"), "url", payload.alias("payload"))
    told = told.withColumn("payload_digest", F.sha2("payload", 256))
    long = told.filter(F.octet_length("payload") >= least)
    firsts = long.groupBy("payload_digest").agg(F.min("key").alias("first"), F.count("*").alias("rows"))
    firsts = stored(firsts.filter("rows > 1 and first is not null").select("payload_digest", "first"), "firsts")
    refers = F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first"))
    return told.join(firsts, "payload_digest", "left").withColumn("refers_to", refers).drop("first")


def cuts(payload: bytes, chunk: int) -> list[tuple[int, int]]:
    """Bounds of the segments of a payload: at most ``chunk`` bytes, none with ``WARC/1.1`` and a line end inside."""
    ends = [m.start() + 2 for m in re.finditer(rb"WARC/1\.1\r\n", payload)]
    places, start = [], 0
    for end in [*ends, len(payload)]:
        while start < end:
            stop = min(end, start + chunk)
            places.append((start, stop))
            start = stop
    return places or [(0, 0)]


def _header(fields: dict) -> bytes:
    lines = (f"{k}: {re.sub('[^!-~]', '_', str(v))}" for k, v in fields.items() if v is not None)
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode()


def write_archive(pages: DataFrame, folder: str, chunk: int = CHUNK) -> None:
    """Write ``pages(key, url, payload, payload_digest, refers_to)`` as WARC files, one for each task.

    A null payload counts as empty; a null digest is taken from the payload.
    """

    def records(rows):
        for row, key, url, payload, digest, refers in rows:
            name = f"<urn:record:{row}:1>"
            shared = {"WARC-Target-URI": url, "X-Key": key, "X-Payload-Length": len(payload), "WARC-Payload-Digest": f"sha256:{digest}"}
            if refers is not None:
                more = {"WARC-Type": "revisit", "WARC-Record-ID": name, "WARC-Profile": PROFILE, "X-Refers-To-Key": refers}
                yield (_header(more | shared | {"Content-Length": len(HTTP)}) + HTTP + b"\r\n\r",)
                continue
            running, places = hashlib.sha256(), cuts(payload, chunk)
            for number, (start, end) in enumerate(places, 1):
                part = payload[start:end]
                running.update(part)
                body = HTTP + part if number == 1 else part
                more = {"WARC-Type": "response" if number == 1 else "continuation", "WARC-Record-ID": f"<urn:record:{row}:{number}>"}
                if len(places) > 1:
                    more |= {"WARC-Segment-Number": number, "WARC-Segment-Origin-ID": name, "X-Running-Digest": running.hexdigest()}
                    if number == len(places):
                        more["WARC-Segment-Total-Length"] = len(payload) + len(HTTP)
                yield (_header(more | shared | {"Content-Length": len(body)}) + body + b"\r\n\r",)

    payload = F.coalesce("payload", F.lit("").cast("binary"))
    numbered = pages.select(F.monotonically_increasing_id().alias("row"), "key", "url", payload.alias("payload"), F.coalesce("payload_digest", F.sha2(payload, 256)).alias("payload_digest"), "refers_to")
    rows = map_rows(numbered, records, "value binary", flush=64)
    rows.select(F.col("value").cast("string")).write.option("lineSep", "\n").text(folder)


def read_chunks(spark, folder: str) -> DataFrame:
    """``(record, chunk, key, record_type, refers_to, payload_bytes, payload_digest, running_digest, body)``.

    One row for each record of the archives, oversized payloads in several; a record that is not as
    long as its header says fails the query.
    """
    piece = F.col("value")
    piece = F.when(F.startswith(piece, F.lit("WARC/1.1\r\n")), F.substring(piece, 11, F.length(piece))).otherwise(piece)
    cut = spark.read.text(folder, lineSep=OPENING).select(piece.alias("value")).withColumn("head", F.substring_index("value", "\r\n\r\n", 1))

    def field(name):
        found = F.regexp_extract("head", rf"(?m)^{FIELDS[name]}: (.*?)\r?$", 1)
        return F.when(found != "", found)

    data = F.col("value").cast("binary")
    whole = F.substring(data, F.octet_length("head") + 5, F.octet_length("value"))
    size = field("length").cast("int")
    fits = (F.octet_length(whole) == size) | (F.octet_length(whole) == size + 4)  # the last of a file keeps its end
    body = F.when(fits, F.substring(whole, F.lit(1), size)).otherwise(F.raise_error(F.lit("a WARC record has another length than its header says")))
    chunks = cut.select(*(field(n).alias(n) for n in FIELDS), body.alias("body"))
    payload = F.when(F.col("record_type") != "continuation", F.substring("body", F.lit(len(HTTP) + 1), F.octet_length("body"))).otherwise(F.col("body"))
    return chunks.select(
        F.regexp_extract(F.coalesce("origin", "record_id"), r"record:(\d+):", 1).cast("long").alias("record"),
        F.coalesce(F.col("chunk").cast("int"), F.lit(1)).alias("chunk"),
        F.col("origin").isNotNull().alias("in_chunks"),
        F.when(F.col("key") != "None", F.col("key")).cast("long").alias("key"),
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
        F.col("payload_bytes").cast("long").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
        "running_digest",
        payload.alias("body"),
    )


def payloads(chunks: DataFrame) -> DataFrame:
    """``(key, payload_bytes, payload_digest, record_type, refers_to)``: each record once, sizes and digests taken from its bytes.

    Chunks of one record meet sorted in one task, where a running digest goes over them; memory does
    not grow with the record. A digest that differs from the header's fails the query. A revisit
    has no bytes: its digest and size are the header's.
    """
    same = (F.sha2("body", 256) == F.col("payload_digest")) & (F.octet_length("body") == F.col("payload_bytes"))
    sound = F.when(same, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a payload differs from its digest")))
    columns = "key", "payload_bytes", "payload_digest", "record_type", "refers_to"
    short = chunks.filter("not in_chunks").withColumn(
        "payload_digest", F.when(F.col("record_type") == "revisit", F.col("payload_digest")).otherwise(sound)
    )
    long = chunks.filter("in_chunks").repartition(shuffle_partitions(chunks.sparkSession), "record").sortWithinPartitions("record", "chunk")

    def fold(rows):
        last = key = total = wanted = None
        running, size, number = hashlib.sha256(), 0, 0
        for record, chunk, own, told, digest, so_far, body in rows:
            if record != last:
                if last is not None:
                    yield _checked(key, size, total, running.hexdigest(), wanted)
                last, key, total, wanted, running, size, number = record, own, told, digest, hashlib.sha256(), 0, 0
            number += 1
            running.update(body)
            size += len(body)
            if chunk != number or running.hexdigest() != so_far:
                raise ValueError(f"record {record} breaks at chunk {chunk}")
        if last is not None:
            yield _checked(key, size, total, running.hexdigest(), wanted)

    long = long.select("record", "chunk", "key", "payload_bytes", "payload_digest", "running_digest", "body")
    folded = map_rows(long, fold, "key long, payload_bytes long, payload_digest string")
    folded = folded.withColumn("record_type", F.lit("response")).withColumn("refers_to", F.lit(None).cast("long"))
    return short.select(*columns).unionByName(folded)


def _checked(key, size, total, digest, wanted):
    if size != total or digest != wanted:
        raise ValueError(f"the payload of {key} differs from its header")
    return key, size, digest

"""Pages as WARC archives, and archives as pages: equal payloads are stored once.

Writing: digests decide which page of equal payloads is stored (the smallest id), the others point
to it. Records are put into volumes of bounded size, one text row and one file each, with the
end of a record as the line end, so Spark's own text writer lays them down in any store it can
reach. A long record is cut into segments, which may lie in different volumes.

Reading: each task parses volumes; segments are brought together by the identifier of their origin,
ordered by number, and checked against the stated length; then the transfer framing is taken off.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill.llm import frames, warc
from prosemill.llm.shared import kept, new_folder

#: Bytes of a block in one record, of a chunk of its body, and of a volume (about).
SEGMENT_BYTES, CHUNK_BYTES, VOLUME_BYTES = 1 << 16, 1 << 13, 16 << 20
#: Payloads of fewer bytes are stored each.
LEAST_BYTES = 0
#: The date of all records: pages have none.
DATE = "2024-01-01T00:00:00Z"
#: Keys with more than rows / MOST_HOT rows (LEAST_HOT at least) are looked up by a broadcast: there are fewer than MOST_HOT.
MOST_HOT, LEAST_HOT = 10_000, 10_000

PARTS = (
    "origin string, type string, page_id bigint, uri string, refers_to_uri string, digest string, "
    "number int, total bigint, block binary"
)


def looked_up(rows: DataFrame, found: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join of narrow rows to one row per key, whose number of rows is in `size`.

    A key that very many rows have does not bring them to one task: such keys are fewer than
    MOST_HOT by their definition, and are sent to the rows.
    """
    limit = max(LEAST_HOT, total // MOST_HOT)
    hot, cold = found.where(F.col(size) > limit), found.where(F.col(size) <= limit)
    beside = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(beside.join(cold, key, "left"))


def decided(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Pages with their payloads' digests and, for those not stored, the page stored in their place.

    Stored is the smallest id (a null id last) of equal payloads; of repeated rows with that id the
    first in the table as written here.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = kept(rows.withColumn("locator", F.monotonically_increasing_id()), "pages", "zstd")
    own = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "locator", "url")
    keys = kept(rows.select(F.sha2("html", 256).alias("key"), F.octet_length("html").alias("size"), own.alias("own")), "payload_keys")
    groups = keys.where(F.col("size") >= least_bytes).groupBy("key").agg(F.min("own").alias("first"), F.count(F.lit(1)).alias("copies"))
    groups = kept(groups.where("copies > 1"), "equal_payloads")
    at = looked_up(keys.where(F.col("size") >= least_bytes), groups, "key", "copies", keys.count())
    others = at.where("first.locator != own.locator").select(F.col("own.locator").alias("locator"), "first")
    return rows.join(others, "locator", "left")


def write_archives(
    pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
    volume_bytes: int = VOLUME_BYTES, least_bytes: int = LEAST_BYTES, compression: str = "gzip",
) -> None:
    """Write a record for every page, in volumes under `path`, each one gzip member (or `none`).

    A null page counts as empty; a null url leaves its field out; repeated rows are records each; a
    page of any length is cut into segments; an empty table gives no volumes. Other columns are
    not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        volume: list[bytes] = []
        size = 0
        for batch in batches:
            for part in frames.slices(batch, "html"):
                for row in part.to_pylist():
                    for record in _records(row, segment_bytes, chunk_bytes):
                        volume.append(record)
                        size += len(record)
                        if size >= volume_bytes:
                            yield pa.RecordBatch.from_arrays([pa.array([warc.END.join(volume)], pa.binary())], names=["volume"])
                            volume, size = [], 0
        if volume:
            yield pa.RecordBatch.from_arrays([pa.array([warc.END.join(volume)], pa.binary())], names=["volume"])

    rows = decided(pages, least_bytes).select(
        "page_id", "locator", "url", "html", F.col("first.page_id").alias("first_id"),
        F.col("first.locator").alias("first_locator"), F.col("first.url").alias("first_url"),
    )
    volumes = rows.mapInArrow(run, "volume binary").select(F.col("volume").cast("string"))
    volumes.write.option("lineSep", warc.END.decode()).option("maxRecordsPerFile", 1).text(path, compression=compression)


def _records(row: dict, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    payload = row["html"].encode("utf-8", "replace")
    fields: dict[str, object] = {
        "WARC-Type": "response", "WARC-Record-ID": warc.record_uri(row["page_id"], row["locator"]), "WARC-Date": DATE,
        "WARC-Target-URI": None if row["url"] is None else warc.clean(row["url"]), "Page-ID": row["page_id"],
        "WARC-Payload-Digest": f"sha1:{warc.digest(payload)}", "Content-Type": warc.HTTP_KIND,
    }
    if row["first_locator"] is None:
        yield from warc.segmented(fields, warc.HTTP_HEAD + warc.chunked(payload, chunk_bytes), segment_bytes)
        return
    fields |= {
        "WARC-Type": "revisit", "WARC-Profile": warc.SAME_PAYLOAD,
        "WARC-Refers-To": warc.record_uri(row["first_id"], row["first_locator"]),
        "WARC-Refers-To-Target-URI": None if row["first_url"] is None else warc.clean(row["first_url"]),
    }
    yield warc.record_bytes(fields, warc.HTTP_HEAD)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """Every record that carries a page or a part of one, as it stands in the archives.

    `origin` is the identifier of the record that a part belongs to. An archive is read whole by
    one task, plain or as gzip members. A malformed archive stops the job and is named.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, held, size = frames.arrow_schema(PARTS), [], 0

        def handed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            for row in range(batch.num_rows):
                name = batch.column("path")[row].as_py()
                try:
                    for record in warc.records(batch.column("content")[row].as_py()):
                        if record.fields.get("warc-type") in ("response", "revisit", "continuation", "resource"):
                            held.append(_part(record))
                            size += len(record.block)
                            if size >= frames.SLICE_BYTES:
                                yield handed()
                                held, size = [], 0
                except (warc.Malformed, ValueError) as error:
                    raise ValueError(f"{name}: {error}") from error
        if held:
            yield handed()

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, PARTS)


def _part(record: warc.Record) -> tuple:
    fields, kind = record.fields, record.fields["warc-type"]

    def number(name: str) -> int | None:
        return int(fields[name]) if name in fields else None

    digest = fields.get("warc-payload-digest", "").rpartition(":")[2] or None
    origin = fields.get("warc-segment-origin-id") if kind == "continuation" else fields.get("warc-record-id")
    return (origin, kind, number("page-id"), fields.get("warc-target-uri"), fields.get("warc-refers-to"), digest,
            number("warc-segment-number"), number("warc-segment-total-length"), record.block)


def reassembled(parts: DataFrame) -> DataFrame:
    """Whole records. Those in segments are put together by origin, in order of their numbers.

    `fault` says what is wrong with one: a segment missing or repeated, no first record, no stated
    length, or another length than stated. Records in one piece are not shuffled.
    """
    segment = F.struct("number", F.octet_length("block").alias("size"), "total", "block")
    head = F.max(F.when(F.col("type") != "continuation", F.struct("type", "page_id", "uri", "refers_to_uri", "digest")))
    groups = parts.where("number IS NOT NULL OR type = 'continuation'").groupBy("origin").agg(
        head.alias("head"), F.sort_array(F.collect_list(segment)).alias("segments")
    )
    numbers, total = F.col("segments.number"), F.array_max("segments.total")
    whole = F.aggregate("segments", F.lit(0).cast("bigint"), lambda size, s: size + s["size"])
    fault = (
        F.when(F.col("head").isNull(), "no first segment")
        .when(numbers != F.sequence(F.lit(1), F.size("segments")), "segments missing or repeated")
        .when(total.isNull() | F.element_at("segments", -1)["total"].isNull(), "no total length")
        .when(whole != total, "not the total length")
    )
    joined = F.array_join(F.transform("segments", lambda s: s["block"].cast("string")), "").cast("binary")
    put_together = groups.select("origin", "head.*", F.array_join(F.array(fault), "").alias("fault"), joined.alias("block"))
    whole_ones = parts.where("number IS NULL AND type != 'continuation'").select(
        "origin", "type", "page_id", "uri", "refers_to_uri", "digest", F.lit("").alias("fault"), "block"
    )
    return whole_ones.unionByName(put_together)


PAGES = (
    "record_id string, type string, page_id bigint, uri string, refers_to_uri string, stated_digest string, "
    "fault string, payload binary, payload_bytes bigint, payload_digest string"
)


def read_pages(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record: identifier, type, page, payload, its bytes and digest, and what is
    wrong with it, if anything. A revisit has no payload of its own. Without `payloads` the payload
    itself is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = frames.arrow_schema(PAGES)
        for batch in batches:
            for part in frames.slices(batch, "block"):
                rows = [_page_row(row, payloads) for row in part.to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return reassembled(read_parts(spark, path)).mapInArrow(run, PAGES)


def _page_row(row: dict, payloads: bool) -> tuple:
    fault, payload, found = row["fault"] or None, None, None
    if not fault and row["type"] != "revisit":
        try:
            payload = warc.payload_of(row["block"]) if row["type"] == "response" else row["block"]
            found = warc.digest(payload)
            if row["digest"] and row["digest"] != found:
                fault = "another digest than stated"
        except warc.Malformed as error:
            fault = str(error)
    size = None if payload is None else len(payload)
    return (row["origin"], row["type"], row["page_id"], row["uri"], row["refers_to_uri"], row["digest"], fault,
            payload if payloads else None, size, found)


def archive_report(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write all pages as archives, read them back, and report each page's payload and record.

    Size and digest of a revisit are those of the record it refers to. A fault in an archive stops
    the job. An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = path or new_folder(spark, "archives")
    write_archives(pages, path)
    sound = F.when(F.col("fault").isNotNull(), F.raise_error(F.concat_ws(": ", "record_id", "fault"))).otherwise(F.col("type"))
    found = read_pages(spark, path, payloads=False).select(
        "record_id", "page_id", "refers_to_uri", "stated_digest", "payload_bytes", "payload_digest", sound.alias("type")
    )
    found = kept(found, "read_back")
    stored = found.where("type = 'response'").select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("bigint").alias("refers_to"))
    visits = found.where("type = 'revisit'").select("page_id", F.col("refers_to_uri").alias("record_id"))
    copies = kept(visits.groupBy("record_id").agg(F.count(F.lit(1)).alias("copies")), "revisited")
    origins = found.join(copies, "record_id").select(
        "record_id", "copies", F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest"
    )
    again = looked_up(visits, kept(origins, "origins"), "record_id", "copies", visits.count())
    return stored.unionByName(again.select("page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to"))

"""WARC archives: one record a page, written by Spark's text writer and read back by boundary-chain verification.

Reading splits archives anywhere. Scanning tasks take each magic for a candidate, read its declared length and send out
where its chain of successors leaves the split. Pointer jumping over these hops, from the start of each file, finds the
true first record of each split, so a magic inside a payload is never taken for a record. A second scan starts from there;
a record whose payload has a magic in a later split is put together from its fragments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossweave.llm.common import filled
from glossweave.session import materialise, stage_path

MAGIC = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
#: Payloads below this size are never replaced by a reference.
SMALLEST_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
#: Rows of a lookup table that are broadcast at most (about 100 bytes each); a larger one is joined by shuffling.
BROADCAST_ROWS = 200_000
#: Splits of one read, which bounds the broadcast list of their first records.
MAX_SPLITS = 2_000_000


def _record_id(page: Column) -> Column:
    h = F.md5(F.concat(F.lit("page "), F.coalesce(page.cast("string"), F.lit("null"))))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def first_of_payload(pages: DataFrame, ident: str, html: str) -> DataFrame:
    """(``digest``, ``first``) of payloads that several pages share and that are not small."""
    payload = filled(F.col(html))
    shared = pages.select(F.sha2(payload, 256).alias("__digest"), F.col(ident).alias("id"), F.octet_length(payload).alias("n"))
    groups = shared.filter(F.col("n") >= SMALLEST_REVISIT).groupBy("__digest").agg(F.min("id").alias("__first"), F.count("*").alias("n"))
    return groups.filter("n > 1 AND __first IS NOT NULL").drop("n")


def write_archives(pages: DataFrame, path: str, ident: str = "page_id", url: str = "url", html: str = "html") -> None:
    """A ``response`` record for each row, or a ``revisit`` of the smallest id with an equal payload of 100 bytes or more.

    A NULL payload is empty; a NULL id is written as such and always revisits where it can; rows that repeat the smallest
    id are responses too; line breaks in a URL are escaped. An empty table writes an archive without records.
    """
    first = materialise(first_of_payload(pages, ident, html), "payloads")
    first = F.broadcast(first) if first.count() <= BROADCAST_ROWS else first
    payload = filled(F.col(html))
    rows = pages.withColumn("__digest", F.sha2(payload, 256)).join(first, "__digest", "left")
    page = F.col(ident)
    again = F.col("__first").isNotNull() & ~page.eqNullSafe(F.col("__first"))
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    block = F.when(again, F.lit("")).otherwise(F.concat(http, payload))
    target = F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), r"[\r\n]", "%0A")
    refers = F.concat(
        F.lit("WARC-Refers-To: "), _record_id(F.col("__first")),
        F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
    )
    record = F.concat(
        F.lit(MAGIC.decode()), F.lit("WARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), _record_id(page), F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), target,
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("__digest"), F.lit("\r\n"), F.when(again, refers).otherwise(F.lit("")),
        F.lit("X-Page-ID: "), F.coalesce(page.cast("string"), F.lit("")),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"), block,
    )
    rows.select(record.alias("value")).write.option("lineSep", END.decode()).text(path)


def _header(data: bytes) -> tuple[dict[str, str], int]:
    """Fields of a record and the length of its header, magic included; no end of header gives length 0."""
    end = data.find(END)
    if not data.startswith(MAGIC) or end < 0:
        return {}, 0
    fields = {}
    for line in data[len(MAGIC) : end].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            fields.setdefault(name.strip().lower(), value.strip())
    return fields, end + len(END)


def record_length(data: bytes) -> int:
    """Bytes from a record's magic to its successor's, by its declared length; -1 if it is no record."""
    fields, head = _header(data)
    declared = fields.get("content-length", "")
    return head + int(declared) + len(END) if head and declared.isascii() and declared.isdigit() and len(declared) < 16 else -1


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """Archive texts cut at each magic, in order within a split; the reader works on any file system of Spark."""
    raw = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes | None, tuple]]:
    """(split key, chunk, further columns); a chunk of None ends a split."""
    now, extra = None, ()
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for file, split, value, *rest in zip(*columns, strict=True):
            if now is not None and now != (file, split):
                yield now, None, extra
            now, extra = (file, split), tuple(rest)
            yield now, value or b"", extra
    if now is not None:
        yield now, None, extra


def _scan_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per candidate: where it starts and where its chain leaves the split; one row without a start has the split's size."""
    at, found = 0, []
    for (file, split), chunk, _ in _walk(batches):
        if chunk is not None:
            start = at - len(MAGIC)
            if split or at:
                found.append((start, record_length(MAGIC + chunk)))
            at += len(chunk) + len(MAGIC)
            continue
        leaves: dict[int, int] = {}
        for start, length in reversed(found):
            then = start + length
            if length > 0:
                leaves[start] = then if then >= at - len(MAGIC) else leaves.get(then, -(1 << 62))
        rows = [(file, split, s, e) for s, e in leaves.items() if e >= 0] + [(file, split, None, at)]
        columns = list(zip(*rows, strict=True))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["file", "split", "start", "leave"])
        at, found = 0, []


def first_records(chunks: DataFrame) -> DataFrame:
    """(``file``, ``split``, ``base``, ``entry``): a split's place in its file and its first true record, relative to it.

    Each round doubles the hops of every candidate and adds what the records reached so far lead to. Both tables of hops grow
    with the archives, so they are merged, never broadcast.
    """
    scanned = materialise(chunks.mapInArrow(_scan_splits, "file string, split bigint, start bigint, leave bigint"), "candidates")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = scanned.filter("start IS NULL").select("file", "split", F.coalesce(F.sum("leave").over(before), F.lit(0)).alias("base"))
    hops = scanned.filter("start IS NOT NULL").join(splits.hint("merge"), ["file", "split"])
    hops = materialise(hops.select("file", (F.col("base") + F.col("start")).alias("off"), (F.col("base") + F.col("leave")).alias("to"), "split", "base"), "hops")
    jump = hops.select("file", "off", "to")
    reached, count = materialise(jump.filter("off = 0").select("file", "off"), "reached"), 0
    while count < (count := reached.count()):
        further = reached.join(jump.hint("merge"), ["file", "off"]).select("file", F.col("to").alias("off"))
        reached = materialise(reached.unionByName(further).distinct(), "reached")
        beyond = jump.select("file", F.col("off").alias("to"), F.col("to").alias("beyond")).hint("merge")
        jump = materialise(jump.join(beyond, ["file", "to"]).select("file", "off", F.col("beyond").alias("to")), "jumps")
    entries = hops.join(reached.hint("merge"), ["file", "off"]).groupBy("file", "split").agg(F.min("off").alias("off"))
    return splits.join(entries.hint("merge"), ["file", "split"], "left").select("file", "split", "base", (F.col("off") - F.col("base")).alias("entry"))


_FIELDS = "page_id string, record_id string, refers_to string, record_type string, payload_bytes bigint, payload_digest string"


def parse_record(data: bytes) -> tuple:
    """The values of ``_FIELDS`` of one whole record; a revisit has no payload of its own."""
    fields, head = _header(data)
    block = data[head : head + int(fields["content-length"])]
    payload = block.partition(END)[2]
    kind = fields.get("warc-type")
    size = len(payload) if kind == "response" else None
    declared = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    digest = hashlib.sha256(payload).hexdigest() if kind == "response" else declared
    if digest != declared:
        raise ValueError(f"record {fields.get('warc-record-id')}: payload does not have its declared digest")
    return fields.get("x-page-id") or None, fields.get("warc-record-id"), fields.get("warc-refers-to"), kind, size, digest


def _read_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from each split's first one on; what belongs to a record of another split goes out as a fragment."""
    out: list[tuple] = []
    at, want, begin, need, size = 0, None, 0, 0, 0
    held: list[bytes] = []

    def batch() -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.binary(), *[pa.string()] * 4, pa.int64(), pa.string()]
        names = ["file", "off", "opens", "data", *[f.split()[0] for f in _FIELDS.split(", ")]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(*[zip(*out, strict=True), kinds], strict=True)], names)

    for (file, split), chunk, (base, entry) in _walk(batches):
        if chunk is None:
            if size:
                out.append((file, base + begin, need > 0, b"".join(held), *[None] * 6))
            at, want, held, need, size = 0, None, [], 0, 0
            continue
        want = entry if at == 0 else want
        start = at - len(MAGIC)
        data = (MAGIC if split or at else b"") + chunk
        if start == want:
            if size:
                out.append((file, base + begin, False, b"".join(held), *[None] * 6))
            need, begin, held, size = record_length(data), start, [], 0
        elif not held:
            begin = start
        held.append(data)
        size += len(data)
        if 0 < need <= size:
            out.append((file, base + begin, True, None, *parse_record(b"".join(held))))
            want, held, need, size = begin + need, [], 0, 0
        at += len(chunk) + len(MAGIC)
        if len(out) >= 1000:
            yield batch()
            out = []
    if out:
        yield batch()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the archives below ``path``, revisits with their response's payload figures.

    A response is found by record id and payload digest, since ids may repeat with other payloads; a revisit without one raises.
    """
    chunks = _chunks(spark, path)
    entries = materialise(first_records(chunks), "entries")
    if (splits := entries.count()) > MAX_SPLITS:
        raise ValueError(f"{splits} splits; read at most {MAX_SPLITS} at a time, by folders of archives")
    placed = chunks.join(F.broadcast(entries), ["file", "split"]).select("file", "split", "value", "base", "entry")
    read = materialise(placed.mapInArrow(_read_splits, f"file string, off bigint, opens boolean, data binary, {_FIELDS}"), "records")
    whole = read.filter("data IS NULL").drop("file", "off", "opens", "data")
    order = Window.partitionBy("file").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
    owned = read.filter("data IS NOT NULL").select("file", "off", "data", F.last(F.when(F.col("opens"), F.col("off")), True).over(order).alias("own"))
    joined = owned.filter("own IS NOT NULL").groupBy("file", "own").agg(F.sort_array(F.collect_list(F.struct("off", "data"))).alias("parts"))
    joined = joined.select(F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["data"])).alias("data"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = list(zip(*[parse_record(d) for d in part.column(0).to_pylist()], strict=True))
            kinds = [*[pa.string()] * 4, pa.int64(), pa.string()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], [f.split()[0] for f in _FIELDS.split(", ")])

    records = whole.unionByName(joined.mapInArrow(parse, _FIELDS))
    responses = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("there"), F.col("page_id").alias("page"), F.col("payload_digest").alias("same")
    )
    revisits = records.filter("record_type = 'revisit'").drop("payload_bytes")
    wanted = materialise(revisits.select("refers_to", F.col("payload_digest").alias("same")).distinct(), "wanted")
    answers = responses.join(wanted.hint("merge"), ["refers_to", "same"], "left_semi").dropDuplicates(["refers_to", "same"])
    revisits = revisits.withColumnRenamed("payload_digest", "same").join(answers.hint("merge"), ["refers_to", "same"], "left").withColumnRenamed("same", "payload_digest")
    lost = F.raise_error(F.concat(F.lit("no response for revisit "), F.coalesce("record_id", F.lit("without id")))).cast("bigint")
    revisits = revisits.withColumn("payload_bytes", F.when(F.col("there").isNull(), lost).otherwise(F.col("there")))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    return records.filter("record_type = 'response'").select(*columns, F.lit(None).cast("string").alias("refers_to")).unionByName(
        revisits.select(*columns, F.col("page").alias("refers_to"))
    )


def archive_round_trip(pages: DataFrame, ident: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes ``pages`` as archives in the shared folder and reads them back; ids have their own type again."""
    path = stage_path(pages.sparkSession, "warc")
    write_archives(pages, path, ident, url, html)
    kind = pages.schema[ident].dataType
    back = read_archives(pages.sparkSession, path)
    return back.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind)).select(
        F.col("page_id").alias(ident), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ROUND_TRIP_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""

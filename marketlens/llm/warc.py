"""WARC archives: written as text files by Spark, read back in splits with boundary-chain verification.

Payloads are not shuffled: records are planned on digests, splits are linked by rows of offsets, and a record is put
together where its split is read. Only records that reach over a split's end travel.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, fits, join_checked, small_batches, stored

MAGIC = "WARC/1."
END = "\r\n\r\n"
#: Stands in a url for what follows a magic's letters: ESCAPE + 2E is the magic, ESCAPE + 25 is ESCAPE itself.
ESCAPE = MAGIC[:-1] + "%"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1, from the hex digits (base-32 digits of each 40 bits, renamed)."""
    hexes = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexes, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Per page: payload, its size and digest, record_type and refers_to.

    Of equal payloads of at least min_bytes the row with the largest page_id is the response (a null id is the
    smallest). This is decided on digests alone, by partial aggregation, and the payloads that occur more than once
    come back to the pages as a checked broadcast. Where several rows of a payload have the largest id, one with the
    least url is the response.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", base32_sha1(F.encode("payload", "UTF-8")))
    by_id = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "page_id").agg(F.count("*").alias("n"), F.min("url").alias("url"))
    order = F.coalesce(F.col("page_id"), F.lit(-(1 << 63)))
    best = by_id.groupBy("payload_digest").agg(F.sum("n").alias("_copies"), F.max("page_id").alias("_best"), F.max_by("n", order).alias("_ties"), F.max_by(F.struct("url"), order).alias("_first"))
    best = stored(best.where("_copies > 1").select("payload_digest", "_best", "_ties", F.col("_first.url").alias("_url")), "copies")
    rows = join_checked(rows, best, "payload_digest", "left")
    is_best = F.col("page_id").eqNullSafe(F.col("_best"))
    first = F.col("_ties").isNull() | is_best
    out = ["page_id", "url", "payload", "payload_bytes", "payload_digest", F.when(first, "response").otherwise("revisit").alias("record_type"), F.when(~first, F.col("_best")).alias("refers_to")]
    if best.where("_ties > 1").isEmpty():
        return rows.select(*out)
    # rows of one payload with one id: the first with the least url is the response, the rest are told by their count
    tied = rows.where((F.col("_ties") > 1) & is_best)
    response = tied.where(F.col("url").eqNullSafe(F.col("_url"))).groupBy("payload_digest", "page_id", "url", "payload_bytes").agg(F.first("payload").alias("payload"))
    rest = tied.groupBy("payload_digest", "page_id", "url", "payload_bytes", "_url").agg(F.count("*").alias("n"))
    rest = rest.withColumn("n", F.col("n") - F.col("url").eqNullSafe(F.col("_url")).cast("int")).where("n > 0")
    rest = rest.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("n"))))
    cols = ["page_id", "url", "payload", "payload_bytes", "payload_digest"]
    return (
        rows.where(~F.coalesce((F.col("_ties") > 1) & is_best, F.lit(False))).select(*out)
        .unionByName(response.select(*cols, F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")))
        .unionByName(rest.withColumn("payload", F.lit("")).select(*cols, F.lit("revisit").alias("record_type"), F.col("page_id").alias("refers_to")))
    )


def _id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def write_archives(records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one WARC/1.0 record per row, with Spark's text writer (each task writes one archive).

    A response carries an HTTP header and the payload; a revisit has the HTTP header alone and names the response
    by WARC-Refers-To. Control characters in a url are percent-encoded. So is the point of a magic in a url, as a
    header must lie in one segment; `page_records` undoes it.
    """
    is_response = F.col("record_type") == "response"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    length = F.octet_length(http) + F.when(is_response, F.col("payload_bytes")).otherwise(0)
    url = F.regexp_replace(F.regexp_replace("url", r"\r", "%0D"), r"\n", "%0A")
    url = F.replace(F.replace(url, F.lit(ESCAPE), F.lit(ESCAPE + "25")), F.lit(MAGIC), F.lit(ESCAPE + "2E"))
    head = F.concat(
        F.lit(MAGIC + "0\r\nWARC-Type: "),
        F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "),
        _id(F.col("page_id")),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), url), F.lit("")),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha1:"),
        F.col("payload_digest"),
        F.when(is_response, F.lit("")).otherwise(
            F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: "), _id(F.col("refers_to")))
        ),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
        length.cast("string"),
        F.lit(END),
    )
    body = F.when(is_response, F.col("payload")).otherwise("")
    records.select(F.concat(head, http, body).alias("value")).write.option("lineSep", END).text(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at every magic by Spark's splittable text reader: (file, split, body), a split's in a row."""
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("body"))


_LENGTH = re.compile(rb"\r\nContent-Length: *([0-9]+)(?:\r\n|$)", re.I)
_END = END.encode()


def _extent(body: bytes) -> tuple[int, int] | None:
    """Length of the header behind a candidate's magic, and of its block; None where there is no record."""
    head = body.find(_END)
    found = _LENGTH.search(body, 0, head) if head >= 0 else None
    return (head, int(found[1])) if found else None


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[bytes]]]:
    """Each split's first row (without its body) and its bodies, one after the other; each must be read to its end."""

    def rows():
        for batch in batches:
            names = [n for n in batch.schema.names if n != "body"]
            for values in zip(batch.column("body"), *[batch.column(n).to_pylist() for n in names]):
                yield dict(zip(names, values[1:])), values[0].as_py()

    source = rows()
    ahead = next(source, None)
    while ahead is not None:
        row, key = ahead[0], (ahead[0]["file"], ahead[0]["split"])

        def bodies():
            nonlocal ahead
            while ahead is not None and (ahead[0]["file"], ahead[0]["split"]) == key:
                body = ahead[1]
                ahead = next(source, None)
                yield body

        yield row, bodies()


_LINKS = "file string, split long, at long, exit long, last long, total long"


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per candidate of a split: its place (from the split's first magic), where its chain leaves the split (null:
    it breaks) and the last record of the chain in the split; and one row with the split's bytes."""
    for row, bodies in _by_split(batches):
        place, jump, total = [], [], 0
        for i, body in enumerate(bodies):
            found = _extent(body) if i or row["split"] else None  # before a file's first magic there is nothing
            if found:
                place.append(total)
                jump.append(total + len(MAGIC) + sum(found) + 2 * len(END))
            total += len(MAGIC) + len(body)
        leaves, last = [None] * len(place), list(place)
        index = {p: i for i, p in enumerate(place)}
        for i in range(len(place) - 1, -1, -1):
            if jump[i] >= total:
                leaves[i] = jump[i]
            elif jump[i] in index:
                leaves[i], last[i] = leaves[index[jump[i]]], last[index[jump[i]]]
        n = len(place)
        cols = [[row["file"]] * (n + 1), [row["split"]] * (n + 1), [*place, None], [*leaves, None], [*last, None], [*[None] * n, total]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(cols)], names=["file", "split", "at", "exit", "last", "total"])


def chain(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Reachable starts (file, offset), from links (file, offset, next), by pointer jumping.

    A file's chain starts at offset 0. In each round every node's pointer jumps to its pointer's pointer, and a node
    reached marks what its pointer reaches; the rounds are the logarithm of the links of a file. Links to an offset
    that is no node end there.
    """
    ok = nodes.select("file", F.col("offset").alias("next"), F.lit(True).alias("_ok"))
    nodes = nodes.select("file", "offset", "next").join(ok, ["file", "next"], "left")
    nodes = nodes.select("file", "offset", F.when(F.col("_ok"), F.col("next")).alias("next"), (F.col("offset") == 0).alias("live"))
    nodes = scratch.stored(nodes, "chain")
    while not nodes.where("next is not null").isEmpty():
        marked = nodes.where("live and next is not null").select("file", F.col("next").alias("offset")).distinct().withColumn("_mark", F.lit(True))
        to = nodes.select("file", F.col("offset").alias("next"), F.col("next").alias("_next"))
        nodes = nodes.join(to, ["file", "next"], "left").join(marked, ["file", "offset"], "left")
        nodes = scratch.stored(nodes.select("file", "offset", F.col("_next").alias("next"), (F.col("live") | F.coalesce("_mark", F.lit(False))).alias("live")), "chain")
    return nodes.where("live").select("file", "offset")


def split_entries(segs: DataFrame, scratch: Scratch) -> DataFrame:
    """Per split (file, split): base (offset of its first magic), entry (its first record), carry (the record that
    reaches in from earlier splits) and goes_on (its own last record, where that reaches into a later split).

    Tasks emit candidate-to-successor links; chains are followed to a split's end where they are read. What other
    splits' chains lead to, and the starts of files, are the nodes that pointer jumping decides on.
    """
    links = scratch.stored(segs.mapInArrow(_links, _LINKS), "links")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = links.where("at is null").select("file", "split", "total", (F.coalesce(F.sum("total").over(before), F.lit(0)) - len(MAGIC)).alias("base"))
    splits = scratch.stored(splits, "splits")
    links = join_checked(links.where("at is not null").drop("total"), splits.drop("total"), ["file", "split"])
    links = links.select("file", "split", (F.col("base") + F.col("at")).alias("offset"), (F.col("base") + F.col("exit")).alias("next"), (F.col("base") + F.col("last")).alias("last"))
    targets = scratch.stored(links.where("next is not null").select("file", F.col("next").alias("offset")).distinct(), "targets")
    nodes = join_checked(links, targets.withColumn("_hit", F.lit(True)), ["file", "offset"], "left").where("offset = 0 or _hit").drop("_hit")
    nodes = scratch.stored(nodes, "nodes")
    live = nodes.join(chain(nodes, scratch), ["file", "offset"]).select("file", "split", F.col("offset").alias("entry"), "last")
    splits = splits.join(live, ["file", "split"], "left").withColumn("carry", F.max("last").over(before))
    splits = scratch.stored(splits, "entries")
    over = splits.where("carry is not null and (entry is null or entry > base)").select(F.col("file").alias("_file"), F.col("carry").alias("goes_on")).distinct()
    splits = splits.join(over, (F.col("file") == F.col("_file")) & (F.col("last") == F.col("goes_on")), "left")
    return scratch.stored(splits.select("file", "split", "base", "entry", "carry", "goes_on"), "spans")


_WHOLE = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("header", pa.string()), ("block", pa.binary())])
_PARTS = pa.schema([("file", pa.string()), ("record", pa.int64()), ("at", pa.int64()), ("raw", pa.binary())])
#: Records of a batch that a task hands over, and their bytes.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20


def _rows_of(row: dict, bodies: Iterator[bytes], whole: bool) -> Iterator[tuple]:
    at, record, expected, need, parts, size = row["base"], row["carry"], row["entry"], 0, [], 0
    spans = (None, row["carry"], row["goes_on"])  # no record yet, or one that reaches over a split's end
    for body in bodies:
        found = _extent(body) if at == expected else None
        if found:
            if whole and record not in spans:
                yield _record(row["file"], record, parts)
            record, parts, size = at, [], 0
            need = len(MAGIC) + sum(found) + len(END)
            expected = at + need + len(END)
        if record in spans:
            if not whole and record is not None:
                yield row["file"], record, at, MAGIC.encode() + body
        elif whole and size < need:  # what follows a broken chain is no part of a record
            parts.append(body)
            size += len(MAGIC) + len(body)
        at += len(MAGIC) + len(body)
    if whole and record not in spans:
        yield _record(row["file"], record, parts)


def _record(file: str, offset: int, parts: list[bytes]) -> tuple[str, int, str, bytes]:
    raw = MAGIC.encode() + MAGIC.encode().join(parts)
    head, length = _extent(parts[0])
    start = len(MAGIC) + head
    return file, offset, raw[:start].decode("utf-8", "replace"), raw[start + len(END) : start + len(END) + length]


def _assemble(whole: bool):
    """whole: (file, offset, header, block) of the records inside a split; else (file, record, at, raw), the segments of
    those that reach over its end."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _WHOLE if whole else _PARTS
        held, size = [], 0
        for row, bodies in _by_split(batches):
            for x in _rows_of(row, bodies, whole):
                held.append(x)
                size += len(x[3])
                if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), out)], schema=out)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), out)], schema=out)

    return assemble


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under path: file, offset, header, block (the record's bytes).

    Each segment that follows a magic is a candidate record; its Content-Length names its successor. Candidates not
    reachable from the start of their file (a magic inside a payload) are rejected and their bytes rejoin the record
    that holds them.
    """
    small_batches(spark, 200)
    scratch = Scratch(spark, "warc-links")
    segs = segments(spark, path)
    splits = split_entries(segs, scratch)
    scratch.keep(splits)

    def placed(splits: DataFrame) -> DataFrame:
        if fits(splits):
            return segs.join(F.broadcast(splits), ["file", "split"])
        rows = segs.withColumn("seq", F.monotonically_increasing_id()).join(splits, ["file", "split"])
        return rows.sortWithinPartitions("file", "split", "seq").drop("seq")

    records = placed(splits).mapInArrow(_assemble(True), "file string, offset long, header string, block binary")
    over = splits.where("goes_on is not null or carry is not null and (entry is null or entry > base)")
    if over.isEmpty():
        return records
    parts = placed(over).mapInArrow(_assemble(False), "file string, record long, at long, raw binary")
    joined = parts.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("at", "raw"))).alias("p"))  # the segments of one record
    joined = joined.select("file", F.col("record").alias("offset"), F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["raw"])).alias("raw"))
    end = F.instr(F.decode("raw", "ISO-8859-1"), END)
    joined = joined.withColumn("_head", F.substring(F.col("raw"), F.lit(1), end - 1)).withColumn("header", F.col("_head").cast("string"))
    length = F.regexp_extract("header", r"(?i)\r\nContent-Length: *([0-9]+)", 1).cast("bigint")
    start = F.octet_length("_head") + len(END) + 1
    return records.unionByName(joined.select("file", "offset", "header", F.substring(F.col("raw"), start, length.cast("int")).alias("block")))


def page_records(records: DataFrame) -> DataFrame:
    """Per record of `write_archives`: page_id, url, record_type, refers_to, payload, its size and digest.

    Sizes and digests of responses are those of the bytes read; a revisit's digest is its header's, and its size
    is the Content-Length of its HTTP header.
    """
    field = lambda name: F.regexp_extract("header", rf"(?i)\r\n{name}: *([^\r\n]*)", 1)
    page = lambda name: F.expr(f"try_cast(regexp_extract({name}, ':page:(-?[0-9]+)>', 1) as bigint)")
    http = F.substring_index(F.decode("block", "ISO-8859-1"), END, 1)
    rows = records.select(field("WARC-Type").alias("record_type"), field("WARC-Record-ID").alias("_rid"), field("WARC-Refers-To").alias("_ref"), field("WARC-Target-URI").alias("url"), field("WARC-Payload-Digest").alias("_digest"), http.alias("_http"), "block")
    payload = F.substring(F.col("block"), F.length("_http") + len(END) + 1, F.octet_length("block"))
    rows = rows.withColumn("payload", payload)
    is_response = F.col("record_type") == "response"
    told = F.regexp_extract("_http", r"(?i)\r\nContent-Length: *([0-9]+)", 1).cast("bigint")
    return rows.select(
        page("_rid").alias("page_id"),
        F.nullif(F.replace(F.replace("url", F.lit(ESCAPE + "2E"), F.lit(MAGIC)), F.lit(ESCAPE + "25"), F.lit(ESCAPE)), F.lit("")).alias("url"),
        F.when(is_response, F.octet_length("payload").cast("long")).otherwise(told).alias("payload_bytes"),
        F.when(is_response, base32_sha1(F.col("payload"))).otherwise(F.substring("_digest", 6, 32)).alias("payload_digest"),
        "record_type",
        page("_ref").alias("refers_to"),
        "payload",
    )


def round_trip(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Write pages to archives under path and read them back, one row per page.

    Nulls: a null html is an empty payload; a null page_id or url is read back as null. Repeated pages have a record
    each; of equal rows one is the response. Payloads may hold the magic, blank lines or look like whole records.
    Other columns are ignored; an empty table gives an empty result.
    """
    write_archives(plan_records(pages, min_bytes), path)
    return page_records(read_archives(pages.sparkSession, path))

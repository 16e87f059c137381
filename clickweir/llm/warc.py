"""WARC archives: writing, and reading with boundary-chain verification.

An archive is written by Spark's text writer: records end in CRLF CRLF, so that is its
line separator. It is read back by the text reader with a separator that occurs before
every record but the first of a file, and that cannot overlap itself. Files are split
among tasks, and a running sum of lengths gives every piece its offset.

A separator inside a payload starts a false candidate, which may even be a whole record.
Each candidate emits the offset at which its header says the next record starts. Pointer
jumping from offset 0 of every file doubles the reached distance each round; candidates
that are never reached are payload, and are joined to the record that holds them.

Payloads stay in the task that reads them. Only offsets are shuffled, and the pieces of
records that were cut by a false candidate. These are read a second time and known again
by the digest of their bytes, so neither scan depends on how the other was split.

Defined results: a null payload is written as an empty one; equal payloads of at least
``min_bytes`` are stored once, with the largest key, and others refer to it; a null url
is left out, and line ends in one are percent-encoded. A row without a key is a response
of its own; of rows that repeat a key each is a record. Other columns are not archived. A file that ends in the middle of a
record keeps its whole records. An empty table gives an archive without files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweir.llm.scratch import Scratch
from clickweir.workspace import materialized

RECORD_END = "\r\n\r\n"
MAGIC = "WARC/1.0"
# No beginning of it equals an end of it, so occurrences never overlap.
SEPARATOR = f"\n\r\n{MAGIC}\r"
_BEFORE_MAGIC = 3
RECORDS_PER_FILE = 20_000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, made from 8 groups of 20 bits."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * g + 1, 5), 16, 32), 4, "0") for g in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write_archive(df: DataFrame, path: str, key: str = "page_id", url: str = "url",
                  payload: str = "html", min_bytes: int = 0, scratch: Scratch | None = None,
                  date: str = "1970-01-01T00:00:00Z") -> None:
    """Write an uncompressed record per row under ``path``."""
    own = scratch or Scratch(df.sparkSession, "warc-write")
    pages = df.select(
        F.col(key).alias("key"), F.col(url).alias("url"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload")).withColumn(
        "digest", base32_sha1(F.col("payload")))
    digests = own.keep(pages.select(
        "key", "digest", F.octet_length("payload").alias("size")), "warc-digests")
    # Per digest one row; only digests that occur more than once refer to anything.
    holders = digests.where(F.col("size") >= min_bytes).groupBy("digest").agg(
        F.max("key").alias("holder"), F.count(F.lit(1)).alias("copies")
    ).where("copies > 1").drop("copies")
    # A row per key and digest, so that rows that repeat both stay as many as they are.
    revisits = own.keep(digests.join(holders, "digest").where("key <> holder").select(
        "key", "digest", "holder").distinct(), "warc-revisits")
    if revisits.isEmpty():
        found = pages.withColumn("holder", F.lit(None).cast("string"))
    else:
        found = pages.join(revisits, ["key", "digest"], "left")
    size = F.octet_length("payload")
    is_revisit = F.col("holder").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        size, F.lit("\r\n\r\n"))
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    address = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"),
                        F.lit("%0A"))
    record = F.concat(
        F.lit(f"{MAGIC}\r\n"),
        F.when(is_revisit, F.lit("WARC-Type: revisit\r\n")).otherwise("WARC-Type: response\r\n"),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(
            F.col("key").cast("string"), F.lit("")), F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        F.coalesce(_line("WARC-Target-URI", address), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(is_revisit, F.concat(
            _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("holder"), F.lit(">"))),
            _line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(""),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        _line("Content-Length", F.octet_length("block")), F.lit("\r\n"), F.col("block"))
    (found.withColumn("block", block).select(record.alias("value"))
     .write.option("maxRecordsPerFile", RECORDS_PER_FILE)
     .text(path, lineSep=RECORD_END))
    if scratch is None:
        own.close()


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between separators, with file, split and a rising number."""
    return spark.read.text(path, lineSep=SEPARATOR).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("n"), F.col("value").cast("binary").alias("data"))


def _located(pieces: DataFrame) -> DataFrame:
    """Pieces with the offset of their record start; ``length`` must be there.

    The sum runs inside a split, which the reader bounds; splits are then summed.
    """
    inside = Window.partitionBy("file", "split").orderBy("n").rowsBetween(
        Window.unboundedPreceding, -1)
    per_split = pieces.groupBy("file", "split").agg(
        F.sum("length").alias("split_length"), F.min("n").alias("first_n"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_split.withColumn(
        "split_start", F.coalesce(F.sum("split_length").over(before), F.lit(0)))
    return pieces.withColumn(
        "in_split", F.coalesce(F.sum("length").over(inside), F.lit(0))
    ).join(starts.select("file", "split", "split_start"), ["file", "split"]).withColumn(
        "start", F.col("split_start") + F.col("in_split")
    ).withColumn("at", F.when(F.col("start") == 0, 0).otherwise(
        F.col("start") - len(SEPARATOR) + _BEFORE_MAGIC)).drop("in_split", "split_start")


def reachable(candidates: DataFrame, scratch: Scratch) -> DataFrame:
    """(file, at) of the candidates on the chain from offset 0 of their file.

    ``candidates`` has file, at and ``successor`` (null if the header names none).
    Each round a reached candidate marks the one that its pointer names, and pointers
    are replaced by their pointer's pointer.
    """
    state = scratch.keep(candidates.select(
        "file", "at", F.col("successor").alias("pointer"), (F.col("at") == 0).alias("reached")),
        "warc-chain")
    while not state.where("reached AND pointer IS NOT NULL").isEmpty():
        marked = state.where("reached AND pointer IS NOT NULL").select(
            "file", F.col("pointer").alias("at"), F.lit(True).alias("marked"))
        onward = state.select("file", F.col("at").alias("pointer"),
                              F.col("pointer").alias("next"))
        state = scratch.keep(
            state.join(marked, ["file", "at"], "left").join(onward, ["file", "pointer"], "left")
            .select("file", "at", F.col("next").alias("pointer"),
                    (F.col("reached") | F.coalesce("marked", F.lit(False))).alias("reached")),
            "warc-chain")
    return state.where("reached").select("file", "at")


def _between(data: Column, start: Column, length: Column) -> Column:
    return F.substring(data, start, length)


def _header_value(header: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(header, rf"(?i)\n{name}: *([^\r\n]*)", 1), F.lit(""))


def _parsed(pieces: DataFrame) -> DataFrame:
    """Header fields, the block's place in the piece and the length the file spends on it."""
    text = F.col("data").cast("string")
    # In front of the first piece of a file nothing was cut off.
    named = pieces.withColumn("is_first", F.substring(text, 1, len(MAGIC)) == MAGIC)
    header_at = F.when(F.col("is_first"), len(MAGIC) + 2).otherwise(1)
    header = F.substring_index(text, RECORD_END, 1)
    size = F.octet_length("header")
    parsed = named.withColumn("header", F.when(
        F.contains(text, F.lit(RECORD_END)), F.concat(F.lit("\n"), header)))
    content = F.regexp_extract("header", r"(?i)\nContent-Length: *([0-9]{1,15})\r?(?:\n|$)", 1)
    return parsed.withColumns({
        "block_start": size - 1 + len(RECORD_END) + 1,
        "block_length": F.nullif(content, F.lit("")).cast("long"),
        "length": (F.octet_length("data") + len(SEPARATOR)).cast("long"),
        # Magic and line end before the piece, as far as they are not part of it.
        "lead": F.when(F.col("is_first"), 0).otherwise(len(MAGIC) + 1),
    }).drop("is_first")


def _payload_columns(block: Column) -> dict[str, Column]:
    """Payload of a block that is an HTTP response: what follows its header."""
    head = F.octet_length(F.substring_index(block.cast("string"), RECORD_END, 1))
    payload = F.substring(block, head + len(RECORD_END) + 1, F.octet_length(block))
    return {"payload": payload}


def read_archive(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """A row per record: key, record_type, url, refers_to, bytes and digest of the stored
    payload, the header's digest, file and offset."""
    pieces = _parsed(_pieces(spark, path))
    whole = (F.col("block_start") - 1 + F.col("block_length") <= F.octet_length("data"))
    block = F.substring("data", F.col("block_start").cast("int"), F.least("block_length", F.lit(2**31 - 1)).cast("int"))
    narrow = pieces.withColumn("block", F.when(whole, block)).select(
        "file", "split", "n", "length", "lead", "block_start", "block_length", "header",
        F.when(whole, F.octet_length(_payload_columns(F.col("block"))["payload"])).alias("bytes"),
        F.when(whole, base32_sha1(_payload_columns(F.col("block"))["payload"])).alias("digest"),
        whole.alias("whole"), F.sha1("data").alias("content"))
    # Numbers of one scan never meet those of another: it is written before it is used twice.
    scanned = scratch.keep(narrow, "warc-scan")
    located = scratch.keep(_located(scanned).withColumn(
        "successor", F.col("at") + F.col("lead") + F.col("block_start") - 1
        + F.col("block_length") + len(RECORD_END)).drop("split", "n"), "warc-pieces")
    scratch.drop(scanned)
    chain = reachable(located.select("file", "at", "successor"), scratch)
    records = located.join(chain, ["file", "at"])
    cut = records.where("block_length IS NOT NULL AND NOT coalesce(whole, false)").select(
        "file", F.col("at").alias("record_at"), "successor", "lead", "block_start", "block_length")
    cut = scratch.keep(cut, "warc-cut")
    if not cut.isEmpty():
        joined = _rejoined(spark, path, located, cut)
        records = records.join(joined, ["file", "at"], "left").where(
            "whole OR joined_digest IS NOT NULL").withColumns({
                "bytes": F.coalesce("bytes", "joined_bytes"),
                "digest": F.coalesce("digest", "joined_digest")})
    header = F.col("header")
    identifier = r"(?i)\n{}: *<urn:page:([^>\r\n]*)>"
    return records.where(F.col("bytes").isNotNull()).select(
        F.nullif(F.regexp_extract(header, identifier.format("WARC-Record-ID"), 1),
                 F.lit("")).alias("key"),
        _header_value(header, "WARC-Type").alias("record_type"),
        _header_value(header, "WARC-Target-URI").alias("url"),
        F.nullif(F.regexp_extract(header, identifier.format("WARC-Refers-To"), 1),
                 F.lit("")).alias("refers_to"),
        F.col("bytes").cast("long").alias("stored_bytes"), F.col("digest").alias("stored_digest"),
        F.regexp_replace(_header_value(header, "WARC-Payload-Digest"), "^sha1:", "").alias(
            "header_digest"),
        "file", "at")


def _rejoined(spark: SparkSession, path: str, located: DataFrame, cut: DataFrame) -> DataFrame:
    """Payload bytes and digest of records that false candidates cut into pieces.

    Of the archive only the pieces inside such records are read again, one of each content;
    they are put together in the order of their offsets. A record bounds what one row gathers.
    """
    owners = Window.partitionBy("file").orderBy("at", F.col("record_at").isNull())
    marks = located.select("file", "at", "content").join(
        cut.select("file").distinct(), "file", "left_semi")
    owned = marks.join(
        cut.select("file", F.col("record_at").alias("at"), "record_at", "successor"),
        ["file", "at"], "left"
    ).withColumns({
        "record_at": F.last("record_at", True).over(owners),
        "until": F.last("successor", True).over(owners),
    }).where("record_at IS NOT NULL AND at < until").select("file", "at", "content", "record_at")
    wanted = owned.select("content").distinct()
    data = _pieces(spark, path).select(F.sha1("data").alias("content"), "data").join(
        wanted, "content", "left_semi").dropDuplicates(["content"])
    gathered = owned.join(data, "content").groupBy("file", "record_at").agg(
        F.sort_array(F.collect_list(F.struct("at", "data"))).alias("parts"))
    whole = F.aggregate(
        F.slice("parts", 2, F.size("parts")), F.get("parts", 0)["data"],
        lambda total, part: F.concat(total, F.lit(SEPARATOR).cast("binary"), part["data"]))
    block = F.substring("data", F.col("block_start").cast("int"), F.least("block_length", F.lit(2**31 - 1)).cast("int"))
    return gathered.withColumn("data", whole).join(cut, ["file", "record_at"]).where(
        F.octet_length("data") >= F.col("block_start") - 1 + F.col("block_length")
    ).withColumn("block", block).withColumns(_payload_columns(F.col("block"))).select(
        "file", F.col("record_at").alias("at"),
        F.octet_length("payload").alias("joined_bytes"),
        base32_sha1(F.col("payload")).alias("joined_digest"))


def resolved(records: DataFrame) -> DataFrame:
    """Records with payload_bytes and payload_digest of the full payload.

    A response's are those of its stored bytes, a revisit's those of the response that
    it refers to.
    """
    by = ["refers_to", "header_digest"]
    responses = records.where("record_type = 'response'").select(
        F.col("key").alias("refers_to"), F.col("stored_digest").alias("header_digest"),
        F.col("stored_bytes").alias("full_bytes"), F.col("stored_digest").alias("full_digest"))
    visited = records.where("record_type = 'revisit'").select(*by).distinct()
    full = responses.join(visited, by, "left_semi").dropDuplicates(by)
    revisit = F.col("record_type") == "revisit"
    return records.join(full, by, "left").withColumns({
        "payload_bytes": F.when(revisit, F.col("full_bytes")).otherwise(F.col("stored_bytes")),
        "payload_digest": F.when(revisit, F.col("full_digest")).otherwise(F.col("stored_digest")),
    }).drop("full_bytes", "full_digest")


def round_trip(df: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
               min_bytes: int = 0) -> DataFrame:
    """Write an archive of ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    scratch = Scratch(spark, "warc")
    path = scratch.folder("archive")
    write_archive(df, path, key, url, payload, min_bytes, scratch)
    found = materialized(resolved(read_archive(spark, path, scratch)), "warc-records")
    scratch.close()
    return found

"""WARC archives of pages: written and read back as Spark jobs.

Writing is one text sink whose line end is the blank line pair that closes a record, so archives
come under Spark's commit protocol. Reading cuts the files at every occurrence of the magic, also
inside payloads, and keeps those cuts only that are records: each cut with a header gives a candidate
(its offset and the offset of its successor), and pointer jumping from the start of each file, where
the known stretch of the chain doubles every round, finds the candidates that are reached. Magic
inside a payload is never reached, and its pieces go back into their record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortloom.llm.stored import quoted, stored

MAGIC = "WARC/1.1\r\n"
BLANK = "\r\n\r\n"
LEAST_REVISIT = 100  # bytes; smaller payloads are always written
RECORDS_PER_FILE = 4096
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + BLANK


def revisits(pages: DataFrame) -> DataFrame:
    """``digest`` and smallest ``page_id`` of payloads that occur more than once. Copies are folded
    before the shuffle."""
    return stored(pages.where(F.col("payload_bytes") >= LEAST_REVISIT).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("rows")
    ).where("rows > 1 and first_id is not null").select("digest", "first_id"), "first-pages")


def write_archives(pages: DataFrame, folder: str, *, page_id: str = "page_id", url: str = "url", html: str = "html",
                   date: str = "2026-01-01T00:00:00Z", compression: str = "gzip") -> None:
    """One record per row. Of equal payloads of at least ``LEAST_REVISIT`` bytes, the rows with the
    smallest ``page_id`` are responses (each of them, if such a row is repeated), the others revisits
    without payload. A null html is an empty payload; a null url leaves its field out; rows without
    ``page_id`` are responses unless an equal page has an id. Other columns are not read. An empty
    table writes no record. Files hold at most ``RECORDS_PER_FILE`` records.
    """
    plain = pages.select(
        quoted(page_id).cast("long").alias("page_id"), quoted(url).cast("string").alias("url"),
        F.coalesce(quoted(html).cast("string"), F.lit("")).alias("payload"),
    ).withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    known = revisits(plain).withColumnRenamed("digest", "known_digest")
    first = F.col("first_id")
    again = first.isNotNull() & F.coalesce(F.col("page_id") != first, F.lit(True))
    block = F.concat(F.lit(_HTTP), F.when(again, F.lit("")).otherwise(F.col("payload")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda value: F.concat(F.lit("<urn:page:"), F.coalesce(value.cast("string"), F.lit("")), F.lit(">"))
    record = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("page_id"))), line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20]", "")), F.lit("")),
        F.when(again, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", urn(first)))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("Payload-Length", F.col("payload_bytes").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)
    plain.join(known, F.col("digest") == F.col("known_digest"), "left").select(record.alias("value")).write.option(
        "lineSep", BLANK).option("compression", compression).option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def _field(name: str, pattern: str) -> Column:
    found = F.regexp_extract("head", rf"(?i)(?:^|\r\n){name}:[ \t]*({pattern})", 1)
    return F.when(found != "", found)


def cuts(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of the files between occurrences of the magic, with what their header says. Stored, as
    the place of a piece in its split is only known while the file is read."""
    size = F.octet_length("value").cast("long")
    pieces = spark.read.option("lineSep", MAGIC).text(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"), size.alias("size"), "value",
        F.when(F.instr("value", BLANK) > 0, F.substring_index("value", BLANK, 1)).alias("head"))
    return stored(pieces.select(
        "file", "split", "place", "size", "value", "head", (F.octet_length("head") + 4).cast("long").alias("head_bytes"),
        _field("Content-Length", "[0-9]{1,15}").cast("long").alias("content_bytes")), "pieces")


def offsets(pieces: DataFrame) -> DataFrame:
    """Narrow rows with the ``offset`` of the magic in front of each piece (negative: none).

    Running sums within a split of the file, plus the sizes of the splits before it, so no task
    holds more than a split's rows or a file's splits.
    """
    narrow = pieces.select("file", "split", "place", (F.col("size") + len(MAGIC)).alias("step"), "head_bytes", "content_bytes")
    splits = narrow.groupBy("file", "split").agg(F.sum("step").alias("whole"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "split", F.coalesce(F.sum("whole").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("file", "split").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return narrow.withColumn("at", F.coalesce(F.sum("step").over(within), F.lit(0))).join(starts, ["file", "split"]).select(
        "file", "split", "place", (F.col("start") + F.col("at") - len(MAGIC)).alias("offset"),
        (F.col("start") + F.col("at") + F.col("head_bytes") + F.col("content_bytes") + len(BLANK)).alias("successor"))


def reached(candidates: DataFrame) -> DataFrame:
    """``file``, ``offset`` of the candidates on the chain from the start of their file.

    ``jump`` leads 1, 2, 4, ... records on; each round doubles the known stretch. Rounds grow with
    the logarithm of a file's records, and each is stored.
    """
    jump = stored(candidates.select("file", "offset", F.col("successor").alias("to")), "jumps")
    known = candidates.where("offset = 0").select("file", "offset")
    count = -1
    while True:
        known = stored(known.join(jump, ["file", "offset"]).select("file", F.col("to").alias("offset"))
                       .unionByName(known).distinct(), "reached")
        now = known.count()
        if now == count:
            break
        count = now
        onward = jump.select("file", F.col("offset").alias("to"), F.col("to").alias("further"))
        jump = stored(jump.join(onward, ["file", "to"]).select("file", "offset", F.col("further").alias("to")), "jumps")
    return candidates.join(known, ["file", "offset"], "left_semi").select("file", "offset", "successor")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all archives in ``folder``: ``file``, ``record_type``, ``page_id``, ``url``,
    ``refers_to``, ``payload`` (null for revisits), ``payload_bytes``, ``payload_digest`` and ``intact``
    (the payload has the digest that its header names).

    A broken header ends the chain of its file: what follows it is not reached.
    """
    pieces = cuts(spark, folder)
    placed = stored(offsets(pieces), "offsets")
    chain = stored(reached(placed.where("offset >= 0 and successor is not null")), "chain")

    marked = placed.select("file", "split", "place", "offset").join(
        chain.select("file", "offset", F.col("offset").alias("record")), ["file", "offset"], "left")
    last = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = marked.groupBy("file", "split").agg(F.max("record").alias("record")).select(
        "file", "split", F.max("record").over(last).alias("carried"))
    so_far = Window.partitionBy("file", "split").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    owned = stored(marked.withColumn("own", F.max("record").over(so_far)).join(carried, ["file", "split"]).select(
        "file", "split", "place", "offset", F.coalesce("own", "carried").alias("record")
    ).join(chain.select("file", F.col("offset").alias("record"), "successor"), ["file", "record"])
        .where("offset < successor"), "owned")
    torn = stored(owned.groupBy("file", "record").agg(F.count("*").alias("n")).where("n > 1").select("file", "record"), "torn")

    # Nearly every piece is one record. Only the others are named and joined, so payloads are not shuffled.
    at = ["file", "split", "place"]
    of_torn = stored(owned.join(torn, ["file", "record"], "left_semi").select(*at, "offset", "record"), "torn-pieces")
    alone = owned.where("offset = record").select(*at).join(of_torn.select(*at), at, "left_anti")
    odd = stored(placed.select(*at).join(alone, at, "left_anti"), "odd-pieces")
    records = pieces.join(odd, at, "left_anti").select("file", "head", "head_bytes", "content_bytes", "value")
    if not torn.isEmpty():  # the pieces of a record are as large as the record
        parts = F.sort_array(F.collect_list(F.struct("offset", "value")))
        first = lambda name: F.max(F.when(F.col("offset") == F.col("record"), F.col(name))).alias(name)
        records = records.unionByName(pieces.join(of_torn, at).groupBy("file", "record").agg(
            first("head"), first("head_bytes"), first("content_bytes"),
            F.array_join(F.transform(parts, lambda p: p["value"]), MAGIC).alias("value")).drop("record"))
    block = F.expr("substring(cast(value as binary), cast(head_bytes + 1 as int), cast(content_bytes as int))")
    body = F.expr("substring(block, cast(locate('\\r\\n\\r\\n', cast(block as string)) + 4 as int))")
    fields = records.withColumn("block", block).select(
        "file", _field("WARC-Type", "[a-z]+").alias("record_type"),
        _field("WARC-Record-ID", "<urn:page:-?[0-9]+>").alias("id"), _field("WARC-Target-URI", r"[^\r\n]+").alias("url"),
        _field("WARC-Refers-To", "<urn:page:-?[0-9]+>").alias("to"),
        _field("WARC-Payload-Digest", "sha256:[0-9a-f]+").alias("named"),
        _field("Payload-Length", "[0-9]+").cast("long").alias("length"), body.alias("payload"))
    number = lambda name: F.regexp_extract(name, "-?[0-9]+", 0).cast("long")
    again = F.col("record_type") == "revisit"
    digest = F.when(again, F.substring("named", 8, 64)).otherwise(F.sha2("payload", 256))
    return fields.select(
        "file", "record_type", number("id").alias("page_id"), "url", number("to").alias("refers_to"),
        F.when(~again, F.col("payload")).alias("payload"),
        F.when(again, F.col("length")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        digest.alias("payload_digest"),
        (digest == F.substring("named", 8, 64)).alias("intact"))


ORACLE = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CAST(CASE WHEN first_id IS NULL OR page_id = first_id THEN NULL ELSE first_id END AS BIGINT) AS refers_to
FROM f
"""

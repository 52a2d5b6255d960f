"""WARC archives: writing them, and reading them back with boundary-chain verification.

A record is header, block, and two line ends. Spark's text writer with that terminator as line separator gives
archives of any number of records, one file a task. Spark's text reader with line end and magic as separator cuts
archives, also in the middle of a file, into pieces: each begins with what may be a record, or with magic that is part
of a payload. Only the chain tells them apart:

1. Every piece is parsed where it is read and gives a candidate edge, from its offset to that of its successor: its own
   plus header, stated length and terminator. Texts do not move; sizes become offsets by running sums per block of
   a file and over its blocks.
2. Neighbours whose edge leads to the next piece are contracted to runs, block by block. Pointer jumping over the
   runs from the start of each file doubles its reach in every round; what it does not reach is no record.
3. Pieces that are whole records are taken from a second read as they pass by. Payloads that contain the separator are
   put together from their pieces. Pieces are recognised by file, hash and size, so nothing depends on how the second
   read splits its files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydroflow.llm.common import text_or_empty
from hydroflow.session import stored

LINE, GAP, MAGIC = "\r\n", "\r\n\r\n", "WARC/1."
#: Pieces are cut here. No header has it inside, and it cannot overlap itself, which Hadoop's line reader relies on
#: where a split ends within a separator.
SEPARATOR = "\n" + MAGIC
#: Payloads from this size on are written once; the others of the same content revisit it.
REVISIT_BYTES = 1000
WRITTEN = "2024-01-01T00:00:00Z"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _digests(pages: DataFrame, page_id: str, payload: str) -> DataFrame:
    body = text_or_empty(payload).cast("binary")
    return pages.select(F.col(page_id).alias("page"), F.sha1(body).alias("digest"), F.octet_length(body).alias("size"))


def write_warc(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = REVISIT_BYTES,
    date: str = WRITTEN,
) -> None:
    """One record per row. Of equal payloads of ``least`` bytes or more the largest page id is the response, the others
    are revisits of it; smaller payloads are all responses.

    A NULL payload is empty; a NULL url has no target line, line ends in a url become blanks. A NULL id is smaller
    than any other and written as an empty one. Rows that repeat the id of the response are responses too. Which
    payloads repeat is settled before by digest; that table decides by its size whether it is broadcast, and
    payloads are not shuffled unless it is large. No rows give an empty archive.
    """
    repeated = (
        _digests(pages, page_id, payload)
        .filter(F.col("size") >= least)
        .groupBy("digest", "size")
        .agg(F.max("page").alias("keep"), F.count(F.lit(1)).alias("times"))
    )
    repeated = stored(repeated.filter("times > 1").select("digest", "size", "keep"), "repeated-payloads")
    body = text_or_empty(payload)
    rows = pages.select(
        F.col(page_id).alias("page"),
        F.regexp_replace(url, "[\r\n]", " ").alias("uri"),
        body.alias("body"),
        F.sha1(body.cast("binary")).alias("digest"),
        F.octet_length(body).alias("size"),
    ).join(repeated, ["digest", "size"], "left")
    revisit = F.col("keep").isNotNull() & ~F.col("page").eqNullSafe(F.col("keep"))

    def record_id(page: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("")), F.lit(">"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)

    block = F.concat(F.lit(HTTP_HEAD), F.when(revisit, "").otherwise(F.col("body")))
    head = F.concat_ws(
        LINE,
        F.lit(f"{MAGIC}0"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id("page")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, line("WARC-Refers-To", record_id("keep"))),
        F.when(revisit, line("WARC-Profile", F.lit(PROFILE))),
        F.lit("Content-Type: application/http; msgtype=response"),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    rows.select(F.concat(head, F.lit(GAP), block).alias("value")).write.option("lineSep", GAP).text(path)


def _field(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, f"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", SEPARATOR).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("raw"),
        F.xxhash64("value").alias("hash"),
        F.octet_length("value").cast("long").alias("size"),
    )


def _candidates(pieces: DataFrame) -> DataFrame:
    head = F.substring_index("raw", GAP, 1)
    return pieces.select(
        "file",
        "block",
        "seq",
        "hash",
        "size",
        F.col("raw").rlike(r"\A[01]\r\n").alias("version_follows"),
        F.col("raw").rlike(r"\AWARC/1\.[01]\r\n").alias("starts_with_magic"),
        F.when(F.instr("raw", GAP) > 0, F.octet_length(head) + len(GAP)).alias("head_bytes"),
        _field(head, "Content-Length").try_cast("long").alias("block_bytes"),
    )


def _with_offsets(candidates: DataFrame) -> DataFrame:
    """Where each piece's text starts in its file, its offset as a record, and that of its successor."""
    in_block = Window.partitionBy("file", "block").orderBy("seq")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    step = F.col("size") + len(SEPARATOR)
    blocks = candidates.groupBy("file", "block").agg(F.sum(step).alias("block_size"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select("file", "block", F.coalesce(F.sum("block_size").over(earlier), F.lit(0)).alias("base"))
    placed = candidates.withColumn("within", F.coalesce(F.sum(step).over(before), F.lit(0))).join(bases, ["file", "block"])
    text_at = F.col("base") + F.col("within")
    first = text_at == 0
    valid = F.when(first, F.col("starts_with_magic")).otherwise(F.col("version_follows"))
    valid = valid & F.col("head_bytes").isNotNull() & F.col("block_bytes").isNotNull()
    needed = F.col("head_bytes") + F.col("block_bytes")
    return placed.select(
        "file",
        "block",
        "seq",
        "hash",
        "size",
        text_at.alias("text_at"),
        F.when(first, F.lit(0).cast("long")).otherwise(text_at - len(MAGIC)).alias("offset"),
        F.coalesce(valid, F.lit(False)).alias("valid"),
        F.when(valid, text_at + needed + len(GAP)).alias("next"),
        F.coalesce(valid & (needed <= F.col("size")), F.lit(False)).alias("whole"),
        # The last line end of a record is the first byte of the separator.
        F.coalesce(valid & (needed + len(GAP) - 1 == F.col("size")), F.lit(False)).alias("to_neighbour"),
    )


def _with_runs(placed: DataFrame) -> DataFrame:
    """Number the runs of pieces that lead to their neighbour, within each block."""
    order = Window.partitionBy("file", "block").orderBy("seq")
    starts = ~F.coalesce(F.lag("to_neighbour").over(order), F.lit(False))
    return placed.withColumn("starts", starts.cast("int")).withColumn("run", F.sum("starts").over(order)).drop("starts")


def _reached(pieces: DataFrame) -> DataFrame:
    """Runs that the chain from the file start enters, with the offset where it enters: pointer jumping."""
    run = ["file", "block", "run"]
    ends = pieces.groupBy(*run).agg(F.max_by("next", "seq").alias("exit"))
    target = pieces.select(
        F.col("file").alias("to_file"), F.col("offset").alias("entry"), F.col("block").alias("to_block"), F.col("run").alias("to_run")
    )
    jumps = stored(
        ends.join(target, (F.col("file") == F.col("to_file")) & (F.col("exit") == F.col("entry"))).select(
            *run, "to_block", "to_run", "entry"
        ),
        "jumps",
    )
    reached = pieces.filter("offset = 0").select(*run, F.col("offset").alias("entry"))
    most = jumps.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    span = 1
    while span <= most:
        hop = jumps.select(
            *[F.col(c).alias(f"from_{c}") for c in run],
            F.col("to_block").alias("next_block"),
            F.col("to_run").alias("next_run"),
            F.col("entry").alias("next_entry"),
        )

        def meets(block: str, number: str) -> Column:
            return (F.col("file") == F.col("from_file")) & (F.col(block) == F.col("from_block")) & (F.col(number) == F.col("from_run"))

        onward = reached.join(hop, meets("block", "run")).select(
            "file", F.col("next_block").alias("block"), F.col("next_run").alias("run"), F.col("next_entry").alias("entry")
        )
        reached = stored(reached.unionByName(onward), "reached")
        if span * 2 <= most:
            jumps = stored(
                jumps.join(hop, meets("to_block", "to_run")).select(
                    *run, F.col("next_block").alias("to_block"), F.col("next_run").alias("to_run"), F.col("next_entry").alias("entry")
                ),
                "jumps",
            )
        span *= 2
    return reached


def _verified(candidates: DataFrame) -> DataFrame:
    """Every piece with ``record`` (the chain reaches it and it is one) and ``owner``, the offset of the last record
    that starts at or before it."""
    pieces = stored(_with_runs(_with_offsets(candidates)), "pieces")
    entered = _reached(pieces)
    marked = pieces.join(entered, ["file", "block", "run"], "left").withColumn(
        "record", F.coalesce(F.col("valid") & (F.col("offset") >= F.col("entry")), F.lit(False))
    )
    here = F.max(F.when(F.col("record"), F.col("offset"))).over(Window.partitionBy("file", "block").orderBy("seq"))
    marked = marked.withColumn("here", here)
    last = marked.groupBy("file", "block").agg(F.max("here").alias("last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("file", "block", F.max("last").over(earlier).alias("carried"))
    return stored(
        marked.join(carried, ["file", "block"]).select(
            "file", "hash", "size", "text_at", "offset", "record", "whole", F.coalesce("here", "carried").alias("owner")
        ),
        "verified",
    )


def _records(raw: DataFrame) -> DataFrame:
    """Header fields and payload of whole record texts."""
    head = F.substring_index("raw", GAP, 1)
    block = F.substring(
        F.col("raw").cast("binary"), F.octet_length(head) + len(GAP) + 1, _field(head, "Content-Length").cast("int")
    )
    parsed = raw.select("file", head.alias("head"), block.alias("block"))
    text = F.col("block").cast("string")
    http = F.when(F.substring(text, 1, 5) == "HTTP/", F.octet_length(F.substring_index(text, GAP, 1)) + len(GAP)).otherwise(0)
    return parsed.select(
        "file",
        F.lower(_field(F.col("head"), "WARC-Type")).alias("record_type"),
        _field(F.col("head"), "WARC-Record-ID").alias("record_id"),
        _field(F.col("head"), "WARC-Target-URI").alias("target_uri"),
        _field(F.col("head"), "WARC-Refers-To").alias("refers_to"),
        _field(F.col("head"), "WARC-Payload-Digest").alias("stated_digest"),
        F.substring(F.col("block"), http + 1, F.octet_length("block")).alias("payload"),
    )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The verified records: file, record_type, record_id, target_uri, refers_to, stated_digest, payload.

    A chain ends where its next record is missing or unreadable; what lies behind that in the file is not reached and
    not returned. A record cut off by the end of its file has the payload that is there. An HTTP head at the start
    of a block is not part of the payload. Empty archives give no rows.
    """
    pieces = _pieces(spark, path)
    key = ["file", "hash", "size"]
    checked = _verified(_candidates(pieces))
    simple = F.col("record") & F.col("whole")
    # Contents of which some piece is no whole record; few, unless payloads are archives themselves.
    odd = stored(
        checked.groupBy(*key).agg(F.sum(simple.cast("long")).alias("times"), F.count(F.lit(1)).alias("all")).filter("times < all").select(*key, "times"),
        "odd-pieces",
    )
    raw = pieces.select(*key, "raw")
    records = raw.join(odd.select(*key), key, "left_anti").select("file", "raw")
    if not odd.isEmpty():
        odd_raw = stored(raw.join(odd.select(*key), key, "left_semi").dropDuplicates(key), "odd-texts")
        again = odd_raw.join(odd.filter("times > 0"), key).select(
            "file", "raw", F.explode(F.sequence(F.lit(1).cast("long"), "times"))
        )
        owners = checked.filter("record and not whole").select("file", F.col("offset").alias("owner"))
        parts = checked.filter(~simple).join(owners, ["file", "owner"]).join(odd_raw, key)
        own = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("text_at", "raw"))), lambda p: p["raw"]), SEPARATOR)
        joined = parts.groupBy("file", "owner").agg(own.alias("raw"))
        records = records.unionByName(again.select("file", "raw")).unionByName(joined.select("file", "raw"))
    return _records(records)

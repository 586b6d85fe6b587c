"""WARC archives: writing pages, and reading records by their verified boundary chain.

Reading cuts files at the version line, over many tasks per file. Each cut is a candidate
record: it may also be text inside a payload. A candidate names its successor, the offset
after its header, block and final line ends. Only candidates reachable from the start of
the file are records. Where a candidate's successor is the next candidate, they belong to
one run; runs are joined by pointer jumping, in as many rounds as the logarithm of the
most runs of a file, which is none for a file whose payloads hold no version line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tagloom.llm.shared import Scratch

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
#: Rows of a table of repeated payloads, of about 60 bytes, up to which it is broadcast.
MOST_BROADCAST_ROWS = 100_000
#: C0 and C1 controls (the next-line character among them), and the separators of lines and paragraphs.
CONTROLS = r"[\x00-\x1F\x7F-\x9F\u2028\u2029]"
BASE32_DIGITS = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def digest(payload: Column) -> Column:
    """SHA-1 as 32 base-32 digits: four times 40 bits, each as eight digits of five bits."""
    raw = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(raw, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.upper(F.concat(*parts)), *BASE32_DIGITS)


def printable(text: Column) -> Column:
    """The text with control characters and line ends of any kind percent-encoded."""
    each = F.transform(F.split(text, ""), lambda c: F.when(c.rlike(CONTROLS), F.regexp_replace(F.hex(F.encode(c, "utf-8")), "(..)", "%$1")).otherwise(c))
    return F.when(text.rlike(CONTROLS), F.array_join(each, "")).otherwise(text)


def first_copies(pages: DataFrame) -> DataFrame:
    """(digest, response) of each payload that several rows have: the largest page_id."""
    return (
        pages.groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
        .filter("n > 1").drop("n")
    )


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", scratch: Scratch | None = None
) -> None:
    """WARC files at `path`, a record for each row of `pages` (page_id, url, html), a file for each task.

    Of rows with equal payloads of at least `min_bytes` bytes, that of the largest page_id is a
    response, and so are rows that repeat that id; the others are revisits of it, without
    payload. A null html is an empty payload. Controls and line ends of any kind in urls are percent-encoded; a page
    without url is named by its id. A row without page_id gets an empty id.
    """
    spark = pages.sparkSession
    scratch = scratch or Scratch(spark)
    html = F.coalesce(F.col("html"), F.lit(""))
    payload = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).alias("size"), digest(html).alias("digest"))
    repeated = scratch.keep(first_copies(payload.filter(F.col("size") >= min_bytes).select("page_id", "digest")))
    if repeated.count() <= MOST_BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    rows = payload.join(repeated, "digest", "left")
    known = F.col("size") >= min_bytes
    revisit = F.coalesce(known & F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response")), F.lit(False))
    name = lambda c: F.concat(F.lit("<urn:pages:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    url = printable(F.coalesce("url", F.lit("")))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit(END)
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    lines = [
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name("page_id")),
        F.concat(F.lit("WARC-Target-URI: "), F.when(url == "", F.concat(F.lit("urn:pages:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))).otherwise(url)),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name("response"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block")),
    ]
    record = F.concat(F.lit(MAGIC), F.concat_ws("\r\n", *lines), F.lit(END), F.col("block"), F.lit("\r\n"))
    rows.withColumn("block", block).select(record.alias("value")).write.option("lineSep", "\r\n").text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text between version lines, with the file, the split and the order it came in."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("piece"),
    )


def _field(header: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(header, rf"(?imd)^{name}:[ \t]*(.*?)[ \t]*\r?$", 1), F.lit(""))


def _record(piece: Column) -> dict[str, Column]:
    """What the header of a candidate says; nulls where there is no header."""
    header = F.when(F.instr(piece, END) > 0, F.substring_index(piece, END, 1))
    length = F.try_to_number(F.regexp_extract(_field(header, "Content-Length"), r"^\d{1,15}$", 0), F.lit("999999999999999"))
    return {"head_bytes": (F.octet_length(header) + len(END)).cast("bigint"), "block_bytes": length.cast("bigint"), "header": header}


def _payload(block: Column) -> Column:
    """The body of an HTTP message, as bytes."""
    head = F.substring_index(block.cast("string"), END, 1)
    return F.substring(block, F.octet_length(head) + len(END) + 1, F.octet_length(block))


def _fields(frame: DataFrame) -> DataFrame:
    """Fields of the output from header and block; the block may be null, then the digest is."""
    header, block = F.col("header"), F.col("block")
    http = F.substring_index(block.cast("string"), END, 1)
    number = lambda c: F.try_to_number(F.regexp_extract(c, r"^\d{1,15}$", 0), F.lit("999999999999999")).cast("bigint")
    revisit = _field(header, "WARC-Type") == "revisit"
    id_of = lambda name: F.regexp_extract(_field(header, name), r"<urn:pages:(-?\d{1,19})>", 1).try_cast("bigint")
    payload = _payload(block)
    return frame.withColumns(
        {
            "page_id": id_of("WARC-Record-ID"),
            "record_type": _field(header, "WARC-Type"),
            "refers_to": id_of("WARC-Refers-To"),
            "payload_bytes": F.when(revisit, number(_field(http, "Content-Length"))).otherwise(F.octet_length(payload).cast("bigint")),
            "payload_digest": F.when(block.isNull(), None).when(revisit, F.regexp_extract(_field(header, "WARC-Payload-Digest"), "^sha1:(.*)$", 1)).otherwise(digest(payload)),
        }
    ).drop("header", "block")


RECORD = ("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest")


def candidates(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """(file, offset, succ, run, *RECORD) of every candidate; `payload_digest` is null if more pieces belong to it."""
    size = F.octet_length("piece").cast("bigint")
    scan = _pieces(spark, path)
    known = scan.select("*", *[c.alias(n) for n, c in _record(F.col("piece")).items()])
    inside = F.col("head_bytes") + F.col("block_bytes")
    block = F.when(size >= inside, F.substring(F.col("piece").cast("binary"), (F.col("head_bytes") + 1).cast("int"), F.col("block_bytes").cast("int")))
    light = scratch.keep(
        _fields(known.select("file", "file_size", "split", "at", (size + len(MAGIC)).alias("bytes"), inside.alias("inside"), "header", block.alias("block")))
    )
    return _placed(light).select("file", "file_size", "offset", "succ", "run", *RECORD)


def _placed(light: DataFrame) -> DataFrame:
    """Offsets in the file from the order within splits, and runs of candidates that follow each other."""
    plain = F.coalesce(F.col("inside") + len(END) == F.col("bytes") - len(MAGIC), F.lit(False))
    light = light.withColumn("cut", (~plain).cast("bigint"))
    splits = light.groupBy("file", "split").agg(F.sum("bytes").alias("b"), F.sum("cut").alias("c"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        "file", "split", F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("base"), F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("cuts")
    )
    within = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.col("_b"), F.lit(0)) - len(MAGIC)
    return (
        light.withColumns({"_b": F.sum("bytes").over(within), "_c": F.sum("cut").over(within)})
        .join(splits, ["file", "split"])
        .withColumns({"offset": start, "run": F.col("cuts") + F.coalesce(F.col("_c"), F.lit(0))})
        .withColumn("succ", F.col("offset") + len(MAGIC) + F.col("inside") + len(END))
        .filter("offset >= 0")
    )


def reachable(found: DataFrame, scratch: Scratch) -> DataFrame:
    """The candidates that a chain from the start of their file reaches."""
    runs = scratch.keep(
        found.groupBy("file", "run").agg(F.min("offset").alias("first"), F.max_by("succ", "offset").alias("exit"))
    )
    most = runs.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    start = runs.filter("first = 0").select("file", "run", F.lit(0).cast("bigint").alias("entry"))
    if most <= 1:
        entered = start
    else:
        ends = runs.select("file", F.col("run").alias("from"), F.col("exit").alias("offset"))
        jump = scratch.keep(
            ends.join(found.select("file", "offset", "run"), ["file", "offset"]).select("file", "from", "run", F.col("offset").alias("entry"))
        )
        entered, length = scratch.keep(start), 1
        while length < most:
            onward = entered.select("file", F.col("run").alias("from")).join(jump, ["file", "from"]).select("file", "run", "entry")
            entered = scratch.keep(entered.unionAll(onward).groupBy("file", "run").agg(F.min("entry").alias("entry")))
            step = jump.select("file", F.col("from").alias("run"), F.col("run").alias("run2"), F.col("entry").alias("entry2"))
            jump = scratch.keep(jump.join(step, ["file", "run"]).select("file", "from", F.col("run2").alias("run"), F.col("entry2").alias("entry")))
            length *= 2
    return found.join(entered, ["file", "run"]).filter(F.col("offset") >= F.col("entry")).drop("entry", "run")


def read_archives(spark: SparkSession, path: str, scratch: Scratch | None = None, strict: bool = False) -> DataFrame:
    """(file, offset, page_id, record_type, refers_to, payload_bytes, payload_digest) of every record.

    Digest and length are those of the payload as read; a revisit has none and tells those
    of the record it refers to. Version lines inside payloads start no records. A damaged
    file gives the records before the damage; `chain_ends` tells where chains end. If `strict`, a
    file whose chain does not end with the file is an error.
    """
    scratch = scratch or Scratch(spark)
    found = candidates(spark, path, scratch)
    records = scratch.keep(reachable(found, scratch))
    if strict:
        whole = chain_ends(records).filter("complete").select("file")
        broken = found.select("file").distinct().join(whole, "file", "left_anti").limit(3).collect()
        if broken:
            raise ValueError(f"records do not reach the end of {', '.join(r['file'] for r in broken)}")
    split = records.filter("payload_digest IS NULL AND succ IS NOT NULL")
    out = ["file", "offset", *RECORD]
    if split.isEmpty():
        return records.select(*out)
    return records.filter("payload_digest IS NOT NULL OR succ IS NULL").select(*out).unionByName(_joined(spark, path, found, split).select(*out))


def _joined(spark: SparkSession, path: str, found: DataFrame, split: DataFrame) -> DataFrame:
    """Records whose payload holds version lines, put together from their pieces in a second scan."""
    owners = split.select(F.col("file").alias("_file"), F.col("offset").alias("owner"), "succ")
    size = F.octet_length("piece").cast("bigint")
    scan = _pieces(spark, path).join(split.select("file").distinct(), "file", "left_semi")
    placed = _placed(
        scan.select("file", "split", "at", "piece", (size + len(MAGIC)).alias("bytes"), F.lit(None).cast("bigint").alias("inside"))
    ).select("file", "offset", "piece")
    inside = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    owned = (
        found.select("file", "offset").join(owners, (F.col("offset") == F.col("owner")) & (F.col("file") == F.col("_file")), "left")
        .withColumns({c: F.last(c, True).over(inside) for c in ("owner", "succ")})
        .filter(F.col("offset") < F.col("succ")).select("file", "offset", "owner")
    )
    parts = placed.join(owned, ["file", "offset"])
    whole = parts.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("offset", "piece"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["piece"]), MAGIC)
    whole = whole.select("file", F.col("owner").alias("offset"), text.alias("piece"))
    known = whole.select("*", *[c.alias(n) for n, c in _record(F.col("piece")).items()])
    block = F.substring(F.col("piece").cast("binary"), (F.col("head_bytes") + 1).cast("int"), F.col("block_bytes").cast("int"))
    return _fields(known.withColumn("block", block))


def chain_ends(records: DataFrame) -> DataFrame:
    """(file, file_size, end, complete): where the chain of each file ends. `records`: from `reachable`."""
    ends = records.groupBy("file", "file_size").agg(F.max("succ").alias("end"))
    return ends.withColumn("complete", F.col("end").eqNullSafe(F.col("file_size")))

"""Web archives: writing records of pages, and reading archives whose records are found in parallel.

Reading cuts every file at each place that looks like the begin of a record, in pieces of any size, so a
piece may also begin inside a payload that holds such text. Each piece gives a pointer from its offset to where
the record that it claims to be ends. Only the records that can be reached from a file's start along these
pointers are real; they are found by pointer jumping, whose rounds double the distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickline.llm.spans import discard
from wickline.session import settled

#: The first line of a record, the end of its header and the end of its block.
MAGIC, GAP = "WARC/1.1\r\n", "\r\n\r\n"
#: Payloads below this many bytes are stored again rather than referred to.
LEAST_SHARED = 100
#: Digests that repeat are broadcast up to this many (about 100 MB), else joined by a shuffle.
MOST_BROADCAST = 500_000


def _header(fields: list[tuple[str, Column]], length: Column) -> Column:
    """Header lines; a field that is null is left out."""
    lines = [F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))) for name, value in fields]
    present = [F.coalesce(line, F.lit("")) for line in lines]
    return F.concat(F.lit(MAGIC), *present, F.lit("Content-Length: "), length.cast("string"), F.lit(GAP))


def archive_records(pages: DataFrame) -> DataFrame:
    """One text per page: its record, without the gap after it.

    A page whose payload has 100 bytes or more and also belongs to a smaller page_id is a revisit of the smallest;
    its record has no payload. Null html is an empty payload. A null page_id is never referred to, and its record
    has no target field for it. Line breaks in a url become spaces. Repeated rows of one page_id each get the
    same record.
    """
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.regexp_replace("url", r"[\r\n]", " ").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"), F.octet_length(body).cast("long").alias("bytes"), F.sha2(body, 256).alias("digest"))
    shared = settled(
        pages.where(F.col("bytes") >= LEAST_SHARED).groupBy("digest").agg(
            F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null").select("digest", "first"), "digests")
    shared = F.broadcast(shared) if shared.count() <= MOST_BROADCAST else shared
    found = pages.join(shared, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    kind = F.when(again, "revisit").otherwise("response")
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    header = _header([
        ("WARC-Type", kind), ("WARC-Record-ID", urn(F.col("page_id"))), ("WARC-Target-URI", F.col("url")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Payload-Length", F.col("bytes").cast("string")),
        ("WARC-Refers-To", F.when(again, urn(F.col("first"))))], F.when(again, 0).otherwise(F.col("bytes")))
    return found.select(F.concat(header, F.when(again, "").otherwise(F.col("html"))).alias("value"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Archives of all pages below ``path``, one file per task. The gap that ends a record ends Spark's line."""
    archive_records(pages).write.option("lineSep", GAP).text(path)


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between two magics, in file order within a block of a file (``place``)."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("place"), "value",
        F.octet_length("value").cast("long").alias("bytes"))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every place that looks like a record: file, offset, next (where the record would end) and its fields.

    Pieces between two places that hold the magic are Spark's lines. A piece's offset is the bytes before it
    in its block of the file and the bytes of the blocks before that.
    """
    line = _pieces(spark, path).withColumn("header", F.substring_index("value", GAP, 1))
    thin = line.select(
        "file", "block", "size", "place", "bytes", F.octet_length("header").cast("long").alias("head"),
        _number(_field("Content-Length")).alias("length"),
        "value", _field("WARC-Type").alias("type"), _field("WARC-Record-ID").alias("id"), _field("WARC-Refers-To").alias("refers"),
        _field("WARC-Payload-Digest").alias("named_digest"), _field("WARC-Payload-Length").alias("named_length"))
    payload = F.expr("substring(cast(value as binary), cast(head + 5 as int), cast(coalesce(length, 0) as int))")
    thin = thin.withColumn("payload", payload).withColumn("digest", F.sha2("payload", 256)).withColumn(
        "held", F.octet_length("payload").cast("long")).drop("payload", "value")
    blocks = thin.groupBy("file", "block").agg(F.sum(F.col("bytes") + len(MAGIC)).alias("all"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("before"))
    return _with_offsets(thin.join(blocks, ["file", "block"])).where("offset >= 0").withColumn(
        "next", F.when(F.col("length") >= 0, F.col("offset") + len(MAGIC) + F.col("head") + 2 * len(GAP) + F.col("length")))


def _number(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit("")).try_cast("long")


def _with_offsets(pieces: DataFrame) -> DataFrame:
    """``offset`` of each piece's magic; ``before`` is what lies before the piece's block in the file."""
    so_far = F.sum(F.col("bytes") + len(MAGIC)).over(Window.partitionBy("file", "block").orderBy("place"))
    return pieces.withColumn("offset", F.col("before") + so_far - F.col("bytes") - 2 * len(MAGIC))


def reachable(pointers: DataFrame) -> DataFrame:
    """(file, offset) of the records on each file's chain from offset 0, by pointer jumping.

    Round k holds the pointers over 2^k records and adds, for everything reached, what lies that far on. Each
    round is a table; a round halves the pointers that still have somewhere to go.
    """
    jump = settled(pointers.where("next > offset").select("file", "offset", "next"), "jump")
    reached = settled(pointers.where("offset = 0").select("file", "offset").distinct(), "reached")
    while True:
        # Pointers that end at a candidate; the others end at a file's end or at nothing.
        target = jump.select("file", F.col("offset").alias("next"), F.col("next").alias("beyond"))
        far = settled(reached.join(jump, ["file", "offset"]).select("file", F.col("next").alias("offset")).union(reached).distinct(), "reached")
        further = settled(jump.join(target, ["file", "next"]).select("file", "offset", F.col("beyond").alias("next")), "jump")
        discard(jump.sparkSession, reached, jump)
        reached, jump = far, further
        if jump.isEmpty():
            discard(jump.sparkSession, jump)
            return reached


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every real record below ``path``: page_id, payload_bytes, payload_digest, record_type, refers_to, file, offset.

    Length and digest of a response come from the bytes that are read, also where its payload holds the magic and
    lies in several pieces; those of a revisit are the ones it names. Raises ValueError where a file's chain does
    not end at the file's end. Archives without a record give an empty result.
    """
    found = settled(candidates(spark, path), "candidates")
    real = settled(found.join(reachable(found.select("file", "offset", "next")), ["file", "offset"]), "records")
    broken = real.groupBy("file", "size").agg(F.max(F.coalesce("next", F.lit(-1))).alias("end"), F.min(F.coalesce("next", F.lit(-1))).alias("low")).where(
        "end <> size or low < 0").limit(3).collect()
    files = found.select("file").distinct().count()
    if broken or files != real.select("file").distinct().count():
        raise ValueError(f"no chain of records from begin to end in {[r.file for r in broken] or 'some file'}")
    parts = real.where(F.col("held") < F.col("length"))
    if not parts.isEmpty():
        whole = settled(_whole_payloads(spark, path, parts, found), "payloads")
        real = real.join(whole, ["file", "offset"], "left").withColumn(
            "digest", F.coalesce("whole_digest", "digest")).withColumn("held", F.coalesce("whole_held", "held"))
    discard(spark, found)
    again = F.col("type") == "revisit"
    page = lambda c: _number(F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1))
    return real.select(
        page("id").alias("page_id"),
        F.when(again, _number(F.col("named_length"))).otherwise(F.col("held")).alias("payload_bytes"),
        F.when(again, F.regexp_replace("named_digest", "^sha256:", "")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), F.when(again, page("refers")).alias("refers_to"), "file", "offset")


def _whole_payloads(spark: SparkSession, path: str, parts: DataFrame, found: DataFrame) -> DataFrame:
    """Payloads that hold the magic: their pieces put together again, digest and length.

    Only the blocks that hold such pieces are read again. A piece belongs to the record whose span holds it;
    spans are cut into cells of 64 KB, which makes that a join by equality.
    """
    grid = 1 << 16
    cell = F.floor(F.col("offset") / grid).alias("cell")
    spans = parts.select(
        "file", F.col("offset").alias("record"), "next", "head", "length",
        F.explode(F.sequence(F.floor(F.col("offset") / grid), F.floor((F.col("next") - 1) / grid))).alias("cell"))
    held = found.select("file", "block", "before", "offset", cell).join(spans, ["file", "cell"]).where("offset >= record and offset < next")
    blocks = held.select("file", "block", "before").distinct()
    pieces = _with_offsets(_pieces(spark, path).join(blocks, ["file", "block"]))
    inside = pieces.select("file", "offset", F.concat(F.lit(MAGIC).cast("binary"), F.col("value").cast("binary")).alias("b"), cell)
    whole = inside.join(spans, ["file", "cell"]).where("offset >= record and offset < next").groupBy(
        "file", "record", "head", "length").agg(F.array_sort(F.collect_list(F.struct("offset", "b"))).alias("p")).select(
        "file", F.col("record").alias("offset"), "length", "head",
        F.aggregate("p", F.lit("").cast("binary"), lambda a, x: F.concat(a, x["b"])).alias("b"))
    body = F.expr(f"substring(b, cast({len(MAGIC) + len(GAP)} + head + 1 as int), cast(length as int))")
    return whole.select("file", "offset", F.sha2(body, 256).alias("whole_digest"), F.octet_length(body).cast("long").alias("whole_held"))

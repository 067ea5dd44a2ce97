"""A content-addressed WARC archive.

Two tables in a folder: `payloads` has every distinct payload once under its SHA-256, with the header block of the response that is
its first record; `headers` has the exact header block of every record with that digest. The original record is the header block, the
payload found by digest, and two line ends. First records are read as they stand, so that payloads are shuffled once, when they are
filled, and not again when they are read.
Equal digests are verified: length and SHA-1 of all payloads under one SHA-256 must agree, and reading checks the stored
bytes against their digest.

A record has the four mandatory fields. Its id is a URI of the page_id, a part of a digest over the record's content and the
number of the copy, so that no two records share one. `WARC-Date` is a parameter, since pages carry no date and reruns must
agree. Of records with equal payloads, that of the largest page_id (among equal ones, of the largest url; of equal rows, the
first copy) is the response, the others are revisits that refer to it; payloads under `least` bytes are stored as responses
of their own. Rows are summed up by page_id, url and digest before they are shuffled; the table of payloads is filled by
page_id, which no group of copies makes uneven; the joins on digests are plain shuffle joins, whose hot side adaptive
execution splits.

Defined cases: null html is an empty payload; a null url leaves out the target header; line ends in a url are escaped;
null page_ids are smaller than any other; very long payloads are single values; columns but page_id, url and html do not come
along, so none can clash; no rows give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, repeated

END = "\r\n"
DATE = "1970-01-01T00:00:00Z"
#: RFC 4648 base32 letters, and the digits that conv() writes in base 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 40 hex digits are four groups of 40 bits, eight letters each."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def record_id(page_id: Column, url: Column, digest: Column, copy: Column) -> Column:
    """<urn:page:ID:content:copy>; ID is null for a null page_id."""
    content = F.substring(F.sha2(F.concat(digest, F.coalesce(F.concat(F.lit("u"), url), F.lit("n"))), 256), 1, 16)
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(":"), content, F.lit(":"), copy.cast("string"), F.lit(">"))


def records(pages: DataFrame, least: int = 0, date: str = DATE) -> DataFrame:
    """page_id, digest, owner (page_id of the payload's response), whether it is the first record of its payload, and the header block of every page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    seen = pages.select("page_id", "url", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"), base32_sha1(payload).alias("sha1"))
    seen = seen.groupBy(*seen.columns).agg(F.count("*").alias("copies"))
    owners = seen.groupBy("digest").agg(
        F.max(F.struct("page_id", "url")).alias("top"), F.max(F.struct("bytes", "sha1")).alias("high"), F.min(F.struct("bytes", "sha1")).alias("low"),
    ).withColumn("top", F.when(F.col("high") == F.col("low"), F.col("top")).otherwise(F.raise_error(F.lit("two payloads have one SHA-256"))))
    owners = materialise(owners.select("digest", F.col("top.page_id").alias("owner"), F.col("top.url").alias("owner_url")))  # a plain table: the hot side of the join can be split
    met = repeated(seen.join(owners, "digest"), "copies", "copy")
    first = F.col("page_id").eqNullSafe(F.col("owner")) & F.col("url").eqNullSafe(F.col("owner_url")) & (F.col("copy") == 1)
    again = (F.col("bytes") >= least) & ~first
    target = F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"))
    head = F.concat_ws(
        END, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"), F.col("url"), F.col("digest"), F.col("copy"))), F.lit(f"WARC-Date: {date}"), target,
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("owner"), F.col("owner_url"), F.col("digest"), F.lit(1)))),
        F.when(again, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: text/html; charset=utf-8"), F.concat(F.lit("Content-Length: "), F.when(again, F.lit(0)).otherwise(F.col("bytes")).cast("string")), F.lit(END),
    )
    return met.select("page_id", "digest", "owner", first.alias("first"), head.alias("header"))


def write_archive(pages: DataFrame, path: str, least: int = 0, date: str = DATE) -> None:
    """Writes headers and payloads of pages (page_id, url, html) below path."""
    spark = pages.sparkSession
    records(pages, least, date).write.parquet(f"{path}/headers")
    owned = spark.read.parquet(f"{path}/headers").where("first").select("digest", F.col("owner").alias("page_id"), "header")
    bytes_ = pages.select("page_id", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha2("payload", 256))
    same = F.col("a.page_id").eqNullSafe(F.col("b.page_id")) & (F.col("a.digest") == F.col("b.digest"))
    store = bytes_.alias("a").join(owned.alias("b"), same).select("a.digest", "b.header", "a.payload")
    many = spark.read.parquet(f"{path}/headers").where(F.col("page_id").eqNullSafe(F.col("owner"))).groupBy("digest").count().where("count > 1").select("digest")
    if many.isEmpty():  # no page_id stands twice with one payload
        store.write.parquet(f"{path}/payloads")
        return
    one = store.join(many, "digest", "left_anti")
    again = store.join(many, "digest", "left_semi").groupBy("digest").agg(F.first("header").alias("header"), F.first("payload").alias("payload"))
    one.unionByName(again).write.parquet(f"{path}/payloads")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """digest, header and payload of every first record; fails if a stored payload does not have its digest."""
    stored = spark.read.parquet(f"{path}/payloads")
    checked = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload does not have its digest")))
    return stored.select("digest", "header", checked.alias("payload"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record with its header and full payload; fails if a stored payload does not have its digest."""
    return spark.read.parquet(f"{path}/headers").select("digest", "header").join(_stored(spark, path).select("digest", "payload"), "digest").select("header", "payload")


def read_described(spark: SparkSession, path: str) -> DataFrame:
    """described() of every record of an archive. A revisit has length and digest of the payload of the first record under its digest,
    which is parsed once and whose payload does not move; other responses (of payloads under `least` bytes) meet their payloads."""
    own = described(rebuild(_stored(spark, path)))
    rest = spark.read.parquet(f"{path}/headers").where(~F.col("first")).select("digest", "header")
    revisit = F.col("header").contains(f"{END}WARC-Type: revisit{END}")
    small = rest.where(~revisit)
    of = own.select("digest", "payload_bytes", "payload_digest")
    again = rest.where(revisit).join(of, "digest")
    again = _told(_parsed(rebuild(again.withColumn("payload", F.lit(b"")), "payload_bytes", "payload_digest")), F.col("payload_bytes"), F.col("payload_digest"))
    told = own.drop("digest").unionByName(again)
    if small.isEmpty():  # nothing was stored under `least`, and payloads need not be dealt for it
        return told
    return told.unionByName(described(rebuild(small.join(_stored(spark, path).select("digest", "payload"), "digest"))).drop("digest"))


def rebuild(archive: DataFrame, *carry: str) -> DataFrame:
    """record, the bytes of the original records (header block, payload unless it is a revisit, two line ends), and payload; digest
    where the archive has it, and `carry`."""
    own = F.when(F.col("header").contains(f"{END}WARC-Type: revisit{END}"), F.lit(b"")).otherwise(F.col("payload"))
    return archive.select(F.concat(F.col("header").cast("binary"), own, F.lit(END * 2).cast("binary")).alias("record"), "payload", *(c for c in ("digest",) if c in archive.columns), *carry)


def _field(key: str, what: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{key}: {what}\r\n", 1)


def _parsed(rebuilt: DataFrame) -> DataFrame:
    """With header, the block up to the first empty line, type, and the place and length of the record's block."""
    header = F.concat(F.substring_index(F.col("record").cast("string"), END * 2, 1), F.lit(END))
    parsed = rebuilt.withColumn("header", header)
    return parsed.withColumns({"type": _field("WARC-Type", "([a-z]+)"), "start": F.octet_length("header") + len(END) + 1, "length": _field("Content-Length", "([0-9]+)").cast("int")})


def _told(parsed: DataFrame, size: Column, sha1: Column, *carry: str) -> DataFrame:
    """What records say, if it is so of payloads of that size and digest."""
    page = lambda key: _field(key, r"<urn:page:(-?[0-9]+|null):[0-9a-f]{16}:[0-9]+>").try_cast("bigint")
    sound = (sha1 == _field("WARC-Payload-Digest", "sha1:([A-Z2-7]+)")) & (F.octet_length("record") == F.col("start") - 1 + F.col("length") + 2 * len(END))
    return parsed.select(
        page("WARC-Record-ID").alias("page_id"), size.cast("long").alias("payload_bytes"),
        F.when(sound, sha1).otherwise(F.raise_error(F.lit("a record is not what its header says"))).alias("payload_digest"),
        F.col("type").alias("record_type"), page("WARC-Refers-To").alias("refers_to"), *carry,
    )


def described(rebuilt: DataFrame) -> DataFrame:
    """What records say of themselves, parsed from their bytes, and length and digest of the payloads.

    The header block ends at the first empty line; the block of a response, as long as its Content-Length, is its payload, and
    a record whose length or digest is not what its header says is an error. The payload of a revisit is that of the response
    it refers to, which the join on digests has found.
    """
    block = F.substring(F.col("record"), F.col("start"), F.col("length"))
    payload = F.when(F.col("type") == "response", block).otherwise(F.col("payload"))
    parsed = _parsed(rebuilt).withColumn("whole", payload).withColumn("sha1", base32_sha1(F.col("whole")))
    return _told(parsed, F.octet_length("whole"), F.col("sha1"), *(c for c in ("digest",) if c in rebuilt.columns))

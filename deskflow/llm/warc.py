"""Content-addressed web archive (operator 3).

An archive is two tables in one folder.  ``payloads`` holds the bytes of each different payload once, under their SHA-256.
``records`` holds the exact header of every record (its WARC lines, the empty line, and the HTTP lines of the answer) with
the digest of the payload.  A record is read back by joining the two; a payload whose digest is not its name is an
error.  A revisit record repeats no bytes: its header names the record that has them.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from deskflow.sources.stage import new_path

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: Column) -> Column:
    """SHA-1 of binary data in upper-case base32: four times 40 bits as eight digits."""
    digest = F.sha1(data)
    digits = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _name(page: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def _lines(*lines: Column) -> Column:
    return F.concat_ws("\r\n", *lines)


def _line(name: str, value: Column) -> Column:
    """A header line; none when the value is null.  Line ends in the value are percent-encoded."""
    return F.concat(F.lit(f"{name}: "), F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")))


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  least: int = 0, date: str = "2026-01-01T00:00:00Z") -> None:
    """Archive one record per row.

    Of records with equal payloads of at least ``least`` bytes, that with the largest id is a response and the others
    revisit it (rows that repeat that id are responses too); smaller ones are all responses.  Null html is an
    empty payload; a null url has no line; a null id is written as an empty name.
    """
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.encode(F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    digest = F.unhex(F.sha2("payload", 256))
    # Copies are united in each task before their bytes move.
    rows.groupBy(digest.alias("digest")).agg(F.first("payload").alias("payload")).write.option(
        "compression", "zstd").parquet(f"{folder}/payloads")

    small = rows.select("page", "url", digest.alias("digest"), base32_sha1(F.col("payload")).alias("sha1"),
                        F.octet_length("payload").cast("long").alias("n"))
    owner = small.where(F.col("n") >= least).groupBy("digest").agg(F.max("page").alias("owner"))
    known = small.join(owner, "digest", "left")
    revisit = F.col("owner").isNotNull() & ~F.col("page").eqNullSafe(F.col("owner"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n").cast("string"), F.lit("\r\n\r\n"))
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("n"))
    header = F.concat(_lines(
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _name(F.col("page"))), _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, _line("WARC-Profile", F.lit(PROFILE))), F.when(revisit, _line("WARC-Refers-To", _name(F.col("owner")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string"))), F.lit("\r\n\r\n"), http)
    known.select(F.encode(header, "UTF-8").alias("header"), "digest").write.option(
        "compression", "zstd").parquet(f"{folder}/records")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """(header, record, payload, digest) of every record, its bytes as they would stand in an archive file."""
    records = spark.read.parquet(f"{folder}/records")
    stored = spark.read.parquet(f"{folder}/payloads")
    verified = stored.select("digest", F.when(F.unhex(F.sha2("payload", 256)) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.lit("A payload of the archive is not what its digest says.")).cast("binary")).alias("payload"))
    is_revisit = F.decode("header", "UTF-8").startswith("WARC/1.1\r\nWARC-Type: revisit\r\n")
    # A record whose payload is missing is an error too, not a lost row.
    payload = F.coalesce("payload", F.raise_error(F.lit("A payload is missing from the archive.")).cast("binary"))
    return records.join(verified, "digest", "left").select(
        "header", F.concat("header", F.when(is_revisit, F.lit(b"")).otherwise(payload), F.lit(b"\r\n\r\n")).alias("record"),
        payload.alias("payload"), "digest")


def parsed(records: DataFrame) -> DataFrame:
    """(page, type, url, payload_digest, refers_to, payload) of records read back, from their headers."""
    head = F.split_part(F.decode("header", "UTF-8"), F.lit("\r\n\r\n"), F.lit(1))

    def field(name: str) -> Column:
        found = F.regexp_extract(head, rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
        return F.when(found != "", found)

    def page(name: str) -> Column:
        return F.regexp_extract(field(name), "^<urn:x-page:(-?[0-9]+)>$", 1).try_cast("long")

    return records.select(
        page("WARC-Record-ID").alias("page"), field("WARC-Type").alias("type"), field("WARC-Target-URI").alias("url"),
        F.replace(field("WARC-Payload-Digest"), F.lit("sha1:"), F.lit("")).alias("payload_digest"),
        page("WARC-Refers-To").alias("refers_to"), "payload")


def archive(pages: DataFrame, **names: str) -> DataFrame:
    """Write the pages into a new archive in the shared folder and read its records back."""
    spark = pages.sparkSession
    folder = new_path(spark, "archive")
    write_archive(pages, folder, **names)
    return parsed(read_archive(spark, folder))

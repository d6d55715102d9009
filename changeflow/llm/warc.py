"""WARC derivatives: each response gives a metadata record and a plain-text conversion record.

Both name the response they come from (WARC-Refers-To) and each other (the conversion is WARC-Concurrent-To's target of the
metadata); the metadata keeps the response's HTTP header fields, status, digests, title, language and links. Only column
expressions: a map over the responses without a shuffle.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

# The base-32 alphabet of digests, elements whose content is not text, elements that break lines, entities.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HIDDEN = ("head", "script", "style", "noscript", "template")
BREAKS = ("address article aside blockquote body br caption dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li "
          "main nav ol option p pre section table tbody td tfoot th thead title tr ul").split()
ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®", "middot": "·",
            "hellip": "…", "ndash": "–", "mdash": "—", "laquo": "«", "raquo": "»", "euro": "€"}

_HIDDEN = "(?is)<!--.*?(-->|\\z)" + "".join(f"|<{e}([ \\t\\r\\n/][^>]*)?>.*?(</{e}[^>]*>|\\z)" for e in HIDDEN)
_BREAK = f"(?i)</?({'|'.join(BREAKS)})([ \\t\\r\\n/][^>]*)?>"
_TAG = "<[a-zA-Z/!?][^>]*>"
_ENTITY = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z]{2,8});"
CRLF = "\r\n"

# The SQL states _HIDDEN, ENTITIES and _ENTITY, which suit pages with closed heads and few entities. For any page: head's tags may be
# left out, so only its elements without page text go, and all names of HTML that end in a semicolon are entities.
UNSEEN = ("title", *HIDDEN[1:])
_UNSEEN = "(?is)<!--.*?(-->|\\z)" + "".join(f"|<{e}([ \\t\\r\\n/][^>]*)?>.*?(</{e}[^>]*>|\\z)" for e in UNSEEN)
_NAMED = ENTITIES | {name[:-1]: char for name, char in html5.items() if name.endswith(";") and name[:-1] not in ENTITIES}
_ANY_ENTITY = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});"
_HREF = "(?is)<a[ \\t\\r\\n/](?:[^>]*?[ \\t\\r\\n\"'/])?href[ \\t\\r\\n]*=[ \\t\\r\\n]*(\"[^\"]*\"|'[^']*'|[^ \\t\\r\\n\"'>][^ \\t\\r\\n>]*)"


def base32_sha1(body: Column) -> Column:
    """``sha1:`` and the digest in base 32, as WARC digests are written; from groups of 20 bits."""
    digest = F.sha1(body.cast("binary"))
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for shift in (15, 10, 5, 0)]
    return F.concat(F.lit("sha1:"), *letters)


def urn(*parts: Column) -> Column:
    """A record id made from its parts, the same whenever the record is built again."""
    h = F.md5(F.concat_ws("\x00", *[F.coalesce(p, F.lit("")) for p in parts]))
    cuts = [F.substring(h, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _character(entity: Column) -> Column:
    """One entity as its character; unknown names stay, numbers that are no character become U+FFFD."""
    name = F.substring(entity, F.lit(2), F.length(entity) - 2)
    known = F.str_to_map(F.lit("\x02".join(f"{n}\x01{c}" for n, c in _NAMED.items())), F.lit("\x02"), F.lit("\x01"))
    hexadecimal = F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10)
    number = F.when(F.lower(F.substring(name, 2, 1)) == "x", hexadecimal).otherwise(F.substring(name, F.lit(2), F.length(name))).cast("int")
    bad = (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
    code = F.decode(F.unhex(F.lpad(F.hex(F.when(bad, 0xFFFD).otherwise(number)), 8, "0")), "UTF-32")
    return F.when(F.startswith(name, F.lit("#")), code).otherwise(F.coalesce(F.try_element_at(known, name), entity))


def decoded(text: Column) -> Column:
    """``text`` with its entities replaced once."""
    gaps, hits = F.split(text, _ANY_ENTITY, -1), F.regexp_extract_all(text, F.lit(_ANY_ENTITY), F.lit(0))
    whole = F.array_join(F.zip_with(gaps, hits, lambda g, h: F.concat(g, F.coalesce(_character(h), F.lit("")))), "")
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


def tidy(text: Column) -> Column:
    """Runs of blanks as one space, runs of line ends as one line feed, none at the ends."""
    text = F.regexp_replace(text, "[ \\t\\x0B\\f\\r ]+", " ")
    return F.regexp_replace(F.regexp_replace(text, " ?\\n[ \\n]*", "\n"), "^[ \\n]+|[ \\n]+\\z", "")


def _line(name: str, value: Column) -> Column:
    """A header field, or nothing if there is no value."""
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))).otherwise(F.lit(""))


def derivatives(responses: DataFrame) -> DataFrame:
    """Two records for each response (record_id, target_uri, date, http_header, payload; other columns are kept in ``source``).

    Gives ``source``, ``warc_type``, ``record_id``, ``refers_to``, ``header`` (WARC header fields), ``block`` and ``block_digest``.
    ``http_header`` is the status line and the header fields. A null payload is empty; null header values leave their
    field out. Record ids follow from the response's id, so responses given twice have equal derivatives. Entities are decoded
    once; text of unclosed hidden elements and comments is left out to the end. An empty table gives no records.
    """
    rows = responses.select(
        F.struct(*responses.columns).alias("source"), "record_id", "target_uri", "date", F.coalesce("http_header", F.lit("")).alias("http_header"),
        F.coalesce("payload", F.lit("")).alias("payload"))
    rows = rows.select("*", F.regexp_replace("payload", _UNSEEN, " ").alias("shown"))
    plain = F.regexp_replace(F.regexp_replace("shown", _BREAK, "\n"), _TAG, "")
    rows = rows.select("*", plain.alias("plain"))
    rows = rows.select("*", decoded(F.col("plain")).alias("read")).select("*", tidy(F.col("read")).alias("text"))
    title = F.regexp_extract("payload", "(?is)<title([ \\t\\r\\n/][^>]*)?>(.*?)</title", 2)
    language = F.regexp_extract("payload", "(?is)<html[^>]*[ \\t\\r\\n]lang=[\"']?([a-zA-Z-]+)", 1)
    quoted = lambda x: F.substring(x, 1, 1).isin('"', "'")
    links = F.transform(F.regexp_extract_all("shown", F.lit(_HREF), F.lit(1)), lambda x: F.when(quoted(x), F.substring(x, F.lit(2), F.length(x) - 2)).otherwise(x))
    rows = rows.select("*", title.alias("title"), language.alias("language"), links.alias("links"))
    block = F.concat("http_header", F.lit(CRLF + CRLF), "payload")
    rows = rows.select(
        "*", base32_sha1(F.col("payload")).alias("payload_digest"), base32_sha1(block).alias("source_digest"), base32_sha1(F.col("text")).alias("text_digest"),
        tidy(decoded(F.col("title"))).alias("name"), urn(F.lit("metadata"), F.col("record_id")).alias("metadata_id"), urn(F.lit("conversion"), F.col("record_id")).alias("conversion_id"))
    some = lambda c: F.when(F.length(c) > 0, F.regexp_replace(c, "[\\r\\n]+", " "))
    fields = F.concat(
        _line("title", some("name")), _line("language", some("language")), _line("source-block-digest", F.col("source_digest")),
        _line("source-payload-digest", F.col("payload_digest")), _line("conversion", F.col("conversion_id")), _line("conversion-digest", F.col("text_digest")),
        F.array_join(F.transform(F.filter(F.split("http_header", "\r?\n"), lambda x: F.length(x) > 0), lambda x: F.concat(F.lit("source-header: "), x, F.lit(CRLF))), ""),
        F.array_join(F.transform("links", lambda x: F.concat(F.lit("outlink: "), F.regexp_replace(x, "[\\r\\n]+", " "), F.lit(CRLF))), ""))
    rows = rows.select("*", fields.alias("fields"))
    records = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.col("metadata_id").alias("record_id"), F.lit("application/warc-fields").alias("content_type"), F.col("fields").alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.col("conversion_id").alias("record_id"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")))
    rows = rows.select("source", F.col("record_id").alias("refers_to"), "target_uri", "date", "payload_digest", "metadata_id", F.explode(records).alias("r"))
    rows = rows.select("source", "refers_to", "target_uri", "date", "payload_digest", "metadata_id", "r.*").withColumn("block_digest", base32_sha1(F.col("block")))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF), _line("WARC-Type", F.col("warc_type")), _line("WARC-Record-ID", F.col("record_id")), _line("WARC-Date", F.col("date")),
        _line("WARC-Refers-To", F.col("refers_to")), _line("WARC-Refers-To-Payload-Digest", F.col("payload_digest")),
        _line("WARC-Concurrent-To", F.when(F.col("warc_type") == "conversion", F.col("metadata_id"))), _line("WARC-Target-URI", F.col("target_uri")),
        _line("WARC-Block-Digest", F.col("block_digest")), _line("Content-Type", F.col("content_type")), _line("Content-Length", F.octet_length("block").cast("string")))
    return rows.select("source", "warc_type", "record_id", "refers_to", header.alias("header"), "block", "block_digest")


def serialised(records: DataFrame) -> DataFrame:
    """``records`` with ``record``, the bytes of a WARC file's record; files are records one after the other."""
    return records.withColumn("record", F.concat("header", F.lit(CRLF), "block", F.lit(CRLF + CRLF)).cast("binary"))


def page_responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of a table of pages (page_id, url, html): 200, with type and length as header fields."""
    body = F.coalesce("html", F.lit(""))
    header = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(body).cast("string"))
    return pages.select(
        "page_id", urn(F.lit("response"), F.col("page_id").cast("string"), F.col("url")).alias("record_id"), F.col("url").alias("target_uri"),
        F.lit(date).alias("date"), header.alias("http_header"), body.alias("payload"))

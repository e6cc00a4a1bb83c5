"""Web archives: pages to WARC records in files, and files back to one nested row per capture.

Every page becomes a transaction of three records: a request, a response or a revisit, and a
metadata record; request and metadata name the response in ``WARC-Concurrent-To``. Records are
written and read by Spark's text source, whose line separator is the end of a record,
so archives lie in any file system that Spark reaches. Plain files are read in parallel
ranges; gzip files, the default, by one task each.

A payload may hold the separator itself. Such a payload is sent in HTTP chunks that cut each
occurrence in two. A record that is shorter than its Content-Length is an error, never a short row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.plans.staging import join_staged, stage_table

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
# What Spark splits files at, and what the first record of a file begins with.
SEPARATOR = END + VERSION
REVISIT_FROM = 1000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _bytes(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def _identifier(kind: str, page: Column) -> Column:
    """A record id in the form of a UUID, made from what names the capture."""
    digest = F.md5(F.concat(F.lit(f"{kind}:"), page))
    parts = [F.substring(digest, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: Column, identifier: Column, url: Column, content: Column, block: Column, *more: Column) -> Column:
    """Header and block; ``more`` are whole header lines, of which nulls are left out."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    lines = [
        line("WARC-Type", kind),
        line("WARC-Record-ID", identifier),
        line("WARC-Date", F.lit("2000-01-01T00:00:00Z")),
        line("WARC-Target-URI", url),
        *more,
        line("Content-Type", content),
        line("Content-Length", _bytes(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def _in_chunks(payload: Column) -> Column:
    """The payload in HTTP chunks that end in the middle of every version line it holds."""
    cut = F.split(payload, r"(?<=WA)(?=RC/1\.1\r\n)")
    one = lambda part: F.concat(F.lower(F.hex(F.octet_length(part))), F.lit("\r\n"), part, F.lit("\r\n"))
    return F.concat(F.array_join(F.transform(cut, one), ""), F.lit("0" + END))


def deduplicated(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Pages (page_id, url, payload) with payload_bytes, payload_digest, occurrence, refers_to and refers_to_url.

    Equal rows are numbered from 0 by ``occurrence``. Of equal payloads of ``revisit_from`` bytes or more rows of the
    largest page_id are responses; the others refer to it, in the capture of its largest url. Equal digests and
    sizes count as equal payloads.
    """
    sized = pages.withColumns({"payload_bytes": _bytes(F.col("payload")), "payload_digest": F.sha1("payload")})
    # Payloads are not shuffled: what is shuffled are names of captures, reduced ahead of it.
    own = ["page_id", "url", "payload_digest", "payload_bytes"]
    captures = stage_table(sized.groupBy(*own).agg(F.count("*").alias("copies")), "captures")
    large = captures.where(F.col("payload_bytes") >= revisit_from)
    first = F.max(F.struct("page_id", "url"))
    groups = large.groupBy("payload_digest", "payload_bytes").agg(first.alias("first"), F.count("*").alias("n"))
    shared = groups.where((F.col("n") > 1) & F.col("first.page_id").isNotNull()).select(
        "payload_digest", "payload_bytes", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")
    )
    same_page = F.col("_page_id").eqNullSafe(F.col("page_id"))
    repeated = captures.where(F.col("copies") > 1).select(F.col("page_id").alias("_page_id"), *own[1:], "copies")
    repeated = stage_table(repeated, "repeated").withColumnsRenamed({c: f"_{c}" for c in own[1:]})
    for name in own[1:]:
        same_page &= F.col(f"_{name}") == F.col(name)
    once = sized.join(repeated, same_page, "left_anti").withColumn("occurrence", F.lit(0).cast("long"))
    # Repeated rows come together under their name, and go out as many times as they came in.
    several = sized.join(repeated, same_page).groupBy(*own).agg(F.first("payload").alias("payload"), F.max("copies").alias("copies"))
    several = several.withColumn("occurrence", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")
    joined = join_staged(once.unionByName(several), shared, ["payload_digest", "payload_bytes"], "left")
    other = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.withColumns({"refers_to": F.when(other, F.col("first_id")), "refers_to_url": F.when(other, F.col("first_url"))})


def records(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """(record): three WARC records for each row of pages (page_id, url, payload).

    A null page_id, url or payload is written as an empty text, and a null page_id reads back as
    null. Every row is a capture of its own, also where rows repeat.
    """
    filled = pages.select(
        F.col("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("payload", F.lit("")).alias("payload")
    )
    own = deduplicated(filled, revisit_from)
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    name = lambda page, occurrence, url: F.concat_ws(":", page, "payload_digest", occurrence, url)
    named = name(page, F.col("occurrence").cast("string"), F.col("url"))
    capture, url, payload = _identifier("capture", named), F.regexp_replace("url", r"[\r\n]", ""), F.col("payload")
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"))
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), capture)
    revisit = F.col("refers_to").isNotNull()
    refers = F.concat(F.lit("WARC-Refers-To: "), _identifier("capture", name(F.col("refers_to").cast("string"), F.lit("0"), F.col("refers_to_url"))))
    profile = F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}"))
    # The blank line ahead of a payload counts: it may begin as a record does.
    split_up = payload.contains(SEPARATOR) | F.concat(F.lit(END), F.substring(payload, 1, len(SEPARATOR))).contains(SEPARATOR)
    length = F.when(split_up, F.lit("Transfer-Encoding: chunked")).otherwise(
        F.concat(F.lit("Content-Length: "), F.col("payload_bytes").cast("string"))
    )
    # A revisit has the HTTP header of its capture, which tells the payload's size, and no payload.
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), length, F.lit(END))
    plain = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END),
    )
    body = F.when(split_up, _in_chunks(payload)).otherwise(payload)
    block = F.when(revisit, plain).otherwise(F.concat(http, body))
    asked = F.concat(F.lit("GET "), url, F.lit(" HTTP/1.1" + END))
    about = F.concat(F.lit("page-id: "), page, F.lit("\r\n"))
    return own.select(
        F.explode(
            F.array(
                _record(F.lit("request"), _identifier("request", named), url, F.lit("application/http; msgtype=request"), asked, concurrent),
                _record(
                    F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
                    capture, url, F.lit("application/http; msgtype=response"), block, digest, profile, refers,
                ),
                _record(F.lit("metadata"), _identifier("metadata", named), url, F.lit("application/warc-fields"), about, concurrent),
            )
        ).alias("record")
    )


def write_archives(pages: DataFrame, path: str, revisit_from: int = REVISIT_FROM, compression: str = "gzip") -> None:
    """Files of WARC records below ``path``, one or more for each task."""
    whole = records(pages, revisit_from).select(F.concat(F.lit(VERSION), F.col("record")).alias("value"))
    whole.write.option("lineSep", END).option("compression", compression).text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(fields, block) of every record below ``path``: header fields by lower-case name, the block's bytes.

    Repeated header fields are joined by a blank. A file is read in parallel ranges.
    """
    pieces = spark.read.option("lineSep", SEPARATOR).text(path).where(F.octet_length("value") > 0)
    # Only the header is text; the block is cut out by byte places.
    first = F.substring_index("value", END, 1)
    parted = pieces.select(F.col("value").cast("binary").alias("raw"), first.alias("first"))
    head = F.regexp_replace("first", r"^WARC/1\.[01]\r\n", "")
    skipped = F.octet_length("first") + len(END)
    lines = F.filter(F.split(head, "\r\n"), lambda line: F.instr(line, ":") > 0)
    pairs = F.transform(
        lines,
        lambda line: F.struct(
            F.lower(F.trim(F.substring_index(line, ":", 1))).alias("name"),
            F.trim(F.substring(line, F.instr(line, ":") + 1, F.length(line))).alias("value"),
        ),
    )
    fields = F.aggregate(
        pairs,
        F.create_map().cast("map<string,string>"),
        lambda known, pair: F.map_concat(
            F.map_filter(known, lambda name, _: name != pair["name"]),
            F.create_map(pair["name"], F.concat_ws(" ", F.element_at(known, pair["name"]), pair["value"])),
        ),
    )
    size = F.element_at("fields", "content-length").cast("int")
    parsed = parted.select("raw", fields.alias("fields"), skipped.alias("skipped"))
    complete = F.octet_length("raw") - F.col("skipped") >= size
    broken = F.raise_error(F.concat(F.lit("cut short: "), F.element_at("fields", "warc-record-id"))).cast("binary")
    block = F.when(complete, F.expr("substring(raw, skipped + 1, int(fields['content-length']))")).otherwise(broken)
    return parsed.select("fields", block.alias("block"))


def _payload(block: Column) -> Column:
    """The payload of an HTTP response as bytes; chunks are put together."""
    head = F.substring_index(block.cast("string"), END, 1)
    content = F.call_function("substring", block, F.octet_length(head) + len(END) + 1, F.octet_length(block))
    chunked = F.lower(head).contains("transfer-encoding: chunked")
    body = F.decode(content, "ISO-8859-1")  # one character for each byte, so places are byte places
    # (rest, what is put together so far); a chunk is its size in hexadecimal, a line end, bytes, a line end
    size = lambda rest: F.coalesce(F.conv(F.substring_index(rest, "\r\n", 1), 16, 10).cast("int"), F.lit(0))
    start = lambda rest: F.instr(rest, "\r\n") + 2
    # Every chunk has a line end, so there are no more chunks than lines; steps past the last one do nothing.
    steps = F.sequence(F.lit(1), F.size(F.split(body, "\r\n")))
    whole = F.aggregate(
        steps,
        F.struct(body.alias("rest"), F.lit("").alias("done")),
        lambda state, _: F.struct(
            F.substring(state["rest"], start(state["rest"]) + size(state["rest"]) + 2, F.length(state["rest"])).alias("rest"),
            F.concat(state["done"], F.substring(state["rest"], start(state["rest"]), size(state["rest"]))).alias("done"),
        ),
        lambda state: state["done"],
    )
    return F.when(chunked, F.encode(whole, "ISO-8859-1")).otherwise(content)


def transactions(found: DataFrame, with_payload: bool = True) -> DataFrame:
    """One nested row per capture: its response or revisit with the request and metadata concurrent to it.

    The key is the id of the response; requests and metadata come to it through
    ``WARC-Concurrent-To``. A request or metadata record without a response still makes
    a row, under the id it names. Payload size and digest are taken from the payload itself;
    a revisit has them from its own header fields. Without ``with_payload`` payloads are not shuffled.
    """
    field = lambda name: F.element_at("fields", name)
    kind = field("warc-type")
    found = found.withColumn("_content", F.when(kind == "response", _payload(F.col("block"))))
    content = F.col("_content")
    header = F.decode(F.substring("block", 1, 4096), "ISO-8859-1")
    told = F.regexp_extract(header, r"(?i)\r\ncontent-length: *([0-9]+)", 1).cast("long")
    response = kind == "response"
    flat = found.where(kind.isin("request", "response", "revisit", "metadata")).select(
        F.coalesce(F.when(~kind.isin("response", "revisit"), field("warc-concurrent-to")), field("warc-record-id")).alias("capture_id"),
        kind.alias("kind"),
        F.struct(
            field("warc-record-id").alias("record_id"),
            field("warc-target-uri").alias("url"),
            field("warc-date").alias("date"),
            F.when(kind.isin("request", "metadata"), F.decode("block", "UTF-8")).alias("text"),
            F.when(response, F.octet_length(content).cast("long")).when(kind == "revisit", told).alias("payload_bytes"),
            F.when(response, F.sha1(content)).otherwise(F.regexp_replace(field("warc-payload-digest"), "^sha1:", "")).alias("payload_digest"),
            field("warc-refers-to").alias("refers_to"),
            (F.when(response, content) if with_payload else F.lit(None).cast("binary")).alias("payload"),
        ).alias("record"),
    )
    pick = lambda *kinds: F.max_by("record", F.when(F.col("kind").isin(*kinds), F.col("record")["record_id"]))
    return flat.groupBy("capture_id").agg(
        F.max(F.when(F.col("kind").isin("response", "revisit"), F.col("kind"))).alias("record_type"),
        pick("response", "revisit").alias("response"),
        pick("request").alias("request"),
        pick("metadata").alias("metadata"),
    )


def page_of(metadata: Column) -> Column:
    return F.regexp_extract(metadata["text"], r"page-id: ([^\r\n]*)", 1).try_cast("long")


def digest_columns(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and the page that a revisit refers to."""
    rows = stage_table(
        captures.select(
            page_of(F.col("metadata")).alias("page_id"),
            F.col("response.payload_bytes").alias("payload_bytes"),
            F.col("response.payload_digest").alias("payload_digest"),
            "record_type",
            "capture_id",
            F.col("response.refers_to").alias("target"),
        ),
        "captures",
    )
    # Only captures that a revisit names are looked up.
    named = rows.where(F.col("target").isNotNull()).select(F.col("target").alias("capture_id")).distinct()
    targets = rows.join(named, "capture_id", "left_semi").select(F.col("capture_id").alias("target"), F.col("page_id").alias("refers_to"))
    return join_staged(rows, targets, ["target"], "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

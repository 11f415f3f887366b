"""WARC derivatives: linked metadata and plain-text conversion records.

Every response record gives one metadata record and one conversion record. Both
refer to the response by its record id, repeat its target URI and date, and
carry digests of their own; the metadata also keeps the response's headers and
digests. The three are stored together, so what is referred to can be found.
Records are built per row, so nothing shuffles; files are gzipped record by
record, as the format asks, and bounded in bytes.
"""

from __future__ import annotations

import base64
import hashlib
import html as html_entities
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.common import Scratch, file_store, table

#: Responses, and packed bytes, after which the next output file begins.
FILE_RECORDS, FILE_BYTES = 2000, 16 << 20
#: The date of pages that are stored without one.
DATE = "2024-01-01T00:00:00Z"
_SPACE_OF_IDS = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc:derivatives")
_CRLF = b"\r\n"

_NAME = re.compile(r"(/?)([A-Za-z][^\s/>]*)")
#: Elements whose content is no text; without an end tag they go on to the end.
_RAW = {"script", "style", "noscript", "template"}
#: What may stand in a head. A head without end tag ends before the first text or element that may not.
_IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "head", "title", "noframes", *_RAW}
_BLOCKS = {"p", "div", "br", "li", "ul", "ol", "tr", "table", "article", "section", "nav", "header", "footer", "blockquote", "pre", "title", *(f"h{k}" for k in range(1, 7))}
#: What tags without attributes, outside of a head, leave in a text.
_SIMPLE = {f"{end}{name}": "\n" for name in sorted(_BLOCKS - {"title"}) for end in ("", "/")} | {f"{end}{name}": "" for name in ("a", "b", "i", "em", "strong", "span", "td", "th", "tbody", "code") for end in ("", "/")}
_HUGE_NUMBER = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{8,});?")


def digest(content: bytes) -> str:
    """A labelled SHA-1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(content).digest()).decode()


def record_id(*parts: str) -> str:
    """The same id for the same parts, in every run and attempt."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE_OF_IDS, chr(31).join(parts))}>"


def _ends() -> dict[str, re.Pattern]:
    return {name: re.compile(rf"(?i)</{name}\s*>") for name in (*_RAW, "title", "noframes")}


_ENDS = _ends()


def plain_text(html: str) -> str:
    """Title and body text: no tags, scripts or styles; a line for each block; entities resolved.

    The page is read once, from one ``<`` to the next. The first title is the first
    line. A ``<`` that no ``>`` follows, or no name, is text.
    """
    first, *parts = html.split("<")
    title, out, in_head = None, [first], False
    start, upto = len(first), 0  # of the part's sign in the page; what lies before ``upto`` is done
    endless: set[str] = set()  # elements of which no end tag is ahead
    simple = _SIMPLE.get

    def end_of(name: str, at: int) -> re.Match | None:
        found = None if name in endless else _ENDS[name].search(html, at)
        if not found:
            endless.add(name)
        return found

    for part in parts:
        at, start = start, start + 1 + len(part)
        if at < upto:  # inside of a tag, a comment or an element without text
            text = html[upto:start] if start > upto else ""
        else:
            end = part.find(">")
            sign = simple(part[:end]) if end > 0 else None
            if sign is not None and not in_head:
                out.append(sign)
                out.append(part[end + 1 :])
                continue
            m = _NAME.match(part)
            close = -1
            if m or part[:1] in ("!", "?", "/"):
                close = at + 1 + end if end >= 0 else html.find(">", start)
            if part.startswith("!--"):
                done = html.find("-->", at + 4)
                upto = done + 3 if done >= 0 else len(html)
                out.append(" ")
            elif not (m or part[:1] in ("!", "?", "/")):
                upto = at + 1
                in_head = False
                out.append("<")
            elif close < 0:
                out.append(html[at:])
                break
            else:
                upto = close + 1
                name = m[2].lower() if m else ""
                if m and m[1]:
                    in_head = in_head and name not in ("head", "body", "html", "br")
                elif name in _RAW:
                    done = end_of(name, upto)
                    upto = done.end() if done else len(html)
                    out.append(" ")
                elif name == "title" or name == "noframes" and in_head:
                    done = end_of(name, upto)
                    if done:
                        title = html[upto : done.start()] if name == "title" and title is None else title
                        upto = done.end()
                    in_head = in_head and bool(done)
                elif name == "head":
                    in_head = True
                    out.append(" ")
                else:
                    in_head = in_head and (not name or name in _IN_HEAD)
                if name in _BLOCKS:
                    out.append("\n")
            text = html[upto:start] if start > upto else ""
        if in_head and text and not text.isspace():
            in_head = False
        if not in_head:
            out.append(text)
    lines = [" ".join(line.split()) for line in _unescaped(_without_tags(title or "") + "\n" + "".join(out)).split("\n")]
    return "\n".join(filter(None, lines))


def _unescaped(text: str) -> str:
    return html_entities.unescape(_HUGE_NUMBER.sub("\ufffd", text)) if "&" in text else text


def _without_tags(text: str) -> str:
    cut = text.rfind(">") + 1  # each tag before it ends, so none is looked for in vain
    return re.sub(r"<[^>]*>", "", text[:cut]) + text[cut:]


def build(kind: str, headers: list[tuple[str, str]], content: bytes) -> bytes:
    """The bytes of one record."""
    lines = [b"WARC/1.1", f"WARC-Type: {kind}".encode(), *(f"{k}: {v}".encode("utf-8", "surrogatepass") for k, v in headers), f"Content-Length: {len(content)}".encode()]
    return _CRLF.join(lines) + _CRLF * 2 + content + _CRLF * 2


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (by lower-case name, in order) and content of one record."""
    head, _, rest = record.partition(_CRLF * 2)
    version, *lines = head.split(_CRLF)
    if not version.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = {}
    for line in lines:
        name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
        headers[name.strip().lower()] = value.strip()
    return headers, rest[: int(headers.get("content-length", 0))]


def _as_uri(text: str) -> str:
    """A URL as a header holds it: blanks and control characters as per cent escapes."""
    return re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", text)


def response(key: str, url: str | None, html: str | None, date: str = DATE, row: int = 0) -> bytes:
    """A response record of a stored page; a null page is an empty payload.

    Its id comes of all that is known of it, with its date and the number of its
    row, so that pages that repeat and later crawls of a page have ids of their own.
    """
    payload = (html or "").encode("utf-8", "surrogatepass")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + str(len(payload)).encode() + _CRLF * 2 + payload
    headers = [
        ("WARC-Record-ID", record_id("response", key, url or "", digest(payload), date, str(row))),
        ("WARC-Date", date),
        ("WARC-Target-URI", _as_uri(url or "")),
        ("WARC-Payload-Digest", digest(payload)),
        ("WARC-Block-Digest", digest(http)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return build("response", headers, http)


def derive(record: bytes) -> tuple[bytes, bytes] | None:
    """(metadata, conversion) of a response; None for any other record.

    The metadata's fields are the response's HTTP status and headers, its
    digests and what the conversion is; a missing digest is worked out. A
    response without a payload converts to empty text.
    """
    headers, block = parse(record)
    if headers.get("warc-type") != "response":
        return None
    head, _, payload = block.partition(_CRLF * 2)
    status, *http = head.decode("latin-1").split("\r\n")
    source, uri, date = headers["warc-record-id"], headers.get("warc-target-uri", ""), headers.get("warc-date", DATE)
    payload_digest = headers.get("warc-payload-digest") or digest(payload)
    charset = next((m[1] for h in http if (m := re.match(r"(?i)content-type:.*charset=[\"']?([\w-]+)", h))), "utf-8")
    try:
        page = payload.decode(charset, "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    text = plain_text(page).encode("utf-8", "replace")
    text_digest = digest(text)
    conversion_id = record_id("conversion", source)
    shared = [("WARC-Refers-To", source), ("WARC-Target-URI", uri), ("WARC-Date", date)]
    conversion = build("conversion", [("WARC-Record-ID", conversion_id), *shared, ("WARC-Block-Digest", text_digest), ("WARC-Source-Payload-Digest", payload_digest), ("Content-Type", "text/plain; charset=utf-8")], text)
    fields = [
        ("source-status", status),
        *((f"source-header-{h.partition(':')[0].strip().lower()}", h.partition(":")[2].strip()) for h in http if ":" in h),
        ("source-payload-digest", payload_digest),
        ("source-block-digest", headers.get("warc-block-digest") or digest(block)),
        ("conversion-record-id", conversion_id),
        ("conversion-block-digest", text_digest),
        ("text-length", str(len(text))),
    ]
    body = b"".join(f"{k}: {v}\r\n".encode("utf-8", "surrogatepass") for k, v in fields)
    metadata = build("metadata", [("WARC-Record-ID", record_id("metadata", source)), *shared, ("WARC-Concurrent-To", conversion_id), ("WARC-Block-Digest", digest(body)), ("Content-Type", "application/warc-fields")], body)
    return metadata, conversion


#: Pages that a task turns into records at once.
SLICE_PAGES = 256


def responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", date: str | None = None) -> DataFrame:
    """Response records (key, record) of stored pages; null ids have an empty key.

    ``date`` names a column with the dates of the records as text; pages without
    one get a constant, as they do not say when they were fetched. A null URL is
    an empty one, a null page an empty payload. Rows may repeat; each has a record
    with an id of its own, by its number in the table as it is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE_PAGES):
                b = batch.slice(low, SLICE_PAGES)
                columns = (b.column(c).to_pylist() for c in ("key", "url", "html", "date", "row"))
                made = [response(k or "", u, h, d or DATE, n) for k, u, h, d, n in zip(*columns, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(made, pa.binary())], names=["key", "record"])

    known = {"key": F.col(page_id).cast("string"), "url": F.col(url), "html": F.col(html), "date": (F.col(date) if date else F.lit(None)).cast("string")}
    rows = pages.select(*(c.alias(n) for n, c in known.items()), F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(run, "key string, record binary")


def write_derivatives(records: DataFrame, folder: str, file_records: int = FILE_RECORDS, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write each response of (key, record) rows with its metadata and conversion; return key, path and where each begins.

    Files are written under the attempt's name and renamed, so a lost executor
    leaves no half file. Records that are no responses give no row. ``size`` is
    the length of the three together.
    """
    spark = records.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    names = ["key", "path", "response_at", "meta_at", "text_at", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = file_store(folder)
        context = TaskContext.get()
        n_file, rows, members, at = 0, [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"part-{context.partitionId():06d}-{n_file:05d}.warc.gz"
            attempt = f"{root}/.{name}.{context.taskAttemptId()}"
            with store.open_output_stream(attempt, compression=None) as out:
                for m in members:
                    out.write(m)
            if store.get_file_info(f"{root}/{name}").type != fs.FileType.NotFound:  # an earlier attempt's
                store.delete_file(f"{root}/{name}")
            store.move(attempt, f"{root}/{name}")
            columns = list(zip(*rows, strict=True))
            kinds = [pa.string(), *[pa.int64()] * 4]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([arrays[0], pa.array([name] * len(rows)), *arrays[1:]], names=names)

        for batch in batches:
            for key, record in zip(batch.column("key"), batch.column("record"), strict=True):
                record = record.as_py()
                made = derive(record)
                if made is None:
                    continue
                page, meta, text = (zlib.compress(x, 1, 31) for x in (record, *made))
                rows.append((key.as_py(), at, at + len(page), at + len(page) + len(meta), len(page) + len(meta) + len(text)))
                members += [page, meta, text]
                at += len(page) + len(meta) + len(text)
                if len(rows) >= file_records or at >= file_bytes:
                    yield flush()
                    n_file, rows, members, at = n_file + 1, [], [], 0
        if rows:
            yield flush()

    return records.mapInArrow(run, "key string, path string, response_at long, meta_at long, text_at long, size long")


def read_derivatives(folder: str, index: DataFrame, keep_text: bool = True) -> DataFrame:
    """Per response, from the files: what its metadata and conversion records say, with the text or its digest alone.

    The index's places are dealt out by file, and each task reads its files'
    records there, one at a time; no content shuffles. ``linked`` says that both
    refer to the stored response and to each other, and that all digests hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_store(folder)
        names = ["key", "refers_to", "metadata_id", "conversion_id", "target_uri", "source_payload_digest", "text_digest", "linked", "text_length", "text_sha256", "text"][: 11 if keep_text else 10]
        kinds = [*[pa.string()] * 7, pa.bool_(), pa.int64(), pa.string(), pa.string()][: len(names)]
        for batch in batches:
            for path, places in zip(batch.column("path").to_pylist(), batch.column("places"), strict=True):
                places, out = places.as_py(), []
                with store.open_input_file(f"{root}/{path}") as f:
                    packed = memoryview(f.read_buffer())  # FILE_BYTES, or one record
                for place in places:
                    edges = [place["response_at"], place["meta_at"], place["text_at"], place["response_at"] + place["size"]]
                    (page, block), (meta, body), (conv, text) = (parse(zlib.decompress(packed[s:e], 31)) for s, e in zip(edges, edges[1:], strict=False))
                    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in body.decode("utf-8", "surrogatepass").split("\r\n") if line)
                    linked = page["warc-record-id"] == meta["warc-refers-to"] == conv["warc-refers-to"] and fields["conversion-record-id"] == conv["warc-record-id"] == meta["warc-concurrent-to"]
                    linked &= digest(block) == page["warc-block-digest"] == fields["source-block-digest"] and digest(text) == conv["warc-block-digest"] == fields["conversion-block-digest"]
                    out.append((place["key"], meta["warc-refers-to"], meta["warc-record-id"], conv["warc-record-id"], conv["warc-target-uri"], fields["source-payload-digest"], conv["warc-block-digest"], linked, len(text), hashlib.sha256(text).hexdigest(), *([text.decode("utf-8")] if keep_text else ())))
                columns = list(zip(*out, strict=True)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    # A file has FILE_RECORDS places at most.
    places = index.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("response_at", "meta_at", "text_at", "size", "key"))).alias("places"))
    schema = "key string, refers_to string, metadata_id string, conversion_id string, target_uri string, source_payload_digest string, text_digest string, linked boolean, text_length long, text_sha256 string"
    # As many tasks as files: their places are few bytes, by which adaptive execution would join them up.
    dealt = places.repartition(max(1, index.select("path").distinct().count()), "path")
    return dealt.mapInArrow(run, schema + ", text string" * keep_text)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build and read back the derivatives of every page."""
    scratch = Scratch(spark, "op3")
    folder = scratch.path("warc")
    index = scratch.save(write_derivatives(responses(table(spark, sf_dir, "pages")), folder), "index")
    back = read_derivatives(folder, index, keep_text=False)
    return back.withColumn("key", F.col("key").cast("long")).withColumnRenamed("key", "page_id")

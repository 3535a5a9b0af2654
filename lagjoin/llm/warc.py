"""WARC archives: index first, then coalesced byte-range reads.

Writing makes one gzip member per record, so a record can be read alone, and
returns an index row (file, offset, length, url, digest, ...) per record.
Reading takes any selection of index rows, sorts it by file and offset,
merges neighbouring ranges into one read each, and parses the records.

Duplicates: of records with equal payloads of at least ``min_revisit`` bytes
the smallest id is a response, all others revisit it.  Only ids and digests
decide that.  The ``MAX_SENT`` most repeated digests are broadcast, so no
payload of theirs is shuffled; if there are more repeated digests, a second
join shuffles on the others, none of which is hot, and the revisits found
before travel without their payload.

Defined results: a null payload is empty; a null url has no target field; a
null id never is a response's id but may revisit one; rows that repeat the
smallest id are responses each; an empty table gives empty archives.  Columns
other than the named ones are ignored.  A task holds one payload while it
writes, and while it reads one stretch of the file and about ``READ_BYTES`` of
payloads (one longer payload is held alone), however well they compress.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagjoin.llm.shared import new_path, ship, table, written
from lagjoin.llm.store import filesystem, own_name

MIN_REVISIT = 100
FILE_BYTES = 256 << 20   # a task starts another archive beyond this
READ_BYTES = 8 << 20     # one coalesced read is at most about this long
GAP_BYTES = 64 << 10     # unwanted bytes read over to save a request
MAX_SENT = 200_000       # repeated digests broadcast, about 100 bytes each

INDEX = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("id", T.LongType()),
    T.StructField("url", T.StringType()), T.StructField("digest", T.StringType()),
    T.StructField("record_type", T.StringType())])
RECORD = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("payload", T.BinaryType())])


def with_revisits(df: DataFrame, id_col: str, url_col: str, payload_col: str,
                  min_revisit: int = MIN_REVISIT) -> DataFrame:
    """id, url, payload, digest, n_bytes and refers_to (null: a response).
    The payload of a revisit may be null."""
    rows = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("n_bytes", F.octet_length("payload"))
    firsts = written(rows.where(F.col("n_bytes") >= min_revisit).groupBy("digest")
                     .agg(F.min("id").alias("first_id"), F.count("*").alias("copies"))
                     .where("copies > 1 and first_id is not null"), "warc-firsts")
    sent, rest = firsts, None
    if firsts.count() > MAX_SENT:
        sent = written(firsts.orderBy(F.desc("copies"), "digest").limit(MAX_SENT), "warc-firsts")
        rest = firsts.join(F.broadcast(sent.select("digest")), "digest", "left_anti")
    rows = rows.join(F.broadcast(sent.drop("copies")), "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    rows = rows.withColumn("payload", F.when(~revisit, F.col("payload")))
    if rest is not None:
        # Rows decided already meet nobody; their own key spreads them.
        rows = (rows.withColumn("key", F.when(F.col("first_id").isNull(), F.col("digest"))
                                .otherwise(F.concat(F.lit("-"), F.xxhash64("id", "url").cast("string"))))
                .join(rest.select(F.col("digest").alias("key"), F.col("first_id").alias("rest_id")), "key", "left")
                .withColumn("first_id", F.coalesce("first_id", "rest_id")).drop("key", "rest_id"))
    return rows.withColumn("refers_to", F.when(revisit, F.col("first_id"))).drop("first_id")


def record_bytes(rid: int | None, url: str | None, payload: bytes | None, n_bytes: int, digest: str,
                 refers_to: int | None) -> bytes:
    """One gzip member: a response, or a revisit with an empty block."""
    body = payload if refers_to is None else b""
    kind = "response" if refers_to is None else "revisit"
    head = ["WARC/1.1", f"WARC-Type: {kind}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {n_bytes}",
            f"Content-Length: {len(body)}"]
    if rid is not None:
        head.append(f"WARC-Record-ID: <urn:page:{rid}>")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", 5, mtime=0)


#: Characters of a URL written as they are; the rest, per cent included,
#: is quoted so that any text is read back unchanged.
_URL_SAFE = ":/?#[]@!$&'()*+,;=-._~"


def parse_record(member: bytes) -> dict:
    """Fields of one record; the payload of a response is checked against
    its digest."""
    from urllib.parse import unquote
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    number = lambda name: int(m[1]) if (m := re.match(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
        raise ValueError(f"payload digest does not match in record {fields.get('WARC-Record-ID')}")
    url = fields.get("WARC-Target-URI")
    return {"id": number("WARC-Record-ID"), "url": None if url is None else unquote(url), "record_type": kind,
            "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": digest,
            "refers_to": number("WARC-Refers-To"), "payload": body}


def write_archives(rows: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archives of :func:`with_revisits` rows in ``folder``; their index, as
    a written table.  Tasks hold one record at a time."""
    spark = rows.sparkSession
    ship(spark)
    folder = folder or new_path(spark, "warc")

    def run(batches):
        out, uri, at = None, None, 0
        try:
            for batch in batches:
                index = []
                for k in range(batch.num_rows):
                    rid, url, payload, n_bytes, digest, refers_to = (c[k].as_py() for c in batch.columns)
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        uri, at = own_name(folder, ".warc.gz"), 0
                        system, path = filesystem(uri)
                        system.create_dir(path.rpartition("/")[0], recursive=True)
                        out = system.open_output_stream(path, compression=None)
                    data = record_bytes(rid, url, payload, n_bytes, digest, refers_to)
                    out.write(data)
                    index.append({"file": uri, "offset": at, "length": len(data), "id": rid, "url": url,
                                  "digest": digest, "record_type": "response" if refers_to is None else "revisit"})
                    at += len(data)
                yield pa.RecordBatch.from_pylist(index, _arrow(INDEX))
        finally:
            if out is not None:
                out.close()

    return written(rows.select("id", "url", "payload", "n_bytes", "digest", "refers_to").mapInArrow(run, INDEX), "warc-index")


def _arrow(schema: T.StructType) -> pa.Schema:
    kinds = {T.StringType: pa.string(), T.LongType: pa.int64(), T.BinaryType: pa.binary()}
    return pa.schema([(f.name, kinds[type(f.dataType)]) for f in schema])


def read_records(index: DataFrame, payloads: bool = True, read_bytes: int = READ_BYTES,
                 gap_bytes: int = GAP_BYTES) -> DataFrame:
    """The records of the selected index rows, in any number.  Stretches of
    a file go to tasks whole, sorted; each run of near ranges is one read."""
    ship(index.sparkSession)
    schema = RECORD if payloads else T.StructType(RECORD.fields[:-1])
    stretch = F.floor(F.col("offset") / (4 * read_bytes))

    def run(batches):
        arrow, open_file, f = _arrow(schema), None, None

        def records(file, group):
            nonlocal open_file, f
            if open_file != file:
                system, path = filesystem(file)
                open_file, f = file, system.open_input_file(path)
            first = group[0][0]
            f.seek(first)
            data = f.read(max(o + n for o, n in group) - first)
            found, held = [], 0
            for o, n in group:
                record = parse_record(data[o - first:o - first + n])
                if payloads:
                    held += len(record["payload"])
                else:
                    del record["payload"]
                found.append(record)
                if held >= read_bytes:
                    yield pa.RecordBatch.from_pylist(found, arrow)
                    found, held = [], 0
            if found:
                yield pa.RecordBatch.from_pylist(found, arrow)

        file, group = None, []
        for batch in batches:
            for name, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if group and (name != file or offset > sum(group[-1]) + gap_bytes
                              or offset + length - group[0][0] > read_bytes):
                    yield from records(file, group)
                    group = []
                file = name
                group.append((offset, length))
        if group:
            yield from records(file, group)

    picked = (index.select("file", "offset", "length").repartition("file", stretch)
              .sortWithinPartitions("file", "offset"))
    return picked.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: every page written to archives and read back from them."""
    pages = table(spark, sf_dir, "pages")
    index = write_archives(with_revisits(pages, "page_id", "url", "html"))
    return read_records(index, payloads=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
                  sha256(coalesce(html, '')) as payload_digest from pages),
f as (select payload_digest, min(page_id) as first_id from p where payload_bytes >= 100 group by 1)
select p.page_id, p.payload_bytes::bigint as payload_bytes, p.payload_digest,
       case when f.first_id is null or f.first_id = p.page_id then 'response' else 'revisit' end as record_type,
       case when f.first_id <> p.page_id then f.first_id end as refers_to
from p left join f using (payload_digest)
"""

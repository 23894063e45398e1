"""WARC archives: a gzip member for each record, written and read back one record after the other.

Tasks write archives of their own into a shared folder and report them as rows, so a repeated task leaves at
most an unused file behind. Readers stream an archive: they inflate piece by piece, take as many bytes as
``Content-Length`` says, and check the payload's digest, holding one piece at a time unless the payload is
asked for.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewharf.functions.scratch import materialized

ROLL_BYTES = 256 << 20
PIECE = 1 << 16
LEVEL = 6
LEAST_SHARED = 100
DATE = "1970-01-01T00:00:00Z"

# Names of the format
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"

RECORDS = (
    "page_id long, record_type string, target_uri string, payload_bytes long, payload_digest string, "
    "refers_to long, verified boolean, archive string"
)


def with_first_copies(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest`` and ``first``: the smallest page_id of an equal payload.

    ``first`` is null for payloads without copies and for those under ``least`` bytes. Only digests that
    occur more than once are joined to the pages.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    firsts = (
        rows.where(F.length("payload") >= least).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    return rows.join(materialized(firsts), "digest", "left").select("page_id", "url", "payload", "digest", "first")


def _clean(text: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{name}: {value}" for name, value in headers)]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode()
    packed = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packed.compress(head + block + b"\r\n\r\n") + packed.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """A response, or a revisit of the page ``first``, which keeps the head of the answer but no payload."""
    own = "null" if page_id is None else str(page_id)
    headers = [("WARC-Record-ID", f"<{URN}{own}>"), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", _clean(url)))
    headers += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if first is None or first == page_id:
        return record("response", headers, answer + payload)
    headers += [("WARC-Refers-To", f"<{URN}{first}>"), ("WARC-Profile", PROFILE)]
    return record("revisit", headers, answer)


def write(pages: DataFrame, folder: str, roll: int = ROLL_BYTES) -> DataFrame:
    """Writes archives for ``pages`` into ``folder``, which all executors share, and returns ``(archive, records)``.

    One record for each row, repeated rows too. Null html is an empty payload, a null url leaves the header
    out, and a null page_id is written as such.
    """
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        out, name, size, count = None, "", 0, 0
        done: dict[str, int] = {}
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "first")]
            for i in range(batch.num_rows):
                if out is None:
                    store.create_dir(root, recursive=True)
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    about = f"software: tidewharf\r\nformat: WARC File Format 1.1\r\nfilename: {name}\r\n".encode()
                    out.write(record("warcinfo", [
                        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, name)}>"), ("WARC-Date", DATE),
                        ("Content-Type", "application/warc-fields"),
                    ], about))
                data = page_record(*(c[i].as_py() for c in columns))
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= roll:
                    out.close()
                    done[name], out = count, None
        if out is not None:
            out.close()
            done[name] = count
        yield pa.RecordBatch.from_pydict({
            "archive": pa.array([f"{folder}/{n}" for n in done], pa.string()), "records": pa.array(list(done.values()), pa.int64()),
        })

    return materialized(with_first_copies(pages).mapInArrow(written, "archive string, records long"))


class Members:
    """The gzip members of a stream; ``read`` gives bytes of the present one."""

    def __init__(self, stream):
        self.stream, self.raw, self.inflate, self.ready = stream, b"", None, b""

    def next(self) -> bool:
        """Moves on to the next member; False at the end of the stream."""
        if self.inflate is not None and not self.inflate.eof:
            while self.read(PIECE):
                pass
        self.raw = self.raw or self.stream.read(PIECE)
        if not self.raw:
            return False
        self.inflate, self.ready = zlib.decompressobj(31), b""
        return True

    def _more(self) -> bool:
        while not self.inflate.eof:
            self.raw = self.raw or self.stream.read(PIECE)
            if not self.raw:
                raise ValueError("the archive ends inside a record")
            self.ready += self.inflate.decompress(self.raw, PIECE)
            self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if self.ready:
                return True
        return False

    def read(self, n: int) -> bytes:
        """At most ``n`` bytes, none only at the member's end."""
        if not self.ready and not self._more():
            return b""
        out, self.ready = self.ready[:n], self.ready[n:]
        return out

    def head(self) -> bytes:
        """Bytes up to an empty line, which is consumed. Only the member's end bounds a head, as urls are of any length."""
        pieces, edge = [], b""
        while (at := (piece := edge + self.ready).find(b"\r\n\r\n")) < 0:
            cut = max(len(piece) - 3, 0)  # the empty line may lie across pieces
            pieces.append(piece[:cut])
            edge, self.ready = piece[cut:], b""
            if not self._more():
                raise ValueError("a record's head has no end")
        self.ready = piece[at + 4 :]
        return b"".join([*pieces, piece[:at]])


def fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def read_records(stream, payloads: bool = False) -> Iterator[dict]:
    """The records of an archive in order. ``verified`` tells whether length and digest fit the payload."""
    members = Members(stream)
    while members.next():
        head = fields(members.head())
        left = int(head["content-length"])
        kind, digest, kept = head.get("warc-type", ""), hashlib.sha256(), []
        stated, seen = 0, 0
        if head.get("content-type", "").startswith("application/http"):
            answer = members.head()
            left -= len(answer) + 4
            stated = int(fields(answer).get("content-length", left))
        while left > 0:
            piece = members.read(min(left, PIECE))
            if not piece:
                raise ValueError("a record is shorter than its Content-Length")
            digest.update(piece)
            seen += len(piece)
            left -= len(piece)
            if payloads:
                kept.append(piece)
        tail = b""
        while piece := members.read(PIECE):
            tail += piece[: 8 - len(tail)]
        if left < 0 or tail != b"\r\n\r\n":
            raise ValueError("a record does not end where its Content-Length says")
        named = head.get("warc-payload-digest", "").removeprefix("sha256:")
        sound = kind == "revisit" or kind == "warcinfo" or (seen == stated and digest.hexdigest() == named)
        yield {
            "id": head.get("warc-record-id", "").strip("<>"), "kind": kind, "uri": head.get("warc-target-uri"),
            "size": stated, "digest": named, "refers": head.get("warc-refers-to", "").strip("<>"), "verified": sound,
            "payload": b"".join(kept) if payloads and kind == "response" else None,
        }


def checked(records: DataFrame) -> DataFrame:
    """``records`` with ``verified`` of a revisit true only if a verified response has its number, digest and length.

    Revisits of one response are compared once, so a payload of very many pages is one row here. Null numbers equal
    nothing: a revisit without one is not verified. ``records`` is read twice and should be stored.
    """
    asked = records.where("record_type = 'revisit'").select("refers_to", "payload_digest", "payload_bytes").distinct()
    sound = records.where("record_type = 'response' AND verified").select(
        F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes"
    )
    bad = asked.join(sound, ["refers_to", "payload_digest", "payload_bytes"], "left_anti")
    bad = materialized(bad.select(*[F.col(c).alias(f"_bad_{c}") for c in bad.columns], F.lit(True).alias("_bad")))
    same = [F.col(c).eqNullSafe(F.col(f"_bad_{c}")) for c in ("refers_to", "payload_digest", "payload_bytes")]
    refused = F.col("_bad").isNotNull() & (F.col("record_type") == "revisit")
    return records.join(bad, same, "left").withColumn("verified", F.col("verified") & ~refused).select(*records.columns)


def _number(urn: str) -> int | None:
    text = urn.removeprefix(URN)
    return int(text) if urn.startswith(URN) and text != "null" else None


def read(archives: DataFrame, payloads: bool = False, rows_at_once: int = 256) -> DataFrame:
    """The response and revisit records of ``archives(archive)``, each archive read by one task in sequence.

    With ``payloads`` there is a column ``payload`` besides, null for revisits.
    """
    schema = RECORDS + ", payload binary" * payloads
    names = ["page_id", "record_type", "target_uri", "payload_bytes", "payload_digest", "refers_to", "verified", "archive"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.binary()]

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * (len(names) + payloads)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names + ["payload"] * payloads
            )

        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                store, path = fs.FileSystem.from_uri(archive)
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for r in read_records(stream, payloads):
                        if r["kind"] not in ("response", "revisit"):
                            continue
                        row = (_number(r["id"]), r["kind"], r["uri"], r["size"], r["digest"], _number(r["refers"]), r["verified"], archive)
                        rows.append(row + (r["payload"],) * payloads)
                        held += len(r["payload"] or b"") + len(r["uri"] or "")
                        if len(rows) >= rows_at_once or held > 16 << 20:
                            yield packed(rows)
                            rows, held = [], 0
                if rows:
                    yield packed(rows)

    listed = archives.select("archive")
    return listed.repartition(max(listed.count(), 1)).mapInArrow(told, schema)

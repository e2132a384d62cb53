"""WARC archives: pages out as records, and back in by verified record boundaries.

Writing: pages of equal payload form a group; the one of the largest page_id is a
response that carries the payload, the others are revisits that refer to it and
carry headers only. Each task writes one archive.

Reading: an archive is cut into stretches that tasks read by offset. The magic of a
record's start can also stand inside a payload, so a stretch reports every place
where it stands, with the place where that record would end and the next begin.
Chains of these inside a stretch are followed there; what is left is a table from
each place where a stretch may be entered to where its chain leaves it. Pointer
jumping from the archive's start doubles the reach each round and finds the true
entries; only records on the chain from the start are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pulsetide.llm import files
from pulsetide.session import shared_folder, store

MAGIC = b"WARC/1.1\r\n"
HEADER_END = b"\r\n\r\n"
LENGTH = re.compile(rb"\r\nContent-Length: ([0-9]+)\r\n")
STRETCH = 4 << 20
#: Read beyond a stretch's end at first, for a record that starts near it.
MARGIN = 16 << 10
DATE = "2024-01-01T00:00:00Z"

RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers: int | None) -> bytes:
    """One record; without payload a revisit, whose HTTP header still tells the payload's length."""
    kind = "response" if payload is not None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http + (payload or b"")
    lines = [
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers}>")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return MAGIC + "\r\n".join(lines).encode() + HEADER_END + body + HEADER_END


def first_record() -> bytes:
    body = b"format: WARC File Format 1.1\r\n"
    head = f"WARC-Type: warcinfo\r\nWARC-Record-ID: <urn:archive>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(body)}"
    return MAGIC + head.encode() + HEADER_END + body + HEADER_END


def planned(pages: DataFrame, least: int, folder: str) -> DataFrame:
    """The pages with refers_to, and without html where they are revisits.

    Payloads are compared by digest on narrow rows, so a payload that a third of
    all pages share moves its digests only; the pages themselves are dealt by page_id.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keys = store(rows.select("page_id", F.sha2("html", 256).alias("key"), F.octet_length("html").cast("long").alias("size")), f"{folder}/keys")
    heads = store(keys.groupBy("key").agg(F.max("page_id").alias("head"), F.count("*").alias("n")).where("n > 1"), f"{folder}/heads")
    again = keys.join(heads, "key").where(F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head")) & (F.col("size") >= least))
    again = store(again.select(F.col("page_id").alias("p"), F.col("key").alias("k"), "head").distinct(), f"{folder}/again")
    same = F.col("page_id").eqNullSafe(F.col("p")) & (F.sha2("html", 256) == F.col("k"))
    found = rows.join(again, same, "left")
    return found.select("page_id", "url", "html", F.col("head").alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write the pages' records below `folder`; returns the archives (path, size, n_records).

    Of pages with equal payloads of at least `least` bytes, the one with the largest
    page_id is the response, the others revisit it; smaller payloads are all
    responses. A null html is an empty payload; rows that repeat a page_id and its
    payload are alike. A page without page_id is never referred to unless all its
    group have none, and then all are responses. Other columns are not read.
    """
    files.make_folder(f"{folder}/warc")

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, size, n = f"{folder}/warc/part-{TaskContext.get().partitionId():06d}.warc", 0, 0
        with files.Writing(path) as out:
            size += out.write(first_record())
            for batch in rows:
                for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to"))):
                    page, url, html, refers = row
                    payload = html.encode()
                    size += out.write(record(page, url, None if refers is not None else payload, len(payload), digest_of(payload), refers))
                    n += 1
        yield pa.RecordBatch.from_pydict({"path": [path], "size": [size], "n_records": [n]})

    return store(planned(pages, least, folder).mapInArrow(write, "path string, size long, n_records long"), f"{folder}/archives")


def _header(uri: str, raw: bytes, base: int, at: int) -> tuple[bytes, int] | None:
    """(header, where its body starts) of a candidate, or None if the archive ends before its header does."""
    end, size = raw.find(HEADER_END, at - base), MARGIN
    while end < 0:
        size *= 2
        raw = files.read_range(uri, at, size)
        base, end = at, raw.find(HEADER_END)
        if end < 0 and len(raw) < size:
            return None
    return raw[at - base : end + 4], base + end + 4


def candidates(uri: str, start: int, end: int) -> list[tuple[int, int]]:
    """(place, successor) of every magic in a stretch, true or not."""
    raw = files.read_range(uri, start, end - start + MARGIN)
    found, at = [], raw.find(MAGIC)
    while 0 <= at < end - start:
        got = _header(uri, raw, start, start + at)
        length = LENGTH.search(got[0]) if got else None
        if length:
            found.append((start + at, got[1] + int(length[1]) + len(HEADER_END)))
        at = raw.find(MAGIC, at + 1)
    return found


def _stretches(archives: DataFrame, stretch: int) -> DataFrame:
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(stretch).cast("long")))
    return archives.where("size > 0").select("path", "size", cut.alias("start")).withColumn("end", F.least(F.col("start") + stretch, "size"))


def _exits(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per candidate of a stretch, where the chain from it leaves the stretch."""
    for batch in rows:
        for s in batch.to_pylist():
            leaves: dict[int, int] = {}
            for at, following in reversed(candidates(s["path"], s["start"], s["end"])):
                # A chain that runs into a place without magic is broken: it leads nowhere.
                leaves[at] = leaves.get(following, -1) if following < s["end"] else following
            place = [a for a, b in leaves.items() if b >= 0]
            yield pa.RecordBatch.from_pydict(
                {"path": [s["path"]] * len(place), "start": [s["start"]] * len(place), "at": place, "to": [leaves[a] for a in place]},
                schema=pa.schema([("path", pa.string()), ("start", pa.int64()), ("at", pa.int64()), ("to", pa.int64())]),
            )


def entries(archives: DataFrame, folder: str, stretch: int = STRETCH) -> DataFrame:
    """(path, start, at): where the chain from each archive's start enters each stretch that it enters.

    A chain that does not arrive at its archive's end is an error: records would be lost.
    """
    cuts = _stretches(archives, stretch)
    spread = cuts.repartition(max(1, min(cuts.count(), 8 * cuts.sparkSession.sparkContext.defaultParallelism)))
    chains = store(spread.mapInArrow(_exits, "path string, start long, at long, to long"), f"{folder}/chains")
    # Only places that some chain arrives at can be entries.
    arrivals = chains.select("path", F.col("to").alias("at")).union(archives.select("path", F.lit(0).cast("long").alias("at"))).distinct()
    jumps = store(chains.join(arrivals, ["path", "at"]), f"{folder}/jumps0")
    starts = jumps.select("path", "at", "start")
    reached = store(archives.select("path", F.lit(0).cast("long").alias("at")), f"{folder}/reached0")
    hops, round_, before = jumps.select("path", "at", "to"), 0, reached.count()
    while True:
        round_ += 1
        onward = reached.join(hops, ["path", "at"]).select("path", F.col("to").alias("at"))
        reached = store(reached.union(onward).distinct(), f"{folder}/reached{round_}")
        now = reached.count()
        if now == before:
            break
        before = now
        second = hops.select("path", F.col("at").alias("to"), F.col("to").alias("then"))
        hops = store(hops.join(second, ["path", "to"]).select("path", "at", F.col("then").alias("to")), f"{folder}/jumps{round_}")
    broken = archives.join(reached, (reached["at"] == archives["size"]) & (reached["path"] == archives["path"]), "left_anti")
    if not broken.isEmpty():
        raise ValueError(f"{broken.count()} archives have no unbroken chain of records to their end, such as {broken.first()['path']}")
    return starts.join(reached, ["path", "at"], "left_semi").select("path", "start", "at")


def parse(header: bytes, body: bytes) -> dict | None:
    """A page's record, its payload checked against its digest; None for other records."""
    fields = dict(line.split(": ", 1) for line in header.decode().split("\r\n")[1:] if ": " in line)
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    http, payload = body.split(HEADER_END, 1)
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and digest_of(payload) != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")

    def page(name: str) -> int | None:
        number = fields[name].removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": int(re.search(rb"Content-Length: ([0-9]+)", http)[1]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page("WARC-Refers-To") if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def read_archives(archives: DataFrame, folder: str, stretch: int = STRETCH, payloads: bool = True) -> DataFrame:
    """Records of pages in the archives, one row each (RECORDS, and the payload if asked for)."""
    found = entries(archives, folder, stretch).withColumn("end", F.col("start") + stretch)
    schema = RECORDS + (", payload binary" if payloads else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for s in batch.to_pylist():
                out: list[dict] = []
                at, raw, base = s["at"], files.read_range(s["path"], s["at"], s["end"] - s["at"] + MARGIN), s["at"]
                while at < s["end"] and raw:
                    got = _header(s["path"], raw, base, at) if at - base < len(raw) else None
                    if got is None:
                        break
                    size = int(LENGTH.search(got[0])[1])
                    lo = got[1] - base
                    body = raw[lo : lo + size] if lo + size <= len(raw) else files.read_range(s["path"], got[1], size)
                    row = parse(got[0], body)
                    out += [row] if row else []
                    at = got[1] + size + len(HEADER_END)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], _KIND.get(n, pa.int64())) for n in names], names=names)

    n = max(1, min(found.count(), 8 * found.sparkSession.sparkContext.defaultParallelism))
    return found.repartition(n).mapInArrow(read, schema)


_KIND = {"url": pa.string(), "payload_digest": pa.string(), "record_type": pa.string(), "payload": pa.binary()}


def write_and_read(pages: DataFrame, least: int = 0, folder: str | None = None) -> DataFrame:
    """Write the pages' archives and read their records back (RECORDS)."""
    folder = folder or shared_folder(pages.sparkSession, "warc")
    archives = write_archives(pages, folder, least)
    found = store(read_archives(archives, folder, payloads=False), f"{folder}/found")
    written = archives.agg(F.sum("n_records")).first()[0] or 0
    if found.count() != written:
        raise ValueError(f"{written} records written, {found.count()} read")
    return found

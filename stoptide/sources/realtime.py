"""Realtime feed messages: read as binary files, decoded on the executors, damaged files as rows.

Files are listed and read by Spark's ``binaryFile`` source, so any store works and each file is a
row; a decoder turns a file's bytes into rows in Arrow batches. What an archive holds is told by an
``unpack`` function (file name, bytes) -> (member name, bytes), which can be replaced: the one here
knows plain messages, zip archives and gzip. A file or member that can't be read gives one row with
``problem``, and no other row of it is lost or made up. Empty files aren't listed by Spark: their hours are missing.

The wire format is read by its own rules (tag, varint, length), and the messages by the tables below.
"""

from __future__ import annotations

import gzip
import io
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Field numbers and enumerations of the public feed specification.
TRIP = {1: "trip_id", 3: "start_date", 5: "route_id"}
TRIP_RELATIONSHIPS = {0: "SCHEDULED", 1: "ADDED", 2: "UNSCHEDULED", 3: "CANCELED", 5: "REPLACEMENT", 6: "DUPLICATED", 7: "DELETED"}
STOP_RELATIONSHIPS = {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA", 3: "UNSCHEDULED"}
VEHICLE_STATUS = {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"}

BATCH_ROWS = 20_000
Unpack = Callable[[str, bytes], Iterable[tuple[str, bytes]]]
VARINT, FIXED64, LENGTH, FIXED32 = 0, 1, 2, 5

_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64()}


def _event_columns(of: str) -> dict[str, str]:
    return {f"{of}_{x}{y}": "boolean" if y else ("bigint" if x == "time" else "int") for x in ("time", "delay", "uncertainty") for y in ("_present", "")}


TRIP_UPDATES = (
    {"header_timestamp": "bigint", "snapshot_file": "string", "trip_id": "string", "start_date": "string", "route_id": "string", "trip_schedule_relationship": "string"}
    | {"tu_timestamp_present": "boolean", "tu_timestamp": "bigint", "stop_sequence": "int", "stop_id": "string", "stop_schedule_relationship": "string"}
    | _event_columns("arrival")
    | _event_columns("departure")
    | {"problem": "string"}
)
VEHICLES = (
    {"header_timestamp": "bigint", "snapshot_file": "string", "trip_id": "string", "start_date": "string"}
    | {f"{x}{y}": "boolean" if y else kind for x, kind in (("vehicle_id", "string"), ("vehicle_timestamp", "bigint"), ("latitude", "double"), ("longitude", "double")) for y in ("_present", "")}
    | {f"{x}{y}": "boolean" if y else kind for x, kind in (("current_status", "string"), ("current_stop_sequence", "int")) for y in ("_present", "")}
    | {"stop_id": "string", "problem": "string"}
)


# ---------------------------------------------------------------- the wire format


def _varint(body: memoryview, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        if at >= len(body) or shift > 63:
            raise ValueError("a number isn't whole")
        byte = body[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value & 0xFFFFFFFFFFFFFFFF, at
        shift += 7


def wire_fields(body: memoryview) -> Iterator[tuple[int, int, int | memoryview]]:
    """(field number, wire type, value) in order; ValueError where the bytes aren't a message."""
    at = 0
    while at < len(body):
        tag, at = _varint(body, at)
        number, kind = tag >> 3, tag & 7
        if kind == VARINT:
            value, at = _varint(body, at)
        elif kind in (LENGTH, FIXED64, FIXED32):
            size, at = _varint(body, at) if kind == LENGTH else ((8 if kind == FIXED64 else 4), at)
            if number == 0 or at + size > len(body):
                raise ValueError("a field isn't whole")
            value, at = body[at : at + size], at + size
        else:
            raise ValueError(f"wire type {kind}")
        yield number, kind, value


class Fields:
    """A message's fields: the last value of each number, by wire type; a value of another type is as unknown as another number."""

    def __init__(self, body: memoryview | None) -> None:
        self.all = list(wire_fields(body)) if body is not None else []
        self.last = {(n, kind): v for n, kind, v in self.all}

    def whole(self, number: int, bits: int = 64) -> int | None:
        x = self.last.get((number, VARINT))
        if x is None:
            return None
        x &= (1 << bits) - 1
        return x - (1 << bits) if x >> (bits - 1) else x

    def part(self, number: int) -> memoryview | None:
        return self.last.get((number, LENGTH))

    def parts(self, number: int) -> list[memoryview]:
        return [v for n, kind, v in self.all if (n, kind) == (number, LENGTH)]

    def text(self, number: int) -> str | None:
        x = self.part(number)
        return None if x is None else bytes(x).decode("utf-8")

    def real(self, number: int) -> float:
        return struct.unpack("<f", self.last.get((number, FIXED32), bytes(4)))[0]


def _message(body: bytes) -> tuple[int, list[memoryview]]:
    """The header's time and the entities."""
    f = Fields(memoryview(body))
    if f.part(1) is None:
        raise ValueError("no header")
    return Fields(f.part(1)).whole(3) or 0, f.parts(2)


def _event(of: str, body: memoryview | None) -> dict:
    f = Fields(body)
    values = {"delay": f.whole(1, 32), "time": f.whole(2), "uncertainty": f.whole(3, 32)}
    return {f"{of}_{x}_present": v is not None for x, v in values.items()} | {f"{of}_{x}": v for x, v in values.items()}


def trip_update_rows(name: str, body: bytes) -> Iterator[dict]:
    """A row for each stop of each trip update; one without stops for an update that has none."""
    time, entities = _message(body)
    for entity in entities:
        if (update := Fields(entity).part(3)) is None:
            continue
        f = Fields(update)
        trip, stamp, stops = Fields(f.part(1)), f.whole(4), f.parts(2)
        head = {"header_timestamp": time, "snapshot_file": name, "tu_timestamp_present": stamp is not None, "tu_timestamp": stamp}
        head |= {column: trip.text(n) for n, column in TRIP.items()} | {"trip_schedule_relationship": TRIP_RELATIONSHIPS.get(trip.whole(4) or 0, "SCHEDULED")}
        for stop in map(Fields, stops):
            own = {"stop_sequence": stop.whole(1, 32), "stop_id": stop.text(4), "stop_schedule_relationship": STOP_RELATIONSHIPS.get(stop.whole(5) or 0, "SCHEDULED")}
            yield head | own | _event("arrival", stop.part(2)) | _event("departure", stop.part(3))
        if not stops:
            yield head | _event("arrival", None) | _event("departure", None)


def vehicle_rows(name: str, body: bytes) -> Iterator[dict]:
    """A row for each vehicle position."""
    time, entities = _message(body)
    for entity in entities:
        if (vehicle := Fields(entity).part(4)) is None:
            continue
        f = Fields(vehicle)
        trip, place = Fields(f.part(1)), Fields(f.part(2))
        values = {"vehicle_id": Fields(f.part(8)).text(1), "vehicle_timestamp": f.whole(5), "current_status": VEHICLE_STATUS.get(f.whole(4)), "current_stop_sequence": f.whole(3, 32)}
        values |= {x: place.real(n) if f.part(2) is not None else None for x, n in (("latitude", 1), ("longitude", 2))}
        head = {"header_timestamp": time, "snapshot_file": name, "trip_id": trip.text(1), "start_date": trip.text(3), "stop_id": f.text(7)}
        yield head | values | {f"{x}_present": v is not None for x, v in values.items()}


# ---------------------------------------------------------------- files


def unpacked(name: str, body: bytes) -> Iterator[tuple[str, bytes]]:
    """The messages of a file: members of a zip archive in order of name, the content of a gzip file, or the file itself."""
    if body[:4] == b"PK\x03\x04":
        with zipfile.ZipFile(io.BytesIO(body)) as archive:
            for member in sorted(x for x in archive.namelist() if x.endswith(".pb")):
                yield member, archive.read(member)
    elif body[:2] == b"\x1f\x8b":
        yield name.removesuffix(".gz"), gzip.decompress(body)
    else:
        yield name, body


def decoded(files: DataFrame, kind: str = "trip_updates", unpack: Unpack = unpacked) -> DataFrame:
    """Rows of all messages of ``files`` (path, content) of ``trip_updates`` or ``vehicles``.

    ``snapshot_file`` is the member's name, or the file's behind its folder. A null content, and what
    isn't a message, gives one row with ``snapshot_file`` and ``problem``; the members before it stay.
    """
    columns, rows_of = {"trip_updates": (TRIP_UPDATES, trip_update_rows), "vehicles": (VEHICLES, vehicle_rows)}[kind]
    schema = pa.schema([("path", pa.string()), *((c, _ARROW[t]) for c, t in columns.items())])

    def messages(path: str, content: bytes | None) -> Iterator[dict]:
        name = (path or "").rpartition("/")[2]
        try:
            if content is None:
                raise ValueError("no content")
            for name, body in unpack(name, content):
                yield from list(rows_of(name, body))  # all of a message or none
        except (ValueError, EOFError, OSError, zipfile.BadZipFile, zlib.error, RuntimeError, NotImplementedError) as e:
            yield {"snapshot_file": name, "problem": f"{type(e).__name__}: {e}"[:200]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[dict] = []
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                for row in messages(path.as_py(), content.as_py()):
                    held.append(row | {"path": path.as_py()})
                    if len(held) == BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
            yield pa.RecordBatch.from_pylist(held, schema)

    return files.select("path", "content").mapInArrow(run, ", ".join(f"{f.name} {columns.get(f.name, 'string')}" for f in schema))


def hour_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """The files under ``root/<date>/<hour>...``: path, service_date, hour and length; their content isn't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    date, hour = (F.regexp_extract("path", r"/(\d{4}-\d{2}-\d{2})/(\d{2})(?:[./][^/]*)?$", k) for k in (1, 2))
    return found.select("path", F.try_to_date(F.nullif(date, F.lit(""))).alias("service_date"), F.nullif(hour, F.lit("")).try_cast("int").alias("hour"), "length")


def read_feed(spark: SparkSession, paths: str | list[str], kind: str = "trip_updates", unpack: Unpack = unpacked, pattern: str = "*") -> DataFrame:
    """The decoded rows of all files under one or many paths or globs, with date and hour from the path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(paths)
    date, hour = (F.regexp_extract("path", r"/(\d{4}-\d{2}-\d{2})/(\d{2})(?:[./][^/]*)?$", k) for k in (1, 2))
    return decoded(files, kind, unpack).withColumns({"service_date": F.try_to_date(F.nullif(date, F.lit(""))), "hour": F.nullif(hour, F.lit("")).try_cast("int")})


def hours_present(files: DataFrame, dates: DataFrame, hours: Iterable[int] = range(24)) -> DataFrame:
    """(service_date, hour, n_files, bytes, present) of every expected hour: a missing one is a row, not an exception.

    ``files`` has service_date, hour and length; ``dates`` the expected service_date. Empty files count as missing.
    """
    expected = dates.select("service_date").distinct().withColumn("hour", F.explode(F.array(*(F.lit(h) for h in hours))))
    there = files.filter("length > 0").groupBy("service_date", "hour").agg(F.count("*").alias("n_files"), F.sum("length").alias("bytes"))
    out = expected.join(there, ["service_date", "hour"], "left")
    return out.select("service_date", "hour", F.coalesce("n_files", F.lit(0)).alias("n_files"), F.coalesce("bytes", F.lit(0)).alias("bytes"), F.col("n_files").isNotNull().alias("present"))


def require_hours(found: DataFrame) -> None:
    """FileNotFoundError that lists every hour of ``hours_present`` that isn't there."""
    gone = found.filter("NOT present").orderBy("service_date", "hour").collect()
    if gone:
        raise FileNotFoundError(f"{len(gone)} hours are missing: " + ", ".join(f"{r['service_date']} {r['hour']:02d}" for r in gone))


# ---------------------------------------------------------------- writing messages


def _number(x: int) -> bytes:
    x &= 0xFFFFFFFFFFFFFFFF
    out = bytearray()
    while x > 127:
        out.append(x & 127 | 128)
        x >>= 7
    return bytes([*out, x])


def wire(number: int, value: int | float | str | bytes | None) -> bytes:
    """One field: whole numbers as varints, floats in 32 bits, texts and messages with their length; nothing for a null."""
    if value is None:
        return b""
    if isinstance(value, float):
        return _number(number << 3 | FIXED32) + struct.pack("<f", value)
    if isinstance(value, int):
        return _number(number << 3 | VARINT) + _number(int(value))
    body = value.encode() if isinstance(value, str) else value
    return _number(number << 3 | LENGTH) + _number(len(body)) + body


def encoded_updates(rows: list[dict]) -> bytes:
    """A feed message with a trip update for each row, as ``decoded`` reads it; null columns are left out."""

    def event(r: dict, of: str) -> bytes | None:
        body = b"".join(wire(n, r.get(f"{of}_{x}")) for n, x in ((1, "delay"), (2, "time"), (3, "uncertainty")))
        return body or None

    def code(names: dict[int, str], name: str | None) -> int | None:
        return next((k for k, v in names.items() if v == name), None)

    out = [wire(1, wire(1, "2.0") + wire(3, rows[0]["header_timestamp"]))]
    for k, r in enumerate(rows):
        trip = wire(1, r.get("trip_id")) + wire(3, r.get("start_date")) + wire(4, code(TRIP_RELATIONSHIPS, r.get("trip_schedule_relationship"))) + wire(5, r.get("route_id"))
        stop = wire(1, r.get("stop_sequence")) + wire(2, event(r, "arrival")) + wire(3, event(r, "departure")) + wire(4, r.get("stop_id"))
        if stop:
            stop = wire(2, stop + wire(5, code(STOP_RELATIONSHIPS, r.get("stop_schedule_relationship"))))
        out.append(wire(2, wire(1, str(k)) + wire(3, wire(1, trip) + stop + wire(4, r.get("tu_timestamp")))))
    return b"".join(out)


def encoded_vehicles(rows: list[dict]) -> bytes:
    """A feed message with a vehicle position for each row."""
    out = [wire(1, wire(1, "2.0") + wire(3, rows[0]["header_timestamp"]))]
    for k, r in enumerate(rows):
        place = wire(1, r.get("latitude")) + wire(2, r.get("longitude"))
        body = wire(1, wire(1, r.get("trip_id")) + wire(3, r.get("start_date"))) + (wire(2, place) if place else b"") + wire(3, r.get("current_stop_sequence")) + wire(5, r.get("vehicle_timestamp")) + wire(7, r.get("stop_id")) + wire(8, wire(1, r.get("vehicle_id")))
        status = next((n for n, v in VEHICLE_STATUS.items() if v == r.get("current_status")), None)
        out.append(wire(2, wire(1, str(k)) + wire(4, body + wire(4, status))))
    return b"".join(out)


def as_messages(rows: DataFrame, file: Column, kind: str = "trip_updates") -> DataFrame:
    """(path, content): the rows of each file as one message; a file is a snapshot, so its size is the feed's, not the table's."""
    encode = {"trip_updates": encoded_updates, "vehicles": encoded_vehicles}[kind]

    def run(table: pa.Table) -> pa.Table:
        return pa.table({"path": [table["path"][0].as_py()], "content": pa.array([encode(table.to_pylist())], pa.binary())})

    return rows.withColumn("path", file).groupBy("path").applyInArrow(run, "path string, content binary")

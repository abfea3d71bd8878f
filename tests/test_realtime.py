"""Feed messages from files: archives, damage, hours that are missing, values at their limits."""

from __future__ import annotations

import gzip
import zipfile

import pytest

from stoptide.sources import realtime as r

UPDATES = [
    {"header_timestamp": 1704067200, "trip_id": "t1", "start_date": "20240101", "tu_timestamp": 5, "stop_sequence": 3, "stop_id": "å", "departure_time": 99, "departure_delay": -30, "departure_uncertainty": 0, "trip_schedule_relationship": "CANCELED"},
    {"header_timestamp": 1704067200, "trip_id": "t2"},
    {"header_timestamp": 1704067200, "stop_sequence": 1, "arrival_delay": -(2**31), "arrival_time": 2**62, "stop_schedule_relationship": "SKIPPED"},
]


@pytest.fixture
def root(tmp_path):
    body = r.encoded_updates(UPDATES)
    day = tmp_path / "2024-01-01"
    (day / "02").mkdir(parents=True)
    (day / "02" / "a.pb").write_bytes(body)
    with zipfile.ZipFile(day / "03.zip", "w") as z:
        z.writestr("b.pb", body)
        z.writestr("a.pb", body)
        z.writestr("notes.txt", "no message")
    (day / "04.pb.gz").write_bytes(gzip.compress(body))
    (day / "05.pb").write_bytes(body[:-3])
    (day / "06.zip").write_bytes(b"PK\x03\x04 cut off")
    (day / "07.pb").write_bytes(b"")
    (day / "08.pb").write_bytes(b"<html>no feed</html>")
    return tmp_path


def test_files_are_decoded_and_damage_is_a_row(spark, root):
    got = r.read_feed(spark, str(root)).collect()
    whole, damaged = [x for x in got if x["problem"] is None], [x for x in got if x["problem"]]
    assert sorted((x["hour"], x["snapshot_file"]) for x in whole) == sorted([(2, "a.pb"), (3, "a.pb"), (3, "b.pb"), (4, "04.pb")] * 3)
    assert sorted(x["hour"] for x in damaged) == [5, 6, 8] and all(x["trip_id"] is None and x["header_timestamp"] is None for x in damaged)
    assert {x["service_date"].isoformat() for x in got} == {"2024-01-01"}
    first = next(x for x in whole if x["trip_id"] == "t1").asDict()
    assert {k: first[k] for k in UPDATES[0]} == UPDATES[0]
    assert first["stop_schedule_relationship"] == "SCHEDULED" and not first["arrival_time_present"] and first["departure_uncertainty_present"]
    bare = next(x for x in whole if x["trip_id"] == "t2")
    assert bare["stop_sequence"] is None and bare["stop_schedule_relationship"] is None and not bare["tu_timestamp_present"]
    last = next(x for x in whole if x["trip_id"] is None)
    assert (last["arrival_delay"], last["arrival_time"], last["stop_schedule_relationship"]) == (-(2**31), 2**62, "SKIPPED")


def test_many_paths_and_an_injected_decoder(spark, root):
    paths = [str(root / "2024-01-01" / x) for x in ("03.zip", "04.pb.gz")]
    assert r.read_feed(spark, paths).count() == 9
    twice = r.read_feed(spark, paths[1:], unpack=lambda name, body: [("x", gzip.decompress(body)), ("y", gzip.decompress(body))])
    assert sorted(x[0] for x in twice.select("snapshot_file").collect()) == ["x"] * 3 + ["y"] * 3


def test_hours_without_reading_content(spark, root):
    files = r.hour_files(spark, str(root))
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    got = r.hours_present(files, files.filter("service_date IS NOT NULL"), range(2, 11)).collect()
    assert {x["hour"]: x["present"] for x in got} == {h: h in (2, 3, 4, 5, 6, 8) for h in range(2, 11)}


def test_vehicles(spark):
    rows = [{"header_timestamp": 17, "vehicle_id": "v", "latitude": 56.5, "longitude": -14.25, "current_status": "STOPPED_AT", "vehicle_timestamp": 8, "trip_id": "t", "stop_id": "s", "current_stop_sequence": 4}, {"header_timestamp": 17}]
    body = r.encoded_vehicles(rows)
    files = spark.createDataFrame([("d/x", bytearray(body)), ("d/y", None), ("d/z", bytearray(r.encoded_updates(UPDATES)))], "path string, content binary")
    got = sorted(r.decoded(files, "vehicles").collect(), key=lambda x: (x["path"], str(x["trip_id"])))
    assert len(got) == 3 and got[2]["problem"]
    full, bare = next(x for x in got if x["trip_id"]), next(x for x in got if x["trip_id"] is None and not x["problem"])
    assert {k: full[k] for k in rows[0]} == rows[0] and full["latitude_present"]
    assert not any(bare[c] for c in r.VEHICLES if c.endswith("_present")) and bare["latitude"] is None


def test_values_of_another_type_are_unknown():
    odd = r.wire(1, r.wire(3, "no time")) + r.wire(2, r.wire(3, r.wire(1, 5) + r.wire(2, r.wire(1, "x") + r.wire(4, 7)) + r.wire(99, "more")))
    (row,) = r.trip_update_rows("f", odd)
    assert row["header_timestamp"] == 0 and row["trip_id"] is None and row["stop_sequence"] is None and row["stop_id"] is None
    with pytest.raises(ValueError, match="wire type"):
        list(r.wire_fields(memoryview(b"\x0b")))
    with pytest.raises(ValueError, match="whole"):
        list(r.wire_fields(memoryview(b"\x08\xff")))


def test_every_cut_is_noticed_or_whole(spark):
    body = r.encoded_updates(UPDATES[:1])
    for n in range(1, len(body)):
        try:
            rows = list(r.trip_update_rows("f", body[:n]))
        except ValueError:
            continue
        assert rows == []  # the header alone is a whole message

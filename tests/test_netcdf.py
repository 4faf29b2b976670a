"""Headers of classic NetCDF files: the layouts, damaged files, and the way to a catalogue."""

import struct

import pytest

from meridian.functions import calendars as cal
from meridian.sources import netcdf, paths
from meridian.sources.folders import file_system

TIMES = [15.0, 45.0, 75.5]


def sample(version=1, records=True, extra=True, kind="double", **attributes):
    dims = {"time": None if records else 3, "lat": 2, "plev": 19, "three": 3}
    variables = [("lat", "float", ["lat"], {"units": "degrees_north"}, [1.5, -1.5]), ("time", kind, ["time"], {"units": "days since 2000-01-01", "calendar": "noleap"}, TIMES if kind == "double" else [15, 45, 75])]
    if extra:
        variables.append(("tas", "short", ["time", "three"], {"standard_name": "air_temperature", "units": "K", "valid_range": [1, 400], "scale": 0.5}, list(range(9))))
    given = {n: f"{n}-x" for n in paths.CMIP6_ATTRIBUTES} | {"variable_id": "tas", "title": "ünï", "realization": 3} | attributes
    return netcdf.encode(dims, given, variables, version)


def read(data):
    return netcdf.read_header(lambda at, n: data[at : at + n], len(data))


@pytest.mark.parametrize("version", [1, 2, 5])
@pytest.mark.parametrize("records", [True, False])
@pytest.mark.parametrize("extra", [True, False])
def test_layouts(version, records, extra):
    found = read(sample(version, records, extra))
    assert found["times"] == [15.0, 75.5] and found["time_units"] == "days since 2000-01-01" and found["calendar"] == "noleap"
    assert found["dimensions"] == {"time": 3, "lat": 2, "plev": 19, "three": 3}
    assert found["header"]["title"] == "ünï" and found["header"]["realization"] == "3" and found["header"]["source_id"] == "source_id-x"
    names = [v[0] for v in found["variables"]]
    assert names == ["lat", "time"] + ["tas"] * extra
    if extra:
        assert found["variables"][2] == ("tas", "short", ["time", "three"], {"standard_name": "air_temperature", "units": "K", "valid_range": "1 400", "scale": "0.5"})


def test_single_record_variable_is_not_padded():
    data = netcdf.encode({"time": None}, {}, [("time", "short", ["time"], {"units": "days since 2000-01-01"}, [1, 2, 7])])
    assert read(data)["times"] == [1.0, 7.0] and read(data)["calendar"] == "standard"


def test_records_of_a_stream_are_counted_by_the_length():
    data = bytearray(sample())
    data[4:8] = struct.pack(">i", -1)
    assert read(bytes(data))["times"] == [15.0, 75.5]


def test_a_header_longer_than_the_first_read():
    data = sample(history="x" * 50_000)
    asked = []
    found = netcdf.read_header(lambda at, n: asked.append(n) or data[at : at + n], len(data))
    assert found["times"] == [15.0, 75.5] and asked[0] == netcdf.FIRST_READ and sum(asked) < 5 * len(data)


@pytest.mark.parametrize("data, error", [
    (b"", "ends inside"), (b"CDF", "ends inside"), (b"GRIB1234", "not a NetCDF"), (b"\x89HDF\r\n\x1a\n", "HDF5"), (b"CDF\x09" + b"\0" * 40, "not a NetCDF"), (sample()[:300], "ends inside"),
    (sample(kind="double")[:-30], "before its last time"), (b"CDF\x01" + struct.pack(">iii", 0, 77, 1), "damaged"), (b"CDF\x01" + struct.pack(">iii", 0, 10, -4), "damaged"),
])
def test_damaged_files_say_what_is_wrong(data, error):
    with pytest.raises(ValueError, match=error):
        read(data)


def test_files_without_times():
    empty = netcdf.encode({"time": None, "x": 2}, {"a": 1.5}, [("time", "double", ["time"], {"units": "days since 2000-01-01"}, []), ("x", "int", ["x"], {}, [1, 2])])
    assert read(empty)["times"] is None and read(empty)["header"] == {"a": "1.5"}
    none = netcdf.encode({"x": 2}, {}, [("x", "int", ["x"], {}, [1, 2])])
    assert read(none)["times"] is None and read(none)["time_units"] is None and read(none)["dimensions"] == {"x": 2}


def test_partitions_by_weight():
    parts = netcdf.packed([(f"f{k}", 10 if k % 2 else 1 << 40) for k in range(10)], 4 << 20)
    assert [len(p.paths) for p in parts] == [2, 2, 2, 2, 2] and [p for x in parts for p, _ in x.paths] == [f"f{k}" for k in range(10)]
    assert netcdf.packed([], 10) == []


def test_from_files_to_a_catalogue(spark, tmp_path):
    root = tmp_path / "CMIP6" / "v20200101"
    root.mkdir(parents=True)
    (root / "good.nc").write_bytes(sample(sub_experiment_id="s1960"))
    (root / "fixed.nc").write_bytes(netcdf.encode({"x": 2}, {"source_id": "s"}, [("x", "int", ["x"], {}, [1, 2])]))
    (root / "torn.nc").write_bytes(sample()[:300])
    (root / "other.nc").write_bytes(b"\x89HDF\r\n\x1a\n")
    (root / "notes.txt").write_text("x")
    valid, left_out = netcdf.find_datasets(spark, f"file://{tmp_path}", paths.cmip6_from_header, target="1000000")
    found = {r["path"].rpartition("/")[2]: r for r in valid.withColumns({c: cal.time_text(valid[c]) for c in ("start_time", "end_time")}).collect()}
    good = found["good.nc"]
    assert (good["start_time"], good["end_time"], good["vertical_levels"], good["units"], good["standard_name"], good["init_year"], good["version"]) == ("2000-01-16 00:00:00", "2000-03-17 12:00:00", 19, "K", "air_temperature", 1960, "v20200101")
    assert set(found) == {"good.nc", "fixed.nc"} and found["fixed.nc"]["start_time"] is None and found["fixed.nc"]["source_id"] == "s"
    errors = {r["path"].rpartition("/")[2]: r["invalid_asset"] for r in left_out.collect()}
    assert set(errors) == {"torn.nc", "other.nc"} and "ends inside" in errors["torn.nc"] and "HDF5" in errors["other.nc"]
    with pytest.raises(ValueError, match="no valid datasets"):
        netcdf.find_datasets(spark, str(tmp_path), paths.cmip7_from_header)
    with pytest.raises(Exception, match="no files"):
        netcdf.headers(spark, str(tmp_path), pattern="*.grib").count()
    named = spark.createDataFrame([(str(root / "good.nc"), 1), (str(root / "absent.nc"), 2)], "path string, k int")
    by = {r["k"]: r for r in netcdf.with_headers(named).collect()}
    assert by[1]["times"] == [15.0, 75.5] and by[2]["header"] is None and "FileNotFound" in by[2]["invalid_asset"]
    assert file_system(f"file://{root}/good.nc")[1] == str(root / "good.nc") == file_system(f"file:{root}/good.nc")[1]

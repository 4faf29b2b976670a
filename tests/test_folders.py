"""Whole folders as a source, and catalogues that grow by them."""

import json
import os

import pytest

from meridian.plans.upsert import validate
from meridian.sources.folders import FolderSource, Folders, _FolderStream
from meridian.sources.paths import cmip6_from_path
from meridian.streaming.folders import Catalog, ingest_folders

COLUMNS = ("source_id", "variable_id", "frequency")


def make(root, source, variable="tas", years=(2000, 2001), version="v20200101", table="Amon"):
    folder = root / "CMIP6" / "CMIP" / "INST" / source / "hist" / "r1i1p1f1" / table / variable / "gn" / version
    folder.mkdir(parents=True, exist_ok=True)
    for y in years:
        (folder / f"{variable}_{table}_{source}_hist_r1i1p1f1_gn_{y}01-{y}12.nc").write_bytes(b"CDF\x01")
    return folder


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def catalog(spark, path, name):
    return Catalog(spark, f"file://{path}/{name}", COLUMNS)


def test_offsets_are_batches_of_whole_folders(tmp_path):
    for k in range(5):
        make(tmp_path / "in", f"M{k}")
    options = {"path": str(tmp_path / "in"), "log": str(tmp_path / "log"), "maxfolders": "2", "perpartition": "1"}
    stream = _FolderStream(options)
    assert stream.initialOffset() == {"batch": 0}
    assert [stream.latestOffset() for _ in range(4)] == [{"batch": 1}, {"batch": 2}, {"batch": 3}, {"batch": 3}]
    late = make(tmp_path / "in", "A0")
    again = _FolderStream(options)  # after a restart: what was announced stays as it was
    first = [n for p in again.partitions({"batch": 0}, {"batch": 1}) for n in p.names]
    assert len(first) == 2 and again.latestOffset() == {"batch": 4}
    every = [n for p in again.partitions({"batch": 0}, {"batch": 4}) for n in p.names]
    assert len(every) == len(set(every)) == 6 and every[-1] == str(late)
    assert again.partitions({"batch": 4}, {"batch": 4}) == []
    assert len(list(again.read(Folders([str(late)])))) == 2
    assert sorted(os.listdir(tmp_path / "log")) == [f"{n:09d}.json" for n in range(1, 5)]
    assert json.loads((tmp_path / "log" / "000000004.json").read_text()) == [str(late)]


def test_folders_that_still_change_wait(tmp_path):
    folder = make(tmp_path / "in", "M0")
    options = {"path": str(tmp_path / "in"), "log": str(tmp_path / "log"), "settle": "3600"}
    assert _FolderStream(options).latestOffset() == {"batch": 0}
    for f in folder.iterdir():
        os.utime(f, (1e9, 1e9))
    assert _FolderStream(options).latestOffset() == {"batch": 1}
    assert _FolderStream(options | {"depth": "10", "log": str(tmp_path / "log2")}).latestOffset() == {"batch": 1}


def test_batch_source(spark, tmp_path):
    spark.dataSource.register(FolderSource)
    folder = make(tmp_path / "in", "M0")
    (folder / "notes.txt").write_text("x")
    found = spark.read.format("folders").option("path", f"file://{tmp_path}/in").load()
    assert found.count() == 2 and {r["folder"] for r in found.collect()} == {str(folder)} and {r["size"] for r in found.collect()} == {4}
    with pytest.raises(Exception, match="no files"):
        spark.read.format("folders").option("path", str(tmp_path / "in")).option("pattern", "*.grib").load().count()
    with pytest.raises(Exception, match="no folder"):
        spark.read.format("folders").option("path", str(tmp_path / "absent")).load().count()


def test_batches_equal_one_ingest(spark, tmp_path):
    for k in range(5):
        make(tmp_path / "in", f"M{k}")
    make(tmp_path / "in", "BAD", table="Xmon")
    small, whole = catalog(spark, tmp_path, "small"), catalog(spark, tmp_path, "whole")
    assert ingest_folders(small, str(tmp_path / "in"), str(tmp_path / "c1"), cmip6_from_path, 2) == 3
    assert ingest_folders(whole, str(tmp_path / "in"), str(tmp_path / "c2"), cmip6_from_path) == 1
    assert rows(small.datasets()) == rows(whole.datasets()) and small.datasets().count() == 5
    assert rows(small.files()) == rows(whole.files()) and small.files().count() == 10
    assert small.rows("invalid").count() == 2
    assert rows(whole.rows("statistics").drop("batch")) == [("dataset", "created", 5), ("file", "added", 10), ("invalid", "left out", 2)]
    # nothing new: no batch; a further folder of a dataset that is there: its files, and the dataset where it differs
    assert ingest_folders(small, str(tmp_path / "in"), str(tmp_path / "c1"), cmip6_from_path, 2) == 3
    make(tmp_path / "in", "M9", years=(1990,))
    assert ingest_folders(small, str(tmp_path / "in"), str(tmp_path / "c1"), cmip6_from_path, 2) == 4
    assert small.datasets().count() == 6 and small.files().count() == 11


class Killed(Exception):
    pass


@pytest.mark.parametrize("table", ["datasets", "done"])
def test_killed_between_write_and_commit(spark, tmp_path, monkeypatch, table):
    """Whichever table was last written, the batch is run again and the catalogue equals one that never broke off."""
    for k in range(4):
        make(tmp_path / "in", f"M{k}")
    broken, whole = catalog(spark, tmp_path, "broken"), catalog(spark, tmp_path, "whole")
    write, left = Catalog._write, [1]

    def killed(self, name, df, batch):
        out = write(self, name, df, batch) if name != "done" else None
        if name == table and batch == 1 and left[0]:
            left[0] -= 1
            raise Killed(name)
        return out if name != "done" else write(self, name, df, batch)

    monkeypatch.setattr(Catalog, "_write", killed)
    with pytest.raises(Exception, match="Killed"):
        ingest_folders(broken, str(tmp_path / "in"), str(tmp_path / "c1"), cmip6_from_path, 2)
    assert broken.batches() == [0] and broken.datasets().count() == 2  # what is not complete is not read
    assert ingest_folders(broken, str(tmp_path / "in"), str(tmp_path / "c1"), cmip6_from_path, 2) == 2
    monkeypatch.undo()
    ingest_folders(whole, str(tmp_path / "in"), str(tmp_path / "c2"), cmip6_from_path)
    assert rows(broken.datasets()) == rows(whole.datasets()) and rows(broken.files()) == rows(whole.files())
    before = rows(broken.rows("datasets"))
    broken.take_in(cmip6_from_path(spark.read.format("folders").option("path", str(tmp_path / "in")).load().where("path like '%M0%' or path like '%M1%'")), 0)
    assert rows(broken.rows("datasets")) == before  # a batch that is repeated changes nothing


def test_states_and_disagreeing_datasets(spark, tmp_path):
    c = catalog(spark, tmp_path, "c")
    schema = "path string, instance_id string, source_id string, variable_id string, frequency string, start_time string, end_time string, finalised boolean"
    first = [("/a1", "a", "s", "tas", "mon", "2000", "2001", True), ("/b1", "b", "s", "tas", "mon", "2000", "2001", False), ("/b2", "b", "s", "pr", "mon", None, None, False)]
    c.take_in(spark.createDataFrame(first, schema), 0)
    assert rows(c.datasets().select("instance_id")) == [("a",)] and rows(c.rows("invalid").select("path", "invalid_asset")) == [("/b1", "its dataset disagrees in variable_id"), ("/b2", "its dataset disagrees in variable_id")]
    with pytest.raises(ValueError, match="inconsistent"):
        validate(spark.createDataFrame(first, schema), "instance_id", (), COLUMNS)
    second = [("/a1", "a", "other", None, "mon", "2000", "2002", False), ("/b1", "b", "s", "tas", "mon", "2000", "2001", False)]
    c.take_in(spark.createDataFrame(second, schema), 1)
    # read from its path only, a finalised dataset keeps what its header said; its file has a new end
    assert rows(c.datasets()) == [("a", "s", "tas", "mon", True), ("b", "s", "tas", "mon", False)]
    assert rows(c.files()) == [("a", "/a1", "2000", "2002"), ("b", "/b1", "2000", "2001")]
    assert rows(c.rows("statistics").where("batch = 1").drop("batch")) == [("dataset", "created", 1), ("file", "added", 1), ("file", "updated", 1)]
    c.take_in(spark.createDataFrame([], schema), 2)
    assert c.datasets().count() == 2

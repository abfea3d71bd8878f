"""The shared folder: named by the session, or one of this process on a single machine, or refused."""

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from stoptide.sources import scratch


def session(master, named=None, app="app-1"):
    conf = SimpleNamespace(get=lambda key, default=None: named)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=app, getConf=lambda: SimpleNamespace(get=lambda key: None)))


def test_the_folder_is_named_made_once_or_refused():
    assert scratch.shared_dir(session("spark://x", "hdfs://y/z/")) == "hdfs://y/z"
    made = scratch.shared_dir(session("local[4]"))
    assert made == scratch.shared_dir(session("local[4]")) and os.path.isdir(made.removeprefix("file://"))
    assert made != scratch.shared_dir(session("local", app="app-2"))
    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        scratch.shared_dir(session("spark://x"))


def test_store(spark, tmp_path):
    store = scratch.Store(spark, str(tmp_path))
    store.write(f"{tmp_path}/a", "text é")
    store.write(f"{tmp_path}/b", "other")
    assert store.read(f"{tmp_path}/a") == "text é" and store.names(str(tmp_path)) == ["a", "b"]
    assert not store.rename(f"{tmp_path}/a", f"{tmp_path}/b") and store.rename(f"{tmp_path}/a", f"{tmp_path}/c")
    assert store.read(f"{tmp_path}/b") == "other" and store.names(f"{tmp_path}/none") == []

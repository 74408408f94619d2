"""Records of a fit's finished iterations, from which it can go on.

A record is one JSON file: the settings, the history, and where the state's
tables and φ files are.  It is written under another name and renamed, which
the file system does as a whole, and the tables of the iteration before are
deleted only after that.  So at any moment the newest record names a complete
state, whatever was lost in between.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from topic_tables.session import open_bucketed

RECORD = re.compile(r"iteration-(\d+)\.json$")


class Run:
    def __init__(self, spark: SparkSession, folder: str, settings: dict):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.settings = json.loads(json.dumps(settings))
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def record(self, done: int, history: list, state) -> None:
        tables = {}
        for name in ("rows_table", "theta_table", "passed", "hot"):
            table = getattr(state, name)
            if table is not None:
                tables[name] = {"path": table._tt_path, "schema": table.schema.json(), "buckets": getattr(table, "_tt_buckets", None)}
        files = {k: v for k, v in state.files.__dict__.items() if k != "_held"}
        text = json.dumps({"settings": self.settings, "done": done, "history": history, "tables": tables, "files": files})
        name, hidden = f"{self.folder}/iteration-{done:05d}.json", f"{self.folder}/.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(hidden))
        out.write(bytearray(text.encode()))
        out.close()
        self._fs.delete(self._path(name), False)
        if not self._fs.rename(self._path(hidden), self._path(name)):
            raise OSError(f"could not record an iteration as {name}")

    def last(self):
        """(iterations done, history, tables, φ files) of the newest record, or
        None.  Records of a fit with other settings are refused."""
        if not self._fs.exists(self._path(self.folder)):
            return None
        found = {}
        for status in self._fs.listStatus(self._path(self.folder)):
            m = RECORD.search(status.getPath().getName())
            if m:
                found[int(m.group(1))] = status.getPath().toString()
        if not found:
            return None
        got = json.loads(self.spark.read.text(found[max(found)], wholetext=True).first()[0])
        if got["settings"] != self.settings:
            raise ValueError(f"{self.folder} records a fit with other settings: {got['settings']}")
        tables = {}
        for name, t in got["tables"].items():
            schema = StructType.fromJson(json.loads(t["schema"]))
            if t["buckets"]:
                tables[name] = open_bucketed(self.spark, t["path"], schema, ["row_id", "part"], t["buckets"])
            else:
                tables[name] = self.spark.read.schema(schema).parquet(t["path"])
                tables[name]._tt_path = t["path"]
        return got["done"], [tuple(h) for h in got["history"]], tables, got["files"]

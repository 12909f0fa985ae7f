"""Versions of a set of tables: which folders each table consists of, in one small file per committed run.

Data folders are written first and named by nobody; the commit file then appears whole or not at all. A reader takes the newest
commit, so a run that dies leaves the version before it readable, and of two runs that start from one version the second fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Commit:
    """tables: by name, the schema as JSON and the folders by part (a year, or '' for a whole table)."""

    version: int = 0
    tables: dict[str, dict] = field(default_factory=dict)
    marks: dict[str, object] = field(default_factory=dict)

    def folders(self, name: str) -> dict[str, str]:
        return self.tables.get(name, {}).get("folders", {})


class ConflictError(RuntimeError):
    """Another run has committed this version."""


class Commits:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        fs = path.getFileSystem(self._conf)
        return [status.getPath().getName() for status in fs.listStatus(path)] if fs.exists(path) else []

    def versions(self) -> list[int]:
        names = self._names(f"{self.root}/commits")
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith("."))

    def at(self, version: int) -> Commit:
        text = self.spark.read.option("wholetext", True).text(f"{self.root}/commits/{version:010d}.json").first()[0]
        return Commit(**json.loads(text))

    def latest(self) -> Commit:
        """The newest version; one without tables if there is none."""
        known = self.versions()
        return self.at(known[-1]) if known else Commit()

    def commit(self, new: Commit) -> None:
        text = json.dumps({"version": new.version, "tables": new.tables, "marks": new.marks})
        draft = self._path(f"{self.root}/commits/.{uuid.uuid4().hex}")
        out = draft.getFileSystem(self._conf).create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        # Without an option to overwrite, a rename onto a commit fails.
        none = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
        try:
            files.rename(draft, self._path(f"{self.root}/commits/{new.version:010d}.json"), none)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception):
                raise ConflictError(f"version {new.version} is there already") from error
            raise

    def new_folder(self, name: str) -> str:
        return f"{self.root}/data/{name}/{uuid.uuid4().hex}"

    def parts(self, folder: str, column: str) -> dict[str, str]:
        """The folders that a write partitioned by column has made, by value."""
        names = [name for name in self._names(folder) if name.startswith(f"{column}=")]
        return {name.removeprefix(f"{column}="): f"{folder}/{name}" for name in names}

    def read(self, commit: Commit, name: str, parts: set[str] | None = None) -> DataFrame | None:
        """A table, or some of its parts, as of a commit; None for a table that it does not have."""
        if name not in commit.tables:
            return None
        folders = [folder for part, folder in commit.folders(name).items() if parts is None or part in parts]
        schema = T.StructType.fromJson(json.loads(commit.tables[name]["schema"]))
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def expire(self, keep: int = 2) -> list[str]:
        """Drop all but the newest versions, and the folders that only dropped ones name; gives these folders."""
        old, kept = self.versions()[:-keep], self.versions()[-keep:]
        used = {folder for v in kept for name in self.at(v).tables for folder in self.at(v).folders(name).values()}
        unused = sorted({folder for v in old for name in self.at(v).tables for folder in self.at(v).folders(name).values()} - used)
        for name in [*unused, *(f"{self.root}/commits/{v:010d}.json" for v in old)]:
            path = self._path(name)
            path.getFileSystem(self._conf).delete(path, True)
        return unused

"""Publishing a run's tables: written down first, then done, and done again after a failure.

A run writes all its rows to a folder of its own.  Only when every table is there does it write a manifest: the
files that come into each target folder, and the files that go from it.  Publishing follows the manifest; each of
its steps may be repeated.  So a run that dies before its manifest leaves the targets untouched, and one that dies
later is finished by ``recover`` -- every job calls it first.

Replacing rows rewrites the files that hold some of them: rows of those files that are not replaced (rows with a
null key included) are written anew beside the run's own rows, and the old files go.  Other files stay as they are.
"""

from __future__ import annotations

import json
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "manifest.json"


class Folder:
    """Files of any store that Spark can reach, by names relative to one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._path(name))

    def folders(self) -> list[str]:
        if not self.exists():
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path("")) if s.isDirectory())

    def files(self) -> list[str]:
        """Data files below the folder."""
        if not self.exists():
            return []
        base = bare(self.fs.makeQualified(self._path("")).toString())
        found, entries = [], self.fs.listFiles(self._path(""), True)
        while entries.hasNext():
            name = bare(entries.next().getPath().toString())[len(base) + 1:]
            if not any(part.startswith(("_", ".")) for part in name.split("/")):
                found.append(name)
        return sorted(found)

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The whole file appears at once, or not at all."""
        stream = self.fs.create(self._path(f"_{name}.new"), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.fs.rename(self._path(f"_{name}.new"), self._path(name)):
            raise OSError(f"cannot write {self.root}/{name}")

    def delete(self, name: str = "") -> None:
        self.fs.delete(self._path(name), True)

    def drop_empty(self, name: str) -> None:
        """Delete a folder in which nothing is left."""
        if name and self.exists(name) and not self.fs.listStatus(self._path(name)):
            self.delete(name)

    def move_to(self, name: str, target: Folder, to: str) -> None:
        """Move one file; a file that has been moved before is left alone."""
        if not self.exists(name):
            if not target.exists(to):
                raise FileNotFoundError(f"{self.root}/{name} is gone and not in {target.root}")
            return
        target.fs.mkdirs(target._path(to).getParent())
        if not self.fs.rename(self._path(name), target._path(to)):
            raise OSError(f"cannot move {self.root}/{name} to {target.root}/{to}")


def bare(uri: str) -> str:
    """A path without scheme and host."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", uri)


def replaced_files(old: DataFrame, target: str, replaced: Column) -> list[str]:
    """Names below target of the files of old that hold a row to replace (a list of files, never of rows)."""
    rows = old.where(replaced).select(F.input_file_name().alias("f")).distinct().collect()
    base = bare(target).rstrip("/")
    return sorted(unquote(bare(r["f"]))[len(base) + 1:] for r in rows)


def kept_rows(spark: SparkSession, target: str, files: list[str], replaced: Column) -> DataFrame:
    """The rows of these files that stay; a null in the condition keeps its row."""
    df = (spark.read.option("basePath", target).option("mergeSchema", "true")
          .parquet(*[f"{target.rstrip('/')}/{f}" for f in files]))
    return df.where(~F.coalesce(replaced, F.lit(False)))


def stage(spark: SparkSession, target: str, staged: list[str], remove: list[str]) -> dict:
    """A manifest entry: the files of the staged folders come into target, the named ones go."""
    return {"target": target, "remove": remove,
            "add": [{"from": folder, "files": Folder(spark, folder).files()} for folder in staged]}


def commit(spark: SparkSession, run_folder: str, entries: dict) -> None:
    """From here on the run counts: whatever happens next, its manifest is carried out."""
    Folder(spark, run_folder).write(MANIFEST, json.dumps(entries))


def publish_files(spark: SparkSession, entry: dict) -> None:
    target = Folder(spark, entry["target"])
    for name in entry["remove"]:
        target.delete(name)
    for part in entry["add"]:
        staged = Folder(spark, part["from"])
        for name in part["files"]:
            staged.move_to(name, target, name)
    for folder in {name.rpartition("/")[0] for name in entry["remove"]}:
        target.drop_empty(folder)


def committed_runs(spark: SparkSession, runs_folder: str) -> list[tuple[str, dict]]:
    """Folders and manifests of runs that were committed and not finished."""
    runs = Folder(spark, runs_folder)
    return [(f"{runs.root}/{r}", json.loads(runs.read(f"{r}/{MANIFEST}"))) for r in runs.folders()
            if runs.exists(f"{r}/{MANIFEST}")]


def drop_uncommitted(spark: SparkSession, runs_folder: str) -> list[str]:
    """Delete what runs without a manifest left; call it only when no other run is at work."""
    runs = Folder(spark, runs_folder)
    gone = [r for r in runs.folders() if not runs.exists(f"{r}/{MANIFEST}")]
    for r in gone:
        runs.delete(r)
    return gone

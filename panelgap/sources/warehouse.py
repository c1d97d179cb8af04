"""A warehouse folder whose loads appear whole or not at all.

The reference deletes and refills its tables inside one transaction.  Here a load writes
its tables as Parquet into folders of its own, ``data/<load>/<table>``, where no reader
looks, and last of all renames one manifest folder into place, ``manifests/v00000007``.
The manifest names, for every table, its schema and the folders that hold it.  Readers
resolve the newest manifest, so they see all tables of one load; a load that is killed
midway leaves the one before as it was, with nothing to clean up first.

A load may refresh single partitions: the new manifest then points at the new folders of
these and the old folders of all others, so nothing else is rewritten.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .sinks import round_doubles

_VERSION = "v{:08d}"


class LoadConflict(RuntimeError):
    """Another load was committed in the meantime."""


class Warehouse:
    """Versioned tables under ``root``, a folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- file system of the cluster, not of the driver's machine

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        fs, path = self._fs(), self._path(*parts)
        return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []

    # -- versions

    def versions(self) -> list[int]:
        return [int(n[1:]) for n in self._names("manifests") if n.startswith("v")]

    def manifest(self, version: int | None = None) -> dict:
        """Tables of a version, by default of the newest; none before the first load."""
        known = self.versions()
        if version is None:
            if not known:
                return {}
            version = known[-1]
        elif version not in known:
            raise ValueError(f"no version {version} under {self.root}")
        rows = self.spark.read.text(f"{self.root}/manifests/{_VERSION.format(version)}", wholetext=True).collect()
        return json.loads(rows[0][0])["tables"]

    def _commit(self, version: int, tables: dict) -> None:
        """The one step that makes a load visible: a rename that fails if the version is taken."""
        draft = f"drafts/{uuid.uuid4().hex}"
        text = json.dumps({"version": version, "tables": tables}, sort_keys=True)
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{self.root}/{draft}")
        jvm, source, target = self.spark._jvm, self._path(draft), self._path("manifests", _VERSION.format(version))
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), self.spark._jsc.hadoopConfiguration()) \
            if source.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.spark._jsc.hadoopConfiguration())
        self._fs().mkdirs(self._path("manifests"))
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        none = self.spark.sparkContext._gateway.new_array(rename, 0)
        if self._fs().exists(target):
            raise LoadConflict(f"version {version} of {self.root} is there already")
        try:
            files.rename(source, target, none)
        except Exception as e:  # the file system refuses to replace a manifest
            if self._fs().exists(target):
                raise LoadConflict(f"version {version} of {self.root} is there already") from e
            raise

    # -- loads

    def load(self, tables: Mapping[str, DataFrame], partition_by: Mapping[str, Sequence[str]] | None = None,
             digits: int | None = 4, only_partitions: bool = False) -> int:
        """Writes ``tables`` and commits them together; returns the new version.

        Tables that are not given stay as they are.  With ``only_partitions``, a given table keeps
        the partitions that the new rows don't touch.  Doubles are stored with ``digits`` places.
        """
        partition_by = partition_by or {}
        known = self.versions()
        version = 1 + (known[-1] if known else 0)
        manifest, load = self.manifest(known[-1]) if known else {}, f"{version:08d}-{uuid.uuid4().hex[:8]}"
        fresh = {}
        for name, df in tables.items():
            out = round_doubles(df, digits) if digits is not None else df
            keys, old = list(partition_by.get(name, ())), manifest.get(name)
            if only_partitions and old:
                if not keys:
                    keys = old["partition_by"]
                if not keys or keys != old["partition_by"] or T.StructType.fromJson(json.loads(old["schema"])) != _nullable(out.schema):
                    raise ValueError(f"{name}: a refresh of partitions needs the columns and partitions of the table")
            folder = f"data/{load}/{name}"
            writer = out.write.partitionBy(*keys) if keys else out.write
            writer.parquet(f"{self.root}/{folder}")
            parts = [f"{folder}/{p}" for p in self._partitions(folder, len(keys))] if keys else [folder]
            if only_partitions and old:
                new = {_below(p) for p in parts}
                parts += [p for p in old["parts"] if _below(p) not in new]
            fresh[name] = {"schema": _nullable(out.schema).json(), "partition_by": keys, "parts": sorted(parts)}
        self._commit(version, manifest | fresh)
        return version

    def _partitions(self, folder: str, depth: int) -> list[str]:
        found = [""]
        for _ in range(depth):
            found = [f"{p}/{n}".strip("/") for p in found for n in self._names(folder, *([p] if p else [])) if "=" in n]
        return found

    def drop(self, *names: str) -> int:
        """A version without these tables."""
        known = self.versions()
        manifest = self.manifest()
        self._commit(1 + (known[-1] if known else 0), {n: t for n, t in manifest.items() if n not in names})
        return 1 + (known[-1] if known else 0)

    # -- readers

    def tables(self, version: int | None = None) -> list[str]:
        return sorted(self.manifest(version))

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table as of a version.  Partitions keep the type of their column."""
        found = self.manifest(version).get(name)
        if found is None:
            raise KeyError(f"{name} is no table of {self.root}")
        schema = T.StructType.fromJson(json.loads(found["schema"]))
        if not found["partition_by"]:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{found['parts'][0]}")
        bases: dict[str, list[str]] = {}
        for p in found["parts"]:
            bases.setdefault("/".join(p.split("/")[:3]), []).append(f"{self.root}/{p}")
        out = self.spark.createDataFrame([], schema) if not bases else None
        for base, paths in bases.items():  # a scan for each load that still holds partitions
            one = self.spark.read.schema(schema).option("basePath", f"{self.root}/{base}").parquet(*paths).select(schema.names)
            out = one if out is None else out.unionByName(one)
        return out

    def folder(self, name: str, version: int | None = None) -> str:
        """The folder of a table that one load wrote as a whole."""
        bases = {"/".join(p.split("/")[:3]) for p in self.manifest(version)[name]["parts"]}
        if len(bases) != 1:
            raise ValueError(f"{name} has partitions of {len(bases)} loads")
        return f"{self.root}/{bases.pop()}"

    def register(self, version: int | None = None) -> list[str]:
        """Every table as a temporary view of its name, all of one version."""
        known = self.versions()
        version = version if version is not None else (known[-1] if known else None)
        names = self.tables(version)
        for n in names:
            self.read(n, version).createOrReplaceTempView(n)
        return names

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes manifests but the newest ``keep`` and the folders that none of these names; not while
        a load or a reader of an older version is at work."""
        known, fs = self.versions(), self._fs()
        for v in known[:-keep] if keep else known:
            fs.delete(self._path("manifests", _VERSION.format(v)), True)
        used = {p for v in self.versions() for t in self.manifest(v).values() for p in t["parts"]}
        gone = []
        for load in self._names("data"):
            for table in self._names("data", load):
                folder = f"data/{load}/{table}"
                if not any(p == folder or p.startswith(f"{folder}/") for p in used):
                    fs.delete(self._path(folder), True)
                    gone.append(folder)
            if not self._names("data", load):
                fs.delete(self._path("data", load), True)
        fs.delete(self._path("drafts"), True)
        return gone


def _below(part: str) -> str:
    """Partition values of a folder ``data/<load>/<table>/<values>``."""
    return "/".join(part.split("/")[3:])


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])

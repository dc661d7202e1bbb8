"""Versioned shards with size-tiered compaction.

A store is a folder of immutable runs (Parquet files) and a folder of
manifests, one for each version. ``append`` writes the rows of one arrival as
small shards straight from the tasks that hold them, without a shuffle.
``compact`` groups runs of similar size (the same power of ``fanout``) and,
where ``fanout`` or more meet, rewrites them as one run of target-sized files.
Every change ends with one commit: the new manifest is written beside the
others under a temporary name and renamed to its version number, which fails
if another writer took that number, so readers see the old version or the new.

Sizes are bytes of files. A merge puts whole input splits together until they
have the target size, without a shuffle, so a source with a third of all rows
makes more files, not larger ones, and no task reads much more than the target.
A manifest names every file with its size, and the schema; it grows with the
number of files (corpus size over target size), not with rows. Readers open the
files that their version names and list no folder.

A lost executor's tasks are redone by Spark's committer, and a writer that dies
before its commit leaves files that no manifest names; ``vacuum`` removes them
and those of old versions, of which it keeps the last two, so that a reader who
opened the version before a compaction can finish.

Edge cases: rows of any schema, nulls and repeats are kept as they are; an
empty arrival commits a version without a new run; an empty store reads as an
empty table of the given schema.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class File:
    path: str
    bytes: int


@dataclass(frozen=True)
class Run:
    level: int
    files: tuple[File, ...]

    @property
    def bytes(self) -> int:
        return sum(f.bytes for f in self.files)


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    runs: tuple[Run, ...] = field(default_factory=tuple)
    schema: str | None = None


class ShardStore:
    """Shards under ``root``, a path that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 128 << 20, fanout: int = 4, tier_bytes: int = 1 << 20):
        self.spark, self.root = spark, root.rstrip("/")
        self.target_bytes, self.fanout, self.tier_bytes = target_bytes, fanout, tier_bytes
        self._fs_api = spark._jvm.org.apache.hadoop.fs
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, text: str):
        return self._fs_api.Path(text)

    def _files(self, path: str) -> tuple[File, ...]:
        """The data files of a folder that was just written."""
        found = [(f.getPath(), f.getLen()) for f in self._fs.listStatus(self._path(path)) if f.isFile()]
        return tuple(File(p.toString(), int(n)) for p, n in sorted(found, key=lambda x: x[0].getName()) if p.getName().startswith("part-"))

    # -- manifests

    def versions(self) -> list[int]:
        at = self._path(f"{self.root}/manifests")
        if not self._fs.exists(at):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(at)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        found = self.versions()
        if not found and version is None:
            return Manifest()
        text = self.spark.read.option("wholetext", True).text(self._manifest_path(found[-1] if version is None else version)).head()[0]
        read = json.loads(text)
        return Manifest(read["version"], tuple(Run(r["level"], tuple(File(**f) for f in r["files"])) for r in read["runs"]), read["schema"])

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/v{version:08d}.json"

    def commit(self, old: Manifest, runs: list[Run], schema: str | None = None) -> Manifest:
        """The next version, or an error if another writer has it."""
        new = Manifest(old.version + 1, tuple(runs), schema or old.schema)
        draft, final = f"{self.root}/manifests/.{uuid.uuid4().hex}", self._manifest_path(new.version)
        out = self._fs.create(self._path(draft), False)
        out.write(bytearray(json.dumps(asdict(new)).encode()))
        out.close()
        context = self._fs_api.FileContext.getFileContext(self._path(self.root).toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(self._fs_api.Options.Rename, 0)
        context.rename(self._path(draft), self._path(final), options)  # does not overwrite
        return new

    # -- writing

    def _write(self, df: DataFrame, level: int) -> Run | None:
        path = f"{self.root}/runs/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        files = self._files(path)
        return Run(level, files) if files else None

    def append(self, rows: DataFrame) -> Manifest:
        """One arrival as one run of small shards."""
        old = self.manifest()
        run = self._write(rows, 0)
        return self.commit(old, [*old.runs, *([run] if run else [])], rows.schema.json())

    def append_arrivals(self, rows: DataFrame, arrival: Column) -> Manifest:
        """Arrivals that lie in one table, in order: their files are written in
        one pass, and each is appended as a version of its own, with the
        compaction and the vacuum that it calls for."""
        path = f"{self.root}/runs/{uuid.uuid4().hex}"
        named = "_arrival"
        while named in rows.columns:
            named = f"_{named}"
        rows.withColumn(named, arrival).write.partitionBy(named).option("compression", "zstd").parquet(path)
        folders = [d.getPath().toString() for d in self._fs.listStatus(self._path(path)) if d.isDirectory() and "=" in d.getPath().getName()]
        key = lambda p: (len(p), p)  # noqa: E731  numbers in order
        for folder in sorted(folders, key=key):
            old = self.manifest()
            self.commit(old, [*old.runs, Run(0, self._files(folder))], rows.schema.json())
            if self.compact().version > old.version + 1:
                self.vacuum(pending=path)
        if not folders:
            self.commit(self.manifest(), list(self.manifest().runs), rows.schema.json())
        return self.manifest()

    # -- compaction

    def tier(self, run: Run) -> int:
        return max(0, math.floor(math.log(max(run.bytes, 1) / self.tier_bytes, self.fanout)))

    def plan(self, runs: tuple[Run, ...]) -> list[list[Run]]:
        """Groups of ``fanout`` or more runs of one tier, smallest tier first; runs of a full tier merge together."""
        tiers: dict[int, list[Run]] = {}
        for r in runs:
            tiers.setdefault(self.tier(r), []).append(r)
        return [group for _, group in sorted(tiers.items()) if len(group) >= self.fanout]

    def compact(self, until_stable: bool = True) -> Manifest:
        """Merge full tiers, one commit for each merge, until none is full."""
        now = self.manifest()
        while groups := self.plan(now.runs):
            group = groups[0]
            files = max(1, math.ceil(sum(r.bytes for r in group) / self.target_bytes))
            # Input splits are put together where they are: no shuffle, whatever the keys are.
            merged = self._write(self.read_runs(group, now.schema).coalesce(files), max(r.level for r in group) + 1)
            gone = set(group)
            now = self.commit(now, [*[r for r in now.runs if r not in gone], *([merged] if merged else [])])
            if not until_stable:
                break
        return now

    def vacuum(self, keep: int = 2, pending: str | None = None) -> None:
        """Delete run files that none of the last ``keep`` versions names; those
        below ``pending`` that no version has named yet stay."""
        versions = self.versions()
        kept = {self._local(f.path) for v in versions[-keep:] for r in self.manifest(v).runs for f in r.files}
        old = {self._local(f.path) for v in versions[:-keep] for r in self.manifest(v).runs for f in r.files}
        for run in self._fs.listStatus(self._path(f"{self.root}/runs")):
            waits = pending is not None and self._local(run.getPath().toString()) == self._local(pending)
            files = self._fs.listFiles(run.getPath(), True)
            gone, left = [], 0
            while files.hasNext():
                path = files.next().getPath()
                if not path.getName().startswith("part-"):
                    continue
                local = self._local(path.toString())
                if local in kept or (waits and local not in old):
                    left += 1
                else:
                    gone.append(path)
            for path in gone:
                self._fs.delete(path, False)
            if not left:
                self._fs.delete(run.getPath(), True)

    @staticmethod
    def _local(path: str) -> str:
        return path.split(":", 1)[-1].lstrip("/")

    # -- reading

    def read_runs(self, runs: list[Run] | tuple[Run, ...], schema: str) -> DataFrame:
        """Files of runs, by their names; folders of arrivals add no column."""
        paths = [f.path for r in runs for f in r.files]
        return self.spark.read.schema(StructType.fromJson(json.loads(schema))).option("recursiveFileLookup", True).parquet(*paths)

    def read(self, version: int | None = None, schema: str | None = None) -> DataFrame:
        """The rows of a version, as they arrived."""
        now = self.manifest(version)
        if not now.runs:
            if schema is None and now.schema is None:
                raise ValueError("an empty store needs a schema")
            return self.spark.createDataFrame([], schema or StructType.fromJson(json.loads(now.schema)))
        return self.read_runs(now.runs, now.schema)

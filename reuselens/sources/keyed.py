"""A stored table with a key: upserts, toggles and replaced runs as small files, committed as whole versions.

A version is a list of folders: one with the merged rows and, in order, those
of the changes since. Readers take one version, so they never see half a
change; rows that no change touches are read as they are, the others are folded
by key. A writer whose version another one has taken fails, and tries again on
top of that one. Files lie in buckets of the key, so a look-up reads few.
"""

from __future__ import annotations

import json
import threading
import uuid
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

_OPERATIONS = ("put", "add", "drop", "toggle")
_renames = threading.Lock()  # writers of one driver; between drivers the file system's rename refuses a name that is taken


class Conflict(RuntimeError):
    """Another writer has committed the version that was to be made."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    base: str | None = None
    changes: tuple[str, ...] = ()


class KeyedTable:
    """Rows of ``schema`` below ``path``, one for each value of ``keys``, which are never null.

    Changes are merged into new base files once there are ``compact_after`` of
    them, so what is folded for a key is bounded.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: int = 16, compact_after: int = 8) -> None:
        self.spark, self.path, self.schema, self.keys, self.buckets, self.compact_after = spark, path.rstrip("/"), schema, keys, buckets, compact_after
        self._api = spark._jvm.org.apache.hadoop.fs
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._api.Path(f"{self.path}/{name}" if name else self.path)

    # -- versions

    def _numbers(self) -> list[int]:
        if not self._fs.exists(self._at("versions")):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at("versions"))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def version(self, number: int | None = None) -> Version:
        """A version, the last one if none is named; an empty one before the first commit."""
        if number is None:
            held = self._numbers()
            if not held:
                return Version()
            number = held[-1]
        stream = self._fs.open(self._at(f"versions/{number:08d}.json"))
        try:
            found = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(found["number"], found["base"], tuple(found["changes"]))

    def commit(self, old: Version, base: str | None, changes: tuple[str, ...]) -> Version:
        """The version after ``old``; :class:`Conflict` if another writer has it."""
        new = Version(old.number + 1, base, changes)
        draft, final = self._at(f"versions/.{uuid.uuid4().hex}"), self._at(f"versions/{new.number:08d}.json")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(asdict(new)).encode()))
        out.close()
        context = self._api.FileContext.getFileContext(self._at("").toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self._api.Options.Rename, 0)
        with _renames:
            try:
                context.rename(draft, final, none)  # refuses a name that is taken
            except Exception as e:
                self._fs.delete(draft, False)
                if self._fs.exists(final):
                    raise Conflict(f"version {new.number} is another writer's") from e
                raise
        return new

    # -- writing

    def _write(self, rows: DataFrame) -> str:
        name = f"data/{uuid.uuid4().hex}"
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        rows.withColumn("_bucket", bucket).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{name}")
        return name

    def _change(self, rows: DataFrame, operation: str, order: str | None) -> DataFrame:
        """One row for each key: the last by ``order``; of toggles those of an odd number."""
        if operation not in _OPERATIONS:
            raise ValueError(f"no operation {operation}")
        columns = self.schema.names
        held = rows.select(*[F.col(f"`{c}`") if c in rows.columns else F.lit(None).alias(c) for c in columns], (F.col(order) if order else F.lit(0)).alias("_order"))
        if held.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])).limit(1).count():
            raise ValueError("null keys")
        last = F.max_by(F.struct(*columns), F.struct("_order")).alias("_row")  # a null order comes first
        one = held.groupBy(*[F.col(k).alias(f"_{k}") for k in self.keys]).agg(last, F.count("*").alias("_n"))
        if operation == "toggle":
            one = one.where("_n % 2 = 1")
        cast = [F.col(f"_row.{f.name}").cast(f.dataType).alias(f.name) for f in self.schema.fields]
        return one.select(*cast, F.lit(operation).alias("_operation"))

    def apply(self, rows: DataFrame, operation: str = "put", order: str | None = None, tries: int = 20) -> Version:
        """Commit a change of all keys of ``rows``; what it does doesn't depend on the version it comes on top of.

        ``put`` replaces or adds, ``add`` leaves what is there, ``drop``
        removes, ``toggle`` removes what is there and else adds. Of several
        rows of a key the last by ``order`` counts.
        """
        name = self._write(self._change(rows, operation, order))
        for left in reversed(range(tries)):
            old = self.version()
            try:
                new = self.commit(old, old.base, (*old.changes, name))
                break
            except Conflict:
                if not left:
                    raise
        return self.compact() if len(new.changes) >= self.compact_after else new

    def replace(self, rows: DataFrame, column: str, values: list, tries: int = 20) -> Version:
        """All rows with one of ``values`` in ``column`` give way to ``rows``, in one version."""
        for left in reversed(range(tries)):
            old = self.version()
            gone = self.read(old).where(F.col(column).isin(*values)).join(rows.select(*self.keys), self.keys, "left_anti")
            name = self._write(self._change(rows, "put", None).unionByName(self._change(gone, "drop", None)))
            try:
                return self.commit(old, old.base, (*old.changes, name))
            except Conflict:
                self._fs.delete(self._at(name), True)
                if not left:
                    raise
        raise Conflict("no try allowed")

    def compact(self) -> Version:
        """Merge the changes into base files; changes that come meanwhile stay changes. Gives way to another writer's compaction."""
        old = self.version()
        name = self._write(self.read(old))
        while True:
            now = self.version()
            if now.base != old.base:
                self._fs.delete(self._at(name), True)
                return now
            try:
                return self.commit(now, name, now.changes[len(old.changes) :])
            except Conflict:
                continue

    def vacuum(self, keep: int = 2, older_than_ms: int = 86_400_000) -> None:
        """Delete versions but the last ``keep``, and files that none of those names and that are older than a writer may take."""
        numbers = self._numbers()
        held = {n for v in map(self.version, numbers[-keep:]) for n in (v.base, *v.changes) if n}
        now = self.spark._jvm.java.lang.System.currentTimeMillis()
        for s in self._fs.listStatus(self._at("data")) if self._fs.exists(self._at("data")) else []:
            if f"data/{s.getPath().getName()}" not in held and s.getModificationTime() <= now - older_than_ms:
                self._fs.delete(s.getPath(), True)
        for n in numbers[:-keep]:
            self._fs.delete(self._at(f"versions/{n:08d}.json"), False)

    # -- reading

    def _stored(self, name: str, changes: bool, buckets: list[int] | None) -> DataFrame:
        extra = [StructField("_operation", StringType())] if changes else []
        wide = StructType([*self.schema.fields, *extra, StructField("_bucket", IntegerType())])
        found = self.spark.read.schema(wide).parquet(f"{self.path}/{name}")
        return (found if buckets is None else found.where(F.col("_bucket").isin(*buckets))).drop("_bucket")

    def read(self, version: Version | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of a version, the last one if none is named."""
        at = self.version() if version is None else version
        none = self.spark.createDataFrame([], self.schema)
        base = self._stored(at.base, False, buckets) if at.base else none
        if not at.changes:
            return base
        changes = reduce(DataFrame.unionByName, [self._stored(n, True, buckets).withColumn("_at", F.lit(k)) for k, n in enumerate(at.changes)])
        touched = changes.select(*self.keys).distinct()
        whole = changes.unionByName(base.join(touched, self.keys, "left_semi").select(*self.schema.names, F.lit("put").alias("_operation"), F.lit(-1).alias("_at")))
        entry = F.struct(F.col("_at").alias("at"), F.col("_operation").alias("operation"), F.struct(*self.schema.names).alias("row"))
        listed = F.array_sort(F.collect_list(entry), lambda a, b: a["at"] - b["at"])  # one a change
        blank = F.lit(None).cast(self.schema)

        def folded(row, e):
            op = e["operation"]
            return F.when(op == "put", e["row"]).when(op == "add", F.coalesce(row, e["row"])).when((op == "toggle") & row.isNull(), e["row"]).otherwise(blank)

        kept = whole.groupBy(*[F.col(k).alias(f"_{k}") for k in self.keys]).agg(F.aggregate(listed, blank, folded).alias("_row")).where("_row is not null")
        return base.join(touched, self.keys, "left_anti").unionByName(kept.select("_row.*"))

    def lookup(self, wanted: DataFrame, version: Version | None = None) -> DataFrame:
        """The rows of the keys in ``wanted``; only the buckets that these lie in are read."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        keys = wanted.select(*[F.col(k).cast(self.schema[k].dataType).alias(k) for k in self.keys]).distinct()
        asked = [r[0] for r in keys.select(bucket).distinct().collect()]  # at most one a bucket
        return self.read(version, asked or [-1]).join(keys, self.keys, "left_semi")

"""Reading input tables; all cells of text formats stay text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.ordering import global_index
from .workbooks import read_sheet

BOM = "﻿"


def _clean_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.removeprefix(BOM).strip().strip('"') for c in df.columns])


def read_delimited(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """A file with a header line, every column a string, without a byte-order mark; quoted cells may hold line ends."""
    options = {"header": True, "sep": sep, "encoding": encoding, "inferSchema": False, "multiLine": True, "quote": '"', "escape": '"'}
    return _clean_header(spark.read.options(**options).csv(path))


def is_utf8(spark: SparkSession, path: str) -> bool:
    """Whether every line of the file is valid UTF-8."""
    return spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1).count() == 0


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table by the suffix of its path: csv, txt, tsv (UTF-8, or else GBK), xlsx, xlsm (the first sheet with rows), parquet, json or orc.

    Reading GBK turns the session's setting for Java's character sets on.
    """
    suffix = path.rstrip("/").rpartition(".")[2].lower()
    if suffix in ("csv", "txt", "tsv"):
        encoding = "UTF-8" if is_utf8(spark, path) else "GBK"
        if encoding == "GBK":
            spark.conf.set("spark.sql.legacy.javaCharsets", "true")
        return read_delimited(spark, path, "\t" if suffix == "tsv" else ",", encoding)
    if suffix in ("xlsx", "xlsm"):
        return read_sheet(spark, path)
    if suffix in ("parquet", "json", "orc"):
        return getattr(spark.read, suffix)(path)
    raise ValueError(f"no reader for .{suffix}")


def read_samples(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Sample files as one table of ``(user_id, sample_group, source_file)``; the file's name is the group where there is none."""
    out = None
    for path in paths:
        name = path.rstrip("/").rpartition("/")[2].rpartition(".")[0]
        df = read_table(spark, path)
        group = F.coalesce(F.nullif(F.trim("sample_group"), F.lit("")), F.lit(name)) if "sample_group" in df.columns else F.lit(name)
        one = df.select(F.trim(F.col("user_id").cast("string")).alias("user_id"), group.alias("sample_group"), F.lit(name).alias("source_file")).where("user_id <> ''")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no sample file")
    return out


def newest_file(spark: SparkSession, folder: str, patterns: tuple[str, ...] = ("annotated_w*.csv", "annotated_*.csv")) -> str | None:
    """The last file of a folder by name that the first of ``patterns`` with any match gives; None where none has one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for pattern in patterns:
        found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, pattern)) or []
        if names := sorted(s.getPath().toString() for s in found):
            return names[-1]
    return None


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file that begin with ``http``, outer blanks aside."""
    return spark.read.text(path).select(F.trim("value").alias("url")).where(F.startswith("url", F.lit("http")))


def candidates(df: DataFrame, prefix: str, order: str, url: str = "qualification_url") -> DataFrame:
    """Rows with an http url and ``candidate_id``: the prefix and the row's place among all rows, bad ones included."""
    placed = global_index(df, [F.asc(order)], "_i")
    return placed.withColumn("candidate_id", F.concat(F.lit(f"{prefix}-"), F.col("_i"))).where(F.startswith(url, F.lit("http"))).drop("_i")


def latest_partition(df: DataFrame, column: str = "dtm", since: str | None = None) -> str | None:
    """The greatest value of a partition column, from ``since`` on."""
    rows = df if since is None else df.where(F.col(column) >= since)
    return rows.agg(F.max(column)).first()[0]


def first_filled_partition(df: DataFrame, wanted: list[str], column: str = "dtm") -> str | None:
    """The first of ``wanted`` partitions that has a row, by one query over those alone."""
    held = {r[0] for r in df.where(F.col(column).isin(*wanted)).select(column).distinct().collect()}  # len(wanted) at most
    return next((w for w in wanted if w in held), None)


def fetch_targets(images: DataFrame, ids: DataFrame, pool: tuple[str, str] | None = None) -> DataFrame:
    """Images of the asked accounts and of a window of days, each account and url once, ``is_target_user`` if asked for."""
    asked = images.join(ids.select("user_id").distinct(), "user_id", "left_semi").withColumn("is_target_user", F.lit(True))
    if pool is not None:
        asked = asked.unionByName(images.where(F.col("settle_date").between(*pool)).withColumn("is_target_user", F.lit(False)))
    rest = [c for c in images.columns if c not in ("user_id", "qualification_url")]
    one = F.max(F.struct("is_target_user", *rest)).alias("_r")
    return asked.groupBy("user_id", "qualification_url").agg(one).select("user_id", "qualification_url", "_r.*")


def joined_chunks(chunks: DataFrame) -> DataFrame:
    """Uploads from base64 chunks ``(upload_id, index, chunk)``, in order, as bytes."""
    parts = F.array_sort(F.collect_list(F.struct("index", "chunk")))
    text = F.array_join(F.transform(parts, lambda p: p["chunk"]), "")
    return chunks.groupBy("upload_id").agg(F.unbase64(text).alias("content"))


def read_pipe_table(spark: SparkSession, path: str) -> DataFrame:
    """A text table with ``|`` between cells: the first such line is the header, rules of dashes fall out, cells are trimmed text."""
    lines = global_index(spark.read.text(path).withColumn("_at", F.monotonically_increasing_id()).where(F.startswith("value", F.lit("|"))), [F.asc("_at")], "_n")
    cells = F.transform(F.split(F.regexp_replace("value", r"^\|+|\|+$", ""), r"\|"), lambda c: F.trim(c))
    head = lines.where("_n = 0").select(cells.alias("c")).first()  # one line
    if head is None:
        raise ValueError("no table")
    body = lines.where("_n > 0").where(~F.contains("value", F.lit("---"))).select(cells.alias("c"))
    return body.select(*[F.try_element_at("c", F.lit(k + 1)).alias(name) for k, name in enumerate(head["c"])])


def read_upload(spark: SparkSession, path: str) -> DataFrame:
    """An upload with a header line; header and cells are trimmed text."""
    raw = read_table(spark, path)
    return raw.select(*[F.trim(F.col(f"`{c}`").cast("string")).alias(c.strip()) for c in raw.columns])

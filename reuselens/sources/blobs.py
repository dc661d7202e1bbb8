"""Images and artifacts as rows of bytes: reading, a cache by content key, and a store by run and stage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .decoders import any_pixels

_IMAGE = "h int, w int, data binary"


def shrunk(image: np.ndarray, longest: int | None) -> np.ndarray:
    """The image with its longer side at ``longest`` pixels at most, by nearest pixels."""
    h, w = image.shape[:2]
    if not longest or max(h, w) <= longest:
        return image
    rows, columns = (max(1, round(n * longest / max(h, w))) for n in (h, w))
    return image[np.arange(rows) * h // rows][:, np.arange(columns) * w // columns]


def decoded_images(files: DataFrame, decode: Callable[[bytes], np.ndarray | None] = any_pixels, longest: int | None = None) -> DataFrame:
    """``files (.., content)`` with ``h``, ``w`` and ``data`` (RGB bytes) in place of ``content``; nulls where it can't be decoded."""
    keep = [c for c in files.columns if c != "content"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [None if c is None else decode(bytes(c)) for c in b["content"]]
            found = [None if x is None else shrunk(x, longest) for x in found]
            out = b[keep].copy()
            out["h"] = pd.array([None if x is None else x.shape[0] for x in found], dtype="Int32")
            out["w"] = pd.array([None if x is None else x.shape[1] for x in found], dtype="Int32")
            out["data"] = [None if x is None else x.tobytes() for x in found]
            yield out

    schema = ", ".join([f"`{c}` {kind}" for c, kind in files.dtypes if c != "content"] + [_IMAGE])
    return files.select(*keep, "content").mapInPandas(run, schema)


def read_images(spark: SparkSession, folder: str, pattern: str = "*", decode: Callable[[bytes], np.ndarray | None] = any_pixels, longest: int | None = None) -> DataFrame:
    """``(url, h, w, data)`` of the files of a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return decoded_images(files.select(F.col("path").alias("url"), "content"), decode, longest)


def cache_key(url: Column, longest: int | None = None) -> Column:
    """The key of a cached image: its url and the size it is kept in, never its place in a file."""
    return F.sha1(F.concat(F.lit(f"L{longest}|" if longest else "Lorig|"), url))


def cached_images(wanted: DataFrame, cache: DataFrame | None, fetch: Callable[[DataFrame], DataFrame], longest: int | None = None) -> DataFrame:
    """``(key, url, h, w, data, cached)`` of all wanted urls: from ``cache (key, h, w, data)``, or else from ``fetch``.

    ``fetch`` takes ``(url)`` rows and gives ``(url, content)``; only misses
    reach it. What it gives for ``cached = false`` belongs to the next cache.
    """
    own = wanted.select("url").where("url is not null").distinct().withColumn("key", cache_key(F.col("url"), longest))
    if cache is None:
        missed, hits = own, None
    else:
        missed = own.join(cache.select("key"), "key", "left_anti")
        hits = own.join(cache.select("key", "h", "w", "data"), "key").select("key", "url", "h", "w", "data", F.lit(True).alias("cached"))
    new = decoded_images(fetch(missed.select("url")), longest=longest)
    fresh = missed.join(new, "url", "left").select("key", "url", "h", "w", "data", F.lit(False).alias("cached"))
    return fresh if hits is None else hits.unionByName(fresh)


_CACHED = "key string, h int, w int, data binary, shelf string"


def _shelf(key: Column) -> Column:
    return F.substring(key, 1, 2)


def stored_images(spark: SparkSession, path: str) -> DataFrame | None:
    """``(key, h, w, data, shelf)`` of the images kept at ``path``; None before the first is."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return spark.read.schema(_CACHED).parquet(path)


def fill_cache(wanted: DataFrame, path: str, fetch: Callable[[DataFrame], DataFrame], longest: int | None = None, pieces: int = 8) -> None:
    """Fetch what the cache at ``path`` lacks of the wanted urls, a piece at a time.

    Each piece is committed by itself, so a run that breaks off leaves what it
    has got, and the next one asks for the rest only. Images that can't be
    fetched or decoded aren't kept; they are asked for again. ``fetch`` is as
    in :func:`cached_images`. One run fills a cache at a time.
    """
    spark = wanted.sparkSession
    own = wanted.select("url").where("url is not null").distinct().withColumn("key", cache_key(F.col("url"), longest))
    for piece in range(pieces):
        part = own.where(F.pmod(F.crc32("key"), F.lit(pieces)) == piece).withColumn("shelf", _shelf(F.col("key")))
        held = stored_images(spark, path)
        # keys only: the pictures themselves aren't read
        missed = part if held is None else part.join(held.select("shelf", "key"), ["shelf", "key"], "left_anti")
        new = decoded_images(fetch(missed.select("url")), longest=longest).where("h is not null").dropDuplicates(["url"])
        kept = new.select(cache_key(F.col("url"), longest).alias("key"), "h", "w", "data").withColumn("shelf", _shelf(F.col("key")))
        kept.repartition("shelf").write.mode("append").partitionBy("shelf").parquet(path)


def add_artifacts(path: str, artifacts: DataFrame) -> None:
    """Append ``(run_id, stage, filename, content_type, content)`` to a store, with an id and the size."""
    own = artifacts.select("run_id", "stage", "filename", "content_type", "content", F.octet_length("content").alias("size"), F.sha1(F.concat_ws("|", F.col("run_id").cast("string"), "stage", "filename", F.sha1("content"))).alias("artifact_id"))
    own.write.mode("append").partitionBy("run_id").parquet(path)


def read_artifact(spark: SparkSession, path: str, artifact_id: str) -> DataFrame:
    """The artifact of an id; an empty table where there is none."""
    return spark.read.parquet(path).where(F.col("artifact_id") == artifact_id)

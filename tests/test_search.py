"""Searches by posting lists against the scan."""

import random
import zlib

from pyspark.sql import functions as F

from reuselens.operators.review import search_user
from reuselens.operators.search import _postings, search_indexed, write_search_index


def test_same_rows_as_the_scan(spark, tmp_path):
    rng = random.Random(6)
    users = ["".join(rng.choice("abAB01é") for _ in range(rng.randint(1, 9))) for _ in range(400)] + [None, "", "x", "abab", "ABABAB", "aba%b_c"]
    rows = [(u, rng.randint(-1, 30)) for u in users for _ in range(3)]
    items = spark.createDataFrame(rows, "user_id string, cluster_id int").repartition(3)
    path = f"file://{tmp_path}/s"
    write_search_index(items, path, buckets=16)
    for part in ("ab", " AB ", "aba", "abab", "baba01", "é0", "0É1", "%b_", "zz", "a", "", "x", "bababababa"):
        got = sorted(map(tuple, search_indexed(spark, path, part, buckets=16).collect()))
        assert got == sorted(map(tuple, search_user(items, part).collect())), part
    assert search_indexed(spark, path, "ab", limit=3, buckets=16).count() == 3
    every = spark.read.parquet(f"{path}/grams")
    files = lambda df: {r[0] for r in df.select(F.input_file_name()).distinct().collect()}
    plan = _postings(spark, path, "abab", 16)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    asked = every.where(F.col("bucket").isin(*[zlib.crc32(g.encode()) % 16 for g in ("aba", "bab")]))
    assert len(files(asked)) <= 2 < len(files(every))


def test_an_empty_index(spark, tmp_path):
    items = spark.createDataFrame([("abc", -1)], "user_id string, cluster_id int")
    write_search_index(items, f"file://{tmp_path}/s", buckets=4)
    assert search_indexed(spark, f"file://{tmp_path}/s", "ab", buckets=4).count() == 0

"""Pages from the layout against a sort of the cluster."""

import random

import pytest

from reuselens.operators.pages import page_from, write_pages
from reuselens.operators.workflow import page_of

SCHEMA = "row_idx int, cluster_id int, `a.b` string, _place string, block int, total_ long"


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    rng = random.Random(4)
    ids = rng.sample(range(3000), 900)
    # cluster 1 holds more than a third of all rows
    rows = [(k, rng.choice([-1, 0, 1, 1, 1, 2, 30, None]), f"v{k}", None, 7, 8) for k in ids]
    items = spark.createDataFrame(rows, SCHEMA).repartition(5)
    path = f"file://{tmp_path_factory.mktemp('pages')}/p"
    write_pages(items, path, block=50, buckets=4)
    return items, path


@pytest.mark.parametrize("cluster,page,size", [(1, 1, 7), (1, 4, 50), (1, 2, 49), (-1, 2, 30), (0, 1, 1), (2, 1, 1000), (30, 99, 5), (5, 1, 5)])
def test_same_rows_as_the_sort(spark, laid_out, cluster, page, size):
    items, path = laid_out
    got, want = page_from(spark, path, cluster, page, size), page_of(items, cluster, page, size)
    assert got.columns == want.columns and list(map(tuple, got.collect())) == list(map(tuple, want.collect()))


def test_a_page_reads_one_block_or_two(spark, laid_out):
    _, path = laid_out
    files = len(spark.read.parquet(f"{path}/rows").inputFiles())
    for page in range(1, 10):
        assert len(page_from(spark, path, 1, page, 40).inputFiles()) <= 2 < files


def test_an_empty_table(spark, tmp_path):
    write_pages(spark.createDataFrame([], SCHEMA), f"file://{tmp_path}/p")
    found = page_from(spark, f"file://{tmp_path}/p", 0, 1, 10)
    assert found.count() == 0 and found.columns[-1] == "total"

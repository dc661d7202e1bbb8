"""Null, repeated and very long rows, tied ids and clashing column names, for every operator and every stage."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_operators import A, B, OPERATORS, _prose

import corpus_pipeline
from reuselens.llm import sharding, simhash

CLASH = (
    "v place sides y y_place y_sides rank open company k1 k2 h band rep component digest whole lines bin group offset bins bound anchor hi lo spans ids media pixels fp shard bytes row base slots names"
    " _id _k1 _k2 _h _row _f _text _carry _arrival pair x xs n n_words kept stage sequence_id group_id license"
).split()
LONG = " ".join(f"w{random.Random(7).getrandbits(16)}x{k % 5000}" for k in range(60_000)) + " 192.168.0.1"
ROWS = [
    (1, None), (2, ""), (3, " \n"), (4, A), (4, A), (4, B), (5, A), (6, LONG), (7, LONG), (8, LONG[:200_000] + " " + B), (9, "a" * 300_000), (None, A), (None, None), (None, "only here " + _prose(77, 120)), (10, "tie " * 60), (11, "tie " * 60),
]


@pytest.fixture(scope="module")
def hard(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    return docs.withColumns({c: F.lit("x") for c in CLASH} | {"lang": F.lit(None).cast("string"), "source": F.lit("hot"), "n_chars": F.char_length("text").cast("long")})


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_on_hard_rows(hard, name):
    rows = OPERATORS[name](hard).collect()
    ids = Counter(r.doc_id for r in rows)
    if name == "passages":
        assert {4, 5, 6, 7, 8} <= set(ids) and None not in ids
        return
    if name == "packing":
        assert set(ids) == {i for i, _ in ROWS} and sum(r.piece == 0 for r in rows) == len(ROWS)
        return
    assert ids == Counter(i for i, _ in ROWS)


def test_store_on_hard_rows(spark, hard, tmp_path):
    store = sharding.ShardStore(spark, f"file://{tmp_path}/s", tier_bytes=1000)
    store.append_arrivals(hard, F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(5)))
    assert sorted(map(str, store.read().collect())) == sorted(map(str, hard.collect()))


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_on_hard_rows(spark, hard, stage):
    name, run = stage
    out = run(spark, hard, None)
    rows = out.collect()
    texts = Counter(r.text if "text" in out.columns else None for r in rows)
    if name != "best_fit_packing":
        assert out.columns == hard.columns
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    if name == "quality_rules":
        assert A in texts and "" not in texts and None not in texts
    if name == "simhash_near_dedup":
        held = {r.doc_id for r in rows if r.text == A}
        assert held == {4} and texts[A] == 1 and texts[B] == 1 and texts[LONG] == 1 and sum(1 for r in rows if not (r.text or "").strip()) == 1
        assert any((r.text or "").startswith("only here") and r.doc_id is None for r in rows)
    if name == "substring_dedup":
        assert texts[LONG] == 1 and texts[None] == 2 and texts[""] == 1
    if name == "pii":
        assert len(rows) == len(ROWS) and not any("192.168.0.1" in (r.text or "") for r in rows)
    assert run(spark, hard.where("false"), None).count() == 0


def test_many_equal_rows_on_both_sides_of_a_pair(spark):
    near = B.split()
    near[100] = "other"
    rows = [(4, A)] + [(1, B)] * 1000 + [(2, " ".join(near))] * 1000 + [(None, B)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    groups = Counter((r.doc_id, r.group_id) for r in simhash.similar_documents(docs).collect())
    assert groups == {(4, 4): 1, (1, 1): 1000, (2, 1): 1000, (None, 1): 50}
    assert Counter((r.doc_id, r.text) for r in simhash.without_near_copies(docs).collect()) == {(4, A): 1, (1, B): 1}


def test_simhash_pairs_come_first(spark, monkeypatch):
    """Texts linked by their fingerprints are one group without any band; those that only look alike are not."""
    near = B.split()
    near[100] = "other"
    rows = [(1, B), (2, " ".join(near)), (3, A)]
    assert bin(simhash.fingerprint(rows[0][1]) ^ simhash.fingerprint(rows[1][1])).count("1") <= simhash.DISTANCE
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    empty = spark.createDataFrame([], "rep long, bands array<long>, sketch binary")
    real = simhash.materialize
    monkeypatch.setattr(simhash, "materialize", lambda df, name, *a, **b: real(empty if name == "similar-sketches" else df, name, *a, **b))
    assert {(r.doc_id, r.group_id) for r in simhash.similar_documents(docs).collect()} == {(1, 1), (2, 1), (3, 3)}

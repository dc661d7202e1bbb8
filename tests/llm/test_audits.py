"""Exact copies, the Merkle manifest and the filter audit against plain versions, on edge cases and on the smallest tables."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from reuselens.llm import exact_dedup, filter_audit, merkle, queries

SF = "/root/testdata/sf0.001"
TIE = "Same TEXT with  runs\t\nof space " * 40
ROWS = [
    (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t", None, "a"), (4, TIE, "en", "a"), (4, TIE, "en", "a"), (5, TIE.replace("\t\n", " "), "de", "a"), (6, TIE.lower(), "en", "a"), (None, TIE, "en", "a"), (None, None, None, None),
    (7, "x " * 30_000 + "#", "en", "a"), (8, "Y" * 200_000, "", "é漢😀"), (9, "z", "fr", "a"), (10, "lone", "é", "a"), (-3, "NEGATIVE ids", "en", "b"),
] + [(100 + k, f"row {k} " + "w" * (k % 7) + " Caps" * (k % 3), "hot", "s") for k in range(75)] + [(300 + k, f"many {k % 12} copies", "hot", "s") for k in range(60)]


@pytest.fixture(scope="module")
def hard(spark):
    docs = spark.createDataFrame([(i, t, g, s, None if t is None else len(t)) for i, t, g, s in ROWS], "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    clash = "k idx n h up run path pos first leaf tampered digest own least part mask cells carried _row _len _pre _open keep_id group_size level subroot good toxic before after parent _x _c _m"
    return docs.withColumns({c: F.lit("x") for c in clash.split()})


def _copies(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for x, ids in groups.items():
        held = sorted(ids, key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(x.encode()).hexdigest()
        out += [(i, held[0], len(held), k == 0, sha) for k, i in enumerate(held)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("prefix", [1, 256])
@pytest.mark.parametrize("keys", [1 << 20, 0])
def test_exact_copies(hard, monkeypatch, prefix, keys):
    monkeypatch.setattr(exact_dedup, "_KEYS", keys)
    found = exact_dedup.exact_copies(hard, every_digest=True, prefix=prefix)
    assert sorted(map(tuple, found.collect()), key=repr) == _copies([(i, t) for i, t, _, _ in ROWS])
    assert exact_dedup.exact_copies(hard.where("false")).count() == 0


def test_only_open_groups_are_hashed(spark):
    docs = spark.createDataFrame([(1, "aa"), (2, "ab"), (3, "a  b"), (4, "a b"), (5, "longer"), (6, "ac" * 200 + "x"), (7, "ac" * 200 + "y")], "doc_id long, text string")
    found = {r.doc_id: r.digest for r in exact_dedup.exact_copies(docs).collect()}
    assert [found[i] is None for i in range(1, 8)] == [True, True, False, False, True, False, False]


def test_large_groups_are_joined_apart(spark, monkeypatch):
    from reuselens.llm import grouping

    monkeypatch.setattr(grouping, "LARGE", 3)
    rows = [(k, "hot" if k % 2 else f"t{k % 40}") for k in range(200)]
    found = exact_dedup.exact_copies(spark.createDataFrame(rows, "doc_id long, text string"), every_digest=True)
    assert sorted(map(tuple, found.collect()), key=repr) == _copies(rows)


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(i, source, lang, n, text):
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])


def _tree(nodes):
    """Root, and for each node its siblings as (before, after) level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + 8] for k in range(0, len(nodes), 8)]
        for path, k in zip(paths, at):
            run = runs[k // 8]
            path.append(("".join(run[: k % 8]), "".join(run[k % 8 + 1 :])))
        nodes, at = [_h(*r) for r in runs], [k // 8 for k in at]
    return (nodes[0] if nodes else None), paths


def _manifest(rows):
    langs = {}
    for i, t, g, s in rows:
        n = None if t is None else len(t)
        low = None if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)
        touched = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
        langs.setdefault(g, []).append((i is not None, i or 0, _leaf(i, s, g, n, t), _leaf(i, s, g, n, low if touched else t), i))
    order = sorted(langs, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _tree([x[2] for x in sorted(langs[g])]) for g in order}
    root, tops = _tree([trees[g][0] for g in order])
    out = []
    for g, top in zip(order, tops):
        for (_, _, leaf, tampered, i), path in zip(sorted(langs[g]), trees[g][1]):
            path = path + top
            fold = tampered
            for a, b in path:
                fold = _h(a, fold, b)
            out.append((i, leaf, trees[g][0], root, _h(*[a + b for a, b in path]), fold, fold == root))
    return sorted(out, key=repr)


def test_manifest(hard):
    found = merkle.audited(hard)
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == _manifest(ROWS)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [8], [9], [64], [65], [1, 1, 1, 1, 1, 1, 1, 1, 1], [513, 2]])
def test_manifest_of_sizes(spark, sizes):
    rows = [(1000 * g + k, f"t{k}", f"g{g}", "s") for g, n in enumerate(sizes) for k in range(n)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(map(tuple, merkle.audited(docs).collect()), key=repr) == _manifest(rows)


def test_empty_manifest(hard):
    assert merkle.audited(hard.where("false")).count() == 0


def _audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    least = {}
    for i, t, _, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = {}
    for i, t, g, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and least[t] < i,
        }
        parts.setdefault(g or "", []).append((i, fails))
    out = []
    for part, docs in parts.items():
        steps = {}
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                failing = [d for d in docs if d[1][f]]
                unique = sum(1 for d in failing if sum(d[1].values()) == 1)
                steps["".join(order), step] = [len(left), len(gone), len(failing) - len(gone), unique, sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)]
        share = {f: sum(v[1] for (o, s), v in steps.items() if o[s - 1] == f) for f in "ABCDE"}
        out += [(part, o, s, *v, share[o[s - 1]]) for (o, s), v in steps.items()]
    return sorted(out)


def test_filter_audit(spark, hard):
    labels = [(4, 1, 0), (5, 0, 1), (5, 1, None), (7, 1, 1), (None, 1, 1), (305, 1, 0), (999, 1, 1)]
    found = filter_audit.audit(hard, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, found.collect())) == _audit(ROWS, labels)
    assert filter_audit.audit(hard.where("false"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_merkle", "op13_filter_audit"])
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    plain = lambda rows, names: sorted(tuple(dict(zip(names, r))[c] for c in columns) for r in rows)
    assert plain(map(tuple, got.collect()), got.columns) == plain(want.fetchall(), want.columns)

"""Each operator against a plain version, on edge cases and on the smallest tables."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reuselens.llm import bpe, compact_windows, licenses, packing, pii, quality, queries, sharding, simhash, suffix_dedup, webp
from reuselens.llm.induced_sort import Shard

SF = "/root/testdata/sf0.001"


def _prose(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    return " ".join(rng.choice(words) for _ in range(n))


A, B = _prose(1, 300), _prose(2, 260)
EDGE = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, A),
    (5, A),
    (6, B + "\n" + A[:900] + "\n" + B[:400]),
    (7, "é😀 漢字 me@x.org 8.8.8.8 +49 30 1234567 4785380592391139"),
    (8, "ab" * 40_000),
    (9, "word " * 300),
    (10, _prose(3, 20_000)),
    (11, "x"),
    (12, "# $ % & " + B[:700]),
    (13, None),
]


@pytest.fixture(scope="module")
def edge(spark):
    # columns that clash with those the operators make
    rows = [(i, t, "n", 5, "k", 9) for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, fp string, n_words int, spans string, anchor int")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


OPERATORS = {
    "suffix": lambda d: suffix_dedup.deduplicated(d),
    "media": lambda d: webp.features(webp.read_pixels(webp.store(d))),
    "simhash": lambda d: simhash.near_duplicates(d),
    "similar": lambda d: simhash.similar_documents(d),
    "packing": lambda d: packing.pack(packing.pieces(d, public_tokenizers.path("byte_bpe_50k.json"))),
    "quality": lambda d: quality.judged(d, ["doc_id"]),
    "passages": lambda d: compact_windows.near_passages(d),
    "bpe": lambda d: bpe.decode(bpe.encode(d, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN), public_tokenizers.path("byte_bpe_50k.tiktoken")),
    "licences": lambda d: licenses.scan(d, licenses.known_digests(d.sparkSession)),
    "pii": lambda d: pii.find_pii(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], "doc_id long, text string")).count() == 0


# 1


def test_induced_sort_by_brute_force():
    rng = random.Random(7)
    for _ in range(150):
        letters = rng.choice([b"ab", b"a", b"abc", bytes(range(256))])
        strings = [bytes(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 6))]
        cap = rng.randint(1, 9)
        shard = Shard(strings, cap, memory=rng.choice([1 << 20, 100]))
        found = shard.repeated()
        seen = defaultdict(int)
        for s in strings:
            for k in range(len(s) - cap + 1):
                seen[s[k : k + cap]] += 1
        for at, s in zip(shard.starts, strings):
            for k in range(len(s) - cap + 1):
                assert found[at + k] == (seen[s[k : k + cap]] > 1)


@pytest.mark.parametrize("limits", [{}, {"hot": 1}, {"shard_bytes": 4000, "memory": 2000}])
def test_suffix_dedup(edge, limits):
    small = edge.where("doc_id <> 10")
    want = brute.suffix([d for d in EDGE if d[0] != 10])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.deduplicated(small, **limits).collect()}
    assert got == want


def test_suffix_dedup_on_tables(spark, texts):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op1_suffix_dedup(spark, SF).collect()}
    assert got == brute.suffix(texts.items())


def test_suffix_dedup_of_a_very_long_text(spark):
    base = _prose(5, 60_000)
    rows = [(1, base * 4), (2, base[100_000:100_400])]
    got = {r.doc_id: r for r in suffix_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == len(base) * 4 and got[2].n_removed == 400


# 2


def test_sharding(spark, tmp_path):
    store = sharding.ShardStore(spark, f"file://{tmp_path}/s", target_bytes=20_000, tier_bytes=2_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("odd", F.lit(None).cast("string"))
    for k in range(9):
        store.append(docs.where(f"doc_id % 9 = {k}"))
        now = store.compact()
    assert now.version > 9 and len(now.runs) < 9 and max(r.level for r in now.runs) >= 1
    store.vacuum()
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, docs.collect()))
    with pytest.raises(Exception):
        store.commit(sharding.Manifest(now.version - 1), [])  # another writer has this version
    assert store.manifest().version == now.version
    before = store.read().count()
    store.append(docs.where("false"))
    assert store.read().count() == before


def test_arrivals_of_one_table(spark, tmp_path):
    store = sharding.ShardStore(spark, f"file://{tmp_path}/s", target_bytes=20_000, tier_bytes=2_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"_arrival": F.lit(1), "x": F.lit(None).cast("long")})
    docs = docs.unionByName(docs.limit(3)).unionByName(docs.limit(1).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.repeat(F.lit("long "), 100_000)}))
    last = store.append_arrivals(docs, F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(16)))
    assert len(store.versions()) > 16 and len(last.runs) < 16 and max(r.level for r in last.runs) >= 1
    want = sorted(map(str, docs.collect()))
    assert sorted(map(str, store.read().collect())) == want
    before = store.versions()[-2]  # a reader of the version before still finds its files
    assert store.read(before).count() > 0
    sizes = [f.bytes for r in last.runs if r.level for f in r.files]
    assert all(r.bytes == sum(f.bytes for f in r.files) for r in last.runs) and max(sizes) < 100_000
    empty = sharding.ShardStore(spark, f"file://{tmp_path}/e")
    empty.append_arrivals(docs.where("false"), F.lit(0))
    assert empty.read().columns == docs.columns and empty.read().count() == 0


def test_empty_store(spark, tmp_path):
    store = sharding.ShardStore(spark, f"file://{tmp_path}/s")
    assert store.read(schema="doc_id long").count() == 0


# 3


def test_webp_round_trips():
    rng = np.random.default_rng(0)
    images = [rng.integers(0, 2**32, s, dtype=np.uint32) for s in ((1, 1), (5, 3), (24, 12), (17, 20))]
    images += [np.full((40, 30), 9, dtype=np.uint32), rng.choice(rng.integers(0, 2**32, 100, dtype=np.uint32), (20, 30))]
    for cache in (0, 1, 8, 11):
        for a, b in zip(images, webp.decode(webp.encode(images, cache))):
            assert (a == b).all()
    for transforms in ((webp.PREDICTOR,), (webp.CROSS_COLOUR,), (webp.SUBTRACT_GREEN, webp.CROSS_COLOUR, webp.PREDICTOR)):
        for mode in range(14):
            for a, b in zip(images[:4], webp.decode(webp.encode(images[:4], 4, transforms, mode))):
                assert (a == b).all()
    for colours in (2, 4, 16, 100):
        image = rng.choice(rng.integers(0, 2**32, colours, dtype=np.uint32), (11, 13))
        assert (webp.decode(webp.encode([image], 3, (webp.PALETTE,)))[0] == image).all()


def test_webp_simple_codes_and_damage():
    # a 1 x 1 image by hand: five simple codes of one symbol (green 7, red 5, blue 3, alpha 255, distance 0)
    bits = webp._Tokens()
    for value, n in ((0x2F, 8), (0, 14), (0, 14), (1, 1), (0, 3), (0, 1), (0, 1), (0, 1)):
        bits.put(value, n)
    for symbol in (7, 5, 3, 255):
        for value, n in ((1, 1), (0, 1), (1, 1), (symbol, 8)):
            bits.put(value, n)
    for value, n in ((1, 1), (0, 1), (0, 1), (0, 1)):
        bits.put(value, n)
    number = at = 0
    for value, n in bits.items:
        number, at = number | value << at, at + n
    words = np.frombuffer(number.to_bytes(-(-at // 64) * 8, "little"), dtype="<u8")
    assert webp.decode([webp._container(words, at)])[0].tolist() == [[255 << 24 | 5 << 16 | 7 << 8 | 3]]
    whole = webp.encode([np.arange(400, dtype=np.uint32).reshape(20, 20)])[0]
    with pytest.raises(ValueError):
        webp.decode([whole[:4] + (40).to_bytes(4, "little") + whole[8:16] + (28).to_bytes(4, "little") + whole[20:48]])


def test_stored_media_have_transforms(spark):
    """Each text is stored in the way that is shortest, and a table's decoder inverts transforms."""
    rng = np.random.default_rng(5)
    row = "".join(chr(c) for c in rng.integers(97, 123, 48))
    slope = "".join(chr(33 + (k // 4 + k % 4) % 90) for k in range(6000))
    rows = [(1, row * 60), (2, slope), (3, "the quick brown fox jumps over the lazy dog " * 3), (4, None), (5, row)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    used = {}
    for r in webp.store(docs).collect():
        headers, kinds = webp._Headers(), []
        for f in webp.split_files(r.media):
            dims = int.from_bytes(f[21:25], "little")
            kinds.append([t[0] for t in headers.parse(f[20:], (dims & 0x3FFF) + 1, (dims >> 14 & 0x3FFF) + 1).transforms])
        used[r.doc_id] = kinds
        assert b"".join(x.tobytes() for x in webp.decode(webp.split_files(r.media))) == webp.payload(dict(rows)[r.doc_id])
    assert webp.PREDICTOR in used[1][0] and webp.PREDICTOR in used[2][0] and used[5] == [[]]
    images = [rng.integers(0, 2**32, (h, 12), dtype=np.uint32) for h in (12, 24, 48, 12)] + [np.arange(144, dtype=np.uint32).reshape(12, 12) * np.uint32(0x01010101)]
    assert all((a == b).all() for a, b in zip(images, webp.decode(webp.encode_best(images))))


def test_media(edge):
    for r in OPERATORS["media"](edge).collect():
        raw = (dict(EDGE)[r.doc_id] or "").encode()
        payload = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))


# 4


def test_simhash(spark, edge, texts):
    for docs, held, bucket in ((edge, dict(EDGE), 4096), (spark.read.parquet(f"{SF}/documents.parquet"), texts, 40)):
        fp = {i: brute.simhash(t) for i, t in held.items()}
        ids = sorted(fp)
        linked = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if bin(fp[a] ^ fp[b]).count("1") <= 3]
        want = brute.components(ids, linked)
        got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs, bucket=bucket).collect()}
        assert got == {i: (fp[i], want[i]) for i in ids}


def test_simhash_of_a_dense_bucket(spark):
    rng = random.Random(4)
    points = {rng.getrandbits(64) for _ in range(20)}
    points |= {p ^ 1 << rng.randrange(24) ^ 1 << rng.randrange(24) for p in list(points) for _ in range(30)}
    rows = [(p - 2**64 if p >> 63 else p, k) for k, p in enumerate(sorted(points))]
    edges = [(r.src, r.dst) for r in simhash.links(spark.createDataFrame(rows, "fp long, rep long"), bucket=8).collect()]
    value = {k: p % 2**64 for p, k in rows}
    linked = [(a, b) for a in value for b in range(a) if bin(value[a] ^ value[b]).count("1") <= 3]
    assert all(bin(value[a] ^ value[b]).count("1") <= 3 for a, b in edges)
    assert brute.components(list(value), edges) == brute.components(list(value), linked)


def test_similar_documents(spark):
    rows = [(1, A), (2, A), (3, A.replace(A.split()[150], "changed", 1)), (4, B), (5, None), (6, ""), (7, "")]
    got = {r.doc_id: r.group_id for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k] for k in (1, 2, 3, 4)] == [1, 1, 1, 4] and got[6] == got[7] == got[5]


def test_similar_documents_against_all_pairs(spark):
    rng = random.Random(11)
    new = lambda n: [f"w{rng.getrandbits(40)}" for _ in range(n)]
    texts = []
    for n in range(40, 120):  # words put in at one place, at similarities around 0.8
        words, k = new(n), rng.randrange(n)
        texts += [words, words[:k] + new(rng.randint(n // 16, n // 6)) + words[k:]]
    frame = new(200)  # a source of texts that are alike but under 0.8, some with a partner over it
    for _ in range(80):
        own = list(frame)
        for k in rng.sample(range(200), 7):
            own[k] = new(1)[0]
        texts.append(own)
        if rng.random() < 0.3:
            texts.append(own[:90] + new(12) + own[90:])
    rng.shuffle(texts)
    rows = [(k, " ".join(w)) for k, w in enumerate(texts)]
    held = {k: brute.shingles(t) for k, t in rows}
    linked = [(a, b) for a in held for b in range(a) if len(held[a] & held[b]) >= 0.8 * len(held[a] | held[b])]
    got = {r.doc_id: r.group_id for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(linked) > 40 and got == brute.components(list(held), linked)


# 5


def test_packing(spark):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext| >é", "日本 <|endoftext|>x", "tie " * 700, "tie " * 700, "q" * 5000]
    texts = dict(EDGE) | {900 + k: t for k, t in enumerate(odd)}
    repeated = [(904, texts[904]), (4, texts[4])]
    docs = spark.createDataFrame([*texts.items(), *repeated], "doc_id long, text string").withColumns({c: F.lit("x") for c in ("bin", "group", "length", "open")})
    rows = packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        copies = 1 + sum(k == i for k, _ in repeated)
        ids = np.array([*own.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            assert (r.piece, r.start, r.ids_crc32) == (k // copies, at, zlib.crc32(ids[at : at + r.length].tobytes()))
            assert r.piece == 0 or r.length == 1024
            at += r.length if k % copies == copies - 1 else 0
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    total = packing.lower_bound(np.array([r.length for r in rows]), 1024)
    assert total <= len(by_sequence) <= total + 1


def test_certified_bins():
    rng = np.random.default_rng(2)
    for _ in range(50):
        sizes = rng.integers(1, rng.integers(2, 1025), 400)
        bins, _ = packing.best_fit_decreasing(sizes, 1024)
        keep = packing.certified_bins(np.bincount(bins, weights=sizes).astype(np.int64), 1024)
        assert packing.lower_bound(sizes[keep[bins]], 1024) == keep.sum()


def test_lower_bounds_hold_and_exchange(spark):
    assert packing.lower_bound(np.array([600] * 10), 1024) == 10
    rng = np.random.default_rng(1)
    for sizes in (rng.integers(1, 1024, 6000), rng.integers(300, 700, 3000), np.full(2000, 341), np.full(1500, 400)):
        bins, _ = packing.best_fit_decreasing(sizes, 1024)
        assert packing.lower_bound(sizes, 1024) <= bins.max() + 1
        assert np.bincount(bins, weights=sizes).max() <= 1024
        cut = spark.createDataFrame([(k, 0, 0, int(n), 0) for k, n in enumerate(sizes)], "doc_id long, piece int, start long, length long, ids_crc32 long")
        packed = packing.pack(cut, group_items=500).toPandas()
        assert len(packed) == len(sizes) and packed.groupby("sequence_id").length.sum().max() <= 1024
        assert packed.groupby("sequence_id")[["bins", "bound"]].nunique().max().max() == 1
        one = packed.groupby("sequence_id").agg(bins=("bins", "first"), bound=("bound", "first"))
        assert (one.bins >= one.bound).all()
        assert packed.sequence_id.nunique() <= 1.02 * packing.lower_bound(sizes, 1024) + 4


def test_assembled_sequences(spark):
    cut = packing.pieces(spark.createDataFrame([(1, A), (2, B)], "doc_id long, text string"), public_tokenizers.path("byte_bpe_50k.json"))
    for r in packing.assemble(cut, packing.pack(cut)).collect():
        assert len(r.ids) == 4 * r.length <= 4096


# 6


def test_quality(edge):
    for r in quality.judged(edge, ["doc_id"]).collect():
        want = brute.quality(dict(EDGE)[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.kept and r.base_failed)
    assert {r.doc_id for r in edge.where(quality.passes(F.col("text"))).collect()} == {r.doc_id for r in quality.judged(edge, ["doc_id"]).where("kept").collect()}


# 7


def test_passages(spark):
    passage = _prose(9, 70)
    rows = [(k, _prose(20 + k, 120) + " " + passage + " " + _prose(40 + k, 90)) for k in range(12)]
    rows += [(50, A), (51, A.upper()), (52, _prose(60, 200)), (53, None), (54, ""), (55, passage[:120])]
    found = compact_windows.near_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    held = found.collect()
    assert {r.doc_id for r in held} == {*range(12), 50, 51}
    words = {i: (t or "").encode().lower().split() for i, t in rows}
    for r in held:
        a, b = (brute.shingles(b" ".join(words[i][s:e]).decode()) for i, s, e in ((r.doc_id, r.start, r.end), (r.other_id, r.other_start, r.other_end)))
        assert len(a & b) >= 0.8 * len(a | b) and r.end - r.start >= 50
    left = compact_windows.without_passages(spark.createDataFrame(rows, "doc_id long, text string"), found)
    texts = {r.doc_id: r.text for r in left.collect()}
    assert sum(passage in (t or "") for t in texts.values()) == 1 and 51 not in texts and texts[52] == rows[14][1]


def test_edited_passages_are_verified():
    rng = random.Random(5)
    new = lambda n: [f"w{rng.getrandbits(60)}" for _ in range(n)]
    sequence = lambda words: compact_windows.shingle_hashes(compact_windows.word_hashes(" ".join(words)))
    seen = 0
    for size, at in [(50, [20]), (86, [43]), (100, [33, 66]), (50, [3]), *((rng.randint(50, 100), rng.sample(range(50), rng.randint(1, 3))) for _ in range(200))]:
        words, ahead = new(size), new(rng.randint(0, 150))
        other = [new(1)[0] if k in at else w for k, w in enumerate(words)]
        x, y = sequence(ahead + words + new(30)), sequence(new(70) + other + new(90))
        # brute force: the places that stretches of 46 shingles or more at 0.8 have in common with the other side
        same = np.isin(sequence(words), sequence(other))
        total = np.r_[0, np.cumsum(same)]
        need = {k for s in range(size - 4) for e in range(s + 46, size - 3) if (m := total[e] - total[s]) >= 0.8 * (2 * (e - s) - m) for k in range(s, e) if same[k]}
        found = compact_windows.verified(x, y, 46, 0.8)
        for s, e, ys, ye in found:
            a, b = set(x[s:e].tolist()), set(y[ys:ye].tolist())
            assert len(a & b) >= 0.8 * len(a | b) and min(e - s, ye - ys) >= 46
        assert need <= {k - len(ahead) for s, e, _, _ in found for k in range(s, e)}
        seen += bool(need)
    assert seen > 50


def test_passages_of_texts_in_parts(spark):
    rng = random.Random(8)
    new = lambda n: " ".join(f"w{rng.getrandbits(40)}" for _ in range(n))
    rows, need = [], {}
    for k in range(24):  # passages before, across and after the cuts, one longer than a part
        passage, ahead = new(700 if k == 0 else 80), (37 * k, 900 - 31 * k)
        need[2 * k] = (ahead[0], ahead[0] + len(passage.split()))
        rows += [(2 * k + i, " ".join([new(n), passage, new(1000 - n)]).strip()) for i, n in enumerate(ahead)]
    found = compact_windows.near_passages(spark.createDataFrame(rows, "doc_id long, text string"), hashes=8, part=300).collect()
    for doc, (start, end) in need.items():
        held = {k for r in found if r.doc_id == doc and r.other_id == doc + 1 for k in range(r.start, r.end)}
        assert held >= set(range(start, end))


def test_recall_of_edited_passages(spark):
    """Passages of 50 to 200 words with one edit in 25 words or fewer, in other prose, of one common key or not."""
    rng = random.Random(11)
    new = lambda n: [f"w{rng.getrandbits(40)}" for _ in range(n)]
    sequence = lambda words: compact_windows.shingle_hashes(compact_windows.word_hashes(" ".join(words)))
    common = new(24)  # too short a passage, in every third text
    rows, need = [], set()
    for k in range(240):
        words = new(rng.randint(50, 200))
        other = list(words)
        for at in rng.sample(range(len(words)), rng.randint(1, max(1, len(words) // 25))):
            other[at] = rng.choice([new(1)[0], words[at - 1], "of"])
        if k % 3 == 0:
            words, other = common + words, common + other
        rows += [(2 * k + i, " ".join(new(rng.randint(0, 150)) + w + new(rng.randint(0, 150)))) for i, w in enumerate((words, other))]
        if len(compact_windows.verified(sequence(words), sequence(other), 46, 0.8)):
            need.add(2 * k)
    found = compact_windows.near_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert all(r.doc_id // 2 == r.other_id // 2 for r in found)
    caught = need & {r.doc_id for r in found}
    assert len(need) > 150 and len(caught) >= 0.95 * len(need), (len(need), len(caught))


def test_windows_that_fail_meet_others(spark):
    """Pairs that share a short passage with many texts, and only with each other a whole one."""
    rng = random.Random(12)
    new = lambda n: [f"w{rng.getrandbits(40)}" for _ in range(n)]
    common = new(40)
    rows = []
    for k in range(30):
        words = new(12) + common + new(8)
        rows += [(100 * k + i, " ".join(new(60) + words + new(60))) for i in range(2)]
    found = compact_windows.near_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {(r.doc_id, r.other_id) for r in found if r.doc_id < r.other_id} == {(100 * k, 100 * k + 1) for k in range(30)}


def test_windows_of_a_key_have_ranks_of_their_own(spark, monkeypatch):
    """A key's windows are in one task when they are ranked, also where the join before that becomes a broadcast."""
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    phrase = words(40)
    rows = [(k, " ".join([*words(60), *phrase, *words(60)])) for k in range(60)]
    ranks, write = [], compact_windows.materialize

    def seen(df, name, **kept):
        out = write(df, name, **kept)
        if name == "windows-ranked" and not ranks:
            ranks.extend((r.v, r.rank) for r in out.collect())
        return out

    monkeypatch.setattr(compact_windows, "materialize", seen)
    # a join is planned with a shuffle, and becomes a broadcast as it runs
    planned = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key, None) for key in planned}
    try:
        for key, value in planned.items():
            spark.conf.set(key, value)
        compact_windows.near_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(ranks) >= 60 and len(set(ranks)) == len(ranks)


def test_rounds_do_not_grow_with_the_square_of_a_key(spark, monkeypatch):
    """A phrase too short for a passage ends before the rounds, and a word that is repeated is one run, not a window a place."""
    rng = random.Random(6)
    words = lambda n: [f"w{rng.getrandbits(40)}" for _ in range(n)]
    phrase = words(40)
    rows = [(k, " ".join([*words(60), *phrase, *words(60)])) for k in range(60)]
    rows += [(100 + k, " ".join([*words(30), *["the"] * (40 if k < 6 else 400), *words(30)])) for k in range(12)]
    made, write = [], compact_windows.materialize

    def seen(df, name, **kept):
        out = write(df, name, **kept)
        if name == "windows-met":
            made.append(out.count())
        return out

    monkeypatch.setattr(compact_windows, "materialize", seen)
    found = compact_windows.near_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sum(made[1:]) <= 12 * 12 * 16, made  # rounds after the first meeting: pairs of the texts with runs, in sixteen keys at most
    held = {d: {k for r in found if r.doc_id == d for k in range(r.start, r.end)} for d in range(106, 112)}
    assert all(held[d] >= set(range(30, 430)) for d in held) and {r.doc_id for r in found} == {*held}


def test_texts_are_taken_apart_once(spark, monkeypatch):
    """Words are hashed in the first step; no later one reads or shuffles texts."""
    rng = random.Random(14)
    words = lambda n: [f"w{rng.getrandbits(40)}" for _ in range(n)]
    passage, rows = words(70), []
    for k in range(6):
        rows.append((k, " ".join([*words(20), *passage[10 * (k % 3) :], *words(20)])))
    plans, write = {}, compact_windows.materialize

    def seen(df, name, **kept):
        plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name, **kept)

    monkeypatch.setattr(compact_windows, "materialize", seen)
    found = compact_windows.near_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == {*range(6)} and "passage-links" in plans
    assert [name for name, plan in plans.items() if "text" in plan] == ["passages-words"]


def test_words_hashed_in_bulk():
    """The words of many texts at a time: equal hashes for equal words, A-Z aside, and none across texts."""
    rng = random.Random(15)
    letters = ["a", "A", "b", "é", "É", "ß", "文", " ", "  ", "\n", "\t\x0b", "\x0c\r", "\u00a0", ""]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(400)] + ["", " ", "a b", "A\nB", "b a"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    rows = [r for b in compact_windows._worded(iter([batch.slice(0, 100), batch.slice(100)])) for r in b.to_pylist()]
    split = [t.encode().lower().split() for t in texts]
    assert [r["n"] for r in rows] == [len(w) for w in split]
    named = {}
    for r, own in zip(rows, split):
        for word, value in zip(own, np.frombuffer(r["words"], np.uint32).tolist(), strict=True):
            assert named.setdefault(word, value) == value
    assert len(set(named.values())) == len(named) > 100
    folded = [" ".join(t.lower().split()) if "\u00a0" not in t else None for t in texts]
    for k in range(0, len(texts), 7):
        assert all((rows[k]["h"] == r["h"]) == (folded[k] == f) for r, f in zip(rows, folded) if f is not None and folded[k] is not None)


def _cut(columns, names, rng):
    """The rows as batches of any size, empty ones too."""
    at, batches = 0, []
    while at < len(columns[0]):
        n = rng.choice([0, 1, 2, 7, 50])
        batches.append(pa.RecordBatch.from_arrays([pa.array(c[at : at + n]) for c in columns], names=list(names)))
        at += n
    return iter(batches)


def test_spans_and_open_windows_in_order():
    """Islands of spans, windows in no passage and live keys, held against plain versions, however rows fall into batches."""
    rng = random.Random(16)
    for _ in range(60):
        spans = sorted((rng.randrange(3), rng.randrange(3), s := rng.randrange(60), s + rng.randrange(8), t := rng.randrange(60), t + rng.randrange(8)) for _ in range(rng.randint(1, 60)))
        want = []
        for pair in {r[:2] for r in spans}:
            todo = [[r for r in spans if r[:2] == pair]]
            for a in (2, 4):  # apart in the first text, then in the other
                parts = []
                for group in todo:
                    reach = None
                    for r in sorted(group, key=lambda r: r[a : a + 2]):
                        if reach is None or r[a] > reach:
                            parts.append([])
                        parts[-1].append(r)
                        reach = r[a + 1] if reach is None else max(reach, r[a + 1])
                todo = parts
            want += [(*pair, *(f(r[k] for r in g) for f, k in zip((min, max, min, max), (2, 3, 4, 5)))) for g in todo]
        found = [tuple(r.values()) for b in compact_windows._join_spans(_cut([*zip(*spans)], compact_windows._SPAN, rng)) for r in b.to_pylist()]
        assert sorted(found) == sorted(want)

        windows = [(rng.randrange(4), rng.randrange(4), rng.randrange(30), rng.randrange(2), 1) for _ in range(rng.randint(1, 60))]
        passages = [(0, rng.randrange(4), s := rng.randrange(30), s + rng.randrange(6), 0) for _ in range(rng.randint(0, 5))]
        rows = sorted([*windows, *passages], key=lambda r: (r[1], r[2], r[4], r[0], r[3]))
        marked = [tuple(r.values()) for b in compact_windows._opened(_cut([*zip(*rows)], (*compact_windows._WINDOW, "window"), rng)) for r in b.to_pylist()]
        plain = {(*w[:4], int(not any(p[1] == w[1] and p[2] <= w[2] <= p[3] for p in passages))) for w in windows}
        assert sorted(marked) == sorted(plain)

        rows = sorted(plain, key=lambda r: (r[0], -r[4], r[1], r[2]))
        live = [tuple(r.values()) for b in compact_windows._live(_cut([*zip(*rows)], compact_windows._OPEN, rng)) for r in b.to_pylist()]
        keys = {r[0] for r in plain if len({q[1] for q in plain if q[0] == r[0]}) > 2 and any(q[0] == r[0] and q[4] for q in plain)}
        assert sorted(r[:5] for r in live) == sorted(r for r in plain if r[0] in keys)
        assert len({(r[0], r[5]) for r in live}) == len(live)


def test_stretches_come_once():
    """A stretch that has failed for one share is not tried again for the next."""
    rng = np.random.default_rng(17)
    for _ in range(200):
        held = rng.random(int(rng.integers(1, 200))) < 0.85
        once = [list(compact_windows._segments(held, 20, [share])) for share in (0.8, 0.85, 1.0)]
        found = list(compact_windows._segments(held, 20, [0.8, 0.85, 1.0]))
        assert len(set(found)) == len(found) and set(found) == set().union(*once)


def test_windows_of_a_run_take_one_step(monkeypatch):
    """A value that stands 5,000 times in a row, in a text of others: the windows of a plain tree, in few steps."""
    rng = np.random.default_rng(4)
    own = np.concatenate([rng.integers(1, 2**63, 100), np.full(5000, 7), rng.integers(1, 2**63, 100)]).astype(np.uint64)
    calls, mix = [], compact_windows._mix
    values = [mix(own, j + 1) for j in range(2)]
    monkeypatch.setattr(compact_windows, "_mix", lambda x, seed: calls.append(seed) or mix(x, seed))
    found = compact_windows.windows(values, np.array([0]), np.array([len(own)]), 46)
    want = set()
    for v in values:
        high, todo = v >> np.uint64(24), [(0, len(own) - 1)]
        while todo:
            a, b = todo.pop()
            if b - a + 1 >= 46:
                c = a + int(np.argmin(high[a : b + 1]))
                want |= {(a, c, b)} if max(c - a, b - c) >= 23 else set()
                todo += [(a, c - 1), (c + 1, b)]
    assert set(zip(*[x.tolist() for x in found[1:]])) == want and len(calls) < 400


def test_places_in_dense_stretches():
    """Against all stretches of at least so many places."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 40))
        own = rng.integers(0, rng.integers(2, 40), n).astype(np.uint64)
        shared = np.unique(rng.choice(own, rng.integers(0, n + 1)))
        held = {k for s, e in zip(*compact_windows._dense(own, shared, 6, 0.8)) for k in range(s, e)}
        for s in range(n):
            for e in range(s + 6, n + 1):
                different = set(own[s:e].tolist())
                if len(different & set(shared.tolist())) >= 0.8 * len(different):
                    assert held >= set(range(s, e))


def test_passages_on_tables(spark, texts):
    held = defaultdict(set)
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        for k in range(len(w) - 49):
            held[tuple(w[k : k + 50])].add(i)
    need = {i for s in held.values() if len(s) > 1 for i in s}
    assert need <= {r.doc_id for r in queries.op7_compact_windows(spark, SF).collect()}


# 8


def _encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(edge):
    encoding = _encoding()
    for r in OPERATORS["bpe"](edge).collect():
        text = dict(EDGE)[r.doc_id] or ""
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == encoding.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()


def test_bpe_pieces():
    encoding, vocab = _encoding(), bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(2)
    held = ["".join(rng.choice("abcdefghij é\n'") for _ in range(rng.randint(0, 400))) for _ in range(100)] + [" " * 500, "a" * 3000]
    split = regex.compile(public_tokenizers.PATTERN).findall
    for text, ids in zip(held, vocab.encode_texts([split(t) for t in held])):
        assert ids.tolist() == encoding.encode_ordinary(text)


# 9


@pytest.mark.skipif(not Path("/usr/share/common-licenses/GPL-3").exists(), reason="no licence texts on this machine")
def test_whole_licence_texts(spark):
    names = {"Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}
    rows = []
    for k, f in enumerate(names):
        text = Path("/usr/share/common-licenses", f).read_text(encoding="utf-8")
        rows += [(10 * k, text), (10 * k + 1, "Copyright (c) 2020 A. Person\n" + text.upper().replace(" ", "  ").replace("ORGANIZATION", "organisation")), (10 * k + 2, text[:-200])]
    found = {r.doc_id: r.license for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), licenses.known_digests(spark)).collect()}
    for k, name in enumerate(names.values()):
        assert [found[10 * k], found[10 * k + 1], found[10 * k + 2]] == [name, name, None]


def test_licences_of_a_folder(spark, tmp_path):
    (tmp_path / "House-1.0.txt").write_text("Copyright 2020 House\nUse it, but never on a Sunday.\n")
    (tmp_path / "House 2+").write_text("Use it, whilst you can.")
    texts = licenses.known_texts(spark, f"file://{tmp_path}")
    same = spark.createDataFrame([("House-1.1", "use it but never on a sunday"), ("empty", ""), ("none", None)], "name string, text string")
    known = licenses.known_digests(spark, texts=texts.unionByName(same))
    rows = [(1, "USE IT -- but never on a Sunday!"), (2, "use it while you can\n(c) 2021 me"), (3, ""), (4, "Some words.\n  Use it, while you can.")]
    got = {r.doc_id: (r.license, r.notices) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()}
    assert got == {1: ("House-1.0,House-1.1", "House-1.0,House-1.1"), 2: ("House 2+", "House 2+"), 3: (None, ""), 4: (None, "House 2+")}


def test_licences(spark):
    mit = dict(licenses.KNOWN[:1])["MIT"]
    rows = [
        (1, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ,")),
        (2, "Some text\nreleased under the  MIT licence\nLicensed under CC BY-NC 4.0."),
        (3, None),
        (4, ""),
        (5, "the MIT License."),
        (6, mit + " and more"),
    ]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), licenses.known_digests(spark)).collect()}
    assert got[1].license == "MIT" and got[2].license is None and got[2].notices == "CC-BY-NC-4.0,MIT"
    assert got[3].text_digest is None and [got[k].license for k in (4, 5, 6)] == [None] * 3


# 10

ODD = [
    "a@b.c_d@e.f x@@y.z a@b.c@d.e",
    "1.2.3.4.5.6.7.8 300.1.2.3.4 1.2.3 ..1.1.1.1 000000000000000255.1.1.1",
    "4785380592391139 4785 3805-9239 1139  47 85380592391139 99",
    "+1 (743) 555-3824, +12 +1234567(  +49 30 1234567 8",
    "x" * 30_000 + " a@b.co",
    "1" * 30_000,
    "a." * 10_000 + "@x.y",
]


def test_pii(spark, edge):
    docs = edge.select("doc_id", "text").union(spark.createDataFrame([(100 + k, t) for k, t in enumerate(ODD)], "doc_id long, text string"))
    held = dict(EDGE) | {100 + k: t for k, t in enumerate(ODD)}
    for r in pii.find_pii(docs).collect():
        assert [(s.kind, s.start, s.end) for s in r.base] == brute.pii(held[r.doc_id])


def test_pii_bootstrap_and_redaction(spark):
    seeds = [(k, f"note customer key {'%040x' % (k * 7919)} end") for k in range(8)]
    rows = [*seeds, (20, "note customer key QX-7781-Z end"), (21, "plain 12345 words"), (22, "mail me@x.org or é@ +1 (743) 555-3824.")]
    found = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"), carry=("text",)).withColumn("out", pii.redact(F.col("text"), F.col("spans"))).collect()}
    assert found[20].out == "note customer key [ID] end" and found[21].spans == []
    assert found[22].out == "mail [EMAIL] or é@ [PHONE]."


def _plain_patterns(slots, rounds=3, min_seeds=5, min_score=0.8):
    edges = {}
    for context, value, seed in slots:
        if context is not None:
            edges[context, value] = edges.get((context, value), False) or seed
    seeds, sure = {e for e, seed in edges.items() if seed}, {}
    while True:
        held = Counter(c for c, _ in seeds)
        live = [e for e in edges if held[e[0]] >= min_seeds]
        score = {e: float(e in seeds) for e in live}
        for _ in range(rounds):
            of = {c: [score[e] for e in live if e[0] == c] for c, _ in live}
            mean = {c: sum(v) / len(v) for c, v in of.items()}
            doubt = defaultdict(lambda: 1.0)
            for c, v in live:
                doubt[v] *= 1 - min(mean[c], 0.999)
            score = {e: 1.0 if e in seeds else 1 - doubt[e[1]] for e in live}
        before, sure = sure, {c: (round(mean[c], 9), held[c]) for c in mean if mean[c] >= min_score} if live else {}
        if len(sure) in (len(before) if before else -1, 0):
            return sure
        found = {v for c, v in edges if c in sure}
        seeds |= {e for e in edges if e[1] in found}


def test_pii_patterns_against_a_plain_version(spark):
    rng = random.Random(11)
    slots = [(None if rng.random() < 0.1 else f"w{rng.randint(0, 12)} x", rng.randint(0, 90), False) for _ in range(700)]
    slots += [(f"key {c}", 1000 + rng.randint(0, 20) + 8 * c, c == 0 or rng.random() < 0.05) for c in range(6) for _ in range(60)]
    got = {r.context: (round(r.score, 9), r.seeds) for r in pii.learn_patterns(spark.createDataFrame(slots, "context string, value long, seed boolean")).collect()}
    want = _plain_patterns(slots)
    assert got == want and len(want) > 2


def test_pii_found_identifiers_are_seeds_of_other_contexts(spark):
    """The second phrase has no seed of a known form beside it: only codes that the first phrase finds; the third is learned from the second."""
    rows = [(k, f"note customer key {'%040x' % (k * 7919)} end") for k in range(30)]
    rows += [(100 + k, f"note customer key QX-77{k}-Z end") for k in range(6)]
    rows += [(200 + k, f"the member code QX-77{k}-Z was given") for k in range(6)] + [(250, "the member code LL-9041 was given")]
    rows += [(300 + k, f"the lot number 44{k}-B was given") for k in range(9)]
    found = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"), carry=("text",)).collect()}
    assert [found[250].text[s.start : s.end] for s in found[250].spans] == ["LL-9041"]
    assert all(found[200 + k].spans for k in range(6)) and not any(found[300 + k].spans for k in range(9))

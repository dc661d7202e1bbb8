"""The queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.materialize import materialize, new_path
from . import bpe, compact_windows, exact_dedup, filter_audit, licenses, merkle, packing, pii, quality, sharding, simhash, suffix_dedup, webp


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of whole documents at three bits or fewer."""
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production threshold table over whole documents."""
    found = quality.judged(documents(spark, sf_dir), ["doc_id"])
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "base_failed", "kept")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in whole documents: base spans and learned ones."""
    found = pii.find_pii(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of whole documents and of their single lines."""
    return licenses.scan(documents(spark, sf_dir), licenses.known_digests(spark))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen arrivals, each appended as a version with the compaction it calls for, and read back from the last manifest."""
    store = sharding.ShardStore(spark, new_path(spark, "shards"))
    store.append_arrivals(documents(spark, sf_dir), F.pmod(F.xxhash64("doc_id"), F.lit(16)).cast("int"))
    rows = store.read()
    return rows.select("doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("text_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents encoded by ranks and decoded again."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = bpe.decode(bpe.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN), path)
    return found.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokenized documents packed into sequences of 1024 tokens."""
    cut = packing.pieces(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return packing.pack(materialize(cut, "pieces"))


def op3_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents stored as lossless WebP, read back and described."""
    stored = materialize(webp.store(documents(spark, sf_dir)), "media", codec="uncompressed")
    return webp.features(webp.read_pixels(stored))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by repeated strings of 200 bytes, removed from whole documents."""
    return suffix_dedup.deduplicated(documents(spark, sf_dir))


def op7_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate passages of fifty words or more, as pairs of documents."""
    return compact_windows.near_passages(documents(spark, sf_dir))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among whole documents, white space aside."""
    found = exact_dedup.exact_copies(documents(spark, sf_dir), every_digest=True)
    return found.withColumnRenamed("digest", "text_sha256")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of all documents by language, its proofs, and their check after a tampering."""
    return merkle.audited(documents(spark, sf_dir))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over whole documents in all 120 orders."""
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _merkle_sql(depth: int = 8, top: int = 3) -> str:
    """The manifest in SQL, for groups of up to 8 ** ``depth`` leaves and up to 8 ** ``top`` groups."""
    leaf = lambda t: "sha256(concat(" + ", ".join(f"coalesce(concat(octet_length(encode(CAST({c} AS VARCHAR))), ':', CAST({c} AS VARCHAR)), '-')" for c in ("doc_id", "source", "lang", "n_chars", t)) + "))"
    crc = "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda z: ascii(z)::BIGINT)), lambda c, z: list_reduce(list_concat([xor(c, z)], [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]), lambda y, k: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END)), 4294967295::BIGINT)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def level(name: str, source: str) -> str:
        """One node a row with what its siblings are; a node alone in its group stays as it is."""
        run = "PARTITION BY k, idx // 8 ORDER BY idx ROWS BETWEEN"
        return f"""{name} AS (SELECT k, idx, n, h, CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS before,
  CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS after FROM {source})"""

    def up(name: str, below: str) -> str:
        return f"{name} AS (SELECT DISTINCT k, idx // 8 AS idx, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(concat(before, h, after)) ELSE h END AS h FROM {below})"

    parts = [
        f"""leaves AS (SELECT doc_id, lang, {leaf("text")} AS leaf, {leaf(f"CASE WHEN {crc} % 3 = 0 THEN translate(text, '{upper}', '{lower}') ELSE text END")} AS tampered FROM documents)""",
        "z0 AS (SELECT coalesce('=' || lang, '') AS k, doc_id, tampered, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n, leaf AS h FROM leaves)",
        level("l0", "z0"),
    ]
    for d in range(1, depth + 1):
        parts += [up(f"z{d}", f"l{d - 1}"), level(f"l{d}", f"z{d}")]
    parts += [f"t0 AS (SELECT '' AS k, k AS g, row_number() OVER (ORDER BY k) - 1 AS idx, count(*) OVER () AS n, h FROM z{depth})", level("u0", "t0")]
    for d in range(1, top + 1):
        parts += [up(f"t{d}", f"u{d - 1}"), level(f"u{d}", f"t{d}")]
    steps = [(f"l{d}.before", f"l{d}.after", f"l{d}.n") for d in range(depth)] + [(f"u{d}.before", f"u{d}.after", f"u{d}.n") for d in range(top)]
    joins = " ".join([f"JOIN l{d} ON l{d}.k = z0.k AND l{d}.idx = z0.idx // {8**d}" for d in range(depth)] + ["JOIN t0 ON t0.g = z0.k"] + [f"JOIN u{d} ON u{d}.idx = t0.idx // {8**d}" for d in range(top)])
    paths = ", ".join(f"{{'b': {b}, 'a': {a}, 'n': {n}}}" for b, a, n in steps)
    parts.append(f"p AS (SELECT z0.doc_id, z0.h AS leaf, t0.h AS subroot, z0.tampered, [{paths}] AS path FROM z0 {joins})")
    fold = "list_reduce(list_concat([{'b': '', 'a': tampered, 'n': 1}], path), lambda x, y: {'b': '', 'a': CASE WHEN y.n > 1 THEN sha256(concat(y.b, x.a, y.a)) ELSE x.a END, 'n': 1}).a"
    parts.append(f"f AS (SELECT doc_id, leaf, subroot, (SELECT max(h) FROM t{top}) AS root, sha256(array_to_string(list_transform(path, lambda s: concat(s.b, s.a)), '')) AS proof_sha256, {fold} AS folded_root FROM p)")
    return "WITH " + ",\n".join(parts) + "\nSELECT *, folded_root = root AS verified FROM f"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op7_compact_windows": op7_compact_windows,
    "op1_suffix_dedup": op1_suffix_dedup,
    "op3_webp": op3_webp,
    "op5_packing": op5_packing,
    "op8_bpe": op8_bpe,
    "op2_sharding": op2_sharding,
    "op9_licenses": op9_licenses,
    "op10_pii": op10_pii,
    "op6_quality": op6_quality,
    "op4_simhash": op4_simhash,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_merkle": op12_merkle,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op6_quality": r"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
m AS (
  SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(list_filter(w, lambda x: lower(x) IN ('a', 'an', 'and', 'are', 'as', 'at', 'au', 'auf', 'aux', 'avec', 'be', 'but', 'by', 'ce', 'como', 'con', 'dans', 'das', 'de', 'del', 'dem', 'den', 'der', 'des', 'die', 'du', 'ein', 'eine', 'el', 'elle', 'en', 'es', 'est', 'et', 'for', 'from', 'für', 'has', 'have', 'il', 'in', 'is', 'ist', 'it', 'la', 'las', 'le', 'les', 'lo', 'los', 'mit', 'ne', 'nicht', 'no', 'not', 'of', 'on', 'or', 'para', 'pas', 'por', 'pour', 'que', 'qui', 'se', 'su', 'that', 'the', 'this', 'to', 'un', 'una', 'und', 'une', 'von', 'was', 'were', 'with', 'y', 'you', 'zu'))) AS BIGINT) AS n_stop_words
  FROM d),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM m WHERE len(w) >= 8)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY doc_id),
j AS (SELECT m.*, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words FROM m LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 12.0 AND n_symbols / n_words <= 0.1
       AND (n_words < 50 OR n_stop_words / n_words >= 0.01) AND (n_words < 50 OR n_dup_lines / n_lines <= 0.3) AS kept
FROM b""",
    "op9_licenses": r"""WITH known_text(name, txt) AS (VALUES
('MIT', 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
('BSD-2-Clause', 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
('BSD-3-Clause', 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
('ISC', 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
('0BSD', 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
('MIT', 'Released under the MIT License.'),
('MIT', 'Licensed under the MIT License.'),
('MIT', 'SPDX-License-Identifier: MIT'),
('Apache-2.0', 'Licensed under the Apache License, Version 2.0.'),
('Apache-2.0', 'SPDX-License-Identifier: Apache-2.0'),
('BSD-3-Clause', 'SPDX-License-Identifier: BSD-3-Clause'),
('GPL-3.0', 'This work is licensed under the GNU General Public License, version 3.'),
('GPL-3.0', 'SPDX-License-Identifier: GPL-3.0'),
('CC-BY-NC-4.0', 'Licensed under CC BY-NC 4.0.'),
('CC-BY-4.0', 'Licensed under CC BY 4.0.'),
('CC-BY-SA-4.0', 'Licensed under CC BY-SA 4.0.'),
('CC0-1.0', 'This work is dedicated to the public domain under CC0 1.0.')),
known AS (SELECT h, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM (SELECT name, sha256(trim(regexp_replace(c, '[\x20\n]+', ' ', 'g'))) AS h FROM (SELECT name, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(lower(txt), '(?m)^[^a-z0-9\n]*(?:copyright|\(c\)|©)[^\n]*$', '', 'g'), '[!-/:-@\[-`{-~©®™“”‘’«»–—…·•]+', ' ', 'g'), '[\x20\t\x0b\x0c\r]+', ' ', 'g'), 'licence', 'license'), 'sub license', 'sublicense'), 'non commercial', 'noncommercial'), 'favour', 'favor'), 'acknowledgement', 'acknowledgment'), 'isation', 'ization'), 'analogue', 'analog'), 'artefact', 'artifact'), 'catalogue', 'catalog'), 'centre', 'center'), 'judgement', 'judgment'), 'labour', 'labor'), 'offence', 'offense'), 'practise', 'practice'), 'programme', 'program'), 'whilst', 'while'), 'wilful', 'willful'), 'per cent', 'percent'), 'https', 'http') AS c FROM known_text) UNION ALL SELECT * FROM (VALUES
('Apache-2.0', 'ff7be961361eda3cd2a76927dd0d9482cf45defafde2045befedf77400d98100'),
('Artistic-1.0', 'ddb49d591ecc4f65a223b9f53f330918100c323532a653c090d21b38e35a3a42'),
('BSD-3-Clause', '3d151449461c0c776e892a4dc41cac0d251eb00c9fc49d2d48802d9bed818fe9'),
('CC0-1.0', '96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f'),
('GFDL-1.2', '19d29a7c800a0d85704b63b4c09d5cd01dd9a287c61e238f4717d8a9e75d214f'),
('GFDL-1.3', 'e70f40f3a50995855f972521fe4eaa4af360a4597e5914977b6093cce5243480'),
('GPL-1.0', 'ecffd792bbe30a8f068c26179a7995c53247219322c9fdd6010c935476aec4fd'),
('GPL-2.0', 'ceb13cdc7143ca5f58fb64136b9b542b00470d4db4dbcee1328c6250bf845b08'),
('GPL-3.0', 'baa8c61cc079d9c70231aa29a72e8c512fc4474cf75133d41bc9aacb7768b6eb'),
('LGPL-2.0', 'bb476e23f93731f9ea53e5e7b83c7b6a59108767834823d05ca20e6446de79bf'),
('LGPL-2.1', 'a85084b195866fe5aa81ee399a54444581dffa68e7bb2559e143718f6e2693bb'),
('LGPL-3.0', 'aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be'),
('MPL-1.1', 'f77c59051c0127d677dcce7ba0d4733294974749a7b4155250912498d92767d6'),
('MPL-2.0', '95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9')) x(name, h)) GROUP BY h),
f AS (SELECT doc_id, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')), '(?m)^[^a-z0-9\n]*(?:copyright|\(c\)|©)[^\n]*$', '', 'g'), '[!-/:-@\[-`{-~©®™“”‘’«»–—…·•]+', ' ', 'g'), '[\x20\t\x0b\x0c\r]+', ' ', 'g'), 'licence', 'license'), 'sub license', 'sublicense'), 'non commercial', 'noncommercial'), 'favour', 'favor'), 'acknowledgement', 'acknowledgment'), 'isation', 'ization'), 'analogue', 'analog'), 'artefact', 'artifact'), 'catalogue', 'catalog'), 'centre', 'center'), 'judgement', 'judgment'), 'labour', 'labor'), 'offence', 'offense'), 'practise', 'practice'), 'programme', 'program'), 'whilst', 'while'), 'wilful', 'willful'), 'per cent', 'percent'), 'https', 'http') AS c FROM documents),
w AS (SELECT doc_id, trim(regexp_replace(c, '[\x20\n]+', ' ', 'g')) AS d FROM f),
l AS (SELECT DISTINCT doc_id, sha256(trim(regexp_replace(x, '[\x20\n]+', ' ', 'g'))) AS h FROM (SELECT doc_id, unnest(string_split(c, chr(10))) AS x FROM f)),
n AS (SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS notices FROM (SELECT doc_id, unnest(string_split(names, ',')) AS name FROM l JOIN known USING (h)) GROUP BY doc_id)
SELECT w.doc_id, CASE WHEN w.d <> '' THEN sha256(w.d) END AS text_digest, known.names AS license, coalesce(n.notices, '') AS notices
FROM w LEFT JOIN known ON sha256(w.d) = known.h LEFT JOIN n ON w.doc_id = n.doc_id""",
    "op2_sharding": r"""SELECT doc_id, lang, source, n_chars, sha256(text) AS text_sha256 FROM documents""",
    "op11_exact_dedup": r"""WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    "op12_merkle": _merkle_sql(),
    "op13_filter_audit": r"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 3 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 16 ELSE 0 END AS mask FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, 1 << (ascii(filter_order[step]) - 65) AS own,
    CAST(coalesce(list_sum(list_transform(string_split(filter_order[1:step - 1], ''), lambda z: CASE WHEN z = '' THEN 0 ELSE 1 << (ascii(z) - 65) END)), 0) AS INTEGER) AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
x AS (SELECT part, filter_order, step, n, good, toxic, mask, own, mask & own <> 0 AS fails, mask & before <> 0 AS gone FROM c, s),
r AS (SELECT part, filter_order, step, own, sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost FROM x GROUP BY ALL),
v AS (SELECT part, own, sum(removed) AS shapley FROM r GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(shapley AS BIGINT) AS shapley FROM r JOIN v USING (part, own)""",
}

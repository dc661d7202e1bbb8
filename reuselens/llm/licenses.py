"""Licence scans: canonical digests of entire texts, hash-joined to known ones.

A unit (a whole document, or one line of it) is put in canonical form: lower
case, copyright lines dropped, punctuation to spaces, equivalent spellings
folded, white space collapsed. Its digest is joined to the digests of known
licence texts and notices, put in the same form by the same expression.

Only DataFrame functions run. The known table is joined without a hint: Spark
broadcasts it while it is under the session's threshold and shuffles beyond.

Edge cases: null, empty and punctuation-only units match nothing; a text that
is listed under several names gives all of them, sorted; repeated rows are
scanned alike, each for itself; other columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.materialize import materialize

# Patterns of the canonical form, in order of use; they read alike in Java and RE2.
COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(?:copyright|\(c\)|©)[^\n]*$"
PUNCTUATION = r"[!-/:-@\[-`{-~©®™“”‘’«»–—…·•]+"
EQUIVALENT = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("favour", "favor"),
    ("acknowledgement", "acknowledgment"),
    ("isation", "ization"),
    ("analogue", "analog"),
    ("artefact", "artifact"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("offence", "offense"),
    ("practise", "practice"),
    ("programme", "program"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("per cent", "percent"),
    ("https", "http"),
)

# Public licence texts and notices, word for word.
_WARRANTY_MIT = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_WARRANTY_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
KNOWN = (
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n'
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n" + _WARRANTY_MIT,
    ),
    ("BSD-2-Clause", _BSD_CLAUSES + _WARRANTY_BSD),
    (
        "BSD-3-Clause",
        _BSD_CLAUSES
        + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
        + _WARRANTY_BSD,
    ),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_WARRANTY),
    ("0BSD", _ISC_GRANT + ".\n" + _ISC_WARRANTY),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
)

# Digests of the canonical form of whole public licence texts, as Debian distributes them.
KNOWN_DIGESTS = (
    ("Apache-2.0", "ff7be961361eda3cd2a76927dd0d9482cf45defafde2045befedf77400d98100"),
    ("Artistic-1.0", "ddb49d591ecc4f65a223b9f53f330918100c323532a653c090d21b38e35a3a42"),
    ("BSD-3-Clause", "3d151449461c0c776e892a4dc41cac0d251eb00c9fc49d2d48802d9bed818fe9"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "19d29a7c800a0d85704b63b4c09d5cd01dd9a287c61e238f4717d8a9e75d214f"),
    ("GFDL-1.3", "e70f40f3a50995855f972521fe4eaa4af360a4597e5914977b6093cce5243480"),
    ("GPL-1.0", "ecffd792bbe30a8f068c26179a7995c53247219322c9fdd6010c935476aec4fd"),
    ("GPL-2.0", "ceb13cdc7143ca5f58fb64136b9b542b00470d4db4dbcee1328c6250bf845b08"),
    ("GPL-3.0", "baa8c61cc079d9c70231aa29a72e8c512fc4474cf75133d41bc9aacb7768b6eb"),
    ("LGPL-2.0", "bb476e23f93731f9ea53e5e7b83c7b6a59108767834823d05ca20e6446de79bf"),
    ("LGPL-2.1", "a85084b195866fe5aa81ee399a54444581dffa68e7bb2559e143718f6e2693bb"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "f77c59051c0127d677dcce7ba0d4733294974749a7b4155250912498d92767d6"),
    ("MPL-2.0", "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9"),
)


def canonical(text: Column) -> Column:
    """The canonical form; line breaks stay until the last step of :func:`digest`."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT_LINE, ""), PUNCTUATION, " ")
    spaced = F.regexp_replace(bare, r"[\x20\t\x0b\x0c\r]+", " ")
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), EQUIVALENT, spaced)


def digest(form: Column) -> Column:
    """Digest of a canonical form as one run of words; null if it has none."""
    words = F.trim(F.regexp_replace(form, r"[\x20\n]+", " "))
    return F.when(words != "", F.sha2(words, 256))


def known_texts(spark: SparkSession, folder: str) -> DataFrame:
    """``(name, text)`` of a folder with a file a licence, named as the licence is, with or without ``.txt``."""
    files = spark.read.text(folder, wholetext=True)
    name = F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"\.txt$", "")
    return files.select(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("name"), F.col("value").alias("text"))


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN, digests: tuple[tuple[str, str], ...] = KNOWN_DIGESTS, texts: DataFrame | None = None) -> DataFrame:
    """``(digest, names)`` of a list of licence texts, one of digests of canonical forms, and ``texts (name, text)`` of any number."""
    table = spark.createDataFrame(list(known), "name string, text string")
    table = table if texts is None else table.unionByName(texts.select("name", "text"))
    table = table.select("name", digest(canonical(F.col("text"))).alias("digest"))
    named = table.unionByName(spark.createDataFrame(list(digests), "name string, digest string")).where("digest is not null")
    return named.groupBy("digest").agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("names"))


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_digest, license, notices)`` for each row: the names of
    the whole text, or null, and those of its single lines, sorted and joined."""
    form = F.transform(F.array(canonical(F.coalesce(F.col(text_col), F.lit("")))), lambda f: F.struct(digest(f).alias("whole"), F.array_distinct(F.transform(F.split(f, "\n", -1), digest)).alias("lines")))[0]
    rows = docs.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"), form.alias("_f")).select("_id", "_row", "_f.whole", "_f.lines")
    rows = materialize(rows, "licences")
    lines = rows.select("_row", F.explode("lines").alias("digest")).where("digest is not null").join(known, "digest")
    named = lines.groupBy("_row").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.split("names", ","))))), ",").alias("notices"))
    whole = known.select(F.col("digest").alias("whole"), F.col("names").alias("license"))
    return (
        rows.join(whole, "whole", "left")
        .join(named, "_row", "left")
        .select(F.col("_id").alias(id_col), F.col("whole").alias("text_digest"), "license", F.coalesce("notices", F.lit("")).alias("notices"))
    )

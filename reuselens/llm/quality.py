"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a built-in expression over the whole text of one row; there
are no user functions, joins or shuffles.

Edge cases: null text counts as no text; a ratio over nothing is zero; a text
without a word has base_failed set; repeated rows are judged alike; columns of
the input that are not named are left alone; an empty table stays empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.let import let

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be but by for from has have in is it not of on or that the this to was were with you "
    "auf das dem den der des die ein eine ist nicht und von zu mit für "
    "au aux avec ce de des du elle en est et il la le les ne pas pour que qui un une dans "
    "como con del el en es las los no para por se su una y lo"
).split()


@dataclass(frozen=True)
class Rule:
    """A document with at least ``min_words`` words fails unless low <= measure <= high."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


#: The production threshold table.
RULES = (
    Rule("mean_word_length", "word_chars / n_words", 2.0, 12.0, 20),
    Rule("symbol_ratio", "n_symbols / n_words", None, 0.1, 20),
    Rule("stop_word_ratio", "n_stop_words / n_words", 0.01, None, 50),
    Rule("duplicate_line_ratio", "n_dup_lines / n_lines", None, 0.3, 50),
)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of WINDOW words found twice or more in the text."""

    def pairs(step: int):
        return lambda h: F.when(
            F.size(h) > step,
            F.zip_with(F.slice(h, 1, F.size(h) - step), F.slice(h, step + 1, F.size(h) - step), lambda a, b: F.xxhash64(a, b)),
        ).otherwise(F.array().cast("array<bigint>"))

    def covered(at: Column) -> Column:
        # at: sorted starts of repeated windows; the next start (or the end of the last window) bounds what each adds
        return F.aggregate(
            F.transform(at, lambda p, i: F.coalesce(F.least(F.get(at, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0).cast("bigint"),
            lambda s, x: s + x,
        )

    def starts(rows: Column) -> Column:
        same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
        marked = F.transform(rows, lambda x, i: F.when(same(x, F.get(rows, i - 1)) | same(x, F.get(rows, i + 1)), x["i"]))
        return F.sort_array(F.filter(marked, lambda p: p.isNotNull()))

    def count(windows: Column) -> Column:
        rows = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(let(let(rows, starts), covered))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("bigint")).otherwise(let(let(let(let(hashed, pairs(1)), pairs(2)), pairs(4)), count))


def measures(text: Column) -> Column:
    """One struct of all measures of a text."""
    whole = F.coalesce(text, F.lit(""))

    def struct(words: Column) -> Column:
        lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(WORD))
        line_counts = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.char_length(F.translate(whole, SPACES, "")).cast("bigint").alias("word_chars"),
            (F.char_length(whole) - F.char_length(F.translate(whole, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            line_counts.alias("lines"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("bigint").alias("n_stop_words"),
            _repeat_words(words).alias("n_repeat_words"),
        )

    return let(F.regexp_extract_all(whole, F.lit(WORD), 0), struct)


def _ratio(rule: Rule, m: dict[str, Column]) -> Column:
    top, below = (m[x.strip()] for x in rule.measure.split("/"))
    return F.when(below == 0, F.lit(0.0)).otherwise(top / below)


def _verdict(m: dict[str, Column], rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """base_failed, and the names of failed rules."""
    base = (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])
    failures = []
    for r in rules:
        x = _ratio(r, m)
        broken = F.lit(False)
        if r.low is not None:
            broken = broken | (x < r.low)
        if r.high is not None:
            broken = broken | (x > r.high)
        failures.append(F.when((m["n_words"] >= r.min_words) & broken, F.lit(r.name)))
    return base, F.filter(F.array(*failures), lambda x: x.isNotNull()) if failures else F.array().cast("array<string>")


def _named(m: Column) -> dict[str, Column]:
    plain = {c: m[c] for c in ("n_words", "word_chars", "n_symbols", "n_stop_words", "n_repeat_words")}
    return plain | {"n_dup_lines": m["lines"]["dup"].cast("bigint"), "n_lines": m["lines"]["n"].cast("bigint")}


def passes(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a text is kept, as one predicate."""

    def verdict(m: Column) -> Column:
        base, failed = _verdict(_named(m), rules)
        return ~base & (F.size(failed) == 0)

    return let(measures(text), verdict)


def judged(docs: DataFrame, keep: list[str], text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``keep`` columns, the measures, base_failed, kept and the names of failed rules."""
    held = docs.select(*[F.col(f"`{c}`") for c in keep], measures(F.col(text_col)).alias("_m"))
    m = _named(F.col("_m"))
    base, failed = _verdict(m, rules)
    return held.select(
        *[F.col(f"`{c}`") for c in keep],
        *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")],
        base.alias("base_failed"),
        failed.alias("failed_rules"),
        (~base & (F.size(failed) == 0)).alias("kept"),
    )

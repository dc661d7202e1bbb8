"""Personal data by fixed forms and by bootstrapped contextual extraction.

Base spans come from regular expressions with checks (parts of an address,
Luhn digits, digit counts). A bootstrap then looks for identifiers that no
form describes: base spans and key-like tokens are seed entities, the two words
before a seed induce a lexical pattern, and every token with a digit or an
``@`` that follows the same words is an instance of the pattern. Scores flow
over the pattern-instance graph for a few rounds: a pattern scores the mean of
its distinct instances, an instance one minus the product of its patterns'
doubts. Patterns with enough distinct seeds and a high score are sure: their
instances are new spans and seeds of the next step, in which they can make
further contexts sure, until a step adds none.

All of it is DataFrame expressions; nothing runs in Python workers, and nothing
but counts of patterns leaves the executors. Positions are code points.

Edge cases: null text is empty text; a document without personal data has zero
counts and empty digests; repeated rows are scanned alike, each for itself;
columns not named in ``carry`` are dropped before the scan; an empty table
gives an empty table. Very long texts take time in proportion to n log n for n
matches: places are sums by doubling, slices are cut from blocks, and a run of
letters or digits is entered only at its start or where the last match ended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.let import let
from ..plans.materialize import drop_tables, materialize

KINDS = ("email", "ip", "card", "phone")
LEARNED = "id"
_LOCAL = "A-Za-z0-9._%+-"
# Same matches as the plain forms, entered only at the start of a run; repeated
# groups are possessive, which keeps the matcher from one stack frame a repeat.
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A document without this has no match of the kind.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
SECRET = r"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|[0-9a-f]{40})"
TOKEN = r"(?<![^\s])[^\s0-9@]*+[0-9@][^\s]*+"
EDGE = "\"'`.,;:!?()[]{}<>*#$%&|"
_SPAN = "struct<kind:string,start:bigint,end:bigint,value:string>"
_NO_SPANS = f"array<{_SPAN}>"


#: Distances of a scan by doubling; an array has fewer than 2**31 elements.
_STEPS = [1 << k for k in range(31)]
_BLOCK = 256


def _scan(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """``combine`` of all elements up to each one: a scan by doubling, log n passes over an array of longs."""
    steps = F.filter(F.array(*[F.lit(k) for k in _STEPS]), lambda k: k < F.size(values))
    return F.aggregate(steps, values, lambda a, k: F.transform(a, lambda x, i: F.when(i >= k, combine(a[i - k], x)).otherwise(x)))


def _placed(text: Column, pattern: str, kind: str) -> Column:
    """All matches with their places: sums over the gaps between matches and the matches give the ends."""

    def spans(found: Column, gaps: Column) -> Column:
        sizes = F.transform(found, lambda v, i: (F.char_length(gaps[i]) + F.char_length(v)).cast("bigint"))
        ends = lambda x: _scan(x, lambda a, b: a + b)
        span = lambda v, end: F.struct(F.lit(kind).alias("kind"), (end - F.char_length(v)).alias("start"), end.alias("end"), v.alias("value"))
        return let(let(sizes, ends), lambda e: F.transform(found, lambda v, i: span(v, e[i])))

    none = F.array().cast(_NO_SPANS)
    return let(F.regexp_extract_all(text, F.lit(pattern), 0), lambda found: F.when(F.size(found) == 0, none).otherwise(let(F.split(text, pattern, -1), lambda gaps: spans(found, gaps))))


def _blocks(text: Column) -> Column:
    """The text in blocks of ``_BLOCK`` code points, so that a slice isn't searched from the start of the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), 0)


def _slice(blocks: Column, start: Column, end: Column) -> Column:
    """The code points [start, end)."""
    first = F.floor(start / _BLOCK)
    count = F.floor((end - 1) / _BLOCK) - first + 1
    near = F.array_join(F.slice(blocks, (first + 1).cast("int"), F.greatest(count, F.lit(0)).cast("int")), "")
    return F.substring(near, (start - first * _BLOCK + 1).cast("int"), (end - start).cast("int"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    total = F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda d, i: let(d.cast("int") * (i % 2 + 1), lambda x: F.when(x > 9, x - 9).otherwise(x)),
        ),
        F.lit(0),
        lambda s, x: s + x,
    )
    return total % 10 == 0


CHECKS = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(F.split(v, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False))),
    "card": lambda v: let(_digits(v), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(F.lit(False))),
    "phone": lambda v: F.length(_digits(v)).between(8, 15),
}


def base_spans(text: Column, kind: str) -> Column:
    """Spans of one kind, leftmost and non-overlapping, checked."""
    found = F.filter(_placed(text, PATTERNS[kind], kind), lambda s: CHECKS[kind](s["value"]))
    if not NEEDS[kind]:
        return found
    return F.when(F.instr(text, NEEDS[kind]) > 0, found).otherwise(F.array().cast(_NO_SPANS))


def _context(blocks: Column, start: Column) -> Column:
    """The two words before a place, lower case; null where there aren't two."""
    near = _slice(blocks, F.greatest(start - 64, F.lit(0)), start)
    found = F.regexp_extract(F.lower(near), r"(?:^|\s)(\S+\s+\S+)\s+\S*$", 1)
    return F.nullif(F.regexp_replace(found, r"\s+", " "), F.lit(""))


def _free(tokens: Column, base: Column) -> Column:
    """The tokens that no base span overlaps: sorted together, the greatest end
    of the base spans before a token and the least start of those after it decide."""
    bounds = lambda s, own: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(own).alias("token"), s.alias("s"))
    both = F.array_sort(F.concat(F.transform(base, lambda b: bounds(b, False)), F.transform(tokens, lambda t: bounds(t, True))))
    top = F.lit((1 << 62)).cast("bigint")

    def kept(rows: Column) -> Column:
        before = _scan(F.transform(rows, lambda r: F.when(r["token"], F.lit(0).cast("bigint")).otherwise(r["end"])), F.greatest)
        after = F.reverse(_scan(F.reverse(F.transform(rows, lambda r: F.when(r["token"], top).otherwise(r["start"]))), F.least))
        clear = lambda r, i, ends, starts: r["token"] & (ends[i] <= r["start"]) & (starts[i] >= r["end"])
        return let(before, lambda ends: let(after, lambda starts: F.transform(F.filter(rows, lambda r, i: clear(r, i, ends, starts)), lambda r: r["s"])))

    return F.when((F.size(base) == 0) | (F.size(tokens) == 0), tokens).otherwise(let(both, kept))


def _slots(text: Column, base: Column) -> Column:
    """Base spans and other identifier-like tokens, with their contexts."""
    trimmed = F.transform(
        _placed(text, TOKEN, LEARNED),
        lambda t: let(
            F.length(t["value"]) - F.length(F.ltrim(t["value"], F.lit(EDGE))),
            lambda cut: let(
                F.trim(t["value"], F.lit(EDGE)),
                lambda v: F.struct(t["kind"].alias("kind"), (t["start"] + cut).alias("start"), (t["start"] + cut + F.char_length(v)).alias("end"), v.alias("value")),
            ),
        ),
    )
    free = let(F.filter(trimmed, lambda t: F.char_length(t["value"]) >= 4), lambda t: _free(t, base))
    slot = lambda blocks, s: F.struct(
        s["kind"].alias("kind"),
        s["start"].alias("start"),
        s["end"].alias("end"),
        F.xxhash64(s["value"]).alias("value"),
        _context(blocks, s["start"]).alias("context"),
        ((s["kind"] != LEARNED) | F.coalesce(s["value"].rlike(f"^{SECRET}$"), F.lit(False))).alias("seed"),
    )
    return let(F.concat(base, free), lambda every: F.when(F.size(every) > 0, let(_blocks(text), lambda blocks: F.transform(every, lambda s: slot(blocks, s)))))


def learn_patterns(slots: DataFrame, rounds: int = 3, min_seeds: int = 5, min_score: float = 0.8) -> DataFrame:
    """``(context, score, seeds)`` of the contexts whose instances are identifiers.

    ``slots`` has ``context``, ``value`` (a hash) and ``seed``. Repeats of one
    value in one context count once, so a group of copies is no evidence.

    What a sure pattern finds is a seed of every other context from then on.
    Seeds only become more, so do the sure patterns, and the steps end when one
    adds no pattern; ``seeds`` counts the found ones too.
    """
    edges = slots.where("context is not null").groupBy("context", "value").agg(F.max("seed").alias("seed"))
    edges = materialize(edges, "pii-edges")
    # a context with fewer values than it needs seeds is never sure
    wide = edges.groupBy("context").agg(F.count("*").alias("n")).where(F.col("n") >= min_seeds).select("context")
    graph = materialize(edges.join(wide, "context"), "pii-graph", consumed=(edges,))
    sure, known = None, -1
    while True:
        able = graph.groupBy("context").agg(F.count_if("seed").alias("seeds")).where(F.col("seeds") >= min_seeds)
        live = materialize(graph.join(able, "context"), "pii-live")
        scored = live.withColumn("s", F.col("seed").cast("double"))
        patterns = None
        for _ in range(rounds):
            patterns = scored.groupBy("context").agg(F.avg("s").alias("score"), F.first("seeds").alias("seeds"))
            doubts = live.join(patterns.select("context", "score"), "context").groupBy("value").agg(F.sum(F.log1p(-F.least(F.col("score"), F.lit(0.999)))).alias("d"))
            scored = live.join(doubts, "value").withColumn("s", F.when(F.col("seed"), F.lit(1.0)).otherwise(1 - F.exp("d")))
        used = (live,) if sure is None else (live, sure)
        sure = materialize(patterns.where(F.col("score") >= min_score), "pii-patterns", consumed=used)
        before, known = known, sure.count()
        if known in (before, 0):
            break
        found = graph.join(sure.select("context"), "context", "left_semi").select("value").distinct().withColumn("found", F.lit(True))
        grown = graph.join(found, "value", "left").select("context", "value", (F.col("seed") | F.coalesce("found", F.lit(False))).alias("seed"))
        graph = materialize(grown, "pii-graph", consumed=(graph,))
    drop_tables(graph)
    return sure


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), rounds: int = 3, min_seeds: int = 5, min_score: float = 0.8) -> DataFrame:
    """``(doc_id, *carry, base, spans)`` for each row.

    ``base`` and ``spans`` are arrays of (kind, start, end, ...) by kind as
    listed, then start; ``spans`` are ``base`` and the learned ones.

    The patterns are learned from a table of slots, which holds no text. The
    learned spans depend on the text alone, so they are joined to the rows of
    a second scan by id and digest of the text: repeated rows get them alike.
    """
    whole = F.coalesce(F.col("_text"), F.lit(""))
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.struct(*[F.col(f"`{c}`") for c in carry] or [F.lit(None).cast("int").alias("_none")]).alias("_carry"))
    keyed = own.withColumns({"_k1": F.xxhash64("_id", whole), "_k2": F.unhex(F.md5(whole))})
    base = F.concat(*[base_spans(whole, k) for k in KINDS])
    slots = keyed.select("_k1", "_k2", let(base, lambda b: _slots(whole, b)).alias("slots")).where("slots is not null")
    table = materialize(slots, "pii-slots")
    slots = table.select("_k1", "_k2", F.explode("slots").alias("s")).select("_k1", "_k2", "s.*")
    patterns = learn_patterns(slots, rounds, min_seeds, min_score)
    learned = (
        slots.where(F.col("kind") == LEARNED)
        .join(patterns.select("context"), "context", "left_semi")
        .groupBy("_k1", "_k2")
        .agg(F.array_sort(F.collect_set(F.struct(F.col("kind"), "start", "end"))).alias("more"))
    )
    learned = materialize(learned, "pii-learned", consumed=(table,))
    found = keyed.withColumn("base", F.transform(base, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    return found.join(learned, ["_k1", "_k2"], "left").select(
        F.col("_id").alias(id_col),
        *[F.col("_carry")[c].alias(c) for c in carry],
        "base",
        F.concat("base", F.coalesce("more", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>"))).alias("spans"),
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, of the kind that starts first."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def joined(spans: Column, ends: Column) -> Column:
        heads = F.filter(F.transform(spans, lambda s, i: F.struct(i.alias("i"), s.alias("s"))), lambda h: F.when(h["i"] == 0, True).otherwise(h["s"]["start"] >= ends[h["i"] - 1]))

        def pieces(blocks: Column, heads: Column) -> Column:
            piece = lambda h: F.concat(_slice(blocks, F.when(h["i"] == 0, F.lit(0).cast("bigint")).otherwise(ends[h["i"] - 1]), h["s"]["start"]), F.lit("["), F.upper(h["s"]["kind"]), F.lit("]"))
            rest = _slice(blocks, F.element_at(ends, -1), F.char_length(text).cast("bigint"))
            return F.concat(F.array_join(F.transform(heads, piece), ""), rest)

        return let(heads, lambda h: let(_blocks(text), lambda blocks: pieces(blocks, h)))

    whole = let(ordered, lambda o: let(_scan(F.transform(o, lambda s: s["end"]), F.greatest), lambda ends: joined(o, ends)))
    return F.when(F.size(spans) > 0, whole).otherwise(text)

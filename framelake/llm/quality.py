"""Quality rules whose thresholds adapt to each language and source.

Each document has five measures in whole numbers. Per language, source and
measure the values are summed up in a quantile sketch: counts by bin, where a
value below 1024 is its own bin and a larger one keeps its ten leading bits, so
a quantile is off by less than 0.2 %. Sketches merge by adding counts, upwards
to languages and to the whole corpus. A measure's fences are Tukey's, the
quartiles moved out by ``SPREAD`` times their distance, and by the measure's
``slack`` at least, so a group of nearly equal clean documents loses none of
them. Fences of small groups lean on larger ones, without a jump at any size: a
group's fence is the mean of its own, weighted by its number of documents, and
its language's, weighted by ``PRIOR_DOCS``; the language's leans on the corpus's
in the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm.common import GAP_CHARS, GAP_RE, written

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
PRIOR_DOCS = 100  # documents that the fence a group leans on counts for
SPREAD = 3
# Measure -> least distance of the upper fence from the upper quartile, and of
# the lower fence from the lower one (null: no lower fence).
SLACK = {
    "symbols": (60, None),  # symbols per 1000 word characters
    "dup_lines": (400, None),  # repeated lines per 1000 lines with a word
    "repeats": (350, None),  # repeated words per 1000 words
    "capitals": (350, None),  # A-Z per 1000 word characters
    "word_length": (600, 250),  # word characters per 100 words
}
MEASURES = tuple(SLACK)
BOUNDED_BELOW = tuple(k for k, (_, below) in SLACK.items() if below is not None)

_LET = "element_at(transform(array({value}), {name} -> {body}), 1)"


def _let(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once, as ``name``, in ``body``."""
    return _LET.format(value=value, name=name, body=body)


def _repeated_words(words: str) -> str:
    """SQL for the number of words in 3-word windows that the array ``words``
    holds twice or more, first occurrences included. Windows are compared by
    64-bit hash; the sort is done only where some window does repeat."""
    windows = f"transform(sequence(0, size({words}) - 3), i -> xxhash64({words}[i], {words}[i + 1], {words}[i + 2]))"
    equal = "(k > 0 AND s[k - 1].h = e.h) OR (k < size(s) - 1 AND s[k + 1].h = e.h)"
    at = f"sort_array(transform(filter(s, (e, k) -> {equal}), e -> e.i))"
    covered = "aggregate(transform(p, (v, k) -> CASE WHEN k = size(p) - 1 THEN 3 ELSE least(3, p[k + 1] - v) END), 0, (a, b) -> a + b)"
    by_hash = _let("sort_array(transform(h, (x, i) -> struct(x AS h, i AS i)))", "s", _let(at, "p", covered))
    return f"CASE WHEN size({words}) < 3 THEN 0 ELSE " + _let(windows, "h", f"CASE WHEN size(array_distinct(h)) = size(h) THEN 0 ELSE {by_hash} END") + " END"


def _counts(text: str) -> str:
    """SQL struct of the counts of the non-null string ``text``."""
    words = f"CASE WHEN bare = '' THEN array() ELSE split(bare, r'{GAP_RE}') END"
    solid = f"length(translate(t, {GAP_CHARS}, ''))"
    lines = f"filter(split(t, '\\n'), x -> btrim(x, {GAP_CHARS}) <> '')"
    fields = (
        "struct("
        "CAST(size(w) AS BIGINT) AS n_words, "
        f"CAST({solid} AS BIGINT) AS word_chars, "
        f"CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols, "
        "CAST(size(l) - size(array_distinct(l)) AS BIGINT) AS n_dup_lines, "
        f"CAST({_repeated_words('w')} AS BIGINT) AS n_repeat_words, "
        "CAST(size(l) AS BIGINT) AS n_lines, "
        "CAST(length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS BIGINT) AS n_capitals)"
    )
    return _let(text, "t", _let(f"btrim(t, {GAP_CHARS})", "bare", _let(words, "w", _let(lines, "l", fields))))


def _per(scale: int, part: str, whole: str) -> Column:
    return F.expr(f"CAST({scale} * {part} div greatest({whole}, 1) AS BIGINT)")


def with_counts(docs: DataFrame, carry: list[str], name: str = "q") -> DataFrame:
    """Columns ``carry`` of ``docs`` packed as ``row``, with ``lang``, ``source``
    and a struct ``name`` of counts and measures."""
    counted = docs.select(F.struct(*[f"`{c}`" for c in carry]).alias("row"), "lang", "source", F.expr(_counts("coalesce(text, '')")).alias("c"))
    measures = {
        "symbols": _per(1000, "c.n_symbols", "c.word_chars"),
        "dup_lines": _per(1000, "c.n_dup_lines", "c.n_lines"),
        "repeats": _per(1000, "c.n_repeat_words", "c.n_words"),
        "capitals": _per(1000, "c.n_capitals", "c.word_chars"),
        "word_length": _per(100, "c.word_chars", "c.n_words"),
    }
    failed = F.expr(f"c.n_words < {MIN_WORDS} OR 100 * c.n_repeat_words > {MAX_REPEATED_PERCENT} * c.n_words")
    return counted.select("row", "lang", "source", F.struct("c.*", failed.alias("base_failed"), *[v.alias(k) for k, v in measures.items()]).alias(name))


def bin_of(value: Column | str) -> Column:
    """Lower end of the sketch bin that holds a non-negative whole number."""
    v = F.col(value) if isinstance(value, str) else value
    shift = F.greatest(F.length(F.bin(v)) - 10, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, shift), shift)


def sketch(measured: DataFrame, name: str = "q") -> DataFrame:
    """Quantile sketches ``lang, source, measure, bin, n`` of the documents that
    pass the base rules, by partial aggregation before the only shuffle."""
    pairs = F.array(*[F.struct(F.lit(k).alias("measure"), F.col(f"{name}.{k}").alias("value")) for k in MEASURES])
    values = measured.where(~F.col(f"{name}.base_failed")).select("lang", "source", F.inline(pairs))
    return values.groupBy("lang", "source", "measure", bin_of("value").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches merged over everything but ``keys``."""
    return sketches.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Per ``keys`` and measure the sketch's size ``n`` and its quartiles
    ``low`` and ``high`` (nearest rank)."""
    group = [*keys, "measure"]
    up_to = F.sum("n").over(Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(Window.partitionBy(*group))
    ranked = sketches.select(*group, "bin", (4 * up_to).alias("up_to"), total.alias("total"))
    at = lambda quarter: F.min(F.when(F.col("up_to") >= quarter * F.col("total"), F.col("bin")))
    return ranked.groupBy(*group).agg(F.max("total").alias("n"), at(1).alias("low"), at(3).alias("high"))


def _slack(side: int) -> Column:
    """The measure's least distance above (0) or below (1); null if it has no such fence."""
    return F.coalesce(*[F.when(F.col("measure") == k, F.lit(v[side])) for k, v in SLACK.items() if v[side] is not None])


def _fences(sketches: DataFrame, keys: list[str], level: int) -> DataFrame:
    """Per ``keys`` and measure the size and fences of the sketch itself, the
    columns numbered by ``level``; a lower fence is 0 at least."""
    found = quartiles(sketches, keys)
    reach = SPREAD * (F.col("high") - F.col("low"))
    above = F.col("high") + F.greatest(reach, _slack(0))
    below = F.when(_slack(1).isNotNull(), F.greatest(F.col("low") - F.greatest(reach, _slack(1)), F.lit(0)))
    return found.select(*[F.col(k).alias(f"{k}{level}") for k in [*keys, "measure", "n"]], above.alias(f"above{level}"), below.alias(f"below{level}"))


def thresholds(sketches: DataFrame, prior: int = PRIOR_DOCS) -> DataFrame:
    """One row per language and source: ``<measure>_max``, and ``<measure>_min``
    of those bounded below. Works on sketches only, whose size does not follow
    the number of documents."""
    own = _fences(sketches, ["lang", "source"], 0)
    by_lang = _fences(merge(sketches, ["lang"]), ["lang"], 1)
    overall = _fences(merge(sketches, []), [], 2)
    known = own.join(by_lang, F.col("lang0").eqNullSafe(F.col("lang1")) & (F.col("measure0") == F.col("measure1")))
    known = known.join(overall, F.col("measure0") == F.col("measure2"))
    leaning = lambda side, level, on: f"(n{level} * {side}{level} + {prior} * ({on})) div (n{level} + {prior})"
    fence = lambda side: F.expr(leaning(side, 0, leaning(side, 1, f"{side}2")))
    chosen = known.select(F.col("lang0").alias("lang"), F.col("source0").alias("source"), F.col("measure0").alias("measure"), fence("above").alias("above"), fence("below").alias("below"))
    ends = [F.max(F.when(F.col("measure") == k, F.col("above"))).alias(f"{k}_max") for k in MEASURES]
    ends += [F.max(F.when(F.col("measure") == k, F.col("below"))).alias(f"{k}_min") for k in BOUNDED_BELOW]
    return chosen.groupBy("lang", "source").agg(*ends)


def judge(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns ``carry`` of ``docs``, all unless
    given), ``q`` (counts and measures) and ``kept``.

    ``docs`` needs ``text``, ``lang`` and ``source``; other columns, whatever
    their names, are carried along in ``row``. A null text counts as empty and
    fails the base rules, as does one of fewer than 50 words; null languages
    and sources are groups of their own; repeated rows are judged alike. A
    group none of whose documents passes the base rules has no thresholds and
    keeps nothing. Counted once: the counted documents are written, the
    sketches read only their numbers, and the thresholds (one row per language
    and source, written, so that adaptive execution knows their size) are joined
    back to them: by broadcast below Spark's threshold, else by a join that
    adaptive execution splits where a group is hot.
    """
    measured = written(with_counts(docs, carry or docs.columns), "quality-docs")
    fences = written(thresholds(sketch(measured)), "quality-fences").withColumnsRenamed({"lang": "lang_", "source": "source_"})
    met = measured.join(fences, F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")), "left")
    inside = ~F.col("q.base_failed")
    for k in MEASURES:
        inside = inside & (F.col(f"q.{k}") <= F.col(f"{k}_max"))
    for k in BOUNDED_BELOW:
        inside = inside & (F.col(f"q.{k}") >= F.col(f"{k}_min"))
    return met.select("row", "q", F.coalesce(inside, F.lit(False)).alias("kept"))


def apply_rules(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are kept."""
    return judge(docs).where("kept").select("row.*")

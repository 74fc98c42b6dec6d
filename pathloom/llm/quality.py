"""Quality rules with thresholds that follow the data, in DataFrame functions only.

Every text is measured in whole. Quantile sketches of the measures are built per language and
source, merged to languages and to the whole, and turned into fences: the quartiles widened by
a multiple of their distance. A small group takes the fences of its language, a small language
those of the whole. The fences are joined to the measures and decide which rows stay.

Sketches are combined before the shuffle, so a source with most of the rows costs what a small
one does. The join's other side has a row per language and source and is broadcast only after
counting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathloom.config import BROADCAST_ROWS
from pathloom.storage import broadcast_if_small, freeze

# What a word and a symbol are, and the fixed part of the rules.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED = 50  # in a hundred words

SKETCH_K = 2048  # a sketch of so many values is exact
LEAST_GROUP = 200  # texts that a group's own fences need
FENCE = 4.0  # times the distance of the quartiles

# Measure: least distance of the quartiles that is assumed, and whether it has a lower fence.
MEASURES = {"symbol_share": (0.05, False), "dup_line_share": (0.1, False), "repeat_share": (0.08, False), "word_length": (0.4, True)}


def _windows(words: Column) -> Column:
    """(hash, place) of every three words in a row, ordered by hash."""
    pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    hashes = F.zip_with(pairs, F.slice(words, 3, F.size(words)), lambda p, c: F.xxhash64(p["a"], p["b"], c))
    hashes = F.slice(hashes, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    return F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _repeated(windows: Column) -> Column:
    """Places of the windows whose hash an ordered neighbour has too, in order of place."""
    n = F.size(windows)
    after = F.zip_with(windows, F.slice(windows, 2, n), lambda w, b: F.struct(w["i"].alias("i"), w["h"].alias("h"), F.coalesce(w["h"] == b["h"], F.lit(False)).alias("same")))
    before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), windows)
    beside = F.zip_with(after, before, lambda w, b: F.when(w["same"] | (w["h"] == b["h"]), w["i"]))
    return F.sort_array(F.filter(beside, lambda i: i.isNotNull()))


def _covered(places: Column) -> Column:
    """Words in windows of three that start at the ordered places."""
    steps = F.zip_with(places, F.slice(places, 2, F.size(places)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)


def measure(docs: DataFrame, keep: dict[str, Column], text: Column) -> DataFrame:
    """The columns ``keep``, the counts ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words`` of the whole text and ``base_failed``, and the measures that thresholds
    are drawn for (null without words). A null text has no words. Equal windows of words are
    told by their 64-bit hashes within one text."""
    kept = list(keep)
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(F.col("t"), "\n"), lambda line: line.rlike(NOT_SPACE))
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], text.alias("t"))
    rows = rows.select(*kept, F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                       F.array_remove(F.split("t", SPACES), "").alias("w"), lines.alias("l"))
    rows = rows.select(*kept, "n_symbols", F.size("w").cast("long").alias("n_words"), F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
                       F.size("l").alias("n_lines"), (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
                       _windows(F.col("w")).alias("w"))
    rows = rows.withColumn("w", _repeated(F.col("w")))
    rows = rows.withColumn("n_repeat_words", _covered(F.col("w"))).drop("w")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    share = lambda n, of: F.when(F.col(of) > 0, F.col(n) / F.col(of))
    return rows.select(*kept, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                       share("n_symbols", "n_words").alias("symbol_share"), share("n_dup_lines", "n_lines").alias("dup_line_share"),
                       share("n_repeat_words", "n_words").alias("repeat_share"), share("word_chars", "n_words").alias("word_length"))


def thresholds(measured: DataFrame, lang: str = "lang", source: str = "source", k: int = SKETCH_K,
               least_group: int = LEAST_GROUP, fence: float = FENCE) -> DataFrame:
    """Per language and source (null is a value of its own): a struct (low, high) for every
    measure, from the texts that the fixed rules keep. Groups below ``least_group`` texts take
    those of the language, or of all languages."""
    names = list(MEASURES)
    good = measured.where("NOT base_failed AND n_words > 0")
    own = good.groupBy(lang, source).agg(*[F.kll_sketch_agg_double(n, F.lit(k)).alias(n) for n in names])

    def merged(sketches: DataFrame, *keys: str) -> DataFrame:
        return sketches.groupBy(*keys).agg(*[F.kll_merge_agg_double(n, F.lit(k)).alias(n) for n in names])

    def fences(sketches: DataFrame, level: str, *keys: str) -> DataFrame:
        found = []
        for n in names:
            least, lower = MEASURES[n]
            quartile = F.kll_sketch_get_quantile_double(n, F.array(F.lit(0.25), F.lit(0.75)))
            width = fence * F.greatest(quartile[1] - quartile[0], F.lit(least))
            low = quartile[0] - width if lower else F.lit(float("-inf"))
            found.append(F.struct(low.alias("low"), (quartile[1] + width).alias("high")).alias(n))
        enough = F.kll_sketch_get_n_double(names[0]) >= (1 if level == "all" else least_group)
        return sketches.where(enough).select(*keys, F.struct(*found).alias(level))

    own = freeze(own)
    by_lang = merged(own, lang)
    whole = fences(merged(by_lang), "all")
    groups = measured.groupBy(lang, source).agg(F.lit(1).alias("one"))
    found = _null_safe(groups, fences(own, "group", lang, source), lang, source)
    found = _null_safe(found, fences(by_lang, "language", lang), lang)
    # one row, if any: the fences of the whole
    found = found.withColumn("one", F.lit(1)).join(F.broadcast(whole.limit(1).withColumn("one", F.lit(1))), "one", "left")
    chosen = found.select(lang, source, F.coalesce("group", "language", "all").alias("f"))
    return chosen.select(lang, source, *[F.col("f")[n].alias(f"{n}_fence") for n in names])


def _null_safe(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Left join on keys among which null equals null."""
    right = right.select(*[F.col(k).alias(f"r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"r_{k}"))
        on = same if on is None else on & same
    return left.join(right, on, "left").drop(*[f"r_{k}" for k in keys])


def judge(measured: DataFrame, fences: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """The measured rows with ``kept``: false if the fixed rules fail or a measure lies outside
    its fences."""
    within = ~F.col("base_failed")
    for n in MEASURES:
        inside = F.col(n).between(F.col(f"{n}_fence")["low"], F.col(f"{n}_fence")["high"])
        within = within & F.coalesce(inside, F.lit(True))
    joined = _null_safe(measured, broadcast_if_small(fences, BROADCAST_ROWS), lang, source)
    return joined.withColumn("kept", within).drop(*[f"{n}_fence" for n in MEASURES])


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``
    and the measures, per row.

    Null and empty texts have no words and fail. Null languages and sources are groups of their
    own. Null ids and repeated rows stay. An empty table gives an empty one.
    """
    measured = freeze(measure(docs, {"doc_id": F.col(doc_id), "lang": F.col(lang), "source": F.col(source)}, F.col(text)))
    judged = judge(measured, freeze(thresholds(measured)))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *MEASURES)


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all columns as they are."""
    names = docs.columns
    whole = F.struct(*[F.col(f"`{n}`") for n in names])
    measured = freeze(measure(docs, {"row": whole, "lang": F.col(lang), "source": F.col(source)}, F.col(text)))
    judged = judge(measured, freeze(thresholds(measured.drop("row"))))
    return judged.where("kept").select(*[F.col("row")[n].alias(n) for n in names])

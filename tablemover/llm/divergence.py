"""Quality rules by distribution divergence, with built-in functions only.

Each document has two histograms: its characters by class, and its words by the commonest words of its
language (all other words in one class). Both are compared with the language's own histograms by the
Jensen-Shannon distance (base 2, so 0 to 1). The references are statistics of the whole corpus: one
pass counts every word per language, a second matches the words of each document and counts its
characters, and the language totals are sums over all documents. Every language that holds ``min_ref_words``
words gets a reference, whatever its share of the corpus. A document too short for stable histograms, or in
a language without reference, is not judged by the distances.

Layout: words become rows only inside their own task, where they are matched with the list of common words
and summed per document before the one shuffle, of one narrow row per document. The list (``top`` words a
language) and the references are broadcast up to ``_BROADCAST`` languages, and joined without that hint beyond.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACES, col, fresh, written

#: Character classes: white space and symbols come from the base counts, these by pattern; what is left
#: (mostly lower-case letters) is a class of its own.
CLASSES = {"upper": r"\p{Lu}", "digit": r"\p{Nd}", "sentence": r"[.,;:?!'\"()\-]"}
KINDS = ["space", "symbol", *CLASSES]
#: Words longer than this are counted by their hash, so that text without spaces is not shuffled.
LONG_WORD = 32
_BROADCAST = 1000
SYMBOLS = r"[#*$%&|<>]"
LENGTH_GUARD = 50


def words_of(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text, in order; none for null."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"[\x20\x09-\x0D]+"))


def count_chars(text: Column, pattern: str) -> Column:
    """Code points of ``text`` that match a one-character pattern."""
    return F.length(text) - F.length(F.regexp_replace(text, f"{pattern}+", ""))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def windows_of(words: Column) -> Column:
    """One long per 3-word window: half of a hash above, the window's place below."""
    spots = F.when(F.size(words) > 2, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(spots, lambda i: F.shiftleft(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), 32)
                       .bitwiseOR(i.cast("long")))


def _half(x: Column) -> Column:
    return F.shiftright(x, 32)


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).cast("int")


def suspects(packed: Column) -> Column:
    """Sorted packed windows whose half hash equals a neighbour's: all repeats, and hardly any other."""
    return F.filter(packed, lambda x, k: (F.coalesce(_half(F.get(packed, k + 1)) == _half(x), F.lit(False)))
                    | ((k > 0) & (_half(F.get(packed, k - 1)) == _half(x))))


def clashes(words: Column, found: Column) -> Column:
    """How many neighbours among the suspects share the half hash but not the three words."""
    def differ(x, y):
        i, j = _place(x), _place(y)
        return ((F.get(words, i) != F.get(words, j)) | (F.get(words, i + 1) != F.get(words, j + 1))
                | (F.get(words, i + 2) != F.get(words, j + 2)))
    return F.size(F.filter(found, lambda x, k: (k > 0) & (_half(F.get(found, k - 1)) == _half(x))
                           & differ(x, F.get(found, k - 1))))


def by_words(words: Column, found: Column) -> Column:
    """(three words, suspect), sorted: equal windows lie side by side. Only for texts with clashes."""
    return F.sort_array(F.transform(found, lambda x: F.struct(F.concat_ws(
        " ", F.get(words, _place(x)), F.get(words, _place(x) + 1), F.get(words, _place(x) + 2)).alias("w"), x.alias("x"))))


def real_repeats(pairs: Column) -> Column:
    same = lambda k, x: F.coalesce(F.get(pairs, k)["w"] == x["w"], F.lit(False))
    return F.transform(F.filter(pairs, lambda x, k: same(k + 1, x) | ((k > 0) & same(k - 1, x))), lambda x: x["x"])


def covered(found: Column) -> Column:
    """Number of words that lie in the windows ``found``."""
    spots = F.flatten(F.transform(found, lambda x: F.array(_place(x), _place(x) + 1, _place(x) + 2)))
    return F.size(F.array_distinct(spots)).cast("long")


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (square root of the divergence, base 2) of two arrays of shares; what is
    missing to 1 counts as one more class."""
    def rest(x):
        return F.greatest(F.lit(1.0) - F.aggregate(x, F.lit(0.0), lambda s, y: s + y), F.lit(0.0))

    def term(x, y):
        m = (x + y) / 2
        return (F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
                + F.when(y > 0, y * F.log2(y / m)).otherwise(F.lit(0.0)))

    terms = F.zip_with(F.concat(p, F.array(rest(p))), F.concat(q, F.array(rest(q))), term)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def _base(docs: DataFrame, text_col: str, lang_col: str, keep: list[str]) -> DataFrame:
    """Per document: kept columns as c0.., `lang`, `words` (its words, lower case), base counts, class counts."""
    d = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(keep)], col(lang_col).cast("string").alias("lang"),
                    F.coalesce(col(text_col), F.lit("")).alias("t"))
    d = d.withColumn("w", words_of(F.col("t")))
    d = d.withColumn("packed", F.sort_array(windows_of(F.col("w"))))
    d = d.withColumn("found", suspects(F.col("packed")))
    d = d.withColumn("pairs", F.when(clashes(F.col("w"), F.col("found")) > 0, by_words(F.col("w"), F.col("found"))))
    d = d.withColumn("n_repeat_words", covered(F.when(F.col("pairs").isNull(), F.col("found"))
                                               .otherwise(real_repeats(F.col("pairs")))))
    d = d.withColumns({"n_all": F.length("t").cast("long"), "word_chars": F.length(F.concat_ws("", "w")).cast("long"),
                       "n_symbols": count_chars(F.col("t"), SYMBOLS).cast("long")})
    return d.select(
        *[f"c{i}" for i in range(len(keep))], "lang", F.size("w").cast("long").alias("n_words"), "word_chars", "n_symbols",
        duplicate_lines(F.col("t")).alias("n_dup_lines"), "n_repeat_words", "n_all",
        (F.col("n_all") - F.col("word_chars")).alias("k_space"), F.col("n_symbols").alias("k_symbol"),
        *[count_chars(F.col("t"), p).cast("long").alias(f"k_{k}") for k, p in CLASSES.items()],
        F.transform("w", lambda x: F.when(F.length(x) > LONG_WORD, F.md5(F.lower(x).cast("binary"))).otherwise(F.lower(x))).alias("words"))


def _small(df: DataFrame, languages: int) -> DataFrame:
    return F.broadcast(df) if languages <= _BROADCAST else df


def common_words(base: DataFrame, top: int = 24, min_share: float = 0.0, min_ref_words: int = 1000) -> DataFrame:
    """(lang, word, place, c): the ``top`` commonest words of each language over the whole corpus, their
    places and counts. Languages with less than ``min_ref_words`` words, or ``min_share`` of all, are left out."""
    words = written(base.select("lang", F.explode("words").alias("word")).groupBy("lang", "word")
                    .agg(F.count(F.lit(1)).alias("c")), "divergence-counts")
    langs = words.groupBy("lang").agg(F.sum("c").alias("n"))
    whole = words.agg(F.sum("c")).first()[0] or 0
    langs = langs.where(F.col("lang").isNotNull() & (F.col("n") >= F.lit(max(float(min_share * whole), float(min_ref_words)))))
    rank = Window.partitionBy("lang").orderBy(F.col("c").desc(), "word")
    ranked = words.withColumn("place", F.row_number().over(rank)).where(F.col("place") <= top)
    return written(ranked.join(langs.select("lang"), "lang").select("lang", "word", "place", "c"), "divergence-words")


def language_references(common: DataFrame, rows: DataFrame, top: int) -> DataFrame:
    """(lang, ref_words, ref_classes): shares of the common words and of the character classes, the totals
    being sums over all documents (``rows``)."""
    sums = rows.groupBy("lang").agg(F.sum("n_words").alias("n"), F.sum("n_all").alias("all"),
                                    *[F.sum(f"k_{k}").alias(f"k_{k}") for k in KINDS])
    listed = common.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "c"))).alias("ps"))
    shares = F.transform(F.sequence(F.lit(0), F.lit(top - 1)),
                         lambda i: F.coalesce(F.try_divide(F.get("ps", i)["c"], F.col("n")), F.lit(0.0)))
    return listed.join(sums, "lang").where((F.col("n") > 0) & (F.col("all") > 0)).select(
        "lang", shares.alias("ref_words"), F.array(*[F.try_divide(f"k_{k}", "all") for k in KINDS]).alias("ref_classes"))


def quality_rules(docs: DataFrame, keep: list[str], text_col: str = "text", lang_col: str = "lang", top: int = 24,
                  min_share: float = 0.0, min_words: int = 100, max_class: float = 0.25, max_words: float = 0.28,
                  min_ref_words: int = 1000) -> DataFrame:
    """Columns ``keep`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_distance, word_distance and kept, one row per row of ``docs``.

    base_failed: under 50 words, or more than half of them in repeated 3-word windows. kept is false if
    base_failed; otherwise a document of ``min_words`` or more whose language has a reference is kept if
    its class distance is at most ``max_class`` and its word distance at most ``max_words``; shorter ones
    and unknown or null languages are kept. Distances are null where they are not judged. Null text
    counts as empty (base_failed); repeated rows and null ids each give their row; an empty table gives
    no rows. Kept columns whose names clash with the results get a trailing underscore.
    """
    base = _base(docs, text_col, lang_col, keep)
    common = common_words(base, top, min_share, min_ref_words)
    languages = common.where("place = 1").count()
    # The tokens of a document are matched and summed in the task that read it; what is shuffled is
    # one row of numbers per document.
    cs = [f"c{i}" for i in range(len(keep))]
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_all", *[f"k_{k}" for k in KINDS]]
    tokens = base.withColumn("rid", F.monotonically_increasing_id()).select(
        "rid", *cs, "lang", *numbers, F.explode_outer("words").alias("word"))
    found = tokens.join(_small(common.select("lang", "word", "place"), languages), ["lang", "word"], "left")
    d = found.groupBy("rid", *cs, "lang").agg(
        *[F.max(c).alias(c) for c in numbers],
        *[F.sum(F.when(F.col("place") == k + 1, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))).alias(f"h{k}")
          for k in range(top)])
    # One narrow row per document: the references' totals and the verdicts both come from it.
    d = written(d, "divergence-rows")
    refs = language_references(common, d, top)
    d = d.select(*cs, "lang", *numbers, F.array(*[F.try_divide(F.col(f"h{k}"), F.col("n_words")) for k in range(top)]).alias("words"),
                 F.array(*[F.try_divide(F.col(f"k_{k}"), F.col("n_all")) for k in KINDS]).alias("classes"))
    d = d.join(_small(refs, languages), "lang", "left")
    judged = F.col("ref_words").isNotNull() & (F.col("n_words") >= min_words)
    d = d.withColumns({
        "class_distance": F.when(judged, distance(F.col("classes"), F.col("ref_classes"))),
        "word_distance": F.when(judged, distance(F.col("words"), F.col("ref_words"))),
        "base_failed": (F.col("n_words") < LENGTH_GUARD) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))})
    verdict = ~F.col("base_failed") & (~judged | ((F.col("class_distance") <= max_class) & (F.col("word_distance") <= max_words)))
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance"]
    names = []
    for c in keep:
        names.append(fresh([*made, "kept", *names], c))
    return d.select(*[F.col(f"c{i}").alias(x) for i, x in enumerate(names)], *made, verdict.alias("kept"))

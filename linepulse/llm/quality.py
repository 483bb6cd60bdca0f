"""Quality rules: how far a document's histograms are from those of its language.

Two histograms of a document, of character classes and of common words, are compared with the
references of its language (the mean over that language's documents which are long enough and
pass the base rules) by the Jensen-Shannon distance: the root of the divergence in bits, 0 to 1.

A short text is far from any reference by chance alone. So a distance is not held against one bound but
against what documents of the same language and length have: lengths go in classes that double, and
each class has the median of both distances and the spread of the word distance (from its lower half,
which poor documents do not reach), over all documents that the base rules let through. A document is
rejected if its word distance is `word_bound` spreads beyond the median, or its class distance
`class_excess` beyond, or both are mildly beyond. The guard of minimum lengths is twofold: texts below
`least_chars` and `least_words` don't shape the references, and a class of lengths with fewer than
`least_docs` documents takes the bounds of the nearest one that has them, widened if that is longer. Without any such class only
the class distance counts, with the bound `class_distance`.

All of it is built-in functions. What the driver gets are five references of some seventy numbers and
the bounds of at most forty lengths for each.

Null text has no words, so the base rules reject it. A language that is null or has no list
of common words is compared with the reference of all such documents. Texts of any length are judged
whole. Repeated rows are judged each on its own and count each; equal distances get equal verdicts. An empty
table gives no rows. Other columns are kept, whatever their names, but names of the result are refused.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import SPACE_RUN, materialize, owned, text_or_empty

#: Frequent words of each language.
COMMON = {
    "en": "the of and to in is that it for was on are as with be by this at from or".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
}
WORDS = sorted({w for words in COMMON.values() for w in words})
#: Character classes, by Java pattern; what none holds is the last bin.
CLASSES = {
    "upper": r"\p{Lu}",
    "beyond_ascii": r"[^\x00-\x7F]",
    "digit": r"[0-9]",
    "symbol": r"[#*$%&|<>]",
    "mark": r"[!-\"'-/:;=?@\[-`{}~&&[^#*$%&|<>]]",
    "space": r"[\x20\x09-\x0D]",
}


@dataclass(frozen=True)
class Rules:
    """Bounds of the distances; see the head of this module."""

    word_bound: float = 4.0
    class_excess: float = 0.20
    mild_word_bound: float = 1.4
    mild_class_excess: float = 0.02
    class_distance: float = 0.30
    least_chars: int = 200
    least_words: int = 60
    least_docs: int = 20


RESULTS = ("_q", "base_failed", "class_distance", "word_distance", "kept")


def _class_count(pattern: str) -> Column:
    inner = pattern[1:-1] if pattern.startswith("[") and "&&" not in pattern else pattern
    if pattern.startswith("[^"):
        other = "[" + pattern[2:]
    elif "&&" in pattern:
        other = f"[^{pattern}]"
    else:
        other = f"[^{inner}]"
    return F.length(F.regexp_replace("_text", f"{other}++", "")).cast("bigint")


def let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _joined(hashes: Column, step: int) -> Column:
    """Hashes of runs of words from those of runs half as long, `step` words each."""
    return let(
        hashes,
        lambda h: F.zip_with(
            F.slice(h, 1, F.size(h) - step),
            F.slice(h, 1 + step, F.size(h)),
            lambda x, y: F.xxhash64(x, y),
        ),
    )


def _repeat_words(words: Column) -> Column:
    """Words inside windows of eight words that occur twice or more in the text.

    The windows' 64-bit hashes are counted by a hash set; only texts with an equal pair are
    sorted, and the places of repeated windows then cover min(8, gap to the next) words.
    """
    window = 8
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    for step in (1, 2, 4):
        hashes = _joined(hashes, step)

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = let(
            placed,
            lambda p: F.zip_with(
                p,
                F.slice(p, 2, F.size(p)),
                lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])),
            ),
        )
        starts = F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))
        gaps = let(
            starts,
            lambda p: F.zip_with(
                p,
                F.slice(p, 2, F.size(p)),
                lambda x, y: F.least(F.coalesce(y - x, F.lit(window)), F.lit(window)),
            ),
        )
        return F.aggregate(gaps, F.lit(0), lambda s, x: s + x).cast("bigint")

    def judged(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(
            covered(h)
        )

    return F.when(F.size(words) > window, let(hashes, judged)).otherwise(F.lit(0).cast("bigint"))


def _shares(bins: Column) -> Column:
    def of(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda s, x: s + x)
        return let(total, lambda n: F.transform(counts, lambda x: x / F.greatest(n, F.lit(1))))

    return let(bins, of)


def with_measures(docs: DataFrame, own: Column | None = None) -> DataFrame:
    """`_own` (a struct of the caller's columns) and the struct `_q` with the base measures and both histograms."""
    docs = docs.select(
        (F.lit(None) if own is None else own).alias("_own"), text_or_empty().alias("_text"), F.col("lang").alias("lang")
    )
    text = F.col("_text")
    words = F.col("_words")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.withColumn("_words", F.array_remove(F.split("_text", SPACE_RUN), ""))
    counted = (
        split.withColumn("_lines", lines)
        .withColumn("_common", F.filter(words, lambda w: w.isin(WORDS)))
        .withColumn("_chars", F.length("_text").cast("bigint"))
        .withColumn("_classes", F.array(*[_class_count(p) for p in CLASSES.values()]))
    )
    rest = F.col("_chars") - F.aggregate("_classes", F.lit(0).cast("bigint"), lambda s, x: s + x)
    hits = let(
        F.col("_common"), lambda c: F.array(*[F.size(c) - F.size(F.array_remove(c, w)) for w in WORDS])
    )
    n_words = F.size("_words").cast("bigint")
    symbol = list(CLASSES).index("symbol")
    measures = F.struct(
        n_words.alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.col("_classes")[symbol].alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(words).alias("n_repeat_words"),
        F.col("_chars").alias("n_chars"),
        _shares(F.concat("_classes", F.array(F.greatest(rest, F.lit(0))))).alias("classes"),
        _shares(
            F.concat(hits, F.array(F.size("_words") - F.size("_common"))).cast("array<bigint>")
        ).alias("common"),
        F.when(F.col("lang").isin(list(COMMON)), F.col("lang")).otherwise("other").alias("lang"),
    )
    return counted.select("_own", measures.alias("_q"))


def _base_failed() -> Column:
    q = F.col("_q")
    return (q["n_words"] < 20) | (100 * q["n_repeat_words"] > 30 * q["n_words"])


def references(measured: DataFrame, rules: Rules) -> dict[str, tuple[list[float], list[float]]]:
    """Mean shares of each language's documents: (classes, common words). At most five rows."""
    q = F.col("_q")
    fit = measured.where(
        ~_base_failed()
        & (q["word_chars"] >= rules.least_chars)
        & (q["n_words"] >= rules.least_words)
    ).select(
        q["lang"].alias("lang"),
        q["classes"].alias("c"),
        q["common"].alias("w"),
    )
    sizes = {"c": len(CLASSES) + 1, "w": len(WORDS) + 1}
    rows = fit.groupBy("lang").agg(
        *[F.avg(F.col(k)[i]).alias(f"{k}{i}") for k, n in sizes.items() for i in range(n)]
    )
    return {
        r["lang"]: tuple([r[f"{k}{i}"] for i in range(n)] for k, n in sizes.items())
        for r in rows.collect()
    }


def js_distance(p: Column, q: list[float]) -> Column:
    """Jensen-Shannon distance of an array of shares from fixed shares."""

    def half(x, m):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    fixed = F.array(*[F.lit(float(x)) for x in q])
    terms = F.zip_with(p, fixed, lambda x, y: half(x, (x + y) / 2) + half(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def _length_class(n: Column) -> Column:
    return F.floor(F.log2(F.greatest(n, F.lit(1)))).cast("int")


def bounds(distances: DataFrame, rules: Rules) -> dict[str, dict[int, tuple[float, float, float]]]:
    """By language and class of lengths: median and spread of the word distance, median class distance."""
    q = F.col("_q")
    quarter, half = F.percentile_approx("word_distance", F.array(F.lit(0.25), F.lit(0.5))), 0.5
    rows = (
        distances.where(~_base_failed() & F.col("word_distance").isNotNull())
        .groupBy(q["lang"].alias("lang"), _length_class(q["n_words"]).alias("length"))
        .agg(
            quarter.alias("word"),
            F.percentile_approx("class_distance", half).alias("class"),
            F.count("*").alias("n"),
        )
        .where(F.col("n") >= rules.least_docs)
        .collect()
    )
    found: dict = {}
    for r in rows:
        low, middle = r["word"]
        spread = max((middle - low) / QUARTILE, 0.005)
        found.setdefault(r["lang"], {})[r["length"]] = (middle, spread, r["class"])
    return found


#: Fixed value: the upper quartile of the normal distribution.
QUARTILE = 0.6745
#: Classes of lengths; texts have fewer than 2 ** LENGTHS words.
LENGTHS = 40


def _of_class(bound: dict[int, tuple[float, float, float]], k: int, length: Column) -> Column:
    """The k-th number of a document's class of lengths, else of the nearest class.

    The chance part of a distance goes with the inverse root of the length, so what a shorter class
    takes of the word distance is widened by the root of two for each halving.
    """
    nearest = [min(bound, key=lambda at, own=own: (abs(at - own), at)) for own in range(LENGTHS)]
    wider = [2 ** (max(0, at - own) / 2) if k < 2 else 1.0 for own, at in enumerate(nearest)]
    return F.get(F.array(*[F.lit(bound[at][k] * w) for at, w in zip(nearest, wider, strict=True)]), length)


def _far(found: dict[str, dict[int, tuple[float, float, float]]], rules: Rules) -> Column:
    """Is a document beyond the bounds of its language and length?"""
    lang, length = F.col("_q")["lang"], _length_class(F.col("_q")["n_words"])
    words, classes = F.col("word_distance"), F.col("class_distance")
    far = classes > rules.class_distance
    for own, bound in found.items():
        middle, spread, usual = (_of_class(bound, k, length) for k in range(3))
        beyond, excess = (words - middle) / spread, classes - usual
        far = F.when(
            lang == own,
            (beyond > rules.word_bound)
            | (excess > rules.class_excess)
            | ((beyond > rules.mild_word_bound) & (excess > rules.mild_class_excess)),
        ).otherwise(far)
    return F.coalesce(far, F.lit(False))


def judge(
    docs: DataFrame, rules: Rules | None = None, columns: list[str] | None = None
) -> DataFrame:
    """docs (or those columns) with `_q`, base_failed, class_distance, word_distance and kept.

    What is asked for is written once with the measures; without the texts that is little. A distance is
    null where the language has no reference.
    """
    rules = rules or Rules()
    names, own = owned(docs, columns, RESULTS)
    measured = materialize(with_measures(docs, own), "measures")
    refs = references(measured, rules)
    lang = F.col("_q")["lang"]
    classes, words = F.lit(None).cast("double"), F.lit(None).cast("double")
    for name, (c, w) in refs.items():
        classes = F.when(lang == name, js_distance(F.col("_q")["classes"], c)).otherwise(classes)
        words = F.when(lang == name, js_distance(F.col("_q")["common"], w)).otherwise(words)
    distances = measured.withColumn("class_distance", classes).withColumn("word_distance", words)
    far = _far(bounds(distances, rules), rules)
    return distances.select(
        *[F.col("_own")[n].alias(n) for n in names],
        "_q",
        _base_failed().alias("base_failed"),
        "class_distance",
        "word_distance",
        (~_base_failed() & ~far).alias("kept"),
    )

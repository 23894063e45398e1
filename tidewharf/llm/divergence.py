"""Quality rules: how far a text's histograms lie from those of its language.

Two histograms are taken of a text: of character classes and of common words. Each is compared with the
references of all languages by Jensen-Shannon distance; the nearest reference counts, so texts in a mix of
languages or with a wrong label are not put at a disadvantage. Texts under a minimum length are not judged by
a histogram. Everything runs as DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewharf.functions.scratch import materialized
from tidewharf.llm.text import white_words

COMMON_WORDS = 24
LEAST_CHARS = 100
LEAST_WORDS = 60
CHAR_LIMIT = 0.22
WORD_LIMIT = 0.42
WINDOW = 5

# Character classes; what fits none, lower-case letters and digits among it, is the class "other", so that clean
# short texts with many figures stay near.
CLASSES = {
    "upper": r"[A-ZÀ-ÖØ-Þ]",
    "symbol": r"[#*$%&|<>]",
    "mark": r"[.,;:?!'\"()\-]",
    "space": r"[ \t-\r]",
}
KINDS = (*CLASSES, "other")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column, n: Column) -> Column:
    """Words inside windows of five words that occur twice or more in the array, the first included."""
    def covered(grams: Column) -> Column:
        ordered = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def again(s: Column) -> Column:
            return F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))

        places = F.sort_array(F.transform(bound(ordered, again), lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        union = F.aggregate(places, start, lambda acc, x: F.struct(
            (x + WINDOW).alias("end"), (acc["n"] + x + WINDOW - F.greatest(acc["end"], x)).alias("n")
        ))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(union["n"])

    grams = F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    )
    return F.when(n < WINDOW, F.lit(0)).otherwise(bound(grams, covered)).cast("long")


def divergence(p: dict[str, Column], q: dict[str, float]) -> Column:
    """Jensen-Shannon distance of two histograms over the same few classes."""
    total = F.lit(0.0)
    for name, share in q.items():
        total = total + _term(p[name], F.lit(share))
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def _term(p: Column, q: Column) -> Column:
    middle = (p + q) / 2
    one = F.when(p > 0, p * F.log2(p / middle)).otherwise(0.0)
    return one + F.when(q > 0, q * F.log2(q / middle)).otherwise(0.0)


def word_references(docs: DataFrame, k: int = COMMON_WORDS) -> dict[str, dict[str, float]]:
    """The ``k`` commonest lower-case words of each language with their shares, over all texts.

    Languages are few by nature, so a few hundred rows come to the driver.
    """
    words = docs.where(F.col("lang").isNotNull()).select("lang", F.explode(white_words(F.lower("text"))).alias("word"))
    count = materialized(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    total = {r["lang"]: r["n"] for r in count.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    found: dict[str, dict[str, float]] = {name: {} for name in sorted(total)}
    for r in count.withColumn("turn", first).where(F.col("turn") <= k).orderBy("lang", "turn").collect():
        found[r["lang"]][r["word"]] = r["n"] / total[r["lang"]]
    return found


def _common(words: Column, references: dict[str, dict[str, float]]) -> Column:
    """The distinct common words of a text with their counts."""
    listed = sorted({w for shares in references.values() for w in shares})
    if not listed:
        return F.array().cast("array<struct<w:string,n:int>>")

    def counted(found: Column) -> Column:
        return F.transform(F.array_distinct(found), lambda w: F.struct(
            w.alias("w"), F.size(F.filter(found, lambda x: x == w)).alias("n")
        ))

    return bound(F.filter(F.transform(words, F.lower), lambda w: w.isin(listed)), counted)


def word_distance(common: Column, n: Column, shares: dict[str, float]) -> Column:
    """Distance of a text's common words, and the rest of its words as one class, from a reference.

    A common word that the text lacks adds half its share, so a sum over those it has is enough.
    """
    known = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
    rest = 1 - sum(shares.values())
    seen = F.filter(common, lambda x: F.map_contains_key(known, x["w"]))
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("p"))

    def step(acc: Column, x: Column) -> Column:
        p, q = x["n"] / n, F.element_at(known, x["w"])
        return F.struct((acc["sum"] + _term(p, q) - q).alias("sum"), (acc["p"] + p).alias("p"))

    total = bound(F.aggregate(seen, start, step), lambda t: t["sum"] + (1 - F.lit(rest)) + _term(F.greatest(1 - t["p"], F.lit(0.0)), F.lit(rest)))
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def measured(docs: DataFrame) -> DataFrame:
    """The columns of the rules for every row of ``docs``, and ``char_distance`` and ``word_distance``.

    ``base_failed``: under 10 words, or over a fifth of the words in repeated windows. ``kept``: not failed, and
    no histogram of sufficient length is farther from every language than its limit. Null texts count as
    empty; without any language only the base rules hold. Repeated rows get equal results.
    """
    references = word_references(docs)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "lang", text.alias("text"), white_words(text).alias("words"))
    rows = rows.select("*", F.size("words").alias("n"), F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t-\r]")).alias("lines"))
    counts = {name: F.regexp_count("text", F.lit(pattern)).cast("long") for name, pattern in CLASSES.items()}
    rows = materialized(rows.select(
        "doc_id", "lang", F.col("n").cast("long").alias("n_words"), F.length("text").cast("long").alias("n_chars"),
        *[c.alias(f"n_{name}") for name, c in counts.items()],
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words"), F.col("n")).alias("n_repeat_words"),
        bound(_common(F.col("words"), references), lambda c: F.array_min(F.array(*[
            word_distance(c, F.col("n"), shares) for shares in references.values()
        ])) if references else F.lit(None).cast("double")).alias("word_distance"),
    ))
    rows = rows.withColumn("n_other", F.col("n_chars") - sum((F.col(f"n_{name}") for name in CLASSES), F.lit(0)))
    totals = rows.where(F.col("lang").isNotNull()).groupBy("lang").agg(*[F.sum(f"n_{name}").alias(name) for name in KINDS]).collect()
    shares = [{name: r[name] / sum(r[x] for x in KINDS) for name in KINDS} for r in totals if sum(r[x] for x in KINDS)]
    own = {name: F.col(f"n_{name}") / F.greatest("n_chars", F.lit(1)) for name in KINDS}
    near = F.array_min(F.array(*[divergence(own, q) for q in shares])) if shares else F.lit(None).cast("double")
    rows = rows.withColumn("char_distance", near)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    odd = ((F.col("n_chars") >= LEAST_CHARS) & (F.col("char_distance") > CHAR_LIMIT)) | (
        (F.col("n_words") >= LEAST_WORDS) & (F.col("word_distance") > WORD_LIMIT)
    )
    return rows.select(
        "doc_id", "n_words", (F.col("n_chars") - F.col("n_space")).alias("word_chars"), F.col("n_symbol").alias("n_symbols"),
        "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & ~F.coalesce(odd, F.lit(False))).alias("kept"), "char_distance", "word_distance",
    )

"""URL filters: rules for hosts and paths, and a character language-model ratio where no rule speaks.

Two variable-order Markov models are counted, of URLs that the rules allow and of URLs that they block. The
probability of a character mixes its frequency after contexts of growing length, each by how often it was
met. A URL is scored by the mean difference of log likelihood per character against a cut that is calibrated
on ruled URLs kept from training. Everything runs as DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewharf.functions.scratch import materialized
from tidewharf.llm.text import LOWER, UPPER, crc_class

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
ORDER = 5
STRENGTH = 4.0
ALPHABET = 128
START, END = "\x02", "\x03"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``ruling``, the verdict of the longest fitting rule.

    A rule is ``host/path``: it fits the host and its subdomains if the path begins with the rule's. Rules
    meet the distinct hosts and their parent domains; what fits a host is then joined to its pages.
    """
    spark = pages.sparkSession
    parts = [(verdict, rule, rule.partition("/")[0], "/" + rule.partition("/")[2]) for verdict, rule in rules]
    book = spark.createDataFrame(parts, "ruling string, rule string, domain string, begin string")
    rows = pages.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    # of a host's parent domains, only those with as many labels as a rule's can fit
    depths = sorted({domain.count(".") + 1 for _, _, domain, _ in parts})
    last = F.slice(F.reverse(F.split("host", r"\.")), 1, max(depths, default=1))
    parents = F.transform(
        F.filter(F.array(*[F.lit(d) for d in depths]).cast("array<int>"), lambda d: d <= F.size(last)),
        lambda d: F.array_join(F.reverse(F.slice(last, 1, d)), "."),
    )
    fits = (
        rows.select("host").distinct().withColumn("domain", F.explode(parents)).join(book, "domain")
        .groupBy("host").agg(F.collect_list(F.struct(F.length("rule").alias("n"), "rule", "ruling", "begin")).alias("fits"))
    )
    best = F.array_max(F.filter("fits", lambda r: F.startswith(F.col("path"), r["begin"])))
    return rows.join(materialized(fits), "host", "left").withColumn("best", best).select(
        *pages.columns, "host", "path", F.col("best.rule").alias("rule"), F.col("best.ruling").alias("ruling")
    )


def shown(url: Column) -> Column:
    """What the models read: the URL after its scheme, digits as one character."""
    plain = F.when(F.instr(url, "://") > 0, after_scheme(url)).otherwise(url)
    return F.translate(plain, "123456789", "0" * 9)


def grams(text: Column, order: int = ORDER) -> Column:
    """Each character, and the end, with the ``order`` characters before it."""
    padded = F.concat(F.lit(START * order), text, F.lit(END))
    # the list in a list binds the characters once, so the work is in proportion to the length
    return F.transform(F.array(F.split(padded, "")), lambda chars: F.transform(
        F.sequence(F.lit(1), F.size(chars) - order), lambda i: F.array_join(F.slice(chars, i, F.lit(order + 1)), "")
    ))[0]


def log_ratios(counts: DataFrame, order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """``(g, ratio)``: log probability of a gram's last character after its context, allowed less blocked.

    ``counts`` holds ``(g, n_allow, n_block)`` for every gram that is to be scored, zero where untrained.
    """
    sides = ("allow", "block")
    level = None
    for k in range(order + 1):
        short = F.substring("g", order + 1 - k, k + 1)
        here = counts.groupBy(short.alias("s")).agg(*[F.sum(f"n_{x}").alias(f"n_{x}") for x in sides])
        here = here.withColumn("before", F.substring("s", 1, k)).withColumn("shorter", F.substring("s", 2, k))
        context = here.groupBy("before").agg(*[F.sum(f"n_{x}").alias(f"all_{x}") for x in sides])
        joined = here.join(context, "before")
        if level is None:
            joined = joined.select("*", *[F.lit(1.0 / ALPHABET).alias(f"low_{x}") for x in sides])
        else:
            joined = joined.join(level.select(F.col("s").alias("shorter"), *[F.col(f"p_{x}").alias(f"low_{x}") for x in sides]), "shorter")
        level = joined.select("s", *[
            ((F.col(f"n_{x}") + strength * F.col(f"low_{x}")) / (F.col(f"all_{x}") + strength)).alias(f"p_{x}") for x in sides
        ])
        level = materialized(level)
    return level.select(F.col("s").alias("g"), (F.log("p_allow") - F.log("p_block")).alias("ratio"))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``score`` and ``cut`` of every row of ``pages``.

    Both models learn from distinct URLs with a ruling, four fifths of them; the others calibrate the cut,
    the middle of the blocked URLs' 95th and the allowed URLs' 5th percentile. ``score`` is null for URLs a
    rule decides. A null or empty URL, for which nothing can speak, is blocked. Work grows in proportion to a URL's length. If the rules leave one model
    without URLs, others are allowed. Equal URLs are judged once; repeated rows agree.
    """
    rows = ruled(pages.select("page_id", "url"), rules)
    urls = (
        rows.where(F.length("url") > 0).select("url", "ruling").distinct()
        .withColumn("test", crc_class(F.col("url"), 5) == 0).withColumn("u", F.monotonically_increasing_id())
    )
    # few bytes, but each character becomes a row: spread over all tasks
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    urls = materialized(urls.repartition(parts, "u"))
    each = urls.select("u", "ruling", "test", F.explode(grams(shown(F.col("url")))).alias("g"))
    learns = ~F.col("test")
    counts = materialized(each.groupBy("g").agg(
        F.count(F.when(learns & (F.col("ruling") == "allow"), 1)).alias("n_allow"),
        F.count(F.when(learns & (F.col("ruling") == "block"), 1)).alias("n_block"),
    ))
    ratios = log_ratios(counts)
    asked = each.where(F.col("ruling").isNull() | F.col("test")).select("u", "g")
    scores = materialized(
        asked.join(ratios, "g").groupBy("u").agg(F.avg(F.round("ratio", 9).cast("decimal(28,9)")).cast("double").alias("score"))
        .join(urls, "u").select("url", "ruling", "score")
    )
    known = scores.groupBy().agg(
        F.percentile_approx(F.when(F.col("ruling") == "allow", F.col("score")), 0.05, 100_000).alias("allowed"),
        F.percentile_approx(F.when(F.col("ruling") == "block", F.col("score")), 0.95, 100_000).alias("blocked"),
    ).first()
    cut = None if known["allowed"] is None or known["blocked"] is None else (known["allowed"] + known["blocked"]) / 2
    cut = F.lit(cut).cast("double")
    verdict = F.when(F.coalesce(F.length("url"), F.lit(0)) == 0, "block").when(F.col("score") < cut, "block").otherwise("allow")
    # rows without a URL have no score to find; a key each spreads them
    key = F.coalesce("url", F.concat(F.lit(END), F.xxhash64("page_id").cast("string")))
    scores = scores.where(F.col("ruling").isNull()).select(F.col("url").alias("_key"), "score")
    return rows.withColumn("_key", key).join(scores, "_key", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruling", verdict).alias("verdict"), "score", cut.alias("cut")
    )

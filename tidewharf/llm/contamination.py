"""Benchmark decontamination with a positional inverted index.

The index keeps a posting (term, text, position) for every word of every training text. It is dealt over
shards by text; inside a shard file postings are ordered by term. A query window looks its rarest term up
first, moves that list back by the term's place in the window, and intersects it with the lists of the next
rarest terms, so common words are read only for the few starts that are left.

Terms are 64-bit hashes of words. Everything runs as DataFrame operations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewharf.functions.scratch import materialized
from tidewharf.llm.text import LOWER, UPPER, unused

WINDOW = 13
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
EARLY = 3


def terms(text: Column) -> Column:
    """The words of a text with A to Z lower-cased, as hashes; empty for null and for texts without words."""
    words = F.filter(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), lambda w: w != "")
    return F.coalesce(F.transform(words, lambda w: F.xxhash64(w)), F.array().cast("array<bigint>"))


@dataclass
class Index:
    """``texts``: ``t`` (key of a text), key columns, ``n_words``. ``postings``: ``term``, ``t``, ``pos``."""

    texts: DataFrame
    postings: DataFrame


def text_key(docs: DataFrame) -> Column:
    """Rows with the same key and text share one entry of the index."""
    return F.xxhash64("doc_id", "text")


def build_index(docs: DataFrame) -> Index:
    """Stores the postings of all words of all texts; no posting leaves the task that reads its text.

    Rows repeated in key and text have one text, so their postings are stored once; only they are moved for that.
    """
    keyed = docs.select(text_key(docs).alias("t"), "text")
    repeated = materialized(keyed.groupBy("t").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("t"))
    once = keyed.join(repeated, "t", "left_anti")
    again = keyed.join(repeated, "t", "left_semi").dropDuplicates(["t"])
    rows = once.union(again).select("t", terms(F.col("text")).alias("terms"))
    postings = materialized(
        rows.select("t", F.posexplode("terms").alias("pos", "term")).select("term", "t", "pos").sortWithinPartitions("term")
    )
    counted = F.size(terms(F.col("text"))).cast("long")
    return Index(docs.select("doc_id", text_key(docs).alias("t"), counted.alias("n_words")), postings)


def windows(items: DataFrame, length: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``(w, terms)`` of the items, and which items ``(w, item_id)`` hold them.

    A window is ``length`` words in a row; an item of fewer words, but not none, is one window.
    """
    listed = items.select("item_id", terms(F.col("text")).alias("terms")).where(F.size("terms") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("terms") - (length - 1), F.lit(1)))
    cut = materialized(
        listed.select("item_id", "terms", F.explode(starts).alias("at"))
        .select("item_id", F.slice("terms", F.col("at"), F.lit(length)).alias("terms"))
        .withColumn("w", F.xxhash64(F.size("terms"), F.to_json("terms")))
        .distinct()
    )
    return cut.select("w", "terms").distinct(), cut.select("w", "item_id")


def _ranked(index: Index, wins: DataFrame) -> DataFrame:
    """``(w, term, place, turn, size, absent)``: a window's terms in the index from the rarest to the commonest.

    ``absent`` tells that the index lacks a term of the window.
    """
    each = wins.select("w", F.size("terms").alias("size"), F.posexplode("terms").alias("place", "term"))
    asked = materialized(each.select("term").distinct())
    found = materialized(index.postings.join(asked, "term").groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    turn = F.row_number().over(Window.partitionBy("w").orderBy("df", "place"))
    absent = F.count("df").over(Window.partitionBy("w")) < F.col("size")
    known = each.join(found, "term", "left").withColumn("absent", absent).where("df is not null")
    return materialized(known.select("w", "term", "place", turn.alias("turn"), "size", "absent"))


def phrase_matches(index: Index, wins: DataFrame) -> DataFrame:
    """``(w, t, start, size)``: every place where a window's words stand in a row.

    A window with a term that the index lacks is dropped at once.
    """
    ranked = _ranked(index, wins).where("not absent")
    first = F.col("pos") - F.col("place")
    step = ranked.where("turn = 1").select("w", "term", "place", "size")
    found = materialized(index.postings.join(step, "term").select("w", "t", first.alias("start"), "size").where("start >= 0"))
    for turn in range(2, EARLY + 1):
        step = materialized(ranked.where(F.col("turn") == turn).select("w", "term", "place"))
        lists = index.postings.join(step, "term").select("w", "t", first.alias("start"))
        rest = found.where(F.col("size") >= turn).join(lists, ["w", "t", "start"], "left_semi")
        found = materialized(rest.union(found.where(F.col("size") < turn)))
    # the commoner terms, only in the texts and at the positions that are left
    late = ranked.where(F.col("turn") > EARLY).select("w", "term", "place")
    open_ = found.join(late, "w").select("w", "t", "start", "size", "term", (F.col("start") + F.col("place")).alias("pos"))
    texts = materialized(found.where(F.col("size") > EARLY).select("t").distinct())
    common = materialized(late.select("term").distinct())
    near = materialized(index.postings.join(texts, "t", "left_semi").join(common, "term", "left_semi"))
    sure = (
        open_.join(near, ["t", "pos", "term"], "left_semi").groupBy("w", "t", "start", "size")
        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == F.col("size") - EARLY).drop("n")
    )
    return sure.union(found.where(F.col("size") <= EARLY))


def proximity_matches(index: Index, wins: DataFrame, slop: int = 8, terms_needed: int = EARLY) -> DataFrame:
    """``(w, t, start, n_near)``: places where a window's rarest terms stand close together, in any order.

    Around each posting of the rarest term, the next ``terms_needed`` - 1 terms count as near if they are at
    most ``slop`` words off their place in the window. Windows of fewer terms need all of them. Terms that the
    index lacks are passed over.
    """
    ranked = _ranked(index, wins).where(F.col("turn") <= terms_needed)
    lists = index.postings.join(ranked, "term").select("w", "t", (F.col("pos") - F.col("place")).alias("start"), "turn", "size")
    lists = materialized(lists)
    anchor = lists.where("turn = 1").select("w", "t", "start", "size")
    others = lists.where("turn > 1").select("w", "t", F.col("start").alias("other"), "turn")
    near = anchor.join(others, ["w", "t"], "left").where(
        F.col("other").isNull() | (F.abs(F.col("other") - F.col("start")) <= slop)
    )
    return (
        near.groupBy("w", "t", "start", "size").agg((F.countDistinct("turn") + 1).alias("n_near"))
        .where(F.col("n_near") >= F.least(F.col("size"), F.lit(terms_needed))).drop("size")
    )


def contamination(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated`` of every row.

    A word is hit inside an occurrence of any window of any item. ``contaminated`` means that a twentieth of
    the words or more are hit. Null texts have no words; repeated rows get equal results; null items and
    those without words are left out; without items nothing is hit.
    """
    index = build_index(docs)
    wins, holders = windows(items, length)
    found = materialized(phrase_matches(index, wins))
    hit = (
        found.select("t", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("pos")).distinct()
        .groupBy("t").agg(F.count(F.lit(1)).alias("n_hit"))
    )
    named = (
        found.select("t", "w").distinct().join(holders, "w")
        .groupBy("t").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    per_text = materialized(hit.join(named, "t"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return index.texts.join(per_text, "t", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated; rows are told apart by key and text."""
    index = build_index(docs)
    wins, _ = windows(items, length)
    hit = (
        phrase_matches(index, wins)
        .select("t", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("pos")).distinct()
        .groupBy("t").agg(F.count(F.lit(1)).alias("n_hit"))
    )
    bad = materialized(hit.join(index.texts, "t").where(20 * F.col("n_hit") >= F.col("n_words")).select("t").distinct())
    own = unused(docs.columns, "_t")
    keyed = docs.withColumn(own, text_key(docs))
    return keyed.join(bad.select(F.col("t").alias(own)), own, "left_anti").select(*docs.columns)

"""Phrase collocations, mined with Rabin-Karp fingerprints.

A task hashes the words of many texts and keeps prefix sums of the hashes times powers of a base, so the fingerprint of
any run of words is one difference times an inverse power. The corpus is read three times: for the counts of words and
pairs, for those of longer runs whose pairs are all frequent, and for the texts of what is frequent. The shuffles
carry fingerprints and counts; only in the last pass, where few are left, a task compares the bytes of every
occurrence with those of the first it has met, and the shuffle adds up equal texts with pointers to occurrences. So two
phrases with the same fingerprint are told apart, and counts are exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewharf.functions.ranking import with_position
from tidewharf.functions.scratch import materialized
from tidewharf.llm.text import Texts, byte_set, mix, powers, slices

LONGEST = 4
LEAST = 30
TOP = 2000
COVERED_PERCENT = 80
SLICE = 1 << 20
TALLY = 1 << 19
ROWS = 1 << 16
PART = 1 << 20
FEWEST_BITS, MOST_BITS = 16, 28  # of a filter: 32 MB at most
BREAKS = byte_set(*[(ord(c), ord(c)) for c in ".,;:!?"], (0x0A, 0x0D))
SEPARATORS = BREAKS | byte_set((0x20, 0x20), (0x09, 0x09))
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
INVERSE = pow(BASE, -1, 1 << 64)


class Runs:
    """The words of a slice of texts, and the fingerprints of all runs of them inside a piece of a text."""

    def __init__(self, part: pa.RecordBatch, mask: int):
        self.words = Texts.of(part.column("text"), fold=True).words(SEPARATORS)
        n, self.mask = len(self.words), np.uint64(mask)
        language = part.column("language").to_numpy().view(np.uint64)
        values = mix(self.words.hashes() + language[self.words.owner]) * powers(n, BASE)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
        self.back = powers(n, INVERSE)
        place = np.cumsum(BREAKS[self.words.texts.data])[self.words.start] if n else np.zeros(0, np.int64)
        new = np.ones(n, bool)
        new[1:] = (place[1:] != place[:-1]) | (self.words.owner[1:] != self.words.owner[:-1])
        self.piece = np.cumsum(new)

    def fingerprints(self, size: int, at: np.ndarray) -> np.ndarray:
        """Of the runs of ``size`` words that begin at the words ``at``."""
        return mix((self.sums[at + size] - self.sums[at]) * self.back[at] + np.uint64(size)) & self.mask

    def starts(self, size: int) -> np.ndarray:
        """The words at which a run of ``size`` words in one piece begins."""
        n = len(self.piece) - size + 1
        return np.flatnonzero(self.piece[:n] == self.piece[size - 1 :]) if n > 0 else np.zeros(0, np.int64)


class Filter:
    """A bit for each value of the leading bits of a fingerprint; false positives only."""

    def __init__(self, bits: int, data: bytes):
        self.shift, self.data = np.uint64(64 - bits), np.frombuffer(data, np.uint64)

    def holds(self, fp: np.ndarray) -> np.ndarray:
        slot = mix(fp) >> self.shift
        return (self.data[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _filter(frequent: DataFrame):
    """The fingerprints of ``frequent`` as a broadcast filter, with a size in proportion to their number up to a limit."""
    spark = frequent.sparkSession
    bits = int(np.clip(int(np.ceil(np.log2(64 * max(frequent.count(), 1)))), FEWEST_BITS, MOST_BITS))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(1 << bits, bool)
        for batch in batches:
            flags[(mix(batch.column("fp").to_numpy().view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)] = True
        words = np.packbits(flags, bitorder="little").view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_pydict({"at": at, "flags": words[at]})

    rows = frequent.mapInArrow(packed, "at long, flags long").groupBy("at").agg(F.bit_or("flags").alias("flags")).toArrow()
    data = np.zeros((1 << bits) // 64, np.int64)
    data[rows["at"].to_numpy()] = rows["flags"].to_numpy()
    return bits, spark.sparkContext.broadcast(data.tobytes())


class Tally:
    """Counts of fingerprints, handed on when they are many."""

    def __init__(self):
        self.values, self.counts, self.held = [], [], 0

    def add(self, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        own, count = np.unique(values, return_counts=True)
        self.values.append(own)
        self.counts.append(count)
        self.held += len(own)
        if self.held > TALLY:
            yield from self.merged()

    def merged(self) -> Iterator[pa.RecordBatch]:
        values = np.concatenate(self.values) if self.values else np.zeros(0, np.uint64)
        counts = np.concatenate(self.counts) if self.counts else np.zeros(0, np.int64)
        self.values, self.counts, self.held = [], [], 0
        order = np.argsort(values, kind="stable")
        values = values[order]
        first = np.flatnonzero(np.concatenate((np.ones(len(values[:1]), bool), values[1:] != values[:-1])))
        total = np.add.reduceat(counts[order], first) if len(first) else counts
        values = values[first].view(np.int64)
        for i in range(0, len(values), ROWS):
            yield pa.RecordBatch.from_pydict({"fp": values[i : i + ROWS], "n": pa.array(total[i : i + ROWS], pa.int64())})


def _words_and_pairs(mask: int):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for part in slices(batches, SLICE):
            runs = Runs(part, mask)
            for size in (1, 2):
                yield from tally.add(runs.fingerprints(size, runs.starts(size)))
        yield from tally.merged()

    return counted


def _longer(mask: int, longest: int, bits: int, pairs):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, frequent = Tally(), Filter(bits, pairs.value)
        for part in slices(batches, SLICE):
            runs = Runs(part, mask)
            at = runs.starts(2)
            pair = np.zeros(len(runs.piece) + 1, bool)
            pair[at[frequent.holds(runs.fingerprints(2, at))]] = True
            reach = pair.copy()  # runs of size - 1 words, all of whose pairs are frequent
            for size in range(3, longest + 1):
                reach[: len(pair) - size + 2] &= pair[size - 2 :]
                reach[len(pair) - size + 2 :] = False
                at = np.flatnonzero(reach)
                if len(at):
                    yield from tally.add(runs.fingerprints(size, at))
        yield from tally.merged()

    return counted


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places ``start`` to ``start + length``, one range behind the other."""
    return np.arange(int(length.sum())) + np.repeat(start - (np.cumsum(length) - length), length)


def _gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of all ranges, one behind the other; places are made for a part of them at a time."""
    ends = np.cumsum(length)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    cuts = np.unique(np.append(np.searchsorted(ends, np.arange(PART, len(out), PART)), len(ends)))
    for a, b in zip(np.append(0, cuts[:-1]), cuts):
        out[ends[a] - length[a] if a < b else 0 : ends[b - 1] if a < b else 0] = data[_ranges(start[a:b], length[a:b])]
    return out


def _differs(data: np.ndarray, start: np.ndarray, length: np.ndarray, other: np.ndarray, other_length: np.ndarray) -> np.ndarray:
    """Whether the bytes of each range differ from those of the other."""
    out = length != other_length
    some = np.flatnonzero(~out)
    if len(some):
        unequal = _gathered(data, start[some], length[some]) != _gathered(data, other[some], length[some])
        out[some] = np.logical_or.reduceat(unequal, np.cumsum(length[some]) - length[some])
    return out


def _phrases(mask: int, longest: int, bits: int, wanted):
    """Frequent phrases with their texts, counts and places; a row of size 0 counts a language's words."""
    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Filter(bits, wanted.value)
        for part in slices(batches, SLICE):
            runs = Runs(part, mask)
            words, names, keys = runs.words, part.column("lang").to_pylist(), part.column("doc_id")
            kept = [(size, at[frequent.holds(runs.fingerprints(size, at))]) for size in range(1, longest + 1) for at in (runs.starts(size),)]
            at = np.concatenate([x for _, x in kept])
            size = np.repeat([s for s, _ in kept], [len(x) for _, x in kept])
            fp = np.concatenate([runs.fingerprints(s, x) for s, x in kept])
            # the words again, one space between them
            length = words.end - words.start
            place = np.cumsum(length + 1) - (length + 1)
            joined = np.full(int((length + 1).sum()), 0x20, np.uint8)
            joined[_ranges(place, length)] = words.texts.data[words.inside]
            start, bytes_ = place[at], place[at + size - 1] + length[at + size - 1] - place[at]

            _, first, kind, count = np.unique(fp, return_index=True, return_inverse=True, return_counts=True)
            odd = _differs(joined, start, bytes_, start[first][kind], bytes_[first][kind]) | (size != size[first][kind])
            clash = np.zeros(len(first), bool)
            clash[kind[odd]] = True
            rows = [(first[~clash], count[~clash])]
            if clash.any():  # different phrases with one fingerprint: told apart by their bytes
                seen, times = {}, Counter()
                for i in np.flatnonzero(clash[kind]).tolist():
                    own = (names[words.owner[at[i]]], joined[start[i] : start[i] + bytes_[i]].tobytes())
                    times[seen.setdefault(own, i)] += 1
                rows.append((np.fromiter(times, np.int64), np.fromiter(times.values(), np.int64)))
            index, n = (np.concatenate(x) for x in zip(*rows))
            owner = words.owner[at[index]]
            ends = np.concatenate(([0], np.cumsum(bytes_[index])))
            text = _gathered(joined, start[index], bytes_[index])
            phrase = pa.LargeStringArray.from_buffers(len(index), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(text)).cast(pa.string())
            yield pa.RecordBatch.from_pydict({
                "lang": part.column("lang").take(pa.array(owner)), "size": pa.array(size[index], pa.int32()), "fp": fp[index].view(np.int64),
                "phrase": phrase, "n": pa.array(n, pa.int64()), "doc_id": keys.take(pa.array(owner)),
                "word": pa.array(at[index] - words.first[owner], pa.int64()),
            })
            totals = Counter()
            for name, count in zip(names, words.counts.tolist()):
                totals[name] += count
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array(list(totals), pa.string()), "size": pa.array([0] * len(totals), pa.int32()), "fp": pa.array([0] * len(totals), pa.int64()),
                "phrase": pa.array([""] * len(totals)), "n": pa.array(list(totals.values()), pa.int64()),
                "doc_id": pa.nulls(len(totals), keys.type), "word": pa.nulls(len(totals), pa.int64()),
            })

    return told


def _wide(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, mask: int = (1 << 64) - 1) -> DataFrame:
    """``lang``, ``size``, ``phrase``, ``n``, ``doc_id`` and ``word`` of the phrases found ``least`` times or more in their language.

    ``doc_id`` and ``word`` point to an occurrence in the document with the smallest key. Rows of size 0 hold the number
    of words of each language. ``mask`` leaves only some bits of a fingerprint, for tests.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    rows = docs.select("text", lang.alias("lang"), F.xxhash64(lang).alias("language"), "doc_id")
    read, key = rows.select("text", "language"), docs.schema["doc_id"].dataType.simpleString()

    def often(counts: DataFrame) -> DataFrame:
        return materialized(counts.groupBy("fp").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("fp"))

    short = often(read.mapInArrow(_words_and_pairs(mask), "fp long, n long"))
    long = often(read.mapInArrow(_longer(mask, longest, *_filter(short)), "fp long, n long"))
    found = rows.mapInArrow(
        _phrases(mask, longest, *_filter(short.union(long))),
        f"lang string, size int, fp long, phrase string, n long, doc_id {key}, word long",
    )
    counted = found.groupBy("fp", "lang", "size", "phrase").agg(
        F.sum("n").alias("n"), F.min_by("word", "doc_id").alias("word"), F.min("doc_id").alias("doc_id")
    )
    return materialized(counted.where((F.col("n") >= least) | (F.col("size") == 0)).drop("fp"))


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, covered_percent: int = COVERED_PERCENT,
                 mask: int = (1 << 64) - 1) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``, ``doc_id`` and ``word``: each language's best phrases.

    Texts are lower-cased from A to Z and split into pieces at ``. , ; : ! ?`` and line ends, pieces into words at spaces and
    tabs. Of phrases of 2 to ``longest`` words inside a piece, those found ``a >= least`` times are candidates. Cut into two
    parts found ``l`` and ``r`` times, a phrase scores ``floor(2000000 a / (l + r))``; the lowest cut counts, the first of
    equal ones. A candidate inside a longer one with ``covered_percent`` of its count goes. ``n`` counts the language's words;
    ``doc_id`` and ``word`` point to an occurrence. A null language is ``und``, and null and empty texts have no words.
    Repeated rows count each time. An empty table has no phrases; other columns are not read. The first ``top`` phrases by
    score, count and bytes are a report's length; nothing is left out before.
    """
    found = frequent_phrases(docs, longest, least, mask)
    words, counts = F.split("phrase", " "), found.where("size > 0")
    many = counts.where("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"), "doc_id", "word", words.alias("words"))
    cuts = many.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("right"),
    )
    parts = [counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)) for side, name in (("left", "l"), ("right", "r"))]
    scored = cuts.join(parts[0], ["lang", "left"]).join(parts[1], ["lang", "right"]).withColumn("wide", _wide("l") + _wide("r"))
    scored = scored.withColumn("score", F.expr("cast(a as decimal(20,0)) * 2000000 div wide"))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    spans = [(i, n) for n in range(2, longest) for i in range(longest - n + 1)]
    inner = F.filter(
        F.array(*[F.struct(F.lit(i).alias("i"), F.lit(n).alias("n")) for i, n in spans]),
        lambda s: (s["i"] + s["n"] <= F.col("size")) & (s["n"] < F.col("size")),
    ) if spans else F.array().cast("array<struct<i:int,n:int>>")
    covers = many.select("lang", "a", "words", F.explode(inner).alias("s")).select(
        "lang", F.array_join(F.slice("words", F.col("s.i") + 1, F.col("s.n")), " ").alias("phrase"), "a"
    ).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    uncovered = F.col("longer").isNull() | (100 * _wide("longer") < covered_percent * _wide("a"))
    kept = many.join(covers, ["lang", "phrase"], "left").where(uncovered).join(lowest, ["lang", "phrase"])
    totals = found.where("size = 0").select("lang", F.col("n").alias("n"))
    kept = kept.join(totals, "lang").select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"),
        "doc_id", "word",
    )
    placed = with_position(kept, "rank", [-F.col("score"), -F.col("a"), F.col("phrase")], by=["lang"])
    return placed.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "doc_id", "word"
    )

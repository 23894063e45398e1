"""Language identification of mixed-language texts.

Words are scored by character n-gram models, one per language. The scripts a word is written in narrow the
languages it may belong to. A Viterbi pass over the word scores, with a penalty for each switch, labels spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewharf.llm.text import WHITE, Texts, Words, byte_set, crc_class, mix, slices

BUCKETS = 1 << 15
ORDERS = (2, 3, 4)
SWITCH = 10.0
SAMPLE_PER_LANGUAGE = 2000
SLICE = 3 << 20

# First code points of the blocks of a script, with the script's name; "" is no letter.
SCRIPT_STARTS = [
    (0x00, ""), (0x41, "Latin"), (0x5B, ""), (0x61, "Latin"), (0x7B, ""), (0xAA, "Latin"), (0xAB, ""),
    (0xB5, "Greek"), (0xB6, ""), (0xBA, "Latin"), (0xBB, ""), (0xC0, "Latin"), (0xD7, ""), (0xD8, "Latin"),
    (0xF7, ""), (0xF8, "Latin"), (0x2B0, ""), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Armenian"),
    (0x590, "Hebrew"), (0x600, "Arabic"), (0x700, "Other"), (0x900, "Devanagari"), (0x980, "Bengali"),
    (0xA00, "Other"), (0xE00, "Thai"), (0xE80, "Other"), (0x10A0, "Georgian"), (0x1100, "Hangul"),
    (0x1200, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, ""), (0x2C00, "Other"), (0x2E00, ""),
    (0x2E80, "Han"), (0x3000, ""), (0x3040, "Kana"), (0x3100, "Other"), (0x3130, "Hangul"), (0x3190, "Other"),
    (0x31F0, "Kana"), (0x3200, ""), (0x3400, "Han"), (0x4DC0, ""), (0x4E00, "Han"), (0xA000, "Other"),
    (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB10, "Other"), (0xFE00, ""),
    (0xFE70, "Arabic"), (0xFF00, ""), (0xFF21, "Latin"), (0xFF3B, ""), (0xFF41, "Latin"), (0xFF5B, ""),
    (0xFF66, "Kana"), (0xFFA0, "Other"), (0xFFE0, ""), (0x10000, "Other"), (0x1F000, ""), (0x20000, "Han"),
    (0x32000, ""),
]
SCRIPTS = sorted({name for _, name in SCRIPT_STARTS if name})
STARTS = np.array([first for first, _ in SCRIPT_STARTS])
SCRIPT_OF = np.array([SCRIPTS.index(name) if name else -1 for _, name in SCRIPT_STARTS])
LEADS = byte_set((0x00, 0x7F), (0xC0, 0xFF))
SPAN = pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])


def folded(texts: Texts) -> Texts:
    """Lower case for A to Z and for the accented capitals of Latin-1."""
    data = texts.data.copy()
    data[(data >= 0x41) & (data <= 0x5A)] += 32
    late = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    data[late] += 32
    return Texts(data, texts.offsets)


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the places of their first bytes."""
    at = np.flatnonzero(LEADS[data])
    wide = np.concatenate((data, np.zeros(3, np.uint8))).astype(np.int64)
    a, b, c, d = (wide[at + i] for i in range(4))
    b, c, d = b & 63, c & 63, d & 63
    return np.select(
        [a < 0x80, a < 0xE0, a < 0xF0],
        [a, ((a & 31) << 6) | b, ((a & 15) << 12) | (b << 6) | c],
        ((a & 7) << 18) | (b << 12) | (c << 6) | d,
    ), at


def script_counts(words: Words) -> np.ndarray:
    """Letters of each script, per word."""
    out = np.zeros((len(words), len(SCRIPTS)), np.int32)
    if not len(words):
        return out
    points, at = code_points(words.texts.data)
    script = SCRIPT_OF[np.searchsorted(STARTS, points, side="right") - 1]
    keep = (script >= 0) & words.inside[at]
    place = np.searchsorted(words.start, at[keep], side="right") - 1
    cell = place * len(SCRIPTS) + script[keep]
    return np.bincount(cell, minlength=out.size).reshape(out.shape).astype(np.int32)


def chosen(words: Words, which: np.ndarray) -> Words:
    """Only the words ``which``, packed as the words of one text."""
    start, end = words.start[which], words.end[which]
    length = end - start
    stop = np.cumsum(length + 1)
    begin = stop - length - 1
    data = np.full(int(stop[-1]) if len(stop) else 0, 0x20, np.uint8)
    to = np.arange(int(length.sum())) + np.repeat(np.arange(len(which)), length)
    data[to] = words.texts.data[np.arange(len(to)) + np.repeat(start - (np.cumsum(length) - length), length)]
    inside = np.zeros(len(data), bool)
    inside[to] = True
    owner = np.zeros(len(which), np.int64)
    return Words(Texts(data, np.array([0, len(data)])), inside, begin, begin + length, owner, np.array([0, len(which)]))


def grams(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the buckets of the words' n-grams, with a mark at both ends of a word, and their words."""
    if not len(words):
        return
    length = words.end - words.start + 2
    begin = np.cumsum(length) - length
    owner = np.repeat(np.arange(len(words)), length)
    room = np.arange(len(owner)) - begin[owner]
    inner = (room > 0) & (room < (length - 1)[owner])
    data = np.full(len(owner), 0x5F, np.uint64)
    data[inner] = words.texts.data[words.inside]
    rolled = data.copy()
    for n in range(2, max(ORDERS) + 1):
        rolled = rolled[:-1] * np.uint64(257) + data[n - 1 :]
        if n in ORDERS:
            fits = np.flatnonzero(owner[: len(rolled)] == owner[n - 1 :])
            yield (mix(rolled[fits] + np.uint64(n << 56)) & np.uint64(BUCKETS - 1)).astype(np.int32), owner[fits]


def _count(names: list[str]):
    """Counts of n-gram buckets, and behind them of scripts, per language."""
    cells = BUCKETS + len(SCRIPTS)
    of = {name: i for i, name in enumerate(names)}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names) * cells, np.int64)
        for part in slices(batches, SLICE):
            words = folded(Texts.of(part.column("text"))).words(WHITE)
            if not len(words):
                continue
            lang = np.array([of[x] for x in part.column("lang").to_pylist()])[words.owner]
            h = words.hashes() + lang.astype(np.uint64)
            _, which, times = np.unique(h, return_index=True, return_counts=True)
            distinct, base = chosen(words, which), lang[which] * cells
            for bucket, owner in grams(distinct):
                total += np.bincount(base[owner] + bucket, times[owner], len(total)).astype(np.int64)
            for j, column in enumerate(script_counts(distinct).T):
                total += np.bincount(base + BUCKETS + j, column * times, len(total)).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": at, "n": total[at]})

    return counted, cells


class Model:
    """``log_p``: natural log of bucket probabilities less their mean over languages; ``allowed``: by script."""

    def __init__(self, names: list[str], log_p: np.ndarray, allowed: np.ndarray):
        self.names, self.log_p, self.allowed = names, log_p, allowed

    def word_scores(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """A score for each word and language, equal ones for words without letters; whether there are letters."""
        if not len(words):
            return np.zeros((0, len(self.names)), np.float32), np.zeros(0, bool)
        _, which, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
        distinct = chosen(words, which)
        scores = np.zeros((len(which), len(self.names)))
        for bucket, owner in grams(distinct):
            for j, column in enumerate(self.log_p.T):
                scores[:, j] += np.bincount(owner, column[bucket], len(which))
        scores /= len(ORDERS)
        letters = script_counts(distinct)
        allowed = self.allowed[letters.argmax(axis=1)]
        scores = np.where(allowed.any(axis=1, keepdims=True) & ~allowed, -60.0, scores)
        lettered = letters.any(axis=1)
        scores[~lettered] = 0
        return scores.astype(np.float32)[back], lettered[back]


def train(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """N-gram models of the languages in ``lang``.

    Fitted on a sample of about ``per_language`` distinct texts of each language, chosen by a hash of the text,
    each taken once; rows without text or language are left out. Languages are few by nature; their counts and at most
    ``BUCKETS`` sums for each come to the driver.
    """
    labelled = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        "text", "lang", F.xxhash64("text").alias("h")
    )
    totals = {r["lang"]: r["count"] for r in labelled.select("lang", "h").distinct().groupBy("lang").count().collect()}
    names = sorted(totals)
    if not names:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPTS), 0), bool))
    share = F.lit(0.0)
    for name in names:
        share = F.when(F.col("lang") == name, min(1.0, per_language / totals[name])).otherwise(share)
    sample = labelled.where(F.pmod("h", F.lit(1_000_000)) < share * 1_000_000).dropDuplicates(["lang", "h"]).drop("h")
    counted, cells = _count(names)
    rows = (
        sample.mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    )
    count = np.zeros(len(names) * cells)
    count[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    count = count.reshape(len(names), cells)
    seen, letters = count[:, :BUCKETS] + 0.5, count[:, BUCKETS:]
    log_p = np.log(seen / seen.sum(axis=1, keepdims=True)).T
    allowed = (letters >= 0.01 * np.maximum(letters.sum(axis=1, keepdims=True), 1)) & (letters > 0)
    return Model(names, (log_p - log_p.mean(axis=1, keepdims=True)).astype(np.float32), allowed.T)


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word; all texts advance together, word by word."""
    kind = np.min_scalar_type(-max(scores.shape[1], 1))  # the smallest signed type that holds every label
    label = np.zeros(len(scores), kind)
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    start, left = first[:-1][order], length[order]
    longest = int(left[0]) if len(left) else 0
    active = np.searchsorted(-left, -np.arange(longest), side="left")  # texts with more than t words
    back = np.empty(scores.shape, kind)
    own = np.arange(scores.shape[1], dtype=kind)
    state = np.zeros((len(left), scores.shape[1]), np.float32)
    for t in range(longest):
        n = active[t]
        now, at = state[:n], start[:n] + t
        if t:
            best = now.argmax(axis=1)
            change = (now[np.arange(n), best] - switch)[:, None]
            back[at] = np.where(change > now, best[:, None], own)
            np.maximum(now, change, out=now)
        now += scores[at]
    tag = state.argmax(axis=1).astype(kind)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = start[:n] + t
        label[at] = tag[:n]
        if t:
            tag[:n] = back[at, tag[:n]]
    return label


def _spans(label: np.ndarray, first: np.ndarray, names: list[str]) -> pa.Array:
    change = np.ones(len(label), bool)
    change[1:] = label[1:] != label[:-1]
    change[first[:-1][first[:-1] < len(label)]] = True
    at = np.flatnonzero(change)
    count = np.searchsorted(at, first, side="left")
    owner = np.searchsorted(first, at, side="right") - 1
    size = np.diff(np.concatenate((at, [len(label)])))
    values = pa.StructArray.from_arrays(
        [pa.array(np.array(names, object)[label[at]], pa.string()), pa.array(at - first[owner]), pa.array(size)],
        fields=list(SPAN),
    )
    return pa.ListArray.from_arrays(pa.array(count.astype(np.int32)), values)


def identify(docs: DataFrame, model: Model, *keys: str | Column, spans: bool = True) -> DataFrame:
    """``keys``, ``lang_pred``, ``score`` and, if asked for, ``spans`` of every row of ``docs``.

    ``lang_pred`` is the language with most bytes in the labelled words that have letters and ``score`` its
    share of them; ties go to the first name. Null texts and texts without letters get ``und`` and 0.
    Repeated rows are labelled alike. Without any learned language every text is ``und``.
    """
    names = model.names
    inner = docs.select(*keys, "text") if "text" not in keys else docs.select(*keys)
    outer = [f for f in inner.schema.fields if f.name != "text" or "text" in keys]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outer) + ", lang_pred string, score double"
    if spans:
        ddl += ", spans array<struct<lang string, first_word bigint, n_words bigint>>"
    shared = docs.sparkSession.sparkContext.broadcast(model)

    # scores are words times languages: beyond 16 languages a slice has less text
    limit = max(SLICE * 16 // max(len(names), 16), 1 << 16)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in slices(batches, limit):
            words = folded(Texts.of(part.column("text"))).words(WHITE)
            scores, lettered = model.word_scores(words)
            label = viterbi(scores, words.first) if names else np.zeros(len(words), np.int8)
            weight = np.where(lettered, words.end - words.start, 0)
            kinds = max(len(names), 1)
            mass = np.bincount(words.owner * kinds + label, weight, len(words.texts) * kinds).reshape(-1, kinds)
            total, best = mass.sum(axis=1), mass.argmax(axis=1)
            found = (total > 0) & bool(names)
            columns = {f.name: part.column(f.name) for f in outer}
            columns["lang_pred"] = pa.array(np.where(found, np.array([*names, "und"], object)[best], "und"), pa.string())
            columns["score"] = pa.array(np.where(found, mass.max(axis=1) / np.maximum(total, 1), 0.0))
            if spans:
                columns["spans"] = _spans(label, words.first, names or ["und"])
            yield pa.RecordBatch.from_pydict(columns)

    return inner.mapInArrow(labelled, ddl)


def held_out(key: str = "doc_id", classes: int = 3, out: int = 1) -> Column:
    """Whether a document is kept from training; never true for a null key."""
    return F.coalesce(crc_class(key, classes) == out, F.lit(False))


def learned_from(docs: DataFrame) -> DataFrame:
    """The rows a model may learn from: those with a key that is not held out."""
    return docs.where(crc_class("doc_id", 3) != 1)



"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages and only the bag is labelled. Every passage is encoded, a gated attention
learned from the document labels weighs the passages, and the weighted sum of their encodings is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewharf.llm.text import WHITE, Texts, byte_set, crc_class, slices, sums

PASSAGE_WORDS = 48
MAX_LABELLED = 6000
SYMBOLS = "#*$%&|<>"
CUT = 0.3

LOWER_CASE = byte_set((0x61, 0x7A))
UPPER_CASE = byte_set((0x41, 0x5A))
DIGIT = byte_set((0x30, 0x39))
OTHER = byte_set((0x80, 0xFF))
SYMBOL = byte_set(*[(ord(c), ord(c)) for c in SYMBOLS])
STOP = byte_set(*[(ord(c), ord(c)) for c in ".,;:?"])
BANG = byte_set((0x21, 0x21))
PIPE = byte_set((0x7C, 0x7C))
CLASSES = (LOWER_CASE, UPPER_CASE, DIGIT, OTHER, SYMBOL, STOP, BANG, PIPE)
FEATURES = len(CLASSES) + 8


def passages(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of ``PASSAGE_WORDS`` words, and each text's first passage.

    A text without words is one passage of zeros. The features: shares of byte classes, words beginning
    upper-case, words equal to the one before or to one of the three before, distinct words of the passage,
    words met earlier in the text, mean word length, lengths of passage and text.
    """
    words = texts.words(WHITE)
    count = words.counts
    bags = np.maximum((count + PASSAGE_WORDS - 1) // PASSAGE_WORDS, 1)
    first = np.concatenate(([0], np.cumsum(bags)))
    x = np.zeros((int(first[-1]), FEATURES), np.float32)
    if not len(words):
        return x, first
    passage = first[words.owner] + (np.arange(len(words)) - words.first[words.owner]) // PASSAGE_WORDS
    begin = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
    which = passage[begin]
    n = np.diff(np.concatenate((begin, [len(words)]))).astype(np.float64)
    edge = words.start[begin]
    upper_late = np.zeros(len(texts.data), bool)
    data = texts.data
    upper_late[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    length = words.end - words.start
    size = np.maximum(sums(length, begin), 1).astype(np.float64)
    counts = []
    for flags in CLASSES:
        hit = flags[data] & words.inside
        if flags is UPPER_CASE:
            hit |= upper_late
        counts.append(sums(hit.astype(np.int32), edge))
    features = [c / size for c in counts]
    h = words.hashes()
    same = np.zeros(len(words), bool)
    near = np.zeros(len(words), bool)
    for back in (1, 2, 3):
        if len(h) > back:
            match = (h[back:] == h[:-back]) & (words.owner[back:] == words.owner[:-back])
            near[back:] |= match
            if back == 1:
                same[1:] = match
    order = np.lexsort((words.owner, h))  # stable: equal words of a text stay in order
    repeat = np.zeros(len(words), bool)
    repeat[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (words.owner[order[1:]] == words.owner[order[:-1]])
    inner = np.zeros(len(words), bool)
    inner[order[1:]] = repeat[order[1:]] & (passage[order[1:]] == passage[order[:-1]])
    capital = UPPER_CASE[data[words.start]]
    for flag in (capital, same, near, inner, repeat):
        features.append(sums(flag.astype(np.int32), begin) / n)
    features += [np.log1p(size / n) / 3, np.log1p(n) / 4, np.log1p(count[words.owner[begin]]) / 10]
    x[which] = np.stack(features, axis=1)
    return x, first


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]

    def score(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The score of each bag and the attention of each passage."""
        state = forward((x - self.mean) / self.scale, first, self.w)
        return state["p"], state["a"]


def sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def forward(x: np.ndarray, first: np.ndarray, w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    start, bag = first[:-1], np.repeat(np.arange(len(first) - 1), np.diff(first))
    h = np.tanh(x @ w["E"] + w["e"])
    v, u = np.tanh(h @ w["V"]), sigmoid(h @ w["U"])
    s = np.clip((v * u) @ w["q"], -20, 20)
    g = np.exp(s - np.maximum.reduceat(s, start)[bag])
    a = g / np.add.reduceat(g, start)[bag]
    z = np.add.reduceat(h * a[:, None], start, axis=0)
    return {"h": h, "v": v, "u": u, "a": a, "z": z, "bag": bag, "p": sigmoid(z @ w["c"] + w["b"])}


def gradients(x, first, y, w, s) -> dict[str, np.ndarray]:
    """Of the mean log loss."""
    start, bag, h, v, u, a, z = first[:-1], s["bag"], s["h"], s["v"], s["u"], s["a"], s["z"]
    d = (s["p"] - y) / len(y)
    dz = d[:, None] * w["c"]
    dh = dz[bag] * a[:, None]
    da = (dz[bag] * h).sum(axis=1)
    ds = a * (da - np.add.reduceat(da * a, start)[bag])
    dv, du = ds[:, None] * u * w["q"] * (1 - v * v), ds[:, None] * v * w["q"] * u * (1 - u)
    dh = dh + dv @ w["V"].T + du @ w["U"].T
    de = dh * (1 - h * h)
    return {
        "E": x.T @ de, "e": de.sum(axis=0), "V": h.T @ dv, "U": h.T @ du,
        "q": ((v * u) * ds[:, None]).sum(axis=0), "c": z.T @ d, "b": np.array([d.sum()]),
    }


def fit(x: np.ndarray, first: np.ndarray, y: np.ndarray, epochs: int = 60, width: int = 16, seed: int = 7) -> Model:
    """Adam on batches of 64 bags, in a fixed order drawn from ``seed``."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - mean) / scale
    rng = np.random.default_rng(seed)
    d, k = x.shape[1], 8
    w = {
        "E": rng.normal(0, d**-0.5, (d, width)), "e": np.zeros(width), "V": rng.normal(0, width**-0.5, (width, k)),
        "U": rng.normal(0, width**-0.5, (width, k)), "q": rng.normal(0, 0.3, k), "c": rng.normal(0, 0.3, width),
        "b": np.zeros(1),
    }
    m, r = ({name: np.zeros_like(p) for name, p in w.items()} for _ in range(2))
    step, size = 0, np.diff(first)
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        rate = 0.01 * (1 - epoch / epochs) + 0.0005
        for at in range(0, len(y), 64):
            bags = order[at : at + 64]
            ends = np.concatenate(([0], np.cumsum(size[bags])))
            rows = np.arange(ends[-1]) + np.repeat(first[bags] - ends[:-1], size[bags])
            part = x[rows]
            g = gradients(part, ends, y[bags], w, forward(part, ends, w))
            step += 1
            for name in w:
                m[name] = 0.9 * m[name] + 0.1 * (g[name] + 1e-5 * w[name])
                r[name] = 0.999 * r[name] + 0.001 * g[name] ** 2
                w[name] = w[name] - rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(r[name] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, w)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        x, first = passages(Texts.of(part.column("text")))
        values = pa.ListArray.from_arrays(pa.array((first * FEATURES).astype(np.int32)), pa.array(x.ravel()))
        yield pa.RecordBatch.from_pydict({"y": part.column("y"), "h": part.column("h"), "x": values})


def train(docs: DataFrame, labels: DataFrame, label: str, max_labelled: int = MAX_LABELLED, **options) -> Model | None:
    """A model of the 0/1 column ``label`` of ``labels`` for the texts of ``docs`` with the same ``doc_id``.

    It is fitted on about ``max_labelled`` labelled documents, chosen by a hash of their key; that is the only
    bound, and texts are read whole. Null labels, keys and texts are left out, equal rows count once, and a
    key labelled both ways counts as 0. None if there are no documents of both labels.
    """
    y = F.col(label).cast("double")
    usable = labels.where(y.isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(y).alias("y"))
    share = min(1.0, max_labelled / max(usable.count(), 1))
    sample = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = (
        docs.select("doc_id", "text").where(F.col("text").isNotNull())
        .join(F.broadcast(sample), "doc_id")  # at most max_labelled keys, up to chance
        .select("text", "y").distinct().withColumn("h", F.xxhash64("text"))
    )
    got = rows.mapInArrow(_encode, "y double, h long, x array<float>").toArrow().sort_by("h").combine_chunks()
    truth = got["y"].to_numpy()
    if len(set(truth.tolist())) < 2:
        return None
    lists = got["x"].chunk(0)
    x = lists.flatten().to_numpy().reshape(-1, FEATURES).astype(np.float64)
    first = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy() // FEATURES)))
    return fit(x, first, truth, **options)


def score(docs: DataFrame, model: Model | None, *keys: str | Column, attention: bool = False) -> DataFrame:
    """``keys`` and ``score`` (0 to 1) of every row of ``docs``; with ``attention`` its passages' weights.

    Null and empty texts are one empty passage. Without a model every score is 0.5.
    """
    inner = docs.select(*keys, "text") if "text" not in keys else docs.select(*keys)
    outer = [f for f in inner.schema.fields if f.name != "text" or "text" in keys]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outer) + ", score double"
    ddl += ", attention array<double>" * attention
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in slices(batches):
            x, first = passages(Texts.of(part.column("text")))
            if model is None:
                p, a = np.full(part.num_rows, 0.5), 1 / np.repeat(np.diff(first), np.diff(first))
            else:
                p, a = model.score(x.astype(np.float64), first)
            columns = {f.name: part.column(f.name) for f in outer} | {"score": pa.array(p)}
            if attention:
                columns["attention"] = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(a))
            yield pa.RecordBatch.from_pydict(columns)

    return inner.mapInArrow(scored, ddl)


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is kept from training; never true for a null key."""
    return F.coalesce(crc_class(key, 5) == 0, F.lit(False))


def learnable(labels: DataFrame) -> DataFrame:
    """The labels a model may learn from: those of keys that are not held out."""
    return labels.where(crc_class("doc_id", 5) != 0)

"""Fill-in-the-middle transformation over a compressed set of boundaries.

The places in a text's bytes where a unit (code point, word or line) begins, and the end, form a set. It is kept in
containers of 2^16 places, each as a sorted array, a bitmap or a list of runs, whichever is smallest, with cumulative
cardinalities in front. The place of the k-th boundary is found by a search over the containers and a select inside
one of them, so a text is cut at any unit without decoding it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewharf.llm.text import WHITE, slices

SPAN = 1 << 16
BITMAP_BYTES = SPAN // 8
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT, SPM_PERCENT = 10, 20
RESULTS = ("n", "form", "prefix_units", "middle_units", "output")


class ArrayContainer:
    def __init__(self, places: np.ndarray):
        self.places = places.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.places[k])


class BitmapContainer:
    def __init__(self, flags: np.ndarray):
        whole = np.zeros(SPAN, bool)
        whole[: len(flags)] = flags
        self.words = np.packbits(whole, bitorder="little").view(np.uint64)
        self.after = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.after, k, side="right"))
        bits = int(self.words[word])
        for _ in range(k - (int(self.after[word - 1]) if word else 0)):
            bits &= bits - 1  # drops the lowest bit
        return 64 * word + (bits & -bits).bit_length() - 1


class RunContainer:
    def __init__(self, first: np.ndarray, lengths: np.ndarray):
        self.first = first.astype(np.uint16)
        self.after = np.cumsum(lengths, dtype=np.int64)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.after, k, side="right"))
        return int(self.first[run]) + k - (int(self.after[run - 1]) if run else 0)


def container(flags: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest form of the set of places that are flagged; ``flags`` holds 2^16 places at most."""
    places = np.flatnonzero(flags)
    breaks = np.flatnonzero(np.diff(places) > 1)
    first = np.concatenate((places[:1], places[breaks + 1]))
    last = np.concatenate((places[breaks], places[-1:]))
    sizes = {"runs": 4 * len(first), "array": 2 * len(places), "bitmap": BITMAP_BYTES}
    smallest = min(sizes, key=sizes.get)
    if smallest == "runs":
        return RunContainer(first, last - first + 1)
    return ArrayContainer(places) if smallest == "array" else BitmapContainer(flags)


class Boundaries:
    """The flagged places, to be asked for the k-th one, from 0."""

    def __init__(self, flags: np.ndarray):
        self.containers, self.base, counts = [], [], []
        for start in range(0, len(flags), SPAN):
            part = flags[start : start + SPAN]
            if n := int(np.count_nonzero(part)):
                self.containers.append(container(part))
                self.base.append(start)
                counts.append(n)
        self.after = np.cumsum(counts, dtype=np.int64)

    def __len__(self) -> int:
        return int(self.after[-1]) if len(self.after) else 0

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.after, k, side="right"))
        return self.base[at] + self.containers[at].select(k - (int(self.after[at - 1]) if at else 0))


def unit_starts(data: np.ndarray, unit: str) -> np.ndarray:
    """Flags of the bytes at which a unit begins, and of the end."""
    flags = np.ones(len(data) + 1, bool)
    if unit == "char":
        flags[:-1] = (data & 0xC0) != 0x80  # not a continuation byte of UTF-8
    elif unit == "word":
        flags[:-1] = ~WHITE[data]
        flags[1:-1] &= WHITE[data[:-1]]
    elif unit == "line":
        flags[1:-1] = data[:-1] == 0x0A
    else:
        raise ValueError(f"unit {unit} is none of char, word, line")
    return flags


def _cut(unit: str, sentinels: tuple[str, str, str], plain_percent: int, spm_percent: int, schema: pa.Schema):
    p, s, m = (x.encode() for x in sentinels)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column("text").cast(pa.large_binary()).to_pylist()
            draws = zip(*(part.column(f"h{i}").to_pylist() for i in (1, 2, 3, 4)))
            out = {name: [] for name in RESULTS}
            for text, (h1, h2, h3, h4) in zip(texts, draws):
                text = text or b""
                starts = Boundaries(unit_starts(np.frombuffer(text, np.uint8), unit))
                n = len(starts) - 1
                form, first, second, output = "plain", None, None, text
                if text and h3 % 100 < 100 - plain_percent and not (p in text or s in text or m in text):
                    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
                    a, b = starts.select(first), starts.select(second)
                    if h4 % 100 < spm_percent:
                        form, output = "spm", b"".join((s, text[b:], p, text[:a], m, text[a:b]))
                    else:
                        form, output = "psm", b"".join((p, text[:a], s, text[b:], m, text[a:b]))
                cut = form != "plain"
                for name, x in zip(RESULTS, (n, form, first, second - first if cut else None, output)):
                    out[name].append(x)
            arrays = [part.column(name) for name in schema.names[: -len(RESULTS)]]
            arrays += [
                pa.array(out["n"], pa.int64()), pa.array(out["form"], pa.string()), pa.array(out["prefix_units"], pa.int64()),
                pa.array(out["middle_units"], pa.int64()), pa.array(out["output"], pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return told


def draws(seed: int) -> list[Column]:
    """Four numbers of 32 bits for each document, from the SHA-256 of the seed, a colon and the key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transform(docs: DataFrame, *keep: str, seed: int = 1, unit: str = "char", sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
              plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``n``, ``form``, ``prefix_units``, ``middle_units`` and ``output``.

    A text of ``n`` units is cut at two of its ``n + 1`` boundaries, drawn from a hash of ``seed`` and ``doc_id``, and put
    together as prefix, suffix, middle (``psm``) or, for ``spm_percent`` of the cut texts, suffix, prefix, middle (``spm``),
    each after its sentinel. ``plain_percent`` of all texts stay ``plain``, as do empty and null ones (``n`` is 0, ``output``
    empty) and those that contain a sentinel; their unit counts are null. Words and lines include what follows them up to
    the next; what precedes the first word is in the prefix. A null key counts as an empty one, rows with the same key are
    cut at the same draws, and columns of ``docs`` with the name of a result give way to it. One pass without a shuffle.
    """
    kept = [c for c in keep if c.lower() not in RESULTS]
    rows = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(kept)], F.col("text").cast("string").alias("text"), *draws(seed))
    kinds = [rows.schema[f"_{i}"].dataType.simpleString() for i in range(len(kept))]
    passed = [f"_{i}" for i in range(len(kept))]
    fields = [f"{name} {kind}" for name, kind in zip(passed, kinds)]
    fields += ["n long", "form string", "prefix_units long", "middle_units long", "output string"]
    schema = pa.schema([(name, pa.null()) for name in (*passed, *RESULTS)])
    cut = rows.mapInArrow(_cut(unit, sentinels, plain_percent, spm_percent, schema), ", ".join(fields))
    return cut.toDF(*kept, *RESULTS)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that ``transform`` made ``output`` of. A cut text holds each sentinel once, so they split it."""
    parts = F.split(output, "|".join(rf"\Q{x}\E" for x in sentinels), -1)
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)

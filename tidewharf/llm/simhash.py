"""Near-duplicate documents by SimHash fingerprints, linked through multi-index hashing.

A fingerprint of 64 bits is split into m segments with a table of fingerprints for each. If two fingerprints differ in
at most r = m * a + b bits, they differ in at most a bits in one of the first b + 1 segments, or in at most a - 1 bits in
one of the others. So each fingerprint enumerates the small Hamming ball around each of its segments, fetches the
tables' entries of those values, and the whole distance is verified.

Documents with the same fingerprint are one vertex. Before the tables are asked, fingerprints are sorted by each quarter
of their bits in turn and linked exactly inside blocks of neighbours; so a large group of near copies has become one
component, or few, when the tables are built. A fingerprint then asks only entries that hold a larger component than its
own, and long entries are cut in pieces: members of a group never meet each other in pairs through the tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewharf.functions.scratch import materialized, shuffled
from tidewharf.llm.jaccard import components
from tidewharf.llm.text import slices

SEED = 42
WORDS = 4
DISTANCE = 4
BLOCK = 1024
PIECE = 512
LANES = 255
AT_ONCE = 1 << 18


def shingle_hashes(text: bytes | None, words: int) -> list[int]:
    """XXH64 of the space-joined runs of ``words`` words, repeats included; of all words if there are fewer."""
    found = (text or b"").lower().split()  # of bytes: A to Z, and the six white space characters of ASCII
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= words:
        return [digest(joined, SEED)] if found else []
    ends = (np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[: len(found) - words]]]
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :])]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of ``counts`` hashes the bits set in over half of them; 0 for none."""
    out = np.zeros(len(counts), np.uint64)
    own = np.flatnonzero(counts)
    if not len(own):
        return out
    counts = counts[own]
    first = np.cumsum(counts) - counts
    place = np.arange(len(hashes)) - np.repeat(first, counts)
    block = np.flatnonzero(place % LANES == 0)
    lanes, upto = [], np.append(block, len(hashes))
    for i in range(0, len(block), AT_ONCE // LANES):
        some = block[i : i + AT_ONCE // LANES]
        own_hashes = hashes[some[0] : upto[i + len(some)]]
        # a bit in a byte, eight bytes in a word: up to 255 words are added without a carry
        bits = np.unpackbits(own_hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
        lanes.append(np.add.reduceat(bits, some - some[0], axis=0).view(np.uint8).astype(np.int64))
    lanes = np.concatenate(lanes)
    sums = np.add.reduceat(lanes, np.searchsorted(block, first), axis=0)
    out[own] = np.packbits(2 * sums > counts[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _fingerprints(words: int):
    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            lists = [shingle_hashes(text, words) for text in part.column("text").cast(pa.large_binary()).to_pylist()]
            counts = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter((h for own in lists for h in own), np.uint64, int(counts.sum()))
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "fp": pa.array(majority(flat, counts).view(np.int64)),
            })

    return told


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id`` and ``fp``, a signed long, of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_fingerprints(words), f"doc_id {kind}, fp long")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def segments(m: int, distance: int) -> list[tuple[int, int, int]]:
    """Shift, width and radius of each of ``m`` segments; the narrower ones get the larger radius."""
    a, b = divmod(distance, m)
    widths = [64 // m] * (m - 64 % m) + [64 // m + 1] * (64 % m)
    shifts = [sum(widths[:i]) for i in range(m)]
    return [(shift, width, a if i <= b else a - 1) for i, (shift, width) in enumerate(zip(shifts, widths))]


def ball(width: int, radius: int) -> list[int]:
    """All masks of up to ``radius`` of ``width`` bits."""
    masks, last = [0], [(0, 0)]
    for _ in range(max(radius, 0)):
        last = [(mask | 1 << i, i + 1) for mask, low in last for i in range(low, width)]
        masks += [mask for mask, _ in last]
    return masks


def best_segments(n: int, distance: int) -> int:
    """The number of segments for ``n`` fingerprints: fewest values asked plus entries met by chance."""
    def cost(m: int) -> float:
        return sum(len(ball(width, radius)) * (1 + n / 2.0**width) for _, width, radius in segments(m, distance) if radius >= 0)

    return min(range(2, max(distance, 2) + 1), key=cost)


def _neighbours(distance: int):
    """Links of each fingerprint to the first one of its component inside a block of sorted fingerprints."""
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            for start in range(0, len(fp), BLOCK):
                own = fp[start : start + BLOCK].view(np.uint64)
                near = np.bitwise_count(own[:, None] ^ own[None, :]) <= distance
                a, b = np.nonzero(near)
                label, low = np.arange(len(own)), None
                while low is None or (low != label).any():
                    label = label if low is None else low[low]
                    low = np.minimum.reduceat(label[b], np.searchsorted(a, np.arange(len(own))))
                moved = np.flatnonzero(label != np.arange(len(own)))
                yield pa.RecordBatch.from_pydict({
                    "a": pa.array(own[moved].view(np.int64)), "b": pa.array(own[label[moved]].view(np.int64)),
                })

    return linked


def _near_in_order(classes: DataFrame, distance: int) -> DataFrame:
    """Links ``(a, b)`` between fingerprints that are close in one of four sort orders."""
    found = None
    for turn in (0, 16, 32, 48):
        fp = F.col("fp")
        order = F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, 64 - turn)) if turn else fp
        ordered = classes.select("fp", order.alias("o")).repartitionByRange("o").sortWithinPartitions("o").select("fp")
        links = ordered.mapInArrow(_neighbours(distance), "a long, b long")
        found = links if found is None else found.unionByName(links)
    return materialized(found)


def _rooted(vertices: DataFrame, name: str, links: DataFrame, to: str) -> DataFrame:
    """``vertices`` with ``to``: the smallest vertex that ``links`` lead to from column ``name``."""
    roots = components(links).select(F.col("v").alias(name), F.col("root").alias("_root"))
    return vertices.join(shuffled(roots), name, "left").withColumn(to, F.coalesce("_root", name)).drop("_root")


def linked_fingerprints(classes: DataFrame, distance: int = DISTANCE, m: int | None = None) -> DataFrame:
    """``(fp, root)`` of distinct fingerprints: equal roots for those that links of ``distance`` bits at most connect."""
    grouped = _rooted(classes.select("fp"), "fp", _near_in_order(classes, distance), "g")
    sizes = grouped.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    groups = materialized(grouped.join(shuffled(sizes), "g").select("fp", "g", "size"))

    def keys(enumerated: bool) -> Column:
        fp, out = F.col("fp"), []
        for i, (shift, width, radius) in enumerate(parts):
            own = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))
            for mask in ball(width, radius) if enumerated else [0]:
                if radius >= 0:
                    out.append(F.struct(F.lit(i).alias("i"), own.bitwiseXOR(F.lit(mask)).alias("value")))
        return F.inline(F.array(*out))

    parts = segments(m or best_segments(groups.count(), distance), distance)
    table = groups.select("fp", "g", "size", keys(False))
    rank = F.struct("size", "g")
    entries = table.groupBy("i", "value").agg(F.count(F.lit(1)).alias("held"), F.max(rank).alias("top"))
    pieces = F.ceil(F.col("held") / PIECE)
    asked = materialized(
        groups.select("fp", "g", "size", keys(True)).join(shuffled(entries), ["i", "value"]).where(rank < F.col("top"))
        .select("fp", "g", "i", "value", pieces.alias("pieces"))
    )
    opened = asked.select("i", "value", "pieces").distinct()
    members = (
        table.join(shuffled(opened), ["i", "value"]).withColumn("piece", F.pmod(F.xxhash64("fp"), "pieces"))
        .groupBy("i", "value", "piece").agg(F.collect_list(F.struct("fp", "g")).alias("members"))
    )
    asking = asked.select("fp", "g", "i", "value", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    met = asking.join(shuffled(members), ["i", "value", "piece"])
    close = F.filter("members", lambda x: (x["g"] != F.col("g")) & (F.bit_count(x["fp"].bitwiseXOR(F.col("fp"))) <= distance))
    links = met.select("g", F.explode(F.array_distinct(F.transform(close, lambda x: x["g"]))).alias("other"))
    links = materialized(links.distinct().select(F.col("g").alias("a"), F.col("other").alias("b")))
    return _rooted(groups.select("fp", "g"), "g", links, "root").select("fp", "root")


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fp``, ``fingerprint`` and ``component_id`` of every row of ``docs``.

    The fingerprint has a bit set if over half of the XXH64 values of the text's shingles have it, after lower-casing A to Z;
    a text of fewer words is one shingle, and null texts and texts without words have the fingerprint zero, linked like
    any other. Fingerprints link if they differ in at most ``distance`` bits; ``component_id`` is the smallest doc_id that
    links reach, null only where no row of the component has a key. Repeated rows each have their row in the result; an
    empty table gives an empty one; other columns of ``docs`` are not read.
    """
    found = materialized(fingerprints(docs, words))
    classes = materialized(found.groupBy("fp").agg(F.min("doc_id").alias("low")))
    rooted = linked_fingerprints(classes, distance).join(shuffled(classes), "fp")
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    placed = materialized(rooted.select("fp", "root").join(shuffled(lows), "root").select("fp", "component_id"))
    return found.join(shuffled(placed), "fp").select("doc_id", "fp", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")

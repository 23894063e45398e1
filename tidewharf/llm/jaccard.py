"""N-gram Jaccard join with a token-group matrix.

Texts with the same shingle set form one class. Classes are partitioned into groups of similar ones; a group
stands for its token union. A class is compared with another group only if the group's tokens leave room for
the overlap a link needs, so members of a group never meet each other in pairs, however large it is.

All comparisons are exact on 64-bit shingle hashes. Tokens are ordered from rare to frequent; two sets that
overlap enough share some of the first tokens of both ("prefix"), so only those are kept in the matrix. If
sets of a and b tokens must have o in common, then the first a - o + m tokens of the one and b - o + m of the
other have at least m in common; m is an eighth of the tokens here, which rules out most sets that merely
share a passage. Of its first m tokens, a set has those for itself alone that no other prefix holds, so they
cannot be in an overlap; if they are too many, nothing can link with the set. The larger set of a pair asks and the smaller one is asked: as o is larger for partners that
are not smaller, a set has a shorter prefix in the matrix than as a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewharf.functions.scratch import materialized, shuffled, temporary
from tidewharf.llm.text import WHITE, Texts, mix, slices, unused, window_hashes

FREQUENCY_BUCKETS = 1 << 18
FILTER_BITS = 1 << 24
MARGIN = 8
MEMBERS = 256
QUERIES = 512
NO_TOKEN = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(part: pa.RecordBatch, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle, one without words none."""
    found = Texts.of(part.column("text"), fold=True).words(WHITE)
    h = found.hashes()
    shingles, at = window_hashes(h, found.owner, words)
    cut = np.searchsorted(at, found.first)
    for i, (a, b) in enumerate(zip(found.first[:-1], found.first[1:])):
        if b - a >= words:
            yield np.unique(shingles[cut[i] : cut[i + 1]])
        elif b > a:
            yield mix(np.array([np.bitwise_xor.reduce(mix(h[a:b] + np.arange(b - a, dtype=np.uint64))) ^ NO_TOKEN]))
        else:
            yield h[:0]


def least_overlap(a: int, b: int, percent: int) -> int:
    """The smallest intersection of sets of sizes ``a`` and ``b`` that makes a link."""
    return -(-percent * (a + b) // (100 + percent))


def margin(n: int) -> int:
    """Prefix tokens that linked sets have in common at least, by the smaller one's size."""
    return max(n // MARGIN, 1)


def prefix_length(n: int, percent: int) -> int:
    """Of a query, whose partners may be smaller."""
    return n - -(-percent * n // 100) + margin(n)


def asked_length(n: int, percent: int) -> int:
    """Of a set in the matrix, whose partners are not smaller."""
    return n - least_overlap(n, n, percent) + margin(n)


def needed(n: Column, percent: int) -> Column:
    """``margin`` of the smallest set that a set of ``n`` tokens can link with."""
    return F.greatest(F.floor(F.ceil(n * percent / 100) / MARGIN), F.lit(1))


def _frequencies(words: int):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FREQUENCY_BUCKETS, np.int64)
        for part in slices(batches):
            found = Texts.of(part.column("text"), fold=True).words(WHITE)
            shingles, _ = window_hashes(found.hashes(), found.owner, words)
            total += np.bincount((shingles >> np.uint64(46)).astype(np.int64), minlength=FREQUENCY_BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": at, "n": total[at]})

    return counted


def frequencies(docs: DataFrame, words: int) -> np.ndarray:
    """Shingles of all texts, counted in a fixed number of buckets by their leading bits."""
    rows = (
        docs.select("text").mapInArrow(_frequencies(words), "bucket long, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    )
    total = np.zeros(FREQUENCY_BUCKETS, np.int64)
    total[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return total


def _signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(_signed(flat)))


def _classes(words: int, percent: int, frequency):
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = frequency.value
        for part in slices(batches):
            n, sig, prefix, asked = [], [], [], []
            for tokens in shingle_sets(part, words):
                n.append(len(tokens))
                sig.append(xxhash.xxh3_128_digest(tokens))
                count = order[(tokens >> np.uint64(46)).astype(np.int64)]
                first = np.argsort(count, kind="stable")[: prefix_length(len(tokens), percent)]
                prefix.append(tokens[first] if len(tokens) else tokens)
                asked.append(asked_length(len(tokens), percent))
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"), "row": part.column("row"), "n": pa.array(n, pa.int64()),
                "sig": pa.array(sig, pa.binary()), "prefix": _lists(prefix), "asked": pa.array(asked, pa.int64()),
            })

    return summed


def _members(words: int, wanted):
    """Whole sets of the rows whose key may be wanted; the filter has false positives, which a join removes."""
    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(np.frombuffer(wanted.value, np.uint8))
        for batch in batches:
            keep = flags[batch.column("slot").to_numpy()].astype(bool)
            for part in slices(iter([batch.filter(pa.array(keep))])):
                sets = list(shingle_sets(part, words))
                lows = [[_signed(mix(s ^ NO_TOKEN * np.uint64(k))).min() for k in (1, 2)] if len(s) else [0, 0] for s in sets]
                yield pa.RecordBatch.from_pydict({
                    "row": part.column("row"), "low_1": pa.array([x for x, _ in lows], pa.int64()),
                    "low_2": pa.array([x for _, x in lows], pa.int64()), "tokens": _lists(sets),
                })

    return told


def _leaders(by: str, percent: int):
    """Links each class to the first class before it, of those with the same ``by``, that it is similar to.

    Rows arrive ordered by ``by``. After MEMBERS classes a new block of leaders begins.
    """
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, met, leaders = None, 0, []
        for batch in batches:
            tokens = batch.column("tokens")
            values, ends = tokens.values.to_numpy(), tokens.offsets.to_numpy()
            out = []
            for i, (c, k) in enumerate(zip(batch.column("c").to_pylist(), batch.column(by).to_pylist())):
                own = values[ends[i] : ends[i + 1]]
                if k != key or met >= MEMBERS:
                    key, met, leaders = k, 0, []
                met += 1
                for leader, other in leaders:
                    need = least_overlap(len(own), len(other), percent)
                    if need <= min(len(own), len(other)):
                        both = np.intersect1d(own, other, assume_unique=True)
                        if len(both) >= need:
                            out.append(leader)
                            break
                else:
                    leaders.append((c, own.copy()))
                    out.append(c)
            yield pa.RecordBatch.from_pydict({"c": batch.column("c"), "leader": pa.array(out, pa.int64())})

    return linked


def _opened(percent: int):
    """Links of the queries of one block: one for each component among its members, as those are linked already."""
    schema = pa.schema([("c", pa.int64()), ("other", pa.int64())])

    def linked(left: pa.Table, right: pa.Table) -> pa.Table:
        out_c, out_other = [], []
        if left.num_rows and right.num_rows:
            member, query = left.combine_chunks(), right.combine_chunks()
            lists = member["tokens"].chunk(0)
            values = lists.flatten().to_numpy()
            size = lists.value_lengths().to_numpy()
            order = np.argsort(values, kind="stable")
            union, owner = values[order], np.repeat(np.arange(len(size)), size)[order]
            names, parts = member["c"].to_numpy(), member["g"].to_numpy()
            asked = query["tokens"].chunk(0)
            flat, ends = asked.flatten().to_numpy(), np.concatenate(([0], np.cumsum(asked.value_lengths().to_numpy())))
            for c, g, a, b in zip(query["c"].to_pylist(), query["g"].to_pylist(), ends[:-1], ends[1:]):
                own = flat[a:b]
                low = np.searchsorted(union, own, side="left")
                times = np.searchsorted(union, own, side="right") - low
                if np.count_nonzero(times) < max(least_overlap(len(own), int(size.min()), percent), -(-percent * len(own) // 100)):
                    continue  # the token union leaves no room for a link
                at = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
                both = np.bincount(owner[at], minlength=len(size))
                hit = np.flatnonzero(((100 + percent) * both >= percent * (len(own) + size)) & (parts != g))
                _, first = np.unique(parts[hit], return_index=True)
                out_c += [c] * len(first)
                out_other += names[hit[first]].tolist()
        return pa.Table.from_pydict({"c": out_c, "other": out_other}, schema=schema)

    return linked


def components(links: DataFrame) -> DataFrame:
    """``(v, root)`` of the vertices of ``links(a, b)``: labels sink to the smallest vertex, jumping over pointers."""
    edges = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = materialized(edges)
    labels = materialized(edges.select(F.col("a").alias("v")).distinct().withColumn("root", F.col("v")))
    while True:
        reached = edges.join(shuffled(labels.withColumnRenamed("v", "b")), "b")
        near = reached.groupBy(F.col("a").alias("v")).agg(F.min("root").alias("low"))
        sunk = labels.join(shuffled(near), "v").select("v", F.col("root").alias("was"), F.least("root", "low").alias("to"))
        onward = sunk.select(F.col("v").alias("to"), F.col("to").alias("next"))
        fresh = materialized(sunk.join(shuffled(onward), "to").select("v", "was", F.least("to", "next").alias("root")))
        labels = fresh.select("v", "root")
        if not fresh.where(F.col("was") != F.col("root")).limit(1).count():
            return labels


def link_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``class_id``, ``n_links`` and ``component_id`` of every row of ``docs``.

    A text's set holds its distinct shingles of ``words`` words after lower-casing A to Z; a shorter text is
    one shingle. Texts link if 100 x intersection >= ``percent`` x union. ``component_id`` is the smallest
    doc_id reachable by links, ``class_id`` tells apart different sets, and ``n_links`` counts the links
    found from a class to others that the components rest on. Null texts and texts without words have no
    shingles and link with nothing. Repeated rows fall in one class. Null keys are never the smallest.
    """
    with temporary(docs.sparkSession) as made:
        return made.keep(materialized(_linked(docs, words, percent).select(
            "doc_id", F.col("n").alias("n_shingles"), F.col("c").alias("class_id"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("doc_id")).alias("component_id"),
        )))


def one_per_group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest key, null last.

    Texts without words link with nothing and all stay. Of rows repeated in key and text one stays.
    """
    with temporary(docs.sparkSession) as made:
        leaves, repeated = _surplus(docs, words, percent)
        made.keep(leaves, repeated)
    own = unused(docs.columns, "_row")
    keyed = docs.withColumn(own, row_key())
    rest = keyed.join(leaves.select(F.col("leaves").alias(own)), own, "left_anti")
    again = keyed.join(repeated.select(F.col("repeated").alias(own)), own, "left_semi").dropDuplicates([own])
    return rest.unionByName(again).select(*docs.columns)


def _surplus(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Keys of the rows that are not the first of their component, and of first rows that are repeated."""
    found = materialized(_linked(docs, words, percent).where("n > 0").select("doc_id", "row", "root"))
    kinds = found.groupBy("root", "row").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("times"))
    kinds = materialized(kinds)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    # stored, so that the join with a root's many kinds can be split
    first = materialized(kinds.groupBy("root").agg(F.min(order).alias("first")).select("root", F.col("first.row").alias("first")))
    marked = kinds.join(first, "root").withColumn("stays", F.col("row") == F.col("first"))
    leaves = materialized(marked.where("not stays or times > 1").select(F.col("row").alias("leaves")))
    repeated = materialized(marked.where("stays and times > 1").select(F.col("row").alias("repeated")))
    return leaves, repeated


def row_key() -> Column:
    """Equal for rows with the same key and text."""
    return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("#")), F.lit(":"), F.hex(F.xxhash64("text")))


def _linked(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id``, ``row``, ``n``, ``c``, ``n_links``, ``root`` and ``low`` of every row of ``docs``."""
    context = docs.sparkSession.sparkContext
    rows = docs.select("doc_id", "text", row_key().alias("row"))
    key_type = docs.schema["doc_id"].dataType.simpleString()

    frequency = context.broadcast(frequencies(docs, words))
    sets = materialized(rows.mapInArrow(
        _classes(words, percent, frequency), f"doc_id {key_type}, row string, n long, sig binary, prefix array<long>, asked long"
    ))
    classes = materialized(
        sets.where("n > 0").groupBy("sig")
        .agg(F.min("doc_id").alias("low_doc"), F.min("row").alias("row"), F.max("n").alias("n"), F.max("prefix").alias("prefix"),
             F.max("asked").alias("asked"))
        .withColumn("c", F.monotonically_increasing_id())
    )
    by_token = Window.partitionBy("t")
    ranked = classes.select(F.posexplode("prefix").alias("place", "t"), "c", "n", "asked")
    held = F.col("place") < F.col("asked")  # in the matrix, not only in the query
    n, enough = F.col("n"), needed(F.col("n"), percent)
    shared = materialized(
        ranked.withColumn("held", held).withColumn("others", F.count(F.lit(1)).over(by_token) - 1)
        .withColumn("holders", F.count(F.when(held, 1)).over(by_token) - held.cast("int"))
        .withColumn("asks", F.col("holders") > 0).withColumn("leads", F.col("place") < enough)
        .where("others > 0 and (held or asks or leads)").select("t", "c", "n", "place", "held", "asks", "leads")
    )
    # what is left of a set without the first tokens that are its own bounds every overlap, and so a partner's size
    rest = n - enough + F.col("leads")
    met = shared.groupBy("c", "n").agg(*[F.count_if(x).alias(x) for x in ("held", "asks", "leads")]).select(
        "c", "n", ((F.col("held") >= enough) & (rest >= F.ceil(2 * percent * n / (100 + percent)))).alias("holds"),
        F.when(F.col("asks") >= enough, F.floor((100 + percent) * rest / percent) - n).otherwise(0).alias("room"),
    ).where(F.col("holds") | (100 * F.col("room") >= percent * n))
    active = materialized(met.join(classes.select("c", "row"), "c"))

    slot = F.pmod(F.xxhash64("row"), F.lit(FILTER_BITS)).cast("int")
    wanted = context.broadcast(_bits(active.select(slot.alias("slot"))))
    whole = rows.select("row", "text", slot.alias("slot")).mapInArrow(
        _members(words, wanted), "row string, low_1 long, low_2 long, tokens array<long>"
    ).dropDuplicates(["row"])  # a class enters once, however often its row is repeated
    members = materialized(active.join(whole, "row").drop("row"))

    groups = _groups(members, percent)
    links = _cross_links(shared, groups, members, percent)
    roots = components(links.select(F.col("g").alias("a"), F.col("other_g").alias("b")))
    placed = (
        classes.select("c", "sig", "low_doc").join(groups.select("c", "g"), "c", "left")
        .join(roots.select(F.col("v").alias("g"), "root"), "g", "left")
        .select("c", "sig", "low_doc", F.coalesce("root", "g", "c").alias("root"))
    )
    lows = placed.groupBy("root").agg(F.min("low_doc").alias("low"))
    degree = links.groupBy("c").agg(F.count(F.lit(1)).alias("n_links"))
    found = placed.join(lows, "root").join(degree, "c", "left").select("sig", "c", "n_links", "root", "low")
    return sets.select("doc_id", "row", "n", "sig").join(found, "sig", "left").drop("sig")


def _bits(slots: DataFrame) -> bytes:
    """The slots as a bit set of ``FILTER_BITS``, gathered in pieces of fixed size."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            flags[batch.column("slot").to_numpy()] = True
        words = np.packbits(flags).view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_pydict({"at": at, "bits": words[at]})

    got = slots.mapInArrow(packed, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[got["at"].to_numpy()] = got["bits"].to_numpy()
    return out.tobytes()


def _groups(members: DataFrame, percent: int) -> DataFrame:
    """``(c, g, k, alone, part, n, holds, room)``: for every class its component so far and its group's block.

    Two rounds of leaders, each over classes ordered by another minimum hash, link classes to ``g``. A group
    ``k`` holds components that are similar: a component takes the smallest name of those with which one of its
    classes shares a minimum hash, in two steps, so that copies edited in many places still fall into the group of
    the others and not into one each. It is cut in blocks of about MEMBERS classes. A component larger than that has
    blocks ``alone``, named by it; others share blocks, where ``alone`` is -1. Rounds and groups only save work: links
    they miss are found by the matrix.
    """
    def led(rows: DataFrame, by: str, then: str) -> DataFrame:
        ordered = rows.repartitionByRange(by, then, "c").sortWithinPartitions(by, then, "c")
        return materialized(ordered.select("c", by, "tokens").mapInArrow(_leaders(by, percent), "c long, leader long"))

    first = led(members, "low_1", "low_2")
    heads = first.where("c = leader").select("c")
    second = led(members.join(heads, "c"), "low_2", "low_1")
    joined = first.join(second.select(F.col("c").alias("leader"), F.col("leader").alias("g")), "leader").select("c", "g")
    joined = materialized(joined.join(members.select("c", "n", "holds", "room", "low_1", "low_2"), "c"))
    names = joined.groupBy("g").agg(F.min("low_1").alias("k"))
    for low in ("low_2", "low_1"):
        named = materialized(joined.select("g", low).distinct().join(names, "g"))
        shared = materialized(named.groupBy(low).agg(F.min("k").alias("k")))
        names = materialized(named.select("g", low).join(shared, low).groupBy("g").agg(F.min("k").alias("k")))
    parts = materialized(joined.groupBy("g").agg(F.count(F.lit(1)).alias("size")).join(names, "g"))
    sizes = parts.where(F.col("size") <= MEMBERS).groupBy("k").agg(F.sum("size").alias("whole"))
    large = F.col("size") > MEMBERS
    part = F.when(large, F.pmod(F.xxhash64("c"), F.ceil(F.col("size") / MEMBERS))).otherwise(
        F.pmod(F.xxhash64("g"), F.ceil(F.col("whole") / MEMBERS))
    )
    return materialized(
        joined.join(parts.join(sizes, "k", "left"), "g")
        .select("c", "g", "k", F.when(large, F.col("g")).otherwise(-1).alias("alone"), part.alias("part"), "n", "holds", "room")
    )


def _cross_links(shared: DataFrame, groups: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """``(c, g, other, other_g)``: links between components, one for each class and component of a block at most.

    Of two classes, the larger one is the query. A block, its own too, is opened for a query that has one of
    its first tokens, early enough to leave room for the overlap. The shortest prefixes suffice here.
    """
    block, by_token, n = ["k", "alone", "part"], Window.partitionBy("t"), F.col("n")
    held = F.col("held") & F.col("holds") & (F.col("place") <= n - F.ceil(2 * percent * n / (100 + percent)))
    asks = F.col("asks") & (F.col("room") > 0) & (F.col("place") <= n - F.ceil(percent * n / 100))
    placed = shared.select("t", "c", "place", "held", "asks").join(groups, "c")
    placed = placed.withColumn("held", held).withColumn("asks", asks).where("held or asks")
    several = materialized(
        placed.withColumn("from", F.min("g").over(by_token)).withColumn("to", F.max("g").over(by_token))
        .where(F.col("from") != F.col("to")).drop("from", "to")
    )
    bounds = groups.where("holds").groupBy(block).agg(F.min("n").alias("least"), F.max("n").alias("most"))
    matrix = several.where("held").select("t", *block).distinct().join(bounds, block)
    least = F.greatest("least", F.ceil(n * percent / 100))
    overlap = F.ceil(percent * (n + least) / (100 + percent))
    queries = materialized(
        several.where("asks").select("t", "c", "g", "n", "room", "place").join(matrix, "t")
        .where((F.col("g") != F.col("alone")) & (F.col("least") <= F.least(n, "room")) & (percent * n <= 100 * F.col("most")))
        .where(n - F.col("place") >= overlap).select("c", "g", *block).distinct()
    )
    count = queries.groupBy(block).agg(F.count(F.lit(1)).alias("asked"))
    chunk = F.pmod(F.xxhash64("c"), F.ceil(F.col("asked") / QUERIES))
    queries = materialized(queries.join(count, block).withColumn("chunk", chunk).drop("asked"))
    slots = queries.select(*block, "chunk").distinct()
    tokens, keys = members.select("c", "tokens"), [*block, "chunk"]
    left = groups.select("c", "g", *block).join(slots, block).join(tokens, "c")
    right = queries.join(tokens, "c").select(*[F.col(x).alias(x) for x in (*keys, "c", "g", "tokens")])
    hits = left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(_opened(percent), "c long, other long")
    return materialized(
        hits.join(groups.select("c", "g"), "c")
        .join(groups.select(F.col("c").alias("other"), F.col("g").alias("other_g")), "other")
    )

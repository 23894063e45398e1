import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewharf.llm import contamination, jaccard

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame([(i, text, "en", "s", len(text or "")) for i, text in rows], DOCS)


def shingles(text, n):
    words = WORD.findall((text or "").translate(FOLD))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def linked(rows, n, percent):
    """The smallest reachable key of every row, by place."""
    sets = [shingles(text, n) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        for j, both in Counter(j for t in own for j in holders[t]).items():
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                root[find(i)] = find(j)
        for t in own:
            holders[t].append(i)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[find(i)] = min(low.get(find(i), key), key)
    return [(key, len(s), low.get(find(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets))]


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


def corpus(seed):
    """Copies, chains of near copies, a shared passage, short and odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    rows, key = [], 0
    for _ in range(12):
        words = rng.choices(vocabulary, k=rng.randrange(20, 200))
        for _ in range(rng.randrange(1, 12)):
            rows.append((key, " ".join(words)))
            words = edited(rng, words, rng.choice([0, 1, 1, 2, 6]))
            key += 1
    for _ in range(40):
        rows.append((key, " ".join(passage + rng.choices(vocabulary, k=rng.randrange(5, 80)))))
        key += 1
    base = rng.choices(vocabulary, k=120)
    for _ in range(150):  # one large group of near copies
        rows.append((key, " ".join(edited(rng, base, rng.randrange(0, 4)))))
        key += 1
    rows += [(key, "one two three"), (key + 1, "One TWO  three"), (key + 2, "one two"), (key + 3, ""), (key + 4, None),
             (key + 5, " \n "), (key + 6, "x " * 30_000), (key + 6, "x " * 30_000), (None, "one two three"), (None, None),
             (None, "alone in the world tonight here")]
    return rows


@pytest.mark.parametrize("seed,n,percent", [(1, 4, 85), (2, 5, 80), (3, 3, 60)])
def test_components_as_brute_force(spark, seed, n, percent):
    rows = corpus(seed)
    random.Random(seed).shuffle(rows)
    found = jaccard.link_components(frame(spark, rows), n, percent).collect()
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found)
    assert got == Counter(linked(rows, n, percent))


def test_large_group_is_split(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MEMBERS", 8)
    monkeypatch.setattr(jaccard, "QUERIES", 4)
    rows = corpus(5)
    found = jaccard.link_components(frame(spark, rows), 4, 85).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == Counter(linked(rows, 4, 85))


def test_repeated_rows_with_a_near_copy_stay_once_each(spark):
    rng = random.Random(6)
    first, second = ([f"{x}{i}" for i in range(80)] for x in "ab")
    rows = [(1, " ".join(first))] * 3 + [(2, " ".join(edited(rng, first, 1)))]
    rows += [(None, " ".join(second))] * 2 + [(9, " ".join(edited(rng, second, 1)))]
    found = jaccard.link_components(frame(spark, rows), 4, 85).collect()
    want = linked(rows, 4, 85)
    assert {low for _, _, low in want} == {1, 9}
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == Counter(want)


def test_one_of_each_group_stays(spark):
    rows = corpus(4)
    docs = frame(spark, rows).withColumn("_row", F.lit("clash")).withColumn("score", F.lit(1))
    left = jaccard.one_per_group(docs)
    assert left.columns == docs.columns
    want = Counter({(key, text) for (key, text), (_, n, low) in zip(rows, linked(rows, 5, 80)) if n and key == low})
    want += Counter((key, text) for (key, text), (_, n, _) in zip(rows, linked(rows, 5, 80)) if not n)
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == want


def test_no_rows(spark):
    none = frame(spark, [])
    assert jaccard.link_components(none).count() == 0 and jaccard.one_per_group(none).count() == 0
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert contamination.contamination(none, items).count() == 0


def test_least_overlap_and_prefix():
    for percent in (50, 80, 85, 100):
        for a in range(1, 60):
            for b in range(1, 60):
                need = next((o for o in range(min(a, b) + 1) if 100 * o >= percent * (a + b - o)), None)
                assert jaccard.least_overlap(a, b, percent) == need or need is None and jaccard.least_overlap(a, b, percent) > min(a, b)


def contaminated(rows, items):
    wins = defaultdict(set)
    for key, text in items:
        words = ALNUM.findall((text or "").translate(FOLD))
        for i in range(max(len(words) - 12, 1) if words else 0):
            wins[tuple(words[i : i + 13])].add(str(key))
    out = []
    for key, text in rows:
        words = ALNUM.findall((text or "").translate(FOLD))
        hit, named = set(), set()
        for n in {len(w) for w in wins}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in wins:
                    hit.update(range(i, i + n))
                    named |= wins[tuple(words[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((key, len(words), len(hit), len(named), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return out


def benchmark_case():
    rng = random.Random(9)
    vocabulary = [f"b{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(13, 30)))) for i in range(30)]
    items += [(10, "Short ITEM"), (100, "the"), (101, None), (102, " -- "), (103, items[0][1]), (104, "é ü rare")]
    rows = []
    for key in range(80):
        words = rng.choices([*vocabulary, "other", "the-short", "item."], k=rng.randrange(0, 300))
        if key % 3 == 0:
            at = rng.randrange(len(words) + 1)
            part = items[rng.randrange(30)][1].split()
            words[at:at] = part[: rng.randrange(8, len(part) + 1)]
        rows.append((key, ", ".join(words)))
    rows += [(200, None), (201, ""), (202, "the " * 30_000), (203, "THE short item"), (203, "THE short item"), (None, "É ü rare; é ü Rare")]
    return rows, items


def test_contamination_as_brute_force(spark):
    rows, items = benchmark_case()
    docs = frame(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = Counter(tuple(r) for r in contamination.contamination(docs, bench).collect())
    want = Counter(contaminated(rows, items))
    assert found == want
    left = contamination.without_contaminated(docs.withColumn("_t", F.lit(0)), bench)
    assert left.columns == [*docs.columns, "_t"]
    assert left.count() == sum(n for row, n in want.items() if not row[-1])


def test_contamination_of_repeated_rows(spark):
    passage = " ".join(f"p{i}" for i in range(15))
    rows = [(1, f"before {passage} after")] * 3 + [(None, f"{passage} behind")] * 2 + [(2, passage), (3, "before after behind")]
    items = [(7, passage)]
    docs, bench = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    want = Counter(contaminated(rows, items))
    assert sum(n for row, n in want.items() if row[-1]) == 6
    assert Counter(tuple(r) for r in contamination.contamination(docs, bench).collect()) == want
    assert [r["doc_id"] for r in contamination.without_contaminated(docs, bench).collect()] == [3]


def test_contamination_without_items(spark):
    rows, _ = benchmark_case()
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] or r["n_hit"] for r in contamination.contamination(frame(spark, rows), none).collect())


def test_phrases_and_proximity(spark):
    docs = frame(spark, [(1, "zero alpha beta gamma delta one"), (2, "alpha beta x gamma delta"), (3, "delta gamma beta alpha"), (4, "alpha")])
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    index = contamination.build_index(docs)
    wins, _ = contamination.windows(items)
    key = {r["t"]: r["doc_id"] for r in index.texts.collect()}
    assert [(key[r["t"]], r["start"], r["size"]) for r in contamination.phrase_matches(index, wins).collect()] == [(1, 1, 4)]
    near = {key[r["t"]] for r in contamination.proximity_matches(index, wins, slop=2).collect()}
    assert {1, 2} <= near and 4 not in near


def test_proximity_passes_over_absent_terms(spark):
    words = [f"p{i}" for i in range(13)]
    index = contamination.build_index(frame(spark, [(1, " ".join([*words[:6], "edited", *words[7:]])), (2, "p0 p1")]))
    wins, _ = contamination.windows(spark.createDataFrame([(1, " ".join(words))], "item_id long, text string"))
    assert contamination.phrase_matches(index, wins).count() == 0
    near = contamination.proximity_matches(index, wins).join(index.texts, "t").collect()
    assert near and {(r["doc_id"], r["n_near"]) for r in near} == {(1, 3)}

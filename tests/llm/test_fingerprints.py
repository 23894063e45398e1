"""SimHash links, fill-in-the-middle cuts and phrase collocations against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewharf.llm import collocations, fim, jaccard, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [(900, None), (901, ""), (902, " \n\t"), (903, "one"), (904, "One  TWO three"), (905, "ünï İ çode ßtraße two words \x0b here"),
       (906, "a,b.c;d"), (None, None), (None, "a text without key"), (907, "same row twice"), (907, "same row twice"), (908, "x y " * 20_000)]


def frame(spark, rows, lang="en"):
    return spark.createDataFrame([(i, text, lang, "s", len(text or "")) for i, text in rows], DOCS)


# ---- SimHash


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(FOLD))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(values, distance):
    """The component of each place, by comparing every pair."""
    values = np.array(values, np.uint64)
    root = np.arange(len(values))
    while True:
        low = np.array([root[np.bitwise_count(values ^ v) <= distance].min() for v in values])
        if (low == root).all():
            return root
        root = low[low]


def test_fingerprints_and_components_equal_brute_force(spark):
    rng = random.Random(3)
    rows, key = list(ODD), 0
    for _ in range(25):
        words = [f"V{rng.randrange(500)}" for _ in range(rng.randrange(3, 400))]
        for _ in range(rng.randrange(1, 8)):
            rows.append((key, rng.choice([" ", "  ", "\n"]).join(words)))
            words = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 30])):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
            key += 1
    rows = [(key if key is None else key + 7, text) for key, text in rows]
    values = [plain_fingerprint(text) for _, text in rows]
    root, low = roots(values, 4), {}
    for r, (key, _) in zip(root, rows):
        if key is not None:
            low[r] = min(low.get(r, key), key)
    expected = Counter((key, f"{v:016x}", low.get(r)) for (key, _), v, r in zip(rows, values, root))
    docs = frame(spark, rows).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(1))
    found = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")
    assert Counter(map(tuple, found.collect())) == expected
    assert len(set(low.values())) < len(set(values)) < len(rows)


def clusters(rng):
    """Random values, chains of steps of 1 to 6 bits, and a dense cluster of near copies."""
    values = [rng.getrandbits(64) for _ in range(300)]
    for _ in range(60):
        v = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 6)):
            values.append(v)
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                v ^= 1 << b
    centre = rng.getrandbits(64)
    soft = rng.sample(range(64), 24)
    for _ in range(1500):
        values.append(centre ^ sum(1 << b for b in rng.sample(soft, rng.randrange(0, 9))))
    for step in (5, 9):  # small groups beside the dense one
        for _ in range(40):
            values.append(centre ^ sum(1 << b for b in rng.sample(soft, 3)) ^ sum(1 << b for b in rng.sample(range(64), step)))
    return sorted({*values, 0, (1 << 64) - 1})


@pytest.mark.parametrize("m", [None, 2, 4])
def test_no_link_is_lost_whatever_the_segments(spark, m, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 64)
    monkeypatch.setattr(simhash, "PIECE", 16)
    values = clusters(random.Random(7))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.linked_fingerprints(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, m).collect()
    groups = defaultdict(set)
    for fp, root in found:
        groups[root].add(fp)
    expected = defaultdict(set)
    for v, r in zip(signed, roots(values, 4)):
        expected[r].add(v)
    assert {frozenset(x) for x in groups.values()} == {frozenset(x) for x in expected.values()}


def test_tables_find_links_that_sorting_misses(spark, monkeypatch):
    """With blocks of one fingerprint nothing is linked before the tables are asked."""
    monkeypatch.setattr(simhash, "BLOCK", 1)
    rng = random.Random(1)
    pairs = [(v, v ^ sum(1 << b for b in rng.sample(range(64), n))) for n in (1, 2, 3, 4, 5) for v in [rng.getrandbits(64) for _ in range(30)]]
    signed = [v - (1 << 64) if v >> 63 else v for pair in pairs for v in pair]
    found = dict(map(tuple, simhash.linked_fingerprints(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()))
    linked = [found[a] == found[b] for a, b in zip(signed[::2], signed[1::2])]
    assert linked == [True] * 120 + [False] * 30


def test_segments_satisfy_the_pigeonhole():
    for m in (2, 3, 4):
        parts = simhash.segments(m, 4)
        assert sum(width for _, width, _ in parts) == 64 and sum(radius + 1 for _, _, radius in parts) > 4
    assert len(simhash.ball(21, 2)) == len(set(simhash.ball(21, 2))) == 1 + 21 + 210
    assert simhash.best_segments(10**4, 4) >= simhash.best_segments(10**7, 4) > simhash.best_segments(10**11, 4)


def test_no_table_of_fingerprints_is_gathered_in_the_driver(spark, monkeypatch):
    """An exploded table is far larger than Spark takes it for, so no join may be left to its threshold."""
    plans = []

    def seen(df, store=simhash.materialized):
        df.collect()  # the plan of this run is final
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df)

    monkeypatch.setattr(simhash, "materialized", seen)
    monkeypatch.setattr(jaccard, "materialized", seen)
    monkeypatch.setattr(simhash, "BLOCK", 2)
    rows = [(i, " ".join(f"w{k}" for k in range(i // 4, i // 4 + 40)) + f" z{i}") for i in range(40)]
    found = simhash.near_duplicates(frame(spark, rows))
    assert found.count() == 40
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in x for x in plans) >= 6 and not any("Broadcast" in x for x in plans)


def test_empty_table_has_no_fingerprints(spark):
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


# ---- fill in the middle


def plain_cut(key, text):
    text = text or ""
    n, digest = len(text), hashlib.sha256(b"1:" + (b"" if key is None else str(key).encode())).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return key, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return key, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return key, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(5)
    alphabets = ["abc ", "é中\U0001f600", "<PSM>", "á\n"]
    rows = [(i, "".join(rng.choices(rng.choice(alphabets) + "x", k=rng.randrange(0, 60)))) for i in range(400)]
    mixed = "".join(rng.choices("ab" * 9 + "é中", k=150_000))
    return rows + ODD + [(500, mixed), (501, "\U0001f600" * 70_000), (502, "<P>"), (503, "<S>" * 3), (504, "x" * 140_000)]


def test_cuts_equal_slices_of_code_points_and_can_be_undone(spark):
    rows = texts()
    docs = frame(spark, rows).withColumn("n", F.lit("clash"))
    cut = fim.transform(docs, "doc_id", "n", "lang").withColumn("back", fim.restored(F.col("output"), F.col("form")))
    assert cut.columns == ["doc_id", "lang", *fim.RESULTS, "back"]
    got = Counter(tuple(x) for x in cut.select("doc_id", "n", "form", "prefix_units", "middle_units", "output").collect())
    assert got == Counter(plain_cut(*row) for row in rows)
    assert Counter(x[0] for x in cut.select("back").collect()) == Counter(text or "" for _, text in rows)
    assert {x[2] for x in got} == {"plain", "psm", "spm"}
    assert fim.transform(frame(spark, []), "doc_id").collect() == []


@pytest.mark.parametrize("unit, pattern", [("word", r"[^ \t-\r]+"), ("line", r"[^\n]*\n|[^\n]+$")])
def test_cuts_between_words_and_lines(spark, unit, pattern):
    rows = [(i, "\n".join(" ".join(f"w{i}{j}é" for j in range(i % 7)) for i in range(n))) for n, i in enumerate(range(40))]
    cut = fim.transform(frame(spark, rows), "doc_id", unit=unit, plain_percent=0, spm_percent=50)
    whole = dict(rows)
    for row in cut.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect():
        text = whole[row["doc_id"]]
        starts = [m.start() for m in re.finditer(pattern, text)] + [len(text)]
        assert row["n"] == len(starts) - 1 and row["back"] == text
        if row["form"] == "psm":
            a, b = row["prefix_units"], row["prefix_units"] + row["middle_units"]
            assert row["output"] == f"<P>{text[:starts[a]]}<S>{text[starts[b]:]}<M>{text[starts[a]:starts[b]]}"


@pytest.mark.parametrize("share, kind", [(0.001, fim.ArrayContainer), (0.5, fim.BitmapContainer), (1.0, fim.RunContainer)])
def test_containers_select_every_member(share, kind):
    flags = np.random.default_rng(0).random(fim.SPAN) < share
    assert isinstance(fim.container(flags), kind)
    several = np.concatenate((flags, np.zeros(fim.SPAN, bool), flags[:1000], np.ones(7, bool)))
    found, places = fim.Boundaries(several), np.flatnonzero(several)
    assert len(found) == len(places)
    for k in {0, len(places) - 1, *random.Random(2).choices(range(len(places)), k=300)}:
        assert found.select(k) == places[k]


# ---- collocations


def plain_collocations(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(FOLD)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3, 4):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        many = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in many.items():
            inside = (q for q in many if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * many[q] >= 80 * a for q in inside):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return out


def phrases(seed):
    rng = random.Random(seed)
    fixed = [["New", "York", "city"], ["à", "la", "carte"], ["the", "quick", "brown", "fox"], ["ha", "ha", "ha", "ha", "ha", "ha"], ["x y", "z"]]
    rows = []
    for _ in range(300):
        out = []
        for _ in range(rng.randrange(0, 40)):
            out += rng.choice(fixed) if rng.random() < 0.3 else [rng.choice("abcdefghij") * rng.randrange(1, 3)]
            if rng.random() < 0.2:
                out[-1] += rng.choice(".,;:!?\n\r\x0b\x0c")
        rows.append((rng.choice(["en", "fr", "en", None, ""]), rng.choice([" ", "\t ", "  "]).join(out)))
    return rows + [("en", None), ("fr", ""), ("und", "ha ha ha"), ("de", "kein Satz"), ("fr", "a b " * 30_000), ("fr", "a b\n" * 9)] + [("es", "uno dos tres")] * 7


@pytest.mark.parametrize("mask", [(1 << 64) - 1, 0x3F])
def test_collocations_equal_brute_force(spark, mask):
    """With fingerprints of six bits nearly all phrases collide, and the texts tell them apart."""
    rows = phrases(11)
    docs = spark.createDataFrame([(i, text, lang, 1, 2) for i, (lang, text) in enumerate(rows)], "doc_id long, text string, lang string, n int, score int")
    found = collocations.collocations(docs.repartition(3), least=5, top=40, mask=mask)
    got = sorted(map(tuple, found.drop("doc_id", "word").collect()))
    assert got == sorted(plain_collocations(rows, 5, 40))
    for row in found.collect():  # the pointer leads to the phrase
        lang, text = rows[row["doc_id"]]
        words = re.findall("[^\x20\x09.,;:!?\x0a-\x0d]+", text.translate(FOLD))
        own = row["phrase"].split(" ")
        assert words[row["word"] : row["word"] + len(own)] == own


def test_collocations_of_nothing(spark):
    docs = frame(spark, [])
    assert collocations.collocations(docs).collect() == []
    assert collocations.collocations(frame(spark, [(1, None), (None, "")])).collect() == []


def test_scores_of_large_counts_are_exact(spark):
    row = spark.range(1).select(F.lit(4 * 10**18).alias("a"), (F.lit(8 * 10**18).cast("decimal(20,0)") + F.lit(1)).alias("wide"))
    assert row.select(F.expr("cast(a as decimal(20,0)) * 2000000 div wide")).first()[0] == 2_000_000 * 4 * 10**18 // (8 * 10**18 + 1)

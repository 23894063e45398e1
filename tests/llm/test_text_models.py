import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewharf.llm import divergence, languages, licenses, quality_model, tokens

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0D]+")
ODD = [
    (1, None, None, None, None), (2, "", "en", None, 0), (3, " \n\t ", "en", "a", 4), (4, "!!! 123 ...", None, "a", 1),
    (5, "x" * 300_000, "en", "b", 1), (6, "the of and the of " * 2000, "en", "b", 1), (6, "the of and the of " * 2000, "en", "b", 1),
    (None, "der die und das nicht", "de", "b", 1), (7, "naïve café \U0001F600 Привет мир", None, "b", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*row, row[0]) for row in ODD], DOCS + ", score long")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_languages_held_out(spark, docs):
    model = languages.train(languages.learned_from(docs))
    found = languages.identify(docs, model, "doc_id", spans=False)
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").where(languages.held_out()).collect()
    assert len(rows) == sum(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in docs.collect())
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_label_spans(spark, docs):
    model = languages.train(docs)
    by = {r["lang"]: r["text"] for r in docs.where("length(text) between 400 and 900").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    text = by["de"] + " " + by["fr"]
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    spans = languages.identify(df, model, "doc_id").first()["spans"]
    n = len(WORD.findall(by["de"]))
    assert [s["lang"] for s in spans][:2] == ["de", "fr"]
    assert abs(spans[0]["n_words"] - n) <= 3 and spans[1]["first_word"] == spans[0]["n_words"]


def test_languages_viterbi_is_the_best_path():
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    scores = rng.normal(0, 3, (12, 3)).astype(np.float32)
    first = np.array([0, 5, 5, 12])
    label = languages.viterbi(scores, first, 2.0)
    for a, b in zip(first[:-1], first[1:]):
        def value(path, part=scores[a:b]):
            return sum(part[i, x] for i, x in enumerate(path)) - 2.0 * sum(x != y for x, y in zip(path, path[1:]))
        best = max(itertools.product(range(3), repeat=int(b - a)), key=value, default=())
        assert value(tuple(label[a:b])) == pytest.approx(value(best), abs=1e-4)


def test_languages_over_128_names(spark):
    names = [f"l{i:03}" for i in range(200)]
    texts = {name: " ".join(f"{chr(97 + i // 26)}{chr(97 + i % 26)}q{x}" for x in "abcdefgh") for i, name in enumerate(names)}
    rows = spark.createDataFrame([(i, texts[name], name) for i, name in enumerate(names)], "doc_id long, text string, lang string")
    found = languages.identify(rows.coalesce(1), languages.train(rows), "doc_id").collect()
    assert {r["doc_id"]: r["lang_pred"] for r in found} == dict(enumerate(names))
    assert all([s["lang"] for s in r["spans"]] == [names[r["doc_id"]]] for r in found)


def test_languages_scripts_narrow(spark):
    rows = [(i, "привет мир это текст", "ru") for i in range(20)] + [(i + 20, "hello world this is text", "en") for i in range(20)]
    model = languages.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    test = spark.createDataFrame([(1, "совершенно другие слова"), (2, "completely other words"), (3, "漢字")], "doc_id long, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in languages.identify(test, model, "doc_id").collect()}
    assert found[1] == "ru" and found[2] == "en" and found[3] in ("en", "ru")


def test_languages_of_many_copies_are_learned(spark):
    rows = [(f"hello world this is text {i % 20}", "en") for i in range(1000)] + [(f"bonjour le monde voici {i}", "fr") for i in range(30)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = languages.train(docs, per_language=20)
    assert model.allowed[languages.SCRIPTS.index("Latin")].all()
    test = spark.createDataFrame([(1, "hello this world"), (2, "voici le monde")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in languages.identify(test, model, "doc_id").collect()} == {1: "en", 2: "fr"}
    once = languages.train(docs.distinct(), per_language=20)
    assert (model.log_p == once.log_p).all()  # copies change neither the choice nor the counts


def test_languages_odd_rows(docs, odd, empty):
    model = languages.train(docs)
    rows = languages.identify(odd, model, "doc_id").collect()
    assert len(rows) == len(ODD)
    by = {r["doc_id"]: r for r in rows}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3, 4))
    assert by[None]["lang_pred"] == "de" and by[6]["lang_pred"] == "en"
    assert languages.identify(empty, model, "doc_id").count() == 0
    unlearned = languages.train(empty)
    assert {r["lang_pred"] for r in languages.identify(odd, unlearned, "doc_id").collect()} == {"und"}


def test_quality_held_out(spark, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality_model.train(docs, quality_model.learnable(labels), "quality")
    rows = (
        quality_model.score(docs, model, "doc_id").join(labels, "doc_id").where(quality_model.held_out()).collect()
    )
    right = sum((r["score"] >= quality_model.CUT) == (r["quality"] == 1) for r in rows)
    assert len(rows) > 50 and right >= 0.95 * len(rows)
    again = quality_model.train(docs, quality_model.learnable(labels), "quality")
    assert all((model.w[k] == again.w[k]).all() for k in model.w)


def test_quality_gradients():
    import numpy as np

    rng = np.random.default_rng(0)
    x, first, y = rng.normal(size=(7, 5)), np.array([0, 3, 4, 7]), np.array([1.0, 0.0, 1.0])
    w = {"E": rng.normal(size=(5, 4)), "e": rng.normal(size=4), "V": rng.normal(size=(4, 3)), "U": rng.normal(size=(4, 3)),
         "q": rng.normal(size=3), "c": rng.normal(size=4), "b": rng.normal(size=1)}

    def loss():
        p = quality_model.forward(x, first, w)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    got = quality_model.gradients(x, first, y, w, quality_model.forward(x, first, w))
    for name, values in w.items():
        flat, want = values.reshape(-1), got[name].reshape(-1)
        for i in range(len(flat)):
            flat[i] += 1e-6
            up = loss()
            flat[i] -= 2e-6
            down = loss()
            flat[i] += 1e-6
            assert want[i] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_quality_odd_rows(spark, docs, odd, empty):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality_model.train(docs, labels, "quality", epochs=3)
    rows = quality_model.score(odd, model, "doc_id", attention=True).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(sum(r["attention"]) == pytest.approx(1) for r in rows)
    assert quality_model.score(empty, model, "doc_id").count() == 0
    assert quality_model.train(empty, labels, "quality") is None
    assert quality_model.train(docs, labels.limit(0), "quality") is None
    assert {r["score"] for r in quality_model.score(odd, None, "doc_id").collect()} == {0.5}


def repeated(words):
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    return len({i + k for at in places.values() if len(at) > 1 for i in at for k in range(5)})


def test_divergence_base(docs, odd):
    rows = docs.select("doc_id", "text", "lang").union(odd.select("doc_id", "text", "lang"))
    texts = {(r["doc_id"], len(r["text"] or "")): r["text"] or "" for r in rows.collect()}
    found = divergence.measured(rows).collect()
    assert len(found) == rows.count()
    want = Counter()
    for (doc, _), text in texts.items():
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        n = repeated(words)
        want[(doc, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), n,
              len(words) < 10 or 100 * n > 20 * len(words))] += 2 if doc == 6 and text.startswith("the of and the of ") else 1
    assert Counter(tuple(r)[:7] for r in found) == want
    assert not any(r["kept"] and r["base_failed"] for r in found)


def test_divergence_keeps_clean_documents(spark, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = divergence.measured(docs).join(labels, "doc_id").collect()
    good = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r for r in rows if r["quality"] == 0]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good)
    assert sum(not r["kept"] for r in bad) >= 0.75 * len(bad)


def test_divergence_without_languages(odd, empty):
    rows = divergence.measured(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in rows)
    assert divergence.measured(empty).count() == 0


def best_count(word, scores):
    data = ("▁" + word).encode()
    best = [(0.0, 0)] + [(float("-inf"), 0)] * len(data)
    for end in range(1, len(data) + 1):
        for start in range(end):
            piece = data[start:end]
            score = scores.get(piece, tokens.UNKNOWN if len(piece) == 1 else None)
            if score is not None and best[start][0] + score > best[end][0]:
                best[end] = (best[start][0] + score, best[start][1] + 1)
    return best[-1]


def test_tokens_as_brute_force(spark, odd, docs):
    scores = tokens.unigram_scores(tokens.default_vocabulary())
    rows = docs.select("doc_id", "text").limit(40).union(odd.where("doc_id not in (5)").select("doc_id", "text"))
    known = {}
    for r in tokens.count_tokens(rows, "doc_id", "text").collect():
        words = WORD.findall(r["text"] or "")
        for w in set(words) - set(known):
            known[w] = best_count(w, scores)[1]
        assert r["n_words"] == len(words)
        assert r["n_tokens"] == sum(known[w] for w in words)


def test_tokens_odd_rows(odd, empty):
    rows = tokens.count_tokens(odd, "doc_id", vocabulary={"▁x".encode(): -1.0, b"xxxx": -1.0, b"the": -2.0}).collect()
    by = {r["doc_id"]: r["n_tokens"] for r in rows}
    assert len(rows) == len(ODD) and by[1] == by[2] == by[3] == 0 and by[5] >= 75_000
    assert tokens.count_tokens(empty, "doc_id").count() == 0


def test_licenses_find_planted_notices(spark, docs):
    found = licenses.scan(docs).collect()
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for name, notice in licenses.TEMPLATES[:4]:
        holders = {i for i, t in text.items() if notice in t}
        exact = {r["doc_id"] for r in found if r["license"] == name and r["coverage"] == 1.0}
        assert holders <= exact
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in found:
        words = list(word.finditer("".join(c.lower() if "A" <= c <= "Z" else c for c in text[r["doc_id"]])))
        assert text[r["doc_id"]][words[r["first_word"]].start() : words[r["last_word"]].end()] == r["matched_text"]


def test_licenses_edits_and_repeats(spark, odd, empty):
    notice = dict(licenses.TEMPLATES)["MIT-notice"]
    changed = notice.replace("free of charge, ", "").replace("Software without", "Software now without")
    df = spark.createDataFrame([(1, "before " + changed + " after " + "word " * 50 + notice), (2, None)], "doc_id long, text string")
    rows = sorted((r["first_word"], r["coverage"]) for r in licenses.scan(df).where("license = 'MIT-notice'").collect())
    assert len(rows) == 2 and rows[0][0] == 1 and 0.9 < rows[0][1] < 1 and rows[1][1] == 1
    assert licenses.scan(odd).count() == 0 and licenses.scan(empty).count() == 0


def test_licenses_many_notices_side_by_side(spark):
    credit, mit = "Photo by Ann Lee. Licensed under CC BY-NC 4.0. ", "Released under the MIT License. "
    texts = [credit * 500, (mit + "see it ") * 40, mit + "as the MIT License says; " * 3 + mit, mit * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [(r["doc_id"], r["license"], r["first_word"], r["coverage"]) for r in licenses.scan(df).collect() if r["coverage"] == 1]
    want = [(0, "CC-BY-NC-4.0", 11 * i + 4, 1) for i in range(500)] + [(1, "MIT", 7 * i, 1) for i in range(40)]
    want += [(2, "MIT", 0, 1), (2, "MIT", 5 + 3 * 5, 1)] + [(3, "MIT", 5 * i, 1) for i in range(30)]
    assert sorted(found) == want


def test_licenses_whole_texts(spark):
    """Whole licenses, edited in many places, are covered; notices in them and older versions are not reported besides."""
    import random

    rng, whole = random.Random(4), dict(licenses.whole_texts())
    rows = []
    for i, name in enumerate(sorted(whole)):
        words = whole[name].split()
        for _ in range(len(words) // 50):
            k = rng.randrange(len(words))
            rng.choice([lambda: words.pop(k), lambda: words.insert(k, "thing"), lambda: words.__setitem__(k, "other")])()
        rows.append((i, " ".join([*[f"n{j}" for j in range(rng.randrange(40))], *words, "Released under the MIT License."]), name))
    df = spark.createDataFrame(rows, "doc_id int, text string, name string")
    found = licenses.scan(df, templates=licenses.TEMPLATES + licenses.whole_texts()).collect()
    got = {(r["doc_id"], r["license"]): r["coverage"] for r in found}
    assert len(got) == len(found)
    assert set(got) == {(i, name) for i, _, name in rows} | {(i, "MIT") for i, _, _ in rows}
    assert all(got[i, name] > 0.9 for i, _, name in rows)
    part = spark.createDataFrame([(1, " ".join(whole["GPL-3.0-text"].split()[:2000]))], "doc_id int, text string")
    assert licenses.scan(part, templates=licenses.whole_texts()).count() == 0


def test_licenses_nested_notices():
    spans = [(0, 5, 10, 14), (1, 50, 8, 60), (1, 50, 70, 120), (2, 5, 118, 124), (3, 50, 8, 60), (0, 5, 58, 64)]
    assert licenses.outermost(spans) == [(0, 5, 58, 64), (1, 50, 8, 60), (1, 50, 70, 120), (2, 5, 118, 124)]
    assert licenses.outermost([]) == []


def test_licenses_winnowing_guarantee():
    import numpy as np

    rng = np.random.default_rng(3)
    h = rng.integers(0, 9, 200).astype(np.uint64)
    at = set(licenses.winnow(h, 4).tolist())
    assert all(at & set(range(i, i + 4)) for i in range(len(h) - 3))


def test_long_words_count_as_in_the_trie(spark, monkeypatch):
    """The forward pass of a long word and the trie agree, also across its steps."""
    book = tokens.Vocabulary(tokens.unigram_scores(tokens.default_vocabulary()))
    rng = np.random.default_rng(4)
    words = [bytes(rng.choice(np.frombuffer("abcdethé中文字ing0123=".encode(), np.uint8), n)) for n in (1, 2, 7, 300, 700)]
    words += [("的一是不了人我在" * 40).encode(), b"YWJjZGVm" * 60, b"=" * 500]
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    start = end - [len(w) for w in words]
    expected = book.shared(data, start, end)
    for step in (3, 64, 1 << 16):
        monkeypatch.setattr(tokens, "STEP", step)
        assert [book.forward(np.concatenate((book.mark, np.frombuffer(w, np.uint8)))) for w in words] == expected.tolist()
    assert book.count(data, start, end).tolist() == expected.tolist()
    began = time.perf_counter()
    huge = np.frombuffer(b"QUJD0123" * 125_000, np.uint8)
    assert book.count(huge, np.array([0]), np.array([len(huge)]))[0] > 1000
    assert time.perf_counter() - began < 30


def test_spans_cover_all_words_whatever_the_slices(docs, odd, monkeypatch):
    model = languages.train(languages.learned_from(docs))
    some = docs.select("doc_id", "text").limit(200).union(odd.select("doc_id", "text"))
    found = languages.identify(some, model, "doc_id", "text").collect()
    for r in found:
        at = 0
        for span in r["spans"]:
            assert span["first_word"] == at and span["n_words"] > 0
            at += span["n_words"]
        assert at == len(re.findall("[^\\x20\\x09-\\x0D]+", r["text"] or ""))
    monkeypatch.setattr(languages, "SLICE", 1 << 10)
    assert sorted(map(str, languages.identify(some, model, "doc_id", "text").collect())) == sorted(map(str, found))

import gzip
import io
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewharf.functions.scratch import new_folder
from tidewharf.llm import mixing, urls, warc
from tidewharf.llm.queries import LLM_QUERIES

FOLDER = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0D]+")
LONG = "<html>" + "é" * 60 + "</html>"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([
        (3, "http://a/ b\r\nWARC-Type: x", LONG), (1, "http://a/1", LONG), (2, None, LONG), (4, "u", "short"), (5, "u", "short"),
        (6, "u", None), (7, "u", ""), (1, "http://a/1", LONG), (None, "u", LONG), (8, "u", "x" * 3_000_000), (9, "u", "\r\n\r\n" * 50),
    ], PAGES)


def test_warc_round_trip(spark, pages):
    archives = warc.write(pages, new_folder(spark, "warc"), roll=500)
    assert archives.count() > 1
    rows = warc.read(archives, payloads=True).collect()
    html = {r["page_id"]: r["html"] or "" for r in pages.collect()}
    assert len(rows) == pages.count() and all(r["verified"] for r in rows)
    for r in rows:
        data = html[r["page_id"]].encode()
        assert r["payload_bytes"] == len(data)
        same = html[r["page_id"]] == LONG
        assert (r["record_type"], r["refers_to"]) == (("revisit", 1) if same and r["page_id"] != 1 else ("response", None))
        assert r["payload"] == (data if r["record_type"] == "response" else None)
    assert warc.read(warc.write(pages.limit(0), new_folder(spark, "warc"))).count() == 0


def archive_bytes():
    a = warc.page_record(1, "http://x/", b"payload" * 30, __import__("hashlib").sha256(b"payload" * 30).hexdigest(), None)
    b = warc.page_record(2, None, b"", __import__("hashlib").sha256(b"").hexdigest(), None)
    return a, b


def test_warc_members_and_framing():
    a, b = archive_bytes()
    text = gzip.decompress(a)
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(b"\r\n\r\n")

    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(1)

    got = list(warc.read_records(Slow(a + b), payloads=True))
    assert [(r["id"], r["size"], r["verified"]) for r in got] == [("urn:page:1", 210, True), ("urn:page:2", 0, True)]
    assert got[0]["payload"] == b"payload" * 30
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(a[:-20])))
    wrong = warc.page_record(1, None, b"payload", "0" * 64, None)
    assert [r["verified"] for r in warc.read_records(io.BytesIO(wrong))] == [False]


def test_warc_url_of_megabytes(spark):
    url = "data:text/html," + "ab c" * 1_000_000
    rows = [(1, url, LONG), (2, "u", "short"), (3, url, LONG)]
    found = warc.read(warc.write(spark.createDataFrame(rows, PAGES), new_folder(spark, "warc")), payloads=True).collect()
    by = {r["page_id"]: r for r in found}
    assert len(found) == 3 and all(r["verified"] for r in found)
    assert by[1]["target_uri"] == by[3]["target_uri"] == url.replace(" ", "%20")
    assert by[1]["payload"] == LONG.encode() and by[3]["refers_to"] == 1 and by[2]["payload"] == b"short"
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(gzip.compress(b"WARC/1.1\r\nno end"))))


def ruling(url, rules=urls.RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in rules:
        domain, _, begin = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + begin):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_url_rules_and_verdicts(spark):
    own = [
        (1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://WWW.Example.NET/en/x?q#f"), (6, "https://example.net"),
        (7, "http://xexample.net/en/"), (8, "http://a.example.com/de/1"), (9, "http://a.org/fr/#x"), (10, "http://a.org/fr"),
        (11, "http://net/?x"), (11, "http://net/?x"), (None, "x://y://net/"), (12, "http://ü.org/fr/" + "a" * 20_000), (13, "http://a.net\n/x"),
    ]
    given = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url")
    own = [(i if i is None else -i, url) for i, url in own]  # apart from the given keys
    rows = given.union(spark.createDataFrame(own, "page_id long, url string")).withColumn("score", F.lit("clash"))
    url = {r["page_id"]: r["url"] for r in rows.collect()}
    found = urls.judged(rows).collect()
    assert len(found) == rows.count()
    for r in found:
        host, path, rule, verdict = ruling(url[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url[r["page_id"]]
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    by = {r["page_id"]: r["verdict"] for r in found}
    assert by[-1] == by[-2] == "block"
    assert urls.judged(rows.limit(0)).count() == 0


def test_url_model_tells_sides_apart(spark):
    rows = [(i, f"http://h{i}.net/buy-pills-{i}") for i in range(60)] + [(i + 100, f"http://h{i}.org/fr/poem-{i}") for i in range(60)]
    rows += [(1000, "http://q.com/buy-pills-now"), (1001, "http://q.com/a-poem")]
    by = {r["page_id"]: r["verdict"] for r in urls.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert by[1000] == "block" and by[1001] == "allow"


def test_url_ratios_as_brute_force(spark):
    texts = [("abab", 1), ("abba", 1), ("bbbb", 0), ("cab", None)]
    order, strength = 2, 4.0
    rows = spark.createDataFrame(texts, "t string, y int").select("y", F.explode(urls.grams(F.col("t"), order)).alias("g"))
    counts = rows.groupBy("g").agg(F.count(F.when(F.col("y") == 1, 1)).alias("n_allow"), F.count(F.when(F.col("y") == 0, 1)).alias("n_block"))
    found = {r["g"]: r["ratio"] for r in urls.log_ratios(counts, order, strength).collect()}
    grams = [(r["g"], r["y"]) for r in rows.collect()]
    import math

    def p(g, y, k):
        if k < 0:
            return 1 / urls.ALPHABET
        own = sum(x.endswith(g[order - k :]) for x, z in grams if z == y)
        all_ = sum(x[order - k : order] == g[order - k : order] for x, z in grams if z == y)
        return (own + strength * p(g, y, k - 1)) / (all_ + strength)

    assert set(found) == {g for g, _ in grams}
    for g, ratio in found.items():
        assert ratio == pytest.approx(math.log(p(g, 1, order) / p(g, 0, order)))


def water(sizes, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        share = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = 2 * sizes[s]
            rest -= target[s]
        open_ -= above
    return target


def mix_rows():
    rows = [(i, "w " * (i % 17), "en", f"s{i % 5}", 0) for i in range(300)]
    rows += [(1000, "w " * 5000, "en", "tiny", 0), (1001, None, "en", "none", 0), (1002, "w", "en", None, 0), (1003, "a b c", "en", None, 0),
             (None, "a b", "en", "s1", 0), (1004, " \n", "en", "s2", 0), (1005, "x y", "en", "s3", 0), (1005, "x y", "en", "s3", 0)]
    return rows


def test_mixing_targets_and_takes(spark):
    rows = mix_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumn("knots", F.lit(1)).withColumn("size", F.lit("clash"))
    found = mixing.assigned(docs).collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = water(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert r["size"] == len(WORD.findall(r["text"] or "")) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]]) and 0 <= r["taken"] <= 2 * r["size"]
        assert (r["first_position"] is None) == (r["taken"] == 0)
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    key = lambda r: (r["doc_id"] or 0, r["text"] or "", r["taken"], r["first_position"] or 0)
    assert sorted(map(key, found)) == sorted(map(key, mixing.assigned(docs.repartition(7)).collect()))
    assert mixing.assigned(docs.limit(0)).count() == 0


def test_mixing_positions_follow_the_schedule(spark):
    docs = spark.createDataFrame([(i, "a b c d", "en", "ab"[i % 2], 0) for i in range(4000)], DOCS)
    schedule = spark.createDataFrame(
        [("a", 0.0, 1.0), ("a", 1.0, 0.0), ("b", 0.0, 0.0), ("b", 0.5, 0.5), ("b", 1.0, 1.0)], "source string, at double, share double"
    )
    rows = mixing.training_order(mixing.assigned(docs, weights=(1,), percent=100, schedule=schedule)).collect()
    at = [r["first_position"] for r in rows]
    assert len(rows) == 4000 and at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    for part, share in ((slice(0, 1000), 0.875), (slice(1000, 2000), 0.625), (slice(3000, 4000), 0.125)):
        assert sum(r["source"] == "a" for r in rows[part]) / 1000 == pytest.approx(share, abs=0.01)
    assert sum(t < 0.25 for t in at) == pytest.approx(1000, abs=10)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "s", 0), (None, "the of and " * 40, "en", None, 1)], DOCS)
    rows = docs.union(odd).withColumn("score", F.lit("clash")).withColumn("lang_pred", F.lit(1))
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, FOLDER)
        left = rows.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert rows.columns == [*docs.columns, "score", "lang_pred"]
            assert 0 < len(left)
        rows = spark.createDataFrame(left, rows.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_pipeline_run_is_its_stages(spark):
    found = sorted(r["doc_id"] for r in corpus_pipeline.run(spark, FOLDER).collect())
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), stage(spark, docs, FOLDER).schema)
    assert found == sorted(r["doc_id"] for r in docs.collect())
    assert 100 <= len(found) < 200


def test_all_are_registered():
    assert {name.split("_")[0] for name in LLM_QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_mixing_default_curriculum_bends_each_weight_in_turn(spark):
    """Positions are the inverse of the integrated share, and the shares over the run follow the schedule."""
    docs = spark.range(900).selectExpr("id as doc_id", "concat('s', id % 3) as source", "repeat('w ', 20) as text")
    rows = mixing.assigned(docs, weights=(1, 1, 1), percent=100, schedule=mixing.CURRICULUM).collect()
    early = {}
    for row in rows:
        turn = int(row["source"][1])
        (_, a), (_, b) = mixing.CURRICULUM[turn]
        t = row["first_position"]
        assert a * t + (b - a) * t * t / 2 == pytest.approx(round(300 * (a * t + (b - a) * t * t / 2)) / 300, abs=1e-9)
        early[turn] = early.get(turn, 0) + (t < 0.5)
    assert early == {0: 188, 1: 150, 2: 113}  # of 300: shares of 5/8, 1/2 and 3/8 in the first half


def test_integral_of_a_schedule():
    assert mixing.integrated([(0.0, 2.0), (0.5, 1.0), (1.0, 0.0)]) == [(0.0, 2.0, 0.0), (0.5, 1.0, 0.75), (1.0, 0.0, 1.0)]


def test_long_urls_and_hosts(spark):
    """Characters are counted one by one, so a URL of a megabyte takes seconds, not hours."""
    rows = [(i, f"https://a{i}.{'net' if i % 2 else 'org/fr'}/p{i}") for i in range(40)]
    deep = ".".join(f"l{i}" for i in range(10_000))
    rows += [(100, "https://long.com/" + "x" * 1_000_000), (101, f"https://{deep}.net/"), (102, f"https://{deep}.com/"), (103, None), (104, "")]
    rows += [(105, "https://é中\U0001f600.com/"), (None, None)]
    found = {r["page_id"]: r for r in urls.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert found[101]["rule"] == "net/" and found[101]["verdict"] == "block" and found[102]["rule"] is None
    assert found[100]["host"] == "long.com" and found[103]["verdict"] == found[104]["verdict"] == "block" and len(found) == len(rows)
    assert found[100]["score"] is not None and found[105]["score"] is not None


def test_grams_of_characters_beyond_two_bytes(spark):
    row = spark.createDataFrame([("a\U0001f600é",)], "t string").select(urls.grams(F.col("t"), 2).alias("g")).first()
    s, e = urls.START, urls.END
    assert row["g"] == [s + s + "a", s + "a\U0001f600", "a\U0001f600é", "\U0001f600é" + e]


def test_revisits_are_checked_against_their_responses(spark):
    rows = [
        (1, "response", 120, "a", None, True), (2, "revisit", 120, "a", 1, True), (3, "revisit", 120, "b", 1, True),
        (4, "revisit", 121, "a", 1, True), (5, "revisit", 120, "a", 99, True), (6, "response", 150, "c", None, False),
        (7, "revisit", 150, "c", 6, True), (None, "revisit", 120, "a", None, True), (1, "response", 120, "a", None, True),
        (2, "revisit", 120, "a", 1, True), (8, "response", 0, None, None, True),
    ]
    names = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, verified boolean"
    found = warc.checked(spark.createDataFrame(rows, names))
    assert len(found.collect()) == len(rows) and found.columns == [n.split()[0] for n in names.split(", ")]
    sound = sorted(r["page_id"] for r in found.where("verified").collect())
    assert sound == [1, 1, 2, 2, 8]
    assert warc.checked(found.where("page_id > 99")).count() == 0

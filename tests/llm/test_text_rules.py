"""Quality rules, personal data, URL filters, language and quality classifiers."""

from __future__ import annotations

import hashlib
import random
import subprocess
import sys

import numpy
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orrery.llm import language_id, pii, quality_classifier, quality_rules, text, url_filter
from orrery.llm.queries import QUERIES, URL_RULES, load
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
TEXTS = [
    None, "", " \t\n", "one", "a b c a b c a b c", "x\n x \nx\n\nx\n \n\n", "\u00a0a\u00a0b # * $ % & | < >",
    "De " * 300, "\n".join(["same line here"] * 40), "ÄÖ é\x0bz " * 60, "a b c d " * 13 + "e f g",
]


def test_quality_measures_equal_plain_version(spark):
    rows = [(i, t, "h" if i % 2 else None, i) for i, t in enumerate(TEXTS)] + [(3, "one", "h", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int")
    got = quality_rules.quality_rules(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        measured = tuple(r[c] for c in quality_rules.BASE)
        assert measured == brute.quality(TEXTS[r["doc_id"]])
    assert quality_rules.quality_rules(frame.limit(0)).collect() == []


def test_a_failing_host_takes_its_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(good, "bad" if i % 10 else "small") for i in range(20)] + [("x", "bad")] * 200 + [(good, "good")] * 300
    got = quality_rules.quality_rules(spark.createDataFrame(rows, "text string, source string"))
    kept = {(r["source"], r["base_failed"]): r["kept"] for r in got.collect()}
    assert kept == {("bad", False): False, ("bad", True): False, ("small", False): True, ("good", False): True}


PERSONAL = [
    None, "", "a@b.c@d.e x@y-z.co_m@n.o.p", "mail: first.last+tag@mail.example.com.", "1.2.3.4.5.6 256.1.1.1 01.002.3.255",
    "4111 1111 1111 1111 4111-1111-1111-1112 0000000000000", "+1 (017) 555-7713 +12 +1234567890123456 +44 20 7946 0958",
    "é日本 4111111111111111 é +1 (017) 555-7713", "7" * 30_000, "a" * 30_000 + "@b.c", "1." * 20_000, "+1" * 5_000,
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0", "@@ . a@b a@.c 1.1.1 1.1.1.1.", "12.34.56.78-4111 1111 1111 1111@x.y",
]


def test_personal_data_equals_plain_version(spark):
    frame = spark.createDataFrame(list(enumerate(PERSONAL)), "doc_id long, text string")
    for r in pii.find_pii(frame).collect():
        want = brute.pii(PERSONAL[r["doc_id"]])
        got = {k: [(s["first"], s["last"]) for s in r["pii"] if s["kind"] == k] for k in want}
        assert got == want, PERSONAL[r["doc_id"]][:80]
    assert pii.find_pii(frame.limit(0)).collect() == []


def test_checksums_and_context_add_spans(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 now", "DE88 3704 0044 0532 0130 00", "token " + "0a" * 20, "0a" * 20]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    found = pii.find_pii(frame).withColumn("safe", pii.redact(F.col("text"), F.col("pii"))).collect()
    kinds = {r["text"]: {s["kind"] for s in r["pii"]} & {"iban", "secret"} for r in found}
    assert kinds == dict(zip(texts, [{"iban"}, set(), {"secret"}, set()]))
    assert {r["safe"] for r in found} >= {"IBAN <IBAN> now", "token <SECRET>"}


def test_redaction_merges_overlaps(spark):
    text = "x +378282246310005 y a@b.c"
    frame = pii.find_pii(spark.createDataFrame([(text,), (None,), ("clean",)], "text string"))
    safe = [r[0] for r in frame.select(pii.redact(F.col("text"), F.col("pii"))).collect()]
    assert safe[1:] == [None, "clean"]
    assert safe[0] == "x <PHONE> y <EMAIL>"


def test_queries_equal_plain_versions(spark):
    docs = {r["doc_id"]: r["text"] for r in load(spark, SF_DIR, "documents").collect()}
    for r in QUERIES["op10_pii"](spark, SF_DIR).collect():
        spans = ",".join(f"{k}:{a}:{b}" for k, found in brute.pii(docs[r["doc_id"]]).items() for a, b in found)
        assert r["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
    rules = [(r.verdict, r.pattern) for r in URL_RULES]
    pages = {r["page_id"]: r["url"] for r in load(spark, SF_DIR, "pages").select("page_id", "url").collect()}
    got = QUERIES["op3_url_filters"](spark, SF_DIR).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r["host"], r["path"], r["rule"]) == brute.url(pages[r["page_id"]], rules)
        if r["rule"]:
            assert r["verdict"] == dict((p, v) for v, p in rules)[r["rule"]]


URLS = [
    None, "", "no-scheme.org/x", "http://A.Example.ORG/es/1?x=1#y", "http://example.org?es", "x://y://z.com/de/",
    "http://notexample.org/es/", "http://com/de/", "https://a.com#/fr/", "https://a.com/fr", "https://É.com/DE/", "://org/",
]


def test_rules_equal_plain_version(spark):
    frame = spark.createDataFrame([(u, "q") for u in URLS * 2], "url string, host string")
    rules = [(r.verdict, r.pattern) for r in URL_RULES]
    for r in url_filter.filter_urls(frame, URL_RULES).collect():
        assert (r["host"], r["path"], r["rule"]) == brute.url(r["url"], rules)
        assert r["verdict"] in ("allow", "block")
    assert url_filter.filter_urls(frame.limit(0), URL_RULES).collect() == []


def test_trees_learn_what_the_rules_show(spark):
    rows = [(f"http://a{i}.com/{'de' if i % 3 else 'fr'}/{i}",) for i in range(300)]
    rows += [(f"http://b{i}.net/{'de' if i % 3 else 'fr'}/{i}",) for i in range(60)]
    got = url_filter.filter_urls(spark.createDataFrame(rows, "url string"), URL_RULES).where("rule IS NULL")
    right = [(r["verdict"] == "block") == ("/de/" in r["url"]) for r in got.collect()]
    assert len(right) == 60 and sum(right) / 60 > 0.95


def test_languages_held_out(spark):
    lang = {r["doc_id"]: r["lang"] for r in load(spark, SF_DIR, "documents").collect()}
    got = QUERIES["op7_language_id"](spark, SF_DIR).where("held_out").collect()
    assert len(got) > 30
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in got) / len(got) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_languages_of_odd_rows(spark):
    learn = spark.createDataFrame(
        [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("x", None), (None, "de")], "text string, lang string"
    )
    model = language_id.train_language_model(learn)
    rows = [(None, 1), ("", 2), ("123 !!", 3), ("THE dogs", 4), ("Hunde", 5), ("日本", 6)] * 2
    frame = spark.createDataFrame(rows, "text string, score int")
    got = language_id.identify_language(frame, model).collect()
    assert [r["lang_pred"] for r in got][:5] == ["und", "und", "und", "en", "de"]
    assert got[0]["score"] == 0.0 and got[:6] == got[6:]
    nothing = language_id.train_language_model(learn.limit(0))
    assert {r["lang_pred"] for r in language_id.identify_language(frame, nothing).collect()} == {"und"}
    assert language_id.identify_language(frame.limit(0), model).collect() == []


def test_backoff_prefers_longer_grams(spark):
    learn = spark.createDataFrame([("abcdef", "x"), ("abczzz", "y")], "text string, lang string")
    model = language_id.train_language_model(learn)
    assert model.word("abcdef") == model.tables[0]["abcdef"]
    assert all(len(g) == 5 for n in (5,) for g in model.tables[n])
    assert model.predict(__import__("pyarrow").array(["bcdefg"]))[0] == ["x"]


@pytest.fixture(scope="module")
def quality(spark):
    sf = "/root/testdata/sf0.01"
    labels = load(spark, sf, "labels")
    docs = load(spark, sf, "documents")
    even = labels.where("doc_id % 2 = 0")
    model = quality_classifier.train_quality_model(docs, even)
    return quality_classifier.classify_quality(docs.select("doc_id", "text", "source", "lang"), model), labels


def test_quality_of_documents_not_learned_from(quality):
    judged, labels = quality
    rows = judged.join(labels, "doc_id").where("doc_id % 2 = 1").collect()
    clean = [r["kept"] for r in rows if r["quality"] and not r["toxic"]]
    bad = [r["kept"] for r in rows if not r["quality"]]
    assert sum(clean) / len(clean) > 0.9 and sum(bad) / len(bad) < 0.35


def test_quality_of_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "h", "p"), (2, "", "h", "p"), (3, "x " * 5000, "h", "q")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(1, 1, None), (9, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality_classifier.train_quality_model(frame, labels)
    got = quality_classifier.classify_quality(frame, model).collect()
    assert len(got) == 4 and all(0 <= r["score"] <= 1 for r in got)
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality_classifier.train_quality_model(frame, one)
    assert quality_classifier.classify_quality(frame.limit(0), model).collect() == []


class Given:
    """A model that takes a text's number for its log odds."""

    def odds(self, texts):
        values = numpy.array([float(t) for t in texts.to_pylist()])
        return values, numpy.full(len(values), -30.0)


def given(seed: int, hosts: int, spread: float, sizes: list[int]) -> list[tuple]:
    rng, rows = random.Random(seed), []
    for h in range(hosts):
        of_host = rng.gauss(0, spread)
        for path in range(rng.choice([1, 3])):
            of_path = of_host + rng.gauss(0, spread / 2)
            rows += [(str(of_path + rng.gauss(0, 1)), f"h{h}" if h else None, f"p{path}") for _ in range(rng.choice(sizes))]
    return rows


@pytest.mark.parametrize("seed,hosts,spread,sizes", [(1, 30, 1.5, [1, 2, 50]), (2, 12, 0.0, [40]), (3, 1, 1.0, [30])])
def test_rates_equal_a_plain_version(spark, seed, hosts, spread, sizes):
    rows = given(seed, hosts, spread, sizes)
    frame = spark.createDataFrame(rows, "text string, source string, lang string").withColumn("id", F.monotonically_increasing_id())
    plain = frame.select("id", "text", "source", "lang").collect()
    got = {r["id"]: r for r in quality_classifier.classify_quality(frame, Given()).collect()}
    wanted = brute.shrunk([(float(r["text"]), r["source"], r["lang"]) for r in plain], quality_classifier.PRIORS)
    for r, (host_rate, path_rate, score) in zip(plain, wanted):
        found = got[r["id"]]
        assert (found["host_rate"], found["path_rate"], found["score"]) == pytest.approx((host_rate, path_rate, score), abs=1e-6)


def test_sparse_paths_shrink_to_their_host(spark):
    rows = [("-2", "a", "p")] * 3 + [(str(1.5 + k % 2), "a", "q") for k in range(200)]
    rows += [(str(-1.5 + k % 2), "b", "p") for k in range(200)] + [("2", "b", "r")]
    frame = spark.createDataFrame(rows, "text string, source string, lang string")
    rates = {(r["source"], r["lang"]): r for r in quality_classifier.classify_quality(frame, Given(), prior_rows=(50.0, 50.0)).collect()}
    low, high = rates["b", "p"]["path_rate"], rates["a", "q"]["path_rate"]
    assert low < 0.4 < 0.75 < high
    # Three poor documents move the path of a good host a little; one good document does not save a path of a poor host.
    assert rates["a", "q"]["host_rate"] > rates["a", "p"]["path_rate"] > 0.7 and rates["b", "r"]["path_rate"] < 0.45
    # A document is not evidence for its own path.
    assert rates["b", "r"]["path_rate"] == pytest.approx(rates["b", "r"]["host_rate"])


def test_words_longer_than_a_span_are_hashed_alike_wherever_they_stand():
    long = "é" * text.SPAN + "x"
    texts = [f"a {long}", f"{'b ' * 20_000}{long} c", long, f"{long}y", "", None]
    words = text.find_words(pa.array(texts))
    hashes = words.hashes()
    found = {}
    for start, end, value in zip(words.start, words.end, hashes.tolist()):
        found.setdefault(words.data[start:end].tobytes(), set()).add(value)
    assert all(len(v) == 1 for v in found.values())
    assert len(set().union(*found.values())) == len(found) == 5


def test_memory_does_not_grow_for_good_with_one_long_text():
    program = (
        "import pyarrow as pa, resource\n"
        "from orrery.llm import text\n"
        "peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024\n"
        "texts = pa.array(['somehow ' * (4 << 20) + 'x' * (32 << 20)])\n"
        "before = peak()\n"
        "text.find_words(texts).hashes()\n"
        "print(peak() - before)\n"
    )
    grown = subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, check=True).stdout
    assert float(grown) < 500


def test_input_columns_may_have_the_names_of_helpers(spark):
    rows = [(i, f"http://a{i % 7}.{'org' if i % 2 else 'com/de'}/p{i}", "good words here " * 30, "h", "p", i) for i in range(60)]
    names = ["_f_vector", "_good", "_host", "_orrery_host", "_known", "_kept", "kept0"]
    frame = spark.createDataFrame(rows, "doc_id long, url string, text string, source string, lang string, n int")
    frame = frame.withColumns({c: F.lit(c) for c in names})
    model = quality_classifier.train_quality_model(frame, spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"))
    from orrery.llm import ngram_jaccard

    for got in (
        url_filter.filter_urls(frame, URL_RULES), quality_classifier.classify_quality(frame, model),
        quality_rules.quality_rules(frame), ngram_jaccard.own_nodes(frame, "doc_id", "text", "node"),
    ):
        assert [got.first()[c] for c in names] == names and got.count() == 60


def test_a_hot_url_and_a_hot_text_do_not_fill_the_samples(spark):
    urls = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "http://hot.org/x").otherwise(F.concat(F.lit("http://a.com/"), F.col("id").cast("string"))).alias("url"),
    ).withColumns({"host": F.lit("a.com"), "path": F.lit("/p"), "label": F.when(F.col("url").contains("hot"), 1).otherwise(0)})
    sizes = []
    real = url_filter.store
    url_filter.store = lambda rows, purpose: (kept := real(rows, purpose), sizes.append(kept.count()))[0]
    try:
        url_filter.train_url_model(urls, sample_rows=1000)
    finally:
        url_filter.store = real
    assert 600 < sizes[0] < 1400
    texts = urls.select(F.col("url").alias("text"), F.lit("en").alias("lang"))
    counts = []
    real = language_id.store
    language_id.store = lambda rows, purpose: (kept := real(rows, purpose), counts.append(kept.count()))[0]
    try:
        language_id.train_language_model(texts, sample_rows=1000)
    finally:
        language_id.store = real
    assert 600 < counts[-1] < 1400


@pytest.mark.parametrize("seed,words,grams", [(1, 10_000, 5_000), (2, 6, 9)])
def test_languages_equal_a_plain_version(spark, seed, words, grams):
    rng = random.Random(seed)
    letters = {"en": "abcdefgh", "de": "cdefghäöü", "fr": "aéèçfgh"}
    make = lambda lang: " ".join(
        "".join(rng.choice(letters[lang]) for _ in range(rng.randrange(1, 8))) for _ in range(rng.randrange(1, 12))
    )
    learn = [(make(lang), lang) for lang in letters for _ in range(8)]
    learn += learn[:3]
    texts = [make(rng.choice(list(letters))) + rng.choice(["", " Zzz!", "-12-", " ÄÖ"]) for _ in range(40)] + ["", None, "12", "жук"]
    model = language_id.train_language_model(
        spark.createDataFrame(learn, "text string, lang string"), max_words=words, max_grams=grams
    )
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {r["id"]: r for r in language_id.identify_language(frame, model).collect()}
    plain = brute.language_scores(learn, {0: words, **{n: grams for n in range(1, 6)}})
    for i, text in enumerate(texts):
        lang, score = brute.language(text, *plain)
        assert got[i]["score"] == pytest.approx(score, abs=1e-9) and (got[i]["lang_pred"] == lang or score < 0.34)

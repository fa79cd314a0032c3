"""Classifiers and the language model: derivatives, held-out accuracy and odd rows."""

import math
import zlib

import numpy as np
import pytest

from rosterforge.llm import language_id, pseudo_likelihood, quality_mil, url_filter
from rosterforge.llm.arrow_text import word_bounds, word_hashes
from tests.conftest import SF
from tests.llm.conftest import ODD_ROWS

SMALL = SF.replace("sf0.001", "sf0.01")


def texts_of(*texts):
    blobs = [t.encode() for t in texts]
    return np.frombuffer(b"".join(blobs), np.uint8), np.cumsum([0] + [len(b) for b in blobs])


def test_mil_gradient():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(9, quality_mil.WIDTH))
    first, y, weight = np.array([0, 2, 3]), np.array([1.0, 0, 1]), np.array([0.5, 0.2, 0.3])
    shapes = {"W": (quality_mil.WIDTH, 4), "b": (4,), "V": (4, 3), "U": (4, 3), "v": (3,), "c": (4,), "c0": (1,)}
    p = {k: rng.normal(0, 0.3, s) for k, s in shapes.items()}
    _, grad = quality_mil.loss_and_gradient(p, x, first, y, weight, 0.01)
    for k in p:
        at = tuple(0 for _ in p[k].shape)
        moved = {n: v.copy() for n, v in p.items()}
        moved[k][at] += 1e-6
        up = quality_mil.loss_and_gradient(moved, x, first, y, weight, 0.01)[0]
        moved[k][at] -= 2e-6
        down = quality_mil.loss_and_gradient(moved, x, first, y, weight, 0.01)[0]
        assert abs((up - down) / 2e-6 - grad[k][at]) < 1e-5


def test_passages_do_not_see_their_neighbours():
    texts = ["A b c. " * 100, "", "ÉA!! " * 70, "x"]
    whole, starts = quality_mil.encode(*texts_of(*texts))
    for i, text in enumerate(texts):
        alone, _ = quality_mil.encode(*texts_of(text))
        part = whole[starts[i] : starts[i + 1]]
        assert part.shape == alone.shape
        assert np.array_equal(part, alone)


def test_quality_on_held_out(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    found = {r["doc_id"]: r for r in quality_mil.classify(docs, labels).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert len(found) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    test = [i for i, r in found.items() if r["held_out"] and i in truth]
    assert np.mean([found[i]["predicted"] == truth[i] for i in test]) > 0.97


def test_quality_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (7, 0), (5, 1), (5, 0), (None, 1), (9, None), (3, 4)], "doc_id long, quality int")
    rows = quality_mil.classify(odd, labels).collect()
    assert len(rows) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert quality_mil.classify(empty, labels).count() == 0
    none = labels.limit(0)
    assert {r["predicted"] for r in quality_mil.classify(odd, none).collect()} == {1}
    kept = quality_mil.reject(odd, none)
    assert kept.schema == odd.schema and kept.count() == len(ODD_ROWS)


def test_language_on_held_out(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = language_id.identify(docs, language_id.train(docs)).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(odd, empty):
    rows = language_id.identify(odd, language_id.train(odd)).collect()
    assert len(rows) == len(ODD_ROWS)
    for doc_id in (2, 3, 4, 8):
        assert [(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] == doc_id] == [("und", 0.0)]
    learned = {r[2] if len(r) > 2 else "en" for r in ODD_ROWS} - {None}
    assert {r["lang_pred"] for r in rows} <= learned | {"und"}
    assert {r["lang_pred"] for r in language_id.identify(odd, language_id.train(empty)).collect()} == {"und"}
    assert language_id.identify(empty, language_id.train(odd)).count() == 0


def test_families_come_first():
    rng = np.random.default_rng(0)
    centres = {k: rng.normal(size=40) for k in ("en", "de", "fr", "es", "xx")}
    langs = [k for k in centres for _ in range(30)]
    x = np.stack([centres[k] + rng.normal(0, 0.3, 40) for k in langs]).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    model = language_id.fit(x, langs, language_id.FAMILIES)
    assert sorted(map(sorted, model.families)) == [["de", "en"], ["es", "fr"], ["xx"]]
    found, scores = model.predict(x)
    assert np.mean(np.array(found) == np.array(langs)) > 0.98 and scores.min() >= 0 and scores.max() <= 1


def toy_vocabulary():
    share = np.arange(pseudo_likelihood.VOCABULARY) + 1.0
    ids = np.arange(pseudo_likelihood.VOCABULARY)
    n = pseudo_likelihood.CLASSES
    return pseudo_likelihood.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), ids % n, ids // n, np.log(share / share.sum()))


def test_window_network_gradient_and_normalisation():
    rng = np.random.default_rng(4)
    words = toy_vocabulary()
    p = {k: v.astype(np.float64) for k, v in pseudo_likelihood.start(words).items()}
    ids = rng.integers(0, pseudo_likelihood.VOCABULARY, 50)
    around = pseudo_likelihood.contexts(ids, np.array([20, 0, 30]))
    assert (around[0, [0, 1, 20, 21]] == pseudo_likelihood.EDGE).all() and around[3, 0] == ids[2]
    loss, grad = pseudo_likelihood.gradient(p, words, ids, around)
    assert abs(loss + pseudo_likelihood.log_probability(p, words, ids, around).sum()) < 1e-3
    for k, at in (("b", (2,)), ("C", (1, 3)), ("c", (5,)), ("E", (2, int(around[2, 7]), 4)), ("w", (int(ids[0]) % 32, int(ids[0]) // 32))):
        ends = []
        for move in (1e-4, -1e-4):
            moved = {n: v.copy() for n, v in p.items()}
            moved[k][at] += move
            ends.append(pseudo_likelihood.gradient(moved, words, ids, around)[0])
        assert abs((ends[0] - ends[1]) / 2e-4 - grad[k][at]) < 1e-3 * max(1, abs(grad[k][at]))
    every = np.arange(pseudo_likelihood.VOCABULARY)
    same = np.repeat(around[:, 7:8], len(every), axis=1)
    assert abs(np.exp(pseudo_likelihood.log_probability(p, words, every, same)).sum() - 1) < 1e-4


def test_corpus_scores_beat_single_words(spark, odd, empty):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts = pseudo_likelihood.count_words(docs)
    words = pseudo_likelihood.vocabulary(counts)
    texts = [r["text"] for r in docs.select("text").collect()]
    data, offsets = texts_of(*texts)
    begin, end, per_text = word_bounds(data, offsets)
    hashes = word_hashes(data, begin, end)
    assert counts.agg({"n": "sum"}).first()[0] == len(hashes) == sum(len(t.split()) for t in texts)
    single = words.log_share[words.encode(hashes)].mean()
    p = pseudo_likelihood.train(docs, words)
    rows = pseudo_likelihood.score(docs, words, p).collect()
    assert len(rows) == len(texts) and sum(r["tokens"] for r in rows) == len(hashes)
    assert sum(r["pseudo_log_likelihood"] for r in rows) / len(hashes) > single
    assert all(math.isfinite(r["mean_log_probability"]) and r["mean_log_probability"] <= 0 for r in rows)
    found = pseudo_likelihood.score(odd, words, p).collect()
    assert len(found) == len(ODD_ROWS)
    assert all(r["pseudo_log_likelihood"] == 0 for r in found if r["tokens"] == 0)
    assert pseudo_likelihood.score_corpus(empty).count() == 0


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("https://A.Example.ORG/es/3?x#y", "a.example.org", "/es/3", "example.org/es/", "block"),
        ("http://example.org/en/1", "example.org", "/en/1", "example.org/en/1", "block"),
        ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://badexample.org/es/3", "badexample.org", "/es/3", "org/", "allow"),
        ("x://com/fr/", "com", "/fr/", "com/fr/", "allow"),
        ("x://m.b.com/de/q#/fr/", "m.b.com", "/de/q", "com/de/", "block"),
        ("http://b.org", "b.org", "", None, None),
        ("http://b.org?q=http://c.com/de/", "b.org", "", None, None),
        ("http://É.org/", "É.org", "/", "org/", "allow"),
        ("no scheme", "", "", None, None),
        ("", "", "", None, None),
        (None, "", "", None, None),
        ("http://casino-win.example.net/spin/1", "casino-win.example.net", "/spin/1", None, "block"),
        ("http://www.readinghall.example.net/en/9", "www.readinghall.example.net", "/en/9", None, "allow"),
    ],
)
def test_url(spark, url_model, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "h", "r", 0.5)], "page_id long, url string, host string, rule string, score double")
    got = url_filter.judge(pages, url_model).collect()
    assert [(r["host"], r["path"], r["rule"]) for r in got] == [(host, path, rule)]
    assert verdict is None or got[0]["verdict"] == verdict
    assert got[0]["verdict"] in ("allow", "block")


@pytest.fixture(scope="module")
def url_model(spark):
    return url_filter.train(url_filter.labelled_urls(spark))


def test_url_model(spark, url_model):
    labelled = url_filter.labelled_urls(spark)
    pages = labelled.selectExpr("label AS page_id", "url")
    rows = url_filter.judge(pages, url_model, rules=()).collect()
    assert np.mean([(r["verdict"] == "block") == (r["page_id"] == 1) for r in rows]) > 0.97
    # the score by hand, from the same buckets
    one = pages.select("url", url_filter.grams(url_filter.host_of(pages.url), url_filter.path_of(pages.url)).alias("f")).orderBy("url").first()
    z = url_model.bias
    for side in ("host", "path"):
        z += url_filter.SHARE[side] * sum(url_model.weights[b] for b in one["f"][side]) / math.sqrt(max(1, len(one["f"][side])))
    judged = url_filter.judge(pages.where(pages.url == one["url"]), url_model).first()
    assert abs(judged["score"] - 1 / (1 + math.exp(-z))) < 1e-9
    long = spark.createDataFrame([(1, "http://a.net/" + "xy" * 300_000)], "page_id long, url string")
    assert url_filter.judge(long, url_model).count() == 1 and url_filter.judge(pages.limit(0), url_model).count() == 0
    assert url_filter.train(labelled.where("label = 0")).bias == -1.0
    plan = url_filter.judge(pages, url_model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_vocabulary_grows_with_the_counted_words(spark):
    counts = spark.range(5000).selectExpr("xxhash64(id) AS hash", "IF(id < 3000, 500L, 1L) AS n")
    words = pseudo_likelihood.vocabulary(counts)
    assert words.own == 3000 and len(np.unique(words.class_of)) == words.classes == 57
    hashes = np.array([r["hash"] for r in counts.where("n = 500").collect()], np.int64).view(np.uint64)
    assert sorted(words.encode(hashes).tolist()) == list(range(3000))
    assert words.totals.sum() == 2000 and len(words.log_share) == words.edge + 1


def test_words_in_shared_ids_have_their_own_probability(spark, docs_of):
    often = [f"often{i}" for i in range(pseudo_likelihood.OWN_WORDS)]
    names = [f"rare{i}" for i in range(400)]
    data, offsets = texts_of(*names)
    slot = word_hashes(data, *word_bounds(data, offsets)[:2]) % np.uint64(pseudo_likelihood.SHARED)
    once, thrice, never = [names[i] for i in np.flatnonzero(slot == slot[0])[:3]]
    body = " ".join(often * 5)
    corpus = docs_of([(1, body), (2, f"often1 {once} often2"), *[(k, f"often1 {thrice} often2") for k in (3, 4, 5)], (6, "")])
    found = {r["doc_id"]: r for r in pseudo_likelihood.score_corpus(corpus).collect()}
    assert [found[k]["tokens"] for k in range(1, 7)] == [4800, 3, 3, 3, 3, 0] and found[6]["pseudo_log_likelihood"] == 0
    value = lambda k: found[k]["pseudo_log_likelihood"]
    assert abs(value(3) - value(2) - math.log(3)) < 1e-6 and value(3) == value(4) == value(5)
    # the shares of an id's words and of all unseen ones add up to the id's probability
    counts = pseudo_likelihood.count_words(corpus)
    words = pseudo_likelihood.vocabulary(counts)
    p = pseudo_likelihood.start(words)
    asked = docs_of([(k, w) for k, w in enumerate((once, thrice, never))])
    whole = pseudo_likelihood.score(asked, words, p).collect()
    shares = {r["doc_id"]: r["pseudo_log_likelihood"] for r in pseudo_likelihood.score(asked, words, p, counts).collect()}
    assert abs(sum(math.exp(v) for v in shares.values()) - math.exp(whole[0]["pseudo_log_likelihood"])) < 1e-9
    assert abs(shares[2] - shares[0]) < 1e-9

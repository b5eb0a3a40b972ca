"""Language identification and toxicity: held-out accuracy, and their defined answers to odd rows."""

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from tillmark.llm import language, language_query, toxicity, toxicity_query  # noqa: F401 - registers the queries
from tillmark.llm.registry import QUERIES, table

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    rows = QUERIES["op3_language_id"](spark, SF)
    docs = table(spark, SF, "documents").select("doc_id", "lang", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    got = rows.join(docs.toDF("doc_id", "lang", "crc"), "doc_id").collect()
    assert len(got) == 1000 and all(r.held_out == (r.crc % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r.lang == r.lang_pred for r in got if r.held_out]
    assert sum(held) >= 0.95 * len(held)


def test_language_scores_are_sums_over_ngrams():
    texts = ["Ab c", "zz", "ab" * 50 + "é", "1a"]
    counts = language.count_ngrams(texts, 1 << 10)
    assert counts.sum() == sum(len(t) + 2 + len(t) + 1 + len(t) for t in texts)
    assert (counts == sum(language.count_ngrams([t], 1 << 10) for t in texts)).all()
    rng = np.random.default_rng(1)
    model = language.Model(["x", "y"], rng.normal(size=(1 << 10, 2)), np.array([-1.0, -2.0]))
    want = [model.prior + language.count_ngrams([t], 1 << 10) @ model.log_probs for t in texts]
    assert np.allclose(language.log_scores(texts, model), want)


def test_language_of_odd_rows(spark, documents):
    en, de = documents(["the house and the street"] * 3, lang="en"), documents(["das haus und die straße"] * 3, lang="de")
    untaught = documents(pairs=[(90, None), (91, ""), (92, "12 !? 3")], lang="en")
    model = language.fit(en.union(de).union(untaught), F.lit(True))
    assert model.languages == ["de", "en"]
    docs = documents([None, "", "12 - $", "the street", "die straße", "die straße", "the " * 300_000])
    got = language.predict(docs.withColumn("score", F.lit("clash")), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got] == ["und", "und", "und", "en", "de", "de", "en"]
    assert [r.score for r in got[:3]] == [0, 0, 0] and got[4].score == got[5].score
    assert language.predict(documents(), model).count() == 0
    empty = language.fit(documents(), F.lit(True))
    assert [r.lang_pred for r in language.predict(documents(["a"]), empty).collect()] == ["und"]


def test_language_learns_from_so_many_rows(spark, documents):
    docs = documents(["a b"] * 400, lang="en")
    model = language.fit(docs, F.lit(True), rows=50)
    assert model.languages == ["en"] and model.prior.tolist() == [0.0]


def test_toxicity_held_out(spark):
    rows = QUERIES["op1_toxicity"](spark, SF)
    docs = rows.join(table(spark, SF, "labels"), "doc_id").collect()
    assert rows.count() == 1000 and all(r.predicted == (r.score >= 0.7) for r in docs)
    held = [r for r in docs if r.held_out]
    assert sum(r.toxic == r.predicted for r in held) >= 0.95 * len(held)


def toy(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        sentences = [" ".join(rng.choice(words, 6)) for _ in range(8)]
        if i % 4 == 0:
            sentences[i % 8] += " " + ("foul" if i % 8 else "nasty")
        rows.append((i, ". ".join(sentences)))
        labels.append((i, int(i % 4 == 0)))
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxic_sentences_are_located(spark, documents):
    rows, labels = toy(spark)
    model = toxicity.fit(documents(pairs=rows), labels, F.lit(True))
    text = "w1 w2 w3. w4 FOUL, w5! w6 w7"
    docs = documents([text, "w1 w2 w3. w6 w7", None, "", " .!? ", "foul " + "w1 w2. " * 50_000, text])
    got = toxicity.score_documents(docs.withColumn("offending", F.lit(1)), model).orderBy("doc_id").collect()
    assert [text[s.start : s.end] for s in got[0].offending] == [" w4 FOUL, w5"]
    assert got[0].score > 0.7 > 0.3 > got[1].score and not got[1].offending
    assert [r.score for r in got[2:5]] == [0, 0, 0]
    assert got[5].offending[0].start == 0 and got[6].score == got[0].score
    assert toxicity.score_documents(documents(), model).count() == 0


def test_score_is_noisy_or_of_the_sentences():
    model = toxicity.Model({toxicity.features("bad")[0]: 3.0, toxicity.features("vile")[0]: 2.0}, -2.0)
    weights = {t: sum(model.weights.get(b, 0) for b in toxicity.features(t)) for t in "a bad vile bad,".split()}
    score, spans = toxicity.score_text("a bad. a vile. a", weights, model.bias)
    p = 1 / (1 + np.exp([-1.0, 0.0, 2.0]))
    assert np.isclose(score, 1 - np.prod(1 - p)) and [s[:2] for s in spans] == [(0, 5), (6, 13)]


def test_toxicity_without_two_classes(spark, documents):
    none = spark.createDataFrame([(0, 0), (1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(documents(["a b", "c"]), none, F.lit(True))
    got = toxicity.score_documents(documents(["a b"]), model).collect()
    assert 0 <= got[0].score < 0.1


def plain_languages(rows, labels, order_of=language.ORDERS, buckets=language.BUCKETS):
    """(language, posterior) of each (doc_id, text), n-gram by n-gram with plain integers and logarithms."""
    factors, mask = [int(f) for f in language._FACTORS], (1 << 32) - 1

    def grams(text):
        codes = [c if 97 <= c <= 122 or c >= 192 else 32 for c in map(ord, f" {text.lower()} ")]
        for order in order_of:
            for end in range(order - 1, len(codes)):
                mixed = codes[end] * factors[0] & mask
                for back in range(1, order):
                    mixed ^= (codes[end - back] + back) * factors[back] & mask
                mixed ^= mixed >> 15
                mixed = mixed * (0x2C1B3C6D + 2 * order) & mask
                yield (mixed >> 7) & (buckets - 1)

    counts, prior = {}, {}
    for doc_id, text in rows:
        lang = labels[doc_id]
        if lang is None or text is None or zlib.crc32(str(doc_id).encode()) % 5 == 0:
            continue
        prior[lang] = prior.get(lang, 0) + 1
        if any(c.isalpha() for c in text):
            own = counts.setdefault(lang, {})
            for g in grams(text):
                own[g] = own.get(g, 0) + 1
    languages = sorted(counts)
    totals = {lang: sum(counts[lang].values()) + 0.5 * buckets for lang in languages}
    seen = sum(prior[lang] for lang in languages)
    out = {}
    for doc_id, text in rows:
        if not text or not any(c.isalpha() for c in text):
            out[doc_id] = ("und", 0.0)
            continue
        own = {}
        for g in grams(text):
            own[g] = own.get(g, 0) + 1
        logs = [
            math.log(prior[lang] / seen) + sum(n * math.log((counts[lang].get(g, 0) + 0.5) / totals[lang]) for g, n in own.items())
            for lang in languages
        ]
        best = max(range(len(languages)), key=lambda k: logs[k])
        out[doc_id] = (languages[best], 1 / sum(math.exp(x - logs[best]) for x in logs))
    return out


def test_language_query_against_a_plain_version(spark):
    small = "/root/testdata/sf0.001"
    docs = table(spark, small, "documents").select("doc_id", "text", "lang").collect()
    want = plain_languages([(r.doc_id, r.text) for r in docs], {r.doc_id: r.lang for r in docs})
    got = QUERIES["op3_language_id"](spark, small).collect()
    assert len(got) == len(docs)
    for r in got:
        lang, score = want[r.doc_id]
        assert r.lang_pred == lang and abs(r.score - score) < 1e-6
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)

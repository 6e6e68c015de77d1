"""Language vectors and quality rules against plain recomputation; odd rows of packing,
quality, language and sharding."""

import math
import random
import unicodedata

import numpy as np
import pyarrow as pa

from factweave.llm import op01_packing, op04_language, op06_quality, op10_sharding


def _vector(text):
    """The document's vector, one n-gram at a time."""
    symbols = [0]
    for char in text:
        letter = 0
        if unicodedata.category(char)[0] == "L":
            low = char.lower()
            letter = ord(low) if len(low) == 1 else ord(char)
        if letter or symbols[-1]:
            symbols.append(letter)
    symbols += [0] if symbols[-1] else []
    total = np.zeros(op04_language.DIMENSIONS)
    for i in range(len(symbols) - 2):
        if symbols[i + 1]:
            gram = np.ones(op04_language.DIMENSIONS, int)
            for k in range(3):
                gram = gram * np.roll(op04_language._vector(symbols[i + k]).astype(int), k)
            total += gram
    return total


def test_language_vectors():
    random.seed(5)
    texts = ["", "a", "Ab c", "  été über straße, ı İ 日本", "1 2 3", None, "x" * 50, *("".join(random.choices("abc dé,\n1", k=random.randint(1, 60))) for _ in range(60))]
    found, has = op04_language.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        wanted = _vector(text or "")
        assert np.array_equal(found[i], wanted), text
        assert has[i] == any(unicodedata.category(c)[0] == "L" for c in text or "")


def test_language_prediction_is_the_nearest_prototype(spark):
    random.seed(6)
    words = {"aa": "lor ip dol sit amet", "bb": "kun zwei drei vier fun", "cc": "uno dos tres cuatro"}
    rows = [(i, " ".join(random.choices(words[lang].split(), k=9)), lang) for i in range(90) for lang in [sorted(words)[i % 3]]]
    docs = spark.createDataFrame([*rows, *rows[:9], (None, None, "aa"), (1, "x", None)], "doc_id long, text string, lang string")
    prototypes = op04_language.learn(docs)
    plain = {}
    for text, lang in {(t, lang) for _, t, lang in rows}:
        v = _vector(text)
        plain[lang] = plain.get(lang, 0) + v / np.linalg.norm(v)
    learned, prototypes = prototypes, op04_language.prototypes(prototypes)
    assert list(prototypes) == sorted(plain) and all(np.allclose(prototypes[k], plain[k], rtol=1e-4, atol=1e-3) for k in plain)
    test = [(i, " ".join(random.choices([w for v in words.values() for w in v.split()], k=6)), "own") for i in range(40)] + [(None, "lor " * 50_000, "own"), (3, None, "own"), (3, None, "own")]
    found = op04_language.predict(spark.createDataFrame(test, "doc_id long, text string, score string"), learned).collect()
    assert len(found) == len(test) and found[0].__fields__ == ["doc_id", "text", "lang_pred", "score", "cosine"]
    for r in found:
        if r["text"] is None:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        v = _vector(r["text"])
        cosines = {k: v @ p / np.linalg.norm(v) / np.linalg.norm(p) for k, p in plain.items()}
        assert cosines[r["lang_pred"]] >= max(cosines.values()) - 1e-5
        share = math.exp(op04_language.SCALE * max(cosines.values())) / sum(math.exp(op04_language.SCALE * c) for c in cosines.values())
        assert abs(r["score"] - share) < 1e-2 and abs(r["cosine"] - max(cosines.values())) < 1e-4


def test_six_hundred_languages_in_blocks(spark, monkeypatch):
    """None is left out, and blocks of prototypes and flushed sums change nothing."""
    random.seed(8)
    words = {f"l{i:03d}": ["".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(6)] for i in range(600)}
    docs = spark.createDataFrame([(i * 10 + k, " ".join(random.choices(w, k=8)), lang) for i, (lang, w) in enumerate(words.items()) for k in range(2)], "doc_id long, text string, lang string")
    learned = op04_language.learn(docs)
    whole = {r["doc_id"]: tuple(r)[3:] for r in op04_language.predict(docs, learned).collect()}
    assert learned.count() == 600 and {r["lang_pred"] for r in op04_language.predict(docs, learned).select("lang_pred").distinct().collect()} == set(words)
    monkeypatch.setattr(op04_language, "BLOCK", 70)
    monkeypatch.setattr(op04_language, "BROADCAST_LANGUAGES", -1)
    again = op04_language.learn(docs)
    for r in op04_language.predict(docs, again).collect():
        lang, score, cosine = whole[r["doc_id"]]
        assert r["lang_pred"] == lang == r["lang"] and abs(r["score"] - score) < 1e-3 and abs(r["cosine"] - cosine) < 1e-5


def test_quality_rules_equal_a_plain_reading(spark):
    random.seed(7)
    rows = [(i, " ".join(random.choices("the house of water and light THE! 12".split(), k=random.randint(2, 40))) + ("." if i % 2 else " $$$ BUY"), i % 2) for i in range(160)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, 1), (None, 1), (4, None)], "doc_id long, quality int")
    ensemble = op06_quality.learn(docs, labels)
    assert ensemble == op06_quality.learn(docs.union(docs).repartition(5), labels.union(labels))
    odd = spark.createDataFrame([(1, "The house. " * 60_000, "a", 1), (1, None, "a", 1), (1, None, "a", 1), (None, "", "a", 1), *[(i, t, "a", 1) for i, t, _ in rows[:60]]], "doc_id long, text string, score string, chars int")
    found = op06_quality.score(odd, ensemble).collect()
    assert len(found) == 64 and found[0].__fields__ == ["doc_id", "text", "chars", "score", "predicted"]
    for r in found:
        x = op06_quality.measure(pa.array([r["text"]], pa.string()))[0]
        total = ensemble.intercept
        for rule, weight in ensemble.rules:
            if all((x[k] > threshold) == above for k, above, threshold in rule):
                total += weight
        assert abs(r["score"] - 1 / (1 + math.exp(-total))) < 1e-9 and r["predicted"] == int(r["score"] >= 0.5)
    assert op06_quality.score(odd.limit(0), ensemble).collect() == []


def test_packing_odd_rows(spark):
    path = op01_packing.default_tokenizer()
    rows = [(None, "no key", "s"), (1, "twice", "s"), (1, "twice", "s"), (2, None, "s"), (3, "", "s"), (4, "long words here " * 40_000, "s")]
    pieces = op01_packing.pack(spark.createDataFrame(rows, "doc_id long, text string, sequence_id string"), path).collect()
    total = {}
    for p in pieces:
        total[p["doc_id"]] = total.get(p["doc_id"], 0) + p["length"]
        assert p["offset"] + p["length"] <= 1024
    one = {p["doc_id"]: p["doc_tokens"] for p in pieces}
    assert total[1] == 2 * one[1] and total[2] == total[3] == 1 and total[4] == one[4] > 100_000 and None in total
    places = sorted((p["sequence_id"], p["offset"], p["length"]) for p in pieces)
    for (s, o, n), (t, q, _) in zip(places, places[1:]):
        assert (t, q) == (s, o + n) if s == t else q == 0


def test_sharding_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a", 9), (None, None, 9)], "doc_id long, shard string, slot int")
    assert op10_sharding.place(docs.limit(0), ["a", "b"], size=101).collect() == []
    found = op10_sharding.place(docs, ["a"], size=101).collect()
    assert {r["shard"] for r in found} == {"a"} and found[0].__fields__ == ["doc_id", "slot", "shard"]

"""Packing, language, HTML, quality, lines, decontamination, toxicity and sharding."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from factweave.llm import op01_packing, op02_toxicity, op04_language, op05_html, op06_quality, op07_lines, op08_fmindex, op10_sharding

ODD = [None, "", " ", "'s it's 'tis don't <|endoftext|> a", "\n\n  two  spaces \t\n x", "日本語 текст 123 ½ ²x", "😀😀 a b c", "x" * 5000, "a b " * 3000, "\r\n!?'ll  'S"]


def _docs(spark, texts, extra=""):
    return spark.createDataFrame([(i, t, "zz", 0) for i, t in enumerate(texts)], "doc_id long, text string, ids string, n_words int")


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    random.seed(1)
    texts = ODD + [" ".join(random.choice(["ab", "Cde", "f,g", "12"]) for _ in range(random.randint(0, 900))) for _ in range(60)]
    path = op01_packing.default_tokenizer()
    pieces = op01_packing.pack(_docs(spark, texts).repartition(3), path, window=64).collect()
    whole = Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        mine = sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"])
        ids = np.concatenate([np.frombuffer(p["ids"], "<u4") for p in mine])
        assert ids.tolist() == whole.encode(text or "", add_special_tokens=False).ids + [0]
        assert [p["start"] for p in mine] == np.cumsum([0] + [p["length"] for p in mine])[:-1].tolist()
        assert all(p["doc_tokens"] == len(ids) for p in mine)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    padding = 0
    for parts in sequences.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0] + [n for _, n in sorted(parts)])[:-1].tolist()
        used = sum(n for _, n in parts)
        assert used <= 64
        padding += 0 if used & (used - 1) == 0 else 64 - used
    assert padding == 0
    digest = op01_packing.with_crc32(op01_packing.pack(_docs(spark, ["hello world now"]), path)).first()
    assert digest["ids_crc32"] == zlib.crc32(np.asarray(whole.encode("hello world now", add_special_tokens=False).ids + [0], "<u4").tobytes())
    assert op01_packing.pack(_docs(spark, ["x"]).limit(0), path).collect() == []


def test_least_squares_uses_only_what_is_there():
    histogram = np.zeros(32, np.int64)
    histogram[[5, 27, 10, 22, 16, 8]] = [7, 5, 3, 9, 4, 6]
    patterns = op01_packing.combinations(histogram)
    repeats = op01_packing.solve(histogram, patterns)
    used = Counter()
    for p, n in zip(patterns, repeats.tolist(), strict=True):
        for r in p:
            used[r] += n
    assert repeats.sum() > 0 and all(used[r] <= histogram[r] for r in used)
    assert all(sum(p) == 32 or len(p) == 1 for p in patterns)


def test_language(spark):
    words = {"en": "the and of with that this water house", "de": "der und die mit dass dieses wasser haus straße"}
    random.seed(3)
    rows = [(i, " ".join(random.choices(words[lang].split(), k=12)), lang) for i in range(80) for lang in [("en", "de")[i % 2]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    prototypes = op04_language.learn(docs.where("doc_id < 60"))
    found = op04_language.predict(docs.where("doc_id >= 60"), prototypes).collect()
    assert all(r["lang_pred"] == r["lang"] and 0 <= r["score"] <= 1 for r in found)
    odd = op04_language.predict(_docs(spark, [*ODD, "123 !", "der"]), prototypes).collect()
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in odd}
    assert by[0] == by[1] == by[2] == by[10] == ("und", 0.0) and by[11][0] == "de" and len(odd) == 12
    assert op04_language.learn(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in op04_language.predict(docs, op04_language.learn(docs.limit(0))).collect()} == {"und"}


PAGE = """<!DOCTYPE html><html lang=en><head><title>T</title><script>var t="</p>";</script></head><body class="has-sidebar">
<header><a href=/>Home</a></header><nav><ul><li><a href=/a>A</a></li></ul></nav><div class="cookie-notice">We use cookies.</div><!-- x -->
<article><header><h1>Big &amp; bold</h1></header><p>First <b>para</b>graph&nbsp;here<br>and more.<p>Unclosed one &lt;tag&gt; &eacute;<p>Short.
<form><input><label>Mail</label></form><aside>Related</aside><div class="ad">Buy</div><section class="comments"><p>Nice post!</p></section></article>
<footer>&copy; x</footer>"""


def test_html():
    assert op05_html.main_text(PAGE) == "Big & bold First paragraph here and more. Unclosed one <tag> é Short."
    assert op05_html.main_text(None) == op05_html.main_text("") == op05_html.main_text("<p>") == ""
    assert op05_html.main_text("<article><p>cut &am") == "cut &am"
    plain = "<div><p>" + "the cat and the dog of the house " * 10 + "</p><p>Yes.</p></div><div><a href=x>more</a> <a href=y>links</a></div>"
    assert op05_html.main_text(plain).endswith("house Yes.")
    for bad in ("<", "<<<>>", "</p></p>", "<script>", "<!--", "<p class='x", "a < b", "<svg/><p>hi"):
        op05_html.main_text(bad)


def test_html_open_head():
    for start in ("<html><head><title>x</title><meta charset=utf-8>", "<head><link rel=x><style>p {}</style>\n", "<html><head><title>x</title><html>"):
        assert op05_html.main_text(start + "<body><article><p>Hello there.</p></article></body></html>") == "Hello there."
        assert op05_html.main_text(start + "<article><p>Hello there.</p></article>") == "Hello there."
        assert op05_html.main_text(start + "<svg></svg><main>Hello there.</main>") == "Hello there."
    words = "the cat and the dog of the house " * 10
    assert op05_html.main_text("<head><title>x</title>" + words) == words.strip()


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "t"), (2, None, None, "t")], "page_id long, url string, html string, text string")
    found = {r["page_id"]: r for r in op05_html.extract(pages).collect()}
    assert found[2]["text"] == "" and found[1]["n_chars"] == len(found[1]["text"])


def test_quality(spark):
    random.seed(2)
    rows = [(i, " ".join(random.choices("the house of water and light".split(), k=40)) + "." if i % 2 else "BUY!!! $$$ " * 30, i % 2) for i in range(240)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 180], "doc_id long, quality int")
    ensemble = op06_quality.learn(docs, labels)
    assert ensemble.rules and len(ensemble.rules) < 60
    found = op06_quality.score(docs, ensemble).where("doc_id >= 180").collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in found)
    odd = op06_quality.score(_docs(spark, ODD), ensemble).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 for r in odd)
    assert op06_quality.learn(docs.limit(0), labels).rules == ()


def test_toxicity(spark):
    random.seed(4)
    plain = [f"word{i}" for i in range(50)]
    rows = [(i, " ".join(random.choices(plain, k=20) + (["vilest"] if i % 4 == 0 else [])), int(i % 4 == 0), int(i % 8 != 0)) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t, q) for i, _, t, q in rows if i < 300], "doc_id long, toxic int, quality int")
    chain = op02_toxicity.learn(docs, labels, op02_toxicity.categories())
    assert chain.categories == ("low_quality", "toxic", "toxic_low_quality") and len(chain.models[2].chained) == 2
    found = op02_toxicity.score(docs, chain).where("doc_id >= 300").collect()
    assert all((r["toxic"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in found)
    odd = op02_toxicity.score(_docs(spark, ODD), chain).collect()
    assert len(odd) == len(ODD) and all(0 <= r["toxic"] <= 1 for r in odd)


def _lost(texts, least):
    lines = {i: [x.strip(" \t\r\x0b\f") for x in (t or "").split("\n")] for i, t in texts.items()}
    kept = {i: [(k, x) for k, x in enumerate(v) if x] for i, v in lines.items()}
    order = {i: n for n, i in enumerate(sorted(texts))}
    out = defaultdict(set)
    for i in texts:
        for j in range(len(kept[i])):
            best = 0
            for a in texts:
                for b in range(len(kept[a])):
                    if (order[a], b) >= (order[i], j):
                        continue
                    n = 0
                    while j + n < len(kept[i]) and b + n < len(kept[a]) and kept[i][j + n][1] == kept[a][b + n][1]:
                        n += 1
                    best = max(best, n)
            if sum(len(x.split()) for _, x in kept[i][j : j + best]) >= least:
                out[i] |= {k for k, _ in kept[i][j : j + best]}
    return out


def test_repeated_lines(spark):
    random.seed(6)
    pool = [" ".join(random.choices("ab cd ef gh".split(), k=random.randint(1, 4))) for _ in range(6)]
    texts = {i: "\n".join(random.choice(pool + ["", f"own {i}"]) for _ in range(random.randint(0, 14))) for i in range(25)}
    texts |= {30: texts[3], 31: None, 32: "", 33: "x\n" * 40, 34: " a b c d e f g h \r\n", 35: "a b c d e f g h"}
    docs = spark.createDataFrame([(i, t, 7) for i, t in texts.items()], "doc_id long, text string, removed int")
    for least in (6, 12):
        found = {r["doc_id"]: r for r in op07_lines.remove_repeats(docs, min_words=least).collect()}
        lost = _lost(texts, least)
        assert set(found) == set(texts)
        for i, text in texts.items():
            ranges = found[i]["removed"]
            inside = {k for k, x in enumerate((text or "").split("\n")) if x.strip() and any(r["first"] <= k <= r["last"] for r in ranges)}
            assert inside == lost[i], i
            left = [x for k, x in enumerate((text or "").split("\n")) if not any(r["first"] <= k <= r["last"] for r in ranges)]
            assert found[i]["text"] == ("\n".join(left) if ranges else text)
    assert op07_lines.remove_repeats(docs.limit(0)).collect() == []


def test_suffixes_and_search():
    rng = np.random.default_rng(1)
    text = rng.integers(1, 4, 400)
    text[200:300] = text[50:150]
    index = op08_fmindex.FMIndex(text, 4)
    listed = text.tolist()
    assert op08_fmindex._suffixes(np.append(text, 0)).tolist() == sorted(range(401), key=lambda i: listed[i:] + [0])
    for n in (1, 2, 5, 9):
        for at in range(0, 380, 37):
            phrase = text[at : at + n]
            low, high = index.search(phrase[None, :], np.asarray([n]))
            want = [i for i in range(401 - n) if listed[i : i + n] == phrase.tolist()]
            assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


def test_contamination(spark, monkeypatch):
    monkeypatch.setattr(op08_fmindex, "SHARD_WORDS", 50)
    random.seed(8)
    vocabulary = [f"v{i}" for i in range(30)]
    items = [(0, " ".join(random.choices(vocabulary, k=14))), (1, "v1 v2"), (2, None), (3, "!!"), (10, " ".join(random.choices(vocabulary, k=10)))]
    texts = [" ".join(random.choices(vocabulary, k=30)) for _ in range(20)]
    texts += [items[0][1].upper() + "; tail", "x " + items[4][1] + " " + items[0][1] + " y v1-v2", None, "", items[0][1]]
    docs = _docs(spark, texts)
    bench = spark.createDataFrame(items, "item_id long, text string")

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(i)
    wanted = {}
    for d, t in enumerate(texts):
        w, hit, found = words(t), set(), set()
        for x, owners in windows.items():
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit |= set(range(k, k + len(x)))
                    found |= owners
        wanted[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit))
    for most in (2_000_000, 40):
        monkeypatch.setattr(op08_fmindex, "MOST_WORDS", most)
        found = op08_fmindex.digest(op08_fmindex.contamination(docs, bench)).collect()
        assert {r["doc_id"]: tuple(r)[1:] for r in found} == wanted
    cut = {r["doc_id"]: r["text"] for r in op08_fmindex.remove_spans(docs, bench).collect()}
    assert cut[20] == "; tail" or cut[20] == "tail"
    assert cut[21] == "x y" and cut[22] is None and cut[24] == ""
    assert op08_fmindex.contamination(docs, bench.limit(0)).where("size(spans) > 0").count() == 0


def test_sharding(spark):
    table = op10_sharding.lookup_table(["a", "b", "c"], 101)
    share = Counter(table)
    assert len(table) == 101 and max(share.values()) - min(share.values()) <= 1
    more = op10_sharding.lookup_table(["a", "b", "c", "d"], 101)
    assert sum(x != y and y != 3 for x, y in zip(table, more, strict=True)) < 25
    heavy = Counter(op10_sharding.lookup_table(["a", "b"], 101, [3, 1]))
    assert heavy[0] > 2.5 * heavy[1]
    with pytest.raises(ValueError):
        op10_sharding.lookup_table(["a"], 100)
    docs = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y"), (2, None)], "doc_id long, shard string")
    found = op10_sharding.place(docs, ["a", "b", "c"], size=101).collect()
    assert len(found) == 4 and len({r["shard"] for r in found if r["doc_id"] == 1}) == 1 and set(found[0].asDict()) == {"doc_id", "slot", "shard"}


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    from factweave.llm._store import written

    random.seed(9)
    base = " ".join(f"word{random.randint(0, 500)}" for _ in range(80))
    run = "\n".join(" ".join(f"line{k}w{j}" for j in range(20)) for k in range(4))
    texts = [base, base.replace("word1 ", "wordx "), run + "\nfirst own", "second own\n" + run, "12345", None, " ".join(f"bench{i}" for i in range(12)) + " rest of the text", *[f"clean text number {i} of many here" for i in range(5)]]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(0, " ".join(f"bench{i}" for i in range(12)))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, str(tmp_path)))
        left[name] = docs
    kept = {r["doc_id"]: r["text"] for r in left["benchmark decontamination"].collect()}
    assert 4 not in kept and 5 not in kept and kept[3] == "second own" and kept[6] == "rest of the text"
    assert all(kept[i] == texts[i] for i in range(7, 12))
    assert left["benchmark decontamination"].columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} == set(kept)


def test_registered_queries_give_rows(spark):
    from factweave.llm import registry

    folder = "/root/testdata/sf0.001"
    for name in ("op2_toxicity", "op6_quality", "op7_lines", "op10_sharding"):
        found = registry.llm_queries()[name](spark, folder)
        assert found.count() == spark.read.parquet(f"{folder}/documents.parquet").count()

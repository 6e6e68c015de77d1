"""Spelling variants against all pairs, and odd rows."""

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from factweave.llm import op11_spelling as op


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _expected(docs):
    counts = Counter()
    for key, text in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if _one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def _found(spark, docs):
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id long, text string, word string, n int")
    rows = op.variants(frame).collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_all_pairs_of_words_with_few_letters(spark):
    # Two or three letters: bigrams repeat inside words, and most are as rare as each other.
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abé"[: 2 + i % 2]), rng.integers(4, 9))) for i in range(500)]
    docs = [(i, " ".join(words[j] for j in np.minimum(rng.geometric(0.01, 60) - 1, 499))) for i in range(120)]
    want = _expected(docs)
    assert len(want) > 150 and sum(v[0] is not None for v in want.values()) > 50
    assert _found(spark, docs) == want


def test_prefix_filter_loses_no_pair(spark):
    rng = np.random.default_rng(2)
    words = {"".join(rng.choice(list("abc"), n)) for n in (5, 6, 7) for _ in range(130)} | {"ababab", "ababa", "bababab", "aaaaa", "aaaaaa", "aaaaaaa"}
    frame = spark.createDataFrame([(w, int(rng.integers(3, 99))) for w in words], "word string, n long")
    found = [frozenset((r["a"], r["b"])) for r in op.near(frame).collect()]
    want = {frozenset((a, b)) for a in words for b in words if _one_edit(a, b)}
    assert len(found) == len(set(found)) and set(found) == want and len(want) > 300


def test_chains_of_forms_reach_their_end(spark):
    chain = [("abcdefgh"[:5] + "x" * i, 3 * 2**i) for i in range(8)]
    docs = [(None, f"{w} " * n) for w, n in chain]
    assert _found(spark, docs) == _expected(docs)
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(100)], "word string, form string")
    assert {r["root"] for r in op.roots(forms).collect()} == {"w100"}


def test_only_the_frequencies_of_bigrams_are_broadcast(spark, monkeypatch):
    plans, name = [], "spark.sql.autoBroadcastJoinThreshold"
    old, store = spark.conf.get(name), op.written
    plan = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or store(df)
    monkeypatch.setattr(op, "written", plan)
    spark.conf.set(name, "1g")
    try:
        out = op.variants(spark.createDataFrame([(1, "colour color colours " * 9)], "doc_id long, text string"))
        plans.append(out._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.set(name, old)
    assert sum("SortMergeJoin" in p for p in plans) >= 4
    # The one table that is broadcast has a row for each bigram.
    assert [p.count("BroadcastHashJoin") for p in plans if "BroadcastHashJoin" in p] == [1]


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "ÉTUDE Étude étude " * 9), (None, "colour, COLOUR; colour×colour÷"), (4, "color " * 20), (4, "color " * 20), (5, "1234 ---"), (6, "longword" * 20_000), (7, "longword" * 20_000), (8, "longword" * 20_000 + " word" * 100_000)]
    assert _found(spark, docs) == _expected(docs)
    assert _found(spark, docs[:2]) == {}
    assert _found(spark, []) == {}


def test_query_and_letters(spark):
    assert op.variants(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).where(~F.col("word").rlike("^[a-zÀ-ÿ]{5,}$")).count() == 0

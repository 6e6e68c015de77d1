"""The similarity join against all pairs, and scores against a plain table."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from factweave.functions import lcs
from factweave.operators import resolve
from factweave.operators import similarity as S


def _common(x, y):
    row = [0] * (len(y) + 1)
    for c in x:
        diagonal = 0
        for j, d in enumerate(y, 1):
            above = row[j]
            row[j] = diagonal + 1 if c == d else max(above, row[j - 1])
            diagonal = above
    return row[-1]


def _ratio(a, b):
    x, y = (" ".join(sorted(t.split())) for t in (a, b))
    return 100.0 if not x and not y else 200.0 * _common(x, y) / (len(x) + len(y))


def test_common_lengths_of_short_and_long_texts():
    random.seed(1)
    texts = ["", "a", "日本é", "ab" * 40, *("".join(random.choices("abcé", k=random.randint(0, n))) for n in (5, 30, 64, 65, 130, 200) for _ in range(15))]
    pairs = [(random.choice(texts), random.choice(texts)) for _ in range(300)]
    found = lcs.common_lengths(pa.array([a for a, _ in pairs]), pa.array([b for _, b in pairs]))
    assert found.tolist() == [_common(a, b) for a, b in pairs]


def _names(n):
    random.seed(n)
    parts = ["".join(random.choices("abcdefghijklmnop", k=random.randint(2, 8))) for _ in range(40)]
    out = set()
    while len(out) < n:
        name = " ".join(random.choices(parts, k=random.randint(1, 3)))
        if random.random() < 0.5:
            at = random.randrange(len(name))
            name = name[:at] + random.choice("abcx ") + name[at + random.randint(0, 1) :]
        out.add(name)
    return sorted(out)


@pytest.mark.parametrize("threshold", [55.0, 70.0, 80.0, 85.0, 95.0, 100.0])
def test_no_pair_is_lost(spark, threshold):
    names = _names(160)
    rows = [(n, "xy"[i % 2]) for i, n in enumerate(names)] + [(names[0], "x"), (None, "x"), ("?", None), ("aaaaaa", "x"), ("aaaa", "x"), ("ababab", "x"), ("bababa", "x")]
    found = {(r["family"], r["a"], r["b"]): r["score"] for r in S.similar_names(spark.createDataFrame(rows, "name string, family string"), threshold).collect()}
    want = {}
    for family in "xy":
        own = sorted({n for n, f in rows if f == family and n is not None})
        want |= {(family, a, b): _ratio(a, b) for i, a in enumerate(own) for b in own[i + 1 :] if _ratio(a, b) >= threshold}
    assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-9 for k in want)


def test_names_without_words_are_alike(spark):
    frame = spark.createDataFrame([(n, "x") for n in ("", " ", "  ", "a")], "name string, family string")
    assert {(r["a"], r["b"]) for r in S.similar_names(frame).collect()} == {("", " "), ("", "  ")}


def test_what_meets_grows_with_what_is_alike(spark):
    met = []
    for n in (400, 1_600):
        random.seed(n)
        names = ["".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=14)) for _ in range(n)]
        names += [x[:5] + "#" + x[6:] for x in names[: n // 4]]
        frame = spark.createDataFrame([(x, "x") for x in names], "name string, family string")
        pairs = S.candidates(frame, 85.0)
        met.append(pairs.count())
        assert pairs.where(F.col("a") >= F.col("b")).count() == 0
    # Four times the names give four times the alike pairs; all pairs would be 16 times as many.
    assert met[0] < 0.02 * 500**2 and met[1] < 0.02 * 2_000**2


@pytest.mark.parametrize("threshold", [55.0, 70.0, 85.0])
def test_components_of_names_are_those_of_all_pairs(spark, threshold):
    names = _names(130)
    rows = [(n, "xy"[i % 2]) for i, n in enumerate(names)] + [("", "x"), (" ", "x"), ("q", None), ("r", None), (None, "x")]
    least = {}
    for family in "xy":
        own = sorted({n for n, f in rows if f == family and n is not None})
        least |= {(family, n): n for n in own}
        links = [(a, b) for i, a in enumerate(own) for b in own[i + 1 :] if _ratio(a, b) >= threshold]
        for _ in own:
            for a, b in links:
                least[family, a] = least[family, b] = min(least[family, a], least[family, b])
    found = {(r["family"], r["name"]): r["component"] for r in S.kin(spark.createDataFrame(rows, "name string, family string"), threshold).collect()}
    size = Counter((f, c) for (f, _), c in least.items())
    assert found == {k: c for k, c in least.items() if size[k[0], c] > 1} and len({c for c in found.values()}) > 1


def test_a_family_of_names_that_are_all_alike_is_not_compared_pair_by_pair(spark, monkeypatch):
    met, score = [], S.scored
    monkeypatch.setattr(S, "scored", lambda pairs, *names: met.append(pairs.count()) or score(pairs, *names))
    rows = [(f"e{i}", f"Supplier#{i * 7:09d}", "organization", "", i) for i in range(700)]
    frame = spark.createDataFrame(rows, "entity_id string, name string, family string, context string, ord long")
    assert {r["proposal"] for r in resolve.proposals(frame, 70.0).collect()} == {"supplier#000000000"}
    # All pairs would be 244,650.
    assert met and sum(met) < 20_000

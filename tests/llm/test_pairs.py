"""Near-duplicate operators against brute force on small fixtures."""

import random
import re

import numpy as np
import pytest

from factweave.llm import op03_setsketch, op09_subspace
from factweave.llm._graph import _in_one_task, components
from factweave.llm import _graph


def _shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def _components(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def _texts():
    random.seed(5)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(90):  # copies near the threshold of one text
        words = base[:]
        for _ in range(random.randint(0, 5)):
            words[random.randrange(60)] = f"x{random.randint(0, 999)}"
        texts[i] = " ".join(words)
    for i in range(90, 120):
        texts[i] = " ".join(f"w{random.randint(0, 400)}" for _ in range(random.randint(1, 80)))
    texts |= {120: texts[3], 121: texts[3].upper(), 122: None, 123: "", 124: "one", 125: "ONE", 126: " \t ", 127: "été  x", 128: "É été", 129: texts[90] + " " + texts[90]}
    return texts


@pytest.mark.parametrize("block", [512, 16])
def test_setsketch_components(spark, monkeypatch, block):
    monkeypatch.setattr(op03_setsketch, "BLOCK", block)
    texts = _texts()
    docs = spark.createDataFrame([(i, t, "n") for i, t in texts.items()], "doc_id long, text string, n string")
    found = {r["doc_id"]: r for r in op03_setsketch.near_duplicates(docs, shingle=2).collect()}
    sets = {i: _shingles(t, 2) for i, t in texts.items()}
    wanted = _components(list(texts), lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    assert {i: found[i]["n_shingles"] for i in texts} == {i: len(s) for i, s in sets.items()}
    assert {i: found[i]["component_id"] for i in texts} == wanted
    assert all(found[i]["kept"] == (wanted[i] == i) for i in texts)


def test_setsketch_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert op03_setsketch.near_duplicates(none).collect() == []
    rows = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, "a b c")], "doc_id long, text string")
    found = sorted(op03_setsketch.near_duplicates(rows).collect(), key=str)
    assert len(found) == 4 and {r["component_id"] for r in found} == {1, None}


def test_setsketch_key_of_several_texts(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, one), (2, two), (5, one + " x"), (5, two + " y"), (5, None), (5, "alone"), (6, two + " z"), (7, ""), (8, "other"), (None, one), (None, "")]
    found = op03_setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    assert sorted(((r["doc_id"], r["n_shingles"]) for r in found), key=str) == sorted(((i, len(_shingles(t, 2))) for i, t in rows), key=str)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in found} == {(1, 1, True), (2, 1, False), (5, 1, False), (6, 1, False), (7, 7, True), (8, 8, True), (None, None, False)}


def test_setsketch_shared_keys(spark):
    rows = [(str(i if i < 90 else i % 100), t) for i, t in _texts().items()]
    rows += [("40", t) for _, t in rows[100:]]
    found = op03_setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id string, text string"), shingle=2).collect()
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(_shingles(t, 2))
    wanted = _components(sorted(sets), lambda a, b: any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]))
    assert len(found) == len(rows)
    assert {(r["doc_id"], r["component_id"]) for r in found} == set(wanted.items())


def test_sketch_merges():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (300, 200))
    both = np.unique(np.concatenate([a, b]))
    one, two, union = (op03_setsketch.registers(x, np.asarray([0, len(x)])) for x in (a, b, both))
    assert (op03_setsketch.merge(one, two) == union).all()
    overlap = np.unique(np.concatenate([a[:250], b]))
    left, right = op03_setsketch.registers(a, np.asarray([0, len(a)])), op03_setsketch.registers(overlap, np.asarray([0, len(overlap)]))
    more, less = op03_setsketch._counts(left, right)
    true = len(np.intersect1d(a, overlap)) / len(np.union1d(a, overlap))
    assert abs(op03_setsketch.estimate(more, less, np.asarray([len(a)]), np.asarray([len(overlap)]))[0] - true) < 0.12


def test_components_agree(spark, monkeypatch):
    random.seed(2)
    pairs = [(random.randint(0, 60), random.randint(0, 60)) for _ in range(40)] + [(5, 5)]
    edges = spark.createDataFrame(pairs, "u long, v long")
    small = {r["id"]: r["component"] for r in components(edges).collect()}
    monkeypatch.setattr(_graph, "SMALL", -1)
    assert {r["id"]: r["component"] for r in components(edges).collect()} == small
    ids = sorted({x for p in pairs for x in p if p[0] != p[1]})
    linked = {frozenset(p) for p in pairs}
    assert _components(ids, lambda a, b: frozenset((a, b)) in linked) == small
    assert _in_one_task(_graph._canonical(edges.where("u < 0"))).collect() == []


@pytest.mark.parametrize("chunk", [8_192, 9])
def test_subspace_links(spark, monkeypatch, chunk):
    monkeypatch.setattr(op09_subspace, "CHUNK", chunk)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 16))
    vectors = [(base[i % 12] + rng.normal(size=16) * (0.05 + 0.03 * (i % 10))).astype(np.float32).tolist() for i in range(80)]
    vectors += [vectors[0], vectors[0], [2 * x for x in vectors[1]]]
    odd = [None, [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [], [1.0, 0.0], [0.99, 0.01]]
    rows = list(enumerate(vectors + odd))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {r["vec_id"]: r for r in op09_subspace.linked(frame).collect()}
    good = {i: np.asarray(v, np.float32).astype(float) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}

    def linked(a, b):
        if a not in good or b not in good or len(good[a]) != len(good[b]):
            return False
        return good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= 0.9

    ids = [i for i, _ in rows]
    assert {i: found[i]["component_id"] for i in ids} == _components(ids, linked)
    assert {i: found[i]["n_links"] for i in ids} == {i: sum(linked(i, j) for j in ids if j != i) for i in ids}
    assert op09_subspace.linked(frame.limit(0)).collect() == []


def test_subspace_keys_repeat(spark):
    import duckdb

    from factweave.llm import oracles

    rng = np.random.default_rng(7)
    base = rng.normal(size=(5, 8))
    rows = [(int(i % 17) if i % 9 else None, (base[i % 5] + rng.normal(size=8) * 0.25).astype(np.float32).tolist()) for i in range(60)]
    rows += [(1, [0.0, 1.0]), (2, [1.0, 0.01]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0]), (4, None), (4, [0.0, 0.0]), (4, [0.0, 2.0])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, component_id string, n_links int")
    found = sorted((tuple(r) for r in op09_subspace.linked(frame).collect()), key=str)
    duck = duckdb.connect()
    duck.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    duck.executemany("INSERT INTO embeddings VALUES (?, ?)", [list(r) for r in rows])
    assert found == sorted(duck.execute(oracles.OP9).fetchall(), key=str)


def test_subspace_counts_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(op09_subspace, "CHUNK", 150)
    rng = np.random.default_rng(8)
    centre = rng.normal(size=64)
    vectors = (centre + rng.normal(size=(420, 64)) * 0.33).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    found = {r["vec_id"]: r["n_links"] for r in op09_subspace.linked(frame).collect()}
    wide = vectors.astype(float)
    unit = wide / np.linalg.norm(wide, axis=1)[:, None]
    wanted = (unit @ unit.T >= 0.9).sum(1) - 1
    assert 1_000 < wanted.sum() < 170_000 and [found[i] for i in range(420)] == wanted.tolist()

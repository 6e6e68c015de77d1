"""Maximal runs of lines, and odd documents."""

import random

from factweave.llm import op07_lines as op


def _lines(text):
    return [x for x in (s.strip(op.BLANK) for s in (text or "").split("\n")) if x]


def test_runs_are_copies_and_maximal(spark):
    random.seed(21)
    pool = [" ".join(random.choices("ab cd ef gh".split(), k=random.randint(1, 4))) for _ in range(8)]
    texts = {i: "\n".join(random.choice([*pool, "", f"own {i}"]) for _ in range(random.randint(0, 16))) for i in range(30)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    runs = op.repeated_runs(docs, min_words=6)[0].collect()
    assert runs
    seen = set()
    for r in runs:
        mine, source = _lines(texts[r["doc"]]), _lines(texts[r["first"]["doc"]])
        n = r["end"] - r["start"] + 1
        copied = mine[r["start"] : r["end"] + 1]
        assert copied == source[r["first"]["i"] : r["first"]["i"] + n] and len(copied) == n
        assert sum(len(x.split()) for x in copied) >= 6
        assert (r["first"]["doc"], r["first"]["i"]) < (r["doc"], r["start"])
        key = (r["doc"], r["first"]["doc"], r["start"] - r["first"]["i"])
        # Runs along one source neither overlap nor touch.
        assert all((key, k) not in seen for k in range(r["start"] - 1, r["end"] + 2))
        seen |= {(key, k) for k in range(r["start"], r["end"] + 1)}


def test_lines_of_odd_documents(spark):
    run = "\n".join(" ".join(f"l{k}w{j}" for j in range(12)) for k in range(3))
    rows = [(1, run, "x"), (1, run, "x"), (2, run + "\nown line", "x"), (None, run, "x"), (3, None, "x"), (4, "", "x"), (5, (run + "\n") * 2_000, "x"), (6, "y " * 300_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string")
    found = op.remove_repeats(docs).collect()
    assert len(found) == len(rows) and found[0].__fields__ == ["doc_id", "text", "n_lines", "n_removed", "removed"]
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append(r["text"])
    assert by[1] == [run, run] and by[2] == ["own line"] and by[None] == [run] and by[3] == [None] and by[4] == [""]
    assert by[5] == [""] and by[6] == ["y " * 300_000]
    assert op.remove_repeats(docs.limit(0)).collect() == []

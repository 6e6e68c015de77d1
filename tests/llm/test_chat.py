"""Chat formatting: round trips, spans and digests against plain string code."""

import hashlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from factweave.llm import op13_chat as op

SCHEMA = "conv_id long, turn long, role string, text string, part string"
PIECES = st.lists(st.sampled_from(["</s>", "<s>", "[INST]", "[/INST]", "[SYS] ", " [/SYS]", "[TURN ", "[/TURN]", "<|im_end|>", "\\", "<", "[", "/", "s>", "INST]", " ", "\n", "é", "日本", "a", ""]), max_size=9).map("".join)
ROLES = st.sampled_from(["user", "assistant", "system", "tool", "", "a] [INST]", "user\0", "é"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(ROLES, PIECES), min_size=1, max_size=12), st.data())
def test_round_trip(said, data):
    cuts = sorted({0, *data.draw(st.lists(st.integers(0, len(said) - 1), max_size=3))})
    parts, loss = op.assemble([r for r, _ in said], pa.array([t for _, t in said]), np.asarray(cuts))
    found, learned = [], []
    for part, spans in zip(parts.to_pylist(), loss.to_pylist(), strict=True):
        back = list(op.turns(part))
        found += [(r, t) for r, t, _, _ in back]
        learned += [op.unescaped(part[s["start"] : s["end"]]) for s in spans]
        # No control string is left inside a text.
        assert not any(mark in part[a:b] for _, _, a, b in back for mark in ("</s>", "<s>", "[INST]", "[/INST]", "[SYS]", "[/TURN]", "<|im_end|>"))
        plain = "".join(b + op._PLAIN.sub(lambda m: m[0][:1] + b"\\" + m[0][1:], t.encode()).decode() + e for r, t, _, _ in back for b, e in [[m.decode() for m in op.marks(r)]])
        assert part == plain
    assert found == said
    assert learned == [t for r, t in said if r == "assistant"]


def _expected(rows):
    by = {}
    for conv, turn, role, text, _ in rows:
        by.setdefault(conv, []).append((turn if turn is not None else -(10**9), role or "", text or ""))
    out = {}
    for conv, said in by.items():
        said.sort(key=lambda x: x[0])
        learned = "".join(t for _, r, t in said if r == "assistant")
        out[conv] = (len(said), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in said).encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def _found(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


def test_long_conversation_lies_in_many_parts(spark):
    rows = [(7, i, ["user", "assistant"][i % 2], f"turn {i} </s> é" * 3, "x") for i in range(3_000)] + [(c, i, ["user", "assistant"][i], "[INST] \\ ok", "x") for c in range(8, 60) for i in range(2)]
    parts = op.written(op.formatted(spark.createDataFrame(rows, SCHEMA).drop("part").withColumn("whole", op.F.lit(3)).repartition(5)))
    assert parts.where("conv_id = 7").count() >= 3 and parts.where("whole").count() > 20
    assert _found(op.digests(parts)) == _expected(rows)
    total = {r["conv_id"]: r["n"] for r in parts.groupBy("conv_id").agg(op.F.sum(op.F.length("text")).alias("n")).collect()}
    assert {r["conv_id"]: r["formatted_chars"] for r in op.digests(parts).collect()} == total


def test_odd_rows(spark):
    rows = [(None, 0, "user", "a", "x"), (None, 1, "assistant", "b", "x"), (1, None, None, "first", "x"), (1, 0, "assistant", None, "x"), (1, 1, "assistant", "", "x"), (2, 0, "user", "same", "x"), (2, 0, "user", "same", "x"), (3, 0, "tool", "long " * 400_000, "x")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert _found(op.digests(op.formatted(frame))) == _expected(rows)
    assert op.digests(op.formatted(frame.limit(0))).collect() == []


def test_ties_are_in_one_order(spark):
    rows = [(1, 0, r, t, "x") for r in ("user", "assistant") for t in ("b", "a")]
    first = _found(op.digests(op.formatted(spark.createDataFrame(rows, SCHEMA))))
    assert first == _found(op.digests(op.formatted(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3))))


def test_query_reads_every_turn_back(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"], "") for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    rows += [(-1, 0, "user", op.CONTROL, ""), (-1, 1, "assistant", op.CONTROL, "")]
    assert _found(op.op13_chat(spark, folder)) == _expected(rows)

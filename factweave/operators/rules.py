"""Probabilistic facts of assertions, and programs of rules over them: a semi-naive fixpoint
of joins that keeps for each derived term the sets of facts it rests on."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factweave.functions import text as T
from factweave.storage import cut


def noisy_or(p: Column) -> Column:
    """Probability that one of independent causes holds (an aggregate)."""
    below = F.when(p < 1, F.log1p(-p))
    return F.when(F.max(p) >= 1, F.lit(1.0)).otherwise(1 - F.exp(F.sum(below)))


def facts(assertions: DataFrame, fillers: DataFrame, confidences: DataFrame) -> DataFrame:
    """(functor, args, p) of assertions with a named entity filler at least, equal terms
    as one by noisy-or. Arguments stand in order of role and index; the probability is
    the candidate's confidence, 1 where none was given.

    ``assertions`` has (assertion_id, candidate_id, predicate), ``fillers``
    (assertion_id, role_id, filler_index, name), ``confidences`` (candidate_id,
    confidence_score)."""
    named = fillers.where(F.trim("name") != "").groupBy("assertion_id").agg(F.sort_array(F.collect_list(F.struct("role_id", "filler_index", T.logic_atom(F.col("name")).alias("atom")))).alias("f"))
    functor = T.logic_atom(F.replace("predicate", F.lit(":"), F.lit("_")))
    rows = assertions.join(named, "assertion_id").join(confidences, "candidate_id", "left")
    terms = rows.select(functor.alias("functor"), F.transform("f", lambda x: x["atom"]).alias("args"), F.coalesce("confidence_score", F.lit(1.0)).alias("p"))
    return terms.groupBy("functor", "args").agg(noisy_or(F.col("p")).alias("p"))


@dataclass(frozen=True)
class Rule:
    """``head(args) :- body``: names that begin with a capital are variables, others are
    constants; each goal of the body is a functor with arguments, a variable among them at least."""

    head: str
    args: tuple[str, ...]
    body: tuple[tuple[str, tuple[str, ...]], ...]

    def __post_init__(self) -> None:
        bound = {v for _, names in self.body for v in names if _variable(v)}
        missing = [v for v in self.args if _variable(v) and v not in bound]
        if not self.body or missing:
            raise ValueError(f"variables without a goal: {missing}")


def _variable(name: str) -> bool:
    return name[:1].isupper() or name[:1] == "_"


#: Proofs of one term at most whose probability is summed over all their subsets.
MOST_PROOFS = 12
#: Proofs of one term at most that are kept at all.
MOST_KEPT = 1_000
_PROOF = "array<struct<fact: string, p: double>>"


def _goal(rows: DataFrame, functor: str, names: Sequence[str], i: int) -> DataFrame:
    """Bindings of one goal: a column for each variable, and the proof."""
    out = rows.where((F.col("functor") == functor) & (F.size("args") == len(names)))
    first: dict[str, int] = {}
    for k, name in enumerate(names):
        if not _variable(name):
            out = out.where(F.col("args")[k] == F.lit(name))
        elif name in first:
            out = out.where(F.col("args")[k] == F.col("args")[first[name]])
        else:
            first[name] = k
    return out.select(*[F.col("args")[k].alias(v) for v, k in first.items()], F.col("proof").alias(f"_p{i}"))


def _fired(rule: Rule, sources: Sequence[DataFrame]) -> DataFrame:
    """(functor, args, proof) of one rule, each goal read from its own source."""
    out, bound, waiting = None, set(), list(range(len(rule.body)))
    while waiting:
        # Goals that share a variable with those before come first.
        at = next((i for i in waiting if not bound or bound & {v for v in rule.body[i][1] if _variable(v)}), None)
        if at is None:
            raise ValueError(f"{rule.body[waiting[0]][0]} shares no variable with the goals before it")
        waiting.remove(at)
        functor, names = rule.body[at]
        goal = _goal(sources[at], functor, names, at)
        shared = [v for v in dict.fromkeys(names) if v in bound]
        out = goal if out is None else out.join(goal, shared)
        bound |= {v for v in names if _variable(v)}
    proof = F.array_sort(F.array_distinct(F.concat(*[F.col(f"_p{i}") for i in range(len(rule.body))])))
    return out.select(F.lit(rule.head).alias("functor"), F.array(*[F.col(v) if _variable(v) else F.lit(v) for v in rule.args]).alias("args"), proof.alias("proof"))


def _minimal(rows: DataFrame) -> DataFrame:
    """Proofs of each term that hold no other of its proofs."""
    whole = rows.groupBy("functor", "args").agg(F.collect_set("proof").alias("proofs"), F.count_distinct("proof").alias("n"))
    many = F.concat_ws(" ", F.lit("more proofs than are kept, of"), "functor", F.array_join("args", ","))
    sized = whole.withColumn("proofs", F.when(F.col("n") > MOST_KEPT, F.raise_error(many).cast(f"array<{_PROOF}>")).otherwise(F.col("proofs")))
    inside = lambda p: F.exists("proofs", lambda o: (F.size(o) < F.size(p)) & (F.size(F.array_except(o, p)) == 0))
    return sized.withColumn("proofs", F.filter("proofs", lambda p: ~inside(p)))


def proofs(known: DataFrame, program: Sequence[Rule]) -> DataFrame:
    """(functor, args, proofs) of every term that ``known`` (functor, args, p) and the rules
    give; a proof is the set of facts it rests on, and none holds another.

    Rules may be recursive. Each round fires them on what the last one found, so a round
    costs what is new; it ends when nothing is. A term that cycles through itself gains
    nothing by it. Facts with a null probability, functor or arguments are left out, equal
    facts are one by noisy-or. A term of more than MOST_KEPT proofs raises.
    """
    facts_ = known.where(F.col("p").isNotNull() & F.col("functor").isNotNull() & F.col("args").isNotNull()).groupBy("functor", "args").agg(noisy_or(F.col("p")).alias("p"))
    named = F.struct(F.concat("functor", F.lit("("), F.array_join("args", ","), F.lit(")")).alias("fact"), F.col("p").cast("double").alias("p"))
    delta = cut(facts_.select("functor", "args", F.array(named).cast(_PROOF).alias("proof")))
    old, parts = None, [delta]
    while True:
        everything = parts[0]
        for part in parts[1:]:
            everything = everything.union(part)
        fired = None
        for rule in program:
            for i in range(len(rule.body)):
                if old is None and i:
                    continue  # in the first round all is new
                sources = [delta if k == i and old is not None else everything if k >= i or old is None else old for k in range(len(rule.body))]
                found = _fired(rule, sources)
                fired = found if fired is None else fired.union(found)
        if fired is None:
            break
        # What is new for its term, and holds none of the proofs that are known.
        fresh = _minimal(fired.distinct()).select("functor", "args", F.explode("proofs").alias("proof"))
        before = everything.groupBy("functor", "args").agg(F.collect_set("proof").alias("had"))
        held = F.exists("had", lambda o: F.size(F.array_except(o, F.col("proof"))) == 0)
        new = cut(fresh.join(before, ["functor", "args"], "left").where(F.col("had").isNull() | ~held).select("functor", "args", "proof"))
        if new.isEmpty():
            break
        old, delta = everything, new
        parts.append(new)
    return _minimal(everything).select("functor", "args", "proofs")


def probability(proofs_: Column) -> Column:
    """Probability that one of the proofs holds, exactly, proofs sharing facts or not.

    Facts of all proofs are taken out; if what is left shares none, proofs are independent.
    Else the probabilities of all subsets are summed with alternating signs, up to
    MOST_PROOFS proofs; more raise."""
    product = lambda facts: F.aggregate(facts, F.lit(1.0), lambda acc, f: acc * f["p"])
    common = F.aggregate(proofs_, F.element_at(proofs_, 1), F.array_intersect)
    rest = F.transform(proofs_, lambda p: F.array_except(p, common))
    apart = F.size(F.array_distinct(F.flatten(rest))) == F.aggregate(rest, F.lit(0), lambda acc, p: acc + F.size(p))
    independent = 1 - F.aggregate(rest, F.lit(1.0), lambda acc, p: acc * (1 - product(p)))
    # Subset s takes the proofs at the bits of s; pow is exact for these sizes.
    bit = lambda s, i: F.floor(s / F.pow(F.lit(2.0), i)).cast("long") % 2 == 1
    chosen = lambda s: F.array_distinct(F.flatten(F.filter(rest, lambda p, i: bit(s, i))))
    sign = lambda s: F.when(F.bit_count(s) % 2 == 1, 1.0).otherwise(-1.0)
    subsets = F.sequence(F.lit(1).cast("long"), (F.pow(F.lit(2.0), F.size(proofs_)) - 1).cast("long"))
    summed = F.aggregate(subsets, F.lit(0.0), lambda acc, s: acc + sign(s) * product(chosen(s)))
    error = F.raise_error(F.concat(F.lit(f"more than {MOST_PROOFS} proofs share facts: "), F.size(proofs_).cast("string"))).cast("double")
    return product(common) * F.when(apart, independent).when(F.size(proofs_) <= MOST_PROOFS, summed).otherwise(error)


def evaluate(known: DataFrame, program: Sequence[Rule]) -> DataFrame:
    """(functor, args, p, n_proofs) of the terms that the program derives; facts alone are
    left out unless a rule derives them too."""
    heads = list(dict.fromkeys(r.head for r in program))
    found = proofs(known, program).where(F.col("functor").isin(heads))
    return found.select("functor", "args", probability(F.col("proofs")).alias("p"), F.size("proofs").alias("n_proofs"))


def derive(known: DataFrame, head: str, head_args: Sequence[str], body: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Facts (functor, args, p) of one rule ``head(args) :- body``, proofs that share a fact
    taken as such. A head variable that no goal has is an error, and so is a goal without
    a variable in common with the others."""
    rule = Rule(head, tuple(head_args), tuple((f, tuple(names)) for f, names in body))
    if head in {f for f, _ in rule.body}:
        raise ValueError("a recursive rule needs a program")
    return evaluate(known.where(F.col("functor") != head), [rule]).select("functor", "args", "p")

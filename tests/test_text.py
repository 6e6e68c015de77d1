import pytest
from pyspark.sql import functions as F

from factweave.functions import payload
from factweave.functions import text as T


def _one(spark, column, *values):
    names = [f"c{i}" for i in range(len(values))]
    row = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
    return row.select(column(*[F.col(n) for n in names]).alias("x")).first()[0]


@pytest.mark.parametrize(
    ("name", "wanted"),
    [("Gen. John  Smith", "john smith"), ("Lt. Col. Ann Lee", "ann lee"), ("General", "general"), ("vice admiral Bo Ray", "bo ray"), ("Mr. Fox.", "fox"), ("Gen.", "general"), ("  Ada Lovelace, ", "ada lovelace")],
)
def test_normalize_name(spark, name, wanted):
    assert _one(spark, T.normalize_name, name) == wanted


@pytest.mark.parametrize(
    ("name", "rule", "certain"),
    [
        ("they", "pronoun", True), ("groups", "bare generic noun", True), ("These actors", "demonstrative phrase", True), ("their tools", "possessive anaphor prefix", True),
        ("the firm's plan", "possessive anaphor", True), ("Acme's operators", "possessive construction", True), ("the red group", "article + generic noun", False),
        ("a very long lower case phrase that names no one at all here", "long descriptive phrase", False), ("Nobody There Who Uses Many Old Words", "verb-containing phrase", False), ("Acme Corp", "", False),
    ],
)
def test_anaphor(spark, name, rule, certain):
    found = _one(spark, T.anaphor, name)
    assert (found["rule"], found["is_certain"], found["is_anaphor"]) == (rule, certain, bool(rule))


def test_small_expressions(spark):
    assert _one(spark, T.lemma_candidates, "Used") == ["used", "us", "use"]
    assert _one(spark, T.acronym, "North Lake 9 Port") == "NLP"
    assert _one(spark, T.acronym_signatures, "U.S. Special Operations Command") == ["ussocom", "socom"]
    assert _one(spark, T.alias_tokens, "The Office of Sea's end") == ["office", "sea"]
    assert _one(spark, T.type_family, "x:military_base") == "place"
    assert _one(spark, T.name_family, "oc:entity", "Dr. Ann Lee") == "person"
    assert _one(spark, T.name_family, "oc:entity", "Fort Knox") == "place"
    assert _one(spark, T.name_family, "oc:entity", "Harbour Agency") == "organization"
    assert _one(spark, T.logic_atom, "9 Lives!") == "e_9_lives"
    assert _one(spark, T.canonical_json, '{"b": 1.0, "a": "é"}') == '{"a":"\\u00e9","b":1.0}'
    assert _one(spark, T.token_sort_ratio, "b a", "a b") == 100.0
    assert _one(spark, T.person_name, "Capt. J. Doe").asDict() == {"surname": "doe", "given": None, "initial": "j", "surname_only": False, "titled": True}
    assert not _one(spark, T.types_compatible, "Person", "Process")


def test_spans_count_code_points(spark):
    rows = spark.createDataFrame([("😀 ab ab", 2, 4, "ab"), ("abc", 1, 9, "bc")], "t string, a int, b int, s string")
    found = rows.select(payload.span_ok(*[F.col(c) for c in "tabs"]).alias("ok"), payload.locate_span(F.col("t"), F.col("s")).alias("at")).collect()
    assert [r["ok"] for r in found] == [True, False]
    assert [tuple(r["at"]) for r in found] == [(2, 4), (1, 3)]


def test_payload_roles(spark):
    text = '{"b":[{"entity_id":"ent:1"}],"a":[{"kind":"unknown"}],"c":[{"kind":"value","value":"1"}]}'
    roles = F.from_json(F.lit(text), payload.ROLES)
    row = spark.range(1).select(
        payload.normalize_roles(roles)["b"][0]["kind"].alias("kind"), payload.drop_optional_unknown(roles, F.array(F.lit("a"))).alias("kept"),
        payload.rename_roles(roles, {"a": "x", "c": "x"}).alias("named"), payload.roles_are_valid(roles).alias("ok"), payload.role_signature(F.lit("r"), roles["b"][0]).alias("sig"), payload.is_vague(roles["a"][0]).alias("vague"),
    ).first()
    assert row["kind"] == "entity" and sorted(row["kept"]) == ["b", "c"] and row["ok"] and row["vague"]
    assert {k: len(v) for k, v in row["named"].items()} == {"x": 2, "b": 1}
    assert row["sig"] == "r:unknown:ent:1"

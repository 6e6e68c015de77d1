"""Row-local text expressions: names, aliases, digests, references, lemmas."""

from __future__ import annotations

import json

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from factweave.functions import lcs

# Leading title abbreviations and what they stand for.
TITLE_ABBREVIATIONS = {
    "gen.": "general", "lt. gen.": "lieutenant general", "maj. gen.": "major general", "brig. gen.": "brigadier general",
    "col.": "colonel", "lt. col.": "lieutenant colonel", "maj.": "major", "capt.": "captain", "cpt.": "captain",
    "lt.": "lieutenant", "1lt.": "first lieutenant", "2lt.": "second lieutenant", "sgt.": "sergeant",
    "sgt. maj.": "sergeant major", "msgt.": "master sergeant", "ssgt.": "staff sergeant", "cpl.": "corporal",
    "pvt.": "private", "adm.": "admiral", "vadm.": "vice admiral", "radm.": "rear admiral", "cmdr.": "commander",
    "cdr.": "commander", "lcdr.": "lieutenant commander", "ens.": "ensign", "dr.": "doctor", "mr.": "", "mrs.": "",
    "ms.": "", "prof.": "professor", "sen.": "senator", "rep.": "representative", "gov.": "governor",
    "amb.": "ambassador", "sec.": "secretary", "pres.": "president", "hon.": "honorable",
}
# Titles of one and of two words that carry no identity.
TITLES = "general colonel major captain lieutenant sergeant corporal private admiral commander ensign doctor professor senator representative governor ambassador secretary president honorable mister miss sir madam dame".split()
DOUBLE_TITLES = ["lieutenant general", "major general", "brigadier general", "lieutenant colonel", "first lieutenant", "second lieutenant", "sergeant major", "master sergeant", "staff sergeant", "vice admiral", "rear admiral", "lieutenant commander"]
RANKS = "general lieutenant major colonel captain commander admiral sergeant corporal private".split()
# Type slugs of each resolution family, and name hints.
FAMILIES = {
    "person": "person gp_person".split(),
    "organization": "org organization military_organization military_organization_unit government_organization government_agency intelligence_agency educational_institution university civilian_organization combatant_command unit".split(),
    "place": "location place city installation military_installation military_base base facility".split(),
}
PLACE_PREFIXES = ("fort ", "ft ", "camp ", "base ", "station ")
ORGANIZATION_HINTS = "agency bureau center centre command commands committee department directorate division group groups headquarters office organization university unit units".split()
# Words left out of alias tokens, and parts of acronyms.
ALIAS_STOPWORDS = "a an and at for from in of on the to with".split()
COMPOUND_PARTS = {("special", "operations"): "so", ("psychological", "operations"): "po"}
WORD_PARTS = {"agency": "a", "command": "com", "group": "g", "headquarters": "hq", "university": "u"}
# Heads of definite descriptions of organizations, and names of one installation.
DESCRIPTOR_HEADS = "agency bureau command department group office organization unit university".split()
INSTALLATIONS = {"fort bragg": "installation:1", "ft bragg": "installation:1", "fort liberty": "installation:1"}
# Words that refer to something named elsewhere.
PRONOUNS = "it its itself they them their themselves this these those he him his himself she her hers herself we us our ourselves".split()
GENERIC_NOUNS = """group groups actor actors attacker attackers target targets device devices system systems entity entities
organization organizations campaign campaigns operation operations activity activities threat threats initiative initiatives
effort efforts approach approaches strategy strategies convergence dimension format method mechanism vector technique
infrastructure assessment report source sources step steps procedure procedures process processes pattern patterns behavior
behaviors portfolio training material materials capability capabilities tactic tactics tool tools resource resources""".split()
FINITE_VERB = r"(?i)\b(is|are|was|were|has|have|had|uses|used|provides|allows|includes?|conducts?|performs?|operates?|involves?|enables?|relies?|deploys?|targets?|employs?)\b"
# Type families of agents and of processes.
AGENT_TYPES = "Agent CognitiveAgent SentientAgent Organization GovernmentOrganization Corporation MilitaryOrganization PoliticalOrganization EducationalOrganization Person Human".split()
PROCESS_TYPES = "Process IntentionalProcess PhysicalProcess SocialProcess CommunicationAct Transfer Motion Proposition Attribute Relation".split()


def _quoted(words: list[str]) -> str:
    return "|".join(w.replace(".", r"\.") for w in sorted(words, key=len, reverse=True))


def _in(column: Column, words: list[str]) -> Column:
    return column.isin(*words)


def fold(text: Column) -> Column:
    """Key for matching and ordering without regard to case (ASCII and Latin)."""
    return F.lower(text)


def lookup_key(text: Column) -> Column:
    return F.lower(F.trim(text))


def collapse(text: Column) -> Column:
    """Runs of white space as one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normalize_name(name: Column) -> Column:
    """Name for matching: lower case, one leading abbreviation expanded, leading titles
    dropped unless nothing else is there, punctuation at the ends stripped."""
    base = collapse(F.lower(name))
    abbreviation = F.regexp_extract(base, rf"^({_quoted([*TITLE_ABBREVIATIONS])})", 1)
    table = F.create_map(*[F.lit(x) for pair in TITLE_ABBREVIATIONS.items() for x in pair])
    expanded = F.when(abbreviation != "", F.trim(F.concat(F.coalesce(table[abbreviation], F.lit("")), F.lit(" "), F.trim(F.substr(base, F.length(abbreviation) + 1))))).otherwise(base)
    bare = F.regexp_replace(expanded, rf"^(?:(?:{_quoted(TITLES)})(?:\s+|$))*(?:(?:{_quoted(DOUBLE_TITLES)})(?:\s+|$))*", "")
    kept = F.when(F.trim(bare) == "", expanded).otherwise(bare)
    return collapse(F.btrim(kept, F.lit(" .,;:")))


def comparison_name(name: Column) -> Column:
    """Lower case, trimmed, without full stops at the end."""
    return F.regexp_replace(F.trim(F.lower(name)), r"\.+\z", "")


def short_digest(text: Column, n: int = 24) -> Column:
    return F.left(F.sha2(text, 256), F.lit(n))


def utc_text(at: Column) -> Column:
    """A timestamp as ISO text with its offset; the session's zone is UTC."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssxxx")


def slug(text: Column) -> Column:
    """Lower-case letters and digits with single underscores between them."""
    return F.btrim(F.regexp_replace(F.lower(F.trim(text)), r"[^a-z0-9]+", "_"), F.lit("_"))


def type_slug(entity_type: Column) -> Column:
    base = F.lower(F.trim(entity_type))
    return F.when(base == "", F.lit("unknown")).otherwise(F.element_at(F.split(base, ":"), -1))


def type_family(entity_type: Column) -> Column:
    own = type_slug(entity_type)
    out = own
    for family, slugs in FAMILIES.items():
        out = F.when(_in(own, slugs), F.lit(family)).otherwise(out)
    return out


def has_title(name: Column) -> Column:
    base = F.btrim(collapse(F.lower(name)), F.lit(" .,;:"))
    plain = F.regexp_replace(base, r"[.,;:]+", "")
    cleaned = [a.strip(" .") for a in TITLE_ABBREVIATIONS]
    pattern = rf"^(?:{_quoted([*cleaned, *TITLES, *DOUBLE_TITLES])})(?: |$)"
    return base.rlike(pattern) | plain.rlike(pattern)


def name_family(entity_type: Column, name: Column) -> Column:
    """Resolution family of a mention, from its type and, where that is open, its name."""
    base, own, bare = type_family(entity_type), type_slug(entity_type), normalize_name(name)
    tokens = F.filter(F.split(bare, " "), lambda t: t != "")
    letters = F.forall(tokens, lambda t: t.rlike(r"^\p{L}+$"))
    generic = _in(own, ["entity", "unknown"])
    titled = F.when(has_title(name), letters & (F.size(tokens) <= 3)).otherwise((F.size(tokens) == 2) & (F.length(tokens[0]) == 1) & letters)
    compact = F.regexp_replace(F.trim(name), r"[^A-Za-z0-9]+", "")
    shouted = (F.size(tokens) == 1) & (F.length(compact) >= 3) & compact.rlike("[A-Z]") & (F.upper(compact) == compact)
    signed = (F.size(tokens) >= 2) & (F.size(alias_tokens(bare)) > 0)
    hinted = F.exists(tokens, lambda t: _in(t, ORGANIZATION_HINTS))
    rank_person = (own == "military_rank") & F.exists(tokens, lambda t: ~_in(t, RANKS))
    out = (
        F.when(rank_person, "person")
        .when(bare.rlike("^(?:" + "|".join(PLACE_PREFIXES) + ")"), "place")
        .when(generic & titled & (F.size(tokens) > 0), "person")
        .when(generic & (hinted | signed | shouted), "organization")
        .otherwise(base)
    )
    return F.when(F.coalesce(F.trim(name), F.lit("")) == "", base).when(bare == "", base).otherwise(out)


def person_name(name: Column) -> Column:
    """Surname, given name, initial, whether only a surname, whether titled."""
    tokens = F.filter(F.split(normalize_name(name), " "), lambda t: t != "")
    n = F.size(tokens)
    given = F.when(n > 1, F.btrim(F.get(tokens, F.lit(0)), F.lit(".,;:")))
    return F.struct(
        F.when(n > 0, F.element_at(tokens, -1)).alias("surname"),
        F.when(F.length(given) > 1, given).alias("given"),
        F.left(given, F.lit(1)).alias("initial"),
        (n == 1).alias("surname_only"),
        has_title(name).alias("titled"),
    )


def alias_tokens(name: Column) -> Column:
    text = F.replace(F.lower(F.trim(name)), F.lit("u.s."), F.lit("us"))
    text = F.regexp_replace(text, r"\bu\.s\b", "us")
    text = F.regexp_replace(text, r"'s\b.*", "")
    return F.filter(F.split(F.regexp_replace(text, r"[^a-z0-9]+", " "), " "), lambda t: (t != "") & ~_in(t, ALIAS_STOPWORDS))


def acronym_signatures(name: Column) -> Column:
    """High-confidence acronyms of an organisation-like name."""
    tokens = alias_tokens(name)
    text = F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))
    for (a, b), part in COMPOUND_PARTS.items():
        text = F.replace(text, F.lit(f" {a} {b} "), F.lit(f" ={part} "))
    def part(token: Column) -> Column:
        out = F.when(token == "us", token)
        for word, short in WORD_PARTS.items():
            out = out.when(token == word, F.lit(short))
        return out.when(token.startswith("="), F.substr(token, F.lit(2))).when(token.rlike("^[0-9]"), token).otherwise(F.left(token, F.lit(1)))

    joined = F.array_join(F.transform(F.filter(F.split(text, " "), lambda t: t != ""), part), "")
    one = F.get(tokens, F.lit(0))
    compact = F.when(F.size(tokens) == 1, F.when(F.length(one) >= 2, one).otherwise(joined)).otherwise(joined)
    bare = F.when(compact.startswith("us") & (F.length(compact) > 2), F.substr(compact, F.lit(3)))
    return F.array_distinct(F.filter(F.array(compact, bare), lambda s: s.isNotNull() & (s != "")))


def unit_signature(name: Column) -> Column:
    """Signature of a numbered psychological-operations group, written out or short."""
    tokens = alias_tokens(name)
    lead, rest = F.get(tokens, F.lit(0)), F.array_join(F.slice(tokens, 2, F.greatest(F.size(tokens), F.lit(1))), " ")
    return F.when(lead.rlike("^[0-9]") & _in(rest, ["psyop group", "pog"]), F.concat(F.lit("unitabbr:"), lead, F.lit(":pog")))


def installation_key(name: Column) -> Column:
    """One key for the names an installation has had."""
    table = F.create_map(*[F.lit(x) for pair in INSTALLATIONS.items() for x in pair])
    return table[F.array_join(alias_tokens(name), " ")]


def descriptor_head(name: Column) -> Column:
    """Head of a name like "the Agency", else null."""
    head = F.trim(F.regexp_replace(F.regexp_extract(collapse(F.lower(name)), "^the (.*)$", 1), "[^a-z0-9]+", " "))
    return F.when(_in(head, DESCRIPTOR_HEADS), head)


def descriptor_heads_in(text: Column) -> Column:
    """Heads that a text speaks of: "the agency", "the agency's" or "agency leadership"."""
    low = F.lower(text)
    return F.filter(F.array(*map(F.lit, DESCRIPTOR_HEADS)), lambda h: F.regexp_like(low, F.concat(F.lit(r"\b(?:the "), h, F.lit("|"), h, F.lit(r" leadership)\b"))))


def mention_signatures(name: Column, family: Column) -> Column:
    """Keys that make two mentions of one family one entity: full person names, else
    the normalised name, acronyms, and signatures of installations and units."""
    person, bare = person_name(name), normalize_name(name)
    full = F.when(person["given"].isNotNull(), F.concat(F.lit("person:"), person["given"], F.lit(":"), person["surname"]))
    other = F.concat(
        F.array(F.when(bare != "", F.concat(F.lit("norm:"), bare)), F.when(bare != "", installation_key(name)), unit_signature(name)),
        F.transform(acronym_signatures(name), lambda a: F.concat(F.lit("acr:"), a)),
    )
    return F.array_distinct(F.filter(F.when(family == "person", F.array(full)).otherwise(other), lambda x: x.isNotNull()))


def acronym(name: Column) -> Column:
    """First letters of the words of a name of two words or more, upper case."""
    words = F.filter(F.split(name, r"\s+"), lambda w: w != "")
    firsts = F.transform(F.filter(words, lambda w: w.rlike(r"^\p{L}")), lambda w: F.upper(F.left(w, F.lit(1))))
    return F.when(F.size(words) < 2, F.lit("")).otherwise(F.array_join(firsts, ""))


def lemma_candidates(verb: Column) -> Column:
    """Forms to look a verb up by, the raw one first."""
    base = F.lower(F.trim(verb))
    out = [base]
    for suffix in ("ing", "ed", "es", "s"):
        fits = base.endswith(suffix) & (F.length(base) > len(suffix) + 1)
        cut = F.substr(base, F.lit(1), F.length(base) - len(suffix))
        out.append(F.when(fits, cut))
        if suffix in ("ing", "ed"):
            out.append(F.when(fits, F.concat(cut, F.lit("e"))))
    return F.array_distinct(F.filter(F.array(*out), lambda x: x.isNotNull()))


def types_compatible(a: Column, b: Column) -> Column:
    """False for an agent and a process."""

    def of(kind: Column, families: list[str]) -> Column:
        return kind.rlike("^(?:" + "|".join(families) + ")")

    return ~((of(a, AGENT_TYPES) & of(b, PROCESS_TYPES)) | (of(b, AGENT_TYPES) & of(a, PROCESS_TYPES)))


def anaphor(name: Column) -> Column:
    """Which rule takes a name for a reference to something else: struct of is_anaphor,
    is_certain and rule, the first rule that holds."""
    bare = F.trim(name)
    low = F.lower(bare)
    generic = _in(low, GENERIC_NOUNS) | _in(F.regexp_replace(low, "s+$", ""), GENERIC_NOUNS)
    rest = F.filter(F.split(F.regexp_replace(low, r"^(?:the|an|a) ", ""), r"\s+"), lambda w: w != "")
    def noun(word: Column) -> Column:
        return _in(word, GENERIC_NOUNS) | _in(F.regexp_replace(word, "s+$", ""), GENERIC_NOUNS)

    article = low.rlike(r"^(?:the|an|a) ") & (F.size(rest) > 0) & (noun(F.get(rest, F.lit(0))) | noun(F.get(rest, F.size(rest) - 1)))
    words = F.filter(F.split(bare, r"\s+"), lambda w: w != "")
    first = F.get(words, F.lit(0))
    plain_start = first.rlike(r"^\p{Ll}") | _in(F.lower(first), ["a", "an", "the"])
    proper = F.exists(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(1))), lambda w: w.rlike(r"^\p{Lu}") & (F.length(w) > 2) & (F.upper(w) != w))
    rule = (
        F.when(_in(low, PRONOUNS), "pronoun")
        .when(generic, "bare generic noun")
        .when(low.rlike("^(?:this|these|those) "), "demonstrative phrase")
        .when(low.rlike("^(?:their|its) "), "possessive anaphor prefix")
        .when(low.startswith("the ") & low.contains("'s"), "possessive anaphor")
        .when(F.regexp_extract(bare, r"^(?:(?!'s ).)*'s (.)", 1).rlike(r"\p{Ll}"), "possessive construction")
        .when(article, "article + generic noun")
        .when((F.length(bare) > 50) & plain_start & ~proper, "long descriptive phrase")
        .when((F.length(bare) > 30) & bare.rlike(FINITE_VERB), "verb-containing phrase")
    )
    certain = _in(rule, ["pronoun", "bare generic noun", "demonstrative phrase", "possessive anaphor prefix", "possessive anaphor", "possessive construction"])
    return F.struct(rule.isNotNull().alias("is_anaphor"), F.coalesce(certain, F.lit(False)).alias("is_certain"), F.coalesce(rule, F.lit("")).alias("rule"))


def logic_atom(name: Column) -> Column:
    """Name as a logic-programming atom."""
    text = F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), "[\"']", ""), r"\s+", "_")
    text = F.regexp_replace(text, "[^a-z0-9_]", "")
    return F.when(text == "", F.lit("unknown")).when(text.rlike("^[0-9]"), F.concat(F.lit("e_"), text)).otherwise(text)


def local_entity_id(source_ref: Column, entity_type: Column, name: Column) -> Column:
    """Entity id that holds inside one source."""
    return F.concat_ws(":", F.lit("ent:auto"), short_digest(source_ref, 8), slug(type_slug(entity_type)), slug(name))


@F.pandas_udf(StringType())
def _canonical(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else json.dumps(json.loads(t), sort_keys=True, separators=(",", ":")))


def canonical_json(text: Column) -> Column:
    """JSON text with sorted keys, no spaces, non-ASCII escaped and numbers as written."""
    return _canonical(text)


@F.pandas_udf(DoubleType())
def _likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(lcs.ratios(pa.array(a, pa.string()), pa.array(b, pa.string())))


def sorted_words(name: Column) -> Column:
    """The words of a name in order, joined by a space; null counts as empty."""
    words = F.filter(F.split(F.coalesce(name, F.lit("")), r"\s+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Likeness (0 to 100) of two names with their words sorted: twice the longest common
    subsequence over the summed lengths."""
    return _likeness(sorted_words(a), sorted_words(b))

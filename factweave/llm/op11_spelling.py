"""Spelling variants of words by a rare-first q-gram prefix filter.

One edit changes at most two bigrams of a word, so of the three bigrams of a word that are
rarest over the whole vocabulary one at least stands unchanged among the three rarest of
any word one edit away, at the same position or, in a longer word, at the next one. And as
the one edit lies on one side of that bigram, what is on its other side is the same in
both; if that is little, one half of the rest is the same too. Words are joined on this: the
bigram, its position, the length, and what they share. What meets is then verified. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.llm._store import forget, written

# Fixed values of the word rule: runs of these; upper and lower case of A to Z.
RUN = r"[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word has this many code points and occurrences at least.
SHORTEST, LEAST = 5, 3
#: Every so manyth occurrence, by its hash, loses a code point.
DAMAGED = 97
#: A form occurs so many times as often as its variant, at least.
TIMES = 2
#: Bigrams of a word that are joined: an edit changes two of them at most.
RAREST = 3
#: Known parts of words below this many code points are joined with half of the rest.
SPLIT_BELOW = 5


def _apart(df: DataFrame) -> DataFrame:
    """``df`` to be joined by shuffle: Spark takes the compressed files of a table, as they are
    before an explode, for the size of what it would broadcast."""
    return df.hint("merge")


def occurrences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word) for each run of letters: A to Z lowered, one code point deleted from those
    that the hash of key and run picks. A null text has none, a null key counts as an
    empty string. Rows that repeat count as often as they do."""
    found = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.explode(F.regexp_extract_all(F.translate(F.col(text).cast("string"), _UPPER, _LOWER), F.lit(RUN), F.lit(0))).alias("run")
    )
    h = F.crc32(F.concat_ws(":", "key", "run").cast("binary"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return found.withColumn("h", h).select(F.when(F.col("h") % DAMAGED == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words of SHORTEST code points that occur LEAST times, or more."""
    words = occurrences(docs, key, text).where(F.length("word") >= SHORTEST)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST)


def _prefixes(words: DataFrame) -> DataFrame:
    """(word, n, size, gram, at) for the three positional bigrams of each word that are
    rarest in the vocabulary. The order over all bigrams is by frequency, then bigram,
    then position."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.struct(F.col("word").substr(i, F.lit(2)).alias("gram"), i.alias("at")))
    spread = words.select("word", "n", F.explode(grams).alias("g")).select("word", "n", "g.gram", "g.at")
    # As many rows as there are bigrams of 26 and 64 letters, 8,100, at most.
    counts = spread.groupBy("gram").count()
    ranked = F.array_sort(F.collect_list(F.struct("count", "gram", "at")))
    rarest = spread.join(F.broadcast(counts), "gram").groupBy("word", "n").agg(F.slice(ranked, 1, RAREST).alias("rarest"))
    return rarest.select("word", "n", F.length("word").alias("size"), F.explode("rarest").alias("g")).select("word", "n", "size", "g.gram", "g.at")


def _keys(size: Column, at: Column, longer: bool) -> Column:
    """What a word of ``size`` whose bigram stands at ``at`` shares with its near words: keys
    of an edit behind the bigram and of one before it. A part of fewer than SPLIT_BELOW
    code points is shared by too many words, so one half of the rest joins it: the edit
    is in the other. ``longer`` says that the word is the longer one of the two."""
    word = F.col("word")

    def side(mark: str, known: Column, rest: Column, n: Column) -> Column:
        # Halves of the shorter word's rest, which has one code point fewer.
        half = F.floor((n - int(longer)) / 2).cast("int")
        first, last = rest.substr(F.lit(1), half), rest.substr(half + 1 + int(longer), n)
        named = lambda part, of: F.concat(F.lit(mark + part), known, F.lit("|"), of)
        halves = F.array(named("1+" if longer else "1", first), named("2+" if longer else "2", last))
        return F.when(F.length(known) < SPLIT_BELOW, halves).otherwise(F.array(F.concat(F.lit(mark), known)))

    behind = side("<", word.substr(F.lit(1), at + 1), word.substr(at + 2, size), size - at - 1)
    before = side(">", word.substr(at, size), word.substr(F.lit(1), at - 1), at - 1)
    return F.concat(behind, before)


def near(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b) once for each two words of ``words`` (word, n) that differ by one
    inserted, deleted or replaced code point; a is the shorter or the lesser one."""
    tokens = written(_prefixes(words))
    size, at = F.col("size"), F.col("at")
    # As one of two words of a size, as the shorter and as the longer one; an edit before the
    # bigram moves it on in the longer word. Keys differ by the longer word's size and place.
    own = F.transform(_keys(size, at, False), lambda k: F.struct(k.alias("k"), size.alias("to"), at.alias("place")))
    shorter = F.transform(_keys(size, at, False), lambda k: F.struct(F.when(k.rlike("^.[12]"), F.concat(F.substring(k, 1, 2), F.lit("+"), k.substr(F.lit(3), F.length(k)))).otherwise(k).alias("k"), (size + 1).alias("to"), (at + k.startswith(">").cast("int")).alias("place")))
    longer = F.transform(F.filter(_keys(size, at, True), lambda k: k.rlike("^.[12]")), lambda k: F.struct(k.alias("k"), size.alias("to"), at.alias("place")))

    def side(name: str, keys: Column) -> DataFrame:
        spread = tokens.select(F.col("word").alias(name), F.col("n").alias(f"n_{name}"), F.explode(keys).alias("key"))
        return spread.select(name, f"n_{name}", F.xxhash64("key.k", "key.to", "key.place").alias("key"))

    a, b = F.col("a"), F.col("b")
    ordered = (F.length(a) < F.length(b)) | ((F.length(a) == F.length(b)) & (a < b))
    pairs = _apart(side("a", F.concat(own, shorter))).join(_apart(side("b", F.concat(own, longer))), "key").where(ordered & (F.levenshtein(a, b, 1) == 1))
    return pairs.select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following ``forms`` (word, form) ends, for each of its words.
    A form must occur more often than its word, so no path comes back; paths are
    followed by doubling steps until none goes on."""
    now = written(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(now.join(_apart(on), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        forget(now)
        now = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return now


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of the texts.

    Words are those of ``vocabulary``; null and empty texts have none, and no texts give
    no rows. ``n_near`` counts the words one edit away. ``form`` is the most frequent of
    them, of several as frequent the one that sorts first, if it occurs at least twice as
    often as the word; else null, and ``root`` is the word itself. A text of any length is
    one row, whose words take some 60 bytes each for a moment; the bigrams' frequencies
    (8,100 at most) are broadcast, nothing else is. Further columns are not read.
    """
    words = written(vocabulary(docs, key, text))
    pairs = written(near(words))
    both = pairs.select(F.col("a").alias("word"), "n_a", F.col("b").alias("other"), "n_b").union(pairs.select("b", "n_b", "a", "n_a"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("other").alias("form"))).alias("best"))
    found = words.join(_apart(best), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    frequent = F.col("form_n") >= TIMES * F.col("n")
    found = written(found.withColumns({"form": F.when(frequent, F.col("form")), "form_n": F.when(frequent, F.col("form_n"))}))
    ends = roots(found.where("form is not null").select("word", "form"))
    return found.join(_apart(ends), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of the words of all documents."""
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Table of CRC-32 by its reflected polynomial; bytes of a text; words one edit apart by what
#: deleting one code point leaves of them.
OP11 = rf"""WITH RECURSIVE
bits AS (SELECT range::BIGINT AS i, range::BIGINT AS c, 0 AS k FROM range(256) UNION ALL SELECT i, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
uses AS (SELECT d, run, count(*) AS n FROM runs GROUP BY 1, 2),
codes AS (SELECT d, run, n, list_transform(string_split(d || ':' || run, ''), lambda c: unicode(c)::BIGINT) AS u FROM uses),
bytes AS (SELECT d, run, n, flatten(list_transform(u, lambda c: CASE WHEN c < 128 THEN [c] ELSE [192 | (c >> 6), 128 | (c & 63)] END)) AS b FROM codes),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda h, x: xor(h >> 8, t[(xor(h, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc),
made AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM made WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
cuts AS (SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
linked AS (SELECT a.word AS a, a.n AS na, b.word AS b, b.n AS nb FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word < b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word),
near AS (SELECT a AS word, na AS n, b AS other, nb AS m FROM linked UNION SELECT b, nb, a, na FROM linked),
best AS (SELECT word, n, count(*) AS n_near, min(struct_pack(m := -m, other := other)) AS top FROM near GROUP BY 1, 2),
forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN -b.top.m >= 2 * w.n THEN b.top.other END AS form, CASE WHEN -b.top.m >= 2 * w.n THEN -b.top.m END AS form_n FROM words w LEFT JOIN best b USING (word)),
walk AS (SELECT word, word AS root FROM forms UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.root AND forms.form IS NOT NULL),
ends AS (SELECT walk.word, walk.root FROM walk JOIN forms ON forms.word = walk.root WHERE forms.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n FROM forms f JOIN ends e USING (word)"""

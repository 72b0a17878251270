"""Distribution divergence: quality rules on word and character histograms.

Per document five base counts are taken; then its character-class histogram
and its histogram of common words are compared with one reference per
language by Jensen-Shannon distance (base 2, 0 to 1). The references are the
summed histograms of all documents of a language that pass the base rules;
every language with such a document has one. A language's common words are the
most frequent words of those documents, of any length, as written, in their
case; a token without a letter is no common word. The word histogram of a text has a
bin for each of them and one for any other word, so a text without a common
word is far from a language that uses them. A document is kept if some
language's reference is near enough in both histograms. Guards: the classes of
a text under ``min_chars`` characters, and the words of one under
``min_rated`` words, give no reliable histogram, and that comparison is
skipped (it can't reject).

DataFrame functions only. The texts are read twice, in narrow passes: to count
the words of those that pass the base rules, and for the counts of each. What is
shuffled are counts of words and one sum per language. The references
are one row, joined to every document.

Defined results: a NULL or empty text has no words, so it fails the base rule
(under ``min_words``) and isn't kept. Repeated rows each give a row. Where
no document of a language passes the base rules (empty table, only NULL
languages) no reference exists and the base rule alone decides. Ties among common words fall to the smaller word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strata.llm.common import let, stored

CLASSES = ("space", "digit", "upper", "punct", "foreign", "lower")  # foreign: bytes of UTF-8 beyond one a character
SPACE = r"[\x20\x09-\x0D]"
LETTER = r"[^!-@\[-`{-~]"  # anything but ASCII digits and signs


@dataclass(frozen=True)
class Limits:
    """Parameters of the rules.

    ``min_rated``, ``max_class`` and ``max_words`` are set on the rows of sf0.1
    with a quality label that pass the base rules.
    """

    min_words: int = 10
    repeat_percent: int = 20
    min_chars: int = 200
    min_rated: int = 100
    common: int = 8
    max_class: float = 0.25
    max_words: float = 0.20


def windows(words: Column) -> Column:
    """A 64-bit hash of every 5-word window, in order."""
    n = F.size(words)
    zipped = F.arrays_zip(words, *(F.slice(words, k, n) for k in (2, 3, 4, 5)))
    return F.transform(F.slice(zipped, 1, F.greatest(n - 4, F.lit(0))), lambda w: F.xxhash64(w))


def covered(wins: Column) -> Column:
    """How many words lie in windows whose hash occurs twice or more."""
    marked = F.sort_array(F.transform(wins, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        hit = F.transform(s, lambda x, k: F.when(
            F.coalesce(F.get(s, k - 1)["w"] == x["w"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["w"] == x["w"], F.lit(False)), x["i"]))
        return let(F.sort_array(F.array_compact(hit)), lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(5), F.coalesce(F.get(p, k + 1) - x, F.lit(5)))),
            F.lit(0), lambda a, x: a + x))
    return let(marked, repeated)


def word_counts(words: Column) -> Column:
    """(word, n) of the different words."""
    def runs(s: Column) -> Column:
        starts = F.array_compact(F.transform(s, lambda w, i: F.when(~F.coalesce(F.get(s, i - 1) == w, F.lit(False)), i)))
        return let(starts, lambda at: F.transform(at, lambda x, k: F.struct(
            F.get(s, x).alias("word"), (F.coalesce(F.get(at, k + 1), F.size(s)) - x).alias("n"))))
    return let(F.sort_array(words), runs)


def base_counts(docs: DataFrame, limits: Limits) -> DataFrame:
    """doc_id, lang, words, signs (ASCII but letters a-z and blanks) and lengths,
    plus the base columns."""
    d = docs.withColumns({
        "pieces": F.split(F.col("text"), SPACE),  # one more than white space characters
        "lines": F.filter(F.split(F.col("text"), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "signs": F.regexp_replace("text", r"[^!-`{-~]+", "")})
    d = d.withColumn("words", F.array_remove("pieces", "")).withColumn("wins", windows(F.col("words")))
    twice = F.when(F.size(F.array_distinct("wins")) == F.size("wins"), F.lit(0)).otherwise(covered(F.col("wins")))
    d = d.select(
        "doc_id", "lang", "signs", "words",
        (F.size("pieces") - 1).cast("long").alias("n_space"),
        F.length("text").cast("long").alias("length"), F.octet_length("text").cast("long").alias("octets"),
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - F.size("pieces") + 1).cast("long").alias("word_chars"),
        F.regexp_count("signs", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        twice.cast("long").alias("n_repeat_words"))
    return d.withColumn("base_failed", (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words")))


def common_words(d: DataFrame, limits: Limits) -> DataFrame:
    """(lang, top): the most frequent words, (rank, word, n), of all texts of a
    language that pass the base rules."""
    # no filter, and none that Spark infers from explode: either would take the windows of a text twice
    good = d.select("lang", F.when(F.col("lang").isNotNull() & ~F.col("base_failed"), F.col("words")).alias("words"))
    counts = good.select("lang", F.explode_outer("words").alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    order = [F.desc("letter"), F.desc("n"), "word"]  # looked for in different words only
    rank = F.row_number().over(W.partitionBy("lang").orderBy(*order))
    return (counts.withColumn("letter", F.col("word").rlike(LETTER)).withColumn("rank", rank)
            .where((F.col("rank") <= limits.common) & F.col("letter"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("top")))


def histograms(d: DataFrame, vocabulary: list[str]) -> DataFrame:
    """The counts of CLASSES (array ``cls``) beside those of the words in the vocabulary."""
    digit, upper = (F.regexp_count("signs", F.lit(p)).cast("long") for p in (r"[0-9]", r"[A-Z]"))
    d = d.withColumns({"digit": digit, "upper": upper})
    punct = F.length("signs") - F.col("digit") - F.col("upper")
    foreign = F.col("octets") - F.col("length")
    rest = F.greatest(F.col("length") - F.col("n_space") - F.length("signs") - foreign, F.lit(0))
    return d.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed",
                    F.array("n_space", "digit", "upper", punct, foreign, rest).cast("array<long>").alias("cls"),
                    word_counts(F.filter("words", lambda w: w.isin(vocabulary))).alias("held"))


def total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)


def references(h: DataFrame, top: DataFrame) -> DataFrame:
    """Summed histograms of every language with a text that passes the base
    rules: (lang, classes, top: its common words, words: their counts and that
    of all other words)."""
    good = h.where(F.col("lang").isNotNull() & ~F.col("base_failed"))
    per = good.groupBy("lang").agg(
        F.array(*(F.sum(F.get("cls", F.lit(i))) for i in range(len(CLASSES)))).alias("classes"), F.sum("n_words").alias("n"))
    none = F.array().cast("array<struct<rank:int,word:string,n:bigint>>")
    both = per.join(top, "lang", "left").withColumn("top", F.coalesce("top", none))
    return both.select("lang", "classes", F.col("top.word").alias("top"), F.concat(
        F.col("top.n"), F.array(F.col("n") - total(F.col("top.n")))).alias("words"))


def js_distance(counts: Column, ref: Column | list[int]) -> Column:
    """Jensen-Shannon distance (square root of the divergence, base 2) between
    two count arrays; NULL when either is empty."""
    if isinstance(ref, list):
        ref = F.array(*(F.lit(x) for x in ref)).cast("array<long>")

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    def distance(n: Column) -> Column:
        terms = F.zip_with(counts, ref, lambda c, r: let(F.struct((c / n["a"]).alias("a"), (r / n["b"]).alias("b")), lambda x: let(
            (x["a"] + x["b"]) / 2, lambda m: part(x["a"], m) + part(x["b"], m))))
        return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))
    sums = F.struct(total(counts).cast("double").alias("a"), total(ref).cast("double").alias("b"))
    return let(sums, lambda n: F.when((n["a"] > 0) & (n["b"] > 0), distance(n)))


def quality(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id",
            text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: base counts, ``nearest`` (language of the nearest
    reference, NULL without one), ``class_distance`` and ``word_distance`` to
    it, ``base_failed`` and ``kept``."""
    d = docs.select(docs[id_col].alias("doc_id"), docs[lang_col].alias("lang"),
                    F.coalesce(docs[text_col], F.lit("")).alias("text"))
    d = base_counts(d, limits)
    top = stored(common_words(d, limits), "common")
    vocabulary = [r["word"] for r in top.select(F.explode("top.word").alias("word")).distinct().collect()]  # ``common`` a language
    h = stored(histograms(d, vocabulary), "quality")
    refs = stored(references(h, top), "references")
    every = refs.agg(F.sort_array(F.collect_list(F.struct("lang", "classes", "top", "words"))).alias("refs"))
    h = h.withColumn("held", F.map_from_entries("held")).crossJoin(F.broadcast(every))

    def words(top: Column) -> Column:
        own = F.transform(top, lambda w: F.coalesce(F.try_element_at("held", w), F.lit(0)).cast("long"))
        return let(own, lambda n: F.concat(n, F.array(F.col("n_words") - total(n))))
    long_enough, enough = total(F.col("cls")) >= limits.min_chars, F.col("n_words") >= limits.min_rated
    rated = F.transform("refs", lambda r: F.struct(
        F.coalesce(F.when(long_enough, js_distance(F.col("cls"), r["classes"])), F.lit(0.0)).alias("c"),
        F.coalesce(F.when(enough, let(words(r["top"]), lambda n: js_distance(n, r["words"]))), F.lit(0.0)).alias("w"),
        r["lang"].alias("lang")))
    scaled = lambda x: F.greatest(x["c"] / limits.max_class, x["w"] / limits.max_words)
    best = F.array_min(F.transform(rated, lambda x: F.struct(
        scaled(x).alias("far"), x["lang"].alias("lang"), x["c"].alias("c"), x["w"].alias("w"))))
    out = h.withColumn("best", best)
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return out.select(*base, F.col("best.lang").alias("nearest"), F.col("best.c").alias("class_distance"),
                      F.col("best.w").alias("word_distance"),
                      (~F.col("base_failed") & F.coalesce(F.col("best.far") <= 1, F.lit(True))).alias("kept"))

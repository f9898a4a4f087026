"""Quality rules: base counts of a text, and how far its histograms lie from those of its language.

Every language has two reference histograms, counted over all rows: classes of characters, and common
words. A text is compared with its language by the Jensen-Shannon distance (base 2, so 0 to 1). A text
too short for a histogram to mean anything is not judged by it, nor is one whose language is too rare
to have a reference.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.rows import SPACES, let, text_of
from martloom.storage import store

# The character classes and the base rules.
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
BLANKS = " \t\n\x0b\x0c\r"
MARKS = ".,;:!?'\"()-"
SYMBOLS = "#*$%&|<>"
RARE_SYMBOLS = "@[]\\^_`{}~/+="
CLASSES = ("lower", "upper", "digits", "blanks", "marks", "symbols", "rare", "other")
WINDOW = 5
LEAST_WORDS = 10
REPEATED_PERCENT = 20


@dataclass(frozen=True)
class Limits:
    """What the divergence rule goes by."""

    #: A distance above this rejects: of character classes, of common words.
    class_distance: float = 0.34
    word_distance: float = 0.33
    #: Guards: fewer characters or words than this leave the text unjudged by that histogram.
    least_chars: int = 200
    least_words: int = 60
    #: A word is common when it makes up this share of its language's words: at most 1 / share such words.
    common_share: float = 0.005
    #: A language has a reference from this share of all words on: at most 1 / share languages.
    language_share: float = 0.001


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES + "+", -1), "")


def _repeated(words: Column) -> Column:
    """Words that lie in a window found twice or more.

    Hashes of the windows, taken from one hash per word, tell the texts in which all differ. In the others the windows
    themselves are sorted, so that equal ones are neighbours, and the union of their places is measured.
    """
    starts = lambda n: F.sequence(F.lit(1), n)
    window = lambda h, i: F.xxhash64(*[F.get(h, i + (k - 1)) for k in range(WINDOW)])
    hashes = lambda n: let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.transform(starts(n), lambda i: window(h, i)))
    windows = lambda n: F.sort_array(
        F.transform(starts(n), lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("w"), i.alias("at")))
    )
    twice = lambda s: F.sort_array(
        F.array_compact(
            F.transform(
                s,
                lambda x, k: F.when(
                    (x["w"] == F.get(s, k - 1)["w"]) | (x["w"] == F.get(s, k + 1)["w"]), x["at"]
                ),
            )
        )
    )
    covered = lambda at: F.aggregate(
        F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    exact = lambda n: let(windows(n), lambda s: let(twice(s), covered))
    n = F.size(words) - (WINDOW - 1)
    return F.when(n < 2, F.lit(0).cast("long")).otherwise(
        let(n, lambda m: F.when(F.size(F.array_distinct(hashes(m))) == m, F.lit(0).cast("long")).otherwise(exact(m)))
    )


def _kinds(text: Column) -> Column:
    """The text with each character of a class as one character that stands for the class, without lower-case letters.

    One pass over the text; the classes are then counted on what is left.
    """
    kinds = {"A": UPPER, "0": DIGITS, " ": BLANKS, ".": MARKS, "#": SYMBOLS, "~": RARE_SYMBOLS}
    return F.translate(text, "".join(kinds.values()) + LOWER, "".join(k * len(v) for k, v in kinds.items()))


def _classes(text: Column, kinds: Column) -> Column:
    """Characters of each of CLASSES as an array of doubles; `kinds` is `_kinds` of the text."""
    count = lambda k: F.octet_length(kinds) - F.octet_length(F.replace(kinds, F.lit(k)))
    known = F.array(F.char_length(text) - F.char_length(kinds), *[count(k) for k in "A0 .#~"])
    rest = lambda x: F.char_length(text) - F.aggregate(x, F.lit(0), lambda total, n: total + n)
    return let(known, lambda x: F.concat(x, F.array(rest(x)))).cast("array<double>")


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two count arrays of one length; null when one of them is all zero."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def of(np: Column, nq: Column) -> Column:
        terms = F.zip_with(
            p,
            q,
            lambda a, b: let(
                F.struct((a / np).alias("a"), (b / nq).alias("b")),
                lambda s: part(s["a"], (s["a"] + s["b"]) / 2) + part(s["b"], (s["a"] + s["b"]) / 2),
            ),
        )
        return F.sqrt(F.greatest(total(terms) / 2, F.lit(0.0)))

    return let(
        F.struct(total(p).alias("p"), total(q).alias("q")),
        lambda n: F.when((n["p"] > 0) & (n["q"] > 0), of(n["p"], n["q"])),
    )


def references(docs: DataFrame, limits: Limits = Limits(), text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per language: classes, words, word_counts (a count per word, then that of all others).

    Counted over all rows. Only shares bound what comes out: at most 1 / language_share rows of at most
    1 / common_share words.
    """
    body = docs.select(docs[lang].cast("string").alias("lang"), text_of(docs, text).alias("body")).filter("lang IS NOT NULL")
    counted = body.select("lang", let(_kinds(F.col("body")), lambda k: _classes(F.col("body"), k)).alias("each"))
    sums = [F.sum(F.get("each", F.lit(i))) for i in range(len(CLASSES))]
    classes = counted.groupBy("lang").agg(F.array(*sums).alias("classes"))
    spoken = body.select("lang", F.explode(_words(F.lower("body"))).alias("word"))
    words = store(spoken.groupBy("lang", "word").agg(F.count("*").alias("n")), "words_of_languages")
    totals = words.groupBy("lang").agg(F.sum("n").alias("all_words"))
    everything = totals.agg(F.sum("all_words")).scalar()
    heard = totals.filter(F.col("all_words") >= limits.language_share * everything)
    common = (
        words.join(F.broadcast(heard), "lang")  # bounded by the language share
        .filter(F.col("n") >= limits.common_share * F.col("all_words"))
        .groupBy("lang", "all_words")
        .agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("common"))
    )
    counts = F.col("common.n")
    rest = F.col("all_words") - F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x)
    shares = common.select(
        "lang",
        F.col("common.word").alias("words"),
        F.concat(counts, F.array(rest)).cast("array<double>").alias("word_counts"),
    )
    return store(shares.join(classes, "lang"), "language_references")


def _word_counts(words: Column, common: Column) -> Column:
    """How often each common word occurs, then how many other words there are.

    Each word becomes one character, so that counting is a matter of lengths. A word longer than all common ones is
    not looked for among them.
    """
    first = 48
    code = lambda k: F.char(k + first)
    place = lambda w, most: F.when(F.octet_length(w) <= most, F.array_position(common, w)).otherwise(0)
    longest = F.array_max(F.transform(common, lambda w: F.octet_length(w)))
    coded = let(longest, lambda most: F.array_join(F.transform(words, lambda w: code(place(w, most))), ""))
    hits = lambda s, k: F.char_length(s) - F.char_length(F.replace(s, code(k)))
    order = lambda: F.concat(F.sequence(F.lit(1), F.size(common)), F.array(F.lit(0)))
    return let(coded, lambda s: F.transform(order(), lambda k: hits(s, k).cast("double")))


def measured(
    docs: DataFrame, limits: Limits = Limits(), text: str = "text", lang: str = "lang", reference: DataFrame | None = None
) -> DataFrame:
    """`docs` with `__quality`, a struct of all counts, distances and verdicts; rows are not moved.

    `reference` is what `references` returns, by default that of `docs`. It has a proven bound and is
    broadcast.
    """
    reference = references(docs, limits, text, lang) if reference is None else reference
    known = reference.select(F.col("lang").alias("__lang"), F.struct("classes", "words", "word_counts").alias("__ref"))
    rows = docs.join(F.broadcast(known), docs[lang].cast("string") == F.col("__lang"), "left")
    return rows.withColumn("__quality", _judged(text_of(docs, text), F.col("__ref"), limits)).select(*docs.columns, "__quality")


def _judged(body: Column, ref: Column, limits: Limits) -> Column:
    """All counts, distances and verdicts of a text.

    One nested expression, in which each part is computed once: a filter on the verdict then costs
    what the verdict costs, wherever the optimizer puts it.
    """
    lines = F.filter(F.split(body, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    parts = F.struct(_words(body).alias("words"), _kinds(body).alias("kinds"), lines.alias("lines"))

    def counted(x: Column) -> Column:
        words = x["words"]
        common = F.when(F.size(words) >= limits.least_words, _word_counts(F.transform(words, F.lower), ref["words"]))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            _repeated(words).alias("n_repeat_words"),
            (F.size(x["lines"]) - F.size(F.array_distinct(x["lines"]))).cast("long").alias("n_dup_lines"),
            common.alias("common"),
            _classes(body, x["kinds"]).alias("classes"),
            F.char_length(body).cast("long").alias("chars"),
        )

    def measured_by(m: Column) -> Column:
        of_classes = F.when(m["chars"] >= limits.least_chars, divergence(m["classes"], ref["classes"]))
        distances = F.struct(of_classes.alias("classes"), divergence(m["common"], ref["word_counts"]).alias("words"))
        return let(distances, lambda d: verdict(m, d))

    def verdict(m: Column, d: Column) -> Column:
        n_words, n_repeat = m["n_words"], m["n_repeat_words"]
        failed = (n_words < LEAST_WORDS) | (100 * n_repeat > REPEATED_PERCENT * n_words)
        close = lambda c, most: F.coalesce(c <= most, F.lit(True))
        near = close(d["classes"], limits.class_distance) & close(d["words"], limits.word_distance)
        of_class = lambda name: F.get(m["classes"], F.lit(CLASSES.index(name))).cast("long")
        return F.struct(
            n_words.alias("n_words"),
            (m["chars"] - of_class("blanks")).alias("word_chars"),
            of_class("symbols").alias("n_symbols"),
            m["n_dup_lines"].alias("n_dup_lines"),
            n_repeat.alias("n_repeat_words"),
            failed.alias("base_failed"),
            (~failed & near).alias("kept"),
            d["classes"].alias("class_distance"),
            d["words"].alias("word_distance"),
        )

    return let(parts, lambda x: let(counted(x), measured_by))


def assessed(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of `docs`: key, the base counts, base_failed, kept and the two distances.

    Null text has no words and fails the base rules, as an empty one does. A text under the guards, one
    without language and one of a language without reference are kept when they pass the base rules.
    Repeated rows are judged alike. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(key, text, lang)
    return measured(rows, limits, text, lang).select(key, "__quality.*")


def passing(docs: DataFrame, limits: Limits = Limits(), text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of `docs` that are kept, with their columns as they were, whatever their names.

    Null and empty texts fail the base rules. Repeated rows are judged alike and long texts whole. An empty table gives no rows.
    """
    rows = docs.select(F.struct("*").alias("doc"), docs[text].alias("text"), docs[lang].alias("lang"))
    judged = measured(rows, limits, "text", "lang", references(docs, limits, text, lang))
    return judged.filter("__quality.kept").select("doc.*")

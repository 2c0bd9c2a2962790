"""Quality rules with Spark expressions only.

Counts that any text has (words, symbols, repeated lines and windows) give the base
verdict. The rest is a test of distributions: a text's histogram of character
classes and its histogram of common words are compared with those of each language
reference by the Jensen-Shannon distance (square root of the divergence in bits).
A text fails if its nearest reference is too far. A histogram with too few entries
says little, so a guard on its size comes before each test.

There are three histograms: of the character classes, of the common words, and of
symbols against all other characters, since in the first the lower-case letters hide a
share of symbols below a fifth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, every_column, settled

#: Character classes, as patterns of runs of them.
CLASSES = {"lower": "[a-z]+", "upper": "[A-Z]+", "digit": "[0-9]+", "symbol": "[#*$%&|<>]+", "other": r"""[!"'()+,\-./:;=?@\[\\\]\^_`{}~]+""", "beyond": r"[^\x00-\x7F]+"}

#: Fixed values, as those of COMMON_SHARES: shares of the character classes among a text's non-space characters, in the order of
#: CLASSES, and at least 0.001. Both are estimated from the labelled good texts of sf0.1 that are not held out (2,573 of them).
CLASS_REFERENCES = {
    "en": (0.954, 0.016, 0.001, 0.001, 0.028, 0.001),
    "fr": (0.849, 0.012, 0.001, 0.001, 0.029, 0.108),
    "de": (0.914, 0.014, 0.001, 0.001, 0.026, 0.045),
    "es": (0.864, 0.014, 0.001, 0.001, 0.027, 0.093),
}

#: A language's commonest words, and the share of each among them.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "with", "be", "by", "on", "this", "are"),
    "fr": ("le", "la", "les", "de", "des", "du", "et", "en", "un", "une", "que", "qui", "pour", "dans", "par", "sur"),
    "de": ("der", "die", "das", "und", "in", "von", "zu", "mit", "den", "dem", "ist", "nicht", "ein", "eine", "als", "auf"),
    "es": ("el", "la", "los", "las", "de", "que", "y", "en", "un", "una", "con", "por", "para", "del", "se", "su"),
}
COMMON_SHARES = {
    "en": (0.267, 0.138, 0.112, 0.082, 0.057, 0.051, 0.045, 0.037, 0.038, 0.025, 0.028, 0.023, 0.023, 0.031, 0.022, 0.022),
    "fr": (0.100, 0.137, 0.065, 0.253, 0.055, 0.036, 0.078, 0.052, 0.045, 0.033, 0.030, 0.023, 0.029, 0.024, 0.020, 0.020),
    "de": (0.260, 0.137, 0.046, 0.110, 0.079, 0.055, 0.047, 0.038, 0.068, 0.023, 0.025, 0.022, 0.021, 0.022, 0.017, 0.031),
    "es": (0.076, 0.133, 0.048, 0.040, 0.255, 0.101, 0.051, 0.067, 0.032, 0.023, 0.026, 0.031, 0.021, 0.036, 0.040, 0.022),
}

#: Characters that a text needs for the tests of characters, and words for the test of common words.
MIN_CHARS, MIN_WORDS = 200, 50
#: Distances beyond which a text fails. The good texts above have 0.266 at most by classes, 0.662 by words (short ones; 0.27 from
#: 500 words on) and 0.022 by symbols; the 228 junk texts that pass the base rules have 0.183 at least by symbols.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE, MAX_SYMBOL_DISTANCE = 0.30, 0.80, 0.15
#: The share of symbols that the last test compares with.
SYMBOL_SHARE = 0.001


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE, -1), lambda w: w != "")


def _without(text: Column, runs: str) -> Column:
    return F.regexp_replace(text, runs, "")


def repeat_words(words: Column) -> Column:
    """The words that lie in a window of three found twice or more, from a sort of the windows' 64-bit hashes."""
    n = F.size(words)
    tri = F.filter(F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(n, F.lit(1))).alias("b"), F.slice(words, 3, F.greatest(n, F.lit(1))).alias("c")), lambda t: t["c"].isNotNull())
    return F.transform(tri, lambda t, i: F.struct(F.xxhash64(t["a"], t["b"], t["c"]).alias("h"), i.alias("i")))


def distance(counts: Column, reference: tuple[float, ...]) -> Column:
    """The Jensen-Shannon distance of a histogram (array of counts) and a reference; 1 for an empty histogram."""
    whole, zero = sum(reference), F.lit(0.0)
    total = F.aggregate(counts, zero, lambda a, c: a + c)

    def term(c: Column, q: Column) -> Column:
        p = c / total
        m = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / m)).otherwise(zero) + F.when(q > 0, q * F.log2(q / m)).otherwise(zero)

    terms = F.aggregate(F.zip_with(counts, F.array(*[F.lit(r / whole) for r in reference]), term), zero, lambda a, t: a + t)
    return F.when(total > 0, F.sqrt(F.greatest(terms / 2, zero))).otherwise(F.lit(1.0))


def quality_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance, symbol_distance, kept.

    A word is a run of characters other than ASCII white space. A null text has no words, so
    it fails the base rules, as every text of fewer than 50 words does. Texts of any length are
    judged whole. Rows are judged one by one: repeated rows get equal results, an empty table
    gives no rows. Columns of ``docs`` with the names of the results are replaced by them. No shuffle.
    """
    raw = F.coalesce(docs[text], F.lit(""))
    held = docs.select(F.struct(*every_column(docs, *RESULTS)).alias("row"), raw.alias("text"))
    # Most characters are lower-case letters: the other classes are counted in what is left without them.
    step = settled(held, "row", "text", words_of(F.col("text")).alias("words"), _without(F.col("text"), CLASSES["lower"]).alias("rest"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = settled(step, "row", F.length("text").alias("n_chars"), "words", "rest", _without(F.col("rest"), SPACE).alias("dense"), lines.alias("lines"), F.sort_array(repeat_words(F.col("words"))).alias("windows"))
    # A window counts if the one before or after it in the order has its hash.
    pairs = F.zip_with(F.slice("windows", 1, F.greatest(F.size("windows") - 1, F.lit(0))), F.slice("windows", 2, F.greatest(F.size("windows"), F.lit(1))), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], a["i"] + 1, a["i"] + 2, b["i"], b["i"] + 1, b["i"] + 2)))
    repeated = F.size(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))
    listed = list(dict.fromkeys(w for ws in COMMON_WORDS.values() for w in ws))
    codes = {w: chr(0x100 + i) for i, w in enumerate(listed)}
    lookup = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    longest = max(map(len, listed))
    common = F.array_join(F.transform(F.filter("words", lambda w: F.octet_length(w) <= longest), lambda w: F.coalesce(F.try_element_at(lookup, F.lower(w)), F.lit(""))), "")
    counts = [F.col("n_chars") - F.length("rest"), *[F.length("dense") - F.length(_without(F.col("dense"), runs)) for name, runs in CLASSES.items() if name != "lower"]]
    out = settled(
        step,
        "row",
        F.size("words").cast("long").alias("n_words"),
        (F.col("n_chars") - F.length("rest") + F.length("dense")).cast("long").alias("word_chars"),
        F.array(*[c.cast("double") for c in counts]).alias("classes"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
        common.alias("common"),
    )
    count = lambda w: (F.length("common") - F.length(F.replace(F.col("common"), F.lit(codes[w]), F.lit("")))).cast("double")
    out = settled(out, "*", *[F.array(*[count(w) for w in ws]).alias(f"common_{lang}") for lang, ws in COMMON_WORDS.items()])
    symbols = F.element_at("classes", list(CLASSES).index("symbol") + 1)
    out = settled(
        out,
        "*",
        F.array_min(F.array(*[distance(F.col("classes"), r) for r in CLASS_REFERENCES.values()])).alias("class_distance"),
        F.array_min(F.array(*[distance(F.col(f"common_{lang}"), r) for lang, r in COMMON_SHARES.items()])).alias("word_distance"),
        distance(F.array(symbols, F.col("word_chars") - symbols), (SYMBOL_SHARE, 1 - SYMBOL_SHARE)).alias("symbol_distance"),
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
    )
    far = (F.col("word_chars") >= MIN_CHARS) & ((F.col("class_distance") > MAX_CLASS_DISTANCE) | (F.col("symbol_distance") > MAX_SYMBOL_DISTANCE))
    far = far | ((F.col("n_words") >= MIN_WORDS) & (F.col("word_distance") > MAX_WORD_DISTANCE))
    return out.select("row.*", "n_words", "word_chars", symbols.cast("long").alias("n_symbols"), "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "symbol_distance", (~F.col("base_failed") & ~far).alias("kept"))


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "symbol_distance", "kept")

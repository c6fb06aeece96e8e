"""Quality rules on whole texts, in DataFrame functions only.

Per text: counts of words, symbols, repeated lines and repeated five-word
windows (the base rules), a histogram of character classes and one of common
words.  The histograms are summed per language over all documents that pass
the base rules; these sums are the language references.  A document is kept
when it passes the base rules and the Jensen-Shannon distance (square root of
the divergence, base 2) of both histograms to its language's reference is
within the limits.

Guards: a text with fewer than ``min_words`` words is too short for its
histograms to say anything and is judged by the base rules alone; a language
(or null) with less than ``min_reference`` characters in all is compared with
the reference over all languages.

Costs: one scan, everything per text inside the row; only the summed
histograms and rows of counts are shuffled.

Defined cases: a null text counts as empty (no words, so ``base_failed``);
rows are never merged, so repeated rows and null ids come back as they came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import WS, Workspace

#: The commonest function words of the four languages.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "it", "that", "for", "was", "with", "on"],
    "de": ["der", "die", "und", "das", "von", "nicht", "mit", "ist", "ein", "den", "für", "des"],
    "fr": ["le", "la", "les", "des", "et", "un", "une", "pour", "dans", "que", "qui", "du"],
    "es": ["el", "los", "las", "del", "con", "para", "por", "una", "se", "de", "y", "en"],
}
WORDS = list(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words))
#: Character classes by regex; lower-case ASCII and others are what is left.
CLASSES = {
    "space": f"[{WS}]",
    "upper": "[A-Z]",
    "digit": "[0-9]",
    "symbol": "[#*$%&|<>]",
    "punct": "[!-\"'()+,\\-./:;=?@\\[-`{}~]",
    "beyond_ascii": "[^\\x00-\\x7F]",
}
WINDOW = 5
#: Most languages whose references are broadcast; more are joined by a shuffle.
BROADCAST_LANGUAGES = 10_000


def let(value: Column, body) -> Column:
    """``body`` over a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words in windows of WINDOW words that occur twice or more."""
    starts = lambda n: F.sequence(F.lit(0), n - WINDOW)

    def covered(hashes):
        keyed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def among(p):
            twice = F.filter(p, lambda e, i: (F.get(p, i - 1)["h"].eqNullSafe(e["h"])) | (F.get(p, i + 1)["h"].eqNullSafe(e["h"])))
            at = F.array_sort(F.transform(twice, lambda e: e["i"]))
            return let(at, lambda a: F.aggregate(
                F.transform(a, lambda v, j: F.least(F.lit(WINDOW), F.coalesce(F.get(a, j + 1) - v, F.lit(WINDOW)))),
                F.lit(0).cast("long"), lambda s, v: s + v))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(keyed, among))

    hashes = F.transform(starts(F.size(words)), lambda i: F.xxhash64(F.slice(words, i + 1, WINDOW)))
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(let(hashes, covered))


def text_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with the counts and histograms."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, f"[{WS}]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{WS}]"))

    def of(w):
        common = F.filter(F.transform(F.filter(w, lambda x: F.length(x) <= max(map(len, WORDS))), F.lower), lambda x: x.isin(WORDS))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
            let(common, lambda c: F.transform(
                F.array(*[F.lit(x) for x in WORDS]), lambda x: (F.size(c) - F.size(F.array_remove(c, x))).cast("long"))).alias("common"),
        )

    rest = [c for c in docs.columns if c != text_col]
    classes = [F.regexp_count(text, F.lit(rx)).cast("long") for rx in CLASSES.values()]
    return docs.select(
        *rest,
        let(words, of).alias("w"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.length(text).cast("long").alias("chars"),
        F.array(*classes).alias("classes"),
    ).select(
        *rest, "w.n_words", "w.word_chars",
        F.col("classes")[list(CLASSES).index("symbol")].alias("n_symbols"),
        "n_dup_lines", "w.n_repeat_words",
        F.concat("classes", F.array(F.col("chars") - F.aggregate("classes", F.lit(0).cast("long"), lambda s, v: s + v))).alias("char_hist"),
        F.concat("w.common", F.array(F.col("w.n_words") - F.aggregate("w.common", F.lit(0).cast("long"), lambda s, v: s + v))).alias("word_hist"),
    )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two count histograms; null if one is empty."""
    def shares(x):
        return let(F.aggregate(x, F.lit(0).cast("double"), lambda s, v: s + v),
                   lambda total: F.transform(x, lambda v: v / total))

    def term(a, b):
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    both = F.zip_with(shares(p), shares(q), lambda a, b: term(a, b) + term(b, a))
    filled = lambda x: F.exists(x, lambda v: v > 0)
    return F.when(filled(p) & filled(q), F.sqrt(F.greatest(
        F.lit(0.0), F.aggregate(both, F.lit(0.0), lambda s, v: s + v) / 2)))


def quality_rules(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_words: int = 30,
                  min_reference: int = 20_000, max_char_distance: float = 0.27,
                  max_word_distance: float = 0.6, **ids: str) -> DataFrame:
    """One row per row of ``docs``: id, counts, ``base_failed``, ``kept``,
    ``char_distance``, ``word_distance`` (null where a guard holds)."""
    id_col = ids.get("id_col", "doc_id")
    ws = Workspace(docs.sparkSession, "quality")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counts = ws.put(text_counts(rows).withColumn(
        "base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))))

    def summed(frame, *keys):
        n, k = len(CLASSES) + 1, len(WORDS) + 1
        sums = frame.where("not base_failed").groupBy(*keys).agg(
            *[F.sum(F.col("char_hist")[i]).alias(f"c{i}") for i in range(n)],
            *[F.sum(F.col("word_hist")[i]).alias(f"w{i}") for i in range(k)])
        return sums.select(*keys, F.array(*[F.coalesce(f"c{i}", F.lit(0)) for i in range(n)]).alias("ref_chars"),
                           F.array(*[F.coalesce(f"w{i}", F.lit(0)) for i in range(k)]).alias("ref_words"))

    languages = ws.put(summed(counts, "lang"))
    overall = languages.agg(
        *[F.sum(F.col("ref_chars")[i]).alias(f"c{i}") for i in range(len(CLASSES) + 1)],
        *[F.sum(F.col("ref_words")[i]).alias(f"w{i}") for i in range(len(WORDS) + 1)])
    total = overall.first()
    every_c = F.array(*[F.lit(total[f"c{i}"] or 0).cast("long") for i in range(len(CLASSES) + 1)])
    every_w = F.array(*[F.lit(total[f"w{i}"] or 0).cast("long") for i in range(len(WORDS) + 1)])
    refs = languages.where(F.aggregate("ref_chars", F.lit(0).cast("long"), lambda s, v: s + v) >= min_reference)
    refs = refs.withColumnRenamed("lang", "ref_lang")
    if refs.limit(BROADCAST_LANGUAGES + 1).count() <= BROADCAST_LANGUAGES:
        refs = F.broadcast(refs)
    joined = counts.join(refs, counts["lang"].eqNullSafe(refs["ref_lang"]), "left")
    long_enough = F.col("n_words") >= min_words
    judged = joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(long_enough, js_distance(F.col("char_hist"), F.coalesce("ref_chars", every_c))).alias("char_distance"),
        F.when(long_enough, js_distance(F.col("word_hist"), F.coalesce("ref_words", every_w))).alias("word_distance"),
    )
    fits = (F.coalesce("char_distance", F.lit(0.0)) <= max_char_distance) & (
        F.coalesce("word_distance", F.lit(0.0)) <= max_word_distance)
    return judged.select(
        F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & fits).alias("kept"), "char_distance", "word_distance")

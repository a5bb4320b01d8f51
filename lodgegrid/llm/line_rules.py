"""Line-first quality rules, in DataFrame functions only.

Every line of a text is judged on its own: by its punctuation (no sentence ends in it, too many symbols or
exclamation marks), as navigation (bar-separated entries, menu words) or as boilerplate (a line of at most
``MAX_PHRASE_WORDS`` words with a fixed phrase; a longer one only speaks of such things). Lines in scripts that
do not mark where a sentence ends need no mark. Lines that fail are removed, and a document that loses more than ``MAX_LOST`` of its word
characters is rejected. Base statistics of the whole text reject a document before that. Nothing is
shuffled: a document is judged within its row, in time that grows with its length times its logarithm.

Cases
-----
* NULL, empty and blank texts have no words, so they fail the base rule.
* Blank lines are neither judged nor lost. Repeated rows are judged one by one.
* Five-word windows are compared by 64-bit hashes within one text.
* Columns beyond ``doc_id`` and ``text`` are passed over.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import SPACE_CHARS, SPACE_CLASS, WORD_PATTERN, boxed, documents, let, unboxed, words_of

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED = 20
MAX_LOST = 0.3
SYMBOLS = "#*$%&|<>"
MAX_SYMBOLS_PER_WORD = 0.3
MAX_BARS_PER_WORD = 0.2
MAX_EXCLAMATIONS_PER_WORD = 0.5

MAX_PHRASE_WORDS = 12

# What ends a sentence in the scripts that mark it (with closing marks after it; the wide
# marks need no space), letters of scripts that do not mark it, and phrases of page furniture.
SENTENCE_END = r"([.!?:;…‼⁇⁈⁉؟۔።፧፨।॥။៕᠃][\"'\p{Pe}\p{Pf}]*([\x20\x09-\x0D]|$)|[。！？｡．︒]|[」』]$)"
UNMARKED = "[\u0e00-\u0e7f\u0e80-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff]"
NAVIGATION = r"(?i)^(home|menu|next|previous|back|top|search|log ?in|sign ?(in|up|out)|register|contact( us)?|about( us)?|share|print|read more|skip to content|site ?map)[.!:]?$"
BOILERPLATE = r"(?i)(javascript|lorem ipsum|all rights reserved|cookie policy|uses? cookies|accept cookies|privacy policy|terms of (use|service)|subscribe to our|click here|powered by)"


# Marks that end a sentence where a line ends in them, and a line of at most MAX_PHRASE_WORDS words.
PLAIN_ENDS = ".!?:;"
SHORT = rf"^{WORD_PATTERN}+(?:{SPACE_CLASS}++{WORD_PATTERN}+){{0,{MAX_PHRASE_WORDS - 1}}}+$"


def count_of(text: Column, characters: str) -> Column:
    """How many characters of the text are among ``characters``."""
    # most texts have few of them or none, which one search tells
    return F.when(
        text.rlike(f"[{characters}]"), F.char_length(text) - F.char_length(_without(text, characters))).otherwise(F.lit(0))


def word_characters(text: Column) -> Column:
    return F.char_length(_without(text, SPACE_CHARS))


def _without(text: Column, characters: str) -> Column:
    # one replace per character works on bytes; translate looks every character up in a map
    return reduce(lambda left, c: F.replace(left, F.lit(c), F.lit("")), characters, text)


def line_verdicts(line: Column) -> Column:
    """``punctuation, navigation, boilerplate`` of one line; all three false for a blank one."""

    def judge(trimmed: Column) -> Column:
        n = F.size(F.split(trimmed, SPACE_CLASS + "+"))
        words = trimmed != F.lit("")

        def many(characters: str, share: float) -> Column:
            # lines without any, nearly all, are not split into words
            found = count_of(trimmed, characters)
            return (found > 0) & (found > share * n)

        # most lines end in one of the plain marks, so the whole pattern need not be searched for
        ended = reduce(lambda left, c: left | trimmed.endswith(c), PLAIN_ENDS[1:], trimmed.endswith(PLAIN_ENDS[0]))
        return F.struct(
            (words & ((~(ended | trimmed.rlike(SENTENCE_END)) & ~trimmed.rlike(UNMARKED))
                      | many(SYMBOLS, MAX_SYMBOLS_PER_WORD)
                      | many("!", MAX_EXCLAMATIONS_PER_WORD))).alias("punctuation"),
            (words & (many("|", MAX_BARS_PER_WORD) | trimmed.rlike(NAVIGATION))).alias("navigation"),
            # blank lines are not short
            (trimmed.rlike(SHORT) & trimmed.rlike(BOILERPLATE)).alias("boilerplate"),
        )

    return let(F.btrim(line, F.lit(SPACE_CHARS)), judge)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of ``window`` words found more than once in the text."""

    def covered(windows: Column) -> Column:
        # equal windows lie side by side once sorted by hash
        def positions(placed: Column) -> Column:
            def again(own: Column, i: Column) -> Column:
                before, after = F.get(placed, i - 1), F.get(placed, i + 1)
                return F.coalesce(before["hash"] == own["hash"], F.lit(False)) | F.coalesce(
                    after["hash"] == own["hash"], F.lit(False))

            return F.sort_array(F.transform(F.filter(placed, again), lambda own: own["place"]))

        def length(places: Column) -> Column:
            steps = F.transform(places, lambda at, i: F.least(
                F.lit(window), F.coalesce(F.get(places, i + 1) - at, F.lit(window))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("hash"), i.alias("place"))))
        return let(let(placed, positions), length)

    def total(every: Column) -> Column:
        n = F.size(every)
        # the words that stand 0, 1, ... places further on, side by side
        each = F.greatest(n - (window - 1), F.lit(0))
        beside = F.arrays_zip(*[F.slice(every, F.lit(i + 1), each) for i in range(window)])
        windows = F.transform(beside, lambda own: F.xxhash64(own))
        return let(windows, lambda own: F.when(
            F.size(F.array_distinct(own)) == F.size(own), F.lit(0).cast("long")).otherwise(covered(own)))

    return let(words, total)


def judged(docs: DataFrame) -> DataFrame:
    """``doc`` (the row of ``docs``), its statistics, its verdicts and the text left of it.

    Columns: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    lines_removed, lost_chars, clean_text, kept``.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.split(text, "\n")
    with_words = F.filter(lines, lambda line: line.rlike(WORD_PATTERN))
    lost = lambda v: v["punctuation"] | v["navigation"] | v["boilerplate"]
    verdict = let(
        F.transform(lines, lambda line: F.struct(line.alias("line"), line_verdicts(line).alias("v"))),
        lambda every: F.struct(
            F.size(F.filter(every, lambda x: lost(x["v"]))).alias("removed"),
            F.aggregate(every, F.lit(0).cast("long"), lambda total, x: total + F.when(
                lost(x["v"]), word_characters(x["line"])).otherwise(F.lit(0)).cast("long")).alias("lost"),
            F.array_join(F.transform(F.filter(every, lambda x: ~lost(x["v"])), lambda x: x["line"]),
                         "\n").alias("clean")))
    stats = boxed(
        docs,
        F.size(words_of(F.col("text"))).cast("long").alias("n_words"),
        word_characters(text).cast("long").alias("word_chars"),
        count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
        let(with_words, lambda own: F.size(own) - F.size(F.array_distinct(own))).cast("long").alias("n_dup_lines"),
        repeated_words(words_of(F.col("text"))).alias("n_repeat_words"),
        verdict.alias("verdict"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return stats.withColumns({
        "base_failed": base_failed,
        "lines_removed": F.col("verdict.removed"), "lost_chars": F.col("verdict.lost"),
        "clean_text": F.col("verdict.clean"),
        "kept": ~base_failed & (F.col("verdict.lost") <= MAX_LOST * F.col("word_chars")),
    }).drop("verdict")


def clean_lines(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with the failed lines taken out of their texts."""
    return unboxed(judged(docs).filter("kept"), docs.columns, text=F.col("clean_text"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judged(documents(spark, folder).select("doc_id", "text")).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "lines_removed", "lost_chars")


OP8_SQL = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
split_words AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM docs),
windows AS (
    SELECT doc_id, i, ws[i:i+4] AS g
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM split_words)),
repeats AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM repeats) GROUP BY doc_id),
split_lines AS (
    SELECT doc_id, line, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs)),
measured AS (
    SELECT *, len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) AS n,
           length(s) - length(translate(s, '{SYMBOLS}', '')) AS symbols,
           length(s) - length(translate(s, '|', '')) AS bars,
           length(s) - length(translate(s, '!', '')) AS bangs,
           length(regexp_replace(s, '[\x20\x09-\x0D]', '', 'g')) AS chars
    FROM split_lines WHERE length(s) > 0),
failing AS (
    SELECT *, (NOT regexp_matches(s, '{SENTENCE_END.replace("'", "''")}') AND NOT regexp_matches(s, '{UNMARKED}'))
              OR symbols > {MAX_SYMBOLS_PER_WORD} * n OR bangs > {MAX_EXCLAMATIONS_PER_WORD} * n
              OR bars > {MAX_BARS_PER_WORD} * n OR regexp_matches(s, '{NAVIGATION}')
              OR (regexp_matches(s, '{BOILERPLATE}') AND n <= {MAX_PHRASE_WORDS}) AS lost
    FROM measured),
by_doc AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (WHERE lost) AS lines_removed,
           coalesce(sum(chars) FILTER (WHERE lost), 0) AS lost_chars
    FROM failing GROUP BY doc_id),
base AS (
    SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
           (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
           coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           coalesce(lines_removed, 0)::INTEGER AS lines_removed, coalesce(lost_chars, 0)::BIGINT AS lost_chars
    FROM split_words w LEFT JOIN covered c ON w.doc_id = c.doc_id LEFT JOIN by_doc b ON w.doc_id = b.doc_id)
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words)
           AND lost_chars <= {MAX_LOST} * word_chars AS kept
FROM base
"""

"""Line-first cleaning: judge lines, remove the failing ones, then judge what is left.

Each line with a word is held against three rules:

* punctuation: symbols make up a tenth of its characters, or a third of its words end in
  several exclamation or question marks;
* navigation: three or more menu separators standing alone, or a line of up to four words
  that begins with a menu word;
* boilerplate: it holds phrases of cookie banners, legal footers or script notices, as whole
  words, and either has up to twelve words or the phrases make up a quarter of its characters. So
  a sentence of some length, or a text in one line, that says one of them stays.

Failing lines go. A document is rejected if it fails the base rules (fewer than 20 words, or
over 30 % of its words in repeated 8-word windows) or loses more than half of its words.

Everything is built-in functions over one row: no shuffle, no Python. Defined results: a null
or blank text has no words and is rejected as too short; lines are equal if all their
characters are; a document that has extra or clashing columns keeps them.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtrail.llm.shared import SPACES, let, text_or_empty, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
MOST_LOST_PERCENT = 50

# What marks a line as a menu or as boilerplate.
MENU_WORDS = "home|menu|login|log in|sign in|sign up|search|next|previous|back to top|share|subscribe|contact us|sitemap"
BOILERPLATE = "cookies?|privacy  policy|terms  of  use|terms  of  service|all  rights  reserved|enable  javascript|lorem  ipsum|click  here|©"
# One of these is in every line that holds such a phrase, which is a quick test.
BOILERPLATE_WORDS = ("cookie", "policy", "terms", "rights", "javascript", "lorem", "click", "copyright", "©")
FEW_WORDS = 12
BOILERPLATE_SHARE = 4  # the phrases' characters times this reach the line's
SEPARATORS = "|»›•·"


def _any_of(text: Column, parts: Iterable[str]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(part)) for part in parts])


def _symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, SYMBOLS, ""))


def _characters(text: Column) -> Column:
    return F.length(F.translate(text, SPACES, ""))


def repeated_words(array: Column, window: int = WINDOW) -> Column:
    """Words in windows that are found twice or more in the array, the first one included.

    Windows are compared by 64-bit hash; positions of repeated ones are merged by one fold
    over the sorted list, so long texts cost n log n.
    """

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def among(ranked: Column) -> Column:
            again = F.filter(
                ranked,
                lambda x, i: ((i > 0) & (F.get(ranked, i - 1)["h"] == x["h"]))
                | F.coalesce(F.get(ranked, i + 1)["h"] == x["h"], F.lit(False)),
            )
            places = F.sort_array(F.transform(again, lambda x: x["i"]))
            start = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
            return F.aggregate(
                places,
                start,
                lambda s, p: F.struct(
                    (s["n"] + F.least(F.lit(window), p - s["last"])).alias("n"), p.alias("last")
                ),
                lambda s: s["n"],
            )

        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(placed, among)).otherwise(0)

    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (window - 1))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, window)))
        return F.when(F.size(w) >= window + 1, let(hashes, covered)).otherwise(0)

    return let(array, of)


def _boilerplate(low: Column) -> Column:
    """Characters of a line's phrases, those between their words included."""
    # Two blanks between words, so that each has its own on either side.
    apart = F.regexp_replace(F.replace(low, F.lit("copyright (c)"), F.lit("©")), "[^a-z©]+", "  ")
    apart = F.concat(F.lit(" "), F.replace(apart, F.lit("©"), F.lit("  ©  ")), F.lit(" "))
    return F.length(apart) - F.length(F.regexp_replace(apart, f" ({BOILERPLATE}) ", "  "))


def line_fails(line: Column, seen: Column) -> Column:
    """Whether a line with words fails a rule. ``seen`` tells which rules its text gives cause for."""
    low = F.lower(line)
    n_words = F.size(words(line))
    loud = F.regexp_count(line, F.lit("[!?]{2,}(?![^ \\t-\\r])"))
    alone = F.regexp_count(line, F.lit(f"(?<![^ \\t-\\r])[{SEPARATORS}](?![^ \\t-\\r])"))
    menu = low.rlike(f"^[ \\t-\\r]*({MENU_WORDS})([^a-z]|$)") & (n_words <= 4)
    return (
        ((seen["n_symbols"] > 0) & (_symbols(line) * 10 >= _characters(line)))
        | (seen["loud"] & _any_of(line, ("!!", "??", "!?", "?!")) & (loud * 3 >= n_words))
        | (seen["separated"] & (alone >= 3))
        | menu
        | (
            seen["boilerplate"]
            & _any_of(low, BOILERPLATE_WORDS)
            & let(
                _boilerplate(low),
                lambda n: (n > 0) & ((n_words <= FEW_WORDS) | (n * BOILERPLATE_SHARE >= _characters(line))),
            )
        )
    )


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """Two structs: ``doc`` with the columns of ``docs``, ``verdict`` with counts, ``kept``, ``clean``.

    ``clean`` is null where no line fails.
    """
    body = text_or_empty(F.col("doc")[text])
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))

    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words")
        )

    def of_lines(array: Column, seen: Column) -> Column:
        def with_failing(failing: Column) -> Column:
            lost = F.aggregate(failing, F.lit(0), lambda n, x: n + F.size(words(x)))
            good = F.filter(array, lambda x: ~line_fails(x, seen))
            return F.struct(
                (F.size(array) - F.size(F.array_distinct(array))).cast("long").alias("n_dup_lines"),
                lost.cast("long").alias("n_lost"),
                F.when(F.size(failing) > 0, F.array_join(good, "\n")).alias("clean"),
            )

        return let(F.filter(array, lambda x: line_fails(x, seen)), with_failing)

    low = F.lower(body)
    seen = F.struct(
        _symbols(body).cast("long").alias("n_symbols"),
        _any_of(body, ("!!", "??", "!?", "?!")).alias("loud"),
        _any_of(body, SEPARATORS).alias("separated"),
        let(low, lambda x: _any_of(x, BOILERPLATE_WORDS)).alias("boilerplate"),
    )

    def of_text(seen: Column) -> Column:
        return F.struct(seen["n_symbols"].alias("n_symbols"), let(lines, lambda x: of_lines(x, seen)).alias("l"))

    parts = F.struct(let(words(body), counts).alias("w"), let(seen, of_text).alias("s"))
    step = docs.select(F.struct("*").alias("doc")).withColumn("verdict", parts)
    n_words, n_repeat = F.col("verdict.w.n_words"), F.col("verdict.w.n_repeat_words")
    n_lost = F.col("verdict.s.l.n_lost")
    base_failed = (n_words < LEAST_WORDS) | (n_repeat * 100 > n_words * MOST_REPEATED_PERCENT)
    return step.withColumn(
        "verdict",
        F.struct(
            n_words.alias("n_words"),
            _characters(body).cast("long").alias("word_chars"),
            F.col("verdict.s.n_symbols").alias("n_symbols"),
            F.col("verdict.s.l.n_dup_lines").alias("n_dup_lines"),
            n_repeat.alias("n_repeat_words"),
            base_failed.alias("base_failed"),
            n_lost.alias("n_lost"),
            (~base_failed & (n_lost * 100 <= n_words * MOST_LOST_PERCENT)).alias("kept"),
            F.col("verdict.s.l.clean").alias("clean"),
        ),
    )


def report(docs: DataFrame) -> DataFrame:
    """One row per document: its counts and the verdict."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged(docs.select("doc_id", "text")).select("doc.doc_id", *[F.col(f"verdict.{n}").alias(n) for n in names])


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents that pass, without their failing lines, in the columns of ``docs``.

    A text without failing lines is returned as it is, blank lines included; ``n_chars``, if
    there is one, follows the text.
    """
    same = F.col("verdict.n_lost") == 0
    new = {
        "text": F.when(same, F.col("doc.text")).otherwise(F.col("verdict.clean")),
        "n_chars": F.when(same, F.col("doc.n_chars")).otherwise(F.length("verdict.clean")),
    }
    columns = [new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns]
    # As a generator: a filter would be pushed down and judge every text a second time.
    passed = F.explode(F.filter(F.array("verdict"), lambda v: v["kept"]))
    return judged(docs).select("doc", passed.alias("verdict")).select(columns)


SQL_REPORT = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, t, list_filter(regexp_split_to_array(t, '[ \t-\r]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS ls FROM d),
win AS (SELECT k, i, list_slice(ws, i, i + 7) AS x FROM (SELECT k, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM w WHERE len(ws) > 8)),
rep AS (SELECT k, i FROM win QUALIFY count(*) OVER (PARTITION BY k, x) > 1),
cov AS (SELECT k, sum(least(8, i - coalesce(before, i - 8))) AS n
        FROM (SELECT k, i, lag(i) OVER (PARTITION BY k ORDER BY i) AS before FROM rep) GROUP BY k),
line AS (SELECT k, x, len(list_filter(regexp_split_to_array(x, '[ \t-\r]+'), lambda y: y <> '')) AS n,
                list_filter(regexp_split_to_array(x, '[ \t-\r]+'), lambda y: y <> '') AS ws,
                ' ' || replace(regexp_replace(replace(lower(x), 'copyright (c)', '©'), '[^a-z©]+', '  ', 'g'), '©', '  ©  ') || ' ' AS z
         FROM (SELECT k, unnest(ls) AS x FROM w)),
phrase AS (SELECT *, regexp_replace(z, ' (cookies?|privacy  policy|terms  of  use|terms  of  service|all  rights  reserved|enable  javascript|lorem  ipsum|click  here|©) ', '  ', 'g') AS y FROM line),
lost AS (SELECT k, sum(n) AS n FROM phrase
         WHERE len(x) - len(translate(x, '#*$%&|<>', '')) >= 0.1 * len(regexp_replace(x, '[ \t-\r]', '', 'g'))
            OR 3 * len(list_filter(ws, lambda y: regexp_matches(y, '[!?][!?]$'))) >= n
            OR len(list_filter(ws, lambda y: y IN ('|', '»', '›', '•', '·'))) >= 3
            OR n <= 4 AND regexp_matches(lower(x), '^[ \t-\r]*(home|menu|login|log in|sign in|sign up|search|next|previous|back to top|share|subscribe|contact us|sitemap)([^a-z]|$)')
            OR len(y) < len(z) AND (n <= 12 OR 4 * (len(z) - len(y)) >= len(regexp_replace(x, '[ \t-\r]', '', 'g')))
         GROUP BY k),
c AS (SELECT doc_id, len(ws)::BIGINT AS n_words, len(regexp_replace(t, '[ \t-\r]', '', 'g'))::BIGINT AS word_chars,
             (len(t) - len(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0) AS n_lost
      FROM w LEFT JOIN cov USING (k) LEFT JOIN lost USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * n_lost <= 50 * n_words AS kept
FROM c
"""

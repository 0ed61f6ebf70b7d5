"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Each rule is a condition that rejects. Its cost and the part it rejects are measured on a sample, and
the rules run in falling order of rejection per cost, so that most bad documents meet a cheap rule
first. The verdict is that no rule rejects; the order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from reviewlake.llm.texts import WORD, shielded
from reviewlake.operators.placement import shuffle_width

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8
SAMPLE_ROWS = 400


@dataclass(frozen=True)
class Rule:
    """``rejects`` may use the columns of ``features``."""

    name: str
    rejects: Column


def rules() -> list[Rule]:
    """The production rules. Shares are of words or of characters in words."""
    stutter = F.expr("size(filter(_words, (w, i) -> i > 0 AND w = _words[i - 1]))")
    lines = F.expr(r"size(filter(split(_text, '\n'), x -> x RLIKE '[^\\x20\\x09-\\x0D]'))")
    return [
        Rule("symbols", F.col("n_symbols") * 10 > F.col("n_words")),
        Rule("capitals", F.regexp_count("_text", F.lit(r"\p{Lu}")) * 10 > F.col("word_chars") * 3),
        Rule("exclamations", F.regexp_count("_text", F.lit("!")) * 10 > F.col("n_words") * 3),
        Rule("stutter", stutter * 10 > F.col("n_words") * 3),
        Rule("line_copies", F.col("n_dup_lines") * 10 > lines * 8),
        Rule("word_length", (F.col("word_chars") < F.col("n_words") * 2) | (F.col("word_chars") > F.col("n_words") * 25)),
    ]


def features(documents: DataFrame) -> DataFrame:
    """Add _text, _words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (NULL text: empty).

    Repeats: the 8-word windows are hashed to 64 bits. Only a text with an equal pair among them has its
    windows sorted by hash; those with an equal neighbour give the positions whose words are counted,
    each word once. All of it stays inside the row, so the cost of a text is about its own length.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.expr(r"filter(split(_text, '\n'), x -> x RLIKE '[^\\x20\\x09-\\x0D]')")
    with_words = documents.withColumn("_text", text).withColumn("_words", F.array_remove(F.split("_text", SPACE), ""))
    counted = (
        with_words.withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long"))
        .withColumn("_lines", lines)
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn(
            "_windows",
            F.expr(f"CASE WHEN n_words > {WINDOW} THEN transform(sequence(1, int(n_words) - {WINDOW - 1}), i -> xxhash64(slice(_words, i, {WINDOW}))) END"),
        )
    )
    paired = counted.withColumn(
        "_sorted",
        F.expr("CASE WHEN size(array_distinct(_windows)) < size(_windows) THEN sort_array(transform(_windows, (h, i) -> struct(h AS h, i AS i))) END"),
    )
    places = paired.withColumn(
        "_places",
        F.expr("sort_array(transform(filter(_sorted, (x, k) -> get(_sorted, k - 1).h <=> x.h OR get(_sorted, k + 1).h <=> x.h), x -> x.i))"),
    )
    covered = F.expr(
        f"aggregate(_places, struct(0L AS total, 0 AS upto), (a, p) -> struct(a.total + {WINDOW} + p - greatest(a.upto, p) AS total, p + {WINDOW} AS upto), a -> a.total)"
    )
    made = places.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_lines", "_windows", "_sorted", "_places")
    # the optimizer would push a filter on a feature below the columns it is made of, and split a text again for each of its
    # words; it does not move one below a column that depends on the task
    here = F.spark_partition_id() >= 0
    return made.withColumns({c: F.when(here, F.col(c)) for c in FEATURES})


FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def measure(documents: DataFrame, candidates: list[Rule], sample_rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """{rule: (seconds, rejected part)} on the first ``sample_rows`` rows; only the order hangs on it.

    A sample brings at most ``sample_rows`` texts together, whatever the size of the table.
    """
    spark = documents.sparkSession
    head = documents.select("text").limit(sample_rows).collect()
    if not head:
        return {rule.name: (1.0, 0.0) for rule in candidates}
    sample = features(spark.createDataFrame(head, "text string").repartition(min(4, shuffle_width(spark)))).persist()
    try:
        sample.count()
        measured = {}
        for rule in candidates:
            seconds = []
            for _ in range(2):
                started = time.monotonic()
                rejected = sample.agg(F.avg(F.coalesce(rule.rejects, F.lit(False)).cast("double")).alias("part")).first()["part"]
                seconds.append(time.monotonic() - started)
            measured[rule.name] = (max(min(seconds), 1e-6), rejected)
        return measured
    finally:
        sample.unpersist()


def cascade(candidates: list[Rule], measured: dict[str, tuple[float, float]]) -> list[Rule]:
    """Rules by rejected part per second, best first; equal ones by name."""
    return sorted(candidates, key=lambda r: (-measured[r.name][1] / measured[r.name][0], r.name))


def verdict(ordered: list[Rule], failed: Column) -> Column:
    """True if nothing rejects. CASE stops at the first branch that holds."""
    kept = F.when(failed, False)
    for rule in ordered:
        kept = kept.when(rule.rejects, False)
    return kept.otherwise(True)


def judge(documents: DataFrame, candidates: list[Rule] | None = None) -> DataFrame:
    """Rows of ``documents`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    NULL and empty texts have no words and fail the base. Columns of the input with these names, or that
    begin with an underscore, are replaced; every row gives one row, repeated ones alike.
    """
    candidates = rules() if candidates is None else candidates
    added = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    clash = [c for c in documents.columns if c.lower() in added or c.startswith("_")]
    rows = documents.drop(*clash)
    ordered = cascade(candidates, measure(rows, candidates))
    judged = features(rows).withColumn("base_failed", base_failed()).withColumn("kept", verdict(ordered, F.col("base_failed")))
    return judged.drop("_text", "_words")


def keep_good(documents: DataFrame) -> DataFrame:
    """Rows whose verdict is to keep them, with the columns of ``documents`` as they are, whatever their names."""
    return shielded(documents, lambda rows: judge(rows).where("kept"), ("text",))


_SQL_WORDS = rf"regexp_extract_all(coalesce(text, ''), '{WORD}')"
#: The same over DuckDB.
SQL = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t, {_SQL_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM documents
), counted AS (
  SELECT doc_id, t, w, len(lines) AS n_lines, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    [array_to_string(w[i:i+{WINDOW - 1}], ' ') for i in range(1, len(w) - {WINDOW - 2})] AS windows
  FROM split
), numbered AS (SELECT *, row_number() OVER () AS row_id FROM counted),
twice AS (SELECT row_id, i, lag(i) OVER (PARTITION BY row_id ORDER BY i) AS before FROM (
    SELECT row_id, i, count(*) OVER (PARTITION BY row_id, win) AS n FROM (
      SELECT row_id, unnest(windows) AS win, generate_subscripts(windows, 1) AS i FROM numbered)) WHERE n > 1),
repeats AS (SELECT row_id, sum(least({WINDOW}, coalesce(i - before, {WINDOW})))::BIGINT AS n_repeat_words FROM twice GROUP BY row_id),
judged AS (
  SELECT n.*, coalesce(r.n_repeat_words, 0) AS n_repeat_words,
    n_words < 20 OR 100 * coalesce(r.n_repeat_words, 0) > 30 * n_words AS base_failed
  FROM numbered n LEFT JOIN repeats r USING (row_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols * 10 > n_words
    OR len(regexp_extract_all(t, '\p{{Lu}}')) * 10 > word_chars * 3
    OR len(regexp_extract_all(t, '!')) * 10 > n_words * 3
    OR len([1 for i in range(2, len(w) + 1) if w[i] = w[i-1]]) * 10 > n_words * 3
    OR n_dup_lines * 10 > n_lines * 8
    OR word_chars < n_words * 2 OR word_chars > n_words * 25) AS kept
FROM judged
"""

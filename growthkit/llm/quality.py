"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of any other characters than space and \t to \r.
SPACES = r"[\x20\x09-\x0D]"
WINDOW = 8

# Frequent function words of English, Spanish, French and German.
STOP_WORDS = (
    "a and are as at be by for from he in is it not of on or that the this to was with you "
    "al con de del el en es la las lo los no para por que se su una un y "
    "au avec ce dans des du elle est et il le les ne ou par pas pour qui sur une "
    "auf das dem den der die ein eine für im ist mit nicht sich und von zu"
).split()


@dataclass(frozen=True)
class Rule:
    """100 * part must lie between low and high times whole, in texts of at least `words` words."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None
    words: int = 0

    def fails(self) -> str:
        bounds = []
        if self.low is not None:
            bounds.append(f"100 * {self.part} < {self.low} * {self.whole}")
        if self.high is not None:
            bounds.append(f"100 * {self.part} > {self.high} * {self.whole}")
        return f"(n_words >= {self.words} AND ({' OR '.join(bounds)}))"


RULES = (
    Rule("length of words", "word_chars", "n_words", low=300, high=1000, words=20),
    Rule("symbols", "n_symbols", "n_words", high=30),
    Rule("exclamation marks", "n_exclaims", "n_words", high=50),
    Rule("stop words", "n_stop_words", "n_words", low=5, words=50),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=50, words=20),
)
#: The fixed part of the verdict; the rules are the rest.
BASE_FAILED = "(n_words < 20 OR 100 * n_repeat_words > 30 * n_words)"


def verdict(rules: tuple[Rule, ...]) -> str:
    """SQL that is true for a text that no rule rejects; valid in Spark and in other engines."""
    return f"NOT ({' OR '.join([BASE_FAILED, *(r.fails() for r in rules)])})"


def _without(characters: str) -> str:
    """SQL for `body` without some characters; quicker than `translate`, since most texts hold none of them."""
    out = "body"
    for c in characters:
        out = f"replace({out}, '{c}')"
    return out


def _measured(docs: DataFrame, text: str) -> DataFrame:
    """`row`, a struct of all columns of `docs`, and the counts that the rules read.

    Each step reads the arrays of the step before at least twice, else the optimizer would merge the steps
    and compute an array again for every element of another.
    """
    rows = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    df = docs.select(rows.alias("row"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    df = df.select(
        "row",
        "body",
        F.array_remove(F.split("body", SPACES + "+"), "").alias("words"),
        F.filter(F.split("body", "\n"), lambda line: line.rlike(SPACES.replace("[", "[^"))).alias("lines"),
    )
    stop_words = ", ".join(f"'{w}'" for w in STOP_WORDS)
    df = df.selectExpr(
        "row",
        "CAST(size(words) AS LONG) AS n_words",
        "aggregate(words, 0L, (n, w) -> n + length(w)) AS word_chars",
        f"CAST(length(body) - length({_without('#*$%&|<>')}) AS LONG) AS n_symbols",
        f"CAST(length(body) - length({_without('!')}) AS LONG) AS n_exclaims",
        "CAST(size(lines) AS LONG) AS n_lines",
        "CAST(size(lines) - size(array_distinct(lines)) AS LONG) AS n_dup_lines",
        f"CAST(size(filter(words, w -> trim(TRAILING '.,;:!?' FROM lower(w)) IN ({stop_words}))) AS LONG) AS n_stop_words",
        "transform(words, w -> xxhash64(w)) AS hashes",
    )
    counts = [c for c in df.columns if c != "hashes"]
    # windows of eight words by doubling: two hashes of half the length make one
    for step in (1, 2, 4):
        half = f"transform(hashes, (x, i) -> xxhash64(x, get(hashes, i + {step})))"
        df = df.selectExpr(*counts, f"CASE WHEN size(hashes) >= {WINDOW} THEN {half} END AS hashes")
    df = df.selectExpr(*counts, f"slice(hashes, 1, greatest(size(hashes) - {WINDOW - 1}, 0)) AS windows")
    # most texts repeat no window; only the others are sorted
    df = df.selectExpr(
        *counts,
        "CASE WHEN size(array_distinct(windows)) < size(windows)"
        " THEN sort_array(transform(windows, (k, i) -> struct(k, i))) END AS sorted",
    )
    df = df.selectExpr(
        *counts,
        "sort_array(transform(filter(sorted, (x, j) -> coalesce(x.k = get(sorted, j - 1).k, false)"
        " OR coalesce(x.k = get(sorted, j + 1).k, false)), x -> x.i)) AS places",
    )
    return df.selectExpr(
        *counts,
        "coalesce(aggregate(places, named_struct('n', 0L, 'end', 0), (acc, i) -> named_struct("
        f"'n', acc.n + {WINDOW} - greatest(acc.end - i, 0), 'end', i + {WINDOW}), acc -> acc.n), 0L) AS n_repeat_words",
    )


def judged(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`row`, a struct of the columns of `docs`, with n_words, word_chars, n_symbols, n_exclaims, n_lines,
    n_dup_lines, n_stop_words, n_repeat_words, base_failed and kept.

    A word is a run of other characters than space and \\t to \\r; lines end at \\n and count if they
    hold a word; n_repeat_words counts the words in windows of eight words that stand twice or more in the
    text. Windows are compared by 64-bit hashes, within one text only. A null or empty text has no words and
    fails. Rows are judged one by one: repeated rows, ties and other columns play no part. Everything is
    built-in functions on one row, without a shuffle.
    """
    df = _measured(docs, text)
    return df.selectExpr("*", f"{BASE_FAILED} AS base_failed", f"{verdict(rules)} AS kept")


def quality_report(docs: DataFrame, id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of `docs`: its id, the counts and the verdict of `judged`."""
    df = judged(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), "text", rules)
    return df.select(F.col("row.id").alias(id), *[c for c in df.columns if c != "row"])


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of `docs` that `judged` keeps, with all their columns.

    A filter would be pushed below the steps of `_measured` and take their arrays apart; a generator is not.
    """
    kept = judged(docs, text, rules).select(F.explode(F.when(F.col("kept"), F.array("row"))).alias("row"))
    return kept.select("row.*")


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """`quality_report` over the table documents, in SQL with list functions; doc_id must be unique."""
    stop_words = ", ".join(f"'{w}'" for w in STOP_WORDS)
    no_space = SPACES.replace("[", "[^")
    return f"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '{no_space}+') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{no_space}')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM texts WHERE len(words) >= {WINDOW}
), keyed AS (
    SELECT doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS k FROM windows
), twice AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM keyed) WHERE n > 1
), covered AS (
    SELECT doc_id, sum(least({WINDOW}, coalesce(after - i, {WINDOW}))) AS n
    FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM twice) GROUP BY doc_id
), counts AS (
    SELECT doc_id, len(words) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        length(regexp_replace(body, '[^!]', '', 'g')) AS n_exclaims,
        len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        len(list_filter(words, lambda x: rtrim(lower(x), '.,;:!?') IN ({stop_words}))) AS n_stop_words,
        CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
    FROM texts LEFT JOIN covered USING (doc_id)
)
SELECT *, {BASE_FAILED} AS base_failed, {verdict(rules)} AS kept FROM counts"""

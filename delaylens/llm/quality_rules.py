"""Quality rules: a table of thresholds compiled into one projection of native expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACES, words_of

#: Common function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for with on was by are as this it an be "
    "der die und das den von zu ist mit des "
    "le la les de et un une est que qui en pour dans "
    "el los las y del se con por su"
).split()
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Keep a text when ``low <= measure <= high``; an open end is None."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Ratios are per word, except dup_line_ratio (per line with a word).
RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 15.0),
    Rule("symbols", "symbol_ratio", None, 0.15),
    Rule("stop_words", "stop_ratio", 0.04, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.7),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _repeat_words(words: Column) -> Column:
    """Words inside a window of three words that occurs twice or more in the text.

    Windows are sorted with their positions, so equal ones are neighbours; each repeated position then counts for
    up to three words, less where the next repeated position is nearer.
    """
    n = F.size(words) - 2
    windows = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(
            F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i")),
    )

    def positions(s: Column) -> Column:
        same = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, b: F.when(
            a["w"] == b["w"], F.array(a["i"], b["i"])))
        return F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda p: p.isNotNull()))))

    def covered(p: Column) -> Column:
        gaps = F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1),
                          lambda a, b: F.least(b - a, F.lit(3)))
        return F.when(F.size(p) > 0, F.aggregate(gaps, F.lit(3), lambda acc, g: acc + g)).otherwise(F.lit(0))

    # transform over a one-element array binds a value that is used more than once
    def bound(value: Column, use) -> Column:
        return F.get(F.transform(F.array(value), use), F.lit(0))

    counted = bound(F.sort_array(windows), lambda s: bound(positions(s), covered))
    return F.when(n > 1, counted).otherwise(F.lit(0)).cast("long")


def measures(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Add the measures of ``text`` as columns: counts ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``,
    ``n_dup_lines``, ``n_repeat_words``, ``n_stop_words``; ``prefix`` avoids clashes with columns of ``docs``.

    A NULL text has no words and all counts 0; so has an empty one.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    parts = docs.withColumns({
        f"{prefix}words": words_of(F.col(text)),
        f"{prefix}lines": F.filter(F.split(body, "\n"), lambda s: F.length(F.translate(s, SPACES, "")) > 0),
    })
    words, lines = F.col(f"{prefix}words"), F.col(f"{prefix}lines")
    return parts.withColumns({
        f"{prefix}n_words": F.size(words).cast("long"),
        f"{prefix}word_chars": F.length(F.translate(body, SPACES, "")).cast("long"),
        f"{prefix}n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
        f"{prefix}n_lines": F.size(lines).cast("long"),
        f"{prefix}n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        f"{prefix}n_repeat_words": _repeat_words(words),
        f"{prefix}n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
    }).drop(f"{prefix}words", f"{prefix}lines")


def failed_rules(rules=RULES, prefix: str = "") -> Column:
    """The names of the rules that a row of ``measures`` breaks."""
    col = {c: F.col(f"{prefix}{c}") for c in
           ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words")}
    ratios = {
        "mean_word_chars": _ratio(col["word_chars"], col["n_words"]),
        "symbol_ratio": _ratio(col["n_symbols"], col["n_words"]),
        "stop_ratio": _ratio(col["n_stop_words"], col["n_words"]),
        "dup_line_ratio": _ratio(col["n_dup_lines"], col["n_lines"]),
    }
    broken = []
    for rule in rules:
        value, test = ratios[rule.measure], F.lit(False)
        if rule.low is not None:
            test = test | (value < rule.low)
        if rule.high is not None:
            test = test | (value > rule.high)
        broken.append(F.when(test, F.lit(rule.name)))
    return F.array_compact(F.array(*broken))


def base_failed(prefix: str = "") -> Column:
    """Fewer than 50 words, or more than half of them inside repeated windows."""
    n, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 50) | (100 * repeated > 50 * n)


def judged(docs: DataFrame, text: str = "text", rules=RULES, prefix: str = "__") -> DataFrame:
    """``docs`` with the measures, ``base_failed``, ``failed_rules`` and ``kept``, all named with ``prefix``.

    Rows stay as they are: repeated rows are judged alike, extra columns pass through, an empty table stays empty.
    """
    rows = measures(docs, text, prefix)
    rows = rows.withColumns({f"{prefix}base_failed": base_failed(prefix), f"{prefix}failed_rules":
                             failed_rules(rules, prefix)})
    kept = ~F.col(f"{prefix}base_failed") & (F.size(f"{prefix}failed_rules") == 0)
    # not deterministic in name: else a filter on the verdict is pushed below the measures, and each of its uses of
    # the words splits the text again
    kept = kept & (F.monotonically_increasing_id() >= 0)
    return rows.withColumn(f"{prefix}kept", kept)


def keep_good(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their own columns."""
    return judged(docs, text, rules, "__quality_").where("__quality_kept").select(*[F.col(f"`{c}`") for c in docs.columns])


DIGEST = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts, base verdict and verdict."""
    rows = judged(docs.select("doc_id", "text"), prefix="q_")
    return rows.select("doc_id", *[F.col(f"q_{c}").alias(c) for c in DIGEST])


def check_sql(rules=RULES) -> str:
    """The digest in SQL."""
    listed = ", ".join(f"'{w}'" for w in STOP_WORDS)
    value = {"mean_word_chars": "word_chars / n_words", "symbol_ratio": "n_symbols / n_words",
             "stop_ratio": "n_stop / n_words", "dup_line_ratio": "n_dup_lines / n_lines"}
    tests = []
    for r in rules:
        tests += [f"coalesce({value[r.measure]}, 0) >= {r.low}"] if r.low is not None else []
        tests += [f"coalesce({value[r.measure]}, 0) <= {r.high}"] if r.high is not None else []
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
p AS (SELECT rid, len(ws) AS n, unnest(ws) AS x, unnest(range(len(ws))) AS i FROM w),
g AS (SELECT rid, i, n, x, lead(x, 1) OVER o AS y, lead(x, 2) OVER o AS z FROM p WINDOW o AS (PARTITION BY rid ORDER BY i)),
c AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, x, y, z) AS k FROM g WHERE i <= n - 3),
r AS (SELECT rid, count(DISTINCT i + s) AS n_repeat FROM c, (SELECT unnest([0, 1, 2]) AS s) WHERE k > 1 GROUP BY rid),
m AS (SELECT w.rid, doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(ls) AS n_lines,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words,
        len(list_filter(ws, lambda x: lower(x) IN ({listed}))) AS n_stop FROM w LEFT JOIN r ON w.rid = r.rid),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(tests)} AS kept FROM b"""

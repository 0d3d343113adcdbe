"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

Measures are built-in array and string expressions over the whole text; repeated three-word windows are found by
sorting a row's window hashes with their places, so cost stays n log n for very long texts.

Edge cases: a null text has no words and fails the base rule, as an empty one does; ratios over nothing count as 0;
an empty table gives an empty result; repeated rows are judged one by one; columns of the input are kept, and
the struct of measures has underscores added to its name if an input column has it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, table

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
#: Frequent function words of the languages served, lower case.
STOP_WORDS = (
    "a al an and as at auf be by con da das de del den der des die du ein eine el en es et for from he in is ist it la las le les los mit"
    " nicht no of on or par pas pour que qui se sich sie sur that the this to un una und une von was with y zu"
).split()


@dataclass(frozen=True)
class Rule:
    """A measure must lie within [least, most]; None: no bound on that side."""

    measure: str
    least: float | None = None
    most: float | None = None


#: The base rule comes first and is fixed; the others are the method's thresholds.
BASE_RULES = (Rule("n_words", least=50), Rule("repeat_ratio", most=0.5))
RULES = (
    Rule("mean_word_chars", least=2.0, most=14.0),
    Rule("symbol_ratio", most=0.05),
    Rule("stop_ratio", least=0.05),
    Rule("dup_line_ratio", most=0.5),
    Rule("chars_per_line", least=10.0),
)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _after(array: Column) -> Column:
    """The array without its first element."""
    return F.slice(array, 2, F.greatest(F.size(array) - 1, F.lit(0)))


def measured(docs: DataFrame, text_col: str = "text", name: str = "measures") -> DataFrame:
    """The input with a struct of all measures of its text.

    Every array that is used more than once is a column of its own until the end: the optimizer inlines the fields of
    structs, which would compute them once per use.
    """
    own = "_m"
    while any(c.startswith(own) for c in docs.columns):
        own = "_" + own
    c = lambda f: F.col(own + f)
    out = docs.withColumn(own + "text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    out = out.withColumns(
        {
            own + "words": F.filter(F.split(c("text"), SPACE), lambda w: w != ""),
            own + "lines": F.filter(F.split(c("text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            own + "n_symbols": (F.length(c("text")) - F.length(F.translate(c("text"), SYMBOLS, ""))).cast("long"),
            own + "word_chars": F.length(F.translate(c("text"), " \t\n\x0b\f\r", "")).cast("long"),
        }
    )
    w = c("words")
    windows = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(WINDOW)]))
    out = out.withColumns(
        {
            own + "n_words": F.size(w).cast("long"),
            own + "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long"),
            own + "n_lines": F.size(c("lines")).cast("long"),
            own + "n_dup_lines": (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
            own + "windows": F.when(F.size(w) >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")),
        }
    )
    # only rows with a window found twice sort theirs, with their places: equal hashes then stand side by side
    twice = F.size(F.array_distinct(c("windows"))) < F.size(c("windows"))
    placed = F.array_sort(F.transform(c("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn(own + "placed", F.when(twice, placed))
    twins = F.filter(F.zip_with(c("placed"), _after(c("placed")), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda p: p["a"]["h"] == p["b"]["h"])
    out = out.withColumn(own + "twins", twins)
    places = F.concat(F.transform(c("twins"), lambda p: p["a"]["i"]), F.transform(c("twins"), lambda p: p["b"]["i"]))
    out = out.withColumn(own + "places", F.sort_array(F.array_distinct(places)))
    # each place adds the words up to the next place, at most a window
    steps = F.zip_with(c("places"), _after(c("places")), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    out = out.withColumn(own + "n_repeat_words", F.coalesce(F.aggregate(steps, F.lit(0), lambda s, x: s + x), F.lit(0)).cast("long"))
    counts = ["n_words", "n_symbols", "word_chars", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words"]
    whole = F.struct(
        *[c(f).alias(f) for f in counts],
        _ratio(c("n_repeat_words"), c("n_words")).alias("repeat_ratio"),
        _ratio(c("word_chars"), c("n_words")).alias("mean_word_chars"),
        _ratio(c("n_symbols"), c("word_chars")).alias("symbol_ratio"),
        _ratio(c("n_stop_words"), c("n_words")).alias("stop_ratio"),
        _ratio(c("n_dup_lines"), c("n_lines")).alias("dup_line_ratio"),
        _ratio(c("word_chars"), c("n_lines")).alias("chars_per_line"),
    )
    kept = [F.col(f"`{x}`") for x in docs.columns if x != name]
    return out.select(*kept, whole.alias(name))


def compiled(rules: tuple[Rule, ...], name: str = "measures") -> Column:
    """True where every rule of the table holds."""
    out = F.lit(True)
    for r in rules:
        value = F.col(f"{name}.{r.measure}")
        if r.least is not None:
            out = out & (value >= r.least)
        if r.most is not None:
            out = out & (value <= r.most)
    return out


def apply_rules(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, name: str = "measures") -> DataFrame:
    """The input with its measures and, in the same struct, base_failed and kept, as the last column. One projection, no shuffle."""
    name = free_name(docs, name)
    whole = measured(docs, text_col, name)
    base = compiled(BASE_RULES, name)
    return whole.withColumn(name, F.struct(f"{name}.*", (~base).alias("base_failed"), (base & compiled(rules, name)).alias("kept")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: base measures and the verdict."""
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return apply_rules(table(spark, sf_dir, "documents")).select("doc_id", *[f"measures.{f}" for f in fields])


def rules_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same query for DuckDB, from the same table of thresholds."""
    bounds = [f"{r.measure} >= {r.least}" for r in rules if r.least is not None] + [f"{r.measure} <= {r.most}" for r in rules if r.most is not None]
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
c AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, len(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(l) AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop_words
  FROM d LEFT JOIN rep USING (r)),
m AS (
  SELECT *, coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_ratio, coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_chars,
         coalesce(n_symbols / nullif(word_chars, 0), 0) AS symbol_ratio, coalesce(n_stop_words / nullif(n_words, 0), 0) AS stop_ratio,
         coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_ratio, coalesce(word_chars / nullif(n_lines, 0), 0) AS chars_per_line,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(bounds)} AS kept
FROM m"""

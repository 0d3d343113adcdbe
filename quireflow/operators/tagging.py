"""Span tagging by token rules, with built-in functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The tokenizer: web addresses, words with inner points, quotes, slashes and hyphens, and single other characters.
TOKEN = r"https?://\S+|\w[\w.'/\-]*\w|\w|[^\w\s]"
DIGITS = r"^\d+$"
Rules = tuple[tuple[str, tuple[str, ...]], ...]


def rules(uri_host: str = "coll.example.org", prefix: str = "") -> Rules:
    """(label, one pattern per consecutive token); a pattern is searched in the token's text. uri_host: the host whose
    object addresses are tagged; prefix: put before each label."""
    # fixed values: labels and patterns
    plain = (
        ("GatheringDate", (r"\b\d{1,2}\.\d{1,2}\.\d{2,4}\b",)),
        ("GatheringDate", (r"\b\d{1,2}\.(I{1,3}|IV|V?I{0,3}|IX|X|XI|XII)\.\d{2,4}\b",)),
        ("GatheringDate", (r"\b(I{1,3}|IV|V?I{0,3}|IX|X|XI|XII)\.\d{2,4}\b",)),
        ("Geo_Longitude", (DIGITS, "^°$", r"\d{1,2}'[E|W]\b")),
        ("Geo_Latitude", (DIGITS, "^°$", r"\d{1,2}'[N|S]\b")),
        ("NURI", (rf"(?i)http://{re.escape(uri_host)}/u/[a-z0-9]{{6}}",)),
        ("Sex", ("(?:♀|♂|⚥)",)),
        ("Type", (r"(?i)\b(holotyp|lectotyp|neotyp|paralectotyp|paratyp|syntyp|type)[a-zA-Z]*\b",)),
    )
    return tuple((prefix + label, patterns) for label, patterns in plain)


def text_parts(text: Column) -> Column:
    """A text's tokens and the white space between them, in order: joined, they are the text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"(?U)(?:{TOKEN})|\s+"), F.lit(0))


def _is_gap(part: Column) -> Column:
    return part.rlike(r"(?U)^\s")


def _before(parts: Column, n: Column) -> Column:
    """Characters of the first n parts."""
    return F.length(F.array_join(F.slice(parts, F.lit(1), n), ""))


def tokens_of(texts: DataFrame, key: list[str], text_col: str = "text") -> DataFrame:
    """(key, tok_start, tok_end, token) of every token of texts with keys of their own; linear in a text's tokens."""
    parts = texts.select(*key, F.posexplode(text_parts(F.col(text_col))).alias("i", "t"))
    before = Window.partitionBy(*key).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.select(*key, "t", F.coalesce(F.sum(F.length("t")).over(before), F.lit(0)).cast("int").alias("tok_start"))
    return placed.where(~_is_gap(F.col("t"))).select(*key, "tok_start", (F.col("tok_start") + F.length("t")).alias("tok_end"), F.col("t").alias("token"))


def with_tags(texts: DataFrame, text_col: str = "text", labels: tuple[str, ...] | None = None, table: Rules | None = None) -> DataFrame:
    """Adds tags, an array of distinct (label, start, end, text) by start, end and label; labels: only these rules.

    Each part's place is its number until a rule has matched; only then are the characters before it counted.
    """
    chosen = [(label, patterns) for label, patterns in (rules() if table is None else table) if labels is None or label in labels]
    parted = texts.withColumn("_tg_parts", text_parts(F.col(text_col).cast("string")))
    numbered = F.transform("_tg_parts", lambda t, i: F.struct(i.alias("i"), t.alias("t")))
    tokened = parted.withColumn("_tg_tokens", F.filter(numbered, lambda x: ~_is_gap(x["t"])))

    def found(label: str, patterns: tuple[str, ...]) -> Column:
        def match(x: Column, j: Column) -> Column:
            hit, last = x["t"].rlike(patterns[0]), x["i"]
            for k, p in enumerate(patterns[1:], 1):
                follower = F.get("_tg_tokens", j + k)
                hit, last = hit & follower["t"].rlike(p), follower["i"]
            return F.when(hit, F.struct(x["i"].alias("a"), last.alias("b"), F.lit(label).alias("label")))

        return F.filter(F.transform("_tg_tokens", match), lambda s: s.isNotNull())

    none = F.array().cast("array<struct<a:int,b:int,label:string>>")
    matched = tokened.withColumn("_tg_found", F.array_sort(F.array_distinct(F.concat(none, *[found(*r) for r in chosen]))))

    def span(s: Column) -> Column:
        whole = F.array_join(F.slice("_tg_parts", s["a"] + 1, s["b"] - s["a"] + 1), "")
        start = _before(F.col("_tg_parts"), s["a"])
        return F.struct(s["label"].alias("label"), start.alias("start"), (start + F.length(whole)).alias("end"), whole.alias("text"))

    return matched.withColumn("tags", F.transform("_tg_found", span)).drop("_tg_parts", "_tg_tokens", "_tg_found")


def expand_to_tokens(spans: DataFrame, tokens: DataFrame, key: list[str]) -> DataFrame:
    """Character ranges (key, start, end, ...) widened to the tokens (key, tok_start, tok_end, and token if wanted) that they touch.

    Adds span_start, span_end and first, the first token that is touched; a range that touches none goes. Tokens do not
    overlap, so a range begins with the first token that ends behind its start and ends with the last that begins before its end. Both are
    found by sorting ranges and tokens of a key together, once in each direction: what is read grows with ranges plus tokens, not with their product.
    """
    token = F.col("token") if "token" in tokens.columns else F.lit(None).cast("string")
    payload = F.struct(*[c for c in spans.columns if c not in key])
    ranges = spans.select(*key, F.lit(0).alias("_t"), F.col("start").alias("_a"), F.col("end").alias("_b"), F.lit(None).cast("string").alias("_token"), payload.alias("_r"))
    both = ranges.unionByName(tokens.select(*key, F.lit(1).alias("_t"), F.col("tok_start").alias("_a"), F.col("tok_end").alias("_b"), token.alias("_token"), F.lit(None).cast(ranges.schema["_r"].dataType).alias("_r")))
    is_token = F.col("_t") == 1
    # where both stand at one place a range comes first: a token that ends where it starts, or starts where it ends, is not touched
    back = Window.partitionBy(*key).orderBy(F.when(is_token, F.col("_b")).otherwise(F.col("_a")).desc(), "_t").rowsBetween(Window.unboundedPreceding, 0)
    on = Window.partitionBy(*key).orderBy(F.when(is_token, F.col("_a")).otherwise(F.col("_b")), "_t").rowsBetween(Window.unboundedPreceding, 0)
    first = F.min(F.when(is_token, F.struct("_a", "_token"))).over(back)
    last = F.max(F.when(is_token, F.col("_b"))).over(on)
    found = both.select(*key, "_t", "_b", "_r", first.alias("_first"), last.alias("_last")).where(~is_token & (F.col("_first._a") < F.col("_b")))
    return found.select(*key, "_r.*", F.col("_first._a").alias("span_start"), F.col("_last").alias("span_end"), F.col("_first._token").alias("first"))

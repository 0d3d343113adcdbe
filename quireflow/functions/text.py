"""Name, newline, attribute and score expressions (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stem(name: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def ground_truth_name(name: Column, compat: bool = False) -> Column:
    """The ground-truth file of an image. compat replaces every occurrence of the extension's text."""
    if compat:
        return F.replace(name, F.substring_index(name, ".", -1), F.lit("xml"))
    return F.concat(stem(name), F.lit(".xml"))


def unix_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\r\n"), F.lit("\n"))


def cleaned_reading(text: Column) -> Column:
    """A recogniser's answer: doubled newlines once made single, then white space trimmed."""
    return F.regexp_replace(F.replace(text, F.lit("\n\n"), F.lit("\n")), r"^\s+|\s+$", "")


def region_text(text: Column, lines: Column) -> Column:
    """A region's own text, else its lines' texts joined by a space."""
    return F.coalesce(unix_newlines(text), F.array_join(lines, " "))


def custom_attributes(custom: Column) -> Column:
    """'tag {body} tag {body}' as an array of (tag, body); none for null."""
    tags, bodies = (F.regexp_extract_all(custom, F.lit(r"(\w+)\s*\{([^}]*)\}"), F.lit(i)) for i in (1, 2))
    pairs = F.zip_with(tags, bodies, lambda t, b: F.struct(t.alias("tag"), F.trim(b).alias("body")))
    return F.coalesce(pairs, F.array().cast("array<struct<tag:string,body:string>>"))


def attribute_value(body: Column, key: str) -> Column:
    """The last value of a key in 'k:v; k:v;', null if absent."""
    found = F.regexp_extract_all(body, F.lit(rf"(?:^|;)\s*{key}\s*:([^;]*)"), F.lit(1))
    return F.trim(F.try_element_at(found, F.lit(-1)))


def ordered_join(index: Column, text: Column, separator: str) -> Column:
    """Aggregate: texts in index order, joined."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(index.alias("i"), text.alias("t")))), lambda x: x["t"]), separator)


def crop_source(name: Column) -> Column:
    """The source image of a crop: the name up to its first point, less its last two characters (the crop's number), as .jpg."""
    base = F.substring_index(name, ".", 1)
    return F.concat(F.left(base, F.greatest(F.length(base) - 2, F.lit(0))), F.lit(".jpg"))


def run_stamp(at: Column) -> Column:
    """A run's id from its start: yyyyMMdd-HHmmss."""
    return F.date_format(at, "yyyyMMdd-HHmmss")


def scores(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """precision, recall and f1 in percent, each from unrounded shares."""
    p = F.coalesce(F.try_divide(tp.cast("double"), tp + fp), F.lit(0.0))
    r = F.coalesce(F.try_divide(tp.cast("double"), tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    return [F.bround(x * 100, 2).alias(n) for x, n in ((p, "precision"), (r, "recall"), (f1, "f1"))]


def character_errors(read: Column, truth: Column) -> Column:
    """Edits per true character; null for an empty truth."""
    return F.try_divide(F.levenshtein(read, truth).cast("double"), F.length(truth))

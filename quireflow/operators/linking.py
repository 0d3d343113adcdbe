"""Linking of place names to a gazetteer table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quireflow.config import GEO_LABELS


def grouped_gazetteer(gazetteer: DataFrame) -> DataFrame:
    """(name, geoname_ids): all ids of a name, by rank."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "geoname_id")))
    return gazetteer.groupBy("name").agg(F.transform(ranked, lambda x: x["geoname_id"]).alias("geoname_ids"))


def link_spans(spans: DataFrame, gazetteer: DataFrame, labels: tuple[str, ...] = GEO_LABELS, distance: int = 0) -> DataFrame:
    """Place-name spans with their ids; spans without a hit go.

    Distinct names are looked up once. With a distance, names up to that many edits away count too, nearest first:
    words within the distance share a word made by deleting that many characters, which is an equality join.
    """
    places = spans.where(F.col("label").isin(*labels))
    if distance == 0:
        return places.join(grouped_gazetteer(gazetteer), places["text"] == F.col("name")).drop("name")
    names = places.select("text").distinct()
    keyed = lambda df, c: df.withColumn("k", F.explode(_deletions(F.col(c), distance)))
    near = keyed(names, "text").join(keyed(gazetteer, "name"), "k").select("text", "name", "rank", "geoname_id").distinct()
    near = near.withColumn("edits", F.levenshtein("text", "name")).where(F.col("edits") <= distance)
    ids = near.groupBy("text").agg(F.transform(F.array_sort(F.collect_list(F.struct("edits", "rank", "geoname_id"))), lambda x: x["geoname_id"]).alias("geoname_ids"))
    return places.join(ids, "text")


def _deletions(word, distance: int):
    """The word and all words made by deleting up to `distance` characters."""
    out = F.array(word)
    for _ in range(distance):
        shorter = F.flatten(
            F.transform(out, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w)))))
        )
        out = F.array_distinct(F.concat(out, shorter))
    return out


#: Characters of a gram, and the least similarity that grams can be used for.
GRAM, LEAST = 2, 0.5


def _allowed(length: Column, similarity: float) -> Column:
    """Edits that leave two names alike, by the longer one's length."""
    return F.floor(length * F.lit(round(1 - similarity, 9)) + 1e-9)


def _grams(name: Column) -> Column:
    """A name's runs of GRAM characters, its ends marked, each numbered among its equals, so that they are a set."""
    marked = F.concat(F.lit("\u0002"), name, F.lit("\u0003"))
    runs = F.transform(F.sequence(F.lit(1), F.length(name) + 1), lambda i: F.substring(marked, i, F.lit(GRAM)))
    bound = F.transform(F.array(runs), lambda r: F.transform(r, lambda g, i: F.concat(g, F.size(F.filter(F.slice(r, F.lit(1), i), lambda x: x == g)).cast("string"))))
    return F.get(bound, F.lit(0))


def alike_names(names: DataFrame, known: DataFrame, similarity: float = 0.8) -> DataFrame:
    """(text, name, edits) of names (text) and known ones (name) that are alike: edits are at most 1 - similarity of the
    longer one's characters. Every such pair is found.

    An edit changes at most GRAM grams. Names with so many edits therefore share a gram among the first GRAM * edits + 1 of
    each, in any one order of grams; the rarest come first, so that few names meet. They meet by gram, with lengths that
    allow the similarity, and only then are edits counted, up to the bound. Nulls and empty names are like none.
    """
    if not LEAST <= similarity <= 1:
        raise ValueError(f"similarity is from {LEAST} to 1")
    side = lambda df, c: df.select(F.col(c).alias("w")).where(F.length(c) > 0).distinct().select("w", F.length("w").alias("n"), _grams(F.col("w")).alias("grams"))
    mine, theirs = side(names, "text"), side(known, "name")
    single = lambda df: df.select("w", "n", F.explode("grams").alias("g"))
    often = single(theirs).groupBy("g").agg(F.count(F.lit(1)).alias("often"))

    def prefix(df: DataFrame) -> DataFrame:
        """The rarest grams of a name, as many as a partner of any length that allows the similarity calls for."""
        rare = Window.partitionBy("w").orderBy(F.coalesce("often", F.lit(0)), "g")
        ranked = single(df).join(often, "g", "left").select("w", "n", "g", F.row_number().over(rare).alias("r"))
        longest = F.floor(F.col("n") / F.lit(similarity) + 1e-9)
        return ranked.where(F.col("r") <= GRAM * _allowed(longest, similarity) + 1).select("w", "n", "g")

    a, b = (prefix(df).select(F.col("w").alias(w), F.col("n").alias(n), "g") for df, w, n in ((mine, "text", "a_n"), (theirs, "name", "b_n")))
    longer, shorter = F.greatest("a_n", "b_n"), F.least("a_n", "b_n")
    met = a.join(b, "g").where(longer - shorter <= _allowed(longer, similarity)).select("text", "name", _allowed(longer, similarity).cast("int").alias("most")).distinct()
    counted = met.select("text", "name", F.call_function("levenshtein", "text", "name", "most").alias("edits"))
    return counted.where("edits >= 0")


def link_alike(spans: DataFrame, gazetteer: DataFrame, labels: tuple[str, ...] = GEO_LABELS, similarity: float = 0.8) -> DataFrame:
    """Place-name spans with the ids of all names that are alike, nearest first; spans without a hit go. Distinct names are looked up once."""
    places = spans.where(F.col("label").isin(*labels))
    ids = alike_names(places, gazetteer, similarity).join(gazetteer, "name")
    grouped = ids.groupBy("text").agg(F.transform(F.array_sort(F.collect_list(F.struct("edits", "rank", "geoname_id"))), lambda x: x["geoname_id"]).alias("geoname_ids"))
    return places.join(grouped, "text")

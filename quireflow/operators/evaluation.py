"""Scores of readings, tags and links against ground truth."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from quireflow.functions.text import attribute_value, character_errors, ordered_join, scores
from quireflow.operators.tagging import expand_to_tokens, tokens_of


def count_gate(truth: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    """Keys whose truth and prediction have the same number of rows."""
    n = lambda df, name: df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return n(truth, "n_gt").join(n(predicted, "n_pred"), key).where("n_gt = n_pred").select(key)


def best_order(cost: list[list[int]]) -> list[int]:
    """For each column the row that serves it at the least total cost; ties go to the lexicographically first order.

    Shortest augmenting paths with potentials give the optimum; the order among optima is then fixed column by column
    over the edges without slack.
    """
    n = len(cost)
    rows_price, cols_price, row_of = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for column in range(1, n + 1):
        row_of[0], at = column, 0
        least, way, seen = [float("inf")] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        while row_of[at]:
            seen[at], here, delta, after = True, row_of[at], float("inf"), 0
            for j in range(1, n + 1):
                if not seen[j]:
                    slack = cost[j - 1][here - 1] - rows_price[here] - cols_price[j]
                    if slack < least[j]:
                        least[j], way[j] = slack, at
                    if least[j] < delta:
                        delta, after = least[j], j
            for j in range(n + 1):
                if seen[j]:
                    rows_price[row_of[j]] += delta
                    cols_price[j] -= delta
                else:
                    least[j] -= delta
            at = after
        while at:
            row_of[at] = row_of[way[at]]
            at = way[at]
    serves = {row_of[j] - 1: j - 1 for j in range(1, n + 1)}  # column -> row
    tight = [[r for r in range(n) if cost[r][c] == rows_price[c + 1] + cols_price[r + 1]] for c in range(n)]
    for c in range(n):
        for r in tight[c]:
            if r >= serves[c]:
                break
            if (moved := _reroute(serves, tight, c, r)) is not None:
                serves = moved
                break
    return [serves[c] for c in range(n)]


def _reroute(serves: dict[int, int], tight: list[list[int]], column: int, row: int) -> dict[int, int] | None:
    """The assignment with column on row, columns before it unchanged, along an alternating cycle; None if there is none."""
    owner = {r: c for c, r in serves.items()}
    if owner[row] <= column:
        return None
    free, came, todo = serves[column], {row: None}, [row]
    while todo:
        r = todo.pop()
        for to in tight[owner[r]]:
            if to in came or (to != free and owner[to] <= column):
                continue
            came[to] = r
            if to == free:
                moved = dict(serves)
                while came[to] is not None:
                    moved[owner[came[to]]] = to
                    to = came[to]
                moved[column] = row
                return moved
            todo.append(to)
    return None


#: Up to so many texts an assignment is an expression over all orders.
FEW = 3


def assigned_errors(texts: DataFrame, key: str, watch: Observation | None = None) -> DataFrame:
    """(key, bb_index, cer) of texts (key, idx, side 'gt' or 'pred', text), each prediction serving one truth so that
    all edits together are fewest (ties: the lexicographically first order). Keys with different counts give no rows; watch
    counts them (unequal) in the same pass. A null reading counts as empty, so it costs all of its truth.

    A key's texts meet in one row by one aggregate. Edit distances and, for up to FEW texts, the assignment are built-in
    expressions; Python sees the cost matrices of larger keys only.
    """
    side = lambda s: F.array_sort(F.collect_list(F.when(F.col("side") == s, F.struct("idx", "text"))))
    known = texts.withColumn("text", F.coalesce("text", F.lit("")))
    grouped = known.groupBy(key).agg(side("gt").alias("g"), side("pred").alias("p"))
    if watch is not None:
        grouped = grouped.observe(watch, F.count_if((F.size("g") > 0) & (F.size("g") != F.size("p"))).alias("unequal"))
    grouped = grouped.where((F.size("g") > 0) & (F.size("g") == F.size("p")))
    costs = F.transform("p", lambda p: F.transform("g", lambda g: F.levenshtein(p["text"], g["text"])))
    rows = grouped.select(key, F.transform("g", lambda g: F.struct(g["idx"].alias("idx"), F.length(g["text"]).alias("chars"))).alias("truths"), costs.alias("cost"))

    def best_of(n: int) -> Column:
        """The order (row per column) of the least sum; structs compare by sum, then by order."""
        orders = [F.struct(sum((F.col("cost")[r][c] for c, r in enumerate(o)), F.lit(0)).alias("sum"), F.array(*map(F.lit, o)).alias("order")) for o in permutations(range(n))]
        return F.array_min(F.array(*orders))["order"]

    order = F.when(F.size("truths") == 1, best_of(1))
    for n in range(2, FEW + 1):
        order = order.when(F.size("truths") == n, best_of(n))
    few = rows.where(F.size("truths") <= FEW).withColumn("order", order)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [best_order(m) for m in batch.column("cost").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], [*batch.schema.names, "order"])

    many = rows.where(F.size("truths") > FEW)
    solved = many.mapInArrow(solve, StructType([*many.schema.fields, StructField("order", ArrayType(IntegerType()))]))
    each = few.unionByName(solved).select(key, "cost", "order", F.posexplode("truths").alias("c", "t"))
    edits = F.get(F.get("cost", F.get("order", F.col("c"))), F.col("c"))
    return each.select(key, F.col("t.idx").alias("bb_index"), F.try_divide(edits.cast("double"), F.col("t.chars")).alias("cer"))


def region_errors(pairs: DataFrame) -> DataFrame:
    """Adds cer to (read, truth) pairs."""
    return pairs.withColumn("cer", character_errors(F.col("read"), F.col("truth")))


def tag_scores(truth: DataFrame, predicted: DataFrame, key: list[str], group: list[str]) -> DataFrame:
    """tp, fp, fn and scores per group, over distinct spans matched on key. A span with a null in its key is none."""
    truth, predicted = (side.na.drop(subset=key) for side in (truth, predicted))
    both = truth.select(*key).distinct().withColumn("g", F.lit(1)).join(predicted.select(*key).distinct().withColumn("p", F.lit(1)), key, "full")
    counted = both.groupBy(*group).agg(
        F.count_if(F.col("g").isNotNull() & F.col("p").isNotNull()).alias("tp"), F.count_if(F.col("g").isNull()).alias("fp"), F.count_if(F.col("p").isNull()).alias("fn")
    )
    return counted.select(*group, "tp", "fp", "fn", *scores(F.col("tp"), F.col("fp"), F.col("fn")))


def link_scores(truth: DataFrame, predicted: DataFrame, image: str = "image_name", labels: tuple[str, ...] | None = None, images: DataFrame | None = None) -> DataFrame:
    """tp, fp and scores of links per image: truth (image, text, geoname_id), predicted (image, text, geoname_ids).

    labels: only entities with one of them (column label) count, on both sides. Entities meet by surface text, many to many. There are no false negatives by definition. An image without a
    usable truth is not valid and has null scores. images: if given, those that neither side names have a row as well.
    """
    if labels is not None:
        truth, predicted = (side.where(F.col("label").isin(*labels)) for side in (truth, predicted))
    usable = truth.where(F.col("geoname_id").isNotNull())
    hit = F.array_contains(F.coalesce("geoname_ids", F.array().cast("array<bigint>")), F.col("geoname_id"))
    met = usable.join(predicted, [image, "text"]).groupBy(image).agg(F.count_if(hit).alias("tp"), F.count_if(~hit).alias("fp"))
    named = truth.select(image).union(predicted.select(image))
    images = (named if images is None else named.union(images.select(image))).distinct()
    known = usable.groupBy(image).agg(F.count(F.lit(1)).alias("n"))
    out = images.join(known, image, "left").join(met, image, "left").na.fill(0, ["n", "tp", "fp"]).withColumn("fn", F.lit(0).cast("long")).withColumn("valid", F.col("n") > 0)
    scored = [F.when(F.col("valid"), s).alias(n) for s, n in zip(scores(F.col("tp"), F.col("fp"), F.col("fn")), ("precision", "recall", "f1"), strict=True)]
    return out.select(image, "valid", "tp", "fp", "fn", *scored)


def line_offsets(lines: DataFrame, key: list[str], order: str, text: str, gap: int = 2) -> DataFrame:
    """Adds the start of each line in its region's text, lines being joined by `gap` characters."""
    before = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return lines.withColumn("start", F.coalesce(F.sum(F.length(text) + gap).over(before), F.lit(0)))


def region_tag_scores(truth: DataFrame, predicted: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """(image_name, region_idx, tp, fp, fn, scores): each predicted region's spans (start, end, label) against those of
    the image's first true region. predicted has a row per region at least, with null spans for one without any.

    regions (image_name, region_idx): all true regions, those without a span included; by default those that truth names.
    An image's first set of spans is made once, and a region's spans meet it as a set; spans with a null are none.
    """
    span = F.when(F.col("start").isNotNull() & F.col("end").isNotNull() & F.col("label").isNotNull(), F.concat_ws(":", "start", "end", "label"))
    spans = truth.select("image_name", "region_idx", span.alias("s"))
    every = spans if regions is None else spans.union(regions.select("image_name", "region_idx", F.lit(None).cast("string")))
    sets = lambda rows, name: rows.groupBy("image_name", "region_idx").agg(F.collect_set("s").alias(name))
    first = sets(every, "g").groupBy("image_name").agg(F.min_by("g", "region_idx").alias("g"))
    met = sets(predicted.select("image_name", "region_idx", span.alias("s")), "p").join(first, "image_name")
    n = lambda of: F.size(of).cast("long")
    counted = met.select("image_name", "region_idx", n(F.array_intersect("p", "g")).alias("tp"), n(F.array_except("p", "g")).alias("fp"), n(F.array_except("g", "p")).alias("fn"))
    return counted.select("image_name", "region_idx", "tp", "fp", "fn", *scores(F.col("tp"), F.col("fp"), F.col("fn")))


def prepared_truth(lines: DataFrame, labels: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Ground truth for tags and links, from page lines (image_name, region_idx, line_idx, text, attrs).

    (image_name, region_idx, text): the regions' texts, lines joined by an empty line; regions without text are left
    out. (image_name, region_idx, label, start, end, text, geoname_id): their marked ranges, widened to whole tokens. A
    range that touches no token is left out, as is an attribute without offset or length.
    """
    key = ["image_name", "region_idx"]
    joined = lines.groupBy(*key).agg(ordered_join(F.col("line_idx"), F.col("text"), "\n\n").alias("text")).where("text <> ''")
    placed = line_offsets(lines, key, "line_idx", "text").withColumnRenamed("start", "line_start")
    marked = placed.select(*key, "line_start", F.explode(F.filter("attrs", lambda a: a["tag"].isin(*labels))).alias("a"))
    value = lambda name: attribute_value(F.col("a.body"), name)
    start = F.col("line_start") + value("offset").cast("int")
    ranges = marked.select(*key, F.col("a.tag").alias("label"), start.alias("start"), (start + value("length").cast("int")).alias("end"), value("Geonames").cast("bigint").alias("geoname_id")).na.drop(subset=["start", "end"])
    wide = expand_to_tokens(ranges, tokens_of(joined, key), key).join(joined, key)
    length = F.col("span_end") - F.col("span_start")
    # a span is mostly one token, which is at hand; only others are cut from the text, which is read from its beginning for that
    text = F.when(F.length("first") == length, F.col("first")).otherwise(F.substring(F.col("text"), F.col("span_start") + 1, length))
    return joined, wide.select(*key, "label", F.col("span_start").alias("start"), F.col("span_end").alias("end"), text.alias("text"), "geoname_id")

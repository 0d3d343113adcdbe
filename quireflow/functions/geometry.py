"""Box, polygon and image-size expressions (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncated_box(x: Column, y: Column, w: Column, h: Column) -> Column:
    """Coordinates cut towards zero."""
    return F.struct(*[c.cast("int").alias(n) for c, n in zip((x, y, w, h), "xywh", strict=True)])


def normalized_box(box: Column, width: Column, height: Column) -> Column:
    share = lambda f, by: F.try_divide(box[f].cast("double"), by.cast("double"))
    return F.struct(share("x", width).alias("x"), share("y", height).alias("y"), share("w", width).alias("w"), share("h", height).alias("h"))


def box_to_coords(x: Column, y: Column, w: Column, h: Column) -> Column:
    """Four corners, clockwise from the upper left, as 'x,y x,y x,y x,y'."""
    corner = lambda a, b: F.concat_ws(",", a.cast("string"), b.cast("string"))
    return F.concat_ws(" ", corner(x, y), corner(x + w, y), corner(x + w, y + h), corner(x, y + h))


def parse_coords(points: Column) -> Column:
    """'x,y x,y ...' as an array of integer points."""
    parts = F.filter(F.split(F.trim(points), r"\s+"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(F.split(p, ",")[0].cast("int").alias("x"), F.split(p, ",")[1].cast("int").alias("y")))


def bounding_box(polygon: Column) -> Column:
    """Smallest box around a polygon's points."""
    xs, ys = F.transform(polygon, lambda p: p["x"]), F.transform(polygon, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x"), F.array_min(ys).alias("y"), (F.array_max(xs) - F.array_min(xs)).alias("w"), (F.array_max(ys) - F.array_min(ys)).alias("h"))


def box_iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes; null if both are empty."""
    overlap = lambda f, n: F.greatest(F.lit(0), F.least(a[f] + a[n], b[f] + b[n]) - F.greatest(a[f], b[f]))
    both = (overlap("x", "w") * overlap("y", "h")).cast("double")
    return F.try_divide(both, a["w"] * a["h"] + b["w"] * b["h"] - both)


def resized(width: Column, height: Column, most: int = 1920, compat: bool = False) -> Column:
    """Target size with the longest side at most `most`. compat keeps the known portrait distortion."""
    scaled = lambda v, by: F.floor(F.lit(most) * v / by).cast("int")
    landscape = F.struct(F.lit(most).alias("w"), scaled(height, width).alias("h"))
    portrait = F.struct((scaled(height, width) if compat else scaled(width, height)).alias("w"), F.lit(most).alias("h"))
    small = F.greatest(width, height) <= most
    return F.when(small, F.struct(width.cast("int").alias("w"), height.cast("int").alias("h"))).when(width >= height, landscape).otherwise(portrait)

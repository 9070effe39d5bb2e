"""Box geometry as column expressions. A box is (cx, cy, w, h), centre based and normalised."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NON_POSITIVE = "non-positive width/height"
OUT_OF_BOUNDS = "box extends outside image bounds"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def box_struct(cx, cy, w, h) -> Column:
    return F.struct(
        _col(cx).cast("double").alias("cx"),
        _col(cy).cast("double").alias("cy"),
        _col(w).cast("double").alias("w"),
        _col(h).cast("double").alias("h"),
    )


def from_pixels(x, y, w, h, width, height) -> Column:
    """Top-left pixel box to a normalised centre box; nothing is clamped."""
    x, y, w, h, width, height = (_col(v).cast("double") for v in (x, y, w, h, width, height))
    return box_struct((x + w / 2) / width, (y + h / 2) / height, w / width, h / height)


def from_corners(x1, y1, x2, y2) -> Column:
    """Corners in the given order; swapped corners show up as a side that is not positive."""
    x1, y1, x2, y2 = (_col(v).cast("double") for v in (x1, y1, x2, y2))
    return box_struct((x1 + x2) / 2, (y1 + y2) / 2, x2 - x1, y2 - y1)


def edges(cx, cy, w, h) -> tuple[Column, Column, Column, Column]:
    cx, cy, w, h = (_col(v) for v in (cx, cy, w, h))
    return cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2


def to_corners(cx, cy, w, h) -> Column:
    x1, y1, x2, y2 = edges(cx, cy, w, h)
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def invalid_kind(cx, cy, w, h, epsilon: float = 0.0) -> Column:
    """Null for a valid box, else which of the two defects it has; the side test comes first."""
    x1, y1, x2, y2 = edges(cx, cy, w, h)
    excess = F.greatest(-x1, -y1, x2 - F.lit(1.0), y2 - F.lit(1.0), F.lit(0.0))
    return F.when((_col(w) <= 0) | (_col(h) <= 0), F.lit(NON_POSITIVE)).when(
        excess > F.lit(epsilon), F.lit(OUT_OF_BOUNDS)
    )


def invalid_reason(cx, cy, w, h, epsilon: float = 0.0) -> Column:
    """The defect with the offending numbers, for reports."""
    kind = invalid_kind(cx, cy, w, h, epsilon)
    sides = F.concat(F.lit(f"{NON_POSITIVE} (w="), _col(w).cast("string"), F.lit(", h="), _col(h).cast("string"), F.lit(")"))
    bounds = F.format_string(OUT_OF_BOUNDS + " (x1=%.4f, y1=%.4f, x2=%.4f, y2=%.4f)", *edges(cx, cy, w, h))
    return F.when(kind == NON_POSITIVE, sides).when(kind == OUT_OF_BOUNDS, bounds)


def clip(cx, cy, w, h) -> Column:
    """Clamp every corner on its own, so a box wholly outside becomes one of zero size."""
    x1, y1, x2, y2 = (F.least(F.greatest(e, F.lit(0.0)), F.lit(1.0)) for e in edges(cx, cy, w, h))
    return from_corners(x1, y1, x2, y2)


def settle(box: Column | str) -> Column:
    """Validate, clip, check again: struct(status ok/clipped/invalid, box) shared by all converters."""
    box = _col(box)
    parts = tuple(box[f] for f in ("cx", "cy", "w", "h"))
    kind = invalid_kind(*parts)
    clipped = clip(*parts)
    status = (
        F.when(kind.isNull(), "ok")
        .when(kind == NON_POSITIVE, "invalid")
        .when((clipped["w"] <= 0) | (clipped["h"] <= 0), "invalid")
        .otherwise("clipped")
    )
    return F.struct(status.alias("status"), F.when(kind.isNull(), box).otherwise(clipped).alias("box"))


def area_fraction(w="w", h="h") -> Column:
    return _col(w) * _col(h)


def elongation(w="w", h="h") -> Column:
    short, long = F.least(_col(w), _col(h)), F.greatest(_col(w), _col(h))
    return F.when(short <= 0, F.lit(float("inf"))).otherwise(long / short)


def to_top_left(cx="cx", cy="cy", w="w", h="h") -> Column:
    cx, cy, w, h = (_col(v) for v in (cx, cy, w, h))
    return F.struct((cx - w / 2).alias("x"), (cy - h / 2).alias("y"), w.alias("w"), h.alias("h"))


def from_top_left(x="x", y="y", w="w", h="h") -> Column:
    x, y, w, h = (_col(v) for v in (x, y, w, h))
    return box_struct(x + w / 2, y + h / 2, w, h)


def corners_to_top_left(x1, y1, x2, y2) -> Column:
    x1, y1, x2, y2 = (_col(v) for v in (x1, y1, x2, y2))
    return F.struct(x1.alias("x"), y1.alias("y"), (x2 - x1).alias("w"), (y2 - y1).alias("h"))


def overlap_ratio(ax, ay, aw, ah, bx, by, bw, bh) -> Column:
    """Intersection over union of two top-left boxes; 0 when the union is empty."""
    ax, ay, aw, ah, bx, by, bw, bh = (_col(v) for v in (ax, ay, aw, ah, bx, by, bw, bh))
    wide = F.least(ax + aw, bx + bw) - F.greatest(ax, bx)
    tall = F.least(ay + ah, by + bh) - F.greatest(ay, by)
    inter = F.greatest(wide, F.lit(0.0)) * F.greatest(tall, F.lit(0.0))
    union = aw * ah + bw * bh - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def strip_project_prefix(source) -> Column:
    return F.regexp_replace(_col(source), "^roboflow_", "")


def merged_source(name) -> Column:
    """Source part of a merged name: the text before the first double underscore."""
    return F.substring_index(_col(name), "__", 1)


def stem(name) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(_col(name), r"(?<=.)\.[^.]*$", "")


def label_line(class_id="class_id", cx="cx", cy="cy", w="w", h="h") -> Column:
    return F.format_string("%d %.6f %.6f %.6f %.6f", *(_col(v) for v in (class_id, cx, cy, w, h)))

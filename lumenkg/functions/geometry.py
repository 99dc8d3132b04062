"""Boxes and directions as column expressions. Boxes are structs x1, y1, x2, y2 in pixels; y grows downwards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _scaled(c: Column, size: Column) -> Column:
    return (c / F.lit(1000.0) * size).cast("bigint")


def pixel_box(rx1: Column, ry1: Column, rx2: Column, ry2: Column, w: Column, h: Column) -> Column:
    """A box in thousandths of the image as whole pixels, at least one pixel wide before it meets the image's edge."""
    x1, y1 = F.greatest(F.lit(0).cast("bigint"), _scaled(rx1, w)), F.greatest(F.lit(0).cast("bigint"), _scaled(ry1, h))
    x2, y2 = F.least(w.cast("bigint"), F.greatest(x1 + 1, _scaled(rx2, w))), F.least(h.cast("bigint"), F.greatest(y1 + 1, _scaled(ry2, h)))
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def width(b: Column) -> Column:
    return b["x2"] - b["x1"]


def height(b: Column) -> Column:
    return b["y2"] - b["y1"]


def area(b: Column) -> Column:
    return width(b) * height(b)


def rounded(c: Column, digits: int) -> Column:
    """Half up, the same in both engines that results are compared in."""
    k = 10.0**digits
    return F.floor(c * k + 0.5) / k


def area_share(b: Column, w: Column, h: Column) -> Column:
    return area(b) / (w * h).cast("double")


def centre_x(b: Column) -> Column:
    return (b["x1"] + b["x2"]) / 2.0


def centre_y(b: Column) -> Column:
    return (b["y1"] + b["y2"]) / 2.0


def location_text(b: Column, w: Column, h: Column) -> Column:
    """Where a box lies in its image, in words (fixed values)."""
    rx, ry, share = centre_x(b) / w, centre_y(b) / h, area_share(b, w, h)
    across = F.when(rx < 0.2, "最左侧").when(rx < 0.4, "偏左").when(rx > 0.8, "最右侧").when(rx > 0.6, "偏右").otherwise("")
    down = F.when(ry < 0.2, "顶部").when(ry < 0.4, "上方").when(ry > 0.8, "底部").when(ry > 0.6, "下方").otherwise("")
    size = F.when(share > 0.15, "大幅").when(share < 0.005, "细小的").otherwise("")
    place = F.when((across == "") & (down == ""), "中央").otherwise(F.concat(down, across))
    return F.concat(size, F.lit("画面"), place)


def crop_views(b: Column, w: Column, h: Column) -> Column:
    """Rectangles of the five views of an entity, as an array of (view, x1, y1, x2, y2)."""
    bw, bh, zero = width(b), height(b), F.lit(0).cast("bigint")
    w, h = w.cast("bigint"), h.cast("bigint")

    def view(name: str, x1, y1, x2, y2) -> Column:
        return F.struct(F.lit(name).alias("view"), x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))

    def padded(name: str, share: float) -> Column:
        px, py = (bw * share).cast("bigint"), (bh * share).cast("bigint")
        return view(name, F.greatest(zero, b["x1"] - px), F.greatest(zero, b["y1"] - py), F.least(w, b["x2"] + px), F.least(h, b["y2"] + py))

    cx, cy = F.floor((b["x1"] + b["x2"]) / 2), F.floor((b["y1"] + b["y2"]) / 2)
    around = view("context", F.greatest(zero, cx - 2 * bw), F.greatest(zero, cy - 2 * bh), F.least(w, cx + 2 * bw), F.least(h, cy + 2 * bh))
    return F.array(view("tight", b["x1"], b["y1"], b["x2"], b["y2"]), padded("pad20", 0.2), padded("pad40", 0.4), around, view("full_scene", zero, zero, w, h))


def layout_direction(dx: Column, dy: Column) -> Column:
    """Direction of the second box seen from the first; equal distances count as vertical."""
    across = F.when(dx > 0, "right_of").otherwise("left_of")
    return F.when(F.abs(dx) > F.abs(dy), across).otherwise(F.when(dy > 0, "below").otherwise("above"))


def spatial_relation(dx: Column, dy: Column) -> Column:
    """Relation of the first box to the second; equal distances count as horizontal."""
    across = F.when(dx > 0, "located_left_of").otherwise("located_right_of")
    return F.when(F.abs(dx) >= F.abs(dy), across).otherwise(F.when(dy > 0, "located_above").otherwise("located_below"))


def compass_direction(dx: Column, dy: Column) -> Column:
    """One of eight directions (fixed values) of an offset; offsets within a pixel count as angle 0."""
    turn = F.when((F.abs(dx) <= 1) & (F.abs(dy) <= 1), F.lit(0.0)).otherwise(F.pmod(F.degrees(F.atan2(-dy, dx)), F.lit(360.0)))
    names = ("右上方", "上方", "左上方", "左方", "左下方", "下方", "右下方")
    out = F.when((turn < 22.5) | (turn >= 337.5), "右方")
    for k, name in enumerate(names):
        out = out.when(turn < 67.5 + 45 * k, name)
    return out

"""Geometry of pages: boxes, merged tables, raised characters, pixels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kodeks.functions.text import TO_RAISE, raised

SIDES = ["start_x", "end_x", "start_y", "end_y"]


def boxes_overlap(a: Column, b: Column) -> Column:
    """Two boxes share more than an edge."""
    return (a["start_x"] < b["end_x"]) & (b["start_x"] < a["end_x"]) & (a["start_y"] < b["end_y"]) & (b["start_y"] < a["end_y"])


def box_within(a: Column, b: Column) -> Column:
    """Box ``a`` lies in box ``b``, edges included."""
    return (a["start_x"] >= b["start_x"]) & (a["end_x"] <= b["end_x"]) & (a["start_y"] >= b["start_y"]) & (a["end_y"] <= b["end_y"])


def merge_tables(tables: Column) -> Column:
    """Tables of a page (an array of boxes, in text order) folded one after the other into the first region that they
    overlap vertically; the regions aren't merged with each other. Null and empty arrays stay as they are."""
    box = lambda x: F.struct(*[x[s].cast("double").alias(s) for s in SIDES])
    union = lambda a, b: F.struct(F.least(a["start_x"], b["start_x"]).alias("start_x"), F.greatest(a["end_x"], b["end_x"]).alias("end_x"), F.least(a["start_y"], b["start_y"]).alias("start_y"), F.greatest(a["end_y"], b["end_y"]).alias("end_y"))

    def fold(acc: Column, t: Column) -> Column:
        hits = F.transform(acc, lambda r: (r["start_y"] < t["end_y"]) & (t["start_y"] < r["end_y"]))
        at = F.array_position(hits, True)
        return F.when(at == 0, F.concat(acc, F.array(t))).otherwise(F.transform(acc, lambda r, i: F.when(i + 1 == at, union(r, t)).otherwise(r)))

    boxes = F.transform(tables, box)
    return F.aggregate(boxes, F.slice(boxes, 1, 0), fold)


def baseline_text(text: Column, bottom: Column, height: Column, line_bottom: Column, usual_height: Column, threshold: float = 2.5) -> Column:
    """A character of a line as it reads: raised where it ends more than ``threshold`` above the line's bottom and hasn't
    the line's usual height, and then a blank if there is no raised form of it."""
    up = (bottom + threshold < line_bottom) & (F.round(height, 1) != F.round(usual_height, 1)) & (text != " ")
    return F.when(up, F.when(F.contains(F.lit(TO_RAISE), text), raised(text)).otherwise(F.lit(" "))).otherwise(text)


def to_page(pixel: Column, image_size: Column, page_size: Column) -> Column:
    """A coordinate of a rendered image on its page; null where the image has no size."""
    return F.when(image_size > 0, pixel * page_size / image_size)

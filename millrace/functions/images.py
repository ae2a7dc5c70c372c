"""Column functions over pixel arrays: flat, row-major, channels last."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Luminance weights, the mean pixel taken off before training, the yellow HSV range.
GRAY = (0.299, 0.587, 0.114)
MEAN_PIXEL = (104.0, 117.0, 123.0)
YELLOW = ((20, 90, 90), (60, 255, 255))
COLOUR_CHECKED = ("SPEED_LIMIT_", "SL_")


def alpha_blend(background: Column, overlay: Column) -> Column:
    """Lay a 4-channel overlay over 3-channel pixels by its alpha; whole numbers 0 to 255.

    Fixed order of arithmetic: what is cut off at the end depends on it.
    """
    unit = F.lit(1 / 255.0)

    def mix(value: Column, i: Column) -> Column:
        pixel, c = F.floor(i / 3).cast("int"), i % 3
        mask = F.element_at(overlay, pixel * 4 + 4)
        below = (value * unit) * ((255 - mask) * unit)
        above = (F.element_at(overlay, pixel * 4 + c + 1) * unit) * (mask * unit)
        return F.floor(below * 255.0 + above * 255.0).cast("int")

    return F.transform(background, mix)


def restore_image(values: Column, height: int, width: int, mean: Sequence[float] = MEAN_PIXEL) -> Column:
    """Channels-first values to displayable pixels: add the mean, cut to a byte, reverse the channels."""
    plane = height * width
    means = F.array(*[F.lit(float(m)) for m in mean])

    def pixel(i: Column) -> Column:
        source = 2 - i % 3
        value = F.element_at(values, source * plane + F.floor(i / 3).cast("int") + 1) + F.element_at(means, source + 1)
        whole = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value))
        return F.pmod(whole, F.lit(256)).cast("int")

    return F.transform(F.sequence(F.lit(0), F.lit(3 * plane - 1)), pixel)


def colour_checked(cls: Column) -> Column:
    """True for classes whose boxes are checked by colour."""
    out = F.lit(False)
    for part in COLOUR_CHECKED:
        out = out | F.contains(cls, F.lit(part))
    return out


def rect_ratio(xmin: Column, ymin: Column, xmax: Column, ymax: Column, width: Column, height: Column) -> Column:
    """``struct(w_ratio, h_ratio)`` of a box in its image."""
    return F.struct(((xmax - xmin) / width).alias("w_ratio"), ((ymax - ymin) / height).alias("h_ratio"))


def rescale_point(value: Column, native: Column, shown: int) -> Column:
    """Coordinate on the shown image to native pixels, truncated."""
    return F.floor(value * (native / shown)).cast("int")

"""Pixel arithmetic on whole images: colour jitter and colour checks in Arrow batches.

Images are flat arrays, row-major, channels last. What is drawn per image (factors,
order, noise) comes from hashed columns; only the arithmetic on pixels is numpy,
over the images of one size of a batch together. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import hash01, hash32
from millrace.functions.images import COLOUR_CHECKED, GRAY, YELLOW, colour_checked

# Lowest factor of each jitter (the factor is up to 1 above it), strength of the
# shift along colour components, share of coloured pixels that removes an image.
LOWEST = {"saturation": 0.5, "brightness": 0.3, "contrast": 0.5}
LIGHT_STRENGTH = 0.5
COLOUR_SHARE = 0.5


# Each blend is ``alpha * x + (1 - alpha) * reference``; the reference is this share of the pixel's own
# luminance and this share of the image's mean luminance.
REFERENCE = {"saturation": (1.0, 0.0), "brightness": (0.0, 0.0), "contrast": (0.0, 1.0)}


def blended(images: np.ndarray, alpha: np.ndarray, own: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The affine form over a stack ``(image, pixel, channel)``; the other arguments are one number per image."""
    luminance = images @ np.array(GRAY)
    reference = own[:, None] * luminance + mean[:, None] * luminance.mean(1, keepdims=True)
    return alpha[:, None, None] * images + ((1.0 - alpha)[:, None] * reference)[..., None]


def colour_shift(images: np.ndarray, noise: np.ndarray) -> np.ndarray:
    """A shift per image along the principal components of its colours.

    Components in ascending order of their variance, each by its variance times its noise. The
    largest part of a component's direction is taken positive, because either sign would do.
    """
    unit = images / 255.0
    centred = unit - unit.mean(1, keepdims=True)
    covariance = np.einsum("npi,npj->nij", centred, centred) / max(1, images.shape[1] - 1)
    variance, directions = np.linalg.eigh(covariance)
    leading = np.take_along_axis(directions, np.abs(directions).argmax(1)[:, None, :], 1)
    directions = directions * np.where(leading < 0, -1.0, 1.0)
    return np.einsum("nij,nj->ni", directions, variance * noise)[:, None, :] * 255.0


def jittered(images: np.ndarray, turns: np.ndarray, alphas: np.ndarray, noise: np.ndarray, names: Sequence[str]) -> np.ndarray:
    """A stack of images of one size after all jitters; ``turns[:, t]`` is the place in ``names`` of the image's t-th jitter."""
    own, mean = (np.array([REFERENCE.get(n, (0.0, 0.0))[k] for n in names]) for k in (0, 1))
    shifts = np.array([n == "lighting" for n in names])
    for turn in turns.T:
        images = images.copy()
        shift = shifts[turn]
        images[shift] += colour_shift(images[shift], noise[shift]) if shift.any() else 0.0
        mix, at = ~shift, turn[~shift]
        images[mix] = blended(images[mix], alphas[mix, at], own[at], mean[at])
        images = np.clip(images, 0.0, 255.0)
    return images


def pixel_jitter(
    df: DataFrame, pixels: str, *key: str, enabled: Sequence[str] = ("brightness", "contrast", "lighting"), seed: object = 0
) -> DataFrame:
    """Apply the enabled jitters to every image, in an order and with factors drawn per image; clipped to 0..255.

    A null image stays null; an image of one pixel has no colour components and takes no shift.
    """
    if unknown := set(enabled) - {*REFERENCE, "lighting"}:
        raise ValueError(f"unknown jitters: {sorted(unknown)}")
    keys, orders = [F.col(k) for k in key], np.array(list(permutations(range(len(enabled)))))
    factors = {f"_f{i}": hash01(f"{seed}{name}", *keys) + F.lit(LOWEST.get(name, 0.0)) for i, name in enumerate(enabled)}
    uniform = {f"_u{i}": hash01(f"{seed}light{i}", *keys) for i in range(6)} if "lighting" in enabled else {}
    drawn = df.withColumns({"_order": hash32(f"{seed}order", *keys) % len(orders), **factors, **uniform})
    schema = df.withColumn(pixels, F.col(pixels).cast("array<double>")).schema
    factor_names, uniform_names, names = list(factors), list(uniform), list(enabled)

    def jitter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            alphas, turns = batch[factor_names].to_numpy(), orders[batch["_order"].to_numpy()]
            noise = np.zeros((len(batch), 3))
            if uniform_names:
                u = batch[uniform_names].to_numpy()
                noise = np.sqrt(-2.0 * np.log(1.0 - u[:, :3])) * np.cos(2.0 * np.pi * u[:, 3:]) * LIGHT_STRENGTH
            out = pd.Series([None] * len(batch), index=batch.index, dtype="object")
            sizes = batch[pixels].map(lambda v: -1 if v is None else len(v)).to_numpy()
            for size in np.unique(sizes[sizes > 0]):
                rows = np.flatnonzero(sizes == size)
                stack = np.stack(batch[pixels].iloc[rows].to_list()).astype("float64").reshape(len(rows), -1, 3)
                quiet = noise[rows] if stack.shape[1] > 1 else noise[rows] * 0.0
                for row, image in zip(rows, jittered(stack, turns[rows], alphas[rows], quiet, names)):
                    out.iat[row] = image.ravel()
            for row in np.flatnonzero(sizes == 0):
                out.iat[row] = np.empty(0)
            kept = batch.drop(columns=["_order", *factor_names, *uniform_names])
            yield kept.assign(**{pixels: out})

    return drawn.mapInPandas(jitter, schema)


def hsv(image: np.ndarray) -> np.ndarray:
    """Hue in half degrees, saturation and value (0..255) of 8-bit blue, green, red pixels.

    Quotients by 12-bit fixed-point reciprocals, as image libraries do for bytes.
    """
    blue, green, red = (image[:, c].astype("int64") for c in range(3))
    high = np.maximum(np.maximum(blue, green), red)
    spread = high - np.minimum(np.minimum(blue, green), red)

    def reciprocal(numerator: float, divisor: np.ndarray) -> np.ndarray:
        return np.where(divisor == 0, 0, np.rint(numerator / np.maximum(divisor, 1))).astype("int64")

    saturation = (spread * reciprocal(255 * 4096.0, high) + 2048) >> 12
    sector = np.where(
        high == red, green - blue, np.where(high == green, blue - red + 2 * spread, red - green + 4 * spread)
    )
    hue = (sector * reciprocal(180 * 4096.0 / 6, spread) + 2048) >> 12
    return np.stack([np.where(hue < 0, hue + 180, hue), saturation, high], axis=1)


def _share(pixels: np.ndarray, width: int, box: dict, low: np.ndarray, top: np.ndarray) -> float | None:
    """Share of the box's pixels inside the limits; None for an empty box."""
    image = np.asarray(pixels).reshape(-1, width, 3)
    crop = image[box["ymin"]:box["ymax"], box["xmin"]:box["xmax"]].reshape(-1, 3)
    if not len(crop):
        return None
    values = hsv(crop)
    return float(((values >= low) & (values <= top)).all(axis=1).mean())


def colour_shares(limits: Sequence[Sequence[int]] = YELLOW):
    """UDF ``(pixels, width, rois) -> shares``: per region of a colour-checked class, else null."""
    low, top = (np.asarray(v) for v in limits)

    @F.pandas_udf("array<double>")
    def shares(pixels: pd.Series, width: pd.Series, rois: pd.Series) -> pd.Series:
        out = []
        for image, wide, boxes in zip(pixels, width, rois, strict=True):
            if image is None:
                out.append(None)
                continue
            checked = [any(part in box["cls"] for part in COLOUR_CHECKED) for box in boxes]
            out.append([_share(image, int(wide), box, low, top) if c else None for box, c in zip(boxes, checked, strict=True)])
        return pd.Series(out, dtype="object")

    return shares


def with_colour_shares(images: DataFrame, limits: Sequence[Sequence[int]] = YELLOW) -> DataFrame:
    """Add ``shares`` to images ``(width, pixels, rois)``; pixels leave the JVM only for checked classes."""
    candidate = F.exists("rois", lambda r: colour_checked(r["cls"]))
    return images.withColumn("shares", colour_shares(limits)(F.when(candidate, F.col("pixels")), F.col("width"), F.col("rois")))


def removed_by_colour(share: float = COLOUR_SHARE) -> Column:
    """True where one of the ``shares`` is above ``share``."""
    return F.coalesce(F.exists("shares", lambda s: F.coalesce(s > share, F.lit(False))), F.lit(False))


def filter_color_fraction(images: DataFrame, share: float = COLOUR_SHARE, limits: Sequence[Sequence[int]] = YELLOW) -> DataFrame:
    """Images without a colour-checked region of which more than ``share`` lies inside the HSV limits."""
    return with_colour_shares(images, limits).filter(~removed_by_colour(share)).drop("shares")

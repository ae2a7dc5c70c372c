"""Column functions over numeric arrays; n-dimensional data is flat, row-major, with a shape."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import prod

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``.

    A plain reference inside a lambda is evaluated again for every element.
    """
    return F.transform(F.array(value), body)[0]


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v.cast("double"))


def doubles(values: Column) -> Column:
    return values.cast("array<double>")


# -- sparse lines ------------------------------------------------------------------

# Fixed value: an entry is an index, a colon and a decimal number, infinity or NaN; signs are allowed.
ENTRY = (r"^[-+]?[0-9]{1,9}:([-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?"
         r"|[-+]?[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])$")


def sparse_entries(line: Column) -> Column:
    """``(idx, val)`` entries of an ``idx:val idx:val`` line in index order, the last value of an index kept.

    Unreadable numbers give a null index or value.
    """
    def entry(item: Column, at: Column) -> Column:
        good = F.rlike(item, F.lit(ENTRY))
        index = F.substring_index(item, ":", 1).try_cast("int")
        value = F.substring_index(item, ":", -1).try_cast("float")
        return F.struct(F.when(good, index).alias("idx"), (-at).alias("back"), F.when(good, value).alias("val"))

    parsed = F.transform(F.array_remove(F.split(line, " "), ""), entry)
    return let(
        F.array_sort(parsed),
        lambda s: F.filter(s, lambda e, i: (i == 0) | ~e["idx"].eqNullSafe(F.try_element_at(s, i)["idx"])),
    )


def sparse_valid(entries: Column, size: int) -> Column:
    """True if every entry has a readable value and an index in ``[0, size)``."""
    return F.forall(
        entries, lambda e: F.coalesce((e["idx"] >= 0) & (e["idx"] < size) & e["val"].isNotNull(), F.lit(False))
    )


def dense(entries: Column, size: int) -> Column:
    """Float array of ``size``: entry values at their index, 0 elsewhere.

    Runs of zeros are laid between consecutive entries, so the work is linear in
    ``size`` and not in ``size`` times the number of entries.
    """
    zero = F.lit(0.0).cast("float")

    def piece(s: Column) -> Column:
        body = F.transform(
            s,
            lambda e, i: F.concat(
                F.array_repeat(zero, e["idx"] - F.when(i > 0, F.try_element_at(s, i)["idx"]).otherwise(-1) - 1),
                F.array(e["val"]),
            ),
        )
        last = F.coalesce(F.try_element_at(s, F.lit(-1))["idx"], F.lit(-1))
        return F.concat(F.flatten(body), F.array_repeat(zero, F.lit(size - 1) - last))

    return let(entries, piece)


def sparse_to_dense(line: Column, label_dim: int, data_dim: int, int_label: bool = True, strict: bool = True) -> Column:
    """``struct(label, data)`` of a sparse line: indexes below ``label_dim`` are the label.

    Integer labels are truncated and must be finite. A bad index or number raises an
    error; with ``strict=False`` the whole struct is null instead.
    """
    size = label_dim + data_dim
    element = "int" if int_label else "float"

    def build(entries: Column) -> Column:
        both = let(
            dense(entries, size),
            lambda d: F.struct(
                F.slice(d, 1, label_dim).cast(f"array<{element}>").alias("label"),
                F.slice(d, label_dim + 1, data_dim).alias("data"),
            ),
        )
        bad = F.raise_error(F.concat(F.lit("invalid sparse line: "), line)) if strict else F.lit(None)
        good = sparse_valid(entries, size)
        if int_label:
            good = good & F.forall(entries, lambda e: (e["idx"] >= label_dim) | (F.abs(e["val"]) < F.lit(float("inf"))))
        return F.when(good, both).otherwise(bad)

    return let(sparse_entries(line), build)


def sparse_text(label: Column, data: Column, threshold: float = 1e-10) -> Column:
    """Sparse line of a label and a data array: every label slot, data above ``threshold``."""
    offset = F.size(label)
    head = F.transform(label, lambda v, i: F.concat(i.cast("string"), F.lit(":"), v.cast("string")))
    pairs = F.transform(data, lambda v, i: F.struct(i.alias("i"), v.alias("v")))
    tail = F.transform(
        F.filter(pairs, lambda p: p["v"] > threshold),
        lambda p: F.concat((p["i"] + offset).cast("string"), F.lit(":"), p["v"].cast("string")),
    )
    return F.array_join(F.concat(head, tail), " ")


# -- shapes ------------------------------------------------------------------------


def reshape(values: Column, shape: Sequence[int]) -> Column:
    """``struct(flat, shape)``; null where the product of ``shape`` is not the array's size.

    One ``-1`` stands for whatever is left.
    """
    known = prod(d for d in shape if d >= 0)
    dims = [F.lit(d) if d >= 0 else (F.size(values) / known).cast("int") for d in shape]
    fits = F.size(values) % known == 0 if -1 in shape else F.size(values) == known
    return F.when(fits, F.struct(values.alias("flat"), F.array(*dims).alias("shape")))


def rows_of(values: Column, width: int) -> Column:
    """Nested arrays of ``width`` values each."""
    count = (F.size(values) / width).cast("int")
    return F.when(
        count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(values, i * width + 1, width))
    ).otherwise(F.array().cast("array<array<double>>"))


def flatten_from(shape: Sequence[int], axis: int) -> list[int]:
    """Shape after joining all axes from ``axis`` on; the flat values do not change."""
    return [prod(shape[:axis]), prod(shape[axis:])]


# -- arithmetic ----------------------------------------------------------------------


def zipped(a: Column, b: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Combine two arrays of one length; an error if the lengths differ, null if an array is null."""
    unequal = F.raise_error(F.concat(
        F.lit("arrays of unequal length: "), F.size(a).cast("string"), F.lit(" and "), F.size(b).cast("string")))
    return F.when(F.size(a) == F.size(b), F.zip_with(a, b, combine)).when(F.size(a) != F.size(b), unequal)


def elementwise(operation: str, *arrays: Column) -> Column:
    """SUM (``+``), MUL (``*``), DIV (``/``) or MAX over arrays of one length, left to right; unequal lengths are an error."""

    def divide(a: Column, b: Column) -> Column:
        infinite = F.when(a > 0, F.lit(float("inf"))).when(a < 0, F.lit(float("-inf"))).otherwise(F.lit(float("nan")))
        return F.when(b != 0, a / b).otherwise(infinite)

    steps: dict[str, Callable[[Column, Column], Column]] = {
        "SUM": lambda a, b: a + b,
        "+": lambda a, b: a + b,
        "MUL": lambda a, b: a * b,
        "*": lambda a, b: a * b,
        "DIV": divide,
        "/": divide,
        "MAX": lambda a, b: F.greatest(a, b),
    }
    if operation not in steps:
        raise ValueError(f"unknown elementwise operation: {operation}")
    out = arrays[0]
    for other in arrays[1:]:
        out = zipped(out, other, steps[operation])
    return out


def scale_shift(values: Column, weight: Sequence[float], bias: Sequence[float], inner: int = 1) -> Column:
    """``x * w + b`` per channel; each channel holds ``inner`` consecutive values."""
    w, b = (F.array(*[F.lit(float(v)) for v in vs]) for vs in (weight, bias))

    def channel(i: Column) -> Column:
        return F.floor(i / inner).cast("int") + 1

    return F.transform(values, lambda x, i: x * F.element_at(w, channel(i)) + F.element_at(b, channel(i)))


def l2_normalize(values: Column, scale: float = 1.0, eps: float = 1e-10) -> Column:
    """``x / (norm + eps) * scale``."""
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v * v)) + eps
    return let(norm, lambda n: F.transform(values, lambda v: v / n * scale))


def crop(values: Column, reference: Column, offset: int) -> Column:
    """``[offset, offset + size(reference))``."""
    return F.slice(values, F.lit(offset + 1), F.size(reference))


def slices(values: Column, points: Sequence[int]) -> list[Column]:
    """Consecutive pieces up to each slice point; what follows the last point is dropped."""
    starts = [0, *points[:-1]]
    return [F.slice(values, start + 1, stop - start) for start, stop in zip(starts, points, strict=True)]


def softmax(scores: Column) -> Column:
    """Probabilities of scores, with the maximum subtracted first."""
    shifted = let(F.array_max(scores), lambda top: F.transform(scores, lambda s: F.exp(s - top)))
    return let(shifted, lambda e: let(total(e), lambda t: F.transform(e, lambda v: v / t)))


def cross_entropy(scores: Column, label: Column) -> Column:
    """``log(sum(exp(s))) - s[label]``, with the maximum subtracted first."""
    log_sum = let(
        F.array_max(scores),
        lambda top: F.log(F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + F.exp(s - top))) + top,
    )
    return log_sum - F.element_at(scores, label + 1)


def squared_error(output: Column, target: Column, weights: Column | None = None) -> Column:
    """Sum of ``(o - t)^2``, each times its weight if weights are given."""
    squares = zipped(output, target, lambda o, t: (o - t) * (o - t))
    if weights is not None:
        squares = zipped(squares, weights, lambda s, w: s * w)
    return total(squares)


def argmax(scores: Column) -> Column:
    """Position of the first maximum."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


# -- characters ------------------------------------------------------------------------


def encode_chars(text: Column, charset: str, length: int = 16, null_code: int = 99, strict: bool = False) -> Column:
    """Character codes (position in ``charset``), padded with ``null_code`` to ``length``.

    Characters outside the charset are coded ``null_code`` too. What a text has beyond ``length``
    characters is lost; with ``strict`` a longer text is an error.
    """
    if strict:
        too_long = F.raise_error(F.concat(F.lit("text is too long: "), text))
        text = F.when(F.char_length(text) > length, too_long).otherwise(text)
    codes = F.transform(
        F.filter(F.split(text, ""), lambda c: c != ""),
        lambda c: _code(charset, c, null_code),
    )
    return F.slice(F.concat(codes, F.array_repeat(F.lit(null_code), length)), 1, length)


def _code(charset: str, char: Column, null_code: int) -> Column:
    at = F.instr(F.lit(charset), char)
    return F.when(at > 0, at - 1).otherwise(null_code)

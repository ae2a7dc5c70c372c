"""Image manifests, archive members, messages, lookups and shard assignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import hash32
from millrace.functions.text import dotted_suffix, tokens
from millrace.plans import lookup_join, numbered, top_n
from millrace.session import materialize

# Image extensions of folders and of archives; names that are not carried over.
FOLDER_IMAGES = (".jpg", ".png")
ARCHIVE_IMAGES = (".jpg", ".jpeg", ".tiff", ".bmp", ".png")
NOT_CARRIED = ("log", "eval")
NOT_CARRIED_PREFIX = "model."
COPIES_PER_CHUNK = 100_000
TOP_ROWS = 10_000


def image_manifest(files: DataFrame, path: str = "path") -> DataFrame:
    """Keep image files; add ``label`` (parent folder) and ``root`` (the folder above it)."""
    p = F.col(path)
    return (
        files.filter(dotted_suffix(p).isin(*FOLDER_IMAGES))
        .withColumn("label", F.try_element_at(F.split(p, "/"), F.lit(-2)))
        .withColumn("root", F.regexp_extract(p, r"^(.*)/[^/]+/[^/]+$", 1))
    )


def label_counts(manifest: DataFrame, label: str = "label") -> DataFrame:
    return manifest.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def cap_per_label(manifest: DataFrame, n: int, label: str = "label", order: Sequence[str] = ("path",)) -> DataFrame:
    """At most ``n`` rows per label, the first in path order."""
    return top_n(manifest, [label], order, n)


def class_map(lines: DataFrame, line: str = "line") -> DataFrame:
    """Parse ``archive@/member<TAB>index`` lines to ``member``, ``class_idx`` and ``error``.

    Blank lines go; empty fields are skipped. Lines that cannot be read keep their
    row with the reason in ``error``.
    """
    fields = F.filter(F.split(F.trim(F.regexp_replace(line, r"[\r\n]+$", "")), "\t"), lambda f: f != "")
    at = F.locate("@", F.col("_f")[0])
    member = F.regexp_replace(F.regexp_extract(F.col("_f")[0], "^[^@]*@(.*)$", 1), "^/", "")
    index = F.try_element_at("_f", F.lit(2)).try_cast("int")
    error = (
        F.when(F.size("_f") < 2, "too few fields")
        .when(at == 0, "no @ in class")
        .when(member == "", "empty member")
        .when(index.isNull(), "bad index")
    )
    return (
        lines.withColumn("_f", fields)
        .filter(F.size("_f") > 0)
        .select(
            *[c for c in lines.columns],
            F.when(error.isNull(), member).alias("member"),
            F.when(error.isNull(), index).alias("class_idx"),
            error.alias("error"),
        )
    )


def check_unique_label(mapping: DataFrame, member: str = "member", index: str = "class_idx") -> DataFrame:
    """Members with more than one class index; empty for a valid map."""
    spread = mapping.groupBy(member).agg(F.min(index).alias("low"), F.max(index).alias("high"))
    return spread.filter(F.col("low") != F.col("high"))


def filter_archive_members(
    members: DataFrame, member: str = "member", size: str = "size", extensions: Sequence[str] = ARCHIVE_IMAGES
) -> DataFrame:
    """Drop folders, dot names, empty members and other extensions."""
    name = F.col(member)
    return members.filter(
        ~F.endswith(name, F.lit("/"))
        & ~F.startswith(name, F.lit("."))
        & (F.col(size) > 0)
        & dotted_suffix(name).isin(*[e.lower() for e in extensions])
    )


def join_archive_labels(members: DataFrame, mapping: DataFrame, member: str = "member") -> DataFrame:
    """Members with their class index; members outside the map go."""
    known = materialize(mapping.groupBy(member).agg(F.max("class_idx").alias("class_idx")))
    return lookup_join(members, known, [member])


def filter_carry_over(listing: DataFrame, name: str = "name") -> DataFrame:
    """Entries to carry over: not the log and eval folders, nor models (names compared in lower case)."""
    low = F.lower(F.col(name))
    return listing.filter(~low.isin(*NOT_CARRIED) & ~F.startswith(low, F.lit(NOT_CARRIED_PREFIX)))


def properties(lines: DataFrame, file: str = "file", line: str = "line", line_no: str = "line_no") -> DataFrame:
    """``(file, key, value)`` of ``k=v`` lines: ``#`` lines go, the first ``=`` splits, the last key wins."""
    text = F.col(line)
    pairs = lines.filter(~F.startswith(text, F.lit("#")) & F.contains(text, F.lit("="))).select(
        file,
        line_no,
        F.trim(F.substring_index(text, "=", 1)).alias("key"),
        F.trim(F.regexp_extract(text, "^[^=]*=(.*)$", 1)).alias("value"),
    )
    return pairs.groupBy(file, "key").agg(F.max_by("value", line_no).alias("value"))


def add_default_fields(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add the missing mandatory fields with constant values; existing ones stay."""
    return df.withColumns({name: F.lit(value) for name, value in defaults.items() if name not in df.columns})


def lookup_with_default(
    hosts: DataFrame, topology: DataFrame, default: str, host: str = "host", line: str = "line", line_no: str = "line_no"
) -> DataFrame:
    """Add ``rack``: the second field of the last topology line whose first field is the host, else ``default``."""
    words = tokens(F.col(line))
    pairs = topology.select(
        F.try_element_at(words, F.lit(1)).alias(host), F.try_element_at(words, F.lit(2)).alias("_rack"), line_no
    ).filter(F.col(host).isNotNull())
    racks = materialize(pairs.groupBy(host).agg(F.max_by("_rack", line_no).alias("rack")))
    joined = lookup_join(hosts, racks, [host], "left")
    found = F.when(F.coalesce("rack", F.lit("")) != "", F.col("rack"))
    return joined.withColumn("rack", F.coalesce(found, F.lit(default)))


def tag_latest(images: DataFrame, latest: DataFrame, group: str = "group", name_tag: str = "name_tag") -> DataFrame:
    """Add ``is_latest``: the image's ``name:tag`` is listed for its group."""
    listed = materialize(latest.select(group, name_tag).distinct()).withColumn("_listed", F.lit(True))
    joined = lookup_join(images, listed, [group, name_tag], "left")
    return joined.withColumn("is_latest", F.col("_listed").isNotNull()).drop("_listed")


def changed_minus_deleted(changed: DataFrame, deleted: DataFrame, column: str = "names", separator: str = ";") -> DataFrame:
    """Entries of ``;``-lists that are in the first side only; duplicates count one by one.

    Entries are counted per task before the shuffle. What is left of a name is written out in chunks
    of at most COPIES_PER_CHUNK rows that are dealt to different tasks.
    """

    def entries(df: DataFrame, sign: int) -> DataFrame:
        return df.select(F.explode(F.split(column, separator)).alias("name"), F.lit(sign).alias("_sign"))

    left = entries(changed, 1).unionByName(entries(deleted, -1)).groupBy("name").agg(F.sum("_sign").alias("_n")).filter("_n > 0")
    chunks = left.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / COPIES_PER_CHUNK))))
    copies = F.least(F.lit(COPIES_PER_CHUNK), F.col("_n") - F.col("_chunk") * COPIES_PER_CHUNK)
    return chunks.repartition("name", "_chunk").select(
        "name", F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("_copy")).drop("_copy")


def limit_n(messages: DataFrame, n: int | None, order: Sequence[str]) -> DataFrame:
    """The first ``n`` messages in order; all of them for None or -1.

    Up to TOP_ROWS are collected from all tasks in order; more are cut off by numbers given in
    ranges, for which ``order`` must be unique.
    """
    if n is None or n < 0:
        return messages
    if n <= TOP_ROWS:
        return messages.orderBy(*order).limit(n)
    return numbered(messages, [], order, "_n").filter(F.col("_n") <= n).drop("_n")


def sorted_scan(files: DataFrame, path: str = "path") -> DataFrame:
    """Files in name order (a range-partitioned sort)."""
    return files.orderBy(path)


def shard_assign(df: DataFrame, world_size: int, *key: Column, seed: object = 0) -> DataFrame:
    """Add ``shard`` in ``[0, world_size)`` from a hash of the key."""
    return df.withColumn("shard", (hash32(seed, *key) % world_size).cast("int"))


def worker_batch(batch_per_device: int, local_devices: int) -> int:
    """Rows a worker reads per step: the batch of one device for each of its devices."""
    return batch_per_device * max(1, local_devices)


def image_lines(manifest: DataFrame, base: str) -> DataFrame:
    """``(root, line)`` with ``relative-path label`` lines, paths relative to ``base``."""
    start = len(base.rstrip("/")) + 2
    path = F.translate("path", "\\", "/")
    return manifest.select("root", F.concat_ws(" ", F.substring(path, F.lit(start), F.length(path)), "label").alias("line"))


def map_class_key(df: DataFrame, mapping_json: str, key: str = "key") -> DataFrame:
    """Add ``cls`` from a JSON map ``key -> class``; an unknown key gives null."""
    mapping = F.from_json(F.lit(mapping_json), "map<string,string>")
    return df.withColumn("cls", F.try_element_at(mapping, F.col(key)))


"""Column functions over text, paths and small key=value syntaxes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.arrays import let

# What separates tokens (every Unicode white space and the ASCII separators);
# the upper ones stand behind one range test, which other letters fail at once.
_UPPER = r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
WHITESPACE = r"[\t-\r\x1c-\x20\x85\xa0" + _UPPER + "]+"


def tokens(line: Column, lower: bool = False) -> Column:
    """Whitespace-separated tokens of a line; a blank line has none."""
    text = F.lower(line) if lower else line
    return F.array_remove(F.split(text, WHITESPACE), "")


# -- paths ---------------------------------------------------------------------


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dir_name(path: Column) -> Column:
    """Everything before the last slash; ``.`` without one, as in the shell."""
    return F.when(F.locate("/", path) > 0, F.regexp_extract(path, r"^(.*)/[^/]*$", 1)).otherwise(".")


def extension(path: Column) -> Column:
    """Text after the last dot of the base name; the whole name without a dot."""
    return F.substring_index(base_name(path), ".", -1)


def stem(path: Column) -> Column:
    """Base name without its last dot and what follows."""
    return F.regexp_replace(base_name(path), r"\.[^.]*$", "")


def dotted_suffix(path: Column) -> Column:
    """Lower-case extension with its dot; empty for none and for leading-dot names."""
    return F.lower(F.regexp_extract(base_name(path), r"^\.*[^.].*(\.[^.]*)$", 1))


def path_parts(path: Column) -> Column:
    """Struct of base name, folder, extension, stem and lower-case extension."""
    return F.struct(
        base_name(path).alias("base"),
        dir_name(path).alias("dir"),
        extension(path).alias("ext"),
        stem(path).alias("stem"),
        F.lower(extension(path)).alias("ext_lower"),
    )


def flatten_path_name(relative: Column, base: Column | str) -> Column:
    """File name for a folder: ``/`` ``\\`` and ``.`` become ``_``; the root keeps the bare name."""
    base = F.lit(base) if isinstance(base, str) else base
    flat = F.translate(relative, "\\/.", "___")
    return F.when(relative == ".", base).otherwise(F.concat(flat, F.lit("_"), base))


def path_group(path: Column, root: str) -> Column:
    """First path component below the fixed ``root``; empty if the path is not below it."""
    return F.regexp_extract(path, "^" + _quote(root.rstrip("/")) + "/([^/]+).*$", 1)


def message_path(path: Column, base: Column, cluster_prefixes: Sequence[str]) -> Column:
    """Point a message's image path into the archive (cluster runs) or folder given by ``base``."""
    on_cluster = F.lit(False)
    for prefix in cluster_prefixes:
        on_cluster = on_cluster | F.startswith(base, F.lit(prefix))
    name = base_name(path)
    return F.when(on_cluster, F.concat(base, F.lit(".zip@/"), name)).otherwise(
        F.concat(base, F.when(F.endswith(base, F.lit("/")), "").otherwise("/"), name)
    )


def archive_member_path(archive: Column, member: Column) -> Column:
    """``archive@/member``."""
    return F.concat(archive, F.lit("@/"), F.regexp_replace(member, r"[\r\n]+$", ""))


def _quote(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c not in "/_" else c for c in text)


# -- image names ---------------------------------------------------------------


def image_name_tag(path: Column, root: str = "images/") -> Column:
    """Parts of ``<root><type>/.../name/tag``.

    ``name_tag`` is ``name:tag``; ``type_prefix`` is the first component when it is
    not a custom one; ``dashed`` joins the rest with dashes, ``custom-`` in front.
    """
    name = F.replace(path, F.lit(root), F.lit(""))
    custom = F.startswith(name, F.lit("custom"))
    tag = F.substring_index(path, "/", -1)
    owner = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.struct(
        F.concat(owner, F.lit(":"), tag).alias("name_tag"),
        F.when(custom, "custom").otherwise(F.substring_index(name, "/", 1)).alias("type_prefix"),
        F.replace(F.when(custom, name).otherwise(F.concat(F.lit("custom-"), name)), F.lit("/"), F.lit("-")).alias(
            "dashed"
        ),
    )


# -- key=value and templates -----------------------------------------------------


def key_value_pairs(text: Column) -> Column:
    """Array of ``(key, value)`` from ``k=v k=v``: the first ``=`` splits, later keys follow earlier ones."""
    return F.transform(
        tokens(text),
        lambda item: F.struct(
            F.substring_index(item, "=", 1).alias("key"),
            F.regexp_extract(item, "^[^=]*=(.*)$", 1).alias("value"),
        ),
    )


def kv_args(text: Column) -> Column:
    """Map from ``k=v k=v``; the last value of a repeated key is kept."""
    pairs = key_value_pairs(text)
    kept = let(
        pairs,
        lambda p: F.filter(
            p,
            lambda item, i: ~F.exists(F.slice(p, i + 2, F.size(p)), lambda later: later["key"] == item["key"]),
        ),
    )
    return F.map_from_entries(kept)


def substitute(text: Column, values: Mapping[str, Column | str], style: str = "$", first_only: bool = False) -> Column:
    """Replace ``$Key$`` (style ``$``) or ``[#key]`` (style ``#``) by its value.

    Keys are replaced one after another; ``first_only`` replaces one occurrence per key.
    """
    for key, value in values.items():
        mark = f"${key}$" if style == "$" else f"[#{key}]"
        value = F.lit(value) if isinstance(value, str) else value
        if first_only:
            at = F.locate(mark, text)
            text = F.when(
                at > 0,
                F.concat(
                    F.substring(text, F.lit(1), at - 1), value, F.substring(text, at + len(mark), F.length(text))
                ),
            ).otherwise(text)
        else:
            text = F.replace(text, F.lit(mark), value)
    return text


def after_colon(line: Column) -> Column:
    return F.trim(F.regexp_extract(line, r"^[^:]*:(.*)$", 1))


def rewrite_solver_line(line: Column, output_dir: str) -> Column:
    """Point a solver's ``snapshot_prefix`` below ``output_dir`` with forward slashes; keep other lines."""
    is_prefix = F.startswith(F.lower(F.trim(line)), F.lit("snapshot_prefix"))
    value = F.replace(after_colon(line), F.lit('"'), F.lit(""))
    joined = F.when(F.startswith(value, F.lit("/")), value).otherwise(
        F.concat(F.lit(output_dir.rstrip("/") + "/"), value)
    )
    path = F.replace(joined, F.lit("\\"), F.lit("/"))
    return F.when(is_prefix, F.concat(F.lit('snapshot_prefix: "'), path, F.lit('"'))).otherwise(line)


def solver_max_iter(line: Column) -> Column:
    """``max_iter`` value of a solver line, null on other lines."""
    is_max = F.startswith(F.lower(F.trim(line)), F.lit("max_iter"))
    return F.when(is_max, F.try_to_number(after_colon(line), F.lit("999999999999")).cast("long"))

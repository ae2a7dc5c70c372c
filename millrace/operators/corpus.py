"""Text corpora: tokens, vocabulary, noisy pairs, ids and length buckets."""

from __future__ import annotations

from collections.abc import Collection, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.arrays import let
from millrace.functions.hashing import hash01
from millrace.functions.text import tokens
from millrace.plans import broadcastable, lookup_join, numbered
from millrace.session import materialize

# Reserved ids and tokens.
PAD_ID, GO_ID, EOS_ID = 0, 1, 2
RESERVED = ("PAD", "GO", "EOS")
# up to so many rows are chosen by collecting them from all tasks in order
TOP_ROWS = 10_000
BANK_UNKNOWN = "<unk>"
DIALOG_UNKNOWN = "UNK"

# Words the plain noise replaces or drops.
PLAIN_REPLACEMENTS = {"there": "their", "their": "there"}
PLAIN_DROPS = ("a", "an", "the")
# The same for dialog text.
DIALOG_REPLACEMENTS = {
    "there": "they 're",
    "their": "they 're",
    "they 're": "their",
    "then": "than",
    "than": "then",
    "your": "you 're",
    "you 're": "your",
    "ill": "i 'll",
    "i 'll": "ill",
    "its": "it' s",
    "it 's": "its",
}
DIALOG_DROPS = ("a", "an", "the", "'ll", "'s", "'m", "'ve", "'re")


def lines(df: DataFrame, text: str, *ids: str) -> DataFrame:
    """One row per line of ``text``: the ids, ``line_no`` (from 0) and ``line``."""
    return df.select(*ids, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def line_tokens(df: DataFrame, line: str = "line", *, lower: bool = False, out: str = "tokens") -> DataFrame:
    """Replace the line by its token array."""
    return df.withColumn(out, tokens(F.col(line), lower)).drop(line)


def token_rows(df: DataFrame, *ids: str, column: str = "tokens") -> DataFrame:
    """One row per token with its position.

    The outer form is used because Spark puts a size test before an inner explode,
    and so would cut every line twice.
    """
    rows = df.select(*ids, F.posexplode_outer(column).alias("pos", "token"))
    return rows.filter(F.col("pos").isNotNull())


def token_counts(df: DataFrame, column: str = "tokens") -> DataFrame:
    """Occurrences per token; counted per task before the shuffle, so frequent tokens stay small."""
    return token_rows(df, column=column).groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))


def vocab_topk(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent tokens, ties in token order; a large ``k`` is cut off by numbers given in ranges."""
    if k <= TOP_ROWS:
        return counts.orderBy(F.desc("cnt"), F.asc("token")).limit(k)
    return ranked_tokens(counts).filter(F.col("_n") <= k).drop("_n")


def ranked_tokens(counts: DataFrame) -> DataFrame:
    """Tokens with ``_n``, their place by falling count and token."""
    return numbered(counts.withColumn("_fall", -F.col("cnt")), [], ["_fall", "token"], "_n").drop("_fall")


def vocabulary(counts: DataFrame, specials: Sequence[str] = RESERVED, max_size: int | None = None) -> DataFrame:
    """``(token, cnt, id)``: the special tokens first, then tokens by falling count and token.

    ``max_size`` includes the special tokens. A bounded vocabulary is cut down
    before it is numbered; an unbounded one is numbered in ranges.
    """
    names = F.array(*[F.lit(t) for t in specials]) if specials else F.array().cast("array<string>")
    reserved = counts.sparkSession.range(0, 1, 1, 1).select(
        F.posexplode(names).alias("id", "token")).select("token", F.lit(None).cast("long").alias("cnt"), F.col("id").cast("long").alias("id"))
    if max_size is not None:
        reserved = reserved.filter(F.col("id") < max_size)
    room = None if max_size is None else max(0, max_size - len(specials))
    if room is not None and room <= TOP_ROWS:
        ranked = vocab_topk(counts, room).withColumn(
            "_n", F.row_number().over(Window.orderBy(F.desc("cnt"), F.asc("token")))
        )
    else:
        ranked = ranked_tokens(counts)
        ranked = ranked if room is None else ranked.filter(F.col("_n") <= room)
    learned = ranked.select("token", "cnt", (F.col("_n") - 1 + len(specials)).cast("long").alias("id"))
    return reserved.unionByName(learned).withColumn("id", F.col("id").cast("int"))


def build_vocabulary(counts: DataFrame, specials: Sequence[str] = RESERVED, max_size: int | None = None) -> DataFrame:
    """:func:`vocabulary`, stored in the shared folder so that encoding does not count again."""
    return materialize(vocabulary(counts, specials, max_size))


def token_ids(vocab: DataFrame) -> DataFrame:
    """``(token, id)`` with one id per token: the later one if a special token also occurs in the text."""
    return vocab.groupBy("token").agg(F.max("id").alias("id"))


def _map_lists(
    df: DataFrame, columns: Mapping[str, str], names: pa.Array, values: pa.Array, default: object, kind: T.DataType, keep: bool
) -> DataFrame:
    """Look up every element of array columns in Arrow batches; no row leaves its partition. Without ``keep`` the
    looked-up columns do not come back from the batches."""
    table = df.sparkSession.sparkContext.broadcast((names, values))
    rest = [f for f in df.schema.fields if keep or f.name not in columns]
    stay = [f.name for f in rest]
    schema = T.StructType([*rest, *[T.StructField(out, T.ArrayType(kind)) for out in columns.values()]])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found = table.value
        index = pd.Index(known.to_pandas())  # its hash table is built once per task
        for batch in batches:
            fields = list(batch.schema.names)
            arrays = [batch.column(fields.index(name)) for name in stay]
            for source, out in columns.items():
                lists = batch.column(fields.index(source))
                lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
                coded = lists.flatten().dictionary_encode()
                place = index.get_indexer(coded.dictionary.to_pandas())  # each distinct token of the batch once
                items = found.take(pa.array(place, pa.int64(), mask=place < 0)).take(coded.indices)
                if default is not None:
                    items = items.fill_null(default)
                sizes = pc.fill_null(pc.list_value_length(lists), 0)
                ends = pc.cumulative_sum(sizes).cast(pa.int32())
                offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
                arrays.append(pa.ListArray.from_arrays(offsets, items, mask=lists.is_null()))
            yield pa.RecordBatch.from_arrays(arrays, names=[*stay, *columns.values()])

    return df.mapInArrow(look_up, schema)


def _mapped(
    df: DataFrame, lookup: DataFrame, key: str, value: str, columns: Mapping[str, str], default: object, keep: bool = True
) -> DataFrame:
    kind = lookup.schema[value].dataType
    if broadcastable(lookup):
        rows = lookup.select(key, value).toArrow().combine_chunks()  # measured just above
        first = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rows.columns]
        return _map_lists(df, columns, first[0], first[1], default, kind, keep)
    out = df
    for source, target in columns.items():
        row_id = F.monotonically_increasing_id()
        out = materialize(out.withColumn("_row", row_id))
        items = out.select("_row", F.posexplode(source).alias("_pos", key))
        joined = lookup_join(items, lookup.select(key, value), [key], "left")
        filled = F.col(value) if default is None else F.coalesce(F.col(value), F.lit(default).cast(kind))
        lists = joined.groupBy("_row").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("_pos", filled.alias("x")))), lambda s: s["x"]).alias(
                target
            )
        )
        empty = F.when(F.col(source).isNotNull(), F.array().cast(T.ArrayType(kind)))
        out = (
            out.join(lists, "_row", "left").withColumn(target, F.coalesce(F.col(target), empty)).drop("_row")
        )
    return out if keep else out.drop(*columns)


def encode_tokens(df: DataFrame, vocab: DataFrame, columns: Mapping[str, str], unknown: str, *, keep: bool = True) -> DataFrame:
    """Add id arrays for token arrays (``{source: target}``); unknown tokens get the unknown token's id. Without
    ``keep`` the token arrays go.

    A vocabulary measured to fit a broadcast is looked up inside Arrow batches,
    without moving the corpus. A larger one is joined token by token, salted.
    ``vocab`` should be stored (:func:`build_vocabulary`): it is read twice.
    """
    ids = token_ids(vocab)
    row = ids.filter(F.col("token") == unknown).first()
    if row is None:
        raise ValueError(f"the unknown token {unknown!r} is not in the vocabulary")
    return _mapped(df, ids, "token", "id", columns, row["id"], keep)


def decode_ids(df: DataFrame, vocab: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add token arrays for id arrays; an id outside the vocabulary gives null."""
    return _mapped(df, vocab.select("id", "token"), "id", "token", columns, None)


def flag_unknown(df: DataFrame, vocab: DataFrame, unknown: str, token: str = "token") -> DataFrame:
    """Add ``is_unknown``: not in the vocabulary, or the unknown token itself."""
    known = vocab.select(F.col("token").alias(token), F.lit(True).alias("_known")).distinct()
    joined = lookup_join(df, known, [token], "left")
    return joined.withColumn("is_unknown", F.col("_known").isNull() | (F.col(token) == unknown)).drop("_known")


def dataset_copies(df: DataFrame, copies: int) -> DataFrame:
    """``copies`` rows per row, told apart by ``copy_id``, so that each copy gets its own noise."""
    return df.withColumn("copy_id", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def _literal_map(values: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def noise_words(
    words: Column,
    key: Sequence[Column],
    *,
    replacements: Mapping[str, str] = PLAIN_REPLACEMENTS,
    replace_prob: float = 0.25,
    drops: Collection[str] = PLAIN_DROPS,
    drop_prob: float = 0.0,
    seed: object = 0,
) -> Column:
    """Noisy source of a clean token array: some words replaced, some dropped.

    The draw for a position depends on the seed, ``key`` (line and copy) and the position.
    """
    table = _literal_map(replacements)

    def emit(word: Column, at: Column) -> Column:
        replaced = word.isin(*replacements) & (hash01(f"{seed}r", *key, at) < replace_prob)
        dropped = word.isin(*drops) & (hash01(f"{seed}d", *key, at) < drop_prob)
        return (
            F.when(replaced, F.array(F.try_element_at(table, word)))
            .when(dropped, F.array().cast("array<string>"))
            .otherwise(F.array(word))
        )

    return _if_any(words, [*replacements, *(drops if drop_prob > 0 else ())], F.flatten(F.transform(words, emit)))


def _if_any(words: Column, triggers: Collection[str], noisy: Column) -> Column:
    """``noisy`` for lines with a word that noise can begin at; other lines are left alone."""
    begins = F.array(*[F.lit(t) for t in dict.fromkeys(triggers)])
    return F.when(F.arrays_overlap(words, begins), noisy).otherwise(words)


def noise_bigrams(
    words: Column,
    key: Sequence[Column],
    *,
    replacements: Mapping[str, str] = DIALOG_REPLACEMENTS,
    replace_prob: float = 0.25,
    drops: Collection[str] = DIALOG_DROPS,
    drop_prob: float = 0.0,
    seed: object = 0,
) -> Column:
    """As :func:`noise_words`, with replacements of two tokens and by several tokens.

    A replaced pair takes both its words out of the source; the word before a pair
    is tried first, so of two overlapping pairs the earlier one wins.
    """
    singles = {k: v for k, v in replacements.items() if " " not in k}
    doubles = {k: v for k, v in replacements.items() if " " in k}
    table = _literal_map(replacements)
    firsts = list(dict.fromkeys(k.split(" ")[0] for k in doubles))

    def pair(at: Column) -> Column:
        return F.concat_ws(" ", F.try_element_at(words, at + 1), F.try_element_at(words, at + 2))

    def single_hit(at: Column) -> Column:
        return F.try_element_at(words, at + 1).isin(*singles) & (hash01(f"{seed}r", *key, at) < replace_prob)

    def pair_hit(at: Column) -> Column:
        begins = F.try_element_at(words, at + 1).isin(*firsts)
        return begins & pair(at).isin(*doubles) & (hash01(f"{seed}p", *key, at) < replace_prob) & ~single_hit(at)

    positions = F.when(F.size(words) > 1, F.sequence(F.lit(0), F.size(words) - 2)).otherwise(
        F.array().cast("array<int>")
    )
    chosen = F.aggregate(
        F.filter(positions, pair_hit),
        F.array().cast("array<int>"),
        lambda acc, at: F.when(F.try_element_at(acc, F.lit(-1)) == at - 1, acc).otherwise(F.array_append(acc, at)),
    )

    def emit_all(pairs: Column) -> Column:
        def emit(word: Column, at: Column) -> Column:
            dropped = word.isin(*drops) & (hash01(f"{seed}d", *key, at) < drop_prob)
            return (
                F.when(F.array_contains(pairs, at - 1), F.array().cast("array<string>"))
                .when(single_hit(at), F.split(F.try_element_at(table, word), " "))
                .when(F.array_contains(pairs, at), F.split(F.try_element_at(table, pair(at)), " "))
                .when(dropped, F.array().cast("array<string>"))
                .otherwise(F.array(word))
            )

        return F.flatten(F.transform(words, emit))

    return _if_any(words, [*singles, *firsts, *(drops if drop_prob > 0 else ())], let(chosen, emit_all))


def encode_pairs(df: DataFrame, vocab: DataFrame, unknown: str) -> DataFrame:
    """Ids for the token arrays ``source`` and ``target``, EOS after the target."""
    ids = encode_tokens(df, vocab, {"source": "_source", "target": "_target"}, unknown, keep=False)
    return (
        ids.withColumnRenamed("_source", "source")
        .withColumn("target", F.array_append("_target", F.lit(EOS_ID)))
        .drop("_target")
    )


def bucketize(df: DataFrame, buckets: Sequence[tuple[int, int]]) -> DataFrame:
    """Add ``bucket_id``: the first bucket longer than both source and target; pairs that fit none go."""
    found = F.lit(None).cast("int")
    for number, (source, target) in reversed(list(enumerate(buckets))):
        fits = (F.size("source") < source) & (F.size("target") < target)
        found = F.when(fits, F.lit(number)).otherwise(found)
    return df.withColumn("bucket_id", found).filter(F.col("bucket_id").isNotNull())


def build_dataset(
    df: DataFrame,
    vocab: DataFrame,
    *,
    key: Sequence[str],
    copies: int,
    buckets: Sequence[tuple[int, int]],
    unknown: str = DIALOG_UNKNOWN,
    replacements: Mapping[str, str] = DIALOG_REPLACEMENTS,
    replace_prob: float = 0.25,
    drops: Collection[str] = DIALOG_DROPS,
    drop_prob: float = 0.0,
    seed: object = 0,
) -> DataFrame:
    """Token lines to encoded, bucketed pairs: copies, bigram noise, ids, buckets; one narrow stage."""
    copied = dataset_copies(df, copies)
    keys = [F.col(k) for k in (*key, "copy_id")]
    noisy = copied.withColumn(
        "source",
        noise_bigrams(F.col("tokens"), keys, replacements=replacements, replace_prob=replace_prob, drops=drops,
                      drop_prob=drop_prob, seed=seed),
    ).withColumnRenamed("tokens", "target")
    return bucketize(encode_pairs(noisy, vocab, unknown), buckets)

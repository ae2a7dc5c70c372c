"""Token files: whole texts as token ids in Parquet list columns, in id order, for selective reads."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import id_type, small_batches, text_list
from millrace.llm.tokens import text_encoder, vocabulary_path

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10


def write_token_files(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = 2,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
) -> None:
    """Encode every whole text, append ``end_id`` and write the ids in ascending order of ``id_col``.

    Columns: ``doc_id``, ``shard`` and ``shard_start`` (which file, and ids before the document
    in it), ``n_tokens``, ``ids`` (list of int). The list is dictionary encoded, so an id takes
    as many bits as its row group's vocabulary asks for; the sorted numbers are delta encoded.
    Row groups and pages are bounded and indexed, so that a reader of some documents or of the
    metadata alone skips the rest.

    Texts are dealt by ranges of (id, hash of the text), once; each range is encoded as it
    streams by. Null text: only the end id. Null id: written first. Repeated rows stay, next to
    each other. An empty table leaves files without rows.
    """
    vocabulary = vocabulary_path(tokenizer)
    schema = f"doc_id {id_type(docs, id_col)}, shard int, shard_start long, n_tokens long, ids array<int>"
    end = np.uint32(end_id).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, before = text_encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in small_batches(batches, "text"):
            ids = [i + end for i in encoder.encode_all(text_list(batch, "text"))]
            sizes = np.fromiter((len(i) >> 2 for i in ids), np.int64, len(ids))
            ends = np.cumsum(sizes)
            flat = np.frombuffer(b"".join(ids), "<i4")
            lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(ids), shard, np.int32)), pa.array(before + ends - sizes),
                 pa.array(sizes), lists], ["doc_id", "shard", "shard_start", "n_tokens", "ids"])
            before += int(ends[-1]) if len(ids) else 0

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(encode, schema).write.options(**{
        "compression": "zstd",
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": "true",
    }).parquet(path)


def read_token_files(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The documents of token files with ``start``, the ids of all documents before each one.

    Only the wanted columns are read. One total per file is added up on the driver's side;
    that many rows are as many as files.
    """
    files = spark.read.parquet(path)
    totals = files.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    bases = np.cumsum([0, *[r.n for r in totals]]).tolist()
    starts = spark.createDataFrame([(r.shard, base) for r, base in zip(totals, bases)], "shard int, base long")
    wanted = [F.col("start") if c == "start" else F.col(c) for c in columns or ["doc_id", "start", "n_tokens", "ids"]]
    return files.join(F.broadcast(starts), "shard").withColumn("start", F.col("base") + F.col("shard_start")).select(*wanted)


def token_checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and the unsigned CRC-32 of each row's ids as little-endian 32-bit integers."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            offsets = lists.offsets.to_numpy().tolist()
            data = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    schema = f"doc_id {id_type(tokens, 'doc_id')}, start long, n_tokens long, ids_crc32 long"
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(check, schema)

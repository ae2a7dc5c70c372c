"""Queries over text corpora."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import inputs
from millrace.catalog.registry import Registry
from millrace.operators import corpus
from millrace.session import scratch_path
from millrace.sources import sinks

registry = Registry()
add = registry.add

MAX_SIZE = 500
DIALOG_SPECIALS = (*corpus.RESERVED, corpus.DIALOG_UNKNOWN)
BUCKETS = ((10, 11), (20, 21), (40, 41))
_WITH = f"WITH {inputs.SQL_TOKENS}"
_VOCAB = inputs.sql_vocabulary(DIALOG_SPECIALS, MAX_SIZE)
_JOINED = "array_to_string(tokens, ' ')"


def dialog_vocabulary(spark, folder):
    counts = corpus.token_counts(inputs.corpus_tokens(spark, folder))
    return corpus.build_vocabulary(counts, DIALOG_SPECIALS, MAX_SIZE)


def _ids(column):
    return F.array_join(F.col(column).cast("array<string>"), " ")


@add("a1_scan_text_tokens", f"""
WITH {inputs.SQL_LINES}
SELECT doc_id, line_no, CAST(len(tokens) AS INTEGER) AS n_tokens, {_JOINED} AS tokens
FROM (SELECT doc_id, line_no, {inputs.sql_tokens('line')} AS tokens FROM lines)""")
def scan_text_tokens(spark, folder):
    return inputs.corpus_tokens(spark, folder, lower=False).select(
        "doc_id", "line_no", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


@add("a2_scan_text_tokens_lower", f"""
{_WITH} SELECT doc_id, line_no, CAST(len(tokens) AS INTEGER) AS n_tokens, {_JOINED} AS tokens FROM line_tokens""")
def scan_text_tokens_lower(spark, folder):
    return inputs.corpus_tokens(spark, folder).select(
        "doc_id", "line_no", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


@add("e1_token_counts", f"{_WITH} SELECT token, cnt FROM counts")
def token_counts(spark, folder):
    return corpus.token_counts(inputs.corpus_tokens(spark, folder))


@add("g1_vocab_topk", f"{_WITH} SELECT token, cnt FROM counts ORDER BY cnt DESC, token LIMIT 100")
def vocab_topk(spark, folder):
    return corpus.vocab_topk(corpus.token_counts(inputs.corpus_tokens(spark, folder)), 100)


@add("f1_vocab_rank", f"{_WITH}, {_VOCAB} SELECT token, cnt, id FROM vocab")
def vocab_rank(spark, folder):
    counts = corpus.token_counts(inputs.corpus_tokens(spark, folder))
    return corpus.vocabulary(counts, DIALOG_SPECIALS, MAX_SIZE)


@add("f1_vocab_rank_full", f"""
{_WITH}, {inputs.sql_vocabulary(DIALOG_SPECIALS, 1 << 30)} SELECT token, cnt, id FROM vocab""")
def vocab_rank_full(spark, folder):
    counts = corpus.materialize(corpus.token_counts(inputs.corpus_tokens(spark, folder)))
    return corpus.vocabulary(counts, DIALOG_SPECIALS)


_ENCODED = f"""
{_WITH}, {_VOCAB},
ids AS (SELECT token, max(id) AS id FROM vocab GROUP BY token),
encoded AS (
  SELECT doc_id, line_no, string_agg(CAST(coalesce(i.id, 3) AS VARCHAR), ' ' ORDER BY pos) AS ids
  FROM words w LEFT JOIN ids i ON w.token = i.token GROUP BY doc_id, line_no)"""


@add("d3_encode_tokens", f"""
{_ENCODED} SELECT l.doc_id, l.line_no, coalesce(e.ids, '') AS ids
FROM line_tokens l LEFT JOIN encoded e ON l.doc_id = e.doc_id AND l.line_no = e.line_no""")
def encode_tokens(spark, folder):
    vocab = dialog_vocabulary(spark, folder)
    encoded = corpus.encode_tokens(
        inputs.corpus_tokens(spark, folder), vocab, {"tokens": "ids"}, corpus.DIALOG_UNKNOWN)
    return encoded.select("doc_id", "line_no", _ids("ids").alias("ids"))


@add("d4_decode_ids", f"""
{_WITH}, {_VOCAB},
ids AS (SELECT token, max(id) AS id FROM vocab GROUP BY token),
decoded AS (
  SELECT doc_id, line_no, string_agg(CASE WHEN i.id IS NULL THEN '{corpus.DIALOG_UNKNOWN}' ELSE w.token END, ' ' ORDER BY pos)
    AS tokens
  FROM words w LEFT JOIN ids i ON w.token = i.token GROUP BY doc_id, line_no)
SELECT l.doc_id, l.line_no, coalesce(d.tokens, '') AS tokens
FROM line_tokens l LEFT JOIN decoded d ON l.doc_id = d.doc_id AND l.line_no = d.line_no""")
def decode_ids(spark, folder):
    vocab = dialog_vocabulary(spark, folder)
    encoded = corpus.encode_tokens(
        inputs.corpus_tokens(spark, folder), vocab, {"tokens": "ids"}, corpus.DIALOG_UNKNOWN)
    decoded = corpus.decode_ids(encoded.drop("tokens"), vocab, {"ids": "tokens"})
    return decoded.select("doc_id", "line_no", F.array_join("tokens", " ").alias("tokens"))


@add("d5_flag_unknown", f"""
{_WITH}, {_VOCAB}
SELECT c.token, c.cnt, v.token IS NULL OR c.token = '{corpus.DIALOG_UNKNOWN}' AS is_unknown
FROM counts c LEFT JOIN (SELECT DISTINCT token FROM vocab) v ON c.token = v.token""")
def flag_unknown(spark, folder):
    counts = corpus.materialize(corpus.token_counts(inputs.corpus_tokens(spark, folder)))
    vocab = corpus.build_vocabulary(counts, DIALOG_SPECIALS, MAX_SIZE)
    return corpus.flag_unknown(counts, vocab, corpus.DIALOG_UNKNOWN)


@add("h2_dataset_copies", f"""
WITH {inputs.SQL_LINES} SELECT doc_id, line_no, CAST(copy_id AS INTEGER) AS copy_id, line
FROM lines, range(2) AS c(copy_id)""")
def dataset_copies(spark, folder):
    return corpus.dataset_copies(inputs.corpus_lines(spark, folder), 2).select("doc_id", "line_no", "copy_id", "line")


# Words the corpus has, so that noise occurs on the given texts.
_SWAPS = {"then": "than", "than": "then", "on": "upon", "and": "as well"}
_PAIR_SWAPS = {**_SWAPS, "the the": "the", "is and": "and is so", "of the": "o' the", "the or": "nor"}
_DROPS = ("the", "is", "for")

_NOISE_KEYS = ("w.doc_id", "w.line_no", "w.copy_id", "w.pos")


def _in(words):
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _case(values):
    return " ".join("WHEN '{}' THEN '{}'".format(k.replace("'", "''"), v.replace("'", "''")) for k, v in values.items())


_COPIED = f"""
{_WITH}, copied AS (
  SELECT doc_id, line_no, pos, token, CAST(copy_id AS INTEGER) AS copy_id FROM words, range(2) AS c(copy_id)),
keys AS (SELECT doc_id, line_no, CAST(copy_id AS INTEGER) AS copy_id, tokens FROM line_tokens, range(2) AS c(copy_id))"""


@add("j3_noise_words", f"""
{_COPIED},
noisy AS (
  SELECT doc_id, line_no, copy_id, string_agg(out, ' ' ORDER BY pos) AS source FROM (
    SELECT doc_id, line_no, copy_id, pos, CASE
      WHEN token IN {_in(_SWAPS)} AND {inputs.sql_hash01('7r', *_NOISE_KEYS)} < 0.25 THEN CASE token {_case(_SWAPS)} END
      WHEN token IN {_in(_DROPS)} AND {inputs.sql_hash01('7d', *_NOISE_KEYS)} < 0.1 THEN NULL
      ELSE token END AS out
    FROM copied w) GROUP BY doc_id, line_no, copy_id)
SELECT k.doc_id, k.line_no, k.copy_id, coalesce(n.source, '') AS source, array_to_string(k.tokens, ' ') AS target
FROM keys k LEFT JOIN noisy n ON k.doc_id = n.doc_id AND k.line_no = n.line_no AND k.copy_id = n.copy_id""")
def noise_words(spark, folder):
    copied = corpus.dataset_copies(inputs.corpus_tokens(spark, folder), 2)
    source = corpus.noise_words(F.col("tokens"), [F.col(c) for c in ("doc_id", "line_no", "copy_id")],
                                replacements=_SWAPS, drops=_DROPS, drop_prob=0.1, seed=7)
    return copied.select("doc_id", "line_no", "copy_id", F.array_join(source, " ").alias("source"),
                         F.array_join("tokens", " ").alias("target"))


_PAIRS = {k: v for k, v in _PAIR_SWAPS.items() if " " in k}
_SINGLES = {k: v for k, v in _PAIR_SWAPS.items() if " " not in k}
_BIGRAM_NOISE = f"""
{_COPIED},
hits AS (
  SELECT *, token IN {_in(_SINGLES)} AND {inputs.sql_hash01('9r', *_NOISE_KEYS)} < 0.25 AS single,
    token || ' ' || lead(token) OVER line AS pair
  FROM copied w WINDOW line AS (PARTITION BY doc_id, line_no, copy_id ORDER BY pos)),
cands AS (
  SELECT *, coalesce(pair IN {_in(_PAIRS)} AND {inputs.sql_hash01('9p', *_NOISE_KEYS)} < 0.25 AND NOT single, false) AS cand
  FROM hits w),
islands AS (
  SELECT *, pos - count(*) FILTER (cand) OVER (PARTITION BY doc_id, line_no, copy_id ORDER BY pos) AS island FROM cands),
active AS (
  SELECT *, cand AND (row_number() OVER (PARTITION BY doc_id, line_no, copy_id, island, cand ORDER BY pos)) % 2 = 1 AS act
  FROM islands),
emitted AS (
  SELECT doc_id, line_no, copy_id, pos, CASE
    WHEN coalesce(lag(act) OVER (PARTITION BY doc_id, line_no, copy_id ORDER BY pos), false) THEN NULL
    WHEN single THEN CASE token {_case(_SINGLES)} END
    WHEN act THEN CASE pair {_case(_PAIRS)} END
    WHEN token IN {_in(_DROPS)} AND {inputs.sql_hash01('9d', *_NOISE_KEYS)} < 0.1 THEN NULL
    ELSE token END AS out
  FROM active w),
noisy AS (
  SELECT doc_id, line_no, copy_id, string_agg(out, ' ' ORDER BY pos) AS source FROM emitted GROUP BY ALL),
pairs AS (
  SELECT k.doc_id, k.line_no, k.copy_id, coalesce(n.source, '') AS source, array_to_string(k.tokens, ' ') AS target
  FROM keys k LEFT JOIN noisy n ON k.doc_id = n.doc_id AND k.line_no = n.line_no AND k.copy_id = n.copy_id)"""


def _noisy_pairs(spark, folder):
    copied = corpus.dataset_copies(inputs.corpus_tokens(spark, folder), 2)
    source = corpus.noise_bigrams(F.col("tokens"), [F.col(c) for c in ("doc_id", "line_no", "copy_id")],
                                  replacements=_PAIR_SWAPS, drops=_DROPS, drop_prob=0.1, seed=9)
    return copied.withColumn("source", source).withColumnRenamed("tokens", "target")


@add("j4_noise_bigrams", f"{_BIGRAM_NOISE} SELECT * FROM pairs")
def noise_bigrams(spark, folder):
    return _noisy_pairs(spark, folder).select(
        "doc_id", "line_no", "copy_id", F.array_join("source", " ").alias("source"),
        F.array_join("target", " ").alias("target"))


_ENCODED_PAIRS = f"""
{_BIGRAM_NOISE}, {_VOCAB},
ids AS (SELECT token, max(id) AS id FROM vocab GROUP BY token),
sides AS (
  SELECT doc_id, line_no, copy_id, side, t, o FROM (
    SELECT doc_id, line_no, copy_id, 's' AS side, unnest(string_split(source, ' ')) AS t,
      generate_subscripts(string_split(source, ' '), 1) AS o FROM pairs
    UNION ALL
    SELECT doc_id, line_no, copy_id, 't', unnest(string_split(target, ' ')),
      generate_subscripts(string_split(target, ' '), 1) FROM pairs) WHERE t <> ''),
sided AS (
  SELECT doc_id, line_no, copy_id, side, string_agg(CAST(coalesce(i.id, 3) AS VARCHAR), ' ' ORDER BY o) AS ids, count(*) AS n
  FROM sides s LEFT JOIN ids i ON i.token = s.t GROUP BY ALL),
coded AS (
  SELECT p.doc_id, p.line_no, p.copy_id, coalesce(s.ids, '') AS source, coalesce(t.ids || ' 2', '2') AS target,
    coalesce(s.n, 0) AS n_source, coalesce(t.n, 0) + 1 AS n_target
  FROM pairs p
  LEFT JOIN sided s ON s.side = 's' AND s.doc_id = p.doc_id AND s.line_no = p.line_no AND s.copy_id = p.copy_id
  LEFT JOIN sided t ON t.side = 't' AND t.doc_id = p.doc_id AND t.line_no = p.line_no AND t.copy_id = p.copy_id)"""


@add("j5_encode_pair", f"{_ENCODED_PAIRS} SELECT doc_id, line_no, copy_id, source, target FROM coded")
def encode_pair(spark, folder):
    pairs = corpus.encode_pairs(_noisy_pairs(spark, folder), dialog_vocabulary(spark, folder), corpus.DIALOG_UNKNOWN)
    return pairs.select("doc_id", "line_no", "copy_id", _ids("source").alias("source"), _ids("target").alias("target"))


_BUCKET_CASE = " ".join(f"WHEN n_source < {s} AND n_target < {t} THEN {i}" for i, (s, t) in enumerate(BUCKETS))


@add("j6_bucketize", f"""
{_ENCODED_PAIRS} SELECT * FROM (
  SELECT doc_id, line_no, copy_id, CAST(CASE {_BUCKET_CASE} END AS INTEGER) AS bucket_id, source, target FROM coded)
WHERE bucket_id IS NOT NULL""")
def bucketize(spark, folder):
    pairs = corpus.encode_pairs(_noisy_pairs(spark, folder), dialog_vocabulary(spark, folder), corpus.DIALOG_UNKNOWN)
    return corpus.bucketize(pairs, BUCKETS).select(
        "doc_id", "line_no", "copy_id", "bucket_id", _ids("source").alias("source"), _ids("target").alias("target"))


@add("j6_write_buckets", f"""
{_ENCODED_PAIRS} SELECT * FROM (
  SELECT doc_id, line_no, copy_id, CAST(CASE {_BUCKET_CASE} END AS INTEGER) AS bucket_id, source, target FROM coded)
WHERE bucket_id IS NOT NULL""")
def write_buckets(spark, folder):
    """The corpus from tokens to bucket folders: copies, noise, ids, buckets, and the folders read back."""
    path = scratch_path(spark, "buckets")
    pairs = corpus.build_dataset(
        inputs.corpus_tokens(spark, folder), dialog_vocabulary(spark, folder), key=["doc_id", "line_no"], copies=2, buckets=BUCKETS,
        replacements=_PAIR_SWAPS, drops=_DROPS, drop_prob=0.1, seed=9)
    sinks.write_buckets(pairs, path)
    stored = spark.read.schema(pairs.schema).parquet(path)
    return stored.select("doc_id", "line_no", "copy_id", "bucket_id", _ids("source").alias("source"), _ids("target").alias("target"))

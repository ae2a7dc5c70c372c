"""Inputs of the registered queries, derived from the given tables.

Each derivation stands here twice: as a DataFrame and as a SQL common table
expression for DuckDB. Numbers turn into text through integers, because the two
engines print doubles differently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import corpus
from millrace.session import load_table, spread


def micros(ts: Column) -> Column:
    """Microseconds since 1970, whatever the session time zone."""
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz"))


def two_decimals(cents: Column) -> Column:
    """``123`` as ``1.23``."""
    whole = F.floor(cents / 100).cast("long").cast("string")
    return F.concat(whole, F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


SQL_CENTS = "CAST(round(value * 100) AS BIGINT)"


def sql_two_decimals(cents: str) -> str:
    return f"(CAST(({cents}) // 100 AS VARCHAR) || '.' || lpad(CAST(({cents}) % 100 AS VARCHAR), 2, '0'))"


# -- corpus lines --------------------------------------------------------------------


def corpus_lines(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.lines(spread(load_table(spark, folder, "documents").select("doc_id", "text")), "text", "doc_id")


def corpus_tokens(spark: SparkSession, folder: str, lower: bool = True) -> DataFrame:
    return corpus.line_tokens(corpus_lines(spark, folder), lower=lower)


SQL_LINES = """
lines AS (
  SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS line_no, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""


def sql_tokens(line: str) -> str:
    return f"list_filter(regexp_split_to_array({line}, '\\s+'), lambda t: t <> '')"


SQL_TOKENS = f"""
{SQL_LINES},
line_tokens AS (SELECT doc_id, line_no, {sql_tokens('lower(line)')} AS tokens FROM lines),
words AS (
  SELECT doc_id, line_no, CAST(generate_subscripts(tokens, 1) - 1 AS INTEGER) AS pos, unnest(tokens) AS token
  FROM line_tokens),
counts AS (SELECT token, count(*) AS cnt FROM words GROUP BY token)"""


def sql_vocabulary(specials: tuple[str, ...], max_size: int) -> str:
    """``vocab(token, cnt, id)`` after ``counts``."""
    reserved = " UNION ALL ".join(
        f"SELECT '{t}' AS token, CAST(NULL AS BIGINT) AS cnt, {i} AS id" for i, t in enumerate(specials)
    )
    return f"""
vocab AS (
  SELECT * FROM ({reserved})
  UNION ALL
  SELECT token, cnt, id FROM (
    SELECT token, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, token) - 1 + {len(specials)} AS INTEGER) AS id
    FROM counts) WHERE id < {max_size})"""


# -- run logs --------------------------------------------------------------------------


def run_logs(spark: SparkSession, folder: str) -> DataFrame:
    """``(run_id, line_no, at_us, line)``: one run per user, the event id numbers its lines."""
    n, kind = F.col("event_id"), F.col("event_type")
    cents = F.round(F.col("value") * 100).cast("long")
    loss = F.when(n % 97 == 0, F.lit("1.2.3")).otherwise(two_decimals(cents))
    line = (
        F.when(
            kind == "view",
            F.concat(F.lit("epoch done Training Loss "), loss, F.lit(", at iteration "), (n % 5000).cast("string"),
                     F.lit(" ok")),
        )
        .when((kind == "click") & (n % 2 == 0), F.concat(F.lit("PROGRESS: "), two_decimals(cents % 10000), F.lit("%")))
        .when(
            kind == "click",
            F.concat(F.lit("at step "), F.when(n % 3 == 0, 490).otherwise(n % 490).cast("string"), F.lit(", loss = "),
                     two_decimals(cents), F.lit(" (0.5 sec)")),
        )
        .when((kind == "signup") & (n % 2 == 0), F.concat(F.lit("  max_iter: "), (n % 5 * 500 + 1000).cast("string")))
        .when(kind == "signup", F.concat(F.lit("> Execute Command: train_"), (n % 7).cast("string")))
        .when(
            kind == "purchase",
            F.concat(F.lit("solver] Iteration "), (n % 1000).cast("string"), F.lit(" (2.5 iter/s), loss = "),
                     (cents % 1000).cast("string"), F.lit("e-02")),
        )
        .otherwise(F.concat(F.lit("WARN retry "), n.cast("string")))
    )
    events = load_table(spark, folder, "events")
    return events.select(F.col("user_id").alias("run_id"), n.alias("line_no"), micros(F.col("ts")).alias("at_us"),
                         line.alias("line"))


SQL_LOGS = f"""
logs AS (
  SELECT user_id AS run_id, event_id AS line_no, epoch_us(ts) AS at_us,
    CASE
      WHEN event_type = 'view' THEN 'epoch done Training Loss '
        || CASE WHEN event_id % 97 = 0 THEN '1.2.3' ELSE {sql_two_decimals(SQL_CENTS)} END
        || ', at iteration ' || CAST(event_id % 5000 AS VARCHAR) || ' ok'
      WHEN event_type = 'click' AND event_id % 2 = 0
        THEN 'PROGRESS: ' || {sql_two_decimals(SQL_CENTS + ' % 10000')} || '%'
      WHEN event_type = 'click' THEN 'at step '
        || CAST(CASE WHEN event_id % 3 = 0 THEN 490 ELSE event_id % 490 END AS VARCHAR)
        || ', loss = ' || {sql_two_decimals(SQL_CENTS)} || ' (0.5 sec)'
      WHEN event_type = 'signup' AND event_id % 2 = 0
        THEN '  max_iter: ' || CAST(event_id % 5 * 500 + 1000 AS VARCHAR)
      WHEN event_type = 'signup' THEN '> Execute Command: train_' || CAST(event_id % 7 AS VARCHAR)
      WHEN event_type = 'purchase' THEN 'solver] Iteration ' || CAST(event_id % 1000 AS VARCHAR)
        || ' (2.5 iter/s), loss = ' || CAST({SQL_CENTS} % 1000 AS VARCHAR) || 'e-02'
      ELSE 'WARN retry ' || CAST(event_id AS VARCHAR)
    END AS line
  FROM events)"""

# The log formats that are recognised, as in functions.logs.
_RX_LOSS = r"^.*Training Loss ([0-9.]+), at iteration ([0-9]+)"
_RX_MAX = r"^\s*max_iter:\s(\d+)\s*$"
_RX_ITER = r"^.*\sIteration\s+(\d+)\s.*loss\s=\s([-+]?\d*.?\d+(?:e[-+]\d+)?)(?:\s.*)?$"
_RX_STEP = r"^.*step\s\d+,\sloss\s=\s(.*?)\s.*$"
_RX_EPOCH = r"^.*step\s490,\sloss\s=\s(.*?)\s.*$"
_RX_COMMAND = r"^.*Execute\sCommand:\s(.*?)$"


def _rx(text: str, pattern: str, group: int, kind: str) -> str:
    return (
        f"CASE WHEN regexp_matches({text}, '{pattern}') "
        f"THEN TRY_CAST(regexp_extract({text}, '{pattern}', {group}) AS {kind}) END"
    )


SQL_PARSED = f"""
{SQL_LOGS},
raw_losses AS (
  SELECT run_id, line_no, at_us, line, {_rx('line', _RX_LOSS, 1, 'DOUBLE')} AS l, {_rx('line', _RX_LOSS, 2, 'BIGINT')} AS i,
    CASE WHEN NOT regexp_matches(line, '{_RX_LOSS}') THEN {_rx('line', '^.*PROGRESS: ([0-9.]+)%', 1, 'DOUBLE')} END
      AS progress
  FROM logs),
parsed AS (
  SELECT run_id, line_no, at_us, line, progress, CASE WHEN i IS NOT NULL THEN l END AS loss,
    CASE WHEN l IS NOT NULL THEN i END AS iter
  FROM raw_losses)"""

SQL_SOLVER = f"""
{SQL_LOGS},
solver AS (
  SELECT run_id, line_no, at_us, {_rx('trim(line)', _RX_MAX, 1, 'BIGINT')} AS max_iter,
    {_rx('trim(line)', _RX_ITER, 1, 'BIGINT')} AS iter, {_rx('trim(line)', _RX_ITER, 2, 'DOUBLE')} AS loss
  FROM logs)"""

SQL_STEPS = f"""
{SQL_LOGS},
steps AS (
  SELECT run_id, line_no, {_rx('line', _RX_STEP, 1, 'DOUBLE')} AS minibatch_loss,
    {_rx('line', _RX_EPOCH, 1, 'DOUBLE')} AS epoch_loss, {_rx('line', _RX_COMMAND, 1, 'VARCHAR')} AS command
  FROM logs)"""


# -- checkpoints -------------------------------------------------------------------------


def checkpoint_files(spark: SparkSession, folder: str) -> DataFrame:
    """Solver states, one per order: the customer is the model, the order key the iteration."""
    orders = load_table(spark, folder, "orders")
    name = F.concat(F.lit("/models/m"), F.col("o_custkey").cast("string"), F.lit("_iter_"),
                    F.col("o_orderkey").cast("string"), F.lit(".solverstate"),
                    F.when(F.col("o_orderkey") % 3 == 0, ".h5").otherwise(""))
    return orders.select(F.col("o_custkey").alias("model"), name.alias("path"), micros(F.col("o_orderdate")).alias("mtime"),
                         F.col("o_orderstatus").alias("status"))


def weight_files(spark: SparkSession, folder: str) -> DataFrame:
    """Weight files, one per urgent order."""
    orders = load_table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'")
    name = F.concat(F.lit("/weights/m"), F.col("o_custkey").cast("string"), F.lit("_"),
                    F.col("o_orderkey").cast("string"), F.lit(".caffemodel"))
    return orders.select(F.col("o_custkey").alias("model"), name.alias("path"), micros(F.col("o_orderdate")).alias("mtime"))


SQL_CHECKPOINTS = r"""
files AS (
  SELECT o_custkey AS model, '/models/m' || o_custkey || '_iter_' || o_orderkey || '.solverstate'
    || CASE WHEN o_orderkey % 3 = 0 THEN '.h5' ELSE '' END AS path, epoch_us(o_orderdate) AS mtime,
    o_orderstatus AS status
  FROM orders),
weights AS (
  SELECT o_custkey AS model, '/weights/m' || o_custkey || '_' || o_orderkey || '.caffemodel' AS path,
    epoch_us(o_orderdate) AS mtime
  FROM orders WHERE o_orderpriority = '1-URGENT'),
states AS (
  SELECT *, regexp_extract(path, '^(?:.*/)?(.*_)([0-9]+)\.solverstate(.*)$', 1) AS prefix,
    CAST(regexp_extract(path, '_([0-9]+)\.solverstate', 1) AS BIGINT) AS iter,
    regexp_extract(path, '\.solverstate(.*)$', 1) AS suffix
  FROM files),
ranked_states AS (SELECT *, CAST(row_number() OVER (PARTITION BY model ORDER BY iter DESC, path) AS INTEGER) AS rank FROM states)"""


def sql_hash01(seed: object, *keys: str) -> str:
    text = " || '|' || ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"


def sql_hash32(seed: object, *keys: str) -> str:
    text = " || '|' || ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT)"

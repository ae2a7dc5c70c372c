"""Queries over sensor rows, hazard tags and text predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import inputs
from millrace.catalog.registry import Registry
from millrace.operators import corpus, temporal
from millrace.session import scratch_path, spread
from millrace.sources import files as scans

registry = Registry()
add = registry.add
table = inputs.load_table

HOUR = 3_600_000_000
FEATURES = ("f1", "f2")
TYPES = ("speed_bump", "big_pothole", "small_pothole", "sewer_cap")

_SENSOR = """
sensor AS (
  SELECT user_id AS trip_id, 'phone' || user_id % 3 AS device, epoch_us(ts) AS ts, event_id AS id, value AS f1,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS f2, event_type FROM events)"""
_HAZARDS = f"""
{_SENSOR},
hazards AS (
  SELECT trip_id, ts, id, ['speed_bump', 'big_pothole', 'small_pothole', 'sewer_cap'][id % 4 + 1] AS type
  FROM sensor WHERE event_type = 'error'),
samples AS (SELECT * FROM sensor WHERE event_type <> 'error')"""


def sensor(spark, folder):
    return table(spark, folder, "events").select(
        F.col("user_id").alias("trip_id"), F.concat(F.lit("phone"), (F.col("user_id") % 3).cast("string")).alias("device"),
        inputs.micros(F.col("ts")).alias("ts"), F.col("event_id").alias("id"), F.col("value").alias("f1"),
        F.get_json_object("props", "$.k").cast("double").alias("f2"), "event_type")


def hazards(spark, folder):
    kind = F.element_at(F.array(*[F.lit(t) for t in TYPES]), (F.col("id") % 4 + 1).cast("int"))
    return sensor(spark, folder).filter("event_type = 'error'").select("trip_id", "ts", "id", kind.alias("type"))


def samples(spark, folder):
    return sensor(spark, folder).filter("event_type <> 'error'")


@add("a10_scan_sensor_csv", f"WITH {_SENSOR} SELECT trip_id, device, ts, id, f1, f2 FROM sensor")
def scan_sensor_csv(spark, folder):
    """The sensor rows are recorded as CSV, then scanned."""
    path = scratch_path(spark, "sensor-csv")
    columns = ("trip_id", "device", "ts", "id", "f1", "f2")
    sensor(spark, folder).select(*columns).write.option("header", True).csv(path)
    rows = scans.sensor_csv(spark, path, "trip_id long, device string, ts long, id long, f1 double, f2 double")
    return rows.select(*columns)


@add("a11_scan_hazard_json", f"""
WITH {_HAZARDS}
SELECT trip_id, id, ts + 1000000 * k AS ts, CASE k WHEN 0 THEN type ELSE 'unpaved_road' END AS type,
  CAST(id AS DOUBLE) / 8 AS lat FROM hazards, range(2) AS r(k)""")
def scan_hazard_json(spark, folder):
    """Hazard records of two tags each are recorded as JSON, then scanned."""
    path = scratch_path(spark, "hazard-json")
    at = F.timestamp_micros("ts")
    place = F.struct((F.col("id") / 8).alias("lat"), F.lit(0.0).alias("lon"))
    tags = F.array(F.struct(place.alias("location"), at.alias("timestamp"), F.col("type")),
                   F.struct(place.alias("location"), (at + F.expr("interval 1 second")).alias("timestamp"),
                            F.lit("unpaved_road").alias("type")))
    hazards(spark, folder).select(
        F.col("trip_id").cast("string").alias("car"), F.lit("d").alias("driver"), F.col("id").cast("string").alias("tagger"),
        tags.alias("tags")).write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    found = scans.hazard_json(spark, path)
    return found.select(F.col("car").cast("long").alias("trip_id"), F.col("tagger").cast("long").alias("id"),
                        F.unix_micros("ts").alias("ts"), "type", "lat")


@add("c10_select_features", f"WITH {_SENSOR} SELECT trip_id, ts, f2 FROM sensor")
def select_features(spark, folder):
    return temporal.select_features(sensor(spark, folder), ["f2"])


@add("c6_filter_trips", f"""
WITH {_SENSOR} SELECT trip_id, device, ts, id, f1, event_type AS type, trip_id % 5 AS folder FROM sensor
WHERE device = 'phone1' AND event_type IN ('view', 'click') AND trip_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 1000)
  AND trip_id % 5 IN (SELECT r_regionkey FROM region WHERE r_regionkey < 3)""")
def filter_trips(spark, folder):
    rows = sensor(spark, folder).select(
        "trip_id", "device", "ts", "id", "f1", F.col("event_type").alias("type"), (F.col("trip_id") % 5).alias("folder"))
    blacklist = table(spark, folder, "customer").filter("c_acctbal < 1000").select(F.col("c_custkey").alias("trip_id"))
    folders = table(spark, folder, "region").filter("r_regionkey < 3").select(F.col("r_regionkey").cast("long").alias("folder"))
    return temporal.filter_trips(rows, blacklist, folders, "phone1", ["view", "click"])


@add("c7_crop_trip_start", f"""
WITH {_SENSOR} SELECT trip_id, ts, id FROM (
  SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY ts, id) AS n, count(*) OVER (PARTITION BY trip_id) AS size FROM sensor)
WHERE n > floor(size * 0.05)""")
def crop_trip_start(spark, folder):
    return temporal.crop_trip_start(sensor(spark, folder).select("trip_id", "ts", "id"), order=["ts", "id"])


def _nearest(left, right, value):
    """``nearest``: both neighbours of every left row by as-of joins, then the closer one."""
    return f"""
before AS (SELECT l.trip_id, l.ts, l.id, r.ts AS b_ts, r.{value} AS b_val FROM {left} l ASOF LEFT JOIN {right} r
  ON l.trip_id = r.trip_id AND l.ts >= r.ts),
after AS (SELECT l.id, r.ts AS a_ts, r.{value} AS a_val FROM {left} l ASOF LEFT JOIN {right} r
  ON l.trip_id = r.trip_id AND l.ts <= r.ts),
nearest AS (
  SELECT trip_id, ts, id, CASE WHEN a_ts IS NULL OR ts - b_ts <= a_ts - ts THEN b_ts ELSE a_ts END AS right_ts,
    CASE WHEN a_ts IS NULL OR ts - b_ts <= a_ts - ts THEN b_val ELSE a_val END AS val
  FROM before JOIN after USING (id))"""


@add("d9_nearest_time_join", f"""
WITH {_SENSOR},
images AS (SELECT trip_id, ts, id FROM sensor WHERE event_type = 'view'),
frames AS (SELECT trip_id, ts, id AS frame_id FROM sensor WHERE event_type = 'click'),
{_nearest('images', 'frames', 'frame_id')}
SELECT trip_id, ts, id, val AS frame_id, right_ts, abs(ts - right_ts) AS gap FROM nearest""")
def nearest_time_join(spark, folder):
    rows = sensor(spark, folder)
    images = rows.filter("event_type = 'view'").select("trip_id", "ts", "id")
    frames = rows.filter("event_type = 'click'").select("trip_id", "ts", F.col("id").alias("frame_id"))
    return temporal.nearest_time_join(images, frames, ["trip_id"], ["frame_id"], right_id="frame_id")


_LABELLED = f"""
{_HAZARDS}, {_nearest('samples', 'hazards', 'type')},
labelled AS (
  SELECT n.trip_id, n.ts, n.id, s.f1, s.f2, CASE WHEN abs(n.ts - right_ts) <= {3 * HOUR} THEN val END AS hazard
  FROM nearest n JOIN samples s USING (id))"""


def labelled(spark, folder):
    rows = samples(spark, folder).select("trip_id", "ts", "id", "f1", "f2")
    return temporal.label_sensor_rows(rows, hazards(spark, folder), 6 * HOUR)


@add("d10_label_sensor_rows", f"WITH {_LABELLED} SELECT trip_id, ts, id, hazard FROM labelled")
def label_sensor_rows(spark, folder):
    return labelled(spark, folder).select("trip_id", "ts", "id", "hazard")


_PAIRS = f"""
{_SENSOR},
tags AS (
  SELECT trip_id, ts, id, CASE event_type WHEN 'signup' THEN 's' WHEN 'purchase' THEN 'e' ELSE 'u' END AS type
  FROM sensor WHERE event_type IN ('signup', 'purchase', 'error')),
opened AS (SELECT *, count(*) FILTER (type = 's') OVER (PARTITION BY trip_id ORDER BY ts, id) AS k FROM tags),
intervals AS (
  SELECT trip_id, min(ts) FILTER (type = 's') AS start_ts, min(ts) FILTER (type = 'e') AS end_ts,
    CASE WHEN min((ts, id)) FILTER (type = 'u') < min((ts, id)) FILTER (type = 'e') THEN 'unpaved_road' ELSE 'bumpy_road' END AS cls
  FROM opened WHERE k > 0 GROUP BY trip_id, k HAVING count(*) FILTER (type = 'e') > 0)"""


def intervals(spark, folder):
    kind = (F.when(F.col("event_type") == "signup", temporal.START).when(F.col("event_type") == "purchase", temporal.END)
            .when(F.col("event_type") == "error", temporal.UNPAVED))
    return temporal.pair_start_end(sensor(spark, folder).select("trip_id", "ts", "id", kind.alias("type")))


@add("f12_pair_start_end", f"WITH {_PAIRS} SELECT trip_id, start_ts, end_ts, cls FROM intervals")
def pair_start_end(spark, folder):
    return intervals(spark, folder)


@add("d11_interval_label_join", f"""
WITH {_PAIRS} SELECT s.trip_id, s.ts, s.id, coalesce(i.cls, 'paved_road') AS cls
FROM sensor s LEFT JOIN intervals i ON i.trip_id = s.trip_id AND s.ts BETWEEN i.start_ts AND i.end_ts
WHERE s.event_type IN ('view', 'click')""")
def interval_label_join(spark, folder):
    rows = sensor(spark, folder).filter("event_type IN ('view', 'click')").select("trip_id", "ts", "id")
    return temporal.interval_label_join(rows, intervals(spark, folder))


@add("d11_overlapping_intervals", f"""
WITH {_SENSOR},
spans AS (
  SELECT trip_id, ts - id % 5 * {6 * HOUR} AS start_ts, ts + (id % 13 + 1) * {12 * HOUR} AS end_ts, event_type AS cls
  FROM sensor WHERE event_type IN ('signup', 'purchase', 'error'))
SELECT s.trip_id, s.ts, s.id, coalesce(i.cls, 'paved_road') AS cls
FROM sensor s LEFT JOIN spans i ON i.trip_id = s.trip_id AND s.ts BETWEEN i.start_ts AND i.end_ts
WHERE s.event_type IN ('view', 'click')
QUALIFY row_number() OVER (PARTITION BY s.id ORDER BY i.start_ts DESC, i.end_ts, i.cls DESC) = 1""")
def overlapping_intervals(spark, folder):
    """Every third kind of event holds its surroundings; such stretches nest and cross."""
    events = sensor(spark, folder).select("trip_id", "ts", "id", "event_type")
    spans = events.filter("event_type IN ('signup', 'purchase', 'error')").select(
        "trip_id", (F.col("ts") - F.col("id") % 5 * (6 * HOUR)).alias("start_ts"),
        (F.col("ts") + (F.col("id") % 13 + 1) * (12 * HOUR)).alias("end_ts"), F.col("event_type").alias("cls"))
    return temporal.overlap_label_join(events.filter("event_type IN ('view', 'click')").drop("event_type"), spans)


@add("d12_match_way_section", """
WITH points AS (
  SELECT o_orderkey AS id, 45 + (o_orderkey % 100 + o_orderkey * 31 % 17 / 17.0::DOUBLE) * 0.001::DOUBLE AS lat,
    7 + (o_orderkey // 750 + o_orderkey * 13 % 19 / 19.0::DOUBLE) * 0.001::DOUBLE AS lon FROM orders),
sections AS (
  SELECT p_partkey AS section_id, 45 + (p_partkey % 100 + p_partkey * 7 % 11 / 11.0::DOUBLE) * 0.001::DOUBLE AS lat,
    7 + (p_partkey // 100 + p_partkey * 5 % 13 / 13.0::DOUBLE) * 0.001::DOUBLE AS lon FROM part),
pairs AS (
  SELECT id, section_id, asin(sqrt(sin(radians(s.lat - p.lat) / 2) * sin(radians(s.lat - p.lat) / 2)
    + cos(radians(p.lat)) * cos(radians(s.lat)) * sin(radians(s.lon - p.lon) / 2) * sin(radians(s.lon - p.lon) / 2))) * 12742000.0::DOUBLE AS d
  FROM points p JOIN sections s ON floor(p.lat / 0.001::DOUBLE) - floor(s.lat / 0.001::DOUBLE) BETWEEN -1 AND 1
    AND floor(p.lon / 0.002::DOUBLE) - floor(s.lon / 0.002::DOUBLE) BETWEEN -1 AND 1),
best AS (SELECT id, min((d, section_id)) AS b FROM pairs WHERE d <= radians(0.001::DOUBLE) * 6371000.0::DOUBLE GROUP BY id)
SELECT p.id, b[2] AS section_id, round(b[1], 3) AS distance_m FROM points p LEFT JOIN best USING (id)""")
def match_way_section(spark, folder):
    k, p = F.col("o_orderkey"), F.col("p_partkey")
    points = spread(table(spark, folder, "orders").select("o_orderkey")).select(
        k.alias("id"), (45 + (k % 100 + k * 31 % 17 / 17.0) * 0.001).alias("lat"),
        (7 + (F.floor(k / 750) + k * 13 % 19 / 19.0) * 0.001).alias("lon"))
    sections = table(spark, folder, "part").select(
        p.alias("section_id"), (45 + (p % 100 + p * 7 % 11 / 11.0) * 0.001).alias("lat"),
        (7 + (F.floor(p / 100) + p * 5 % 13 / 13.0) * 0.001).alias("lon"))
    return temporal.match_way_section(points, sections).withColumn("distance_m", F.round("distance_m", 3))


@add("f10_rolling_features", f"""
WITH {_SENSOR} SELECT trip_id, ts, id, round(avg(f1) OVER w, 6) AS f1_mean, round(stddev_samp(f1) OVER w, 6) AS f1_std,
  min(f1) OVER w AS f1_min, max(f1) OVER w AS f1_max
FROM sensor WINDOW w AS (PARTITION BY trip_id ORDER BY ts, id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def rolling_features(spark, folder):
    rows = sensor(spark, folder).select("trip_id", "ts", "id", "f1")
    out = temporal.rolling_features(rows, ["f1"], 5, order=["ts", "id"]).drop("f1")
    return out.withColumns({c: F.round(c, 6) for c in ("f1_mean", "f1_std")})


_WINDOWS = f"""
{_LABELLED},
placed AS (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY ts, id) - 1 AS n FROM labelled),
windows AS (
  SELECT trip_id, n // 6 AS "window", round(avg(f1), 6) AS f1_mean,
    arg_min(hazard, n) FILTER (hazard IS NOT NULL AND n % 6 >= 1 AND n % 6 < 5) AS label
  FROM placed GROUP BY trip_id, n // 6 HAVING count(*) = 6)"""


def windows(spark, folder):
    out = temporal.step_windows(labelled(spark, folder), 6, 1, ["f1"], order=["ts", "id"])
    return out.withColumn("f1_mean", F.round("f1_mean", 6))


@add("f11_step_windows", f"""WITH {_WINDOWS} SELECT trip_id, "window", f1_mean, label FROM windows""")
def step_windows(spark, folder):
    return windows(spark, folder)


@add("g8_balance_negatives", f"""
WITH {_WINDOWS},
keyed AS (SELECT *, trip_id || ':' || "window" AS id FROM windows),
negative AS (
  SELECT *, row_number() OVER (ORDER BY {inputs.sql_hash32('neg', 'id')}, id) AS n FROM keyed WHERE label IS NULL)
SELECT trip_id, "window", label FROM keyed WHERE label IS NOT NULL
UNION ALL
SELECT trip_id, "window", label FROM negative WHERE n <= CAST(floor(0.5 * (SELECT count(label) FROM keyed)) AS BIGINT)""")
def balance_negatives(spark, folder):
    from millrace.session import materialize

    keyed = windows(spark, folder).withColumn("id", F.concat_ws(":", "trip_id", "window"))
    return temporal.balance_negatives(materialize(keyed), 0.5, seed="neg").select("trip_id", "window", "label")


@add("f13_resample", f"""
WITH {_SENSOR},
cells AS (SELECT trip_id, ts // {6 * HOUR} * {6 * HOUR} AS ts, avg(f1) AS f1, avg(f2) AS f2 FROM sensor GROUP BY 1, 2),
filled AS (SELECT *, lead(ts) OVER (PARTITION BY trip_id ORDER BY ts) AS nxt FROM cells)
SELECT trip_id, ts + k * {6 * HOUR} AS ts, round(f1, 6) AS f1, round(f2, 6) AS f2
FROM (SELECT *, unnest(range((coalesce(nxt, ts + {6 * HOUR}) - ts) // {6 * HOUR})) AS k FROM filled)""")
def resample(spark, folder):
    out = temporal.resample(sensor(spark, folder), 6 * HOUR, FEATURES)
    return out.withColumns({f: F.round(f, 6) for f in FEATURES})


@add("f14_scale_features", f"""
WITH {_SENSOR}, stats AS (
  SELECT avg(f1) AS m1, stddev_pop(f1) AS d1, min(f2) AS lo, max(f2) - min(f2) AS width FROM sensor)
SELECT id, round((f1 - m1) / d1, 6) AS f1, round((f2 - lo) / width, 6) AS f2 FROM sensor, stats""")
def scale_features(spark, folder):
    rows = sensor(spark, folder).select("id", "f1", "f2")
    out = temporal.scale_features(temporal.scale_features(rows, ["f1"], "standard"), ["f2"], "minmax")
    return out.withColumns({f: F.round(f, 6) for f in FEATURES})


_WORDS = f"""WITH {inputs.SQL_TOKENS.lstrip()}, texts AS (SELECT doc_id, line_no, pos, token AS text,
  doc_id || ':' || line_no || ':' || pos AS id FROM words)"""


@add("g7_sample_per_length", f"""
{_WORDS} SELECT id, text, CAST(n_chars AS INTEGER) AS n_chars FROM (
  SELECT *, length(text) AS n_chars, row_number() OVER (PARTITION BY length(text) ORDER BY {inputs.sql_hash32('len', 'id')}, id) AS n
  FROM texts WHERE length(text) BETWEEN 2 AND 16) WHERE n <= 20""")
def sample_per_length(spark, folder):
    words = corpus.token_rows(inputs.corpus_tokens(spark, folder), "doc_id", "line_no")
    keyed = words.select(F.concat_ws(":", "doc_id", "line_no", "pos").alias("id"), F.col("token").alias("text"))
    return temporal.sample_per_length(keyed, 20, seed="len")


@add("g9_split_by_day", f"""
WITH {_SENSOR} SELECT trip_id, ts, id, ts // 86400000000 IN (
    SELECT epoch_us(DATE '2024-01-01') // 86400000000 + r_regionkey * 3 FROM region) AS is_test FROM sensor""")
def split_by_day(spark, folder):
    """Days are numbered from 1970; every third day of the first half month is for testing."""
    days = table(spark, folder, "region").select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("r_regionkey") * 3).alias("day"))
    rows = sensor(spark, folder).select("trip_id", "ts", "id")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("ts") / 86_400_000_000).cast("int"))
    train, test = temporal.split_by_day(rows, days, day)
    names = ("trip_id", "ts", "id")
    return train.select(*names, F.lit(False).alias("is_test")).unionByName(test.select(*names, F.lit(True).alias("is_test")))


_OCR = """
ocr AS (
  SELECT doc_id, line_no, pos, 'img/' || doc_id || '-' || line_no || '-' || pos || '_' || token || '.png' AS file,
    CASE WHEN (doc_id * 7 + line_no * 3 + pos) % 5 = 0 THEN token || '?' ELSE token END AS text,
    (doc_id + line_no + pos) % 100 / 100.0::DOUBLE AS conf, CAST((doc_id + pos) % 60 AS INTEGER) AS comp_size
  FROM words)"""


def ocr_predictions(spark, folder):
    """Every corpus word read from an image named after it; every fifth is misread."""
    doc, line, pos, token = (F.col(c) for c in ("doc_id", "line_no", "pos", "token"))
    words = corpus.token_rows(inputs.corpus_tokens(spark, folder), "doc_id", "line_no")
    return words.select(
        doc, line, pos, F.concat(F.lit("img/"), F.concat_ws("-", doc, line, pos), F.lit("_"), token, F.lit(".png")).alias("file"),
        F.when((doc * 7 + line * 3 + pos) % 5 == 0, F.concat(token, F.lit("?"))).otherwise(token).alias("text"),
        ((doc + line + pos) % 100 / 100.0).alias("conf"), ((doc + pos) % 60).cast("int").alias("comp_size"))


@add("c5_filter_predictions", f"""
WITH {inputs.SQL_TOKENS}, {_OCR} SELECT doc_id, line_no, pos, text, conf, comp_size FROM ocr WHERE conf >= 0.5 AND comp_size >= 25""")
def filter_predictions(spark, folder):
    return temporal.filter_predictions(
        ocr_predictions(spark, folder).select("doc_id", "line_no", "pos", "text", "conf", "comp_size"))


@add("e12_ocr_eval", f"""
WITH {inputs.SQL_TOKENS}, {_OCR} SELECT CAST(length(token) AS INTEGER) AS n_chars, count(*) AS n,
  round(avg(CAST(text = token AS INTEGER)), 9) AS match_rate FROM ocr JOIN words USING (doc_id, line_no, pos) GROUP BY 1""")
def ocr_eval(spark, folder):
    return temporal.ocr_eval(ocr_predictions(spark, folder)).withColumn("match_rate", F.round("match_rate", 9))

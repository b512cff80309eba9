"""Rules of the feeds that no other query would notice missing: each result changes when its
rule is left out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import watermarks as H
from ..session import scratch_path
from ..sources import csv as C
from ..sources import pages as PG
from ..sources import sinks as K
from ..sources import snapshots as SN
from ..sources.specs import CLIENTS, REVIEWS, clients_spec
from .jobs import reviews_bootstrap
from .q_io import _events_as_reviews
from .registry import register
from .tables import RUN_1, RUN_2, table


def _clients(spark, sf, **known):
    """Customers as a clients export: ``known`` gives columns by target name, the others are blank."""
    return table(spark, sf, "customer").select(*[known.get(t, F.lit("")).alias(n) for n, _, t in CLIENTS.columns], "c_mktsegment")


def _csv(df):
    return df.write.option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "")


def _key():
    return F.col("c_custkey").cast("string")


@register("clients_bad_files", """
SELECT CAST(c_custkey AS VARCHAR) AS client_id, c_name AS first_name FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT 'bad files', CAST(count(DISTINCT c_mktsegment) AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING'""")
def clients_bad_files(spark, sf):
    """A clients file whose records do not fit its header is set aside, the others load."""
    rows = _clients(spark, sf, client_id=_key(), first_name=F.col("c_name"))
    root = scratch_path(spark, "clients")
    _csv(rows.where("c_mktsegment <> 'BUILDING'").drop("c_mktsegment")).csv(f"{root}/good")
    bad = rows.where("c_mktsegment = 'BUILDING'").drop("c_mktsegment").withColumn("last_name", F.lit("a, b"))
    bad.coalesce(1).write.option("header", True).option("quote", "").option("escapeQuotes", False).csv(f"{root}/bad")
    batch = C.read_csv_dir(spark, [f"{root}/good", f"{root}/bad"], CLIENTS)
    return batch.rows.select("client_id", "first_name").unionByName(
        batch.bad_files.agg(F.count("*").cast("string").alias("first_name")).select(F.lit("bad files").alias("client_id"), "first_name"))


def _reviews(spark, sf):
    return _events_as_reviews(table(spark, sf, "events"))


def _as_stored(spark, root):
    return SN.read_table(spark, root, "reviews").select("review_id", "branch_id", "rating")


@register("reviews_bad_file", """
SELECT CAST(event_id AS VARCHAR) AS review_id, event_type AS branch_id, CAST(floor(value) AS BIGINT) AS rating FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'refused', '', 1""")
def reviews_bad_file(spark, sf):
    """One bad file refuses the whole bootstrap of reviews, which then loads without it."""
    ev, landing, hub, refused = _reviews(spark, sf), scratch_path(spark, "reviews"), scratch_path(spark, "hub"), 0
    K.write_csv(ev.where("branch_id <> 'error'"), f"{landing}/all/good", REVIEWS)
    bad = K.as_csv_text(ev.where("branch_id = 'error'"), REVIEWS)
    bad.coalesce(1).write.option("header", True).option("quote", "").option("escapeQuotes", False).csv(f"{landing}/all/bad")
    try:
        reviews_bootstrap(spark, f"{landing}/all", hub, "run0", RUN_1)
    except ValueError:
        refused = int("reviews" not in SN.latest_manifest(spark, hub))
    reviews_bootstrap(spark, f"{landing}/all/good", hub, "run1", RUN_1)
    return _as_stored(spark, hub).unionByName(
        spark.range(1).select(F.lit("refused").alias("review_id"), F.lit("").alias("branch_id"), F.lit(refused).cast("long").alias("rating")))


@register("reviews_bootstrap_once", """
SELECT CAST(event_id AS VARCHAR) AS review_id, event_type AS branch_id, CAST(floor(value) AS BIGINT) AS rating FROM events WHERE event_id % 2 = 0""")
def reviews_bootstrap_once(spark, sf):
    """A second bootstrap, from other files, is left out because the table has rows."""
    ev, landing, hub = _reviews(spark, sf), scratch_path(spark, "reviews"), scratch_path(spark, "hub")
    for k in (0, 1):
        K.write_csv(ev.where(F.col("review_id").cast("long") % 2 == k), f"{landing}/{k}", REVIEWS)
        reviews_bootstrap(spark, f"{landing}/{k}", hub, f"run{k}", RUN_1)
    return _as_stored(spark, hub)


@register("clients_version_dates", """
SELECT CAST(c_custkey AS VARCHAR) AS client_id, CASE WHEN c_custkey % 2 = 0 THEN DATE '2024-01-01' + CAST(c_custkey % 28 AS INT) END AS as_date,
       CASE WHEN c_custkey % 2 = 1 THEN epoch_us(CAST(DATE '2024-01-01' + CAST(c_custkey % 28 AS INT) AS TIMESTAMP)) + 37815000000 END AS as_time_us
FROM customer""")
def clients_version_dates(spark, sf):
    """Versions of clients are dates, and a full timestamp gives none; read as timestamps it is the other way round."""
    day = F.date_format(F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("c_custkey") % 28).cast("int")), "yyyy-MM-dd")
    told = F.when(F.col("c_custkey") % 2 == 0, day).otherwise(F.concat(day, F.lit(" 10:30:15")))
    landing = scratch_path(spark, "clients")
    _csv(_clients(spark, sf, client_id=_key(), source_updated_at=told).drop("c_mktsegment")).csv(landing)
    dates = C.read_csv_dir(spark, landing, CLIENTS).rows.select("client_id", F.col("source_updated_at").cast("date").alias("as_date"))
    times = C.read_csv_dir(spark, landing, clients_spec("timestamp")).rows.select("client_id", F.unix_micros(F.col("source_updated_at").cast("timestamp")).alias("as_time_us"))
    return dates.join(times, "client_id")


_INTS = ["' ' || CAST(event_id AS VARCHAR) || ' '", "CAST(value AS VARCHAR) || 'x'", "''", "'-7'", "'99999999999999999999'", "'1.0'", "NULL"]


@register("parse_int_nullable", f"""
SELECT event_id, CASE WHEN regexp_matches(trim(t), '^[+-]?[0-9]+$') THEN TRY_CAST(trim(t) AS BIGINT) END AS v
FROM (SELECT event_id, CASE CAST(event_id % 7 AS INT) {' '.join(f'WHEN {k} THEN {e}' for k, e in enumerate(_INTS))} END AS t FROM events)""")
def parse_int_nullable(spark, sf):
    """what is no integer, or does not fit one, is NULL and not 0."""
    text = "CASE CAST(event_id % 7 AS INT) " + " ".join(f"WHEN {k} THEN {e.replace('VARCHAR', 'STRING')}" for k, e in enumerate(_INTS)) + " END"
    return table(spark, sf, "events").select("event_id", S.lenient_long(F.expr(text), None, "default").alias("v"))


@register("staff_dates", """
SELECT CAST(s_suppkey AS VARCHAR) AS staff_id, CASE WHEN s_suppkey % 6 IN (0, 1, 2) THEN DATE '1990-01-01' + CAST(s_suppkey % 1000 AS INT) END AS birth_date FROM supplier""")
def staff_dates(spark, sf):
    """staff dates come as a date, an instant with its offset or a date and time with a blank,
    cut to the day as written; other forms (T without an offset, blanks around, text) are NULL."""
    day = F.date_format(F.date_add(F.lit(dt.date(1990, 1, 1)), (F.col("s_suppkey") % 1000).cast("int")), "yyyy-MM-dd")
    forms = [day, F.concat(day, F.lit("T23:30:00-08:00")), F.concat(day, F.lit(" 00:15:00")), F.concat(day, F.lit("T10:00:00")), F.concat(F.lit(" "), day), F.lit("soon")]
    told = forms[0]
    for k, form in enumerate(forms):
        told = F.when(F.col("s_suppkey") % 6 == k, form).otherwise(told)
    rows = table(spark, sf, "supplier").select(F.col("s_nationkey").cast("string").alias("branch_id"), F.lit(0).cast("long").alias("page"), F.col("s_suppkey").alias("pos"),
                                               F.col("s_suppkey").cast("string").alias("staff_id"), told.alias("birth_date"))
    root = scratch_path(spark, "staff-pages")
    PG.write_pages(rows, root, "staff", page_size=200)
    read, _ = PG.read_pages(spark, root, "staff")
    return PG.parse_item_times(read, "staff").select("staff_id", "birth_date")


@register("clients_bad_bytes", """
SELECT CAST(c_custkey AS VARCHAR) AS client_id, 'Zo' || chr(65533) || chr(65533) || '!' AS first_name, c_name AS last_name FROM customer""")
def clients_bad_bytes(spark, sf):
    """bytes that are no UTF-8 become one replacement character each, none is lost or merged."""
    rows = _clients(spark, sf, client_id=_key(), first_name=F.lit("Zoéé!"), last_name=F.col("c_name")).drop("c_mktsegment")
    landing = scratch_path(spark, "clients")
    _csv(rows).option("encoding", "ISO-8859-1").csv(landing)
    return C.read_csv_dir(spark, landing, CLIENTS).rows.select("client_id", "first_name", "last_name")


@register("day_only", "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(ts AS DATE) END AS day FROM events")
def day_only(spark, sf):
    """a timestamp's day; a zero timestamp has none."""
    zero = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, sf, "events").select("event_id", S.day(F.when(F.col("event_id") % 7 == 0, zero).otherwise(F.col("ts"))).alias("day"))


@register("mark_lookup", """
SELECT 'transactions_csv' AS entity, '7' AS branch_id, max(l_shipdate) AS last_updated FROM lineitem WHERE l_suppkey = 7 HAVING count(*) > 0
UNION ALL SELECT 'clients_csv', 'ALL', max(ts) FROM events""")
def mark_lookup(spark, sf):
    """Marks by (entity, branch); a blank branch asks for the entity's own, and neither an
    unknown branch nor a known branch of another entity has one. The marks come from the hub."""
    root = scratch_path(spark, "hub")
    seeds = H.seed_hwm(table(spark, sf, "lineitem"), "transactions_csv", "l_shipdate", branch="l_suppkey").unionByName(
        H.seed_hwm(table(spark, sf, "events"), "clients_csv", "ts"))
    SN.publish(spark, root, "run0", {"hwm": H.merge_hwm(H.empty_hwm(spark, "timestamp_ntz", "date"), seeds, RUN_1)})
    hwm = SN.read_table(spark, root, "hwm")
    found = H.get_hwm(hwm, "transactions_csv", "7")
    for entity, branch in (("transactions_csv", "no such branch"), ("clients_csv", "7"), ("clients_csv", "")):
        found = found.unionByName(H.get_hwm(hwm, entity, branch))
    return found.select("entity", "branch_id", "last_updated")


@register("archive_replay", """
SELECT CAST(event_id AS VARCHAR) AS review_id, event_type AS branch_id, CAST(floor(value) AS BIGINT) AS rating FROM events""")
def archive_replay(spark, sf):
    """K2: two runs archived by branch and run, one of them twice: a bootstrap from the archive has
    every row once."""
    ev, root, hub = _reviews(spark, sf), scratch_path(spark, "archive"), scratch_path(spark, "hub")
    for run, part in (("20240101", 0), ("20240201", 1), ("20240201", 1)):
        K.archive(ev.where(F.col("review_id").cast("long") % 2 == part), root, REVIEWS, run)
    rows = C.read_csv_dir(spark, root, REVIEWS, on_bad_file="fail").rows
    SN.publish(spark, hub, "run0", {"reviews": rows.select(*REVIEWS.targets, F.lit(RUN_2).alias("created_at"))})
    return _as_stored(spark, hub)


@register("find_by_key", """
SELECT CAST(c_custkey AS VARCHAR) AS client_id, c_name AS first_name FROM customer WHERE c_custkey IN (3, 17)""")
def find_by_key(spark, sf):
    """Rows of a stored table by key, from one bucket each; a key that is not there gives none."""
    root = scratch_path(spark, "hub")
    rows = table(spark, sf, "customer").select(_key().alias("client_id"), F.col("c_name").alias("first_name"))
    SN.publish_bucketed(spark, root, "run0", "clients", rows, ["client_id"], 32)
    at = SN.snapshot(spark, root)
    found = [SN.find(spark, root, "clients", {"client_id": k}, at) for k in ("3", "17", "no one")]
    return found[0].unionByName(found[1]).unionByName(found[2])

"""Queries that arrive in several runs of a stream."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from normalake.plans.base import query, table
from normalake.streaming import captures as streams

c = F.col

#: Events arrive in five parts by day; each tenth one part late.
_PART = "CAST(floor((day(ts) - 1) / 8) AS INT) + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END"
PARTS = 5


def _events(spark, d):
    return table(spark, d, "events").withColumn("ts", c("ts").cast("timestamp")).withColumn("part", F.expr(_PART))


_LOG = f"""SELECT event_type AS tipo, CASE WHEN user_id % 10 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS numero, '' AS rendicao, 'pdf' AS formato,
  sha256(props) AS sha256, 'src-' || (event_id % 7) AS source, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS captured_at, event_id, {_PART} AS part FROM events"""


@query("str4_append_log", f"""WITH r AS (SELECT *, CASE WHEN numero = '' THEN source ELSE '' END AS one_of FROM ({_LOG})),
top AS (SELECT tipo, numero, one_of, part, max(captured_at) AS top FROM r GROUP BY ALL),
ok AS (SELECT r.* FROM r WHERE NOT EXISTS (SELECT 1 FROM top t WHERE t.tipo = r.tipo AND t.numero = r.numero AND t.one_of = r.one_of AND t.part < r.part AND t.top > r.captured_at))
SELECT tipo, numero, sha256, source, captured_at, event_id FROM ok QUALIFY row_number() OVER (PARTITION BY tipo, numero, one_of, sha256 ORDER BY part, captured_at, event_id) = 1""")  # fmt: skip
def _(spark, d):
    e = _events(spark, d)
    rows = e.select(
        c("event_type").alias("tipo"), F.when(c("user_id") % 10 == 0, "").otherwise(c("user_id").cast("string")).alias("numero"), F.lit("").alias("rendicao"), F.lit("pdf").alias("formato"),
        F.sha2("props", 256).alias("sha256"), F.concat(F.lit("src-"), (c("event_id") % 7).cast("string")).alias("source"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("captured_at"), "event_id", "part",
    )
    runs = [{"rows": rows.where(c("part") == k).drop("part")} for k in range(PARTS)]
    return streams.in_runs(spark, runs, lambda s: streams.append_log(s["rows"], then="event_id")).select("tipo", "numero", "sha256", "source", "captured_at", "event_id")


_WAIT = f"""h AS (SELECT 'u-' || user_id AS source, ts AS at, event_id FROM events WHERE event_type = 'error'),
i AS (SELECT 'u-' || user_id AS source, min(ts) AS at, 'lei' AS tipo, CAST(min(event_id) AS VARCHAR) AS numero FROM events WHERE event_type = 'click' AND user_id % 3 <> 0 AND day(ts) > 9 GROUP BY 1)"""


@query("str5_promoted_late", f"""WITH {_WAIT} SELECT h.source, h.at, h.event_id, CASE WHEN i.at <= h.at + INTERVAL 6 DAY THEN i.tipo END AS tipo, CASE WHEN i.at <= h.at + INTERVAL 6 DAY THEN i.numero END AS numero,
  CASE WHEN i.at <= h.at + INTERVAL 6 DAY THEN 'promoted' ELSE 'rest' END AS decision FROM h LEFT JOIN i USING (source)""")  # fmt: skip
def _(spark, d):
    """Promoted rows as the stream gives them out, and the rest of the holding area."""
    e = _events(spark, d).withColumn("source", F.concat(F.lit("u-"), c("user_id").cast("string")))
    held = e.where("event_type = 'error'").select("source", c("ts").alias("at"), "event_id", "part")
    ids = e.where("event_type = 'click' AND user_id % 3 <> 0 AND day(ts) > 9").groupBy("source").agg(F.min("ts").alias("at"), F.lit("lei").alias("tipo"), F.min("event_id").cast("string").alias("numero"), F.min_by("part", "ts").alias("part"))
    runs = [{"held": held.where(c("part") == k).drop("part"), "ids": ids.where(c("part") == k).drop("part")} for k in range(PARTS)]
    out = streams.in_runs(spark, runs, lambda s: streams.promoted(s["held"], s["ids"], datetime.timedelta(days=6), "20 days"))
    went = out.where("decision = 'promoted'")
    rest = held.drop("part").join(went.select("event_id"), "event_id", "left_anti").selectExpr("source", "at", "event_id", "CAST(NULL AS STRING) AS tipo", "CAST(NULL AS STRING) AS numero", "'rest' AS decision")
    return went.unionByName(rest)


@query("str6_fresh_snapshots", f"""WITH RECURSIVE r AS (SELECT user_id, {{'part': {_PART}, 't': ts, 'id': event_id}} AS one FROM events),
taken AS (
  SELECT user_id, min(one) AS one FROM r GROUP BY 1
  UNION ALL
  SELECT t.user_id, min(r.one) AS one FROM taken t JOIN r ON r.user_id = t.user_id AND r.one > t.one AND r.one.t > t.one.t + INTERVAL 24 HOUR GROUP BY 1)
SELECT user_id, one.t AS "at", one.id AS event_id FROM taken""")
def _(spark, d):
    rows = _events(spark, d).select("user_id", c("ts").alias("at"), "event_id", "part")
    runs = [{"rows": rows.where(c("part") == k).drop("part")} for k in range(PARTS)]
    return streams.in_runs(spark, runs, lambda s: streams.fresh(s["rows"], "user_id", datetime.timedelta(hours=24), "20 days"))

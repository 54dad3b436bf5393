"""SQL projections of the test tables into `inspection` frames.

The text runs unchanged in Spark SQL and DuckDB; `{events}` stands for the
`events` table. Measurements are dyadic, so their sums are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_REPEATED = """(
  SELECT event_id AS k, ts, user_id, event_type, value, props FROM {events}
  UNION ALL
  SELECT event_id AS k, ts, user_id, event_type, value, props FROM {events} WHERE event_id % 50 = 0
) src"""

# Every 50th event twice; NULLs, blanks and outer spaces scattered by id.
INSPECTION_SQL = f"""
SELECT
  CASE WHEN k % 101 = 0 THEN NULL ELSE CAST(k AS INT) END AS id,
  CASE WHEN k % 97 = 0 THEN NULL ELSE ts END AS date,
  CASE WHEN k % 89 = 0 THEN '   ' ELSE concat('  ', event_type, ' ') END AS zone,
  CASE WHEN k % 83 = 0 THEN NULL ELSE concat(' conv-', CAST(user_id % 17 AS VARCHAR(10))) END AS instal,
  CASE WHEN k % 5 = 0 THEN NULL ELSE k % 2 END AS p_produit,
  CASE WHEN k % 7 = 0 THEN NULL ELSE (k + 1) % 2 END AS huile_graisse,
  k % 2 AS ailette, (k + 1) % 2 AS boulonneries, k % 2 AS cable, (k + 1) % 2 AS plaque_a_borne,
  CASE WHEN k % 3 = 0 THEN NULL ELSE k % 2 END AS graisseur,
  CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(k % 90 AS DOUBLE) + 0.5 END AS t_av,
  CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(k % 80 AS DOUBLE) + 0.25 END AS t_ar,
  CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(k % 40 AS DOUBLE) / 8.0 END AS av_ax,
  CAST(k % 41 AS DOUBLE) / 8.0 AS av_h, CAST(k % 42 AS DOUBLE) / 8.0 AS av_v,
  CASE WHEN k % 19 = 0 THEN NULL ELSE CAST(k % 43 AS DOUBLE) / 8.0 END AS ar_ax,
  CAST(k % 44 AS DOUBLE) / 8.0 AS ar_h, CAST(k % 45 AS DOUBLE) / 8.0 AS ar_v,
  CASE WHEN k % 4 = 0 THEN ' ' ELSE props END AS observation,
  CASE WHEN k % 6 = 0 THEN NULL ELSE concat(event_type, ' ') END AS action,
  CASE WHEN k % 8 = 0 THEN '' ELSE concat('user', CAST(user_id AS VARCHAR(10))) END AS utilisateur
FROM {_REPEATED}
"""

# As a loosely typed source delivers it: fractional ids, textual numbers and
# dates, flags out of range, free text as numbers.
LOOSE_SQL = """
SELECT
  CAST(event_id AS DOUBLE) + 0.75 AS id,
  CASE WHEN event_id % 9 = 0 THEN 'pas une date' ELSE CAST(ts AS STRING) END AS date,
  event_type AS zone,
  user_id AS instal,
  CASE event_id % 5 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN '1.75' WHEN 3 THEN '-2.' ELSE 'oui' END AS p_produit,
  CASE WHEN event_id % 50 = 0 THEN 3000000000 ELSE event_id % 2 END AS huile_graisse,
  CAST(event_id % 2 AS DOUBLE) + 0.875 AS ailette,
  event_id % 2 = 0 AS boulonneries,
  CAST(event_id % 3 AS SMALLINT) AS cable,
  CASE WHEN event_id % 7 = 0 THEN 40000000000.0 ELSE -1.5 END AS plaque_a_borne,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 2 AS INT) END AS graisseur,
  CASE WHEN event_id % 4 = 0 THEN 'chaud' ELSE concat(CAST(event_id % 90 AS STRING), '.5') END AS t_av,
  CAST(value AS FLOAT) AS t_ar,
  event_id % 40 AS av_ax, CAST(event_id % 41 AS INT) AS av_h, CAST(event_id % 42 AS STRING) AS av_v,
  CAST(NULL AS STRING) AS ar_ax, value AS ar_h, event_id % 45 AS ar_v,
  event_id AS observation, event_id % 2 = 0 AS action, props AS utilisateur
FROM {events}
"""

# As a raw export: texts everywhere, accents and signs beyond Latin-1, fractional numbers as
# text, every 40th event twice, every 60th twice with a space more. `mark` 0: to be garbled.
RAW_SQL = """
SELECT
  concat(CAST(k AS VARCHAR(20)), '.25') AS id,
  CASE WHEN k % 97 = 0 THEN NULL ELSE CAST(ts AS VARCHAR(40)) END AS date,
  concat(CASE WHEN k % 3 = 1 THEN 'Zone déjà №' ELSE 'Entrée à côté ' END, CAST(user_id % 9 AS VARCHAR(10)), pad) AS zone,
  CASE WHEN k % 83 = 0 THEN '  ' ELSE concat('conv-é', CAST(user_id % 17 AS VARCHAR(10))) END AS instal,
  CASE WHEN k % 5 = 0 THEN 'oui' ELSE concat(CAST(k % 2 AS VARCHAR(10)), '.9') END AS p_produit,
  CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(k % 2 AS VARCHAR(10)) END AS huile_graisse,
  k % 2 AS ailette, k % 2 AS boulonneries, k % 2 AS cable, k % 2 AS plaque_a_borne, k % 2 AS graisseur,
  CASE WHEN k % 11 = 0 THEN 'chaud' ELSE concat(CAST(k % 90 AS VARCHAR(10)), '.5') END AS t_av,
  concat(CAST(k % 80 AS VARCHAR(10)), '.25') AS t_ar,
  concat(CAST(k % 40 AS VARCHAR(10)), '.125') AS av_ax,
  k % 41 AS av_h, k % 42 AS av_v, k % 43 AS ar_ax, k % 44 AS ar_h, k % 45 AS ar_v,
  CASE WHEN k % 4 = 0 THEN ' ' ELSE 'Bruit étrange — à revoir' END AS observation,
  CASE WHEN k % 6 = 0 THEN NULL ELSE 'resserré' END AS action,
  concat('user', CAST(user_id AS VARCHAR(10))) AS utilisateur,
  k % 3 AS mark
FROM (
  SELECT event_id AS k, ts, user_id, '' AS pad FROM {events}
  UNION ALL SELECT event_id, ts, user_id, '' FROM {events} WHERE event_id % 40 = 0
  UNION ALL SELECT event_id, ts, user_id, ' ' FROM {events} WHERE event_id % 60 = 0
) src
"""
RAW_NAMES = (
    " ID ", "Date", "ZONE", "Instal", "P. Produit", "Huile/Graisse", "ailette", "Boulonneries", "CABLE", "Plaque A-Borne",
    "graisseur", "T-AV", "T-AR", "AV AX", "AV H", "AV V", "AR AX", "AR H", "AR V", "Observation", "ACTION", " Utilisateur",
)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def projected(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql, events=table(spark, sf_dir, "events"))


def inspection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected(spark, sf_dir, INSPECTION_SQL)


def duckdb_sql(sql: str) -> str:
    """The same projection over DuckDB's `events` view."""
    return sql.replace("{events}", "events")

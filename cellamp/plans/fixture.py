"""Read pairs and a whitelist derived from the ``events`` table.

Both texts run unchanged in Spark SQL and DuckDB, so a query and its check start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellamp.config import Region, RegionConfig
from cellamp.session import spread

READS_SQL = """
WITH b AS (
 SELECT event_id AS read_id, user_id AS cell, md5(cast(event_id as string)) AS h,
        (event_id*7919) % 1000 AS k1, (event_id*104729) % 997 AS k2, (event_id*31) % 4 AS shift,
        md5('c' || cast(user_id as string)) AS hc FROM events),
c AS (
 SELECT *, translate(substr(hc,1,16),'0123456789abcdef','ACGTACGTACGTACGT') AS true_bc,
   translate(substr(md5('u' || cast(cell as string) || '_' || cast(k2 % 6 as string)),1,12),'0123456789abcdef','ACGTACGTACGTACGT') AS true_umi,
   translate(substr(md5('z' || cast(cell as string)),1,16),'0123456789abcdef','ACGTACGTACGTACGT') AS ghost FROM b),
e AS (
 SELECT *, CASE WHEN k1 < 80 AND cell % 5 = 0 THEN substr(true_bc,1,15) || translate(substr(true_bc,16,1),'ACGT','CGTA')
      WHEN k1 < 120 THEN substr(true_bc,1,k1 % 16) || translate(substr(true_bc,1+(k1 % 16),1),'ACGT','CGTA') || substr(true_bc,2+(k1 % 16))
      WHEN k1 < 400 AND cell % 10 = 0 THEN substr(true_bc,1,15) || translate(substr(true_bc,16,1),'ACGT','GTAC')
      WHEN k1 >= 950 AND k1 <= 985 AND cell % 7 = 3 THEN substr(ghost,1,15) || translate(substr(ghost,16,1),'ACGT','CGTA')
      WHEN k1 > 985 THEN translate(substr(h,1,16),'0123456789abcdef','ACGTACGTACGTACGT') ELSE true_bc END AS bc,
   CASE WHEN k2 < 100 THEN substr(true_umi,1,k2 % 12) || translate(substr(true_umi,1+(k2 % 12),1),'ACGT','GTAC') || substr(true_umi,2+(k2 % 12)) ELSE true_umi END AS umi,
   CASE WHEN ((cell*13 + k2 % 6) % 5 < 2) <> (k1 % 29 = 0) THEN 'ACCTAGGTTC' ELSE 'ACGTACGTAC' END AS tgt FROM c)
SELECT read_id, bc || umi AS seq_r1, translate(substr(md5('q1' || cast(read_id as string)),1,28),'0123456789abcdef','IIIIIHHGGFEDB;5+') AS qual_r1,
  substr(repeat('T',cast(shift as int)) || CASE WHEN k2 % 50 = 7 THEN 'GGGGGGGGGGGGGGGGGGGG' WHEN k1 % 9 = 0 THEN 'GATTACAGATTACAGATTAG' ELSE 'GATTACAGATTACAGATTAC' END
   || CASE WHEN k1 % 41 = 0 THEN 'AAAAAA' ELSE 'CCATGG' END
   || CASE WHEN k1 % 17 = 0 THEN substr(tgt,1,2) || translate(substr(tgt,3,1),'CG','GC') || substr(tgt,4) WHEN k1 % 23 = 0 THEN 'TTTTTTTTTT' ELSE tgt END
   || CASE WHEN k1 % 37 = 0 THEN 'AAAAAA' WHEN k2 % 3 = 0 THEN 'GTGAGT' ELSE 'GTCAGT' END
   || CASE WHEN k2 % 43 = 0 THEN 'GGGGGG' WHEN k1 % 3 = 0 THEN 'CAACAT' ELSE 'CATCAT' END
   || translate(h,'0123456789abcdef','ACGTACGTACGTACGT'), 1, 60) AS seq_r2,
  translate(substr(md5('q2' || cast(read_id as string)) || md5('q3' || cast(read_id as string)),1,60),'0123456789abcdef','IIIIIHHGGFEDB;5+') AS qual_r2
FROM e
"""

WHITELIST_SQL = """
SELECT DISTINCT bc FROM (
 SELECT translate(substr(md5('c' || cast(user_id as string)),1,16),'0123456789abcdef','ACGTACGTACGTACGT') AS bc FROM events WHERE user_id % 11 <> 3
 UNION ALL SELECT substr(bc0,1,15) || translate(substr(bc0,16,1),'ACGT','GTAC') FROM (SELECT translate(substr(md5('c' || cast(user_id as string)),1,16),'0123456789abcdef','ACGTACGTACGTACGT') AS bc0, user_id FROM events WHERE user_id % 5 = 0) z
 UNION ALL SELECT translate(substr(md5('z' || cast(user_id as string)),1,16),'0123456789abcdef','ACGTACGTACGTACGT') FROM events WHERE user_id % 7 = 3
 UNION ALL SELECT substr(g,1,15) || translate(substr(g,16,1),'ACGT','GTAC') FROM (SELECT translate(substr(md5('z' || cast(user_id as string)),1,16),'0123456789abcdef','ACGTACGTACGTACGT') AS g FROM events WHERE user_id % 14 = 3) v) y
"""

# Every 53rd read loses its second mate, every 59th its bases behind the primer, every 61st its known qualities.
DAMAGED_SQL = """
SELECT read_id, seq_r1, qual_r1,
  CASE WHEN read_id % 53 = 0 THEN '' WHEN read_id % 59 = 0 THEN substr(seq_r2, 1, 18) ELSE seq_r2 END AS seq_r2,
  CASE WHEN read_id % 53 = 0 THEN '' WHEN read_id % 59 = 0 THEN substr(qual_r2, 1, 18)
       WHEN read_id % 61 = 0 THEN repeat('~', 60) ELSE qual_r2 END AS qual_r2
FROM reads
"""

CIRC = RegionConfig(
    (
        Region("primer", "GATTACAGATTACAGATTAC", 1, 20),
        Region("shared", "CCATGG", 21, 26),
        Region("wt", "ACGTACGTAC", 27, 36),
        Region("mut", "ACCTAGGTTC", 27, 36),
        Region("fw_wt", "GTCAGT", 37, 42),
        Region("fw_mut", "GTGAGT", 37, 42),
        Region("rv_wt", "CATCAT", 43, 48),
        Region("rv_mut", "CAACAT", 43, 48),
    )
)
LINEAR = CIRC.linear()


def _events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(*columns)


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread(_events(spark, sf_dir, "event_id", "user_id"))
    return spark.sql(READS_SQL.replace("FROM events", "FROM {events}"), events=events)


def damaged_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DAMAGED_SQL.replace("FROM reads", "FROM {reads}"), reads=reads(spark, sf_dir))


def whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct barcodes; the order of the list is the order of the barcodes."""
    from cellamp.operators.whitelist import ordered_whitelist

    events = _events(spark, sf_dir, "user_id").distinct()
    barcodes = spark.sql(WHITELIST_SQL.replace("FROM events", "FROM {events}"), events=events)
    return ordered_whitelist(barcodes.selectExpr("bc", "bc AS position"))

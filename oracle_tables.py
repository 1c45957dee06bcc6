"""SQL forms of the sample tables, for the SQL twins of the queries.

Each constant is one or more common table expressions over ``orders``; ``with_tables`` joins those that a
query needs.  They are written independently of ``odmeter.samples``.
"""

OD = """
base AS (
 SELECT o_orderkey, CAST(o_orderdate AS DATE) AS od,
  CAST(o_orderkey % 4 AS INT) AS file_idx,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE -34.0e0 + ((o_custkey * 37) % 3900) / 100.0e0 END AS poc_latitude,
  -74.0e0 + ((o_custkey * 53) % 4000) / 100.0e0 AS poc_longitude,
  -34.0e0 + ((o_custkey * 37) % 3900) / 100.0e0
   + (CASE WHEN o_orderkey % 101 = 0 THEN 0 ELSE (o_orderkey * 17) % 200 - 100 END) / 1000.0e0 AS order_latitude,
  -74.0e0 + ((o_custkey * 53) % 4000) / 100.0e0
   + (CASE WHEN o_orderkey % 101 = 0 THEN 0 ELSE (o_orderkey * 29) % 200 - 100 END) / 1000.0e0 AS order_longitude
 FROM orders),
all_rows AS (
 SELECT *, 0 AS copy_no FROM base
 UNION ALL
 SELECT *, 1 AS copy_no FROM base WHERE o_orderkey % 50 = 0
 UNION ALL
 SELECT o_orderkey, od, (file_idx + 1) % 4 AS file_idx, poc_latitude, poc_longitude,
  order_latitude + 0.001e0 AS order_latitude, order_longitude, 2 AS copy_no FROM base WHERE o_orderkey % 70 = 0
 UNION ALL
 SELECT o_orderkey, CAST(od + INTERVAL '1' MONTH AS DATE) AS od, file_idx, poc_latitude, poc_longitude,
  order_latitude, order_longitude, 3 AS copy_no FROM base WHERE o_orderkey % 90 = 0),
od AS (
 SELECT CASE WHEN o_orderkey % 499 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS order_number,
  substring(CAST(od AS VARCHAR), 1, 7) AS partition_month,
  concat('part-0000', CAST(file_idx AS VARCHAR), '.snappy.parquet') AS source_file,
  file_idx, copy_no, o_orderkey * 4 + copy_no AS row_index,
  concat(substring(CAST(od AS VARCHAR), 1, 7), '-0', CAST(file_idx + 1 AS VARCHAR), 'T03:10:00+00:00') AS last_modified,
  poc_latitude, poc_longitude, order_latitude, order_longitude
 FROM all_rows)
"""

FILES = """
files AS (SELECT partition_month, source_file, file_idx, last_modified,
  concat(partition_month, '/', source_file) AS file_path, CAST(count(*) AS BIGINT) AS n
 FROM od GROUP BY ALL)
"""

ROUTES = """
routes AS (
 SELECT poc_longitude, poc_latitude, order_longitude, order_latitude,
  round(111000.0e0 * (abs(dlat) + abs(dlon)), 1) AS distance,
  round(111000.0e0 * (abs(dlat) + abs(dlon)) / 8.0e0, 1) AS duration
 FROM (SELECT DISTINCT poc_longitude, poc_latitude, order_longitude,
   CASE WHEN CAST(order_number AS BIGINT) % 10 = 3 THEN order_latitude + 0.00001e0 ELSE order_latitude END AS order_latitude,
   order_latitude - poc_latitude AS dlat, order_longitude - poc_longitude AS dlon
  FROM od
  WHERE poc_latitude IS NOT NULL AND order_number IS NOT NULL AND CAST(order_number AS BIGINT) % 10 <> 0) t)
"""

LANDED = """
landed AS (SELECT order_number, partition_month FROM od WHERE file_idx = 0 AND partition_month < '1998-01')
"""

FIRST_IN_FILE = """
first_in_file AS (SELECT * FROM od QUALIFY row_number() OVER
 (PARTITION BY partition_month, source_file, order_number ORDER BY row_index) = 1)
"""

CLEAN = """
clean AS (SELECT * FROM first_in_file WHERE poc_latitude IS NOT NULL AND poc_longitude IS NOT NULL
 AND order_latitude IS NOT NULL AND order_longitude IS NOT NULL)
"""

# Answers for the rows of a table named ``to_route``.
ROUTED = """
exact AS (
 SELECT poc_longitude, poc_latitude, order_longitude, order_latitude, distance, duration FROM routes
 QUALIFY row_number() OVER (PARTITION BY poc_longitude, poc_latitude, order_longitude, order_latitude
  ORDER BY distance, duration) = 1),
near AS (
 SELECT round_even(poc_longitude * 10000, 0) AS a, round_even(poc_latitude * 10000, 0) AS b,
  round_even(order_longitude * 10000, 0) AS c, round_even(order_latitude * 10000, 0) AS d, distance, duration
 FROM routes
 QUALIFY row_number() OVER (PARTITION BY a, b, c, d ORDER BY distance, duration) = 1),
routed AS (
 SELECT t.*, coalesce(e.distance, n.distance) AS distance, coalesce(e.duration, n.duration) AS duration,
  CASE WHEN t.poc_latitude IS NULL OR t.poc_longitude IS NULL OR t.order_latitude IS NULL
    OR t.order_longitude IS NULL THEN 'missing_coords'
   WHEN e.distance IS NOT NULL THEN 'exact' WHEN n.distance IS NOT NULL THEN 'rounded' ELSE 'no_route' END AS route_match
 FROM to_route t
 LEFT JOIN exact e ON t.poc_longitude = e.poc_longitude AND t.poc_latitude = e.poc_latitude
  AND t.order_longitude = e.order_longitude AND t.order_latitude = e.order_latitude
 LEFT JOIN near n ON round_even(t.poc_longitude * 10000, 0) = n.a AND round_even(t.poc_latitude * 10000, 0) = n.b
  AND round_even(t.order_longitude * 10000, 0) = n.c AND round_even(t.order_latitude * 10000, 0) = n.d)
"""

ALL_ROWS_TO_ROUTE = "to_route AS (SELECT * FROM od)"
CLEAN_ROWS_TO_ROUTE = "to_route AS (SELECT * FROM clean)"

GEO = """
geo AS (
 SELECT *, 2 * 6371008.8e0 * asin(least(1.0e0, sqrt(
   power(sin(radians(order_latitude - poc_latitude) / 2), 2)
   + cos(radians(poc_latitude)) * cos(radians(order_latitude))
   * power(sin(radians(order_longitude - poc_longitude) / 2), 2)))) * 1.3e0 AS metres
 FROM clean)
"""

LANDING_ROWS = """
landing AS (
 SELECT order_number, CAST(row_index AS DOUBLE) AS distance, CAST(file_idx AS DOUBLE) AS duration,
  substring(last_modified, 1, 10) AS ingestion_date, last_modified AS processing_timestamp, source_file,
  substring(partition_month, 1, 4) AS year, substring(partition_month, 6, 2) AS month
 FROM od)
"""

MANIFEST = """
manifest AS (
 SELECT partition_month, file_path, last_modified AS file_time, n AS rows,
  CASE WHEN partition_month < '2000-01' THEN 'HISTORICAL' WHEN partition_month = '2001-05' THEN 'INCREMENTAL_PREVIOUS'
   ELSE 'INCREMENTAL_CURRENT' END AS mode,
  concat(partition_month, '-28T04:00:00.000000') AS run_ts
 FROM files
 WHERE partition_month < '2000-01' OR partition_month = '2001-05'
  OR (partition_month = '2001-07' AND file_idx < 2) OR (partition_month = '2001-08' AND file_idx < 1)),
state AS (
 SELECT partition_month, bool_or(mode = 'HISTORICAL') AS completed,
  max(CASE WHEN mode <> 'HISTORICAL' THEN file_time END) AS checkpoint, max(run_ts) AS last_updated
 FROM manifest GROUP BY partition_month)
"""

# Months with their job type under the clock 2001-08-15.
PLAN = """
labelled AS (
 SELECT m.partition_month, s.checkpoint,
  CASE WHEN m.partition_month = '2001-08' THEN 'INCREMENTAL_CURRENT'
   WHEN m.partition_month = '2001-07' AND s.checkpoint IS NOT NULL THEN 'INCREMENTAL_PREVIOUS'
   WHEN coalesce(s.completed, false) THEN 'SKIP' ELSE 'HISTORICAL' END AS mode
 FROM (SELECT DISTINCT partition_month FROM od) m LEFT JOIN state s USING (partition_month)),
plan AS (
 SELECT *, row_number() OVER (ORDER BY CASE mode WHEN 'HISTORICAL' THEN 0 WHEN 'INCREMENTAL_PREVIOUS' THEN 1 ELSE 2 END,
  partition_month) - 1 AS seq
 FROM labelled WHERE mode <> 'SKIP')
"""

RUN_LOG = """
dated AS (SELECT o_orderkey AS k, o_custkey AS c, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders),
kinds AS (SELECT day, min(k) % 10 AS kind FROM dated GROUP BY day),
run_log AS (
 SELECT concat(day, '_', replace(day, '-', ''), '_040000_', CASE kind WHEN 0 THEN 'osrm_timeout'
   WHEN 1 THEN 'pipeline_failed' ELSE 'success' END, '.log') AS file_name, k AS line_no,
  CASE WHEN k % 11 = 0 THEN '' ELSE concat(day, ' 04:', lpad(CAST(k % 60 AS VARCHAR), 2, '0'), ':05 - ',
   CASE k % 7
    WHEN 0 THEN concat('⚠️  Removidas ', num, ' duplicatas do arquivo fonte!')
    WHEN 1 THEN concat('✅ Partição ', substring(day, 1, 7), ' concluída. Total: ', num)
    WHEN 2 THEN concat('📊 Total processado: ', num, ' registros')
    WHEN 3 THEN '❌ FALHA: Pipeline principal falhou. WARNING'
    ELSE '⚙️  Processando bloco' END) END AS line
 FROM (SELECT *, concat(CAST(c // 1000 + 1 AS VARCHAR), ',', lpad(CAST(c % 1000 AS VARCHAR), 3, '0')) AS num
  FROM dated JOIN kinds USING (day)))
"""

RUNS = """
runs AS (
 SELECT run_date, CASE k % 10 WHEN 0 THEN 'osrm_timeout' WHEN 1 THEN 'container_restart' ELSE 'success' END AS status,
  CASE WHEN k % 10 < 2 THEN CAST(k % 7 + 1 AS DOUBLE) END AS recovery_hours
 FROM (SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS run_date, min(o_orderkey) AS k FROM orders GROUP BY 1))
"""


def with_tables(query: str, *tables: str) -> str:
    return "WITH " + ",\n".join(t.strip() for t in tables) + "\n" + query.strip()

"""Bars, dimensions and snapshots derived from the star-schema test tables.

The texts run in Spark SQL and in DuckDB alike; ``{orders}`` etc. name the tables and
``{days}`` is a one-column relation ``rn`` of the integers 1 to 62.

Each stock is the orders of one block of 750 consecutive order keys, dated by the position
in the block. Order keys are unique, so no stock exceeds 750 bars and ``(stock, date)`` is
unique by construction: the number of stocks grows with the data, their length does not.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

BARS_PER_STOCK = 750
PLANTED_DAYS = 62

BARS = """
WITH x AS (
  SELECT o_orderkey,
         CAST(floor(o_orderkey / 750.0) AS BIGINT) AS stock_id,
         CAST(o_orderkey % 750 AS BIGINT) AS rn,
         CAST(round(o_totalprice * 100) AS BIGINT) AS x
  FROM {orders}),
walk AS (
  SELECT o_orderkey, stock_id, rn, x,
    ((CAST(floor(x / 7.0) AS BIGINT) % 61) - 30)
      * CASE WHEN CAST(floor(x / 13.0) AS BIGINT) % 3 = 0 THEN 10 ELSE 1 END AS body,
    CASE WHEN CAST(floor(x / 11.0) AS BIGINT) % 3 = 0
         THEN ((CAST(floor(x / 500.0) AS BIGINT) % 41) - 20) * 10 ELSE 0 END AS gap,
    CASE WHEN CAST(floor(x / 17.0) AS BIGINT) % 3 = 0 THEN 0
         ELSE CAST(floor(x / 1300.0) AS BIGINT) % 90 END AS up,
    CASE WHEN CAST(floor(x / 19.0) AS BIGINT) % 3 = 0 THEN 0
         ELSE CAST(floor(x / 9100.0) AS BIGINT) % 90 END AS dn
  FROM x),
priced AS (
  SELECT *, 3000 + CAST(sum(body + gap) OVER (PARTITION BY stock_id ORDER BY rn
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) % 1500 AS c
  FROM walk),
planted AS (
  SELECT CAST(-1 AS BIGINT) AS stock_id, rn,
    CASE WHEN rn <= 60 THEN 3005 - 10 * rn WHEN rn = 61 THEN 2400 ELSE 2240 END AS o,
    CASE WHEN rn <= 60 THEN 3000 - 10 * rn ELSE 2300 END AS c, 10 AS up, 10 AS dn
  FROM {days}
  UNION ALL
  SELECT CAST(-2 AS BIGINT), rn,
    CASE WHEN rn <= 60 THEN 1995 + 10 * rn WHEN rn = 61 THEN 2600 ELSE 2760 END,
    CASE WHEN rn <= 60 THEN 2000 + 10 * rn ELSE 2700 END, 10, 10
  FROM {days}
  UNION ALL
  SELECT CAST(-3 AS BIGINT), rn,
    CASE WHEN rn <= 57 THEN 3000 WHEN rn <= 61 THEN 2990 ELSE 2960 END,
    CASE WHEN rn <= 56 THEN 3005 WHEN rn = 57 THEN 2900 WHEN rn <= 61 THEN 3000 ELSE 2945 END, 5, 5
  FROM {days}
  UNION ALL
  SELECT CAST(-4 AS BIGINT), rn,
    CASE WHEN rn <= 59 THEN 1995 + 10 * rn WHEN rn = 60 THEN 2600 WHEN rn = 61 THEN 2760
         ELSE 2730 END,
    CASE WHEN rn <= 59 THEN 2000 + 10 * rn WHEN rn = 60 THEN 2700 WHEN rn = 61 THEN 2762
         ELSE 2640 END, 10, 10
  FROM {days}),
quoted AS (
  SELECT o_orderkey AS chart_id, stock_id, rn, c - body AS o, c, up, dn,
         1 + x % 100000 AS v FROM priced
  UNION ALL
  SELECT stock_id * 100 - rn, stock_id, rn, o, c, up, dn, 1000 + rn FROM planted)
SELECT CAST(chart_id AS BIGINT) AS chart_id, CAST(stock_id AS BIGINT) AS stock_id,
       CAST(date_add(DATE '1990-01-01', CAST(rn AS INT)) AS DATE) AS chart_date,
       CAST(o AS BIGINT) AS chart_open, CAST(greatest(o, c) + up AS BIGINT) AS chart_high,
       CAST(least(o, c) - dn AS BIGINT) AS chart_low, CAST(c AS BIGINT) AS chart_close,
       CAST(v AS BIGINT) AS chart_volume
FROM quoted
"""

STOCKS = """
SELECT CAST(c_custkey AS BIGINT) AS stock_id,
       lpad(CAST(c_custkey AS {text}), 12, '0') AS ticker,
       c_name AS stock_name, CAST(c_nationkey AS BIGINT) AS sector_id
FROM {customer}
"""

SECTORS = "SELECT CAST(n_nationkey AS BIGINT) AS sector_id, n_name AS sector_name FROM {nation}"

MARKET_CAP_SNAPSHOT = """
SELECT concat('A', lpad(CAST(c_custkey AS {text}), 12, '0')) AS symbol,
       CAST(round(abs(c_acctbal) * 100) AS BIGINT) AS cap
FROM {customer}
"""

LISTING = """
SELECT concat('A', lpad(CAST(c_custkey AS {text}), 12, '0')) AS symbol, c_name AS stock_name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN n_name ELSE concat('코스닥 ', n_name) END
         AS sector_name
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

RAW_BARS = """
SELECT concat('A', lpad(CAST(stock_id AS {text}), 12, '0')) AS symbol,
       CAST(year(chart_date) * 10000 + month(chart_date) * 100 + day(chart_date) AS INT) AS date,
       chart_open AS open, chart_high AS high, chart_low AS low, chart_close AS close,
       chart_volume AS volume
FROM {charts}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _derive(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    return spark.sql(text.replace("{text}", "STRING"), **frames)


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = spark.range(1, PLANTED_DAYS + 1, numPartitions=1).select(F.col("id").alias("rn"))
    return _derive(spark, BARS, orders=table(spark, sf_dir, "orders"), days=days)


def charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars as a ``charts`` table whose change percentages are not computed yet."""
    return bars(spark, sf_dir).withColumns({
        "chart_turnover": F.col("chart_close") * F.col("chart_volume"),
        "chart_change_percentage": F.lit(None).cast("double")})


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, RAW_BARS, charts=bars(spark, sf_dir))


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, STOCKS, customer=table(spark, sf_dir, "customer"))


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, SECTORS, nation=table(spark, sf_dir, "nation"))


def market_cap_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, MARKET_CAP_SNAPSHOT, customer=table(spark, sf_dir, "customer"))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(
        spark, LISTING,
        customer=table(spark, sf_dir, "customer"), nation=table(spark, sf_dir, "nation"))

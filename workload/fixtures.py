"""Messages and lines derived from `orders`, as SQL that Spark and DuckDB run unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordwash.plans.staging import Staging

# k is the row id, the stream offset and the tie-break for "first"; y the order year.
MESSAGES_CTE = r"""
base AS (
  SELECT o_orderkey AS k, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d,
    '渝' || lpad(cast(o_custkey % 37 AS string), 4, '0') || '民初' || cast(o_orderkey % 700 AS string) || '号' AS tail,
    CASE o_custkey % 4 WHEN 0 THEN '重庆市第一中级人民法院' WHEN 1 THEN '四川省高级人民法院'
      WHEN 2 THEN '吉林省四平市中级人民法院' ELSE '安徽省望江县人民法院' END AS crt
  FROM orders),
parts AS (
  SELECT k, y, tail, crt,
    CASE WHEN k % 11 = 0 THEN NULL WHEN k % 4 = 0 THEN '（2017）' || tail WHEN k % 4 = 1 THEN '[2017] ' || tail
      WHEN k % 4 = 2 THEN '〔2017〕' || tail ELSE '(2017)' || tail END AS rawno,
    CASE WHEN k % 17 = 0 THEN NULL ELSE crt END AS court,
    '2017-' || lpad(cast(m AS string), 2, '0') || '-' || CASE WHEN k % 37 = 0 THEN '99' WHEN k % 41 = 0 THEN lpad(cast(1 + d % 28 AS string), 2, '0') ELSE lpad(cast(d AS string), 2, '0') END AS jdate,
    CASE WHEN k % 29 = 0 THEN NULL WHEN k % 23 = 0 THEN '刑事' ELSE '民事' END AS ctype,
    CASE WHEN m <= 10 THEN substr('一二三四五六七八九十', cast(m AS int), 1)
      ELSE '十' || substr('一二', cast(m AS int) - 10, 1) END AS mon,
    CASE WHEN d <= 10 THEN substr('一二三四五六七八九十', cast(d AS int), 1)
      WHEN d < 20 THEN '十' || substr('一二三四五六七八九', cast(d AS int) - 10, 1) WHEN d = 20 THEN '二十'
      WHEN d < 30 THEN '二十' || substr('一二三四五六七八九', cast(d AS int) - 20, 1)
      WHEN d = 30 THEN '三十' ELSE '三十一' END AS dy
  FROM base),
msgs AS (
  SELECT k, y, '{"' || CASE WHEN k % 3 = 0 THEN 'casenumber' ELSE 'caseNumber' END || '":'
    || coalesce('"' || rawno || '"', 'null') || ',"court":' || coalesce('"' || court || '"', 'null')
    || ',"title":"甲与乙' || CASE WHEN k % 997 = 0 THEN repeat('劳动', 400) || '纠纷' WHEN k % 43 = 0 THEN '爆炸罪' WHEN k % 5 = 0 THEN '买卖合同纠纷' WHEN k % 5 = 1 THEN '借贷纠纷' ELSE '盗窃' END || '一审判决书"'
    || ',"sourceUrl":"u' || cast(k % 900 AS string) || '","judgementType":"判决书","judgementDate":"' || jdate
    || '","publishDate":"null","crawlDate":"2018-05-' || lpad(cast(1 + k % 28 AS string), 2, '0')
    || '","caseType":' || coalesce('"' || ctype || '"', 'null')
    || ',"status":"' || CASE WHEN k % 31 = 0 THEN 'x' ELSE cast(k % 5 AS string) END
    || '","trialRound":"一审","sourcename":"s' || cast(k % 3 AS string) || '","relateInfo":{"p":' || cast(k % 7 AS string)
    || '},"legalBase":"null","relateFile":" ","caseInfo":"","content":"<div>'
    || CASE WHEN k % 13 = 0 THEN '重庆市渝中区人民法院' ELSE crt END || '</div><div>民事一审</div><div> 民 事 判 决 书 </div>'
    || CASE WHEN k % 19 = 0 THEN '' ELSE '<div>（2017）' || tail || '</div>' END
    || CASE WHEN k % 7 = 0 THEN '<div>死刑复核</div>' ELSE '' END
    || '<div>二〇一七年' || mon || '月' || dy || '日</div>"' || CASE WHEN k % 101 = 0 THEN '' ELSE '}' END AS value
  FROM parts)
"""

# The same messages as crawlers write them: dates in other forms, missing or no dates, courts without
# their province, long texts, broken JSON, and messages that came twice.
_CRAWLED = "'\"crawlDate\":\"2018-05-'"
VARIED_CTE = rf"""
written AS (
  SELECT k, y, CASE k % 11
      WHEN 0 THEN replace(value, {_CRAWLED}, '"crawlDate":"2018-5-')
      WHEN 1 THEN replace(value, {_CRAWLED}, '"crawlDate":"201805')
      WHEN 2 THEN replace(value, {_CRAWLED}, '"crawlDate":"about ')
      WHEN 3 THEN replace(value, {_CRAWLED} || lpad(cast(1 + k % 28 AS string), 2, '0') || '"', '"crawlDate":null')
      WHEN 4 THEN replace(value, {_CRAWLED}, '"crawlDate":"2017-13-')
      ELSE value END AS value
  FROM msgs),
dated AS (
  SELECT k, y, CASE k % 9
      WHEN 0 THEN replace(value, '"judgementDate":"2017-0', '"judgementDate":"2017-')
      WHEN 1 THEN replace(replace(replace(value, '"judgementDate":"2017-10-', '"judgementDate":"201710'),
        '"judgementDate":"2017-11-', '"judgementDate":"201711'), '"judgementDate":"2017-12-', '"judgementDate":"201712')
      ELSE value END AS value
  FROM written),
named AS (
  SELECT k, y, CASE WHEN k % 8 >= 5 THEN replace(replace(value, '"court":"安徽省望江县', '"court":"望江县'),
      '"court":"吉林省四平市中级', '"court":"四平市中级') ELSE value END AS value
  FROM dated),
single AS (
  SELECT k, y, CASE WHEN k % 59 = 7 THEN '{{"a" ' || cast(k AS string) || '}}'
      WHEN k % 499 = 1 THEN replace(value, '<div>民事一审</div>', '<div>民事一审</div>' || repeat('原告诉称：被告应当依法承担责任。', 1 + cast(k % 20 AS int) * 150))
      ELSE value END AS value
  FROM named),
varied AS (
  SELECT k, y, value FROM single
  UNION ALL SELECT k + 100000000 AS k, y, value FROM single WHERE k % 20 = 3)
"""

# Eight pipe-delimited fields; every 53rd is a comma header, every 59th has nine fields.
LINES_CTE = r"""
packed AS (
  SELECT o_orderkey AS k,
    CASE WHEN o_orderkey % 53 = 0 THEN 'caseNumber,title,court,reason'
      ELSE '（2017）渝' || cast(o_custkey % 37 AS string) || '民初' || cast(o_orderkey % 700 AS string) || '号|甲诉乙'
        || CASE o_orderkey % 6 WHEN 0 THEN '买卖合同纠纷' WHEN 1 THEN '民间借贷纠纷' WHEN 2 THEN '盗窃' WHEN 3 THEN '离婚纠纷、股权转让纠纷'
          WHEN 4 THEN '刑事判决书' ELSE '案' END
        || '|某市人民法院|'
        || CASE o_orderkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN '' WHEN 2 THEN '劳动争议' WHEN 3 THEN ' ' ELSE '继承纠纷' END
        || '|' || substr(cast(o_orderdate AS string), 1, 10) || '|u' || cast(o_orderkey % 90 AS string)
        || '|正文' || CASE o_orderkey % 3 WHEN 0 THEN '民事' WHEN 1 THEN '刑事' ELSE '' END || o_orderpriority
        || '|' || CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE substr(cast(o_orderdate AS string), 1, 10) END
        || CASE WHEN o_orderkey % 59 = 0 THEN '|9' ELSE '' END
    END AS value
  FROM orders)
"""

# Courts with and without their province and city; one short name is that of two courts.
COURTS_CTE = r"""
spelled AS (
  SELECT o_orderkey AS k, '(2017)渝' || cast(o_custkey % 37 AS string) || '民初' || cast(o_orderkey % 300 AS string) || '号' AS number,
    CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE
      CASE WHEN o_orderkey % 3 = 0 THEN CASE o_custkey % 6 WHEN 0 THEN '重庆市' WHEN 1 THEN '四川省'
          WHEN 2 THEN '吉林省四平市' WHEN 3 THEN '河北省张家口市' WHEN 4 THEN '河北省邢台市' ELSE '' END
        WHEN o_orderkey % 3 = 1 THEN CASE o_custkey % 6 WHEN 2 THEN '四平市' WHEN 3 THEN '张家口市'
          WHEN 4 THEN '邢台市' ELSE '' END
        ELSE '' END
      || CASE o_custkey % 6 WHEN 0 THEN '渝中区' WHEN 1 THEN '成都市锦江区' WHEN 2 THEN '铁西区'
        WHEN 3 THEN '桥东区' WHEN 4 THEN '桥东区' ELSE '望江县' END || '人民法院' END AS court
  FROM orders)
"""

# History is what came before this year.
FIRST_BATCH_YEAR = 1997


def _derived(spark: SparkSession, sf_dir: str, query: str, name: str) -> DataFrame:
    """Rows derived from `orders`, written once per session like any source table.

    A compact input file is one task, however much text is derived from its rows, so the
    rows are spread first when there are fewer input splits than cores.
    """
    known = (spark.sparkContext.applicationId, sf_dir, name)
    if known not in _STORED:
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
        cores = spark.sparkContext.defaultParallelism
        if orders.rdd.getNumPartitions() < cores:
            orders = orders.repartition(cores, "o_orderkey")
        orders.createOrReplaceTempView("orders")
        staging = Staging(spark)
        staging.store(spark.sql(query), name)
        _STORED[known] = staging.path(name)
    return spark.read.parquet(_STORED[known])


_STORED: dict[tuple[str, str, str], str] = {}


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, y, value)"""
    query = f"WITH {MESSAGES_CTE} SELECT k, y, value FROM msgs"
    return _derived(spark, sf_dir, query, "messages")


def varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, y, value): messages that reach every branch of the wash."""
    query = f"WITH {MESSAGES_CTE}, {VARIED_CTE} SELECT k, y, value FROM varied"
    return _derived(spark, sf_dir, query, "varied")


def declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, rawno, court): the declared values before they are put into a message."""
    query = f"WITH {MESSAGES_CTE} SELECT k, rawno, court FROM parts"
    return _derived(spark, sf_dir, query, "declared")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, value)"""
    query = f"WITH {LINES_CTE} SELECT k, value FROM packed"
    return _derived(spark, sf_dir, query, "lines")


def spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, number, court): cases under several spellings of their court."""
    query = f"WITH {COURTS_CTE} SELECT k, number, court FROM spelled"
    return _derived(spark, sf_dir, query, "spelled")


def as_stream_rows(messages: DataFrame) -> DataFrame:
    """The source contract: value, topic, partition, offset, timestamp."""
    return messages.select(
        "value",
        F.lit("cases").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("k").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )

"""Source tables as views over the benchmark's parquet tables.

The same text defines the input of the DuckDB check, so both engines start from equal rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_MENU_ID = "(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)) * 10 + o_orderkey % 2"

SOURCE_SQL = {
    "account": """
        SELECT c_custkey AS user_id, c_name AS username,
               CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
               make_date(CAST(1970 + c_custkey % 35 AS INT), 1, 1) AS birth_date,
               CAST(1 + c_custkey % 14 AS STRING) AS ssafy_year, CAST(1 + c_custkey % 6 AS STRING) AS class_num,
               n_name AS ssafy_region
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "food": """
        SELECT p_partkey AS food_id, p_name AS food_name,
               CASE WHEN p_size <= 17 THEN '주메뉴' WHEN p_size <= 34 THEN '서브메뉴' ELSE '기타' END AS main_sub,
               p_type AS category, p_brand AS tag
        FROM part""",
    "menu": f"SELECT DISTINCT {_MENU_ID} AS menu_id, CAST(o_orderdate AS DATE) AS date FROM orders",
    "menu_food": f"""
        SELECT DISTINCT {_MENU_ID} AS menu_id, l_partkey AS food_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "food_review": """
        SELECT l_orderkey * 10 + l_linenumber AS id, o_custkey AS user_id, l_partkey AS food_id,
               ceil(l_quantity / 5) / 2 AS food_score, o_orderdate AS timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "menu_review": f"""
        SELECT o_orderkey AS id, o_custkey AS user_id, {_MENU_ID} AS menu_id,
               CAST(1 + o_orderkey % 10 AS DOUBLE) / 2 AS menu_score,
               CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS menu_regret,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS menu_comment,
               o_orderdate AS timestamp
        FROM orders""",
    # Voting in advance stands for the two most pressing order priorities.
    "pre_vote": f"""
        SELECT o_orderkey AS pre_vote_id, {_MENU_ID} AS menu_id, o_custkey AS user_id
        FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "raw_insight": """
        SELECT user_id, CAST(ts AS DATE) AS insight_date, event_id, concat(event_type, ' ', props) AS insight
        FROM events""",
    "review_comment": """
        SELECT doc_id % 150 AS user_id, text AS menu_comment,
               make_date(2024, 1, CAST(1 + doc_id % 30 AS INT)) AS comment_date
        FROM documents""",
    "messages": """
        SELECT CAST(CAST(event_id AS STRING) AS BINARY) AS key, CAST(props AS BINARY) AS value FROM events""",
}

BASE_TABLES = ("nation", "customer", "part", "orders", "lineitem", "events", "documents")


class Sources:
    """Source tables of one data folder, as lazy frames."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def base(self, table: str) -> DataFrame:
        if table not in self._frames:
            self._frames[table] = self.spark.read.parquet(f"{self.root}/{table}.parquet")
        return self._frames[table]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SOURCE_SQL:
            raise AttributeError(name)
        if name not in self._frames:
            text = SOURCE_SQL[name]
            used = [t for t in BASE_TABLES if re.search(rf"\b(?:FROM|JOIN) {t}\b", text)]
            for table in used:
                text = re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", text)
            self._frames[name] = self.spark.sql(text, **{t: self.base(t) for t in used})
        return self._frames[name]

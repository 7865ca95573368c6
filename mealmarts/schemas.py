"""Table contracts: columns, keys, value domains and references of every stored table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The code sets of the warehouse.
GENDERS = ("m", "f")
MAIN_SUB_CODES = ("main", "sub", "etc")
SCORE_TYPES = ("best", "worst")
GROUP_TYPES = ("all", "gender", "age")


@dataclass(frozen=True)
class Contract:
    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    references: dict[str, str] = field(default_factory=dict)
    partition_by: str | None = None

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)

    def enforce(self, df: DataFrame) -> DataFrame:
        """Columns of the contract, in its order and types; a missing column is an error."""
        missing = [f.name for f in self.schema if f.name not in df.columns]
        if missing:
            raise ValueError(f"{self.name}: missing columns {missing}")
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])


_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "DECIMAL(3,2)": T.DecimalType(3, 2),
    "DECIMAL(38,0)": T.DecimalType(38, 0),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "BINARY": T.BinaryType(),
}


def _schema(columns: str) -> T.StructType:
    # StructType.fromDDL needs a running session, and contracts are read before there is one.
    pairs = (column.split() for column in columns.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _contract(name, ddl, key="", domains=None, references=None, partition_by=None):
    return Contract(
        name,
        _schema(ddl),
        tuple(key.split()),
        domains or {},
        references or {},
        partition_by,
    )


_USER = {"user_id": "dim_user"}

# Table and column names are the interface of the warehouse and its marts.
_ALL = [
    _contract(
        "account",
        "user_id BIGINT, username STRING, gender STRING, birth_date DATE, ssafy_year STRING, "
        "class_num STRING, ssafy_region STRING",
        "user_id",
    ),
    _contract(
        "food",
        "food_id BIGINT, food_name STRING, main_sub STRING, category STRING, tag STRING",
        "food_id",
    ),
    _contract("menu", "menu_id BIGINT, date DATE", "menu_id"),
    _contract("menu_food", "menu_id BIGINT, food_id BIGINT", "menu_id food_id"),
    _contract(
        "food_review",
        "id BIGINT, user_id BIGINT, food_id BIGINT, food_score DOUBLE, timestamp TIMESTAMP_NTZ",
        "id",
    ),
    _contract(
        "menu_review",
        "id BIGINT, user_id BIGINT, menu_id BIGINT, menu_score DOUBLE, menu_regret INT, "
        "menu_comment STRING, timestamp TIMESTAMP_NTZ",
        "id",
    ),
    _contract("pre_vote", "pre_vote_id BIGINT, menu_id BIGINT, user_id BIGINT", "pre_vote_id"),
    _contract(
        "dim_user",
        "user_id BIGINT, gender STRING, birth_year INT, ssafy_year INT, ssafy_class INT, ssafy_region STRING",
        "user_id",
        {"gender": GENDERS},
    ),
    _contract(
        "dim_menu_food_combined",
        "menu_id BIGINT, menu_date DATE, food_id BIGINT, food_name STRING, main_sub STRING, "
        "category_name STRING, tag_name STRING",
        "food_id menu_id",
        {"main_sub": MAIN_SUB_CODES},
    ),
    _contract(
        "fact_user_food_feedback",
        "user_id BIGINT, food_id BIGINT, food_score DOUBLE, rating_date DATE",
        "user_id food_id rating_date",
        references=_USER,
        partition_by="rating_date",
    ),
    _contract(
        "fact_user_menu_feedback",
        "user_id BIGINT, menu_id BIGINT, menu_score DOUBLE, menu_regret INT, menu_comment STRING, "
        "pre_vote INT, comment_date DATE",
        "user_id menu_id comment_date",
        references=_USER,
        partition_by="comment_date",
    ),
    _contract(
        "raw_user_review_word",
        "user_id BIGINT, word STRING, comment_date DATE, count BIGINT",
        "user_id word comment_date",
        references=_USER,
        partition_by="comment_date",
    ),
    _contract(
        "raw_user_insight",
        "user_id BIGINT, insight_date DATE, insight STRING",
        "user_id insight_date",
        references=_USER,
        partition_by="insight_date",
    ),
    _contract(
        "xgb_train_data",
        "user_id BIGINT, menu_id BIGINT, user_gender STRING, user_age INT, "
        "A_tag_overlap INT, B_tag_overlap INT, A_tag_ratio DOUBLE, B_tag_ratio DOUBLE, "
        "A_category_overlap INT, B_category_overlap INT, A_category_ratio DOUBLE, B_category_ratio DOUBLE, "
        "A_avg_score_on_tags DOUBLE, B_avg_score_on_tags DOUBLE, "
        "A_avg_score_on_categories DOUBLE, B_avg_score_on_categories DOUBLE, "
        "menu_regret INT, pre_vote INT, label INT, train_date DATE",
        "user_id train_date menu_id",
        {"user_gender": GENDERS},
        _USER,
        "train_date",
    ),
    _contract("dm_user_summary", "user_id BIGINT, avg_score DOUBLE, total_reviews BIGINT, pre_vote_count BIGINT", "user_id"),
    _contract(
        "dm_user_food_rating_rank",
        "user_id BIGINT, food_name STRING, food_score DOUBLE, rank_order INT, score_type STRING",
        "user_id score_type rank_order",
        {"score_type": SCORE_TYPES},
    ),
    _contract("dm_user_category_stats", "user_id BIGINT, category STRING, count BIGINT", "user_id category"),
    _contract("dm_user_tag_stats", "user_id BIGINT, tag STRING, count BIGINT", "user_id tag"),
    _contract(
        "dm_user_group_comparison",
        "user_id BIGINT, group_type STRING, group_value STRING, user_avg_score DOUBLE, group_avg_score DOUBLE, "
        "user_diversity_score BIGINT, group_diversity_score BIGINT",
        "user_id group_type",
        {"group_type": GROUP_TYPES},
    ),
    _contract("dm_user_review_word", "user_id BIGINT, word STRING, count BIGINT", "user_id word"),
    _contract("dm_user_insight", "user_id BIGINT, insight STRING", "user_id"),
    _contract(
        "dm_monthly_food_ranking",
        "month STRING, food_id BIGINT, food_name STRING, avg_score DECIMAL(3,2), rank_type STRING, rank INT, count BIGINT",
        "month rank_type rank",
        {"rank_type": SCORE_TYPES},
    ),
    _contract("dm_monthly_count", "month STRING, evaluator BIGINT, cumulative BIGINT, difference BIGINT", "month"),
    _contract(
        "dm_monthly_statistic",
        "month STRING, min INT, max INT, avg DECIMAL(3,2), q1 INT, q3 INT, variance DECIMAL(3,2), stdev DECIMAL(3,2)",
        "month",
    ),
    _contract(
        "dm_monthly_frequent_evaluator",
        "month STRING, rank BIGINT, name STRING, evaluates BIGINT, last_evaluate TIMESTAMP_NTZ",
        "month rank",
    ),
    _contract(
        "dm_class_engagement_monthly",
        "month DATE, class STRING, generation STRING, review_count BIGINT",
        "month class generation",
    ),
    # What a periodic run reads in place of the whole history.
    _contract("monthly_count_state", "start DATE, evaluator BIGINT, cumulative BIGINT, difference BIGINT", "start", partition_by="start"),
    _contract(
        "user_food_state",
        "bucket INT, user_id BIGINT, food_id BIGINT, total DOUBLE, n BIGINT, as_of DATE",
        "bucket user_id food_id",
        partition_by="bucket",
    ),
    _contract(
        "user_rank_state",
        "bucket INT, user_id BIGINT, food_id BIGINT, food_score DOUBLE, rank_order INT, score_type STRING",
        "bucket user_id score_type rank_order",
        {"score_type": SCORE_TYPES},
        partition_by="bucket",
    ),
    # Rows of users that changed since they were last folded into the two tables above.
    _contract(
        "user_food_recent",
        "bucket INT, user_id BIGINT, food_id BIGINT, total DOUBLE, n BIGINT, as_of DATE",
        "bucket user_id food_id",
        partition_by="bucket",
    ),
    _contract(
        "user_rank_recent",
        "bucket INT, user_id BIGINT, food_id BIGINT, food_score DOUBLE, rank_order INT, score_type STRING",
        "bucket user_id score_type rank_order",
        {"score_type": SCORE_TYPES},
        partition_by="bucket",
    ),
    _contract("score_sketch_day", "start DATE, day DATE, sketch BINARY", "start day", partition_by="start"),
    _contract("fm_dictionary", "idx BIGINT, block STRING, number BIGINT, value STRING, feature STRING", "block number value"),
    _contract("load_ledger", "load_id STRING, n_rows BIGINT, row_hashes DECIMAL(38,0)", "load_id", partition_by="load_id"),
]

CONTRACTS: dict[str, Contract] = {c.name: c for c in _ALL}
SOURCE_TABLES = ("account", "food", "menu", "menu_food", "food_review", "menu_review", "pre_vote")


def contract(name: str) -> Contract:
    """Contract of a table; loading into any other name is refused."""
    try:
        return CONTRACTS[name]
    except KeyError:
        raise ValueError(f"unknown table: {name}") from None

"""Named queries over one data folder: every job on its whole input tables.

Keys that end in ``_month`` or ``_day`` show the same job with the report's date argument.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mealmarts.functions.columns import in_month
from mealmarts.operators import fingerprints, loads, metrics, quality
from mealmarts.operators.ranking import greatest_row
from mealmarts.plans import (
    choice,
    insights,
    models,
    month_chain,
    monthly_marts,
    rank_state,
    score_sketches,
    sparse_rows,
    user_marts,
    warehouse,
)
from mealmarts.plans.review_words import review_words
from mealmarts.schemas import CONTRACTS, MAIN_SUB_CODES, GENDERS, SOURCE_TABLES
from mealmarts.session import scratch_path, stage, tune
from mealmarts.sources import files
from mealmarts.sources.views import Sources
from mealmarts.streaming import messages

MONTH, DAY = "1997-05", "1997-05-12"
LOAD_SPLIT, BATCH_START = "1998-01-01", "1997-07-01"
LATE_REGION = "NATION_7"
CHAIN_START, LATE_MONTH = "2001-04", "2001-05"
CHANGED_MONTH, LOST_USERS, TWICE = "2001-03", 50, 500
HOLDOUT = 0.2
RECENT_DAYS, TOPIC_PARTITIONS = 30, 4
LOAD_DAYS, INSIGHT_SPLIT = 3, "2024-01-16"
_RATINGS, _ARRIVAL = "fact_user_food_feedback", ("id", "food_score")
PROPS_SCHEMA = T.StructType().add("k", T.IntegerType())

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


class Tables(Sources):
    """Source tables plus the warehouse tables built from them.

    ``stored`` writes a table several branches of a query read to the shared folder first,
    as the daily load would have done.
    """

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root)
        self._stored: dict[str, DataFrame] = {}

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._stored:
            self._stored[name] = stage(build(), name)
        return self._stored[name]

    def ratings(self, day=None):
        return warehouse.food_feedback(self.food_review, day)

    def menu_feedback(self, day=None):
        return warehouse.menu_feedback(self.menu_review, self.pre_vote, day)

    def dishes(self):
        return warehouse.dim_menu_food(self.menu_food, self.food, self.menu)

    def stored_dishes(self):
        """Dishes on menus with what the menu choice and the code sets read of them."""
        return self.stored("dishes", lambda: self.dishes().drop("food_name"))

    def attributes(self):
        return warehouse.food_attributes(self.dishes())

    def users(self):
        return warehouse.dim_user(self.account)

    def insight_context(self):
        return insights.context_from_facts(self.stored("ratings", self.ratings), self.attributes(), self.users())

    def comparison(self, menu_food=None, day=None):
        menu_food = self.menu_food if menu_food is None else menu_food
        features = choice.menu_features(menu_food, choice.food_features(self.food, self.food_review))
        return choice.menu_comparison(self.menu_review, self.menu, self.account, features, day)

    def training_rows(self, day=None):
        return choice.ab_training_rows(
            self.ratings(), self.menu_feedback(), self.stored_dishes(), self.users(), day
        )

    def fm_inputs(self):
        """Comparison rows without the dish lists, and the menus' tag counts."""
        menu_food = self.stored("menu_food", lambda: self.menu_food)
        comparison = self.stored("comparison", lambda: self.comparison(menu_food))
        vectors = self.stored("tag-vectors", lambda: sparse_rows.tag_vectors(menu_food, self.food))
        return comparison, vectors

    def dictionary(self):
        return self.stored("dictionary", lambda: sparse_rows.feature_dictionary(*self.fm_inputs()))

    def encoded(self):
        """Comparison rows with the entries of their users and dates."""
        comparison, vectors = self.fm_inputs()
        return (comparison, *sparse_rows.entries(comparison, vectors, self.dictionary()))

    def fm_predictions(self):
        """Scores of all comparison rows, by a model fitted on all of them."""
        encoded, size = self.encoded(), self.dictionary().count()
        rows = models.packed_rows(sparse_rows.sparse_rows(*encoded), size)
        return models.predict_fm(models.train_fm(rows, size), rows, size)

    def rating_batch(self):
        """Ratings as they arrive later, with changed scores and repeated keys."""
        start = F.lit(BATCH_START).cast("timestamp_ntz")
        return self.food_review.filter(F.col("timestamp") >= start).select(
            "id", "user_id", "food_id", (F.lit(5.5) - F.col("food_score")).alias("food_score"),
            F.to_date("timestamp").alias("rating_date"),
        )

    def stored_ratings(self):
        """A warehouse with the ratings before ``LOAD_SPLIT``, in date partitions."""
        root = scratch_path(self.spark, "warehouse")
        loads.store(self.ratings().filter(F.col("rating_date") < F.lit(LOAD_SPLIT).cast("date")), root, _RATINGS)
        return root

    def load_sides(self, batch_start):
        """Stored rows and an incoming batch of menu reviews with changed scores."""
        reviews = self.menu_review
        split, start = (F.lit(d).cast("timestamp_ntz") for d in (LOAD_SPLIT, batch_start))
        batch = reviews.filter(F.col("timestamp") >= start).withColumn("menu_score", F.lit(5.5) - F.col("menu_score"))
        return reviews.filter(F.col("timestamp") < split), batch


def query(function: Callable[[Tables], DataFrame]):
    """Register a job under its function name."""
    name = function.__name__.lstrip("_")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return function(Tables(spark, sf_dir))

    _QUERIES[name] = run
    return function


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Means of means depend on the order of addition in their last digits."""
    return df.withColumns({c: F.round(c, 9) for c in columns})


def _as_text(column: str):
    return F.array_join(F.col(column), ",").alias(column)


# --- warehouse ---------------------------------------------------------------------------


@query
def dim_user(t):
    return t.users()


@query
def dim_menu_food(t):
    return t.dishes()


@query
def fact_food_feedback(t):
    return t.ratings()


@query
def fact_food_feedback_day(t):
    return t.ratings(DAY)


@query
def fact_menu_feedback(t):
    return t.menu_feedback()


@query
def fact_menu_feedback_day(t):
    return t.menu_feedback(DAY)


@query
def food_attributes(t):
    return t.attributes().drop("menus")


@query
def rated_users(t):
    return warehouse.rated_users(t.ratings())


# --- loading -----------------------------------------------------------------------------


@query
def load_append(t):
    target, batch = t.load_sides(LOAD_SPLIT)
    return loads.load_append(target, batch, ["id"])


@query
def load_ignore(t):
    target, batch = t.load_sides(BATCH_START)
    return loads.load_ignore(target, batch, ["id"])


@query
def load_upsert(t):
    target, batch = t.load_sides(BATCH_START)
    return loads.load_upsert(target, batch, ["id"])


@query
def store_append(t):
    root = t.stored_ratings()
    loads.store(t.ratings().filter(F.col("rating_date") >= F.lit(LOAD_SPLIT).cast("date")), root, _RATINGS)
    return loads.read_table(t.spark, root, _RATINGS)


@query
def store_ignore(t):
    root = t.stored_ratings()
    loads.store(t.rating_batch(), root, _RATINGS, "ignore", _ARRIVAL)
    return loads.read_table(t.spark, root, _RATINGS)


@query
def store_upsert(t):
    root = t.stored_ratings()
    loads.store(t.rating_batch(), root, _RATINGS, "overwrite", _ARRIVAL)
    return loads.read_table(t.spark, root, _RATINGS)


@query
def mart_overwrite_roundtrip(t):
    """Marts written for the ratings of a month, then anew for all: only the second version is there."""
    root = scratch_path(t.spark, "marts")
    attributes = t.attributes()
    for ratings in (warehouse.food_feedback(in_month(t.food_review, "timestamp", MONTH)), t.ratings()):
        loads.replace_table(user_marts.user_category_stats(ratings, attributes), root, "dm_user_category_stats")
        loads.replace_table(user_marts.user_tag_stats(ratings, attributes), root, "dm_user_tag_stats")
    out = None
    for table, value in (("dm_user_category_stats", "category"), ("dm_user_tag_stats", "tag")):
        rows = loads.read_table(t.spark, root, table).select(
            F.lit(table).alias("table_name"), "user_id", F.col(value).alias("value"), "count"
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def bulk_copy(t):
    target = scratch_path(t.spark, "copy")
    counts = None
    for table in files.bulk_copy(t.spark, t.root, target):
        rows = t.spark.read.parquet(f"{target}/{table}.parquet")
        one = rows.agg(F.count("*").alias("row_count")).select(
            F.lit(table).alias("table_name"), F.lit(len(rows.columns)).cast("bigint").alias("column_count"), "row_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query
def bulk_copy_fingerprints(t):
    """Per column of every copied table its fingerprint, and whether source and copy hold the same rows."""
    target, out = scratch_path(t.spark, "copy"), None
    for table in files.bulk_copy(t.spark, t.root, target):
        copy = t.spark.read.parquet(f"{target}/{table}.parquet")
        same = fingerprints.same_rows(t.base(table), copy).withColumn("table_name", F.lit(table))  # a row
        one = fingerprints.column_fingerprints(copy, table).join(same, "table_name")
        out = one if out is None else out.unionByName(one)
    return out


@query
def bulk_copy_changes(t):
    """Reviews against a copy in which scores of one month are changed, those of some users lost, and some come twice."""
    reviews = t.menu_review
    in_may = in_month(reviews, "timestamp", CHANGED_MONTH).select("id").withColumn("hit", F.lit(True))
    copy = reviews.join(in_may, "id", "left").filter(F.col("user_id") % LOST_USERS != 0)
    copy = copy.withColumn("menu_score", F.when(F.col("hit"), F.lit(None)).otherwise(F.col("menu_score"))).drop("hit")
    copy = copy.unionByName(copy.filter(F.col("id") % TWICE == 0))
    return fingerprints.differing_keys(reviews, copy, ["id"]).withColumn("columns", _as_text("columns"))


@query
def training_csv_roundtrip(t):
    path = scratch_path(t.spark, "training-csv")
    files.export_csv(t.training_rows(), path)
    return _rounded(files.read_csv(t.spark, path, "xgb_train_data"), *_AFFINITIES, *_RATIOS)


@query
def json_sink_roundtrip(t):
    path = scratch_path(t.spark, "messages-json")
    files.write_json(messages.parse_json(t.messages, PROPS_SCHEMA, keep=("key",)), path)
    return files.read_json(t.spark, path, "key STRING, k INT")


@query
def empty_table_contracts(t):
    """Empty tables made from the contracts, filled with the source rows and reported on."""
    filled = {name: getattr(t, name) for name in SOURCE_TABLES}
    filled |= {
        "dim_user": t.users(),
        "dim_menu_food_combined": t.dishes(),
        "fact_user_food_feedback": t.ratings(),
        "fact_user_menu_feedback": t.menu_feedback(),
    }
    reports = [quality.contract_report(df, CONTRACTS[name]) for name, df in filled.items()]
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


# --- quality -----------------------------------------------------------------------------


@query
def key_violations(t):
    """Repeated keys in the ratings as they come, before the load resolves them."""
    raw = t.food_review.withColumn("rating_date", F.to_date("timestamp"))
    votes = t.menu_review.withColumn("comment_date", F.to_date("timestamp"))
    return quality.key_violations(raw, CONTRACTS["fact_user_food_feedback"]).unionByName(
        quality.key_violations(votes, CONTRACTS["fact_user_menu_feedback"])
    )


@query
def domain_violations(t):
    """Codes outside their set: as delivered, and none once they are in the dimensions."""
    raw = quality.domain_violations(t.account, "account", "gender", GENDERS).unionByName(
        quality.domain_violations(t.food, "food", "main_sub", MAIN_SUB_CODES)
    )
    loaded = {"dim_user": t.users(), "dim_menu_food_combined": t.stored_dishes(), "xgb_train_data": t.training_rows()}
    for name, rows in loaded.items():
        raw = raw.unionByName(quality.domain_report(rows, CONTRACTS[name]))
    return raw


@query
def orphan_rows(t):
    """Facts of users a dimension load has missed: those of the region that came late."""
    loaded = t.users().filter(F.col("ssafy_region") != LATE_REGION)
    facts = {
        "fact_user_food_feedback": t.ratings(),
        "fact_user_menu_feedback": t.menu_feedback(),
        "raw_user_review_word": review_words(t.review_comment),
    }
    out = None
    for name, rows in facts.items():
        report = quality.reference_report(rows, CONTRACTS[name], {"dim_user": loaded})
        out = report if out is None else out.unionByName(report)
    return out


@query
def ab_gate(t):
    return choice.ab_gate(choice.dish_menus(t.dishes()))


# --- daily marts -------------------------------------------------------------------------


@query
def user_summary(t):
    return user_marts.user_summary(t.ratings(), t.menu_feedback())


@query
def user_food_rating_rank(t):
    return user_marts.user_food_rating_rank(t.ratings(), t.attributes())


@query
def user_rank_incremental(t):
    """All ratings but those of the last days, then those days one by one, the last but one behind the last."""
    root, ratings = scratch_path(t.spark, "ranks"), t.stored("ratings", t.ratings)
    newest = ratings.select("rating_date").distinct().orderBy(F.col("rating_date").desc()).limit(LOAD_DAYS).collect()
    days = sorted(r.rating_date.isoformat() for r in newest)

    def of(condition):
        return ratings.filter(condition)

    date = F.col("rating_date")
    rank_state.start_ranks(of(date < F.lit(days[0]).cast("date")), root, "1970-01-01")
    arrived = []
    for day in [*days[:-2], *days[:-3:-1]]:
        arrived.append(day)
        known = (date < F.lit(days[0]).cast("date")) | date.cast("string").isin(arrived)
        rank_state.add_day(of(date == F.lit(day).cast("date")), root, day, of(known))
    return rank_state.stored_ranks(t.spark, root, t.attributes())


@query
def user_category_stats(t):
    return user_marts.user_category_stats(t.ratings(), t.attributes())


@query
def user_tag_stats(t):
    return user_marts.user_tag_stats(t.ratings(), t.attributes())


@query
def group_stats(t):
    return user_marts.group_stats(t.ratings(), t.attributes(), t.users())


@query
def user_group_comparison(t):
    return user_marts.user_group_comparison(t.ratings(), t.attributes(), t.users())


@query
def recent_reviews(t):
    return user_marts.recent_reviews(t.menu_review, RECENT_DAYS)


@query
def user_review_word(t):
    return user_marts.user_review_word(review_words(t.review_comment))


@query
def insight_append(t):
    """Insights in two dated loads, the second sent twice. The newest insight of a user and date is the row to store."""
    root = scratch_path(t.spark, "insights")
    rows = greatest_row(t.raw_insight, ["user_id", "insight_date"], ["event_id", "insight"])
    early = F.col("insight_date") < F.lit(INSIGHT_SPLIT).cast("date")
    for load_id, batch in (("first", early), ("second", ~early), ("second", ~early)):
        loads.append_once(rows.filter(batch), root, "raw_user_insight", load_id)
    return loads.read_loads(t.spark, root, "raw_user_insight")


@query
def user_insight_latest(t):
    return user_marts.user_insight_latest(t.raw_insight, tie="event_id")


# --- monthly marts -----------------------------------------------------------------------


@query
def monthly_food_ranking(t):
    return monthly_marts.monthly_food_ranking(t.food_review, t.food)


@query
def monthly_food_ranking_month(t):
    return monthly_marts.monthly_food_ranking(t.food_review, t.food, MONTH)


@query
def monthly_count(t):
    return monthly_marts.monthly_count(t.menu_review, t.pre_vote, t.menu, MONTH)


@query
def monthly_count_series(t):
    return monthly_marts.monthly_count_series(t.menu_review, t.pre_vote, t.menu)


@query
def cumulative_distinct_evaluators(t):
    return monthly_marts.cumulative_distinct_evaluators(t.menu_review, t.pre_vote)


@query
def running_distinct_evaluators(t):
    return monthly_marts.running_distinct_evaluators(t.menu_review, t.pre_vote, t.menu)


@query
def monthly_count_chained(t):
    """Months from ``CHAIN_START`` on come one by one; half the reviews of ``LATE_MONTH`` come after the month behind it."""
    root, votes, menu = scratch_path(t.spark, "chain"), t.pre_vote, t.menu
    month_chain.start_chain(t.menu_review, votes, menu, root, CHAIN_START)
    known = monthly_marts.report_months(t.menu_review).filter(F.col("month") >= CHAIN_START)
    months = sorted(r.month for r in known.select("month").collect())  # the months a scheduler would have run
    for month in months:
        reviews = t.menu_review.filter("id % 2 = 0") if month == LATE_MONTH else t.menu_review
        month_chain.extend_chain(reviews, votes, menu, root, month)
        if month == max(months[:3]):
            month_chain.extend_chain(t.menu_review, votes, menu, root, LATE_MONTH)
    return month_chain.stored_months(t.spark, root)


@query
def monthly_quartiles_merged(t):
    """Sketches of all days up to ``LOAD_SPLIT``, then of the rest, merged to months and held against the scores."""
    root, split = scratch_path(t.spark, "sketches"), F.lit(LOAD_SPLIT).cast("timestamp_ntz")
    score_sketches.store_sketches(t.food_review.filter(F.col("timestamp") < split), root)
    score_sketches.store_sketches(t.food_review.filter(F.col("timestamp") >= split), root)
    return score_sketches.within_error(score_sketches.stored_quartiles(t.spark, root), t.food_review)


@query
def monthly_statistic(t):
    return monthly_marts.monthly_statistic(t.food_review)


@query
def monthly_statistic_month(t):
    return monthly_marts.monthly_statistic(t.food_review, MONTH)


@query
def monthly_frequent_evaluator(t):
    return monthly_marts.monthly_frequent_evaluator(t.food_review, t.pre_vote, t.menu, t.account)


@query
def monthly_frequent_evaluator_month(t):
    return monthly_marts.monthly_frequent_evaluator(t.food_review, t.pre_vote, t.menu, t.account, MONTH)


@query
def class_engagement_monthly(t):
    return monthly_marts.class_engagement_monthly(t.menu_review, t.account)


@query
def previous_month(t):
    return monthly_marts.report_months(t.menu_review)


# --- menu choice -------------------------------------------------------------------------

_AFFINITIES = [f"{s}_avg_score_on_{k}" for k in ("tags", "categories") for s in ("A", "B")]
_RATIOS = [f"{s}_{k}_ratio" for k in ("tag", "category") for s in ("A", "B")]


@query
def menu_pairs(t):
    return choice.menu_pairs(t.menu)


@query
def food_features(t):
    return choice.food_features(t.food, t.food_review)


@query
def menu_features(t):
    rows = choice.menu_features(t.menu_food, choice.food_features(t.food, t.food_review))
    return _rounded(rows, "avg_food_score").withColumn("food_ids", _as_text("food_ids"))


@query
def menu_comparison(t):
    return _rounded(t.comparison(), "avg_food_score_a", "avg_food_score_b")


@query
def menu_comparison_day(t):
    return _rounded(t.comparison(day=DAY), "avg_food_score_a", "avg_food_score_b")


@query
def menu_pairs_day(t):
    return choice.menu_pairs(t.menu, DAY)


@query
def menu_dishes(t):
    return choice.menu_dishes(t.menu_food, choice.food_features(t.food, t.food_review))


@query
def ab_user_preferences(t):
    rows = choice.user_preferences(choice.taste_profiles(t.ratings(), t.dishes()))
    return rows.select("user_id", _as_text("user_tags"), _as_text("user_cats"))


@query
def ab_overlap_features(t):
    return _rounded(choice.ab_overlap_features(t.ratings(), t.menu_feedback(), t.stored_dishes()), *_RATIOS)


@query
def ab_affinity_scores(t):
    return _rounded(choice.ab_affinity_scores(t.ratings(), t.menu_feedback(), t.stored_dishes()), *_AFFINITIES)


@query
def ab_labels(t):
    return choice.choice_labels(t.menu_feedback(), choice.menu_pairs(choice.dish_menus(t.dishes())))


@query
def ab_training_rows(t):
    return _rounded(t.training_rows(), *_AFFINITIES, *_RATIOS)


@query
def ab_training_rows_day(t):
    return _rounded(t.training_rows(DAY), *_AFFINITIES, *_RATIOS)


# --- feature export and models -----------------------------------------------------------


@query
def fm_feature_dictionary(t):
    return sparse_rows.feature_dictionary(*t.fm_inputs()).select("idx", "block", "feature")


@query
def fm_sparse_rows(t):
    return _rounded(sparse_rows.long_rows(sparse_rows.sparse_rows(*t.encoded())), "value")


@query
def fm_libfm_lines(t):
    """Lines written to text files and read back, as the trainer would find them."""
    path = scratch_path(t.spark, "libfm")
    files.write_lines(sparse_rows.libfm_lines(*t.encoded()), path, compression="gzip")
    return t.spark.read.text(path).withColumnRenamed("value", "line")


@query
def fm_dictionary_append(t):
    """The dictionary of the comparison rows before ``LOAD_SPLIT``, extended by those of all, sent twice."""
    root = scratch_path(t.spark, "dictionary")
    comparison, vectors = t.fm_inputs()
    early = comparison.filter(F.col("date") < F.lit(LOAD_SPLIT).cast("date"))
    for batch in (early, comparison, comparison):
        out = sparse_rows.extend_dictionary(batch, vectors, root)
    return out.select("idx", "block", "feature")


@query
def json_feature_columns(t):
    events = t.base("events")
    return sparse_rows.json_features(events, "event_id", "props")


@query
def json_object_columns(t):
    return sparse_rows.json_feature_columns(t.base("events").select("event_id", "props"), "props", ["k"]).drop("props")


def _checked(predictions, *keys):
    """Keys, label, and what holds for any model: scores are shares, and classes follow from them."""
    score = F.col("score")
    return predictions.select(
        *keys, "label", score.between(0, 1).alias("score_is_share"),
        (F.col("predicted") == F.when(score >= 0.5, 1).otherwise(0)).alias("class_follows_score"),
    )


def _recounted(predictions, measured, names):
    """Rows per label, and whether metrics equal a recount by groups of the same predictions."""
    predictions = stage(predictions, "predictions")
    groups = predictions.groupBy("label", "predicted").agg(
        F.count("*").alias("n"), F.sum(F.pow(F.col("score") - F.col("label"), 2)).alias("squares")
    )

    def n(condition):
        return F.coalesce(F.sum(F.when(F.expr(condition), F.col("n"))), F.lit(0))

    right, called, positive, total = n("label = predicted"), n("predicted = 1"), n("label = 1"), n("true")
    hits = n("label = 1 and predicted = 1")
    counted = groups.agg(
        total.alias("rows"), positive.alias("positive"),
        F.coalesce(F.try_divide(right, total), F.lit(0.0)).alias("accuracy"),
        F.coalesce(F.try_divide(hits, called), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(hits, positive), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2 * hits, called + positive), F.lit(0.0)).alias("f1_score"),
        F.sqrt(F.try_divide(F.sum("squares"), total)).alias("rmse"),
    )
    own = measured(predictions).select(F.lit(1).alias("one"), *[F.col(c).alias(f"_{c}") for c in names])
    same = [F.coalesce(F.abs(F.col(c) - F.col(f"_{c}")) < 1e-9, F.col(c).isNull() & F.col(f"_{c}").isNull()) for c in names]
    both = counted.withColumn("one", F.lit(1)).join(own, "one")  # a row each
    return both.select("rows", "positive", *[s.alias(f"{c}_agrees") for c, s in zip(names, same)])


@query
def fm_train_predict(t):
    return _checked(t.fm_predictions(), "review_id")


@query
def fm_train_metrics(t):
    return _recounted(t.fm_predictions(), models.fm_metrics, ("rmse", "precision", "recall"))


@query
def gbt_train_predict(t):
    rows = stage(t.training_rows(), "training-rows")
    return _checked(models.predict_gbt(models.train_gbt(rows), rows), "user_id", "train_date", "menu_id")


@query
def gbt_train_metrics(t):
    rows = stage(t.training_rows(), "training-rows")
    predictions = models.predict_gbt(models.train_gbt(rows), rows)
    return _recounted(predictions, models.gbt_metrics, ("accuracy", "precision", "recall", "f1_score"))


@query
def gbt_holdout_metrics(t):
    """Metrics on a fifth of the rows held out by a hash of their key, of a model of the others."""
    rows = stage(t.training_rows(), "training-rows")
    held = rows.filter(models.in_holdout(HOLDOUT))
    predictions = models.predict_gbt(models.train_gbt(rows, HOLDOUT), held)
    metrics_agree = _recounted(predictions, models.gbt_metrics, ("accuracy", "precision", "recall", "f1_score"))
    counts = rows.agg(F.count("*").alias("all_rows"), F.count_if(models.in_holdout(HOLDOUT)).alias("held")).withColumn("one", F.lit(1))
    share = (F.col("held") / F.col("all_rows")).between(HOLDOUT / 2, HOLDOUT * 2)
    return metrics_agree.withColumn("one", F.lit(1)).join(counts, "one").select(  # a row each
        "all_rows", share.alias("share_held"), (F.col("rows") == F.col("held")).alias("only_held"),
        *[f"{c}_agrees" for c in ("accuracy", "precision", "recall", "f1_score")],
    )


def _scored(t):
    """A fixed rule as the scorer: menu B's share of both menus' mean scores."""
    a, b = F.col("avg_food_score_a"), F.col("avg_food_score_b")
    return t.comparison().select("label", F.round(b / (a + b), 9).alias("score")).filter("score IS NOT NULL")


@query
def binary_metrics(t):
    return metrics.binary_metrics(_scored(t).withColumn("predicted", metrics.to_class("score")), "label", "predicted")


@query
def rmse_metric(t):
    return _rounded(metrics.rmse(_scored(t), "label", "score"), "rmse")


# --- text --------------------------------------------------------------------------------


@query
def _review_words(t):
    return review_words(t.review_comment)


@query
def review_words_text_dates(t):
    """Words of comments whose date comes as text, every seventh day of the month not readable."""
    day = F.when(F.day("comment_date") % 7 == 0, F.lit("some day")).otherwise(F.date_format("comment_date", "yyyy-MM-dd"))
    return review_words(t.review_comment.withColumn("comment_date", day))


@query
def insight_context(t):
    return t.insight_context()


@query
def insight_prompt(t):
    return insights.insight_prompt(t.insight_context())


# --- topics ------------------------------------------------------------------------------


@query
def json_messages(t):
    return messages.parse_json(t.messages, PROPS_SCHEMA, keep=("key",))


def _stream_to_files(t, stream, name):
    out = scratch_path(t.spark, name)
    messages.run_stream(stream, out, f"{out}-progress")
    return t.spark.read.schema("key STRING, value STRING").parquet(out)


@query
def stream_messages(t):
    """The events file as a stream of topic rows, echoed as text."""
    events = messages.stream_topic(
        t.spark, t.root, "parquet", t.base("events").schema, pathGlobFilter="events.parquet"
    )
    rows = events.select(F.col("event_id").cast("string").cast("binary").alias("key"), F.col("props").cast("binary").alias("value"))
    return _stream_to_files(t, messages.as_text(rows), "stream")


@query
def publish_messages(t):
    """All messages sent to a topic, then consumed from it as a stream."""
    topic = scratch_path(t.spark, "topic")
    messages.publish(t.messages, topic, "parquet")
    return _stream_to_files(t, messages.as_text(messages.stream_topic(t.spark, topic, "parquet")), "echo")


@query
def stream_exactly_once(t):
    """All messages with their places stored by a stream, then again without its checkpoint."""
    events = messages.stream_topic(t.spark, t.root, "parquet", t.base("events").schema, pathGlobFilter="events.parquet")
    placed = events.select(
        F.pmod("event_id", F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        F.col("event_id").cast("string").cast("binary").alias("key"), F.col("props").cast("binary").alias("value"),
    )
    out = scratch_path(t.spark, "messages")
    for attempt in ("first", "lost-checkpoint"):
        messages.run_stream_once(placed, out, f"{out}-{attempt}")
    return messages.as_text(messages.read_placed(t.spark, out))


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)

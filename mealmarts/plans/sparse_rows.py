"""Sparse rows for a factorization machine: feature dictionary, encoded rows, text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mealmarts.functions.columns import number_text
from mealmarts.operators.loads import read_table, store
from mealmarts.operators.ranking import number_rows
from mealmarts.session import stage

# Order of the feature blocks. Within a block, features are ordered by value.
USER_BLOCK = "user_id"
USER_BLOCKS = ("gender", "region", "class_num")
TAG_BLOCKS = {"a": "tag_a", "b": "tag_b"}
SCORE_BLOCKS = {"a": "avg_food_score_a", "b": "avg_food_score_b"}
BLOCKS = (USER_BLOCK, *USER_BLOCKS, *TAG_BLOCKS.values(), *SCORE_BLOCKS.values())


def tag_vectors(menu_food: DataFrame, food: DataFrame) -> DataFrame:
    """Dishes per menu and tag."""
    return (
        menu_food.join(food.select("food_id", "tag"), "food_id")
        .filter(F.col("tag").isNotNull())
        .groupBy("menu_id", "tag")
        .agg(F.count("*").alias("dishes"))
    )


def _offers(comparison: DataFrame) -> DataFrame:
    return comparison.select("date", "menu_id_a", "menu_id_b", *SCORE_BLOCKS.values()).dropDuplicates(["date"])


def _exploded(df: DataFrame, keep: list[str], **structs) -> DataFrame:
    """One row per block; ``structs`` give the block's columns."""
    entries = [F.struct(F.lit(block).alias("block"), *columns) for block, columns in structs.items()]
    return df.select(*keep, F.explode(F.array(*entries)).alias("e")).select(*keep, "e.*")


def _offer_features(comparison: DataFrame, vectors: DataFrame) -> DataFrame:
    """``date, block, value, x``: tag counts of both menus and their mean scores, per date."""
    offers = _offers(comparison)
    menus = {block: [F.col(f"menu_id_{side}").alias("menu_id")] for side, block in TAG_BLOCKS.items()}
    scores = {block: [F.lit("").alias("value"), F.col(block).alias("x")] for block in SCORE_BLOCKS.values()}
    tags = _exploded(offers, ["date"], **menus).join(vectors, "menu_id")
    return tags.select("date", "block", F.col("tag").alias("value"), F.col("dishes").cast("double").alias("x")).unionByName(
        _exploded(offers, ["date"], **scores)
    )


def _block_position(block: Column) -> Column:
    return F.array_position(F.array(*[F.lit(b) for b in BLOCKS]), block)


_FEATURE = ["block", "number", "value"]


def features(comparison: DataFrame, vectors: DataFrame) -> DataFrame:
    """``block, number, value`` of every feature that occurs. User ids are numbers, everything else is text."""
    users = comparison.select("user_id", *USER_BLOCKS).distinct()
    ids = users.select(F.lit(USER_BLOCK).alias("block"), F.col("user_id").alias("number"), F.lit("").alias("value"))
    codes = _exploded(users, [], **{b: [F.col(b).cast("string").alias("value")] for b in USER_BLOCKS})
    offers = _offer_features(comparison, vectors).select("block", "value")
    return (
        ids.unionByName(codes.unionByName(offers).withColumn("number", F.lit(0).cast("bigint")))
        .filter(F.col("value").isNotNull())
        .distinct()
    )


def _numbered(found: DataFrame, start: int) -> DataFrame:
    placed = found.withColumn("position", _block_position(F.col("block")))
    numbered = number_rows(placed, [F.col("position"), F.col("number"), F.col("value")], "idx", start=start)
    feature = (
        F.when(F.col("block") == USER_BLOCK, F.concat_ws("=", "block", F.col("number").cast("string")))
        .when(F.col("block").isin(*SCORE_BLOCKS.values()), F.col("block"))
        .when(F.col("block").isin(*TAG_BLOCKS.values()), F.concat_ws("_", "block", "value"))
        .otherwise(F.concat_ws("=", "block", "value"))
    )
    return numbered.select("idx", *_FEATURE, feature.alias("feature"))


def feature_dictionary(comparison: DataFrame, vectors: DataFrame) -> DataFrame:
    """``idx, block, number, value, feature`` of every feature that occurs, 0-based without gaps.

    User ids sort as numbers, everything else as text. The numbering is spread over tasks,
    as the dictionary has an entry per user.
    """
    return _numbered(features(comparison, vectors), 0)


def extend_dictionary(comparison: DataFrame, vectors: DataFrame, root: str) -> DataFrame:
    """The stored dictionary with this batch's new features appended, numbered from the largest stored index on.

    Stored indexes never change, so a model and the lines of any later day agree. New features have the order of
    ``feature_dictionary`` among themselves. A batch that comes again finds all its features and adds none.
    """
    spark = comparison.sparkSession
    stored = read_table(spark, root, "fm_dictionary")
    fresh = features(comparison, vectors).join(stored.select(*_FEATURE), _FEATURE, "left_anti")
    start = stored.agg(F.coalesce(F.max("idx") + 1, F.lit(0))).first()[0]
    store(_numbered(fresh, start), root, "fm_dictionary")
    return read_table(spark, root, "fm_dictionary")


def entries(comparison: DataFrame, vectors: DataFrame, dictionary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sorted (idx, value) entries per user and per date.

    Indexes are looked up once per user and once per date, never per review: a code such as
    a gender is on so many reviews that a join on it would be one task's work. The codes
    are staged, so Spark knows their size and broadcasts them as long as they are small, and
    so are the results, as a user or a date may have very many reviews to join.
    Indicators are 1, tag counts and mean scores keep their value. Nulls, zeros and what the dictionary lacks are left out.
    """
    codes = stage(dictionary.filter(F.col("block") != USER_BLOCK).select("block", "value", "idx"), "feature-codes")
    ids = dictionary.filter(F.col("block") == USER_BLOCK).select(F.col("number").alias("user_id"), F.col("idx").alias("_user"))
    people = comparison.select("user_id", *USER_BLOCKS).distinct().join(ids, "user_id", "left")
    for block in USER_BLOCKS:
        code = codes.filter(F.col("block") == block).select(F.col("value").alias(block), F.col("idx").alias(f"_{block}"))
        people = people.join(code, block, "left")
    marks = [
        F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("idx"), F.lit(1.0).alias("value")))
        for c in ("_user", *[f"_{b}" for b in USER_BLOCKS])
    ]
    people = people.select("user_id", F.filter(F.array(*marks), lambda e: e.isNotNull()).alias("user_entries"))
    # A date has an entry per tag on its two menus and per mean score.
    offers = (
        _offer_features(comparison, vectors)
        .filter("x <> 0")
        .join(codes, ["block", "value"])
        .groupBy("date")
        .agg(F.sort_array(F.collect_list(F.struct("idx", F.col("x").alias("value")))).alias("offer_entries"))
    )
    return stage(people, "user-entries"), stage(offers, "offer-entries")


def _with_entries(comparison: DataFrame, people: DataFrame, offers: DataFrame) -> DataFrame:
    rows = comparison.select("review_id", "user_id", "date", "label")
    return rows.join(people, "user_id").join(offers, "date", "left")


def sparse_rows(comparison: DataFrame, people: DataFrame, offers: DataFrame) -> DataFrame:
    """``review_id, user_id, date, label, features``, features by index: an appended dictionary mixes the blocks."""
    none = F.array().cast("array<struct<idx:bigint,value:double>>")
    both = F.sort_array(F.concat("user_entries", F.coalesce("offer_entries", none)))
    return _with_entries(comparison, people, offers).select("review_id", "user_id", "date", "label", both.alias("features"))


def long_rows(rows: DataFrame) -> DataFrame:
    """One row per review and feature."""
    return rows.select("review_id", F.explode("features").alias("f")).select("review_id", "f.idx", "f.value")


def _entry_text(column: str) -> Column:
    pairs = F.transform(column, lambda e: F.concat_ws(":", e["idx"].cast("string"), number_text(e["value"])))
    return F.nullif(F.array_join(pairs, " "), F.lit(""))


def libfm_lines(comparison: DataFrame, people: DataFrame, offers: DataFrame) -> DataFrame:
    """``label idx:value ...`` per review; the text is made once per user and per date."""
    rows = _with_entries(
        comparison,
        people.select("user_id", _entry_text("user_entries").alias("user_text")),
        offers.select("date", _entry_text("offer_entries").alias("offer_text")),
    )
    return rows.select("review_id", F.concat_ws(" ", F.col("label").cast("string"), "user_text", "offer_text").alias("line"))


def _number(value: Column) -> Column:
    """A number, also one that is written as text; null for anything else."""
    return F.when(F.schema_of_variant(value) != "BOOLEAN", F.try_variant_get(value, "$", "double"))


def json_features(df: DataFrame, id_column: str, json_column: str) -> DataFrame:
    """Numbers of a JSON object column as (id, name, value) rows; names inside objects follow a dot.

    The text is parsed once. Objects are opened level by level until none is left, however deep; what is nested is staged, so
    a further level costs in proportion to what lies there. Lists, words, truth values and nulls give no
    row, and cost no other value. A text that is no object, or that has a name twice in one object, gives no rows.
    """
    objects = df.select(F.col(id_column), F.lit(None).cast("string").alias("_name"), F.try_parse_json(json_column).alias("_value"))
    found = None
    while True:
        fields = objects.select(id_column, "_name", F.explode(F.try_variant_get("_value", "$", "map<string,variant>")).alias("_key", "_item"))
        named = fields.select(id_column, F.concat_ws(".", "_name", "_key").alias("_name"), F.col("_item").alias("_value"))
        is_object = F.schema_of_variant("_value").startswith("OBJECT")
        numbers = named.filter(~is_object).select(id_column, F.col("_name").alias("name"), _number(F.col("_value")).alias("value"))
        numbers = numbers.filter(F.col("value").isNotNull())
        found = numbers if found is None else found.unionByName(numbers)
        objects = stage(named.filter(is_object), "json-objects")
        if objects.isEmpty():
            return found


def _paths(name: str) -> list[str]:
    """Ways to read a dotted name: a dot may part two objects or belong to a name. Objects first."""
    head, *rest = name.split(".")
    groups = [[head]]
    for part in rest:
        groups = [g for old in groups for g in ([*old, part], [*old[:-1], f"{old[-1]}.{part}"])]
    if "'" in name:
        return ["$" + "".join(f'["{part}"]' for part in group) for group in groups]
    return ["$" + "".join(f"['{part}']" for part in group) for group in groups]


def json_feature_columns(df: DataFrame, json_column: str, names: list[str]) -> DataFrame:
    """Named numbers of a JSON object column as columns (``a.b`` inside objects, at any depth); what is missing is null."""
    parsed = F.try_parse_json(json_column)

    def read(name: str) -> Column:
        return F.coalesce(*[_number(F.try_variant_get(parsed, path, "variant")) for path in _paths(name)])

    return df.withColumns({name: read(name) for name in names})

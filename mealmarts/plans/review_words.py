"""Keywords of review comments, counted per user, word and day."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mealmarts.functions.columns import date_or_epoch
from mealmarts.functions.text import is_keyword, tokens


def review_words(comments: DataFrame, tokenizer: Callable[[Column], Column] = tokens) -> DataFrame:
    """Keyword counts over whole comments.

    ``tokenizer`` maps the text column to an array of words; a part-of-speech tagger plugs
    in here as a pandas UDF. Comments without text or date are left out; a date that cannot
    be read counts as 1970-01-01. Words are counted within each task before the shuffle, so
    neither a user nor a word with most of the comments gathers them in one task.
    """
    day = comments.schema["comment_date"].dataType.typeName()
    date = F.col("comment_date") if day == "date" else date_or_epoch("comment_date")
    return (
        comments.filter(F.col("menu_comment").isNotNull() & F.col("comment_date").isNotNull())
        .select("user_id", date.alias("comment_date"), F.explode(tokenizer(F.col("menu_comment"))).alias("word"))
        .filter(is_keyword(F.col("word")))
        .groupBy("user_id", "word", "comment_date")
        .agg(F.count("*").alias("count"))
    )

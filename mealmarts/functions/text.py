"""Tokens and keyword rules for review comments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that never count as keywords.
STOPWORDS = (
    "정말", "진짜", "너무", "매우", "그리고", "그냥", "또", "더", "더욱",
    "거", "것", "근데", "그건", "이건", "저건", "그게", "이게", "저게",
    "해서", "했는데", "했어요", "입니다", "있어요", "있는", "없는", "하기",
    "처럼", "같이", "때문", "하면서", "보다", "보다도", "까지",
    "맛", "밥", "음식", "요리", "식사", "메뉴", "이다", "있다",
)

TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def tokens(text: str | Column) -> Column:
    """Runs of letters and digits of the whole text, as an array."""
    return F.split(text, TOKEN_BREAK)


def is_keyword(word: Column) -> Column:
    return (F.length(word) > 1) & ~word.isin(*STOPWORDS)

"""Hit counts from captured pages of search engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Engine to (pattern of the count, encoding, address).
ENGINES = {
    "baidu": (r"找到相关结果约?([0-9,]+)个", "gbk", "http://www.baidu.com/s?wd=%s"),
    "google": (r"获得约 <b>([0-9,]+)</b> 条结果", "utf-8", "http://%s/search?q=%s"),
}
MISS = "未找到和您的关键词"


def hit_count(page: Column, engine: str) -> Column:
    """The number of hits that a page reports, 0 if none; a dictionary's page counts 0 or 1."""
    if engine == "baidu_dict":
        return F.when(page.rlike(MISS), F.lit(0)).otherwise(F.lit(1)).cast("bigint")
    if engine not in ENGINES:
        raise ValueError(f"unknown engine: {engine}")
    number = F.replace(F.regexp_extract(page, ENGINES[engine][0], 1), F.lit(","), F.lit(""))
    return F.coalesce(number.try_cast("bigint"), F.lit(0))


def query_url(word: Column, engine: str, host: str = "www.google.com") -> Column:
    pattern = ENGINES[engine][2]
    return F.format_string(pattern, *([F.lit(host)] if pattern.count("%s") == 2 else []), F.url_encode(word))

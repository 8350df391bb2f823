"""Page scrape -> posts with engagement, and listing clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.functions.columns import (absolute_url, first_int, leading_count, parse_money, regex_flag, renamed,
                                      url_authority, when_columns_exist)
from rillet.functions.rules import classify
from rillet.sources.html import bound, captures, element, plain_text

# The shape of a listing page; a page that looks different needs other patterns, not other code.
# A story is a marked row; its details stand in the table row after it.
STORY_BLOCKS = r"(?s)<tr\b[^>]*\bathing\b[^>]*>.*?(?=<tr\b[^>]*\bathing\b|\z)"
# Fields of the story row (attributes of the title link, up to and with its end), and of the details.
STORY_FIELDS = [r"""<tr\b[^>]*\bid=["'](?<id>[^"']*)["']""",
                r""".*?\btitleline\b[^>]*>\s*<a\b(?<attributes>[^>]*>)(?<title>.*?)</a>"""]
NEXT_ROW = r"^\s*<tr\b[^>]*>"
DETAILS = r"(?s)<td\b[^>]*\bsubtext\b[^>]*>(.*)</td>"
DETAIL_FIELDS = [".*?" + element("score", "score"), ".*?" + element("hnuser", "author"), ".*?" + element("age", "age"),
                 r".*<a\b[^>]*(?<last>>.*?)</a>"]
HREF = r"""\bhref=["']([^"']*)["']"""


def _story(block: Column) -> Column:
    """Fields of the story row and of the first table row after it, from the text of one story."""
    def fields(rows: Column) -> Column:
        # Every row but the text behind the last one is closed.
        closed = F.size(rows) - 1
        first = F.when(closed > 0, F.get(rows, F.lit(0))).otherwise(F.lit(""))
        after = F.filter(F.slice(rows, F.lit(2), F.greatest(closed - 1, F.lit(0))), lambda r: r.rlike(NEXT_ROW))
        details = F.regexp_extract(F.coalesce(F.get(after, F.lit(0)), F.lit("")), DETAILS, 1)
        return F.struct(captures(first, STORY_FIELDS, ["id", "attributes", "title"]).alias("head"), captures(details, DETAIL_FIELDS, ["score", "author", "age", "last"]).alias("details"))
    return bound(F.split(block, "</tr>"), fields)


def _content(group: Column) -> Column:
    """Text of a captured element; NULL where there is none."""
    return F.when(group != "", plain_text(F.substring(group, 2, 1 << 30)))


def scrape_posts(pages: DataFrame, html: str = "html", page_no: str = "page_no") -> DataFrame:
    """One row per story of every page. A story without a title link, without details,
    without any link in them, or with points that are no number is skipped.

    A page is cut into stories by one pattern, a story's fields are captured by one match of
    its row and one of its details; the rows of the generator carry them, so no later
    filter or column runs a pattern on markup again.
    """
    stories = F.transform(F.regexp_extract_all(html, F.lit(STORY_BLOCKS), 0), _story)
    found = pages.select(page_no, F.explode(stories).alias("_s")).select(page_no, "_s.*")
    # A field that was found holds at least the end of its tag.
    found = found.filter((F.col("head.attributes") != "") & (F.col("details.last") != ""))
    fields = found.select(
        page_no, F.col("head.id").alias("story_id"), plain_text(F.col("head.title")).alias("title"),
        F.regexp_extract("head.attributes", HREF, 1).alias("_href"), _content(F.col("details.score")).alias("_score"),
        F.coalesce(_content(F.col("details.author")), F.lit("unknown")).alias("author"),
        F.coalesce(_content(F.col("details.age")), F.lit("unknown")).alias("age"), _content(F.col("details.last")).alias("_last"))
    points = F.when(F.coalesce("_score", F.lit("")) == "", 0).otherwise(F.split("_score", r"[\s\xa0]+")[0].try_cast("int"))
    posts = fields.select(
        page_no, "story_id", "title", absolute_url("_href").alias("url"), points.alias("points"), "author", "age",
        leading_count("_last").alias("comments"), url_authority("_href").alias("source"))
    return posts.filter(F.col("points").isNotNull())


def popularity(score: str = "engagement_score") -> F.Column:
    s = F.col(score)
    return classify([(s >= 100, "viral"), (s >= 50, "popular"), (s >= 20, "moderate")], "new")


def engagement(posts: DataFrame) -> DataFrame:
    out = posts.withColumn("engagement_score", F.col("points") + F.col("comments"))
    return out.withColumns({"popularity": popularity(),
                            "is_external": regex_flag("url", "news.ycombinator.com", negate=True)})


def flow_posts(pages: DataFrame) -> DataFrame:
    return engagement(scrape_posts(pages))


LISTING_RENAME = {"Listing Id": "listing_id", "Resort Name": "name", "Price": "price", "Reviews": "total_reviews"}


def flow_listings(raw: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename by mapping, then parse the price and the review count, each only
    if its source column exists."""
    out = renamed(raw, mapping or LISTING_RENAME)
    out = when_columns_exist(out, ["price"], lambda d: d.withColumn("price_usd", parse_money("price")))
    return when_columns_exist(out, ["total_reviews"],
                              lambda d: d.withColumn("review_count", first_int("total_reviews")))

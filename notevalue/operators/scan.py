"""From web pages to ranked price gaps that are reported once."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from notevalue.functions import fixed, price, replies, text
from notevalue.operators.evaluate import Predictor
from notevalue.session import cut
from notevalue.sources.seen import listing_key, seen_keys, write_seen

# A reader adds `reply`, the JSON a model returned for the article in `text`.
Reader = Callable[[DataFrame], DataFrame]

# The entities the pattern variant decodes, the ampersand last. Old ones may lack the
# semicolon.
ENTITIES = (("&nbsp;?", " "), ("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&apos;", "'"), ("&#39;?", "'"), ("&amp;?", "&"))
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


# --- pages ----------------------------------------------------------------------------------------


def readable(html: Column) -> Column:
    """Page text by patterns: skipped elements and comments out, tags to spaces, entities decoded."""
    for element in fixed.SKIPPED_ELEMENTS:
        html = F.regexp_replace(html, rf"(?is)<{element}\b[^>]*>.*?</{element}\s*>", " ")
    html = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    html = F.regexp_replace(html, r"(?s)<[^>]*>", " ")
    decoded = reduce(lambda value, pair: F.regexp_replace(value, pair[0], pair[1]), ENTITIES, html)
    return F.coalesce(text.clean(decoded), F.lit(""))


class _Text(HTMLParser):
    """Collects text outside the skipped elements; an end tag closes everything left open inside it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.pieces: list[str] = []

    def handle_starttag(self, tag: str, attrs: object) -> None:
        self.pieces.append(" ")
        if tag not in VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag: str, attrs: object) -> None:
        self.pieces.append(" ")

    def handle_endtag(self, tag: str) -> None:
        self.pieces.append(" ")
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_comment(self, data: str) -> None:
        self.pieces.append(" ")

    def handle_data(self, data: str) -> None:
        if not any(tag in fixed.SKIPPED_ELEMENTS for tag in self.open):
            self.pieces.append(data)


def _read_page(html: str | None) -> str:
    page = _Text()
    page.feed(html or "")
    page.close()
    return " ".join("".join(page.pieces).split())


def page_text(pages: DataFrame, column: str = "html", out: str = "body", method: str = "parser") -> DataFrame:
    """Adds the readable text of a page.

    `parser` follows nesting, unclosed elements and every entity, in Arrow batches; `pattern` stays in
    the JVM and is for pages known to have none of these.
    """
    if method == "pattern":
        return pages.withColumn(out, readable(F.col(column)))
    if method != "parser":
        raise ValueError("method must be 'pattern' or 'parser'")

    @F.pandas_udf("string")
    def parse(html: pd.Series) -> pd.Series:
        return html.map(_read_page)

    return pages.withColumn(out, parse(F.col(column)))


def per_feed(articles: DataFrame, k: int = 5, feed: str = "feed", position: str = "position") -> DataFrame:
    """The first `k` entries of every feed."""
    first = Window.partitionBy(feed).orderBy(position)
    return articles.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= k).drop("_n")


def article_text(articles: DataFrame, out: str = "text") -> DataFrame:
    """Adds title, summary and body as one text of limited length; the limit is part of the task."""
    parts = [F.coalesce(F.col(name), F.lit("")) for name in ("title", "summary", "body")]
    whole = F.concat(parts[0], F.lit("\n\n"), parts[1], F.lit("\n\n"), parts[2])
    return articles.withColumn(out, F.substring(whole, 1, fixed.ARTICLE_CHARS))


# --- listings -------------------------------------------------------------------------------------


def _listing(wine: Column) -> Column:
    """One listing out of a JSON object, null unless name, note and price are all acceptable."""
    kind = replies.field_type(wine, "$.price")
    amount = F.when(~kind.startswith("ARRAY") & ~kind.startswith("OBJECT"), F.try_variant_get(wine, "$.price", "double"))
    url_kind = replies.field_type(wine, "$.url")
    name, note = replies.string(wine, "$.name"), replies.string(wine, "$.note")
    fine = (
        name.isNotNull()
        & (F.length(note) >= fixed.MIN_NOTE)
        & (amount > 0)
        & (url_kind.isNull() | (url_kind == "STRING"))
    )
    fields = F.struct(
        name.alias("name"), note.alias("note"), amount.alias("price"), replies.string(wine, "$.url").alias("url")
    )
    return F.when(F.coalesce(fine, F.lit(False)), fields)


def listings(answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Listings out of `(article_url, reply)` rows, and the articles whose reply is unusable.

    One bad listing discards its whole article. An empty address becomes the article's.
    """
    parsed = text.settle(answers, "_wines", F.try_variant_get(F.try_parse_json("reply"), "$.wines", "array<variant>"))
    read = text.settle(parsed, "_found", F.transform("_wines", _listing)).drop("_wines")
    usable = F.col("_found").isNotNull() & F.forall("_found", lambda wine: wine.isNotNull())
    good = read.filter(usable).select("article_url", F.explode("_found").alias("_wine"))
    found = good.select(
        "article_url",
        "_wine.name",
        "_wine.note",
        "_wine.price",
        F.coalesce(text.present(F.col("_wine.url")), F.col("article_url")).alias("url"),
    )
    return found, read.filter(~F.coalesce(usable, F.lit(False))).select("article_url", "reply")


def _in_range() -> Column:
    return F.col("price").between(fixed.MIN_PRICE, fixed.MAX_PRICE)


def in_range(found: DataFrame) -> DataFrame:
    """Listings the models can judge: the price range they were trained on."""
    return found.filter(_in_range())


def range_summary(found: DataFrame) -> DataFrame:
    """How many listings are kept, and how many skipped as out of range."""
    return found.agg(F.count_if(_in_range()).alias("kept"), F.count_if(~_in_range()).alias("skipped"))


def unseen(found: DataFrame, seen: DataFrame) -> DataFrame:
    """Listings whose key is not remembered. Equal keys within one run all pass."""
    return found.withColumn("key", listing_key()).join(seen.select("key"), "key", "left_anti")


def judge(found: DataFrame, estimator: Predictor) -> DataFrame:
    """Listings with `estimate` and `discount`, in no order.

    `estimator` adds `guess` to rows that have the note as `description`; it sees nothing else that a
    caller with bare prose would not have.
    """
    priced = estimator(found.withColumn("description", F.col("note"))).withColumnRenamed("guess", "estimate").drop("description")
    return priced.withColumn("discount", F.col("estimate") - F.col("price"))


def by_gap(judged: DataFrame) -> DataFrame:
    return judged.orderBy(F.desc("discount"), "key", "price")


def opportunities(found: DataFrame, estimator: Predictor) -> DataFrame:
    """Judged listings, the largest gap first."""
    return by_gap(judge(found, estimator))


def alerts(found: DataFrame, threshold: float = fixed.THRESHOLD) -> DataFrame:
    """Opportunities worth a message, with its text."""
    summary = F.concat(
        "name", F.lit(": listed $"), price.whole_dollars(F.col("price")),
        F.lit(", we estimate $"), price.whole_dollars(F.col("estimate")),
        F.lit(" (gap $"), price.signed_dollars(F.col("discount")), F.lit(")\n"), "url",
    )
    return found.filter(F.col("discount") >= threshold).withColumn("summary", summary)


# --- runs -----------------------------------------------------------------------------------------


def scan(articles: DataFrame, reader: Reader, k: int = 3, fetch: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Listings of the newest articles of every feed, as a reader structures them.

    `fetch` adds `body`, such as `page_text`; it is called for the newest articles only.
    """
    newest = per_feed(articles, k)
    # The reader may be costly; its replies are written once.
    answers = cut(reader(article_text(fetch(newest) if fetch else newest)).select(F.col("url").alias("article_url"), "reply"))
    return listings(answers)[0]


def plan(spark: SparkSession, found: DataFrame, estimator: Predictor, seen_path: str, out_path: str, run: int) -> DataFrame:
    """One run: judge the unseen listings, store the opportunities, remember their keys.

    Both tables get one directory per run and the run ignores its own, so repeating it after a crash
    changes nothing. Of the remembered keys only the buckets that the listings fall into are read.
    """
    asked = in_range(found)
    keys = asked.select(listing_key().alias("key"))
    judge(unseen(asked, seen_keys(spark, seen_path, run, keys)), estimator).write.mode("overwrite").parquet(f"{out_path}/run={run}")
    stored = spark.read.parquet(f"{out_path}/run={run}")
    write_seen(stored, seen_path, run)
    return by_gap(stored)

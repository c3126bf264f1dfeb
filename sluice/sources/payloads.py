"""Rows from JSON and XML payloads held in a column, with explicit schemas; bad items are skipped, not the payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.dates import parse_datetime
from sluice.functions.html import clean_html
from sluice.functions.rules import matches_keywords
from sluice.functions.text import collapse, html_unescape, repo_url, text_or_empty, title_parts, truncate

COMPANY = (
    "array<struct<name:string,website:string,url:string,slug:string,team_size:string,one_liner:string,industries:array<string>,"
    "tags:array<string>,industry:string,subindustry:string,status:string,batch:string>>"
)
REMOTE_JOB = "array<struct<position:string,company:string,tags:array<string>,description:string,date:string,epoch:string,url:string,apply_url:string>>"
BOARD = "struct<jobs:array<struct<title:string,content:string,location:struct<name:string>,first_published:string,updated_at:string,company_name:string,absolute_url:string>>>"
PAPERS = "array<struct<title:string,paper:struct<id:string,title:string,authors:array<struct<name:string>>,summary:string,publishedAt:string>>>"
ATOM = (
    "struct<entry:array<struct<id:string,title:string,summary:string,published:string,updated:string,author:array<struct<name:string>>,"
    "link:array<struct<_href:string,_rel:string,_type:string,_title:string>>,category:array<struct<_term:string>>>>>"
)
RSS = "struct<channel:struct<item:array<struct<title:string,link:string,summary:string,description:string,published:string,updated:string,pubDate:string>>>>"


def rows_of(df: DataFrame, body: str, schema: str, array: str | None = None, carry: list[str] | None = None) -> DataFrame:
    """A row for each element of a JSON array, in order: position seq, element item. What is no such array gives none."""
    value = F.from_json(F.col(body), schema, {"mode": "PERMISSIVE"})
    if array:
        value = value[array]
    return df.select(*(carry or []), F.posexplode(value).alias("seq", "item"))


def xml_rows(df: DataFrame, body: str, schema: str, path: str, carry: list[str] | None = None) -> DataFrame:
    value = F.from_xml(F.col(body), schema, {"mode": "PERMISSIVE", "ignoreNamespace": "true", "valueTag": "_text"})
    for step in path.split("."):
        value = value[step]
    return df.select(*(carry or []), F.posexplode(value).alias("seq", "item"))


def _first_date(now: Column, *cs: Column) -> Column:
    """The first of some dates that can be read."""
    return F.coalesce(*[parse_datetime(c, now) for c in cs])


def _first_text(*cs: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cs])


def companies(df: DataFrame, body: str = "body", page: str = "https://example.com/companies/") -> DataFrame:
    """Company directory rows: blank names dropped, team size a positive number or null, the address from the slug if missing."""
    i = F.col("item")
    size = i["team_size"].try_cast("double")
    return rows_of(df, body, COMPANY).where(F.trim(i["name"]) != "").select(
        "seq", F.trim(i["name"]).alias("name"), F.nullif(i["website"], F.lit("")).alias("website"),
        F.coalesce(F.nullif(i["url"], F.lit("")), F.concat(F.lit(page), text_or_empty(i["slug"]))).alias("page_url"),
        F.when(size > 0, size.cast("int")).alias("team_size"), text_or_empty(i["one_liner"]).alias("one_liner"),
        F.coalesce(i["industries"], F.array().cast("array<string>")).alias("industries"), F.coalesce(i["tags"], F.array().cast("array<string>")).alias("tags"),
        text_or_empty(i["industry"]).alias("industry"), text_or_empty(i["subindustry"]).alias("subindustry"),
        text_or_empty(i["status"]).alias("status"), text_or_empty(i["batch"]).alias("batch"),
    )


def remote_jobs(df: DataFrame, now: Column, keywords: list[str], body: str = "body") -> DataFrame:
    i = F.col("item")
    hay = F.concat_ws(" ", i["position"], i["tags"], i["description"])
    return rows_of(df, body, REMOTE_JOB).where(i["position"].isNotNull() & matches_keywords(hay, keywords)).select(
        "seq", F.coalesce(F.nullif(i["company"], F.lit("")), F.lit("Unknown")).alias("company"), i["position"].alias("title"),
        _first_date(now, i["date"], i["epoch"]).alias("date"), F.lit(True).alias("is_remote"),
        _first_text(i["url"], i["apply_url"]).alias("url"), truncate(clean_html(text_or_empty(i["description"])), 2000).alias("description"),
    )


def board_jobs(df: DataFrame, now: Column, keywords: list[str], body: str = "body", token: str = "token") -> DataFrame:
    i = F.col("item")
    rows = rows_of(df, body, BOARD, "jobs", [token]).withColumn("content", clean_html(html_unescape(text_or_empty(i["content"]))))
    content = F.col("content")
    return rows.where(matches_keywords(F.concat_ws(" ", i["title"], content), keywords)).select(
        "seq", F.coalesce(_first_text(i["company_name"]), F.col(token)).alias("company"), i["title"].alias("title"),
        _first_date(now, i["first_published"], i["updated_at"]).alias("date"),
        F.contains(F.lower(text_or_empty(i["location"]["name"])), F.lit("remote")).alias("is_remote"),
        i["absolute_url"].alias("url"), truncate(content, 2000).alias("description"),
    )


def feed_jobs(df: DataFrame, now: Column, keywords: list[str], body: str = "body") -> DataFrame:
    i = F.col("item")
    parts = title_parts(i["title"])
    summary = F.coalesce(F.nullif(i["summary"], F.lit("")), i["description"])
    rows = xml_rows(df, body, RSS, "channel.item").withColumn("description", clean_html(text_or_empty(summary)))
    return rows.where(matches_keywords(F.concat_ws(" ", i["title"], F.col("description")), keywords)).select(
        "seq", parts["company"].alias("company"), parts["role"].alias("title"), parse_datetime(_first_text(i["published"], i["updated"], i["pubDate"]), now).alias("date"),
        F.lit(True).alias("is_remote"), i["link"].alias("url"), truncate(F.col("description"), 2000).alias("description"),
    )


def news_items(df: DataFrame, now: Column, keywords: list[str], body: str = "body", source: str = "source_name") -> DataFrame:
    i = F.col("item")
    summary = F.coalesce(i["summary"], i["description"])
    return xml_rows(df, body, RSS, "channel.item", [source]).where(
        (F.trim(i["title"]) != "") & (F.trim(i["link"]) != "") & matches_keywords(F.concat_ws(" ", i["title"], summary), keywords)
    ).select(
        source, "seq", collapse(i["title"]).alias("headline"), F.trim(i["link"]).alias("url"),
        parse_datetime(_first_text(i["published"], i["updated"], i["pubDate"]), now).alias("date"),
        truncate(clean_html(text_or_empty(summary)), 1000).alias("summary"),
    )


def atom_papers(df: DataFrame, now: Column, body: str = "body") -> DataFrame:
    i = F.col("item")
    pdf = F.get(F.filter(i["link"], lambda x: (x["_title"] == "pdf") | (x["_type"] == "application/pdf")), F.lit(0))["_href"]
    return xml_rows(df, body, ATOM, "entry").select(
        "seq", F.regexp_replace(F.element_at(F.split(F.regexp_replace(F.trim(i["id"]), "/+$", ""), "/"), -1), r"v\d+$", "").alias("paper_id"),
        collapse(i["title"]).alias("title"), collapse(i["summary"]).alias("summary"),
        F.filter(F.transform(i["author"]["name"], lambda x: F.trim(x)), lambda x: x != "").alias("authors"), F.trim(i["id"]).alias("paper_url"), pdf.alias("pdf_url"),
        parse_datetime(_first_text(i["published"], i["updated"]), now).alias("published_date"),
        F.transform(i["category"]["_term"], lambda x: x).alias("categories"), repo_url(i["summary"]).alias("github_url"),
    ).where("published_date is not null")


def daily_papers(df: DataFrame, now: Column, body: str = "body", page: str = "https://example.com/papers/") -> DataFrame:
    i = F.col("item")
    return rows_of(df, body, PAPERS).where(F.trim(i["paper"]["id"]) != "").select(
        "seq", i["paper"]["id"].alias("paper_id"), collapse(_first_text(i["title"], i["paper"]["title"])).alias("title"),
        F.filter(F.transform(i["paper"]["authors"]["name"], lambda x: F.trim(x)), lambda x: x != "").alias("authors"),
        F.concat(F.lit(page), i["paper"]["id"]).alias("paper_url"), collapse(text_or_empty(i["paper"]["summary"])).alias("summary"),
        parse_datetime(i["paper"]["publishedAt"], now).alias("published_date"), repo_url(i["paper"]["summary"]).alias("github_url"),
    ).where("published_date is not null")

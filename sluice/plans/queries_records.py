"""Examples of the record shapes and of the verticals as wholes, over literal rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.catalog import example, inline, values
from sluice.plans import verticals
from sluice.sinks.tabs import flatten

NOW = "2026-09-04 12:00:00"


def _now():
    return F.lit(NOW).cast("timestamp")


_SOURCE = "struct<name:string,url:string>"
RECORDS = {
    "startup": (
        [(("dir", "https://d.com/"), ("Acme", (12,)), "2026-09-04 10:00:00"), (("dir", None), ("Beta", (None,)), "2026-09-04 11:00:00")],
        f"source {_SOURCE}, content struct<entityName:string,data:struct<employeeCount:int>>, at string",
        {"source.name": "source.name", "source.url": "source.url", "entityName": "content.entityName", "employeeCount": "content.data.employeeCount", "collectedAt": "collectedAt"},
        [("dir", "https://d.com/", "Acme", 12, "2026-09-04T10:00:00"), ("dir", "", "Beta", None, "2026-09-04T11:00:00")],
    ),
    "product": (
        [(("dir", "https://d.com/"), ("Acme", "FREE"), "2026-09-04 10:00:00")], f"source {_SOURCE}, content struct<startupName:string,pricingModel:string>, at string",
        {"source.name": "source.name", "source.url": "source.url", "startupName": "content.startupName", "pricingModel": "content.pricingModel", "collectedAt": "collectedAt"}, [("dir", "https://d.com/", "Acme", "FREE", "2026-09-04T10:00:00")],
    ),
    "paper": (
        [(("arc", "https://p.org/"), ("T", ["A", "B"], None, 3), "2026-09-04 10:00:00")], f"source {_SOURCE}, content struct<title:string,authors:array<string>,github_url:string,github_stars:int>, at string",
        {"source.name": "source.name", "title": "content.title", "authors": "content.authors", "github_url": "content.github_url", "github_stars": "content.github_stars", "collectedAt": "collectedAt"}, [("arc", "T", "A, B", "", 3, "2026-09-04T10:00:00")],
    ),
    "job": (
        [(("board", None), ("Acme", True, "Engineering", None), "2026-09-04 10:00:00")], f"source {_SOURCE}, content struct<company:string,is_remote:boolean,role_family:string,url:string>, at string",
        {"company": "content.company", "is_remote": "content.is_remote", "role_family": "content.role_family", "url": "content.url", "collectedAt": "collectedAt"}, [("Acme", True, "Engineering", "", "2026-09-04T10:00:00")],
    ),
    "news": (
        [(("feed", None), ("H", None, "https://n.com/1"), "2026-09-04 10:00:00")], f"source {_SOURCE}, content struct<headline:string,summary:string,url:string>, at string",
        {"headline": "content.headline", "summary": "content.summary", "url": "content.url", "collectedAt": "collectedAt"}, [("H", "", "https://n.com/1", "2026-09-04T10:00:00")],
    ),
}


def _flat(kind, rows, schema, paths, expected):
    def run(spark, sf):
        return flatten(inline(spark, rows, schema).withColumn("collectedAt", F.col("at").cast("timestamp")), paths)

    example(f"SELECT * FROM {values(expected, ', '.join(paths))}", f"flatten_{kind}")(run)


for _kind, _x in RECORDS.items():
    _flat(_kind, *_x)

NEWS = [
    (0, "Feed", "AI news", "https://n.com/1", "2026-09-04 10:00:00", "s"), (1, "Feed", "ai  NEWS", "https://n.com/2", "2026-09-04 10:00:00", "s"), (2, "Other", "AI news", "https://n.com/3", "2026-09-04 11:00:00", "s"),
    (3, "Feed", "Old", "https://n.com/4", "2026-09-01 10:00:00", "s"), (4, "Feed", "Again", "https://n.com/1", "2026-09-04 10:00:00", "s"), (5, "Feed", "Bad link", "nowhere", "2026-09-04 10:00:00", "s"), (6, "Feed", "No date", "https://n.com/6", None, "s"),
]


@example(f"SELECT * FROM {values([(0, 'gold'), (2, 'gold'), (3, 'rejected'), (5, 'rejected'), (6, 'rejected')], 'seq, branch')}")
def news_vertical(spark, sf):
    rows = inline(spark, NEWS, "seq int, source_name string, headline string, url string, at string, summary string").withColumn("date", F.col("at").cast("timestamp")).drop("at")
    out = verticals.news(verticals.RunContext(spark, _now(), ""), rows)
    return out.accepted.select("seq", F.lit("gold").alias("branch")).unionByName(out.rejected.select("seq", F.lit("rejected").alias("branch")))


STARTUPS = [(0, "OpenAI, Inc.", "https://d.com/1", 5), (1, "openai, inc.", "https://d.com/2", 5), (2, "Nova Labs", "https://D.com", None), (3, "Bad", "d.com", 1)]


@example("SELECT * FROM " + values([(0, "OpenAI", 5, "https://d.com/1"), (2, "Nova Labs", None, "https://d.com/")], "seq, canonical_name, employee_count, source_url"))
def startups_vertical(spark, sf):
    rows = inline(spark, STARTUPS, "seq bigint, name string, page_url string, team_size int")
    return verticals.startups(verticals.RunContext(spark, _now(), ""), rows).accepted.drop("dedup_key", "entity_name")


JOBS = [(0, "OpenAI Inc", "Backend Engineer", "2026-09-04 10:00:00", True, "https://j.com/1", ""), (1, "Nova", "Cook", "2026-09-04 10:00:00", False, None, ""), (2, "Nova", "Cook", "2026-09-04 11:00:00", False, None, ""), (3, "Old", "Cook", "2026-08-04 10:00:00", False, None, "")]


@example("SELECT * FROM " + values([(0, "OpenAI", "Engineering"), (1, "Nova", "Other")], "seq, canonical_name, role_family"))
def jobs_vertical(spark, sf):
    rows = inline(spark, JOBS, "seq bigint, company string, title string, at string, is_remote boolean, url string, description string").withColumn("date", F.col("at").cast("timestamp")).drop("at")
    return verticals.jobs(verticals.RunContext(spark, _now(), ""), rows).accepted.select("seq", "canonical_name", "role_family")


PRODUCTS = [(0, "Acme", "https://a.com", "free plan and $5/mo"), (1, "Beta", "https://b.com", "nothing"), (2, "Gamma", "", "free plan"), (3, "Delta", "https://d.com/x", "contact sales")]


@example("SELECT * FROM " + values([(0, "Acme", "FREEMIUM", "https://a.com/"), (3, "Delta", "ENTERPRISE", "https://d.com/x")], "seq, canonical_name, pricing_model, source_url"))
def products_vertical(spark, sf):
    rows = inline(spark, PRODUCTS, "seq bigint, name string, website string, page_text string")
    return verticals.products(verticals.RunContext(spark, _now(), ""), rows).accepted.select("seq", "canonical_name", "pricing_model", "source_url")


PAPERS = [(0, "1", "T", ["A"], "https://p.org/1", "https://github.com/a/b", "see https://github.com/a/b"), (1, "2", "U", ["B"], "https://p.org/2", "https://github.com/c/d", "no code"), (2, "1", "T", ["A"], "https://p.org/1", None, ""), (3, "4", "", ["A"], "https://p.org/4", None, "")]
STARS = [("a/b", 7)]


@example("SELECT * FROM " + values([(0, "T", "https://github.com/a/b", 7), (1, "U", None, None)], "seq, title, github_url, github_stars"))
def papers_vertical(spark, sf):
    rows = inline(spark, PAPERS, "seq bigint, paper_id string, title string, authors array<string>, paper_url string, github_url string, summary string").withColumn("published_date", _now())
    return verticals.papers(verticals.RunContext(spark, _now(), ""), rows, inline(spark, STARS, "slug string, github_stars int")).accepted.select("seq", "title", "github_url", "github_stars")

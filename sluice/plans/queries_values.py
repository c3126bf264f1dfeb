"""Examples over literal rows that both engines are given: parsing, rules, cascades and entity resolution."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from sluice.catalog import example, inline, query, table, values
from sluice.functions import dates, html, rules, salvage, text
from sluice.operators import candidates, resolve, similarity, validate
from sluice.sources import payloads

NOW = "2026-09-04 12:00:00"


def _now():
    return F.lit(NOW).cast("timestamp")


def _stamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def golden(rows, names):
    """The rows that are right, as SQL."""
    return f"SELECT * FROM {values(rows, names)}"


def case(name, rows, schema, expected, names, make):
    """A query over literal rows with a literal result."""

    def run(spark, sf):
        return make(inline(spark, rows, schema))

    example(golden(expected, names), name)(run)


DATES = [
    (1, "2026-09-04T10:00:00Z", "2026-09-04 10:00:00"), (2, "2026-09-04T10:00:00+02:00", "2026-09-04 08:00:00"), (3, "Fri, 04 Sep 2026 10:00:00 GMT", "2026-09-04 10:00:00"),
    (4, "Fri, 04 Sep 2026 10:00:00 +0100", "2026-09-04 09:00:00"), (5, "3 hours ago", "2026-09-04 09:00:00"), (6, "about 2 weeks ago", "2026-08-21 12:00:00"),
    (7, "1788516000", "2026-09-04 10:00:00"), (8, "1788516000000", "2026-09-04 10:00:00"), (9, "just now", "2026-09-04 12:00:00"), (10, "today", "2026-09-04 00:00:00"),
    (11, "Yesterday", "2026-09-03 00:00:00"), (12, "2026-09-01", "2026-09-01 00:00:00"), (13, "", None), (14, None, None), (15, "not a date", None),
    (16, "1 month ago", "2026-08-05 12:00:00"), (17, "5 MINUTES AGO", "2026-09-04 11:55:00"), (18, "2026-09-04 10:11:12", "2026-09-04 10:11:12"),
    (19, "9223372036854775807", None), (20, "999999999999999999 years ago", None), (21, "99999999999999999999999 days ago", None), (22, "3000 years ago", None), (23, "253402300799000", "9999-12-31 23:59:59"), (24, "99999999999999999999999", None),
]
case("parse_datetime", [r[:2] for r in DATES], "id int, s string", [(r[0], r[2]) for r in DATES], "id, at",
     lambda df: df.select("id", _stamp(dates.parse_datetime(F.col("s"), _now())).alias("at")))

PRICING = [
    (1, "Start with our free plan, then $10/month", "FREEMIUM"), (2, "Free forever for everyone", "FREE"), (3, "Only $29.99 per user", "PAID"), (4, "Contact sales for pricing", "ENTERPRISE"),
    (5, "There is no free tier available. $5/mo", "PAID"), (6, "We do not offer a free plan", None), (7, "No ads. Our free plan is great", "FREE"), (8, "", None), (9, None, None),
    (10, "Free tier. Talk to sales", "FREEMIUM"), (11, "A lovely product", None), (12, "USD 15 / month", "PAID"), (13, "without a free tier, but always free for schools", "FREE"),
]
case("pricing_model", [r[:2] for r in PRICING], "id int, s string", [(r[0], r[2]) for r in PRICING], "id, model", lambda df: df.select("id", rules.pricing_model(F.col("s")).alias("model")))

NEGATED = [
    (1, "our free plan", True), (2, "no free plan", False), (3, "never a free plan", False), (4, "no, really: a free plan", True), (5, "not free plan but free tier!", False),
    (6, "no free plan. Try the free tier", True), (7, "casino games and slots on the free plan", True), (8, "nothing", False), (9, "they do n't have a free plan", False), (10, "they don't have a free plan", True),
]
case("negation_match", [r[:2] for r in NEGATED], "id int, s string", [(r[0], r[2]) for r in NEGATED], "id, hit", lambda df: df.select("id", rules.unnegated_match(F.col("s")).alias("hit")))

ROLES = [
    (1, "Senior Backend Engineer", "", "Engineering"), (2, "Data Scientist", "", "Data Science / ML"), (3, "Research Lead", None, "Research"), (4, "Product Manager", "", "Product"),
    (5, "Graphic Designer", "", "Design"), (6, "Account Executive", "", "Sales"), (7, "Growth Lead", "", "Marketing"), (8, "Customer Success", "", "Customer Support"),
    (9, "Finance Lead", "", "Operations"), (10, "Astronaut", "", "Other"), (11, "Astronaut", "builds software", "Engineering"), (12, "Recruiter", "", "Design"), (13, None, None, "Other"),
]
case("role_family", [r[:3] for r in ROLES], "id int, title string, extra string", [(r[0], r[3]) for r in ROLES], "id, family", lambda df: df.select("id", rules.role_family(F.col("title"), F.col("extra")).alias("family")))

HEADS = ["", "We offer a ", "there is no ", "not a ", "They do n't have a ", "Never pay: ", "without any real ", "no. But a "]
CORES = ["free plan", "FREE TIER", "start free", "starts free", "free forever", "100% free", "always free", "free to use", "freeplan", "carefree plan", "nothing", "$5/mo", "$12.50 per user", "usd 9 / month", "contact sales", "Book a demo", "request a quote", "$5 a month"]
TAILS = ["", ". $10 / month", " and contact us for pricing", ". Free tier too", " casino, free plans", " for all. Talk to sales today"]
_SENTENCES = f"""s AS (SELECT h.i * 1000 + c.i * 20 + t.i AS id, h.x || c.x || t.x AS s FROM {values(list(enumerate(HEADS)), 'i, x').replace(' AS t(', ' AS h(')}, {values(list(enumerate(CORES)), 'i, x').replace(' AS t(', ' AS c(')}, {values(list(enumerate(TAILS)), 'i, x')})"""
_FREE_AT = "free plan\\b|free tier\\b|starts? free\\b|free forever\\b|100% free\\b|always free\\b|free to use\\b"
#: A hit by looking at every place of the text, with no help of the operator's way over matches and gaps.
_HITS = f"""hit AS (SELECT DISTINCT id FROM (SELECT id, lower(s) AS s FROM s), unnest(range(1, length(s) + 1)) AS u(i)
WHERE regexp_matches(substr(s, i), '^({_FREE_AT})') AND (i = 1 OR NOT regexp_matches(substr(s, i - 1, 1), '\\w'))
AND NOT regexp_matches(substr(s, greatest(i - 30, 1), least(30, i - 1)), '\\b(no|not|without|n''t have|never)\\s+(\\w+\\s+)*\\w*\\s*$'))"""


def _sentences(spark):
    part = lambda rows, i, x: inline(spark, list(enumerate(rows)), f"{i} int, {x} string")
    all_ = part(HEADS, "a", "h").crossJoin(part(CORES, "b", "c")).crossJoin(part(TAILS, "d", "t"))
    return all_.select((F.col("a") * 1000 + F.col("b") * 20 + F.col("d")).alias("id"), F.concat("h", "c", "t").alias("s"))


@example(f"WITH {_SENTENCES}, {_HITS} SELECT id, id IN (SELECT id FROM hit) AS hit FROM s")
def negation_match_generated(spark, sf):
    return _sentences(spark).select("id", rules.unnegated_match(F.col("s")).alias("hit"))


@example(f"""WITH {_SENTENCES}, {_HITS}, f AS (SELECT id, id IN (SELECT id FROM hit) AS free,
regexp_matches(lower(s), '\\$\\d+(\\.\\d\\d)? */ *(mo|month|user|seat)') OR regexp_matches(lower(s), '\\$\\d+(\\.\\d\\d)? *per *(month|user|seat)') OR regexp_matches(lower(s), '\\busd? ?\\d+ */ *mo') AS paid,
regexp_matches(lower(s), '\\b(contact sales|talk to sales|book a demo|custom pricing|enterprise plan|contact us for pricing|request a quote)\\b') AS sales FROM s)
SELECT id, CASE WHEN free AND (paid OR sales) THEN 'FREEMIUM' WHEN free THEN 'FREE' WHEN paid THEN 'PAID' WHEN sales THEN 'ENTERPRISE' END AS model FROM f""")
def pricing_model_generated(spark, sf):
    return _sentences(spark).select("id", rules.pricing_model(F.col("s")).alias("model"))


LEVELS = ["Senior", "Lead", "Head of", "Junior", "AI", "ML", "Staff UX", "VP"]
JOB_NAMES = ["Engineer", "Software Developer", "Data Scientist", "Scientist", "Product Owner", "Product Manager", "PM Growth", "Designer", "Account Executive", "Content Writer", "Customer Success Manager", "Recruiter", "Finance Lead", "Astronaut", "Cook", "LLM Researcher", "HR Partner", "Legal Counsel"]
EXTRAS = ["", "you own the sales pipeline", "we use machine learning", "people ops", "none"]


def _roles(spark):
    part = lambda rows, i, x: inline(spark, list(enumerate(rows)), f"{i} int, {x} string")
    all_ = part(LEVELS, "a", "l").crossJoin(part(JOB_NAMES, "b", "j")).crossJoin(part(EXTRAS, "d", "extra"))
    return all_.select((F.col("a") * 1000 + F.col("b") * 20 + F.col("d")).alias("id"), F.concat_ws(" ", "l", "j").alias("title"), "extra")


# the keyword that is found in the first family of the list: a join of rows and keywords, not a chain of conditions
_WORDS = values([(k, name, w) for k, (name, words) in enumerate(rules.ROLE_RULES) for w in words], "k, family, w").replace(" AS t(", " AS w(")


@example(f"""WITH r AS (SELECT l.i * 1000 + j.i * 20 + e.i AS id, ' ' || lower(l.x || ' ' || j.x) || ' ' || lower(e.x) || ' ' AS hay FROM {values(list(enumerate(LEVELS)), 'i, x').replace(' AS t(', ' AS l(')},
{values(list(enumerate(JOB_NAMES)), 'i, x').replace(' AS t(', ' AS j(')}, {values(list(enumerate(EXTRAS)), 'i, x').replace(' AS t(', ' AS e(')})
SELECT id, coalesce((SELECT arg_min(family, k) FROM {_WORDS} WHERE contains(r.hay, w)), 'Other') AS family FROM r""")
def role_family_generated(spark, sf):
    return _roles(spark).select("id", rules.role_family(F.col("title"), F.col("extra")).alias("family"))


@query("""SELECT p_partkey, trim(split_part(s, ':', 1)) AS company, trim(substr(s, strpos(s, ':') + 1)) AS role
FROM (SELECT p_partkey, ' ' || p_brand || ' : ' || p_name || ': ' || p_type AS s FROM part)""")
def title_partition_table(spark, sf):
    s = F.concat(F.lit(" "), "p_brand", F.lit(" : "), "p_name", F.lit(": "), "p_type")
    parts = text.title_parts(s)
    return table(spark, sf, "part").select("p_partkey", parts["company"].alias("company"), parts["role"].alias("role"))


_REPO_TEXT = "CASE p_partkey % 4 WHEN 0 THEN 'see https://github.com/' || replace(p_brand, '#', '-') || '/r' || p_partkey || '.git' WHEN 1 THEN '(http://www.github.com/o.x/r_' || p_partkey || '),' WHEN 2 THEN 'https://example.com/a/b' ELSE 'code: https://github.com/only' END"


@query(rf"""WITH s AS (SELECT p_partkey, {_REPO_TEXT} AS s FROM part),
u AS (SELECT p_partkey, rtrim(nullif(regexp_extract(s, 'https?://(www\.)?github\.com/[A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+'), ''), ').,;') AS url FROM s)
SELECT p_partkey, url, CASE WHEN url IS NOT NULL THEN split_part(url, '/', 4) || '/' || regexp_replace(split_part(url, '/', 5), '\.git$', '') END AS slug FROM u""")
def repo_evidence_table(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", F.expr(_REPO_TEXT).alias("s")).select("p_partkey", text.repo_url(F.col("s")).alias("url"))
    return df.select("p_partkey", "url", text.repo_slug(F.col("url")).alias("slug"))


#: Times written in six ways by both engines, and what was written.
_AT = "CASE event_id % 6 WHEN 0 THEN {f0} WHEN 1 THEN {f1} WHEN 2 THEN {f2} WHEN 3 THEN {f3} WHEN 4 THEN {f4} ELSE {f5} END"


@query("SELECT event_id, strftime(CASE WHEN event_id % 6 = 4 THEN date_trunc('day', ts) WHEN event_id % 6 = 5 THEN TIMESTAMP '2026-09-04 12:00:00' - to_hours(CAST(event_id % 1000 AS INTEGER)) ELSE date_trunc('second', ts) END, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def parse_datetime_table(spark, sf):
    form = lambda f: f"date_format(ts, \"{f}\")"
    s = _AT.format(f0=form("yyyy-MM-dd'T'HH:mm:ss'Z'"), f1=form("EEE, dd MMM yyyy HH:mm:ss 'GMT'"), f2="cast(unix_seconds(cast(ts as timestamp)) as string)", f3="cast(unix_seconds(cast(ts as timestamp)) * 1000 as string)", f4=form("yyyy-MM-dd"), f5="concat(event_id % 1000, ' hours ago')")
    return table(spark, sf, "events").select("event_id", _stamp(dates.parse_datetime(F.expr(s), _now())).alias("at"))


LLM = [(1, "PAID", "FREE"), (2, "paid", "FREE"), (3, None, "FREE"), (4, "", None), (5, "ENTERPRISE", None)]


@example(f"SELECT id, CASE WHEN answer IN ('FREE', 'FREEMIUM', 'PAID', 'ENTERPRISE') THEN answer ELSE rule END AS model FROM {values(LLM, 'id, answer, rule')}")
def coalesce_classifier(spark, sf):
    df = inline(spark, LLM, "id int, answer string, rule string")
    return df.select("id", candidates.isolated(F.when(F.col("answer").isin(validate.PRICING_MODELS), F.col("answer")), F.col("rule")).alias("model"))


NUMBERS = [(1, " 42 ", "2026-09-04", "true"), (2, "x", "2026-13-01", "maybe"), (3, None, None, None), (4, "7.9", "2026-09-04T10:00:00", "false")]


@example(f"SELECT id, TRY_CAST(CASE WHEN regexp_full_match(trim(n), '[+-]?\\d+') THEN trim(n) END AS INTEGER) AS n, strftime(TRY_CAST(d AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS d, TRY_CAST(b AS BOOLEAN) AS b FROM {values(NUMBERS, 'id, n, d, b')}")
def coerce_types(spark, sf):
    df = inline(spark, NUMBERS, "id int, n string, d string, b string")
    return validate.coerce(df, {"n": "int", "d": "timestamp", "b": "boolean"}).withColumn("d", _stamp(F.col("d"))).select("id", "n", "d", "b")


@example(f"SELECT id, CASE WHEN regexp_full_match(n, '\\s*[+-]?\\d+(\\.\\d+)?\\s*') THEN TRY_CAST(n AS DOUBLE) END AS seconds FROM {values(NUMBERS, 'id, n, d, b')}")
def try_float(spark, sf):
    return inline(spark, NUMBERS, "id int, n string, d string, b string").select("id", text.try_float(F.col("n")).alias("seconds"))


ATTEMPTS = [(0, None), (1, None), (2, None), (5, None), (10, None), (1, 7.5), (1, 400.0)]


@example(f"SELECT attempt, retry_after, CAST(CASE WHEN retry_after IS NULL THEN least(1.0 * power(2.0, attempt), 30.0) ELSE least(retry_after, 30.0) END AS DOUBLE) AS seconds FROM (SELECT attempt, CAST(retry_after AS DOUBLE) AS retry_after FROM {values(ATTEMPTS, 'attempt, retry_after')})")
def backoff_schedule(spark, sf):
    df = inline(spark, ATTEMPTS, "attempt int, retry_after double")
    return df.select("attempt", "retry_after", dates.backoff_seconds(F.col("attempt"), 1.0, 30.0, F.col("retry_after")).alias("seconds"))


STATUSES = [(200,), (204,), (301,), (404,), (429,), (500,), (503,), (598,), (599,)]


@example(f"SELECT status, CASE WHEN status BETWEEN 200 AND 299 THEN 'ok' WHEN status = 429 OR status >= 500 THEN 'retry' ELSE 'failed' END AS class FROM {values(STATUSES, 'status')}")
def fetch_status_class(spark, sf):
    return inline(spark, STATUSES, "status int").select("status", rules.status_class(F.col("status")).alias("class"))


ITEMS = [(1, "4"), (2, "zero"), (3, None), (4, "0"), (5, "-2")]


@example(f"SELECT id, CASE WHEN TRY_CAST(n AS INTEGER) <> 0 THEN CAST(100.0 AS DOUBLE) / TRY_CAST(n AS INTEGER) END AS result, TRY_CAST(n AS INTEGER) IS NULL OR TRY_CAST(n AS INTEGER) = 0 AS failed FROM {values(ITEMS, 'id, n')}")
def failure_isolation(spark, sf):
    got = F.try_divide(F.lit(100.0), F.col("n").try_cast("int"))
    return inline(spark, ITEMS, "id int, n string").select("id", got.alias("result"), got.isNull().alias("failed"))


TITLES = [(1, "Acme: Engineer", "Acme", "Engineer"), (2, "Engineer", "Unknown", "Engineer"), (3, "Acme: Lead: AI", "Acme", "Lead: AI"), (4, "Acme:", "Unknown", "Acme:"), (5, " Acme : Dev ", "Acme", "Dev"), (6, "Acme: ", "Acme", "Acme: "), (7, "", "Unknown", "")]
case("title_partition", [r[:2] for r in TITLES], "id int, s string", [(r[0], r[2], r[3]) for r in TITLES], "id, company, role",
     lambda df: df.select("id", text.title_parts(F.col("s"))["company"].alias("company"), text.title_parts(F.col("s"))["role"].alias("role")))

SLUGS = [(1, "https://github.com/a/b", "a/b"), (2, "https://github.com/a/b.git", "a/b"), (3, "http://www.github.com/a/b/tree/main", "a/b"), (4, "https://example.com/a/b", None), (5, "https://github.com/a", None), (6, None, None)]
case("repo_slug", [r[:2] for r in SLUGS], "id int, s string", [(r[0], r[2]) for r in SLUGS], "id, slug", lambda df: df.select("id", text.repo_slug(F.col("s")).alias("slug")))

EVIDENCE = [(1, "Code at https://github.com/a/b.", "none", "https://github.com/a/b"), (2, "no code", "see (https://github.com/c/d),", "https://github.com/c/d"), (3, None, None, None), (4, "github.com/a/b", "", None)]
case("url_evidence_extract", [r[:3] for r in EVIDENCE], "id int, a string, b string", [(r[0], r[3]) for r in EVIDENCE], "id, url", lambda df: df.select("id", text.repo_url(F.col("a"), F.col("b")).alias("url")))

REPLIES = [
    (1, '{"a": 1}', '{"a":1}'), (2, 'Sure:\n```json\n{"a": 1}\n```', '{"a":1}'), (3, 'The answer is {"a": {"b": 2}} I think', '{"a":{"b":2}}'), (4, "nothing", None), (5, "{broken", None), (6, "[1, 2]", None), (7, None, None), (8, "{}", "{}"),
]
case("json_salvage", [r[:2] for r in REPLIES], "id int, s string", [(r[0], r[2]) for r in REPLIES], "id, json", lambda df: df.select("id", salvage.json_salvage(F.col("s")).alias("json")))

LINKS = [
    (1, '<a href="/about">x</a><a href="/pricing">Prices</a>', "https://e.com/pricing"), (2, '<a href="https://x.com/pricing">p</a>', "https://x.com/pricing"), (3, '<a href="plans">Pricing</a><a href="/p">pricing</a>', "https://e.com/p"),
    (4, "<p>no links</p>", None), (5, '<a href="/plans"> Pricing </a>', "https://e.com/plans"), (6, None, None),
]
case("find_link", [r[:2] for r in LINKS], "id int, s string", [(r[0], r[2]) for r in LINKS], "id, url", lambda df: df.select("id", html.find_link(F.col("s"), F.lit("https://e.com/")).alias("url")))

RATIOS = [(1, "scale ai", "ai scale", 100.0), (2, "openai", "open ai", 92.307692), (3, "abc", "xyz", 0.0), (4, "anthropic", "anthropics", 94.736842), (5, "data bricks", "databricks", 57.142857)]
RATIOS[4] = (5, "data bricks", "databricks", round(200 * 6 / 21, 6))


def _ratio(a, b):
    """200 * LCS / lengths of the sorted words, by the usual table."""
    a, b = (" ".join(sorted(x.split())) for x in (a, b))
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return round(200 * row[-1] / (len(a) + len(b)), 6)


case("token_sort_ratio", [r[:3] for r in RATIOS], "id int, a string, b string", [(r[0], _ratio(r[1], r[2])) for r in RATIOS], "id, score",
     lambda df: df.select("id", F.round(text.token_sort_ratio(F.col("a"), F.col("b")), 6).alias("score")))

SWEEP = [(1, "acme robotics"), (2, "robotics acme"), (3, "acme robotic"), (4, "beta systems"), (5, "beta system"), (6, "gamma"), (7, "gamme"), (8, "delta lake labs"), (9, "acme robots")]
case("similarity_self_join", SWEEP, "key int, name string",
     [(a, b, s) for i, (a, x) in enumerate(SWEEP) for b, y in SWEEP[i + 1 :] if (s := _ratio(x, y)) >= 85], "a, b, score",
     lambda df: similarity.similar_pairs(df, 85).select("a", "b", F.round("score", 6).alias("score")))

NAMES = [
    (1, "OpenAI, Inc.", "OpenAI", "exact", 100.0), (2, "Open AI", "OpenAI", "alias", 100.0), (3, "DeepMind", "Google DeepMind", "alias", 100.0), (4, "Nova Labs", "Nova Labs", "unmatched-new", 0.0),
    (5, "nova labs", "Nova Labs", "exact", 100.0), (6, "", "", "unmatched-new", 0.0), (7, "Hugging Face", "Hugging Face", "exact", 100.0), (8, "Nóva  Labs LLC", "Nova Labs", "exact", 100.0), (9, " ?! ", "?!", "unmatched-new", 0.0),
]
case("entity_exact_alias", [r[:2] for r in NAMES], "seq bigint, name string", NAMES, "seq, raw_name, canonical_name, method, confidence", lambda df: resolve.resolve(df, "name", "seq"))

FUZZY = [
    (1, "Labs Nova Robotics", "Labs Nova Robotics", "unmatched-new", 0.0), (2, "Nova Robotics Labs", "Labs Nova Robotics", "fuzzy", 100.0), (3, "Anthropics", "Anthropic", "fuzzy", _ratio("anthropics", "anthropic")),
    (4, "Zebra", "Zebra", "unmatched-new", 0.0), (5, "Nova Robotics Labs", "Labs Nova Robotics", "fuzzy", 100.0), (6, "Zebras", "Zebra", "fuzzy", _ratio("zebra", "zebras")), (7, "Quux Metal", "Quux Metal", "unmatched-new", 0.0),
]
case("entity_fuzzy", [r[:2] for r in FUZZY], "seq bigint, name string", FUZZY, "seq, raw_name, canonical_name, method, confidence",
     lambda df: resolve.resolve(df, "name", "seq", {"Anthropic": ["Anthropic PBC"], "OpenAI": []}, 90))

REVIEW = [(1, "Anthropics"), (2, "Zebra"), (3, "Zebras"), (4, "Quux Metal")]
case("entity_review_band", REVIEW, "seq bigint, name string", [("Anthropics", "Anthropic", _ratio("anthropics", "anthropic")), ("Zebras", "Zebra", _ratio("zebra", "zebras"))], "raw_name, candidate, confidence",
     lambda df: resolve.review_candidates(df, "name", "seq", {"Anthropic": []}))

ENTRIES = [(1, "A", "A", "exact", 100.0), (2, "A", "A", "exact", 90.0), (3, "A", "A", "alias", 100.0), (4, "B", "B", "exact", 100.0), (5, "C", "C", "exact", 1.0)]
STORED = [("B", "B", "exact")]


@example(f"""SELECT raw_name, canonical_name, method, arg_min(confidence, seq) AS confidence FROM {values(ENTRIES, 'seq, raw_name, canonical_name, method, confidence')}
WHERE (raw_name, canonical_name, method) NOT IN (SELECT (r, c, m) FROM {values(STORED, 'r, c, m')}) GROUP BY 1, 2, 3""")
def mapping_log_dedup(spark, sf):
    entries = inline(spark, ENTRIES, "seq int, raw_name string, canonical_name string, method string, confidence double")
    return resolve.mapping_log(entries, "seq", inline(spark, STORED, "raw_name string, canonical_name string, method string")).drop("seq")


ANSWERS = [
    (1, 0, 0, 500, None), (1, 0, 1, 200, {"a": "x"}), (2, 0, 0, 200, {"a": ""}), (2, 0, 1, 200, {"a": "never asked"}), (2, 1, 0, 200, {"a": "y"}), (3, 0, 0, 200, {"a": ""}), (3, 1, 0, 500, None), (4, 0, 0, 200, {}), (4, 0, 1, 429, None),
]
case("provider_fallback", ANSWERS, "row_id int, chunk int, tier int, status int, data map<string,string>", [(1, 0, 1, "x"), (2, 1, 0, "y"), (3, None, None, None), (4, None, None, None)], "row_id, chunk, tier, a",
     lambda df: candidates.provider_fallback(df, keys=["a"]).select("row_id", "chunk", "tier", F.try_element_at("data", F.lit("a")).alias("a")))

PAGES = [(1, 0, 598, None), (1, 1, 200, "free plan"), (1, 2, 200, "$5/mo"), (2, 0, 200, "nothing"), (2, 1, 404, None), (3, 0, 200, "contact sales")]


@example(f"""SELECT site, arg_min(ordinal, ordinal) AS ordinal, arg_min(m, ordinal) AS model FROM (SELECT *, CASE WHEN contains(page, 'free plan') THEN 'FREE' WHEN contains(page, '$') THEN 'PAID' WHEN contains(page, 'contact sales') THEN 'ENTERPRISE' END AS m
FROM {values(PAGES, 'site, ordinal, status, page')}) WHERE m IS NOT NULL AND status = 200 GROUP BY site""")
def first_successful_candidate(spark, sf):
    df = inline(spark, PAGES, "site int, ordinal int, status int, page string").withColumn("model", rules.pricing_model(F.col("page")))
    return candidates.first_success(df, ["site"], "ordinal", (F.col("status") == 200) & F.col("model").isNotNull()).select("site", "ordinal", "model")


COMPANIES = json.dumps([
    {"name": " Acme ", "website": "", "url": "https://d.com/acme", "team_size": 12.0, "status": "Active", "tags": ["AI"]}, {"name": "", "url": "x"},
    {"name": "Beta", "website": "https://b.com", "slug": "beta", "team_size": 0, "industries": ["B2B"]}, {"name": "Gamma", "team_size": None, "url": "u"},
])
case("startup_projection", [(COMPANIES,), ("null",), ("{bad",)], "body string",
     [(0, "Acme", None, "https://d.com/acme", 12), (2, "Beta", "https://b.com", "https://example.com/companies/beta", None), (3, "Gamma", None, "u", None)], "seq, name, website, page_url, team_size",
     lambda df: payloads.companies(df).select("seq", "name", "website", "page_url", "team_size"))

JOBS = json.dumps([{"legal": "notice"}, {"position": "ML Engineer", "company": "Acme", "tags": ["ai"], "description": "<p>Do  it</p>", "date": "2026-09-04T10:00:00Z", "url": "https://j.com/1"},
                   {"position": "Cook", "company": "", "tags": ["email"], "description": "", "date": "whenever", "epoch": 1788516000, "apply_url": "https://j.com/2"}, {"position": "Cook", "tags": []}])
case("jobs_json_parse", [(JOBS,)], "body string", [(1, "Acme", "ML Engineer", "2026-09-04 10:00:00", True, "https://j.com/1", "Do  it"), (2, "Unknown", "Cook", "2026-09-04 10:00:00", True, "https://j.com/2", "")],
     "seq, company, title, at, is_remote, url, description",
     lambda df: payloads.remote_jobs(df, _now(), ["ai"]).select("seq", "company", "title", _stamp(F.col("date")).alias("at"), "is_remote", "url", "description"))

BOARD = json.dumps({"jobs": [{"title": "Engineer", "content": "&lt;p&gt;Build &amp;amp; run AI&lt;/p&gt;", "location": {"name": "Remote - EU"}, "first_published": "2026-09-03T12:00:00Z", "absolute_url": "https://b.com/1"},
                             {"title": "AI Lead", "content": "x", "location": {"name": "Paris"}, "first_published": "soon", "updated_at": "2026-09-02T12:00:00Z", "company_name": "Acme", "absolute_url": "https://b.com/2"}]})
case("jobs_board_parse", [("acme", BOARD)], "token string, body string", [(0, "acme", "Engineer", "2026-09-03 12:00:00", True, "Build & run AI"), (1, "Acme", "AI Lead", "2026-09-02 12:00:00", False, "x")],
     "seq, company, title, at, is_remote, description",
     lambda df: payloads.board_jobs(df, _now(), ["ai"]).select("seq", "company", "title", _stamp(F.col("date")).alias("at"), "is_remote", "description"))

PAPERS = json.dumps([{"title": "Big  Model", "paper": {"id": "2609.1", "authors": [{"name": "A B"}, {"name": " "}], "summary": "See https://github.com/a/b.", "publishedAt": "2026-09-01T00:00:00Z"}},
                     {"paper": {"id": "", "publishedAt": "2026-09-01T00:00:00Z"}}, {"paper": {"id": "2609.2", "title": "Other", "authors": [], "publishedAt": "never"}}])
case("papers_json_parse", [(PAPERS,)], "body string", [(0, "2609.1", "Big Model", "A B", "2026-09-01 00:00:00", "https://github.com/a/b")], "seq, paper_id, title, authors, at, github_url",
     lambda df: payloads.daily_papers(df, _now()).select("seq", "paper_id", "title", F.array_join("authors", ", ").alias("authors"), _stamp(F.col("published_date")).alias("at"), "github_url"))

ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://p.org/abs/2609.01v2</id><title>A
  Study</title><summary>Code: https://github.com/a/b</summary><published>2026-09-01T00:00:00Z</published><author><name>A B</name></author><author><name>C D</name></author>
<link href="http://p.org/abs/2609.01v2" rel="alternate"/><link title="pdf" href="http://p.org/pdf/2609.01v2" type="application/pdf"/><category term="cs.AI"/></entry>
<entry><id>http://p.org/abs/2609.02v1</id><title>No date</title><published>soon</published><author><name>E</name></author></entry></feed>"""
case("atom_parse", [(ATOM,)], "body string", [(0, "2609.01", "A Study", "A B, C D", "http://p.org/pdf/2609.01v2", "2026-09-01 00:00:00", "https://github.com/a/b")], "seq, paper_id, title, authors, pdf_url, at, github_url",
     lambda df: payloads.atom_papers(df, _now()).select("seq", "paper_id", "title", F.array_join("authors", ", ").alias("authors"), "pdf_url", _stamp(F.col("published_date")).alias("at"), "github_url"))

RSS = """<rss version="2.0"><channel><title>Feed</title><item><title>AI  news</title><link>https://n.com/1</link><description>&lt;p&gt;Big &lt;b&gt;day&lt;/b&gt;&lt;/p&gt;</description><pubDate>Fri, 04 Sep 2026 10:00:00 GMT</pubDate></item>
<item><title>Sports</title><link>https://n.com/2</link><description>Ball</description><pubDate>Fri, 04 Sep 2026 10:00:00 GMT</pubDate></item><item><title> </title><link>https://n.com/3</link><description>ai</description></item></channel></rss>"""
case("rss_parse", [("Feed", RSS)], "source_name string, body string", [("Feed", 0, "AI news", "https://n.com/1", "2026-09-04 10:00:00", "Big\n\nday")], "source_name, seq, headline, url, at, summary",
     lambda df: payloads.news_items(df, _now(), ["ai"]).select("source_name", "seq", "headline", "url", _stamp(F.col("date")).alias("at"), "summary"))

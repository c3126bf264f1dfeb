"""Chunks, cascades, pages, stores and streams against plain Python."""

import json

from pyspark.sql import functions as F

from sluice.functions.html import clean_html, main_text
from sluice.functions.salvage import salvage
from sluice.functions.text import html_unescape
from sluice.operators import candidates, chunk, dedup
from sluice.operators.manifest import Tables
from sluice.plans import verticals
from sluice.sinks import tabs
from sluice.sources import http, stars
from sluice.streaming import incremental


def tokens(t):
    return max(1, (len(t) + 3) // 4)


def packed(text, budget, overlap):
    ps = [p.strip() for p in text.split("\n\n") if p.strip()]
    if not ps:
        return []
    lead, room = ps[0], max(budget - tokens(ps[0]), 500)
    out, body, n = [], [], 0
    for p in ps[1:]:
        if body and n + tokens(p) > room:
            out.append(lead + "\n\n" + "\n\n".join(body))
            tail = out[-1][-4 * overlap :] if overlap else ""
            body, n = ([tail], tokens(tail)) if tail else ([], 0)
        body.append(p)
        n += tokens(p)
    if body:
        out.append(lead + "\n\n" + "\n\n".join(body))
    return out or [lead]


def test_chunks(spark):
    texts = ["", "one", "a\n\nb", "\n\n".join(f"paragraph {i} " * 20 for i in range(60)), "lead\n\n" + "x" * 9000 + "\n\nend", " \n\n ", "x" * 5000 + "\n\ny"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    for budget, overlap in ((700, 50), (700, 0), (3500, 200)):
        got = {r["id"]: r["c"] for r in df.select("id", chunk.chunk_text(F.col("t"), budget, overlap).alias("c")).collect()}
        for i, t in enumerate(texts):
            assert [c["text"] for c in got[i]] == packed(t, budget, overlap)
            assert [c["index"] for c in got[i]] == list(range(len(got[i]))) and [c["is_lead"] for c in got[i]] == [k == 0 for k in range(len(got[i]))]


def test_main_text():
    page = "<body><nav>menu</nav><div class='sidebar-x'>no<p>no</p></div><article><h1>T</h1><p>a <b>bold</b> word<p>next<br>line<script>var x='</p>'</script></article><footer>f</footer></body>"
    assert main_text(page) == "T\n\na\n\nbold\n\nword\n\nnext\n\nline"
    assert main_text("<div>no zones</div>") == "no zones" and main_text("") == ""


BARE = "A &amp; b &amp</h1><p>&ampx; &copy 1 &#38 c&#38;d &lt;i&gt;"


def test_main_text_keeps_bare_entities(spark):
    """The query reads closed entities alone, as its SQL does; the function reads bare ones too by default."""
    df = spark.createDataFrame([(f"<body><article><h1>{BARE}</article></body>",), (None,)], "html string")
    rows = df.select(clean_html(F.col("html"), bare=False).alias("closed"), clean_html(F.col("html")).alias("all")).collect()
    assert [r.closed for r in rows] == ["A & b &amp\n\n&ampx; &copy 1 &#38 c&d <i>", ""]
    assert rows[0].all == "A & b &\n\n&x; © 1 & c&d <i>"


def test_unescape_of_closed_entities(spark):
    df = spark.createDataFrame([(BARE,), ("&amp;lt; &&quot;&nope;&#x41;&#x42",), ("plain",), (None,)], "t string")
    rows = df.select(html_unescape(F.col("t"), bare=False).alias("closed"), html_unescape(F.col("t")).alias("all")).collect()
    assert [r.closed for r in rows] == ["A & b &amp</h1><p>&ampx; &copy 1 &#38 c&d <i>", '&lt; &"&nope;A&#x42', "plain", None]
    assert [r.all for r in rows] == ["A & b &</h1><p>&x; © 1 & c&d <i>", '&lt; &"&nope;AB', "plain", None]


def test_salvage():
    assert salvage('x ```json\n{"a": [1]}\n``` y') == '{"a":[1]}' and salvage("{a") is None and salvage(None) is None


def test_retry():
    calls, waits = [], []

    def call():
        calls.append(1)
        return http.Answer(429, None, {"retry-after": "3"}) if len(calls) < 3 else http.Answer(200, "ok")

    assert http.retry(call, 4, sleep=waits.append) == http.Answer(200, "ok") and waits == [3.0, 3.0]
    assert http.retry(lambda: http.Answer(503), 2, sleep=waits.append).status == 503
    assert http.Answer(429, None, {"Retry-After": "soon"}).asked is None


def test_pages(tmp_path):
    assert list(http.pages(lambda c: ([c], None if c == 3 else (c or 0) + 1))) == [[None], [1], [2], [3]]
    assert list(http.pages(lambda c: ([1], "same"), "same")) == [[1]] and list(http.pages(lambda c: ([1], str(c) + "x"), most=2)) == [[1], [1]]
    items, waits = list(range(10)), []
    fetch = lambda at, n: items[at : at + n]
    assert list(http.offset_pages(fetch, 4, 100, sleep=waits.append)) == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]] and waits == [3.0] * 3
    assert [x for p in http.offset_pages(fetch, 4, 6, sleep=waits.append) for x in p] == [0, 1, 2, 3, 4, 5]
    stop, seen = http.Stop(str(tmp_path / "stop")), []
    for page in http.pages(lambda c: ([c], (c or 0) + 1), stop=stop):
        seen += page
        if len(seen) == 3:
            http.Stop(str(tmp_path / "stop")).trigger()  # another process
    assert len(seen) == 3 and stop.is_set() and list(http.offset_pages(fetch, 4, 6, stop=stop)) == []


def test_stop_on_a_signal():
    import os
    import signal

    before = {s: signal.getsignal(s) for s in (signal.SIGINT, signal.SIGTERM)}
    try:
        stop = http.Stop().install()
        assert not stop.is_set()
        os.kill(os.getpid(), signal.SIGTERM)
        assert stop.is_set()
    finally:
        for s, h in before.items():
            signal.signal(s, h)


def test_http_source_keeps_failures(spark):
    spark.dataSource.register(http.HttpSource)
    rows = spark.read.format("sluice_http").option("urls", json.dumps(["http://127.0.0.1:9/x"])).option("retries", 0).load().collect()
    assert [(r["status"], r["body"]) for r in rows] == [(599, None)]


def test_fetch_keeps_headers_and_failures(spark):
    def ask(url):
        if url.endswith("boom"):
            raise ValueError("boom")
        return http.Answer(200, url.upper(), {"X-Left": "5"})

    urls = [f"https://h{k % 3}.com/{k}" for k in range(40)] + ["https://h.com/boom", "https://h0.com/0", None, "no address"]
    got = {r["url"]: r for r in http.fetch(spark.createDataFrame([(u,) for u in urls], "url string"), ask=ask).collect()}
    assert set(got) == {u for u in urls if u} and got["https://h0.com/0"]["headers"] == {"X-Left": "5"} and got["https://h0.com/0"]["body"] == "HTTPS://H0.COM/0"
    assert (got["https://h.com/boom"]["status"], got["https://h.com/boom"]["error"]) == (599, "boom")


def test_isolated_calls(spark):
    df = spark.createDataFrame([(k, k % 3) for k in range(30)], "id int, n int").coalesce(1)

    def work(row):
        return {"share": 6 // row["n"], "name": f"r{row['id']}"}

    rows = candidates.isolate(df, work, "share int, name string").collect()
    assert [r["id"] for r in rows] == list(range(30))  # in order, failures in their places
    assert all((r["share"], r["name"], r["error"]) == ((6 // r["n"], f"r{r['id']}", None) if r["n"] else (None, None, "ZeroDivisionError: integer division or modulo by zero")) for r in rows)
    assert {r["error"] for r in candidates.isolate(df, work, "share int", stop=lambda: True).collect()} == {"stopped"}


PAGES = {
    "https://free.com": (200, "<p>Our free plan</p>"), "https://linked.com": (200, "<a href='/our-pricing'>Prices</a>"), "https://linked.com/our-pricing": (200, "<p>$5/mo</p>"),
    "https://guess.com": (200, "<p>Hello</p>"), "https://guess.com/plans": (200, "contact sales"), "https://guess.com/price": (200, "free forever"),
    "https://broken.com": (599, None), "http://broken.com": (200, "free tier"), "https://gone.com": (404, None), "http://gone.com": (200, "free tier"), "https://quiet.com": (200, "nothing"), "https://dead.com": (598, None),
    "https://slow.com": (200, "x"), "https://slow.com/pricing": (598, None), "http://slow.com/pricing": (200, "$9 per user"),
}


def test_probe_pricing(spark):
    pages = spark.createDataFrame([(u, s, b) for u, (s, b) in PAGES.items()], "url string, status int, body string")
    asked = []

    def get(df):
        asked.append({r["url"] for r in df.select("url").collect()})
        return df.select("url").join(pages, "url", "left").fillna(404, ["status"])

    names = ["free", "linked", "guess", "broken", "gone", "quiet", "dead", "slow"]
    sites = spark.createDataFrame([(n, f"https://{n}.com") for n in names], "site string, website string")
    got = {r["site"]: r for r in candidates.probe_pricing(sites, get).collect()}
    assert {k: (r["pricing_model"], r["fetched_url"]) for k, r in got.items()} == {
        "free": ("FREE", "https://free.com"), "linked": ("PAID", "https://linked.com/our-pricing"), "guess": ("ENTERPRISE", "https://guess.com/plans"),
        "broken": ("FREE", "http://broken.com"), "slow": ("PAID", "http://slow.com/pricing"),
    }
    assert got["free"]["evidence"].strip() == "Our free plan"
    every = set().union(*asked)
    assert "http://gone.com" not in every and "https://linked.com/plans" not in every and "https://free.com/pricing" not in every


def test_stars(spark, tmp_path):
    asked = []

    def answers(slug):
        out = {"o/a": http.Answer(200, '{"stargazers_count": 7}', {"X-RateLimit-Remaining": "9"}), "o/b": http.Answer(404), "o/c": http.Answer(500), "o/d": http.Answer(200, '{"stargazers_count": 9}', {"x-ratelimit-remaining": "0"})}
        return out.get(slug, http.Answer(403))

    def ask(slug):
        asked.append(slug)
        return answers(slug)

    assert list(stars.look_up(iter(["o/a", "o/b", "o/c", "o/d", "o/e"]), ask)) == [("o/a", 7), ("o/b", None), ("o/d", 9)] and asked[-1] == "o/d"
    assert list(stars.look_up(iter(["o/x", "o/a"]), ask)) == []
    rows = spark.createDataFrame([(k, f"https://github.com/o/{x}") for k, x in enumerate("abcde")] + [(9, "https://example.com/x"), (10, None)], "seq int, github_url string")
    path = str(tmp_path / "stars")
    first = {r["slug"]: r["github_stars"] for r in stars.with_stars(rows, "github_url", "seq", path, answers, 2, 1).collect()}
    assert first == {"o/a": 7, "o/b": None, "o/c": None, "o/d": None, "o/e": None, None: None}
    again = stars.with_stars(rows, "github_url", "seq", path, lambda s: http.Answer(200, '{"stargazers_count": 1}'), 10, 2)
    assert {r["slug"]: r["github_stars"] for r in again.collect()} == {"o/a": 7, "o/b": None, "o/c": 1, "o/d": 1, "o/e": 1, None: None}


def test_store_twice_and_stream(spark, tmp_path):
    now = F.lit("2026-09-04 12:00:00").cast("timestamp")
    rows = [(0, "Acme", "https://d.com/1", 5), (1, "acme", "https://d.com/2", 5), (2, "Bad", "nowhere", 1)]
    df = spark.createDataFrame(rows, "seq bigint, name string, page_url string, team_size int")
    ctx = verticals.RunContext(spark, now, str(tmp_path / "out"))
    key = F.lower(F.trim("canonical_name"))
    assert verticals.store(ctx, "startups", verticals.startups(ctx, df), key) == 1
    assert verticals.store(ctx, "startups", verticals.startups(ctx, df, verticals.seen_items(ctx, "startups")), key) == 0
    assert {r["raw_name"] for r in Tables(spark, ctx.root).read("mapping").collect()} == {"Acme", "Bad"}

    df.coalesce(1).write.json(str(tmp_path / "in"))
    ctx2 = verticals.RunContext(spark, now, str(tmp_path / "out2"))
    for _ in range(2):  # the second run finds nothing new
        stream = incremental.read_files(spark, str(tmp_path / "in"), "seq bigint, name string, page_url string, team_size int")
        incremental.run_stream(stream, verticals.startups, ctx2, "startups", str(tmp_path / "cp"), key).awaitTermination(120)
    assert Tables(spark, ctx2.root).read("startups").count() == 1


def test_verticals_with_answers_pins_and_pools(spark):
    now = F.lit("2026-09-04 12:00:00").cast("timestamp")
    ctx = verticals.RunContext(spark, now, "")
    rows = spark.createDataFrame([(0, "Acme", "https://a.com", "free plan"), (1, "Beta", "https://b.com", "$5/mo"), (2, "Gamma", "https://c.com", "nothing")], "seq bigint, name string, website string, page_text string")
    answers = spark.createDataFrame([("acme", "freemium"), ("beta", "cheap"), ("gamma", "PAID")], "answer_key string, answer string")
    out = verticals.products(ctx, rows, answers=answers)
    assert {r["canonical_name"]: r["pricing_model"] for r in out.accepted.collect()} == {"Acme": "FREEMIUM", "Beta": "PAID"}
    assert verticals.counters(ctx, rows, out) == {"records_discovered": 3, "accepted": 2, "validation_failures": 1, "freshness_failures": 0, "duplicates_removed": 0}

    jobs = spark.createDataFrame([(0, "Acme", "Cook", "2026-09-04 10:00:00", True, None, ""), (1, "Acme", "Cook", "2026-08-04 10:00:00", True, "https://j.com/1", "")], "seq bigint, company string, title string, at string, is_remote boolean, url string, description string").withColumn("date", F.col("at").cast("timestamp")).drop("at")
    out = verticals.jobs(ctx, jobs, answers=spark.createDataFrame([("Acme:Cook", "Operations")], "answer_key string, answer string"))
    assert [r["role_family"] for r in out.accepted.collect()] == ["Operations"] and verticals.counters(ctx, jobs, out)["freshness_failures"] == 1

    news = spark.createDataFrame([(0, "F", "H", "https://n.com/1", "2026-09-04 10:00:00", "s", "NEWS"), (1, "F", "I", "https://n.com/2", "2026-09-04 10:00:00", "s", "JOB")], "seq int, source_name string, headline string, url string, at string, summary string, record_type string").withColumn("date", F.col("at").cast("timestamp")).drop("at")
    out = verticals.news(ctx, news)
    assert [r["seq"] for r in out.accepted.collect()] == [0] and [(r["seq"], r["reason"]) for r in out.rejected.collect()] == [(1, "record_type: not NEWS")]

    pages = spark.createDataFrame([("https://a.com", 200, "free plan"), ("https://x.com", 200, "$5/mo")], "url string, status int, body string")
    get = lambda df: df.select("url").join(pages, "url", "left").fillna(404, ["status"])
    pool = lambda rows: spark.createDataFrame(rows, "seq bigint, name string, website string")
    first, others = pool([(0, "Acme", "https://a.com"), (1, "Dead", "https://d.com")]), pool([(10, "acme ", "https://a.com"), (11, "Xeno", "https://x.com"), (12, "None", "")])
    assert {r["canonical_name"] for r in verticals.probed_products(ctx, first, get, 1, others).accepted.collect()} == {"Acme"}
    assert {(r["canonical_name"], r["pricing_model"], r["source_url"]) for r in verticals.probed_products(ctx, first, get, 5, others).accepted.collect()} == {("Acme", "FREE", "https://a.com/"), ("Xeno", "PAID", "https://x.com/")}
    assert verticals.startups(ctx, spark.createDataFrame([(k, f"Name{k} Qx{k * 7919}", "https://d.com/1", 5) for k in range(60)], "seq bigint, name string, page_url string, team_size int"), target=1).accepted.count() == 51


def test_products_told_apart_by_numbers(spark, tmp_path):
    """The query's products are those of its SQL, one a number; by similarity alone the later is the earlier with a letter more."""
    rows = spark.createDataFrame([(1, "Small Widget 1005", "https://a.com", "free forever"), (2, "Small Widget 10305", "https://b.com", "free forever")], "seq int, name string, website string, page_text string")
    for numbers, second in ((True, "Small Widget 10305"), (False, "Small Widget 1005")):
        ctx = verticals.RunContext(spark, F.lit("2024-01-31").cast("timestamp"), str(tmp_path), numbers=numbers)
        got = verticals.products(ctx, rows).accepted.orderBy("seq").collect()
        assert [r.canonical_name for r in got] == ["Small Widget 1005", second]


def test_tabs(spark, tmp_path):
    df = spark.createDataFrame([(1, None, ["a", "b"]), (2, 'q"x', [])], "id int, s string, l array<string>")
    assert [list(r) for r in tabs.stringify(df, ["id", "s", "l", "none"]).orderBy("id").collect()] == [["1", "", "a, b", ""], ["2", 'q"x', "", ""]]
    assert not tabs.write_csv(df.where("false"), ["id"], str(tmp_path / "e")) and tabs.write_csv(df, ["id", "s"], str(tmp_path / "c"))
    sink = tabs.MemorySink()
    tabs.push({"t": (["id"], df)}, sink)
    assert sorted(sink.tabs["t"][1:]) == [["1"], ["2"]]
    tabs.write_workbook({"t": (["id", "s"], [["1", "<&>"]]), "empty": (["x"], [])}, str(tmp_path / "w.xlsx"), {"t": [12, 20]})
    import zipfile

    assert len(zipfile.ZipFile(tmp_path / "w.xlsx").namelist()) == 6


def test_edge_tables(spark):
    empty = spark.createDataFrame([], "id bigint, name string")
    assert dedup.first_wins(empty, "name", ["id"]).count() == 0
    repeated = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, None)], "id bigint, name string")
    assert sorted((r["id"], r["name"]) for r in dedup.first_wins(repeated, "name", ["id"]).collect()) == [(1, "a"), (2, None)]


def test_streams(spark, tmp_path):
    """Repeated keys within the watermark count once; counts by window."""
    rows = [("a", "x", "2026-09-04 10:01:00"), ("a", "x", "2026-09-04 10:02:00"), ("b", "x", "2026-09-04 10:59:00"), ("c", "y", "2026-09-04 11:30:00")]
    spark.createDataFrame(rows, "id string, kind string, at string").coalesce(1).write.json(str(tmp_path / "in"))
    read = lambda: incremental.read_files(spark, str(tmp_path / "in"), "id string, kind string, at timestamp")
    for name, df, mode in (("first", incremental.bounded_dedup(read(), ["id"], "at"), "append"), ("counts", incremental.windowed_counts(read(), "at", "kind"), "complete")):
        df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination(120)
    assert sorted(r["id"] for r in spark.table("first").collect()) == ["a", "b", "c"]
    assert sorted((str(r["start"]), r["kind"], r["n"]) for r in spark.table("counts").collect()) == [("2026-09-04 10:00:00", "x", 3), ("2026-09-04 11:00:00", "y", 1)]


def test_a_quota_over_tied_places(spark):
    from sluice.operators import candidates

    rows = spark.createDataFrame([(k, 7, False) for k in (5, 3, 9, 1, 8)] + [(2, 1, True), (4, 3, False)], "k int, place int, is_cached boolean").repartition(5)
    assert [tuple(r) for r in candidates.misses(rows, "k", "place", 3).collect()] == [(4, 3), (1, 7), (3, 7)]


def test_papers_by_category(spark):
    """Quotas, pages, the stop at the target and the second pool, against the described loop."""
    import math

    now = F.lit("2026-09-04 12:00:00").cast("timestamp")
    ctx = verticals.RunContext(spark, now, "")
    columns = "seq long, category string, paper_id string, title string, paper_url string"
    pool = [(k, "abcx"[k % 4], f"p{k // 2 if k % 3 else k}", " " if k % 7 == 0 else f"t{k}", f"https://p.org/{k}") for k in range(90)]
    other = [(k, None, f"p{k}", f"t{k}", f"https://p.org/{k}") for k in range(5, 60, 2)]
    more = lambda rows: spark.createDataFrame(rows, columns).withColumns({"authors": F.array(F.lit("A")), "github_url": F.lit(None).cast("string"), "summary": F.lit(""), "published_date": now})
    for target, size in ((12, 4), (60, 5), (3, 1)):
        quota, seen, got = math.ceil(target * 1.15 / 3), set(), []
        for c in "cab":
            rows, at = [r for r in pool if r[1] == c][:quota], 0
            while at < len(rows) and len(got) < target:
                for r in rows[at : at + size]:
                    if r[2] not in seen and r[3].strip():
                        got.append(r[0])
                    seen.add(r[2])
                at += size
        ids = {r[2] for r in pool if r[0] in got}
        for r in other:
            if len(got) < target and r[2] not in ids:
                got.append(r[0])
        out = verticals.papers_by_category(ctx, more(pool), more(other), target, ["c", "a", "b"], size)
        assert sorted(r.seq for r in out.accepted.collect()) == sorted(got)
        out.rejected.collect()

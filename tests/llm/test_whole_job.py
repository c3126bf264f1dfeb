"""Operators on tables where a bounded share of the comparisons, texts or counts would not do."""

import base64
import hashlib
import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import chat, langid, minhash, packing, quality, secrets


def test_near_duplicates_form_letters(spark):
    """Letters of 196 shingles that differ in four words, 20 shingles, are no links, though half of them share each of many buckets; of three words, they are."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    form = [word() for _ in range(200)]
    fields = [[word() for _ in range(4)] for _ in range(1200)]
    want = list(range(len(fields)))
    for a in range(100, 140):
        b = a + 600
        fields[b][a % 4] = fields[a][a % 4]
        want[b] = a
    rows = []
    for i, own in enumerate(fields):
        text = list(form)
        text[20::50] = own
        rows.append((i, " ".join(text)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (196, c) for i, c in enumerate(want)}


def test_language_samples_copies(spark):
    """Thousands of copies of the text of least hash are one training text, and a long text is read to its end."""
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(12)) for _ in range(100)]
    texts.append("long " * 1000 + "the last words")
    hashed = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    least = hashed.orderBy(F.xxhash64("text")).first()["text"]
    docs = hashed.unionByName(spark.createDataFrame([(least, "en")] * 3000, "text string, lang string"))
    got = langid.train_dictionaries(docs)["en"].decode()
    assert got.count(least) == 1 and all(t in got for t in texts[:100]) and "the last words" in got


def test_secret_behind_words(spark, sf):
    """A random token joined to many ordinary words is found; the words alone are not."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ratios = secrets.train_markov(secrets.labelled_samples(docs))
    rng, some = random.Random(2), docs.where("lang = 'en'").orderBy("doc_id").limit(50).collect()
    words = sorted({w for r in some for w in r["text"].split() if re.fullmatch("[a-z]{4,9}", w)})
    rows = []
    for i in range(40):
        name = "_".join(rng.sample(words, 8))
        rows += [(2 * i, name + "_" + base64.b64encode(hashlib.sha256(b"%d" % i).digest()).decode()[:24]), (2 * i + 1, name)]
    got = secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string"), ratios).select("doc_id", F.size(F.filter("_secrets.all", lambda x: x["kind"] == "random"))).collect()
    assert all((n == 1) == (i % 2 == 0) for i, n in got)


def test_clashing_columns(spark, sf):
    """Columns with the operators' own names come through every stage as they are."""
    names = ["_key", "_text_hash", "_host", "_stats", "_secrets", "_k", "_masked", "lang_pred", "score", "_lang", "_lang_pred", "_langaccepted", "node", "component", "piece", "length", "_doc"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    rows = quality.quality_rules(docs, carry=docs.columns).select("doc_id", "_carried").collect()
    assert all(r["_carried"][n] == f"{n}{r['doc_id']}" for r in rows for n in names) and len(rows) == docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        got = out.collect()
        assert out.columns == docs.columns and got and all(r[n] == f"{n}{r['doc_id']}" for r in got for n in names), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).select("doc_id").distinct().count() == docs.count()
    chats = spark.createDataFrame([(1, 0, "user", "hi", "x", 5)], "conv_id long, turn long, role string, text string, kind string, level int")
    assert chat.format_chat(chats).collect()[0]["kind"] == "message"


def test_long_white_space(spark):
    """Ids of a text with two million white-space characters are the library's."""
    import public_tokenizers as P
    from tokenizers import Tokenizer

    texts = ["a" + " \n" * 1_000_000 + "b", " " * 2_000_000]
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    totals = {r["doc_id"]: r["n"] for r in packing.pack_documents(got, P.path("byte_bpe_50k.json")).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert totals == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}


def test_secrets_of_long_texts(spark, sf):
    """Thousands of spans in one text, and a run of a million characters, in time that does not grow with the square."""
    ratios = secrets.train_markov(secrets.labelled_samples(spark.read.parquet(f"{sf}/documents.parquet")))
    keys = [hashlib.md5(b"%d" % k).hexdigest() for k in range(8000)]
    rows = [(1, " é ".join(keys)), (2, "QmFz" * 250_000)]
    found = secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string"), ratios)
    got = {r["doc_id"]: r for r in found.select("doc_id", F.col("_secrets.base").alias("b"), secrets.redacted(F.col("text"), F.col("_secrets.base")).alias("t")).collect()}
    assert [(x["s"], x["e"]) for x in got[1]["b"]] == [(35 * k, 35 * k + 32) for k in range(8000)] and got[1]["t"] == " é ".join(["[SECRET]"] * 8000) and got[2]["b"] == []

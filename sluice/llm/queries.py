"""The queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import bpe, chat, idfile, langid, lm, media, minhash, packing, pieces, quality, secrets, trie, variants
from sluice.llm.common import crc_mod, read_table


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(read_table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("_secrets")
    return secrets.scan_secrets(read_table(spark, sf_dir, "documents")).select(
        "doc_id", s["n_assign"].alias("n_assign"), s["n_access"].alias("n_access"), s["n_hex"].alias("n_hex"),
        F.sha2(secrets.in_order(s["base"]), 256).alias("base_sha256"), secrets.in_order(s["all"]).alias("spans"),
    )


def op4_media_sniffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_texts(read_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_table(spark, sf_dir, "documents"))


def op6_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's conversations hold no tool calls, so turns are taken as calls and results by the rule of calls_of_turns."""
    return chat.format_chat(chat.calls_of_turns(read_table(spark, sf_dir, "conversations")), chat.ASK)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out")
    return langid.identify(docs.select("doc_id", "text", held), langid.train_dictionaries(langid.training_rows(docs))).drop("text")


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), percent=85)


def op10_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfile.write_and_read(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(read_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_lm_scoring, op2_best_fit_packing, op3_secret_scan, op4_media_sniffing, op5_quality_rules, op6_tool_call_linking,
        op7_language_id, op8_bpe_codec, op9_minhash_dedup, op10_token_id_files,
        op11_piece_codec, op12_spelling_variants, op13_prefix_trie,
    )
}

#: crc32 of a text as a macro of common table expressions: its table, and the checksum of column {0} as an expression.
_CRC_TABLE = """crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM (
  SELECT i, list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(0, 256) AS r(i)))"""
_BYTES = "list_transform(range(0, octet_length(encode({0}))), lambda i: CAST('0x' || substr(hex(encode({0})), 2 * i + 1, 2) AS BIGINT))"
_CRC = "xor(list_reduce(" + _BYTES + ", lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"

SQL: dict[str, str] = {
    "op13_prefix_trie": f"""
WITH RECURSIVE {_CRC_TABLE},
t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
  PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, n, CAST(c AS VARCHAR) AS k FROM (SELECT c, count(*) AS n FROM t GROUP BY c)),
heads AS (SELECT c, n, {_CRC.format("k")} % 6 AS h FROM ids, crc_table),
taken AS (SELECT a.c, a.c - a.c % 100 AS base, a.h, least(a.h, coalesce(b.n, 0)) AS k FROM heads a LEFT JOIN ids b ON b.c = a.c - a.c % 100),
made AS (
  SELECT taken.c, pos AS d, role, text FROM taken JOIN t ON t.c = taken.base AND t.pos <= taken.k
  UNION ALL SELECT taken.c, pos - h + k, role, text FROM taken JOIN t ON t.c = taken.c AND t.pos > taken.h
),
whole AS (SELECT ids.c, coalesce(len(path), 0) AS n, coalesce(path, []) AS path FROM ids LEFT JOIN (SELECT c, list(md5(role || chr(1) || text) ORDER BY d) AS path FROM made GROUP BY c) p ON p.c = ids.c),
steps AS (SELECT c, n, d, array_to_string(path[1:d], ',') AS node, array_to_string(path[1:d - 1], ',') AS above FROM whole, unnest(range(0, n + 1)) AS r(d)),
chars AS (SELECT steps.node, max(length(made.text)) AS chars FROM steps JOIN made ON made.c = steps.c AND made.d = steps.d GROUP BY ALL),
nodes AS (SELECT d, node, any_value(above) AS above, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = n), '')) AS ends_sha256 FROM steps GROUP BY d, node),
worth AS (SELECT nodes.*, (n_convs - 1) * coalesce(chars, 0) AS own, NOT EXISTS (SELECT 1 FROM nodes x WHERE x.d = nodes.d + 1 AND x.above = nodes.node) AS leaf FROM nodes LEFT JOIN chars USING (node)),
up(d, node, top_d, top, own, leaf) AS (
  SELECT d, node, d, node, own, leaf FROM worth
  UNION ALL SELECT up.d, up.node, up.top_d - 1, worth.above, up.own, up.leaf FROM up JOIN worth ON worth.d = up.top_d AND worth.node = up.top WHERE up.top_d > 0
),
sums AS (SELECT top_d AS d, top AS node, sum(own) AS saved, count(*) FILTER (WHERE leaf) AS leaves, count(*) FILTER (WHERE d = top_d + 1) AS children FROM up GROUP BY ALL)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, s.children AS n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.d = n.d AND s.node = n.node LEFT JOIN nodes p ON p.d = n.d - 1 AND p.node = n.above
""",
    "op12_spelling_variants": f"""
WITH RECURSIVE {_CRC_TABLE},
found AS (SELECT doc_id, translate(u.run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS u(run)),
runs AS (SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS k, count(*) AS n FROM found WHERE length(run) >= 6 GROUP BY ALL),
summed AS (SELECT run, n, {_CRC.format("k")} AS h FROM runs, crc_table),
spoiled AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, n FROM summed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spoiled WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS r(p)),
pairs AS (
  SELECT a.word AS a, b.word AS b, a.n AS na, b.n AS nb FROM less a JOIN less b ON a.p = b.p AND a.rest = b.rest AND length(a.word) = length(b.word) AND a.word < b.word
  UNION SELECT a.word, b.word, a.n, b.n FROM words a JOIN less b ON a.word = b.rest
),
near AS (SELECT a AS word, b AS near, nb AS n FROM pairs UNION ALL SELECT b, a, na FROM pairs),
best AS (SELECT word, near, n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS place FROM near),
forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.n >= 5 * w.n THEN b.near END AS form, CASE WHEN b.n >= 5 * w.n THEN b.n END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word AND b.place = 1),
path(word, root) AS (SELECT word, word FROM words UNION ALL SELECT path.word, forms.form FROM path JOIN forms ON path.root = forms.word WHERE forms.form IS NOT NULL)
SELECT forms.word, forms.form, path.root, forms.n, CAST(forms.n_near AS BIGINT) AS n_near, forms.form_n
FROM forms JOIN path ON path.word = forms.word JOIN forms e ON e.word = path.root AND e.form IS NULL
""",
    "op5_quality_rules": r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM w, unnest(range(1, len(ws) - 1)) AS r(i)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM rep, unnest([i, i + 1, i + 2]) AS u(p) GROUP BY doc_id),
raw AS (SELECT doc_id, source, t, line FROM d, unnest(string_split(t, chr(10))) AS u(line) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM raw GROUP BY doc_id),
lines AS (SELECT doc_id, source, t, trim(lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')))) AS l FROM raw),
hosts AS (SELECT source, count(DISTINCT t) AS n FROM lines GROUP BY source),
freq AS (SELECT source, l FROM lines GROUP BY source, l HAVING count(DISTINCT t) > 10),
often AS (SELECT l.source, l.l FROM (SELECT source, l, count(DISTINCT t) AS n FROM lines GROUP BY source, l) l JOIN hosts h USING (source) SEMI JOIN freq f ON f.source = l.source AND f.l = l.l WHERE l.n > 0.01 * h.n OR l.n > 1000),
gone AS (SELECT lines.doc_id, count(*) AS n, sum(length(replace(lines.l, ' ', ''))) AS c FROM lines JOIN often ON lines.source = often.source AND lines.l = often.l GROUP BY lines.doc_id),
s AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_lines, coalesce(gone.c, 0) AS gone_chars
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_lines,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND word_chars - gone_chars >= 0.3 * word_chars AS kept
FROM s
""",
    "op9_minhash_dedup": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS r(i) WHERE len(ws) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
meet AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM meet JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.x, edge.b FROM reach JOIN edge ON reach.y = edge.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.c AS component_id, d.doc_id = r.c AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) r ON r.x = d.doc_id
""",
}

"""Registered queries of the training-data operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayguard.llm import (chat_examples, fixity, licences, packing, pair_maxscore, parity_join, pii, prefix_trie,
                          repetition, sampled_pieces, template_html, topk, toxicity)
from dayguard.llm.common import read_table, spool

TOKENIZERS = "/opt/tokenizers"
REGISTRY: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
WS = r"[^\x20\x09-\x0D]+"


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@register
def op1_sampled_segmentations(spark, sf_dir: str, k: int = 4, seed: int = 7) -> DataFrame:
    """Distinct sampled segmentations of every conversation turn, as digests.

    conv_id, turn, sample (0 = best), n_pieces, ids_crc32, log_prob, inclusion and
    round_trip (the decoded pieces are the text).
    """
    model = f"{TOKENIZERS}/piece_bpe_32k.model"
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    key = F.concat_ws("|", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.coalesce(F.col("turn").cast("string"), F.lit("-")),
                      F.col("text"))
    s = sampled_pieces.encode(turns.withColumn("k", key), F.col("k"), F.col("text"), model, k=k, seed=seed)
    back = F.split("key", r"\|", 3)
    number = lambda i: F.when(back[i] != "-", back[i]).cast("long")
    return s.select(number(0).alias("conv_id"), number(1).alias("turn"), "sample", "n_pieces",
                    sampled_pieces.crc32_of(F.col("ids")).alias("ids_crc32"), "log_prob", "inclusion",
                    (sampled_pieces.decode(F.col("ids"), model) == F.translate(back[2], "▁", " ")).alias("round_trip"))


@register
def op2_norm_bucket_topk(spark, sf_dir: str, k: int = 5) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings").where(topk.usable(F.col("embedding")))
    return topk.search(e.select("vec_id", topk.quantised(F.col("embedding")).alias("v")), F.col("vec_id") % 50 == 0, k)


ORACLES["op2_norm_bucket_topk"] = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
one AS (SELECT vec_id, max(v) AS v FROM good GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CASE WHEN len(q.v) = 0 THEN 0 ELSE list_dot_product(q.v, c.v) END AS score
  FROM one q JOIN one c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""


@register
def op3_pattern_packing(spark, sf_dir: str) -> DataFrame:
    cut = packing.pieces(read_table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")
    return packing.pack(cut)


@register
def op4_fixity_audit(spark, sf_dir: str, per_file: int = 512) -> DataFrame:
    """Audit of two replicas of the pages' archive. The second replica is derived: the first
    byte of every 97th payload is overwritten and every 211th record is gone, so that all
    later ones of its file have moved up."""
    p = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    record = lambda body: fixity.warc_record(F.col("url"), F.col("page_id"), body)
    first = fixity.index(p.select(F.col("page_id").alias("record_id"), record(F.col("html")).alias("bytes")), per_file)
    hurt = F.when(F.col("page_id") % 97 == 13, F.expr("overlay(html placing '\\u0001' from 1 for 1)")).otherwise(F.col("html"))
    second = fixity.index(p.where("page_id IS NULL OR page_id % 211 <> 5").select(
        F.col("page_id").alias("record_id"), record(hurt).alias("bytes")), per_file)
    return fixity.audit(first, second)


ORACLES["op4_fixity_audit"] = """
WITH rec AS (
  SELECT page_id, html, octet_length(encode(coalesce(html, ''))) AS body, coalesce(url, '') AS url FROM pages),
sized AS (
  SELECT page_id, html, coalesce(CAST(floor(page_id / 512.0) AS BIGINT), -1) AS file_id,
         octet_length(encode('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
           || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), '')
           || '>' || chr(13) || chr(10) || 'Content-Length: ' || CAST(body AS VARCHAR))) + 8 + body AS length
  FROM rec),
placed AS (
  SELECT *, CAST(sum(length) OVER (PARTITION BY file_id ORDER BY page_id ROWS UNBOUNDED PRECEDING) - length AS BIGINT) AS "offset"
  FROM sized)
SELECT file_id, "offset", CAST(length AS BIGINT) AS length, page_id AS record_id,
       CASE WHEN page_id % 211 = 5 THEN 'missing' ELSE 'changed' END AS status
FROM placed
WHERE page_id % 211 = 5 OR (page_id % 97 = 13 AND length(html) > 0)
"""


@register
def op5_suffix_repetition(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return repetition.judge(docs).select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def _windows(h: int) -> str:
    """Words (i from 1) inside windows of h words that occur again in their text."""
    return f"""(SELECT DISTINCT k, i + j AS i FROM (
      SELECT k, i, count(*) OVER (PARTITION BY k, win) AS n FROM (
        SELECT k, unnest(range(1, len(w) - {h - 2})) AS i, array_to_string(w[i:i + {h - 1}], chr(10)) AS win FROM t WHERE len(w) >= {h}))
      , range({h}) r(j) WHERE n > 1)"""


ORACLES["op5_suffix_repetition"] = f"""
WITH t AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
rep8 AS (SELECT k, count(*) AS n FROM {_windows(repetition.WINDOW)} GROUP BY k),
cover AS (SELECT k, count(*) AS n FROM {_windows(repetition.MIN_WORDS)} GROUP BY k),
far AS (SELECT DISTINCT k FROM {_windows(repetition.MAX_REPEAT + 1)}),
lines AS (
  SELECT k, count(*) - count(DISTINCT line) AS n
  FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY k),
j AS (
  SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep8.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(cover.n, 0) AS covered, far.k IS NOT NULL AS far
  FROM t LEFT JOIN rep8 USING (k) LEFT JOIN cover USING (k) LEFT JOIN far USING (k) LEFT JOIN lines USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * covered > {repetition.MAX_COVER} * n_words OR far) AS kept
FROM j
"""


@register
def op6_parity_join(spark, sf_dir: str) -> DataFrame:
    members, _ = parity_join.component_join(read_table(spark, sf_dir, "documents"), parity_join.JoinSpec(3, 90, 100))
    return members.select("doc_id", "n_shingles", "component_id")


ORACLES["op6_parity_join"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, md5(s) AS s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
classes AS (
  SELECT doc_id, n, min(doc_id) OVER (PARTITION BY n, fp) AS cls
  FROM (SELECT doc_id, count(*) AS n, md5(string_agg(s, '' ORDER BY s)) AS fp FROM g GROUP BY doc_id)),
freq AS (SELECT s, count(*) AS f FROM g JOIN classes USING (doc_id) WHERE doc_id = cls GROUP BY s),
ranked AS (
  SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY f, s) AS r
  FROM g JOIN classes USING (doc_id) JOIN freq USING (s) WHERE doc_id = cls),
cand AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb
  FROM ranked a JOIN ranked b USING (s)
  WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    AND a.r <= a.n - CAST(ceil(0.9 * a.n - 1e-9) AS BIGINT) + 1 AND b.r <= b.n - CAST(ceil(0.9 * b.n - 1e-9) AS BIGINT) + 1),
links AS (
  SELECT a, b FROM (
    SELECT c.a, c.b, c.na, c.nb, count(*) AS k FROM cand c JOIN g x ON x.doc_id = c.a JOIN g y ON y.doc_id = c.b AND y.s = x.s
    GROUP BY ALL) WHERE 100 * k >= 90 * (na + nb - k)),
sides AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT DISTINCT cls AS a, cls AS b FROM classes
  UNION SELECT reach.a, sides.b FROM reach JOIN sides ON reach.b = sides.a),
comp AS (SELECT a AS cls, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(comp.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN classes USING (doc_id) LEFT JOIN comp USING (cls)
"""


@register
def op7_bilstm_crf_pii(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    base = F.filter("pii", lambda x: x["base"])
    listed = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("pii")).alias("spans"))


def _paths(doc_id) -> F.Column:
    """Where a document lies in the mapped file tree: every tenth, hundredth and thousandth is a LICENSE."""
    part = lambda c, n: F.concat(F.lit(c), F.floor(doc_id / F.lit(n)).cast("long").cast("string"))
    a, b, c = part("/a", 1000), part("/b", 100), part("/c", 10)
    return (F.when(doc_id % 1000 == 0, F.concat(F.col("source"), a, F.lit("/LICENSE")))
            .when(doc_id % 100 == 0, F.concat(F.col("source"), a, b, F.lit("/LICENSE")))
            .when(doc_id % 10 == 0, F.concat(F.col("source"), a, b, c, F.lit("/LICENSE")))
            .otherwise(F.concat(F.col("source"), a, b, c, F.lit("/"), doc_id.cast("string"), F.lit(".txt"))))


@register
def op8_licence_scan(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    files = docs.select(F.col("doc_id").alias("key"), _paths(F.col("doc_id")).alias("path"), "text")
    return licences.scan(files).select(F.col("key").alias("doc_id"), "path", "licence", "cosine", "how", "from_dir")


def _licence_sql() -> str:
    rows = ", ".join("({}, '{}', '{}')".format(i, n, x.replace("'", "''")) for i, (n, x) in enumerate(licences.TEMPLATES))
    speaks = "(?i)licen[sc]e|copyright|spdx|warranty|permission is hereby"
    terms = ("list_transform(list_filter(regexp_split_to_array(lower({0}), '[^a-z0-9.]+'), lambda t: length(replace(t, '.', '')) > 0), "
             "lambda t: regexp_replace(t, '^\\.+|\\.+$', '', 'g'))")
    return f"""
WITH tpl(template, licence, line) AS (VALUES {rows}),
tt AS (SELECT template, licence, term, count(*) AS tf FROM (SELECT template, licence, unnest({terms.format('line')}) AS term FROM tpl) GROUP BY ALL),
vocab AS (SELECT DISTINCT term FROM tt),
files AS (
  SELECT doc_id, text, CASE WHEN doc_id % 1000 = 0 THEN source || '/a' || doc_id // 1000 || '/LICENSE'
    WHEN doc_id % 100 = 0 THEN source || '/a' || doc_id // 1000 || '/b' || doc_id // 100 || '/LICENSE'
    WHEN doc_id % 10 = 0 THEN source || '/a' || doc_id // 1000 || '/b' || doc_id // 100 || '/c' || doc_id // 10 || '/LICENSE'
    ELSE source || '/a' || doc_id // 1000 || '/b' || doc_id // 100 || '/c' || doc_id // 10 || '/' || doc_id || '.txt' END AS path
  FROM documents),
lines AS (
  SELECT doc_id, row_number() OVER () AS line, {terms.format('l')} AS terms
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM files WHERE regexp_matches(text, '{speaks}'))
  WHERE regexp_matches(l, '{speaks}')),
total AS (SELECT count(*) AS n FROM lines),
seen AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(terms)) AS term FROM lines) GROUP BY term),
idf AS (SELECT term, ln((n + 1.0) / (coalesce(df, 0) + 1)) + 1 AS idf FROM vocab LEFT JOIN seen USING (term), total),
tv AS (SELECT template, licence, term, tf * idf AS tw FROM tt JOIN idf USING (term)),
tn AS (SELECT template, sqrt(sum(tw * tw)) AS tn FROM tv GROUP BY template),
w AS (
  SELECT doc_id, line, term, tf * coalesce(idf, ln(n + 1.0) + 1) AS w
  FROM (SELECT doc_id, line, term, count(*) AS tf FROM (SELECT doc_id, line, unnest(terms) AS term FROM lines) GROUP BY ALL)
  LEFT JOIN idf USING (term), total),
ln AS (SELECT line, sqrt(sum(w * w)) AS ln FROM w GROUP BY line),
cos AS (
  SELECT doc_id, licence, round(dot / (tn * ln), 6) AS cosine
  FROM (SELECT doc_id, line, template, licence, sum(w * tw) AS dot FROM w JOIN tv USING (term) GROUP BY ALL)
  JOIN ln USING (line) JOIN tn USING (template)),
best AS (
  SELECT doc_id, licence, cosine FROM cos WHERE cosine >= {licences.MIN_COSINE}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, licence) = 1),
own AS (
  SELECT f.doc_id, path, regexp_replace(path, '/[^/]*$', '') AS dir, licence, cosine FROM files f LEFT JOIN best USING (doc_id)),
given AS (
  SELECT dir, licence AS inherited FROM own WHERE licence IS NOT NULL AND path LIKE '%/LICENSE'
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY path, licence) = 1),
found AS (
  SELECT DISTINCT o.dir, g.dir AS from_dir, g.inherited
  FROM (SELECT DISTINCT dir FROM own) o JOIN given g ON o.dir = g.dir OR starts_with(o.dir, g.dir || '/')
  QUALIFY row_number() OVER (PARTITION BY o.dir ORDER BY length(g.dir) DESC) = 1)
SELECT doc_id, path, coalesce(licence, inherited) AS licence, cosine,
       CASE WHEN licence IS NOT NULL THEN 'own' WHEN inherited IS NOT NULL THEN 'inherited' ELSE 'none' END AS how,
       CASE WHEN licence IS NULL THEN from_dir END AS from_dir
FROM own LEFT JOIN found USING (dir)
"""


ORACLES["op8_licence_scan"] = _licence_sql()


@register
def op9_segment_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    learn = ~toxicity.held_out(F.col("doc_id"))
    model = toxicity.fit(docs.where(learn), labels.where(learn))
    s = toxicity.score(docs, model)
    return s.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("tox.score").alias("score"),
                    (F.col("tox.score") >= 0.3).cast("int").alias("predicted"))


@register
def op10_template_text(spark, sf_dir: str) -> DataFrame:
    return template_html.main_text(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


# the conversation that the contract adds: a user, then an assistant row
ADDED = (-7, r"\### Assistant: </turn> ok")


@register
def op11_prefix_targets(spark, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(ADDED[0], i, role, ADDED[1]) for i, role in enumerate(("user", "assistant"))],
                                  "conv_id long, turn long, role string, text string")
    placed = spool(chat_examples.pieces(turns.unionByName(added)))
    return chat_examples.read_back(placed, chat_examples.examples(placed))


ORACLES["op11_prefix_targets"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
p AS (
  SELECT *, 14 + length(role) + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g'))
            + length(regexp_replace(role, '[^\\#<:]', '', 'g')) AS n FROM t),
o AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM p)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars, count(*) FILTER (role = 'assistant') AS n_examples,
       CAST(coalesce(sum(upto) FILTER (role = 'assistant'), 0) AS BIGINT) AS example_chars
FROM o GROUP BY conv_id
"""


@register
def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    seqs = prefix_trie.sequences(read_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.shared_heads(seqs))


ORACLES["op13_prefix_trie"] = """
WITH t AS (
  SELECT conv_id, turn, md5(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS g,
         length(coalesce(text, '')) AS c FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'g': g, 'c': c} ORDER BY turn NULLS FIRST, g) AS s,
         CAST(xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
              lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
                  lambda v, z: xor(v >> 1, 3988292384 * (v & 1))), CAST(4294967295 AS BIGINT)), 4294967295) % 6 AS INTEGER) AS h
  FROM t GROUP BY conv_id),
seq AS (
  SELECT a.conv_id, list_concat(coalesce(b.s[1:a.h], []), a.s[a.h + 1:]) AS s
  FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
p AS (
  SELECT conv_id, d, len(s) AS n, md5(array_to_string(list_transform(s[1:d], lambda x: x.g), ',')) AS k,
         CASE WHEN d > 0 THEN md5(array_to_string(list_transform(s[1:d - 1], lambda x: x.g), ',')) END AS up,
         CASE WHEN d > 0 THEN s[d].c ELSE 0 END AS c
  FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM seq)),
node AS (
  SELECT d, k, min(conv_id) AS conv_id, min(up) AS up, count(*) AS n_convs, min(c) AS c,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM p GROUP BY d, k),
kid AS (SELECT d, up, count(*) AS n FROM node WHERE d > 0 GROUP BY d, up),
one AS (
  SELECT node.*, coalesce(kid.n, 0) AS n_children FROM node LEFT JOIN kid ON kid.d = node.d + 1 AND kid.up = node.k),
sub AS (
  SELECT a.d, a.k, sum(CAST(one.n_children = 0 AS INTEGER)) AS n_leaves, sum((one.n_convs - 1) * one.c) AS saved_tokens
  FROM one JOIN p a ON a.conv_id = one.conv_id AND a.d <= one.d GROUP BY a.d, a.k)
SELECT one.conv_id, CAST(one.d AS BIGINT) AS depth, above.conv_id AS parent_conv_id, one.n_convs, one.n_children,
       CAST(sub.n_leaves AS BIGINT) AS n_leaves, CAST(sub.saved_tokens AS BIGINT) AS saved_tokens, one.ends_sha256
FROM one JOIN sub ON sub.d = one.d AND sub.k = one.k LEFT JOIN node above ON above.d = one.d - 1 AND above.k = one.up
"""


@register
def op12_pair_maxscore(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pair_maxscore.search(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"), k=10)


ORACLES["op12_pair_maxscore"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[0-9a-z\x{80}-\x{10FFFF}]+')) AS t FROM benchmark),
c AS (SELECT count(*) AS n_docs, sum(len(w)) AS n_words FROM d WHERE len(w) > 0),
tf AS (SELECT k, t, count(*) AS tf FROM (SELECT k, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY k, t),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
wt AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM df, c),
m AS (SELECT k, doc_id, CAST(100 - 90 + (90 * len(w) * n_docs) // n_words AS BIGINT) AS m FROM d, c WHERE len(w) > 0),
s AS (
  SELECT q.item_id, k, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m.m))) AS score
  FROM q JOIN tf USING (t) JOIN wt USING (t) JOIN m USING (k) GROUP BY q.item_id, k)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM s JOIN m USING (k) WHERE score > 0)
WHERE rank <= 10
"""

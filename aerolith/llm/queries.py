"""The queries of this subpackage: name -> function of (spark, sf_dir), and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from aerolith.llm import bpe

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.round_trip_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "bpe.*")


def op2_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aerolith.llm import vectors

    linked = vectors.link(table(spark, sf_dir, "embeddings"))
    return linked.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


#: Every vector against every other one.
OP2_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE embedding IS NOT NULL),
u AS (SELECT vec_id, x FROM v WHERE len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND list_sum(list_transform(x, lambda c: c * c)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.9),
reach(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS low FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(c.low, e.vec_id)) AS component_id, e.vec_id <= coalesce(c.low, e.vec_id) AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.a = e.vec_id
"""


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aerolith.llm import mixing

    mixed = mixing.taken(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


#: A source gives the words of its stream up to its target, rounded.
OP3_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(concat(coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight, 3 * source_size AS cap, sum(source_size) OVER ()::BIGINT AS total FROM s),
f AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM w),
t AS (SELECT *, CASE WHEN cap > level * weight THEN weight * (SELECT level FROM f WHERE cap > level * weight ORDER BY cap / weight LIMIT 1) ELSE cap END::DOUBLE AS target FROM f),
o AS (SELECT d.doc_id, d.size, t.source_size, t.target, least(floor(t.target + 0.5)::BIGINT, 3 * t.source_size) AS words, (('0x' || substr(key, 1, 15))::BIGINT % ceil((SELECT count(*) FROM d) / 1500.0)::BIGINT) AS bucket, key, d.source
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
a AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY bucket, key ROWS UNBOUNDED PRECEDING) - size AS lo FROM o)
SELECT doc_id, size, source_size, target, list_sum([greatest(0, least(e * source_size + lo + size, words) - (e * source_size + lo)) FOR e IN [0, 1, 2]])::BIGINT AS taken FROM a
"""


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aerolith.llm import warc

    manifest = warc.write(table(spark, sf_dir, "pages"))
    records = warc.read(manifest, payloads=False, strict=True)
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h, n) AS first FROM p)
SELECT page_id, n AS payload_bytes, h AS payload_digest, CASE WHEN n >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> first THEN first END AS refers_to FROM m
"""

#: Host, path and verdict of the rules of op5.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aerolith.llm import urlfilter

    judged = urlfilter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, column="v")
    return judged.select("page_id", "v.*")


OP5_SQL = r"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
f AS (SELECT page_id, host, p.path, r.h || r.p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(r.h || r.p) DESC NULLS LAST) AS k
  FROM p LEFT JOIN r ON (host = r.h OR host LIKE '%.' || r.h) AND starts_with(p.path, r.p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM f WHERE k = 1
"""


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aerolith.llm import langid

    part = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (part == 0).alias("held_out"))
    model = langid.fit(docs.where("NOT held_out"))
    return langid.identify(docs.drop("lang"), model).select("doc_id", "held_out", "language.*")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from aerolith.llm import lm

    part = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (part != 2).alias("train"))
    scored = lm.score(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return scored.select(F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "mixture_score")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aerolith.llm import dedup_suffix

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_suffix.remove(docs, texts=False, column="r").select("doc_id", "r.n_bytes", "r.n_removed", "r.n_spans", "r.kept_sha256", "r.n_passages", "r.n_passage_bytes")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aerolith.llm import jaccard

    linked = jaccard.join(table(spark, sf_dir, "documents"))
    return linked.select(F.col("id").alias("doc_id"), "class_id", "n_links", "component_id", F.col("first").alias("kept"))


#: All pairs that share an n-gram, counted.
OP9_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM d),
s AS (SELECT doc_id, count(*) AS n, md5(string_agg(x, chr(10) ORDER BY x)) AS h FROM g GROUP BY doc_id),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.x = b.x AND a.doc_id <> b.doc_id JOIN s sa ON sa.doc_id = a.doc_id JOIN s sb ON sb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 9 * count(*) >= 4 * (any_value(sa.n) + any_value(sb.n))),
reach(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS low FROM reach GROUP BY a), k AS (SELECT a, count(*) AS n FROM l GROUP BY a), m AS (SELECT h, min(doc_id) AS class_id FROM s GROUP BY h)
SELECT d.doc_id, coalesce(m.class_id, d.doc_id) AS class_id, coalesce(k.n, 0)::BIGINT AS n_links, least(d.doc_id, coalesce(c.low, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(c.low, d.doc_id) AS kept FROM d LEFT JOIN s USING (doc_id) LEFT JOIN m USING (h) LEFT JOIN k ON k.a = d.doc_id LEFT JOIN c ON c.a = d.doc_id
"""


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aerolith.llm import quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    m = quality.ledger(docs, "text", "ledger").select("doc_id", "ledger.*")
    base = quality.POLICIES["base"]
    return m.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("fail_bits").bitwiseAND(F.lit(base).cast("long")) != 0).alias("base_failed"),
        quality.passes(F.col("fail_bits")).alias("kept"),
        "n_lines", "n_upper", "n_lower", "fail_bits",
    )


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
words AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
wins AS (SELECT r, i, word || ' ' || lead(word) OVER (PARTITION BY r ORDER BY i) || ' ' || lead(word, 2) OVER (PARTITION BY r ORDER BY i) AS win FROM words),
marked AS (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c, win FROM wins),
rep AS (SELECT r, count(DISTINCT i) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS i FROM marked WHERE win IS NOT NULL AND c > 1) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM w),
dup AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words,
  length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  coalesce(dup.n_lines, 0)::BIGINT AS n_lines, coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
  length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_upper, length(regexp_replace(t, '[^a-z]', '', 'g'))::BIGINT AS n_lower
  FROM w LEFT JOIN dup USING (r) LEFT JOIN rep USING (r)),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
  + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN word_chars < 3 * n_words OR word_chars > 12 * n_words THEN 8 ELSE 0 END
  + CASE WHEN 2 * n_dup_lines > n_lines THEN 16 ELSE 0 END + CASE WHEN n_upper > n_lower THEN 32 ELSE 0 END)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept,
  n_lines, n_upper, n_lower, fail_bits FROM b
"""

def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from aerolith.llm import chat

    vocabulary = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows = rows.union(spark.createDataFrame(tricky, rows.schema))
    formatted = chat.formatted(rows, *vocabulary).select("conv_id", "turn", "chat")
    return chat.digests(chat.turns(formatted, *vocabulary))


#: Written forms are as long as texts, marks and one character for each control string within a text.
OP11_SQL = r"""
WITH a AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
m AS (SELECT *, sha256(concat(length(r), ':', r, t)) AS tie, '<\\*/?s>|\[\\*/?INST\]|<\\*</?SYS>>|<\\*</?ROLE>>' AS control FROM a),
n AS (SELECT *, length(t) + len(regexp_extract_all(t, control)) + CASE r WHEN 'user' THEN 13 WHEN 'system' THEN 15 WHEN 'assistant' THEN 4 ELSE 21 + length(r) + len(regexp_extract_all(r, control)) END AS n FROM m)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(concat(r, chr(10), t, chr(10)), '' ORDER BY turn NULLS FIRST, tie)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, tie) FILTER (r = 'assistant'), '')) AS loss_sha256, sum(n)::BIGINT AS formatted_chars
FROM n GROUP BY conv_id
"""

#: Conversations take up to 3 first turns of the one whose number is the next lower multiple of 20.
FAMILY, MOST_TAKEN = 20, 3


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns and conversations after each has taken the first turns of its family's conversation."""
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(MOST_TAKEN + 1))
    convs = convs.select("conv_id", "n_own", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"))
    heads = convs.select(F.col("conv_id").alias("family"), F.col("n_own").alias("n_family"))
    convs = convs.join(heads, "family", "left").withColumn("n_taken", F.least("h", F.coalesce("n_family", F.lit(0))))
    firsts = turns.where(F.col("k") <= MOST_TAKEN).withColumnRenamed("conv_id", "family")
    taken_turns = firsts.join(convs.select("conv_id", "family", "h"), "family").where("k <= h").select("conv_id", "k", "said", "n_words")
    own = turns.join(convs.select("conv_id", "h", "n_taken"), "conv_id").where("k > h").select("conv_id", (F.col("k") - F.col("h") + F.col("n_taken")).alias("k"), "said", "n_words")
    sizes = convs.select("conv_id", (F.col("n_taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("n_turns"))
    return taken_turns.union(own), sizes


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aerolith.llm import trie
    from aerolith.llm.common import written

    turns = written(trie.numbered(table(spark, sf_dir, "conversations")), "trie-numbered")
    return trie.nodes(*_rebuilt(turns))


#: Nodes are told apart by digests of all turns up to them; crc32 is worked out bit by bit. Subtrees by pairs of a node and
#: the nodes of its smallest conversation's members.
OP12_SQL = r"""
WITH a AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(concat(length(r), ':', r, t))) AS k, concat(length(r), ':', length(t), ':', r, t) AS said,
  len(regexp_extract_all(t, '[^ 	-
]+')) AS words FROM a),
c AS (SELECT conv_id, count(*) AS n_own, conv_id - conv_id % 20 AS family, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s % 2 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END), 4294967295) % 4 AS h FROM o GROUP BY conv_id),
f AS (SELECT c.conv_id, c.family, c.h, c.n_own, least(c.h, coalesce(b.n_own, 0)) AS got FROM c LEFT JOIN c b ON b.conv_id = c.family),
b AS (SELECT f.conv_id, o.k, o.said, o.words FROM f JOIN o ON o.conv_id = f.family AND o.k <= f.h UNION ALL SELECT f.conv_id, o.k - f.h + f.got, o.said, o.words FROM f JOIN o ON o.conv_id = f.conv_id AND o.k > f.h),
p AS (SELECT conv_id, k AS depth, words, md5(string_agg(md5(said), '') OVER (PARTITION BY conv_id ORDER BY k)) AS node FROM b UNION ALL SELECT conv_id, 0, 0, 'root' FROM f),
e AS (SELECT conv_id, max(depth) AS last FROM p GROUP BY conv_id),
q AS (SELECT p.*, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, depth = last AS ends FROM p JOIN e USING (conv_id)),
n AS (SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs, bool_and(ends) AS leaf, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM q GROUP BY node),
s AS (SELECT u.node, sum((w.n_convs - 1) * w.words) AS saved, count(*) FILTER (w.leaf) AS leaves FROM n w JOIN q v ON v.conv_id = w.conv_id AND v.depth <= w.depth JOIN n u ON u.node = v.node GROUP BY u.node),
k AS (SELECT parent, count(*) AS n FROM n WHERE parent IS NOT NULL GROUP BY parent)
SELECT n.conv_id, n.depth::BIGINT AS depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0)::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN s ON s.node = n.node LEFT JOIN k ON k.parent = n.node LEFT JOIN n m ON m.node = n.parent
"""

def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aerolith.llm import negatives

    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = rows.where(finite).select("vec_id", moved.alias("label"), F.transform("x", lambda c: F.floor(256 * c)).alias("x"))
    return negatives.mine(whole, F.col("vec_id") % 100 == 0, vector="x")


#: The anchors against all rows.
OP13_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.a, p.b AS positive_id, p.score AS positive_score, s.b AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT a AS anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_vector_dedup": op2_vector_dedup,
    "op3_mixing": op3_mixing,
    "op4_warc": op4_warc,
    "op5_url_filter": op5_url_filter,
    "op6_language_id": op6_language_id,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality_rules": op10_quality_rules,
    "op11_chat_format": op11_chat_format,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE = {
    "op2_vector_dedup": OP2_SQL,
    "op3_mixing": OP3_SQL,
    "op4_warc": OP4_SQL,
    "op5_url_filter": OP5_SQL,
    "op9_jaccard_join": OP9_SQL,
    "op10_quality_rules": OP10_SQL,
    "op11_chat_format": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}

"""The operators as named queries over whole tables, and the DuckDB SQL that some are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import ann, chat, collocations, conversation_trie, decontamination, html_extract, langid, line_dedup, mixing, sharding, toxicity, warc
from clickloom.llm.common import LOWER, UPPER, require
from clickloom.llm.jaccard_join import jaccard_join


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained(require(spark, sf_dir, "documents"), require(spark, sf_dir, "benchmark"), k=5, percent=80)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = sharding.shard(require(spark, sf_dir, "documents"), shards=16)
    return got.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(require(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars", "n_blocks", "n_content")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(require(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = jaccard_join(require(spark, sf_dir, "documents"), k=3, percent=90)
    return got.select("doc_id", "n_shingles", "component_id")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = warc.archived(require(spark, sf_dir, "pages"), least=0)
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.mix(require(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = require(spark, sf_dir, "documents").select("doc_id", "text")
    got = toxicity.score(docs, require(spark, sf_dir, "labels"))
    return got.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
                      "n_exact", "n_misspelled", "n_quoted")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(require(spark, sf_dir, "embeddings"), query="vec_id % 50 = 0", k=5)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = line_dedup.repeated_lines(require(spark, sf_dir, "documents"), k=5, percent=80)
    return got.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), F.array_join("removed", " ").alias("removed"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = require(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.formatted(turns.unionByName(chat.probe(spark))))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = conversation_trie.turn_lists(require(spark, sf_dir, "conversations"))
    got = conversation_trie.trie(conversation_trie.with_shared_heads(lists, every=20))
    return got.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(require(spark, sf_dir, "documents"), threshold=30, percent=80, most=2000)


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_sharding": op2_sharding,
    "op3_html_extraction": op3_html_extraction,
    "op4_language_id": op4_language_id,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_warc": op6_warc,
    "op7_mixing": op7_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_line_dedup": op10_line_dedup,
    "op11_chat_format": op11_chat_format,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_collocations": op13_collocations,
}

#: Word shingles of k words, as lists of text: the rule of `decontamination.shingles` without its hashes.
_SHINGLES = """
    CASE WHEN len(w) < {k} THEN [] ELSE list_distinct(list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k} - 1], ' '))) END"""
_WORDS = "list_filter(regexp_split_to_array({text}, '[\\t\\n\\x0B\\f\\r ]+'), lambda x: x <> '')"

ORACLE: dict[str, str] = {
    "op1_decontamination": f"""
WITH i AS (SELECT item_id, {_WORDS.format(text="lower(coalesce(text, ''))")} AS w FROM benchmark),
it AS (SELECT item_id, {_SHINGLES.format(k=5)} AS s FROM i),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text="lower(coalesce(text, ''))")} AS w FROM documents),
ds AS (SELECT r, doc_id, unnest({_SHINGLES.format(k=5)}) AS h FROM d),
ih AS (SELECT item_id, len(s) AS n_item, unnest(s) AS h FROM it),
c AS (SELECT r, doc_id, item_id, n_item, count(*) AS n_shared FROM ds JOIN ih USING (h) GROUP BY ALL)
SELECT doc_id, item_id, n_item, max(n_shared) AS n_shared, max(n_shared) / n_item::DOUBLE AS containment
FROM c WHERE 100 * n_shared >= 80 * n_item GROUP BY doc_id, item_id, n_item""",
    "op5_ngram_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(text=f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) BETWEEN 1 AND 2 THEN ['<' || array_to_string(w, ' ') || '>'] ELSE {_SHINGLES.format(k=3)} END AS s FROM d),
c AS (SELECT s, len(s) AS n, min(doc_id) AS c FROM s WHERE len(s) > 0 GROUP BY s),
t AS (SELECT c, n, unnest(s) AS h FROM c),
l AS (SELECT x.c AS a, y.c AS b FROM t x JOIN t y ON x.h = y.h AND x.c <> y.c GROUP BY x.c, y.c, x.n, y.n
      HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))),
r AS (SELECT c AS a, c AS b FROM c UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(component_id, s.doc_id) AS component_id
FROM s LEFT JOIN c ON s.s = c.s LEFT JOIN m ON m.a = c.c""",
    "op6_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda j:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, CAST(1 + 5 * (j // 4) AS INT), 5))::INT) >> (15 - 5 * (j % 4))::INT) & 31) + 1, 1)), 'string_agg', '') AS payload_digest FROM p),
b AS (SELECT payload_digest, max(page_id) AS best FROM d GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> best THEN best END AS refers_to FROM d JOIN b USING (payload_digest)""",
    "op10_line_dedup": f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS txt, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents),
w AS (SELECT doc_id, line, {_WORDS.format(text="lower(txt)")} AS w FROM l),
s AS (SELECT doc_id, line, CASE WHEN len(w) BETWEEN 1 AND 4 THEN ['<' || array_to_string(w, ' ') || '>'] ELSE {_SHINGLES.format(k=5)} END AS s FROM w),
c AS (SELECT list_sort(s) AS s, min((doc_id, line)) AS f, len(any_value(s)) AS n, row_number() OVER () AS c FROM s WHERE len(s) > 0 GROUP BY list_sort(s)),
t AS (SELECT c, f, n, unnest(s) AS h FROM c),
p AS (SELECT x.c FROM t x JOIN t y ON x.h = y.h AND x.f > y.f GROUP BY x.c, y.c, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
g AS (SELECT s.doc_id, s.line FROM s JOIN c ON list_sort(s.s) = c.s WHERE c.c IN (SELECT c FROM p) OR (s.doc_id, s.line) > c.f),
r AS (SELECT doc_id, count(*) AS n, string_agg(line, ' ' ORDER BY line) AS removed FROM g GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines, coalesce(n, 0) AS n_removed, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN r USING (doc_id)""",
    "op11_chat_format": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)),
o AS (SELECT *, row_number() OVER w AS i, lag(role) OVER w IS DISTINCT FROM role AS head FROM c
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + CASE WHEN head THEN length(url_encode(role)) + 24 ELSE 10 END)::BIGINT AS formatted_chars,
  count(*) FILTER (head) AS n_blocks
FROM o GROUP BY conv_id""",
    "op12_conversation_trie": r"""
WITH t AS (SELECT conv_id AS c, list({'r': coalesce(role, ''), 'x': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS w FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, c - c % 20 AS base, w, 3 - ((list_reduce(flatten(list_transform(range(1, len(c::VARCHAR) + 1), lambda j: [ascii((c::VARCHAR)[j])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END, 4294967295::BIGINT)) & 3) AS k FROM t),
f AS (SELECT h.c, coalesce(b.w, [])[:h.k] || h.w[(h.k + 1):] AS w FROM h LEFT JOIN t b ON b.c = h.base),
p AS (SELECT c, len(w) AS len, d AS depth, CASE WHEN d > 0 THEN w[:d] ELSE [] END AS key, CASE WHEN d > 1 THEN w[:(d - 1)] ELSE [] END AS up,
    CASE WHEN d > 0 THEN len(regexp_extract_all(w[d].x, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
  FROM (SELECT c, w, unnest(range(0, len(w) + 1)) AS d FROM f)),
n AS (SELECT key, up, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len = depth), '')) AS ends_sha256 FROM p GROUP BY key, up, depth),
k AS (SELECT up, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY up),
s AS (SELECT n.*, CASE WHEN depth > 0 THEN u.conv_id END AS parent_conv_id, coalesce(n_children, 0) AS n_children
  FROM n LEFT JOIN k ON k.up = n.key LEFT JOIN (SELECT key AS ukey, conv_id FROM n) u ON u.ukey = n.up),
m AS (SELECT DISTINCT p.key, q.conv_id, q.depth FROM p JOIN n q ON q.depth >= p.depth AND q.key[:p.depth] = p.key),
a AS (SELECT m.key, sum((s.n_children = 0)::INT)::BIGINT AS n_leaves, sum((s.n_convs - 1) * s.words)::BIGINT AS saved_tokens
  FROM m JOIN s ON s.conv_id = m.conv_id AND s.depth = m.depth GROUP BY m.key)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM s JOIN a USING (key)""",
    "op13_collocations": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:(i + m - 1)], ' '))) AS phrase
  FROM w, range(1, 5) r(m) WHERE len(w) >= m),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM g GROUP BY ALL HAVING count(*) >= 30),
u AS (SELECT lang, phrase, a, w, unnest(range(1, m)) AS k FROM f),
z AS (SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS head, array_to_string(w[(k + 1):], ' ') AS tail FROM u),
c AS (SELECT z.lang, z.phrase, z.a, k, x.a AS l, y.a AS r, ((2000000::HUGEINT * z.a) // (x.a + y.a))::BIGINT AS score
  FROM z JOIN f x ON x.lang = z.lang AND x.phrase = head JOIN f y ON y.lang = z.lang AND y.phrase = tail),
s AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, unnest(list_transform(range(1, m - d + 2), lambda j: array_to_string(w[j:(j + d - 1)], ' '))) AS phrase, a AS longer FROM f, range(2, 4) r(d) WHERE m > d),
b AS (SELECT lang, phrase, max(longer) AS longer FROM i GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM s LEFT JOIN b USING (lang, phrase) JOIN n USING (lang) WHERE longer IS NULL OR 100 * longer < 80 * a
QUALIFY rank <= 2000""",
}

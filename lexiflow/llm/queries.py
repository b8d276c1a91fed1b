"""Driver queries of the training-data operators: thin digests of their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.llm import ann, bpe, chat, langid, lexical, license_rules, licenses, minhash, order_minhash, packing, pii, rolling, token_prefix, toxicity
from lexiflow.llm.common import table, tokenizer_path

TOKEN_LIMIT, SEQUENCE_TOKENS = 512, 2048
TOXIC_FROM = 0.3


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scorer = toxicity.fit(documents.where(~langid.is_held_out()), table(spark, sf_dir, "labels"))
    found = toxicity.score(documents, scorer)
    return found.select("doc_id", langid.is_held_out().alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "evidence")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), SEQUENCE_TOKENS)
    return packing_digest(pieces)


def packing_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id bigint, turn bigint, role string, text string")
    return chat.read_back(chat.format_conversations(rows.unionByName(own)))


OP4_SQL = r"""
WITH own AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM own)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g')) + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) > 1 THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) ELSE t END) AS shingle FROM w
), n AS (SELECT w.doc_id, count(shingle) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT n.doc_id, n.n AS n_shingles, m.y AS component_id, n.doc_id = m.y AS kept FROM n JOIN (SELECT x, min(y) AS y FROM r GROUP BY x) m ON m.x = n.doc_id
"""


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", F.size("values").alias("n_values"), F.array_join(F.array_sort(F.transform("values", lambda v: v["kind"])), ",").alias("kinds"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edit_report(table(spark, sf_dir, "documents"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = langid.fit(documents.where(~langid.is_held_out()))
    found = langid.predict(documents, model)
    return found.select("doc_id", langid.is_held_out().alias("held_out"), "lang_pred", "score", F.map_keys("languages").alias("languages"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_prefix.budget_report(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), TOKEN_LIMIT)


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def rule_rows(rules: list[license_rules.Rule]) -> str:
    """The rules as rows of SQL, keywords and patterns with words set apart."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    return ",\n".join(f"({n}, {r.base}, {r.priority}, {license_rules.WORTH[r.priority]}::DOUBLE, {quoted(r.label)}, {quoted(r.keyword.replace(' ', '  '))}, {quoted(f'({licenses.apart(r.pattern)})')})" for n, r in enumerate(rules))


OP11_SQL = (
    r"""
WITH rules(n, base, priority, worth, label, keyword, pattern) AS (VALUES
"""
    + rule_rows(license_rules.all_rules())
    + r"""
), low AS (SELECT doc_id, row_number() OVER () AS r, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, r, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM low),
normal AS (SELECT r, ' ' || array_to_string(words, '  ') || ' ' AS t FROM d),
marked AS (
  SELECT r, n, base, priority, worth, label, regexp_extract_all(regexp_replace(t, pattern, chr(1) || '\1' || chr(2), 'g'), '[\x01\x02]|[^ \x01\x02]+') AS tokens
  FROM normal JOIN rules ON contains(t, keyword) WHERE regexp_matches(t, pattern)
), marks AS (SELECT r, n, base, priority, worth, label, list_filter(list_transform(tokens, lambda x, i: CASE WHEN x = chr(1) OR x = chr(2) THEN i - 1 END), lambda i: i IS NOT NULL) AS marks FROM marked),
place AS (SELECT r, n, base, priority, worth, label, marks[2 * k - 1] - (2 * k - 2) AS a, marks[2 * k] - (2 * k - 1) AS b FROM (SELECT *, unnest(range(1, len(marks) // 2 + 1)) AS k FROM marks)),
kept AS (
  SELECT * FROM place p WHERE base OR NOT EXISTS (
    SELECT 1 FROM place e WHERE e.r = p.r AND e.a <= p.a AND e.b >= p.b
    AND (e.priority > p.priority OR e.priority = p.priority AND (e.b - e.a > p.b - p.a OR e.a = p.a AND e.b = p.b AND e.n < p.n)))
), found AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(a) FILTER (base) AS first_word, max(a) FILTER (base) AS last_word, max(worth) AS score,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM kept GROUP BY r
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0::DOUBLE) AS score
FROM d LEFT JOIN found USING (r)
"""
)


def op12_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.document_windows(table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, bit: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS t),
d AS (
  SELECT doc_id, source, lang, length(text) AS chars,
    xor(4294967295, list_reduce(string_split(CAST(doc_id AS VARCHAR), '') , lambda c, ch: CAST(xor(CAST(c AS BIGINT) >> 8, t[(xor(CAST(c AS BIGINT), ascii(ch)) & 255) + 1]) AS VARCHAR), '4294967295')::BIGINT) % 1000 AS h FROM documents, crc
), e AS (SELECT *, (doc_id + h - ((doc_id + h) % 6 + 6) % 6) * 10 AS event_s, row_number() OVER () AS r FROM d),
w AS (SELECT * FROM e, (VALUES (1800), (86400)) s(window_s)),
p AS (
  SELECT w.r, w.window_s, count(o.r) AS n_events, coalesce(sum(o.chars), 0) AS sum_chars, count(DISTINCT o.lang) AS n_langs, list_sort(list(o.chars) FILTER (o.chars IS NOT NULL)) AS v
  FROM w LEFT JOIN e o ON o.source IS NOT DISTINCT FROM w.source AND o.event_s >= w.event_s - w.window_s AND o.event_s < w.event_s GROUP BY ALL
)
SELECT doc_id, CAST(w.window_s AS BIGINT) AS window_s, event_s, n_events, CAST(sum_chars AS BIGINT) AS sum_chars, n_langs,
  v[(len(v) + 1) // 2] AS median_chars, v[(99 * len(v) + 99) // 100] AS high_chars
FROM w JOIN p USING (r, window_s)
"""


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS t FROM documents),
b AS (SELECT item_id, row_number() OVER () AS i, list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM benchmark),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0),
p AS (SELECT doc_id, r, n, term, count(*) AS tf FROM (SELECT doc_id, r, len(t) AS n, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, n_docs),
q AS (SELECT item_id, i, unnest(t) AS term FROM b),
scored AS (
  SELECT item_id, i, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, i, doc_id, r
), ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_nearest, op2_toxicity, op3_packing, op4_chat, op5_minhash, op6_bpe, op7_pii, op8_order_minhash, op9_langid, op10_token_counts, op11_licenses, op12_rolling, op13_lexical)}


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express."""
    return {"op1_nearest": OP1_SQL, "op4_chat": OP4_SQL, "op5_minhash": OP5_SQL, "op11_licenses": OP11_SQL, "op12_rolling": OP12_SQL, "op13_lexical": OP13_SQL}

"""One query per operator over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, decontaminate, lexical, minhash, packing, pii, prefix_trie, quality, secrets, simhash, substring, toxicity, training_order,
)
from .spans import listed
from .tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Class of near copies per document. Null and empty texts have fingerprint zero and are linked like any other."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@_query
def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Hit words and found items per document. A null text has no words, a null item no window."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@_query
def op9_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets per document. Null and empty texts have none; every repeated row has its own."""
    rows, spans = secrets.found(table(spark, folder, "documents").select("doc_id", "text"))

    def n(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = secrets.KINDS[:3]
    return rows.select("doc_id", *[n(k) for k in base], F.sha2(listed(spans, base), 256).alias("base_sha256"),
                       listed(spans).alias("spans"))


@_query
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """A row per piece of a document. Null and empty texts are one id 0; every repeated row is packed."""
    return packing.packed(table(spark, folder, "documents")).drop("row")


@_query
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict per document. Null and empty texts have no words and fail."""
    verdicts = quality.rated(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return verdicts.select("doc_id", *quality.COUNTS, "base_failed", "kept")


@_query
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words kept and removed per document. Null and empty texts have none; a repeated row repeats its windows."""
    return substring.without_repeats(table(spark, folder, "documents")).drop("kept")


#: a conversation whose texts hold the template's own marks
MARKED_TEXT = r"\### Assistant: </turn> ok"


@_query
def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Turns read back from formatted examples, per conversation. Null texts and roles are empty, a null turn comes first."""
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKED_TEXT).alias("text"))
    return chat.digests(chat.examples(given.union(marked)))


SQL["op4_chat_formatting"] = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), sized AS (
    SELECT *, 14 + length(role) + length(text) + length(text) - length(replace(text, '\', ''))
        + length(text) - length(replace(text, '<', '')) + length(text) - length(replace(text, '#', '')) AS n,
        row_number() OVER way = count(*) OVER (PARTITION BY conv_id) AS last
    FROM said WINDOW way AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), summed AS (
    SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM sized
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(upto) FILTER (role = 'assistant' OR last) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id
"""


@_query
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data per document. Null and empty texts have none; every repeated row has its own."""
    rows = pii.found(table(spark, folder, "documents"))

    def n(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select("doc_id", *[n(k) for k in pii.BASE], F.sha2(listed("spans", pii.BASE), 256).alias("base_sha256"),
                       listed("spans").alias("spans"))


@_query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Score per document. Null and empty texts are scored too; every repeated row is."""
    docs = table(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, folder, "labels")))


#: decides the training order
ORDER_KEY = 20_240_601


@_query
def op2_training_order(spark: SparkSession, folder: str) -> DataFrame:
    """A row per sequence in its global slot. Null and empty texts are one id 0."""
    return training_order.digests(training_order.materialise(table(spark, folder, "documents"), ORDER_KEY))


@_query
def op11_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Class of near copies per document. Null and empty texts have no shingles and are linked with nothing."""
    return minhash.near_duplicates(table(spark, folder, "documents"))


@_query
def op12_ranked_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """Ten best documents per item. Null and empty texts hold no term; items without a term find nothing."""
    return lexical.search(lexical.index(table(spark, folder, "documents")), table(spark, folder, "benchmark"))


SQL["op12_ranked_lexical_search"] = r"""
WITH said AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
    FROM documents
), lengths AS (SELECT doc_id, count(*) AS n FROM said GROUP BY doc_id
), whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths
), asked AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
        FROM benchmark) GROUP BY item_id, term
), found AS (
    SELECT doc_id, term, count(*) AS tf FROM said WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM found GROUP BY term), whole
), impacts AS (
    SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)) AS impact
    FROM found JOIN lengths USING (doc_id), whole
), scored AS (
    SELECT item_id, doc_id, CAST(sum(times * w * impact) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item_id, doc_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@_query
def op13_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """A row per distinct prefix. Null roles and texts are empty, a null turn comes first, rows without conv_id are in none."""
    return prefix_trie.trie(table(spark, folder, "conversations"))


SQL["op13_conversation_prefix_trie"] = r"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
        sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said, length(coalesce(text, '')) AS chars
    FROM conversations WHERE conv_id IS NOT NULL
), bits(c, v) AS (  -- CRC-32 by the table of single bytes
    SELECT i, i FROM range(256) t(i)
), shifted AS (
    SELECT c, list_reduce(list_prepend(v::BIGINT, range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS v FROM bits
), crc AS (SELECT list(v ORDER BY c) AS steps FROM shifted
), convs AS (
    SELECT conv_id, n, conv_id - conv_id % 100 AS base,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
            lambda x, d: xor(x // 256, steps[xor(x % 256, d) + 1])), 4294967295) % 6 AS h
    FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id), crc
), planned AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS p FROM convs c LEFT JOIN convs b ON c.base = b.conv_id
), built AS (
    SELECT c.conv_id, k AS d, said, chars FROM planned c JOIN turns t ON t.conv_id = c.base AND k <= p
    UNION ALL SELECT c.conv_id, p + k - h, said, chars FROM planned c JOIN turns t ON t.conv_id = c.conv_id AND k > h
), paths AS (
    SELECT conv_id, d, chars, string_agg(said, '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM built
    UNION ALL SELECT conv_id, 0, 0, '' FROM planned
), lasts AS (SELECT conv_id, max(d) AS d FROM paths GROUP BY conv_id
), ended AS (
    SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM paths JOIN lasts USING (conv_id, d) GROUP BY path
), nodes AS (
    SELECT path, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars,
        left(path, length(path) - 64) AS above FROM paths GROUP BY path
), kids AS (SELECT above AS path, count(*) AS k FROM nodes WHERE d > 0 GROUP BY above
), whole AS (
    SELECT nodes.*, coalesce(k, 0) AS k FROM nodes LEFT JOIN kids USING (path)
), summed AS (  -- every node counts for all nodes on the way of its smallest member
    SELECT p.path, sum((w.k = 0)::INTEGER) AS leaves, sum((w.n - 1) * w.chars) AS saved
    FROM whole w JOIN paths p ON p.conv_id = w.conv_id AND p.d <= w.d GROUP BY p.path
)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, CASE WHEN w.d > 0 THEN up.conv_id END AS parent_conv_id, w.n AS n_convs,
    w.k AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM whole w JOIN summed USING (path) LEFT JOIN nodes up ON up.path = w.above LEFT JOIN ended USING (path)
"""

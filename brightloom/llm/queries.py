"""The registered queries of this subpackage and the DuckDB text of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.llm import bpe, chat, cws, kdshard, lexical, minhash, mining, mixing, packing, quality, simple8b, urlrules, wrapper

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: The word-level BPE vocabulary; its path is a parameter of the operators.
VOCABULARY = "word_bpe_49k.json"
#: The byte-level one.
BYTE_VOCABULARY = "byte_bpe_50k.json"
#: Three words and 85 in 100, as the query's contract says.
NEAR = minhash.Scheme(width=3, percent=85, rows=6, bands=32)
SITES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
EXTRA_CONVERSATION = r"\### Assistant: </turn> ok"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _query(name: str, sql: str | None = None):
    def keep(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return keep


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query("op1_minhash_near_duplicates", """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS v FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(v) = 0 THEN [] WHEN len(v) < 3 THEN [array_to_string(v, ' ')]
    ELSE list_transform(range(1, len(v) - 1), lambda i: v[i] || ' ' || v[i + 1] || ' ' || v[i + 2]) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
hit AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM hit JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.c AS component_id, d.doc_id = r.c AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM reach GROUP BY 1) r ON r.a = d.doc_id
""")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document."""
    found = minhash.near_duplicates(_table(spark, folder, "documents"), NEAR)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@_query("op2_wrapper_main_text")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return wrapper.main_text(_table(spark, folder, "pages"))


def _chat_sql() -> str:
    extra = EXTRA_CONVERSATION.replace("'", "''")
    # a text that holds a mark is escaped as a whole: each backslash and < takes one more
    more = "length({0}) - length(replace(replace({0}, '\\', ''), '<', ''))"
    body = f"length(text) + CASE WHEN contains(text, '<turn') OR contains(text, '</turn') THEN {more.format('text')} ELSE 0 END"
    name = f"length(role) + {more.format('role')} + length(role) - length(replace(role, '\"', ''))"
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{extra}' UNION ALL SELECT -7, 1, 'assistant', '{extra}'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
  CAST(sum(30 + {name} + {body}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


@_query("op3_chat_round_trip", _chat_sql())
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation rendered, and what reads back from it."""
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", EXTRA_CONVERSATION), (-7, 1, "assistant", EXTRA_CONVERSATION)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.render(rows.unionByName(extra)))


@_query("op4_differencing_packing")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """The piece of every document in sequences of 2048 tokens."""
    packed = packing.pack(_table(spark, folder, "documents"), vocabulary(), end=1, capacity=2048)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _url_sql() -> str:
    words = "|".join(urlrules.UNWANTED)
    return f"""
WITH p AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p
), r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM q
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN regexp_matches(host, '(^|[.-])({words})([.-]|$)') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""


@_query("op5_url_rules", _url_sql())
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's address."""
    rules = [urlrules.site_rule(v, t) for v, t in SITES] + list(urlrules.PATTERNS)
    return urlrules.judge(_table(spark, folder, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


@_query("op6_weighted_fingerprints")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return cws.edited_beside_next(_table(spark, folder, "documents"))


@_query("op7_quality_rules")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document."""
    found = quality.scored(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query("op8_kd_shards")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document."""
    placed = kdshard.shard(_table(spark, folder, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@_query("op9_pivotal_mix")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that the mix takes."""
    found = mixing.mix(mixing.sized(_table(spark, folder, "documents")))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@_query("op10_simple8b_files")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, read back from the files."""
    return simple8b.round_trip(_table(spark, folder, "documents"), vocabulary(), end=2).select("doc_id", "start", "n_tokens", "ids_crc32")


@_query("op13_trie_bpe")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and what they decode to."""
    path = vocabulary(BYTE_VOCABULARY)
    found = bpe.decode(bpe.encode(_table(spark, folder, "documents"), path), path)
    return found.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


@_query("op11_range_maximum_search", r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS v FROM documents
), s AS (SELECT count(*)::BIGINT AS n, sum(len(v))::BIGINT AS l FROM t WHERE len(v) > 0),
d AS (SELECT doc_id, 25 + (75 * len(v) * s.n) // s.l AS m FROM t, s WHERE len(v) > 0),
q AS (
  SELECT item_id, g, count(*) AS repeats FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS g FROM benchmark
  ) GROUP BY 1, 2
), p AS (
  SELECT doc_id, g, count(*) AS tf FROM (SELECT doc_id, unnest(v) AS g FROM t) WHERE g IN (SELECT g FROM q) GROUP BY 1, 2
), f AS (SELECT g, CAST(floor(1000 * ln((2 * s.n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM p, s GROUP BY g, s.n),
r AS (
  SELECT item_id, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM p JOIN q USING (g) JOIN f USING (g) JOIN d USING (doc_id) GROUP BY 1, 2
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 10
""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query("op12_zone_map_negatives", """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every fiftieth vector."""
    table = _table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mining.mine(table.select("vec_id", label.alias("label"), F.col("embedding").alias("vector")), F.col("vec_id") % 50 == 0)

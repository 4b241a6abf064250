"""The operators of this package as queries over whole tables: name -> (session, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from signal_lake.llm import chat_format, embedding_whitening, html_extraction, language_id, lm_scoring, minhash_dedup, nearest_neighbours, packing, phrase_mining, quality_rules, sentencepiece_codec, sharding, warc
from signal_lake.llm.common import load, prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = prepared
    return fn


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the formatted conversations say when they are read back, and one that holds control strings."""
    said = r"\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(added)
    return chat_format.read_back(chat_format.format_turns(turns)).withColumnRenamed("conv", "conv_id")


ORACLES["op1_chat_format"] = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), e AS (
    SELECT *, row_number() OVER w AS n, lag(role, 1, '') OVER w AS before,
        2 * len(text) - len(replace(text, '\', '')) - 9 * ((len(text) - len(replace(text, '### System:', ''))) // 11)
        - 7 * ((len(text) - len(replace(text, '### User:', ''))) // 9) - 12 * ((len(text) - len(replace(text, '### Assistant:', ''))) // 14)
        - 7 * ((len(text) - len(replace(text, '### Role:', ''))) // 9) - 7 * ((len(text) - len(replace(text, '### Text:', ''))) // 9)
        - 5 * ((len(text) - len(replace(text, '</turn>', ''))) // 7)
        + CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15 ELSE 10 + len(role) + 11 END + 8 AS chars
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
    CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars,
    bool_and(CASE role WHEN 'system' THEN n = 1 WHEN 'user' THEN before IN ('', 'system', 'assistant') WHEN 'assistant' THEN before = 'user' ELSE false END)
        AND max_by(role, n) = 'assistant' AS valid
FROM e GROUP BY conv_id
"""


@query
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found of every fiftieth vector."""
    return nearest_neighbours.nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures, fertility measures and verdict of every document."""
    return quality_rules.judge(load(spark, sf_dir, "documents"))


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; documents of equal text are linked."""
    return sharding.shard_documents(load(spark, sf_dir, "documents"))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, by a model of the documents that aren't held out."""
    return language_id.identify(load(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(load(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    encoded = sentencepiece_codec.encode_documents(load(spark, sf_dir, "documents"), "doc_id", "text")
    return sentencepiece_codec.digests(encoded).withColumnRenamed("id", "doc_id")


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it is read back from the archives it was written to."""
    return warc.round_trip(load(spark, sf_dir, "pages"))


ORACLES["op8_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
r AS (SELECT page_id, html, strlen(html) AS n, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
    CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM r
"""


@query
def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near copies of every document."""
    return minhash_dedup.near_duplicates(load(spark, sf_dir, "documents"))


ORACLES["op9_minhash_dedup"] = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), flat AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
    FROM worded
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM flat GROUP BY doc_id),
shared AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (
    SELECT s.x, s.y FROM shared s JOIN sizes m ON m.doc_id = s.x JOIN sizes k ON k.doc_id = s.y WHERE 100 * s.n >= 75 * (m.n + k.n - s.n)
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least ON x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""


@query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extraction.extract_pages(load(spark, sf_dir, "pages"))


@query
def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document by n-grams of the documents that aren't held out."""
    return lm_scoring.score_documents(load(spark, sf_dir, "documents"))


@query
def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language."""
    return phrase_mining.mine_phrases(load(spark, sf_dir, "documents"))


ORACLES["op13_phrase_mining"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
runs AS (
    SELECT lang, k, unnest(CASE WHEN len(w) >= k THEN list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')) ELSE [] END) AS phrase
    FROM worded, (VALUES (1), (2), (3)) t(k)
), f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (SELECT c.*, cut, array_to_string(w[1:cut], ' ') AS first, array_to_string(w[cut + 1:k], ' ') AS rest FROM c, (VALUES (1), (2)) t(cut) WHERE cut < k),
s AS (
    SELECT cuts.lang, cuts.phrase, a, cut, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
    FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = first JOIN f y ON y.lang = cuts.lang AND y.phrase = rest
    QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, cut) = 1
), most AS (
    SELECT lang, phrase, max(a) AS held FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE k = 3) GROUP BY ALL
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n, score
FROM s JOIN totals USING (lang) LEFT JOIN most ON most.lang = s.lang AND most.phrase = s.phrase
WHERE held IS NULL OR 100 * held < 50 * a
QUALIFY rank <= 2000
"""


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors on up to 32 leading components, scaled to variance 1."""
    return embedding_whitening.whiten(load(spark, sf_dir, "embeddings"))

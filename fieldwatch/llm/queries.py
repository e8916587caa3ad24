"""One query per corpus operator, over its whole table, and their SQL where there is one."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.llm.decontaminate import find_passages
from fieldwatch.llm.html_text import extract
from fieldwatch.llm.language_model import score_documents
from fieldwatch.llm.license import license_sql, scan_licenses
from fieldwatch.llm.mixing import mix
from fieldwatch.llm.prefix_trie import prefix_trie
from fieldwatch.llm.quality import quality_verdicts
from fieldwatch.llm.quotes import as_mail, in_reply_order, link_quotes
from fieldwatch.llm.ranked_search import rank_documents
from fieldwatch.llm.secrets import scan_digest
from fieldwatch.llm.simhash import component_ids
from fieldwatch.llm.vector_search import top_products
from fieldwatch.llm.warc import archived
from fieldwatch.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-likelihood of every document."""
    return score_documents(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item."""
    return find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns sent as mails that quote each other, and put back in reply order."""
    linked = in_reply_order(link_quotes(as_mail(table(spark, sf_dir, "conversations"))))

    def turn(message: str):
        return F.split_part(message, F.lit(":"), F.lit(-1)).cast("long")

    return linked.select(
        F.col("thread").cast("long").alias("conv_id"),
        F.col("sent").alias("turn"),
        turn("parent").alias("parent_turn"),
        turn("root").alias("root_turn"),
        "depth",
        F.col("own").alias("text"),
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return scan_digest(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to a WARC archive and read back."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    return archived(table(spark, sf_dir, "pages"), folder)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return component_ids(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations, rebuilt to share first turns."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that rank highest for every benchmark item."""
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors of highest product with every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_products(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_language_model": op2_language_model,
    "op3_mixing": op3_mixing,
    "op4_quality": op4_quality,
    "op5_decontaminate": op5_decontaminate,
    "op6_quotes": op6_quotes,
    "op7_secrets": op7_secrets,
    "op8_warc": op8_warc,
    "op9_html_text": op9_html_text,
    "op10_simhash": op10_simhash,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_ranked_search": op12_ranked_search,
    "op13_vector_search": op13_vector_search,
}

ORACLE: dict[str, str] = {
    "op1_licenses": license_sql(),
    # Every turn quotes the one before it, so a conversation is one chain of replies.
    "op6_quotes": """
SELECT conv_id, turn, lag(turn) OVER chain AS parent_turn, first_value(turn) OVER chain AS root_turn,
  row_number() OVER chain - 1 AS depth, text
FROM conversations WINDOW chain AS (PARTITION BY conv_id ORDER BY turn)
""",
    "op8_warc": """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
grouped AS (
  SELECT *, max(page_id) OVER same AS first, count(*) OVER same AS times
  FROM sized WINDOW same AS (PARTITION BY html)),
typed AS (
  SELECT *, payload_bytes >= 1000 AND times > 1 AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS again
  FROM grouped)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to
FROM typed
""",
    # CRC-32 of the decimal id bit by bit; a prefix is named by a hash of its turns.
    "op11_prefix_trie": r"""
WITH digested AS (
  SELECT conv_id AS conv, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, digest[:32]) - 1 AS pos FROM digested),
bits AS (
  SELECT DISTINCT conv, list_transform(range(8 * length(conv::VARCHAR)),
    lambda i: ((ascii(substr(conv::VARCHAR, (i // 8 + 1)::INT, 1)) >> (i % 8)::INT) & 1)::UBIGINT) AS bits
  FROM turns),
families AS (
  SELECT conv, xor(list_reduce(list_prepend(4294967295::UBIGINT, bits),
    lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384::UBIGINT)), 4294967295::UBIGINT) % 4 AS h
  FROM bits),
rebuilt AS (
  SELECT f.conv, 0 AS own, t.pos, t.digest, t.words FROM families f JOIN turns t ON t.conv = f.conv - f.conv % 20 AND t.pos < f.h
  UNION ALL
  SELECT f.conv, 1, t.pos, t.digest, t.words FROM families f JOIN turns t ON t.conv = f.conv AND t.pos >= f.h),
placed AS (
  SELECT conv, row_number() OVER (PARTITION BY conv ORDER BY own, pos) AS depth, words,
    sha256(string_agg(digest, '') OVER (PARTITION BY conv ORDER BY own, pos)) AS id,
    count(*) OVER (PARTITION BY conv) AS turns
  FROM rebuilt),
passes AS (
  SELECT conv, depth, id, words, turns = depth AS ends, coalesce(lag(id) OVER (PARTITION BY conv ORDER BY depth), '') AS parent
  FROM placed
  UNION ALL
  SELECT conv, 0, '', 0, conv NOT IN (SELECT conv FROM placed), NULL FROM families),
nodes AS (
  SELECT id, depth, parent, words, min(conv) AS conv, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv::VARCHAR, ',' ORDER BY conv) FILTER (ends), '')) AS ends_sha256
  FROM passes GROUP BY id, depth, parent, words),
children AS (SELECT parent AS id, count(*) AS n_children FROM nodes GROUP BY parent),
subtrees AS (
  SELECT p.id, count(*) FILTER (c.id IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM nodes n LEFT JOIN children c ON c.id = n.id JOIN passes p ON p.conv = n.conv AND p.depth <= n.depth GROUP BY p.id)
SELECT n.conv AS conv_id, n.depth::BIGINT AS depth, up.conv AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
  s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s ON s.id = n.id LEFT JOIN children c ON c.id = n.id LEFT JOIN nodes up ON up.id = n.parent
""",
    "op12_ranked_search": r"""
WITH found AS (
  SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
wanted AS (
  SELECT item, item_id, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL),
sizes AS (SELECT d, count(*) AS n FROM found GROUP BY d),
total AS (SELECT count(*) AS documents, sum(n)::BIGINT AS words FROM sizes),
counted AS (SELECT d, doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
weighted AS (
  SELECT term, floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM counted, total GROUP BY term),
classed AS (SELECT d, 75 + (25 * n * documents) // words AS m FROM sizes, total),
scored AS (
  SELECT item, item_id, d, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM wanted JOIN weighted USING (term) JOIN counted USING (term) JOIN classed USING (d) GROUP BY ALL)
SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW best AS (PARTITION BY item ORDER BY score DESC, doc_id) QUALIFY row_number() OVER best <= 20
""",
    "op13_vector_search": """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 10
""",
}

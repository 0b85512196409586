"""Registered queries of this package. Each applies one operator to its whole table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rubrica.llm.common import table
from rubrica.llm.decontam import contaminated
from rubrica.llm.fuzzylines import dedup_lines
from rubrica.llm.hardneg import hard_negatives
from rubrica.llm.langid import identify
from rubrica.llm.packing import pack_documents
from rubrica.llm.permindex import neighbours
from rubrica.llm.quality import score_documents
from rubrica.llm.ranked import search
from rubrica.llm.sampling import encode_documents
from rubrica.llm.secrets import scan_secrets
from rubrica.llm.simhash import near_duplicates
from rubrica.llm.urlgraph import judge
from rubrica.llm.warc import archived_pages
from rubrica.operators.scratch import scratch_path

#: Where the SentencePiece model of the registered query lies.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Where the byte-level BPE vocabulary of the packing query lies.
TOKENIZER_PATH = "/opt/tokenizers/byte_bpe_50k.json"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op4_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"))


def op5_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), MODEL_PATH)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    return hard_negatives(rows.withColumn("label", label))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), TOKENIZER_PATH)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc, op2_decontamination, op3_url_filter, op4_permutation_index, op5_fuzzy_lines, op6_sentencepiece,
        op7_language, op8_simhash, op9_secrets, op10_quality, op11_hard_negatives, op12_packing, op13_ranked_search,
    )
}
#: The other queries rest on trained models, hashes or searches that SQL does not have; tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op1_warc": """
    WITH p AS (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
    o AS (SELECT d, max(page_id) AS owner FROM p WHERE n >= 1000 GROUP BY d HAVING count(*) > 1)
    SELECT page_id, n AS payload_bytes, d AS payload_digest,
           CASE WHEN owner IS NULL OR owner IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN owner IS DISTINCT FROM page_id THEN owner END AS refers_to,
           replace(replace(url, chr(13), '%0D'), chr(10), '%0A') AS url
    FROM p LEFT JOIN o USING (d)
    """,
    # the walk in 80 rounds, where verdicts have long settled
    "op3_url_filter": r"""
    WITH RECURSIVE p AS (
        SELECT page_id, html, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
               coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    r(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                                        ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
    d AS (
        SELECT page_id, html, host, path, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS node,
               (SELECT arg_max(rhost || rpath, length(rhost || rpath)) FROM r
                WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS rule,
               (SELECT arg_max(verdict, length(rhost || rpath)) FROM r
                WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS decided
        FROM p),
    h AS (SELECT node, avg((decided IS NOT DISTINCT FROM 'allow')::INT) AS a, avg((decided IS NOT DISTINCT FROM 'block')::INT) AS b
          FROM d WHERE node <> '' GROUP BY node),
    k AS (SELECT CASE WHEN a > 0.5 THEN 'trust' ELSE 'distrust' END AS kind, node FROM h WHERE a > 0.5 OR b > 0.5),
    restart AS (SELECT kind, node, 1.0::DOUBLE / count(*) OVER (PARTITION BY kind) AS mass FROM k),
    t AS (SELECT page_id, node AS src, unnest(list_distinct(regexp_extract_all(
              html, '(?i)\bhref\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s<>]+)', 1))) AS raw FROM d WHERE node <> ''),
    l AS (SELECT src, dst, count(*) AS n FROM (SELECT src, regexp_replace(regexp_replace(translate(raw,
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^.*@', ''), ':[0-9]*$', '') AS dst FROM t)
          WHERE dst <> '' AND dst <> src GROUP BY src, dst),
    ways AS (SELECT kind, node, dst, n / sum(n) OVER (PARTITION BY kind, node) AS share
             FROM (SELECT 'trust' AS kind, src AS node, dst, n FROM l UNION ALL SELECT 'distrust', dst, src, n FROM l)),
    walk AS (
        SELECT 0 AS round, kind, node, mass FROM restart
        UNION ALL
        (WITH now AS (SELECT * FROM walk WHERE round < 80)
         SELECT round + 1, kind, node, sum(mass) FROM (
             SELECT now.round, now.kind, ways.dst AS node, 0.85 * now.mass * ways.share AS mass FROM now JOIN ways ON now.kind = ways.kind AND now.node = ways.node
             UNION ALL SELECT o.round, restart.kind, restart.node, 0.15 * restart.mass FROM restart, (SELECT DISTINCT round FROM now) o)
         GROUP BY round, kind, node)),
    m AS (SELECT node, sum(CASE WHEN kind = 'trust' THEN mass ELSE 0 END) AS trust, sum(CASE WHEN kind = 'distrust' THEN mass ELSE 0 END) AS distrust
          FROM walk WHERE round = 80 GROUP BY node)
    SELECT page_id, host, path, rule,
           coalesce(decided, CASE WHEN coalesce(distrust, 0) > 0.5 * (coalesce(trust, 0) + coalesce(distrust, 0)) THEN 'block' ELSE 'allow' END) AS verdict
    FROM d LEFT JOIN m USING (node)
""",
    "op11_hard_negatives": """
    WITH r AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, a.label = o.label AS same, o.vec_id AS other_id,
                 list_inner_product(a.v, o.v)::BIGINT AS score
          FROM r a JOIN r o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id),
    p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
    n AS (SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS rank
          FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
           AND 100 * s.score BETWEEN 80 * p.positive_score AND 100 * p.positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
    """,
    "op13_ranked_search": r"""
    WITH w AS (
        SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents),
    i AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark),
    c AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS tokens FROM w WHERE len(terms) > 0),
    f AS (SELECT doc_id, n, term, count(*) AS tf
          FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM w) GROUP BY doc_id, n, term),
    g AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM f, c GROUP BY term, docs),
    s AS (SELECT item_id, doc_id,
                 sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // tokens)))))::BIGINT AS score
          FROM i JOIN f USING (term) JOIN g USING (term), c GROUP BY item_id, doc_id),
    k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
          FROM s WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
    """,
}

"""The registered query of each operator, over its whole table, with production parameters."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levain.llm import (
    op1_lsh_forest, op2_language, op3_one_bit, op4_bpe_chunks, op5_url_filter, op6_packing, op7_main_text, op8_token_files, op9_exact_topk, op10_pseudonyms,
    op11_toxicity, op12_prefix_trie, op13_hard_negatives,
)
from levain.llm.common import table


def op1_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, copies and number of links of every document."""
    return op1_lsh_forest.join(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    known = op2_language.learn(docs.filter(~op2_language.held_out()))
    found = op2_language.identify(docs, known)
    return found.select("doc_id", op2_language.held_out().alias("held_out"), "lang_pred", "score", "accepted")


def op3_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every vector whose id is divisible by 50."""
    return op3_one_bit.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op4_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return op4_bpe_chunks.digests(op4_bpe_chunks.encode(table(spark, sf_dir, "documents")))


#: (verdict, host, path)
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Sites whose pages make up the list of blocked URLs.
LISTED_SITES = ("ads-track", "spam-farm")


def op5_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL; listed are the canonical URLs of the pages of LISTED_SITES."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.filter(op5_url_filter.host_of(F.col("url")).rlike(rf"(^|\.)({'|'.join(LISTED_SITES)})\."))
    return op5_url_filter.judge(pages, URL_RULES, listed).drop("canonical")


def op6_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket and batch of every document."""
    return op6_packing.packed(table(spark, sf_dir, "documents"), keep=("doc_id",))


def op7_main_text_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, with weights from a bounded sample of labelled pages."""
    pages = table(spark, sf_dir, "pages")
    return op7_main_text.main_text(pages, op7_main_text.learn(pages))


def op8_token_files_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read from the written files."""
    files = op8_token_files.stored(table(spark, sf_dir, "documents"))
    return op8_token_files.checksums(op8_token_files.located(files).select("doc_id", "start", "n_tokens", "ids"))


def op9_exact_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every vector whose id is divisible by 20."""
    return op9_exact_topk.top(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op10_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data under pseudonyms."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op10_pseudonyms.pseudonymise(docs, pii_key(spark), count_col="n_private")


def pii_key(spark: SparkSession) -> str:
    """The secret of the permutations: ``spark.levain.pii.key``, or else a random one for the length of the session."""
    if not spark.conf.get("spark.levain.pii.key", None):
        spark.conf.set("spark.levain.pii.key", secrets.token_hex(32))
    return spark.conf.get("spark.levain.pii.key")


def op11_toxicity_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by the nearest labelled ones that are not held out."""
    return op11_toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return op12_prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), group=20)


def op13_threshold_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 hard negatives for each of the 5 positives of every vector whose id is divisible by 100."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return op13_hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_lsh_forest_join, op2_language_id, op3_one_bit_neighbours, op4_bpe_chunk_reuse, op5_url_verdicts, op6_length_buckets, op7_main_text_of_pages,
              op8_token_files_roundtrip, op9_exact_top20, op10_feistel_pseudonyms, op11_toxicity_votes, op12_conversation_trie, op13_threshold_hard_negatives)
}

#: Whole, finite vectors with a number for each row; floor(scale * x) of each component, as doubles that hold the integers.
_INTEGERS = """
        rows AS (SELECT row_number() OVER () AS n, vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v FROM embeddings
                 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""
_AFTER = "CASE WHEN instr(url, '://') > 0 THEN split_part(substr(url, instr(url, '://') + 3), '#', 1) ELSE '' END"
ORACLES: dict[str, str] = {
    "op9_exact_top20": f"""
        WITH {_INTEGERS.format(scale=64)},
        scored AS (SELECT q.n, q.vec_id AS query_id, r.vec_id, list_inner_product(q.v, r.v)::BIGINT AS score FROM rows q JOIN rows r ON q.vec_id % 20 = 0 AND q.n <> r.n)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
        QUALIFY row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) <= 20
    """,
    "op12_conversation_trie": r"""
        WITH read AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        keyed AS (SELECT conv_id, turn, role, text, md5(length(role) || ':' || role || text) AS key FROM read),
        own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, key) AS pos FROM keyed),
        crc AS (SELECT DISTINCT conv_id AS c, list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ord(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
                        lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))) AS crc FROM own),
        convs AS (SELECT c, xor(crc, 4294967295) % 4 AS h FROM crc),
        rebuilt AS (SELECT c, 0 AS part, pos, key, text FROM convs JOIN own ON conv_id = c - c % 20 AND pos <= h
                    UNION ALL SELECT c, 1, pos, key, text FROM convs JOIN own ON conv_id = c AND pos > h),
        numbered AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS depth, key, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM rebuilt),
        paths AS (SELECT c, depth, words, string_agg(key, '') OVER (PARTITION BY c ORDER BY depth) AS path FROM numbered),
        nodes AS (SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words FROM paths GROUP BY path, depth
                  UNION ALL SELECT '', 0, min(c), count(*), 0 FROM convs HAVING count(*) > 0),
        children AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
        below AS (SELECT n.path, (n.n_convs - 1) * n.words AS saved, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf, unnest(generate_series(0, n.depth)) AS up FROM nodes n LEFT JOIN children k ON k.path = n.path),
        sums AS (SELECT left(path, 32 * up) AS path, sum(saved) AS saved, sum(leaf) AS leaves FROM below GROUP BY 1),
        finals AS (SELECT convs.c, coalesce(max_by(path, depth), '') AS path FROM convs LEFT JOIN paths ON paths.c = convs.c GROUP BY convs.c),
        ends AS (SELECT path, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS digest FROM finals GROUP BY path)
        SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
               coalesce(e.digest, sha256('')) AS ends_sha256
        FROM nodes n JOIN sums s ON s.path = n.path LEFT JOIN children k ON k.path = n.path LEFT JOIN ends e ON e.path = n.path
        LEFT JOIN nodes up ON n.depth > 0 AND up.path = left(n.path, length(n.path) - 32)
    """,
    "op13_threshold_hard_negatives": f"""
        WITH {_INTEGERS.format(scale=256)},
        labelled AS (SELECT n, vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM rows WHERE label IS NOT NULL),
        scored AS (SELECT a.n, a.vec_id AS anchor_id, r.vec_id, r.n AS other, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
                   FROM labelled a JOIN labelled r ON a.vec_id % 100 = 0 AND a.n <> r.n),
        positives AS (SELECT n, anchor_id, other, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
                      QUALIFY row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) <= 5),
        ranked AS (SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                          row_number() OVER (PARTITION BY p.n, p.other ORDER BY s.score DESC, s.vec_id) AS rank
                   FROM positives p JOIN scored s ON s.n = p.n AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
    """,
    "op5_url_verdicts": f"""
        WITH cut AS (SELECT page_id, coalesce({_AFTER}, '') AS rest FROM pages),
        parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?]*[?](.*)$', 1) AS query FROM cut),
        named AS (SELECT page_id, host, path, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':(80|443)$', ''), '^www[.]', '')
                         || regexp_replace(path, '/+$', '')
                         || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(query, '&'),
                                lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&'), ''), '') AS name FROM parts),
        listed AS (SELECT DISTINCT name FROM named WHERE regexp_matches(host, '(^|[.])(ads-track|spam-farm)[.]')),
        rules(verdict, rule_host, rule_path) AS (VALUES {', '.join(str(r) for r in URL_RULES)}),
        fits AS (SELECT page_id, rule_host || rule_path AS rule, r.verdict,
                        row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, rule_host || rule_path) AS n
                 FROM named JOIN rules r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
        SELECT named.page_id, host, path, fits.rule, coalesce(fits.verdict, CASE WHEN host <> '' AND listed.name IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
        FROM named LEFT JOIN fits ON named.page_id = fits.page_id AND fits.n = 1 LEFT JOIN listed ON named.name = listed.name
    """,
}

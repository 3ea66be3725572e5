"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from ohlcraft.llm import alignment, attribution, bestfit, dedup, html, lexical, licences, mixing, neighbours, packing, quality, sharding, warc
from ohlcraft.llm.common import new_folder, stage, table

SEQUENCE_TOKENS = 1024
BEST_FIT_TOKENS = 2048
SHARDS = 24


def op1_harmonic_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), SEQUENCE_TOKENS)


def op2_subset_sum_mixing(spark, sf_dir):
    return mixing.mix_counts(table(spark, sf_dir, "documents")).drop("copies")


def op3_wrapper_induction(spark, sf_dir):
    return html.main_texts(table(spark, sf_dir, "pages"))


def op4_bayes_near_duplicates(spark, sf_dir):
    return dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op5_licence_classifier(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents"))


def op6_indexed_warc(spark, sf_dir):
    index = warc.write_archives(table(spark, sf_dir, "pages"), new_folder(spark, "warc"))
    return warc.resolved(stage(warc.read_records(index, payloads=False), "warc-records"))


def op7_nn_descent(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op8_quality_divergence(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"))


def op9_offset_attribution(spark, sf_dir):
    return attribution.section_tokens(table(spark, sf_dir, "documents"))


def op10_jump_sharding(spark, sf_dir):
    return sharding.jump_sharding(table(spark, sf_dir, "documents"), SHARDS)


def op11_stratified_search(spark, sf_dir):
    index = lexical.build_index(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"))


def op12_certified_best_fit(spark, sf_dir):
    return bestfit.pack_documents(table(spark, sf_dir, "documents"), BEST_FIT_TOKENS)


def op13_pair_alignment(spark, sf_dir):
    return alignment.align_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_harmonic_packing": op1_harmonic_packing,
    "op2_subset_sum_mixing": op2_subset_sum_mixing,
    "op3_wrapper_induction": op3_wrapper_induction,
    "op4_bayes_near_duplicates": op4_bayes_near_duplicates,
    "op5_licence_classifier": op5_licence_classifier,
    "op6_indexed_warc": op6_indexed_warc,
    "op7_nn_descent": op7_nn_descent,
    "op8_quality_divergence": op8_quality_divergence,
    "op9_offset_attribution": op9_offset_attribution,
    "op10_jump_sharding": op10_jump_sharding,
    "op11_stratified_search": op11_stratified_search,
    "op12_certified_best_fit": op12_certified_best_fit,
    "op13_pair_alignment": op13_pair_alignment,
}

SQL = {
    # base32 from the hexadecimal digits, four characters from five of them
    "op6_indexed_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS hex,
             min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(hex, (i // 4 * 5 + 1)::INTEGER, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM d""",
    # crc32 by its bits: DuckDB has no such function
    "op10_jump_sharding": f"""
WITH RECURSIVE t AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
steps AS (
  SELECT doc_id, (coalesce(doc_id, 0)::HUGEINT + 18446744073709551616) % 18446744073709551616 AS k,
         -1::BIGINT AS here, -1::BIGINT AS prior, 0::BIGINT AS jump FROM t
  UNION ALL
  SELECT doc_id, n, jump, here, floor((jump + 1) * (2147483648.0::DOUBLE / ((n // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT *, (k * {sharding.MULTIPLIER} + 1) % 18446744073709551616 AS n FROM steps WHERE jump <= {SHARDS})),
shards AS (
  SELECT doc_id, CASE WHEN here < {SHARDS} THEN here ELSE prior END::INTEGER AS shard, here::INTEGER AS grown_shard
  FROM steps WHERE jump > {SHARDS}),
crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, u: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)
              ORDER BY i) AS tab FROM range(256) r(i)),
crc AS (
  SELECT doc_id, octet_length(b)::BIGINT + 8 AS size,
         xor(list_reduce(range(1, octet_length(b) + 1),
             lambda c, i: xor(c // 256, tab[xor(c % 256, ('0x' || hex(b[i:i]))::BIGINT) + 1]), 4294967295), 4294967295) AS text_crc32
  FROM t, crc_table)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard
FROM crc JOIN shards USING (doc_id)""",
    "op11_stratified_search": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
p AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf
      FROM (SELECT doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM p, s GROUP BY term, docs),
r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN p USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 10""",
}

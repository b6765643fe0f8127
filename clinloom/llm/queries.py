"""The operators' registered queries, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom.llm import jaccard, labelled, lexical, mixing, pieces, quality, sharding, suffix, templates, tokenfiles, topk, toxicity, trie, winnow
from clinloom.llm.common import new_store, table


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.with_copies(documents, mixing.mix_plan(documents, new_store(spark)))
    return mixed.select("doc_id", "_mix.size", "_mix.source_size", "_mix.target", "_mix.taken", "_mix.copies")


def op2_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.kd_shards(table(spark, sf_dir, "documents"), new_store(spark), shards=16, copies_together=True)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_branch_and_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), new_store(spark), lambda vec_id: vec_id % 50 == 0)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    shards = tokenfiles.write_tokens(table(spark, sf_dir, "documents"), new_store(spark), public_tokenizers.path("word_bpe_49k.json"))
    return tokenfiles.read_tokens(shards)


def op5_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.deduplicated(table(spark, sf_dir, "documents"), new_store(spark))


def op6_fragment_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), new_store(spark))


def op7_winnow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.repeated_lines(table(spark, sf_dir, "documents"), new_store(spark)).drop("text_key")


def op7_winnow_long_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.repeated_lines(table(spark, sf_dir, "documents"), new_store(spark), alone=winnow.ALONE_WORDS).drop("text_key")


def op8_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, kept = table(spark, sf_dir, "documents"), labelled.fold(F.col("doc_id"), 5)
    model = quality.fit(documents, table(spark, sf_dir, "labels"), kept != 0)
    return quality.score_documents(documents, model).select(
        "doc_id", F.coalesce(kept == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "difference"
    )


def op9_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), new_store(spark))


def op10_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, kept = table(spark, sf_dir, "documents"), labelled.fold(F.col("doc_id"), 3)
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"), kept != 1)
    return toxicity.score_documents(documents, model).select(
        "doc_id", F.coalesce(kept == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "worst_sentence", "worst_score", "worst_words", "sentences",
    )


def op11_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"), new_store(spark)).withColumn("depth", F.col("depth").cast("long"))


def op13_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), new_store(spark))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pareto_mix, op2_kd_shards, op3_branch_and_bound, op4_token_files, op5_suffix_arrays, op6_fragment_jaccard, op7_winnow_lines, op7_winnow_long_lines, op8_compression_quality, op9_template_leaks,
        op10_noisy_or_toxicity, op11_piece_agenda, op12_prefix_trie, op13_reversed_search,
    )
}
ORACLES: dict[str, str] = {
    "op3_branch_and_bound": """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings WHERE len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.e, c.e)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op7_winnow_lines": """
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) - 1 AS pos, unnest(ls) AS line, len(ls) AS n
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
w AS (SELECT doc_id, pos, n, line, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS line2 FROM l),
f AS (SELECT *, row_number() OVER (PARTITION BY line, line2 ORDER BY doc_id, pos) AS place FROM w WHERE line2 IS NOT NULL),
g AS (SELECT DISTINCT doc_id, n, unnest([pos, pos + 1]) AS line FROM f WHERE place > 1)
SELECT doc_id, CAST(max(n) AS INTEGER) AS n_lines, count(*) AS n_removed, list_sort(list(CAST(line AS INTEGER))) AS removed
FROM g GROUP BY doc_id
""",
    "op7_winnow_long_lines": """
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) - 1 AS pos, unnest(ls) AS line, len(ls) AS n
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
w AS (SELECT doc_id, pos, n, line, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS line2 FROM l),
r AS (
  SELECT doc_id, pos, n, line, line2, 2 AS height FROM w WHERE line2 IS NOT NULL
  UNION ALL SELECT doc_id, pos, n, line, NULL, 1 FROM l WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= 8),
f AS (SELECT *, row_number() OVER (PARTITION BY height, line, line2 ORDER BY doc_id, pos) AS place FROM r),
g AS (SELECT DISTINCT doc_id, n, unnest(CASE height WHEN 2 THEN [pos, pos + 1] ELSE [pos] END) AS line FROM f WHERE place > 1)
SELECT doc_id, CAST(max(n) AS INTEGER) AS n_lines, count(*) AS n_removed, list_sort(list(CAST(line AS INTEGER))) AS removed
FROM g GROUP BY doc_id
""",
    "op1_pareto_mix": """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
         (CAST('0x' || substr(md5('17:' || doc_id), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS w FROM d GROUP BY source),
o AS (
  SELECT *, (SELECT sum(source_size) FROM s)::DOUBLE AS total, row_number() OVER (ORDER BY 3 * source_size / w, source) AS place FROM s),
c AS (
  SELECT *, (total - coalesce(sum(3 * source_size) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(w) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS share FROM o),
f AS (SELECT min(place) AS first_open, arg_min(share, place) AS share FROM c WHERE share * w <= 3 * source_size),
t AS (
  SELECT source, source_size, CASE WHEN place >= first_open THEN f.share * w ELSE (3 * source_size)::DOUBLE END AS target FROM c, f),
a AS (SELECT d.*, 1000 + least(size, 1000) AS a, t.source_size, t.target FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
g AS (SELECT source, target, a, sum(size) AS words FROM a GROUP BY ALL),
r AS (
  SELECT source, a, (target - 3 * coalesce(sum(words) OVER (PARTITION BY source ORDER BY a DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(words * a) OVER (PARTITION BY source ORDER BY a DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rate FROM g),
b AS (SELECT source, arg_max(rate, a) AS rate FROM r WHERE rate * a <= 3 GROUP BY source),
e AS (SELECT a.*, least(3.0::DOUBLE, coalesce(b.rate, 0) * a.a::DOUBLE) AS e FROM a LEFT JOIN b ON a.source IS NOT DISTINCT FROM b.source),
q AS (
  SELECT *, floor(e)::BIGINT AS whole, CASE WHEN e - floor(e) > 0 THEN u / (1 - u) * ((1 - (e - floor(e))) / (e - floor(e))) END AS q,
         target - (sum(size * floor(e)::BIGINT) OVER (PARTITION BY source))::DOUBLE AS need FROM e),
x AS (
  SELECT *, CASE WHEN q IS NOT NULL AND 2 * coalesce(sum(CASE WHEN q IS NOT NULL THEN size END) OVER (
    PARTITION BY source ORDER BY q NULLS LAST, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE + size <= 2 * need THEN 1 ELSE 0 END AS extra FROM q)
SELECT doc_id, size, source_size, target, CAST(size * (whole + extra) AS BIGINT) AS taken, whole + extra AS copies FROM x
""",
    "op6_fragment_jaccard": """
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
k AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, k.y FROM r JOIN k ON k.x = r.reached)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reached) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
""",
    "op12_prefix_trie": """
WITH RECURSIVE t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS body, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), digest) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
b(n, k, v) AS (SELECT n, 0, n FROM range(256) r(n) UNION ALL SELECT n, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM b WHERE k < 8),
r(conv_id, i, c) AS (
  SELECT DISTINCT conv_id, 0, 4294967295::BIGINT FROM t
  UNION ALL SELECT conv_id, i + 1, xor(c >> 8, v) FROM r JOIN b ON k = 8 AND n = xor(c, ascii(substr(conv_id::VARCHAR, i + 1, 1))) & 255 WHERE i < length(conv_id::VARCHAR)),
h AS (SELECT conv_id, xor(c, 4294967295) % 4 AS h FROM r WHERE i = length(conv_id::VARCHAR)),
u AS (
  SELECT h.conv_id, 0 AS part, pos, digest, words FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 20 AND pos <= h
  UNION ALL SELECT h.conv_id, 1, pos, digest, words FROM h JOIN t ON t.conv_id = h.conv_id AND pos > h),
v AS (
  SELECT conv_id, row_number() OVER o AS depth, string_agg(digest, '') OVER o AS key, words FROM u WINDOW o AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL SELECT conv_id, 0, '', 0 FROM h),
m AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM v),
n AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM m GROUP BY key, depth),
k AS (SELECT left(key, length(key) - 32) AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
x AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (key))
SELECT a.conv_id, CAST(a.depth AS BIGINT) AS depth, any_value(p.conv_id) AS parent_conv_id, a.n_convs, a.n_children,
       count(*) FILTER (WHERE s.n_children = 0) AS n_leaves, CAST(sum((s.n_convs - 1) * s.words) AS BIGINT) AS saved_tokens, a.ends_sha256
FROM x a JOIN x s ON starts_with(s.key, a.key) LEFT JOIN x p ON a.depth > 0 AND p.key = left(a.key, length(a.key) - 32)
GROUP BY a.key, a.conv_id, a.depth, a.n_convs, a.n_children, a.ends_sha256
""",
    "op13_reversed_search": """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
i AS (
  SELECT item_id, row_number() OVER () AS item, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, row, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT row, count(*) AS n FROM d GROUP BY row),
a AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, a GROUP BY term, docs),
q AS (SELECT item_id, item, term, count(*) AS times FROM i GROUP BY ALL),
s AS (
  SELECT item_id, item, doc_id, row, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n USING (row), a GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 20
""",
}

"""The queries of this package over the driver's tables, and SQL that says the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from switchyard.llm import (
    bagminhash,
    centroids,
    language_id,
    line_dedup,
    multi_index,
    packing,
    periodic_runs,
    ppm,
    quality,
    sentencepiece_codec,
    token_files,
    topk,
    url_filter,
)
from switchyard.llm.arrowtext import fold_crc
from switchyard.storage import materialize, shared_dir

URL_RULES = [
    url_filter.parse_rule("block", "com/en/"),
    url_filter.parse_rule("allow", "example.com/en/7"),
    url_filter.parse_rule("allow", "net/de/"),
    url_filter.parse_rule("block", "example.net/de/8"),
    url_filter.parse_rule("block", "org/es/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(modulus: int):
    """Whether a document is kept out of training."""
    return F.pmod(fold_crc("doc_id"), F.lit(modulus)) == 0


def fit_quality(docs: DataFrame, labels: DataFrame) -> quality.QualityModel:
    return quality.fit(docs.where(~held_out(5)), labels.where(~held_out(5)))


def fit_languages(docs: DataFrame) -> language_id.LanguageModels:
    return language_id.fit(docs.where(~held_out(5)))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, fit_quality(docs, table(spark, sf_dir, "labels")), held_out=held_out(5))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, fit_languages(docs), held_out=held_out(5))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document, by words and by the byte model."""
    return ppm.score(table(spark, sf_dir, "documents"), held_out=held_out(10))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids (as digests), the decoded text's hash and parity for every document."""
    return sentencepiece_codec.digest(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), parity_every=1)


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    scaled = F.transform(F.col("embedding"), lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("double"))
    whole = vectors.where(topk.usable("embedding")).select(F.monotonically_increasing_id().alias("line"), "vec_id", scaled.alias("vector"))
    whole = materialize(whole, "top-k-rows")  # so that a row's number is the same on both sides
    return topk.top_k(whole, whole.where(F.col("vec_id") % 50 == 0), row="line")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept of every document."""
    docs = table(spark, sf_dir, "documents")
    keys = line_dedup.frequent_line_keys(docs, min_docs=10)
    report = line_dedup.line_report(docs, keys)
    return report.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in windows of 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def with_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, every document with h % 10 = 0 (h: crc32 of its id) ending in a repeated stretch.

    Of its n words those from a = g % n on (g = h div 10) become repeats of the first p from there, where
    p = 1 + (n - a) div (3 + g % 8); words are joined by one space then.
    """
    words = F.filter(F.split("text", "[ \\t-\\r]+"), lambda w: w != "")
    cut = docs.select("doc_id", "text", fold_crc("doc_id").alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    cut = cut.withColumn("n", F.size("words").cast("long")).withColumn("g", F.expr("h div 10"))
    cut = cut.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = F.expr("slice(flatten(array_repeat(slice(words, cast(a as int) + 1, cast(p as int)), cast((n - a) div p as int) + 1)), 1, cast(n - a as int))")
    made = F.array_join(F.concat(F.expr("slice(words, 1, cast(a as int))"), tail), " ")
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words, some documents being made to end in one."""
    found = periodic_runs.find_runs(with_tails(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, F.concat(r.period.cast("string"), F.lit("\n")))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after ten rounds, with inertia and the digest of its centroid."""
    return centroids.report(centroids.cluster(table(spark, sf_dir, "embeddings")))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and digest in bit-packed token files, read back from them."""
    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer_file("byte_bpe_50k.json"))
    return token_files.read(spark, path)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_minhash": op2_minhash,
        "op3_language_id": op3_language_id,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_sentencepiece": op5_sentencepiece,
        "op6_topk": op6_topk,
        "op7_line_dedup": op7_line_dedup,
        "op8_embedding_dedup": op8_embedding_dedup,
        "op9_packing": op9_packing,
        "op10_url_filters": op10_url_filters,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_centroids": op12_centroids,
        "op13_token_files": op13_token_files,
        "pipeline": pipeline,
    }


#: A-Z alone in lower case (lower() folds all letters).
_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: No component is null, NaN or infinite, and there is one.
_FINITE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

_OP10_SQL = f"""
WITH rules(rule, rule_host, rule_path, rule_verdict) AS (VALUES
    ('com/en/', 'com', '/en/', 'block'), ('example.com/en/7', 'example.com', '/en/7', 'allow'),
    ('net/de/', 'net', '/de/', 'block'), ('example.net/de/8', 'example.net', '/de/8', 'block'),
    ('org/es/', 'org', '/es/', 'block')),
cut AS (
    SELECT page_id, row_number() OVER () AS rn,
        CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
    FROM pages),
parts AS (
    SELECT page_id, rn, {_ASCII_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut),
fits AS (
    SELECT p.rn, r.rule, r.rule_verdict,
        row_number() OVER (PARTITION BY p.rn ORDER BY length(r.rule) DESC, r.rule DESC) AS place
    FROM parts p JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.rule_verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.rn = p.rn AND f.place = 1
"""

_OP6_SQL = f"""
WITH numbered AS MATERIALIZED (SELECT row_number() OVER () AS rn, vec_id, embedding FROM embeddings),
whole AS MATERIALIZED (
    SELECT rn, vec_id, list_transform(embedding, lambda x: CAST(floor(256.0 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM numbered
    WHERE {_FINITE}),
scored AS (
    SELECT q.rn, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.rn <> q.rn AND len(c.v) = len(q.v)),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY rn ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_OP8_SQL = f"""
WITH RECURSIVE numbered AS MATERIALIZED (SELECT row_number() OVER () AS rn, vec_id, label, embedding FROM embeddings),
whole AS MATERIALIZED (
    SELECT rn, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM numbered
    WHERE label IS NOT NULL AND vec_id IS NOT NULL AND {_FINITE}
    AND list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) > 0),
links AS MATERIALIZED (
    SELECT a.rn AS u, b.rn AS v FROM whole a JOIN whole b
    ON a.label = b.label AND a.rn <> b.rn AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reached AS (
    SELECT rn AS u, rn AS v FROM numbered
    UNION
    SELECT r.u, l.v FROM reached r JOIN links l ON r.v = l.u),
least AS (SELECT r.u, min(n.vec_id) AS component_id FROM reached r JOIN numbered n ON n.rn = r.v GROUP BY r.u),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, e.vec_id IS NOT DISTINCT FROM l.component_id AS kept
FROM numbered e JOIN least l ON l.u = e.rn LEFT JOIN counts c ON c.u = e.rn
"""

_KEY = _ASCII_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")

_OP7_SQL = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS rn, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
numbered AS (SELECT doc_id, rn, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (SELECT doc_id, rn, pos, line, {_KEY} AS key FROM numbered),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rn) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE key IN (SELECT key FROM frequent)) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE key NOT IN (SELECT key FROM frequent)), '')) AS kept_sha256
FROM keyed GROUP BY rn, doc_id
"""

#: crc32 of the decimal text of doc_id, bit by bit; it has no name in DuckDB.
_CRC = (
    "xor(list_reduce(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda s, b: "
    "list_reduce([CAST(1 AS BIGINT) for _ in range(8)], lambda v, _i: xor(v >> 1, 3988292384 * (v & 1)), xor(s, b)), CAST(4294967295 AS BIGINT)), 4294967295)"
)

_OP11_SQL = f"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS rn, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') AS words,
        CASE WHEN doc_id IS NULL THEN 0 ELSE {_CRC} END AS h FROM documents),
sized AS MATERIALIZED (SELECT *, CAST(len(words) AS BIGINT) AS n, h // 10 AS g FROM docs),
ends AS MATERIALIZED (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM sized),
tails AS MATERIALIZED (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM ends),
flat AS (SELECT rn, words, a, p, unnest(range(n)) AS i FROM tails),
w AS MATERIALIZED (SELECT rn, i, words[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1] AS word FROM flat),
grams AS MATERIALIZED (
    SELECT rn, i, hash(word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS gram,
        lead(word, 4) OVER o IS NOT NULL AS five, [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o] AS five_words
    FROM w WINDOW o AS (PARTITION BY rn ORDER BY i)),
pairs AS (
    SELECT x.rn, x.i, y.i - x.i AS p FROM grams x JOIN grams y ON x.rn = y.rn AND x.gram = y.gram AND x.i < y.i
    WHERE x.five AND y.five AND x.five_words = y.five_words),
isles AS (SELECT rn, p, i, i - row_number() OVER (PARTITION BY rn, p ORDER BY i) AS isle FROM pairs),
reps AS (
    SELECT rn, min(i) AS start, count(*) + 4 + p AS length, p AS period FROM isles GROUP BY rn, p, isle
    HAVING count(*) + 4 + p >= greatest(6, 4 * p)),
runs AS MATERIALIZED (SELECT rn, start, length, min(period) AS period FROM reps GROUP BY rn, start, length),
gone AS (SELECT DISTINCT rn, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
    SELECT w.rn, string_agg(w.word, ' ' ORDER BY w.i) AS collapsed FROM w ANTI JOIN gone ON w.rn = gone.rn AND w.i = gone.i GROUP BY w.rn),
best AS (
    SELECT rn, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS listed,
        first(start ORDER BY length DESC, start, period) AS start, first(length ORDER BY length DESC, start, period) AS length,
        first(period ORDER BY length DESC, start, period) AS period
    FROM runs GROUP BY rn)
SELECT d.doc_id, coalesce(b.n_runs, 0) AS n_runs, b.start, b.length, b.period, (1000 * b.length) // b.period AS exponent_milli,
    sha256(coalesce(b.listed, '')) AS runs_sha256, sha256(coalesce(k.collapsed, '')) AS collapsed_sha256
FROM docs d LEFT JOIN best b ON b.rn = d.rn LEFT JOIN kept k ON k.rn = d.rn
"""


def _op12_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds one by one: assign by exact distance, then the floor of each component's mean."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS (SELECT p.rn, c.cluster, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance FROM points p, c{r} c),
a{r} AS MATERIALIZED (SELECT rn, first(cluster ORDER BY distance, cluster) AS cluster, min(distance) AS distance FROM d{r} GROUP BY rn)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT a.cluster, s.i, sum(p.v[s.i]) AS s, count(*) AS n FROM a{r} a JOIN points p ON p.rn = a.rn, (SELECT unnest(range(1, 65)) AS i) s GROUP BY a.cluster, s.i),
n{r} AS (SELECT cluster, list(CAST((s - (((s % n) + n) % n)) // n AS BIGINT) ORDER BY i) AS v FROM m{r} GROUP BY cluster),
c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(n.v, c.v) AS v FROM c{r} c LEFT JOIN n{r} n ON n.cluster = c.cluster)""")
    return f"""
WITH points AS MATERIALIZED (
    SELECT row_number() OVER () AS rn, vec_id, list_transform(embedding, lambda x: CAST(floor(1024.0 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), ''))) - 1 AS cluster, v
    FROM points ORDER BY cluster LIMIT {k}),{",".join(steps)}
SELECT p.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
    CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN points p ON p.rn = a.rn JOIN c{rounds} c ON c.cluster = a.cluster
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_topk": _OP6_SQL,
        "op7_line_dedup": _OP7_SQL,
        "op8_embedding_dedup": _OP8_SQL,
        "op10_url_filters": _OP10_SQL,
        "op11_periodic_runs": _OP11_SQL,
        "op12_centroids": _op12_sql(),
    }

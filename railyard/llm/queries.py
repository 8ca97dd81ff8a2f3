"""The registered queries of this subpackage, each over its whole table, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import exact_dedup, hard_negatives, language_id, mixing, near_dedup, packing, quality, repeats, runs, sentence_pieces, token_counts, vectors, warc
from railyard.llm.tables import SPACE, read


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode_documents(read(spark, sf_dir, "documents"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, sf_dir, "documents")).drop("kept")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_archive(read(spark, sf_dir, "pages"))
    return warc.describe(warc.read_records(spark, archive))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"))


def repeating(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: of one document in ten, by a digest of its id, the words from some place on repeat."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"[^{SPACE}]+"), 0))
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("w")).withColumn("n", F.size("w").cast("long"))
    at = cut.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))) \
        .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    period = F.slice("w", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), (F.col("n") - F.col("a")).cast("int"))
    made = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), tail), " ")
    return at.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(repeating(read(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    digest = F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("").cast("binary"), 256)
    return found.withColumn("r", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("r.s")).alias("start"), F.col("r.length").alias("length"),
        (-F.col("r.p")).alias("period"), F.floor(1000 * F.col("r.length") / -F.col("r.p")).alias("exponent_milli"),
        digest.alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    rows = table.select("vec_id", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
                        F.transform("embedding", lambda x: 256 * x.cast("double")).alias("vector"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_pareto_mix": op2_pareto_mix,
    "op3_posting_lists": op3_posting_lists,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_repeats": op5_repeats,
    "op6_quality": op6_quality,
    "op7_warc_archive": op7_warc_archive,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_language_id": op9_language_id,
    "op10_token_counts": op10_token_counts,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_best_fit_packing": op13_best_fit_packing,
}

ORACLES: dict[str, str] = {
    "op1_minhash": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
            FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
        links AS (
            SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION SELECT reach.a, edges.b FROM reach JOIN edges ON edges.a = reach.b),
        least_id AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least_id ON least_id.a = d.doc_id""",
    "op2_pareto_mix": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size)::DOUBLE AS stop,
                   [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
            FROM sized GROUP BY source),
        filled AS (
            SELECT *, coalesce(sum(stop) OVER before, 0.0)::DOUBLE AS stops_before,
                   (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS wanted,
                   sum(weight) OVER () - coalesce(sum(weight) OVER before, 0.0) AS weight_left
            FROM sources
            WINDOW before AS (ORDER BY stop / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        water AS (
            SELECT arg_min((wanted - stops_before) / weight_left, stops_before) AS level FROM filled
            WHERE (wanted - stops_before) / weight_left * weight < stop),
        targets AS (
            SELECT source, source_size,
                   CASE WHEN level IS NULL THEN stop ELSE least(stop, level * weight) END AS target
            FROM filled CROSS JOIN water),
        drawn AS (
            SELECT s.doc_id, s.size, s.source, t.source_size, t.target,
                   CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS expected,
                   (('0x' || substr(md5('mix:' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5)
                       / 4503599627370496.0::DOUBLE AS u
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
        parts AS (
            SELECT *, floor(expected) AS whole, expected - floor(expected) AS p,
                   target - floor(expected) * source_size AS missing FROM drawn),
        front AS (
            SELECT doc_id, size, source,
                   sum(size) OVER (PARTITION BY source ORDER BY (u / (1.0::DOUBLE - u)) / (p / (1.0::DOUBLE - p)), doc_id, size
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE - size / 2.0::DOUBLE <= missing AS extra
            FROM parts WHERE p > 0 AND size > 0)
        SELECT parts.doc_id, parts.size, source_size, target,
               (parts.size * (whole + coalesce(extra, false)::INT))::BIGINT AS taken
        FROM parts LEFT JOIN front ON front.doc_id = parts.doc_id""",
    "op7_warc_archive": """
        WITH rows AS (
            SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
        kept AS (SELECT html, max(page_id) AS keeper FROM rows WHERE n >= 1000 GROUP BY html)
        SELECT page_id, n AS payload_bytes, sha1(rows.html) AS payload_digest,
               CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN keeper <> page_id THEN keeper END AS refers_to
        FROM rows LEFT JOIN kept ON kept.html = rows.html AND n >= 1000""",
    "op8_exact_dedup": r"""
        WITH norm AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM norm""",
    "op12_hard_negatives": """
        WITH rows AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
            FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN pairs USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY rank <= 5""",
}

"""The operators and the pipeline as queries over the driver's tables: thin digests of their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, centroids, collocations, exact_dedup, html_extract, langid, licenses, mixing, order_minhash, sentencepieces, simhash, substring_dedup, token_files
from .textkit import crc_bucket, read_table

#: Names of the public tokenizer files; a parameter of the operators, never part of this repository.
PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"
BYTES = "byte_bpe_50k.tiktoken"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.round_trip(read_table(spark, sf_dir, "documents"), tokenizer_path(PIECES))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edit_report(read_table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = crc_bucket("doc_id", 5)
    model = langid.train(docs.filter(fold != 0))
    found = langid.with_language(docs.select("doc_id", "text", (fold == 0).alias("held_out")), model)
    return found.select(
        "doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected")
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.taken(docs)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_corpus(read_table(spark, sf_dir, "documents"), tokenizer_path(WORDS), end_id=2)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(read_table(spark, sf_dir, "documents"), words=3, radius=2)
    return groups.select(F.col("doc").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"), digest=True)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept_text")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.round_trip(read_table(spark, sf_dir, "documents"), tokenizer_path(BYTES), public_tokenizers.PATTERN)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(read_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {f.__name__: f for f in (
        op1_sentencepiece, op2_order_minhash, op3_html_extraction, op4_language_id, op5_mixing, op6_token_files,
        op7_simhash, op8_licenses, op9_exact_dedup, op10_substring_dedup, op11_byte_bpe, op12_collocations, op13_centroids,
    )}
    import corpus_pipeline

    found["pipeline"] = corpus_pipeline.run
    return found


_SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

#: A round of clustering in SQL: assignments to centroids i, as 64 * distance + centroid, and centroids i + 1.
_ROUND = """
        a{i} AS MATERIALIZED (SELECT q.v, q.id, min(64 * list_sum(list_transform(range(1, 65), lambda j: (q.v[j] - c.v[j]) * (q.v[j] - c.v[j])))::HUGEINT + c) AS m
              FROM q, c{i} AS c GROUP BY q.id, q.v),
        s{i} AS (SELECT m % 64 AS c, j, sum(v[j])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{i}, range(1, 65) AS t(j) GROUP BY ALL),
        l{i} AS (SELECT c, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY j) AS v FROM s{i} GROUP BY c),
        c{n} AS MATERIALIZED (SELECT c.c, coalesce(l.v, c.v) AS v FROM c{i} AS c LEFT JOIN l{i} AS l ON c.c = l.c),"""

ORACLES = {
    "op12_collocations": r"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
        e AS (SELECT lang, w, words, unnest(range(1, len(w) - words + 2)) AS i FROM p, range(1, 4) AS t(words)),
        f AS MATERIALIZED (SELECT lang, words, array_to_string(w[i:i + words - 1], ' ') AS phrase, count(*) AS a FROM e GROUP BY ALL),
        c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words >= 2 AND a >= 10),
        k AS (SELECT c.*, k, array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail FROM c, range(1, 3) AS t(k) WHERE k < words),
        s AS (SELECT k.lang, k.words, k.phrase, k.w, k.k, k.a, h.a AS l, t.a AS r, (1000000::HUGEINT * k.a * k.a) // (h.a::HUGEINT * t.a) AS score
              FROM k JOIN f AS h ON h.lang = k.lang AND h.phrase = head JOIN f AS t ON t.lang = k.lang AND t.phrase = tail),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        o AS (SELECT lang, phrase, max(a) AS most FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
              FROM c WHERE words = 3) GROUP BY lang, phrase),
        n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang)
        SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score::BIGINT AS score
        FROM b JOIN n ON n.lang = b.lang LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase
        WHERE most IS NULL OR 100 * most < 50 * a QUALIFY rank <= 2000""",
    "op13_centroids": """
        WITH q AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
              FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v FROM q QUALIFY c < 40),"""
    + "".join(_ROUND.format(i=i, n=i + 1) for i in range(6))
    + """
        f AS (SELECT id, (m % 64)::INT AS cluster, (m // 64)::BIGINT AS distance FROM a5)
        SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
               (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c5.v, ',')) AS centroid_sha256
        FROM f JOIN q USING (id) JOIN c5 ON c5.c = f.cluster""",
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op5_mixing": f"""
        WITH d AS (SELECT doc_id, source, {_SIZE}::BIGINT AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        r AS (SELECT *, row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1 AS rank FROM s),
        w AS (SELECT *, [5, 2, 1][(rank % 3 + 1)::INT]::BIGINT AS w, 3 * source_size AS cap FROM r),
        c AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS ws,
                     coalesce(sum(cap) OVER o, 0) AS cb, coalesce(sum(w) OVER o, 0) AS wb
              FROM w WINDOW o AS (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        k AS (SELECT *, cap::DOUBLE / w <= (total - cb)::DOUBLE / (ws - wb)::DOUBLE AS capped FROM c),
        t AS (SELECT source, source_size, rank, CASE WHEN capped THEN cap::DOUBLE ELSE
                 w::DOUBLE * (total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0))::DOUBLE
                 / (sum(CASE WHEN NOT capped THEN w END) OVER ())::DOUBLE END AS target FROM k),
        p AS (SELECT d.*, source_size, rank, target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(doc_id::VARCHAR)
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        n AS (SELECT *, CASE WHEN size = 0 THEN 0 ELSE
                 least(greatest(floor((target - start - size / 2.0) / source_size) + 1, 0), 3) END::BIGINT AS times FROM p),
        e AS (SELECT *, unnest(range(times)) AS pass FROM n),
        f AS (SELECT *, least((start + pass * source_size)::DOUBLE / target, 1.0::DOUBLE) AS x FROM e),
        o AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN x >= 1.0::DOUBLE THEN 1.0::DOUBLE
                 WHEN rank % 3 = 0 THEN (sqrt(greatest(0.0::DOUBLE, 2.25::DOUBLE - 2.0::DOUBLE * x)) - 1.5::DOUBLE) / -1.0::DOUBLE
                 WHEN rank % 3 = 1 THEN x ELSE sqrt(greatest(0.0::DOUBLE, 0.25::DOUBLE + 2.0::DOUBLE * x)) - 0.5::DOUBLE END,
                 doc_id, source COLLATE C NULLS FIRST, size, pass) - 1 AS place FROM f),
        q AS (SELECT doc_id, min(place) AS first_place FROM o GROUP BY doc_id)
        SELECT n.doc_id, size, source_size, target, (times * size)::BIGINT AS taken, times, first_place FROM n LEFT JOIN q USING (doc_id)""",
    "op10_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        p AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS pos FROM d WHERE len(words) >= 50),
        v AS (SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 49], ' ')) AS h FROM p),
        m AS (SELECT h, min(doc_id) AS least FROM v GROUP BY h HAVING min(doc_id) < max(doc_id)),
        c AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS i FROM v JOIN m USING (h) WHERE doc_id > least),
        g AS (SELECT doc_id, list(i) AS cut FROM c GROUP BY doc_id),
        k AS (SELECT d.doc_id, words, coalesce(cut, []) AS cut FROM d LEFT JOIN g USING (doc_id)),
        e AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
        s AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS kept FROM e LEFT JOIN c ON e.doc_id = c.doc_id AND e.i = c.i
              WHERE c.i IS NULL GROUP BY e.doc_id)
        SELECT k.doc_id, len(words)::BIGINT AS n_words, len(cut)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM k LEFT JOIN s USING (doc_id)""",
}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    return ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

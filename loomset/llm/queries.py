"""The operators of this package as queries on the given tables, and SQL for those that it can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomset.llm import chat_log, language, licences, packing
from loomset.llm.bpe import Tokenizer, id_text
from loomset.llm.common import table
from loomset.llm.exact_dedup import exact_dedup
from loomset.llm.hamming import sign_code, top_k
from loomset.llm.mixing import fair_queue
from loomset.llm.near_dup import near_duplicates
from loomset.llm.resampling import resample
from loomset.llm.tournament import cluster
from loomset.llm.url_trees import Rule, judge
from loomset.llm.warc import payloads, read_archives, write_archives
from loomset.session import scratch_dir

#: A text that says what a template's turns say.
PLANTED_TEXT = r"\### Assistant: </turn> ok"
URL_RULES = [
    Rule.parse("allow", "org/"),
    Rule.parse("block", "example.org/es/"),
    Rule.parse("block", "example.org/en/1"),
    Rule.parse("allow", "com/fr/"),
    Rule.parse("block", "com/de/"),
]


def op1_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op2_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED_TEXT).alias("text"),
    )
    events = chat_log.as_events(turns.union(planted))
    return chat_log.digests(chat_log.render(chat_log.fold(events)))


def op3_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def op4_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, ~language.held_out())
    return language.predict(docs.select("doc_id", language.held_out().alias("held_out"), "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected"
    )


def op5_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokenizer = Tokenizer(spark, path, public_tokenizers.PATTERN)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenizer.there_and_back(docs).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(id_text("ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), URL_RULES)


def op7_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return payloads(read_archives(spark, path)).select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op8_licence_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.fit(docs))


def op9_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_queue(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op10_segment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = table(spark, sf_dir, "embeddings").select("vec_id", sign_code("embedding").alias("code"))
    found = top_k(coded, coded.filter("vec_id % 100 = 0"), k=10, key="vec_id")
    return found.select(F.col("query").alias("query_id"), "rank", F.col("key").alias("vec_id"), "distance")


def op11_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = packing.encode(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2)
    return packing.pack(tokens, capacity=4096).select(
        F.col("key").alias("doc_id"),
        "start",
        "length",
        packing.ids_crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op12_bisector_tournament(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, clusters = cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed=2)
    # At most 40 rows.
    told = clusters.select(
        "cluster",
        "cluster_inertia",
        F.sum("cluster_inertia").over(Window.partitionBy()).alias("inertia"),
        F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256).alias("centroid_sha256"),
    )
    return vectors.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op13_crc_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, min_words=20, seed=2024)


QUERIES = {
    "op1_odd_sketches": op1_odd_sketches,
    "op2_chat_events": op2_chat_events,
    "op3_stream_dedup": op3_stream_dedup,
    "op4_language_centroids": op4_language_centroids,
    "op5_merge_replay": op5_merge_replay,
    "op6_url_trees": op6_url_trees,
    "op7_warc_chunks": op7_warc_chunks,
    "op8_licence_paragraphs": op8_licence_paragraphs,
    "op9_fair_queue_mix": op9_fair_queue_mix,
    "op10_segment_search": op10_segment_search,
    "op11_pattern_packing": op11_pattern_packing,
    "op12_bisector_tournament": op12_bisector_tournament,
    "op13_crc_resampling": op13_crc_resampling,
}


def _clustering_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds one after the other, each vector against each centroid."""
    assigned = """
        assigned{r} AS (
            SELECT row, min([distance, c]) AS best FROM (
                SELECT row, c, sum((x.v - y.v) * (x.v - y.v))::BIGINT AS distance
                FROM xs x JOIN centroids{r} y USING (pos) GROUP BY row, c
            ) GROUP BY row
        )"""
    moved = """
        centroids{n} AS (
            SELECT c, pos, coalesce((total - ((total % held) + held) % held) // held, v)::BIGINT AS v
            FROM centroids{r} LEFT JOIN (
                SELECT best[2] AS c, pos, sum(v) AS total, count(*) AS held
                FROM xs JOIN assigned{r} USING (row) GROUP BY 1, 2
            ) USING (c, pos)
        )"""
    steps = [part.format(r=r, n=r + 1) for r in range(rounds) for part in (assigned, moved)]
    return f"""
        WITH kept AS (
            SELECT vec_id, embedding, row_number() OVER () AS row FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
        ), xs AS (
            SELECT row, unnest(range(64)) AS pos, unnest(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)) AS v
            FROM kept
        ), chosen AS (
            SELECT row, row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), vec_id, embedding) - 1 AS c
            FROM kept QUALIFY c < {k}
        ), centroids0 AS (
            SELECT c, pos, v FROM chosen JOIN xs USING (row)
        ), {", ".join(steps)}, {assigned.format(r=rounds)}, hashes AS (
            SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY pos)) AS centroid_sha256 FROM centroids{rounds} GROUP BY c
        )
        SELECT vec_id, best[2]::INT AS cluster, best[1] AS distance,
               sum(best[1]) OVER (PARTITION BY best[2])::BIGINT AS cluster_inertia,
               sum(best[1]) OVER ()::BIGINT AS inertia, centroid_sha256
        FROM kept JOIN assigned{rounds} USING (row) JOIN hashes ON c = best[2]
    """


ORACLES = {
    "op12_bisector_tournament": _clustering_sql(),
    "op7_warc_chunks": """
        WITH sized AS (
            SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes FROM pages
        ), grouped AS (
            SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
                   CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload) END AS original
            FROM sized
        )
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN original != page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN original != page_id THEN original END AS refers_to
        FROM grouped
    """,
    "op3_stream_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op9_fair_queue_mix": r"""
        WITH sizes AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
            FROM sizes GROUP BY source
        ), weighted AS (
            SELECT *, [3, 1, 2][rank % 3 + 1] AS weight, 1.5::DOUBLE * sum(source_size) OVER () AS budget
            FROM sources
        ), levels AS (
            SELECT *, 2 * source_size::DOUBLE / weight AS ends,
                   (budget - coalesce(sum(2 * source_size) OVER earlier, 0)) / sum(weight) OVER later AS level
            FROM weighted
            WINDOW earlier AS (ORDER BY 2 * source_size::DOUBLE / weight, rank
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   later AS (ORDER BY 2 * source_size::DOUBLE / weight, rank
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        ), targets AS (
            SELECT source, rank, weight, source_size, budget,
                   least((2 * source_size)::DOUBLE, weight * max(level) FILTER (level <= ends) OVER ()) AS target
            FROM levels
        ), queued AS (
            SELECT doc_id, size, hash, rank, weight, source_size, target, budget,
                   sum(size) OVER (PARTITION BY rank ORDER BY hash, doc_id, size ROWS UNBOUNDED PRECEDING) AS done
            FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source
        ), copies AS (
            SELECT *, sum(size) OVER (ORDER BY (source_size * pass + done)::DOUBLE / weight, rank, hash, doc_id, pass
                                      ROWS UNBOUNDED PRECEDING) <= budget AS taken
            FROM queued, (VALUES (0), (1)) passes(pass)
        )
        SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size,
               any_value(target) AS target, (any_value(size) * count(*) FILTER (taken))::BIGINT AS taken
        FROM copies GROUP BY doc_id
    """,
    "op10_segment_search": """
        WITH coded AS (
            SELECT vec_id, list_transform(embedding[1:64], lambda x: coalesce(x > 0, false)) AS bits
            FROM embeddings WHERE embedding IS NOT NULL
        ), measured AS (
            SELECT q.vec_id AS query_id, r.vec_id,
                   list_sum(list_transform(list_zip(q.bits, r.bits), lambda z: (z[1] != z[2])::INT))::INT AS distance
            FROM coded q, coded r WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, vec_id, distance,
               row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank
        FROM measured QUALIFY rank <= 10
    """,
    "op13_crc_resampling": r"""
        WITH crc_table AS (
            SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k:
                       CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS crcs
        ), texts AS (
            SELECT true AS source, row_number() OVER () AS row, doc_id, text FROM documents
            UNION ALL SELECT false, NULL, NULL, text FROM benchmark
        ), worded AS (
            SELECT * EXCLUDE (text), regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM texts
        ), features AS (
            SELECT source, row, unnest(words) AS word FROM worded
        ), hexed AS (
            SELECT word, hex(encode(word)) AS bytes FROM (SELECT DISTINCT word FROM features)
        ), hashed AS (
            SELECT word, xor(list_reduce(
                       list_transform(range(len(bytes) // 2), lambda i: ('0x' || substr(bytes, 2 * i + 1, 2))::BIGINT),
                       lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) % 10000 AS bucket
            FROM hexed, crc_table
        ), counts AS (
            SELECT bucket, count(*) FILTER (source) AS s, count(*) FILTER (NOT source) AS t
            FROM features JOIN hashed USING (word) GROUP BY bucket
        ), gains AS (
            SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE)
                                           / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS gain
            FROM counts
        ), weighed AS (
            SELECT row, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
            FROM features JOIN hashed USING (word) JOIN gains USING (bucket) WHERE source GROUP BY row
        ), scored AS (
            SELECT row, doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                   coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
                       (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                       / 4294967296::DOUBLE)))::BIGINT AS score
            FROM worded LEFT JOIN weighed USING (row) WHERE source
        ), ordered AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight)
                       AS place, count(*) FILTER (n_features >= 20) OVER () AS n
            FROM scored
        )
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank
        FROM ordered
    """,
}

"""The registered queries of this subpackage, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bisector import BisectorClusters
from millrace.llm.lattice import decoded, sample_ids
from millrace.llm.licences import LicenceScan
from millrace.llm.lightest_repair import repaired
from millrace.llm.multi_index import VectorLinks
from millrace.llm.ngram_join import NgramJaccardJoin
from millrace.llm.one_bit import OneBitIndex
from millrace.llm.packing import PackedCorpus
from millrace.llm.quality_cascade import QualityCascade
from millrace.llm.secret_scan import SecretScan, digest
from millrace.llm.token_archive import read_token_archives, write_token_archives
from millrace.llm.toxicity import ToxicityModel, fold_of
from millrace.llm.warc import archive_folder, read_archives, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(build: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op6_quality_cascade", r"""
    WITH w AS (
        SELECT doc_id, coalesce(text, '') AS t,
            list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM documents),
    spots AS (
        SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
    twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM spots),
    hit AS (
        SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
        FROM twice CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id),
    m AS (
        SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
            len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
            len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
            len(lines) AS n_lines, len(regexp_extract_all(t, '\p{Lu}')) AS capitals, len(regexp_extract_all(t, '\p{L}')) AS letters
        FROM w LEFT JOIN hit USING (doc_id)),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 40 * n_lines
            OR (letters > 0 AND 100 * capitals > 50 * letters)) AS kept
    FROM b""")
def quality_cascade(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return QualityCascade(docs).judged(docs, "doc_id")


@query("op5_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return PackedCorpus(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")).placed()


@query("op9_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return NgramJaccardJoin(table(spark, folder, "documents"), size=3, percent=90).documents()


@query("op2_multi_index")
def multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return VectorLinks(table(spark, folder, "embeddings")).vectors()


@query("op4_secret_novelty")
def secret_novelty(spark: SparkSession, folder: str) -> DataFrame:
    return digest(SecretScan().spans(table(spark, folder, "documents")))


@query("op7_toxicity")
def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = ToxicityModel(docs, table(spark, folder, "labels"), fold_of(F.col("doc_id")) != 0)
    scored = docs.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op8_warc", """
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN first <> page_id THEN first END AS refers_to
    FROM p LEFT JOIN f USING (payload_digest)""")
def warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = write_archives(table(spark, folder, "pages"), archive_folder(spark))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_token_archive")
def token_archive(spark: SparkSession, folder: str) -> DataFrame:
    files = write_token_archives(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_token_archives(files)


@query("op10_sampled_pieces")
def sampled_pieces(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    sampled = sample_ids(table(spark, folder, "documents"), model, seed=1)
    back = sampled.select("doc_id", "text", "ids", decoded(F.col("ids"), model).alias("back"))
    return back.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"),
        F.sha2("back", 256).alias("decoded_sha256"), (F.col("back") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


@query("op1_licence_scan")
def licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files of a tree: a folder per source, thousand and hundred of ids, whose first documents are its licence files."""
    number = F.col("doc_id")
    name = F.when(number % 100 == 0, "LICENSE").otherwise(F.concat(number.cast("string"), F.lit(".txt")))
    place = F.concat_ws("/", F.col("source"), F.floor(number / 1000).cast("string"), F.when(number % 1000 != 0, F.floor(number / 100).cast("string")), name)
    return LicenceScan().scan(table(spark, folder, "documents").withColumn("path", place))


def _cluster_sql(k: int, rounds: int) -> str:
    """Lloyd's rounds unrolled; floors of exact integer means."""
    nearest = """
        SELECT r, vec_id, x, arg_min(c, d) AS c, min(d) AS d FROM (
            SELECT r, vec_id, x, c, list_sum(list_transform(list_zip(x, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT * 64 + c AS d
            FROM v CROSS JOIN c{n}) GROUP BY r, vec_id, x"""
    steps = "".join(f"""
    a{n} AS MATERIALIZED ({nearest.format(n=n)}),
    s{n} AS (
        SELECT c, i, sum(x[i]) AS s, count(*) AS n
        FROM (SELECT c, x, unnest(range(1, 65)) AS i FROM a{n}) GROUP BY c, i),
    m{n} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM s{n} GROUP BY c),
    c{n + 1} AS MATERIALIZED (SELECT c, coalesce(m{n}.m, c{n}.m) AS m FROM c{n} LEFT JOIN m{n} USING (c)),""" for n in range(rounds))
    return f"""
    WITH v AS (
        SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
    c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS c, x AS m FROM v
        QUALIFY c < {k}),{steps}
    f AS ({nearest.format(n=rounds)})
    SELECT vec_id, CAST(c AS INTEGER) AS cluster, d // 64 AS distance,
        CAST(sum(d // 64) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d // 64) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(m, ',')) AS centroid_sha256
    FROM f JOIN c{rounds} USING (c)"""


@query("op12_bisector_clusters", _cluster_sql(16, 3))
def bisector_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return BisectorClusters(table(spark, folder, "embeddings"), k=16, rounds=3, dim=64, scale=64, seed=1).clusters()


@query("op11_one_bit_neighbours", """
    WITH v AS (
        SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS x FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    s AS (
        SELECT q.r, q.vec_id AS query_id, v.vec_id,
            list_inner_product(q.x, v.x) / (sqrt(list_inner_product(v.x, v.x)) * sqrt(list_inner_product(q.x, q.x))) AS score
        FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id AND len(v.x) = len(q.x)),
    n AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM n WHERE rank <= 5""")
def one_bit_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return OneBitIndex(vectors).search(vectors.where(F.col("vec_id") % 50 == 0), k=5)


def _repair_sql() -> str:
    """Damage, faults, and the repair by a recursion over each conversation's rows that keeps the best way to each of four states."""
    def way(state: str, cost: str, letter: str, line: str) -> str:
        begun = f"({state}).o || CASE WHEN ({state}).o = '' THEN '' ELSE chr(10) END"
        out = f"({state}).o" if line == "" else f"{begun} || {line}"
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': ({state}).c + {cost}, 'a': ({state}).a || '{letter}', 'o': {out}}} END"

    def least(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    user, assistant = (lambda s: way(s, "5", "I", "'user:'")), (lambda s: way(s, "5", "I", "'assistant:'"))
    keep = lambda s, initial: f"CASE WHEN NOT gone AND first = '{initial}' THEN {way(s, 'extra', 'K', 'line')} END"
    rerole = lambda s, role: f"CASE WHEN NOT gone THEN {way(s, 'extra + 1', 'R', f"'{role}:' || text")} END"
    state = "STRUCT(c BIGINT, a VARCHAR, o VARCHAR)"
    return f"""
    WITH RECURSIVE base AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
    kinds AS (
        SELECT *, xor(list_reduce(list_transform(range(1, length(name) + 1), lambda i: ascii(substring(name, i, 1))::BIGINT),
            lambda c, b: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
            4294967295::BIGINT), 4294967295) % 20 AS kind FROM base),
    live AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM kinds, LATERAL (SELECT unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))) AS copies(n)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM live),
    marked AS (
        SELECT *, rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS body,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
            lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS pair FROM placed),
    rows_ AS (
        SELECT *, CASE WHEN body = '' THEN 1 WHEN again THEN 2 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM marked),
    told AS (
        SELECT conv_id, i, fault IN (1, 2) AS gone, CASE WHEN fault = 3 THEN 5 ELSE 0 END AS extra, role[1:1] AS first, role || ':' || text AS line, text FROM rows_),
    convs AS (SELECT DISTINCT conv_id FROM conversations),
    way AS (
        SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'o': ''}}::{state} AS q, NULL::{state} AS s, NULL::{state} AS u, NULL::{state} AS a FROM convs
        UNION ALL
        SELECT conv_id, i + 1, {way("q", "2", "D", "")}, {least(way("s", "2", "D", ""), keep("q", "s"))},
            {least(way("u", "2", "D", ""), keep("q", "u"), keep("s", "u"), keep("a", "u"), rerole("q", "user"), rerole("s", "user"), rerole("a", "user"))},
            {least(way("a", "2", "D", ""), keep("u", "a"), rerole("u", "assistant"))}
        FROM (
            SELECT w.conv_id, w.i, told.* EXCLUDE (conv_id, i), w.q, w.s,
                {least("w.u", user("w.q"), user("w.s"), user("w.a"))} AS u, {least("w.a", assistant("w.u"))} AS a
            FROM way AS w JOIN told ON told.conv_id IS NOT DISTINCT FROM w.conv_id AND told.i = w.i + 1)),
    ends AS (
        SELECT conv_id, {least("q", "a", assistant("u"), assistant(f"({user('s')})"))} AS best
        FROM way QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
    counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
            count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM rows_ GROUP BY conv_id)
    SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
        coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit, sha256(best.o) AS repaired_sha256
    FROM ends AS e LEFT JOIN counts AS n ON n.conv_id IS NOT DISTINCT FROM e.conv_id"""


@query("op13_lightest_repair", _repair_sql())
def lightest_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repaired(table(spark, folder, "conversations"))

"""Queries over ``documents``, one per operator, and their SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outagegrid.llm import (
    block_search, bpe, decontaminate, exact_dedup, lm_score, near_dedup, pii, spelling, substring_dedup, token_counts,
    token_files, toxicity, vector_codes,
)
from outagegrid.llm.common import table
from outagegrid.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op1_deleted_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score(table(spark, folder, "documents"))


@query()
def op2_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents")).drop("removed")


@query()
def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in pii.KINDS], F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
        pii.joined(F.concat("base", "added")).alias("spans"),
    )


@query()
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(f"""
    WITH RECURSIVE w AS (
        SELECT doc_id, list_filter(string_split_regex({LOWER_SQL}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents
    ), s AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
            ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g
        FROM w
    ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
    ), l AS (
        SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)
    ), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
    SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id, min(c) = r.doc_id AS kept
    FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
""")
def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, folder, "documents"), width=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")



@query(f"""
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM (SELECT doc_id, {LOWER_SQL} AS t FROM documents)
    WINDOW w AS (PARTITION BY t)
""")
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.decide(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query()
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id", (F.length("tokens") / 4).cast("long").alias("n_tokens"), F.sha2("tokens", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.attribute(docs, path, ["source", "lang", "text"], separator=" ")


@query("""
    WITH v AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), d AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.v, c.v) AS score
        FROM v q JOIN v c ON len(c.v) = len(q.v) AND c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
    )
    SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM d
    WINDOW w AS (PARTITION BY query_id ORDER BY score, vec_id) QUALIFY row_number() OVER w <= 10
""")
def op11_block_search(spark: SparkSession, folder: str) -> DataFrame:
    return block_search.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The rounds written out: w0 assigns to the seeds b0, b1 has their means, and so on; the last w is the result."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
    w{k} AS MATERIALIZED (
        SELECT i, part, m % {entries} AS e, m // {entries} AS d FROM (
            SELECT p.i, p.part, min({entries} * list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) + b.e) AS m
            FROM p JOIN b{k} b ON b.part = p.part GROUP BY p.i, p.part)
    )""")
        if k < rounds:
            steps.append(f"""
    s{k} AS (
        SELECT w.part, w.e, u.pos, sum(p.v[u.pos]) AS s, count(*) AS n
        FROM w{k} w JOIN p ON p.i = w.i AND p.part = w.part, unnest(range(1, len(p.v) + 1)) AS u(pos) GROUP BY ALL
    ),
    m{k} AS (
        SELECT part, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS v FROM s{k} GROUP BY part, e
    ),
    b{k + 1} AS MATERIALIZED (
        SELECT b.part, b.e, coalesce(m.v, b.v) AS v FROM b{k} b LEFT JOIN m{k} m ON m.part = b.part AND m.e = b.e
    )""")
    return f"""
    WITH k AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id) AS i, vec_id, label,
               list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    p AS MATERIALIZED (
        SELECT i, q.part, list_slice(v, q.part * len(v) // {parts} + 1, (q.part + 1) * len(v) // {parts}) AS v
        FROM k, unnest(range({parts})) AS q(part)
    ),
    b0 AS MATERIALIZED (SELECT part, i - 1 AS e, v FROM p WHERE i <= {entries}), {",".join(steps)},
    r AS (
        SELECT i, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
        FROM w{rounds} GROUP BY i
    ),
    h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM b{rounds})
    SELECT k.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, h.codebooks_sha256
    FROM k JOIN r ON r.i = k.i, h
    """


@query(_codes_sql())
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings"))


def _crc_nibbles(polynomial: int = 0xEDB88320) -> list[int]:
    """The sixteen steps of a reflected crc32 by half bytes."""
    table = list(range(16))
    for _ in range(4):
        table = [(c >> 1) ^ polynomial if c & 1 else c >> 1 for c in table]
    return table


# Half a byte at a time, low half first; text to UTF-8 bytes for letters below 0x800.
_CRC_SQL = f"""xor(list_reduce(
    flatten(list_transform(flatten(list_transform(string_split(t, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)]
        ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END)), lambda b: [CAST(b % 16 AS BIGINT), CAST(b // 16 AS BIGINT)])),
    lambda c, b: xor(c >> 4, CAST({_crc_nibbles()}[xor(c % 16, b) + 1] AS BIGINT)), CAST(4294967295 AS BIGINT)), 4294967295)"""


@query(f"""
    WITH RECURSIVE r AS (
        SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{7,}}')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
    ), d AS (SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS t, count(*) AS n FROM r GROUP BY ALL),
    h AS (SELECT run, n, {_CRC_SQL} AS h FROM d),
    o AS (
        SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
        FROM h
    ), w AS MATERIALIZED (
        SELECT word, CAST(sum(n) AS BIGINT) AS n FROM o WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
    ), c AS MATERIALIZED (
        SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
        FROM w, unnest(range(1, length(word) + 1)) AS u(i)
    ), p AS (
        SELECT a.word AS a, b.word AS b FROM c a JOIN c b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
        UNION SELECT c.word, w.word FROM c JOIN w ON c.rest = w.word
        UNION SELECT w.word, c.word FROM c JOIN w ON c.rest = w.word
    ), g AS (
        SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, encode(b)) AS best, max(n) AS best_n
        FROM p JOIN w ON w.word = b GROUP BY a
    ), f AS MATERIALIZED (
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form,
               CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n
        FROM w LEFT JOIN g ON g.word = w.word
    ), z AS (
        SELECT word, word AS root FROM f UNION ALL SELECT z.word, f.form FROM z JOIN f ON f.word = z.root WHERE f.form IS NOT NULL
    ), t AS (SELECT z.word, z.root FROM z JOIN f ON f.word = z.root WHERE f.form IS NULL)
    SELECT f.word, f.form, t.root, f.n, f.n_near, f.form_n FROM f JOIN t ON t.word = f.word
""")
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))

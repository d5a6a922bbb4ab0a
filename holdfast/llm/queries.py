"""Registered queries of the operators, one each, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import languages, licenses, norm_topk, permutation_index, pieces, spelling, toxicity, url_rules, whitening
from .line_dedup import dedup_lines
from .minmax import near_copies
from .near_duplicates import near_duplicates
from .packing import pack


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices of every document."""
    return licenses.find_licenses(table(spark, folder, "documents"))


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every text as pieces and back: number and hash of the ids, digest of the text that they decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.encode(table(spark, folder, "documents"), model, with_text=True)
    return found.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), F.sha2("text", 256).alias("decoded_sha256"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines dropped from every document, and a digest of what is kept."""
    return dedup_lines(table(spark, folder, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Severity of every document."""
    docs = table(spark, folder, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op5_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Class of near duplicates of every document."""
    return near_duplicates(table(spark, folder, "documents"))


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's URL."""
    return url_rules.judge(table(spark, folder, "pages"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    docs = table(spark, folder, "documents")
    model = languages.learn(docs.where(~languages.held_out()))
    return languages.predict(docs, model, keep=["doc_id"]).select("doc_id", languages.held_out().alias("held_out"), "lang_pred", "score", "languages")


def op8_permutation_index(spark: SparkSession, folder: str) -> DataFrame:
    """20 nearest vectors of every 20th."""
    vectors = table(spark, folder, "embeddings")
    return permutation_index.search(vectors, vectors.where("vec_id % 20 = 0"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of sequences of 2048 ids, with a digest of each piece."""
    return pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), digest=True)


def op10_norm_bucketed_topk(spark: SparkSession, folder: str) -> DataFrame:
    """5 largest integer inner products of every 50th vector."""
    vectors = table(spark, folder, "embeddings")
    return norm_topk.search(vectors, vectors.where("vec_id % 50 = 0"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents with their more frequent spellings; one run in 97 loses a code point first."""
    return spelling.variant_groups(spelling.count_words(table(spark, folder, "documents"), damage=97))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """32 whitened components of every vector."""
    return whitening.by_component(whitening.whiten(table(spark, folder, "embeddings")))


def op13_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Class of near copies of every document, and whether it is the one kept."""
    return near_copies(table(spark, folder, "documents"))


QUERIES = {
    "op1_license_scans": op1_license_scans,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_line_dedup": op3_line_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_url_filters": op6_url_filters,
    "op7_language_id": op7_language_id,
    "op8_permutation_index": op8_permutation_index,
    "op9_packing": op9_packing,
    "op10_norm_bucketed_topk": op10_norm_bucketed_topk,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_minhash_near_dedup": op13_minhash_near_dedup,
}

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

BLANKS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

def _linked_sql(percent: int) -> str:
    """Shingle sets of all documents, compared through every shingle they share."""
    return rf"""
        WITH RECURSIVE words AS (
            SELECT row_number() OVER () AS r, doc_id,
                   list_filter(string_split_regex(coalesce({LOWER}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), shingles AS MATERIALIZED (
            SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
            FROM words
        ), sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM shingles GROUP BY r
        ), shared AS (
            SELECT a.r AS x, b.r AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY ALL
        ), links AS MATERIALIZED (
            SELECT x, y FROM shared JOIN sizes p ON p.r = x JOIN sizes q ON q.r = y WHERE 100 * c >= {percent} * (p.n + q.n - c)
        ), reach AS (
            SELECT r AS x, r AS y FROM words UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
        )
        SELECT w.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(o.doc_id) AS component_id
        FROM reach JOIN words w ON w.r = reach.x JOIN words o ON o.r = reach.y LEFT JOIN sizes ON sizes.r = w.r
        GROUP BY w.r, w.doc_id"""


ORACLE_SQL = {
    "op3_line_dedup": f"""
        WITH lines AS MATERIALIZED (
            SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place
            FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
        ), keyed AS MATERIALIZED (
            SELECT r, doc_id, line, place,
                   translate(trim(line, {BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
        ), shared AS (
            SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
        ), judged AS (
            SELECT keyed.*, shared.k IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone FROM keyed LEFT JOIN shared USING (k)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY r, doc_id""",
    "op5_ngram_jaccard_join": _linked_sql(75),
    "op10_norm_bucketed_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored QUALIFY rank <= 5""",
    "op6_url_filters": r"""
        WITH RECURSIVE cut AS (
            SELECT row_number() OVER () AS r, page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END, '') AS rest FROM pages
        ), split AS (
            SELECT r, page_id, rest,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut
        ), given(name, v, h, p) AS (
            VALUES ('org/', 'allow', 'org', '/'), ('example.org/es/', 'block', 'example.org', '/es/'), ('example.org/en/1', 'block', 'example.org', '/en/1'),
                   ('com/fr/', 'allow', 'com', '/fr/'), ('com/de/', 'block', 'com', '/de/')
        ), ruled AS (
            SELECT r, arg_max(name, length(name)) AS rule, arg_max(v, length(name)) AS v
            FROM split JOIN given ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r
        ), tokens AS MATERIALIZED (
            SELECT DISTINCT r, t FROM (
                SELECT r, 'h:' || regexp_replace(x, '[0-9]+', '#', 'g') AS t FROM (SELECT r, unnest(string_split(host, '.')) AS x FROM split) WHERE x <> ''
                UNION ALL
                SELECT r, 'p:' || regexp_replace(x, '[0-9]+', '#', 'g') FROM (SELECT r, unnest(string_split(path, '/')) AS x FROM split) WHERE x <> ''
                UNION ALL
                SELECT r, 'q:' || regexp_replace(x, '[0-9]+', '#', 'g') FROM (
                    SELECT r, string_split(unnest(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&')), '=')[1] AS x FROM split) WHERE x <> '')
        ), kinds AS MATERIALIZED (
            SELECT ts, row_number() OVER () AS kind, rs FROM (
                SELECT ts, list(r) AS rs FROM (SELECT r, list(t ORDER BY t) AS ts FROM tokens GROUP BY r) GROUP BY ts)
        ), sets(kind, name, last, n) AS (
            SELECT kind, '', 0, 0 FROM kinds
            UNION ALL
            SELECT kind, name || CASE WHEN n > 0 THEN ' ' ELSE '' END || ts[i], i, n + 1
            FROM (SELECT sets.*, ts, unnest(range(last + 1, len(ts) + 1)) AS i FROM sets JOIN kinds USING (kind))
        ), members AS (SELECT kind, unnest(rs) AS r FROM kinds
        ), seen AS MATERIALIZED (
            SELECT name, any_value(n) AS n, v, count(*) AS k FROM sets JOIN members USING (kind) JOIN ruled USING (r) WHERE n > 0 GROUP BY name, v
        ), mined AS MATERIALIZED (
            SELECT name, n, v, CAST(k AS DOUBLE) / sum(k) OVER (PARTITION BY name) AS confidence, k AS support FROM seen
        ), sure AS MATERIALIZED (
            SELECT *, string_split(name, ' ') AS ts FROM mined
            WHERE support >= ceil(0.002 * (SELECT count(*) FROM ruled)) AND confidence >= 0.8
        ), kept AS (
            SELECT * FROM sure l WHERE NOT EXISTS (
                SELECT 1 FROM sure s WHERE s.v = l.v AND s.n < l.n AND s.confidence >= l.confidence AND list_has_all(l.ts, s.ts))
        ), best AS (
            SELECT kind, max({'confidence': confidence, 'support': support, 'n': kept.n, 'name': name, 'v': kept.v}) AS m FROM sets JOIN kept USING (name) GROUP BY kind
        ), answered AS (SELECT r, m FROM best JOIN members USING (kind))
        SELECT page_id, host, path, rule, coalesce(ruled.v, m.v, 'allow') AS verdict,
               CASE WHEN rule IS NULL THEN m.name END AS mined, CASE WHEN rule IS NULL THEN m.confidence END AS confidence
        FROM split LEFT JOIN ruled USING (r) LEFT JOIN answered USING (r)""",
    "op11_spelling_variants": r"""
        WITH RECURSIVE checks(b, k, c) AS (
            SELECT range, 0, range FROM range(256)
            UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM checks WHERE k < 8
        ), bytes_checked AS MATERIALIZED (SELECT b, c FROM checks WHERE k = 8
        ), found AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
            FROM documents
        ), runs AS MATERIALIZED (
            SELECT row_number() OVER () AS r, run, c, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS bytes
            FROM (SELECT doc_id, run, count(*) AS c FROM found GROUP BY ALL)
        ), states(r, k, c) AS (
            SELECT r, 0, CAST(4294967295 AS BIGINT) FROM runs
            UNION ALL
            SELECT states.r, k + 1, xor(states.c >> 8, t.c) FROM states JOIN runs ON runs.r = states.r
            JOIN bytes_checked t ON t.b = xor(states.c & 255, CAST('0x' || substr(bytes, 2 * k + 1, 2) AS BIGINT)) WHERE 2 * k < length(bytes)
        ), hashed AS (
            SELECT run, runs.c AS c, xor(states.c, 4294967295) AS h FROM states JOIN runs USING (r) WHERE 2 * k = length(bytes)
        ), words AS MATERIALIZED (
            SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
                SELECT c, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
            WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
        ), less AS MATERIALIZED (
            SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
        ), near AS (
            SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT less.word, words.word, words.n FROM less JOIN words ON words.word = less.rest
            UNION SELECT words.word, less.word, less.n FROM less JOIN words ON words.word = less.rest
        ), judged AS (
            SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word
        ), formed AS MATERIALIZED (
            SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * words.n THEN most END AS form_n,
                   CASE WHEN most >= 2 * words.n THEN (SELECT min(other) FROM near WHERE near.word = words.word AND near.n = most) END AS form
            FROM words LEFT JOIN judged USING (word)
        ), chain(word, reached) AS (
            SELECT word, word FROM formed
            UNION ALL SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.reached WHERE formed.form IS NOT NULL
        ), ends AS (
            SELECT chain.word, reached FROM chain JOIN formed ON formed.word = reached WHERE formed.form IS NULL
        )
        SELECT word, form, reached AS root, n, n_near, form_n FROM formed JOIN ends USING (word)""",
    "op13_minhash_near_dedup": f"SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM ({_linked_sql(85)}) linked",
}

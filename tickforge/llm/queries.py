"""Registered queries of the training-data operators, and the SQL they are checked against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.bpe import encoding_digests
from tickforge.llm.common import in_fold, out_of_fold, table
from tickforge.llm.decontaminate import find_passages
from tickforge.llm.language import identify, train_languages
from tickforge.llm.personal import find_personal, listed
from tickforge.llm.phrases import collocations, top_collocations
from tickforge.llm.quality import quality_report
from tickforge.llm.runs import mark_runs, strongest
from tickforge.llm.scoring import score_texts
from tickforge.llm.sharding import assign_shards
from tickforge.llm.simhash import near_copies
from tickforge.llm.token_files import token_files
from tickforge.llm.toxicity import score_toxicity, train_toxicity
from tickforge.llm.warc import archive_pages


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN keeper END AS refers_to
FROM (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
           max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper
    FROM pages
)
"""


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP3_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
),
windows AS (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS n
    FROM (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
          FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM d))
),
repeats AS (
    SELECT rid, count(DISTINCT j) AS n_repeat_words
    FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM windows WHERE n > 1) GROUP BY rid
),
lines AS (
    SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
),
stats AS (
    SELECT rid, doc_id, lang, source, len(ws)::BIGINT AS n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
           (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
           coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           coalesce(n_lines, 0) AS n_lines
    FROM d LEFT JOIN repeats USING (rid) LEFT JOIN lines USING (rid)
),
metrics AS (
    SELECT rid, lang, source, unnest([
        {'m': 'symbols', 'v': 1000 * n_symbols // n_words}, {'m': 'dup_lines', 'v': 1000 * n_dup_lines // n_lines},
        {'m': 'repeats', 'v': 1000 * n_repeat_words // n_words}, {'m': 'word_length', 'v': 1000 * word_chars // n_words}]) AS e
    FROM stats WHERE n_words > 0
),
bins AS (
    SELECT lang, source, e.m AS m, (e.v >> greatest(length(bin(e.v)) - 5, 0)) << greatest(length(bin(e.v)) - 5, 0) AS b
    FROM metrics
),
s AS (SELECT lang, source, m, count(*) AS n, list_sort(list(b)) AS l FROM bins GROUP BY ALL),
l AS (SELECT lang, m, count(*) AS n, list_sort(list(b)) AS l FROM bins GROUP BY ALL),
a AS (SELECT m, count(*) AS n, list_sort(list(b)) AS l FROM bins GROUP BY ALL),
chosen AS (
    SELECT s.lang, s.source, s.m, CASE WHEN s.n >= 100 THEN s.l WHEN l.n >= 100 THEN l.l ELSE a.l END AS v,
           CASE s.m WHEN 'symbols' THEN 25 WHEN 'word_length' THEN 500 ELSE 125 END AS least
    FROM s JOIN l ON s.lang IS NOT DISTINCT FROM l.lang AND s.m = l.m JOIN a ON s.m = a.m
),
q AS (
    SELECT *, v[ceil(len(v) * 0.25)::INT] AS q1, v[ceil(len(v) * 0.5)::INT] AS q2, v[ceil(len(v) * 0.75)::INT] AS q3 FROM chosen
),
bounds AS (
    SELECT lang, source, m,
           q2 + 4 * greatest(least, q2 - q1, CASE WHEN m = 'word_length' THEN q3 - q2 ELSE 0 END) AS high,
           CASE WHEN m = 'word_length' THEN q2 - 4 * greatest(least, q2 - q1, q3 - q2) ELSE -1 END AS low
    FROM q
),
fine AS (
    SELECT x.rid, bool_and(x.e.v BETWEEN b.low AND b.high) AS ok
    FROM metrics x JOIN bounds b
      ON x.lang IS NOT DISTINCT FROM b.lang AND x.source IS NOT DISTINCT FROM b.source AND x.e.m = b.m
    GROUP BY x.rid
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND coalesce(ok, false) AS kept
FROM stats LEFT JOIN fine USING (rid)
"""


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(out_of_fold("doc_id", 5, 0))
    model = train_toxicity(docs, labels)
    return score_toxicity(docs.select("doc_id", "text"), model).select(
        "doc_id", in_fold("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_languages(docs.filter(out_of_fold("doc_id", 4, 2)))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op7_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), out_of_fold("doc_id", 7, 2), in_fold("doc_id", 7, 2),
                       public_tokenizers.path("byte_bpe_50k.json"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_collocations(collocations(table(spark, sf_dir, "documents"))).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP12_SQL = r"""
WITH pieces AS (
    SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
    FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    )
),
totals AS (SELECT lang, sum(len(ws)) AS n FROM pieces GROUP BY lang),
spans AS (SELECT pid, lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM pieces, range(1, 6) t(k) WHERE len(ws) >= k),
counts AS (
    SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase, count(*) AS f FROM spans GROUP BY ALL HAVING count(*) >= 100
),
cuts AS (
    SELECT c.lang, c.phrase, c.k AS size, c.f AS a, l.f AS l, r.f AS r, t.n, u.cut,
           1000::HUGEINT * c.f * t.n // (l.f::HUGEINT * r.f) AS score
    FROM (SELECT *, string_split(phrase, ' ') AS ws FROM counts WHERE k > 1) c
    JOIN totals t ON c.lang = t.lang
    JOIN range(1, 5) u(cut) ON u.cut < c.k
    JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1 : u.cut], ' ')
    JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[u.cut + 1 : c.k], ' ')
),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_parts AS (
    SELECT lang, f, array_to_string(ws[i : i + m - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, k - m + 2)) AS i
          FROM (SELECT *, string_split(phrase, ' ') AS ws FROM counts), range(2, 5) t(m) WHERE m < k)
)
SELECT * FROM (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
           n::BIGINT AS n, score::BIGINT AS score
    FROM scored s
    WHERE NOT EXISTS (FROM inner_parts p WHERE p.lang = s.lang AND p.phrase = s.phrase AND 100 * p.f >= 100 * s.a)
) WHERE rank <= 2000
"""


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth text by the crc32 of its doc_id repeats its own words from word ``a`` on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = docs.select("doc_id", "text", (h / 10).cast("long").alias("g"), F.when(h % 10 == 0, words).alias("w"))
    cut = cut.select("doc_id", "text", "g", "w", F.size("w").cast("long").alias("n"))
    cut = cut.select("*", F.when(F.col("n") > 0, F.col("g") % F.col("n")).alias("a"))
    cut = cut.select("*", F.expr("1 + (n - a) div (3 + g % 8)").alias("p"))
    planted = F.expr("array_join(transform(sequence(0L, n - 1), i -> w[int(IF(i < a, i, a + (i - a) % p))]), ' ')")
    return cut.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_runs(with_planted_runs(table(spark, sf_dir, "documents"))).withColumn("best", strongest("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return marked.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


OP13_SQL = r"""
WITH bytes AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
           list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT) AS digits
    FROM documents
),
hashed AS (
    SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, digits), lambda r, b: list_reduce(
                  list_prepend(xor(r, b), range(8)),
                  lambda s, k: xor(s >> 1, 3988292384 * (s & 1)))), 4294967295) AS h, len(ws) AS n
    FROM bytes
),
plan AS (SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM hashed),
texts AS (
    SELECT rid, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: ws[1 + CASE
               WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE ws END AS ws
    FROM plan
),
words AS (SELECT rid, n, unnest(ws) AS w, unnest(range(n)) AS i FROM texts WHERE n >= 24),
equal AS (
    SELECT x.rid, x.i, y.i - x.i AS q
    FROM words x JOIN words y ON x.rid = y.rid AND x.w = y.w AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
),
islands AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM equal),
stretches AS (
    SELECT rid, q, min(i) AS s, count(*) + q AS m FROM islands GROUP BY rid, q, island
    HAVING count(*) + q >= greatest(24, 3 * q)
),
runs AS (
    SELECT * FROM stretches r WHERE NOT EXISTS (
        FROM stretches x WHERE x.rid = r.rid AND x.q < r.q AND x.s <= r.s AND x.s + x.m >= r.s + r.m)
),
listed AS (
    SELECT rid, count(*) AS n_runs, string_agg(concat(s, ',', m, ',', q, chr(10)), '' ORDER BY s, q) AS lines
    FROM runs GROUP BY rid
),
best AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY rid ORDER BY m // q DESC, (m % q)::DOUBLE / q DESC, s, q) AS place FROM runs
    ) WHERE place = 1
),
gone AS (SELECT DISTINCT rid, unnest(range(s + q, s + m)) AS i FROM runs),
rest AS (
    SELECT rid, string_agg(w, ' ' ORDER BY i) AS kept
    FROM (SELECT rid, unnest(ws) AS w, unnest(range(n)) AS i FROM texts) ANTI JOIN gone USING (rid, i) GROUP BY rid
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, m AS length, q AS period, 1000 * m // q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (rid) LEFT JOIN best USING (rid) LEFT JOIN rest USING (rid)
"""


QUERIES = {
    "op1_warc": op1_warc,
    "op2_sharding": op2_sharding,
    "op3_quality": op3_quality,
    "op4_toxicity": op4_toxicity,
    "op5_language": op5_language,
    "op6_simhash": op6_simhash,
    "op7_attention": op7_attention,
    "op8_token_files": op8_token_files,
    "op9_decontamination": op9_decontamination,
    "op10_bpe": op10_bpe,
    "op11_personal": op11_personal,
    "op12_phrases": op12_phrases,
    "op13_runs": op13_runs,
}
ORACLE = {"op1_warc": OP1_SQL, "op3_quality": OP3_SQL, "op12_phrases": OP12_SQL, "op13_runs": OP13_SQL}

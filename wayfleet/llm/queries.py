"""The registered queries of this subpackage and their twins in SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet.llm import decontaminate as decontamination
from wayfleet.llm import codes, conversations, kneser_ney, language, mixing, ngram_join, periodic, quality, repeats, sharding, topk, toxicity
from wayfleet.llm.ship import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"), n=4, percent=85)


def ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_counts(_table(spark, sf_dir, "documents"), n=4, percent=85)


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), length=10)
    return found.drop("text_hash")


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS g
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
grams AS (SELECT rid, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g
          FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
m AS (SELECT rid, s, grams.n AS n, item FROM grams JOIN win ON grams.n = win.n AND grams.g = win.g),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM m) GROUP BY rid),
met AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT rid, item FROM m) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN met USING (rid)
"""

def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_pages(spark, _table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


#: Wanted shares of tokens.
TARGETS = {
    "source": {f"src{i}": 0.05 for i in range(20)},
    "lang": {"en": 0.58, "de": 0.16, "fr": 0.15, "es": 0.11},
    "topic": {"prose": 0.92, "records": 0.02, "table": 0.02, "symbols": 0.02, "shouting": 0.02},
}


def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", mixing.tokens(F.col("text")).alias("tokens"),
                                                     mixing.register(F.col("text")).alias("topic"))
    return mixing.mix(docs, TARGETS).select("doc_id", "source", "lang", "topic", "tokens", "weight", "probability", "kept")


def quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.collapse_and_render(_table(spark, sf_dir, "conversations"))


CHAT_SQL = f"""
WITH c AS (SELECT conv_id, coalesce(role, 'user') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS p
           FROM conversations WHERE conv_id IS NOT NULL),
w AS (SELECT conv_id, list(role || chr(10) || text ORDER BY p) AS turns FROM c GROUP BY conv_id),
k AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM w GROUP BY turns),
pre AS (SELECT DISTINCT list_slice(turns, 1, n) AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS n FROM k)),
kept AS (SELECT k.* FROM k LEFT JOIN pre ON k.turns = pre.turns WHERE pre.turns IS NULL)
SELECT conv_id, CAST(len(turns) AS BIGINT) AS n_turns, n_copies,
       array_to_string(list_transform(turns, lambda t: '{conversations.OPEN}' || t || '{conversations.CLOSE}'), chr(10)) AS chat
FROM kept
"""


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), k=5, every=50)


TOP_SQL = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, c.rid AS other,
             coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0) AS score
      FROM v q JOIN v c ON q.rid <> c.rid AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id, other) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 5
"""

def kneser_ney_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score_held_out(_table(spark, sf_dir, "documents"))


SHARDS = 40


def rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(_table(spark, sf_dir, "documents"), {s: 1.0 for s in range(SHARDS)}, new_shard=SHARDS)


def _draw_sql(shard: str) -> str:
    return (f"(CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || CAST({shard} AS VARCHAR)), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0")


RENDEZVOUS_SQL = f"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
x AS (SELECT rid, doc_id, octet_length(b) AS n, hex(b) AS h FROM d),
s AS (SELECT rid, doc_id, CAST(n + 16 AS BIGINT) AS size,
             xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
                 list_transform(range(n), lambda i: CAST(('0x' || substr(h, 2 * i + 1, 2)) AS BIGINT))),
                 lambda c, y: xor(c >> 8, t[xor(c & 255, y) + 1])), 4294967295) AS text_crc32
      FROM x, crc),
o AS (SELECT rid, arg_min(k, {_draw_sql('k')} * -1) AS shard, max({_draw_sql('k')}) AS best
      FROM s, range({SHARDS}) r(k) GROUP BY rid),
g AS (SELECT rid, doc_id, size, text_crc32, shard,
             CASE WHEN {_draw_sql(str(SHARDS))} > best THEN {SHARDS} ELSE shard END AS grown_shard,
             CAST(('0x' || substr(md5('lane:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || CAST(text_crc32 AS VARCHAR)), 1, 6)) AS BIGINT) % 64 AS lane
      FROM s JOIN o USING (rid))
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY lane, doc_id NULLS FIRST, text_crc32) - 1 AS BIGINT) AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM g
"""

_SPACED = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x20\x09-\x0D]+')")

JACCARD_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPACED} AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, s, s + 3), ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, reach.r FROM reach JOIN e ON e.a = reach.id)
SELECT documents.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM documents LEFT JOIN n ON n.doc_id = documents.doc_id JOIN reach ON reach.id = documents.doc_id GROUP BY documents.doc_id
"""


def _discount_sql(counts: str, column: str) -> str:
    """n1 to n4 of a table of counts and what counts of 1, 2, 3 or more give away."""
    y = "(n1 / (n1 + 2e0 * n2))"
    clip = lambda x, high: f"least(greatest({x}, 0.05e0), {high}e0)"
    three = [clip(f"1e0 - 2e0 * {y} * n2 / n1", 0.95), clip(f"2e0 - 3e0 * {y} * n3 / n2", 1.95), clip(f"3e0 - 4e0 * {y} * n4 / n3", 2.95)]
    some = "least(n1, n2, n3, n4) > 0"
    return (f"SELECT {', '.join(f'CASE WHEN {some} THEN {x} ELSE {other} END AS d{i + 1}' for i, (x, other) in enumerate(zip(three, ('0.5e0', '1e0', '1.5e0'))))} "
            f"FROM (SELECT {', '.join(f'count(*) FILTER ({column} = {i}) AS n{i}' for i in (1, 2, 3, 4))} FROM {counts})")


KNESER_NEY_SQL = f"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
k AS (SELECT row_number() OVER () AS rid, doc_id, CAST(doc_id AS VARCHAR) AS s, list_append({_SPACED}, '') AS w FROM documents),
f AS (SELECT rid, doc_id, w, coalesce(xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
                 list_transform(range(1, len(s) + 1), lambda i: CAST(ascii(substr(s, i, 1)) AS BIGINT))),
                 lambda c, y: xor(c >> 8, t[xor(c & 255, y) + 1])), 4294967295) % 7 = 2, false) AS held FROM k, crc),
u AS (SELECT rid, held, unnest(w) AS tok, unnest(range(len(w))) AS pos FROM f),
b AS (SELECT rid, held, tok, coalesce(lag(tok) OVER (PARTITION BY rid ORDER BY pos), ' ') AS prev FROM u),
one AS (SELECT tok, count(*) AS c FROM b WHERE NOT held GROUP BY tok),
whole AS (SELECT CAST(sum(c) AS BIGINT) AS n, count(*) AS v FROM one),
two AS (SELECT prev, tok, count(*) AS c FROM b WHERE NOT held GROUP BY prev, tok),
after AS (SELECT tok, count(*) AS c FROM two GROUP BY tok),
dp AS ({_discount_sql('two', 'c')}), ds AS ({_discount_sql('after', 'c')}),
ctx AS (SELECT prev, sum(c) AS total, sum(CASE WHEN c = 1 THEN d1 WHEN c = 2 THEN d2 ELSE d3 END) AS gives FROM two, dp GROUP BY prev),
lft AS (SELECT sum(c) AS pairs, sum(CASE WHEN c = 1 THEN d1 WHEN c = 2 THEN d2 ELSE d3 END) / sum(c) AS gives FROM after, ds),
s AS (SELECT rid, one.c AS c1, two.c AS c2, total, ctx.gives AS gives, dp.d1 AS p1, dp.d2 AS p2, dp.d3 AS p3, n, v,
             lft.gives / (v + 1) + coalesce(greatest(after.c - CASE WHEN after.c = 1 THEN ds.d1 WHEN after.c = 2 THEN ds.d2 ELSE ds.d3 END, 0), 0) / pairs AS low
      FROM b CROSS JOIN whole CROSS JOIN dp CROSS JOIN ds CROSS JOIN lft LEFT JOIN one ON one.tok = b.tok LEFT JOIN after ON after.tok = b.tok
      LEFT JOIN two ON two.prev = b.prev AND two.tok = b.tok LEFT JOIN ctx ON ctx.prev = b.prev),
r AS (SELECT rid, count(*) AS n_tokens, count(c1) AS n_known, any_value(n) AS train_tokens,
             round(sum(log10((coalesce(c1, 0) + 1) / (n + v + 1))), 6) AS base_score,
             round(sum(log10(CASE WHEN total IS NULL THEN low ELSE (coalesce(greatest(c2 - CASE WHEN c2 = 1 THEN p1 WHEN c2 = 2 THEN p2 ELSE p3 END, 0), 0)
                                                                    + gives * low) / total END)), 6) AS score
      FROM s GROUP BY rid)
SELECT doc_id, held AS held_out, n_tokens, n_known, train_tokens, base_score, score, round(pow(10, -score / n_tokens), 3) AS perplexity
FROM f JOIN r USING (rid)
"""


def _shares_sql(dim: str) -> str:
    rows = ", ".join(f"('{v}', {share}e0)" for v, share in sorted(TARGETS[dim].items()))
    return (f"t_{dim} AS (SELECT v, share / sum(share) OVER () * (SELECT sum(total) FROM cells WHERE {dim} <> 'other') AS target FROM (VALUES {rows}) x(v, share) "
            f"WHERE v IN (SELECT {dim} FROM cells WHERE total > 0) UNION ALL SELECT {dim}, sum(total) FROM cells WHERE {dim} = 'other' GROUP BY {dim})")


def _step_sql(inner: str, dim: str) -> str:
    return (f"(SELECT k, source, lang, topic, total, CASE WHEN sum(x) OVER (PARTITION BY {dim}) > 0 THEN x * coalesce(target, 0) "
            f"/ sum(x) OVER (PARTITION BY {dim}) ELSE x END AS x FROM {inner} LEFT JOIN t_{dim} ON t_{dim}.v = {dim})")


MIXING_SQL = f"""
WITH RECURSIVE share AS (SELECT *, greatest(length(coalesce(text, '')), 1) AS size FROM documents),
d AS (SELECT doc_id, source AS own_source, lang AS own_lang, CAST(len({_SPACED}) AS BIGINT) AS tokens,
             CASE WHEN len(regexp_extract_all(coalesce(text, ''), '[|]')) / size > 0.02e0 THEN 'table'
                  WHEN len(regexp_extract_all(coalesce(text, ''), '[#$%&*]')) / size > 0.1e0 THEN 'symbols'
                  WHEN len(regexp_extract_all(coalesce(text, ''), '[A-Z]')) / size > 0.3e0 THEN 'shouting'
                  WHEN len(regexp_extract_all(coalesce(text, ''), '[0-9]')) / size > 0.01e0 THEN 'records' ELSE 'prose' END AS topic,
             CASE WHEN source IN ({', '.join(repr(v) for v in TARGETS['source'])}) THEN source ELSE 'other' END AS source,
             CASE WHEN lang IN ({', '.join(repr(v) for v in TARGETS['lang'])}) THEN lang ELSE 'other' END AS lang FROM share),
cells AS (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS total FROM d GROUP BY source, lang, topic),
{_shares_sql('source')}, {_shares_sql('lang')}, {_shares_sql('topic')},
raked AS (SELECT 0 AS k, source, lang, topic, total, total AS x FROM cells
          UNION ALL SELECT k + 1, source, lang, topic, total, x FROM {_step_sql(_step_sql(_step_sql('(SELECT * FROM raked WHERE k < 60)', 'source'), 'lang'), 'topic')}),
done AS (SELECT source, lang, topic, CASE WHEN total > 0 THEN x / total ELSE 0 END AS ratio FROM raked WHERE k = 60),
scaled AS (SELECT source, lang, topic, round(ratio, 6) AS weight, round(least(1, ratio / (SELECT max(ratio) FROM done)), 6) AS probability FROM done)
SELECT doc_id, own_source AS source, own_lang AS lang, topic, tokens, weight, probability,
       (CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0 < probability AS kept
FROM d JOIN scaled USING (source, lang, topic)
"""

_CASED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
WINDOW = 35


def repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"), length=WINDOW)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


REPEATS_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_CASED} AS w FROM documents),
g AS (SELECT rid, s, array_to_string(list_slice(w, s, s + {WINDOW - 1}), ' ') AS g
      FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS s FROM d WHERE len(w) >= {WINDOW})),
twice AS (SELECT g FROM g GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(s, s + {WINDOW})) AS p FROM g SEMI JOIN twice USING (g)),
word AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM word ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""


def planted_order(key, n: int) -> np.ndarray | None:
    """A tenth of the documents, by the checksum of their id, repeat a part of their words up to their end."""
    h = zlib.crc32(str(key).encode())
    if key is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_table(spark, sf_dir, "documents"), exponent=4, shortest=6, rewrite=planted_order)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return (found.withColumn("top", longest)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.before")).alias("start"), "top.length",
                    (-F.col("top.shorter")).alias("period"), F.expr("1000 * top.length div -top.shorter").alias("exponent_milli"),
                    F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))


PERIODIC_SQL = f"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
k AS (SELECT row_number() OVER () AS rid, doc_id, CAST(doc_id AS VARCHAR) AS s, {_CASED} AS w FROM documents),
f AS (SELECT rid, doc_id, w, CAST(len(w) AS BIGINT) AS n, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
                 list_transform(range(1, len(s) + 1), lambda i: CAST(ascii(substr(s, i, 1)) AS BIGINT))),
                 lambda c, y: xor(c >> 8, t[xor(c & 255, y) + 1])), 4294967295) AS h FROM k, crc),
o AS MATERIALIZED (SELECT rid, doc_id, w, n, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a, 3 + (h // 10) % 8 AS z FROM f),
word AS MATERIALIZED (SELECT rid, i, rid * 4294967296 + i AS k, hash(x) AS x, x AS plain FROM (SELECT rid, i, CASE WHEN i >= a THEN w[1 + a + (i - a) % (1 + (n - a) // z)] ELSE w[1 + i] END AS x
                      FROM (SELECT rid, w, n, a, z, unnest(range(n)) AS i FROM o))),
lag_ AS MATERIALIZED (SELECT rid, n, unnest(range(1, n // 4 + 1)) AS q FROM o),
place AS MATERIALIZED (SELECT rid, n, q, rid * 4294967296 + unnest(range(0, n - 3 * q + 1, q)) AS k FROM lag_),
tried AS MATERIALIZED (SELECT place.rid, n, q FROM place JOIN word a ON a.k = place.k JOIN word b ON b.k = place.k + q
          JOIN word c ON c.k = place.k + 2 * q JOIN word d ON d.k = place.k + 1 JOIN word e ON e.k = place.k + 1 + q
          GROUP BY place.rid, n, q HAVING bool_or(a.x = b.x AND a.x = c.x AND d.x = e.x)),
spot AS MATERIALIZED (SELECT rid, q, rid * 4294967296 + unnest(range(n - q)) AS k FROM tried),
pair AS MATERIALIZED (SELECT spot.rid, q, a.i, a.x AS a, b.x AS b FROM spot JOIN word a ON a.k = spot.k JOIN word b ON b.k = spot.k + q),
same AS (SELECT rid, q, i, a = b AS same, sum(CASE WHEN a = b THEN 0 ELSE 1 END) OVER (PARTITION BY rid, q ORDER BY i) AS island FROM pair),
stretch AS (SELECT rid, q, min(i) AS start, count(*) + q AS length FROM same WHERE same GROUP BY rid, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
run AS MATERIALIZED (SELECT rid, start, length, min(q) AS period FROM stretch GROUP BY rid, start, length),
best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length DESC, start, period) = 1),
listed AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM run GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (SELECT rid, string_agg(plain, ' ' ORDER BY i) AS kept FROM word ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
       CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(coalesce(kept, '')) AS collapsed_sha256
FROM o LEFT JOIN best USING (rid) LEFT JOIN listed USING (rid) LEFT JOIN kept USING (rid)
"""


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.encode_vectors(_table(spark, sf_dir, "embeddings"), scale=4096, parts=8, entries=16, rounds=6)


def _assigned_sql(books: str) -> str:
    return (f"SELECT rid, part, min(far * 16 + entry) AS best FROM (SELECT rid, part, entry, "
            f"coalesce(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 0) AS far FROM p JOIN {books} USING (part)) GROUP BY rid, part")


def _codes_sql(rounds: int = 6) -> str:
    ctes = [f"""v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
            list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)""",
            "p AS MATERIALIZED (SELECT rid, part, list_slice(v, part * len(v) // 8 + 1, (part + 1) * len(v) // 8) AS x FROM v, range(8) r(part))",
            "b0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, x AS c FROM p WHERE rid <= 16)"]
    for i in range(rounds):
        ctes += [f"a{i} AS MATERIALIZED ({_assigned_sql(f'b{i}')})",
                 f"""s{i} AS (SELECT part, entry, k, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM (SELECT part, best % 16 AS entry, unnest(x) AS x,
                 unnest(range(len(x))) AS k FROM p JOIN a{i} USING (rid, part)) GROUP BY part, entry, k)""",
                 f"""b{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(n.c, b.c) AS c FROM b{i} b LEFT JOIN (SELECT part, entry, list(x ORDER BY k) AS c
                 FROM s{i} GROUP BY part, entry) n USING (part, entry))"""]
    last = f"b{rounds}"
    ctes += [f"z AS MATERIALIZED ({_assigned_sql(last)})",
             "e AS (SELECT rid, string_agg('0' || substr('0123456789abcdef', CAST(best % 16 AS INTEGER) + 1, 1), '' ORDER BY part) AS code, sum(best // 16) AS error FROM z GROUP BY rid)",
             f"digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM {last})"]
    return ("WITH " + ",\n".join(ctes) + """
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN e USING (rid), digest""")


CODES_SQL = _codes_sql()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_snapshots": chat_snapshots,
    "op2_ngram_jaccard": ngram_jaccard,
    "op2_ngram_links": ngram_links,
    "op3_quality_discriminant": quality_discriminant,
    "op4_kneser_ney": kneser_ney_scores,
    "op5_rendezvous_shards": rendezvous_shards,
    "op6_weak_toxicity": weak_toxicity,
    "op7_top_products": top_products,
    "op8_decontaminate": decontaminate,
    "op9_language_id": language_id,
    "op10_mixed_sources": mixed_sources,
    "op11_repeated_windows": repeated_windows,
    "op12_periodic_runs": periodic_runs,
    "op13_vector_codes": vector_codes,
}
ORACLES: dict[str, str] = {
    "op1_chat_snapshots": CHAT_SQL,
    "op2_ngram_jaccard": JACCARD_SQL,
    "op4_kneser_ney": KNESER_NEY_SQL,
    "op5_rendezvous_shards": RENDEZVOUS_SQL,
    "op7_top_products": TOP_SQL,
    "op8_decontaminate": DECONTAMINATE_SQL,
    "op10_mixed_sources": MIXING_SQL,
    "op11_repeated_windows": REPEATS_SQL,
    "op12_periodic_runs": PERIODIC_SQL,
    "op13_vector_codes": CODES_SQL,
}

"""The registered queries of this subpackage, each over whole tables, with SQL forms where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.llm import decontaminate, forest, grulm, importance, jaccard, langid, licenses, mixing, phrases, repeats, secrets, simhash, toxicity
from riskspark.llm.base import id_remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(spans: str) -> str:
    return f"concat_ws(',', transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)))"


@query("op1_repeats")
def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight FROM s),
r AS (SELECT *, 3.0::DOUBLE * source_size AS cap,
    coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, weight, source
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, weight, source
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
    sum(source_size) OVER () AS total FROM w),
lv AS (SELECT max((total - capped) / rest) AS level FROM r),
t AS (SELECT source, source_size, least(cap, weight * level) AS target FROM r, lv),
g AS (SELECT d.source, h, sum(size) AS words FROM d GROUP BY d.source, h),
u AS (SELECT g.*, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM g),
f AS (SELECT t.source, source_size, target, floor(target / nullif(source_size, 0)) AS q,
    target - floor(target / nullif(source_size, 0)) * source_size AS budget FROM t),
b AS (SELECT f.source, source_size, target, q, budget, max(h) FILTER (upto <= budget) AS fits,
    coalesce(max(upto) FILTER (upto <= budget), 0) AS inside,
    min(h) FILTER (upto > budget) AS over_h, min(upto) FILTER (upto > budget) AS over_upto
  FROM f JOIN u ON f.source IS NOT DISTINCT FROM u.source GROUP BY ALL),
c AS (SELECT *, CASE WHEN over_upto - budget < budget - inside THEN over_h ELSE coalesce(fits, -1) END AS below FROM b)
SELECT d.doc_id, d.size, c.source_size, c.target,
  CAST(least(coalesce(q, 0) + CASE WHEN source_size > 0 AND h <= below THEN 1 ELSE 0 END, 3) AS INTEGER) AS copies,
  CAST(d.size * least(coalesce(q, 0) + CASE WHEN h <= below THEN 1 ELSE 0 END, 3) AS BIGINT) AS taken
FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source"""


@query("op2_mixing", MIX_SQL)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "copies", "taken")


@query("op3_langid")
def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    found = langid.predict(docs, langid.fit(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


DECONTAMINATE_SQL = r"""
WITH d AS (SELECT doc_id, xx, list_filter(regexp_split_to_array(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM (SELECT doc_id, row_number() OVER () AS xx, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
b AS (SELECT item_id, list_filter(regexp_split_to_array(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark)),
w AS (SELECT DISTINCT item_id, least(len(words), 13) AS n, array_to_string(words[i : i + least(len(words), 13) - 1], ' ') AS win
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 13, 0) + 2)) AS i FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM w),
p AS (SELECT doc_id, xx, n, i, array_to_string(words[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, xx, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, sizes WHERE len(words) >= n)),
h AS (SELECT p.doc_id, p.xx, p.n, i, item_id FROM p JOIN w ON p.win = w.win AND p.n = w.n),
hit AS (SELECT xx, count(DISTINCT place) AS n_hit FROM (SELECT xx, unnest(range(i, i + n)) AS place FROM h) GROUP BY xx),
ids AS (SELECT xx, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT xx, item_id FROM h) GROUP BY xx)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit USING (xx) LEFT JOIN ids USING (xx)"""


@query("op4_decontaminate", DECONTAMINATE_SQL)
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = table(spark, sf_dir, "documents"), id_remainder(F.col("doc_id"), 4)
    index = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold != 2)
    return toxicity.predict(docs, index).select(
        "doc_id", (fold == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "evidence"
    )


@query("op6_forest")
def op6_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"))


@query("op7_secrets")
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = "filter(spans, s -> s.base)"
    counts = [
        F.expr(f"cast(size(filter(spans, s -> s.base AND s.kind = '{k}')) AS bigint)").alias(f"n_{k}")
        for k in secrets.BASE_KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(F.expr(_joined(base)).cast("binary"), 256).alias("base_sha256"),
        F.expr(_joined("spans")).alias("spans"),
    )


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


@query("op9_licenses")
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("spans").cast("long").alias("n_spans"), F.expr(
        "array_join(array_sort(array_distinct(spans.license)), ',')").alias("licenses"), "spans")


@query("op10_grulm")
def op10_grulm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 10) == 0
    vocabulary, network, _ = grulm.fit(docs, ~held_out)
    return grulm.score(docs, held_out, vocabulary, network)


JACCARD_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
s AS MATERIALIZED (SELECT DISTINCT row, hash(words[i : i + 2]) AS g FROM (
  SELECT row, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM d WHERE len(words) > 0)),
z AS MATERIALIZED (SELECT row, count(*) AS n FROM s GROUP BY row),
f AS (SELECT g, count(*) AS df FROM s GROUP BY g),
p AS MATERIALIZED (SELECT row, g FROM (SELECT s.row, s.g, n, row_number() OVER (PARTITION BY s.row ORDER BY df, s.g) AS place FROM s JOIN f USING (g) JOIN z USING (row))
  WHERE place <= n - ceil(0.9 * n) + 1),
c AS MATERIALIZED (SELECT DISTINCT x.row AS a, y.row AS b FROM p x JOIN p y ON x.g = y.g AND x.row < y.row),
e AS MATERIALIZED (SELECT a, b FROM c JOIN s x ON x.row = a JOIN s y ON y.row = b AND y.g = x.g JOIN z za ON za.row = a JOIN z zb ON zb.row = b
  GROUP BY a, b, za.n, zb.n HAVING 100 * count(*) >= 90 * (za.n + zb.n - count(*))),
pairs AS MATERIALIZED (SELECT a AS u, b AS v FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT row, row AS at FROM d UNION SELECT r.row, v FROM r JOIN pairs ON r.at = u)
SELECT d.doc_id, coalesce(any_value(z.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM d JOIN r ON d.row = r.row JOIN d o ON o.row = r.at LEFT JOIN z ON z.row = d.row GROUP BY d.row, d.doc_id"""


@query("op11_jaccard", JACCARD_SQL)
def op11_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


PHRASES_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM (
  SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
t AS (SELECT lang, sum(len(words))::HUGEINT AS n FROM p GROUP BY lang),
f AS MATERIALIZED (SELECT lang, words[i : i + k - 1] AS phrase, k, count(*)::HUGEINT AS f
  FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(words) >= k)
  GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, f AS a, k, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r, n, 1000 * a * n // (x.f * y.f) AS score FROM c JOIN t USING (lang)
  JOIN f x ON x.lang = c.lang AND x.phrase = c.phrase[1 : cut] JOIN f y ON y.lang = c.lang AND y.phrase = c.phrase[cut + 1 : c.k]),
m AS (SELECT lang, phrase, a, n, min({'score': score, 'cut': cut, 'l': l, 'r': r}) AS best FROM s GROUP BY lang, phrase, a, n),
b AS (SELECT lang, phrase, a, n, best.l AS l, best.r AS r, best.score AS score FROM m),
parts AS (SELECT lang, part, max(f) AS f FROM (SELECT lang, f, k, phrase, m, phrase[i : i + m - 1] AS part FROM (
  SELECT *, unnest(range(1, k - m + 2)) AS i FROM f, (SELECT unnest([2, 3, 4]) AS m) WHERE m < k)) GROUP BY ALL),
o AS (SELECT b.lang, array_to_string(b.phrase, ' ') AS phrase, a, l, r, n, score FROM b LEFT JOIN parts ON parts.lang = b.lang AND part = b.phrase
  WHERE parts.f IS NULL OR 100 * parts.f < 100 * a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o) WHERE rank <= 2000"""


@query("op12_phrases", PHRASES_SQL)
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.collocations(table(spark, sf_dir, "documents"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


IMPORTANCE_SQL = r"""
WITH tab AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i:
    CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n)) AS t),
w AS (SELECT kind, id, row, list_filter(regexp_split_to_array(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM (
  SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS row, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL SELECT 'b', NULL, row_number() OVER (), translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark)),
f AS MATERIALIZED (SELECT kind, row, array_to_string(words[i : i + k - 1], ' ') AS feature, count(*) AS n
  FROM (SELECT kind, row, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(words) >= k) GROUP BY ALL),
crc AS MATERIALIZED (SELECT feature, xor(list_reduce(
    list_transform(range(1, len(h) // 2 + 1), lambda i: CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT)),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM f)), tab),
m AS MATERIALIZED (SELECT kind, row, bucket, sum(n) AS n FROM f JOIN crc USING (feature) GROUP BY ALL),
c AS (SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0) AS s, coalesce(sum(n) FILTER (kind = 'b'), 0) AS t FROM m GROUP BY bucket),
a AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM c),
g AS (SELECT bucket, CAST(floor(1000.0::DOUBLE * ln(((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE))) AS BIGINT) AS gain FROM c, a),
d AS (SELECT w.row, any_value(w.id) AS doc_id, any_value(len(w.words)) AS n_words, CAST(coalesce(sum(m.n), 0) AS BIGINT) AS n_features,
    CAST(coalesce(sum(m.n * g.gain), 0) AS BIGINT) AS weight
  FROM w LEFT JOIN m ON m.kind = 'd' AND m.row = w.row LEFT JOIN g USING (bucket) WHERE w.kind = 'd' GROUP BY w.row),
o AS (SELECT *, weight + CAST(floor(-1000.0::DOUBLE * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
    / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM d),
r AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS eligible FROM o WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * eligible // 100 THEN place END AS rank FROM o LEFT JOIN r USING (row)"""


@query("op13_importance", IMPORTANCE_SQL)
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")

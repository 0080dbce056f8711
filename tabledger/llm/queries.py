"""The registered queries of this subpackage, thin forms of its operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, jaccard, licenses, merkle, negatives, packing, periodic, quality, secrets, sharding, suffixes, toxicity, url_lists
from .common import WORD, small, table


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def toxicity_machine(spark: SparkSession, folder: str) -> toxicity.Machine:
    """From labelled documents outside the held-out fifth."""
    labels = table(spark, folder, "labels").where(~held_out())
    chosen = small(toxicity.sampled_labels(labels, "toxic"))
    return toxicity.train(table(spark, folder, "documents").select("doc_id", "text").join(chosen, "doc_id"))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.scores(docs, toxicity_machine(spark, folder))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    base, more = F.transform("phrases", lambda p: p["label"]), F.transform("templates", lambda t: t["label"])
    starts = F.transform("phrases", lambda p: p["start"])
    names = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    score = F.when((F.size("phrases") > 0) | (F.size("templates") > 0), F.lit(1.0)).otherwise(0.9 * F.col("share"))
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), names(base).alias("base_labels"), names(F.concat(base, more)).alias("labels"),
        score.alias("score"), F.size("templates").cast("long").alias("n_templates"),
    )


def op4_merkle(spark: SparkSession, folder: str) -> DataFrame:
    compared = merkle.chained(table(spark, folder, "documents"))
    return compared.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited",
        "near_next", "edits",
    )


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    ids = F.sort_array(F.transform("item_ids", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", decontaminate.n_hit(F.col("spans")).alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def op5_pack(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "opens", "closes"
    )


SHARD_BYTES = 1 << 20


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.directory(table(spark, folder, "documents"), SHARD_BYTES)
    return placed.select("doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_docs")


def fetched_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with the time of the event of their number as fetch time (null where there is none)."""
    times = table(spark, folder, "events").select(F.col("event_id").alias("page_id"), F.col("ts").alias("fetched_at"), "event_type", "user_id")
    return table(spark, folder, "pages").select("page_id", "url").join(times, "page_id", "left")


def list_entries(pages: DataFrame) -> DataFrame:
    """A list kept by reports on pages: an error blocks the page's host from 12 hours later on, a signup its first path
    segment, a purchase allows the host again, and a click of every seventh user removes the host's entry."""
    site = url_lists.patterns_of(F.col("url"))
    host = F.when(F.size(site) > 0, url_lists.host_of(F.col("url")))
    kind = F.col("event_type")
    action = (F.when(kind.isin("error", "signup"), "block").when(kind == "purchase", "allow")
              .when((kind == "click") & (F.col("user_id") % 7 == 0), "remove"))
    pattern = F.when(kind == "signup", F.get(site, F.lit(0))).otherwise(host)
    return pages.select(
        pattern.alias("pattern"), (F.col("fetched_at") + F.expr("INTERVAL 12 HOURS")).alias("listed_at"), action.alias("action")
    ).where("action IS NOT NULL")


def op7_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    pages = fetched_pages(spark, folder)
    return url_lists.as_of(pages, list_entries(pages))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Documents stand at the host and first path segment of the page of their number; without one, at source and lang."""
    docs = quality.described(table(spark, folder, "documents"), keep=("source", "lang"))
    number = F.expr("try_cast(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT)")
    segment = F.element_at(url_lists.patterns_of(F.col("url")), 1)
    sites = table(spark, folder, "pages").select(number.alias("doc_id"), F.struct(url_lists.host_of(F.col("url")).alias("host"), segment.alias("path")).alias("site"))
    sites = sites.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("site").alias("site"))
    placed = docs.join(sites, "doc_id", "left").select(
        "doc_id", "bins", F.coalesce("site.host", "source").alias("host"), F.coalesce("site.path", F.concat_ws("/", "source", "lang")).alias("path"))
    judged = quality.posteriors_of(placed, table(spark, folder, "labels").withColumnRenamed("quality", "label"))
    return judged.withColumn("keep", F.col("score") >= 0.5)


def op9_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_groups(table(spark, folder, "documents"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select(
        "doc_id", *map(count, ("assign", "access", "hex")),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"),
    )


def op11_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = table(spark, folder, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.hard_negatives(rows, F.col("id") % 50 == 0)


def removed_bytes(found: DataFrame) -> DataFrame:
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op12_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return removed_bytes(suffixes.without_repeats(table(spark, folder, "documents")))


def periodic_runs(found: DataFrame) -> DataFrame:
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = found.withColumn("best", periodic.longest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), "collapsed_sha256",
    )


def op13_periodic(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs(periodic.scan(table(spark, folder, "documents"), planted=True))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    f.__name__: f
    for f in (op1_toxicity, op2_decontaminate, op3_licenses, op4_merkle, op5_pack, op6_sharding, op7_url_lists, op8_quality, op9_jaccard,
              op10_secrets, op11_negatives, op12_suffixes, op13_periodic, pipeline)
}

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES: dict[str, str] = {
    "op2_decontaminate": rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all({LOWER}, '{WORD}'), []) AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all({LOWER}, '{WORD}') AS ws FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(10, len(ws)) AS k, array_to_string(ws[s : s + least(10, len(ws)) - 1], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS s FROM i WHERE len(ws) > 0)),
dw AS (SELECT r, s, k, array_to_string(ws[s : s + k - 1], ' ') AS w
  FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM iw) WHERE len(ws) >= k)),
h AS (SELECT r, s, k, item_id FROM dw JOIN iw USING (k, w)),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM h) GROUP BY r),
m AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)
""",
    "op6_sharding": r"""
WITH k AS (SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes, md5(coalesce(text, '')) AS digest,
    row_number() OVER (PARTITION BY doc_id, text) AS copy FROM documents),
h AS (SELECT doc_id, n_bytes, CAST('0x' || substr(md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), digest, CAST(copy AS VARCHAR))), 1, 15) AS BIGINT) AS h FROM k),
s AS (SELECT greatest(0, CAST(ceil(log2(greatest(1.0, sum(n_bytes) / LIMIT.0))) AS INT) - 3) AS d0 FROM h),
l AS (SELECT doc_id, n_bytes, h, d, h >> (60 - d) AS p FROM (SELECT h.*, unnest(range(d0, 41)) AS d FROM h, s)),
b AS (SELECT d, p, sum(n_bytes) AS shard_bytes, count(*) AS shard_docs FROM l GROUP BY d, p),
f AS (SELECT * FROM b WHERE shard_bytes <= LIMIT OR shard_docs = 1),
c AS (SELECT l.h, min(f.d) AS d FROM l JOIN f USING (d, p) GROUP BY l.h)
SELECT h.doc_id, CAST(h.n_bytes AS BIGINT) AS n_bytes, substr(lpad(CAST(CAST(h.h AS BIT) AS VARCHAR), 64, '0'), 5, CAST(c.d AS INT)) AS shard,
  CAST(c.d AS INT) AS depth, CAST(f.shard_bytes AS BIGINT) AS shard_bytes, CAST(f.shard_docs AS BIGINT) AS shard_docs
FROM h JOIN c USING (h) JOIN f ON f.d = c.d AND f.p = h.h >> (60 - c.d)
""".replace("LIMIT", str(SHARD_BYTES)),
    "op11_negatives": r"""
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM r a JOIN r c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 3
""",
    "op12_suffixes": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS hx, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT r, doc_id, i, substr(hx, 2 * i + 1, 100) AS s FROM (SELECT *, unnest(range(0, n - 49)) AS i FROM d)),
h AS (SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY s) AS least FROM w) WHERE doc_id > least),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS k
  FROM (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM h)),
p AS (SELECT r, min(i) AS b, max(i) + 50 AS e FROM g GROUP BY r, k),
l AS (SELECT r, sum(e - b) AS n_removed, count(*) AS n_spans, list(b ORDER BY b) AS bs, list(e ORDER BY b) AS es FROM p GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN hx ELSE array_to_string(
    list_transform(range(1, n_spans + 2), lambda j: substr(hx, 2 * coalesce(es[j - 1], 0) + 1, 2 * (coalesce(bs[j], n) - coalesce(es[j - 1], 0)))), '') END)) AS kept_sha256
FROM d LEFT JOIN l USING (r)
""",
    "op7_url_lists": r"""
WITH p AS (SELECT page_id, url, ts AS fetched_at, event_type, user_id,
    regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\.', '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) AS seg
  FROM pages LEFT JOIN events ON event_id = page_id),
q AS (SELECT *, CASE WHEN host = '' OR host IS NULL THEN [] ELSE CASE WHEN seg <> '' THEN [host || '/' || seg, host] ELSE [host] END
    || list_filter(list_transform(range(2, greatest(len(string_split(host, '.')), 2) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')), lambda x: contains(x, '.')) END AS pats FROM p),
e AS (SELECT CASE WHEN event_type = 'signup' THEN pats[1] WHEN len(pats) > 0 THEN host END AS pattern, fetched_at + INTERVAL 12 HOUR AS since,
    max(CASE WHEN event_type IN ('error', 'signup') THEN 2 WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS act
  FROM q WHERE event_type IN ('error', 'signup', 'purchase') OR (event_type = 'click' AND user_id % 7 = 0) GROUP BY 1, 2),
v AS (SELECT pattern, act, since, lead(since) OVER (PARTITION BY pattern ORDER BY since) AS until FROM e WHERE pattern IS NOT NULL AND since IS NOT NULL),
c AS (SELECT row_number() OVER () AS r, * FROM q),
t AS (SELECT r, fetched_at, i AS lvl, pats[i] AS pattern FROM (SELECT r, fetched_at, pats, unnest(range(1, len(pats) + 1)) AS i FROM c)),
m AS (SELECT t.r, arg_min({'p': v.pattern, 'a': v.act, 'f': v.since, 'u': v.until}, lvl) AS s
  FROM t JOIN v ON v.pattern = t.pattern AND t.fetched_at >= v.since AND (v.until IS NULL OR t.fetched_at < v.until) WHERE v.act > 0 GROUP BY t.r)
SELECT page_id, url, fetched_at, coalesce(s.a = 2, FALSE) AS blocked, s.p AS pattern, CASE s.a WHEN 2 THEN 'block' WHEN 1 THEN 'allow' END AS action,
  s.f AS valid_from, s.u AS valid_to
FROM c LEFT JOIN m USING (r)
""",
}

"""Queries of the training-data operators, one per operator, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ctw, decontaminate, divergence, embedding_dedup, periodic_runs, pieces, pii, quality, simhash, stream_dedup, token_counts, token_files, url_filter
from .common import fold_remainder, new_path, table


#: Hosts, lower-cased, whose pages make up the list of op1.
SPAM_HOSTS = r"^([^/]*\.)?(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\."


def spam_pages(pages: DataFrame) -> DataFrame:
    """The addresses whose host is that of a spam site, whatever else they mention."""
    return pages.where(url_filter.host_and_path(F.col("url"))[0].rlike(SPAM_HOSTS)).select("url")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the pages of the spam sites, which are then found under whatever address they are met."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, spam_pages(pages))


OP1_SQL = r"""
WITH r AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
c AS (SELECT *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '(\.html|/)+$', '') AS canon FROM h),
rules(verdict, rule_host, rule_path) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
fit AS (SELECT DISTINCT c.host, c.path, rule_host || rule_path AS rule, verdict FROM c JOIN rules ON (c.host = rule_host OR ends_with(c.host, '.' || rule_host)) AND starts_with(c.path, rule_path)),
won AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fit GROUP BY host, path),
listed AS (SELECT DISTINCT canon FROM c WHERE regexp_matches(host, '^([^/]*\.)?(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.') AND canon <> '')
SELECT page_id, c.host, c.path, won.rule, coalesce(won.verdict, CASE WHEN l.canon IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, won.rule IS NULL AND l.canon IS NOT NULL AS listed
FROM c LEFT JOIN won ON c.host = won.host AND c.path = won.path LEFT JOIN listed l ON c.canon = l.canon
"""


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_item", "n_found", "containment")


#: The same pairs by comparing all shingles of all texts.
OP2_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM benchmark),
k AS (SELECT DISTINCT least(5, len(w)) AS k FROM b WHERE len(w) > 0),
ds AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s FROM d, k WHERE len(w) >= k)),
bs AS (SELECT DISTINCT item_id, s FROM (SELECT item_id, unnest(list_transform(range(1, greatest(1, len(w) - 4) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM b WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
f AS (SELECT doc_id, item_id, count(*) AS n_found FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_found, n_found / n_item AS containment FROM f JOIN n USING (item_id) WHERE n_found >= ceil(n_item * 0.8)
"""


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold_remainder("doc_id", quality.FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= quality.KEEP_SCORE).cast("int").alias("predicted"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read(token_files.write(table(spark, sf_dir, "documents")))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = pieces.encode_and_decode(docs)
    marks = F.regexp_replace("text", pieces.MARK, " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), (F.col("decoded") == marks).alias("round_trip"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_ctw_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_texts(table(spark, sf_dir, "documents"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.dedup(table(spark, sf_dir, "embeddings"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


#: The same by listing every kept term for every pair of sources.
OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT doc_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 30),
v AS (SELECT lang, count(*) AS kept, sum(total) AS total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
cells AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.total AS lang_n FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n,
        1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * kept) AS p,
        1 + (1000000000::HUGEINT * (lang_n + 5)) // (v.total + 5 * kept) AS q
      FROM cells JOIN v USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
parts AS (SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
r AS (SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
SELECT * FROM r WHERE part = 'pair' OR rank <= 50
"""


def op12_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream into a new store; the pattern stands for a folder of files as well as for one file."""
    found = stream_dedup.Dedup(spark, f"{sf_dir}/documents.parque[t]", new_path(spark, "dedup")).run().decisions()
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS letters, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size, row_number() OVER w = 1 AS kept, sha256(body) AS text_sha256
FROM d WINDOW w AS (PARTITION BY body ORDER BY letters DESC, doc_id)
"""


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where a tenth of the texts go round in a period from some word on."""
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), periodic_runs.WHITE), "")
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumns({"g": F.floor(F.col("h") / 10), "words": F.when(F.col("h") % 10 == 0, words)})
    n = F.size("words")
    spread = chosen.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int")).withColumn("p", F.when(n > 0, 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = n - F.col("a")
    round_ = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    turned = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(round_, F.lit(1), rest))
    return spread.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(turned, " ")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(planted(table(spark, sf_dir, "documents")))
    first = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), first.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.period")
    return best.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_url_filter, op2_benchmark_decontamination, op3_quality_classifier, op4_pii, op5_token_files, op6_sentencepiece, op7_simhash_near_dedup, op8_ctw_scores, op9_embedding_near_dedup, op10_token_counts, op11_source_divergence, op12_stream_dedup, op13_periodic_runs)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": OP1_SQL, "op2_benchmark_decontamination": OP2_SQL, "op11_source_divergence": OP11_SQL, "op12_stream_dedup": OP12_SQL}

"""The registered queries of this subpackage: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordset.llm import decontaminate, embedding_dedup, html_text, licenses, lm, mixing, ngram_join, quality, rules, spelling, suffix_dedup, toxicity, whitening
from recordset.llm.frames import crc_fold, table
from recordset.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE_SQL[name] = oracle
        return fn

    return deco


@register("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from labels of rows with crc32(doc_id) mod 4 other than 2; every document is scored."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = crc_fold("doc_id", 4)
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"), keep=fold != 2)
    return quality.score_quality(docs, model).select("doc_id", (fold == 2).alias("held_out"), "score", "predicted")


# Words and windows as in the operator; the spans of hit words come from a plain equality join on the window text.
DECONTAMINATE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT DISTINCT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bk AS (SELECT item_id, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
bi AS (SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM bk),
p AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM bi),
di AS (SELECT rid, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM p) WHERE len(w) >= k),
hit AS (SELECT x.rid, x.i, x.k, p.item_id FROM (SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM di) x JOIN p USING (k, g)),
words AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS j FROM hit) GROUP BY rid),
items AS (SELECT rid, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""


@register("op2_benchmark_decontamination", DECONTAMINATE_SQL)
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), spans=False)
    return hits.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"), "contaminated")


@register("op3_quality_rules")
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from all labelled rows; every document is judged."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = rules.fit_rule_model(docs, table(spark, sf_dir, "labels"))
    return rules.apply_rules(docs, model).select("doc_id", *rules.STATS, "base_failed", "quality_probability", "kept")


@register("op4_lm_scoring")
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted over rows with crc32(doc_id) mod 5 other than 1; every document is scored."""
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = crc_fold("doc_id", 5)
    scored = lm.score_with_language_model(docs, fold != 1)
    return scored.select("doc_id", (fold == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register("op5_html_extraction")
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@register("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from labels of rows with crc32(doc_id) mod 5 other than 0; every document is scored."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = crc_fold("doc_id", 5)
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), keep=fold != 0)
    return toxicity.score_toxicity(docs, model).select("doc_id", (fold == 0).alias("held_out"), "score", "predicted")


@register("op8_source_mixing")
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, weighted by the square root of the size of their source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix_sources(docs)


@register("op9_ngram_jaccard_join")
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    found = ngram_join.link_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def license_sql(templates: dict[str, str]) -> str:
    """Brute force: for every window of a template's class the template shingles in it are counted."""
    rows = []
    for name, text in templates.items():
        shingles = licenses.template_shingles(text)
        cls = licenses.template_class(len(shingles))
        rows += [f"('{name}', {max(cls // 2, 1)}, {1 if cls == 1 else 3}, {licenses.needed(len(shingles))}, '{x}')" for x in shingles]
    return f"""
WITH t(license, block, span, need, sh) AS (VALUES {", ".join(rows)}),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z]+') AS w FROM documents),
n AS (SELECT *, CASE WHEN len(w) = 0 THEN 0 ELSE greatest(len(w) - 4, 1) END AS n FROM d),
s AS (SELECT rid, n, w, unnest(range(0, n)) AS i FROM n),
hit AS (SELECT s.rid, s.n, s.i, t.* FROM (SELECT rid, n, i, array_to_string(w[i + 1:i + 5], ' ') AS sh FROM s) s JOIN t USING (sh)),
win AS (SELECT rid, license, need, sh, unnest(range(greatest(i // block - (span - 1), 0), least(i // block, (n - 1) // block) + 1)) AS k FROM hit),
found AS (SELECT DISTINCT rid, license FROM (SELECT rid, license, k FROM win GROUP BY rid, license, need, k HAVING count(DISTINCT sh) >= need)),
per AS (SELECT rid, count(*) AS n, string_agg(license, ',' ORDER BY license) AS licenses FROM found GROUP BY rid)
SELECT d.doc_id, CAST(coalesce(per.n, 0) AS BIGINT) AS n_licenses, coalesce(per.licenses, '') AS licenses FROM d LEFT JOIN per USING (rid)
"""


@register("op10_license_scan", license_sql(licenses.TEMPLATES))
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_licenses", F.array_join("licenses", ",").alias("licenses"))


# Brute force: all pairs of one label, and the ids reachable over links.
EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS rid, vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
    vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings),
u AS (SELECT rid, vec_id, label, e FROM v WHERE ok),
link AS (
  SELECT a.rid AS a, b.rid AS b, a.vec_id AS id_a, b.vec_id AS id_b FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.rid <> b.rid
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS id, vec_id AS other FROM u UNION SELECT r.id, l.id_b FROM reach r JOIN link l ON l.id_a = r.other),
comp AS (SELECT id, min(other) AS c FROM reach GROUP BY id),
deg AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, CAST(coalesce(deg.n, 0) AS BIGINT) AS n_links, CASE WHEN v.ok THEN comp.c ELSE v.vec_id END AS component_id,
  coalesce(CASE WHEN v.ok THEN comp.c ELSE v.vec_id END = v.vec_id, true) AS kept
FROM v LEFT JOIN deg ON deg.a = v.rid LEFT JOIN comp ON comp.id = v.vec_id
"""


@register("op11_embedding_near_dedup", EMBEDDING_SQL)
def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    found = embedding_dedup.link_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


@register("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents after the query's own deletions of code points."""
    ensure_checkpoint_dir(spark)
    runs = spelling.misspelled(spelling.letter_runs(table(spark, sf_dir, "documents")))
    return spelling.group_variants(spelling.word_counts(runs)).select("word", "n", "n_near", "form", "form_n", "root")


@register("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on all usable vectors, in whole steps of 1/64; up to 32 components of each."""
    rows = table(spark, sf_dir, "embeddings").filter(F.col("embedding").isNotNull() & F.forall("embedding", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))))
    steps = rows.select("vec_id", F.transform("embedding", lambda c: F.floor(64 * c.cast("double")) + 1_000_000).alias("x"))
    model = whitening.fit_whitening(steps, "x")
    white = whitening.whiten(steps, model, "x")
    error = whitening.identity_error(white)
    each = F.posexplode("whitened").alias("place", "whitened")
    if model is None:
        total = share = F.lit(None)
    else:
        # Squares of whole numbers, exact; null where the sum is beyond a long.
        part = F.zip_with("x", F.array(*(F.lit(int(s)) for s in model.sums)), lambda x, s: F.try_subtract(F.try_multiply(F.lit(model.n).cast("long"), x), s))
        total = F.aggregate(part, F.lit(0).cast("long"), lambda acc, d: F.try_add(acc, F.try_multiply(d, d)))
        share = F.element_at(F.array(*(F.lit(float(e)) for e in model.explained())), F.col("component"))
    # Once for a row, below the step that makes its components.
    white = white.select("vec_id", "whitened", total.cast("long").alias("deviation"))
    out = white.select("vec_id", "deviation", each)
    return out.withColumn("component", (F.col("place") + 1).cast("int")).select(
        "vec_id", "component", F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened", share.cast("double").alias("explained"),
        F.lit(error).alias("identity_error"))

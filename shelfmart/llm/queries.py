"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmart.llm import (bpe_codec, chat_preference, embedding_lsh, filter_audit, langid, license_scan, nn_descent,
                           packing, periodic_runs, pfair_mix, simhash, suffix_dedup, toxicity_chain)

#: Target weights of the mixed corpus; sources not named have weight 1.
MIX_WEIGHTS = {"src0": 8, "src1": 5, "src2": 3, "src3": 2}
MIX_BLOCK_ROWS = 16


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A formatted preference pair of every conversation with a reply."""
    pairs = chat_preference.reply_pairs(_table(spark, sf_dir, "conversations"))
    done = chat_preference.format_pairs(pairs)
    ranges = lambda c: F.array_join(F.transform(c, lambda m: F.concat_ws("-", m["start"], m["end"])), ",")
    return done.withColumns({c: ranges(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest other vectors of every hundredth one."""
    vectors = _table(spark, sf_dir, "embeddings")
    return nn_descent.nearest_neighbours(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document, with coverage and spans."""
    found = license_scan.scan_licenses(_table(spark, sf_dir, "documents"))
    return found.withColumn("spans", F.array_join(F.transform(
        "spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ","))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of 50 words or more, all but their first occurrence."""
    return suffix_dedup.repeated_spans(_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the three quarters that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs, langid.id_remainder() != 2)
    held = F.coalesce(langid.id_remainder() == 2, F.lit(False))
    return langid.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op6_embedding_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at cosine 0.95."""
    return embedding_lsh.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.95)


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.digest(packing.pack(_table(spark, sf_dir, "documents"), packing.default_tokenizer(),
                                       special_tokens=True))


def op9_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of low quality and of toxicity for every document."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    chain = toxicity_chain.fit_chain(docs, labels.withColumn("low_quality", 1 - F.col("quality")),
                                     ["low_quality", "toxic"])
    scored = toxicity_chain.score(docs, chain)
    return scored.select("doc_id", "low_quality", "toxic", F.array_contains("flags", "toxic").alias("is_toxic"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of every document in the mix of sources."""
    return pfair_mix.mix(_table(spark, sf_dir, "documents"), MIX_WEIGHTS, block_rows=MIX_BLOCK_ROWS)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, with some planted."""
    return periodic_runs.digest(periodic_runs.runs(periodic_runs.plant(_table(spark, sf_dir, "documents"))))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their orders, per language."""
    return filter_audit.interactions(filter_audit.filter_masks(_table(spark, sf_dir, "documents")),
                                     _table(spark, sf_dir, "labels"))


def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text decoded from them, as digests."""
    tokenizer = bpe_codec.default_tokenizer()
    return bpe_codec.digest(bpe_codec.decode(bpe_codec.encode(_table(spark, sf_dir, "documents"), tokenizer), tokenizer))


_WEIGHT = "CASE source " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in MIX_WEIGHTS.items()) + " ELSE 1 END"

#: The schedule, simulated slot by slot: each step takes, of the sources whose next block is
#: released, the one with the earliest deadline. A phase starts anew when a source ends.
MIX_SQL = f"""
WITH RECURSIVE ranked AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS r FROM documents
), sources AS (
  SELECT source, {_WEIGHT} AS w, CAST(max(r) // {MIX_BLOCK_ROWS} + 1 AS BIGINT) AS blocks,
         row_number() OVER (ORDER BY {_WEIGHT} DESC, 's' || source) AS i
  FROM ranked GROUP BY source
), start AS (
  SELECT list(w ORDER BY i) AS w, list(blocks ORDER BY i) AS blocks, count(*) AS n FROM sources
), steps AS (
  SELECT CAST(-1 AS BIGINT) AS slot, CAST(0 AS BIGINT) AS t, CAST(NULL AS BIGINT) AS chosen,
         [CAST(0 AS BIGINT) FOR x IN w] AS done, [CAST(0 AS BIGINT) FOR x IN w] AS phase, blocks, w,
         CAST(list_sum(w) AS BIGINT) AS total
  FROM start WHERE n > 0
  UNION ALL
  SELECT slot + 1, CASE WHEN ended THEN 0 ELSE t + 1 END, pick, new_done,
         CASE WHEN ended THEN [CAST(0 AS BIGINT) FOR x IN w] ELSE new_phase END, blocks, w,
         CASE WHEN ended THEN total - w[pick] ELSE total END
  FROM (
    SELECT *, [CASE WHEN x = pick THEN done[x] + 1 ELSE done[x] END FOR x IN range(1, len(w) + 1)] AS new_done,
           [CASE WHEN x = pick THEN phase[x] + 1 ELSE phase[x] END FOR x IN range(1, len(w) + 1)] AS new_phase,
           done[pick] + 1 = blocks[pick] AS ended
    FROM (
      SELECT *, list_min([CASE WHEN done[x] < blocks[x] AND phase[x] * total // w[x] <= t
                               THEN ((phase[x] + 1) * total + w[x] - 1) // w[x] * 100000 + x END
                          FOR x IN range(1, len(w) + 1)]) % 100000 AS pick
      FROM steps WHERE list_sum(done) < list_sum(blocks)))
)
SELECT r.doc_id, r.source, CAST(r.r // {MIX_BLOCK_ROWS} AS BIGINT) AS block, CAST(s.slot AS BIGINT) AS slot,
       CAST(row_number() OVER (ORDER BY s.slot, r.r) - 1 AS BIGINT) AS position
FROM ranked r JOIN sources o USING (source)
JOIN (SELECT slot, chosen, done[chosen] - 1 AS block FROM steps WHERE slot >= 0) s
  ON s.chosen = o.i AND s.block = r.r // {MIX_BLOCK_ROWS}
"""

_SAFE = "replace(coalesce({0}, ''), '<|', '< |')"
_TURN = ("'<|' || replace(coalesce(role, 'unknown'), '<|', '< |') || '|>' || chr(10) || "
         + _SAFE.format("text") + " || '<|end|>' || chr(10)")
PREFERENCE_SQL = f"""
WITH turns AS (
  SELECT conv_id, role, text, {_TURN} AS line, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), last AS (
  SELECT conv_id, max(n) AS n FROM turns WHERE role = 'assistant' GROUP BY conv_id
), reply AS (
  SELECT t.conv_id, t.n, t.text, t.line, '14-' || (21 + length({_SAFE.format("t.text")})) AS mask
  FROM turns t JOIN last l ON t.conv_id = l.conv_id AND t.n = l.n
), prompts AS (
  SELECT r.conv_id, string_agg(t.line, '' ORDER BY t.n) AS prompt
  FROM reply r JOIN turns t ON t.conv_id = r.conv_id AND t.n < r.n GROUP BY r.conv_id
), pairs AS (
  SELECT a.conv_id AS pair_id, a.n, coalesce(p.prompt, '') AS prompt, a.line AS chosen, a.mask AS chosen_mask,
         coalesce(b.line, '') AS rejected, coalesce(b.mask, '') AS rejected_mask, b.conv_id IS NULL AS alone,
         b.conv_id IS NOT NULL AND a.text IS NOT DISTINCT FROM b.text AS same
  FROM reply a LEFT JOIN reply b ON b.conv_id = xor(a.conv_id, 1) LEFT JOIN prompts p ON p.conv_id = a.conv_id
)
SELECT pair_id, CAST(CASE WHEN same THEN n ELSE n - 1 END AS BIGINT) AS n_common,
       CASE WHEN same THEN prompt || chosen ELSE prompt END AS prompt,
       CASE WHEN same THEN '' ELSE chosen END AS chosen, CASE WHEN same THEN '' ELSE rejected END AS rejected,
       CASE WHEN same THEN '' ELSE chosen_mask END AS chosen_mask,
       CASE WHEN same THEN '' ELSE rejected_mask END AS rejected_mask,
       CASE WHEN same THEN 'identical' WHEN alone THEN 'rejected_empty' ELSE 'ok' END AS status
FROM pairs
"""

#: Every pair of vectors, for small tables.
LINKS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), u AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95
), reach AS (
  SELECT vec_id AS node, vec_id AS c FROM embeddings WHERE vec_id IS NOT NULL
  UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.node
)
SELECT r.node AS vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, min(r.c) AS component_id,
       min(r.c) = r.node AS kept
FROM reach r LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) d ON d.a = r.node
GROUP BY r.node, d.n
"""

#: Documents by failed filters, then every order of the five, step by step.
AUDIT_SQL = """
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM texts
), failed AS (
  SELECT doc_id, part,
         len(w) < 100 AS a,
         100 * len(list_distinct(w)) < 80 * len(w) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM words
), masks AS (
  SELECT f.part, [a, b, c, d, e] AS fails,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND l.quality = 1) AS good,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND l.toxic = 1) AS bad
  FROM failed f
), counts AS (
  SELECT part, fails, good, bad, count(*) AS n FROM masks GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 3, 4, 5]) AS i
), orders AS (
  SELECT '' AS o, CAST([] AS INTEGER[]) AS idx
  UNION ALL
  SELECT o || c, list_append(idx, i) FROM orders, letters WHERE NOT list_contains(idx, i)
), steps AS (
  SELECT o, idx, step, idx[step] AS f, idx[1:step - 1] AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) WHERE len(idx) = 5
), judged AS (
  SELECT part, o, step, f, n, good, bad, fails[f] AS here,
         list_bool_or([false] || [fails[x] FOR x IN before]) AS gone,
         len([x FOR x IN fails IF x]) AS total
  FROM counts, steps
), summed AS (
  SELECT part, o, step, f,
         sum(n) FILTER (WHERE NOT here AND NOT gone) AS kept, sum(n) FILTER (WHERE here AND NOT gone) AS removed,
         sum(n) FILTER (WHERE here AND gone) AS redundant, sum(n) FILTER (WHERE here AND total = 1) AS unique_fails,
         sum(n) FILTER (WHERE here AND NOT gone AND good) AS good_lost,
         sum(n) FILTER (WHERE here AND NOT gone AND bad) AS toxic_lost
  FROM judged GROUP BY part, o, step, f
)
SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
       CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM summed
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_preference_formatting, op2_nn_descent, op3_license_scan, op4_suffix_array_dedup, op5_language_id,
        op6_embedding_lsh, op7_simhash_near_dedup, op8_packing, op9_toxicity_chain, op10_source_mixing,
        op11_periodic_runs, op12_filter_audit, op13_bpe_codec)}
ORACLE: dict[str, str] = {
    "op1_preference_formatting": PREFERENCE_SQL,
    "op6_embedding_lsh": LINKS_SQL,
    "op10_source_mixing": MIX_SQL,
    "op12_filter_audit": AUDIT_SQL,
}

"""Registered queries of the training-text operators, and their SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm import (
    boosting,
    jaccard,
    language,
    manifest,
    mixing,
    packing,
    quality,
    secrets,
    sketch,
    tokens,
    toxicity,
    warc,
    whitening,
)
from tabml.llm.frames import remainder, table


def op1_language_codes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    part = remainder(F.col("doc_id"), 3)
    learn = docs.filter(F.coalesce(part != 1, F.lit(True))).select(F.col("doc_id").alias("key"), "text", "lang")
    found = language.predict(docs, language.fit(learn))
    held = F.coalesce(part == 1, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


def op2_token_cache(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = tokens.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return found.withColumn("over_limit", F.col("n_tokens") > 512)


def op3_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    labels = table(spark, folder, "labels").filter(~held).select("doc_id", F.col("quality").alias("label"))
    found = boosting.score(docs, boosting.fit(docs, labels))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_curriculum_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    ordered = mixed.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")
    return ordered.select("doc_id", "size", "source_size", "target", "taken", F.size("positions").cast("long").alias("passes"))


def op5_jaccard_product(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, folder, "documents"))


def op6_online_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    pieces = packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, drops_space=True)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    # The pages carry no capture time: one second after another by id.
    captured = F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0)))
    index = warc.merged_index(warc.capture_runs(spark, warc.write_archives(pages, captured)))
    return index.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "intact"
    )


def op8_paragraph_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.versions(table(spark, folder, "documents"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality.judge(docs, quality.fit(docs, labels))


def op10_blob_ledger(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))
    kinds = [r.kind for r in secrets.BASE]
    base = F.filter("found", lambda f: f["kind"].isin(kinds))
    counts = [
        F.size(F.filter("found", lambda f: f["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")  # noqa: B023
        for kind in kinds
    ]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("found")).alias("spans")
    )


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    spoilt = F.when(remainder(F.col("doc_id"), 2) == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    load = {"doc_id": F.col("doc_id"), "claim": manifest.leaf_of([*fields[:4], spoilt])}
    found = manifest.build(docs, F.col("source"), F.col("doc_id"), fields, load)
    proofs = found.prove(found.leaves).select(
        "load.doc_id",
        "leaf",
        "subroot",
        F.lit(found.root).alias("root"),
        manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        manifest.folded(F.col("load.claim"), F.col("path")).alias("folded_root"),
    )
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_fair_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    labels = table(spark, folder, "labels").filter(~held).select("doc_id", F.col("toxic").alias("label"))
    found = toxicity.score(docs, toxicity.fit(docs, labels))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op13_rank_one_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    "op1_language_codes": op1_language_codes,
    "op2_token_cache": op2_token_cache,
    "op3_quality_trees": op3_quality_trees,
    "op4_curriculum_mix": op4_curriculum_mix,
    "op5_jaccard_product": op5_jaccard_product,
    "op6_online_packing": op6_online_packing,
    "op7_warc_index": op7_warc_index,
    "op8_paragraph_sketch": op8_paragraph_sketch,
    "op9_quality_rules": op9_quality_rules,
    "op10_blob_ledger": op10_blob_ledger,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_fair_toxicity": op12_fair_toxicity,
    "op13_rank_one_whitening": op13_rank_one_whitening,
    "pipeline": pipeline,
}

_WORD = r"[^\x20\x09-\x0D]+"

_OP4 = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{_WORD}')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS draw
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS whole FROM sized GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight FROM totals),
tiers AS (
  SELECT *, sum(whole) OVER () AS words, sum(weight) OVER () AS weights,
         coalesce(sum(3 * whole) OVER before, 0) AS held, coalesce(sum(weight) OVER before, 0) AS gone
  FROM weighed
  WINDOW before AS (ORDER BY whole / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shares AS (
  SELECT *, CAST(words - held AS DOUBLE) / CAST(weights - gone AS DOUBLE) AS share FROM tiers),
share AS (
  SELECT coalesce((SELECT share FROM shares WHERE 3 * whole > share * weight
                   ORDER BY whole / weight, source ASC NULLS LAST LIMIT 1), 0) AS share),
goals AS (
  SELECT source, whole, CAST(CASE WHEN 3 * whole <= share.share * weight THEN 3 * whole ELSE share.share * weight END AS DOUBLE) AS target
  FROM weighed, share),
placed AS (
  SELECT sized.*, whole, target,
         sum(size) OVER (PARTITION BY sized.source ORDER BY draw, size, doc_id ROWS UNBOUNDED PRECEDING) - size / 2 AS middle
  FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source),
passed AS (
  SELECT *, CASE WHEN whole > 0 THEN CAST(floor(target / whole) AS INTEGER) ELSE 0 END AS turns FROM placed)
SELECT doc_id, size, whole AS source_size, target,
       CAST(size * (turns + CASE WHEN middle < target - turns * whole THEN 1 ELSE 0 END) AS BIGINT) AS taken,
       CAST(turns + CASE WHEN middle < target - turns * whole THEN 1 ELSE 0 END AS BIGINT) AS passes
FROM passed
"""

_OP5 = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}'), []) AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([array_to_string(w[i : i + 3], ' ') for i in range(1, len(w) - 2)]) END AS grams
  FROM worded),
cells AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM cells a JOIN cells b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a)
SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
"""

_OP7 = r"""
WITH sized AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
copies AS (SELECT digest, max(page_id) AS first, count(*) AS c FROM sized WHERE n >= 1000 GROUP BY digest),
parts AS (
  SELECT *, regexp_replace(coalesce(url, ''), '^[^:]*://', '') AS rest FROM sized LEFT JOIN copies USING (digest)),
hosts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/]*')), ':.*$', ''), '^www[.]', '') AS host,
         lower(regexp_replace(regexp_replace(rest, '^[^/]*/?', ''), '#.*$', '')) AS path
  FROM parts)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN c > 1 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN c > 1 AND page_id <> first THEN first END AS refers_to,
       CASE WHEN coalesce(url, '') = '' THEN '' ELSE
         array_to_string(list_reverse(string_split(host, '.')), ',') || ')/' || path END AS url_key,
       CAST(1700000000 + coalesce(page_id, 0) AS BIGINT) AS captured, true AS intact
FROM hosts
"""


# kind, pattern, and the group and least length that a match needs; written out apart from the operator's rules.
_SECRETS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    (
        "private_key",
        "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----(?:[^-]*(?:-{1,4}[^-]+)*-{5,}END (?:[A-Z]+ )*PRIVATE KEY-----|"
        r"""[\x20\t\r\n\\"',>|#*+]*(?:[A-Za-z][A-Za-z-]*:\x20?[^\x20\t\r\n\\"']+[\x20\t\r\n\\"',>|#*+]+){0,8}"""
        r"""[A-Za-z0-9+/]{16}[A-Za-z0-9+/=\r\n\\"',]*(?:[\x20\t\r\n\\"',>|#*+]+[A-Za-z0-9+/]{16}[A-Za-z0-9+/=\r\n\\"',]*)*"""
        r"""(?:[\x20\t\r\n\\"',>|#*+]+[A-Za-z0-9+/]+={0,2})?)?""",
        0,
        0,
    ),
    ("json_web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("code_host_token", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("chat_token", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
]


def _op10() -> str:
    """Matches of each rule: the text with marks around them is split, lengths before a part are its place."""
    parts = []
    for place, (kind, pattern, group, least) in enumerate(_SECRETS):
        pattern = pattern.replace("'", "''")
        keeps = f"length(regexp_extract(part, '{pattern}', {group})) >= {least}"
        parts.append(f"""
  SELECT doc_id, '{kind}' AS kind, {place} AS place, start, start + length(part) AS stop
  FROM (SELECT doc_id, split[i] AS part, coalesce(list_sum([length(x) for x in split[1 : i - 1]]), 0) AS start
        FROM (SELECT doc_id, split, unnest(range(2, len(split) + 1, 2)) AS i
              FROM (SELECT doc_id, string_split(replace(regexp_replace(plain, '{pattern}', chr(1) || '\\0' || chr(2), 'g'),
                                                        chr(2), chr(1)), chr(1)) AS split FROM texts)))
  WHERE {keeps if least else "true"}""")
    base = "'assign', 'access', 'hex'"
    counts = ", ".join(f"CAST(count(*) FILTER (kind = '{k}') AS BIGINT) AS n_{k}" for k in ("assign", "access", "hex"))
    order = "ORDER BY start, place, stop"
    span = "kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT)"
    return f"""
WITH texts AS (
  SELECT doc_id, replace(replace(coalesce(text, ''), chr(1), chr(3)), chr(2), chr(3)) AS plain FROM documents),
spans AS ({" UNION ALL ".join(parts)}),
found AS (
  SELECT doc_id, {counts}, string_agg({span}, ',' {order}) FILTER (kind IN ({base})) AS base,
         string_agg({span}, ',' {order}) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in ("assign", "access", "hex"))},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN found USING (doc_id)
"""


def _entry(column: str) -> str:
    return f"coalesce(CAST(strlen(CAST({column} AS VARCHAR)) AS VARCHAR) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_entry(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


# CRC-32 of the decimal id, bit by bit.
_CRC32 = """xor(list_reduce(
  [4294967295::BIGINT] || list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: ascii(CAST(doc_id AS VARCHAR)[i])::BIGINT),
  lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384::BIGINT))),
  4294967295::BIGINT)"""


def _op11() -> str:
    """Nodes level by level, the siblings of each leaf by its place, and a fold one sibling run at a time."""
    grown = """
    SELECT tree, level + 1, spot // 3, sha256(string_agg(digest, '' ORDER BY spot)), (size + 2) // 3
    FROM {nodes} WHERE size > 1 GROUP BY tree, level, spot // 3, size"""
    return f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS tree, {_leaf("text")} AS leaf,
         {_leaf("CASE WHEN crc32_of % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS claim
  FROM (SELECT *, {_CRC32} AS crc32_of FROM documents)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot,
         count(*) OVER (PARTITION BY tree) AS size
  FROM leaves),
nodes(tree, level, spot, digest, size) AS (
  SELECT tree, 0, spot, leaf, size FROM placed
  UNION ALL {grown.format(nodes="nodes")}),
subroots AS (
  SELECT tree, level AS height, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS spot, count(*) OVER () AS size
  FROM nodes WHERE size = 1),
upper_nodes(tree, level, spot, digest, size) AS (
  SELECT '', 0, spot, subroot, size FROM subroots
  UNION ALL {grown.format(nodes="upper_nodes")}),
ways AS (
  SELECT doc_id, leaf, claim, subroot, placed.tree, placed.spot, height, subroots.spot AS place,
         (SELECT max(level) FROM upper_nodes) AS top
  FROM placed JOIN subroots USING (tree)),
steps AS (
  SELECT ways.doc_id, ways.leaf, step, CAST(CASE WHEN step < height THEN spot // CAST(pow(3, step) AS BIGINT)
           ELSE place // CAST(pow(3, step - height) AS BIGINT) END AS BIGINT) AS spot, step < height AS low, tree, height
  FROM ways, unnest(range(0, height + top)) AS r(step)),
siblings AS (
  SELECT doc_id, leaf, step, coalesce(string_agg(n.digest, '' ORDER BY n.spot) FILTER (n.spot < s.spot), '') AS l,
         coalesce(string_agg(n.digest, '' ORDER BY n.spot) FILTER (n.spot > s.spot), '') AS r
  FROM steps s JOIN (SELECT *, true AS low FROM nodes UNION ALL SELECT *, false FROM upper_nodes) n
    ON n.low = s.low AND n.tree = CASE WHEN s.low THEN s.tree ELSE '' END
       AND n.level = CASE WHEN s.low THEN step ELSE step - height END AND n.spot // 3 = s.spot // 3
  GROUP BY doc_id, leaf, step),
folds(doc_id, leaf, step, digest) AS (
  SELECT doc_id, leaf, 0, claim FROM ways
  UNION ALL
  SELECT f.doc_id, f.leaf, f.step + 1, sha256(l || digest || r)
  FROM folds f JOIN siblings s ON s.doc_id = f.doc_id AND s.step = f.step),
proofs AS (SELECT doc_id, string_agg(l || r, '' ORDER BY step) AS proof FROM siblings GROUP BY doc_id),
root AS (SELECT digest AS root FROM upper_nodes WHERE size = 1)
SELECT ways.doc_id, ways.leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256,
       folds.digest AS folded_root, folds.digest = root AS verified
FROM ways JOIN root ON true LEFT JOIN proofs USING (doc_id)
JOIN folds ON folds.doc_id = ways.doc_id AND folds.step = height + top
"""


SQL: dict[str, str] = {
    "op4_curriculum_mix": _OP4,
    "op5_jaccard_product": _OP5,
    "op7_warc_index": _OP7,
    "op10_blob_ledger": _op10(),
    "op11_merkle_manifest": _op11(),
}

"""Queries on equipment evidence, registers and reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import evidence as ev
from .registry import fixture, query

fixture(
    "evidence",
    """SELECT md5(concat_ws('|', CAST(l_orderkey AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING), CAST(l_linenumber AS STRING), CAST(CAST(l_quantity AS INT) AS STRING), l_returnflag, l_linestatus, CAST(CAST(round(l_discount * 100) AS INT) AS STRING))) AS evidence_id,
  concat('EQ-', lpad(CAST(l_partkey AS STRING), 6, '0')) AS equipment_id,
  CAST(l_partkey AS STRING) AS equipment_tag,
  lpad(CAST((l_partkey * 7919) % 10000000 AS STRING), 7, '0') AS serial_number,
  CASE l_linenumber WHEN 1 THEN 'model' WHEN 2 THEN 'equipment_description' WHEN 3 THEN 'range_or_rating' WHEN 4 THEN 'set_point' WHEN 5 THEN 'declaration_reference' WHEN 6 THEN 'order_acceptance_number' ELSE 'test_certificate_reference' END AS field_name,
  l_returnflag AS field_value,
  CAST(l_orderkey % 200 + 1 AS INT) AS source_page,
  CASE WHEN l_linestatus = 'O' THEN 'tier_1_dense_record_evidence' WHEN l_suppkey % 2 = 0 THEN 'tier_2_local_shared_block_evidence' ELSE 'tier_1_direct_or_linked_row' END AS evidence_tier,
  round(1 - l_discount, 2) AS confidence,
  CAST(l_quantity AS DOUBLE) AS selection_score,
  CASE CAST(l_suppkey % 3 AS INT) WHEN 0 THEN 'selected' WHEN 1 THEN 'selected_with_review' ELSE 'rejected' END AS selection_status,
  CASE WHEN l_suppkey % 11 = 0 THEN l_returnflag ELSE concat('line ', l_returnflag, ' ', l_linestatus, ' ', CAST(l_suppkey % 5 AS STRING)) END AS source_text,
  CASE WHEN l_partkey % 13 = 0 THEN '' ELSE concat('EQ-', lpad(CAST(l_partkey AS STRING), 6, '0')) END AS registry_id
FROM lineitem""",
)
fixture(
    "register_wide",
    """SELECT CAST(p_partkey AS STRING) AS equipment_tag, lpad(CAST((p_partkey * 7919) % 10000000 AS STRING), 7, '0') AS serial_number,
  CASE CAST(p_partkey % 4 AS INT) WHEN 0 THEN '' WHEN 1 THEN 'A' WHEN 2 THEN 'N' ELSE 'R' END AS model,
  CASE CAST(p_partkey % 5 AS INT) WHEN 0 THEN '' WHEN 1 THEN 'a' WHEN 2 THEN 'Z' ELSE 'R' END AS equipment_description,
  CASE CAST(p_partkey % 3 AS INT) WHEN 0 THEN 'N' WHEN 1 THEN '' ELSE 'Q' END AS range_or_rating,
  CASE CAST(p_partkey % 7 AS INT) WHEN 0 THEN '' WHEN 1 THEN 'A bar' WHEN 2 THEN 'bar R' ELSE 'N' END AS set_point,
  CASE CAST(p_partkey % 6 AS INT) WHEN 0 THEN '' ELSE concat('PO-', CAST(p_partkey % 50 AS STRING)) END AS purchase_order,
  CASE CAST(p_partkey % 9 AS INT) WHEN 0 THEN '' ELSE concat('DC', CAST(p_partkey % 40 AS STRING)) END AS declaration_reference
FROM part""",
)
fixture("register", "SELECT equipment_tag, serial_number, field_name, value FROM (SELECT equipment_tag, serial_number, 'model' AS field_name, model AS value FROM register_wide UNION ALL SELECT equipment_tag, serial_number, 'equipment_description', equipment_description FROM register_wide UNION ALL SELECT equipment_tag, serial_number, 'range_or_rating', range_or_rating FROM register_wide UNION ALL SELECT equipment_tag, serial_number, 'set_point', set_point FROM register_wide) q", "register_wide")
fixture(
    "registry_rows",
    """SELECT concat('EQ-', lpad(CAST(p_partkey AS STRING), 6, '0')) AS equipment_id,
  CASE WHEN p_partkey % 17 = 0 THEN ' ' ELSE CAST(p_partkey AS STRING) END AS equipment_tag,
  CASE CAST(p_partkey % 8 AS INT) WHEN 0 THEN '' WHEN 1 THEN '12345' WHEN 2 THEN '123456' WHEN 3 THEN '12-34567' ELSE lpad(CAST((p_partkey * 7919) % 10000000 AS STRING), 7, '0') END AS serial_number
FROM part""",
)
FIELDS = ("model", "equipment_description", "range_or_rating", "set_point")

RANKED = """, ranked AS (SELECT *, CASE evidence_tier WHEN 'tier_1_dense_record_evidence' THEN 4 WHEN 'tier_1_direct_or_linked_row' THEN 4 WHEN 'tier_2_local_shared_block_evidence' THEN 2 ELSE 0 END AS tr, lower(trim(field_value)) AS nv FROM evidence),
lead AS (SELECT equipment_id, equipment_tag, serial_number, field_name, nv, max(row(tr, confidence, selection_score)) AS sc, count(*) AS n FROM ranked GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY equipment_id, field_name ORDER BY sc DESC, nv DESC) AS r, count(*) OVER (PARTITION BY equipment_id, field_name) AS n_values, sum(n) OVER (PARTITION BY equipment_id, field_name) AS n_rows FROM lead),
g AS (SELECT b.equipment_id, b.equipment_tag, b.serial_number, b.field_name, b.n_values, CAST(b.n_rows AS BIGINT) AS n_rows, b.nv AS norm_value, m.tr AS tier_rank, m.confidence, m.selection_score
      FROM best b JOIN (SELECT *, row_number() OVER (PARTITION BY equipment_id, field_name ORDER BY tr DESC, confidence DESC, selection_score DESC, nv DESC) AS r FROM ranked) m ON m.equipment_id = b.equipment_id AND m.field_name = b.field_name AND m.r = 1 WHERE b.r = 1),
scored AS (SELECT *, least(100, (CASE WHEN field_name = 'order_acceptance_number' THEN 25 ELSE 0 END) + (CASE WHEN n_values > 1 THEN 45 ELSE 0 END) + (CASE WHEN tier_rank >= 3 THEN 20 WHEN tier_rank = 2 THEN 10 ELSE 5 END) + (CASE WHEN confidence < 0.85 THEN 25 WHEN confidence < 0.95 THEN 10 ELSE 0 END)) AS ps,
  (n_values <= 1 AND tier_rank >= 4 AND confidence >= 0.95) AS ok FROM g),
decided AS (SELECT equipment_id, equipment_tag, serial_number, field_name, n_values, norm_value, tier_rank, confidence, ps AS priority_score, CASE WHEN ps >= 70 THEN 'high' WHEN ps >= 40 THEN 'medium' ELSE 'low' END AS priority, ok AS auto_accepted,
  CASE WHEN ok THEN 'meets auto-accept policy' WHEN n_values > 1 THEN 'conflicting candidate values' WHEN tier_rank < 4 THEN 'evidence tier below auto-accept threshold' ELSE 'confidence below auto-accept threshold' END AS reason,
  CASE WHEN ok THEN 'auto_accept' WHEN n_values > 1 THEN 'compare_candidates' ELSE 'review_source_context' END AS action FROM scored)
"""


PROVENANCE = ", pv AS (SELECT equipment_id, field_name, array_to_string(list_sort(list_distinct(list(source_page))), '|') AS source_pages, array_to_string(list_sort(list_distinct(list(evidence_id))), '|') AS evidence_ids, array_to_string(list_sort(list_distinct(list(source_text))), ' || ') AS source_texts FROM evidence GROUP BY 1, 2) "


@query("a15_best_evidence", "evidence", sql=RANKED + PROVENANCE + "SELECT equipment_id, equipment_tag, serial_number, field_name, n_values, n_rows, norm_value, tier_rank, confidence, selection_score, source_pages, evidence_ids, source_texts FROM g JOIN pv USING (equipment_id, field_name)")
def a15(i):
    g = ev.best_evidence(i.evidence)
    joined = [F.array_join(c, by).alias(c) for c, by in (("source_pages", "|"), ("evidence_ids", "|"), ("source_texts", " || "))]
    return g.select("equipment_id", "equipment_tag", "serial_number", "field_name", "n_values", "n_rows", "norm_value", F.col("score.rank").alias("tier_rank"), "score.confidence", "score.selection_score", *joined)


def _decided(i):
    """Decisions with what they rest on as text."""
    d = ev.decide(ev.best_evidence(i.evidence))
    for c, by in (("source_pages", "|"), ("evidence_ids", "|"), ("source_texts", " || ")):
        d = d.withColumn(c, F.array_join(c, by))
    return d


@query("p34_auto_accept", "evidence", sql=RANKED + PROVENANCE + "SELECT decided.*, source_pages, evidence_ids, source_texts FROM decided JOIN pv USING (equipment_id, field_name)")
def p34(i):
    return _decided(i)


@query("p33_priority_score", "evidence", sql=RANKED + "SELECT equipment_id, field_name, priority_score, priority FROM decided WHERE NOT auto_accepted")
def p33(i):
    return ev.decide(ev.best_evidence(i.evidence)).filter("not auto_accepted").select("equipment_id", "field_name", "priority_score", "priority")


@query("a16_equipment_summary", "evidence", sql=RANKED + "SELECT equipment_id, equipment_tag, serial_number, count(*) AS review_fields, count(*) FILTER (priority = 'high') AS high_priority_fields, count(*) FILTER (NOT auto_accepted) AS candidate_groups, CASE WHEN count(*) FILTER (priority = 'high') > 0 THEN 'review_high_priority_first' ELSE 'review_when_available' END AS action FROM decided GROUP BY ALL")
def a16(i):
    return ev.summary(ev.decide(ev.best_evidence(i.evidence)))


@query("o02_review_order", "evidence", sql=RANKED + PROVENANCE + "SELECT equipment_id, field_name, priority, priority_score, source_pages, evidence_ids, source_texts, row_number() OVER (PARTITION BY equipment_id ORDER BY CASE priority WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, priority_score DESC, field_name) AS position FROM decided JOIN pv USING (equipment_id, field_name) WHERE NOT auto_accepted")
def o02(i):
    from pyspark.sql.window import Window

    d = _decided(i).filter("not auto_accepted")
    band = t.rank(F.col("priority"), {"high": 0, "medium": 1, "low": 2})
    w = Window.partitionBy("equipment_id").orderBy(band, F.desc("priority_score"), "field_name")
    return d.select("equipment_id", "field_name", "priority", "priority_score", "source_pages", "evidence_ids", "source_texts", F.row_number().over(w).alias("position"))


@query("a08_first_seen_values", "evidence", sql=" SELECT equipment_id, field_name, list(field_value ORDER BY first_id) AS field_values FROM (SELECT equipment_id, field_name, field_value, min(evidence_id) AS first_id FROM evidence GROUP BY ALL) q GROUP BY ALL".replace("list(field_value ORDER BY first_id)", "string_agg(field_value, '|' ORDER BY first_id)"))
def a08(i):
    g = i.evidence.groupBy("equipment_id", "field_name").agg(t.first_seen(F.col("field_value"), F.col("evidence_id")).alias("v"))
    return g.select("equipment_id", "field_name", F.array_join("v", "|").alias("field_values"))


PATTERN = """, n AS (SELECT *, lower(trim(field_name)) AS norm_field, lower(trim(field_value)) AS norm_value, lower(trim(source_text)) AS norm_source FROM evidence),
k AS (SELECT * FROM n WHERE norm_field <> '' AND norm_value <> '' AND norm_value <> norm_field AND norm_source <> norm_value AND norm_source <> norm_field)
"""


@query("a17_evidence_patterns", "evidence", sql=PATTERN + "SELECT concat('PAT-', upper(left(sha1(norm_field || '|' || norm_value || '|' || norm_source), 12))) AS pattern_id, norm_field, norm_value, norm_source, count(DISTINCT equipment_id) AS n_equipment, string_agg(DISTINCT CAST(source_page AS STRING), ',' ORDER BY CAST(source_page AS STRING)) AS pages, max(confidence) AS max_confidence, count(*) AS n_rows, CASE WHEN count(DISTINCT equipment_id) > 1 THEN 'review_once_then_propagate' ELSE 'review_equipment_specific' END AS action FROM k GROUP BY norm_field, norm_value, norm_source")
def a17(i):
    return ev.patterns(i.evidence.withColumn("source_page", F.col("source_page").cast("string")))


@query("p37_label_only", "evidence", sql=PATTERN + "SELECT evidence_id, norm_field, norm_value FROM n WHERE NOT (norm_field <> '' AND norm_value <> '' AND norm_value <> norm_field AND norm_source <> norm_value AND norm_source <> norm_field)")
def p37(i):
    e = i.evidence.select("evidence_id", t.casefold(t.clean("field_name")).alias("norm_field"), t.casefold(t.clean("field_value")).alias("norm_value"), t.casefold(t.clean("source_text")).alias("s"))
    keep = (F.col("norm_field") != "") & (F.col("norm_value") != "") & (F.col("norm_value") != F.col("norm_field")) & (F.col("s") != F.col("norm_value")) & (F.col("s") != F.col("norm_field"))
    return e.filter(~keep).drop("s")


@query("f18_sha1_ids", "evidence", sql=PATTERN + "SELECT DISTINCT concat('REV-', upper(left(sha1(equipment_id || '|' || field_name), 12))) AS review_id, equipment_id, field_name FROM evidence")
def f18(i):
    return i.evidence.select("equipment_id", "field_name").distinct().select(t.short_id("REV-", F.col("equipment_id"), F.col("field_name")).alias("review_id"), "equipment_id", "field_name")


@query("f19_comparison_ids", "register", sql=" SELECT concat('CMP-', upper(left(sha1(equipment_tag || '|' || serial_number || '|' || field_name), 12))) AS comparison_id, equipment_tag, field_name FROM register")
def f19(i):
    return i.register.select(t.short_id("CMP-", F.col("equipment_tag"), F.col("serial_number"), F.col("field_name")).alias("comparison_id"), "equipment_tag", "field_name")


@query("a13_identity_registry", "evidence", sql=", k AS (SELECT concat(regexp_replace(upper(equipment_tag), '[^A-Z0-9]', '', 'g'), '::', trim(serial_number)) AS identity_key, * FROM evidence), g AS (SELECT identity_key, min(equipment_tag) AS equipment_tag, min(serial_number) AS serial_number, array_to_string(list_sort(list(DISTINCT source_page)), ',') AS pages FROM k GROUP BY 1) SELECT printf('EQ-%04d', row_number() OVER (ORDER BY identity_key)) AS registry_id, * FROM g")
def a13(i):
    return ev.identity_registry(i.evidence)


@query("w01_sequence_ids", "evidence", sql=", g AS (SELECT DISTINCT equipment_id, field_name FROM evidence) SELECT printf('E-%06d', row_number() OVER (PARTITION BY equipment_id ORDER BY field_name)) AS row_id, equipment_id, field_name FROM g")
def w01(i):
    from pyspark.sql.window import Window

    w = Window.partitionBy("equipment_id").orderBy("field_name")
    return i.evidence.select("equipment_id", "field_name").distinct().select(F.format_string("E-%06d", F.row_number().over(w)).alias("row_id"), "equipment_id", "field_name")


@query("w02_rank_one", "evidence", sql=" SELECT equipment_id, field_name, evidence_id, confidence FROM (SELECT DISTINCT equipment_id, field_name, evidence_id, confidence, selection_score FROM evidence) q QUALIFY row_number() OVER (PARTITION BY equipment_id, field_name ORDER BY confidence DESC, selection_score DESC, evidence_id) = 1")
def w02(i):
    from pyspark.sql.window import Window

    w = Window.partitionBy("equipment_id", "field_name").orderBy(F.desc("confidence"), F.desc("selection_score"), "evidence_id")
    e = i.evidence.select("equipment_id", "field_name", "evidence_id", "confidence", "selection_score").distinct()
    return e.withColumn("r", F.row_number().over(w)).filter("r = 1").select("equipment_id", "field_name", "evidence_id", "confidence")


@query("o08_arg_max", "evidence", sql=" SELECT field_name, field_value, max(confidence) AS confidence, min(evidence_id) FILTER (confidence = top) AS evidence_id FROM (SELECT *, max(confidence) OVER (PARTITION BY field_name, field_value) AS top FROM evidence) q GROUP BY 1, 2")
def o08(i):
    best = F.max_by("evidence_id", F.struct("confidence", F.lit(0)))
    g = i.evidence.groupBy("field_name", "field_value", "confidence").agg(F.min("evidence_id").alias("evidence_id"))
    return g.groupBy("field_name", "field_value").agg(F.max("confidence").alias("confidence"), best.alias("evidence_id"))


PROMOTED = """, n AS (SELECT *, regexp_replace(lower(field_name), '[^a-z0-9]', '', 'g') AS nn, regexp_replace(lower(field_value), '[^a-z0-9]', '', 'g') AS nv FROM evidence),
promoted AS (SELECT *, CASE WHEN registry_id = '' THEN 'review' WHEN nn = nv OR nv = '' THEN 'review'
 WHEN evidence_tier = 'tier_1_direct_or_linked_row' AND selection_status IN ('selected', 'selected_with_review') THEN 'eligible'
 WHEN evidence_tier = 'tier_1_dense_record_evidence' AND field_name <> 'order_acceptance_number' THEN 'eligible' ELSE 'review' END AS promotion_status,
 CASE WHEN registry_id = '' THEN 'unmatched equipment identity' WHEN nn = nv OR nv = '' THEN 'value repeats the field name'
 WHEN evidence_tier = 'tier_1_direct_or_linked_row' AND selection_status IN ('selected', 'selected_with_review') THEN 'selected row'
 WHEN evidence_tier = 'tier_1_dense_record_evidence' AND field_name = 'order_acceptance_number' THEN 'derived from declaration-reference suffix'
 WHEN evidence_tier = 'tier_1_dense_record_evidence' THEN 'dense record field' ELSE 'shared, inherited, or review-status evidence' END AS promotion_reason FROM n)
"""


@query("p29_promotion", "evidence", sql=PROMOTED + "SELECT evidence_id, field_name, promotion_status, promotion_reason FROM promoted")
def p29(i):
    return ev.promotion(i.evidence).select("evidence_id", "field_name", "promotion_status", "promotion_reason")


@query("a14_competing_values", "evidence", sql=PROMOTED + "SELECT equipment_tag, serial_number, field_name, count(DISTINCT nv) AS n_values, count(DISTINCT nv) > 1 AS competing FROM promoted WHERE promotion_status = 'eligible' GROUP BY 1, 2, 3")
def a14(i):
    return ev.competing(ev.promotion(i.evidence))


@query("j07_evidence_registry", "evidence", "registry_rows", sql=" SELECT e.evidence_id, e.equipment_tag, CASE WHEN r.k IS NULL THEN 'unmatched' ELSE 'matched' END AS link FROM evidence e LEFT JOIN (SELECT DISTINCT equipment_tag || '::' || serial_number AS k FROM registry_rows) r ON r.k = e.equipment_tag || '::' || e.serial_number")
def j07(i):
    key = F.concat_ws("::", t.norm_upper("equipment_tag"), t.norm_upper("serial_number"))
    r = i.registry_rows.select(key.alias("k")).distinct().withColumn("hit", F.lit(True))
    j = i.evidence.withColumn("k", key).join(r, "k", "left")
    return j.select("evidence_id", "equipment_tag", F.when(F.col("hit"), "matched").otherwise("unmatched").alias("link"))


@query("a18_canonical_values", "evidence", sql=", v AS (SELECT equipment_tag, field_name, field_value, count(*) AS support, max(confidence) AS confidence, min(source_page) AS page FROM evidence GROUP BY 1, 2, 3) SELECT equipment_tag, field_name, field_value, support, confidence, page, n_values FROM (SELECT *, count(*) OVER (PARTITION BY equipment_tag, field_name) AS n_values, row_number() OVER (PARTITION BY equipment_tag, field_name ORDER BY support DESC, confidence DESC, page, field_value DESC) AS r FROM v) q WHERE r = 1")
def a18(i):
    return ev.canonical_values(i.evidence)


@query("a19_dedup_max_confidence", "evidence", sql=" SELECT evidence_id, field_name, equipment_tag, source_page, confidence FROM evidence QUALIFY row_number() OVER (PARTITION BY field_name, lower(field_value), equipment_tag, source_page ORDER BY confidence DESC, evidence_id) = 1")
def a19(i):
    return ev.deduplicated(i.evidence).select("evidence_id", "field_name", "equipment_tag", "source_page", "confidence")


@query("a23_longest_value", "evidence", sql=" SELECT equipment_tag, field_name, source_text FROM (SELECT DISTINCT equipment_tag, field_name, source_text FROM evidence) q QUALIFY row_number() OVER (PARTITION BY equipment_tag, field_name ORDER BY length(source_text) DESC, source_text DESC) = 1")
def a23(i):
    return ev.longest_values(i.evidence)


@query("a25_merge_records", "evidence", sql=" SELECT equipment_tag, serial_number, array_to_string(list_sort(list(DISTINCT source_page)), ',') AS linked_pages, arg_min(field_value, row(source_page, evidence_id)) AS first_value, count(*) AS n_rows FROM evidence GROUP BY 1, 2")
def a25(i):
    return ev.merged_records(i.evidence)


@query("a27_page_tags", "evidence", sql=" SELECT source_page, array_to_string(list_sort(list(DISTINCT equipment_tag)), ',') AS tags, count(DISTINCT equipment_tag) AS n_tags FROM evidence GROUP BY 1")
def a27(i):
    return ev.page_tags(i.evidence)


@query("a32_relationship_scope", "evidence", sql=", k AS (SELECT source_text, count(DISTINCT equipment_tag) FILTER (registry_id <> '') AS n FROM evidence WHERE source_page < 20 GROUP BY 1) SELECT source_text, n, CASE WHEN n = 0 THEN 'unlinked' WHEN n = 1 THEN 'asset_specific' ELSE 'group_shared' END AS scope FROM k")
def a32(i):
    k = i.evidence.filter("source_page < 20").groupBy("source_text").agg(F.countDistinct(F.when(F.col("registry_id") != "", F.col("equipment_tag"))).alias("n"))
    return k.select("source_text", "n", ev.relationship_scope(F.col("n")).alias("scope"))


COMPARED = """, known AS (SELECT equipment_tag, serial_number, field_name, list_sort(list(DISTINCT regexp_replace(lower(field_value), '[^a-z0-9]', '', 'g'))) AS known FROM evidence GROUP BY 1, 2, 3),
j AS (SELECT r.*, regexp_replace(lower(r.value), '[^a-z0-9]', '', 'g') AS p, coalesce(k.known, []) AS known FROM register r LEFT JOIN known k USING (equipment_tag, serial_number, field_name)),
compared AS (SELECT equipment_tag, serial_number, field_name, value, array_to_string(known, ',') AS known_values, CASE WHEN p = '' AND len(known) = 0 THEN 'no_value' WHEN p <> '' AND list_contains(known, p) THEN 'agrees'
 WHEN field_name = 'set_point' AND p <> '' AND len(list_filter(known, lambda k: contains(k, p) OR suffix(p, k))) > 0 THEN 'normalized_agreement' WHEN p <> '' AND len(known) > 1 THEN 'conflict' WHEN p <> '' AND len(known) > 0 THEN 'semantic_mismatch' WHEN p <> '' THEN 'provisional_only' ELSE 'evidence_only' END AS status FROM j)
"""


@query("p31_register_comparison", "evidence", "register", sql=COMPARED + "SELECT equipment_tag, serial_number, field_name, value, known_values, status, CASE status WHEN 'no_value' THEN 'ignore' WHEN 'agrees' THEN 'retain_provisional' WHEN 'normalized_agreement' THEN 'retain_provisional' WHEN 'conflict' THEN 'review_conflict' WHEN 'semantic_mismatch' THEN 'review_field_mapping' WHEN 'provisional_only' THEN 'retain_with_provenance_review' ELSE 'review_evidence_candidate' END AS action FROM compared")
def p31(i):
    return ev.compare_register(i.register, i.evidence).drop("review_action")


@query("p32_register_review", "evidence", "register", sql=COMPARED + "SELECT equipment_tag, serial_number, field_name, CASE status WHEN 'no_value' THEN 'ignore' WHEN 'agrees' THEN 'accept' WHEN 'normalized_agreement' THEN 'accept' WHEN 'provisional_only' THEN 'accept_provisional_with_provenance' WHEN 'evidence_only' THEN 'review_evidence' ELSE 'use_provisional_flag_evidence' END AS review_action FROM compared")
def p32(i):
    return ev.compare_register(i.register, i.evidence).select("equipment_tag", "serial_number", "field_name", "review_action")


@query("j09_register_evidence_groups", "evidence", "register", sql=COMPARED + "SELECT equipment_tag, field_name, known_values FROM compared")
def j09(i):
    return ev.compare_register(i.register, i.evidence).select("equipment_tag", "field_name", "known_values")


@query("m08_long_evidence", "register_wide", sql=" SELECT equipment_tag, serial_number, field_name, value FROM (UNPIVOT register_wide ON model, equipment_description, range_or_rating, set_point, purchase_order, declaration_reference INTO NAME field_name VALUE value) q WHERE value <> ''")
def m08(i):
    return ev.long_register(i.register_wide, (*FIELDS, "purchase_order", "declaration_reference")).filter("value <> ''")


EVREG = """, r AS (SELECT equipment_tag, field_name, value FROM register), j AS (SELECT e.*, coalesce(r.value, '') AS rv FROM evidence e LEFT JOIN r USING (equipment_tag, field_name)),
c AS (SELECT evidence_id, equipment_tag, field_name, field_value, rv AS register_value, trim(regexp_replace(upper(field_value), '[^A-Z0-9]+', ' ', 'g')) AS a, trim(regexp_replace(upper(rv), '[^A-Z0-9]+', ' ', 'g')) AS b FROM j)
"""


@query("p30_evidence_comparison", "evidence", "register", sql=EVREG + "SELECT evidence_id, equipment_tag, field_name, field_value, register_value, CASE WHEN b = '' THEN 'not_in_provisional' WHEN a = b THEN 'matches_provisional' ELSE 'conflicts_with_provisional' END AS status, CASE WHEN b = '' THEN 'inspect_source' WHEN a = b THEN 'confirm_linkage' ELSE 'resolve_conflict' END AS action FROM c")
def p30(i):
    return ev.compare_evidence(i.evidence, i.register)


@query("j08_last_wins_lookup", "evidence", "register", sql=EVREG + "SELECT evidence_id, field_name, register_value FROM c")
def j08(i):
    return ev.compare_evidence(i.evidence, i.register).select("evidence_id", "field_name", "register_value")


@query("p35_identity_validation", "registry_rows", sql=" SELECT equipment_id, equipment_tag, serial_number, CASE WHEN reason = 'identity fields present' THEN 'valid' ELSE 'review_required' END AS identity_validation_status, reason AS identity_reason FROM (SELECT *, CASE WHEN trim(equipment_tag) = '' THEN 'missing equipment tag' WHEN trim(serial_number) = '' THEN 'missing serial number' WHEN length(regexp_replace(serial_number, '[^0-9]', '', 'g')) < 6 THEN 'serial number has fewer than six digits' WHEN length(regexp_replace(serial_number, '[^0-9]', '', 'g')) <> length(trim(serial_number)) THEN 'serial number contains non-digit characters' WHEN length(trim(serial_number)) = 6 THEN 'six-digit serial may require a leading zero; verify against source' ELSE 'identity fields present' END AS reason FROM registry_rows) q")
def p35(i):
    return ev.identity_checks(i.registry_rows)


@query("p36_registry_status", "evidence", "registry_rows", sql=RANKED + ", f AS (SELECT equipment_id, bool_or(auto_accepted) AS a, bool_or(NOT auto_accepted) AS q FROM decided GROUP BY 1) SELECT r.*, 'extracted' AS registry_status, CASE WHEN coalesce(q, false) THEN 'field_level_review_required' WHEN coalesce(a, false) THEN 'auto_accepted' ELSE '' END AS review_status, CASE WHEN NOT coalesce(q, false) AND coalesce(a, false) THEN 'auto_accepted' ELSE 'review_required' END AS validation_status FROM registry_rows r LEFT JOIN f USING (equipment_id)")
def p36(i):
    return ev.registry_status(i.registry_rows, ev.decide(ev.best_evidence(i.evidence)))


@query("j11_membership_flags", "evidence", "registry_rows", sql=RANKED + " SELECT equipment_id, EXISTS (SELECT 1 FROM decided d WHERE d.equipment_id = r.equipment_id AND d.auto_accepted) AS in_auto, EXISTS (SELECT 1 FROM decided d WHERE d.equipment_id = r.equipment_id AND NOT d.auto_accepted) AS in_queue FROM registry_rows r")
def j11(i):
    d = ev.decide(ev.best_evidence(i.evidence))
    flags = d.groupBy("equipment_id").agg(F.bool_or("auto_accepted").alias("a"), F.bool_or(~F.col("auto_accepted")).alias("q"))
    return i.registry_rows.select("equipment_id").join(flags, "equipment_id", "left").select("equipment_id", F.coalesce("a", F.lit(False)).alias("in_auto"), F.coalesce("q", F.lit(False)).alias("in_queue"))


@query("j10_pivot_register", "evidence", sql=PROMOTED + "SELECT equipment_tag, serial_number, max(field_value) FILTER (field_name = 'model') AS model, max(field_value) FILTER (field_name = 'equipment_description') AS equipment_description, max(field_value) FILTER (field_name = 'range_or_rating') AS range_or_rating, max(field_value) FILTER (field_name = 'set_point') AS set_point FROM promoted WHERE promotion_status = 'eligible' GROUP BY 1, 2")
def j10(i):
    return ev.final_register(ev.promotion(i.evidence).filter("promotion_status = 'eligible'"), FIELDS)


fixture("decisions", "SELECT concat(' ', CAST(p_partkey AS STRING)) AS tag, CASE WHEN p_partkey % 3 = 0 THEN 'accept_equipment_name' ELSE 'no_name_evidence_found' END AS decision, CASE WHEN p_partkey % 6 = 0 THEN ' ' ELSE p_name END AS equipment_name FROM part")


@query("j12_name_decisions", "registry_rows", "decisions", sql=" SELECT r.*, coalesce(d.equipment_name, '') AS equipment_name, CASE WHEN d.tag IS NULL THEN 'unreviewed' ELSE 'reviewed' END AS name_status FROM registry_rows r LEFT JOIN (SELECT * FROM decisions WHERE decision = 'accept_equipment_name' AND trim(equipment_name) <> '') d ON upper(trim(d.tag)) = upper(trim(r.equipment_tag))")
def j12(i):
    return ev.with_decisions(i.registry_rows, i.decisions)


@query("j13_registry_links", "evidence", "registry_rows", sql=" SELECT e.evidence_id, e.equipment_tag, e.serial_number, CASE WHEN p.equipment_tag IS NOT NULL THEN 'matched' WHEN g.equipment_tag IS NOT NULL THEN 'tag_only' ELSE 'unmatched' END AS registry_link FROM evidence e LEFT JOIN (SELECT DISTINCT equipment_tag FROM registry_rows) g ON g.equipment_tag = e.equipment_tag LEFT JOIN (SELECT DISTINCT equipment_tag, serial_number FROM registry_rows) p ON p.equipment_tag = e.equipment_tag AND p.serial_number = e.serial_number")
def j13(i):
    return ev.link_flags(i.evidence.select("evidence_id", "equipment_tag", "serial_number"), i.registry_rows)


@query(
    "j25_shared_reference",
    "register_wide",
    sql=""", refs AS (SELECT equipment_tag, serial_number, 'purchase_order' AS ref_name, purchase_order AS ref FROM register_wide WHERE purchase_order <> '' UNION SELECT equipment_tag, serial_number, 'declaration_reference', declaration_reference FROM register_wide WHERE declaration_reference <> ''),
have AS (SELECT equipment_tag, serial_number, 'model' AS field_name, model AS value FROM register_wide UNION ALL SELECT equipment_tag, serial_number, 'set_point', set_point FROM register_wide),
donors AS (SELECT ref_name, ref, field_name, r.equipment_tag AS donor, min(value) AS lo, max(value) AS hi FROM refs r JOIN have h USING (equipment_tag, serial_number) WHERE value <> '' GROUP BY ALL),
j AS (SELECT r.equipment_tag, r.serial_number, h.field_name, d.donor, d.lo, d.hi FROM refs r JOIN have h ON h.equipment_tag = r.equipment_tag AND h.serial_number = r.serial_number AND h.value = '' JOIN donors d ON d.ref_name = r.ref_name AND d.ref = r.ref AND d.field_name = h.field_name AND d.donor <> r.equipment_tag)
SELECT equipment_tag, serial_number, field_name, min(lo) AS inherited_value, count(DISTINCT donor) AS n_donors FROM j GROUP BY 1, 2, 3 HAVING min(lo) = max(hi)""",
)
def j25(i):
    return ev.inherited(i.register_wide, ("purchase_order", "declaration_reference"), ("model", "set_point"))


@query("j30_page_context", "evidence", sql=", p AS (SELECT source_page, source_text, list_sort(list(DISTINCT equipment_id)) AS ids FROM evidence GROUP BY 1, 2) SELECT e.evidence_id, CASE WHEN e.registry_id <> '' THEN e.registry_id WHEN len(p.ids) <= 2 THEN array_to_string(p.ids, ',') ELSE '' END AS linked FROM evidence e LEFT JOIN p USING (source_page, source_text)")
def j30(i):
    return ev.page_context(i.evidence, ("source_page", "source_text")).select("evidence_id", "linked")


@query("j31_fan_out", "evidence", sql=", l AS (SELECT source_page, field_name, list_sort(list(DISTINCT equipment_id)) AS ids FROM evidence GROUP BY 1, 2) SELECT source_page, field_name, unnest(ids) AS equipment_id FROM l")
def j31(i):
    return ev.fanned_out(i.evidence, ("source_page", "field_name"))


@query("u02_bag_union", "evidence", "register", sql=" SELECT equipment_tag, field_name, field_value AS value FROM evidence UNION ALL SELECT equipment_tag, field_name, value FROM register")
def u02(i):
    a = i.evidence.select("equipment_tag", "field_name", F.col("field_value").alias("value"))
    return a.unionByName(i.register.select("equipment_tag", "field_name", "value"))


@query("u07_dedup_composite", "evidence", sql=" SELECT equipment_tag, field_name, source_page, min(evidence_id) AS evidence_id FROM evidence GROUP BY 1, 2, 3")
def u07(i):
    from pyspark.sql.window import Window

    w = Window.partitionBy("equipment_tag", "field_name", "source_page").orderBy("evidence_id")
    return i.evidence.withColumn("r", F.row_number().over(w)).filter("r = 1").select("equipment_tag", "field_name", "source_page", "evidence_id")


@query("a20_asset_assembly", "evidence", sql=" SELECT equipment_tag, coalesce(string_agg(DISTINCT field_value, ',' ORDER BY field_value) FILTER (field_name = 'model' AND registry_id <> ''), string_agg(DISTINCT field_value, ',' ORDER BY field_value) FILTER (field_name = 'model'), '') AS models, coalesce(string_agg(DISTINCT field_value, ',' ORDER BY field_value) FILTER (field_name = 'set_point'), '') AS set_points, count(DISTINCT source_page) AS n_pages FROM evidence GROUP BY 1")
def a20(i):
    def values(field, extra):
        return F.array_join(F.array_sort(F.collect_set(F.when((F.col("field_name") == field) & extra, F.col("field_value")))), ",")

    g = i.evidence.groupBy("equipment_tag").agg(values("model", F.col("registry_id") != "").alias("own"), values("model", F.lit(True)).alias("any"), values("set_point", F.lit(True)).alias("set_points"), F.countDistinct("source_page").alias("n_pages"))
    return g.select("equipment_tag", F.when(F.col("own") != "", F.col("own")).otherwise(F.col("any")).alias("models"), "set_points", "n_pages")


@query("p28_record_score", "register_wide", sql=" SELECT equipment_tag, score, CASE WHEN score = 7 THEN 'complete' ELSE 'review_required' END AS review_status, missing FROM (SELECT equipment_tag, CAST((model <> '')::INT + (equipment_description <> '')::INT + (range_or_rating <> '')::INT + (set_point <> '')::INT + (serial_number <> '')::INT + (purchase_order <> '')::INT + (declaration_reference <> '')::INT AS INT) AS score, concat_ws(',', CASE WHEN model = '' THEN 'model' END, CASE WHEN equipment_description = '' THEN 'equipment_description' END, CASE WHEN range_or_rating = '' THEN 'range_or_rating' END, CASE WHEN set_point = '' THEN 'set_point' END) AS missing FROM register_wide) q")
def p28(i):
    score, status, missing = ev.record_score()
    return i.register_wide.select("equipment_tag", score.alias("score"), status.alias("review_status"), missing.alias("missing"))


@query("f22_rank_maps", "evidence", sql=" SELECT evidence_tier, CASE evidence_tier WHEN 'tier_1_dense_record_evidence' THEN 4 WHEN 'tier_1_direct_or_linked_row' THEN 4 WHEN 'tier_2_local_shared_block_evidence' THEN 2 ELSE 0 END AS tier_rank, count(*) AS n FROM evidence GROUP BY 1, 2")
def f22(i):
    r = t.rank(F.col("evidence_tier"), ev.Policy().tier_rank)
    return i.evidence.groupBy("evidence_tier", r.alias("tier_rank")).agg(F.count("*").alias("n"))


@query("f23_confidence_format", "evidence", sql=" SELECT evidence_id, CASE WHEN confidence - 0.92::DOUBLE <= 0 THEN '' ELSE printf('%.4f', confidence) END AS confidence_text FROM evidence")
def f23(i):
    return i.evidence.select("evidence_id", ev.confidence_text(F.col("confidence"), 0.92).alias("confidence_text"))

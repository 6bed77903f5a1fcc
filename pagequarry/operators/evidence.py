"""Equipment evidence: registries, promotion, policy decisions, comparisons."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as t
from ..sources.files import written
from .measure import checked_broadcast
from .numbering import ranked

IDENTITY = ("equipment_tag", "serial_number")
METADATA = ("model", "equipment_description", "range_or_rating", "set_point", "declaration_reference", "purchase_order", "test_certificate_reference")
PROVENANCE = ("source_page", "evidence_id", "source_text")
CORE = ("model", "equipment_description", "range_or_rating", "set_point")


@dataclass(frozen=True)
class Policy:
    """What a review policy file says."""

    identity_fields: tuple[str, ...] = ("serial_number",)
    risk_fields: tuple[str, ...] = ("order_acceptance_number",)
    tier_rank: dict[str, int] = field(
        default_factory=lambda: {
            # fixed values
            "tier_1_direct_tag_row": 4,
            "tier_1_direct_or_linked_row": 4,
            "tier_1_dense_record_evidence": 4,
            "tier_2_local_shared_block_evidence": 2,
            "tier_3_shared_page_table_evidence": 1,
        }
    )
    max_values: int = 1
    min_rank: int = 4
    min_confidence: float = 0.95
    high: int = 70
    medium: int = 40


def best_evidence(evidence: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """One row for each equipment and field with the best evidence of its best value.

    Values are equal by case-folded, cleaned text; evidence is ranked by tier, then
    confidence, then selection score. Ties go to the greatest value, then tag, then
    serial number. An equipment id may come with several tags and serial numbers:
    values of these count each, and the best one's are told. What the group rests
    on comes along: pages, evidence ids and source texts of all its rows, each once
    and in order.
    """
    e = evidence.filter((t.clean("equipment_id") != "") & (t.clean("field_name") != "") & (t.clean("field_value") != ""))
    e = e.filter(~F.col("field_name").isin(*policy.identity_fields))
    score = {"rank": t.rank(F.col("evidence_tier"), policy.tier_rank), "confidence": F.coalesce("confidence", F.lit(0.0)), "selection_score": F.coalesce("selection_score", F.lit(0.0))}
    # rows come together once, for values and for fields; they are kept short for that, with ids that are hexadecimal as bytes
    code = F.unhex("evidence_id")
    plain = F.lower(F.hex(code)) == F.col("evidence_id")
    sent = e.select("equipment_id", *IDENTITY, "field_name", "field_value", "source_page", "source_text", F.when(plain, code).alias("_code"), F.when(plain, None).otherwise(F.col("evidence_id")).alias("_id"), *[c.alias(f"_{n}") for n, c in score.items()])
    e = sent.repartition("equipment_id", "field_name").withColumn("evidence_id", F.coalesce(F.lower(F.hex("_code")), "_id"))
    e = e.withColumn("score", F.struct(*[F.col(f"_{n}").alias(n) for n in score])).withColumn("norm_value", t.casefold(t.clean("field_value")))
    lead = e.groupBy("equipment_id", "equipment_tag", "serial_number", "field_name", "norm_value").agg(
        F.max("score").alias("score"),
        F.max_by("field_value", F.struct("score", F.col("evidence_id"))).alias("field_value"),
        F.count("*").alias("n_rows"),
        *[F.collect_set(F.when(t.clean(c) != "", F.col(c))).alias(c) for c in PROVENANCE],
    )
    every = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    groups = lead.groupBy("equipment_id", "field_name").agg(
        F.count("*").alias("n_values"),
        F.sum("n_rows").alias("n_rows"),
        F.max(F.struct("score", "norm_value", "equipment_tag", "serial_number", "field_value")).alias("b"),
        *[every(c).alias(f"{c}s") for c in PROVENANCE],
    )
    return groups.select("equipment_id", "b.equipment_tag", "b.serial_number", "field_name", "n_values", "n_rows", "b.norm_value", "b.field_value", "b.score", *[f"{c}s" for c in PROVENANCE])


def priority(policy: Policy, field_name: Column, n: Column, rank: Column, confidence: Column) -> Column:
    """The review priority score, 0 to 100."""
    score = F.when(field_name.isin(*policy.risk_fields), 25).otherwise(0) + F.when(n > 1, 45).otherwise(0)
    score = score + F.when(rank >= 3, 20).when(rank == 2, 10).otherwise(5)
    score = score + F.when(confidence < 0.85, 25).when(confidence < 0.95, 10).otherwise(0)
    return F.least(score, F.lit(100))


def decide(groups: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """``best_evidence`` groups with priority, band, decision, reason, action, and the pages, evidence ids and source texts they rest on."""
    n, rank, confidence = F.col("n_values"), F.col("score.rank"), F.col("score.confidence")
    score = priority(policy, F.col("field_name"), n, rank, confidence)
    accepted = (n <= policy.max_values) & (rank >= policy.min_rank) & (confidence >= policy.min_confidence)
    reason = (
        F.when(accepted, "meets auto-accept policy")
        .when(n > policy.max_values, "conflicting candidate values")
        .when(rank < policy.min_rank, "evidence tier below auto-accept threshold")
        .otherwise("confidence below auto-accept threshold")
    )
    action = F.when(accepted, "auto_accept").when(n > policy.max_values, "compare_candidates").otherwise("review_source_context")
    rests_on = [F.col(f"{c}s") for c in PROVENANCE if f"{c}s" in groups.columns]
    return groups.select(
        "equipment_id",
        "equipment_tag",
        "serial_number",
        "field_name",
        "n_values",
        "norm_value",
        rank.alias("tier_rank"),
        confidence.alias("confidence"),
        score.alias("priority_score"),
        F.when(score >= policy.high, "high").when(score >= policy.medium, "medium").otherwise("low").alias("priority"),
        accepted.alias("auto_accepted"),
        reason.alias("reason"),
        action.alias("action"),
        *rests_on,
    )


def page_context(evidence: DataFrame, context: tuple[str, ...], most: int = 2) -> DataFrame:
    """``evidence`` with ``linked``: its registry id, or the equipment of its context if that has ``most`` at most.

    ``context`` are the columns that tell what stands together, such as the page. Of a
    context with more equipment no list is made.
    """
    pairs = evidence.select(*context, "equipment_id").distinct()
    few = pairs.groupBy(*context).agg(F.count("*").alias("_n")).filter(F.col("_n") <= most)
    named = pairs.join(few, list(context), "left_semi").groupBy(*context).agg(F.array_join(F.array_sort(F.collect_list("equipment_id")), ",").alias("_ids"))
    own = F.when(F.col("registry_id") != "", F.col("registry_id"))
    return evidence.join(named, list(context), "left").withColumn("linked", F.coalesce(own, "_ids", F.lit(""))).drop("_ids")


def fanned_out(evidence: DataFrame, context: tuple[str, ...]) -> DataFrame:
    """A row for each different equipment of a context."""
    return evidence.select(*context, "equipment_id").distinct()


def summary(decided: DataFrame) -> DataFrame:
    """What is left to review for each equipment."""
    review = ~F.col("auto_accepted")
    out = decided.groupBy("equipment_id", "equipment_tag", "serial_number").agg(
        F.count("*").alias("review_fields"),
        F.count_if(F.col("priority") == "high").alias("high_priority_fields"),
        F.count_if(review).alias("candidate_groups"),
    )
    return out.withColumn("action", F.when(F.col("high_priority_fields") > 0, "review_high_priority_first").otherwise("review_when_available"))


def patterns(evidence: DataFrame) -> DataFrame:
    """Groups of evidence with equal field, value and source text, label-only rows left out."""
    raw, key = ["field_name", "field_value", "source_text"], ["norm_field", "norm_value", "norm_source"]
    f, v, s = (F.col(c) for c in key)

    def normed(rows: DataFrame) -> DataFrame:
        # a generator, so that the norms are made once and not again in the filter
        norms = F.struct(*[t.casefold(t.tidy(c)).alias(n) for n, c in zip(key, raw, strict=True)])
        kept = rows.select(*[c for c in rows.columns if c not in raw], F.inline(F.array(norms)))
        return kept.filter((f != "") & (v != "") & (v != f) & (s != v) & (s != f))

    # by equipment and by page first, so that a frequent text is no single row's list of rows;
    # rows are counted with their pages, where texts that repeat are counted before they are normalised
    equipment = normed(evidence.select(*raw, "equipment_id")).distinct().groupBy(*key).agg(F.count("equipment_id").alias("n_equipment"))
    rows = normed(evidence.groupBy(*raw, "source_page").agg(F.max("confidence").alias("confidence"), F.count("*").alias("n")))
    rows = rows.groupBy(*key, "source_page").agg(F.max("confidence").alias("confidence"), F.sum("n").alias("n"))
    pages = F.array_join(F.array_sort(F.collect_list("source_page")), ",")
    rows = rows.groupBy(*key).agg(F.max("confidence").alias("max_confidence"), F.sum("n").alias("n_rows"), pages.alias("pages"))
    out = equipment.join(rows, key).select(*key, "n_equipment", "max_confidence", "n_rows", "pages")
    action = F.when(F.col("n_equipment") > 1, "review_once_then_propagate").otherwise("review_equipment_specific")
    return out.select(t.short_id("PAT-", f, v, s).alias("pattern_id"), "*", action.alias("action"))


def identity_registry(evidence: DataFrame) -> DataFrame:
    """Different pairs of tag and serial number with their pages and an id by their order."""
    key = F.concat(t.norm_upper("equipment_tag"), F.lit("::"), t.clean("serial_number"))
    # a key is made once for each different pair, not for each row
    pairs = evidence.groupBy("equipment_tag", "serial_number").agg(F.collect_set("source_page").alias("_pages"))
    pages = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_pages")))), ",")
    groups = pairs.groupBy(key.alias("identity_key")).agg(F.min("equipment_tag").alias("equipment_tag"), F.min("serial_number").alias("serial_number"), pages.alias("pages"))
    # written, because ranges are sampled from it before it is dealt out
    found = ranked(written(groups, "identities"), ["identity_key"], place="_place")
    return found.select(F.format_string("EQ-%04d", F.col("_place") + 1).alias("registry_id"), *groups.columns)


def promotion(evidence: DataFrame) -> DataFrame:
    """Each evidence row with ``promotion_status`` and ``promotion_reason``."""
    name, value, tier = F.col("field_name"), F.col("field_value"), F.col("evidence_tier")
    identity = name.isin(*IDENTITY)
    ok = lambda why: F.struct(F.lit("eligible").alias("status"), F.lit(why).alias("reason"))
    no = lambda why: F.struct(F.lit("review").alias("status"), F.lit(why).alias("reason"))
    rule = (
        F.when(t.blank("registry_id"), no("unmatched equipment identity"))
        .when(t.blank(name) | t.blank(value), no("blank field name or value"))
        .when((F.col("_name") == F.col("_value")) | (F.col("_value") == ""), no("value repeats the field name"))
        .when((tier == "tier_1_direct_tag_row") & identity, ok("direct identity row"))
        .when((tier == "tier_1_direct_or_linked_row") & ~identity & F.col("selection_status").isin("selected", "selected_with_review"), ok("selected row"))
        .when((tier == "tier_1_dense_record_evidence") & identity, ok("dense record identity"))
        .when((tier == "tier_1_dense_record_evidence") & name.isin(*METADATA), ok("dense record field"))
        .when((tier == "tier_1_dense_record_evidence") & (name == "order_acceptance_number"), no("derived from declaration-reference suffix"))
        .when(tier == "tier_1_dense_record_evidence", no("unknown field"))
        .otherwise(no("shared, inherited, or review-status evidence"))
    )
    # made once each, not at every place of the rule
    normed = evidence.withColumns({"_name": t.norm_alnum(name), "_value": t.norm_alnum(value)})
    out = normed.withColumn("_p", rule).select("*", F.col("_p.status").alias("promotion_status"), F.col("_p.reason").alias("promotion_reason"))
    return out.drop("_p", "_name", "_value")


def competing(promoted: DataFrame) -> DataFrame:
    """How many eligible values each field of an identity has, and whether they compete."""
    e = promoted.filter("promotion_status = 'eligible'")
    out = e.groupBy("equipment_tag", "serial_number", "field_name").agg(F.countDistinct(t.norm_alnum("field_value")).alias("n_values"))
    return out.withColumn("competing", F.col("n_values") > 1)


def canonical_values(evidence: DataFrame) -> DataFrame:
    """The best value of each tag and field by support, then confidence, then earliest page, then value."""
    v = evidence.groupBy("equipment_tag", "field_name", "field_value").agg(F.count("*").alias("support"), F.max("confidence").alias("confidence"), F.min("source_page").alias("page"))
    order = F.struct("support", "confidence", (-F.col("page")).alias("page"), "field_value")
    return v.groupBy("equipment_tag", "field_name").agg(F.max(order).alias("b"), F.count("*").alias("n_values")).select(
        "equipment_tag", "field_name", F.col("b.field_value").alias("field_value"), F.col("b.support").alias("support"), F.col("b.confidence").alias("confidence"), (-F.col("b.page")).alias("page"), "n_values"
    )


def deduplicated(evidence: DataFrame) -> DataFrame:
    """The most confident row of each field, value, tag and page; ties to the least id."""
    w = Window.partitionBy("field_name", t.norm_alnum("field_value"), "equipment_tag", "source_page").orderBy(F.desc("confidence"), "evidence_id")
    return evidence.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def longest_values(evidence: DataFrame) -> DataFrame:
    """The longest source text of each tag and field; ties to the least text."""
    longest = F.max_by("source_text", F.struct(F.length("source_text"), F.col("source_text")))
    return evidence.groupBy("equipment_tag", "field_name").agg(longest.alias("source_text"))


def merged_records(records: DataFrame) -> DataFrame:
    """Records of one tag and serial with the union of their pages; the earliest page's model stays."""
    return records.groupBy("equipment_tag", "serial_number").agg(
        F.array_join(F.array_sort(F.collect_set("source_page")), ",").alias("linked_pages"),
        F.min_by("field_value", F.struct("source_page", "evidence_id")).alias("first_value"),
        F.count("*").alias("n_rows"),
    )


def page_tags(evidence: DataFrame) -> DataFrame:
    """The tags of each page."""
    return evidence.groupBy("source_page").agg(F.array_join(F.array_sort(F.collect_set("equipment_tag")), ",").alias("tags"), F.countDistinct("equipment_tag").alias("n_tags"))


def relationship_scope(n: Column) -> Column:
    """What evidence with ``n`` linked tags is about."""
    return F.when(n == 0, "unlinked").when(n == 1, "asset_specific").otherwise("group_shared")


def compare_register(register: DataFrame, evidence: DataFrame) -> DataFrame:
    """Each value of a register against the evidence on its tag, serial and field.

    ``register`` has ``equipment_tag, serial_number, field_name, value`` in long form.
    """
    known = evidence.groupBy(t.norm_alnum("equipment_tag").alias("k_tag"), t.norm_alnum("serial_number").alias("k_serial"), F.col("field_name").alias("k_field")).agg(F.array_sort(F.collect_set(t.norm_alnum("field_value"))).alias("known"))
    r = register.select("*", t.norm_alnum("equipment_tag").alias("k_tag"), t.norm_alnum("serial_number").alias("k_serial"), F.col("field_name").alias("k_field"), t.norm_alnum("value").alias("norm"))
    j = r.join(known, ["k_tag", "k_serial", "k_field"], "left").withColumn("known", F.filter(F.coalesce("known", F.array().cast("array<string>")), lambda x: x != ""))
    n, p = F.size("known"), F.col("norm")
    matched = F.array_contains("known", p)
    contained = F.exists("known", lambda k: F.contains(k, p) | F.endswith(p, k))
    status = (
        F.when((p == "") & (n == 0), "no_value")
        .when((p != "") & matched, "agrees")
        .when((F.col("field_name") == "set_point") & (p != "") & contained, "normalized_agreement")
        .when((p != "") & (n > 1), "conflict")
        .when((p != "") & (n > 0), "semantic_mismatch")
        .when(p != "", "provisional_only")
        .otherwise("evidence_only")
    )
    action = F.create_map(*[F.lit(x) for x in (
        "no_value", "ignore", "agrees", "retain_provisional", "normalized_agreement", "retain_provisional", "conflict", "review_conflict",
        "semantic_mismatch", "review_field_mapping", "provisional_only", "retain_with_provenance_review", "evidence_only", "review_evidence_candidate",
    )])
    review = F.when(status == "no_value", "ignore").when(status == "agrees", "accept").when(status == "normalized_agreement", "accept").when(status == "provisional_only", "accept_provisional_with_provenance").when(status == "evidence_only", "review_evidence").otherwise("use_provisional_flag_evidence")
    return j.select("equipment_tag", "serial_number", "field_name", "value", F.array_join("known", ",").alias("known_values"), status.alias("status"), action[status].alias("action"), review.alias("review_action"))


def long_register(wide: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """A register in long form: one row for each tag and field."""
    return wide.unpivot(["equipment_tag", "serial_number"], list(fields), "field_name", "value")


def compare_evidence(evidence: DataFrame, register: DataFrame) -> DataFrame:
    """Each evidence row against the last register row of its tag: match, difference or absence."""
    w = Window.partitionBy("r_tag", "field_name").orderBy(F.desc("serial_number"))
    last = register.select(t.norm_words("equipment_tag").alias("r_tag"), "serial_number", "field_name", F.col("value").alias("reg_value")).withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("r_tag", "field_name", "reg_value")
    j = evidence.withColumn("r_tag", t.norm_words("equipment_tag")).join(last, ["r_tag", "field_name"], "left")
    a, b = t.norm_words("field_value"), t.norm_words("reg_value")
    status = F.when(b == "", "not_in_provisional").when(a == b, "matches_provisional").otherwise("conflicts_with_provisional")
    return j.select("evidence_id", "equipment_tag", "field_name", "field_value", t.text("reg_value").alias("register_value"), status.alias("status"), F.when(status == "matches_provisional", "confirm_linkage").when(status == "not_in_provisional", "inspect_source").otherwise("resolve_conflict").alias("action"))


def identity_checks(registry: DataFrame) -> DataFrame:
    """``identity_validation_status`` and the reason for each registry row."""
    tag, serial = t.clean("equipment_tag"), t.clean("serial_number")
    digits = F.length(F.regexp_replace(serial, r"\D", ""))
    reason = (
        F.when(tag == "", "missing equipment tag")
        .when(serial == "", "missing serial number")
        .when(digits < 6, "serial number has fewer than six digits")
        .when(digits != F.length(serial), "serial number contains non-digit characters")
        .when(digits == 6, "six-digit serial may require a leading zero; verify against source")
        .otherwise("identity fields present")
    )
    return registry.select("*", F.when(reason == "identity fields present", "valid").otherwise("review_required").alias("identity_validation_status"), reason.alias("identity_reason"))


def registry_status(registry: DataFrame, decided: DataFrame) -> DataFrame:
    """Whether each registry row has fields in review, accepted ones, both or none."""
    flags = decided.groupBy("equipment_id").agg(F.bool_or("auto_accepted").alias("has_auto"), F.bool_or(~F.col("auto_accepted")).alias("has_queue"))
    j = registry.join(flags, "equipment_id", "left")
    q, a = F.coalesce("has_queue", F.lit(False)), F.coalesce("has_auto", F.lit(False))
    review = F.when(q, "field_level_review_required").when(a, "auto_accepted").otherwise("")
    return j.select(*registry.columns, F.lit("extracted").alias("registry_status"), review.alias("review_status"), F.when(~q & a, "auto_accepted").otherwise("review_required").alias("validation_status"))


def final_register(resolved: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """One row for each tag and serial with a column for each field, the greatest value of each."""
    return resolved.groupBy("equipment_tag", "serial_number").pivot("field_name", list(fields)).agg(F.max("field_value"))


def with_decisions(registry: DataFrame, decisions: DataFrame) -> DataFrame:
    """Registry rows with reviewers' names of accepted decisions."""
    d = decisions.filter("decision = 'accept_equipment_name' and trim(equipment_name) <> ''").select(F.upper(F.btrim("tag")).alias("d_tag"), "equipment_name")
    j = registry.join(d, F.upper(F.btrim("equipment_tag")) == F.col("d_tag"), "left")
    return j.select(*registry.columns, t.text("equipment_name").alias("equipment_name"), F.when(F.col("equipment_name").isNull(), "unreviewed").otherwise("reviewed").alias("name_status"))


def link_flags(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Whether each row's tag, and its tag with serial, are in the registry."""
    tags = registry.select(t.norm_alnum("equipment_tag").alias("kt")).distinct()
    pairs = registry.select(t.norm_alnum("equipment_tag").alias("pt"), t.norm_alnum("serial_number").alias("ps")).distinct()
    r = rows.select("*", t.norm_alnum("equipment_tag").alias("nt"), t.norm_alnum("serial_number").alias("ns"))
    j = r.join(tags, F.col("nt") == F.col("kt"), "left").join(pairs, (F.col("nt") == F.col("pt")) & (F.col("ns") == F.col("ps")), "left")
    status = F.when(F.col("pt").isNotNull(), "matched").when(F.col("kt").isNotNull(), "tag_only").otherwise("unmatched")
    return j.select(*rows.columns, status.alias("registry_link"))


def inherited(records: DataFrame, references: tuple[str, ...], fields: tuple[str, ...]) -> DataFrame:
    """Values that a record lacks and that records sharing a reference agree on.

    Keyed by tag and serial; a value is inherited only if the sharing records of
    other tags have exactly one. Records and donors of a reference are not paired:
    for each reference and field, the number of tags and the extreme values, with
    and without one tag, tell what there is besides the record's own tag. Tags that
    two references share are counted once for these two; only for records with more
    references are the tags of each different set of references counted out.
    """
    key, group = ["equipment_tag", "serial_number"], ["ref_name", "ref", "field_name"]
    refs = records.unpivot(key, list(references), "ref_name", "ref").filter("ref <> ''").distinct()
    have = records.unpivot(key, list(fields), "field_name", "value")
    donors = refs.join(have.filter("value <> ''"), key).groupBy(*group, F.col("equipment_tag").alias("donor")).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    donors = written(donors, "donors")
    ends = written(donors.groupBy(*group).agg(F.count("*").alias("n"), F.min(F.struct("lo", "donor")).alias("l"), F.max(F.struct("hi", "donor")).alias("h")), "ends")
    without = donors.join(checked_broadcast(ends), group).groupBy(*group).agg(F.min(F.when(F.col("donor") != F.col("l.donor"), F.col("lo"))).alias("lo2"), F.max(F.when(F.col("donor") != F.col("h.donor"), F.col("hi"))).alias("hi2"))
    told = written(ends.join(without, group), "told")
    lack = refs.join(have.filter("value = ''").select(*key, "field_name").distinct(), key)
    own = donors.select(*group, F.col("donor").alias("equipment_tag"), F.lit(1).alias("own"))
    j = lack.join(checked_broadcast(told), group).join(own, [*group, "equipment_tag"], "left").withColumn("own", F.coalesce("own", F.lit(0)))
    end = lambda c, first, second: F.when(F.col(f"{c}.donor") == F.col("equipment_tag"), F.col(second)).otherwise(F.col(f"{c}.{first}"))
    one = j.select(*key, "field_name", F.struct("ref_name", "ref").alias("r"), end("l", "lo", "lo2").alias("lo"), end("h", "hi", "hi2").alias("hi"), (F.col("n") - F.col("own")).alias("n"), "own").filter("n > 0")
    sums = [F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"), F.min("own").alias("all_own"), F.max("own").alias("any_own"), F.array_sort(F.collect_list("r")).alias("rs")]
    agreed = one.groupBy(*key, "field_name").agg(*sums).filter("lo = hi")
    told_one = agreed.filter("size(rs) = 1").select(*key, "field_name", "lo", F.col("n").alias("n_donors"))
    # two references: tags that both have were counted twice, but for the own tag
    at = lambda c: donors.select("field_name", "donor", F.struct("ref_name", "ref").alias(c))
    shared = at("a").join(at("b"), ["field_name", "donor"]).filter("a < b").groupBy("field_name", F.array("a", "b").alias("rs")).agg(F.count("*").alias("both"))
    two = agreed.filter("size(rs) = 2").join(checked_broadcast(written(shared, "shared")), ["field_name", "rs"], "left")
    told_two = two.select(*key, "field_name", "lo", (F.col("n") - F.coalesce("both", F.lit(0)) + F.col("all_own")).alias("n_donors"))
    many = agreed.filter("size(rs) > 2")
    sets = many.select("field_name", "rs").distinct().select("field_name", "rs", F.explode("rs").alias("r"))
    counted = sets.join(at("r"), ["field_name", "r"]).groupBy("field_name", "rs").agg(F.countDistinct("donor").alias("every"))
    told_many = many.join(counted, ["field_name", "rs"]).select(*key, "field_name", "lo", (F.col("every") - F.col("any_own")).alias("n_donors"))
    return told_one.unionByName(told_two).unionByName(told_many).withColumnRenamed("lo", "inherited_value")


#: Fields of a record, which all count for its score; the first ones are named where they are missing.
RECORD_FIELDS = (*CORE, "serial_number", "purchase_order", "declaration_reference")


def record_score(fields: tuple[str, ...] = RECORD_FIELDS, core: tuple[str, ...] = CORE) -> tuple[Column, Column, Column]:
    """How many fields of a record are filled, its review status, and which core fields are missing."""
    score = sum((F.col(c) != "").cast("int") for c in fields)
    missing = F.concat_ws(",", *[F.when(F.col(c) == "", c) for c in core])
    return score, F.when(score == len(fields), "complete").otherwise("review_required"), missing


def confidence_text(confidence: Column, least: float = 0.0) -> Column:
    """A confidence to four places; nothing for what is not above ``least``."""
    return F.when(confidence - least <= 0, "").otherwise(F.format_string("%.4f", confidence))

"""A Merkle manifest of a dataset: a root for all rows, and a proof for each.

Leaves of a group are dealt into blocks of ``ARITY ** LEVELS`` consecutive ones. A
block is one row with an ordered array; its levels are collapsed by higher-order
functions (``sequence``, ``transform``, ``slice``, ``aggregate``), and the roots of
blocks are the nodes of the next round, until each group has one. The roots of
groups are collapsed the same way. Going down again, each block passes the
siblings above it to its members, so that a proof needs no second look at leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import ranked
from .common import crc32_sql, stage_table, width

ARITY = 2
#: Levels that are collapsed in one row.
LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER = 7
_STEP = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts together."""
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """``-`` for a null, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return digest(*map(encoded, values))


def _collapsed(nodes: Column, levels: Column, arity: int, most: int) -> Column:
    """All levels over an ordered array of nodes, the nodes first."""

    def above(level: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / arity).cast("int"))
        return F.transform(runs, lambda j: F.sha2(F.array_join(F.slice(level, j * arity + 1, arity), ""), 256))

    steps = F.slice(F.sequence(F.lit(1), F.lit(most)), F.lit(1), levels)
    start = F.array(nodes).cast("array<array<string>>")
    return F.aggregate(steps, start, lambda done, _: F.concat(done, F.array(above(F.element_at(done, -1)))).cast("array<array<string>>"))


def _steps(levels: Column, place: Column, arity: int, most: int) -> Column:
    """The siblings left and right of a block's node, level by level; the last level has none."""

    def siblings(k: Column) -> Column:
        level = F.element_at(levels, k + 1)
        i = F.floor(place / F.pow(F.lit(float(arity)), k)).cast("int")
        first = (i - i % arity).cast("int")
        left = F.array_join(F.slice(level, first + 1, i - first), "")
        right = F.array_join(F.slice(level, i + 2, F.lit(arity - 1) - (i - first)), "")
        return F.struct(left.alias("before"), right.alias("after"))

    return F.transform(F.slice(F.sequence(F.lit(0), F.lit(most)), F.lit(1), F.size(levels) - 1), siblings).cast(_STEP)


def _blocks(nodes: DataFrame, carried: list[str], arity: int, levels: int) -> DataFrame:
    """``grp, size, block, rows, levels`` from ``grp, size, pos, node`` and carried columns; ``size`` counts the group's nodes."""
    wide = arity**levels
    rows = F.array_sort(F.collect_list(F.struct("pos", "node", *carried)))
    # a group within one block needs only the levels that leave one node
    need = sum([(F.col("size") > arity**k).cast("int") for k in range(levels)], F.lit(0))
    block = F.floor(F.col("pos") / wide).cast("long").alias("block")
    got = nodes.groupBy("grp", "size", block).agg(rows.alias("rows"))
    return got.withColumn("levels", _collapsed(F.col("rows.node"), need.cast("int"), arity, levels))


def _climbed(nodes: DataFrame, carried: list[str], arity: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The written blocks of all rounds, and ``grp, node``: what remains of each group."""
    wide, rounds = arity**levels, []
    most = nodes.agg(F.max("size")).first()[0] or 0
    while True:
        rounds.append(stage_table(_blocks(nodes, [] if rounds else carried, arity, levels), "blocks"))
        root = F.element_at(F.element_at("levels", -1), 1).alias("node")
        size = F.ceil(F.col("size") / wide).cast("long").alias("size")
        nodes = rounds[-1].select("grp", size, F.col("block").alias("pos"), root)
        most = -(-most // wide)
        if most <= 1:
            return rounds, nodes.select("grp", "node")


def _members(names: list[str], arity: int, levels: int) -> Column:
    """The rows of a block, each with the siblings in the block and those above it."""

    def member(row: Column, i: Column) -> Column:
        path = F.concat(_steps(F.col("levels"), i, arity, levels), F.col("path"))
        return F.struct(*[row[n].alias(n) for n in names], path.alias("path"))

    return F.transform("rows", member)


def _descended(rounds: list[DataFrame], tops: DataFrame, carried: list[str], arity: int, levels: int) -> DataFrame:
    """``grp, pos, node, path``, carried columns and those of ``tops`` for each node of the first round.

    ``tops`` has ``grp, path`` and more: what is above each group.
    """
    more = [c for c in tops.columns if c not in ("grp", "path")]
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for k in range(len(rounds) - 1, -1, -1):
        names = ["pos", "node", *(carried if k == 0 else [])]
        joined = rounds[k].join(above, ["grp", "block"])
        above = joined.select("grp", *more, F.inline(_members(names, arity, levels)))
        if k:
            above = above.withColumnRenamed("pos", "block").drop("node")
    return above


def folded(path: Column, node: Column) -> Column:
    """The root that a node and its siblings give."""
    return F.aggregate(path, node, lambda h, s: digest(s["before"], h, s["after"]))


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id", tampered: dict[str, Column] | None = None, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """``<key>, <group>, leaf, subroot, root, path, proof_sha256, folded_root, verified`` for each row of ``docs``.

    A leaf is the digest of a row's ``fields``. Leaves of one ``group`` value, in
    the order of ``key``, make a tree with ``arity`` children to a node, where the
    last node of a level may have fewer; the roots of the groups, in the order of
    their values, make the tree of the root. ``path`` are a leaf's siblings, level
    by level, and ``folded_root`` is what they make of the leaf of the row as it
    is now: ``tampered`` replaces fields by other values. Nulls are values of
    their own and come first, as keys too; rows of equal keys are ordered by their
    leaves, so repeated rows are several leaves with a proof each. Other columns are
    ignored; an empty table gives none.
    """
    changed = {f: F.col(f) for f in fields} | (tampered or {})
    now = leaf([changed[f] for f in fields]) if tampered else F.lit(None).cast("string")
    different = F.lit(False)
    for f, c in (tampered or {}).items():
        different |= ~F.col(f).cast("string").eqNullSafe(c.cast("string"))
    # an encoded group, in which no value equals a null
    grp = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    rows = docs.select(F.col(key).alias("key"), grp.alias("grp"), leaf([F.col(f) for f in fields]).alias("node"), F.when(different, now).alias("now"), F.monotonically_increasing_id().alias("salt"))
    rows = stage_table(rows, "leaves")
    sizes = rows.groupBy("grp").agg(F.count("*").alias("size"))
    placed = ranked(rows, ["key", "node", "salt"], ["grp"], "pos", width(rows)).join(stage_table(sizes, "sizes"), "grp")
    rounds, tops = _climbed(placed, ["key", "now"], arity, levels)
    named = ranked(tops.withColumnRenamed("grp", "lead"), ["lead"], [], "pos").withColumn("grp", F.lit(""))
    named = named.withColumn("size", F.lit(named.count()).cast("long"))
    upper, last = _climbed(named, ["lead"], arity, levels)
    found = last.first()
    root = F.lit(found["node"] if found else None).cast("string")
    start = last.select("grp", F.array().cast(_STEP).alias("path"))
    above = _descended(upper, start, ["lead"], arity, levels).select(F.col("lead").alias("grp"), F.col("node").alias("subroot"), "path")
    proofs = _descended(rounds, stage_table(above, "above"), ["key", "now"], arity, levels)
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), ""), 256)
    out = proofs.select(
        F.col("key").alias(key),
        F.when(F.col("grp") != "", F.substr("grp", F.lit(2))).alias(group),
        F.col("node").alias("leaf"),
        "subroot",
        root.alias("root"),
        "path",
        proof.alias("proof_sha256"),
        folded(F.col("path"), F.coalesce("now", "node")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered_counts(every: int = TAMPER) -> dict[str, Column]:
    """The counts of characters of every so many-th document, by the checksum of its id, one too high."""
    one = F.col("n_chars").cast("decimal(20,0)") + 1
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return {"n_chars": F.when(hit, one).otherwise(F.col("n_chars").cast("decimal(20,0)"))}


def digests(proofs: DataFrame) -> DataFrame:
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _encoded_sql(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR, '-')"


def _leaf_sql(n_chars: str) -> str:
    return f"sha256({' || '.join(_encoded_sql(n_chars if f == 'n_chars' else f) for f in FIELDS)})"


ORACLE_SQL = f"""
WITH RECURSIVE
rows AS (SELECT *, {crc32_sql("list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)")} % {TAMPER} = 0 AS hit FROM documents),
leaves AS (SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf, {_leaf_sql("CASE WHEN hit THEN n_chars::HUGEINT + 1 ELSE n_chars END")} AS changed FROM rows),
placed AS (SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS size FROM leaves),
tree AS (
    SELECT lang, 0 AS lvl, pos, leaf AS h, size FROM placed
    UNION ALL
    SELECT lang, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(size) + 1) // 2 FROM tree WHERE size > 1 GROUP BY lang, lvl, pos // 2
),
subroots AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS size FROM tree WHERE size = 1),
top AS (
    SELECT 0 AS lvl, pos, subroot AS h, size FROM subroots
    UNION ALL
    SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(size) + 1) // 2 FROM top WHERE size > 1 GROUP BY lvl, pos // 2
),
steps AS (
    SELECT p.r, l.lvl, p.pos >> l.lvl & 1 AS odd, t.h
    FROM placed p JOIN (SELECT DISTINCT lang, lvl FROM tree WHERE size > 1) l ON p.lang IS NOT DISTINCT FROM l.lang
    LEFT JOIN tree t ON t.lang IS NOT DISTINCT FROM p.lang AND t.lvl = l.lvl AND t.pos = xor(p.pos >> l.lvl, 1)
    UNION ALL
    SELECT p.r, 1000 + l.lvl, s.pos >> l.lvl & 1, t.h
    FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
    JOIN (SELECT DISTINCT lvl FROM top WHERE size > 1) l ON true
    LEFT JOIN top t ON t.lvl = l.lvl AND t.pos = xor(s.pos >> l.lvl, 1)
),
paths AS (
    SELECT r, string_agg(coalesce(h, ''), '' ORDER BY lvl) AS siblings,
           list(CASE WHEN h IS NULL THEN '|' WHEN odd = 1 THEN h || '|' ELSE '|' || h END ORDER BY lvl) AS path
    FROM steps GROUP BY r
),
found AS (
    SELECT doc_id, leaf, subroot, (SELECT h FROM top WHERE size = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
           list_reduce(list_prepend(changed, coalesce(path, [])), lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root
    FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang LEFT JOIN paths USING (r)
)
SELECT *, folded_root = root AS verified FROM found
"""

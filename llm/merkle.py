"""A Merkle manifest of a table of documents, with an inclusion proof for every row.

Rows are leaves of one binary tree per language, and the trees' roots are leaves of one more.
A leaf's rank splits into a block number and binary digits. Inside a block, at most 2**DIGITS
nodes, the digit columns are grouped away one after the other, each time nesting the child
structs in their parent. Blocks are the leaves of the next round, so no struct outgrows a block.
Proofs come from the nested structs by a transform and an explode; what a block has above it
meets the block in an aggregation, without a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from llm.tables import shuffle_partitions, store

DIGITS = 10
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "array<struct<left:string,right:string>>"
_TOP = "struct<subroot:string,root:string>"


def leaf(*values: Column) -> Column:
    """The digest of a row: each value as `-` if null, else as its UTF-8 byte count, `:` and itself."""
    texts = [v.cast("string") for v in values]
    told = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*told), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """One digest of a proof's siblings, leaf to root and left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows (key, ...) with pos, their rank by ``order`` among the rows of their key from 0, and n, how many there are.

    Nulls stand first. Rows are counted in ranges of (key, order, salt), so that a hot key, or one
    row repeated for a third of the table, is dealt over many tasks; rows that tie stand in any order.
    """
    parts = shuffle_partitions(rows.sparkSession)
    salted = store(rows.withColumn("salt", F.monotonically_increasing_id()), "leaves")
    dealt = salted.repartitionByRange(parts, "key", *order, "salt").withColumn("part", F.spark_partition_id())
    dealt = store(dealt, "ranges")
    every = Window.partitionBy("key")
    before = every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = dealt.groupBy("key", "part").agg(F.count("*").alias("rows")).select(
        F.col("key").alias("of"), F.col("part").alias("in"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shift"), F.sum("rows").over(every).alias("n"),
    )
    own = F.row_number().over(Window.partitionBy("key", "part").orderBy(*order, "salt")) - 1
    return (
        dealt.withColumn("own", own)
        .join(shifts, F.col("key").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")))
        .select("key", *(c for c in rows.columns if c != "key"), (F.col("shift") + F.col("own")).alias("pos"), "n")
    )


def _blocks(nodes: DataFrame, base: int) -> DataFrame:
    """Nodes (key, n, pos, node) of a level rolled up into (key, n, block, node), one row per block."""
    names = [f"d{i}" for i in range(DIGITS)]
    digits = [F.shiftright("pos", i).bitwiseAND(F.lit(1)).cast("tinyint").alias(d) for i, d in enumerate(names)]
    rows = nodes.select("key", "n", F.shiftright("pos", DIGITS).alias("block"), *digits, "node")
    rows = rows.repartition(shuffle_partitions(nodes.sparkSession), "key", "block")
    for i, digit in enumerate(names):
        kids = F.sort_array(F.collect_list(F.struct(digit, F.col("node.h"), F.col("node.kids"))))
        joined = F.array_join(F.transform("kids", lambda kid: kid["h"]), "")
        up = F.when(F.col("n") > F.lit(1 << (base + i)), F.sha2(joined, 256)).otherwise(F.get("kids", F.lit(0))["h"])
        rows = rows.groupBy("key", "n", "block", *names[i + 1 :]).agg(kids.alias("kids")).withColumn("node", F.struct(up.alias("h"), "kids"))
        rows = rows.drop("kids")
    return rows


def _leaves(node: Column, digit: int, base: int, path: Column) -> Column:
    """The leaves below a nested node as (item, pos, path), where path starts at the leaf."""
    kids = node["kids"]
    used = F.col("n") > F.lit(1 << (base + digit))

    def below(kid: Column) -> Column:
        left = F.when(kid[f"d{digit}"] == 1, F.get(kids, F.lit(0))["h"]).otherwise(F.lit(""))
        right = F.when(kid[f"d{digit}"] == 0, F.coalesce(F.get(kids, F.lit(1))["h"], F.lit(""))).otherwise(F.lit(""))
        step = F.when(used, F.array(F.struct(left.alias("left"), right.alias("right")))).otherwise(F.array().cast(_STEP))
        longer = F.concat(step, path)
        if digit:
            return _leaves(kid, digit - 1, base, longer)
        return F.array(F.struct(kid["kids"].alias("item"), longer.alias("path")))

    return F.flatten(F.transform(kids, below))


def _rounds(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Written blocks of each round from the leaves up; the last round has one block per key."""
    rounds, base = [], 0
    while not rounds or most > 1 << base:
        rounds.append(store(_blocks(nodes, base), "blocks"))
        base += DIGITS
        nodes = rounds[-1].select(
            "key", "n", F.col("block").alias("pos"), F.struct(F.col("node.h"), F.col("block").alias("kids")).alias("node")
        )
    return rounds


def _opened(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """(key, item, path, top) of every leaf, given (key, path, top) of each key's root."""
    above = above.withColumn("block", F.lit(0).cast("long"))
    for k in reversed(range(len(rounds))):
        blocks, seen = rounds[k], F.lit(None)
        first = lambda c: F.first(c, ignorenulls=True).alias(c)
        met = (
            blocks.select("key", "block", "n", "node", seen.cast(_STEP).alias("path"), seen.cast(_TOP).alias("top"))
            .unionByName(above.select("key", "block", "path", "top"), allowMissingColumns=True)
            .groupBy("key", "block")
            .agg(*map(first, ("n", "node", "path", "top")))
        )
        leaves = _leaves(F.col("node"), DIGITS - 1, k * DIGITS, F.array().cast(_STEP))
        out = met.select("key", "top", F.col("path").alias("higher"), F.explode(leaves).alias("leaf"))
        out = out.select("key", "top", F.col("leaf.item").alias("item"), F.concat("leaf.path", "higher").alias("path"))
        above = out if not k else out.withColumn("block", F.col("item"))
    return above


def proofs(leaves: DataFrame) -> DataFrame:
    """Roots and proofs of leaves (key, h, item): (key, item, path, top.subroot, top.root) for every leaf.

    A key's leaves stand in the order of ``item``, then of ``h``. ``item`` comes back unchanged.
    """
    def most(ranks: DataFrame) -> int:
        return ranks.agg(F.max("n")).first()[0] or 1

    def nodes(rows: DataFrame) -> DataFrame:
        return rows.select("key", "n", "pos", F.struct("h", F.col("item").alias("kids")).alias("node"))

    own = store(ranked(leaves, ["item", "h"]), "ranked")
    rounds = _rounds(nodes(own), most(own))
    roots = rounds[-1].select(F.lit(0).alias("key"), F.col("node.h").alias("h"), F.struct(F.col("key").alias("lang"), F.col("node.h").alias("subroot")).alias("item"))
    tops = store(ranked(roots, ["item"]), "roots")
    top_rounds = _rounds(nodes(tops), most(tops))
    none, root = F.array().cast(_STEP), F.struct(F.lit("").alias("subroot"), F.col("node.h").alias("root"))
    whole = _opened(top_rounds, top_rounds[-1].select("key", none.alias("path"), root.alias("top")))
    above = whole.select(
        F.col("item.lang").alias("key"), "path", F.struct(F.col("item.subroot"), F.col("top.root")).alias("top")
    )
    return _opened(rounds, above)


def manifest(docs: DataFrame, tampered: dict[str, Column] | None = None) -> DataFrame:
    """Every row's doc_id, leaf, changed_leaf, subroot, root and proof (``path``: left and right siblings).

    Leaves cover doc_id, source, lang, n_chars and text; other columns are not read, whatever their
    names. ``changed_leaf`` is the leaf with the columns of ``tampered`` in their place, else the
    leaf. Nulls are values of their own: a null doc_id stands before all others, a null language is
    a language. Repeated rows are leaves of their own, whose order doesn't matter. An empty text is
    not a null one. A table without rows has no proofs.
    """
    docs = docs.select(*COLUMNS)
    given = [F.col(c) for c in COLUMNS]
    changed = [(tampered or {}).get(c, F.col(c)) for c in COLUMNS]
    differs = F.lit(False)
    for c in tampered or {}:
        differs = differs | ~tampered[c].eqNullSafe(F.col(c))
    leaves = docs.select(
        F.col("lang").cast("string").alias("key"),
        leaf(*given).alias("h"),
        F.when(differs, leaf(*changed)).alias("changed"),
        F.col("doc_id").cast("long").alias("doc_id"),
    )
    rows = proofs(leaves.select("key", "h", F.struct("doc_id", "h", "changed").alias("item")))
    return rows.select(
        F.col("item.doc_id"), F.col("item.h").alias("leaf"), F.coalesce("item.changed", "item.h").alias("changed_leaf"),
        "top.subroot", "top.root", "path",
    )


def checked(proved: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root (from changed_leaf) and verified of a manifest."""
    return (
        proved.withColumn("folded_root", folded(F.col("changed_leaf"), F.col("path")))
        .select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root")
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )


def planted_tampering() -> dict[str, Column]:
    """One added to n_chars of the rows whose id's checksum 7 divides."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}


_ENCODED = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')"
SQL = f"""
with recursive
table_of as materialized (
    select list_transform(range(256), lambda i: list_reduce([i] || range(8),
               lambda c, turn: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc),
sums as (
    select d.*, xor(list_reduce([4294967295] || list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
               lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) as checksum
    from documents d, table_of),
leaves as materialized (
    select doc_id, coalesce('.' || lang, '') as key, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
           leaf, case when checksum % 7 = 0 and n_chars is not null then changed else leaf end as start
    from (select *, sha256({" || ".join(_ENCODED.format(c) for c in COLUMNS)}) as leaf,
                 sha256({" || ".join(_ENCODED.format("(n_chars + 1)" if c == "n_chars" else c) for c in COLUMNS)}) as changed
          from sums)),
climb as (
    select key, 0 as depth, list(leaf order by pos) as nodes from leaves group by key
    union all
    select key, depth + 1, list_transform(range((len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
    from climb where len(nodes) > 1),
subroots as materialized (
    select key, nodes[1] as subroot, row_number() over (order by key) - 1 as pos from climb where len(nodes) = 1),
top as (
    select 0 as depth, list(subroot order by pos) as nodes from subroots
    union all
    select depth + 1, list_transform(range((len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))
    from top where len(nodes) > 1),
levels as materialized (
    select key, false as upper, depth, nodes from climb where len(nodes) > 1
    union all
    select '', true, depth, nodes from top where len(nodes) > 1),
nodes as materialized (
    select key, upper, depth, unnest(nodes) as h, generate_subscripts(nodes, 1) - 1 as pos from levels),
starts as materialized (
    select row_number() over () as id, l.*, s.subroot, s.pos as lang_pos from leaves l join subroots s using (key)),
steps as (
    select s.id, v.upper, v.depth, case when v.upper then s.lang_pos else s.pos end >> v.depth as place
    from starts s join levels v on v.upper or v.key = s.key),
siblings as (
    select p.id, list(case when place & 1 = 1 then 'L' else 'R' end || coalesce(n.h, '') order by p.upper, p.depth) as path
    from steps p join starts s using (id)
    left join nodes n on n.upper = p.upper and n.depth = p.depth and n.key = case when p.upper then '' else s.key end and n.pos = xor(place, 1)
    group by p.id),
folds as (
    select s.*, (select nodes[1] from top where len(nodes) = 1) as root, coalesce(path, []) as path
    from starts s left join siblings using (id))
select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) as proof_sha256,
       list_reduce([start] || path, lambda node, s: sha256(case when s[1] = 'L' then s[2:] || node else node || s[2:] end)) as folded_root,
       folded_root = root as verified
from folds
"""

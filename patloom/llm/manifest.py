"""Merkle manifest of a table: a hash tree per group of rows, one over the groups, and a proof for every row.

A leaf is the hash of a row's columns. In each group the leaves are ranked in order of the key, and the binary digits
of the rank, four to a column, are grouped away one column after the other: rows that agree in the rest of
their digits become an array of child structs, with the hashes of the tree's levels over them. After three columns a
row holds a block of 4,096 leaves. The roots of the blocks are ranked by their block numbers and rolled up in
the same way, until every group has one. On the way back each block takes the steps that lead from its own root to
the top; `transform` over the nested structs adds those inside, and `explode` gives a row per leaf. A block meets the
steps above it by grouping, so no proof needs a join.

A step is what stands left and right of a hash when it is hashed into its parent: a sibling on one side, or nothing
on both where a run has one node.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patloom.llm.registry import query, table, written

DIGIT = 4  # bits of the rank in a column
DIGITS = 3  # columns of a block
BLOCK = 1 << DIGIT * DIGITS  # leaves
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def hashed(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as its length in UTF-8 bytes, a colon and itself; null as a hyphen."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    """The leaf of a row: the hash of its values as fields."""
    return hashed(*(field(value) for value in values))


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its steps lead to."""
    return F.aggregate(steps, leaf, lambda node, step: hashed(step["left"], node, step["right"]))


def proof_digest(steps: Column) -> Column:
    """One hash of all siblings on the way up."""
    return F.sha2(F.array_join(F.transform(steps, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _ranked(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add the rank of each row in its `group` (from 0) and the group's size `n`.

    Rows are sorted by ranges of group and order, so one group fills as many tasks as it needs; a row's place
    in its task and the rows of its group in the tasks before give its rank. Rows that agree in all of `order`
    are told apart by their place in the table, so that they too are split.
    """
    by = ["group", *order, "place"]
    placed = nodes.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("place")
    placed = written(placed.withColumn("at", F.monotonically_increasing_id()), "placed")
    task = F.shiftright("at", 33)  # the high bits are the task's number
    counts = placed.groupBy("group", task.alias("task")).agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    before = W.partitionBy("group").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        F.col("group").alias("of"),
        "task",
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(W.partitionBy("group")).alias("n"),
    )
    starts = written(starts, "starts")  # a row per task and group in it
    met = placed.join(starts, (task == F.col("task")) & F.col("group").eqNullSafe(F.col("of")))
    return met.withColumn("rank", F.col("at") + F.col("shift")).drop("of", "task", "shift", "at")


def _pairs(level: Column) -> Column:
    """The next level: the hash of every two nodes, or of one that is left."""
    first = F.sequence(F.lit(0), F.size(level) - 1, F.lit(2))
    return F.transform(first, lambda i: hashed(F.get(level, i), F.coalesce(F.get(level, i + 1), F.lit(""))))


def _nodes_at(digit: int) -> Column:
    """Nodes of the whole group at the level where this digit counts them."""
    return F.ceil(F.col("n") / F.lit(1 << DIGIT * digit)).cast("long")


def _higher(nodes: Column):
    """Adds a level to the levels so far, the same again where the whole group has but one node left."""

    def add(levels: Column, width: Column) -> Column:
        last = F.element_at(levels, -1)
        return F.concat(levels, F.array(F.when(nodes > width, _pairs(last)).otherwise(last)))

    return add


def _rolled(nodes: DataFrame) -> DataFrame:
    """(group, n, block, tree) of (group, n, rank, hash, item): the digit columns of the rank grouped away."""
    digits = [(F.shiftright("rank", DIGIT * i).bitwiseAND((1 << DIGIT) - 1)).cast("int").alias(f"digit{i}") for i in range(DIGITS)]
    block = F.shiftright("rank", DIGIT * DIGITS).alias("block")
    rows = nodes.select("group", "n", block, *digits, F.struct("hash", "item").alias("node"))
    rows = rows.repartition("group", "n", "block")  # which all groupings below keep
    for i in range(DIGITS):
        rest = ["group", "n", "block", *(f"digit{k}" for k in range(i + 1, DIGITS))]
        children = F.transform(F.array_sort(F.collect_list(F.struct(f"digit{i}", "node"))), lambda child: child["node"])
        rows = rows.groupBy(*rest).agg(children.alias("children"))
        leaves = F.transform("children", lambda child: child["hash"])
        widths = F.array(*(F.lit(1 << t) for t in range(DIGIT)))
        rows = rows.withColumn("levels", F.aggregate(widths, F.array(leaves), _higher(_nodes_at(i))))
        node = F.struct(F.element_at(F.element_at("levels", -1), 1).alias("hash"), "levels", "children")
        rows = rows.select(*rest, node.alias("node"))
    return rows.withColumnRenamed("node", "tree")


def _steps(levels: Column, place: Column, digit: int) -> Column:
    """The steps of a node's child at a place, as many as the group's size asks for."""

    def step(t: int) -> Column:
        at = F.shiftright(place, t)
        odd = at.bitwiseAND(1) == 1
        level = F.element_at(levels, t + 1)
        left = F.when(odd, F.get(level, at - 1)).otherwise("")
        right = F.when(odd, "").otherwise(F.coalesce(F.get(level, at + 1), F.lit("")))
        return F.struct(left.alias("left"), right.alias("right"))

    taken = sum(((_nodes_at(digit) > (1 << t)).cast("int") for t in range(DIGIT)), F.lit(0))
    return F.slice(F.array(*(step(t) for t in range(DIGIT))), F.lit(1), taken)


def _emitted(node: Column, above: Column, digit: int) -> Column:
    """An array of (item, hash, steps) of all leaves below a node."""

    def child(below: Column, place: Column) -> Column:
        steps = F.concat(_steps(node["levels"], place, digit), above)
        if digit:
            return _emitted(below, steps, digit - 1)
        return F.struct(below["item"].alias("item"), below["hash"].alias("hash"), steps.alias("steps"))

    inner = F.transform(node["children"], child)
    return F.flatten(inner) if digit else inner


def _climbed(nodes: DataFrame) -> list[DataFrame]:
    """Tables of blocks from the leaves up, the last with one block per group."""
    tables = [written(_rolled(nodes), "blocks")]
    while (tables[-1].agg(F.max("block")).first()[0] or 0) > 0:
        below = tables[-1]
        nodes = below.select(
            "group",
            F.ceil(F.col("n") / F.lit(BLOCK)).cast("long").alias("n"),
            F.col("block").alias("rank"),
            F.col("tree.hash").alias("hash"),
            F.col("block").alias("item"),
        )
        tables.append(written(_rolled(nodes), "blocks"))
    return tables


def _descended(tables: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(group, item, hash, steps, roots) of all leaves; `tops` has (group, block, steps, roots) of the last table."""
    above = tops
    for trees in reversed(tables):
        both = trees.unionByName(above, allowMissingColumns=True)
        met = both.groupBy("group", "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("n", "tree", "steps", "roots")))
        rows = met.select("group", "roots", F.explode(_emitted(F.col("tree"), F.col("steps"), DIGITS - 1)).alias("leaf"))
        rows = rows.select("group", "roots", "leaf.item", "leaf.hash", "leaf.steps")
        if trees is not tables[0]:
            above = rows.select("group", F.col("item").alias("block"), "steps", "roots")
    return rows


def manifest(
    docs: DataFrame, key: str = "doc_id", group: str = "lang", columns: Sequence[str] = COLUMNS, carried: Column | None = None
) -> DataFrame:
    """(key, group, leaf, carried, subroot, root, steps): the tree's leaf, roots and proof of every row.

    Leaves are hashes of `columns`, in that order. In each group they ascend by the key, null first, rows of one key by
    leaf; the roots of groups ascend by group, null first. Rows are never put together: a repeated row has as many
    leaves. An empty text is another value than null. `carried` is a narrow value, such as another leaf, that comes back beside
    the row's proof. A table without rows gives none. Other columns do not matter.
    """
    item = F.struct(F.col(key).alias("key"), (F.lit(None).cast("string") if carried is None else carried).alias("carried"))
    leaves = docs.select(F.col(group).alias("group"), leaf_of(*(F.col(f"`{c}`") for c in columns)).alias("hash"), item.alias("item"))
    # The texts are read once; what is ranked and moved from here on is narrow.
    ranked = _ranked(written(leaves, "leaves").withColumn("by", F.col("item.key")), ["by", "hash"])
    below = _climbed(ranked.drop("by"))
    subroots = below[-1].select(F.lit(0).alias("group"), F.col("group").alias("item"), F.col("tree.hash").alias("hash"))
    over = _climbed(_ranked(subroots, ["item"]))
    none = F.array().cast("array<struct<left:string,right:string>>")
    top = over[-1].select("group", "block", none.alias("steps"), F.struct(F.col("tree.hash").alias("root")).alias("roots"))
    tops = _descended(over, top).select(
        F.col("item").alias("group"),
        F.lit(0).cast("long").alias("block"),
        "steps",
        F.struct(F.col("hash").alias("subroot"), F.col("roots.root").alias("root")).alias("roots"),
    )
    return _descended(below, tops).select(
        F.col("item.key").alias(key),
        F.col("group").alias(group),
        F.col("hash").alias("leaf"),
        F.col("item.carried").alias("carried"),
        "roots.subroot",
        "roots.root",
        "steps",
    )


FIELD = "coalesce(strlen({0}::varchar) || ':' || {0}::varchar, '-')"
LEAF = f"{FIELD.format('doc_id')} || {FIELD.format('source')} || {FIELD.format('lang')} || {{0}} || {FIELD.format('text')}"
# The checksum bit by bit, over the decimal digits of the id: its polynomial and start value are those of zlib's.
CRC = """xor(4294967295, list_reduce(list_concat([4294967295::bigint], list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint)),
  lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)))"""
STEP = "case when s[1] = '<' then s[2:] || a else a || s[2:] end"

OP11 = f"""
with recursive rows as (
  select doc_id, lang, sha256({LEAF.format(FIELD.format('n_chars'))}) as leaf,
    case when doc_id is not null and n_chars is not null and ({CRC}) % 7 = 0
      then sha256({LEAF.format(FIELD.format('(n_chars::hugeint + 1)'))}) end as tampered
  from documents),
leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as rank, count(*) over (partition by lang) as n
  from rows),
sub as (
  select 0 as lvl, lang, rank as idx, leaf as hash, n from leaves
  union all
  select lvl + 1, lang, idx // 2, sha256(string_agg(hash, '' order by idx)), (n + 1) // 2 from sub where n > 1 group by lvl, lang, idx // 2, n),
subroots as (select lang, hash, row_number() over (order by lang nulls first) - 1 as rank, count(*) over () as n from sub where n = 1),
top as (
  select 0 as lvl, rank as idx, hash, n from subroots
  union all
  select lvl + 1, idx // 2, sha256(string_agg(hash, '' order by idx)), (n + 1) // 2 from top where n > 1 group by lvl, idx // 2, n),
steps as (
  select l.doc_id, l.lang, l.rank, 0 as part, s.lvl, s.idx & 1 as odd, b.hash as other
  from leaves l join sub s on s.lang is not distinct from l.lang and s.n > 1 and s.idx = l.rank >> s.lvl
  left join sub b on b.lang is not distinct from l.lang and b.lvl = s.lvl and b.idx = xor(s.idx, 1)
  union all
  select l.doc_id, l.lang, l.rank, 1, s.lvl, s.idx & 1, b.hash
  from leaves l join subroots r on r.lang is not distinct from l.lang join top s on s.n > 1 and s.idx = r.rank >> s.lvl
  left join top b on b.lvl = s.lvl and b.idx = xor(s.idx, 1)),
paths as (
  select lang, rank, list(case odd when 1 then '<' else '>' end || coalesce(other, '') order by part, lvl) as steps from steps group by lang, rank),
done as (
  select l.*, r.hash as subroot, (select hash from top where n = 1) as root, coalesce(p.steps, []::varchar[]) as steps
  from leaves l join subroots r on r.lang is not distinct from l.lang
  left join paths p on p.lang is not distinct from l.lang and p.rank = l.rank),
proved as (
  select *, sha256(coalesce(array_to_string(list_transform(steps, lambda s: s[2:]), ''), '')) as proof_sha256,
    list_reduce(list_concat([coalesce(tampered, leaf)], steps), lambda a, s: sha256({STEP})) as folded_root
  from done)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified from proved
"""


@query("op11_manifest", OP11)
def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and what a table that was tampered with folds to.

    Where 7 divides the id's checksum and `n_chars` is not null, that is one more in the table that is verified.
    """
    documents = table(spark, sf_dir, "documents")
    values = {name: F.col(name) for name in COLUMNS}
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(21,0)")
    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0
    tampered = F.when(hit & F.col("n_chars").isNotNull(), leaf_of(*{**values, "n_chars": more}.values()))
    proofs = manifest(documents, carried=tampered)
    folds = folded(F.coalesce("carried", "leaf"), F.col("steps"))
    out = proofs.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"), folds.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))

"""Merkle manifest of a dataset: a tree for each group, and one over the groups' roots.

A row's leaf is the SHA-256 (lower-case hex, as all digests here) of its columns one after
another, a null as ``-``, any other value as its number of UTF-8 bytes, ``:`` and itself.
The leaves of a group are ordered by the key; while more than one node remains, every `RUN`
consecutive ones become the digest of their digests. What remains is the group's subroot
(a lone leaf is its own). The subroots, ordered by group, make the root in the same way.

* Places are given by a range partitioning and the sizes of the ranges before, so a group
  with a third of all rows is spread like the others.
* Levels are built from the bottom, each written. A node is one row: the digests of its
  run, and which run it is part of itself, at which place.
* A recursive query climbs from the leaves to the root, one step a level. It appends the
  siblings of each run it enters and folds the digests on the way. The leaves of a run
  share all runs above, so they climb together: one row a run of leaves, with one folded
  digest for each leaf and one list of siblings for all. Runs high up, which very many rows
  enter, are the `TRUNK` nearest to the root at most and are broadcast; the runs below are
  joined by shuffling, where each is entered by its own small share of the rows.

Nulls: a null key comes first, a null group is a group of its own before all others, a null
key is never chosen for tampering, and a null text has nothing to tamper with. Rows with
the same key are ordered by their leaves, so equal rows are exchangeable. Columns other
than those named are not part of the manifest. An empty table has no rows to return.
"""

from __future__ import annotations

import string
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyproof.llm.stored import store

RUN_BITS = 4
RUN = 1 << RUN_BITS
# Runs that are broadcast: 64 bytes a digest, so 9 MB at most.
TRUNK = 8192
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_TOP = -1  # the tree over the subroots

_CLIMB = """
    WITH RECURSIVE climb(tree, part, folded, proof, subroot, up_tree, up_level, up_at, place) AS (
        SELECT tree, part, folded, proof, subroot, up_tree, up_level, up_at, place FROM {start}
        UNION ALL
        SELECT %s
               c.tree, c.part,
               transform(c.folded, f -> sha2(concat(
                   array_join(slice(r.run, 1, c.place), ''), f, array_join(slice(r.run, c.place + 2, %d), '')
               ), 256)),
               concat(c.proof, array_join(slice(r.run, 1, c.place), ''), array_join(slice(r.run, c.place + 2, %d), '')),
               coalesce(c.subroot, r.subroot), r.up_tree, r.up_level, r.up_at, r.place
        FROM climb c JOIN {runs} r ON c.up_tree = r.tree AND c.up_level = r.level AND c.up_at = r.at
    )
    SELECT * FROM climb WHERE up_tree IS NULL OR {done}
"""


def digest(*parts) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value as it enters a leaf."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def lowered(text: Column) -> Column:
    """`text` with A-Z in lower case and nothing else changed."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`rows` with `at`, the place in its group from 0, `n`, the group's size, and `tree`, the
    number of the group, both by `group` and the columns `order`.

    Rows are sorted in ranges; a row's place is its number in its range and the number of
    rows its group has in the ranges before. Only those numbers meet, one for each range
    and group."""
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ranged = store(ranged.withColumn("_number", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_range", F.shiftright("_number", 33))
    counts = ranged.groupBy("_range", group).agg(F.min("_number").alias("_first"), F.count("*").alias("_rows"))
    groups = _ordered_groups(counts, group)
    before = Window.partitionBy(group).orderBy("_range")
    counts = counts.join(groups, group).withColumn("_before", F.sum("_rows").over(before) - F.col("_rows"))
    counts = store(counts.select("_range", group, "_first", "_before", "n", "tree"))
    at = F.col("_number") - F.col("_first") + F.col("_before")
    return ranged.join(counts, ["_range", group]).withColumn("at", at).drop(
        "_range", "_number", "_first", "_before"
    )


def _ordered_groups(counts: DataFrame, group: str) -> DataFrame:
    """(group, n, tree) of all groups, numbered in order."""
    sizes = counts.groupBy(group).agg(F.sum("_rows").alias("n"))
    ranged = store(
        sizes.repartitionByRange(group).sortWithinPartitions(group)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", 33))
    # One row for each range: its first number and how many groups come before it.
    parts = ranged.groupBy("_part").agg(F.min("_at").alias("_low"), F.count("*").alias("_groups"))
    before = F.sum("_groups").over(Window.orderBy("_part")) - F.col("_groups")
    parts = parts.withColumn("_offset", before).drop("_groups")
    return ranged.join(parts, "_part").select(
        group, "n", (F.col("_at") - F.col("_low") + F.col("_offset")).alias("tree")
    )


def _parent(level: Column | int, groups: int) -> list[Column]:
    """up_tree, up_level, up_at and place of node `at` of `level` in a tree of `n` leaves."""
    tree, at = F.col("tree"), F.col("at")
    rest = F.shiftright(F.col("n") - 1, RUN_BITS * level) > 0  # nodes beside it in its level
    over = (tree != _TOP) & F.lit(groups > 1)
    number = F.when(rest, at).when(over, tree)
    return [
        F.when(rest, tree).when(over, F.lit(_TOP)).cast("bigint").alias("up_tree"),
        F.when(rest, F.lit(level + 1)).when(over, F.lit(1)).cast("int").alias("up_level"),
        F.shiftright(number, RUN_BITS).alias("up_at"),
        F.pmod(number, F.lit(RUN)).cast("int").alias("place"),
    ]


def _is_top(level: int) -> Column:
    return F.shiftright(F.col("n") - 1, RUN_BITS * level) == 0


def _runs(nodes: DataFrame, level: int, groups: int) -> DataFrame:
    """The runs above `nodes` (tree, n, at, hash) of the level below, as rows of the tree."""
    run = F.transform(F.array_sort(F.collect_list(F.struct("at", "hash"))), lambda x: x["hash"])
    found = nodes.groupBy("tree", "n", F.shiftright("at", RUN_BITS).alias("at")).agg(run.alias("run"))
    found = found.withColumn("hash", digest(F.array_join("run", "")))
    subroot = F.when((F.col("tree") != _TOP) & _is_top(level), F.col("hash"))
    return found.select(
        "tree", "n", F.lit(level).alias("level"), "at", "run", "hash", subroot.alias("subroot"), *_parent(level, groups)
    )


@dataclass(frozen=True)
class Level:
    """The runs of one height, of all groups' trees or of the tree over them."""

    top: bool
    height: int
    runs: DataFrame

    def has(self, tree: str, level: str) -> str:
        return f"(({tree} = {_TOP}) = {str(self.top).lower()} AND {level} = {self.height})"


def _levels(nodes: DataFrame, height: int, largest: int, groups: int, top: bool) -> list[Level]:
    """All levels from `height` up over `nodes`, trees of up to `largest` leaves; each is written."""
    found = []
    while largest > 1 << RUN_BITS * (height - 1):
        below = nodes.filter(~_is_top(height - 1)).select("tree", "n", "at", "hash")
        nodes = store(_runs(below, height, groups))
        found.append(Level(top, height, nodes))
        height += 1
    return found


@contextmanager
def _any_number_of_rows(spark: SparkSession):
    """A recursive query ends after a million rows unless told otherwise."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _climbed(start: DataFrame, runs: DataFrame, done: str, hint: str = "") -> DataFrame:
    """`start` after its climb through `runs`, as far as these go; written."""
    spark = start.sparkSession
    query = (_CLIMB % (hint, RUN, RUN)).replace("{done}", done)
    with _any_number_of_rows(spark):
        return store(spark.sql(query, start=start, runs=runs))


def _ascended(state: DataFrame, levels: list[Level], trunk: int) -> DataFrame:
    """`state` after its climb through `levels`: the lower ones by joins that shuffle, then those
    next to the root that have at most `trunk` runs together."""
    low, left = list(levels), trunk
    while low and (count := low[-1].runs.count()) <= left:
        left -= count
        low.pop()
    high = levels[len(low) :]
    if low:
        done = " OR ".join(level.has("up_tree", "up_level") for level in high) or "false"
        state = _climbed(state, _union([x.runs for x in low]), done)
    return _climbed(state, _union([x.runs for x in high]), "false", "/*+ BROADCAST(r) */") if high else state


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def manifest(
    rows: DataFrame, columns: tuple[str, ...] = COLUMNS, key: str = "doc_id", group: str = "source",
    text: str = "text", tampered: Column | None = None, trunk: int = TRUNK,
) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root and verified for each row.

    `proof_sha256` is the digest of all siblings of the leaf and of the nodes above it, level
    by level, left to right. `folded_root` is the root folded from the leaf and these siblings,
    where the leaf of `tampered` rows is that of the row with its text's A-Z in lower case;
    without `tampered`, no row is."""
    tampered = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    own = {name: F.col(f"`{name}`") for name in columns}
    leaf = digest(*[field(x) for x in own.values()])
    changed = digest(*[field(lowered(x) if name == text else x) for name, x in own.items()])
    leaves = store(rows.select(
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.concat(F.lit("1"), F.col(f"`{group}`").cast("string")), F.lit("0")).alias("group"),
        leaf.alias("leaf"), F.when(tampered, changed).alias("changed"),
    ))
    placed = numbered(leaves, "group", ["key", "leaf"])
    members = F.array_sort(F.collect_list(F.struct("at", "key", "leaf", "changed")))
    bundles = placed.groupBy("tree", "n", F.shiftright("at", RUN_BITS).alias("part")).agg(members.alias("members"))
    several = F.col("n") > 1
    digests = F.transform("members", lambda m: m["leaf"])
    bundles = store(bundles.withColumn("run", digests).withColumn(
        "hash", F.when(several, digest(F.array_join("run", ""))).otherwise(F.col("run")[0])
    ))
    groups, largest = bundles.agg(F.countDistinct("tree"), F.max("n")).first()
    # The bundles are the runs of level 1; a lone leaf is a node of level 0.
    first = bundles.select("tree", "n", F.col("part").alias("at"), "hash")
    above = _levels(first, 2, largest or 0, groups, False)
    subroots = [x.runs.filter("subroot IS NOT NULL").select("tree", "hash") for x in above]
    nodes = store(_union([first.filter(_is_top(1)).select("tree", "hash"), *subroots]).select(
        F.lit(_TOP).cast("bigint").alias("tree"), F.lit(groups).cast("bigint").alias("n"), F.col("tree").alias("at"), "hash"
    ))
    over = _levels(nodes, 1, groups, groups, True)
    root = (over[-1].runs if over else nodes).first()

    def folded() -> Column:
        def one(m: Column, i: Column) -> Column:
            leaf = F.coalesce(m["changed"], m["leaf"])
            others = F.slice(digests, F.lit(1), i), F.slice(digests, i + 2, F.lit(RUN))
            return F.when(several, digest(F.array_join(others[0], ""), leaf, F.array_join(others[1], ""))).otherwise(leaf)

        return F.transform("members", one)

    subroot = F.when(_is_top(1), F.col("hash"))
    # A lone leaf is in the place of its bundle, so level 1 holds for it as well.
    state = bundles.withColumn("at", F.col("part")).select(
        "tree", "part", folded().alias("folded"), F.lit("").alias("proof"), subroot.alias("subroot"), *_parent(1, groups)
    )
    climbed = _ascended(state, above + over, trunk)
    both = bundles.join(climbed, ["tree", "part"]).select(
        "subroot", "folded", "proof", "run", F.posexplode("members").alias("i", "member")
    )
    i = F.col("i")
    siblings = F.concat(F.array_join(F.slice("run", F.lit(1), i), ""), F.array_join(F.slice("run", i + 2, F.lit(RUN)), ""))
    top = F.lit(root.hash if root else None).cast("string")
    return both.select(
        F.col("member.key").alias(key), F.col("member.leaf").alias("leaf"), "subroot", top.alias("root"),
        digest(siblings, F.col("proof")).alias("proof_sha256"), F.get("folded", i).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

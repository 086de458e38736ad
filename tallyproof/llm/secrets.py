"""Secret scan with corpus-wide ownership, in DataFrame functions only.

Every match of a kind's pattern is a candidate. Positions come from the lengths of what
lies between matches (`split`) and of the matches (`regexp_extract_all`), both of which
find leftmost matches that do not overlap. A text without a match is searched once. Matches
are unfolded to rows, where a running sum over the lengths gives their positions, and
running extremes tell which overlap; so the cost is linear in a text's matches (but for
sorting them), however many it has.

Candidates (of an assignment its value) are hashed, and the hashes are counted over the corpus by repository and owner:
first by (hash, owner, repository), then by (hash, owner), then by hash, each partly in the
map tasks, so a string that is everywhere never meets in one place. What many owners
have is a widely copied example; what few have looks live and gets a span of kind `live`
besides. Apart from the base kinds, long mixed strings of any form are candidates too; they
are reported only if live.

A null text has no matches, a null owner or repository counts as one of its own. Rows with
the same id are reported each for itself.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyproof.llm.stored import store

# Kinds in the order of ties, their patterns, and what a match must have.
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
_ASSIGNED = 6
LIVE = "live"
STRONG = "strong"
STRONG_PATTERN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
ALL = {**PATTERNS, STRONG: STRONG_PATTERN}
_MIXED = ("[0-9]", "[A-Z]", "[a-z]")  # a strong match has all of these, anywhere

# Up to so many bytes of masked places are broadcast, so the texts stay where they are.
BROADCAST_BYTES = 64 << 20

# From so many owners on, a string is taken for a copied example.
WIDE = 3

def _matches(pattern: str) -> Column:
    return F.regexp_extract_all("text", F.lit(pattern), F.lit(0))


def _lengths(kind: str, rank: int) -> Column:
    """Of each match in column `kind`, whose surroundings are in `between`: its number, its
    length and that of what lies before it, in code points and in bytes, and its value."""
    value = F.col("values") if kind == "assign" else F.col(kind)

    def lengths(before: Column, match: Column) -> Column:
        return F.struct(
            F.length(before).cast("bigint").alias("gap"), F.length(match).cast("bigint").alias("size"),
            F.octet_length(before).cast("bigint").alias("byte_gap"), F.octet_length(match).cast("bigint").alias("byte_size"),
        )

    sizes = F.zip_with(F.slice(f"{kind}_between", 1, F.size(kind)), kind, lengths)
    numbered = F.transform(sizes, lambda x, i: x.withField("number", i))
    found = F.zip_with(numbered, value, lambda x, v: F.struct(
        F.lit(rank).alias("rank"), x["number"].alias("number"), x["gap"].alias("gap"), x["size"].alias("size"),
        x["byte_gap"].alias("byte_gap"), x["byte_size"].alias("byte_size"), v.alias("value"),
    ))
    return F.when(F.size(kind) > 0, found)


def _matched(rows: DataFrame) -> DataFrame:
    """`rows` (with text) with `matches`: the lengths of all matches of all kinds, null if
    there are none."""
    found = rows.select("*", *[_matches(p).alias(kind) for kind, p in ALL.items()])
    found = found.select(
        "*",
        *[F.when(F.size(kind) > 0, F.split("text", p, -1)).alias(f"{kind}_between") for kind, p in ALL.items()],
        F.when(F.size("assign") > 0, F.regexp_extract_all("text", F.lit(PATTERNS["assign"]), F.lit(2))).alias("values"),
    )
    lengths = [_lengths(kind, i) for i, kind in enumerate(ALL)]
    kind = found.select(lengths[0].alias("x")).schema["x"].dataType
    none = F.array().cast(kind)
    every = F.concat(*[F.coalesce(x, none) for x in lengths])
    return found.select(*rows.columns, F.when(F.size(every) > 0, every).alias("matches"))


def _placed(found: DataFrame) -> DataFrame:
    """A row for each span: begin, rank, stop, kind, value, byte_begin and byte_stop beside
    the other columns of `found` (row, matches, ..). Of assignments those with a short value
    go after the scan, which they end; of other strong strings those go that do not have all
    of `_MIXED` or that overlap a span of a base kind."""
    others = [name for name in found.columns if name != "matches"]
    each = found.select(*others, F.explode("matches").alias("m")).select(*others, "m.*")
    running = Window.partitionBy("row", "rank").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap") + F.col("size")).over(running)
    byte_stop = F.sum(F.col("byte_gap") + F.col("byte_size")).over(running)
    each = each.withColumn("stop", stop).withColumn("byte_stop", byte_stop)
    kinds = F.array(*[F.lit(kind) for kind in ALL])
    each = each.select(
        *others, (F.col("stop") - F.col("size")).alias("begin"), "rank", "stop",
        F.get(kinds, F.col("rank")).alias("kind"), "value",
        (F.col("byte_stop") - F.col("byte_size")).alias("byte_begin"), "byte_stop",
    )
    strong = F.col("kind") == STRONG
    each = each.filter(((F.col("kind") != "assign") | (F.length("value") >= _ASSIGNED)) & (
        ~strong | reduce(and_, [F.col("value").rlike(p) for p in _MIXED])
    ))
    before, behind = (
        Window.partitionBy("row").orderBy(order).rangeBetween(Window.unboundedPreceding, 0)
        for order in (F.asc("begin"), F.desc("begin"))
    )
    until = F.max(F.when(~strong, F.col("stop"))).over(before)
    following = F.min(F.when(~strong, F.col("begin"))).over(behind)
    meets = (F.coalesce(until, F.lit(-1)) > F.col("begin")) | (F.coalesce(following, F.col("stop")) < F.col("stop"))
    return each.withColumn("meets", meets).filter(~strong | ~F.col("meets")).drop("meets")


def scan_secrets(
    rows: DataFrame, key: str = "doc_id", owner: str = "source", repository: str = "lang", text: str = "text"
) -> DataFrame:
    """One row per row of `rows`: row (its number), mark (of its text), key, base and spans.

    A repository is named by its owner and `repository`. `base` and `spans` are arrays of
    (begin, rank, stop, kind, value, owners, repositories); `spans` adds one of kind `live`
    for each string that few owners have."""
    found = _matched(rows.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{owner}`").alias("owner"),
        F.col(f"`{repository}`").alias("repository"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ))
    # Written, so that the texts are searched once and row numbers are fixed.
    found = store(
        found.select(F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("mark"), "key", "owner", "repository", "matches")
    )
    each = _placed(found.filter("matches IS NOT NULL").select("row", "owner", "repository", "matches"))
    each = store(each.withColumn("hash", F.sha2("value", 256)))
    spread = (
        each.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
        .groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
        .groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    )
    fields = ["begin", "rank", "stop", "kind", "value", "byte_begin", "byte_stop", "owners", "repositories"]
    judged = each.select("row", "hash", *fields[:-2]).join(spread, "hash")
    live = judged.filter(F.col("owners") < WIDE).select(
        "row", (F.col("stop") - F.length("value")).alias("begin"), F.lit(len(KINDS)).alias("rank"), "stop",
        F.lit(LIVE).alias("kind"), "value", (F.col("byte_stop") - F.octet_length("value")).alias("byte_begin"),
        "byte_stop", "owners", "repositories",
    ).distinct()
    spans = judged.filter(F.col("rank") < len(KINDS)).select("row", *fields).unionByName(live)
    listed = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("spans"))
    return (
        found.select("row", "mark", "key").join(listed, "row", "left")
        .withColumn("spans", F.coalesce("spans", F.array().cast(listed.schema["spans"].dataType)))
        .select(
            "row", "mark", F.col("key").alias(key),
            F.filter("spans", lambda s: s["rank"] < len(KINDS)).alias("base"), "spans",
        )
    )


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def named(spans: str) -> Column:
    """kind:begin:stop of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["stop"])), ",")


def mask_live(rows: DataFrame, key: str = "doc_id", owner: str = "source", repository: str = "lang") -> DataFrame:
    """`rows` with the live secrets in `text` replaced by ``<secret>``; copied examples
    stay. No row is dropped. Rows with the same key and text are masked alike."""
    found = scan_secrets(rows, key, owner, repository)
    live = found.select(
        "row", F.col(f"`{key}`").alias("_key"), F.col("mark").alias("_mark"),
        F.explode(F.filter("spans", lambda s: s["kind"] == LIVE)).alias("s"),
    ).select("row", "_key", "_mark", F.col("s.byte_begin").alias("begin"), F.col("s.byte_stop").alias("stop"))
    # Spans that meet are one gap in the text; gaps are told apart by how many begin before.
    earlier = Window.partitionBy("row").orderBy("begin", "stop").rowsBetween(Window.unboundedPreceding, -1)
    apart = F.col("begin") >= F.coalesce(F.max("stop").over(earlier), F.lit(0))
    running = Window.partitionBy("row").orderBy("begin", "stop").rowsBetween(Window.unboundedPreceding, 0)
    gaps = live.withColumn("apart", apart.cast("int")).withColumn("gap", F.sum("apart").over(running))
    gaps = gaps.groupBy("row", "_key", "_mark", "gap").agg(F.min("begin").alias("begin"), F.max("stop").alias("stop"))
    # What stays: from each gap's end to the next one's begin, in bytes.
    in_order = Window.partitionBy("row").orderBy("gap")
    gaps = gaps.withColumn("from", F.coalesce(F.lag("stop").over(in_order), F.lit(0)))
    hits = gaps.groupBy("row", "_key", "_mark").agg(
        F.array_sort(F.collect_list(F.struct("from", F.col("begin").alias("to")))).alias("_parts"), F.max("stop").alias("_end")
    ).groupBy("_key", "_mark").agg(F.first("_parts").alias("_parts"), F.first("_end").alias("_end"))
    hits = store(hits)
    rows_hit, gaps_hit = hits.agg(F.count("*"), F.sum(F.size("_parts"))).first()
    if 64 * rows_hit + 16 * (gaps_hit or 0) <= BROADCAST_BYTES:
        hits = F.broadcast(hits)
    same = F.col(f"`{key}`").eqNullSafe(F.col("_key")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_mark"))
    data = F.col("text").cast("binary")

    def part(begin: Column, stop: Column) -> Column:
        return F.substring(data, (begin + 1).cast("int"), (stop - begin).cast("int")).cast("string")

    parts = F.transform("_parts", lambda p: part(p["from"], p["to"]))
    last = part(F.col("_end"), F.octet_length("text").cast("bigint"))
    masked = F.concat(F.array_join(parts, "<secret>"), F.lit("<secret>"), last)
    text = F.when(F.col("_parts").isNull(), F.col("text")).otherwise(masked)
    return rows.join(hits, same, "left").withColumn("text", text).select(*[F.col(f"`{c}`") for c in rows.columns])

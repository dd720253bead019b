"""Merkle manifest of a table: one tree a group, one tree over the groups, a proof for every row.

Positions come from one range exchange by (group, id, leaf) and the row counts of
its partitions; no group meets in one task.  Levels are built eight at a time: 256
neighbours of a group are one task's small array, so a tree of 2^40 leaves takes
five exchanges.  Proofs are made by pointer jumping.  Every node starts with the
digest of its sibling as the segment towards its parent; a self-join of the nodes
with their ancestors appends the ancestor's segment and doubles the distance, so
after round k a segment spans 2^k levels.  Only nodes at multiples of that
distance are looked up again, so the tables of ancestors shrink by squaring;
the leaves then jump along them (1, 2, 4, ... levels) until the root is reached.

Digests are SHA-256 of the hexadecimal text of the inputs; tables and segments
hold 32 bytes for each.

Nulls and edge cases: a null value counts as ``-`` in its leaf, a null group is a
group of its own and comes first, a null id comes first in its group.  Rows of
equal id are ordered by leaf; repeated rows are leaves of their own with equal
digests.  A group of one row has its leaf as root.  An empty table has no rows.
Texts of any length are hashed whole.  Only the named columns are read.  The
changed number of a tampered row is exact beyond 64 bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import cut
from kestrel.session import checkpoint_dir

#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Groups whose roots and proofs (about 1 KB each) are sent to all tasks; more of them are joined by shuffle.
GROUPS = 10_000
#: Levels of a tree that one exchange builds: a task collects 2^STEP digests a block.
STEP = 8


def _nothing() -> Column:
    return F.lit(b"")


def _saved(df: DataFrame) -> DataFrame:
    """A lineage cut for the small tables; ``cut`` also frees what came before."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _hash(data: Column) -> Column:
    """Digest of the hexadecimal text of ``data``."""
    return F.unhex(F.sha2(F.lower(F.hex(data)), 256))


def leaf_digest(values: list[Column]) -> Column:
    """Digest of the values: ``-`` for null, else byte count, colon and the value as text."""
    def field(v: Column) -> Column:
        s = v.cast("string")
        return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def tampered(row_id: Column) -> Column:
    """The rows whose number is changed for the check of the proofs."""
    return F.coalesce(F.crc32(row_id.cast("string").cast("binary")) % 7 == 0, F.lit(False))


def _depth(n: Column) -> Column:
    return F.when(n <= 1, F.lit(0)).otherwise(F.length(F.bin(n - 1))).cast("int")


def positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``idx`` (place in the group), ``n`` (rows of the group) and ``depth`` of its tree.

    One range exchange; equal rows are spread by their place in the input, so even
    a row that repeats for a third of the table is split.
    """
    own = "_place"
    part, at = F.shiftright(own, 33), F.col(own).bitwiseAND((1 << 33) - 1)
    keys = [group, *order, "_row"]
    laid = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys) \
        .sortWithinPartitions(*keys).drop("_row").withColumn(own, F.monotonically_increasing_id())
    laid = _saved(laid).withColumns({"_part": part, "_at": at})
    parts = laid.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # one row a group and partition that it touches: groups + partitions rows
    w = Window.partitionBy(group).orderBy("_part")
    before = F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.sum("_n").over(Window.partitionBy(group))
    parts = parts.select(group, "_part", (before - F.col("_first")).alias("_shift"), whole.alias("n"))
    return laid.join(parts, [group, "_part"]).withColumns({
        "idx": F.col("_at") + F.col("_shift"), "depth": _depth(F.col("n"))}).drop("_part", "_at", "_shift", own)


def _parents(level: Column) -> Column:
    """Digests of every two neighbours; a last one without neighbour is hashed alone."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int")),
                       lambda i: F.coalesce(_hash(F.concat(F.get(level, i * 2), F.coalesce(
                           F.get(level, i * 2 + 1), _nothing()))), _nothing()))


def _blocks(nodes: DataFrame, base: int, extra: list[str]) -> DataFrame:
    """Blocks of 2^STEP neighbours at level ``base`` with all levels above them, at most STEP."""
    up = F.least(F.lit(STEP), F.col("depth") - base)
    own = F.array_sort(F.collect_list(F.struct("idx", "digest", *extra)))
    blocks = nodes.groupBy("g", "n", "depth", F.shiftright("idx", STEP).alias("block")).agg(own.alias("own"))
    first = F.transform("own", lambda x: F.coalesce(x["digest"], _nothing()))
    levels = F.aggregate(F.sequence(F.lit(1), up), F.array(first),
                         lambda a, _: F.concat(a, F.array(_parents(F.element_at(a, -1)))))
    return blocks.withColumns({"levels": levels, "up": up})


def _block_nodes(blocks: DataFrame, base: int) -> DataFrame:
    """(g, level, idx, segment): the nodes of blocks below their top, each with its sibling's digest."""
    flat = blocks.select("g", "block", F.posexplode(F.slice("levels", 1, STEP)).alias("j", "digests"), "up")
    flat = flat.where("j < up").select("g", "block", "j", "digests", F.posexplode("digests").alias("p", "_d"))
    above = F.expr(f"shiftleft(block, {STEP} - j)")
    return flat.select("g", (F.col("j") + base).alias("level"), (above + F.col("p")).alias("idx"),
                       F.coalesce(F.get("digests", F.col("p").bitwiseXOR(F.lit(1))), _nothing()).alias("segment"))


def _doubled(low: DataFrame, high: DataFrame, span: int) -> DataFrame:
    """One jump: the nodes of ``low`` with the segment of their ancestor ``span`` levels above appended."""
    up = high.select("g", (F.col("level") - span).alias("level"), F.col("idx").alias("_up"),
                     F.col("segment").alias("_more"))
    return low.withColumn("_up", F.shiftright("idx", span)).join(up, ["g", "level", "_up"], "left").withColumn(
        "segment", F.concat("segment", F.coalesce("_more", _nothing()))).drop("_up", "_more")


def forest(leaves: DataFrame, keep: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Trees over leaves (g, n, depth, idx, digest, *keep).

    Returns the leaves with ``segment`` (the siblings' digests from the leaf up to
    the root of its tree, joined) and the roots (g, root).
    """
    keep = list(keep)
    single = leaves.where("depth = 0")
    nodes, base = leaves.where("depth > 0"), 0
    roots, inner, low = [single.select("g", F.col("digest").alias("root"))], [], None
    deepest = leaves.agg(F.max("depth")).first()[0] or 0
    while base < deepest:
        blocks = _saved(_blocks(nodes, base, keep if base == 0 else []))
        flat = _block_nodes(blocks, base)
        if base == 0:
            one = blocks.select("g", "n", "depth", F.posexplode("own").alias("p", "o"), F.element_at("levels", 1).alias("l"))
            low = one.select("g", "n", "depth", F.lit(0).alias("level"), "o.idx", "o.digest", *[f"o.{c}" for c in keep],
                             F.coalesce(F.get("l", F.col("p").bitwiseXOR(F.lit(1))), _nothing()).alias("segment"))
            flat = flat.where("level > 0")
        inner.append(flat)
        top = blocks.select("g", "n", "depth", "up", F.col("block").alias("idx"),
                            F.element_at(F.element_at("levels", -1), 1).alias("digest"))
        done = F.col("depth") <= base + STEP
        roots.append(top.where(done).select("g", F.col("digest").alias("root")))
        nodes, base = top.where(~done).drop("up"), base + STEP
    none = single.withColumns({"level": F.lit(0), "segment": _nothing()})
    if low is None:
        return none, roots[0]
    # ancestors: in round k those at multiples of 2^k; the leaves use the odd multiples
    ancestors, span = reduce(DataFrame.unionByName, inner), 1
    while span < deepest:
        odd = ancestors.where(F.col("level") % (2 * span) == span)
        low = _doubled(low, odd, span)
        ancestors = ancestors.where(F.col("level") % (2 * span) == 0)
        if 2 * span < deepest:
            ancestors = _saved(_doubled(ancestors, odd, span))
        span *= 2
    return low.unionByName(none, allowMissingColumns=True), reduce(DataFrame.unionByName, roots)


def fold(start: Column, segment: Column, idx: Column, n: Column, depth: Column) -> Column:
    """Root recomputed from a leaf's digest and the siblings of its proof."""
    state = F.struct(start.alias("d"), F.lit(1).alias("at"), idx.cast("long").alias("i"),
                     (n - 1).cast("long").alias("last"))

    def step(s: Column, _: Column) -> Column:
        odd = s["i"] % 2 == 1
        there = odd | (s["i"] < s["last"])
        other = F.when(there, F.substring(segment, s["at"], 32)).otherwise(_nothing())
        both = F.when(odd, F.concat(other, s["d"])).otherwise(F.concat(s["d"], other))
        return F.struct(_hash(both).alias("d"), (s["at"] + F.when(there, 32).otherwise(0)).alias("at"),
                        F.shiftright(s["i"], 1).alias("i"), F.shiftright(s["last"], 1).alias("last"))

    return F.when(depth > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), state, step, lambda s: s["d"])) \
        .otherwise(start)


def proofs(leaves: DataFrame, group: str, row_id: str, keep: list[str] = ()) -> DataFrame:
    """Every leaf with its proof.

    ``leaves`` holds ``group``, ``row_id``, ``digest`` and ``keep``.  Adds, for the
    tree of the group, ``idx``, ``n``, ``depth``, ``segment``, ``subroot``; for the
    tree over the groups ``g_idx``, ``g_n``, ``g_depth``, ``g_segment``, ``root``.
    Groups ascend by their text's bytes, null first.
    """
    keep = list(keep)
    name = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    placed = positions(leaves.select(name.alias("g"), row_id, "digest", *keep), "g", [row_id, "digest"])
    low, roots = forest(placed, [row_id, *keep])
    subroots = _saved(roots)
    tree = positions(subroots.select(F.lit("").alias("_all"), F.col("g").alias("_g"), F.col("root").alias("digest")),
                     "_all", ["_g"]).withColumnRenamed("_all", "g")
    high, root = forest(tree, ["_g"])
    up = high.join(root, "g").select(
        F.col("_g").alias("g"), F.col("digest").alias("subroot"), F.col("idx").alias("g_idx"), F.col("n").alias("g_n"),
        F.col("depth").alias("g_depth"), F.col("segment").alias("g_segment"), "root")
    up = _saved(up)
    # few groups hold many rows each: those must not meet by group
    return low.drop("level").join(F.broadcast(up) if up.count() <= GROUPS else up, "g")


def manifest(docs: DataFrame, group: str = "lang", row_id: str = "doc_id", fields: tuple[str, ...] = FIELDS,
             changed: str = "n_chars") -> DataFrame:
    """Leaves and proofs of all rows of ``docs``; ``other`` is the leaf with ``changed`` raised by 1
    where ``tampered`` holds, else null."""
    plus = (F.col(changed).cast("decimal(38,0)") + 1).cast("string")
    digest = leaf_digest([F.col(c) for c in fields])
    other = leaf_digest([plus if c == changed else F.col(c) for c in fields])
    leaves = docs.select(F.col(group).alias("_group"), F.col(row_id).alias("_id"), digest.alias("digest"),
                         F.when(tampered(F.col(row_id)), other).alias("other"))
    return proofs(cut(leaves), "_group", "_id", ["other"])


def verify(proved: DataFrame) -> DataFrame:
    """``proved`` with ``folded``: the root from the changed leaf, or else the leaf, and the proof."""
    start = F.coalesce("other", "digest")
    c = {k: F.col(k) for k in ("segment", "idx", "n", "depth", "g_segment", "g_idx", "g_n", "g_depth")}
    within = proved.withColumn("_sub", fold(start, c["segment"], c["idx"], c["n"], c["depth"]))
    return within.withColumn("folded", fold(F.col("_sub"), c["g_segment"], c["g_idx"], c["g_n"], c["g_depth"])).drop("_sub")


def digest(proved: DataFrame, id_name: str = "doc_id") -> DataFrame:
    """The manifest as text: leaf, roots, hash of the proof and the outcome of its check."""
    def text(c: str) -> Column:
        return F.lower(F.hex(c))
    out = verify(proved)
    return out.select(
        F.col("_id").alias(id_name), text("digest").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
        F.sha2(F.lower(F.hex(F.concat("segment", "g_segment"))), 256).alias("proof_sha256"),
        text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))

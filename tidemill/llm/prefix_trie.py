"""The prefix trie of conversations, by names of power-of-two blocks of turns.

Every conversation is rebuilt (its first turns may come from a shared one), and every
distinct sequence of first turns is a node.  Nodes are found without comparing sequences:

* Turns with equal role and text get one number (a *dense name*: 0, 1, 2, ...).
* Blocks of ``2 ** (j + 1)`` turns, at multiples of their size, are pairs of blocks of half
  the size; distinct pairs of names are named again.  A round for each power of two.
* A prefix of d turns is a chain of such blocks, by the binary form of d, largest first.
  Prefixes with r bits are pairs of a prefix with r - 1 bits and a block; again they are
  named by distinct pairs, in a round for each number of bits.

So a node is (depth, name), found in a logarithmic number of rounds, each of which handles
every turn once at most.  Sums over subtrees double as well: a node's sum over what lies
less than ``2 ** k`` levels below it, and those of its descendants ``2 ** k`` levels below,
give that over less than ``2 ** (k + 1)`` levels.

Names are given by numbering distinct keys, a partition's rows in a row, and adding up
partitions' counts.  Turns are numbered by ranges (``operators.ranks``), so a conversation of
any size is spread out; popular prefixes are counted before rows are shuffled, and joins
back to names are plain equi-joins, whose hot keys adaptive execution splits.  The ids of a
node's members are packed by ranges and hashed as a stream.  Every round is a table in the
shared folder; all but the result are deleted at the end.

Defined results: null role and text are empty; turns of equal number are ordered by the
digest of role and text; null turns come first.  A null conv_id is a conversation of its own
that shares no head: it counts as a member, a node that has no other member has a null
conv_id, and it comes first, as an empty string, in ends_sha256.  An empty table gives no node. Other columns
are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranks import numbered
from .base import CRC32_SQL, arrow_map, materialize, read_table, scratch

SPAN = 100
HEAD_TURNS = 6
PACKED_CHARS = 1 << 16


def dense_names(rows: DataFrame, keys: list[str], name: str = "name") -> DataFrame:
    """Distinct keys with numbers 0, 1, 2, ... in no particular order."""
    each = materialize(rows.select(*keys).distinct().withColumn("_at", F.monotonically_increasing_id()), "distinct")
    # the id's upper bits are a partition's number, its lower bits the place within the partition
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = each.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return each.withColumn("_part", part).join(F.broadcast(sizes), "_part").select(*keys, (place + F.col("_base")).alias(name))


def turns(convs: DataFrame) -> DataFrame:
    """Rows (conv_id, pos, digest, chars): turns in order, from 0."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = convs.select("conv_id", "turn", digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    placed = numbered(rows, ("conv_id",), (F.col("turn").asc_nulls_first(), F.col("digest").asc()), "pos")
    return placed.select("conv_id", (F.col("pos") - 1).alias("pos"), "digest", "chars")


def rebuild(convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows (c, pos, digest, chars), conversations (c, n)): the shared head, then what of a conversation's own turns is behind its first h."""
    own = materialize(turns(convs), "turns")
    ids = own.groupBy("conv_id").agg(F.count("*").alias("own_n"))
    h = F.coalesce(F.crc32(F.col("conv_id").cast("string")) % HEAD_TURNS, F.lit(0)).cast("long")
    ids = ids.select(F.col("conv_id").alias("c"), "own_n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % SPAN).alias("base"))
    heads = own.filter((F.col("conv_id") % SPAN == 0) & (F.col("pos") < HEAD_TURNS - 1))
    held = heads.groupBy(F.col("conv_id").alias("base")).agg(F.count("*").alias("held"))
    ids = materialize(ids.join(held, "base", "left").withColumn("k", F.least("h", F.coalesce("held", F.lit(0)))), "ids")
    first = ids.select("c", "base", "k").join(heads.withColumnRenamed("conv_id", "base"), "base").filter("pos < k").select("c", "pos", "digest", "chars")
    to = ids.filter("own_n > h").select("c", "h", "k")
    rest = own.join(to, F.col("conv_id").eqNullSafe(F.col("c"))).filter("pos >= h").select("c", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "digest", "chars")
    sizes = ids.select("c", (F.col("k") + F.greatest(F.lit(0).cast("long"), F.col("own_n") - F.col("h"))).alias("n"))
    return materialize(first.unionByName(rest), "rebuilt"), sizes


def prefixes(rows: DataFrame) -> DataFrame:
    """Rows (c, d, name, chars), d from 1: name tells the distinct sequences of first d turns apart, chars is the last turn's."""
    named = dense_names(rows, ["digest"])
    cell = F.coalesce(F.col("c").cast("string"), F.lit(""))  # joins must match the null id too
    blocks = materialize(rows.join(named, "digest").select(cell.alias("c"), F.col("pos").alias("k"), "name"), "level_0")
    most = rows.agg(F.max("pos")).first()[0]
    if most is None:
        return rows.select("c", F.col("pos").alias("d"), F.lit(0).cast("long").alias("name"), "chars")
    levels = [blocks]
    while 1 << len(levels) <= most + 1:
        even = F.col("k") % 2 == 0
        pairs = levels[-1].groupBy("c", F.floor(F.col("k") / 2).alias("k")).agg(F.max(F.when(even, F.col("name"))).alias("a"), F.max(F.when(~even, F.col("name"))).alias("b"))
        pairs = materialize(pairs.filter("a IS NOT NULL AND b IS NOT NULL"), "pairs")
        levels.append(materialize(pairs.join(dense_names(pairs, ["a", "b"]), ["a", "b"]).select("c", "k", "name"), f"level_{len(levels)}"))
    # every block behind a prefix: it ends at d and its size is d's lowest bit
    ends = None
    for j, level in enumerate(levels):
        here = level.filter("k % 2 = 0").select("c", ((F.col("k") + 1) * (1 << j)).alias("d"), (F.col("k") * (1 << j)).alias("before"), "name")
        ends = here if ends is None else ends.unionByName(here)
    ends = materialize(ends.withColumn("bits", F.bit_count("d")), "ends")
    done = ends.filter("bits = 1").select("c", "d", "name")
    out, bits = [done], 2
    while (1 << bits) - 1 <= most + 1:
        last = out[-1].select("c", F.col("d").alias("before"), F.col("name").alias("a"))
        pairs = materialize(ends.filter(F.col("bits") == bits).select("c", "d", "before", F.col("name").alias("b")).join(last, ["c", "before"]).select("c", "d", "a", "b"), "chains")
        out.append(materialize(pairs.join(dense_names(pairs, ["d", "a", "b"]), ["d", "a", "b"]).select("c", "d", "name"), f"prefixes_{bits}"))
        bits += 1
    whole = out[0]
    for x in out[1:]:
        whole = whole.unionByName(x)
    last = rows.select(cell.alias("c"), (F.col("pos") + 1).alias("d"), "chars")
    whole = whole.join(last, ["c", "d"])
    return whole.select(F.when(F.col("c") != "", F.col("c")).cast("long").alias("c"), "d", "name", "chars")


def hashed_ends(ends: DataFrame) -> DataFrame:
    """Rows (depth, name, ends_sha256) of rows (depth, name, c): the hash of a node's ids, ascending, joined by commas."""

    def pack(batches):
        key, first, held, size = None, None, [], 0
        for b in batches:
            for depth, name, c in zip(b["depth"], b["name"], b["c"]):
                if key != (depth, name) or size > PACKED_CHARS:
                    if held:
                        yield {"depth": [key[0]], "name": [key[1]], "first": [first], "packed": [",".join(held)]}
                    key, first, held, size = (depth, name), c, [], 0
                held.append("" if c is None else str(c))
                size += len(held[-1]) + 1
        if held:
            yield {"depth": [key[0]], "name": [key[1]], "first": [first], "packed": [",".join(held)]}

    def digest(batches):
        key, sha = None, None
        for b in batches:
            for depth, name, packed in zip(b["depth"], b["name"], b["packed"]):
                if key == (depth, name):
                    sha.update(b"," + packed.encode())
                    continue
                if key:
                    yield {"depth": [key[0]], "name": [key[1]], "ends_sha256": [sha.hexdigest()]}
                key, sha = (depth, name), hashlib.sha256(packed.encode())
        if key:
            yield {"depth": [key[0]], "name": [key[1]], "ends_sha256": [sha.hexdigest()]}

    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["depth", "name", F.col("c").asc_nulls_first()]
    packed = arrow_map(ends.repartitionByRange(n, *order).sortWithinPartitions(*order), pack, "depth long, name long, first long, packed string")
    placed = packed.repartition("depth", "name").sortWithinPartitions("depth", "name", F.col("first").asc_nulls_first())
    return arrow_map(placed, digest, "depth long, name long, ends_sha256 string")


def subtree_sums(nodes: DataFrame, deepest: int) -> DataFrame:
    """Nodes (depth, name, path, leaf, saved) with both summed over subtrees. path: (depth, name) of all prefixes by member."""
    members, sums = nodes
    step, sums = 1, sums
    while step <= deepest:
        up = sums.filter(F.col("depth") >= step).select(F.col("member").alias("c"), (F.col("depth") - step).alias("depth"), "leaves", "saved")
        up = up.join(members, ["c", "depth"]).groupBy("depth", "name").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        sums = sums.join(up, ["depth", "name"], "left").select(
            "depth", "name", "member", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")
        )
        sums = materialize(sums, f"sums_{step}")
        step *= 2
    return sums


def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    with scratch(convs.sparkSession):
        rows, sizes = rebuild(convs)
        sizes = materialize(sizes, "sizes")
        root = sizes.select("c", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("name"), F.lit(0).cast("long").alias("chars"))
        path = materialize(root.unionByName(prefixes(rows).select("c", F.col("d").alias("depth"), "name", "chars")), "path")
        # a node is told by its smallest member; a null id stands for itself only where it is alone, and as text in joins
        cell = F.coalesce(F.col("c").cast("string"), F.lit(""))
        nodes = path.groupBy("depth", "name").agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"))
        nodes = materialize(nodes.withColumn("member", F.coalesce(F.col("conv_id").cast("string"), F.lit(""))), "nodes")
        members = path.select(cell.alias("c"), "depth", "name")
        up = nodes.filter("depth > 0").select("depth", "name", F.col("member").alias("c"), (F.col("depth") - 1).alias("up_depth"))
        up = up.join(members.select("c", F.col("depth").alias("up_depth"), F.col("name").alias("up_name")), ["c", "up_depth"])
        over = nodes.select(F.col("depth").alias("up_depth"), F.col("name").alias("up_name"), F.col("conv_id").alias("parent_conv_id"))
        up = materialize(up.join(over, ["up_depth", "up_name"]).select("depth", "name", "up_depth", "up_name", "parent_conv_id"), "parents")
        children = up.groupBy(F.col("up_depth").alias("depth"), F.col("up_name").alias("name")).agg(F.count("*").alias("n_children"))
        nodes = nodes.join(children, ["depth", "name"], "left").join(up.select("depth", "name", "parent_conv_id"), ["depth", "name"], "left")
        nodes = materialize(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "family")
        own = nodes.select("depth", "name", "member", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
        deepest = nodes.agg(F.max("depth")).first()[0] or 0
        sums = subtree_sums((members, own), deepest)
        last = path.join(sizes, path["c"].eqNullSafe(sizes["c"]) & (path["depth"] == sizes["n"])).select("depth", "name", path["c"])
        out = nodes.join(sums.select("depth", "name", "leaves", "saved"), ["depth", "name"]).join(hashed_ends(last), ["depth", "name"], "left")
        out = out.select(
            "conv_id",
            "depth",
            "parent_conv_id",
            F.col("n_convs").cast("long").alias("n_convs"),
            F.col("n_children").cast("long").alias("n_children"),
            F.col("leaves").cast("long").alias("n_leaves"),
            F.col("saved").cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
        return materialize(out, "trie", keep=True)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


SQL = f"""
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations),
ids AS (SELECT c, count(*) AS own_n, c - c % {SPAN} AS base, {CRC32_SQL.format('CAST(c AS VARCHAR)')} % {HEAD_TURNS} AS h FROM own GROUP BY c),
kept AS (SELECT i.*, least(h, coalesce(b.own_n, 0)) AS k FROM ids i LEFT JOIN (SELECT c AS base, own_n FROM ids) b USING (base)),
rebuilt AS (
  SELECT kept.c, o.pos, o.role, o.text FROM kept JOIN own o ON o.c = kept.base AND o.pos < kept.k
  UNION ALL
  SELECT kept.c, o.pos - kept.h + kept.k, o.role, o.text FROM kept JOIN own o ON o.c = kept.c AND o.pos >= kept.h),
turns AS (SELECT c, pos + 1 AS d, strlen(role) || ':' || role || strlen(text) || ':' || text AS turn, text, count(*) OVER (PARTITION BY c) AS n FROM rebuilt),
paths AS (
  SELECT c, d, list(sha256(turn)) OVER (PARTITION BY c ORDER BY d) AS key, length(text) AS chars, d = n AS ends FROM turns
  UNION ALL
  SELECT c, 0, [], 0, NOT EXISTS (SELECT 1 FROM rebuilt r WHERE r.c = kept.c) FROM kept),
nodes AS (
  SELECT d, key, min(c) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM paths GROUP BY d, key),
family AS (
  SELECT n.*, up.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes x WHERE x.d = n.d + 1 AND list_slice(x.key, 1, n.d) = n.key) AS n_children
  FROM nodes n LEFT JOIN nodes up ON up.d = n.d - 1 AND up.key = list_slice(n.key, 1, n.d - 1))
SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, a.parent_conv_id, a.n_convs, a.n_children,
       count(*) FILTER (b.n_children = 0) AS n_leaves, CAST(sum((b.n_convs - 1) * b.chars) AS BIGINT) AS saved_tokens, a.ends_sha256
FROM family a JOIN family b ON b.d >= a.d AND list_slice(b.key, 1, a.d) = a.key
GROUP BY a.conv_id, a.d, a.parent_conv_id, a.n_convs, a.n_children, a.ends_sha256, a.key
"""

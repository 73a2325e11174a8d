"""Cheapest repair of a conversation's structure, by Dial's shortest paths.

A node is (rows read, state of the pattern of role initials).  Keeping a row costs 0,
giving it the role user or assistant 1, deleting it 2, inserting an empty turn 5; a cut-off
row that is not deleted costs 5 more; blank and repeated rows must be deleted.  All costs
are small integers, so distances to the end are found with a ring of buckets instead of a
heap (``Dial``), backwards, and recorded.  From the start on, the walk takes among the arcs that are tight
the one whose letter is least: from a node each letter leads to one node, so the letters
come out as the least of all cheapest audits.

A conversation may be of any size.  Rows are dealt out by ranges of (conversation, order),
and what of a conversation lies in a range is a *block*.  Most conversations are one block.
Of others, each block gives the distances between its border's states; folded from the end
they give every block its distances behind it; each block walks from every state at its
left border; and folded from the start these walks give the state each block begins in.
No more than two conversations for each range are spread, so what is folded, and broadcast,
is bounded by the number of ranges.  First occurrences of repeated rows are found by
grouping on a digest.  Repaired text is rendered by block and hashed as a stream, so no
task holds a conversation's text.

Defined results: null role and text are one space, as they are in the damage's key, and so are
null conv_id and turn there; a null conv_id is a conversation; null turns come first, rows
of equal turn are ordered by the digest of role and text; a role is known by its first
letter; a conversation of which nothing is left has cost 0, an empty audit and the hash of
nothing; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import CRC32_SQL, arrow_map, materialize, read_table, scratch

KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: The pattern (s?(ua)+)? as state -> letter -> state; accepted: 0 and 3.
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
GOAL = (0, None, None, 0)
#: State -> (state behind an inserted or renamed turn, its role); there is one in every state.
NEW_TURN = {g: next((to, {"u": "user", "a": "assistant"}[c]) for c, to in step.items() if c != "s") for g, step in enumerate(STEPS)}
CHUNK_CHARS = 1 << 16
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True, slots=True)
class Row:
    initial: str
    dead: bool  # blank or repeated
    cut: bool


def arcs_before(rows: list[Row], i: int, g: int):
    """Arcs into node (i, g): (node they come from, cost)."""
    for before in range(4):
        if NEW_TURN[before][0] == g:
            yield i, before, INSERT
    if i == 0:
        return
    row = rows[i - 1]
    yield i - 1, g, DELETE
    if row.dead:
        return
    extra = CUT if row.cut else 0
    for before in range(4):
        if STEPS[before].get(row.initial) == g:
            yield i - 1, before, KEEP + extra
        if NEW_TURN[before][0] == g:
            yield i - 1, before, REROLE + extra


def distances(rows: list[Row], behind: tuple = GOAL) -> list[list[int | None]]:
    """Dial: cost from each node (rows read, state) to the end. behind: costs from the last layer's states on.

    Buckets form a ring: no queued distance is further ahead than the largest arc, or the spread of ``behind`` at first.
    """
    found: list[list[int | None]] = [[None] * 4 for _ in range(len(rows) + 1)]
    starts = [(d, g) for g, d in enumerate(behind) if d is not None]
    low = min(d for d, _ in starts)
    ring = max(REROLE + CUT, INSERT, DELETE, max(d for d, _ in starts) - low) + 1
    buckets: list[list[tuple[int, int]]] = [[] for _ in range(ring)]
    for d, g in starts:
        buckets[d % ring].append((len(rows), g))
    queued, d = len(starts), low
    while queued:
        bucket = buckets[d % ring]
        while bucket:
            i, g = bucket.pop()
            queued -= 1
            if found[i][g] is not None:
                continue
            found[i][g] = d
            for before, state, cost in arcs_before(rows, i, g):
                if found[before][state] is None:
                    buckets[(d + cost) % ring].append((before, state))
                    queued += 1
        d += 1
    return found


def walk(rows: list[Row], found: list[list[int | None]], g: int, last: bool) -> tuple[int, str]:
    """(state at the end, letters) of the least tight path from (0, g). A block that is not the last leaves insertions behind its rows to the next."""
    out, i, n = [], 0, len(rows)
    while True:
        d = found[i][g]
        if i == n and (not last or d == 0):
            return g, "".join(out)
        row = rows[i] if i < n else None
        extra = CUT if row and row.cut else 0
        new = NEW_TURN[g][0]
        if row and _tight(d, DELETE, found[i + 1][g]):
            out.append("D")
            i += 1
        elif _tight(d, INSERT, found[i][new]):
            out.append("I")
            g = new
        elif row and not row.dead and row.initial in STEPS[g] and _tight(d, KEEP + extra, found[i + 1][STEPS[g][row.initial]]):
            out.append("K")
            g = STEPS[g][row.initial]
            i += 1
        else:
            out.append("R")
            g = new
            i += 1


def _tight(d: int, cost: int, rest: int | None) -> bool:
    return rest is not None and d == cost + rest


def render(audit: str, g: int, rows):
    """Lines of the repaired turns. rows: an iterator of (role, text), one for each letter but I."""
    for letter in audit:
        role, text = (None, "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter == "K":
            g = STEPS[g][role[:1]]
        else:
            g, role = NEW_TURN[g]
        yield f"{role}:{text}"


# -- on tables


def damaged(convs: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, copy) after the damage; conv is the id as text, empty for null."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = convs.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        "turn",
        space("role").alias("role"),
        space("text").alias("text"),
        (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20).alias("kind"),
    ).filter("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


ORDER = ("turn", "digest", "copy", "uid")


def _order() -> list:
    return [F.col("turn").asc_nulls_first(), "digest", "copy", "uid"]


def ranged(rows: DataFrame) -> DataFrame:
    """Rows dealt out by ranges of (conv, order), with the range's number, the faults of each row alone, and a digest of role and text."""
    trimmed = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    rows = rows.withColumns({
        "digest": F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)),
        "blank": F.length(F.ltrim(trimmed, F.lit(" \t\n\x0b\x0c\r"))) == 0,
        "cut": ~F.right(trimmed, F.lit(1)).isin(".", "!", "?"),
        "uid": F.monotonically_increasing_id(),
    })
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(rows.repartitionByRange(n, "conv", *_order()).withColumn("part", F.spark_partition_id()), "ranged")


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows without texts: the first fault of each. Rows seen earlier are told by a digest's first place."""
    place = F.struct(F.col("turn").isNotNull(), *(F.col(c) for c in ORDER))
    seen = rows.groupBy("conv", "digest").agg(F.count("*").alias("_n"), F.min(place).alias("_first")).filter("_n > 1")
    seen = seen.select("conv", "digest", F.col("_first.uid").alias("_uid"))
    facts = rows.select("conv", "part", *ORDER, F.substring("role", 1, 1).alias("initial"), "blank", "cut").join(seen, ["conv", "digest"], "left")
    twice = F.coalesce(F.col("uid") != F.col("_uid"), F.lit(False)) & ~F.col("blank")
    facts = facts.withColumn("twice", twice).withColumn("cut", F.col("cut") & ~F.col("blank") & ~F.col("twice"))
    return materialize(facts.select("conv", "part", *ORDER, "initial", "blank", "twice", "cut"), "facts")


def _blocks(batches, columns: list[str]):
    """Consecutive rows of one (conv, part), as (conv, part, lists of columns)."""
    key, held = None, None
    for b in batches:
        for conv, part, *values in zip(b["conv"], b["part"], *(b[c] for c in columns)):
            if key != (conv, part):
                if key is not None:
                    yield *key, held
                key, held = (conv, part), [[] for _ in columns]
            for h, v in zip(held, values):
                h.append(v)
    if key is not None:
        yield *key, held


def _rows_of(initial: list, dead: list, cut: list) -> list[Row]:
    return [Row(*x) for x in zip(initial, dead, cut)]


def _by_block(facts: DataFrame) -> DataFrame:
    return facts.select("conv", "part", *ORDER, "initial", (F.col("blank") | F.col("twice")).alias("dead"), "cut", *(c for c in facts.columns if c in ("behind", "last"))).repartition("conv", "part").sortWithinPartitions("conv", "part", *_order())


def spread(facts: DataFrame) -> DataFrame:
    """Rows (conv, part, behind, last) for the blocks of conversations that lie in several ranges; behind: the costs from their right border on.

    Two such conversations meet in a range at most, so this is as small as the number of ranges.
    """
    parts = facts.groupBy("conv", "part").agg(F.count("*").alias("n"))
    several = parts.groupBy("conv").agg(F.count("*").alias("blocks")).filter("blocks > 1")
    several = materialize(several, "several")

    def across(batches):
        for conv, part, (initial, dead, cut) in _blocks(batches, ["initial", "dead", "cut"]):
            rows = _rows_of(initial, dead, cut)
            ends = [distances(rows, tuple(0 if g == e else None for g in range(4)))[0] for e in range(4)]
            yield {"conv": [conv], "part": [part], "costs": [[ends[e][g] for g in range(4) for e in range(4)]]}

    def fold(batches):
        for b in batches:
            for conv, blocks in zip(b["conv"], b["blocks"]):
                # what is behind the last block: insertions may still follow there
                behind, out = tuple(distances([])[0]), []
                for k, x in enumerate(reversed(blocks)):
                    out.append({"conv": [conv], "part": [x["part"]], "behind": [list(behind)], "last": [k == 0]})
                    behind = tuple(min((c + r for c, r in zip(x["costs"][4 * g : 4 * g + 4], behind) if c is not None and r is not None), default=None) for g in range(4))
                yield from out

    costs = arrow_map(_by_block(facts.join(F.broadcast(several), "conv", "left_semi")), across, "conv string, part int, costs array<int>")
    whole = costs.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "costs"))).alias("blocks"))
    return materialize(arrow_map(whole, fold, "conv string, part int, behind array<int>, last boolean"), "behind")


def audits(facts: DataFrame) -> DataFrame:
    """One row for each block: conv, part, several (blocks), entry, cost (of the first block: the whole conversation's), audit, illegal, first, final (initials)."""
    behind = spread(facts)

    def walks(batches):
        for conv, part, (initial, dead, cut, behind, last) in _blocks(batches, ["initial", "dead", "cut", "behind", "last"]):
            rows = _rows_of(initial, dead, cut)
            several = behind[0] is not None
            found = distances(rows, tuple(behind[0]) if several else GOAL)
            ways = [walk(rows, found, g, last[0] if several else True) if found[0][g] is not None else (g, "") for g in range(4 if several else 1)]
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initial, initial[1:]))
            yield {
                "conv": [conv], "part": [part], "several": [several], "cost": [found[0][0]], "exits": [[e for e, _ in ways]], "ways": [[w for _, w in ways]],
                "illegal": [illegal], "first": [initial[0]], "final": [initial[-1]],
            }

    kind = "conv string, part int, several boolean, cost long, exits array<int>, ways array<string>, illegal long, first string, final string"
    blocks = materialize(arrow_map(_by_block(facts.join(F.broadcast(behind), ["conv", "part"], "left")), walks, kind), "walks")

    def enter(batches):
        for b in batches:
            for conv, exits in zip(b["conv"], b["blocks"]):
                g = 0
                for x in exits:
                    yield {"conv": [conv], "part": [x["part"]], "entry": [g]}
                    g = x["exits"][g]

    chains = blocks.filter("several").groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "exits"))).alias("blocks"))
    entries = arrow_map(chains, enter, "conv string, part int, entry int")
    blocks = blocks.join(F.broadcast(entries), ["conv", "part"], "left").withColumn("entry", F.coalesce("entry", F.lit(0)))
    border = F.concat(F.lag("final").over(Window.partitionBy("conv").orderBy("part")), "first")
    illegal = F.col("illegal") + F.when(border.isNotNull() & ~border.isin("su", "ua", "au"), 1).otherwise(0)
    return materialize(blocks.select("conv", "part", "several", "entry", "cost", F.element_at("ways", F.col("entry") + 1).alias("audit"), illegal.alias("illegal")), "audits")


def hashes(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows (conv, sha): the hash of each conversation's repaired turns."""

    def lines(batches):
        """Blocks as text: a header row has the audit, the rows behind it follow it letter by letter."""
        for b in batches:
            yield from zip(b["conv"], b["part"], b["audit"], b["entry"], b["several"], b["role"], b["text"])

    def rendered(batches):
        stream, here = lines(batches), []

        def following():
            _, _, _, _, _, role, text = next(stream)
            return role, text

        for conv, part, audit, entry, several, _, _ in stream:
            no, size, first, sha, here = 0, 0, True, hashlib.sha256(), []
            for line in render(audit, entry, iter(following, None)):
                if not several:
                    sha.update(("" if first else "\n").encode() + line.encode("utf-8", "surrogatepass"))
                    first = False
                    continue
                here.append(line)
                size += len(line)
                if size > CHUNK_CHARS:
                    yield {"conv": [conv], "part": [part], "no": [no], "sha": [None], "text": ["\n".join(here)]}
                    no, size, here = no + 1, 0, []
            if not several:
                yield {"conv": [conv], "part": [part], "no": [0], "sha": [sha.hexdigest()], "text": [None]}
            elif here:
                yield {"conv": [conv], "part": [part], "no": [no], "sha": [None], "text": ["\n".join(here)]}

    def joined(batches):
        key, sha = None, None
        for b in batches:
            for conv, text in zip(b["conv"], b["text"]):
                if conv != key:
                    if sha:
                        yield {"conv": [key], "sha": [sha.hexdigest()]}
                    key, sha = conv, hashlib.sha256(text.encode())
                else:
                    sha.update(b"\n" + text.encode())
        if sha:
            yield {"conv": [key], "sha": [sha.hexdigest()]}

    none = lambda kind: F.lit(None).cast(kind)
    heads = blocks.select("conv", "part", F.lit(0).alias("row"), none("long").alias("turn"), none("binary").alias("digest"), none("int").alias("copy"), none("long").alias("uid"), "audit", "entry", "several", none("string").alias("role"), none("string").alias("text"))
    body = rows.select("conv", "part", F.lit(1).alias("row"), *ORDER, none("string").alias("audit"), none("int").alias("entry"), none("boolean").alias("several"), "role", "text")
    placed = heads.unionByName(body).repartition("conv", "part").sortWithinPartitions("conv", "part", "row", *_order())
    kind = "conv string, part int, no int, sha string, text string"
    done = materialize(arrow_map(placed.select("conv", "part", "audit", "entry", "several", "role", "text"), rendered, kind), "rendered")
    far = done.filter("sha IS NULL").repartition("conv").sortWithinPartitions("conv", "part", "no")
    return done.filter("sha IS NOT NULL").select("conv", "sha").unionByName(arrow_map(far.select("conv", "text"), joined, "conv string, sha string"))


def repair(convs: DataFrame) -> DataFrame:
    """One row for each conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    with scratch(convs.sparkSession):
        ids = convs.select("conv_id").distinct().withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
        rows = ranged(damaged(convs))
        facts = with_faults(rows)
        blocks = audits(facts)
        turns = facts.groupBy("conv", "turn").agg(*(F.count_if(c).alias(c) for c in ("blank", "twice", "cut")))
        gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
        counts = turns.groupBy("conv").agg(gaps.alias("gaps"), *(F.sum(c).alias(c) for c in ("blank", "twice", "cut")))
        # a conversation has at most a block for each range
        whole = blocks.groupBy("conv").agg(
            F.sum("illegal").alias("illegal"), F.min_by("cost", "part").alias("cost"), F.sort_array(F.collect_list(F.struct("part", "audit"))).alias("parts")
        ).withColumn("audit", F.array_join("parts.audit", ""))
        out = ids.join(counts, "conv", "left").join(whole, "conv", "left").join(hashes(rows, blocks), "conv", "left")
        zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
        out = out.select(
            "conv_id",
            zero("gaps").alias("gaps"),
            zero("blank").alias("blank"),
            zero("twice").alias("duplicate"),
            zero("cut").alias("truncated"),
            zero("illegal").alias("illegal"),
            zero("cost").alias("cost"),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha", F.lit(EMPTY_SHA)).alias("repaired_sha256"),
        )
        return materialize(out, "repaired", keep=True)


def op11_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(read_table(spark, sf_dir, "conversations"))


def _sql() -> str:
    """The repair row by row from the end, without paths: of each state the least text of cost, letters and repaired lines."""
    blank = "\\x20\\x09-\\x0D"
    lines = lambda v: f"substr({v}, strpos({v}, chr(1)) + 1)"

    def before(v: str, cost: str, letter: str, line: str | None) -> str:
        own = "" if line is None else f" || {line} || chr(10)"
        return f"lpad(CAST(CAST(substr({v}, 1, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || '{letter}' || substr({v}, 10, strpos({v}, chr(1)) - 10) || chr(1){own} || {lines(v)}"

    cut = f"(CASE WHEN fault = 'truncated' THEN {CUT} ELSE 0 END)"
    layer = []
    for g in range(4):
        to, role = NEW_TURN[g]
        ways = [before(f"v{g}", str(DELETE), "D", None), f"CASE WHEN live THEN {before(f'v{to}', f'{REROLE} + {cut}', 'R', f"'{role}:' || text")} END"]
        ways += [f"CASE WHEN live AND left(role, 1) = '{c}' THEN {before(f'v{t}', cut, 'K', "role || ':' || text")} END" for c, t in STEPS[g].items()]
        layer.append(f"least({', '.join(ways)}) AS b{g}")
    insert = lambda g, v: before(v, str(INSERT), "I", f"'{NEW_TURN[g][1]}:'")
    closed = f"SELECT c, i, b1, b0, least(b2, {insert(2, 'b3')}) AS v2, least(b3, {insert(3, 'b2')}) AS v3"
    start = "'000000000' || chr(1)"
    return f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC32_SQL.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations),
hit AS (
  SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM keyed WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text), copy) AS no FROM hit),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^{blank}]') THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY no) > 1 THEN 'duplicate'
         WHEN regexp_extract(text, '([^{blank}])[{blank}]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM numbered),
rows_ AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS live, left(lag(role) OVER (PARTITION BY c ORDER BY no), 1) || left(role, 1) AS pair FROM faults),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(no) AS n FROM rows_ GROUP BY c),
walk AS (
  SELECT c, n AS i, {start} AS v0, {before(before("('000000000' || chr(1))", "5", "I", "'assistant:'"), "5", "I", "'user:'")} AS v1, {before("('000000000' || chr(1))", "5", "I", "'assistant:'")} AS v2, {start} AS v3 FROM counts
  UNION ALL
  SELECT c, i, least(b0, {insert(0, 'v2')}), least(b1, {insert(1, 'v2')}), v2, v3 FROM (
    {closed} FROM (SELECT w.c, w.i - 1 AS i, {', '.join(layer)} FROM walk w JOIN rows_ r ON r.c IS NOT DISTINCT FROM w.c AND r.no = w.i))),
ended AS (SELECT c, v0 AS v FROM walk WHERE i = 0)
SELECT q.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(CAST(substr(v, 1, 9) AS BIGINT), 0) AS cost, coalesce(substr(v, 10, strpos(v, chr(1)) - 10), '') AS audit,
       sha256(coalesce(left({lines('v')}, greatest(length({lines('v')}) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN counts ON counts.c IS NOT DISTINCT FROM q.conv_id LEFT JOIN ended ON ended.c IS NOT DISTINCT FROM q.conv_id
"""


SQL = _sql()

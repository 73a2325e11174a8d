"""Mixing sources to target weights by a low-discrepancy slot schedule.

DataFrame functions only.  Every source's documents are put in a fixed shuffled order and
laid end to end as a stream of words, cut into blocks of ``block_words``.  The mix is a
sequence of slots; slot i draws the point ``frac(i * golden ratio)`` and belongs to the
source whose interval of the cumulative weights holds that point.  The r-th slot of a
source takes block ``r mod n_blocks`` of that source, in pass ``r div n_blocks``.  A
source's last slot is cut so that it takes its target to the word.

So a document's words come from the slots of its blocks: ``first_slot`` is the first one,
its place in the mix, by which rows are put into the order of the schedule.

Slots are ranked within fixed runs of slots and the runs are added up, and documents are
placed within hash buckets and the buckets are added up, so no window holds a whole
source, however hot it is.

Targets: the sources in code-point order (null last) weigh ``weights`` in rotation and
share ``share`` times all words; a target stops at ``limit`` times its source's words, and
what is over is shared again by weight.  The fixed point is ``min(cap, level * weight)``,
found in one pass over the sources ordered by cap / weight.

Defined results: null or empty texts have size 0, take 0 words and stay in the result; an
empty table gives an empty result; repeated rows are separate documents, and so are rows with
a null id, which come in the shuffled order where an empty id would; ties in that order are
settled by a row number; no other column is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import WORD, free_names, materialize, read_table

#: Modulus and odd multiplier of the golden-ratio sequence in integers: 0.6180339887 * 2 ** 31.
PERIOD = 1 << 31
STEP = 1327217885
#: Slots ranked together, and cells that cut the unit interval for the equi-join of points to sources.
RUN = 1 << 16
CELL = 1 << 19


def source_targets(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """One row for each source: source, sid, source_size, target. One row a source meets in the ordering windows."""
    each = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = each.withColumn("sid", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(limit)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    onwards = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(whole) * F.lit(float(share))
    ranked = ranked.withColumn("level", (total - before) / onwards)
    reached = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    # the first source whose level stays below its cap sets it; from there on levels only fall
    ranked = ranked.withColumn("level", F.max(reached).over(whole))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight")))
    return ranked.select("source", "sid", "source_size", target.alias("target"))


def mix(docs: DataFrame, block_words: int = 256, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Rows (doc_id, rid, size, source_size, target, taken, first_slot), one for each input row. first_slot is missing where nothing is taken."""
    placed, sources = _placed(docs, block_words, id_col, text_col, source_col)
    slots = schedule(sources, block_words)
    pieces = placed.filter("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("at") / block_words), F.floor((F.col("at") + F.col("size") - 1) / block_words)))
    )
    first = F.greatest(F.col("at"), F.col("block") * block_words)
    last = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block_words)
    pieces = pieces.select("rid", "sid", "block", (first - F.col("block") * block_words).alias("off"), (last - first).alias("words"))
    got = F.greatest(F.lit(0).cast("long"), F.least(F.col("take"), F.col("off") + F.col("words")) - F.col("off"))
    taken = pieces.join(slots.select("sid", "block", "take", "slot"), ["sid", "block"]).groupBy("rid").agg(F.sum(got).alias("taken"), F.min(F.when(got > 0, F.col("slot"))).alias("first_slot"))
    return placed.join(taken, "rid", "left").select("doc_id", "rid", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.col("first_slot").cast("long").alias("first_slot"))


def _placed(docs: DataFrame, block_words: int, id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, DataFrame]:
    """Documents with their place in their source's stream, and the sources."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    sized = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"), F.col(source_col).alias("source"), size.alias("size")), "sizes"
    )
    sources = materialize(source_targets(sized), "sources")
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).drop("source")
    rows = rows.withColumn("order", order).withColumn("bucket", F.substring("order", 1, 3))
    totals = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("sid", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("base"))
    within = Window.partitionBy("sid", "bucket").orderBy("order", "doc_id", "rid").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("at", F.coalesce(F.sum("size").over(within), F.lit(0))).join(totals, ["sid", "bucket"])
    placed = placed.withColumn("at", F.col("at") + F.col("base")).select("doc_id", "rid", "sid", "size", "source_size", "target", "at")
    return materialize(placed, "placed"), sources


def schedule(sources: DataFrame, block_words: int) -> DataFrame:
    """The slots of the mix: slot (order in the mix), sid, rank, block, pass, take (words from the block's start)."""
    spark = sources.sparkSession
    b = F.lit(block_words).cast("long")
    words = F.floor("target").cast("long")
    full = F.floor(words / F.col("source_size")).cast("long")
    n = F.ceil(F.col("source_size") / b).cast("long")
    rest = words - full * F.col("source_size")
    need = sources.filter("source_size > 0").withColumn("words", words).withColumn("n_blocks", n)
    need = need.withColumn("slots", (full * n + F.ceil(rest / b)).cast("long")).filter("slots > 0")
    by_sid = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    need = need.withColumn("upto", F.sum("slots").over(by_sid)).withColumn("all", F.sum("slots").over(whole))
    need = need.withColumn("hi", F.floor(F.col("upto") / F.col("all") * PERIOD).cast("long"))
    need = need.withColumn("lo", F.floor((F.col("upto") - F.col("slots")) / F.col("all") * PERIOD).cast("long"))
    need = materialize(need.select("sid", "source_size", "words", "n_blocks", "slots", "lo", "hi"), "need")
    n_slots = need.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]

    cells = need.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / CELL), F.floor((F.col("hi") - 1) / CELL)))).select("sid", "lo", "hi", "cell")
    points = spark.range(n_slots).select(F.col("id").alias("slot"), F.pmod(F.pmod(F.col("id"), F.lit(PERIOD)) * STEP, F.lit(PERIOD)).alias("u"))
    drawn = points.withColumn("cell", F.floor(F.col("u") / CELL)).join(cells, "cell").filter("u >= lo AND u < hi").select("sid", "slot")
    drawn = materialize(drawn.withColumn("run", F.floor(F.col("slot") / RUN)), "drawn")
    runs = drawn.groupBy("sid", "run").agg(F.count("*").alias("c"))
    earlier = Window.partitionBy("sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("sid", "run", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("base"), "c")
    within = Window.partitionBy("sid", "run").orderBy("slot")
    ranked = drawn.withColumn("rank", F.row_number().over(within) - 1).join(runs.select("sid", "run", "base"), ["sid", "run"])
    ranked = ranked.select("sid", "slot", (F.col("rank") + F.col("base")).alias("rank"))
    # a source whose interval drew a few points too few gets the rest at the end
    drew = need.join(runs.groupBy("sid").agg(F.sum("c").alias("drew")), "sid", "left")
    short = drew.withColumn("drew", F.coalesce("drew", F.lit(0))).filter("drew < slots")
    short = short.select("sid", F.lit(n_slots).cast("long").alias("slot"), F.explode(F.sequence("drew", F.col("slots") - 1)).alias("rank"))
    slots = ranked.unionByName(short).join(need, "sid").filter("rank < slots")
    slots = slots.withColumn("pass", F.floor(F.col("rank") / F.col("n_blocks"))).withColumn("block", F.col("rank") % F.col("n_blocks"))
    length = F.least(b, F.col("source_size") - F.col("block") * b)
    left = F.col("words") - F.col("pass") * F.col("source_size") - F.col("block") * b
    return slots.select("slot", "sid", "rank", "block", "pass", F.least(length, left).alias("take"))


def remix(docs: DataFrame, slot_col: str | None = None, **options) -> DataFrame:
    """docs as the mix takes them: each row as often as the mix takes its words, rounded; all columns.

    slot_col: name of a further column with the row's place in the mix, to write the rows in that order.
    docs is read twice and its rows are told apart by their place, so it must come from stored files, as the
    documents table and the stages of the pipeline do, or from another source that repeats its partitions.
    """
    options = {"id_col": "doc_id", "text_col": "text", "source_col": "source"} | options
    rid, times, copy, slot = free_names(docs, "rid", "times", "copy", "slot")
    numbered = docs.withColumn(rid, F.monotonically_increasing_id())
    taken = mix(docs, **options).filter("size > 0").select(F.col("rid").alias(rid), F.round(F.col("taken") / F.col("size")).cast("int").alias(times), F.col("first_slot").alias(slot))
    out = numbered.join(taken.filter(F.col(times) > 0), rid)
    out = out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).drop(rid, times, copy)
    return out.withColumnRenamed(slot, slot_col) if slot_col else out.drop(slot)


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).drop("rid").withColumn("first_slot", F.coalesce("first_slot", F.lit(-1).cast("long")))


SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
each AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS sid FROM each),
weighed AS (SELECT *, CASE sid % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
                   source_size * 2.0::DOUBLE AS cap FROM ranked),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, sid, source_size, least(cap, weight * (SELECT max(level) FROM levels WHERE level <= cap / weight)) AS target FROM levels),
need AS (
  SELECT sid, source_size, CAST(floor(target) AS BIGINT) AS words, CAST(floor(floor(target) / source_size) AS BIGINT) AS whole
  FROM targets WHERE source_size > 0),
slots AS (
  SELECT sid, CAST(whole * ceil(source_size / 256) + ceil((words - whole * source_size) / 256) AS BIGINT) AS n FROM need),
shares AS (
  SELECT sid, n, CAST(floor(sum(n) OVER (ORDER BY sid) / sum(n) OVER () * {PERIOD}) AS BIGINT) AS hi,
         CAST(floor((sum(n) OVER (ORDER BY sid) - n) / sum(n) OVER () * {PERIOD}) AS BIGINT) AS lo
  FROM slots WHERE n > 0),
points AS (
  SELECT slot, slot % {PERIOD} * {STEP} % {PERIOD} AS u
  FROM (SELECT unnest(generate_series(0, (SELECT CAST(sum(n) AS BIGINT) FROM slots) - 1)) AS slot)),
drawn AS (
  SELECT sid, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS place
  FROM points JOIN shares ON u >= lo AND u < hi),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.sid,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id) - d.size AS BIGINT) AS a,
         CAST(floor(t.target) AS BIGINT) AS words
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(a + size, words) - a) + greatest(0, least(a + size, words - source_size) - a) AS BIGINT) AS taken,
       CASE WHEN size > 0 AND a < words THEN CAST(coalesce(slot, (SELECT sum(n) FROM slots)) AS BIGINT) ELSE -1 END AS first_slot
FROM placed LEFT JOIN drawn ON drawn.sid = placed.sid AND drawn.place = floor(a / 256)
"""

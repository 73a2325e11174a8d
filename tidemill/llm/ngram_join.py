"""N-gram Jaccard self-join of documents by rare-first prefix filtering.

A document's set holds its distinct 5-word shingles (64-bit hashes).  Documents with the
same set are one class; everything below works on classes.  Two classes link when
``100 * intersection >= 80 * union``.  A class is named by 64 bits of its set's hash; sets
are told apart by 128 bits, and where two of them share a name, they get longer-hashed names.

Order.  Shingles are ordered by how often their hash bucket occurs in the whole corpus,
rarest first, then by hash: a total order that all documents share, which is all that
prefix filtering needs.  The table of ``2 ** BUCKET_BITS`` counts has a fixed size; a
bucket counted once holds a shingle that no other document has.  With more distinct shingles
than buckets a count is that of some hundred shingles together: then only shingles that
are common beside those are told apart, which come last, and the rest are in the order of
their buckets; any order gives the same links.

Prefix.  A set of n shingles is indexed by its first ``n - ceil(0.8 n) + 1``; linked sets
share one of these.  One shuffle by shingle leaves the entries whose shingle is shared.
Shingles in very common buckets skip it, so none gathers in one task.

Pairs between components are looked for with further bounds in the join itself, see ``crossing_pairs``.

Pairs pass the length filter, the positional filter (what is left behind the places of a
shared shingle must suffice) and a suffix filter: counts of both sets over ``PARTS``
fixed parts of the hash space bound their Hamming distance from below, as partitioning
the suffixes by a pivot does.  Each pair is verified once, on the whole sets.

Components without all pairs.  A pair within one component need not be verified.  First,
in ``PIVOT_ROUNDS`` rounds, every class meets one pivot of its shingles' lists and
verified links merge components.  Then every remaining candidate pair *between*
components is verified, so no link between different components is lost, and a group of
thousands of near copies takes a number of pairs in the order of its size.

Components spread smallest labels along links, with pointer jumping.

Defined results: null text counts as empty; documents without words have an empty set and
are their own component; fewer than five words are one shingle; rows that repeat an id or
a text get a row each; a null id counts as smaller than all others; an empty table gives an
empty result; other columns are not read.  A set of 2 ** 28 shingles or more is an error.
"""

from __future__ import annotations

import zlib
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import arrow_map, bound_batches, free_names, materialize, read_table, scratch, texts

BUCKET_BITS = 20
SLICES = 16
PARTS = 64
LONGS = 4
PIVOT_ROUNDS = 2
#: Entries of shingles in buckets this full, and this many times as full as the mean bucket, are taken to be shared without a look.
COMMON = 50_000
COMMON_TIMES = 8
KEY_BITS = 22
VOCABULARY = 100_000
#: Bits of a class's name, and how many sets whose name is another's are held in a driver (at 64 bits, a few in 10 ** 10).
NAME_BITS = 64
MOST_CLASHES = 100_000
#: Stands for a null id within the join.
NO_ID = -(1 << 63)
#: Sizes and places are packed in one integer.
SIZE_BITS, PLACE_BITS = 28, 26

_U = np.uint64
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=_U)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= VOCABULARY:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Words()


def shingles(text: str, k: int = 5) -> np.ndarray:
    """The sorted distinct hashes of a text's k-word shingles; words as ASCII white space separates them, A-Z lowered."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, dtype=_U)
    h = np.fromiter(map(_WORDS.__getitem__, words), dtype=_U, count=n)
    width = min(k, n)
    s = np.full(n - width + 1, width, dtype=_U)
    for i in range(width):
        s += h[i : n - width + 1 + i] * _ODD[i]
    for shift, odd in ((31, _ODD[1]), (29, _ODD[2])):
        s ^= s >> _U(shift)
        s *= odd
    s ^= s >> _U(32)
    return np.unique(s)


@dataclass(frozen=True)
class Names:
    """Names of classes: 64 bits of the set's hash; 64 more tell the sets apart that share a name."""

    bits: int = NAME_BITS
    other: dict[int, dict[int, int]] = field(default_factory=dict)  # name -> further bits -> its own name

    def of(self, s: np.ndarray) -> int:
        import xxhash

        raw = s.tobytes()
        name = _signed(xxhash.xxh64_intdigest(raw) >> (64 - self.bits))
        return self.other[name].get(_signed(xxhash.xxh64_intdigest(raw, 1)), name) if name in self.other else name

    def both(self, s: np.ndarray) -> tuple[int, int]:
        """The name, and the further bits."""
        import xxhash

        return self.of(s), _signed(xxhash.xxh64_intdigest(s.tobytes(), 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def classes_of(rows: DataFrame, bits: int = NAME_BITS) -> tuple[DataFrame, DataFrame, Names]:
    """rows (key, more, ...) with keys that no two sets share, their classes (key, first, n, sig, odd), written, and the names that give the keys."""

    def grouped(named: DataFrame) -> DataFrame:
        one = (F.first(c).alias(c) for c in ("n", "sig", "odd"))
        by_key = named.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("first"), *one, F.min("more").alias("lo"), F.max("more").alias("hi"))
        return materialize(by_key, "classes")

    classes = grouped(rows)
    clash = classes.filter("lo < hi").select("key", "lo")
    other: dict[int, dict[int, int]] = {}
    if not clash.isEmpty():
        found = rows.filter("n > 0").join(clash, "key").filter("more > lo").select("key", "more").distinct()
        found = found.withColumn("own", F.xxhash64("key", "more")).limit(MOST_CLASHES + 1).collect()
        if len(found) > MOST_CLASHES:
            raise ValueError("too many sets share a name")
        for r in found:
            other.setdefault(r.key, {})[r.more] = r.own
        table = rows.sparkSession.createDataFrame(found, "key long, more long, own long")
        rows = rows.join(F.broadcast(table), ["key", "more"], "left").withColumn("key", F.coalesce("own", "key")).drop("own")
        classes = grouped(rows)
    return rows.drop("more"), classes.drop("lo", "hi"), Names(bits, other)


def buckets(s: np.ndarray) -> np.ndarray:
    return (s >> _U(64 - BUCKET_BITS)).astype(np.int64)


def signature(s: np.ndarray) -> bytes:
    """How many shingles lie in each part of the hash space; by other bits than the bucket."""
    parts = (s & _U(PARTS - 1)).astype(np.int64)
    return np.minimum(np.bincount(parts, minlength=PARTS), 65535).astype("<u2").tobytes()


def parity(s: np.ndarray) -> list[int]:
    """Whether each of 64 * LONGS parts of the hash space holds an odd number of shingles, as bits of LONGS integers.

    Two sets differ by at least as many shingles as such bits.
    """
    odd = np.bincount(((s >> _U(20)) & _U(64 * LONGS - 1)).astype(np.int64), minlength=64 * LONGS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def prefix(s: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The prefix in the shared order, and the bucket counts of its shingles."""
    own = counts[buckets(s)]
    n = len(s)
    order = np.lexsort((s, own))[: n - (8 * n + 9) // 10 + 1]
    return s[order], own[order]


@contextmanager
def _batches_of(spark: SparkSession, rows: int):
    """Larger Arrow batches for narrow rows while the jobs inside run."""
    bound_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        yield
    finally:
        bound_batches(spark)


def document_rows(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Rows (doc_id, n, key, more, sig, odd) of all documents, written, and the bucket counts of the corpus."""
    size = (1 << BUCKET_BITS) // SLICES
    names = Names(NAME_BITS)

    def run(batches):
        counts = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        for b in batches:
            sets = [shingles(t) for t in b["text"]]
            for s in sets:
                counts[buckets(s)] += 1  # distinct shingles of one text that share a bucket count once, in every run alike
            some = [len(s) > 0 for s in sets]
            if max(map(len, sets), default=0) >> SIZE_BITS:
                raise ValueError(f"a text has {max(map(len, sets))} shingles")
            called = [names.both(s) if z else (None, None) for s, z in zip(sets, some)]
            yield {
                "doc_id": b["doc_id"],
                "n": [len(s) for s in sets],
                "key": [name for name, _ in called],
                "more": [more for _, more in called],
                "sig": [signature(s) if z else None for s, z in zip(sets, some)],
                "odd": [parity(s) if z else None for s, z in zip(sets, some)],
                "slice": [None] * len(sets),
                "counts": [None] * len(sets),
            }
        if counts.any():
            parts = [zlib.compress(counts[i * size : (i + 1) * size].astype("<u4").tobytes(), 1) for i in range(SLICES)]
            none = [None] * SLICES
            yield {"doc_id": none, "n": none, "key": none, "more": none, "sig": none, "odd": none, "slice": list(range(SLICES)), "counts": parts}

    rows = materialize(arrow_map(texts(docs), run, "doc_id long, n long, key long, more long, sig binary, odd array<long>, slice int, counts binary"), "shingled", keep=True)

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for k, raw in zip(b["slice"], b["counts"]):
                part = np.frombuffer(zlib.decompress(raw), dtype="<u4").astype(np.int64)
                totals[k] = totals[k] + part if k in totals else part
        if totals:
            yield {"slice": list(totals), "counts": [t.tobytes() for t in totals.values()]}

    counted = rows.filter("slice IS NOT NULL").select("slice", "counts").repartition(SLICES, "slice")
    total = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    for r in arrow_map(counted, add, "slice int, counts binary").collect():
        total[r.slice * size : (r.slice + 1) * size] += np.frombuffer(r.counts, dtype=np.int64)
    return rows.filter("slice IS NULL").drop("slice", "counts"), total


def common_from(counts: np.ndarray) -> int:
    """The bucket count from which a bucket holds a common shingle. It grows with the mean, so a corpus of any size has few such buckets."""
    return max(COMMON, COMMON_TIMES * int(counts.mean()))


def shared_entries(docs: DataFrame, counts: np.ndarray, names: Names) -> DataFrame:
    """Rows (token, key, n, pos) of prefixes, written: all whose shingle is in the prefixes of several classes, and few others."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(np.minimum(counts, 2**31 - 1).astype(np.int32))
    common_at = common_from(counts)

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            tokens, keys, places, common = [], [], [], []
            for t in b["text"]:
                s = shingles(t)
                if not len(s):
                    continue
                key = names.of(s)
                if key in seen:  # a copy in the same task
                    continue
                if len(seen) < 1_000_000:
                    seen.add(key)
                p, own = prefix(s, table.value)
                (at,) = np.nonzero(own > 1)  # a bucket counted once: no other text has it
                if len(at):
                    tokens.append(p[at].view(np.int64))
                    keys.append(np.full(len(at), key))
                    end = min(511, int(8 * np.log2(own[-1] + 1)))  # how common the prefix's last shingle is, roughly
                    places.append((end << (SIZE_BITS + PLACE_BITS)) + (len(s) << PLACE_BITS) + at)
                    common.append(own[at] >= common_at)
            if tokens:
                yield {"token": np.concatenate(tokens), "key": np.concatenate(keys), "place": np.concatenate(places), "common": np.concatenate(common)}

    def shared(batches):
        def put(t, k, p, keep):
            return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (t, k, p)], names=["token", "key", "place"])

        held = None  # the last row so far, and whether its token was there before
        for b in batches:
            t, k, p = (b.column(i).to_numpy() for i in range(3))
            if held is not None:
                t, k, p = (np.concatenate([h, x]) for h, x in zip(held[0], (t, k, p)))
            fresh = np.ones(len(t), dtype=bool)
            fresh[1:] = (t[1:] != t[:-1]) | (k[1:] != k[:-1])  # copies of a class follow each other
            t, k, p = t[fresh], k[fresh], p[fresh]
            same = t[1:] == t[:-1]
            keep = np.zeros(len(t), dtype=bool)
            keep[1:] |= same
            keep[:-1] |= same
            if held is not None:
                keep[0] |= held[1]
            if keep[:-1].any():
                yield put(t[:-1], k[:-1], p[:-1], keep[:-1])
            held = ((t[-1:], k[-1:], p[-1:]), bool(keep[-1]))
        if held is not None and held[1]:
            yield put(*held[0], np.ones(1, dtype=bool))

    entries = arrow_map(texts(docs), run, "token long, key long, place long, common boolean")
    narrow = "token long, key long, place long"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _batches_of(spark, 512):
        # both kinds leave the same pass: common ones are salted by class, so that no task meets all of a shingle
        salt = F.when(F.col("common"), F.pmod("key", F.lit(4096))).otherwise(F.lit(-1))
        dealt = entries.withColumn("salt", salt).repartition(n, "token", "salt").sortWithinPartitions("token", "key")
        rare = dealt.filter("salt < 0").select("token", "key", "place").mapInArrow(shared, narrow)
        common = dealt.filter("salt >= 0").select("token", "key", "place")
        out = materialize(rare.unionByName(common) if (counts >= common_at).any() else rare, "entries")
    size = F.shiftright("place", PLACE_BITS).bitwiseAND((1 << SIZE_BITS) - 1)
    place = F.col("place").bitwiseAND((1 << PLACE_BITS) - 1)
    return out.select("token", "key", size.alias("n"), place.alias("pos"), F.shiftright("place", SIZE_BITS + PLACE_BITS).cast("int").alias("end"))


def sets_of(docs: DataFrame, firsts: DataFrame, names: Names) -> DataFrame:
    """Rows (key, first, set), written, at least for the documents in firsts: found in a scan through a bitmap of fixed size."""
    spark = docs.sparkSession
    bits = np.zeros(1 << KEY_BITS >> 5, dtype="<u4")
    bit = firsts.select(F.pmod(F.col("first"), F.lit(1 << KEY_BITS)).alias("bit"))
    words = bit.groupBy(F.expr("bit >> 5").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 31 AS int)))").alias("bits"))
    for r in words.collect():  # at most 2 ** KEY_BITS / 32 rows
        bits[r["at"]] = r["bits"]
    packed = spark.sparkContext.broadcast(bits.tobytes())

    def run(batches):
        wanted = np.unpackbits(np.frombuffer(packed.value, dtype=np.uint8), bitorder="little").astype(bool)
        for b in batches:
            out = {"key": [], "first": [], "set": []}
            for doc_id, t in zip(b["doc_id"], b["text"]):
                s = shingles(t) if wanted[doc_id % (1 << KEY_BITS)] else ()
                if len(s):
                    out["key"].append(names.of(s))
                    out["first"].append(doc_id)
                    out["set"].append(s.tobytes())
            if out["key"]:
                yield out

    return materialize(arrow_map(texts(docs), run, "key long, first long, set binary"), "sets")


def _more_sets(docs: DataFrame, pairs: DataFrame, sets: DataFrame | None, names: Names) -> DataFrame:
    """sets with those that pairs need and that are not there yet; a scan only if there are any."""
    firsts = pairs.select(F.col("first_a").alias("first")).unionByName(pairs.select(F.col("first_b").alias("first"))).distinct()
    if sets is None:
        return sets_of(docs, firsts, names)
    new = materialize(firsts.join(sets.select("first").distinct(), "first", "left_anti"), "missing")
    if new.isEmpty():
        return sets
    # what the bitmap lets through by chance may be there already
    return sets.unionByName(sets_of(docs, new, names).join(new, "first", "left_semi"))


def _fits(x: str, y: str):
    """Length and positional filter for two entries of one token."""
    n = lambda s: F.col(f"{s}.n")
    p = lambda s: F.col(f"{s}.pos")
    length = F.least(n(x), n(y)) * 100 >= F.greatest(n(x), n(y)) * 80
    most = F.least(p(x), p(y)) + 1 + F.least(n(x) - p(x) - 1, n(y) - p(y) - 1)
    return length & (most * 9 >= (n(x) + n(y)) * 4)


def _bounds(entries: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (key, most, odd): most is the size without the prefix shingles that no other prefix holds."""
    held = entries.groupBy("key").agg(F.countDistinct("token").alias("held"))
    n = F.col("n")
    length = n - F.floor((8 * n + 9) / 10) + 1
    return classes.join(held, "key").select("key", (n - length + F.col("held")).cast("long").alias("most"), "odd")


def _close(x: str, y: str):
    """First shared shingle in both pair prefixes (every linked pair has one there), enough shingles left, few odd parts.

    A prefix shingle of x that no other prefix holds can only be in y behind the end of y's prefix; if x's prefix
    ends first in the shared order, it is not in y at all. So the intersection is at most the ``most`` of the one
    that ends first, or the larger one where the rough ends are the same.
    """
    both = F.col(f"{x}.n") + F.col(f"{y}.n")
    early = [(F.col(f"{s}.n") - F.col(f"{s}.pos")) * 9 >= both * 4 for s in (x, y)]
    apart = sum((F.bit_count(F.col(f"{x}.odd")[i].bitwiseXOR(F.col(f"{y}.odd")[i])) for i in range(LONGS)), F.lit(0))
    left = F.when(F.col(f"{x}.end") < F.col(f"{y}.end"), F.col(f"{x}.most")).when(F.col(f"{x}.end") > F.col(f"{y}.end"), F.col(f"{y}.most"))
    left = left.otherwise(F.greatest(f"{x}.most", f"{y}.most"))
    return early[0] & early[1] & (left * 9 >= both * 4) & ((both - apart) * 9 >= both * 8)  # (both - apart) / 2 bounds the intersection


def _with_components(entries: DataFrame, components: DataFrame | None) -> DataFrame:
    if components is None:
        return entries.withColumn("comp", F.col("key"))
    return entries.join(components, "key", "left").withColumn("comp", F.coalesce("comp", "key"))


def pivot_pairs(entries: DataFrame, components: DataFrame | None, turn: int) -> tuple[DataFrame, DataFrame]:
    """For each class, the pivot of another component that shares most of its prefix: pairs (a, b), a < b.

    Also the entries of the lists that have several components, written; components only merge, so others need no further look.
    """
    at = _with_components(entries, components)
    chance = F.xxhash64("key", F.lit(turn))
    # a near copy with few changes has few rare shingles before the shared ones: it is the one that most others are near to
    order = F.struct("pos", chance.alias("chance")) if turn == 0 else chance
    pivot = F.min_by(F.struct("key", "n", "pos", "comp"), order).alias("p")
    pivots = at.groupBy("token").agg(pivot, F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("token", "p")
    at = at.join(pivots, "token")
    if components is not None:  # before, every list has several
        at = materialize(at, "open_lists")
    met = at.filter("comp != p.comp").withColumn("x", F.struct("key", "n", "pos")).filter(_fits("x", "p"))
    met = met.groupBy(F.col("key"), F.col("p.key").alias("other")).agg(F.count("*").alias("c"))
    best = met.groupBy("key").agg(F.max_by("other", F.struct("c", "other")).alias("other"))
    pairs = best.select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).distinct()
    return pairs, entries if components is None else at.drop("p", "comp")


def crossing_pairs(entries: DataFrame, components: DataFrame | None, bounds: DataFrame) -> DataFrame:
    """All candidate pairs (a, b) between components.

    In a token's list, the entries outside its largest component meet all entries of other components; within the
    join, a pair must fit by length and place, its first shared shingle must lie in the prefix that the pair's own
    sizes need, and the parity bits must not differ too often.
    """
    at = _with_components(entries, components)
    sizes = at.groupBy("token", "comp").agg(F.count("*").alias("c"))
    lists = sizes.groupBy("token").agg(F.max_by("comp", F.struct("c", "comp")).alias("top"), F.count("*").alias("k")).filter("k > 1").select("token", "top")
    at = materialize(at.join(bounds, "key").join(lists, "token"), "crossing_lists")
    few, every = at.filter("comp != top").alias("x"), at.alias("y")
    met = few.join(every, F.col("x.token") == F.col("y.token")).filter(
        (F.col("x.comp") != F.col("y.comp")) & ((F.col("y.comp") == F.col("y.top")) | (F.col("x.key") < F.col("y.key"))) & _fits("x", "y") & _close("x", "y")
    )
    return met.select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()


def suffix_filter(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (a, first_a, b, first_b) without the pairs whose counts over the parts of the hash space differ too much."""
    side = lambda x: classes.select(*(F.col(c).alias(f"{c}_{x}" if c != "key" else x) for c in ("key", "first", "n", "sig")))

    def run(batches):
        for b in batches:
            x, y = (np.frombuffer(b"".join(b[k]), dtype="<u2").reshape(-1, PARTS).astype(np.int64) for k in ("sig_a", "sig_b"))
            total = np.array(b["n_a"]) + np.array(b["n_b"])
            most = (total - np.abs(x - y).sum(axis=1)) // 2  # of the intersection
            keep = most * 9 >= total * 4
            yield {k: np.array(b[k])[keep] for k in ("a", "first_a", "b", "first_b")}

    return arrow_map(pairs.join(side("a"), "a").join(side("b"), "b"), run, "a long, first_a long, b long, first_b long")


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (a, b, linked), written; each pair once, on the whole sets."""
    # only sets that a pair names are shuffled: found by a broadcast of at most 2 ** BUCKET_BITS slots
    slot = F.pmod(F.col("first"), F.lit(1 << BUCKET_BITS)).alias("slot")
    named = pairs.select(F.col("first_a").alias("first")).unionByName(pairs.select(F.col("first_b").alias("first"))).select(slot).distinct()
    sets = sets.withColumn("slot", slot).join(F.broadcast(named), "slot", "left_semi")
    side = lambda x, as_: sets.select(F.col("key").alias(x), F.col("first").alias(f"first_{x}"), F.col("set").alias(as_))

    def run(batches):
        for b in batches:
            linked = []
            for x, y in zip(b["x"], b["y"]):
                x, y = np.frombuffer(x, dtype=_U), np.frombuffer(y, dtype=_U)
                both = len(x) + len(y)
                shared = both - len(np.unique(np.concatenate([x, y])))
                linked.append(100 * shared >= 80 * (both - shared))
            yield {"a": b["a"], "b": b["b"], "linked": linked}

    met = pairs.join(side("a", "x"), ["a", "first_a"]).join(side("b", "y"), ["b", "first_b"]).select("a", "b", "x", "y")
    # a table that repeats an id and its text has the class's set twice
    return materialize(arrow_map(met, run, "a long, b long, linked boolean").distinct(), "verified", keep=True)


def components_of(links: DataFrame, before: DataFrame | None) -> DataFrame:
    """Rows (key, comp): comp is the smallest key that links reach. before: components so far, that links only merge."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if before is not None:
        named = before.select(F.col("key"), F.col("comp"))
        both = both.join(named.withColumnsRenamed({"key": "a", "comp": "ca"}), "a", "left").join(named.withColumnsRenamed({"key": "b", "comp": "cb"}), "b", "left")
        both = both.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).filter("a != b").distinct()
    both = materialize(both, "links")
    names = materialize(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.col("key")).alias("comp")), "labels")
    while True:
        of = lambda x, y: names.select(F.col("key").alias(x), F.col("comp").alias(y))
        near = both.join(of("b", "c"), "b").groupBy(F.col("a").alias("key")).agg(F.min("c").alias("c"))
        new = names.join(near, "key").select("key", F.least("comp", "c").alias("comp"), F.col("comp").alias("old"))
        new = new.join(of("comp", "up"), "comp", "left").select("key", F.least("comp", F.coalesce("up", "comp")).alias("comp"), "old")
        new = materialize(new, "labels")
        changed = new.filter("comp != old").limit(1).count()
        names = new.select("key", "comp")
        if not changed:
            break
    if before is None:
        return names
    merged = before.join(names.select(F.col("key").alias("comp"), F.col("comp").alias("to")), "comp", "left").select("key", F.coalesce("to", "comp").alias("comp"))
    fresh = names.join(before.select("key"), "key", "left_anti")
    return materialize(merged.unionByName(fresh), "components")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n, key, component_id) of all documents, and the verified pairs of classes (a, b, linked)."""
    with scratch(docs.sparkSession):
        docs = texts(docs, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
        rows, counts = document_rows(docs)
        rows, classes, names = classes_of(rows, NAME_BITS)
        entries = shared_entries(docs, counts, names)
        sets = components = done = None
        lists = entries
        for turn in range(PIVOT_ROUNDS + 1):
            if turn < PIVOT_ROUNDS:
                pairs, lists = pivot_pairs(lists, components, turn)
            else:
                pairs = crossing_pairs(lists, components, _bounds(entries, classes))
            if done is not None:
                pairs = pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")
            pairs = materialize(suffix_filter(pairs, classes), "pairs")
            sets = _more_sets(docs, pairs, sets, names)
            found = verify(pairs, sets)
            components = components_of(found.filter("linked"), components)
            done = found if done is None else done.unionByName(found)
        named = classes.join(components, "key").groupBy("comp").agg(F.min("first").alias("component_id"))
        named = components.join(named, "comp").select("key", "component_id")
        owner = materialize(classes.join(named, "key", "left").select("key", F.coalesce("component_id", "first").alias("component_id")), "owners", keep=True)
    out = rows.filter("n > 0").join(owner, "key").select("doc_id", "n", "key", "component_id")
    empty = rows.filter("n = 0").select("doc_id", "n", "key", F.col("doc_id").alias("component_id"))
    back = {c: F.nullif(F.col(c), F.lit(NO_ID)) for c in ("doc_id", "component_id")}
    return out.unionByName(empty).withColumns(back), done


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs that are the smallest id of their component, with all their columns; one row of each component.

    Where ids repeat or are null, rows are numbered and joined by their numbers, so a row never goes for
    another one that has its id.
    """
    ids = docs.groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("n"))
    away, rid = free_names(docs, "away", "rid")
    if not ids.filter("n > 1 OR id IS NULL").limit(1).count():
        members, _ = join(docs)
        gone = members.filter("doc_id != component_id").select(F.col("doc_id").alias(away))
        return docs.join(gone, docs["doc_id"] == F.col(away), "left_anti")
    numbered = materialize(docs.withColumn(rid, F.monotonically_increasing_id()), "numbered", keep=True)
    members, _ = join(numbered, id_col=rid)
    members = members.select(F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    ids = numbered.select(F.col(rid).alias("row"), "doc_id")
    first = members.join(ids, "row").groupBy("component").agg(F.min(F.struct("doc_id", "row")).alias("least"))
    return numbered.join(first.select(F.col("least.row").alias(rid)), rid, "left_semi").drop(rid)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = join(read_table(spark, sf_dir, "documents"))
    return members.select("doc_id", F.col("n").alias("n_shingles"), "component_id")

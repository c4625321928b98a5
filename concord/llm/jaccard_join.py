"""Exact n-gram Jaccard self-join by universe partition (operator 2).

Two texts link when the Jaccard similarity of their sets of five-word shingles
is at least 3/4. Sets are represented by 64-bit shingle hashes; equal sets are
one *class*. Linked sets of sizes l <= s differ in at most ``(l + s) // 7``
shingles.

Partition. Sizes fall into bands; a band splits the hash universe into a fixed
number of ranges, so a set splits into segments. A set emits the signatures of
its first ``need + spare`` non-empty segments, where ``need`` is one more than
the most differences with any partner: of the set whose emitted range is
shorter at least one segment has no difference (pigeonhole), and the partner
has emitted it too. A set close above a band edge also emits for the band below.

Signatures are grouped by one sort. Groups of at most ``GROUP`` classes give
all their pairs, with the number of shared segments, and a pair that shares
fewer than the pigeonhole bound is dropped before any text is read. Larger
groups give stars around the class that is in most large groups. Surviving
pairs are verified exactly, first one pair per class, then those whose ends are
still in different components.

Large groups that still span components are left to a second pass over only
the classes that have more such segments than spares: all their segments and
their one-deletion neighbourhoods are indexed, list sizes are counted, and
every probing class allots 0, 1 (equal segment) or 2 (one difference) to each
of its segments, cheapest units first, until the allotment reaches ``need``.
Rows carry a parity sketch of their set: sketches of two sets differ in no more
bits than the sets differ in shingles, so classes that meet but differ in too
many bits give no pair, and a family of texts just below the similarity is not
expanded.
So no group is ever expanded into all pairs and no link is lost.

Hashes: a collision inside one pair of documents has probability
|A| |B| / 2**64; candidates that collide otherwise are removed by verification.

Edge cases: null, empty and blank texts have no shingles and link with nothing;
fewer than five words are one shingle; equal texts are one class and always
linked; repeated ids are separate rows of one node; a row with a null id gets
its size and a null component; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.llm import kernels as K
from concord.llm.common import broadcast_if_small, components, table, written

WIDTH = 5
GROUP = 32
#: Lower edges of the size bands (four times wider each).
EDGES = np.array([1, *(64 * 4 ** k for k in range(14))], dtype=np.int64)
_WORDS = K.not_space()


def differences(l, s):
    """Most shingles in which linked sets of these sizes differ."""
    return (l + s) // 7


def band_of(n):
    return np.searchsorted(EDGES, n, side="right") - 1


def ranges_of(band, coarse: bool = False):
    """Ranges of the hash universe; 0 stands for one range per hash value."""
    hi = np.where(band >= len(EDGES) - 1, EDGES[-1] * 4, EDGES[np.minimum(band + 1,
                                                                         len(EDGES) - 1)])
    if coarse:
        wide = np.where(hi <= 256, hi // 2, hi // 4)
    else:
        wide = np.where(hi <= 256, hi, np.where(hi <= 1024, 3 * hi // 4, hi // 2))
    return np.where(band == 0, 0, wide)


def needed(n, lower):
    """One more than the differences with any partner; ``lower``: partners of the band below."""
    edge = EDGES[band_of(n)]
    return np.where(lower, differences(edge - 1, n), differences(n, 4 * n // 3)) + 1


def meets_lower(n):
    """Whether a set of this size has linked partners in the band below."""
    band = band_of(n)
    return (band > 0) & (-(-3 * n // 4) < EDGES[band])


def spare(n):
    """Segments emitted beyond ``needed``; sets of the first band have one gram to a segment."""
    return np.where(n < EDGES[1], np.minimum(2, n - needed(n, False)), 2 + n // 40)


def class_hash(grams: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return K.mix(np.add.reduceat(K.mix(grams, 31), starts) ^ K.mix(n.astype(K.U64), 32), 33)


def segments(grams, owner, n, lower: bool, coarse: bool = False):
    """(first gram of each segment, its owner, range, signature) of concatenated sorted sets."""
    band = band_of(n) - int(lower)
    m = ranges_of(band, coarse)[owner].astype(K.U64)
    at = np.where(m == 0, grams, ((grams >> K.U64(32)) * m) >> K.U64(32))
    new = np.ones(len(grams), bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    with np.errstate(over="ignore"):
        total = np.add.reduceat(K.mix(grams, 41), first)
    return first, owner[first], at[first], sign(total, at[first], band[owner[first]])


def sign(total, at, band):
    with np.errstate(over="ignore"):
        return K.mix(total + K.mix(at ^ K.mix(band.astype(K.U64), 43), 42), 44)


def emitted(grams, sizes):
    """(signature, owner) of the segments that each set emits."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out = []
    for lower in (False, True):
        take = meets_lower(sizes) if lower else sizes > 0
        if not take.any():
            continue
        rows = take[owner]
        g, who = grams[rows], owner[rows]
        first, who, _, sig = segments(g, who, sizes, lower)
        begin = np.searchsorted(who, np.arange(len(sizes)))
        rank = np.arange(len(who)) - begin[who]
        have = np.bincount(who, minlength=len(sizes))
        count = needed(sizes, lower) + spare(sizes)
        if (have[take] < count[take]).any():  # far beyond ten standard deviations
            raise RuntimeError("a set fell into too few hash ranges")
        keep = rank < count[who]
        out.append((sig[keep], who[keep]))
    if not out:
        return np.zeros(0, K.U64), np.zeros(0, np.int64)
    return np.concatenate([s for s, _ in out]), np.concatenate([w for _, w in out])


def concatenated(sets: list[np.ndarray]):
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if len(sets) else np.zeros(0, K.U64)), sizes


def class_of(grams, sizes):
    cls = np.zeros(len(sizes), K.U64)
    full = sizes > 0
    starts = (np.cumsum(sizes) - sizes)[full]
    if len(starts):
        cls[full] = class_hash(grams, starts, sizes[full])
    return cls


def signature_rows(docs: DataFrame) -> DataFrame:
    """(sig, cls, n): signatures, and one row with sig = id, n = -1 - size per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            data, off = K.byte_column(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in K.pieces(off):
                grams, sizes = concatenated(list(K.shingle_sets(data, off[i:j + 1], _WORDS, WIDTH)))
                cls = class_of(grams, sizes)
                fresh = np.zeros(len(sizes), bool)
                for k, c in enumerate(cls.tolist()):
                    if sizes[k] and c not in seen:
                        seen.add(c)
                        fresh[k] = True
                owner = np.repeat(np.arange(len(sizes)), sizes)
                sig, who = emitted(grams[fresh[owner]], np.where(fresh, sizes, 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate((ids[i:j].astype(np.int64), K.signed(sig)))),
                     pa.array(K.signed(np.concatenate((cls, cls[who])))),
                     pa.array(np.concatenate((-1 - sizes, sizes[who])).astype(np.int32))],
                    names=["sig", "cls", "n"])

    return docs.mapInArrow(run, "sig long, cls long, n int")


#: Kinds of rows that the grouping gives.
DOCUMENT, PAIR, LARGE = 0, 1, 2
GROUPED = "kind int, a long, b long, na int, nb int, x long"


def _pair_rows(kind, a, b, na, nb, x):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b),
         pa.array(na.astype(np.int32)), pa.array(nb.astype(np.int32)),
         pa.array(np.asarray(x, np.int64))], names=["kind", "a", "b", "na", "nb", "x"])


def least_shared(l, s):
    """Segments that linked sets of these sizes share at least (pigeonhole)."""
    cross = band_of(l) != band_of(s)
    need = np.where(cross, np.minimum(needed(l, False), needed(s, True)), needed(l, False))
    return need - differences(l, s)


def least_shared_sql(l: str, s: str):  # noqa: E741
    """``least_shared`` of two columns."""
    def edge(n):
        return "CASE " + " ".join(f"WHEN {n} >= {e} THEN {e}L" for e in EDGES[::-1]) + " END"

    need = f"(({l} + 4 * {l} div 3) div 7 + 1)"
    lower = f"(({edge(s)} - 1 + {s}) div 7 + 1)"
    return F.expr(f"IF({edge(l)} <> {edge(s)}, least({need}, {lower}), {need}) "
                  f"- ({l} + {s}) div 7")


def pairs_with_enough(pairs: DataFrame, large: DataFrame) -> DataFrame:
    """The pairs whose equal segments, those in common large groups included, reach the bound."""
    lists = large.groupBy("cls").agg(F.collect_set("sig").alias("s"))  # bounded by set sizes
    la = lists.select(F.col("cls").alias("a"), F.col("s").alias("sa"))
    lb = lists.select(F.col("cls").alias("b"), F.col("s").alias("sb"))
    common = F.coalesce(F.size(F.array_intersect("sa", "sb")), F.lit(0))
    return (pairs.join(la, "a", "left").join(lb, "b", "left")
            .withColumn("common", F.when(F.col("sa").isNull() | F.col("sb").isNull(), 0)
                        .otherwise(common))
            .filter(F.col("shared") + F.col("common") >= least_shared_sql("na", "nb"))
            .select("a", "b", "shared"))


def stars(large: DataFrame, group: list[str], rank: list[str]) -> DataFrame:
    """(a, b, shared): members of large groups with the highest of each group.

    ``shared`` counts the groups in which the pair meets; pairs that show fewer
    than the pigeonhole bound are left to the second pass.
    """
    ranked = large.withColumn("rank", F.struct(*rank, "cls", "n"))
    top = ranked.groupBy(*group).agg(F.max("rank").alias("top")).select(
        *group, F.col("top.cls").alias("p"), F.col("top.n").alias("np"))
    met = ranked.join(top, group).filter("cls <> p AND 4 * least(n, np) >= 3 * greatest(n, np)")
    first = (F.col("n") < F.col("np")) | ((F.col("n") == F.col("np")) & (F.col("cls") < F.col("p")))
    pair = met.select(F.when(first, F.col("cls")).otherwise(F.col("p")).alias("a"),
                      F.when(first, F.col("p")).otherwise(F.col("cls")).alias("b"),
                      F.least("n", "np").alias("na"), F.greatest("n", "np").alias("nb"))
    return (pair.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("shared"))
            .filter(F.col("shared") >= least_shared_sql("na", "nb")).select("a", "b", "shared"))


class Grouper:
    """Turns rows sorted by (sig, n, cls) into pairs, with bounded memory."""

    HOLD = 4096

    def __init__(self, group: int):
        self.group = group
        self.held = tuple(np.zeros(0, np.int64) for _ in range(3))
        self.open = None  # a large group of which members went out
        self.pairs: list[tuple] = []
        self.size = 0

    def small(self, sig, n, cls):
        """All pairs of groups of at most ``group`` rows."""
        for d in range(1, self.group):
            if len(sig) <= d:
                return
            i = np.flatnonzero(sig[d:] == sig[:-d])
            if not len(i):
                return
            ok = 4 * n[i] >= 3 * n[i + d]
            i = i[ok]
            self.pairs.append((cls[i], cls[i + d], n[i], n[i + d]))
            self.size += len(i)

    def members(self, sig, n, cls):
        """The classes of one large group."""
        self.open = sig[0]
        yield _pair_rows(LARGE, cls, sig, n, n, np.zeros(len(n)))

    def flush(self):
        if not self.pairs:
            return
        a, b, na, nb = (np.concatenate(x) for x in zip(*self.pairs, strict=True))
        self.pairs, self.size = [], 0
        order = np.lexsort((b, a))
        a, b, na, nb = a[order], b[order], na[order], nb[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        at = np.flatnonzero(new)
        yield _pair_rows(PAIR, a[at], b[at], na[at], nb[at], np.diff(np.append(at, len(a))))

    def add(self, sig, n, cls, last: bool):
        sig, n, cls = (np.concatenate(x) for x in zip(self.held, (sig, n, cls), strict=True))
        if len(sig):
            same = np.ones(len(sig), bool)
            same[1:] = (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1])
            sig, n, cls = sig[same], n[same], cls[same]
        others = np.flatnonzero(sig != sig[-1]) if len(sig) else sig
        cut = len(sig) if last else int(others[-1]) + 1 if len(others) else 0
        done, self.held = (sig[:cut], n[:cut], cls[:cut]), (sig[cut:], n[cut:], cls[cut:])
        if cut:
            yield from self.groups(*done)
        if len(self.held[0]) > self.HOLD:
            yield from self.members(*self.held)
            self.held = tuple(x[-1:] for x in self.held)  # only to tell repeats
        if self.size > 1 << 18 or last:
            yield from self.flush()

    def groups(self, sig, n, cls):
        at = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        count = np.diff(np.append(at, len(sig)))
        large = count > self.group
        if self.open is not None and self.open == sig[0]:
            large[0] = True
        row = np.repeat(large, count)
        some = ~row & (np.repeat(count, count) > 1)
        self.small(sig[some], n[some], cls[some])
        for k in np.flatnonzero(large):
            s = slice(at[k], at[k] + count[k])
            yield from self.members(sig[s], n[s], cls[s])


def grouped(signatures: DataFrame, group: int = GROUP) -> DataFrame:
    """Pairs with their shared segments, members of large groups, and the documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Grouper(group)
        for batch in batches:
            sig, cls, n = (batch.column(k).to_numpy().astype(np.int64) for k in range(3))
            doc = n < 0
            if doc.any():
                z = -1 - n[doc]
                yield _pair_rows(DOCUMENT, sig[doc], cls[doc], z, z, np.zeros(len(z)))
            yield from state.add(sig[~doc], n[~doc], cls[~doc], False)
        none = np.zeros(0, np.int64)
        yield from state.add(none, none, none, True)

    rows = signatures.repartition("sig").sortWithinPartitions("sig", "n", "cls")
    return rows.mapInArrow(run, GROUPED)


def _of_classes(docs: DataFrame, members: DataFrame, classes: DataFrame, name: str,
                values) -> DataFrame:
    """(cls, n, name) of the given classes, from the documents with one id of each;
    ``values`` gives (sizes, all numbers) of the column of the sets."""
    carriers = (members.join(classes, "cls", "left_semi").groupBy("cls")
                .agg(F.min("doc_id").alias("id")).select("id").distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = K.byte_column(batch.column(1))
            for i, j in K.pieces(off):
                grams, sizes = concatenated(list(K.shingle_sets(data, off[i:j + 1], _WORDS, WIDTH)))
                count, numbers = values(grams, sizes)
                bounds = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(K.signed(class_of(grams, sizes))), pa.array(sizes.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(K.signed(numbers)))],
                    names=["cls", "n", name])

    found = docs.join(broadcast_if_small(carriers.withColumnRenamed("id", "doc_id")), "doc_id",
                      "left_semi")
    return found.mapInArrow(run, f"cls long, n int, {name} array<long>")


def sets_of(docs: DataFrame, members: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, n, grams) of the given classes."""
    return written(_of_classes(docs, members, classes, "grams", lambda grams, sizes: (sizes, grams)),
                   "sets")


def parities(grams, sizes):
    """(numbers of 64 bits, all of them) of the parity sketches of the sets: as many bits as the
    power of two from twice the size on, 64 at least. The lowest bits of a gram's place are
    those of its place in a narrower sketch."""
    bits = np.left_shift(1, np.ceil(np.log2(np.maximum(2 * sizes, 64))).astype(np.int64))
    count = np.where(sizes > 0, bits // 64, 0)
    begin = (np.cumsum(count) - count) * 64
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = begin[owner] + (K.mix(grams, 61) & (bits[owner] - 1).astype(K.U64)).astype(np.int64)
    odd = np.bincount(place, minlength=64 * int(count.sum())) & 1
    return count, np.packbits(odd.astype(np.uint8), bitorder="little").view(K.U64)


def bits_apart(a: str, b: str) -> str:
    """SQL for the bits in which two parity sketches differ, the wider one folded."""
    def folded(x, y):
        return (f"transform(sequence(1, least(size({x}), size({y}))), k -> aggregate("
                f"sequence(k, size({x}), least(size({x}), size({y}))), 0L, "
                f"(acc, j) -> acc ^ {x}[j - 1]))")

    return (f"aggregate(zip_with({folded(a, b)}, {folded(b, a)}, (x, y) -> bit_count(x ^ y)), 0, "
            "(acc, d) -> acc + d)")


def plausible(pairs: DataFrame, docs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs (a, b, and more columns) whose parity sketches differ in no more bits than
    linked sets differ in shingles; no set is moved for the others."""
    classes = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sketched = written(_of_classes(docs, members, classes, "sketch", parities).dropDuplicates(["cls"]),
                       "sketches")
    columns = pairs.columns
    for c in ("a", "b"):
        pairs = pairs.join(sketched.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"),
                                           F.col("sketch").alias(f"s{c}")), c)
    near = pairs.filter(F.expr(f"{bits_apart('sa', 'sb')} <= (na + nb) div 7"))
    return written(near.select(*columns), "plausible")


#: Sets of one side of a cell when many pairs among few sets are verified.
CELL_SETS = 2000


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that reach the similarity, by exact intersection.

    Sets travel either with their pairs (two joins), or, where pairs are many and
    sets few, to the cells of a grid over (a, b): each set once per row and column.
    Each join moves only the sets that are on its side of a pair; up to a counted bound the
    pairs go to the sets of the first side, so these move once, with their pairs.
    """
    pairs = written(pairs.select("a", "b").distinct(), "tested")
    n = sets.count()
    side = -(-n // CELL_SETS)
    if pairs.count() > 2 * n * side > 0:
        return _linked_in_cells(pairs, sets, side)

    def ends_of(c: str) -> DataFrame:
        ends = broadcast_if_small(pairs.select(F.col(c).alias("cls")).distinct())
        return sets.join(ends, "cls", "left_semi").select(F.col("cls").alias(c),
                                                          F.col("grams").alias(f"g{c}"))

    left, right = ends_of("a"), ends_of("b")
    both = F.size(F.array_intersect("ga", "gb"))
    union = F.size("ga") + F.size("gb") - both
    return (broadcast_if_small(pairs).join(left, "a").join(right, "b")
            .filter(100 * both >= 75 * union).select("a", "b"))


def _linked_in_cells(pairs: DataFrame, sets: DataFrame, side: int) -> DataFrame:
    """A task holds the sets of one cell (at most some ``CELL_SETS`` a side) and streams
    the cell's pairs past them."""
    part = lambda c: F.pmod(F.hash(c), F.lit(side))
    cell = lambda x, y: (x * side + y).cast("int").alias("cell")
    all_ = F.sequence(F.lit(0), F.lit(side - 1))
    none = F.lit(None).cast("array<long>")
    rows = sets.select(F.explode(all_).alias("k"), "cls", "grams")
    by_row = rows.select(cell(part("cls"), F.col("k")), F.col("cls").alias("a"),
                         F.lit(None).cast("long").alias("b"), "grams")
    by_column = rows.select(cell(F.col("k"), part("cls")), F.col("cls").alias("a"),
                            F.lit(None).cast("long").alias("b"), "grams")
    tested = pairs.select(cell(part("a"), part("b")), "a", "b", none.alias("grams"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, {}
        for batch in batches:
            cells, a, b = (batch.column(k).to_pylist() for k in range(3))
            grams = batch.column(3)
            out = []
            for k, (c, x, y) in enumerate(zip(cells, a, b, strict=True)):
                if c != at:
                    at, held = c, {}
                if y is None:
                    held[x] = grams[k].values.to_numpy()
                    continue
                ga, gb = held[x], held[y]
                both = len(np.intersect1d(ga, gb, assume_unique=True))
                if 100 * both >= 75 * (len(ga) + len(gb) - both):
                    out.append((x, y))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return (by_row.unionByName(by_column).unionByName(tested)
            .repartition(side * side, "cell").sortWithinPartitions("cell", F.col("b").isNotNull())
            .mapInArrow(run, "a long, b long"))


def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are not yet in one component."""
    la = labels.select(F.col("v").alias("a"), F.col("label").alias("la"))
    lb = labels.select(F.col("v").alias("b"), F.col("label").alias("lb"))
    return (pairs.join(la, "a", "left").join(lb, "b", "left")
            .filter(F.coalesce("la", "a") != F.coalesce("lb", "b")).drop("la", "lb"))


#: Columns of a parity sketch, 64 bits each.
SKETCH = ("s0", "s1", "s2", "s3")


def sketches(grams, sizes):
    """Parity of the number of grams that fall on each of 256 bits, for each set."""
    bit = K.mix(grams, 61) >> K.U64(56)
    start = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.zeros((len(SKETCH), len(sizes)), K.U64)
    for k in range(len(SKETCH) if len(start) else 0):
        own = np.where(bit >> K.U64(6) == k, K.U64(1) << (bit & K.U64(63)), K.U64(0))
        out[k, sizes > 0] = np.bitwise_xor.reduceat(own, start)
    return K.signed(out)


#: Grams that the second pass turns into rows at once.
PIECE_GRAMS = 100_000


def second_pass_rows(sets: DataFrame) -> DataFrame:
    """All segments (unit 1) and their one-deletion neighbourhoods (unit 2) of the sets.

    ``sets`` are (cls, grams, extent, label); the last two are carried along, as are
    the sketch of the set and the number of all its units.
    """
    def piece(cls, extent, label, sizes, grams, lower):
        take = meets_lower(sizes) if lower else sizes > 0
        owner = np.repeat(np.arange(len(sizes)), sizes)
        rows = take[owner]
        g, who_g = grams[rows], owner[rows]
        if not len(g):
            return None
        first, who, at, sig = segments(g, who_g, sizes, lower, coarse=True)
        count = np.diff(np.append(first, len(g)))
        band = band_of(sizes)[who] - int(lower)
        with np.errstate(over="ignore"):
            mixed = K.mix(g, 41)
            seg = np.repeat(np.arange(len(first)), count)
            rest = np.repeat(np.add.reduceat(mixed, first), count) - mixed
        many = count[seg] > 1
        index = np.concatenate((np.arange(len(first)), seg[many]))
        who = who[index]
        unit = np.concatenate((np.ones(len(first)), np.full(many.sum(), 2))).astype(np.int32)
        units = np.bincount(who[:len(first)], 1 + (count > 1), len(sizes)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(K.signed(np.concatenate((sig, sign(rest, at[seg], band[seg])[many])))),
             pa.array(cls[who]), pa.array(sizes[who].astype(np.int32)), pa.array(unit),
             pa.array(K.signed(K.mix(at[index] ^ K.U64(int(lower)), 51))),
             pa.array(count[index].astype(np.int32)), pa.array(np.full(len(index), lower)),
             pa.array(units[who]), pa.array(extent[who]), pa.array(label[who]),
             *(pa.array(s[who]) for s in sketches(grams, sizes))],
            names=["sig", "cls", "n", "unit", "seg", "size", "lower", "units", "extent", "label",
                   *SKETCH])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = batch.column(1).offsets.to_numpy().astype(np.int64)
            grams = batch.column(1).values.to_numpy().view(K.U64)
            cls, extent, label = (batch.column(k).to_numpy() for k in (0, 2, 3))
            for i, j in K.pieces(bounds, PIECE_GRAMS):
                for lower in (False, True):
                    out = piece(cls[i:j], extent[i:j], label[i:j], np.diff(bounds[i:j + 1]),
                                grams[bounds[i]:bounds[j]], lower)
                    if out is not None:
                        yield out

    return sets.select("cls", "grams", "extent", "label").mapInArrow(
        run, "sig long, cls long, n int, unit int, seg long, size int, lower boolean, "
             "units int, extent long, label long, " + ", ".join(f"{s} long" for s in SKETCH))


def meeting(sets: DataFrame) -> DataFrame:
    """(sig, equal, less): signatures by which rows of the second pass meet, and their rows of
    unit 1 and 2. Rows of unit 2 meet each other by no signature."""
    return (second_pass_rows(sets).groupBy("sig").agg(
        F.sum((F.col("unit") == 1).cast("long")).alias("equal"),
        F.sum((F.col("unit") == 2).cast("long")).alias("less"))
        .filter("equal > 0 AND equal + less > 1"))


def second_pass(sets: DataFrame, probing: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of the probing classes by cost-based allotment.

    The units of a class (1: equal segment, 2: one difference) are ranked by the
    number of indexed rows they meet. A partner is only met through the first
    ``differences + 1`` units, by the sizes of the two; a unit 2 ranks after its
    unit 1. Segments of which no row meets another come first: they cost nothing, so
    they are only counted and not moved on. Of two classes the one in the smaller component
    (extent, label) probes.
    Pairs whose sketches differ in more bits than the sets may in shingles are left out.
    """
    mine = second_pass_rows(sets.join(probing, "cls", "left_semi"))
    is_segment = F.col("unit") == 1
    by_class = mine.join(meeting(sets), "sig").repartition("cls")
    traits = ["extent", "label", *SKETCH]
    cost = by_class.groupBy("cls", "n", "lower", "seg", "size", "units").agg(
        F.coalesce(F.sum(F.when(is_segment, F.col("equal"))), F.lit(1)).alias("one"),
        (F.sum(F.when(is_segment, F.col("equal") + F.col("less")).otherwise(F.col("equal")))
         + F.when(F.min("unit") == 1, 0).otherwise(1)).alias("two"),
        F.collect_list(F.struct("sig", "unit")).alias("rows"),  # bounded by the segment's size
        *(F.first(c).alias(c) for c in traits))
    unit_costs = F.when(F.col("size") > 1, F.array("one", F.greatest("one", F.col("two")
                                                                      - F.col("one"))))
    units = cost.select(*cost.columns, F.posexplode(unit_costs.otherwise(F.array("one")))
                        .alias("u", "cost"))
    whole = Window.partitionBy("cls", "lower")
    rank = F.row_number().over(whole.orderBy("cost", "u", "seg"))
    most = F.expr("(n + 4 * n div 3) div 7 + 1")  # differences to any partner, and one
    allotted = (units.withColumn("r", F.col("units") - F.count("*").over(whole) + rank)
                .filter(F.col("r") <= most))
    ranks = allotted.groupBy("cls", "n", "lower", "seg").agg(
        F.min("r").alias("r1"), F.max(F.when(F.col("u") == 1, F.col("r"))).alias("r2"),
        *(F.first(c).alias(c) for c in ("rows", *traits)))
    probe = (ranks.select("*", F.explode("rows").alias("row"))
             .filter("row.unit = 1 OR r2 IS NOT NULL")
             .select(F.col("row.sig").alias("sig"), F.col("cls").alias("p"),
                     F.col("n").alias("np"), F.col("row.unit").alias("up"), "r1", "r2",
                     F.struct("extent", "label").alias("rp"),
                     *(F.col(s).alias(f"p{s}") for s in SKETCH)))
    index = second_pass_rows(sets).select(
        "sig", F.col("cls").alias("i"), F.col("n").alias("ni"), F.col("unit").alias("ui"),
        F.struct("extent", "label").alias("ri"), *(F.col(s).alias(f"i{s}") for s in SKETCH))
    apart = " + ".join(f"bit_count(p{s} ^ i{s})" for s in SKETCH)
    met = ((probe["sig"] == index["sig"]) & F.expr("rp < ri")
           & F.expr("4 * least(np, ni) >= 3 * greatest(np, ni)")
           & F.expr("up + ui <= 3 AND IF(up + ui = 2, r1, r2) <= (np + ni) div 7 + 1")
           & F.expr(f"{apart} <= (np + ni) div 7"))
    return (probe.join(index, met)
            .select(F.least("p", "i").alias("a"), F.greatest("p", "i").alias("b")).distinct())


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         group: int = GROUP) -> DataFrame:
    """doc_id, n_shingles, cls (equal sets have equal values), component_id of each document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    known = rows.filter("doc_id IS NOT NULL")
    g = written(grouped(signature_rows(known), group), "groups")
    members = (g.filter(F.col("kind") == DOCUMENT)
               .select(F.col("a").alias("doc_id"), F.col("b").alias("cls"), F.col("na").alias("n")))
    large = g.filter(F.col("kind") == LARGE).select(
        F.col("a").alias("cls"), F.col("na").alias("n"), F.col("b").alias("sig"))
    held = large.groupBy("cls").agg(F.count("*").alias("held"))

    # equal segments are those of small groups and at most those held back in large ones
    unseen = F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0)))
    pairs = (g.filter(F.col("kind") == PAIR).groupBy("a", "b", "na", "nb")
             .agg(F.sum("x").alias("shared"))
             .join(held.select(F.col("cls").alias("a"), F.col("held").alias("ha")), "a", "left")
             .join(held.select(F.col("cls").alias("b"), F.col("held").alias("hb")), "b", "left")
             .filter(F.col("shared") + unseen >= least_shared_sql("na", "nb"))
             .select("a", "b", "na", "nb", "shared"))
    pairs = pairs_with_enough(pairs, large)
    # the most central class of a large group and size step: it is in most large groups
    large = written(large.join(held, "cls"), "large")
    step = F.floor(F.log("n") / F.log(F.lit(1.2)))
    hubs = stars(large.withColumn("step", step), ["sig", "step"], ["held"])
    pairs = plausible(written(pairs.unionByName(hubs), "pairs"), known, members)
    classes = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = sets_of(known, members, classes)
    best = pairs.groupBy("b").agg(F.max_by("a", "shared").alias("a")).select("a", "b")
    links = written(linked(best, sets), "links")
    labels = components(links)
    more = written(linked(across(pairs, labels), sets), "links")
    if more.limit(1).count():
        links = written(links.union(more), "links")
        labels = components(links)
    return _result(rows, members, _finish_large(known, members, large, links, labels))


def _open(large: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of large groups that span components, with their component and its extent."""
    extent = labels.groupBy("label").count().withColumnRenamed("count", "extent")
    tagged = (large.join(labels.withColumnRenamed("v", "cls"), "cls", "left")
              .withColumn("label", F.coalesce("label", "cls")))
    spanning = (tagged.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
                .filter("lo <> hi").select("sig"))
    return written(tagged.join(spanning, "sig", "left_semi").join(extent, "label", "left")
                   .select("cls", "n", "sig", "held", "label",
                           F.coalesce("extent", F.lit(1)).alias("extent")), "open")


#: More open segments than any spares of the smaller end of a pair (sizes differ by 3/4 at most).
LOST = "count >= IF(n < 6, 1, 3 + (3 * n div 4) div 40)"


def _hubs(docs, members, left, labels) -> DataFrame:
    """Links to the class of the widest component in each open group."""
    hubs = written(across(stars(left, ["sig"], ["extent", "held"]), labels), "pairs")
    hubs = plausible(hubs, docs, members)
    ends = hubs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    return linked(hubs, sets_of(docs, members, ends))


def _probed(docs, members, left, labels) -> DataFrame | None:
    """Links found by the second pass.

    Of a pair in two components the class in the smaller one probes (ties: by
    label), so the bulk of a family of copies never does. A pair is lost only if
    all segments it shares are open, more than the spares of the smaller end;
    so a lost partner has fitting size and shares as many with probing classes.
    """
    sized = left.withColumn("rank", F.struct("extent", "label"))
    top = sized.groupBy("sig").agg(F.max("rank").alias("top"))
    probing = (sized.join(top, "sig").filter("rank < top").groupBy("cls", "n").count()
               .filter(LOST).select("cls"))
    probing = written(probing, "probing")
    if probing.limit(1).count() == 0:
        return None
    sizes = (left.join(probing, "cls", "left_semi").groupBy("sig")
             .agg(F.min("n").alias("lo"), F.max("n").alias("hi")))
    touched = (left.join(sizes, "sig").filter("4 * n >= 3 * lo AND 3 * n <= 4 * hi")
               .groupBy("cls", "n").count().filter(LOST).select("cls"))
    sets = sets_of(docs, members, written(touched, "touched")).join(
        left.select("cls", "extent", "label").distinct(), "cls")
    return linked(written(across(second_pass(sets, probing), labels), "pairs"), sets)


def _finish_large(docs, members, large, links, labels) -> DataFrame:
    """Component labels after large groups that span components are searched, too."""
    for search in (_hubs, _probed):
        left = _open(large, labels)
        found = search(docs, members, left, labels) if left.limit(1).count() else None
        if found is None:
            return labels
        found = written(found, "links")
        if found.limit(1).count():
            links = written(links.union(found), "links")
            labels = components(links)
    return labels


def _result(rows, members, labels) -> DataFrame:
    classes = members.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    named = (classes.join(labels.withColumnRenamed("v", "cls"), "cls", "left")
             .withColumn("label", F.coalesce("label", "cls")))
    roots = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of_class = named.join(roots, "label").select("cls", "component_id")
    main = (members.join(of_class, "cls", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"), "cls",
                    F.coalesce("component_id", "doc_id").alias("component_id")))
    nameless = (rows.filter("doc_id IS NULL")
                .mapInArrow(_sizes_only, "doc_id long, n_shingles long, cls long")
                .withColumn("component_id", F.lit(None).cast("long")))
    return main.unionByName(nameless)


def _sizes_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = K.byte_column(batch.column(1))
        for i, j in K.pieces(off):
            grams, sizes = concatenated(list(K.shingle_sets(data, off[i:j + 1], _WORDS, WIDTH)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(sizes),
                 pa.array(K.signed(class_of(grams, sizes)))], names=["doc_id", "n_shingles", "cls"])


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and component of every row of ``documents``."""
    return join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")

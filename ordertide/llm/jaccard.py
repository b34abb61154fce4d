"""N-gram Jaccard join: an exact metric-space join of documents' shingle sets.

Jaccard distance is a metric. Its pivots here are of two kinds.

Level 0: every shingle is a pivot, the set of it alone. A set's nearest pivots are
its own shingles, all equally near, and a fixed order of pivots (rare ones first)
breaks the tie: the first one names the set's Voronoi region. Two sets within the
threshold share a pivot among their first n - ceil(t * n) + 1, so a set is
replicated to the regions of those, its boundary window, and no others. Distance
to the empty set gives a second window: linked sets' sizes differ by t at most,
and what both hold from the shared pivot on must cover the overlap they need.

Level 1: in each region the set with the fewest rarer shingles, which is nearest to
its middle, becomes a pivot (some more in large regions), and every set's distance
to it is computed exactly. Sets within the threshold of a pivot fall to its Voronoi
cell and are linked. A group of near copies so costs one comparison a set and
pivot, not one a pair.

Level 2: regions that still hold several components join again, exactly. A region of
many sets is dealt into blocks, and each pair of blocks is a cell of bounded size. In
a cell two sets of different components become a pair only if their distances to the
region's pivot differ by no more than the threshold (triangle inequality), the size
windows hold, and their sketches, which lie in a metric space of their own that never
puts sets further apart than they are, differ in few enough bits. Pairs that are left
are compared exactly.

Equal sets are one point from the start. The order of pivots comes from a count
of all shingles of all documents in 2**20 counters; it decides costs, not results.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm import grams
from ordertide.llm.arrow import arrow_schema, record_batch
from ordertide.llm.components import components
from ordertide.session import checkpoint_dir

COUNTERS = 20
COUNT_BLOCKS = 16
BLOCK_CHARS = 250_000
#: Bytes of an Arrow batch at most (or one row), and rows of it whose texts and sets a task holds as objects.
BATCH_BYTES, BATCH_ROWS = 8_000_000, 500
#: Sets of a region that are pivots for all its sets, and for those after the first MANY in hash order.
PIVOTS, MORE_PIVOTS, MANY = 1, 3, 64
#: Sets of a cell in which sets that aren't connected meet each other.
CELL_ROWS = 20_000


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (batch.slice(a, BATCH_ROWS) for a in range(0, batch.num_rows, BATCH_ROWS))


@contextmanager
def _small_batches(spark: SparkSession):
    """Arrow batches of jobs that run inside are bounded in bytes: texts of thousands of
    rows, twice a row when pairs are compared, would lie in JVM and Python memory at once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's runs of ``words`` words (A-Z taken
    as a-z); of all its words if there are fewer; none without words."""
    out = []
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    for a, b in grams.blocks([len(t) for t in data], BLOCK_CHARS):
        units, counts = grams.words_of(data[a:b], grams.LOWER)
        runs = grams.run_hashes(units, words)
        end = np.cumsum(counts)
        start = end - counts
        short = np.flatnonzero((counts > 0) & (counts < words))
        whole = dict(zip(short.tolist(), grams.span_hashes(units, start[short], end[short]), strict=True))
        for i, (s, n) in enumerate(zip(start.tolist(), counts.tolist(), strict=True)):
            out.append(np.unique(runs[s:s + n - words + 1]) if n >= words else
                       np.array([whole[i]] if n else [], np.uint64))
    return out


def _point(s: np.ndarray) -> int:
    """A set's identity: a signed 64-bit hash of its shingles in any order, and its size."""
    h = grams.mixed(s + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(s))
    return int(grams.mixed(np.array([h]))[0].astype(np.int64))


POINTS = "block int, counts binary, row long, doc_id long, text_hash long, point long, n long"


def _points(words: int):
    """A row for each document, and the task's shingle counts in COUNT_BLOCKS rows."""
    def run(batches):
        schema, counts = arrow_schema(POINTS), np.zeros(1 << COUNTERS, np.uint32)
        for batch in (part for whole in batches for part in _slices(whole)):
            rows, ids, hashes, texts = batch.columns
            sets = shingle_sets(texts.to_pylist(), words)
            some = np.concatenate([np.zeros(0, np.uint64), *sets])
            counts += np.bincount((some >> np.uint64(64 - COUNTERS)).astype(np.int64), minlength=1 << COUNTERS).astype(np.uint32)
            none = [None] * len(sets)
            yield record_batch([none, none, rows, ids, hashes, [_point(s) for s in sets], [len(s) for s in sets]], schema)
        if counts.any():
            none = [None] * COUNT_BLOCKS
            yield record_batch([range(COUNT_BLOCKS), [_packed(c) for c in np.split(counts, COUNT_BLOCKS)], none, none, none, none, none], schema)
    return run


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<u8").tobytes(), 1)


def _add_counts(batches):
    """Sums of one task's blocks: at most COUNT_BLOCKS rows whatever comes in."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            c = np.frombuffer(zlib.decompress(counts), "<u8")
            total[block] = total[block] + c if block in total else c
    yield record_batch([list(total), [_packed(c) for c in total.values()]], arrow_schema("block int, counts binary"))


def _commonness(points: DataFrame) -> np.ndarray:
    """For each counter a number that grows with the logarithm of its count; 1 MB for any input."""
    sums = points.where("block is not null").select("block", "counts").repartition(COUNT_BLOCKS, "block")
    sums = sums.mapInArrow(_add_counts, "block int, counts binary")
    counts = np.zeros(1 << COUNTERS, np.uint64)
    parts = counts.reshape(COUNT_BLOCKS, -1)
    for block, c in sums.collect():
        parts[block] += np.frombuffer(zlib.decompress(c), "<u8")
    return np.round(4 * np.log2(np.maximum(counts, 1))).astype(np.uint8)


REGIONS = "pivot long, point long, place long"  # place: n * 2**32 + position in the set's order of pivots


def _windows(words: int, percent: int, commonness):
    """A row for each region that a set belongs to or borders on; once a batch for equal sets."""
    def run(batches):
        schema, common = arrow_schema(REGIONS), commonness.value
        for batch in batches:
            seen = set()
            for part in _slices(batch):
                out = []
                for s in shingle_sets(part.column(0).to_pylist(), words):
                    if not len(s):
                        continue
                    point = _point(s)
                    if point not in seen:
                        seen.add(point)
                        n = len(s)
                        first = n + percent * -n // 100 + 1  # n - ceil(t * n) + 1
                        order = np.lexsort((s, common[(s >> np.uint64(64 - COUNTERS)).astype(np.int64)]))[:first]
                        out.append((s[order], point, n))
                if out:
                    size = [len(o[0]) for o in out]
                    shingle = np.concatenate([o[0] for o in out])
                    point = np.repeat(np.array([o[1] for o in out], np.int64), size)
                    place = np.repeat([o[2] << 32 for o in out], size) + np.concatenate([np.arange(s) for s in size])
                    yield record_batch([shingle.view(np.int64), point, place], schema)
    return run


def _may_link(n1, pos1, n2, pos2, percent: int):
    """Whether two sets that share a pivot at these places in their orders, and none
    before, can overlap enough."""
    need = -(-percent * (n1 + n2) // (100 + percent))
    return (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)) & (n1 - pos1 >= need) & (n2 - pos2 >= need)


MEMBERS = "pivot long, point long, n long, pos long, chief long"
PAIRS = "a long, b long"


def _regions(percent: int):
    """Rows sorted by (pivot, h, point): members of regions of two sets or more, each
    once, with the region's first set, its chief. Sets that can link with no other of a
    small region go. Nothing is held but a region's last row."""
    def useful(region: np.ndarray, n: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Whether a row may link with another of its region, where the region is whole
        and small; all rows of other regions."""
        edge = np.flatnonzero(np.append(True, region[1:] != region[:-1]))
        size = np.diff(np.append(edge, len(region)))
        keep = np.repeat(size > MANY, size)
        keep[:size[0]] = True  # the first and the last may go on in other batches
        keep[len(region) - size[-1]:] = True
        end = np.repeat(edge + size, size)
        i, step = np.flatnonzero(~keep), 1
        while len(i):
            i = i[i + step < end[i]]
            j = i + step
            use = _may_link(n[i], pos[i], n[j], pos[j], percent)
            keep[i[use]] = True
            keep[j[use]] = True
            step += 1
        return keep

    def run(batches):
        schema = arrow_schema(MEMBERS)
        held = None  # the last region's first row, if no other row was seen
        region = chief = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            pivot, _, point, place = (c.to_numpy() for c in batch.columns)
            n, pos = place >> 32, place & (2**32 - 1)
            new = np.empty(len(pivot), bool)  # a region's first row
            new[0] = pivot[0] != region
            new[1:] = pivot[1:] != pivot[:-1]
            copy = np.empty(len(pivot), bool)
            copy[0] = not new[0] and point[0] == last
            copy[1:] = ~new[1:] & (point[1:] == point[:-1])
            region, last = pivot[-1], point[-1]
            rows = np.flatnonzero(~copy)
            if not len(rows):
                continue
            pivot, point, n, pos, first = pivot[rows], point[rows], n[rows], pos[rows], new[rows]
            at = np.maximum.accumulate(np.where(first, np.arange(len(rows)), -1))
            heads = np.where(at < 0, point[0] if chief is None else chief, point[np.maximum(at, 0)])
            keep = ~(first & np.append(first[1:], True))  # the last row may be the first of two
            open_ = bool(first[-1])
            made = [pivot, point, n, pos, heads]
            keep &= useful(pivot, n, pos)
            out = [c[keep] for c in made]
            if held is not None and not first[0]:
                out = [np.concatenate(([x], c)) for x, c in zip(held, out, strict=True)]
            yield record_batch(out, schema)
            held = tuple(int(c[-1]) for c in made) if open_ else None
            chief = int(heads[-1])
    return run


def _pivot_pairs(percent: int):
    """Rows (pivot, point, n, pos, label) sorted by pivot, then in any order: (member, set
    that is a pivot), where they can link and their labels, if known, differ."""
    def run(batches):
        schema, held = arrow_schema(PAIRS), None  # the last region's first rows and length
        for batch in batches:
            if not batch.num_rows:
                continue
            pivot, point, n, pos, label = (c.to_numpy() for c in batch.columns)
            new = np.append(True, pivot[1:] != pivot[:-1])
            start = np.flatnonzero(new)
            out = [np.zeros((2, 0), np.int64)]
            for s, e in zip(start.tolist(), [*start[1:].tolist(), len(pivot)], strict=True):
                if held is None or held[0] != pivot[s]:
                    held = (pivot[s], [], 0)
                _, heads, seen = held
                heads += [(point[i], n[i], pos[i], label[i]) for i in range(s, min(e, s + MORE_PIVOTS - len(heads)))]
                place = seen + np.arange(e - s)
                for k, (p, pn, ppos, plabel) in enumerate(heads):
                    use = np.flatnonzero((place >= (MANY if k >= PIVOTS else 0)) & (label[s:e] != plabel)
                                         & _may_link(n[s:e], pos[s:e], pn, ppos, percent)) + s
                    out.append(np.stack([point[use], np.full(len(use), p)]))
                held = (pivot[s], heads, seen + e - s)
            found = np.concatenate(out, axis=1)
            yield record_batch([found[0], found[1]], schema)
    return run


def _sketch(s: np.ndarray) -> bytes:
    """Bits that each shingle flips one of; at least four for each shingle of the set. Two
    sketches differ in no more bits than their sets do in shingles."""
    size = max(10, int(4 * len(s) - 1).bit_length())
    flips = np.bincount((grams.mixed(s) & np.uint64((1 << size) - 1)).astype(np.int64), minlength=1 << size)
    return np.packbits(flips & 1 > 0).tobytes()


SKETCHES = "point long, sketch binary"


def _sketches(words: int):
    def run(batches):
        for batch in (part for whole in batches for part in _slices(whole)):
            points, texts = (c.to_pylist() for c in batch.columns)
            yield record_batch([points, [_sketch(s) for s in shingle_sets(texts, words)]], arrow_schema(SKETCHES))
    return run


class Sketches:
    """Sketches of rows, compared at the size of a pair's smaller one."""

    def __init__(self, rows: list[bytes]):
        self.bits = np.array([len(r) * 8 for r in rows], np.int64)
        self.of_size = {}  # size -> rows of it, their sketches
        for size in np.unique(self.bits).tolist():
            of = np.flatnonzero(self.bits == size)
            self.of_size[size] = of, np.frombuffer(b"".join(rows[k] for k in of.tolist()), np.uint64).reshape(len(of), -1)
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _at(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Sketches of that size or more, folded to it, and where each row's is: the last
        bits of a position count, so what shares them is flipped together."""
        if size not in self.folded:
            made, place, n = [], np.zeros(len(self.bits), np.int64), 0
            for own, (of, words) in self.of_size.items():
                if own >= size:
                    made.append(np.bitwise_xor.reduce(words.reshape(len(of), own // size, size // 64), axis=1))
                    place[of] = n + np.arange(len(of))
                    n += len(of)
            self.folded[size] = np.concatenate(made), place
        return self.folded[size]

    def within(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether the sketches of rows i and j differ in ``most`` bits at most."""
        ok = np.zeros(len(i), bool)
        size = np.minimum(self.bits[i], self.bits[j])
        for one in np.unique(size).tolist():
            made, place = self._at(one)
            of = np.flatnonzero(size == one)
            for a in range(0, len(of), 20_000):
                at = of[a:a + 20_000]
                differ = np.bitwise_count(made[place[i[at]]] ^ made[place[j[at]]]).sum(axis=1, dtype=np.int64)
                ok[at] = differ <= most[at]
        return ok


def _cell_pairs(percent: int):
    """Rows (cell, apart, block, point, n, pos, label, d, sketch) sorted by (cell, n): pairs of
    different labels that neither the windows nor the sketches rule out. d: distance to
    the region's chief, if known. Sketches are metric too: they differ by no more than the
    sets do, and linked sets differ by (1 - t) / (1 + t) of both sizes at most."""
    def candidates(cell, apart, block, n, pos, label, d):
        """Pairs that the windows leave, as row numbers."""
        start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        size = np.diff(np.append(start, len(cell)))

        def use(i, j):
            return (label[i] != label[j]) & _may_link(n[i], pos[i], n[j], pos[j], percent) & (~apart[i] | (block[i] != block[j])) \
                & ~(np.abs(d[i] - d[j]) > 1 - percent / 100 + 1e-9)
        small = np.repeat(size <= MANY, size)
        end = np.repeat(start + size, size)
        i, step = np.flatnonzero(small), 1
        while len(i):  # in small cells each row with the one ``step`` further on, as long as sizes allow
            i = i[i + step < end[i]]
            i = i[100 * n[i] >= percent * n[i + step]]  # sizes ascend in a cell
            good = use(i, i + step)
            yield i[good], i[good] + step
            step += 1
        for s, e in zip(start[size > MANY].tolist(), (start + size)[size > MANY].tolist(), strict=True):
            names, counts = np.unique(label[s:e], return_counts=True)
            most = names[np.argmax(counts)]
            for k in (s + np.flatnonzero(label[s:e] != most)).tolist():  # of two sets of the greatest component no pair is needed
                lo, hi = s + np.searchsorted(n[s:e], [-(-percent * n[k] // 100), 100 * n[k] // percent + 1])
                j = np.arange(lo, hi)
                j = j[(label[j] == most) | (j < k)]  # of two others the later one looks back
                i = np.full(len(j), k)
                good = use(i, j)
                yield i[good], j[good]

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        cell, apart, block, point, n, pos, label, d = (rows[c].to_numpy() for c in ("cell", "apart", "block", "point", "n", "pos", "label", "d"))
        sketches = Sketches(rows["sketch"].to_pylist())
        out = [np.zeros((2, 0), np.int64)]
        for i, j in candidates(cell, apart, block, n, pos, label, d):
            both = n[i] + n[j]
            near = sketches.within(i, j, both - 2 * -(-percent * both // (100 + percent)))
            i, j = point[i[near]], point[j[near]]
            out.append(np.stack([np.minimum(i, j), np.maximum(i, j)]))
        found = np.unique(np.concatenate(out, axis=1), axis=1)
        return record_batch([found[0], found[1]], arrow_schema(PAIRS))

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= CELL_ROWS:
                rows = pa.Table.from_batches(held).combine_chunks()
                cell = rows["cell"].to_numpy()
                if cut := int(np.flatnonzero(cell == cell[-1])[0]):
                    yield pairs(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
                size = rows.num_rows - cut
        if held:
            yield pairs(pa.Table.from_batches(held))
    return run


DISTANCES = "a long, b long, d double, linked boolean"


def _compare(words: int, percent: int):
    """Rows (a, b, a_text, b_text) sorted by b: exact distances."""
    def run(batches):
        schema, held, held_set = arrow_schema(DISTANCES), None, None
        for batch in (part for whole in batches for part in _slices(whole)):
            a, b, a_text = (c.to_pylist() for c in batch.columns[:3])
            sets = shingle_sets(a_text, words)
            out = []
            for x, y, s, t in zip(a, b, sets, batch.column(3), strict=True):
                if y != held:
                    held, held_set = y, shingle_sets([t.as_py()], words)[0]
                at = np.minimum(np.searchsorted(held_set, s), len(held_set) - 1)
                both = int(np.count_nonzero(held_set[at] == s))
                every = len(s) + len(held_set) - both
                out.append((x, y, 1 - both / every, 100 * both >= percent * every))
            if out:
                yield record_batch(list(zip(*out, strict=True)), schema)
    return run


def jaccard_rows(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): doc_id and
    text_hash, which name the row among others; n_shingles, the size of its set of
    ``words``-word shingles; label, which all rows of its component have and no others.
    Two documents link when 100 * intersection >= percent * union.

    Null, empty or blank text: no shingles, linked with nothing; label is null. Null
    doc_ids take part. Rows of one doc_id are documents of their own. Empty table: no rows."""
    with _small_batches(docs.sparkSession):  # all jobs on texts run in here
        return _labelled_rows(docs, words, percent)


def _labelled_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    text_hash = F.xxhash64("text").alias("text_hash")
    docs = docs.select(F.coalesce("doc_id", F.xxhash64("text")).alias("row"), "doc_id", text_hash, "text")
    folder = f"{checkpoint_dir(spark)}/jaccard-{uuid.uuid4().hex}"
    points = docs.mapInArrow(_points(words), POINTS).checkpoint()
    commonness = spark.sparkContext.broadcast(_commonness(points))
    own = points.where("block is null").select("row", "doc_id", "text_hash", "point", "n")

    rows = docs.select("text").mapInArrow(_windows(words, percent, commonness), REGIONS)
    # the set with the fewest rarer shingles is nearest to the middle of its region
    h = F.col("place").bitwiseAND(2**32 - 1).alias("h")
    rows = rows.repartition("pivot").select("pivot", h, "point", "place").sortWithinPartitions("pivot", "h", "point")
    members = rows.mapInArrow(_regions(percent), MEMBERS).checkpoint()  # in the same order

    # one document's text for every set that may link
    wanted = own.groupBy("point").agg(F.min("row").alias("row"))
    wanted = wanted.join(members.select("point").distinct(), "point", "left_semi")
    found = docs.select("row", "text").join(wanted, "row").dropDuplicates(["row", "text", "point"])
    found = found.select("point", "text").mapInArrow(_of_point(words), "point long, text string")
    found.write.option("compression", "zstd").parquet(f"{folder}/texts")
    texts = spark.read.parquet(f"{folder}/texts")

    def distances(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("point").alias("a"), F.col("text").alias("a_text"))
        right = texts.select(F.col("point").alias("b"), F.col("text").alias("b_text"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text").sortWithinPartitions("b")
        return both.mapInArrow(_compare(words, percent), DISTANCES)

    def labelled(links: DataFrame) -> DataFrame:
        """Members of the regions that hold sets of several components, with their regions' sizes."""
        labels = components(links).select(F.col("node").alias("point"), "label").checkpoint()
        rest = members.join(labels, "point", "left").withColumn("label", F.coalesce("label", "point"))
        several = rest.groupBy("pivot").agg(F.min("label").alias("l1"), F.max("label").alias("l2"), F.count(F.lit(1)).alias("rows"))
        return rest.join(several.where("l1 <> l2").select("pivot", "rows"), "pivot")

    pairs = members.select("pivot", "point", "n", "pos", F.col("point").alias("label")).mapInArrow(_pivot_pairs(percent), PAIRS)
    first = distances(pairs.distinct()).checkpoint()
    links = first.where("linked").select("a", "b")
    rest = labelled(links)
    known = first.select(F.col("a").alias("point"), F.col("b").alias("chief"), "d")
    rest = rest.join(known, ["point", "chief"], "left")
    rest = rest.withColumn("d", F.when(F.col("point") == F.col("chief"), 0.0).otherwise(F.coalesce("d", F.lit(float("nan")))))
    # a region of many sets is dealt into blocks, each pair of which is a cell of its own
    blocks = F.ceil(F.col("rows") / F.lit(CELL_ROWS)).cast("int")
    rest = rest.withColumn("block", F.pmod(F.xxhash64("point"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    pair = (F.least("block", "other"), F.greatest("block", "other"))
    rest = rest.select("point", "n", "pos", "label", "d", "block", F.xxhash64("pivot", *pair).alias("cell"), (pair[0] != pair[1]).alias("apart"))
    sketches = texts.mapInArrow(_sketches(words), SKETCHES)
    rest = rest.join(sketches, "point").repartition("cell").select("cell", "apart", "block", "point", "n", "pos", "label", "d", "sketch")
    second = distances(rest.sortWithinPartitions("cell", "n", "point").mapInArrow(_cell_pairs(percent), PAIRS).distinct())
    links = links.unionByName(second.where("linked").select("a", "b"))

    # components over the components so far
    labels = components(links).select(F.col("node").alias("point"), "label")
    classes = own.join(labels, "point", "left").withColumn("label", F.when(F.col("n") > 0, F.coalesce("label", "point")))
    return classes.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "label")


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): n_shingles, the size
    of its set of ``words``-word shingles, and component_id, the smallest doc_id that
    links reach from it. Two documents link when 100 * intersection >= percent * union.

    Null, empty or blank text: no shingles, linked with nothing; component_id is its own
    doc_id. Null doc_ids take part, but name no component: component_id is null where
    no document that is reached has a doc_id. Rows of one doc_id are documents of their
    own. Empty table: no rows."""
    rows = jaccard_rows(docs, words, percent)
    classes = rows.where("label is not null")
    least = classes.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    classes = classes.join(least, "label").select("doc_id", "n_shingles", "component_id")
    return classes.unionByName(rows.where("label is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _of_point(words: int):
    """Rows whose text has the set that was asked for: rows of one doc_id may differ."""
    def run(batches):
        for batch in (part for whole in batches for part in _slices(whole)):
            sets = shingle_sets(batch.column(1).to_pylist(), words)
            yield batch.filter(pa.array([_point(s) == p for s, p in zip(sets, batch.column(0).to_pylist(), strict=True)], pa.bool_()))
    return run


def op1_jaccard(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))

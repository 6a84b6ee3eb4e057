"""Near duplicates by word shingles: a MinHash LSH forest, exact confirmation, components.

The forest is a number of trees, each an order of all distinct shingle sets by their own sequence
of minimum hashes. Sets that share at least ``SHALLOWEST`` leading hashes are candidates; within
the sorted order a set is compared with its next neighbours only, which share the longest prefixes.
A region with few sets is thus compared at the shallow depth and a crowded one at a greater depth,
whatever its size, and the work is linear.

Equal sets are one class, found by a hash of the set, and only classes go into the forest. Most
regions (tree and leading hashes) hold one set alone. Those are found first, on rows of two numbers,
and only what is left goes through the forest with its keys and sketches. Links are confirmed on full sets in two rounds. The first confirms the nearest neighbours. The second
goes through the forest again, where every set carries the component it is in so far, and looks for
the nearest sets of other components: a link inside a component cannot change the components, so
leaving it out loses nothing, and crowded regions get further than their own group.

The second round also notes every region in which it could not compare
all sets of different components. A third round compares all of them there, in blocks of bounded
size. So every two sets of different components that share the leading hashes of some tree have
been compared, however crowded the region.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import map_arrow
from windrow.llm.components import components
from windrow.operators.joins import attach, is_small
from windrow.session import durable

TREES = 24
DEPTH = 8              # minimum hashes in a tree's key, two bytes each
SHALLOWEST = 4         # leading hashes that candidates share
NEAREST, NEIGHBOURS = 2, 32
SKETCHED = 192         # minimum hashes of which a sketch holds one bit each
SIGMAS = 4.5           # a candidate is dropped when its sketch is that far below the threshold
PIECE = 1024           # rows of a piece of a crowded region, about
STEP = 4096            # pairs after which a block hands on what it found
PARITIES = 512         # bits of a sketch that hold the parity of a share of the set
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, width: int) -> np.ndarray:
    """The distinct shingles of ``width`` words, as sorted 64-bit hashes.

    ASCII letters are lowered and words end at ASCII white space. With fewer words the whole
    sequence is the only shingle; without a word there is none.
    """
    data = _LOWER[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)]
    blank = np.concatenate([[True], _BLANK[data], [True]])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return np.zeros(0, np.uint64)
    # hash of a word = sum of byte * odd**position, moved to position 0 by the inverse power
    power = np.full(len(data), _ODD)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power, out=sums[1:])
    inverse = np.full(len(data), np.uint64(pow(int(_ODD), -1, 1 << 64)))
    inverse[0] = 1
    np.multiply.accumulate(inverse, out=inverse)
    word = _mixed((sums[end] - sums[begin]) * inverse[begin]
                  + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    width = min(width, len(word))
    n = len(word) - width + 1
    h = np.full(n, np.uint64(width))
    for k in range(width):
        h = h * np.uint64(0xA0761D6478BD642F) + word[k:k + n]
    return np.unique(_mixed(h))


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_501)
    return (rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, n, dtype=np.uint64))


def minimum_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """``n`` minimum hashes of a set. Long sets go through in slices."""
    a, b = _coefficients(n)
    least = np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF))
    for s in range(0, len(hashes), 4096):
        np.minimum(least, (hashes[s:s + 4096, None] * a + b).min(0), out=least)
    return _mixed(least)


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int, trees: int) -> DataFrame:
    """Per row: id, a hash of the text, set size, 16-byte class of the set, tree keys and sketch."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).alias("text"))
    n = trees * DEPTH

    def made(batch):
        size, kind, keys, sketch = [], [], [], []
        for text in batch.column(2).to_pylist():
            h = shingles(text, width)
            size.append(len(h))
            if not len(h):
                kind.append(None), keys.append(None), sketch.append(None)
                continue
            place = np.arange(1, len(h) + 1, dtype=np.uint64) * _ODD
            kind.append(np.array([_mixed(h + place).sum(), _mixed(h ^ place).sum()],
                                 "<u8").tobytes())
            low = minimum_hashes(h, n)
            keys.append((low >> np.uint64(48)).astype(">u2").tobytes())
            odd = np.bincount((h % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
            sketch.append(np.packbits((low[:SKETCHED] & np.uint64(1)).astype(bool)).tobytes()
                          + np.packbits(odd.astype(bool)).tobytes())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(size, pa.int64()),
             *(pa.array(x, pa.binary()) for x in (kind, keys, sketch))],
            ["id", "text_hash", "size", "class", "keys", "sketch"])
    return map_arrow(rows, made, f"id {rows.schema['id'].dataType.simpleString()}, text_hash "
                     "bigint, size bigint, class binary, keys binary, sketch binary")


def companions(classes: DataFrame, trees: int) -> DataFrame:
    """The rows of ``classes`` that share a region with another, and ``trees``, those it is in.

    A row goes to its regions as two hashes, in the order of the regions, where a region that goes on
    has equal neighbours. What stands at a border of a partition is taken to share one, and hashes
    that are equal by chance only add trees: no shared region is left out, and the comparisons
    that follow decide.
    """
    rows = classes.withColumn("no", F.xxhash64("class"))
    # the tree is the remainder; 54 bits of hash leave room for it
    region = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.shiftright(
        F.xxhash64(t, F.substring(F.col("keys"), t * (2 * DEPTH) + 1, F.lit(2 * SHALLOWEST))), 10)
        * trees + t)

    def shared(batches):
        last, own, sure = np.zeros(0, np.int64), np.zeros(0, np.int64), True
        for batch in batches:
            at, no = (np.concatenate([held, batch.column(c).to_numpy()])
                      for c, held in enumerate((last, own)))
            if not len(at):
                continue
            keep, same = np.zeros(len(at), bool), at[1:] == at[:-1]
            keep[0] = sure
            keep[1:] |= same
            keep[:-1] |= same
            last, own, sure = at[-1:], no[-1:], keep[-1]      # the next batch may go on with it
            yield made(at[:-1][keep[:-1]], no[:-1][keep[:-1]])
        yield made(last, own)

    def made(at, no):
        return pa.RecordBatch.from_arrays([pa.array(no), pa.array(at % trees, pa.int32())],
                                          ["no", "tree"])
    found = (rows.select(F.explode(region).alias("region"), "no")
             .repartitionByRange("region", "no").sortWithinPartitions("region")
             .mapInArrow(shared, "no bigint, tree int")
             .groupBy("no").agg(F.collect_set("tree").alias("trees")))
    return attach(rows, durable(found), ["no"], "inner", ["class"]).drop("no")


def forest(sets: DataFrame) -> DataFrame:
    """(tree, key, class, size, sketch, root) for every set and each of its ``trees``."""
    split = F.transform("trees", lambda t: F.struct(
        t.alias("tree"), F.substring(F.col("keys"), t * (2 * DEPTH) + 1,
                                     F.lit(2 * DEPTH)).alias("key")))
    return (sets.select("class", F.col("size").cast("int").alias("size"), "sketch", "root",
                        F.explode(split).alias("x"))
            .select("x.tree", "x.key", "class", "size", "sketch", "root"))


def _apart(percent: int, trees: int) -> int:
    """Bits of the minimum hashes in which the sketches of linked sets differ, at most."""
    agree = (100 + percent) / 200           # chance that the bits of a minimum hash agree
    n = min(SKETCHED, trees * DEPTH)
    return int(n * (1 - agree) + SIGMAS * (n * agree * (1 - agree)) ** 0.5) + 1


def candidates(sets: DataFrame, percent: int, trees: int, most: int) -> DataFrame:
    """Pairs (a, b) of classes with different roots that are neighbours in some tree.

    Rows with a tree are no pairs: ``a`` then is the leading hashes of a region of that tree in
    which sets of different roots were not all compared.

    ``most`` neighbours of other roots are looked at before each set. The ratio of the set sizes,
    the parities and the minimum hashes of the sketches must all allow the similarity. The first
    two are exact: two sets differ in at least as many elements as their parities do in bits, and
    at this similarity they differ in at most a share of their sizes. Each tree is one stretch of
    a range partitioning by (tree, key, class), so even equal keys are spread over tasks; a task
    keeps ``most`` rows of each of the last ``most`` roots. A region in which it let go of a row,
    and one that may go on beyond the border of the partition, is noted.
    """
    apart, prefix = _apart(percent, trees), 2 * SHALLOWEST

    def made(left, right, tree):
        return pa.RecordBatch.from_arrays(
            [pa.array(left, pa.binary()), pa.array(right, pa.binary()), pa.array(tree, pa.int32())],
            ["a", "b", "tree"])

    def neighbours(batches):
        region, count = None, 0
        border, cut, several = True, False, False
        held: dict[bytes, list[tuple]] = {}       # roots, the one seen last at the end
        for batch in batches:
            left, right, noted = [], [], []
            for tree, key, kind, size, sketch, root in zip(
                    *(batch.column(c).to_pylist() for c in range(6))):
                if region != (tree, key[:prefix]):
                    if region is not None:
                        if border or (cut and several):
                            noted.append(region)
                        border = False
                    region, count, cut, several = (tree, key[:prefix]), 0, False, False
                    held.clear()
                low = int.from_bytes(sketch[:-PARITIES // 8], "big")
                odd = int.from_bytes(sketch[-PARITIES // 8:], "big")
                if len(held) > (root in held):
                    near = [row for other, rows in held.items() if other != root for row in rows]
                    near.sort(key=lambda row: row[0], reverse=True)
                    cut, several = cut or len(near) > most, True
                    for _, other, other_size, a, b in near[:most]:
                        if (100 * min(size, other_size) >= percent * max(size, other_size)
                                and ((100 + percent) * (odd ^ b).bit_count()
                                     <= (100 - percent) * (size + other_size))
                                and (low ^ a).bit_count() <= apart):
                            left.append(min(kind, other))
                            right.append(max(kind, other))
                rows = held.pop(root, [])
                rows.append((count, kind, size, low, odd))
                held[root] = rows[-most:]
                cut = cut or len(rows) > most or len(held) > most
                if len(held) > most:
                    del held[next(iter(held))]
                count += 1
            if left or noted:
                yield made(left + [r[1] for r in noted], right + [None] * len(noted),
                           [None] * len(left) + [r[0] for r in noted])
        if region is not None:
            yield made([region[1]], [None], [region[0]])
    return (forest(sets).repartitionByRange("tree", "key", "class")
            .sortWithinPartitions("tree", "key", "class")
            .mapInArrow(neighbours, "a binary, b binary, tree int").distinct())


def _pairs(found: DataFrame) -> DataFrame:
    return found.filter("tree is null").select("a", "b")


def crowded_pairs(sets: DataFrame, regions: DataFrame, percent: int, trees: int) -> DataFrame:
    """All pairs (a, b) of classes with different roots in ``regions`` (tree, region).

    The tests are those of :func:`candidates`. A region is dealt by hash into pieces, and every two
    pieces are one block of bounded size, so a crowded region is spread over many tasks.
    """
    apart = _apart(percent, trees)
    rows = forest(sets).withColumn("region", F.substring("key", 1, 2 * SHALLOWEST)).drop("key")
    on = ["tree", "region"]
    n = attach(rows.select(*on, "class", "root"), regions.withColumn("noted", F.lit(True)), on,
               spread=["class"]).filter("noted").groupBy(*on).agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("first"), F.max("root").alias("last"))
    pieces = durable(n.filter("first != last").select(
        *on, F.ceil(F.col("n") / PIECE).cast("int").alias("pieces")))
    dealt = attach(rows, pieces, on, spread=["class"]).filter("pieces is not null").withColumn(
        "own", F.pmod(F.hash("class"), F.col("pieces"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    block = [*on, "low", "high"]
    dealt = dealt.withColumn("low", F.least("own", "other")).withColumn(
        "high", F.greatest("own", "other")).select(*block, "root", "class", "size", "sketch", "own")

    def batch_of(left, right):
        return pa.RecordBatch.from_arrays(
            [pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"])

    def compared(rows):
        root, kind, size, sketch, own = zip(*rows)
        bits = np.frombuffer(b"".join(sketch), np.uint8).reshape(len(rows), -1)
        odd = np.ascontiguousarray(bits[:, -PARITIES // 8:]).view(np.uint64)
        low = np.ascontiguousarray(bits[:, :-PARITIES // 8])
        size, own = np.array(size, np.int64), np.array(own)
        whole, end = own.min() == own.max(), len(rows)
        left, right = [], []
        for i in range(len(rows) - 1, -1, -1):        # rows stand by root: those from end on differ
            if i + 1 < len(rows) and root[i] != root[i + 1]:
                end = i + 1
            if end == len(rows):
                continue
            fine = 100 * np.minimum(size[i], size[end:]) >= percent * np.maximum(size[i], size[end:])
            if not whole:
                fine &= own[end:] != own[i]
            at = np.flatnonzero(fine) + end
            at = at[(100 + percent) * np.bitwise_count(odd[at] ^ odd[i]).sum(1, dtype=np.int64)
                    <= (100 - percent) * (size[at] + size[i])]
            at = at[np.bitwise_count(low[at] ^ low[i]).sum(1, dtype=np.int64) <= apart]
            for j in at.tolist():
                left.append(min(kind[i], kind[j]))
                right.append(max(kind[i], kind[j]))
            if len(left) >= STEP:
                yield batch_of(left, right)
                left, right = [], []
        if left:
            yield batch_of(left, right)

    def blocks(batches):
        now, held = None, []
        for batch in batches:
            for *key, root, kind, size, sketch, own in zip(
                    *(batch.column(c).to_pylist() for c in range(batch.num_columns))):
                if key != now:
                    yield from compared(held) if len(held) > 1 else ()
                    now, held = key, []
                held.append((root, kind, size, sketch, own))
        yield from compared(held) if len(held) > 1 else ()
    return (dealt.repartition(*block).sortWithinPartitions(*block, "root")
            .mapInArrow(blocks, "a binary, b binary").distinct())


def full_sets(docs: DataFrame, text_col: str, wanted: DataFrame, width: int) -> DataFrame:
    """(class, shingle hashes as bytes) of the rows whose text hash is in ``wanted``."""
    rows = docs.select(F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    small = is_small(wanted)
    rows = rows.join(F.broadcast(wanted) if small else wanted, "text_hash", "left_semi")

    def made(batch):
        kind, data = [], []
        for text in batch.column(1).to_pylist():
            h = shingles(text, width)
            place = np.arange(1, len(h) + 1, dtype=np.uint64) * _ODD
            kind.append(np.array([_mixed(h + place).sum(), _mixed(h ^ place).sum()],
                                 "<u8").tobytes())
            data.append(h.tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.binary()), pa.array(data, pa.binary())], ["class", "set"])
    return map_arrow(rows, made, "class binary, set binary").groupBy("class").agg(
        F.first("set").alias("set"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    first = sets.select(F.col("class").alias("a"), F.col("set").alias("set_a"))
    second = sets.select(F.col("class").alias("b"), F.col("set").alias("set_b"))
    both = pairs.select("a", "b").join(first, "a").join(second, "b")

    def check(batch):
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            if not len(x) or not len(y):
                keep.append(False)
                continue
            at = np.minimum(np.searchsorted(x, y), len(x) - 1)
            common = int((x[at] == y).sum())
            keep.append(100 * common >= percent * (len(x) + len(y) - common))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(
            pa.array(keep))
    return map_arrow(both.select("a", "b", "set_a", "set_b"), check, "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 5, percent: int = 80, trees: int = TREES) -> DataFrame:
    """Per row: id, text_hash, n_shingles, class of equal sets, component_id (least id), kept, chosen.

    ``kept`` marks one document of each group: the one whose id is the component's least. Texts
    that are null or have no word are linked with nothing and kept. A row with a null id never
    gives a group its id; it is kept only where no row of its group has an id, and then
    component_id is null. Repeated rows are decided alike. An empty table gives an empty one.

    ``chosen`` marks one pair of id and text of each group, the least with null ids last, so that
    only rows equal in both are marked together.
    """
    marked = durable(signatures(docs, id_col, text_col, width, trees))
    classes = durable(marked.filter(F.col("class").isNotNull()).groupBy("class").agg(
        F.min("id").alias("least_id"), F.min(F.struct(
            F.col("id").isNull().alias("no_id"), "id", "text_hash")).alias("least"),
        F.min("text_hash").alias("text_hash"),
        # equal sets have equal keys and sketches
        *[F.first(c).alias(c) for c in ("size", "keys", "sketch")]))
    keyed = durable(companions(classes.select("class", "keys", "sketch", "size"), trees))

    def found(sets: DataFrame, most: int) -> DataFrame:
        return candidates(sets, percent, trees, most)

    def linked(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        wanted = durable(classes.join(ends, "class", "left_semi").select("text_hash").distinct())
        # not made durable: both joins of the pairs read the one exchange that gathers the sets
        return confirmed(pairs, full_sets(docs, text_col, wanted, width), percent)

    def rooted(roots: DataFrame) -> DataFrame:
        return keyed.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn(
            "root", F.coalesce("root", "class"))

    def fresh(pairs: DataFrame, tested: DataFrame) -> DataFrame:
        """What was looked at before is not looked at again."""
        return durable(
            pairs.withColumn("fresh", F.lit(True))
            .unionByName(tested.withColumn("fresh", F.lit(False)))
            .groupBy("a", "b").agg(F.min("fresh").alias("fresh")).filter("fresh").drop("fresh"))

    def joined_by(roots: DataFrame, links: DataFrame) -> DataFrame:
        return durable(components(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
                                  .unionByName(links)))

    first = durable(_pairs(found(keyed.withColumn("root", F.col("class")), NEAREST)))
    roots = durable(components(linked(first)))
    looked = durable(found(rooted(roots), NEIGHBOURS))
    second = fresh(_pairs(looked), first)
    roots = joined_by(roots, linked(second))
    regions = looked.filter("tree is not null").select("tree", F.col("a").alias("region"))
    third = fresh(crowded_pairs(rooted(roots), regions, percent, trees), first.unionByName(second))
    roots = joined_by(roots, linked(third))
    named = classes.select("class", "least_id", "least").join(
        roots.select(F.col("node").alias("class"), "root"), "class", "left").withColumn(
        "root", F.coalesce("root", "class"))
    groups = named.groupBy("root").agg(
        F.min("least_id").alias("component_id"), F.min("least").alias("best"))
    of_class = durable(attach(named.drop("least"), groups, ["root"], "inner", ["class"]).select(
        "class", "component_id", "best"))
    # the copies of one text may be a large share of all rows
    joined = attach(marked.select("id", "text_hash", "size", "class"), of_class, ["class"],
                    spread=["id", "text_hash"])
    own: Column = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    chosen = F.col("class").isNull() | (F.col("id").eqNullSafe(F.col("best.id"))
                                        & (F.col("text_hash") == F.col("best.text_hash")))
    return joined.select("id", "text_hash", F.col("size").alias("n_shingles"), "class",
                         own.alias("component_id"), F.col("id").eqNullSafe(own).alias("kept"),
                         chosen.alias("chosen"))

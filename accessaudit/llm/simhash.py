"""Near copies by SimHash fingerprints, linked through a Gray-ordered hierarchical index.

Fingerprints are counted once each. Two of them within `distance` bits agree on all but
`distance` of a number of bit blocks, so each fingerprint is dealt under every choice of blocks
to agree on, and linked pairs meet. A part holds the fingerprints that share the first bits of
the chosen blocks: sorted by the chosen blocks, then by Gray rank, they form a tree whose nodes
hold the bits all their members share. A search adds up differing bits from node to node and
leaves a whole group once there are more than `distance`. Parts give trees of links, not
pairs; Spark joins turn the links into components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accessaudit.llm.common import hinted, lean, texts, unused
from accessaudit.session import fresh_folder, written

DISTANCE = 4
SHINGLE = 4
SEED = 42
PART = 2048  # fingerprints in a part, about
HOT = 4096  # a part with more is split into pairs of blocks
LEAF, FAN = 8, 8
STEPS = 1 << 19  # nodes that a search looks at in one go


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text: a bit is set if it is set in over half of the shingles' hashes; without words zero."""
    words = text.lower().split()  # of bytes: A-Z, and white space 9 to 13 and 32
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[: max(1, len(words) - shingle + 1)].tolist()
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[low : low + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fingerprint (a long with the 64 bits) and MD5 of the text (null: as if empty) of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py(), shingle, seed) for t in batch.column("text")]
            bits = pa.array(np.array(made, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), bits, batch.column("text_md5")], names=["doc_id", "bits", "text_md5"])

    return texts(docs).withColumn("text_md5", F.md5("text")).mapInArrow(lean(scan), "doc_id long, bits long, text_md5 string")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each number in the reflected Gray code."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the trees of linked places, all links at once."""
    while True:
        while not np.array_equal(up := parent[parent], parent):
            parent = up
        a, b = parent[a], parent[b]
        apart = a != b
        if not apart.any():
            return parent
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


class GrayIndex:
    """Tree over sorted fingerprints; `key` masks the bits that must be equal. See the module's text."""

    def __init__(self, prints: np.ndarray, key: int):
        key = np.uint64(key)
        order = np.lexsort((gray_rank(prints & ~key), prints & key))
        self.order, self.prints = order, prints[order]
        same = self.prints & key
        start = np.flatnonzero(np.r_[True, same[1:] != same[:-1]]) if len(same) else np.zeros(0, np.int64)
        end = np.append(start[1:], len(prints)).astype(np.int64)
        self.top = np.repeat(np.arange(len(start)), end - start)  # of each fingerprint
        self.levels = []
        while True:
            both = np.bitwise_and.reduceat(self.prints, start) if len(start) else self.prints[:0]
            either = np.bitwise_or.reduceat(self.prints, start) if len(start) else self.prints[:0]
            mask = ~(both ^ either)
            wide = end - start > LEAF
            children = np.where(wide, np.minimum(FAN, -(-(end - start) // LEAF)), 1)
            first = np.cumsum(children) - children
            self.levels.append((start, end, mask, both & mask, first, children))
            if not wide.any():
                return
            owner = np.repeat(np.arange(len(start)), children)
            nth = np.arange(len(owner)) - first[owner]
            size = (end - start)[owner]
            begin = start[owner]
            start, end = begin + size * nth // children[owner], begin + size * (nth + 1) // children[owner]

    def links(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of places in sorted order, first < second, that differ in at most `distance` bits, a block at a time."""
        sizes = (self.levels[0][1] - self.levels[0][0])[self.top]
        low, done = 0, np.cumsum(sizes // LEAF + 1)
        while low < len(self.prints):
            high = max(low + 1, int(np.searchsorted(done, (done[low - 1] if low else 0) + STEPS, "right")))
            yield self._links_of(np.arange(low, high), distance)
            low = high

    def _links_of(self, query: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        node, known = self.top[query], None
        differ = np.zeros(len(query), np.uint8)
        for start, end, mask, pattern, first, children in self.levels:
            if known is not None:  # from the level above: its nodes become their children
                up_first, up_children, up_mask = known
                count = up_children[node]
                owner = np.repeat(np.arange(len(node)), count)
                nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                child = up_first[node][owner] + nth
                query = query[owner]
                fresh = mask[child] & ~up_mask[node][owner]
                differ = differ[owner] + np.bitwise_count((self.prints[query] ^ pattern[child]) & fresh)
                node = child
            near = (differ <= distance) & (end[node] > query + 1)
            query, node, differ = query[near], node[near], differ[near]
            known = first, children, mask
        count = end[node] - start[node]
        owner = np.repeat(np.arange(len(node)), count)
        other = start[node][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        query = query[owner]
        rest = np.bitwise_count((self.prints[query] ^ self.prints[other]) & ~mask[node][owner])
        near = (other > query) & (differ[owner] + rest <= distance)
        return query[near], other[near]

    def forest(self, distance: int) -> np.ndarray:
        """For each of the given fingerprints the place, among the given, of one it is linked to, itself for one of each tree."""
        parent = np.arange(len(self.prints))
        for a, b in self.links(distance):
            parent = _join(parent, a, b)
        out = np.empty(len(parent), np.int64)
        out[self.order] = self.order[parent]
        return out


def _schemes(distance: int, distinct: int) -> tuple[list[int], int]:
    """Masks of the bits to agree on, and how many of their first bits deal out the parts.

    More blocks mean longer masks: the more fingerprints there are, the more bits a pair has to
    share before it is looked at.
    """
    blocks = distance + 1
    while blocks < 64 and blocks < distance + 4 and distinct > 64 << (64 // blocks * (blocks - distance)):
        blocks += 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    of = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(blocks)]
    masks = [sum(x) for x in combinations(of, blocks - distance)]
    shortest = min(m.bit_count() for m in masks)
    return masks, min(shortest, max(0, (distinct // PART).bit_length()))


def _leading(mask: int, bits: int) -> int:
    """The highest `bits` bits of a mask."""
    kept = 0
    for b in reversed(range(64)):
        if bits and mask >> b & 1:
            kept |= 1 << b
            bits -= 1
    return kept


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, distinct: int, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) between distinct fingerprints `bits`, enough to connect all within `distance` bits."""
    if not 0 <= distance <= 60:
        raise ValueError("a distance of 0 to 60 bits")
    masks, first_bits = _schemes(distance, distinct)
    coarse = [_leading(m, first_bits) for m in masks]

    def dealt(i: int) -> Column:
        return F.struct(F.lit(i).alias("scheme"), F.col("bits").bitwiseAND(F.lit(_signed(coarse[i]))).alias("part"))

    rows = prints.select("bits", F.explode(F.array(*[dealt(i) for i in range(len(masks))])).alias("at")).select(
        "bits", "at.scheme", "at.part"
    )
    hot = rows.groupBy("scheme", "part").count().where(F.col("count") > HOT)
    hot = hot.select("scheme", "part", F.ceil(F.col("count") / HOT).cast("int").alias("blocks"))
    rows = rows.join(hot, ["scheme", "part"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("bits", F.lit(3)), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least(j, F.col("own")).alias("i"), F.greatest(j, F.col("own")).alias("j")),
    )
    rows = rows.withColumn("own", own).select("bits", "scheme", "part", F.explode(pairs).alias("pair"))

    def search(key, table):
        given = table.column("bits").combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64)
        up = GrayIndex(given, masks[key[0].as_py()]).forest(distance)
        linked = np.flatnonzero(up != np.arange(len(up)))
        return pa.table({"a": given[linked].view(np.int64), "b": given[up[linked]].view(np.int64)})

    return rows.groupBy("scheme", "part", "pair").applyInArrow(lean(search), "a long, b long")


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node that has a link (a, b), by alternating stars.

    Each round links every larger neighbour, then every smaller one, to the smallest; after
    each round the links are written to the shared folder. It ends when a round changes nothing.
    """
    folder = fresh_folder(edges.sparkSession, label)
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{folder}/0")

    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("a").agg(F.min("b").alias("m"))

    done, round_ = None, 0
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == done:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct()
            )
        done, round_ = state, round_ + 1
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = smallest(both).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = smallest(large)
        small = large.join(low, "a").select("b", "m").union(low.select("a", "m"))
        small = small.toDF("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        edges = written(small.distinct(), f"{folder}/{round_}")


def near_copies(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of `docs`.

    Rows whose fingerprints differ in at most `distance` bits are linked; the component_id is the
    smallest doc_id that links reach. Defined cases: null and empty texts have fingerprint zero
    and are linked like any other; rows without a doc_id link others, but name no component
    (null where no row of a component has an id); rows that share a doc_id are linked by their
    texts alone. Other columns are not read. An empty table gives no rows.
    """
    rows, named = _named(docs, distance, shingle)
    return rows.join(named.select("bits", "component_id"), "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _named(docs: DataFrame, distance: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """`fingerprints`, and bits, root (the component, one for all its bits) and component_id of every distinct one."""
    spark = docs.sparkSession
    rows = written(fingerprints(docs, shingle), fresh_folder(spark, "fingerprints"))
    distinct = written(rows.groupBy("bits").agg(F.min("doc_id").alias("first")), fresh_folder(spark, "distinct"))
    tree = components(links(distinct.select("bits"), distinct.count(), distance), "links")
    named = distinct.join(tree.withColumnRenamed("node", "bits"), "bits", "left")
    named = named.select("bits", "first", F.coalesce("root", "bits").alias("root"))
    roots = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows, named.join(roots, "root").select("bits", "root", "component_id")


def one_of_each(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """The rows of `docs` that stay when each component keeps one row, that with its smallest doc_id.

    Of rows that share that doc_id the one of smallest fingerprint, then MD5 of its text stays. Rows
    without a doc_id are no copies of named ones, but of those in one component one stays. Of
    rows with the same doc_id and text any one may be it: they differ in other columns at most.
    """
    rows, named = _named(docs, distance, shingle)
    unnamed = F.col("doc_id").isNull().alias("unnamed")
    best = F.min(F.struct("doc_id", "bits", "text_md5"))
    first = rows.groupBy("bits", unnamed).agg(best.alias("one"))  # equal fingerprints shrink before they meet the components
    first = first.join(named.select("bits", "root"), "bits").groupBy("root", "unnamed").agg(F.min("one").alias("one"))
    id_, of, md5 = (unused(docs, n) for n in ("kept_id", "kept_md5", "text_md5"))
    kept = first.select(F.col("one.doc_id").alias(id_), F.col("one.text_md5").alias(of))
    kept = hinted(written(kept, fresh_folder(docs.sparkSession, "kept")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(md5) == F.col(of))
    found = docs.withColumn(md5, F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).join(kept, same, "left_semi")
    return found.dropDuplicates(["doc_id", md5]).drop(md5)

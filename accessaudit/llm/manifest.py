"""A Merkle manifest of a dataset, its leaves placed by the rank of their ids in bitmaps.

Every row is a leaf. Each group (source) has its doc_ids as compressed bitmaps, one for every 8,192
ids, merged from what single tasks hold; counts of set bits per word and per
range of ids give the rank of an id, which is its leaf's place: the leaves themselves are never
sorted. Nodes are then put into arrays by place, 2,187 to an array, and each array is
reduced by seven levels at once, until one node is left. Proofs come down the same arrays.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accessaudit.llm.common import hinted
from accessaudit.operators.results import dense_ids
from accessaudit.session import fresh_folder, written

FANOUT = 3
LEVELS = 7  # reduced at once
BLOCK = FANOUT**LEVELS  # places in an array
LOW_BITS = 13  # ids in a bitmap
DIGIT_BITS = 17  # three digits above it make up 64 bits
DENSE = 512  # more ids than this are held as a bitmap of 1,024 bytes, fewer as a list
DEALT = 1 << 17  # rows of one bitmap that are asked for in one task

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: bytes) -> bytes:
    """SHA-256 over digests written as hex."""
    return hashlib.sha256(b"".join(p.hex().encode() for p in parts)).digest()


def levels(n: int) -> int:
    """Reductions by FANOUT until one of n nodes is left."""
    found = 0
    while n > 1:
        n, found = -(-n // FANOUT), found + 1
    return found


# Leaves ----------------------------------------------------------------------------------


def leaf(fields: list[Column]) -> Column:
    """The digest of a row: each field `-` if null, else its length in bytes, a colon and its value."""
    said = []
    for field in fields:
        value = field.cast("string")
        said.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*said), 256))


def leaves(docs: DataFrame, changed: Column | None = None, text: Column | None = None) -> DataFrame:
    """doc_id, source, leaf, found (the leaf of the row as it is found later) and n equal rows.

    `changed` says which rows are found with `text` in place of their own.
    """
    own = leaf([F.col(c) for c in FIELDS])
    rows = docs.select(*FIELDS)
    other = own
    if changed is not None:
        other = F.when(changed & (text != F.col("text")), leaf([*[F.col(c) for c in FIELDS[:-1]], text])).otherwise(own)
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), own.alias("leaf"), other.alias("found"))
    return rows.groupBy("source", "doc_id", "leaf", "found").agg(F.count("*").alias("n"))


# Bitmaps ---------------------------------------------------------------------------------


def compress(low: np.ndarray) -> bytes:
    """Distinct numbers below 2**LOW_BITS, in order, as a list of 16-bit numbers or as a bitmap."""
    if len(low) <= DENSE:
        return b"l" + low.astype("<u2").tobytes()
    bits = np.zeros(1 << LOW_BITS, np.uint8)
    bits[low] = 1
    return b"b" + np.packbits(bits, bitorder="little").tobytes()


def expand(data: bytes) -> np.ndarray:
    if data[:1] == b"l":
        return np.frombuffer(data, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=1), bitorder="little"))


class Ranks:
    """Ranks of ids within a bitmap: a directory of set bits before each 64-bit word, and a count within the word."""

    def __init__(self, data: bytes, repeated: bytes, times: bytes):
        bits = np.zeros(1 << LOW_BITS, np.uint8)
        bits[expand(data)] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        held = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(held) - held
        # ids of several rows, and the rows they have beyond the first before each of them
        self.repeated, times = np.frombuffer(repeated, "<u2").astype(np.int64), np.frombuffer(times, "<i8")
        self.more = np.concatenate([[0], np.cumsum(times - 1)])

    def __call__(self, low: np.ndarray) -> np.ndarray:
        word, bit = low >> 6, (low & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below).astype(np.int64) + self.more[np.searchsorted(self.repeated, low)]

    def several(self, low: np.ndarray) -> np.ndarray:
        return np.isin(low, self.repeated)


BITMAP = "source string, high long, ids binary, repeated binary, times binary, n long"


def _bitmap(source, high, low: np.ndarray, n: np.ndarray) -> tuple:
    """A row of BITMAP from low parts of ids, which may occur several times, and how many rows each stands for."""
    ids, at = np.unique(low, return_inverse=True)
    times = np.zeros(len(ids), np.int64)
    np.add.at(times, at, n)
    several = times > 1
    return source, high, compress(ids), ids[several].astype("<u2").tobytes(), times[several].astype("<i8").tobytes(), int(times.sum())


def _bitmaps(rows: list[tuple]) -> pa.Table:
    kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["source", "high", "ids", "repeated", "times", "n"])


def bitmaps(rows: DataFrame) -> DataFrame:
    """One bitmap per source and range of ids (`high`, null for rows without an id), merged from those of single batches."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("source").dictionary_encode()
            code = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            null = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").fill_null(0).to_numpy()
            n = batch.column("n").to_numpy()
            high = ids >> LOW_BITS
            order = np.lexsort((high, null, code))
            edge = np.flatnonzero((np.diff(code[order]) != 0) | (np.diff(high[order]) != 0) | (np.diff(null[order]) != 0)) + 1
            made = []
            for at in np.split(order, edge) if len(order) else []:
                source = names.dictionary[int(code[at[0]])].as_py() if code[at[0]] >= 0 else None
                made.append(_bitmap(source, None if null[at[0]] else int(high[at[0]]), ids[at] & ((1 << LOW_BITS) - 1), n[at]))
            yield from _bitmaps(made).to_batches()

    def merge(key, table):
        low, n = [], []
        columns = [table.column(c).to_pylist() for c in ("ids", "repeated", "times")]
        for ids, repeated, times in zip(*columns, strict=True):
            own = expand(ids)
            count = np.ones(len(own), np.int64)
            count[np.searchsorted(own, np.frombuffer(repeated, "<u2"))] = np.frombuffer(times, "<i8")
            low.append(own)
            n.append(count)
        return _bitmaps([_bitmap(key[0].as_py(), key[1].as_py(), np.concatenate(low), np.concatenate(n))])

    parts = rows.select("source", "doc_id", "n").mapInArrow(scan, BITMAP)
    return parts.groupBy("source", "high").applyInArrow(merge, BITMAP)


def _joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """`left` joined with a measured `right` by equal or both null `on`, whose columns are kept once."""
    other = hinted(right).withColumnsRenamed({c: f"_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on]
    return left.join(other, same, how).drop(*[f"_{c}" for c in on])


def _before(counts: DataFrame, within: list[str], by: str) -> DataFrame:
    """`counts` with the sum of n over smaller `by` (nulls last) among rows that share `within`."""
    earlier = Window.partitionBy(*within).orderBy(F.asc_nulls_last(by)).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def directory(maps: DataFrame) -> DataFrame:
    """`maps` with `base`, the rows of the source before each bitmap.

    Counts are added up digit by digit of the id, so no range has more than 2**DIGIT_BITS parts, however the ids lie.
    """
    one, two = F.shiftright("high", DIGIT_BITS), F.shiftright("high", 2 * DIGIT_BITS)
    low = _before(maps.select("source", "high", "n", one.alias("one"), two.alias("two")), ["source", "one"], "high")
    middle = _before(low.groupBy("source", "one", "two").agg(F.sum("n").alias("n")), ["source", "two"], "one")
    high = _before(middle.groupBy("source", "two").agg(F.sum("n").alias("n")), ["source"], "two")
    upper = _joined(middle.drop("n").withColumnRenamed("before", "b1"), high.select("source", "two", F.col("before").alias("b2")), ["source", "two"])
    base = _joined(low.select("source", "one", "high", "before"), upper.drop("two"), ["source", "one"])
    base = base.select("source", "high", (F.col("before") + F.col("b1") + F.col("b2")).alias("base"))
    return _joined(maps, base, ["source", "high"])


PLACED = "source string, doc_id long, leaf binary, found binary, n long, pos long, several boolean"


def placed(rows: DataFrame) -> DataFrame:
    """The rows of `leaves`, one for each leaf again, with their place `pos` among the leaves of their source.

    Places ascend by doc_id; leaves without one come last. Leaves that share an id follow one another by their digests.
    """
    maps = written(directory(written(bitmaps(rows), fresh_folder(rows.sparkSession, "bitmaps"))), fresh_folder(rows.sparkSession, "directory"))
    # one id may hold any share of the rows: its rows are dealt over several tasks, each with the bitmap
    hot = maps.where(F.col("n") > DEALT).select("source", "high", F.ceil(F.col("n") / DEALT).cast("int").alias("deals"))
    keyed = _joined(rows.withColumn("high", F.shiftright("doc_id", LOW_BITS)), hot, ["source", "high"], "left")
    deal = F.pmod(F.xxhash64("leaf"), F.coalesce("deals", F.lit(1))).cast("int")
    keyed = keyed.select("source", "high", deal.alias("deal"), "doc_id", "leaf", "found", "n")
    deals = F.greatest(F.lit(1), F.ceil(F.col("n") / DEALT)).cast("int")
    maps = maps.withColumn("deal", F.explode(F.sequence(F.lit(0), F.when(F.col("n") > DEALT, deals).otherwise(1) - 1)))

    def ask(key, asked, held):
        if not asked.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in _arrow(PLACED)})
        ranks = Ranks(*(held.column(c)[0].as_py() for c in ("ids", "repeated", "times")))
        low = asked.column("doc_id").fill_null(0).to_numpy() & ((1 << LOW_BITS) - 1)
        out = {c: asked.column(c) for c in ("source", "doc_id", "leaf", "found", "n")}
        return pa.table({**out, "pos": pa.array(ranks(low) + held.column("base")[0].as_py()), "several": pa.array(ranks.several(low))})

    keys = ("source", "high", "deal")
    found = keyed.groupBy(*keys).cogroup(maps.groupBy(*keys)).applyInArrow(ask, PLACED)
    found = written(found, fresh_folder(rows.sparkSession, "places"))
    several = _among_equals(found.where("several"))
    return found.where("not several").drop("several", "n").unionByName(several)


def _arrow(ddl: str) -> list[pa.Field]:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "int": pa.int32()}
    return [pa.field(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))]


def _among_equals(rows: DataFrame) -> DataFrame:
    """Rows that share an id, each moved on by those with smaller digests, and n equal rows as n rows.

    Digests are counted by their first bytes, so that one id of many rows is no group of its own.
    """
    rows = rows.withColumns({"d1": F.conv(F.substring(F.hex("leaf"), 1, 4), 16, 10).cast("int"), "d2": F.conv(F.substring(F.hex("leaf"), 5, 4), 16, 10).cast("int")})
    key = ["source", "doc_id"]
    one = _before(rows.groupBy(*key, "d1").agg(F.sum("n").alias("n")), key, "d1").withColumnRenamed("before", "b1")
    two = _before(rows.groupBy(*key, "d1", "d2").agg(F.sum("n").alias("n")), [*key, "d1"], "d2").withColumnRenamed("before", "b2")
    last = Window.partitionBy(*key, "d1", "d2").orderBy("leaf", "found").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("b3", F.coalesce(F.sum("n").over(last), F.lit(0)))
    for other, on in ((one, [*key, "d1"]), (two, [*key, "d1", "d2"])):
        rows = _joined(rows, other.drop("n"), on)
    part = 1 << 16
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(part).cast("long"))))
    turn = F.explode(F.sequence(F.col("part"), F.least(F.col("part") + part, F.col("n")) - 1)).alias("turn")
    rows = rows.select("source", "doc_id", "leaf", "found", (F.col("pos") + F.col("b1") + F.col("b2") + F.col("b3")).alias("first"), turn)
    return rows.select("source", "doc_id", "leaf", "found", (F.col("first") + F.col("turn")).alias("pos"))


# Trees -----------------------------------------------------------------------------------


def reduced(nodes: np.ndarray, steps: int) -> list[list[bytes]]:
    """The levels above `nodes` (themselves first), each from runs of FANOUT; a run may be short, even of one."""
    held = [list(nodes)]
    for _ in range(steps):
        last = held[-1]
        held.append([digest(*last[i : i + FANOUT]) for i in range(0, len(last), FANOUT)])
    return held


def siblings(held: list[list[bytes]], at: int) -> bytes:
    """What folds node `at` of the lowest level into the top: for each level its place in the run, the run's size, and the others."""
    out = []
    for level in held[:-1]:
        first, turn = at - at % FANOUT, at % FANOUT
        run = level[first : first + FANOUT]
        out.append(bytes([turn, len(run)]) + b"".join(run[:turn] + run[turn + 1 :]))
        at //= FANOUT
    return b"".join(out)


def fold(node: bytes, path: bytes) -> bytes:
    """The root that follows from a node and its siblings."""
    at = 0
    while at < len(path):
        turn, size = path[at], path[at + 1]
        others = [path[at + 2 + 32 * i : at + 34 + 32 * i] for i in range(size - 1)]
        node = digest(*others[:turn], node, *others[turn:])
        at += 2 + 32 * (size - 1)
    return node


def path_digests(path: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(path):
        size = path[at + 1]
        out += [path[at + 2 + 32 * i : at + 34 + 32 * i] for i in range(size - 1)]
        at += 2 + 32 * (size - 1)
    return out


ARRAY = "source string, block long, steps int, nodes binary, carried binary, top binary"


def _steps(n: Column) -> Column:
    """Levels of a tree over n leaves, in whole numbers."""
    powers = F.array(*[F.lit(FANOUT**k) for k in range(39)])
    return F.size(F.filter(powers, lambda p: p < n))


def arrays(nodes: DataFrame, sizes: DataFrame, round_: int) -> DataFrame:
    """Nodes put into arrays by place, each reduced by up to LEVELS levels: no more than its tree still has.

    `nodes`: source, pos, node, carried (bytes kept beside it); `sizes`: source, total (levels of its tree).
    """
    steps = F.least(F.lit(LEVELS), F.col("total") - LEVELS * round_).cast("int")
    rows = _joined(nodes, sizes.select("source", steps.alias("steps")), ["source"])
    rows = rows.select("source", F.floor(F.col("pos") / BLOCK).alias("block"), (F.col("pos") % BLOCK).cast("int").alias("slot"), "steps", "node", "carried")

    def reduce(key, table):
        n, steps = table.num_rows, table.column("steps")[0].as_py()
        slots, carried = [b""] * n, [b""] * n
        columns = [table.column(c).to_pylist() for c in ("slot", "node", "carried")]
        for slot, node, beside in zip(*columns, strict=True):  # the slots of an array are 0 to n - 1, each taken once
            slots[slot], carried[slot] = node, beside
        top = reduced(slots, steps)[-1][0]
        sizes = np.array([len(x) for x in carried], "<u2").tobytes()
        row = (key[0].as_py(), key[1].as_py(), steps, b"".join(slots), sizes + b"".join(carried), top)
        return pa.table([pa.array([x], f.type) for x, f in zip(row, _arrow(ARRAY), strict=True)], names=[f.name for f in _arrow(ARRAY)])

    return rows.groupBy("source", "block").applyInArrow(reduce, ARRAY)


def _opened(nodes: bytes, carried: bytes) -> tuple[list[bytes], list[bytes]]:
    held = [nodes[i : i + 32] for i in range(0, len(nodes), 32)]
    sizes = np.frombuffer(carried, "<u2", len(held)).astype(np.int64)
    ends = 2 * len(held) + np.cumsum(sizes)
    return held, [carried[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]


def trees(nodes: DataFrame, sizes: DataFrame, highest: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The arrays of every round, lowest first, and the root of each source: source, node.

    `highest` is the number of levels of the highest tree.
    """
    spark, rounds, done = nodes.sparkSession, [], None
    for k in range(max(1, math.ceil(highest / LEVELS))):
        here = sizes.where(F.col("total") > LEVELS * k) if k else sizes
        rounds.append(written(arrays(nodes, here, k), fresh_folder(spark, f"{label}-{k}")))
        tops = rounds[-1].select("source", F.col("block").alias("pos"), F.col("top").alias("node"), F.lit(b"").alias("carried"))
        tops = _joined(tops, sizes.select("source", "total"), ["source"])
        finished = tops.where(F.col("total") <= LEVELS * (k + 1)).select("source", "node")
        done = finished if done is None else done.unionByName(finished)
        nodes = tops.where(F.col("total") > LEVELS * (k + 1)).drop("total")
    return rounds, done


PATHS = "source string, pos long, node binary, carried binary, path binary"


def paths(table: DataFrame, above: DataFrame) -> DataFrame:
    """Every node of a round's arrays with the siblings up to the root; `above` has the rest of the way for each array."""
    above = above.select("source", F.col("pos").alias("block"), F.col("path").alias("rest"))
    rows = _joined(table, above, ["source", "block"], "left")
    rows = rows.select("source", "block", "steps", "nodes", "carried", F.coalesce("rest", F.lit(b"")).alias("rest"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                source, block, steps, data, beside, rest = (batch.column(j)[i].as_py() for j in range(6))
                held, carried = _opened(data, beside)
                tree = reduced(held, steps)
                own = [siblings(tree, slot) + rest for slot in range(len(held))]
                first = block * BLOCK
                columns = ([source] * len(held), range(first, first + len(held)), held, carried, own)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _arrow(PATHS), strict=True)], names=[f.name for f in _arrow(PATHS)])

    return rows.mapInArrow(scan, PATHS)


def _ways(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """The nodes of the lowest round with their siblings up to the end of `top`, the ways on from each tree's root."""
    way = top.withColumn("pos", F.lit(0).cast("long"))
    for table in reversed(rounds):
        # a tree that ends below this round has its own way on at place 0 still
        found = paths(table, way).select("source", "pos", "path")
        here = table.select("source").distinct().withColumn("here", F.lit(True))
        rest = _joined(way.select("source", "pos", "path"), here, ["source"], "left").where("here is null").drop("here")
        way = found.unionByName(rest)
    return way


MANIFEST = "source string, pos long, doc_id long, leaf binary, found binary, path binary"


def manifest(docs: DataFrame, changed: Column | None = None, text: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The manifest of `docs`, a row for each of its rows, and the sources: source, n (leaves), subroot, root.

    A manifest row has source, pos (its place in the source), doc_id, leaf, found, and path, its siblings up to the root (see `siblings`).
    Rows are digested as doc_id, source, lang, n_chars and text; `changed` and `text` say what is found later in
    their place. Defined cases: null fields are digested as such and source null is a source, the first one; leaves
    without an id are the last of their source; rows that share an id follow one another by their digests, and equal rows
    are leaves of their own; other columns are not read; an empty table has no leaves, no sources and no root.
    """
    spark = docs.sparkSession
    rows = written(leaves(docs, changed, text), fresh_folder(spark, "leaves"))
    nodes = placed(rows).select("source", "pos", F.col("leaf").alias("node"), _carried().alias("carried"))
    sizes = written(rows.groupBy("source").agg(F.sum("n").alias("n")), fresh_folder(spark, "sources"))
    totals = sizes.withColumn("total", _steps(F.col("n")))
    most = totals.agg(F.max("n"), F.count("*")).first()
    rounds, subroots = trees(nodes, totals, levels(most[0] or 0), "tree")

    # the trees' roots are the leaves of one more tree
    subroots = written(dense_ids(subroots.withColumnRenamed("node", "subroot"), ["source"], -1).withColumnRenamed("pid", "pos"), fresh_folder(spark, "subroots"))
    whole = spark.range(1 if most[1] else 0).select(F.lit(None).cast("string").alias("source"), F.lit(levels(most[1])).alias("total"))
    upper, root = trees(subroots.select(F.lit(None).cast("string").alias("source"), "pos", F.col("subroot").alias("node"), F.lit(b"").alias("carried")), whole, levels(most[1]), "root")
    end = whole.select("source", F.lit(b"").alias("path"))
    onward = _ways(upper, end).select("pos", "path")
    ways = written(subroots.join(hinted(onward), "pos").select("source", "path"), fresh_folder(spark, "ways"))

    way = ways.withColumn("pos", F.lit(0).cast("long"))
    if len(rounds) > 1:
        way = written(_ways(rounds[1:], ways), fresh_folder(spark, "paths"))
    found = _uncarried(paths(rounds[0], way))
    known = _joined(subroots, sizes, ["source"]).select("source", "n", "subroot")
    return found, written(known.crossJoin(F.broadcast(root.select(F.col("node").alias("root")))), fresh_folder(spark, "roots"))


def _carried() -> Column:
    """doc_id, and the leaf found later where it is another one, as bytes."""
    id_ = F.coalesce(F.unhex(F.lpad(F.hex("doc_id"), 16, "0")), F.lit(b""))
    other = F.when(F.col("found") != F.col("leaf"), F.col("found")).otherwise(F.lit(b""))
    return F.concat(id_, other)


def _uncarried(table: DataFrame) -> DataFrame:
    size = F.octet_length("carried")
    id_ = F.when(size % 32 == 8, F.conv(F.hex(F.substring(F.col("carried"), 1, 8)), 16, -10).cast("long"))
    other = F.when(size >= 32, F.expr("substring(carried, octet_length(carried) - 31, 32)")).otherwise(F.col("node"))
    return table.select("source", "pos", id_.alias("doc_id"), F.col("node").alias("leaf"), other.alias("found"), "path")


VERDICT = "proof binary, folded_root binary"


def verified(table: DataFrame, sources: DataFrame) -> DataFrame:
    """Every manifest row judged: doc_id, source, pos, leaf, subroot, root, proof_sha256, folded_root, verified.

    The root is folded anew from the leaf found and its siblings; digests are lowercase hex.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ways, leaf = batch.column("path").to_pylist(), batch.column("found").to_pylist()
            proofs = [digest(*path_digests(p)) for p in ways]
            roots = [fold(node, p) for node, p in zip(leaf, ways, strict=True)]
            kept = [batch.column(c) for c in ("source", "pos", "doc_id", "leaf")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(proofs, pa.binary()), pa.array(roots, pa.binary())], names=["source", "pos", "doc_id", "leaf", "proof", "folded_root"])

    rows = table.mapInArrow(scan, "source string, pos long, doc_id long, leaf binary, " + VERDICT)
    rows = _joined(rows, sources.select("source", "subroot", "root"), ["source"])
    text = lambda c: F.lower(F.hex(c))
    return rows.select(
        "doc_id",
        "source",
        "pos",
        text("leaf").alias("leaf"),
        text("subroot").alias("subroot"),
        text("root").alias("root"),
        text("proof").alias("proof_sha256"),
        text("folded_root").alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def checked(docs: DataFrame, changed: Column, text: Column) -> DataFrame:
    """The manifest of `docs` checked against rows of which `changed` ones have `text` now (see `verified`)."""
    return verified(*manifest(docs, changed, text))

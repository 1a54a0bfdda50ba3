"""Benchmark passages in documents, by a distributed positional inverted index.

The index holds a posting (term, document, position) for every word of the documents that the
benchmark knows, in term order within each file. For every window of the benchmark its two
rarest terms are looked up; their lists, adjusted by the terms' places in the item, are
intersected on (document, item, shift). What is left is compared word by word.

`near_passages` finds passages that were reworded in places: most of a window's terms within a span of words, in any order.
If at most m terms may be missing, at least two of the m + 2 rarest must be there: their lists are intersected on
(document, window, block of positions), and only what is left is counted in the texts. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accessaudit.llm.common import hinted, unused
from accessaudit.session import fresh_folder, written

WINDOW = 13

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATING = "".join(chr(c) for c in range(128) if not (0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A))
END = "\x00"  # no word; its posting tells a document's length


def words(text: Column) -> Column:
    """Lower-cased words: digits, letters and everything beyond ASCII. None for null."""
    trimmed = F.btrim(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(SEPARATING))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SEPARATORS))


def _documents(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text that tells rows of one doc_id apart, and the words."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("body"),
        words(F.col("text")).alias("words"),
    )


def _index(docs: DataFrame, items: DataFrame, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Items with words, their different texts (entries), the terms in them, and the postings of these terms in the documents."""
    spark = docs.sparkSession
    sources = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words"))
    sources = written(sources.where(F.size("words") > 0), f"{folder}/items")
    entries = sources.select("words").distinct().select(F.monotonically_increasing_id().alias("entry"), "words")
    entries = written(entries, f"{folder}/entries")
    placed = entries.select("entry", F.size("words").alias("size"), F.posexplode("words").alias("place", "word"))
    terms = placed.select("word").distinct().select((F.monotonically_increasing_id() + 1).alias("term"), "word")
    terms = terms.union(spark.range(1).select(F.lit(0).cast("long").alias("term"), F.lit(END).alias("word")))
    terms = written(terms, f"{folder}/terms")
    tokens = _documents(docs).select(
        "doc_id", "body", F.posexplode(F.concat("words", F.array(F.lit(END)))).alias("position", "word")
    )
    postings = tokens.join(hinted(terms), "word").select("term", "doc_id", "body", "position")
    return sources, entries, terms, written(postings.sortWithinPartitions("term"), f"{folder}/postings")


def _windows(entries: DataFrame, window: int) -> DataFrame:
    """Every `window` consecutive words of an entry, or all words of one that has fewer."""
    windows = entries.select(
        "entry",
        F.least(F.size("words"), F.lit(window)).alias("size"),
        F.explode(F.sequence(F.lit(0), F.size("words") - F.least(F.size("words"), F.lit(window)))).alias("first"),
        "words",
    )
    return windows.select("entry", "size", "first", F.slice("words", F.col("first") + 1, F.col("size")).alias("words"))


def _texts_of(docs: DataFrame, found: DataFrame) -> DataFrame:
    """id, of and whole (text) of the rows that `found` (doc_id, body, ...) names; no others are shuffled while these names fit a broadcast."""
    whole = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("of"), F.col("text").alias("whole")
    )
    named = found.select("doc_id", "body").distinct()
    return whole.join(hinted(named), F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("of") == F.col("body")), "left_semi")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it lies inside an occurrence of `window` consecutive words of an item, or
    of a whole item that has fewer. A document is contaminated if it has a hit and at least a
    twentieth of its words are hit. Defined cases: null and empty texts have no words and are
    clean; items without words occur nowhere; equal items all occur where one does; rows that
    share a doc_id are judged one by one; rows without a doc_id as well; items without an id
    are left out of n_items and items_sha256, yet their words are hit. Other columns are not read.
    """
    folder = fresh_folder(docs.sparkSession, "positions")
    sources, entries, terms, postings = _index(docs, items, folder)

    counts = postings.where("term > 0").groupBy("term").agg(F.count("*").alias("found"))
    vocabulary = terms.join(counts, "term").select("word", "term", "found")
    windows = _windows(entries, window)
    rarity = windows.select("entry", "first", "size", F.posexplode("words").alias("offset", "word"))
    rarity = rarity.join(vocabulary, "word").groupBy("entry", "first", "size").agg(
        F.sort_array(F.collect_list(F.struct("found", "term", (F.col("first") + F.col("offset")).alias("place")))).alias("rare")
    )
    # a window with a word that no document has occurs nowhere
    lookups = rarity.where(F.size("rare") == F.col("size")).select("entry", "first", F.slice("rare", 1, 2).alias("rare"))
    lookups = windows.join(lookups, ["entry", "first"]).select(
        "entry", "first", "size", F.array_join("words", " ").alias("passage"), F.col("rare.place").alias("places"), "rare"
    )
    lookups = written(lookups, f"{folder}/lookups")

    anchors = lookups.select("entry", F.explode("rare").alias("at")).select("entry", "at.term", "at.place").distinct()
    seen = postings.join(hinted(anchors), "term")
    seen = seen.select("doc_id", "body", "entry", (F.col("position") - F.col("place")).alias("shift"), "place")
    aligned = seen.groupBy("doc_id", "body", "entry", "shift").agg(F.collect_set("place").alias("matched"))
    shortest = lookups.groupBy("entry").agg(F.min(F.size("places")).alias("least"))
    aligned = aligned.join(hinted(shortest), "entry").where(F.size("matched") >= F.col("least")).drop("least")
    found = aligned.join(hinted(lookups.drop("rare")), "entry")
    found = found.where(F.size(F.array_except("places", "matched")) == 0).select(
        "doc_id", "body", F.struct((F.col("shift") + F.col("first")).alias("start"), "size", "passage", "entry").alias("hit")
    )
    candidates = found.where("hit.start >= 0").groupBy("doc_id", "body").agg(F.collect_list("hit").alias("hits"))
    candidates = written(candidates, f"{folder}/candidates")

    def occurs(hit: Column) -> Column:
        return F.array_join(F.slice("words", hit["start"] + 1, hit["size"]), " ") == hit["passage"]

    def cover(done: Column, hit: Column) -> Column:
        end = hit["start"] + hit["size"]
        fresh = F.greatest(F.lit(0), end - F.greatest(hit["start"], done["end"]))
        return F.struct(F.greatest(done["end"], end).alias("end"), (done["n"] + fresh).alias("n"))

    # texts are joined, not their words: they are smaller, and only those with candidates are split
    # hits repeat their passages, so their files are far smaller than they: not for Spark to broadcast by file size
    checked = _texts_of(docs, candidates).join(candidates.hint("merge"), F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("of") == F.col("body")))
    checked = checked.select("doc_id", "body", words(F.col("whole")).alias("words"), "hits")
    checked = checked.select("doc_id", "body", F.sort_array(F.filter("hits", occurs)).alias("hits"))
    nothing = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    checked = checked.where(F.size("hits") > 0).select(
        "doc_id",
        "body",
        F.aggregate("hits", nothing, cover)["n"].cast("long").alias("n_hit"),
        F.array_distinct(F.col("hits.entry")).alias("entries"),
    )
    checked = written(checked.dropDuplicates(["doc_id", "body"]), f"{folder}/checked")

    named = sources.where("item_id is not null").join(entries, "words").select("entry", "item_id").distinct()
    named = checked.select("doc_id", "body", F.explode("entries").alias("entry")).join(hinted(named), "entry")
    named = named.groupBy("doc_id", "body").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    hits = checked.join(named.withColumnsRenamed({"doc_id": "id", "body": "of"}), F.expr("doc_id <=> id and body = of"), "left")
    hits = hits.select(F.col("doc_id").alias("id"), F.col("body").alias("of"), "n_hit", "ids")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    n_words = F.col("position").cast("long")
    lengths = postings.where("term = 0")
    return lengths.join(hits, F.expr("doc_id <=> id and body = of"), "left").select(
        "doc_id",
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= n_words)).alias("contaminated"),
        "body",
    )


def near_passages(docs: DataFrame, items: DataFrame, window: int = WINDOW, span: int = 2 * WINDOW, share: float = 0.8) -> DataFrame:
    """Proximity matches, one row per document and item that has any: doc_id, body, item_id, place, start, n_found, n_terms.

    A window of an item (`window` consecutive words, or the whole of a shorter item) matches where `share` of its different
    words, rounded up, lie within `span` consecutive words of the document, in any order. Told is the item's best window:
    the one with the most words found, then the first in the item; `start` is the document's first word from which `span` words hold
    that many. Exact occurrences are matches too. Defined cases are those of `contamination`; items without an id are left out;
    rows that share doc_id and text are told once. Other columns are not read.
    """
    if not 1 <= window <= 60:
        raise ValueError("a window has 1 to 60 words")
    folder = fresh_folder(docs.sparkSession, "near")
    sources, entries, terms, postings = _index(docs, items, folder)
    counts = postings.where("term > 0").groupBy("term").agg(F.count("*").alias("found"))
    vocabulary = terms.where("term > 0").join(counts, "term", "left").select("word", "term", F.coalesce("found", F.lit(0)).alias("found"))
    windows = _windows(entries, window).select("entry", "first", F.array_distinct("words").alias("terms"))
    needed = F.ceil(F.size("terms") * F.lit(share)).cast("int")
    windows = windows.select("entry", "first", "terms", F.greatest(needed, F.lit(1)).alias("needed"))
    ranked = windows.select("entry", "first", "needed", F.size("terms").alias("n"), F.explode("terms").alias("word")).join(vocabulary, "word")
    ranked = ranked.groupBy("entry", "first", "needed", "n").agg(F.sort_array(F.collect_list(F.struct("found", "term"))).alias("rare"))
    # of any n - needed + k terms, k are found; what no document holds is among the rarest
    both = F.least(F.lit(2), F.col("needed"))
    anchors = ranked.where(F.size(F.filter("rare", lambda t: t["found"] > 0)) >= F.col("needed"))
    anchors = anchors.select("entry", "first", both.alias("both"), F.posexplode(F.slice("rare", 1, F.col("n") - F.col("needed") + both)).alias("rank", "at"))
    anchors = written(anchors.select("entry", "first", "both", "rank", "at.term"), f"{folder}/anchors")

    seen = postings.join(hinted(anchors), "term")
    block = F.floor(F.col("position") / span)  # a span that begins in a block ends in the next one at the latest
    seen = seen.withColumn("block", F.explode(F.array(block - 1, block))).where("block >= 0")
    held = F.bit_or(F.expr("shiftleft(1L, rank)")).alias("held")
    near = seen.groupBy("doc_id", "body", "entry", "first", "both", "block").agg(held).where("bit_count(held) >= both")
    near = near.groupBy("doc_id", "body", "entry", "first").agg(F.sort_array(F.collect_list("block")).alias("blocks"))
    near = written(near.join(hinted(windows), ["entry", "first"]), f"{folder}/near")

    texts = _texts_of(docs, near).dropDuplicates(["id", "of"])
    joined = texts.join(hinted(near), F.expr("id <=> doc_id and of = body"))
    joined = joined.select("doc_id", "body", "entry", "first", "needed", "terms", words(F.col("whole")).alias("words"), F.explode("blocks").alias("block"))
    around = F.slice("words", (F.col("block") * span + 1).cast("int"), 2 * span)
    starts = F.sequence(F.lit(0), F.lit(span - 1))

    def counted(at: Column) -> Column:
        n = F.size(F.array_intersect(F.col("terms"), F.slice("around", at + 1, span)))
        return F.struct(n.alias("n"), (-(F.col("block") * span + at)).cast("int").alias("back"))

    found = joined.withColumn("around", around).withColumn("best", F.array_max(F.transform(starts, counted)))
    found = found.where("best.n >= needed").select(
        "doc_id", "body", "entry", F.struct(F.col("best.n").alias("n"), (-F.col("first")).alias("place"), "best.back", F.size("terms").alias("terms")).alias("best")
    )
    found = found.groupBy("doc_id", "body", "entry").agg(F.max("best").alias("best"))
    named = sources.where("item_id is not null").join(entries, "words").select("entry", "item_id").distinct()
    return found.join(hinted(named), "entry").select(
        "doc_id",
        "body",
        "item_id",
        (-F.col("best.place")).alias("place"),
        (-F.col("best.back")).alias("start"),
        F.col("best.n").alias("n_found"),
        F.col("best.terms").alias("n_terms"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` that are not contaminated, with all their columns.

    Defined cases are those of `contamination`; rows that share a doc_id are judged each by its own text; columns may have any names.
    """
    id_, body_ = unused(docs, "dirty_id"), unused(docs, "dirty_body")
    dirty = contamination(docs, items, window).where("contaminated").select(F.col("doc_id").alias(id_), F.col("body").alias(body_))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_))
    body = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))) == F.col(body_)
    return docs.join(dirty, same & body, "left_anti")

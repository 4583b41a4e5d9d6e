"""Benchmark decontamination (operator 9): SimHash windows, Hamming blocks, weighted shingles.

A document leaks an item if one of its item-sized windows of words has a
weighted-shingle similarity of 0.8 or more with the item: shingles of five
words, weighted by how often they occur, sum of minima over sum of maxima.

1. A window that similar shares shingles with the item, so windows are laid
   only where a document's shingle lines up with the same shingle of an
   item (same distance from the start), at the item's length, moved inside
   the document's ends.  Items are few and given; their shingles are
   broadcast if there are at most ``BROADCAST_SHINGLES`` of them and joined
   by shuffle otherwise.
2. The k-th of several equal shingles is a feature of its own, so the share
   of features in common is the weighted similarity.  Windows and items get
   SimHash fingerprints of 512 bits over these features: each bit is the
   majority of their hash bits, summed in packed lanes by one aggregate.
3. Multi-index Hamming search: fingerprints are cut into 32 blocks of 16
   bits.  Two that differ in at most ``RADIUS`` = 127 bits differ in at most
   3 bits of some block.  Each item is entered under all 697 values within 3
   bits of each of its blocks, so an equi-join on (length, block, value)
   finds every pair within the radius: these are the candidates, and their
   distance is then checked in full.  Of pairs of strangers of one length a
   third of a row comes out of the join each, and none has passed the
   distance (they differ in 256 bits, with a deviation of 11).  At similarity
   0.8 the mean distance is 77 bits with a deviation of 8: six deviations
   below the radius (``tests/llm`` measure it).
4. The similarity of the candidates is worked out exactly.

Built-in functions only.  Texts are shuffled once, to meet their windows;
rows with a shingle that is in very many documents spread by document.

Defined results: a null or empty text, and an item without words, match
nothing; an item with fewer words than a shingle is one shingle, matched
by windows of its length; a document shorter than an item is one window;
repeated rows get the same verdict, rows of one doc_id with different texts
their own; repeated items are reported each; an empty table gives an empty
table; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import materialize, release

SHINGLE = 5
SIMILARITY = 0.8
WORDS, BITS = 8, 512  # a fingerprint: eight longs
BLOCK_BITS = 16
BLOCKS = BITS // BLOCK_BITS
#: Bits in which a block may differ; by the pigeonhole principle this finds all pairs within the radius.
BLOCK_RADIUS = 3
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Item shingles that may be broadcast (24 bytes each).
BROADCAST_SHINGLES = 1_000_000


def _hashes(text: str) -> Column:
    """Hashes of the lower-cased words of a text, in order."""
    return F.expr(f"transform(filter(split(lower({text}), r'[\\x20\\t-\\r]+'), w -> w <> ''), w -> xxhash64(w))")


def _shingles(words: str, k: int) -> Column:
    """Hashes of the k-word shingles, in order; none if there are fewer words."""
    at = ", ".join(f"{words}[i + {j}]" for j in range(k))
    return F.expr(f"case when size({words}) >= {k} then transform(sequence(0, size({words}) - {k}), i -> xxhash64({at})) else cast(array() as array<bigint>) end")


def counted(rows: DataFrame, key: str) -> DataFrame:
    """(key, length, s, c): how often each shingle of ``shingles`` occurs."""
    return rows.select(key, "length", F.explode("shingles").alias("s")).groupBy(key, "length", "s").agg(F.count("*").alias("c"))


def fingerprints(counts: DataFrame, keys: list[str]) -> DataFrame:
    """SimHash of the numbered shingles of each key: columns f0..f7 and their number ``n``.

    Two bits are counted in the halves of one long.
    """
    rows = counts.select(*keys, F.explode(F.expr("transform(sequence(1, cast(c as int)), j -> xxhash64(s, j))")).alias("x"))
    rows = rows.select(*keys, *[F.expr(f"xxhash64(x, {j})").alias(f"x{j}") for j in range(WORDS)])
    sums = [F.sum(F.expr(f"shiftright(x{j}, {b}) & 4294967297L")).alias(f"c{j}_{b}") for j in range(WORDS) for b in range(32)]
    df = rows.groupBy(*keys).agg(F.count("*").alias("n"), *sums)

    def word(j: int) -> Column:
        bits = [f"shiftleft(cast((c{j}_{b} & 4294967295L) * 2 > n as bigint), {b})" for b in range(32)]
        bits += [f"shiftleft(cast(shiftrightunsigned(c{j}_{b}, 32) * 2 > n as bigint), {b + 32})" for b in range(32)]
        return F.expr(" | ".join(bits)).alias(f"f{j}")

    return df.select(*keys, "n", *(word(j) for j in range(WORDS)))


def _blocks(df: DataFrame, keep: list[str]) -> DataFrame:
    """A row for each block of a fingerprint: (block, value)."""
    per = BLOCKS // WORDS
    values = ", ".join(f"struct({j * per + b} as block, cast(shiftrightunsigned(f{j}, {b * BLOCK_BITS}) & {(1 << BLOCK_BITS) - 1} as int) as value)" for j in range(WORDS) for b in range(per))
    return df.select(*keep, F.inline(F.expr(f"array({values})")))


def _neighbours(blocks: DataFrame) -> DataFrame:
    """A row for each value within ``BLOCK_RADIUS`` bits of a block's."""
    masks = [m for m in range(1 << BLOCK_BITS) if m.bit_count() <= BLOCK_RADIUS]
    return blocks.withColumn("mask", F.explode(F.lit(masks))).withColumn("value", F.col("value").bitwiseXOR(F.col("mask"))).drop("mask")


def near(windows: DataFrame, items: DataFrame) -> DataFrame:
    """(window, item) whose fingerprints lie within ``RADIUS``: found by their blocks, held against the full distance."""
    left, right = _blocks(windows, ["window", "length"]), _neighbours(_blocks(items, ["item", "length"]))
    # Hinted: Spark takes the values for as few as the blocks they come from, and would broadcast them.
    pairs = left.join(right.hint("merge"), ["value", "block", "length"]).select("window", "item").distinct()
    pairs = pairs.join(windows.select("window", *(f"f{j}" for j in range(WORDS))), "window")
    pairs = pairs.join(items.select("item", *(F.col(f"f{j}").alias(f"g{j}") for j in range(WORDS))), "item")
    apart = sum((F.bit_count(F.col(f"f{j}").bitwiseXOR(F.col(f"g{j}"))) for j in range(WORDS)), F.lit(0))
    return pairs.where(apart <= RADIUS).select("window", "item")


def prepared_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, item_id, length, k, shingles) of every item with words."""
    df = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    df = df.withColumn("w", _hashes("text")).where(F.size("w") > 0).withColumn("length", F.size("w")).withColumn("k", F.least("length", F.lit(SHINGLE)))
    by_k = F.when(F.col("k") == SHINGLE, _shingles("w", SHINGLE))
    for k in range(1, SHINGLE):
        by_k = by_k.when(F.col("k") == k, _shingles("w", k))
    return materialize(df.select(F.monotonically_increasing_id().alias("item"), "item_id", "length", "k", by_k.alias("shingles")), "items")


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_key, item_id, start, length, similarity): the best window of each leaked item of each document.

    ``text_key`` is the 64-bit hash of the text; with doc_id it names a row's content.
    """
    it = prepared_items(items, item_id_col, item_text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    texts = texts.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    rows = it.select("k", "length", F.posexplode("shingles").alias("at", "s"))
    places = materialize(rows.select("k", "length", "at", "s").distinct(), "item-places")
    small = places.count() <= BROADCAST_SHINGLES
    found = None
    for (k,) in sorted(tuple(r) for r in it.select("k").distinct().collect()):  # at most five
        p = places.where(F.col("k") == k).select("s", "length", "at", "k")
        hits = texts.select("doc_id", "text_key", _hashes("text").alias("w")).select("doc_id", "text_key", F.size("w").alias("words"), _shingles("w", k).alias("x"))
        # Outer: for the inner form Spark infers a filter on the array, which would repeat the work on every word.
        hits = hits.select("doc_id", "text_key", "words", F.posexplode_outer("x").alias("pos", "s")).join(F.broadcast(p) if small else p, "s")
        start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("at"), F.col("words") - F.col("length")))
        hits = hits.select("doc_id", "text_key", start.alias("start"), "length", "k").distinct()
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, text_key long, item_id long, start int, length int, similarity double")
    found = materialize(found, "windows")

    # The windows' shingles: each text with windows meets them once.
    per_doc = found.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "length", "k")).alias("windows"))
    per_doc = materialize(per_doc.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "windows"), "windows-of")
    met = texts.join(per_doc.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")))
    met = met.select("doc_id", "text_key", "windows", _hashes("text").alias("w")).dropDuplicates(["doc_id", "text_key"])
    win = met.select("doc_id", "text_key", "w", F.inline("windows")).select("doc_id", "text_key", "start", "length", "k", F.expr("slice(w, start + 1, length)").alias("w"))
    by_k = F.when(F.col("k") == SHINGLE, _shingles("w", SHINGLE))
    for k in range(1, SHINGLE):
        by_k = by_k.when(F.col("k") == k, _shingles("w", k))
    win = materialize(win.select(F.monotonically_increasing_id().alias("window"), "doc_id", "text_key", "start", "length", by_k.alias("shingles")), "window-shingles")

    wc = materialize(counted(win, "window"), "window-counts")
    ic = materialize(counted(it, "item"), "item-counts")
    wf = materialize(fingerprints(wc, ["window", "length"]), "window-prints")
    fi = materialize(fingerprints(ic, ["item", "length"]), "item-prints")
    pairs = materialize(near(wf, fi), "near-pairs")
    ours = pairs.join(wc.select("window", "s", F.col("c").alias("cw")), "window")
    common = ours.join(ic.select("item", "s", F.col("c").alias("ci")), ["item", "s"]).groupBy("window", "item").agg(F.sum(F.least("cw", "ci")).alias("both"))
    sized = common.join(wf.select("window", F.col("n").alias("nw")), "window").join(fi.select("item", F.col("n").alias("ni")), "item")
    good = sized.withColumn("similarity", F.col("both") / (F.col("nw") + F.col("ni") - F.col("both"))).where(F.col("similarity") >= similarity)
    named = good.join(win.select("window", "doc_id", "text_key", "start", "length"), "window").join(it.select("item", "item_id"), "item")
    best = F.max_by(F.struct("start", "length", "similarity"), F.struct("similarity", -F.col("start"))).alias("best")
    out = named.groupBy("doc_id", "text_key", "item", "item_id").agg(best)
    out = materialize(out.select("doc_id", "text_key", "item_id", "best.start", "best.length", "best.similarity"), "leaks")
    for written in (it, places, found, per_doc, win, wc, ic, wf, fi, pairs):
        release(written)
    return out


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, leaked, n_items, item_ids, similarity) of every document."""
    found = leaks(docs, items, id_col, text_col)
    # Items are a given set, and a document's list holds each at most once.
    by = found.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list("item_id")).alias("ids"), F.max("similarity").alias("best"))
    keys = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("t0"))
    out = keys.join(by, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t0") == F.col("t")), "left")
    n = F.coalesce("n", F.lit(0)).cast("long")
    return out.select("doc_id", (n > 0).alias("leaked"), n.alias("n_items"), F.coalesce("ids", F.array().cast("array<long>")).alias("item_ids"), F.col("best").alias("similarity"))


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that leak an item; all columns as they were."""
    found = leaks(docs, items, id_col, text_col).select(F.col("doc_id").alias("l_id"), F.col("text_key").alias("l_key")).distinct()
    found = materialize(found, "leaking")
    same = docs[f"`{id_col}`"].cast("long").eqNullSafe(found["l_id"]) & (F.xxhash64(docs[f"`{text_col}`"].cast("string")) == found["l_key"])
    return docs.join(found.hint("shuffle_hash"), same, "left_anti")

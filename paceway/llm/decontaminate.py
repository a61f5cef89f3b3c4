"""Benchmark decontamination by a prefix-filtered set join with exact checks.

An item is cut into windows of ``size`` consecutive words (an item of fewer words is one window). A text holds a window only if it holds all of the window's
words, so one necessary word per window is enough to look it up: the rarest, counted over the whole corpus. Words of the texts are
joined with these prefix words; a hit gives the place where the window would have to start, which must lie inside the
text (length and positional bound), and the words there are compared with the window's, all of them. The join, the bounds and the comparison are one pass
over the texts without a shuffle. Windows go out in blocks of ``block`` rows, dealt by window and not by prefix word, so what is broadcast is bounded, however many items there are and
however many windows share a word; more blocks mean more passes. Hits carry the id and a hash of the text, not a number given during a scan, so passes and repeated tasks agree on whose they are. Only hits and ids are shuffled.

Words are those of :func:`paceway.llm.text.words`. Edge cases: null or wordless texts have ``n_words = 0`` and are clean; null or wordless items have no window;
repeated rows are judged one by one; several items with a window in common all count; empty tables give no rows, or clean rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceway.llm.text import NOT_WORD, ascii_lower
from paceway.runtime import written

#: Rows of a broadcast block; a window of 13 words takes about 300 bytes, so a block stays near 20 MB.
BLOCK = 1 << 16


def _words(c):
    # The pattern takes whole runs, so only the ends can be empty.
    return F.array_remove(F.split(ascii_lower(F.col(c)), NOT_WORD), "")


def windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", size: int = 13) -> DataFrame:
    """``(item, win)``: the different windows of each item, as arrays of words."""
    rows = items.select(F.col(item_col).alias("item"), _words(text_col).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    rows = rows.select("item", "words", F.explode(starts).alias("start"))
    return rows.select("item", F.slice("words", F.col("start"), size).alias("win")).distinct()


def _blocks(table: DataFrame, key: str, block: int) -> list[DataFrame]:
    """The table in parts of about ``block`` rows, at least one; a part is fit to be broadcast."""
    n = max(1, -(-table.count() // block))
    return [table.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) if n > 1 else table for i in range(n)]


def hits(docs: DataFrame, items: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text="text", size=13, block=BLOCK):
    """Where windows occur: ``(id, sign, n_words, start, len, window)``, and ``(window, item)``.

    Every row of the texts has one with ``len = 0``, which carries its number of words; ``sign`` is a hash of the text.
    """
    pairs = written(windows(items, item_col, item_text, size), "item_windows")
    wins = written(pairs.select("win").distinct().withColumn("window", F.monotonically_increasing_id()), "windows")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select("id", F.xxhash64("text").alias("sign"), _words("text").alias("words"))

    # Rarity over the whole corpus, of the words that windows have.
    vocabulary = written(wins.select(F.explode("win").alias("word")).distinct(), "vocabulary")
    single = texts.select(F.explode("words").alias("word"))
    counts = None
    for part in _blocks(vocabulary, "word", block):
        seen = single.join(F.broadcast(part), "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
        counts = seen if counts is None else counts.union(seen)
    counts = written(counts, "rarity")

    # A window with a word that no text has cannot occur: the inner join leaves it short of words.
    placed = wins.select("window", F.size("win").alias("len"), F.posexplode("win").alias("off", "word")).join(counts, "word")
    rare = placed.groupBy("window", "len").agg(F.min(F.struct("n", "word", "off")).alias("rare"), F.count("*").alias("found")).where("found = len")
    prefixes = rare.join(wins.select("window", "win"), "window").select(F.col("rare.word").alias("word"), F.col("rare.off").alias("off"), "len", "win", "window")
    prefixes = written(prefixes, "prefixes")

    every = docs.sparkSession.range(1).select(
        F.lit("").alias("word"), F.lit(0).alias("off"), F.lit(0).alias("len"), F.array().cast("array<string>").alias("win"), F.lit(None).cast("long").alias("window")
    )
    found = None
    for i, part in enumerate(_blocks(prefixes, "window", block)):
        looked = F.concat(F.array(F.lit("")), "words") if i == 0 else F.concat(F.array(F.lit(None).cast("string")), "words")
        spread = texts.select("id", "sign", "words", F.posexplode(looked).alias("pos", "word"))
        start = F.when(F.col("len") == 0, F.lit(1)).otherwise(F.col("pos") - F.col("off"))
        met = spread.join(F.broadcast(part.unionByName(every) if i == 0 else part), "word").withColumn("start", start)
        inside = (F.col("start") >= 1) & (F.col("start") + F.col("len") - 1 <= F.size("words"))
        same = F.slice("words", F.greatest(F.col("start"), F.lit(1)), F.col("len")) == F.col("win")
        met = met.where((F.col("len") == 0) | (inside & same))
        met = met.select("id", "sign", F.size("words").cast("long").alias("n_words"), "start", "len", "window")
        found = met if found is None else found.union(met)
    return written(found, "hits"), pairs.join(wins, "win").select("window", "item")


def _with(rows: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """The rows with a column of what was found for their id, which may be null, and text."""
    f = found.select(F.col("id").alias("_id"), F.col("sign").alias("_sign"), column)
    return rows.join(f, F.col("id").eqNullSafe(F.col("_id")) & (F.col("sign") == F.col("_sign")), "left").drop("_id", "_sign")


def judge(docs: DataFrame, items: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text="text", size=13, share=20, block=BLOCK) -> DataFrame:
    """One row per input row: ``id, sign, n_words, n_hit, n_items, items_sha256, contaminated``.

    ``n_hit`` counts the words inside any occurrence of a window; a text is contaminated from one part in ``share`` of its words on.
    """
    found, owners = hits(docs, items, id_col, text_col, item_col, item_text, size, block)
    # Rows alike in id and text have the same hits; a set leaves out their repetitions before the shuffle.
    spans = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end"))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))

    def step(acc, s):
        new = F.greatest(s["end"] - F.greatest(s["start"], acc["upto"]), F.lit(0))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(acc["upto"], s["end"]).alias("upto"))

    hit = found.where("len > 0")
    counted = hit.groupBy("id", "sign").agg(spans.alias("spans")).select("id", "sign", F.aggregate("spans", zero, step, lambda a: a["n"]).alias("n"))
    named = hit.select("id", "sign", "window").distinct().join(owners, "window").groupBy("id", "sign").agg(F.collect_set(F.col("item").cast("string")).alias("items"))
    rows = found.where("len = 0").select("id", "sign", "n_words")
    out = _with(_with(rows, counted, "n"), named, "items").withColumn("n_hit", F.coalesce("n", F.lit(0).cast("long")))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "id",
        "sign",
        "n_words",
        "n_hit",
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array(items_of)), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, id_col="doc_id", text_col="text", **how) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns as they are."""
    bad = judge(docs, items, id_col, text_col, **how).where("contaminated").select("id", "sign").distinct()
    same = docs[f"`{id_col}`"].eqNullSafe(bad["id"]) & (F.xxhash64(docs[f"`{text_col}`"]) == bad["sign"])
    return docs.join(bad, same, "left_anti")

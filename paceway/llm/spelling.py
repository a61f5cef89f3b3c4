"""Spelling variants: words of a vocabulary within one edit of each other, by dynamic programming over sorted lists.

**Counts.** Tasks count the words of whole texts and emit one row per different word; the counts are added up by word.

**Groups.** Two words of lengths L and L or L + 1 that are one edit apart agree in all that lies before and behind the edit. The positions 0..L are cut into windows of ``span``, or into eight where a word is longer than that; a word stands
in one group for each window and each L it can have: the words that share what lies outside the window. A pair is reported only where the window holds the place at which it
first differs, so by exactly one group. Groups of more than ``crowded`` words have their windows halved until they are small or one position wide, and a group of one position holds no more words
than there are letters and pairs of letters: no group is unbounded and no pair is lost.

**Scan.** In a group the parts inside the window stand sorted. For each word the list behind it is scanned once: rows of the banded edit matrix (three cells wide) are kept by depth, the next word goes on from the row at its
common prefix with the word before, and once a row has no cell within one edit, all words that share that prefix are skipped.

A word's form is its near word of largest count (ties: the first in code-point order), where that count is at least ``dominance`` times its own. Roots follow forms to the last by pointer doubling; counts at least double
with each step for a ``dominance`` of 2, so a chain of k forms needs about log2(k) rounds.

Edge cases: null and empty texts have no words; repeated rows count as often as they come; a null id is written as ``null`` where it is hashed; words of any length, and texts of any length, are read whole (in pieces that
end between words); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceway.runtime import workspace, written


def _counter(typo_every: int | None, least_length: int, flush_words: int = 300_000, flush_bytes: int = 64_000_000, piece: int = 1 << 20):
    """Batch function ``(id as text, text)`` to ``(word, n)``, made here so that it travels to the workers by value."""

    def run(batches):
        import re
        import zlib
        from collections import Counter

        import pyarrow as pa

        # A-Z become small, letters stay, all else parts words. In UTF-8 the letters U+00C0..U+00FF are C3 80 .. C3 BF.
        kept = bytes(range(97, 123)) + bytes(range(128, 256))
        table = bytes(b + 32 if 65 <= b <= 90 else b if b in kept else 32 for b in range(256))
        usual = bytes([*range(128), 0xC3, *range(0x80, 0xC0)])
        foreign = re.compile("[^\x00-\x7fÀ-ÿ]+")
        crc32, counts, seen = zlib.crc32, {}, 0

        def out():
            words = pa.array(list(counts), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        def pieces(data):
            at = 0
            while at < len(data):
                end = data.find(b" ", at + piece)
                end = len(data) if end < 0 else end
                yield data[at:end]
                at = end

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            for i in range(batch.num_rows):
                data = texts[i].as_py()
                if data.translate(None, usual):
                    data = foreign.sub(" ", data.decode()).encode()
                start = crc32(f"{ids[i].as_py()}:".encode())
                for part in pieces(data.translate(table)):
                    seen += len(part)
                    for word, n in Counter(part.split()).items():
                        if len(word) < least_length:
                            continue
                        if typo_every:
                            h = crc32(word, start)
                            if not h % typo_every:
                                text = word.decode()
                                place = h % len(text)
                                word = (text[:place] + text[place + 1 :]).encode()
                        counts[word] = counts.get(word, 0) + n
                    if len(counts) >= flush_words or seen >= flush_bytes:
                        yield out()
                        counts, seen = {}, 0
        if counts:
            yield out()

    return run


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3, typo_every: int | None = None) -> DataFrame:
    """``word, n`` of the words of at least ``least_length`` code points and ``least_count`` occurrences.

    A word is a maximal run of A-Z, a-z and U+00C0..U+00FF with A-Z as a-z. With ``typo_every``, a run loses one code point wherever ``typo_every`` divides the CRC-32 h of ``<id>:<run>``: that at h modulo its length.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.col(text_col).alias("text")).where("text <> ''")
    counted = rows.mapInArrow(_counter(typo_every, least_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where((F.col("n") >= least_count) & (F.length("word") >= least_length))


def _scanner(flush: int = 50_000):
    """Batch function: rows ``key, size, a, e, word, n`` sorted by key to pairs one edit apart. ``size`` is L; the window is the positions a <= p < e."""

    def first_difference(v, w):
        for p, (x, y) in enumerate(zip(v, w)):  # noqa: B905  lengths may differ by one
            if x != y:
                return p
        return min(len(v), len(w))

    def near(parts):
        """Pairs (i, j), i < j, of the sorted different ``parts`` that are one edit apart."""
        far, m = 9, len(parts)
        common = [0, *map(first_difference, parts, parts[1:])]
        rows = [None] * (max(map(len, parts)) + 2)
        for i in range(m - 1):
            q, n = parts[i], len(parts[i])
            # Row d has the costs from d letters of a listed word to d-1, d and d+1 letters of q; what is common to both costs nothing.
            depth = common[i + 1]
            for d in range(depth + 1):
                rows[d] = (1 if d else far, 0, 1 if d < n else far)
            j = i + 1
            while j < m:
                v = parts[j]
                size, dead = len(v), False
                row = rows[depth]
                while depth < size:
                    c = v[depth]
                    x, y, z = row
                    one = min(x + (q[depth - 1] != c), y + 1) if 0 < depth <= n else 1 if not depth else far
                    two = min(y + (q[depth] != c), z + 1, one + 1) if depth < n else far
                    three = min(z + (q[depth + 1] != c), two + 1) if depth + 1 < n else far
                    depth += 1
                    rows[depth] = row = (one, two, three)
                    if one > 1 and two > 1 and three > 1:
                        dead = True
                        break
                if not dead and -1 <= n - size <= 1 and row[n - size + 1] == 1:
                    yield i, j
                j += 1
                if dead:
                    while j < m and common[j] >= depth:
                        j += 1
                if j < m:
                    depth = min(depth, common[j])

    def run(batches):
        import pyarrow as pa

        out = ([], [], [], [])

        def batch_of():
            arrays = [pa.array(c, t) for c, t in zip(out, [pa.string(), pa.int64()] * 2, strict=True)]
            for c in out:
                c.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["word", "n", "near", "near_n"])

        def report(group):
            size, a, e = group[0][:3]
            tail = max(0, size - e)
            listed = sorted((w[a : len(w) - tail], w, n) for _, _, _, w, n in group)
            for i, j in near([part for part, _, _ in listed]):
                (_, v, n), (_, w, k) = listed[i], listed[j]
                # Two words of L + 1 letters belong to the groups of that length.
                if min(len(v), len(w)) == size and a <= first_difference(v, w) < e:
                    for column, x in zip(out, (v, n, w, k), strict=True):
                        column.append(x)

        key, group = None, []
        for batch in batches:
            keys, *columns = (c.to_pylist() for c in batch.columns)
            for k, row in zip(keys, zip(*columns, strict=True), strict=True):
                if k != key:
                    if len(group) > 1:
                        report(group)
                        if len(out[0]) >= flush:
                            yield batch_of()
                    key, group = k, []
                group.append(row)
        if len(group) > 1:
            report(group)
        if out[0]:
            yield batch_of()

    return run


def _keyed(rows: DataFrame) -> DataFrame:
    """Add the group's key: what lies outside the window."""
    return rows.withColumn("key", F.expr("concat_ws(' ', size, a, e, substr(word, 1, a), substr(word, length(word) - greatest(size - e, 0) + 1))"))


def near_pairs(vocabulary: DataFrame, span: int = 4, crowded: int = 5_000, windows: int = 8) -> DataFrame:
    """``word, n, near, near_n``: each pair of words one inserted, deleted or replaced code point apart, once.

    ``vocabulary`` has different words with counts and should be stored: it is read for every halving of crowded groups. Long words have ``windows`` windows, each the wider.
    """
    rows = vocabulary.select("word", "n", F.explode(F.expr("array(length(word), length(word) - 1)")).alias("size")).where("size > 0")
    rows = rows.withColumn("pieces", F.expr(f"least(ceil((size + 1) / {span}), {windows})")).withColumn("c", F.explode(F.expr("sequence(0L, pieces - 1)")))
    rows = _keyed(rows.selectExpr("size", "int(c * (size + 1) div pieces) as a", "int((c + 1) * (size + 1) div pieces) as e", "word", "n"))
    while True:
        big = rows.where("e - a > 1").groupBy("key").agg(F.count("*").alias("members")).where(F.col("members") > crowded).select("key")
        if big.isEmpty():
            break
        halves = rows.join(big, "key", "left_semi").withColumn("half", F.explode(F.array(F.lit(0), F.lit(1))))
        halves = halves.selectExpr("size", "if(half = 1, int((a + e) div 2), a) as a", "if(half = 0, int((a + e) div 2), e) as e", "word", "n")
        rows = rows.join(big, "key", "left_anti").select("size", "a", "e", "word", "n", "key").unionByName(_keyed(halves))
    dealt = rows.select("key", "size", "a", "e", "word", "n").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_scanner(), "word string, n long, near string, near_n long")


def roots(forms: DataFrame, keep) -> DataFrame:
    """``word, root`` for ``forms`` (``word, form``), by pointer doubling; ``keep(df, name)`` stores a round's table."""
    now = forms.select("word", F.col("form").alias("root"))
    turn = 0
    while True:
        to = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = keep(now.join(to, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), f"roots-{turn}")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now, turn = now.select("word", "root"), turn + 1


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = 5,
    least_count: int = 3,
    dominance: float = 2,
    typo_every: int | None = None,
    span: int = 4,
    crowded: int = 5_000,
) -> DataFrame:
    """One row per word of the vocabulary: ``word, form, root, n, n_near, form_n``."""
    with workspace(docs.sparkSession, "spelling") as keep:
        words = keep(count_words(docs, id_col, text_col, least_length, least_count, typo_every), "words")
        pairs = near_pairs(words, span, crowded)
        both = pairs.select(F.explode(F.expr("array(struct(word, near, near_n), struct(near as word, word as near, n as near_n))")).alias("p")).select("p.*")
        best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
        table = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))
        wins = F.col("form_n") >= dominance * F.col("n")
        table = keep(table.withColumns({"form": F.when(wins, F.col("form")), "form_n": F.when(wins, F.col("form_n"))}), "forms")
        ends = roots(table.where("form is not null"), keep)
        out = table.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
        return written(out, "variants")

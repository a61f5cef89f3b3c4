"""Near duplicates by BagMinHash: documents as bags of shingles, compared by weighted Jaccard similarity.

**Signature.** A bag maps a shingle to its number of occurrences. Each shingle owns a Poisson process per dyadic range of weights, (0, 1], (1, 2], (2, 4] and so on, with the
width of the range as rate; each point falls on one of ``bands * rows`` components and, by halving the range bit by bit, on one unit of weight. A bag takes the points
on units it has, and a component keeps its earliest. Equal components then have the chance of the weighted Jaccard similarity, without bias for whole weights.
Points come in ascending order, so a process ends once it is later than all components of its document: most shingles stop at their first point.

**Candidates.** Texts with the same words are one node. Nodes that agree on all rows of a band share a bucket. With 24 bands of 4 rows a pair at similarity
0.8 shares none with a chance of 3e-6.

**Verification** counts the overlap of both bags. Pairs of a bucket are never all written out. First every member is compared with three hubs, among them the node that shares most buckets, which in a group of copies
is the original; links join components. Then what is still apart from the hub's component is compared with all members outside its own component, but for pairs that three exact bounds rule out
(see :func:`_rest`). So every candidate pair is compared, ruled out, or joined by a path of verified links: the classes are those of all links.

Edge cases: words are those of :func:`paceway.llm.text.words`; a text of fewer than ``size`` words is one shingle; null, empty and wordless texts are similar to nothing and form
a class each; repeated rows are members of one class; null ids rank lowest; an empty table gives no rows; other columns are not read, and :func:`keep` returns them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from paceway.llm.graph import components
from paceway.runtime import small_batches, written

#: Rounds of hubs before the rest of a bucket is compared exactly.
ROUNDS = 1
#: Members of a bucket that a task of the rest holds against all others of it; a larger bucket is dealt over more tasks.
REST_BLOCK = 2048


def _kernel():
    """The numeric helpers, made here so that they travel to the workers by value."""
    import numpy as np

    u64, wrap = np.uint64, 0xFFFFFFFFFFFFFFFF
    golden, c1, c2 = u64(0x9E3779B97F4A7C15), u64(0xBF58476D1CE4E5B9), u64(0x94D049BB133111EB)

    def mix(x):
        x = (x ^ (x >> u64(30))) * c1
        x = (x ^ (x >> u64(27))) * c2
        return x ^ (x >> u64(31))

    def powers(base, n):
        out = np.full(n, base, u64)
        if n:
            out[0] = 1
        return np.cumprod(out, dtype=u64)

    byte = np.arange(256)
    lowered = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
    is_word = (lowered >= 128) | ((lowered >= 97) & (lowered <= 122)) | ((lowered >= 48) & (lowered <= 57))
    value = mix((lowered.astype(u64) + u64(1)) * golden)

    def shingles(texts, size):
        """Sorted shingle hashes of each text, one after the other, with the number each text has, and a digest of each text's words."""
        import hashlib

        data = np.frombuffer(b"\n".join(t.encode("utf-8", "replace") for t in texts) + b"\n", np.uint8)
        ends = np.cumsum([len(t.encode("utf-8", "replace")) + 1 for t in texts])
        inside = is_word[data]
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        starts, lengths = edges[0::2], edges[1::2] - edges[0::2]
        first = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum()) - np.repeat(first, lengths)
        weights = value[data[inside]] * powers(u64(0x100000001B3), int(lengths.max(initial=0)) + 1)[place]
        words = mix(np.add.reduceat(weights, first) ^ (lengths.astype(u64) * golden)) if len(first) else np.zeros(0, u64)
        n = np.bincount(np.searchsorted(ends, starts, "right"), minlength=len(texts))
        begin = np.cumsum(n) - n
        digests = [hashlib.md5(words[b : b + k].tobytes()).hexdigest() if k else None for b, k in zip(begin.tolist(), n.tolist(), strict=True)]
        many = np.where(n >= size, n - size + 1, np.minimum(n, 1))
        at = np.cumsum(many) - many
        start = np.repeat(begin - at, many) + np.arange(many.sum())
        short = np.repeat(np.minimum(n, size), many)
        padded = np.concatenate([words, np.zeros(size, u64)])
        hashes = short.astype(u64)
        for j in range(size):
            hashes = hashes * u64(0xD6E8FEB86659FD93) + np.where(j < short, padded[start + j], u64(0))
        hashes = mix(hashes)
        for b, k in zip(at.tolist(), many.tolist(), strict=True):
            hashes[b : b + k].sort()
        return hashes, many, digests

    def bags(hashes, many):
        """``(document, shingle, weight)`` of sorted hashes."""
        doc = np.repeat(np.arange(len(many)), many)
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        return doc[at], hashes[at], np.diff(at, append=len(hashes))

    def signatures(doc, elem, weight, n_docs, m):
        """Earliest points, one row of ``m`` for each document."""
        who, base, low, width, have = [], [], [], [], []
        lo, wide = 0, 1
        while len(doc):
            who.append(doc)
            base.append(mix(elem ^ u64((lo + 1) * int(c2) & wrap)))
            low.append(np.full(len(doc), lo))
            width.append(np.full(len(doc), wide))
            have.append(weight)
            lo, wide = lo + wide, max(1, lo + wide)
            more = weight > lo
            doc, elem, weight = doc[more], elem[more], weight[more]
        out = np.full((n_docs, m), np.inf)
        if not who:
            return out
        who, base, low, width, have = (np.concatenate(x) for x in (who, base, low, width, have))
        latest, time, step = np.full(n_docs, np.inf), np.zeros(len(who)), 0
        flat = out.reshape(-1)
        while len(who):
            step += 1
            bits = mix(base + u64(step * int(golden) & wrap))
            time = time - np.log(((bits >> u64(11)) + u64(1)) * 2.0**-53) / width
            live = time <= latest[who]
            who, base, low, width, have, time, bits = (x[live] for x in (who, base, low, width, have, time, bits))
            if not len(who):
                break
            bits = mix(bits ^ c1)
            part = ((bits >> u64(32)) * u64(m)) >> u64(32)
            unit = low + (((bits & u64(0xFFFFFFFF)) * width.astype(u64)) >> u64(32)).astype(np.int64)
            taken = unit < have
            np.minimum.at(flat, who[taken] * m + part[taken].astype(np.int64), time[taken])
            seen = np.unique(who)
            latest[seen] = out[seen].max(axis=1)
        return out

    def band_keys(points, bands):
        """A hash of each band's rows."""
        bits = points.view(u64).reshape(len(points), bands, -1)
        keys = np.broadcast_to(mix(np.arange(1, bands + 1).astype(u64) * golden), bits.shape[:2])
        for j in range(bits.shape[2]):
            keys = mix(keys * c2 + bits[:, :, j])
        return keys.view(np.int64)

    def numbered(hashes):
        """A bag as a set: the k-th occurrence of a shingle is an element of its own."""
        if not len(hashes):
            return hashes
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        at = np.flatnonzero(new)
        return np.sort(mix(hashes + (np.arange(len(hashes)) - np.repeat(at, np.diff(at, append=len(hashes)))).astype(u64) * golden))

    def similarity(a, b):
        both = len(np.intersect1d(a, b, assume_unique=True))
        return both / max(1, len(a) + len(b) - both)

    return shingles, bags, signatures, band_keys, numbered, similarity


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """``id, text_key, words, n, keys``: a digest of text and of its words, the number of shingles, the hash of each band."""
    kernel = _kernel()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        shingles, bags, signatures, band_keys, _, _ = kernel

        def sketched(batch):
            texts = batch.column(2).to_pylist()
            hashes, many, digests = shingles(texts, size)
            keys = band_keys(signatures(*bags(hashes, many), len(texts), bands * rows), bands)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * bands, pa.int32()), pa.array(keys.reshape(-1)))
            columns = [batch.column(0), batch.column(1), pa.array(digests, pa.string()), pa.array(many, pa.int64()), lists]
            return pa.RecordBatch.from_arrays(columns, names=["id", "text_key", "words", "n", "keys"])

        for batch in batches:
            lengths = batch.column(2).nbytes and np.diff(np.frombuffer(batch.column(2).cast(pa.large_string()).buffers()[1], np.int64, len(batch) + 1, batch.column(2).offset * 8))
            at = 0
            while at < len(batch):  # parts of about a megabyte
                upto = at + 1
                room = 1_000_000 - lengths[at]
                while upto < len(batch) and room >= lengths[upto]:
                    room -= lengths[upto]
                    upto += 1
                yield sketched(batch.slice(at, upto - at))
                at = upto

    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).select("id", F.md5("text").alias("text_key"), "text")
    fields = [("id", texts.schema["id"].dataType), ("text_key", T.StringType()), ("words", T.StringType()), ("n", T.LongType()), ("keys", T.ArrayType(T.LongType()))]
    return texts.mapInArrow(run, T.StructType([T.StructField(*f) for f in fields]))


def compared(pairs: DataFrame, texts: DataFrame, threshold: float, size: int) -> DataFrame:
    """The pairs ``(a, b)`` of texts ``(node, n, text)`` with their ``similarity``; pairs too different in size to reach the threshold are left out."""
    kernel = _kernel()

    def run(batches):
        import pyarrow as pa

        shingles, _, _, _, numbered, similarity = kernel
        last, last_bag = None, None

        def bag(text):
            return numbered(shingles([text], size)[0])

        for batch in batches:
            a, out = batch.column(0).to_pylist(), []
            for i in range(len(batch)):
                if a[i] != last:  # pairs come sorted by their first node
                    last, last_bag = a[i], bag(batch.column(2)[i].as_py())
                out.append(similarity(last_bag, bag(batch.column(3)[i].as_py())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["a", "b", "similarity"])

    first = texts.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("text").alias("ta"))
    second = texts.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("text").alias("tb"))
    near_in_size = F.least("na", "nb") >= threshold * F.greatest("na", "nb") - 1e-9
    met = pairs.join(second, "b").join(first, "a").where(near_in_size)
    return met.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long, similarity double")


def _shared_at_most(texts: DataFrame, size: int) -> DataFrame:
    """``(node, most)``: how many of its shingles a node can share with any other of these nodes; an occurrence that no other has is out."""
    kernel = _kernel()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        shingles, _, _, _, numbered, _ = kernel
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                elements = numbered(shingles([text], size)[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(elements), node, np.int64)), pa.array(elements.view(np.int64))], names=["node", "element"])

    each = texts.select("node", "text").mapInArrow(run, "node long, element long")
    shared = each.groupBy("element").agg(F.count("*").alias("holders"), F.min("node").alias("node"))
    alone = shared.where("holders = 1").groupBy("node").agg(F.count("*").alias("alone"))
    return texts.join(alone, "node", "left").select("node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("most"))


def _outlines(texts: DataFrame, size: int) -> DataFrame:
    """``(node, outline)``: how many elements of the bag fall on each of 1,024 parts, the k-th 16 numbers having a bit for each part with at least k.

    Two bags share at most as many elements as the bits that both outlines have.
    """
    kernel = _kernel()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        shingles, _, _, _, numbered, _ = kernel
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                counts = np.bincount((numbered(shingles([text], size)[0]) & np.uint64(1023)).astype(np.int64), minlength=1024)
                levels = counts[None, :] >= np.arange(1, counts.max() + 1)[:, None]
                out.append(np.packbits(levels, axis=1).view(np.int64).reshape(-1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], names=["node", "outline"])

    return texts.select("node", "text").mapInArrow(run, "node long, outline array<long>")


def _rounds(buckets: DataFrame, texts: DataFrame, threshold: float, size: int, rounds: int) -> DataFrame:
    """``(node, root)`` of the components that all links between members of a bucket make.

    ``buckets (key, node, rank)``; of high rank are nodes that share large buckets, as the original of many copies does.
    """
    none = buckets.sparkSession.createDataFrame([], "a long, b long, similarity double")
    stars, tried, centres = none.select(F.col("a").alias("node"), F.col("b").alias("root")), none, None
    for turn in range(rounds + 1):
        rooted = buckets.join(stars, "node", "left").select("key", "node", "rank", F.coalesce("root", "node").alias("root"))
        ends = F.min("root").alias("least"), F.max("root").alias("most"), F.max_by("root", "rank").alias("main")
        still = rooted.groupBy("key").agg(*ends).where("least <> most").select("key", "main")
        members = written(rooted.join(still, "key"), "members")  # of the buckets that hold more than one component
        if members.isEmpty():
            break
        apart = members.where("root <> main")
        if turn < rounds:
            # Hubs: the node of highest rank, inside the main component and outside it, and any other outside, a new one in every round.
            inner = members.where("root = main").groupBy("key").agg(F.max_by("node", "rank").alias("hub"))
            outer = (apart.groupBy("key").agg(by("node", order).alias("hub")) for by, order in ((F.max_by, F.col("rank")), (F.min_by, F.xxhash64("node", F.lit(turn)))))
            centres = inner if centres is None else centres
            hubs = inner.union(next(outer)).union(next(outer)).distinct()
            pairs = hubs.join(members.select("key", "node"), "key").select(F.col("hub").alias("a"), F.col("node").alias("b"))
        else:
            pairs = _rest(members, apart, centres, tried, texts, threshold, size)
        pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = pairs.join(tried, ["a", "b"], "left_anti")
        found = written(compared(pairs, texts, threshold, size), "compared")
        links = found.where(F.col("similarity") >= threshold)
        stars = components(stars.union(links.select("b", "a")).toDF("a", "b"))
        tried = tried.union(found)
    return stars


def _rest(members: DataFrame, apart: DataFrame, centres: DataFrame | None, tried: DataFrame, texts: DataFrame, threshold: float, size: int) -> DataFrame:
    """Pairs of a bucket in different components that may still be linked.

    Three exact bounds leave out what cannot: the overlap is at most what both can share with anyone here, and at most what their outlines share; and, distance being a metric, two nodes are at least as far
    apart as their distances to the bucket's first hub differ. The nodes outside the main component are dealt in blocks of about ``REST_BLOCK``, so a large bucket is the work of many tasks.
    """
    blocks = apart.groupBy("key").agg(F.ceil(F.count("*") / REST_BLOCK).cast("int").alias("blocks"))
    nodes = members.select("node").distinct()
    left = written(texts.join(nodes, "node", "left_semi"), "left")
    limits = written(_shared_at_most(left, size).join(_outlines(left, size), "node"), "limits")
    if centres is None:
        far = members.select("key", "node", F.lit(None).cast("double").alias("far"))
    else:
        seen = tried.select(F.col("a").alias("hub"), F.col("b").alias("node"), "similarity").union(tried.select("b", "a", "similarity"))
        far = members.select("key", "node").join(centres, "key").join(seen, ["hub", "node"]).select("key", "node", (1 - F.col("similarity")).alias("far"))
    known = members.join(blocks, "key").join(far, ["key", "node"], "left").join(limits, "node").select("key", "blocks", "node", "root", "main", "n", "most", "far", "outline")
    known = written(known, "rest")
    one = known.where("root <> main").select("key", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), *(F.col(c).alias(f"a_{c}") for c in ("node", "root", "n", "most", "far", "outline")))
    other = known.select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "main", *(F.col(c).alias(f"b_{c}") for c in ("node", "root", "n", "most", "far", "outline")))
    small = 1e-9

    def enough(overlap):
        return overlap >= threshold * (F.col("a_n") + F.col("b_n") - overlap) - small

    can_share = enough(F.least("a_most", "b_most"))
    bits = F.zip_with("a_outline", "b_outline", lambda x, y: F.coalesce(F.bit_count(x.bitwiseAND(y)), F.lit(0)))
    in_outline = enough(F.aggregate(bits, F.lit(0), lambda total, n: total + n))
    near = F.coalesce(F.abs(F.col("a_far") - F.col("b_far")) <= 1 - threshold + small, F.lit(True))
    met = one.join(other, ["key", "block"]).where((F.col("a_root") != F.col("b_root")) & ((F.col("b_root") == F.col("main")) | (F.col("a_node") < F.col("b_node"))) & F.when(can_share & near, in_outline).otherwise(False))
    return met.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def find(docs: DataFrame, id_col="doc_id", text_col="text", threshold=0.8, size=5, bands=24, rows=4, rounds=ROUNDS) -> DataFrame:
    """One row per input row: ``id, text_key, class_id`` (least id of the class), ``group_size``, ``kept`` (one row of each class, with that id)."""
    with small_batches(docs.sparkSession):
        sketched = written(sketches(docs, id_col, text_col, size, bands, rows).withColumn("row", F.monotonically_increasing_id()), "sketches")
        nodes = sketched.where("words is not null").groupBy("words").agg(F.min("text_key").alias("text_key"), F.first("n").alias("n"), F.first("keys").alias("keys"))
        nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
        spread = nodes.select("node", F.explode("keys").alias("key"))
        shared = spread.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
        buckets = written(spread.join(shared, "key"), "buckets")
        rank = F.shiftleft(F.sum("members"), 24) + F.shiftrightunsigned(F.xxhash64("node"), 40)
        buckets = written(buckets.join(buckets.groupBy("node").agg(rank.alias("rank")), "node").select("key", "node", "rank"), "ranked")

        wanted = buckets.select("node").distinct().join(nodes.select("node", "n", "text_key"), "node")
        texts = docs.select(F.coalesce(text_col, F.lit("")).alias("text")).withColumn("text_key", F.md5("text"))
        texts = written(texts.join(wanted, "text_key").groupBy("node", "n").agg(F.first("text").alias("text")), "texts")
        roots = _rounds(buckets, texts, threshold, size, rounds)

        labels = nodes.join(roots, "node", "left").select("words", F.coalesce("root", "node").alias("root"))
        members = written(sketched.select("id", "text_key", "words", "row").join(labels, "words", "left").drop("words"), "labels")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    classes = members.where("root is not null").groupBy("root").agg(F.min(order).alias("top"), F.count("*").alias("size"))
    alone = F.col("root").isNull()
    return members.join(classes, "root", "left").select(
        "id",
        "text_key",
        F.when(alone, F.col("id")).otherwise(F.col("top.id")).alias("class_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("top.row"))).alias("kept"),
    )


def keep(docs: DataFrame, id_col="doc_id", text_col="text", **how) -> DataFrame:
    """One row of ``docs`` for each class, with its columns as they are."""
    stays = find(docs, id_col, text_col, **how).where("kept").select("id", "text_key")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    text = F.coalesce(F.col("doc").getField(text_col), F.lit(""))
    whole = whole.withColumns({"id": F.col("doc").getField(id_col), "text_key": F.md5(text)})
    counts = stays.groupBy("id", "text_key").agg(F.count("*").alias("places"))
    same = whole["id"].eqNullSafe(counts["id"]) & (whole["text_key"] == counts["text_key"])
    met = whole.join(counts, same).select("doc", whole["id"], whole["text_key"], "places")
    nth = F.row_number().over(Window.partitionBy("text_key", "id").orderBy(F.lit(1)))
    return met.withColumn("nth", nth).where("nth <= places").select("doc.*")

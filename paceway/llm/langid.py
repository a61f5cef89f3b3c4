"""Language identification by fusing evidence in Bayes' way.

The posterior of a language is proportional to the product of

* the likelihood of the text: byte trigrams, hashed into a fixed number of cells, tempered by ``weight`` because neighbouring trigrams are not independent;
* the likelihood of the declared language: how often each declaration goes with each language, counted over all rows, smoothed towards an honest declaration;
* the likelihood of the last label of the address, where that is a country with one main language;
* the prior of the host: language shares of host, domain, suffix and all rows, each smoothed towards the next wider one. A row's own share is taken out first, so it never backs itself.

The counts are grouped aggregations of text posteriors over all rows, folded before the shuffle; a host of very many rows meets its shares in a join that can be
split. The class ``und`` stands for text that no language explains better than chance.

The languages are all labels that stand with at least one text with letters, counted over all rows. The trigram model is fitted on a bounded, documented sample of the different labelled texts of each language
(``sample`` texts of a language at most in the mean, chosen by a hash of the text, whole texts), so a language that is rare keeps its texts at every size and a text counts once for its language however many
copies it has. The size of the model is fixed: ``CELLS`` per language.

Edge cases: null text, empty text and text without letters are ``und`` with confidence 1 and are rejected; an unknown or missing declaration, host or suffix says nothing;
repeated rows are judged one by one (each counts for the host); ties go to the language that comes first by name; an empty training table makes all rows ``und``; an empty table gives
no rows; other columns are not read, and :func:`keep` returns them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceway.runtime import small_batches, written

CELLS = 1 << 16
UNKNOWN = "und"
#: What a cell counts before anything is seen; small, so that text of unseen trigrams is no language's.
UNSEEN = 0.02
#: What a text must hold to have a trigram.
LETTER = r"[A-Za-z]|[^\x00-\x7F]"

# Main language of a country's address suffix.
SUFFIX_LANGUAGE = {
    "at": "de",
    "au": "en",
    "de": "de",
    "es": "es",
    "fr": "fr",
    "ie": "en",
    "mx": "es",
    "nz": "en",
    "uk": "en",
    "us": "en",
}


def _grams():
    """The functions that find trigrams and part lists of texts, made here so that they travel to the workers by value."""
    import numpy as np

    byte = np.arange(256)
    low = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
    low = np.where(low < 33, 32, low).astype(np.uint32)
    letter = (low >= 128) | ((low >= 97) & (low <= 122))
    shift = 32 - (CELLS - 1).bit_length()

    def grams(texts):
        """Cells of all trigrams that have a letter, and how many each text has."""
        parts = [b" " + t.encode("utf-8", "replace") + b" " for t in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        data = np.frombuffer(b"".join(parts), np.uint8)
        code, alpha = low[data], letter[data]
        cells = ((code[:-2] * np.uint32(65536) + code[1:-1] * np.uint32(256) + code[2:]) * np.uint32(2654435761)) >> np.uint32(shift)
        good = alpha[:-2] | alpha[1:-1] | alpha[2:]
        ends = np.cumsum(sizes)
        for e in ends[:-1]:  # trigrams over the seam of two texts
            good[e - 2 : e] = False
        total = np.concatenate([[0], np.cumsum(good)])
        ends = np.minimum(ends, len(good))
        return cells[good], np.diff(total[ends], prepend=0)

    def parts(texts, size=1_000_000):
        """Ranges of the list with about ``size`` characters each."""
        at, n = 0, 0
        for i, t in enumerate(texts):
            n += len(t)
            if n >= size:
                yield at, i + 1
                at, n = i + 1, 0
        if at < len(texts):
            yield at, len(texts)

    return grams, parts


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = 4000):
    """``(languages, table)``: names in order, and log probabilities of the cells, one row per language and one for ``und``.

    ``sample`` is the number of different texts of each language to learn from, in the mean.
    """
    import numpy as np

    (grams, parts), n_cells = _grams(), CELLS
    known = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null").where(F.col("text").rlike(LETTER))
    different = known.select("lang", F.xxhash64("text").alias("h")).distinct()
    sizes = {r["lang"]: r["count"] for r in different.groupBy("lang").count().collect()}  # one row for each language
    below = [F.lit(x) for lang, n in sizes.items() for x in (lang, math.ceil(min(1.0, sample / n) * 2**32))]
    chosen = known.where(F.shiftrightunsigned(F.xxhash64("text"), 32) < F.create_map(*below)[F.col("lang")]) if sizes else known
    chosen = chosen.distinct()  # copies are folded before the shuffle

    def count(batches):
        import pyarrow as pa

        sums = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in parts(texts):
                cells, n = grams(texts[a:b])
                for lang, piece in zip(langs[a:b], np.split(cells, np.cumsum(n)[:-1]), strict=True):
                    sums[lang] = sums.get(lang, 0) + np.bincount(piece, minlength=n_cells)
        for lang, hits in sums.items():
            cells = np.flatnonzero(hits)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cells), pa.string()), pa.array(cells), pa.array(hits[cells])], names=["lang", "cell", "n"])

    def dense(cells):
        import pyarrow as pa

        counts = np.zeros(n_cells)
        counts[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
        return pa.table({"lang": cells.column("lang")[:1], "counts": pa.array([counts.tobytes()], pa.binary())})

    sums = chosen.mapInArrow(count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    packed = sums.groupBy("lang").applyInArrow(dense, "lang string, counts binary")  # CELLS rows a language become one
    with small_batches(docs.sparkSession):
        counts = {r["lang"]: np.frombuffer(r["counts"]) for r in packed.collect()}
    languages = sorted(counts)
    rows = [np.log((counts[name] + UNSEEN) / (counts[name].sum() + UNSEEN * CELLS)) for name in languages]
    return languages, np.array([*rows, np.full(CELLS, -math.log(CELLS))], np.float32)


def likelihoods(rows: DataFrame, model, weight: float, prior) -> DataFrame:
    """``rows`` with column ``text`` replaced by ``n`` (trigrams), ``logs`` (log likelihood times ``weight`` by language, ``und`` last) and ``p`` (their posterior under ``prior``, given as logs)."""
    (grams, parts), table = _grams(), model[1]
    at = rows.columns.index("text")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts, n_all, logs_all = batch.column(at).to_pylist(), [np.zeros(0, np.int64)], [np.zeros((0, len(table)))]
            for a, b in parts(texts):
                cells, n = grams(texts[a:b])
                ends = np.cumsum(n)
                logs = np.zeros((b - a, len(table)))
                for k, row in enumerate(table):
                    total = np.concatenate([[0.0], np.cumsum(row[cells], dtype=np.float64)])
                    logs[:, k] = weight * (total[ends] - total[ends - n])
                n_all.append(n)
                logs_all.append(logs)
            n, logs = np.concatenate(n_all), np.concatenate(logs_all)
            p = np.exp(logs + prior - (logs + prior).max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            places = pa.array(np.arange(len(n) + 1) * len(table), pa.int32())
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), *(pa.ListArray.from_arrays(places, pa.array(x.reshape(-1))) for x in (logs, p))], names=names)

    fields = [f for f in rows.schema.fields if f.name != "text"]
    fields += [T.StructField("n", T.LongType()), T.StructField("logs", T.ArrayType(T.DoubleType())), T.StructField("p", T.ArrayType(T.DoubleType()))]
    names = [f.name for f in fields]
    return rows.mapInArrow(run, T.StructType(fields))


def _summed(rows: DataFrame, key: str, column: str, k: int, to: str) -> DataFrame:
    """Sums by ``key`` of the ``k`` entries of an array, as an array."""
    sums = rows.groupBy(key).agg(*(F.sum(F.col(column)[i]).alias(f"s{i}") for i in range(k)))
    return sums.select(key, F.array(*(f"s{i}" for i in range(k))).alias(to))


def _fuser(names: list[str], total, said, by_suffix: dict, smoothing: float):
    """Batch function: rows of :func:`likelihoods` with the sums of their host ``h``, domain ``d`` and ``suffix`` to the language found, its confidence and that of the text alone."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        k = len(names)
        of = {name: i for i, name in enumerate(names)}
        labels = pa.array(names)

        def array(column):
            """A list column as a matrix; no list counts as zeros."""
            out = np.zeros((len(column), k))
            have = column.is_valid().to_numpy(zero_copy_only=False)
            out[have] = column.flatten().to_numpy().reshape(-1, k)
            return out, have

        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                col = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: B023, E731
                n, (logs, _), (p, _) = col("n").to_numpy(), array(col("logs")), array(col("p"))
                own = np.where(n[:, None] > 0, p, 0.0)
                share = (np.maximum(total - own, 0) + 1) / (total.sum() - own.sum(1, keepdims=True) + k)
                for level in "sdh":
                    sums, have = array(col(level))
                    others = np.where(have[:, None], np.maximum(sums - own, 0), 0.0)
                    share = (others + smoothing * share) / (others.sum(1, keepdims=True) + smoothing)
                spoken = said[[of.get(x, -1) for x in col("declared").to_pylist()]]
                placed = np.array([by_suffix.get(x, zeros) for x in col("suffix").to_pylist()]).reshape(-1, k)
                score = logs + np.log(share) + spoken + placed
                score = np.exp(score - score.max(1, keepdims=True))
                score /= score.sum(1, keepdims=True)
                found, alone = (np.where(n > 0, x.argmax(1), k - 1) for x in (score, p))
                sure = np.where(n > 0, score.max(1), 1.0)
                yield pa.RecordBatch.from_arrays(
                    [col("id"), col("sign"), labels.take(pa.array(found)), pa.array(sure), labels.take(pa.array(alone)), col("declared"), col("host")],
                    names=["id", "sign", "lang", "confidence", "text_lang", "declared", "host"],
                )

    zeros = [0.0] * len(names)
    return run


def identify(
    rows: DataFrame,
    model,
    id_col: str,
    text: Column,
    declared: Column | None = None,
    host: Column | None = None,
    weight: float = 0.25,
    unknown: float = 0.01,
    smoothing: float = 20.0,
    trust: float = 0.8,
    least: float = 0.5,
) -> DataFrame:
    """One row per input row: ``id, sign`` (digest of the text), ``lang, confidence, text_lang, declared, host, rejected``.

    ``unknown`` is the prior of ``und``, ``smoothing`` the weight of a wider level in rows, ``trust`` the chance that a declaration or suffix is honest before anything is
    counted, and ``least`` the confidence below which a row is rejected. Shares and logs are arrays with an entry for each language, so plans grow with the number of languages, not with its powers.
    """
    import numpy as np

    languages, names = model[0], [*model[0], UNKNOWN]
    k, many = len(names), len(model[0])
    none = F.lit(None).cast("string")
    text = F.coalesce(text, F.lit(""))
    lang = F.lower(F.substring_index(F.trim(declared), "-", 1)) if declared is not None else none
    host = F.nullif(F.lower(host), F.lit("")) if host is not None else none
    evidence = rows.select(F.col(id_col).alias("id"), F.md5(text).alias("sign"), F.when(lang.isin(*languages), lang).alias("declared") if many else none.alias("declared"), host.alias("host"), text.alias("text"))
    prior = np.array([math.log((1 - unknown) / max(1, many))] * many + [math.log(unknown)])
    with small_batches(rows.sparkSession):
        scored = written(likelihoods(evidence, model, weight, prior), "evidence")
    has = scored.where("n > 0")

    # What declarations are worth: log chance of each declaration by language, one row per declaration and a last one of zeros for none.
    pairs = {r["declared"]: r["s"] for r in _summed(has.where("declared is not null"), "declared", "p", k, "s").collect()}  # one row for each language
    counted = np.array([pairs.get(d, [0.0] * k) for d in languages]).reshape(many, k)
    first = np.full((many, k), 1 / max(1, many))
    if many > 1:
        first[:, :many] = np.where(np.eye(many, dtype=bool), trust, (1 - trust) / (many - 1))
    said = np.vstack([np.log((counted + smoothing * first) / (counted.sum(0) + smoothing)), np.zeros(k)])
    by_suffix = {}
    for suffix, name in SUFFIX_LANGUAGE.items():
        if name in languages and many > 1:
            by_suffix[suffix] = np.log(many * np.append(first[languages.index(name), :many], 1 / many)).tolist()

    # Shares of host, domain and suffix, from the smallest groups up.
    hosts = _summed(has.where("host is not null"), "host", "p", k, "h")
    hosts = written(hosts.withColumns({"domain": F.substring_index("host", ".", -2), "suffix": F.substring_index("host", ".", -1)}), "hosts")
    domains, suffixes = _summed(hosts, "domain", "h", k, "d"), _summed(hosts, "suffix", "h", k, "s")
    total = np.array([x or 0.0 for x in has.agg(*(F.sum(F.col("p")[i]) for i in range(k))).first()])
    met = scored.join(hosts.join(domains, "domain").join(suffixes, "suffix"), "host", "left")

    schema = T.StructType([T.StructField("id", rows.schema[id_col].dataType), *(T.StructField(c, T.DoubleType() if c == "confidence" else T.StringType()) for c in ("sign", "lang", "confidence", "text_lang", "declared", "host"))])
    columns = met.select("id", "sign", "declared", "host", "suffix", "n", "logs", "p", "h", "d", "s")
    out = columns.mapInArrow(_fuser(names, total, said, by_suffix, smoothing), schema)
    return out.withColumn("rejected", (F.col("lang") == UNKNOWN) | (F.col("confidence") < least))


def page_text(html: Column) -> Column:
    """Text of a page: without scripts, styles, comments and tags; entities become spaces."""
    return F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|&#?\w{1,10};", " ")


def page_language(html: Column) -> Column:
    """What the page's markup declares."""
    return F.nullif(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z-]+)", 1), F.lit(""))


def url_host(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))


def keep(docs: DataFrame, model, id_col="doc_id", text_col="text", declared_col: str | None = "lang", host_col: str | None = "source", **how) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns as they are."""
    col = lambda c: None if c is None else F.col(c)
    bad = identify(docs, model, id_col, F.col(text_col), col(declared_col), col(host_col), **how).where("rejected").select("id", "sign").distinct()
    text = F.coalesce(docs[f"`{text_col}`"], F.lit(""))
    return docs.join(bad, docs[f"`{id_col}`"].eqNullSafe(bad["id"]) & (F.md5(text) == bad["sign"]), "left_anti")

"""Secret scans that tell owner-specific credentials from widely copied examples.

Candidates are the base spans of three kinds: assignments, access keys and hex strings. Where a match lies follows from what the pattern splits off before it, so patterns run as built-in
expressions and no text leaves its task. The value of every candidate is hashed; over the whole corpus a hash is counted by different owners and repositories, each folded before the shuffle, so
a value that a third of all texts carry costs a task one row per owner. A value of more than ``owners`` owners, or of more than ``repositories`` repositories, is an example that people copied; one that
stays within both looks live.
The method adds the place of every live-looking value as a span of kind ``live``; base spans stay as they are.

Spans are in code points, the end exclusive, ordered by start, then kind as in ``KINDS``. Letters of keywords match A-Z in either case, nothing else. Edge cases: null and empty texts have no spans;
a null owner or repository counts as one of its own; repeated rows are scanned one by one (their owner counts once); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceway.runtime import written

KINDS = ("assign", "access", "hex", "live")

# The patterns, the group that is the value, and the least length of that group.
# The bare patterns of access and hex carry their least length: both take maximal runs, so shorter ones can only fail.
PATTERNS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}


def _matches(text: Column, kind: str) -> Column:
    """Array of ``(kind, start, end, value_start, value)`` of all matches, in order; failing matches are left out."""
    pattern, group, least = PATTERNS[kind]
    order = KINDS.index(kind)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern)
    both = F.arrays_zip(gaps.alias("gap"), whole.alias("hit"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int,value_start:int,value:string>>").alias("spans"))

    def step(acc, m):
        start = acc["at"] + F.char_length(m["gap"])
        end = start + F.char_length(F.coalesce(m["hit"], F.lit("")))
        span = F.struct(
            start.alias("start"), F.lit(order).alias("kind"), end.alias("end"), (end - F.char_length(m["value"])).alias("value_start"), m["value"].alias("value")
        )
        good = m["hit"].isNotNull() & (F.char_length(m["value"]) >= least)
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    found = F.aggregate(both, zero, step, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), found).otherwise(zero["spans"])


def candidates(docs: DataFrame, id_col: str, text_col: str, owner: Column, repository: Column) -> DataFrame:
    """``row, id, owner, repository, spans``: the base spans of every row, ordered by start, then kind."""
    rows = docs.select(F.col(id_col).alias("id"), owner.alias("owner"), repository.alias("repository"), F.coalesce(text_col, F.lit("")).alias("text"))
    found = [_matches(F.col("text"), kind) for kind in PATTERNS]
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", "owner", "repository", F.array_sort(F.concat(*found)).alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])))


def scan(docs: DataFrame, id_col="doc_id", text_col="text", owner: Column | None = None, repository: Column | None = None, owners: int = 1, repositories: int | None = None) -> DataFrame:
    """One row per input row: ``id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example``.

    A value looks live if at most ``owners`` owners have it (and, if given, at most ``repositories`` repositories). With ``repositories`` the rows also have ``n_owners`` and ``n_repositories``:
    by how many different ones the value of each base span is carried, in the order of the base spans.
    """
    none = F.lit(None).cast("string")
    base = written(candidates(docs, id_col, text_col, none if owner is None else owner, none if repository is None else repository), "candidates")
    each = base.where(F.size("spans") > 0).select("row", "owner", "repository", F.explode("spans").alias("s"))
    each = each.withColumn("hash", F.sha2("s.value", 256))
    # An owner or repository without a name still counts once.
    where = each.select("hash", F.struct("owner").alias("o"), F.struct("owner", "repository").alias("r")).distinct()
    where = where.groupBy("hash", "o").agg(F.count("*").alias("n")).groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))
    live = F.col("n_owners") <= owners
    if repositories is not None:
        live = live & (F.col("n_repositories") <= repositories)
    judged = each.join(where.select("hash", live.alias("live"), "n_owners", "n_repositories"), "hash")
    place = F.struct(
        F.col("s.value_start").alias("start"), F.lit(KINDS.index("live")).alias("kind"), F.col("s.end").alias("end"), F.col("s.value_start").alias("value_start"), F.lit("").alias("value")
    )
    aggs = [F.collect_set(F.when(F.col("live"), place)).alias("added"), F.sum(F.when(F.col("live"), 0).otherwise(1)).alias("n_example")]
    if repositories is not None:
        aggs.append(F.array_sort(F.collect_list(F.struct("s.start", "s.kind", "n_owners", "n_repositories"))).alias("counts"))
    added = judged.groupBy("row").agg(*aggs)
    out = base.join(added, "row", "left")
    more = F.coalesce("added", F.array().cast(base.schema["spans"].dataType))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return out.select(
        "id",
        *(count(k) for k in PATTERNS),
        F.sha2(_joined(F.col("spans")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat(F.col("spans"), more))).alias("spans"),
        F.size(more).cast("long").alias("n_live"),
        F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example"),
        *(F.coalesce(f"counts.{n}", F.array().cast("array<long>")).alias(n) for n in ("n_owners", "n_repositories") if repositories is not None),
    )

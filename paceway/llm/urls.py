"""URL filters with dated lists: what applied to a capture when it was fetched.

A list entry is an event: on a day, a key is added to a list or removed from it. The events of a key become validity intervals ``[from, until)``, which never overlap. A capture offers the keys it could be listed under (its host, the
domains above it, the prefixes of its path) and meets, as of its fetch time, the intervals that are open then. An interval is laid into eras of ``era_days`` days and the join is on key and era, so a
capture meets at most one interval per day of an era and list however long the history of its key is; the join is an equality join that can be split where one host has a large part of all captures. Domains and
prefixes are offered only at the depths that entries have. The most specific rule decides: prefix, then host, then domain, the longer key first; between lists on the same key the allowed one wins.

Hosts are compared in lower case, without user, port and closing dot; paths as they are, without query and fragment. Edge cases: a null or odd URL and a null fetch date match nothing and are not blocked; events that
change nothing do no harm; of an addition and a removal on one day the removal holds; events with nulls are ignored; repeated captures are judged one by one; empty tables give no rows or no blocked rows; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paceway.runtime import written

KINDS = ("domain", "host", "prefix")


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(F.rtrim(found, F.lit("."))), F.lit(""))


def path_of(url: Column) -> Column:
    """Path without its leading slash, query and fragment."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1)


def intervals(entries: DataFrame) -> DataFrame:
    """``list, kind, key, valid_from, valid_until`` (null: still open) from events ``list, kind, key, action, day``."""
    good = entries.select("list", "kind", "key", "action", "day").dropna()
    # One event for a key and day is left before the events of a key are put in order.
    daily = good.groupBy("list", "kind", "key", "day").agg(F.max("action").alias("action"))
    after = Window.partitionBy("list", "kind", "key").orderBy("day")
    spans = daily.withColumn("valid_until", F.lead("day").over(after)).where("action = 'add'")
    return spans.select("list", "kind", "key", F.col("day").alias("valid_from"), "valid_until")


def _offers(kind: str, depths: list[int]) -> Column:
    """Keys of a kind that a capture offers."""
    if kind == "host":
        return F.array("host")
    if kind == "domain":
        labels = F.split("host", r"\.")
        at = [F.when(F.size(labels) >= n, F.array_join(F.slice(labels, -n, n), ".")) for n in depths]
    else:
        steps = F.split("path", "/")
        at = [F.when((F.size(steps) >= n) & (F.element_at(steps, n) != ""), F.concat_ws("/", "host", F.array_join(F.slice(steps, 1, n), "/"))) for n in depths]
    return F.array(*at) if at else F.array().cast("array<string>")


def evaluate(captures: DataFrame, entries: DataFrame, id_col="page_id", url_col="url", date_col="fetched", era_days: int = 90, allowed: str = "allowed") -> DataFrame:
    """One row per capture: ``id, host, fetched, n_active`` (rules open at fetch time), ``rule_list, rule_kind, rule_key, valid_from, blocked``."""
    rows = captures.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), F.col(date_col).cast("date").alias("fetched"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "captures")
    era = lambda d: F.floor(F.unix_date(d) / era_days)
    spans = written(intervals(entries), "intervals")
    depth = F.when(F.col("kind") == "domain", F.size(F.split("key", r"\."))).when(F.col("kind") == "prefix", F.size(F.split("key", "/")) - 1)
    depths = {(r["kind"], r["depth"]) for r in spans.select("kind", depth.alias("depth")).distinct().collect() if r["depth"]}  # few: labels of names and steps of paths
    last = rows.agg(F.max("fetched")).first()[0]

    until = F.least(F.date_sub("valid_until", 1), F.lit(last))
    laid = spans.where(F.col("valid_from") <= F.lit(last).cast("date")).withColumn("era", F.explode(F.sequence(era(F.col("valid_from")), F.greatest(era(until), era(F.col("valid_from"))))))

    def named(kind):
        keys = _offers(kind, sorted(d for k, d in depths if k == kind))
        return F.transform(keys, lambda key: F.struct(F.lit(kind).alias("kind"), key.alias("key")))

    offers = [named(k) for k in KINDS]
    offered = rows.where("host is not null and fetched is not null").select("row", "fetched", era(F.col("fetched")).alias("era"), F.explode(F.concat(*offers)).alias("o"))
    offered = offered.select("row", "fetched", "era", "o.kind", "o.key").where("key is not null")
    met = offered.join(laid, ["kind", "key", "era"]).where((F.col("fetched") >= F.col("valid_from")) & (F.col("valid_until").isNull() | (F.col("fetched") < F.col("valid_until"))))
    rank = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    rule = F.struct(rank.alias("rank"), F.char_length("key").alias("size"), (F.col("list") == allowed).alias("allowed"), "list", "kind", "key", "valid_from")
    best = met.groupBy("row").agg(F.max(rule).alias("rule"), F.count("*").alias("n"))
    out = rows.join(best, "row", "left")
    return out.select(
        "id",
        "host",
        "fetched",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_active"),
        F.col("rule.list").alias("rule_list"),
        F.col("rule.kind").alias("rule_kind"),
        F.col("rule.key").alias("rule_key"),
        F.col("rule.valid_from").alias("valid_from"),
        F.coalesce(~F.col("rule.allowed"), F.lit(False)).alias("blocked"),
    )

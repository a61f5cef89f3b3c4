"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceway.llm import decontaminate, exact, langid, near, neighbours, packing, secrets, spelling, tokens, toxicity, urls, warc, whitening

QUERIES = {}
SQL = {}


def query(fn):
    """Register under the name of the function."""
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """A file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1).withColumnRenamed("id", "doc_id")


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.find(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


SQL["op3_exact_dedup"] = """
with d as (
  select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256
  from documents)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = max(doc_id) over g as kept, text_sha256
from d window g as (partition by text_sha256)
"""


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("sign").withColumnRenamed("id", "doc_id")


SQL["op4_decontaminate"] = r"""
with dw as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
bw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (
  select distinct item_id, len, array_to_string(w[s + 1:s + len], ' ') as win
  from (select item_id, w, least(len(w), 13) as len, unnest(range(0, greatest(len(w) - 12, 1))) as s from bw where len(w) > 0)),
lens as (select distinct len from win),
cand as (
  select doc_id, len, s, array_to_string(w[s + 1:s + len], ' ') as win
  from (select doc_id, w, len, unnest(range(0, len(w) - len + 1)) as s from dw, lens where len(w) >= len)),
hit as (select doc_id, s, len, item_id from cand join win using (len, win)),
pos as (select doc_id, count(*) as n from (select distinct doc_id, unnest(range(s, s + len)) as p from hit) group by doc_id),
its as (select doc_id, count(*) as n, string_agg(i, ',' order by i) as items from (select distinct doc_id, item_id::varchar as i from hit) group by doc_id)
select doc_id, len(w) as n_words, coalesce(pos.n, 0) as n_hit, coalesce(its.n, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(pos.n, 0) > 0 and 20 * coalesce(pos.n, 0) >= len(w) as contaminated
from dw left join pos using (doc_id) left join its using (doc_id)
"""


@query
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.find(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id", "group_size", "kept")


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    model = langid.train(table(spark, sf_dir, "documents"))
    html = F.col("html")
    found = langid.identify(pages, model, "page_id", langid.page_text(html), langid.page_language(html), langid.url_host(F.col("url")))
    return found.drop("sign").withColumnRenamed("id", "page_id")


@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # The document stands for the repository; a live value may be in a document and a few copies of it.
    found = secrets.scan(docs, owner=F.col("source"), repository=F.col("doc_id").cast("string"), repositories=3)
    return found.withColumnRenamed("id", "doc_id")


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = F.crc32(F.col("_id").cast("string").cast("binary")) % 4
    model = toxicity.train(toxicity.labelled(docs, table(spark, sf_dir, "labels"), part != 2))
    held_out = F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 2
    return toxicity.score(docs, model).select(
        F.col("id").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.to_json("sentences").alias("offending"),
    )


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).drop("url").withColumnRenamed("id", "page_id")


SQL["op6_warc"] = """
with p as (select page_id, coalesce(html, '') as h from pages),
q as (select page_id, strlen(h) as payload_bytes, sha256(h) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first from q)
select page_id, payload_bytes, payload_digest, case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first then first end as refers_to
from f
"""


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with a fetch date that follows from the page's number."""
    return table(spark, sf_dir, "pages").select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(500)).cast("int")).alias("fetched"))


def url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated list entries on hosts, domains and path prefixes of the pages, with dates that follow from digests of the keys."""
    parts = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), F.regexp_extract("url", "^https?://[^/]+/([^/?#]+)", 1).alias("first"))
    parts = parts.where("host <> ''")
    host = parts.select(F.lit("host").alias("kind"), F.col("host").alias("key"))
    domain = parts.select(F.lit("domain").alias("kind"), F.substring_index("host", ".", -2).alias("key"))
    prefix = parts.where("first <> ''").select(F.lit("prefix").alias("kind"), F.concat_ws("/", "host", "first").alias("key"))
    keys = host.union(domain).union(prefix).distinct().withColumn("v", F.conv(F.substring(F.md5("key"), 1, 4), 16, 10).cast("int"))

    def event(which, list_name, action, day):
        return keys.where(which).select(F.lit(list_name).alias("list"), "kind", "key", F.lit(action).alias("action"), F.expr(f"date_add(date '2024-01-01', {day})").alias("day"))

    out = event("v % 3 = 0", "blocked", "add", "v % 300")
    for more in (
        event("v % 3 = 0 and v % 2 = 0", "blocked", "remove", "v % 300 + v % 150"),
        event("v % 6 = 0 and v % 5 = 0", "blocked", "add", "v % 300 + v % 150 + 30"),
        event("v % 7 < 2", "allowed", "add", "v % 400"),
        event("v % 7 = 1", "allowed", "remove", "v % 400 + 60"),
    ):
        out = out.union(more)
    return out


@query
def op2_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.evaluate(captures(spark, sf_dir), url_lists(spark, sf_dir), id_col="page_id")
    return found.select(F.col("id").alias("page_id"), "host", "fetched", "n_active", "rule_list", "rule_kind", "rule_key", "valid_from", "blocked")


SQL["op2_url_lists"] = """
with c as (
  select page_id, date '2024-01-01' + (page_id % 500)::int as fetched, lower(regexp_extract(url, '^https?://([^/]+)', 1)) as host,
    lower(regexp_extract(url, '^https?://([^/]+)', 1)) || '/' || regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) as prefix
  from pages),
k0 as (
  select 'host' as kind, host as key from c union select 'domain', array_to_string(string_split(host, '.')[-2:], '.') from c
  union select 'prefix', prefix from c where prefix not like '%/'),
k as (select kind, key, ('0x' || substr(md5(key), 1, 4))::int as v from k0 where key <> ''),
e as (
  select 'blocked' as list, kind, key, 'add' as action, date '2024-01-01' + v % 300 as day from k where v % 3 = 0
  union all select 'blocked', kind, key, 'remove', date '2024-01-01' + (v % 300 + v % 150) from k where v % 3 = 0 and v % 2 = 0
  union all select 'blocked', kind, key, 'add', date '2024-01-01' + (v % 300 + v % 150 + 30) from k where v % 6 = 0 and v % 5 = 0
  union all select 'allowed', kind, key, 'add', date '2024-01-01' + v % 400 from k where v % 7 < 2
  union all select 'allowed', kind, key, 'remove', date '2024-01-01' + (v % 400 + 60) from k where v % 7 = 1),
o as (select list, kind, key, day, max(action) as action from e group by all),
i as (select *, lead(day) over (partition by list, kind, key order by day) as until from o),
r as (
  select page_id, list, kind, key, day, row_number() over (
    partition by page_id order by case kind when 'prefix' then 3 when 'host' then 2 else 1 end desc, length(key) desc, list) as nth, count(*) over (partition by page_id) as n
  from c join i on i.action = 'add' and fetched >= day and (until is null or fetched < until)
    and (kind = 'host' and key = host or kind = 'prefix' and key = prefix or kind = 'domain' and key = array_to_string(string_split(host, '.')[-2:], '.')))
select c.page_id, host, fetched, coalesce(n, 0) as n_active, list as rule_list, kind as rule_kind, key as rule_key, day as valid_from, coalesce(list = 'blocked', false) as blocked
from c left join r on r.page_id = c.page_id and nth = 1
"""


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), typo_every=97)


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query
def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0).withColumnRenamed("id", "vec_id")

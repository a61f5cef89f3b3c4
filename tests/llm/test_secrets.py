import hashlib
import random
import re

from pyspark.sql import functions as F

from paceway.llm import queries, secrets

BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}


def base(text):
    out = []
    for k, (pattern, group, least) in enumerate(BASE.values()):
        for m in pattern.finditer(text or ""):
            if len(m[group]) >= least:
                out.append((m.start(), k, m.end(), m.start(group), m[group]))
    return sorted(out)


def join(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def brute(rows, owners):
    seen = {}
    for _, text, owner in rows:
        for s in base(text):
            seen.setdefault(s[4], set()).add(owner)
    out = []
    for i, text, _ in rows:
        found = base(text)
        live = {(s[3], 3, s[2]) for s in found if len(seen[s[4]]) <= owners}
        plain = [s[:3] for s in found]
        n = [sum(s[1] == k for s in found) for k in range(3)]
        out.append((i, *n, hashlib.sha256(join(plain).encode()).hexdigest(), join(sorted([*plain, *live])), len(live), sum(len(seen[s[4]]) > owners for s in found)))
    return out


def corpus():
    rng = random.Random(6)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    bits = ["password=", "Token = '", 'API_KEY":', "apikey:", "secret: token: password: ", "AKIA", "AKIAAKIA", "ſecret=", "toKen=", " ", "é😀", "\n", "\t", "passwd", "=", "'", "x"]
    texts = [None, "", "password=short", "token: password: abcdefghijklmnop", "AKIA" + "A" * 13, "AKIA" + "A" * 14, "a" * 16 + "g" + "0" * 15, "0" * 50_000, "😀 token=abcdef012345678901"]
    for _ in range(150):
        texts.append("".join(rng.choice([rng.choice(bits), hexes(rng.randrange(1, 40)), "ABC123XYZ789" * rng.randrange(1, 3)]) for _ in range(rng.randrange(1, 25))))
    texts += ["the example token=EXAMPLE-of-a-token-1234 here"] * 30
    return [(i, t, f"o{i % 4}") for i, t in enumerate(texts)]


def test_equals_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, source string, spans int").repartition(4)
    for owners in (1, 2):
        got = secrets.scan(docs, owner=F.col("source"), repository=F.col("doc_id").cast("string"), owners=owners)
        assert sorted(map(tuple, got.collect())) == sorted(brute(rows, owners))


def test_repeated_rows_nulls_and_empty(spark):
    rows = [(1, "token=abcdefghijkl", "a"), (1, "token=abcdefghijkl", "a"), (None, "token=abcdefghijkl", None), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r["n_assign"], r["n_live"], r["n_example"]) for r in secrets.scan(docs, owner=F.col("source")).collect())
    assert got == [(0, 0, 0), (1, 0, 1), (1, 0, 1), (1, 0, 1)]
    assert secrets.scan(docs.where("false")).count() == 0


def test_copied_widely_inside_one_owner(spark, tmp_path):
    """The registered query: a value that one owner has in many documents and languages is an example; one in few documents of it is live."""
    wide, few, other = "token=EXAMPLEofatoken", "token=abcdefghijkl", "AKIA" + "B" * 14
    rows = [(i, f"here {wide}", "a", ("en", "fr")[i % 2]) for i in range(40)]
    rows += [(100 + i, f"{few} then {wide}", "a", "en") for i in range(3)] + [(200, other, "a", "en"), (201, other, "b", "en"), (300, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_live"], r["n_example"], r["n_owners"], r["n_repositories"]) for r in queries.op7_secrets(spark, str(tmp_path)).collect()}
    assert got == {
        **{i: (0, 1, [1], [43]) for i in range(40)}, **{100 + i: (1, 1, [1, 1], [3, 43]) for i in range(3)}, 200: (0, 1, [2], [2]), 201: (0, 1, [2], [2]), 300: (0, 0, [], [])
    }

"""Sketches against plain Python with the public XXH64 library."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from candleflow.llm import fingerprints as P

SCHEMA = "doc_id long, text string"


def shingles(text):
    words = [zlib.crc32(w.encode()) for w in re.findall(r"[^ \t\n\x0b\f\r]+", text)]
    out = set()
    for i in range(max(len(words) - 4, min(len(words), 1))):
        seed = 42
        for w in words[i : i + 5]:
            seed = xxhash.xxh64_intdigest(w.to_bytes(8, "little"), seed)
        out.add(seed - 2**64 if seed >= 2**63 else seed)
    return out


def bottom(hashes, k=P.K):
    return sorted(hashes)[:k]


def near(a, b, k=P.K):
    both = bottom(set(a) | set(b), k)
    return len(set(both) & set(a) & set(b)) / len(both) if both else 1.0


def printed(sketch):
    return "".join(f"{h % 2**64:016x}" for h in sketch)


def brute(spark, rows, k=P.K):
    hashed = {(r.doc_id, r.t): (r.r1, r.r2) for r in spark.createDataFrame(rows, SCHEMA).select("doc_id", F.coalesce("text", F.lit("")).alias("t")).select(
        "doc_id", "t", F.xxhash64(F.lit(1), "doc_id", "t").alias("r1"), F.xxhash64(F.lit(2), "doc_id", "t").alias("r2")).collect()}
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is None, -(r[0] or 0), hashed[r]))
    want = {}
    for (i, t), (_, after) in zip(docs, docs[1:] + docs[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        own, other, following = (bottom(shingles(x), k) for x in (t, edited, after))
        want[i, t] = (i, len(t), hashlib.sha256(edited.encode()).hexdigest(), printed(own), printed(other), near(own, other, k), near(own, following, k))
    return Counter(want[i, t or ""] for i, t in rows)


def text(rng, n, words=12):
    return " ".join(rng.choice(["ab", "Cd", "é", "漢字", "😀x", "y."][:words]) + rng.choice(["", "\n", "\t"]) for _ in range(n))


def test_matches_brute_force(spark):
    rng = random.Random(1)
    rows = [(i * 3 - 50, text(rng, rng.randint(0, 400))) for i in range(60)]
    rows += [(500 + i, rows[5][1]) for i in range(3)] + [(700, None), (701, ""), (702, " \n"), (703, "one"), (704, "a b c d"), (705, "a b c d e")]
    rows += [(7, "same id " * 20), (7, "other text " * 9), (None, "no id here at all now"), (None, None), rows[3], rows[3], (700, "")]
    rng.shuffle(rows)
    out = P.compared_with_next(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert Counter(map(tuple, out.collect())) == brute(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, "alone on this table, it follows itself")], [(None, None)], [(2, "w " * 400_000)]])
def test_small_tables_and_a_long_text(spark, rows):
    out = P.compared_with_next(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as d", "'x' as r1", "2 as at", "3 as next", "4 as copies", "5 as n"))
    assert Counter(map(tuple, out.collect())) == brute(spark, rows)


def sketch_of(spark, text, **kw):
    df = spark.createDataFrame([(text,)], "text string").select(P.word_hashes(F.col("text")).alias("w"))
    return df.select(P.sketch(F.col("w"), **kw).alias("s")).first()["s"]


def test_parts_merge_into_the_whole(spark):
    rng = random.Random(2)
    t = " ".join(str(rng.randrange(300)) for _ in range(900))
    whole = bottom(shingles(t), 50)
    for part in (1, 7, 100, 896, 10**6):
        assert sketch_of(spark, t, k=50, part=part) == whole


def test_group_sketches_equal_the_sketch_of_all_their_shingles(spark):
    rng = random.Random(3)
    rows = [("a" if i % 3 else None, " ".join(str(rng.randrange(10**6)) for _ in range(rng.randint(5, 60)))) for i in range(80)] + [("empty", "")]
    sketched = P.sketches(spark.createDataFrame(rows, "lang string, text string"))
    got = {r.lang: r.sketch for r in P.merged_sketches(sketched, ["lang"]).collect()}
    assert got == {g: bottom(set().union(*[shingles(t) for l, t in rows if l == g])) for g in ("a", None, "empty")}


def test_estimates(spark):
    rng = random.Random(4)
    def words(n):
        return [str(rng.randrange(10**9)) for _ in range(n)]

    common = words(3000)
    a, b = " ".join(common + words(1000)), " ".join(common)
    df = P.sketches(spark.createDataFrame([(a, b)], "text string, b string")).withColumnRenamed("sketch", "x").withColumnsRenamed({"text": "a", "b": "text"})
    r = P.sketches(df).select(P.resemblance(F.col("x"), F.col("sketch")).alias("near"), P.distinct_shingles(F.col("x")).alias("n"),
                              P.containment(F.col("sketch"), F.col("x")).alias("inside"), P.containment(F.col("x"), F.col("sketch")).alias("part")).first()
    assert abs(r.near - 0.75) < 0.15 and abs(r.n / 3996 - 1) < 0.35 and r.inside > 0.75 and abs(r.part - 0.75) < 0.2

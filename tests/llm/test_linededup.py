import random

import pytest
from pyspark.sql import functions as F

from candleflow.llm import linededup as L


def words(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def test_columns_and_odd_rows(spark):
    rng = random.Random(2)
    passage = words(rng, 60)
    rows = [(1, passage), (2, f"a\n{passage}\nb"), (50, ""), (51, None), (52, "\n\n"), (None, "x y"), (54, "x\ny"), (2, f"a\n{passage}\nb")]
    df = spark.createDataFrame([(i, t, i, "z") for i, t in rows], "doc_id long, text string, h1 long, chunks string")
    out = L.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "h1", "chunks", "removed_chunks", "removed_words"]
    got = sorted(((r.doc_id or 0, r.text, r.h1, r.removed_words) for r in out.collect()), key=str)
    want = [(i or 0, "a\nb" if i == 2 else t, i, 60 if i == 2 else 0) for i, t in rows]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("distinct", [1, 5])
def test_hash_collisions_fall_back_to_the_bytes(spark, monkeypatch, distinct):
    """With line hashes that collide, always or often, the bytes decide."""
    rng = random.Random(3)
    a, b = words(rng, 60), "\n".join(words(rng, 8) for _ in range(9))
    gap = b.replace("\n", "\n\n", 1)
    rows = [(1, a), (2, a), (3, b), (4, "z\n" + b + "\nq"), (5, gap), (6, gap), (7, "\n".join(words(rng, 8) for _ in range(9)))]
    real = F.xxhash64
    monkeypatch.setattr(L, "line_hash", lambda line: F.pmod(real(line), F.lit(distinct)).cast("long"))
    out = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_runs(spark, rows)
    assert {r.doc_id: (r.text, r.removed_words) for r in out} == {i: want[i, t] for i, t in rows}
    assert want[rows[3]] == ("z\nq", 72) and want[rows[5]] == ("", 72) and want[rows[6]][1] == 0


def test_boundaries_do_not_depend_on_what_stands_around(spark):
    """The same run chooses the same boundaries wherever it stands, and every
    run of enough words has one."""
    rng = random.Random(8)
    run = [words(rng, rng.randint(1, 20)) for _ in range(40)]
    texts = ["\n".join([words(rng, 5) for _ in range(k)] + run + [words(rng, 9)] * k) for k in range(4)]
    rows = L.windowed(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    chosen = [{(w.s - r.doc_id, w.n, w.at - r.doc_id, w.anchor) for w in r.windows if r.doc_id <= w.s and w.s + w.n <= r.doc_id + 40} for r in rows]
    assert len(chosen[0]) > 40 and all(c == chosen[0] for c in chosen)
    assert len({at for _, _, at, _ in chosen[0]}) < 30  # fewer boundaries than lines


def test_frequent_keys_stay_where_they_are(spark, monkeypatch):
    """A passage that stands in most rows gives the same result through the
    broadcast of its key."""
    rng = random.Random(9)
    hot, own = "\n".join(words(rng, 15) for _ in range(5)), [words(rng, 55) for _ in range(10)]
    rows = [(i, f"{rng.choice(own)}\n{hot}\nend {i}") for i in range(40)]
    monkeypatch.setattr(L, "HOT", 20)
    out = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_runs(spark, rows)
    assert {r.doc_id: (r.text, r.removed_words) for r in out} == {i: want[i, t] for i, t in rows}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, ""), (2, "")]])
def test_nothing_to_do(spark, rows):
    assert L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).count() == len(rows)


def brute_runs(spark, rows):
    """What is left by definition: all runs of lines of MIN_WORDS or more, each
    against all earlier places; no windows."""
    hashed = {(r.doc_id, r.text): (r.h1, r.h2) for r in spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", "text", F.xxhash64(F.lit(1), "doc_id", "text").alias("h1"), F.xxhash64(F.lit(2), "doc_id", "text").alias("h2")).collect()}
    first, out = {}, {}
    for doc, (i, t) in enumerate(sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, hashed[r]))):
        lines = t.split("\n")
        count = [len(x.split()) for x in lines]
        gone, place = set(), {k: n for n, k in enumerate(k for k, c in enumerate(count) if c)}
        for a in place:
            for b in place:
                if b >= a and sum(count[a : b + 1]) >= L.MIN_WORDS:
                    at = first.setdefault("\n".join(lines[a : b + 1]), (doc, a, b))
                    if at[0] < doc or at[2] < a:
                        gone.update(range(a, b + 1))
        left = [k for k in range(len(lines)) if k not in gone]
        for k in list(left):  # lines without words between two lines that go
            around = [max((p for p in place if p < k), default=None), min((p for p in place if p > k), default=None)]
            if not count[k] and all(p in gone for p in around):
                left.remove(k)
        out[i, t] = ("\n".join(lines[k] for k in left), sum(count[k] for k in gone))
    return out


def test_runs_of_short_lines_match_brute_force(spark):
    rng = random.Random(4)
    passages = [[words(rng, rng.randint(1, 25)) for _ in range(rng.randint(3, 14))] for _ in range(5)]
    rows = []
    for i in range(40):
        lines = [words(rng, rng.randint(1, 12)) for _ in range(rng.randint(0, 5))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a = rng.randint(0, 2)
            at = rng.randint(0, len(lines))
            lines[at:at] = p[a : len(p) - rng.randint(0, 1)]
        if i % 4 == 0:
            lines[rng.randint(0, len(lines)) :][:0] = [""]
            lines.insert(rng.randint(0, len(lines)), rng.choice(["", "  "]))
        rows.append((i, "\n".join(lines)))
    ten = [words(rng, 10) for _ in range(6)]
    gap = [*ten[:3], "", *ten[3:]]
    rows += [(60, "\n".join(["a b", *ten, "c"])), (61, "\n".join(["d", *ten, "e f g"])), (62, "\n".join(["h", *gap])), (63, "\n".join([*gap, "i"]))]
    rows += [(64, "\n".join(["x"] * 175)), (65, "\n".join(ten + ["x y"] + ten)), (66, "\n" + "\n".join(ten) + "\n\n"), (None, "\n".join(ten[:5])), rows[4], rows[4]]
    out = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_runs(spark, rows)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.text, r.removed_words) for r in out), key=key) == sorted(((i, *want[i, t]) for i, t in rows), key=key)
    assert want[61, rows[41][1]][0] == "d\ne f g" and sum(n for _, n in want.values()) > 500

"""The manifest against a plain Python tree."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from candleflow.llm import manifest as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return H(*[field(v) for v in (*r[:4], text)])


def tree(nodes):
    """The last node and each node's (left, right) siblings, level by level."""
    paths, level, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for path, k in zip(paths, at):
            lo = k // 8 * 8
            path.append(("".join(level[lo:k]), "".join(level[k + 1 : lo + 8])))
        level = [H(*level[i : i + 8]) for i in range(0, len(level), 8)]
        at = [k // 8 for k in at]
    return level[0] if level else None, paths


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r, r[4]), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    done = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    root, upper = tree([done[g][0] for g in order])
    out = []
    for g, up in zip(order, upper):
        for (_, _, digest, r), path in zip(sorted(groups[g], key=lambda x: x[:3]), done[g][1]):
            node, text = digest, r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                lower = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                node = leaf(r, lower)
            for left, right in path + up:
                node = H(left, node, right)
            out.append((r[0], digest, done[g][0], root, H(*[a + b for a, b in path + up]), node, node == root))
    return out


def text(rng):
    return " ".join(rng.choice(["Ab", "cd", "É", "x", "ÄB"]) for _ in range(rng.randint(0, 6)))


def check(spark, rows):
    got = M.merkle_manifest(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == Counter(brute(rows))


def test_matches_plain_trees(spark):
    rng = random.Random(1)
    rows = [(i * 37 - 3000, "s", "en", len(t), t) for i in range(700) for t in [text(rng)]]
    rows += [(rng.randrange(-(2**63), 2**63), None, "de", None, text(rng)) for _ in range(80)]
    rows += [(2**63 - 1, "s", "de", 1, "Q"), (-(2**63), "s", "de", 1, "Q"), (2**63 - 2, "", "de", 1, None)]
    rows += [(i, "s", None, 0, None) for i in range(9)] + [(5, "s", "", 0, "")]
    rng.shuffle(rows)
    check(spark, rows)


def test_repeated_rows_and_ids(spark):
    rng = random.Random(2)
    rows = [(7, "s", "en", 1, "Same")] * 30 + [(7, "s", "en", 1, f"T{i}") for i in range(25)] + [(7, "s", "en", 1, "T3")] * 4
    rows += [(None, "s", "en", 1, f"N{i % 6}") for i in range(20)] + [(i, "s", "en", 1, text(rng)) for i in range(60)] + [(8, "s", "en", 1, "X")] * 3
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(3, "s", "en", 1, "A"), (3, "s", "en", 1, "A")],
                                  [(i, "s", f"l{i}", 1, "A") for i in range(20)], [(1, "s", "en", 1, "Ab " * 300_000)]])
def test_small_tables(spark, rows):
    check(spark, rows)


def test_other_columns_are_ignored(spark):
    rows = [(i, "s", "en", 1, "A") for i in range(10)]
    plain = spark.createDataFrame(rows, SCHEMA)
    clashing = plain.selectExpr("*", "1 as grp", "'x' as leaf", "2 as pos", "3 as n", "'y' as path")
    assert sorted(M.merkle_manifest(clashing).collect()) == sorted(M.merkle_manifest(plain).collect())


def test_places_are_ranks(spark):
    """Bitmap ranks over ids of several directory levels, in shuffled order."""
    rng = random.Random(3)
    ids = [b + rng.randrange(200) * 3 for b in (0, 1 << 16, 1 << 20, 1 << 33, 1 << 50, -(1 << 40)) for _ in range(60)]
    rows = [(i, "s", "en", 1, f"t{k % 50}") for k, i in enumerate(ids)]
    placed = M.placed_leaves(M.leaves_of(spark.createDataFrame(rows, SCHEMA))).select("doc_id", "leaf", "pos").collect()
    assert sorted(p.pos for p in placed) == list(range(len(rows)))
    assert [(p.doc_id, p.leaf) for p in sorted(placed, key=lambda p: p.pos)] == sorted((p.doc_id, p.leaf) for p in placed)

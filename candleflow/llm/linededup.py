"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of two neighbouring lines chooses the places
where chunks begin: in every shortest run of ``MIN_WORDS`` words, from each
line on and up to each line, the place of its smallest value.  The choice
depends on the run alone, so a repeated run has the same boundary in all its
copies, whatever stands around it and however short its lines are.  Boundaries
whose rolling hash occurs at more than one place of the corpus are anchors.
Around an anchor the match grows by whole lines to the runs of ``MIN_WORDS``
words that chose it; those that repeat are removed, neighbours joined, so a
repeated run of more words goes as a whole.  Lines count as equal after a
comparison of their bytes.

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candleflow.llm.common import load, once
from candleflow.plans.sizing import bounded_broadcast
from candleflow.session import materialize

#: Words that a run of lines needs to be removed.
MIN_WORDS = 50
#: Lines looked at first for the end of a window.
AHEAD = 8
#: Rows of one key from which on the key's rows stay where they are in a join.
HOT = 10_000


def line_hash(line: Column) -> Column:
    return F.xxhash64(line)


def _rotated(x: Column, by: int) -> Column:
    return F.shiftleft(x, by).bitwiseOR(F.shiftrightunsigned(x, 64 - by))


def _unit(before: Column, i: Column) -> Column:
    """Line i and those between it and line ``before``."""
    return F.array_join(F.slice("lines", before + 2, i - before), "\n")


def _by_key(rows: DataFrame, keyed: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` joined with ``keyed`` (one row a key, with its count ``c``);
    the rows of a key of over ``HOT`` don't meet in one task."""
    often = bounded_broadcast(keyed.where(F.col("c") > HOT))
    seldom = rows.join(often.select(*keys), keys, "left_anti").join(keyed.where(F.col("c") <= HOT), keys)
    return rows.join(often, keys).unionByName(seldom).drop("c")


def windowed(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (with a column text, not null) and its ``lines``, the places
    ``solid`` of those with words, their ``body_hash``, their ``unit_hash``
    (of a line and the lines without words before it), and the ``windows``: an
    array of (s, n, at, anchor), n lines of words from the s-th on, the place
    of the boundary that they choose and its rolling hash."""
    lines = once(docs, lines=F.split("text", "\n", -1))
    counted = once(lines, line_words=F.transform("lines", lambda x: F.regexp_count(x, F.lit(r"\S+"))))
    placed = once(counted, solid=F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.get("line_words", i) > 0))
    hashed = once(placed, words=F.transform("solid", lambda i: F.get("line_words", i)), body_hash=F.transform("solid", lambda i: line_hash(F.get("lines", i))))

    def unit(i: Column, k: Column) -> Column:  # a line and the lines without words between it and the last
        before = F.coalesce(F.get("solid", k - 1), i - 1)
        return F.when(before == i - 1, F.get("body_hash", k)).otherwise(line_hash(_unit(before, i)))

    def shortest(words: Column) -> Column:  # lines from each on that hold min_words, null if there are too few
        def within(i: Column, size: int) -> Column:
            def more(a: Column, x: Column) -> Column:
                short = a["sum"] < min_words
                return F.struct((a["sum"] + F.when(short, F.least(x, F.lit(min_words))).otherwise(0)).alias("sum"), (a["n"] + F.when(short, 1).otherwise(0)).alias("n"))

            start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))
            return F.aggregate(F.slice(words, i + 1, size), start, more, lambda a: F.when(a["sum"] >= min_words, a["n"]))

        return F.transform(words, lambda x, i: F.when(x >= min_words, F.lit(1)).otherwise(F.coalesce(within(i, min(AHEAD, min_words)), within(i, min_words))))

    turned = once(hashed, unit_hash=F.transform("solid", unit), backward=F.reverse("words"))
    sized = once(turned, ahead=shortest(F.col("words")), back=F.reverse(shortest(F.col("backward"))),
                 rolling=F.transform("unit_hash", lambda u, k: u.bitwiseXOR(_rotated(F.coalesce(F.get("body_hash", k - 1), F.lit(0).cast("long")), 1))))
    from_start = F.transform("ahead", lambda n, s: F.struct(s.alias("s"), n.alias("n")))
    to_end = F.transform("back", lambda n, e: F.struct((e - n + 1).alias("s"), n.alias("n")))
    spans = once(sized, spans=F.concat(
        F.filter(from_start, lambda w: w["n"].isNotNull()),
        F.filter(to_end, lambda w: w["n"].isNotNull() & ~F.get("ahead", w["s"]).eqNullSafe(w["n"]))))

    def boundary(w: Column) -> Column:  # of a single line: itself
        inner = F.slice("rolling", w["s"] + 2, w["n"] - 1)
        at = w["s"] + F.array_position(inner, F.array_min(inner)).cast("int")
        alone = w["n"] == 1
        return F.struct(w["s"].alias("s"), w["n"].alias("n"), F.when(alone, w["s"]).otherwise(at).alias("at"),
                        F.when(alone, F.get("body_hash", w["s"])).otherwise(F.array_min(inner)).alias("anchor"))

    return once(spans, windows=F.transform("spans", boundary)).drop("line_words", "words", "backward", "ahead", "back", "rolling", "spans")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) with repeated runs of lines
    taken out of ``text``, and with ``removed_chunks`` (stretches of lines
    taken out) and ``removed_words``.

    A line of words goes if a run of lines around it, of ``min_words`` or
    more, stands byte for byte at an earlier place that it doesn't overlap.
    Lines without words go if the lines of words on both sides do.  Places are
    in order of doc_id (null first), then of a hash of the row, then in the
    text.  Rows equal in doc_id and text are one document: all of them keep or
    lose the same lines.  A null text stays null, an empty one empty; all
    other rows and columns come through, an empty table as such.

    Boundaries are counted by their rolling hash, a key that occurs often
    being summed within tasks first.  Runs around anchors are counted by the
    SHA-256 of their lines' 64-bit hashes, and every distinct line of theirs is
    compared by its bytes with the others of its hash; runs that hold a line
    whose hash stands for several are told apart by their own bytes.  Runs
    travel as numbers; a text travels only within its own row.
    """
    columns = [c for c in docs.columns if c not in ("removed_chunks", "removed_words")]
    has_text = F.coalesce("text", F.lit(""))
    key_1, key_2 = F.xxhash64(F.lit(1), F.col("doc_id"), has_text), F.xxhash64(F.lit(2), F.col("doc_id"), has_text)
    slim = docs.where("text is not null and text <> ''").select(F.col("doc_id").cast("long").alias("d"), key_1.alias("r1"), key_2.alias("r2"), "text")
    places = materialize(windowed(slim, min_words).select(
        "r1", "r2", F.inline(F.array_distinct(F.transform("windows", lambda w: F.struct(w["at"].alias("at"), w["anchor"].alias("anchor")))))), "chunk-boundaries")
    repeated = places.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1")
    anchors = materialize(_by_key(places, repeated, ["anchor"]).groupBy("r1", "r2").agg(F.collect_set("at").alias("anchors")), "chunk-anchors")

    # Matches grown from the anchors, and the lines in them.
    near = windowed(slim.join(anchors.hint("merge"), ["r1", "r2"]), min_words)
    grown = once(near, grown=F.filter("windows", lambda w: F.array_contains("anchors", w["at"])))
    grown = once(grown, inside=F.array_distinct(F.flatten(F.transform("grown", lambda w: F.sequence(w["s"], w["s"] + w["n"] - 1)))))

    def line(k: Column) -> Column:
        i, before = F.get("solid", k), F.coalesce(F.get("solid", k - 1), F.get("solid", k) - 1)
        return F.struct(k.alias("k"), F.get("lines", i).alias("body"), F.when(before < i - 1, _unit(before, i)).alias("unit"))

    def digest(w: Column) -> Column:
        hashes = F.concat(F.array(F.get("body_hash", w["s"])), F.slice("unit_hash", w["s"] + 2, w["n"] - 1))
        return F.unhex(F.sha2(F.array_join(hashes.cast("array<string>"), ","), 256))

    matches = materialize(grown.select(
        "d", "r1", "r2", F.transform("inside", line).alias("inside"),
        F.transform("grown", lambda w: F.struct(w["s"].alias("s"), w["n"].alias("n"), digest(w).alias("digest"))).alias("runs")), "chunk-matches")

    # The comparison of bytes: hashes that stand for more than one line.
    bodies = matches.select(F.explode(F.flatten(F.transform("inside", lambda x: F.array(x["body"], x["unit"])))).alias("body")).where("body is not null")
    shared = materialize(bodies.select(line_hash(F.col("body")).alias("hash"), "body").distinct()
                         .groupBy("hash").agg(F.count("*").alias("c")).where("c > 1").select("hash"), "chunk-collisions")
    runs = matches.select("d", "r1", "r2", F.inline("runs"))
    if shared.isEmpty():
        same = runs.withColumn("bytes", F.lit(""))
    else:
        unsure = matches.select("r1", "r2", F.explode("inside").alias("x")).select("r1", "r2", "x.k", F.explode(F.array(line_hash(F.col("x.body")), line_hash(F.col("x.unit")))).alias("hash"))
        unsure = unsure.join(bounded_broadcast(shared), "hash", "left_semi").groupBy("r1", "r2").agg(F.collect_set("k").alias("unsure"))
        told = once(matches.join(unsure, ["r1", "r2"], "left"), placed=F.map_from_entries(F.transform("inside", lambda x: F.struct(x["k"], x))))

        def own_bytes(w: Column) -> Column:
            span = F.sequence(w["s"], w["s"] + w["n"] - 1)
            text = F.array_join(F.transform(span, lambda k: F.when(k == w["s"], F.col("placed")[k]["body"]).otherwise(
                F.coalesce(F.col("placed")[k]["unit"], F.col("placed")[k]["body"]))), "\n")
            return F.when(F.arrays_overlap(span, "unsure"), text).otherwise(F.lit(""))

        same = told.select("d", "r1", "r2", F.inline(F.transform("runs", lambda w: F.struct(
            w["s"].alias("s"), w["n"].alias("n"), w["digest"].alias("digest"), F.coalesce(own_bytes(w), F.lit("")).alias("bytes")))))
        same = materialize(same, "chunk-runs")
    key = ["digest", "bytes"]
    firsts = materialize(same.groupBy(*key).agg(F.min(F.struct("d", "r1", "r2", "s")).alias("first"), F.count("*").alias("c")).where("c > 1"), "chunk-firsts")
    here = (F.col("first.r1") == F.col("r1")) & (F.col("first.r2") == F.col("r2"))
    gone = _by_key(same, firsts, key).where(~here | (F.col("s") >= F.col("first.s") + F.col("n"))).select("r1", "r2", "s", (F.col("s") + F.col("n") - 1).alias("e"))

    # Windows that touch make one stretch.
    order = Window.partitionBy("r1", "r2").orderBy("s", "e")
    reach = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begun = gone.withColumn("new", F.when(F.col("s") <= reach + 1, 0).otherwise(1))
    stretch = F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    stretches = begun.withColumn("stretch", stretch).groupBy("r1", "r2", "stretch").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    removed = materialize(stretches.groupBy("r1", "r2").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("gone")), "windows-removed")

    # The row travels as one value, so that no column of it clashes with a working one.
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), key_1.alias("r1"), key_2.alias("r2"), "text")
    joined = row.join(removed.hint("merge"), ["r1", "r2"], "left")
    cut = once(joined.where("gone is not null"), lines=F.split("text", "\n", -1))
    cut = once(cut, line_words=F.transform("lines", lambda x: F.regexp_count(x, F.lit(r"\S+"))))
    cut = once(cut, solid=F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.get("line_words", i) > 0))

    def between(k: Column) -> Column:  # the lines between two stretches
        low = F.when(k == 0, F.lit(0)).otherwise(F.get("solid", F.get("gone", k - 1)["e"]) + 1)
        high = F.when(k == F.size("gone"), F.size("lines")).otherwise(F.get("solid", F.get("gone", k)["s"]))
        return F.slice("lines", low + 1, high - low)

    def words(g: Column) -> Column:
        first, last = F.get("solid", g["s"]), F.get("solid", g["e"])
        return F.aggregate(F.slice("line_words", first + 1, last - first + 1), F.lit(0).cast("long"), lambda a, x: a + x)

    kept_text = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size("gone")), between)), "\n")
    gone_words = F.aggregate(F.transform("gone", words), F.lit(0).cast("long"), lambda a, x: a + x)

    def result(df: DataFrame, text: Column, chunks: Column, words: Column) -> DataFrame:
        return df.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in columns],
                         chunks.alias("removed_chunks"), words.cast("long").alias("removed_words"))

    whole = result(joined.where("gone is null"), F.col("text"), F.lit(0), F.lit(0))
    return whole.unionByName(result(cut, kept_text, F.size("gone"), gone_words))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages that repeat earlier ones."""
    out = dedup_lines(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "removed_chunks", "removed_words", "text")

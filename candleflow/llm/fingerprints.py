"""Document fingerprints: bottom-k sketches of shingle hashes.

A shingle is five consecutive words, its hash XXH64 over the CRC-32 of its
words.  The sketch of a text is the ``K`` smallest different hashes of its
shingles, in order.  Sketches of parts merge into that of the whole (the k
smallest of both), so a long text is sketched in parts and a corpus by merging
the sketches of its documents.  Of two sketches, the k smallest of their union
are a uniform sample of the union of the shingles: the share of it that stands
in both estimates the resemblance, and the k-th smallest hash the number of
different shingles; containment follows from the two.

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candleflow.llm.common import load, once
from candleflow.operators.sequence import ordered_index
from candleflow.session import materialize

#: Words of a shingle, and hashes of a sketch.
SHINGLE, K = 5, 128
#: Shingles of a part of a text.
PART = 1 << 16
SPACE = r"[ \t\n\x0B\f\r]+"


def word_hashes(text: Column) -> Column:
    """A number for each word, a maximal run of characters other than ASCII
    white space."""
    return F.transform(F.filter(F.split(text, SPACE), lambda w: w != ""), lambda w: F.crc32(w))


def bottom(hashes: Column, k: int = K) -> Column:
    """The k smallest different hashes, in order."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return bottom(F.concat(a, b), k)


def sketch(words: Column, k: int = K, part: int = PART) -> Column:
    """The sketch of an array of word hashes, part by part.  Fewer words than
    a shingle are one shingle, none give an empty sketch."""
    n = F.greatest(F.size(words) - (SHINGLE - 1), F.least(F.size(words), F.lit(1)))  # shingles
    none = F.array().cast("array<bigint>")

    def add(acc: Column, p: Column) -> Column:
        places = F.sequence(p * part, F.least((p + 1) * part, n) - 1)
        return merge(acc, F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)])), k)

    parts = F.sequence(F.lit(0), F.floor((n - 1) / part).cast("int"))
    return F.when(n == 0, none).otherwise(F.aggregate(parts, none, add))


def fingerprint(sketched: Column) -> Column:
    """The sketch as a string: its hashes in hexadecimal, 16 digits each."""
    return F.lower(F.array_join(F.transform(sketched, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among those of both (Jaccard); 1.0
    for two sketches without shingles."""
    both = merge(a, b, k)
    return F.when(F.size(both) == 0, 1.0).otherwise(F.size(F.array_intersect(F.array_intersect(both, a), b)) / F.size(both))


def distinct_shingles(sketched: Column, k: int = K) -> Column:
    """Estimated number of different shingles: exact below k."""
    # The k-th smallest of n hashes spread over 2^64 values stands near k / n of the way.
    share = (F.element_at(sketched, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(sketched) < k, F.size(sketched).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds; 1.0 if a has none."""
    common = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(common / distinct_shingles(a, k), F.lit(1.0)))


def sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """``docs`` with the ``sketch`` of its column text (null: empty)."""
    worded = once(docs.drop("sketch"), _cf_words=word_hashes(F.coalesce("text", F.lit(""))))
    return once(worded, sketch=sketch(F.col("_cf_words"), k)).drop("_cf_words")


def merged_sketches(sketched: DataFrame, by: list[str], k: int = K, turns: int = 256) -> DataFrame:
    """The sketch of all rows of each group ``by`` (columns, null being a
    group): ``by`` and sketch.  A group's hashes are cut to k in turns by
    a hash of theirs before they meet, so no group fills a task.  A group
    without shingles has an empty sketch."""
    hashes = sketched.select(*by, F.explode("sketch").alias("_cf_hash")).distinct()
    turn = F.pmod(F.xxhash64("_cf_hash"), F.lit(turns)).alias("_cf_turn")
    first = hashes.select("*", turn).withColumn("_cf_at", F.row_number().over(Window.partitionBy(*by, "_cf_turn").orderBy("_cf_hash"))).where(F.col("_cf_at") <= k)
    best = first.withColumn("_cf_at", F.row_number().over(Window.partitionBy(*by).orderBy("_cf_hash"))).where(F.col("_cf_at") <= k)
    filled = best.select(*by, "_cf_hash").unionByName(sketched.select(*by, F.lit(None).cast("long").alias("_cf_hash")).distinct())
    return filled.groupBy(*by).agg(F.sort_array(F.collect_list("_cf_hash")).alias("sketch"))


def compared_with_next(docs: DataFrame, k: int = K) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    Documents stand in descending order of doc_id, null last, those of one
    doc_id by a hash of their texts; the first follows the last, and a
    document alone follows itself.  The edited text has the last half of the
    code points replaced by as many, or all, of the next document's first
    ones.  Rows equal in doc_id and text are one document and get equal
    results.  A null text is an empty one; texts without words have empty
    fingerprints, which are alike (1.0).  An empty table gives no rows.

    The order is found on (doc_id, hash, length) alone.  Texts are shuffled
    once by document; what the document before needs of a text, its beginning,
    is sent there, and the edited text is put together where it lands.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("d"), F.xxhash64(F.lit(1), "doc_id", text).alias("r1"), F.xxhash64(F.lit(2), "doc_id", text).alias("r2"), text.alias("text"))
    slim = rows.groupBy("d", "r1", "r2").agg(F.max(F.char_length("text")).alias("n"), F.count("*").alias("copies"))
    order = [F.col("d").desc_nulls_last(), F.col("r1"), F.col("r2")]
    places = materialize(ordered_index(slim, order, [], index_col="at", total_col="total"), "fingerprint-order")
    before = places.select(F.col("r1").alias("p1"), F.col("r2").alias("p2"), "d", F.floor(F.col("n") / 2).cast("int").alias("need"), "copies", (F.col("at") % F.col("total") + 1).alias("at"))
    wanted = places.select("r1", "r2", "at").join(before, "at").drop("at")

    texts = rows.groupBy("r1", "r2").agg(F.first("text").alias("text"))
    asked = once(texts.join(wanted.hint("merge"), ["r1", "r2"]), words=word_hashes(F.col("text")))
    heads = asked.select(F.col("p1").alias("r1"), F.col("p2").alias("r2"), "d", "copies", F.left("text", F.col("need")).alias("head"), sketch(F.col("words"), k).alias("next"))
    met = once(texts.join(heads.hint("merge"), ["r1", "r2"]), n=F.char_length("text"))
    edited = once(met, edited=F.concat(F.left("text", F.col("n") - F.floor(F.col("n") / 2).cast("int")), "head"))
    worded = once(edited, words=word_hashes(F.col("text")), edited_words=word_hashes(F.col("edited")), digest=F.sha2("edited", 256))
    made = once(worded, own=sketch(F.col("words"), k), other=sketch(F.col("edited_words"), k))
    near = once(made, near_edited=resemblance(F.col("own"), F.col("other"), k), near_next=resemblance(F.col("own"), F.col("next"), k))
    return near.select(F.col("d").alias("doc_id"), F.col("n").cast("long").alias("n_chars"), F.col("digest").alias("edited_sha256"),
                       fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("other")).alias("edited_fingerprint"),
                       "near_edited", "near_next", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def op12_bottom_k_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, their edited texts and the next documents."""
    return compared_with_next(load(spark, sf_dir, "documents"))


def oracle_sql() -> str:
    """The same in DuckDB; doc_ids must differ.  Both hashes are computed by
    their public definitions, in 128-bit arithmetic."""
    # The five primes of XXH64 and the polynomial of CRC-32.
    p1, p2, p3, p4, p5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
    polynomial = 3988292384
    two64 = 1 << 64

    def times(x: str, p: int) -> str:
        return f"((({x})::uhugeint * {p}::uhugeint) % {two64}::uhugeint)"

    def rotl(x: str, by: int) -> str:  # of a 64-bit x
        return f"((({x}) * {1 << by}::uhugeint) % {two64}::uhugeint + ({x}) // {1 << (64 - by)}::uhugeint)"

    def shifted(x: str, by: int) -> str:
        return f"xor(({x})::ubigint, (({x}) // {1 << by}::uhugeint)::ubigint)::uhugeint"

    # One step of XXH64 over a 64-bit number x with the seed a, a list per stage so that no stage is written twice.
    def staged(start: str, *stages) -> str:
        out = f"[{start}]"
        for stage in stages:
            out = f"list_transform({out}, lambda v: {stage('v')})"
        return f"({out})[1]"

    step = staged(
        times("x", p2), lambda v: rotl(v, 31), lambda v: times(v, p1),
        lambda v: f"xor({v}::ubigint, ((a + {p5}::uhugeint + 8) % {two64}::uhugeint)::ubigint)::uhugeint",
        lambda v: rotl(v, 27), lambda v: f"(({times(v, p1)} + {p4}::uhugeint) % {two64}::uhugeint)",
        lambda v: shifted(v, 33), lambda v: times(v, p2), lambda v: shifted(v, 29), lambda v: times(v, p3), lambda v: shifted(v, 32))

    def near(a: str, b: str) -> str:
        return f"case when len({a}) + len({b}) = 0 then 1.0 else len(list_intersect(list_intersect(u, {a}), {b})) / len(u) end"

    def union(a: str, b: str) -> str:
        return f"list_sort(list_distinct(list_concat({a}, {b})))[1 : {K}]"

    def printed(x: str) -> str:
        return f"array_to_string(list_transform({x}, lambda h: lpad(lower(hex(case when h < 0 then (h::hugeint + {two64}::hugeint)::ubigint else h::ubigint end)), 16, '0')), '')"

    return f"""
with crc(t) as (
  select list_transform(range(256), lambda i: list_reduce(list_prepend(i::ubigint, range(8)::ubigint[]),
    lambda a, k: case when a & 1 = 1 then xor(a >> 1, {polynomial}::ubigint) else a >> 1 end))),
d as (
  select row_number() over (order by doc_id desc) as place, count(*) over () as total, coalesce(text, '') as text, doc_id from documents),
e as (
  select d.place, d.total, d.doc_id, d.text, length(d.text) as n, left(d.text, length(d.text) - length(d.text) // 2) || left(x.text, length(d.text) // 2) as edited
  from d join d x on x.place = d.place % d.total + 1),
w as (
  select place, which, regexp_extract_all(t, '[^ \\t\\n\\x0B\\f\\r]+') as words from (select place, 'own' as which, text as t from e union all select place, 'edited', edited from e)),
s as (
  select place, which, unnest(case when len(words) = 0 then [] else list_transform(range(greatest(len(words) - {SHINGLE - 1}, 1)), lambda i: words[i + 1 : i + {SHINGLE}]) end) as shingle from w),
u as (select distinct shingle from s),
v as (select distinct unnest(shingle) as word from u),
bytes as (select word, list_transform(range(0, strlen(word) * 2, 2), lambda i: ('0x' || hex(word)[i + 1 : i + 2])::ubigint) as b from v),
c as (
  select word, xor(list_reduce(list_prepend(4294967295::ubigint, b), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255)::int + 1])), 4294967295::ubigint) as crc from bytes, crc),
numbers as (
  select shingle, list(crc order by i) as x from (select shingle, unnest(shingle) as word, unnest(range(len(shingle))) as i from u) join c using (word) group by shingle),
hashes as (
  select shingle, list_reduce(list_prepend(42::uhugeint, x::uhugeint[]), lambda a, x: {step}) as h from numbers),
k as (
  select place, which, list_sort(list(distinct case when h >= {1 << 63}::uhugeint then (h::hugeint - {two64}::hugeint)::bigint else h::bigint end))[1 : {K}] as k
  from s join hashes using (shingle) group by place, which),
a as (
  select e.*, coalesce(o.k, []) as own, coalesce(x.k, []) as other, coalesce(f.k, []) as following from e
  left join k o on o.place = e.place and o.which = 'own' left join k x on x.place = e.place and x.which = 'edited' left join k f on f.place = e.place % e.total + 1 and f.which = 'own'),
b as (select *, {union('own', 'other')} as u from a),
r as (select * exclude (u), {near('own', 'other')} as near_edited, {union('own', 'following')} as u from b)
select doc_id, n::bigint as n_chars, sha256(edited) as edited_sha256, {printed('own')} as fingerprint, {printed('other')} as edited_fingerprint,
  near_edited::double as near_edited, ({near('own', 'following')})::double as near_next from r
"""

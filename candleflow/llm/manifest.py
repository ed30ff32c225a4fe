"""Merkle manifest of a dataset, with leaf places from bitmap ranks.

A leaf is the digest of one row.  Within a language leaves stand in order of
doc_id; a leaf's place is its rank, found without sorting the rows: the
doc_ids of a language are merged into a bitmap of 64-bit words (words without
a bit aren't stored), a directory over the words holds the number of leaves in
front of each, and a place is the word's number plus the bits below.  The
directory is summed level by level, 16 bits of the doc_id at a time, so no
window holds more than 65,536 rows whatever the language.

Places then key the reduction: 512 consecutive nodes (three levels of eight)
meet as one array of slots, which gives their ancestor and the siblings on the
way to it; ancestors are reduced likewise until one node a language is left,
and those nodes once more.  Siblings come back down by joins of the small upper
tables, and every leaf folds its own path.

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candleflow.llm.common import load, once
from candleflow.operators.sequence import ordered_index, running_total
from candleflow.plans.sizing import bounded_broadcast
from candleflow.session import materialize

#: Children of a node, and levels reduced in one shuffle.
FAN, LEVELS = 8, 3
SLOTS = FAN**LEVELS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Every n-th document, by the checksum of its doc_id, is tampered with.
TAMPERED_EVERY = 3


def field(value: Column) -> Column:
    """One field of a leaf: its UTF-8 length and the value, ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    """Digest of a row with this text in place of its own."""
    return F.sha2(F.concat(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text)), 256)


def leaves_of(docs: DataFrame) -> DataFrame:
    """One row per different leaf: grp (the language's key, in tree order),
    doc_id, leaf, changed (the digest of the row as tampered with, null where
    that is the same), copies."""
    id_text = F.col("doc_id").cast("string")
    hit = F.coalesce(F.crc32(id_text) % TAMPERED_EVERY == 0, F.lit(False))
    lowered = F.translate("text", UPPER, LOWER)
    rows = docs.select(
        F.coalesce(F.concat(F.lit("l"), F.col("lang").cast("string")), F.lit("")).alias("grp"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(F.col("text")).alias("leaf"),
        F.when(hit & (lowered != F.col("text")), leaf_digest(lowered)).alias("changed"))
    # Equal rows have equal digests; they are counted before the shuffle.
    packed = rows.groupBy("grp", "doc_id", F.unhex("leaf").alias("leaf"), F.unhex("changed").alias("changed")).agg(F.count("*").alias("copies"))
    return packed.select("grp", "doc_id", F.lower(F.hex("leaf")).alias("leaf"), F.lower(F.hex("changed")).alias("changed"), "copies")


def _word(doc_id: Column) -> list[Column]:
    """Key of the bitmap word of a doc_id and its place there.  Rows without a
    doc_id have a word of their own, in front of all others."""
    return [(doc_id.isNotNull()).alias("known"), F.coalesce(F.shiftright(doc_id, 6), F.lit(0)).alias("word")]


def bitmap_index(leaves: DataFrame) -> DataFrame:
    """The bitmaps of all groups: one row per word with a bit, with its bits,
    the number ``before`` of leaves in front of the word and ``more``, the
    places of the word that hold several leaves with how many there are too
    many.  Tasks merge their bits before the shuffle; a group's words spread
    over all tasks."""
    bit = F.coalesce(F.col("doc_id").bitwiseAND(F.lit(63)), F.lit(0)).cast("int")
    per_id = leaves.groupBy("grp", "doc_id").agg(F.sum("copies").alias("n"))
    words = per_id.groupBy("grp", *_word(F.col("doc_id"))).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"), F.sum("n").alias("n"),
        F.collect_list(F.when(F.col("n") > 1, F.struct(bit.alias("bit"), (F.col("n") - 1).alias("extra")))).alias("more"))
    level = materialize(words, "manifest-words")
    # From the widest step down: leaves in front of every 2^48, 2^32, 2^16 doc_ids, then of every word.
    base = None
    for shift in (42, 26, 10, 0):
        step = level.groupBy("grp", "known", F.shiftright("word", shift).alias("at")).agg(F.sum("n").alias("n")) if shift else (
            level.select("grp", "known", F.col("word").alias("at"), "n"))
        if base is None:
            parts, order = ["grp"], ["known", "at"]
            step = step.withColumn("base", F.lit(0).cast("long"))
        else:
            above, width = base
            step = step.withColumn("up", F.shiftright("at", width)).join(above, ["grp", "known", "up"])
            parts, order = ["grp", "known", "up"], ["at"]
        earlier = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        step = step.withColumn("before", F.col("base") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        below = {42: 16, 26: 16, 10: 10, 0: 0}[shift]
        base = (step.select("grp", "known", F.col("at").alias("up"), F.col("before").alias("base")), below)
    before = base[0].select("grp", "known", F.col("up").alias("word"), F.col("base").alias("before"))
    return level.select("grp", "known", "word", "bits", "more").join(before, ["grp", "known", "word"])


def placed_leaves(leaves: DataFrame) -> DataFrame:
    """Every leaf of every row with its place ``pos`` in the group.  Rows that
    share a doc_id stand in order of their leaf; equal ones are one run."""
    rows = leaves.select("*", *_word(F.col("doc_id")), F.coalesce(F.col("doc_id").bitwiseAND(F.lit(63)), F.lit(0)).cast("int").alias("bit"))
    found = rows.join(bitmap_index(leaves), ["grp", "known", "word"])
    below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), F.col("bit")))
    extra = F.aggregate("more", F.lit(0).cast("long"), lambda a, m: a + F.when(m["bit"] < F.col("bit"), m["extra"]).otherwise(0))
    found = found.select(
        "grp", "doc_id", "leaf", "changed", "copies",
        (F.col("before") + F.bit_count(F.col("bits").bitwiseAND(below)) + extra).alias("pos"),
        F.exists("more", lambda m: m["bit"] == F.col("bit")).alias("shared"))
    placed = materialize(found, "manifest-placed")
    single = placed.where(~F.col("shared")).select("grp", "doc_id", "leaf", "changed", "pos")
    several = placed.where("shared").drop("shared")
    if several.isEmpty():
        return single
    # Only rows that share a doc_id are put in order, by a range shuffle that no doc_id can fill.
    within = running_total(ordered_index(several, ["leaf"], ["grp", "pos"], index_col="_cf_i"), ["grp", "pos"], "_cf_i", "copies", "_cf_through")
    start = F.col("pos") + F.col("_cf_through") - F.col("copies")
    spread = within.select("grp", "doc_id", "leaf", "changed", F.explode(F.sequence(start, start + F.col("copies") - 1)).alias("pos"))
    return single.unionByName(spread)


def _runs(nodes: Column) -> Column:
    """The next level: digests of every FAN consecutive nodes."""
    last = F.floor((F.size(nodes) - 1) / FAN).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.sha2(F.array_join(F.slice(nodes, k * FAN + 1, FAN), ""), 256))


def _slots(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """One round: nodes (grp, pos, digest, n: nodes of the group on this level)
    meet in arrays of SLOTS, keyed by place: grp, up, n, level_0.. (the slots
    and the levels above them) and top (their ancestor)."""
    entry = F.struct(F.col("pos").alias("pos"), *[F.col(c).alias(c) for c in ["digest", *carried]])
    arrays = nodes.groupBy("grp", F.floor(F.col("pos") / SLOTS).cast("long").alias("up"), "n").agg(F.sort_array(F.collect_list(entry)).alias("slots"))
    out = once(arrays, level_0=F.transform("slots", lambda s: s["digest"]))
    for k in range(1, LEVELS + 1):
        below = F.col(f"level_{k - 1}")
        out = once(out, **{f"level_{k}": F.when(F.col("n") > FAN ** (k - 1), _runs(below)).otherwise(below)})
    return out.withColumn("top", F.element_at(f"level_{LEVELS}", 1)).drop(f"level_{LEVELS}")


def _path(slot: Column) -> Column:
    """Siblings left and right of a slot on each level up to ``top``; levels
    that the group doesn't have are left out."""
    steps = []
    for k in range(LEVELS):
        nodes = F.col(f"level_{k}")
        at = F.floor(slot / FAN**k).cast("int")
        first = (at - F.pmod(at, F.lit(FAN))).cast("int")
        steps.append(F.when(F.col("n") > FAN**k, F.struct(
            F.array_join(F.slice(nodes, first + 1, F.pmod(at, F.lit(FAN))), "").alias("left"),
            F.array_join(F.slice(nodes, at + 2, F.lit(FAN - 1) - F.pmod(at, F.lit(FAN))), "").alias("right"))))
    return F.array_compact(F.array(*steps))


def _reduced(nodes: DataFrame, carried: list[str]) -> list[DataFrame]:
    """The rounds (see :func:`_slots`) that reduce nodes (grp, pos, digest and
    the ``carried`` columns) to one node a group, each a written table.  In
    the last every group has one row, its ``top`` the group's last node."""
    sizes = nodes.groupBy("grp").agg(F.count("*").alias("n"))
    # One row a group, broadcast if that is small, so that nodes of a large group don't meet in one task.
    rounds = [materialize(_slots(nodes.join(bounded_broadcast(sizes), "grp"), carried), "manifest-round")]
    while not rounds[-1].where(F.col("n") > SLOTS).isEmpty():
        tops = rounds[-1].select("grp", F.col("up").alias("pos"), F.col("top").alias("digest"), F.ceil(F.col("n") / SLOTS).cast("long").alias("n"))
        rounds.append(materialize(_slots(tops, []), "manifest-round"))
    return rounds


def _with_paths(rounds: list[DataFrame], last: DataFrame) -> DataFrame:
    """The nodes of the first round (``entry``), each with its ``path`` of
    siblings.  ``last``: the rows of the last round by (grp, up) with the
    ``path`` from their ``top`` on and any other columns to hand down."""
    names = [c for c in last.columns if c not in ("grp", "up", "path")]
    for level in reversed(rounds):
        slots = level.join(last.withColumnRenamed("path", "above"), ["grp", "up"]).select("*", F.posexplode("slots").alias("slot", "entry"))
        reached = slots.select("grp", "entry", F.concat(_path(F.col("slot")), "above").alias("path"), *names)
        last = reached.select("grp", F.col("entry.pos").alias("up"), "path", *names)
    return reached


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang, source, n_chars; other
    columns are ignored): doc_id, leaf, subroot (of the row's language), root,
    proof_sha256, folded_root, verified.

    Rows without a doc_id stand in front of their language, rows that share a
    doc_id in order of their leaves; equal rows take neighbouring places.  A
    null text, language, source or count is part of the leaf as ``-``; a null
    language is a language of its own, the first.  A row that is its
    language's only one is its subroot, an only subroot the root; a leaf
    without siblings proves by the digest of the empty string.  An empty table
    gives no rows.  ``folded_root`` folds the digest of the row as tampered
    with (every third by the checksum of its doc_id has its text lower-cased)
    with the original siblings; ``verified`` tells whether it gives the root.
    """
    leaves = materialize(leaves_of(docs), "manifest-leaves")
    placed = materialize(placed_leaves(leaves).withColumnRenamed("leaf", "digest"), "manifest-nodes")
    rounds = _reduced(placed, ["doc_id", "changed"])
    subroots = rounds[-1].select("grp", F.col("top").alias("digest"))
    ordered = ordered_index(subroots, ["grp"], [], index_col="pos").select(
        F.lit("").alias("grp"), (F.col("pos") - 1).alias("pos"), "digest", F.col("grp").alias("of"))
    upper = _reduced(ordered, ["of"])
    no_path = F.array().cast("array<struct<left:string,right:string>>").alias("path")
    tops = _with_paths(upper, upper[-1].select("grp", "up", no_path, F.col("top").alias("root")))
    tops = materialize(tops.select(F.col("entry.of").alias("grp"), F.lit(0).cast("long").alias("up"), "path", F.col("entry.digest").alias("subroot"), "root"), "manifest-tops")
    whole = _with_paths(rounds, tops).select(
        F.col("entry.doc_id").alias("doc_id"), F.col("entry.digest").alias("leaf"), "subroot", "root", "path", F.coalesce("entry.changed", "entry.digest").alias("checked"))
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    folded = F.aggregate("path", F.col("checked"), lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))
    out = once(once(whole, steps=F.col("path")).drop("path").withColumnRenamed("steps", "path"), proof_sha256=proof, folded_root=folded)
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents."""
    return merkle_manifest(load(spark, sf_dir, "documents"))


def oracle_sql(levels: int = 8) -> str:
    """The same in DuckDB, level by level, for languages of up to
    ``8 ** levels`` documents and as many languages."""
    ctes = [f"""
crc(t) as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i::ubigint, range(8)::ubigint[]),
  lambda a, k: case when a & 1 = 1 then xor(a >> 1, 3988292384::ubigint) else a >> 1 end)))""", f"""
rows_in as (select row_number() over () as row_id, doc_id, lang, text,
  '-' as none, concat(coalesce(strlen(doc_id::varchar)::varchar || ':' || doc_id::varchar, '-'), coalesce(strlen(source)::varchar || ':' || source, '-'),
  coalesce(strlen(lang)::varchar || ':' || lang, '-'), coalesce(strlen(n_chars::varchar)::varchar || ':' || n_chars::varchar, '-')) as head,
  xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::ubigint)),
      lambda a, c: xor(a >> 8, t[(xor(a, c) & 255)::int + 1])), 4294967295::ubigint) as checksum from documents, crc)""", f"""
leaves as (select *, sha256(head || coalesce(strlen(text)::varchar || ':' || text, '-')) as leaf,
  case when coalesce(checksum % {TAMPERED_EVERY} = 0, false) then sha256(head || coalesce(strlen(text)::varchar || ':' || translate(text, '{UPPER}', '{LOWER}'), '-')) end as changed from rows_in)""", """
a0 as (select row_id, lang as grp, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, leaf as d from leaves)"""]

    def climb(name: str, key: str) -> str:
        for k in range(levels):
            # A node list that is down to one node stays as it is.
            ctes.append(f"""
{name}s{k} as (select {key}, pos, d, count(*) over (partition by {key}) as n from {name}{k}),
{name}{k + 1} as (select {key}, case when n > 1 then pos // {FAN} else pos end as pos, case when n > 1 then sha256(string_agg(d, '' order by pos)) else max(d) end as d
  from {name}s{k} group by {key}, n, case when n > 1 then pos // {FAN} else pos end),
{name}p{k} as (select x.{key}, x.pos, coalesce(string_agg(y.d, '' order by y.pos) filter (where y.pos < x.pos), '') as l, coalesce(string_agg(y.d, '' order by y.pos) filter (where y.pos > x.pos), '') as r, any_value(x.n) as n
  from {name}s{k} x join {name}s{k} y on x.{key} is not distinct from y.{key} and x.pos // {FAN} = y.pos // {FAN} group by x.{key}, x.pos)""")
        return f"{name}{levels}"

    subroots = climb("a", "grp")
    ctes.append(f"""
b0 as (select 0 as one, row_number() over (order by grp nulls first) - 1 as pos, d, grp from {subroots})""")
    root = climb("b", "one")
    ctes.append(f"""
w0 as (select l.row_id, l.doc_id, l.leaf, a0.grp, a0.pos, '' as proof, coalesce(l.changed, l.leaf) as node from leaves l join a0 using (row_id))""")
    last = "w0"
    for k in range(levels):
        ctes.append(f"""
w{k + 1} as (select row_id, doc_id, leaf, w.grp, case when p.n > 1 then w.pos // {FAN} else w.pos end as pos, proof || p.l || p.r as proof,
  case when p.n > 1 then sha256(p.l || node || p.r) else node end as node from {last} w join ap{k} p on w.grp is not distinct from p.grp and w.pos = p.pos)""")
        last = f"w{k + 1}"
    ctes.append(f"""
v0 as (select w.row_id, w.doc_id, w.leaf, b0.d as subroot, b0.pos, w.proof, w.node from {last} w join b0 on w.grp is not distinct from b0.grp)""")
    last = "v0"
    for k in range(levels):
        ctes.append(f"""
v{k + 1} as (select row_id, doc_id, leaf, subroot, case when p.n > 1 then v.pos // {FAN} else v.pos end as pos, proof || p.l || p.r as proof,
  case when p.n > 1 then sha256(p.l || node || p.r) else node end as node from {last} v join bp{k} p on v.pos = p.pos)""")
        last = f"v{k + 1}"
    return "with " + ",".join(ctes) + f"""
select doc_id, leaf, subroot, r.d as root, sha256(proof) as proof_sha256, node as folded_root, node = r.d as verified from {last}, {root} r"""

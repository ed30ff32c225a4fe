"""License scans: an exact set-similarity join of text blocks with templates.

A block is a window of consecutive words that starts at any word of a
template; a template matches a block when the block holds at least
``CONTAINMENT`` of the template's distinct words, unless all it finds there
belongs to another template that finds more.  Only blocks around a word of
some template's prefix are built.  All words of the templates are ordered by their global count, rarest first.  Two
sets that share o words must share one of the first ``size - o + 1`` words of
either (prefix filter); a block with fewer than o template words can't match
(length filter); a first shared word so late that fewer than o can follow
can't either (positional filter).  What is left is verified exactly.

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candleflow.llm.common import load, once
from candleflow.session import materialize

# Phrases whose words must stand consecutively, with their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# License templates with their labels.
TEMPLATES = {
    "all-rights-reserved": "all rights reserved",
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "mit": "released under the mit license",
    "mit-terms": "permission is hereby granted free of charge to any person obtaining a copy of this software",
}
CONTAINMENT = 0.8
#: Words of a block.
BLOCK = 32

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def template_sets(templates: dict[str, str], containment: float) -> dict[str, tuple[set[str], int]]:
    """Label: (distinct words, how many of them a block must hold)."""
    sets = {label: set(text.split()) for label, text in templates.items()}
    return {label: (s, max(1, math.ceil(containment * len(s) - 1e-9))) for label, s in sets.items()}


def word_ranks(texts: DataFrame, vocabulary: set[str]) -> dict[str, int]:
    """The words of the templates by the number of texts that hold them,
    rarest first, ties by the word.  At most as many rows as the templates
    have words reach the driver."""
    found = texts.select(F.explode("present").alias("w")).groupBy("w").count().collect()
    counts = {r["w"]: r["count"] for r in found}
    return {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}


def matches(texts: DataFrame, sets: dict[str, tuple[set[str], int]], block: int) -> DataFrame:
    """Every (block, template) pair that shares enough words: key, the place
    where the block begins, label, score.  ``texts``: key, present (the
    templates' words in the text), words (null where no template can match).

    The places of template words are found in one pass over a text; a block is
    a stretch of at most ``block`` of them, so its cost doesn't depend on the
    length of the text."""
    vocabulary = set().union(*[s for s, _ in sets.values()])
    if not vocabulary:
        return texts.select("key", F.lit(0).alias("block"), F.lit("").alias("label"), F.lit(0.0).alias("score")).limit(0)
    ranks = word_ranks(texts, vocabulary)
    prefixes = []
    for label, (words, need) in sets.items():
        ordered = sorted(ranks[w] for w in words)
        prefixes += [(r, j, label, len(ordered), need, ordered) for j, r in enumerate(ordered[: len(ordered) - need + 1])]
    index = texts.sparkSession.createDataFrame(prefixes, "rank int, j int, label string, size int, need int, t array<int>")
    rank_of = F.create_map(*[x for w, r in ranks.items() for x in (F.lit(w), F.lit(r))])
    first_ranks = sorted({r for r, *_ in prefixes})
    least = min(need for _, need in sets.values())

    # The places of template words, and those of them up to a block's length before a prefix word.
    marked = once(texts.where(F.size("words") > 0).select("key", "words"), at=F.filter(
        F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).isin(sorted(vocabulary))))
    hits = once(marked.where(F.size("at") >= least), hits=F.transform(
        "at", lambda i: F.struct(i.alias("i"), F.element_at(rank_of, F.get("words", i)).alias("r")))).select("key", "hits")
    rare = once(hits, rare=F.filter(F.sequence(F.lit(0), F.size("hits") - 1), lambda k: F.get("hits", k)["r"].isin(first_ranks)))

    def before(k: Column) -> Column:
        low = F.greatest(k - (block - 1), F.lit(0))
        return F.filter(F.sequence(low, k), lambda a: F.get("hits", a)["i"] > F.get("hits", k)["i"] - block)

    begun = once(rare.where(F.size("rare") > 0), starts=F.array_distinct(F.flatten(F.transform("rare", before))))

    def ranks_from(a: Column) -> Column:
        near = F.filter(F.slice("hits", a + 1, block), lambda h: h["i"] < F.get("hits", a)["i"] + block)
        return F.struct(F.get("hits", a)["i"].alias("block"), F.array_sort(F.array_distinct(F.transform(near, lambda h: h["r"]))).alias("b"))

    built = once(begun, built=F.filter(F.transform("starts", ranks_from), lambda x: F.size(x["b"]) >= least))
    blocks = built.select("key", F.inline("built"))
    tokens = blocks.select("key", "block", "b", F.posexplode("b").alias("i", "rank")).where(F.col("rank").isin(first_ranks))
    size_b = F.size("b")
    pairs = tokens.join(F.broadcast(index), "rank").where(
        (size_b >= F.col("need")) & (F.col("i") <= size_b - F.col("need"))
        & (F.least(F.col("size") - F.col("j"), size_b - F.col("i")) >= F.col("need")))
    verified = pairs.withColumn("shared", F.array_intersect("b", "t")).where(F.size("shared") >= F.col("need"))
    # At most one entry a template in a block.
    met = verified.groupBy("key", "block").agg(F.collect_set(F.struct("label", "shared", (F.size("shared") / F.col("size")).alias("score"))).alias("met"))

    def taken(x: Column) -> Column:
        return F.exists("met", lambda o: (F.size(o["shared"]) > F.size(x["shared"])) & (F.size(F.array_except(x["shared"], o["shared"])) == 0))

    return once(met, own=F.filter("met", lambda x: ~taken(x))).select("key", "block", F.inline("own")).drop("shared")


def _places(words: Column, phrase: str) -> Column:
    """Starts of the phrase among ``words``."""
    parts = phrase.split()

    def stands(i: Column) -> Column:
        same = F.get(words, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            same = same & (F.get(words, i + k) == p)
        return same

    n = F.size(words)
    return F.when(n >= len(parts), F.filter(F.sequence(F.lit(0), F.greatest(n - len(parts), F.lit(0))), stands)).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None,
         containment: float = CONTAINMENT, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A null text counts as empty: no words, no labels, score 0.  The result
    depends on a row's text alone but for the order of the words, so repeated
    rows and null doc_ids get equal results each; an empty table gives no
    rows.  ``score`` is the largest share of a matching template's words found
    in a block, 0 if no template matches.  Blocks start at every template
    word, so what matches doesn't depend on where it stands in the text.
    """
    phrases = PHRASES if phrases is None else phrases
    sets = template_sets(TEMPLATES if templates is None else templates, containment)
    text = F.coalesce("text", F.lit(""))
    key = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"), F.length(text).alias("n"))
    wanted = sorted({w for p in phrases for w in p.split()}.union(*[s for s, _ in sets.values()]))
    known = F.array(*[F.lit(w) for w in wanted]).cast("array<string>")
    seen = once(once(docs.select("doc_id", key.alias("key"), text.alias("text")), words=words_of(F.col("text"))), present=F.array_intersect("words", known))
    # Words are kept where the whole text holds what a block or phrase of it would need.
    likely = F.lit(False)
    for words, need in [*sets.values(), *[(set(p.split()), len(set(p.split()))) for p in phrases]]:
        likely = likely | (F.size(F.array_intersect("present", F.array(*[F.lit(w) for w in sorted(words)]))) >= need)
    texts = materialize(seen.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), "present", F.when(likely, F.col("words")).alias("words")), "license-words")

    found = once(texts.where("words is not null"), at=F.array(*[_places(F.col("words"), p) for p in phrases]).cast("array<array<int>>")).select("key", "at")
    flat = F.flatten("at")
    labels = F.array_compact(F.array(*[F.when(F.size(F.get("at", F.lit(k))) > 0, F.lit(label)) for k, label in enumerate(phrases.values())]).cast("array<string>"))
    base_hits = found.where(F.size(flat) > 0).select(
        "key", F.size(flat).cast("long").alias("n_base"), F.array_min(flat).cast("long").alias("first_word"), F.array_max(flat).cast("long").alias("last_word"), labels.alias("base"))
    more = matches(texts, sets, block)
    more = more.groupBy("key").agg(F.collect_set("label").alias("more"), F.max("score").alias("score"))
    # Texts that hold anything, one row each.
    hits = materialize(base_hits.dropDuplicates(["key"]).join(more, "key", "full"), "license-hits")
    none = F.array().cast("array<string>")
    joined = texts.select("doc_id", "key", "n_words").join(hits, "key", "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct(F.coalesce("base", none))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(F.coalesce("base", none), F.coalesce("more", none)))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and license templates in all documents."""
    return scan(load(spark, sf_dir, "documents"))


def oracle_sql() -> str:
    """The same by brute force in DuckDB: every block, from every template word on, with every template."""
    def sql_list(values):
        return "[" + ", ".join(f"'{v}'" for v in values) + "]"

    phrase_rows = ", ".join(f"('{label}', {sql_list(p.split())})" for p, label in PHRASES.items())
    sets = template_sets(TEMPLATES, CONTAINMENT)
    template_rows = ", ".join(f"('{label}', {sql_list(sorted(s))}, {need})" for label, (s, need) in sets.items())
    return f"""
with d as (
  select row_number() over () as row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as words from documents),
phrases(label, p) as (values {phrase_rows}),
templates(label, t, need) as (values {template_rows}),
places as (
  select row_id, label, unnest(list_filter(range(len(words)::bigint), lambda i: words[i + 1 : i + len(p)] = p)) as pos
  from d, phrases where len(words) > 0),
base as (
  select row_id, count(*) as n_base, min(pos) as first_word, max(pos) as last_word, string_agg(distinct label, ',' order by label) as base_labels
  from places group by row_id),
starts as (
  select row_id, words, unnest(list_filter(range(len(words)::bigint), lambda i: list_contains({sql_list(sorted(set().union(*[x for x, _ in sets.values()])))}, words[i + 1]))) as b
  from d where len(words) > 0),
blocks as (select row_id, b, words[b + 1 : b + {BLOCK}] as w from starts),
met as (
  select row_id, b, label, len(t) as size, list_intersect(w, t) as shared
  from blocks, templates where len(list_intersect(w, t)) >= need),
more as (
  select row_id, label, max(len(shared) / size) as score from met x
  where not exists (select 1 from met o where o.row_id = x.row_id and o.b = x.b and len(o.shared) > len(x.shared) and list_has_all(o.shared, x.shared))
  group by row_id, label),
named as (
  select row_id, label from places union select row_id, label from more),
labels as (select row_id, string_agg(distinct label, ',' order by label) as labels from named group by row_id),
best as (select row_id, max(score) as score from more group by row_id)
select doc_id, len(words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
       coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0)::double as score
from d left join base using (row_id) left join labels using (row_id) left join best using (row_id)
"""

import re

import pytest

from candleflow.llm import licenses as L


def brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for p, label in L.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    base = {label for _, label in places}
    more, best = set(), 0.0
    sets = L.template_sets(L.TEMPLATES, L.CONTAINMENT)
    known = set().union(*[x for x, _ in sets.values()])
    for b in range(len(w)):
        block = set(w[b : b + L.BLOCK])
        met = {label: words & block for label, (words, need) in sets.items() if w[b] in known and len(words & block) >= need}
        for label, shared in met.items():
            if not any(shared < other for other in met.values()):
                more.add(label)
                best = max(best, len(shared) / len(sets[label][0]))
    at = [i for i, _ in places]
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), best)


def test_matches_brute_force(spark):
    mit = "Released under the MIT license"
    texts = ["", None, "!!", "CC BY", "cc-by cc BY\ncc by-nc", "all rights", "All Rights RESERVED. all rights reserved", mit, mit.replace("the ", ""),
             "released under mit", "x " * 30 + mit + " y" * 40, "GNU General Public License", "publIc lİcense general public license", "worK all rightſ reserved",
             "license " * 50, "the of under by " * 5000 + "Licensed under CC BY-NC 4.0", "é cc by é", "Permission is hereby granted, free of charge, to any person",
             L.TEMPLATES["bsd"], " ".join(reversed(L.TEMPLATES["gpl-3.0"].split()))]
    rows = [(i, t, 1, "q") for i, t in enumerate(texts)] + [(None, "cc by", 1, "q"), (3, "CC BY", 1, "q"), (3, "CC BY", 1, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, words int, key string")
    out = L.scan(df).collect()
    key = lambda x: tuple(("" if v is None else str(v)) for v in x)
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in out), key=key)
    assert got == sorted(((i, *brute(t)) for i, t, *_ in rows), key=key)


def test_a_notice_with_inserted_words_matches_at_any_offset(spark):
    notice = L.TEMPLATES["mit-terms"].split()
    notice[8:8] = ["zzz"] * 12
    rows = [(k, " ".join(["q"] * k + notice)) for k in range(40)]
    out = L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.labels, r.score) for r in out} == {("mit-terms", 1.0)}


def test_close_templates_are_told_apart(spark):
    rows = [(0, "Licensed under CC BY-NC 4.0"), (1, "licensed under cc by sa 4.0"), (2, "licensed under cc by sa 4.0 or licensed under cc by nc 4.0"),
            (3, "All rights reserved. Licensed under the Apache License, version 2"), (4, "licensed under cc by 4.0")]
    out = {r.doc_id: r.labels for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0] == "cc-by,cc-by-nc-4.0" and out[1] == "cc-by,cc-by-sa-4.0" and out[2] == "cc-by,cc-by-nc-4.0,cc-by-sa-4.0"
    assert out[3] == "all-rights-reserved,apache-2.0,reserved" and out[4] == "cc-by,cc-by-nc-4.0,cc-by-sa-4.0"


@pytest.mark.parametrize("kw", [{"phrases": {}}, {"templates": {}}])
def test_empty_table_and_empty_lists(spark, kw):
    assert L.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert L.scan(spark.createDataFrame([(1, "cc by")], "doc_id long, text string"), **kw).count() == 1

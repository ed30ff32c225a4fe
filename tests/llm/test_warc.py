import hashlib

import pytest

from candleflow.llm import warc as W


def rec(i, payload, kind="response", refers=None):
    return W.record(i, f"http://a.b/{i}", payload, hashlib.sha1(payload).hexdigest(), kind, refers)


def ids(data):
    return [int(r["fields"]["page-id"]) for _, _, r, _ in W.salvage(data) if r]


def gaps(data):
    return [(s, e) for s, e, r, _ in W.salvage(data) if r is None]


@pytest.mark.parametrize("gzip", [True, False])
def test_round_trip_and_damage(gzip):
    wrap = W.member if gzip else (lambda x: x)
    parts = [wrap(rec(i, b"<p>%d</p>" % i * (50 * i))) for i in range(6)]
    data = b"\0".join(parts)
    assert ids(data) == [0, 1, 2, 3, 4, 5] and gaps(data) == []
    start = sum(len(p) + 1 for p in parts[:2])
    hurt = bytearray(data)
    for k in range(10):
        hurt[start + len(parts[2]) // 2 + k] ^= 0x55
    assert ids(bytes(hurt)) == [0, 1, 3, 4, 5]
    (s, e), = gaps(bytes(hurt))
    assert s == start and e == start + len(parts[2]) + 1


@pytest.mark.parametrize("gzip", [True, False])
def test_truncation_at_any_place_keeps_whole_records(gzip):
    wrap = W.member if gzip else (lambda x: x)
    parts = [wrap(rec(i, b"x" * (40 + i))) for i in range(3)]
    data = b"\0".join(parts)
    for cut in range(0, len(data), 7):
        whole, pos = 0, 0
        for p in parts:
            pos += len(p)
            whole += cut >= pos
            pos += 1
        assert len(ids(data[:cut])) == whole
        covered = sum(e - s for s, e in gaps(data[:cut]))
        assert covered == max(0, cut - sum(len(p) + 1 for p in parts[:whole])) or cut in (sum(len(p) + 1 for p in parts[:whole]) - 1,)


def test_junk_between_and_missing_start():
    a, b = W.member(rec(1, b"a" * 99)), W.member(rec(2, b"b" * 99))
    assert ids(b"junk \x1f\x8b\x08 junk" + a + b"WARC/1.1 nothing" + b) == [1, 2]
    assert ids(a[5:] + b) == [2]
    assert ids(b"") == [] and gaps(b"\0\0") == []
    assert gaps(b"only junk") == [(0, 9)]


def test_wrong_length_and_wrong_digest():
    good = rec(1, b"payload")
    short = good.replace(b"Content-Length: %d" % len(good.split(b"\r\n\r\n", 1)[1][:-4]), b"Content-Length: 5")
    assert ids(short + rec(2, b"z")) == [2]
    assert ids(good.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n") + rec(2, b"z")) == [2]


def packed(n=10, size=400):
    """n records, and the places in their text where they begin."""
    import random

    rng = random.Random(n)
    parts = [rec(i, bytes(rng.randrange(32, 127) for _ in range(size))) for i in range(n)]
    return parts, b"".join(parts)


def test_one_damaged_record_of_a_member():
    parts, text = packed()
    hurt = bytearray(text)
    hurt[sum(map(len, parts[:4])) + len(parts[4]) - 20] ^= 1
    data = W.member(rec(77, b"before")) + b"\0" + W.member(bytes(hurt)) + b"\0" + W.member(rec(88, b"after"))
    assert ids(data) == [77, 0, 1, 2, 3, 5, 6, 7, 8, 9, 88]
    (start, end, _, reason), = [x for x in W.salvage(data) if x[2] is None]
    assert start == len(W.member(rec(77, b"before"))) + 1 and end == start + len(W.member(bytes(hurt)))
    a = sum(map(len, parts[:4]))
    assert reason == f"block digest differs, bytes {a} to {a + len(parts[4])} of the member's text"
    hurt[:4] = b"XXXX"
    assert ids(W.member(bytes(hurt))) == [1, 2, 3, 5, 6, 7, 8, 9]


def test_a_member_that_breaks_off_or_goes_bad_keeps_what_comes_before():
    parts, text = packed(20, 5000)
    whole = W.member(text)
    for lost in (40, len(whole) // 2):
        got = ids(whole[:-lost])
        assert got == list(range(len(got))) and len(got) >= 20 * (len(whole) - lost) // len(whole) - 1
        assert gaps(whole[:-lost]) == [(0, len(whole) - lost)]
        assert ids(whole[:-lost] + W.member(rec(99, b"x"))) == [*got, 99]
    hurt = bytearray(whole)
    hurt[len(whole) // 2 : len(whole) // 2 + 50] = b"\xff" * 50
    got = ids(bytes(hurt) + b"\0" + W.member(rec(99, b"x")))
    assert got[-1] == 99 and set(range(9)) <= set(got) and len(set(got)) == len(got)


def test_records_without_digest_count_only_in_sound_members():
    bare = b"\r\n".join(x for x in rec(1, b"p").split(b"\r\n") if b"Digest" not in x)
    assert ids(W.member(bare + rec(2, b"q"))) == [1, 2]
    broken = W.member(bare + rec(2, b"q") + rec(3, b"r" * 50))[:-4]
    assert ids(broken) == [2]


def test_a_broken_member_of_stored_blocks_gives_records_once():
    import zlib

    _, text = packed(6, 300)
    z = zlib.compressobj(0, zlib.DEFLATED, 31)
    data = (z.compress(text) + z.flush())[:-30]
    assert ids(data + b"\0" + W.member(rec(50, b"x"))) == [0, 1, 2, 3, 4, 50]


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    import os

    df = spark.range(40).selectExpr("id as page_id", "'u' as url", "repeat(sha1(cast(id as string)), 15000) as html")
    W.write_archives(df, str(tmp_path / "a"), gzip=False, chunks=2)
    sizes = [os.path.getsize(tmp_path / "a" / f) for f in os.listdir(tmp_path / "a") if f.startswith("part")]
    assert max(sizes) <= 2 * (W.CHUNK_BYTES + 610_000) and sum(sizes) > 24_000_000
    assert sorted(r.page_id for r in W.read_archives(spark, str(tmp_path / "a"), payloads=False).collect()) == list(range(40))


def test_pages_edge_cases(spark, tmp_path):
    big, text = "é" * 600, "y" * 999
    rows = [(1, "u", big, 7), (5, "u", big, 7), (3, None, big, 7), (None, "u\r\nv", big, 7), (6, "u", text, 7), (7, "u", text, 7),
            (8, "u", None, 7), (9, "u", "", 7), (10, "u", "Q" * 3_000_000, 7), (11, "u", "r" * 1000, 7), (11, "u", "r" * 1000, 7)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    W.write_archives(df, str(tmp_path / "a"))
    out = W.read_archives(spark, str(tmp_path / "a"))
    assert out.where("gap is not null").count() == 0
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in out.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert got == [(1, "revisit", 5, 1200), (3, "revisit", 5, 1200), (5, "response", None, 1200), (6, "response", None, 999), (7, "response", None, 999),
                   (8, "response", None, 0), (9, "response", None, 0), (10, "response", None, 3_000_000), (11, "response", None, 1000),
                   (11, "response", None, 1000), (None, "revisit", 5, 1200)]
    html = {r.page_id: bytes(r.payload).decode() for r in out.where("record_type = 'response'").collect()}
    assert html[5] == big and html[8] == "" and len(html[10]) == 3_000_000
    digest = {r.page_id: r.payload_digest for r in out.collect()}
    assert digest[1] == hashlib.sha1(big.encode()).hexdigest()


def test_empty_table(spark, tmp_path):
    W.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "a"))
    assert W.read_archives(spark, str(tmp_path / "a")).count() == 0

from __future__ import annotations

import gzip
import hashlib
import random

import pytest

from tidemark.llm import warc

PAGES = "page_id long, url string, html string"


def sha(text):
    return hashlib.sha1((text or "").encode()).hexdigest()


def make(i, payload=b"x" * 50, kind="response"):
    return warc.record(kind, i, f"http://a.example/{i}", len(payload), hashlib.sha1(payload).hexdigest(), None, payload)


def expected(rows):
    out = []
    for page, url, html in rows:
        same = [(p if p is not None else -1, u or "", p) for p, u, h in rows if (h or "") == (html or "")]
        size = len((html or "").encode())
        lead = max(same)
        own = size < 1000 or (page if page is not None else -1, url or "") == lead[:2]
        out.append((page, size, sha(html), "response" if own else "revisit", None if own else lead[2]))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    long, other = "é<p>" * 400, "WARC/1.0\r\n" * 200
    rows = [
        (1, "http://a/1", long), (2, "http://a/2", long), (3, None, long), (4, "http://a/é x\r\n", "short"), (5, "u", "short"),
        (6, "u", None), (7, "u", ""), (None, "u", "n" * 2000), (8, "u", other), (9, "u", "z" * 999), (10, "u", "z" * 999),
        (11, "u", "z" * 1000), (12, "u", "z" * 1000), (None, None, "lonely"),
        (13, "big", "line of text\n" * 300_000), (14, "crlf", "\r\n\r\n" * 300 + "\x00\x1f\x8b"),
    ]
    pages = spark.createDataFrame(rows, PAGES)
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path)
    records, gaps = warc.read_archives(spark, path)
    got = records.collect()
    digest = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got]
    assert sorted(digest, key=str) == expected(rows)
    assert gaps.count() == 0
    html = {r["page_id"]: r["payload"] for r in got if r["record_type"] == "response" and r["page_id"]}
    for page, _, text in rows:
        if page in html:
            assert bytes(html[page]).decode() == (text or "")
    # Other gzip readers read the files too.
    file = next(f for f in sorted((tmp_path / "warc").glob("part-*")) if f.stat().st_size)
    assert gzip.decompress(file.read_bytes()).startswith(b"WARC/1.0\r\n")


def test_repeated_rows(spark, tmp_path):
    long = "y" * 1500
    rows = [(3, "u", long)] * 4 + [(3, "v", long), (1, "u", long), (2, "u", "short"), (2, "u", "short")]
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame(rows, PAGES), path)
    records, _ = warc.read_archives(spark, path, payload=False)
    got = sorted((r["page_id"], r["record_type"], r["refers_to"] or 0, r["uri"]) for r in records.collect())
    assert got == sorted(
        [(3, "response", 0, "v"), *[(3, "revisit", 3, "u")] * 4, (1, "revisit", 3, "u"), *[(2, "response", 0, "u")] * 2]
    )
    assert len({r["record_id"] for r in records.collect() if r["record_type"] == "revisit" and r["page_id"] == 3}) == 4


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame([], PAGES), path)
    assert warc.read_archives(spark, path)[0].count() == 0


def parsed(data):
    found = list(warc.salvage(data))
    good = [r.headers["x-page-id"] for _, _, r in found if not isinstance(r, str)]
    bad = [(a, b) for a, b, r in found if isinstance(r, str)]
    return good, bad


def test_plain_and_compressed_members():
    plain = [make(i) for i in range(4)]
    data = plain[0] + gzip.compress(plain[1]) + warc.SEPARATOR + plain[2] + gzip.compress(plain[3] + plain[0])
    assert parsed(data) == (["0", "1", "2", "3", "0"], [])


@pytest.mark.parametrize("packed", [False, True])
def test_salvage(packed):
    members = [make(i, bytes([65 + i]) * 300) for i in range(6)]
    members = [gzip.compress(m, mtime=0) for m in members] if packed else members
    starts = [sum(map(len, members[:i])) for i in range(7)]
    data = b"".join(members)
    # A flipped byte, junk between members, a cut end.
    broken = bytearray(data)
    broken[starts[2] + len(members[2]) // 2] ^= 0xFF
    assert parsed(bytes(broken)) == (["0", "1", "3", "4", "5"], [(starts[2], starts[3])])
    junk = b"\x1f\x8b\x08junk WARC/1.0\r\nnot"
    good, bad = parsed(data[: starts[3]] + junk + data[starts[3] :])
    assert good == list("012345") and bad == [(starts[3], starts[3] + len(junk))]
    assert parsed(data[:-7]) == (list("01234"), [(starts[5], len(data) - 7)])
    assert parsed(b"") == ([], []) and parsed(b"junk") == ([], [(0, 4)])
    # Bytes that are gaps and bytes that are records make up the whole.
    rng = random.Random(2)
    for _ in range(60):
        noisy = bytearray(data)
        for _ in range(rng.randint(1, 4)):
            at = rng.randrange(len(noisy))
            noisy[at : at + rng.randint(0, 40)] = rng.randbytes(rng.randint(0, 40))
        spans = [(a, b) for a, b, _ in warc.salvage(bytes(noisy))]
        assert spans == sorted(spans) and spans[0][0] == 0 and spans[-1][1] == len(noisy)
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_lengths_and_digests_are_checked():
    good = make(1)
    for old, new in ((b"Content-Length: 1", b"Content-Length: 9"), (b"sha1:", b"sha1:A"), (b"WARC-Type", b"WARC Type")):
        damaged = good.replace(old, new, 1)
        assert damaged != good and parsed(damaged + make(2))[0] == ["2"]


def test_gap_log(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(make(1) + b"junk" + make(2))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(make(3))[:-3])
    (tmp_path / "empty.warc").write_bytes(b"")
    records, gaps = warc.read_archives(spark, str(tmp_path))
    assert sorted(r["page_id"] for r in records.collect()) == [1, 2]
    assert sorted((r["file"].rsplit("/")[-1], r["end"] - r["start"]) for r in gaps.collect()) == [
        ("a.warc", 4), ("b.warc.gz", len(gzip.compress(make(3))) - 3)
    ]

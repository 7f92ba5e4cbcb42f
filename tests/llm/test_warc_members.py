"""Members of several records, damaged."""

from __future__ import annotations

import gzip
import random
import time
import zlib

import pytest

from tests.llm.test_warc import make, parsed
from tidemark.llm import warc


def many(n=40):
    rng = random.Random(1)
    records = [make(i, rng.randbytes(3_000)) for i in range(n)]
    return records, [str(i) for i in range(n)]


def inside(data):
    return [r.inside for _, _, r in warc.salvage(data) if isinstance(r, str)]


def test_a_bad_record_in_a_sound_member():
    records, names = many(5)
    starts = [sum(map(len, records[:i])) for i in range(6)]
    for bad in range(5):
        broken = [r.replace(b"Content-Length: 3", b"Content-Length: 4", 1) if i == bad else r for i, r in enumerate(records)]
        data = gzip.compress(b"".join(broken)) + gzip.compress(make(99))
        good, gaps = parsed(data)
        assert good == [n for n in names if n != str(bad)] + ["99"]
        assert len(gaps) == 1 and inside(data) == [(starts[bad], starts[bad + 1])]


@pytest.mark.parametrize("level", [0, 9])
@pytest.mark.parametrize("cut", [1, 7, 8, 20, 5_000, 60_000])
def test_a_cut_end(level, cut):
    records, names = many()
    whole = gzip.compress(b"".join(records), level)
    good, gaps = parsed(whole[:-cut])
    left = len(zlib.decompressobj(31).decompress(whole[:-cut]))
    ends = [sum(map(len, records[: i + 1])) for i in range(40)]
    assert good == [n for n, end in zip(names, ends, strict=True) if end <= left] and len(good) > 10 and gaps
    assert gaps[-1][1] == len(whole) - cut
    # A sound member behind the cut one is read as before, and nothing is read twice.
    assert parsed(whole[:-cut] + gzip.compress(make(99)))[0][-1] == "99"
    assert len(set(good)) == len(good)


def test_a_cut_at_the_checksum_loses_no_record():
    records, names = many()
    assert parsed(gzip.compress(b"".join(records))[:-5])[0] == names


@pytest.mark.parametrize("level", [0, 1, 9])
def test_a_bad_block(level):
    records, names = many()
    data = bytearray(gzip.compress(b"".join(records), level))
    data[len(data) // 2] ^= 0xFF
    data = bytes(data) + gzip.compress(make(99))
    good, gaps = parsed(data)
    assert good[:15] == names[:15] and good[-1] == "99" and gaps
    assert len(set(good)) == len(good)


def test_a_wrong_checksum_needs_digests():
    plain = [b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 4\r\nX-Page-Id: %d\r\n\r\nabcd\r\n\r\n" % i for i in range(3)]
    data = gzip.compress(make(7) + b"".join(plain) + make(8))
    assert parsed(data)[0] == ["7", "0", "1", "2", "8"]
    assert parsed(data[:-8] + bytes(8))[0] == ["7", "8"]
    assert parsed(data[:-8])[0] == ["7", "0", "1", "2", "8"]


def test_gap_log_of_a_member(spark, tmp_path):
    records, _ = many(3)
    broken = records[1].replace(b"sha1:", b"sha1:A", 1)
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(records[0] + broken + records[2]))
    found, gaps = warc.read_archives(spark, str(tmp_path))
    assert sorted(r["page_id"] for r in found.collect()) == [0, 2]
    assert [(r["inside_start"], r["inside_end"]) for r in gaps.collect()] == [
        (len(records[0]), len(records[0]) + len(broken))
    ]


def damaged(n):
    """An archive of members that are all damaged, with no version line outside of them."""
    whole = [bytearray(gzip.compress(make(i, random.Random(i).randbytes(1_000)))) for i in range(n)]
    for member in whole:
        member[500] ^= 0xFF
    return b"".join(whole)


def test_time_grows_linearly_with_damaged_members():
    def seconds(n):
        data, best = damaged(n), float("inf")
        for _ in range(3):
            started = time.process_time()
            found = list(warc.salvage(data))
            best = min(best, time.process_time() - started)
        assert len(found) == 1 and found[0][:2] == (0, len(data))
        return best

    assert seconds(8_000) <= 2.5 * seconds(4_000)


@pytest.mark.parametrize("kind", ["member", "plain"])
def test_records_between_much_damage(kind):
    rng = random.Random(3)
    parts, names = [], []
    for i in range(400):
        one = make(i, rng.randbytes(300))
        sound = rng.random() < 0.3
        if not sound:
            at = one.index(b"\r\n\r\n") + 50
            one = one[:at] + bytes([one[at] ^ 0xFF]) + one[at + 1 :]
        else:
            names.append(str(i))
        parts.append(gzip.compress(one) if kind == "member" else one)
    data = b"".join(parts)
    good, gaps = parsed(data)
    assert good == names
    assert all(a < b for a, b, *_ in gaps)

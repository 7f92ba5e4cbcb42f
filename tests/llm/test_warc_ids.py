from __future__ import annotations

from tidemark.llm import warc


def test_ids_of_the_whole_range_of_a_long(spark, tmp_path):
    least, most = -(1 << 63), (1 << 63) - 1
    ids = [least, -(10**18), 10**18 - 1, 10**18, most]
    rows = [(i, f"u{i}", "short") for i in ids] + [(i, "v", "y" * 2000) for i in (least, most)]
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    found = warc.read_archives(spark, path)[0].collect()
    assert sorted(r["page_id"] for r in found) == sorted(r[0] for r in rows)
    assert [(r["page_id"], r["refers_to"]) for r in found if r["record_type"] == "revisit"] == [(least, most)]


def test_numbers_out_of_range_are_none():
    assert [warc._number(str(n)) for n in ((1 << 63), -(1 << 63) - 1, 10**19)] == [None] * 3
    assert warc._number("") is None and warc._number("1e3") is None

import gzip
import hashlib
import re
from collections import defaultdict
from pathlib import Path

import pyarrow.fs as pafs
import pytest

from quadrel.llm import exact_dedup, warc
from quadrel.llm.shared import scratch_path


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


@pytest.mark.parametrize("bits", [1, 3])
def test_copy_classes_match_brute_force(odd, odd_rows, bits):
    groups = defaultdict(list)
    for i, t in odd_rows:
        groups[normal(t)].append((-len(t or ""), i is not None, i if i is not None else 0, i))
    got = exact_dedup.copy_classes(odd, fan_in_bits=bits).collect()
    assert len(got) == len(odd_rows)
    by_hash = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in got:
        members = by_hash[r.text_sha256]
        assert r.group_size == len(members)
        assert r.keep_ident == min(members)[3]
    assert sum(r.kept for r in got) == len(groups)


def test_deduplicate_keeps_rows_whole(odd, odd_rows):
    got = exact_dedup.deduplicate(odd)
    assert got.columns == odd.columns
    assert got.count() == len({normal(t) for _, t in odd_rows})


def test_empty_tables(none):
    assert exact_dedup.copy_classes(none).count() == 0
    assert exact_dedup.deduplicate(none).count() == 0


@pytest.fixture
def pages(spark):
    body = "<p>" + "same " * 40 + "</p>"
    rows = [(1, "http://a/ b", body), (2, None, body), (3, "u", "short"), (4, "u", "short"), (5, "u", None), (None, "u", body), (6, "u", "é🎉\r\n\r\n" * 50), (7, "u", "x\0y" * 20_000), (2, None, body)]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload_digest string").repartition(2)


def test_warc_round_trip(spark, pages):
    folder = scratch_path(spark, "t")
    index = warc.write_archives(pages, folder)
    got = warc.read_archives(index, folder, payloads=True).collect()
    want = pages.collect()
    assert len(got) == len(want)
    html = {r.page_id: r.html or "" for r in want}
    for r in got:
        payload = html[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
        if r.record_type == "response":
            assert r.payload == payload and r.refers_to is None
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got)
    assert kinds == [(0, "response", None), (1, "response", None), (2, "revisit", 1), (2, "revisit", 1), (3, "response", None), (4, "response", None), (5, "response", None), (6, "response", None), (7, "response", None)]
    fs, top = pafs.FileSystem.from_uri(folder)
    names = sorted(x.base_name for x in fs.get_file_info(pafs.FileSelector(top)))
    assert names and all(n.endswith((".warc.gz", ".warc.gz.idx")) for n in names)  # no monolith or part is left
    whole = gzip.decompress(fs.open_input_file(f"{top}/{names[0]}").read())
    assert whole.startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_normaliser_reads_streams_of_any_framing(tmp_path):
    fs = pafs.LocalFileSystem()
    records = [warc.record_bytes(i, f"http://x/{i}", bytes([i % 251]) * (i * 997 % 70_000), None) for i in range(40)]
    one = str(tmp_path / "one.gz")
    warc.write_monolith(fs, one, iter(records))
    many = str(tmp_path / "many.gz")
    with open(many, "wb") as f:
        f.write(b"".join(gzip.compress(b"".join(records[i : i + 7])) for i in range(0, 40, 7)))
    for source in (one, many):
        entries = warc.normalise(fs, source, str(tmp_path / "out.gz"))
        assert [warc.read_member(fs, str(tmp_path / "out.gz"), e["offset"], e["length"]) for e in entries] == records
    with pytest.raises(ValueError):
        list(warc.split_records(iter([records[3][:-10]])))


def test_warc_of_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(empty).count() == 0


def test_an_archive_is_the_same_whatever_the_order_of_rows(spark, tmp_path):
    rows = [(i, f"http://x/{i}", "<p>" + "word " * (i % 50) + "</p>" if i % 9 else None) for i in range(300)] + [(5, "http://y", "again"), (5, "http://y", "again")]
    written = []
    for k, order in enumerate((rows, rows[::-1], sorted(rows, key=lambda r: hash(str(r))))):
        df = spark.createDataFrame(order, "page_id long, url string, html string").coalesce(1)
        folder = f"{tmp_path}/{k}"
        index = sorted(map(str, warc.write_archives(df, "file://" + folder).collect()))
        written.append((index, {f.name: f.read_bytes() for f in sorted(Path(folder).iterdir())}))
    assert written[0] == written[1] == written[2] and len(written[0][1]) == 2

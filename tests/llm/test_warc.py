import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from patronlens.llm import warc
from patronlens.llm.queries import op7_warc_chunks

MARK = "WARC/1.1\r\n"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "http://a", "hello"),
        (2, "http://b\r\nWARC-Type: bad", "hello"),
        (3, None, None),
        (4, "u", ""),
        (None, "x", "hello"),
        (5, "WARC/1.1", MARK * 3 + "é" * 5000 + "\r\n\r\n" + MARK + "x\r\n\r\n"),
        (6, "z", "x\r\n"),
        (7, "z", "\n"),
        (7, "z", "\n"),
        (8, "y", "\r\n\r\nWARC/1.1"),
        (9, "y", "日本語" * 10_000),
    ]
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, payload string, _page string")


def test_round_trip(spark, pages, tmp_path):
    for size in (1 << 16, 1000, 7):
        path = f"file://{tmp_path}/w{size}"
        warc.write_archives(pages, path, size=size)
        rows, want = warc.read_records(spark, path).collect(), pages.collect()
        assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in rows) == sorted(
            (str(p.page_id), len((p.html or "").encode()), digest(p.html)) for p in want
        )
        kind = {r.page_id: (r.record_type, r.refers_to) for r in rows}
        assert kind[2] == kind[None] == ("revisit", 1) and kind[4] == ("revisit", 3) and kind[7] == ("response", None)
        chunks = warc.read_chunks(spark, path)
        for name in (5, 9):
            parts = chunks.filter(chunks.record_id == f"<urn:page:{name}>").orderBy("chunk").collect()
            data = b"".join(p.data for p in parts)
            assert data.decode() == next(p.html for p in want if p.page_id == name)
            assert [p.last for p in parts] == [False] * (len(parts) - 1) + [True]
            assert all(len(p.data) <= size for p in parts)
            done = b""
            for p in parts:  # digests so far
                done += p.data
                assert p.read_digest == base64.b32encode(hashlib.sha1(done).digest()).decode()


def test_small_payloads_never_revisit(pages):
    rows = {r.page_id: r.record_type for r in warc.page_records(pages, least=6).collect()}
    assert set(rows.values()) == {"response"}


def test_files_are_records_of_declared_length(pages, tmp_path):
    warc.write_archives(pages, f"file://{tmp_path}/w", size=1000)
    for file in Path(f"{tmp_path}/w").glob("part-*.gz"):
        data = gzip.decompress(file.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
            assert head.startswith(b"WARC/1.1\r\n")
            n = int(fields[b"Content-Length"])
            assert rest[n : n + 4] == b"\r\n\r\n"
            data = rest[n + 4 :]


def test_damage_is_an_error(spark, pages, tmp_path):
    warc.write_archives(pages.filter("page_id = 9").coalesce(1), f"file://{tmp_path}/w", size=1000)
    file = next(f for f in Path(f"{tmp_path}/w").glob("part-*.gz") if f.stat().st_size > 100)
    data = gzip.decompress(file.read_bytes())
    (tmp_path / "bad").mkdir()
    for n, broken in enumerate((data[: len(data) // 2], data.replace("日".encode(), "本".encode(), 1), data[: data.rindex(b"WARC/1.1")])):
        (tmp_path / "bad" / f"{n}.warc.gz").write_bytes(gzip.compress(broken))
        with pytest.raises(Exception, match="record"):
            warc.read_records(spark, f"file://{tmp_path}/bad/{n}.warc.gz").collect()


def test_pages(spark, tiny):
    pages = spark.read.parquet(f"{tiny}/pages.parquet").collect()
    rows = {r.page_id: r for r in op7_warc_chunks(spark, tiny).collect()}
    first = {}
    for p in sorted(pages, key=lambda p: p.page_id):
        first.setdefault(p.html, p.page_id)
    for p in pages:
        again = first[p.html] != p.page_id
        r = rows[p.page_id]
        assert (r.payload_digest, r.record_type, r.refers_to) == (
            digest(p.html), "revisit" if again else "response", first[p.html] if again else None
        )


def test_no_pages(spark, pages, tmp_path):
    warc.write_archives(pages.limit(0), f"file://{tmp_path}/w")
    assert warc.read_records(spark, f"file://{tmp_path}/w").collect() == []


def test_payloads_are_joined_by_one_plain_digest(pages):
    """Both digests are of the same payload; rows are matched by the hexadecimal one, which costs one pass over it."""
    html = {p.page_id: p.html or "" for p in pages.collect()}
    found = warc._decided(pages, 0).collect()
    assert {r.page_id for r in found} == set(html)
    for r in found:
        digest = hashlib.sha1(html[r.page_id].encode())
        assert (r.sha1, r.payload_digest) == (digest.hexdigest(), base64.b32encode(digest.digest()).decode())

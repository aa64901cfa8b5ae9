"""WARC archives and near-duplicate vectors against brute force."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlens.llm import neardup, warc

PAGES = "page_id long, url string, html string, record long, chunk int"


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    draw = random.Random(1)
    long = "".join(draw.choice("aé漢 <>\r\n") for _ in range(9000))
    tricky = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 3
    html = [None, "", "plain", "plain", long, long, long + "!", tricky, "WARC/1.1\r\n", "end\r\n\r\nWARC/1.1", "\r\n\r\n", "y" * 500]
    rows = [(i, f"http://h/{i}?q=é\r\nX: 1" if i % 2 else None, x, 1, 2) for i, x in enumerate(html)]
    rows += [(50, "u", "same", 1, 2), (50, "u", "same", 1, 2), (50, "u", "other", 1, 2), (None, "u", "plain", 1, 2)]
    rows += [(None, "u", "alone", 1, 2), (60 + 5, "u", "y" * 500, 1, 2), (60, "u", "y" * 499, 1, 2)]
    return spark.createDataFrame(rows, PAGES)


def expected(rows, min_bytes):
    first = {}
    for r in rows:
        if r.page_id is not None:
            first[sha(r.html)] = min(r.page_id, first.get(sha(r.html), r.page_id))
    out = []
    for r in rows:
        size = len((r.html or "").encode())
        refers = first.get(sha(r.html))
        refers = None if refers == r.page_id or size < min_bytes else refers
        out.append((r.page_id, size, sha(r.html), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("chunk", "compression", "min_bytes"), [(64, "none", 0), (1 << 14, "gzip", 0), (100, "none", 5)])
def test_archive_gives_back_what_was_written(spark, pages, tmp_path, chunk, compression, min_bytes):
    path = warc.write_archive(
        pages, str(tmp_path / "w"), chunk_bytes=chunk, compression=compression, min_bytes=min_bytes
    )
    got = [tuple(r) for r in warc.read_archive(spark, path).collect()]
    assert sorted(got, key=repr) == expected(pages.collect(), min_bytes)


def test_archive_is_read_in_splits(spark, pages, tmp_path):
    path = warc.write_archive(pages, str(tmp_path / "w"), chunk_bytes=64, compression="none")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        read = warc.read_archive(spark, path)
        got = [tuple(r) for r in read.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got, key=repr) == expected(pages.collect(), 0)


def test_files_are_warc(spark, pages, tmp_path):
    warc.write_archive(pages, str(tmp_path / "w"), chunk_bytes=256)
    for file in (tmp_path / "w").glob("*.gz"):
        data = gzip.decompress(file.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode("ascii").split("\r\n")
            assert lines[0] == "WARC/1.1"
            fields = dict(line.split(": ", 1) for line in lines[1:])
            length = int(fields["Content-Length"])
            assert rest[length : length + 4] == b"\r\n\r\n" and length < 256 + 200
            data = rest[length + 4 :]


def test_chunks_carry_the_digest_so_far(pages):
    rows = warc.chunks(pages, chunk_bytes=100).orderBy("record", "chunk").collect()
    whole = {}
    for r in rows:
        whole[r.record] = whole.get(r.record, b"") + bytes(r.data)
        assert len(r.data) <= 100
        assert r.digest == base64.b32encode(hashlib.sha1(whole[r.record]).digest()).decode()
    assert sorted(map(len, whole.values())) == sorted(len((p.html or "").encode()) for p in pages.collect())


def test_damage_is_noticed(spark, pages, tmp_path):
    path = warc.write_archive(pages.where("page_id = 2"), str(tmp_path / "w"), compression="none")
    for file in (tmp_path / "w").glob("part-*"):
        file.write_bytes(file.read_bytes().replace(b"plain", b"plaid"))
    for crc in (tmp_path / "w").glob(".*.crc"):
        crc.write_bytes(b"")
        crc.unlink()
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_archive(spark, path).collect()


def test_empty_pages(spark, pages, tmp_path):
    none = pages.where("false")
    assert warc.read_archive(spark, warc.write_archive(none, str(tmp_path / "w"))).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    draw = np.random.default_rng(1)
    rows, centre = [], draw.normal(size=(6, 16))
    for i in range(300):
        rows.append((i, (centre[i % 6] + draw.normal(size=16) * (0.02 + 0.03 * (i % 7))).tolist(), i % 3, "x"))
    rows += [(400 + i, rows[0][1], 0, "x") for i in range(60)]  # copies
    rows += [(500 + i, [3 * x for x in rows[1][1]], 0, "x") for i in range(3)]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [math.nan] + [1.0] * 15, [math.inf] + [1.0] * 15, [1.0], [2.0], [1e300, 0.0]]
    rows += [(600 + i, v, 0, "x") for i, v in enumerate(odd)]
    rows += [(None, rows[0][1], 0, "x"), (5, rows[5][1], 0, "x"), (-3, [-x for x in rows[2][1]], 0, "x")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, place int, code string")


@pytest.mark.parametrize(("tile", "per_code"), [(1024, 200), (7, 200), (1024, 1)])
def test_links_are_those_of_all_pairs(vectors, tile, per_code, monkeypatch):
    monkeypatch.setattr(neardup, "TILE", tile)
    monkeypatch.setattr(neardup, "PER_CODE", per_code)
    rows = vectors.collect()
    usable = [
        r.vec_id is not None and bool(r.embedding) and all(x is not None and math.isfinite(x) for x in r.embedding)
        and any(r.embedding)
        for r in rows
    ]
    links, group = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    unit = [np.array(r.embedding) / np.linalg.norm(r.embedding) if ok else None for r, ok in zip(rows, usable, strict=True)]
    for i in range(len(rows)):
        for j in range(i):
            if usable[i] and usable[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95:
                links[i] += 1
                links[j] += 1
                group[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if usable[i]:
            least[find(i)] = min(r.vec_id, least.get(find(i), r.vec_id))
    want = []
    for i, r in enumerate(rows):
        component = least[find(i)] if usable[i] else r.vec_id
        want.append((r.vec_id, links[i], component, r.vec_id is not None and r.vec_id == component))
    got = [tuple(r) for r in neardup.near_duplicates(vectors).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_no_vectors(vectors):
    assert neardup.near_duplicates(vectors.where("false")).count() == 0
    lone = neardup.near_duplicates(vectors.where("vec_id = 1")).collect()
    assert [tuple(r) for r in lone] == [(1, 0, 1, True)]


def test_float_vectors(spark, vectors):
    floats = vectors.where("vec_id < 300").withColumn("embedding", F.col("embedding").cast("array<float>"))
    assert neardup.near_duplicates(floats).agg(F.sum("n_links")).head()[0] > 0


def test_more_vectors_get_longer_codes_and_enough_tables():
    for n in (0, 1, 1000, 10**6, 10**9):
        bits, tables = neardup.plan_tables(n)
        same = 1 - math.acos(0.95) / math.pi
        assert (1 - same**bits) ** tables <= 1e-4
        assert n / 2**bits <= 2 * neardup.PER_CODE

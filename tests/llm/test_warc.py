import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sieveline.llm import warc

PAGES = [
    (1, "http://a", "x" * 1000),
    (2, "http://b\r\nWARC-Type: fake", "x" * 1000),
    (3, None, "x" * 1000),
    (4, "http://d", "y" * 999),
    (5, "http://e", "y" * 999),
    (6, "http://f", None),
    (7, "http://ü", "é" * 600 + "\r\n\r\nWARC/1.1\r\n\r\n"),
    (8, "http://h", ""),
    (None, "http://i", "x" * 1000),
    (3, "again", "x" * 1000),
    (9, "http://long", "long \r\n" * 200_000),
]
SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("limit", [warc.ARCHIVE_BYTES, 100_000])
def test_round_trip(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", limit)
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "payload", "record", "__n")})
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path)
    rows = warc.read_archives(spark, path).collect()
    assert not [r for r in rows if r.gap_bytes]
    got = sorted((r.record_id, r.record_type, str(r.refers_to), r.payload_bytes, r.payload_digest) for r in rows)
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        revisit = html == "x" * 1000 and i != 3
        want.append((f"<urn:page:{'null' if i is None else i}>", "revisit" if revisit else "response",
                     "<urn:page:3>" if revisit else "None", len(data), hashlib.sha1(data).hexdigest()))
    assert got == sorted(want)
    for r in rows:
        if r.record_type == "response":
            assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest
    assert any(r.target_uri == "http://b%0D%0AWARC-Type:%20fake" for r in rows)


def record(i, size=300):
    rng = random.Random(i)
    body = bytes(rng.choice(b"abcdefghij") for _ in range(size))
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <r{i}>\r\nWARC-Block-Digest: sha1:{hashlib.sha1(body).hexdigest()}\r\nContent-Length: {size}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def ids(found):
    return [f.headers.get("warc-record-id", "") if isinstance(f, warc.Record) else (f.offset, f.length) for f in found]


@pytest.mark.parametrize("packed", [False, True])
def test_whole_archives(packed):
    parts = [record(i) for i in range(8)]
    data = b"".join(gzip.compress(p) if packed else p for p in parts)
    assert ids(warc.salvage(data)) == [f"<r{i}>" for i in range(8)]
    assert list(warc.salvage(b"")) == []


@pytest.mark.parametrize("packed", [False, True])
def test_damaged_archives_lose_only_what_is_damaged(packed):
    parts = [gzip.compress(record(i)) if packed else record(i) for i in range(12)]
    starts = [sum(map(len, parts[:i])) for i in range(13)]
    data = bytearray(b"".join(parts))
    data[starts[2] + 200] ^= 0xFF  # a flipped byte in the block
    data[starts[5] : starts[5] + 8] = b"garbage!"  # no start
    cut = bytes(data[: starts[9] + 40]) + bytes(data[starts[10] :])  # a record that ends too soon
    cut = cut[:-10]  # the archive ends too soon
    found = list(warc.salvage(cut))
    assert [i for i in ids(found) if isinstance(i, str)] == [f"<r{i}>" for i in (0, 1, 3, 4, 6, 7, 8, 10)]
    gaps = [i for i in ids(found) if not isinstance(i, str)]
    assert gaps[0] == (starts[2], len(parts[2])) and gaps[1] == (starts[5], len(parts[5])) and gaps[2] == (starts[9], 40)
    assert gaps[3][0] + gaps[3][1] == len(cut)


def test_random_damage_accounts_for_every_byte():
    rng = random.Random(4)
    for _ in range(60):
        parts = [gzip.compress(record(i)) if rng.random() < 0.5 else record(i) for i in range(10)]
        data = bytearray(b"".join(parts))
        at = rng.randrange(len(data) - 60)
        size = rng.randrange(1, 60)
        data[at : at + size] = bytes(rng.randrange(256) for _ in range(size))
        starts = [sum(map(len, parts[:i])) for i in range(11)]
        touched = {i for i in range(10) if starts[i] < at + size and starts[i + 1] > at}
        found = ids(warc.salvage(bytes(data)))
        assert {f"<r{i}>" for i in range(10) if i not in touched} <= {f for f in found if isinstance(f, str)}
        assert sum(f[1] for f in found if not isinstance(f, str)) <= sum(len(parts[i]) for i in touched)


def named(found):
    return [f.headers["warc-record-id"] for f in found if isinstance(f, warc.Record)]


def test_damaged_record_inside_of_a_member():
    parts = [record(i) for i in range(6)]
    parts[2] = parts[2][:-40] + b"#" + parts[2][-39:]
    data = gzip.compress(b"".join(parts)) + gzip.compress(record(6))
    found = list(warc.salvage(data))
    assert named(found) == [f"<r{i}>" for i in (0, 1, 3, 4, 5, 6)]
    (gap,) = [f for f in found if isinstance(f, warc.Gap)]
    assert (gap.offset, gap.length) == (0, len(parts[2])) and "warc-block-digest differs" in gap.reason
    assert str(len(parts[0] + parts[1])) in gap.reason


@pytest.mark.parametrize("level", [0, 6])
@pytest.mark.parametrize("fault", ["cut", "checksum", "flipped"])
def test_broken_members_with_many_records(fault, level):
    whole = gzip.compress(b"".join(record(i, 3000) for i in range(100)), level)
    if fault == "cut":
        broken, lost = whole[:-9], {"<r99>"}
    elif fault == "checksum":
        broken, lost = whole[:-8] + bytes([whole[-8] ^ 1]) + whole[-7:], set()
    else:
        at = len(whole) // 2
        broken, lost = whole[:at] + bytes(b ^ 0xFF for b in whole[at : at + 30]) + whole[at + 30 :], None
    data = gzip.compress(record(200)) + broken + gzip.compress(record(201))
    found = list(warc.salvage(data))
    got = named(found)
    assert len(got) == len(set(got)) and {"<r200>", "<r201>"} <= set(got)
    every = {f"<r{i}>" for i in range(100)}
    assert every - set(got) <= lost if lost is not None else len(every & set(got)) >= 40
    gaps = [f for f in found if isinstance(f, warc.Gap)]
    assert any(g.offset == len(gzip.compress(record(200))) for g in gaps)


def test_gaps_are_rows(spark, tmp_path):
    path = tmp_path / "damaged"
    path.mkdir()
    (path / "a.warc").write_bytes(b"junk before" + record(1) + b"junk after")
    (path / "empty.warc").write_bytes(b"")
    rows = warc.read_archives(spark, str(path)).orderBy("offset").collect()
    assert [(r.record_id, r.offset, r.gap_bytes) for r in rows] == [(None, 0, 11), ("<r1>", 11, None), (None, 11 + len(record(1)), 10)]
    assert rows[0].gap_reason == "no version line"


def test_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_archives(spark, path).count() == 0


@pytest.mark.parametrize("form", ["hex", "HEX", "base32", "other"])
def test_digests_in_hexadecimal_and_base_32(form):
    import base64

    digest = hashlib.sha1(b"right").digest()
    text = {"hex": digest.hex(), "HEX": digest.hex().upper(), "base32": base64.b32encode(digest).decode(), "other": "1" * 32}[form]
    make = lambda body: (
        f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <r>\r\nWARC-Block-Digest: sha1:{text}\r\n"
        f"Content-Length: 5\r\n\r\n{body}\r\n\r\n"
    ).encode()
    found = list(warc.salvage(make("right") + make("wrong") + make("right")))
    gaps = [f for f in found if isinstance(f, warc.Gap)]
    # A digest in no known form is not looked at.
    assert (len(found), len(gaps)) == ((3, 0) if form == "other" else (3, 1))
    assert form == "other" or gaps[0].reason == "warc-block-digest differs"

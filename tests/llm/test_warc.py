import base64
import hashlib
import random

import pytest

from seqlab.llm import warc
from seqlab.llm.warc import Archive, compressed, record

PAGES = "page_id long, url string, html string, digest string, size int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES).repartition(3)


def test_pages(spark):
    long, other = "é" * 600, "b" * 1000
    rows = [(1, "u", long), (2, "u", long), (2, "v", long), (3, None, "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (None, "n", other), (None, "m", other), (8, "u", other), (9, "w", "a" * 999), (10, "w", "a" * 999), (11, "w", "z" * 500_000)]
    found = warc.archived_pages(pages(spark, rows)).collect()
    data = [(i, u, (h or "").encode()) for i, u, h in rows]
    assert sorted((repr(r["page_id"]), r["payload_bytes"], r["payload_digest"]) for r in found) == sorted((repr(i), len(h), hashlib.sha1(h).hexdigest()) for i, _, h in data)
    by = {}
    for r in found:
        by.setdefault(r["payload_digest"], []).append((r["page_id"], r["record_type"], r["refers_to"]))
    of = lambda text: sorted(by[hashlib.sha1(text.encode()).hexdigest()], key=repr)
    assert of(long) == [(1, "revisit", 2), (2, "response", None), (2, "revisit", 2)]
    assert of(other) == [(8, "response", None), (None, "revisit", 8), (None, "revisit", 8)]
    assert {k for _, k, _ in of("short") + of("") + of("a" * 999)} == {"response"}
    assert warc.archived_pages(pages(spark, [])).count() == 0


def test_line_breaks_in_urls(spark):
    rows = [(1, "u\r\n\r\nv", "one"), (2, "u\r\nWARC-Type: metadata", "two"), (3, "u\x00\x7f", "three")]
    assert sorted((r["page_id"], r["record_type"]) for r in warc.archived_pages(pages(spark, rows)).collect()) == [(i, "response") for i in (1, 2, 3)]
    read = warc.read_archives(warc.write_archives(pages(spark, rows))).collect()
    assert sorted(r["uri"] for r in read) == ["u%00%7F", "u%0D%0A%0D%0Av", "u%0D%0AWARC-Type: metadata"]


def test_missing_records_are_an_error(spark, monkeypatch):
    write = warc.write_archives
    monkeypatch.setattr(warc, "write_archives", lambda p, **given: write(p, **given).selectExpr("path", "bytes", "records + 1 AS records"))
    with pytest.raises(RuntimeError, match="read back"):
        warc.archived_pages(pages(spark, [(1, "u", "one"), (2, "u", "two")]))


def test_payloads_come_back(spark):
    rows = [(i, f"u{i}", f"<p>{'x' * i}</p>") for i in range(50)]
    for gzip in (True, False):
        read = warc.read_archives(warc.write_archives(pages(spark, rows), gzip=gzip), split=700).collect()
        assert sorted((r["id"], r["uri"], bytes(r["payload"]).decode()) for r in read) == sorted((f"urn:page:{i}", u, h) for i, u, h in rows)
        assert all(r["gap"] is None for r in read)


@pytest.mark.parametrize("gzip", [True, False])
@pytest.mark.parametrize("split", [1 << 40, 5000, 301])
def test_salvage(tmp_path, gzip, split):
    rng = random.Random(2)
    parts = []
    for i in range(60):
        body = rng.randbytes(rng.randrange(900)) + (b"\r\n\r\nWARC/1.1\r\n" if i == 7 else b"")
        data = record("response", f"urn:page:{i}", "u", hashlib.sha1(body).hexdigest(), len(body), body, None)
        parts.append(compressed(data) if gzip else data)
    starts = [sum(map(len, parts[:i])) for i in range(61)]
    data = bytearray(b"".join(parts))
    lost = {0, 5, 6, 20, 59}
    for i in lost - {59}:
        data[(starts[i] + starts[i + 1]) // 2] ^= 0x41
    data[starts[30] : starts[30]] = junk = b"junk" * 50 + b"\x1f\x8b\x08WARC/1."
    del data[-7:]
    path = tmp_path / ("a.warc.gz" if gzip else "a.warc")
    path.write_bytes(data)
    found = [r for at in range(0, len(data), split) for r in Archive(str(path)).records(at, at + split)]
    records, gaps = [r for r in found if "gap" not in r], [(r["start"], r["stop"]) for r in found if "gap" in r]
    assert sorted(r["id"] for r in records) == sorted(f"urn:page:{i}" for i in range(60) if i not in lost)
    after = lambda i: starts[i] + (len(junk) if i >= 30 else 0)
    want = [(0, starts[1]), (starts[5], starts[7]), (starts[20], starts[21]), (starts[30], after(30)), (after(59), len(data))]
    assert sorted(gaps) == want


@pytest.mark.parametrize("gzip", [True, False])
@pytest.mark.parametrize("split", [warc.SPLIT, 301])
def test_damaged_copies_are_quarantined(spark, gzip, split):
    rows = [(i, f"u{i}", f"<p>{'x' * (i * 7 % 50)}</p>") for i in range(60)] + [(100 + i, "w", "é" * 700) for i in range(9)]
    manifest = warc.write_archives(pages(spark, rows), gzip=gzip, spoil="page_id % 3 = 1 OR page_id IS NULL").collect()
    found = [r for m in manifest for at in range(0, m["bytes"], split) for r in Archive(m["path"]).records(at, at + split)]
    assert sorted(r["id"] for r in found if "gap" not in r) == sorted(f"urn:page:{i}" for i, _, _ in rows) and sum(m["records"] for m in manifest) == len(rows)
    before = {r["stop"] - r["start"] for r in found if "gap" in r}
    assert sum("gap" in r for r in found) == sum(i % 3 == 1 for i, _, _ in rows) and min(before) > 0


def test_a_changed_byte_leaves_no_sound_copy(tmp_path):
    parts = []
    for i in range(4000):  # in some of them the middle byte names another place with the same letters
        body = " ".join(random.Random(i).choices(["ab", "ac", "bc", "abc"], k=600)).encode()
        whole = compressed(record("response", f"urn:page:{i}", "u", hashlib.sha1(body).hexdigest(), len(body), body, None))
        parts += [warc.spoilt(whole, True), whole]
        assert sum(a != b for a, b in zip(*parts[-2:], strict=True)) == 1
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(parts))
    found = list(Archive(str(path)).records(0, 1 << 40))
    assert [r.get("id") for r in found] == [x for i in range(4000) for x in (None, f"urn:page:{i}")]


def test_pages_after_damaged_copies(spark):
    rows = [(i, f"u{i}", f"<p>{i}</p>") for i in range(40)] + [(100 + i, "w", "b" * 2000) for i in range(5)] + [(None, "n", None)]
    plain, salvaged = (warc.archived_pages(pages(spark, rows), *spoil).collect() for spoil in ((), ("page_id % 4 = 0",)))
    assert sorted(map(repr, (r[:5] for r in plain))) == sorted(map(repr, (r[:5] for r in salvaged)))
    assert not any(r["salvaged"] for r in plain)
    assert sorted(r["page_id"] for r in salvaged if r["salvaged"]) == [i for i, _, _ in rows if i is not None and i % 4 == 0]
    assert warc.archived_pages(pages(spark, []), "true").count() == 0


def test_empty_archive(tmp_path):
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"")
    assert list(Archive(str(path)).records(0, 100)) == []


def base32(kind, data):
    return f"{kind}:{base64.b32encode(hashlib.new(kind, data).digest()).decode().rstrip('=')}".encode()


def foreign(ident, payload, block_digest=None, payload_digest=None, http_length=None, names=str):
    """A record as other writers make it: digests as they are given, field names in any case, another HTTP length."""
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % (len(payload) if http_length is None else http_length) + payload
    fields = {"WARC-Type": b"response", "WARC-Record-ID": b"<%s>" % ident.encode(), "Content-Length": b"%d" % len(block)}
    fields |= {"WARC-Block-Digest": block_digest(block)} if block_digest else {}
    fields |= {"WARC-Payload-Digest": payload_digest(payload)} if payload_digest else {}
    return b"WARC/1.0\r\n" + b"".join(names(k).encode() + b": " + v + b"\r\n" for k, v in fields.items()) + b"\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize("gzip", [True, False])
def test_records_of_other_writers(tmp_path, gzip):
    sha = lambda d: base32("sha1", d)
    good = [
        foreign("a", b"one", sha, sha), foreign("b", b"two", lambda d: base32("sha256", d), names=str.lower), foreign("c", b"", None, lambda d: b"SHA1:" + hashlib.sha1(d).hexdigest().upper().encode(), names=str.upper),
        foreign("d", b"chunked", sha, lambda d: sha(b"another form"), http_length=99), foreign("e", b"x", lambda d: b"blake9:abc"), foreign("f", b"y", http_length=5),
    ]
    bad = [foreign("g", b"z", lambda d: sha(d + b"!")), foreign("h", b"z", None, lambda d: sha(d + b"!"))]
    path = tmp_path / ("a.warc.gz" if gzip else "a.warc")
    path.write_bytes(b"".join(map(compressed if gzip else bytes, good + bad)))
    found = list(Archive(str(path)).records(0, 1 << 40))
    records = [r for r in found if "gap" not in r]
    assert [r["id"] for r in records] == list("abcdef") and records[0]["digest"] == hashlib.sha1(b"one").hexdigest()
    assert records[2]["digest"] == hashlib.sha1(b"").hexdigest()
    assert [r["gap"] for r in found if "gap" in r][0] == "wrong block digest"


@pytest.mark.parametrize("split", [1 << 40, 64])
def test_several_records_in_a_member(tmp_path, split):
    make = lambda i: foreign(i, i.encode() * 20, lambda d: base32("sha1", d))
    broken = make("x").replace(b"xxx", b"yyy", 1)
    members = [make("a") + make("b"), make("c") + broken + make("d"), broken + make("e"), broken, make("f")]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(data := b"".join(map(compressed, members)))
    found = [r for at in range(0, len(data), split) for r in Archive(str(path)).records(at, at + split)]
    assert [r.get("id", r.get("gap")) for r in found] == ["a", "b", "c", "wrong block digest", "d", "wrong block digest", "e", "wrong block digest", "f"]

"""ARC parsing, conversion and the round trip through WARC files."""

import base64
import gzip
import hashlib

import pytest

from quarry.llm import warc


def _sha(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def test_page_identifiers_round_trip():
    for x in (0, 1, -1, 2 ** 63 - 1, -2 ** 63, 2 ** 62, 12345):
        assert warc.uuid_page(warc.page_uuid(x)) == x
    assert warc.uuid_page("6ba7b811-9dad-11d1-80b4-00c04fd430c8") is None


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_arc_versions(version, pack):
    pages = [(1, "http://a/ b\n", b"x\r\n\r\ny"), (None, None, b""), (3, "http://c/", "é".encode() * 999)]
    got = list(warc.read_arc(pack(warc.arc_file("t.arc", version, pages))))
    assert [f["URL"] for f, _ in got] == ["http://a/%20b%0A", "-", "http://c/"]
    assert [warc._split_http(b)[1] for _, b in got] == [p[2] for p in pages]
    assert ("Checksum" in got[0][0]) == (version == 2)


def test_malformed_archives_raise():
    good = warc.arc_file("t.arc", 1, [(1, "http://a/", b"body")])
    for bad in (b"", b"junk\n", good[:-8], good.replace(b"\n1 0 ", b"\n7 0 "), good.replace(b" text/html ", b" ")):
        with pytest.raises(ValueError):
            list(warc.read_arc(bad))


def _want(rows, least=0):
    bodies = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, b in bodies:
        same = [j for j, c in bodies if c == b and j is not None]
        first = max(same) if len(b) >= least and same and sum(c == b for _, c in bodies) > 1 else i
        again = first != i
        out.append((i if i is not None else -1, len(b), _sha(b), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (9, None, "<p>x</p>"), (3, "u", None), (4, "u", ""),
        (5, "http://é/", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"), (6, "http://c/", "z" * 300_000), (None, "http://n/", "only"),
        (7, "http://d/", "twice"), (7, "http://d/", "twice"), (-8, "http://d/", "HTTP/1.1 200 OK\r\n\r\nbody")]


@pytest.mark.parametrize("least", [0, 6])
def test_round_trip(spark, tmp_path, least):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr(
        "*", "1 AS payload", "2 AS record_type", "3 AS response")
    got = warc.pages_to_warc(pages, str(tmp_path / "w"), least)
    assert sorted(((r.page_id if r.page_id is not None else -1, r.payload_bytes, r.payload_digest, r.record_type,
                    r.refers_to) for r in got.collect()), key=str) == _want(ROWS, least)
    # the files are WARC: every record parses, revisits carry no payload
    kinds = []
    for f in (tmp_path / "w").glob("*.gz"):
        with gzip.open(f, "rb") as stream:
            for fields, block in warc.read_warc_stream(stream):
                kinds.append(fields["warc-type"])
                assert fields["warc-date"] == "2000-01-01T00:00:00Z"
                assert fields["warc-block-digest"] == "sha1:" + _sha(block)
    assert kinds.count("response") == sum(w[3] == "response" for w in _want(ROWS, least))


def test_join_path_equals_broadcast_path(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", -1)
    got = warc.pages_to_warc(pages, str(tmp_path / "w"))
    assert sorted(((r.page_id if r.page_id is not None else -1, r.payload_bytes, r.payload_digest, r.record_type,
                    r.refers_to) for r in got.collect()), key=str) == _want(ROWS)


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.pages_to_warc(pages, str(tmp_path / "w")).count() == 0

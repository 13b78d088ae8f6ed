import struct

import pytest
import zstandard

from cairn.llm import warc as x

SCHEMA = "page_id long, url string, html string, payload int, same string, error string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", "e") for r in rows], SCHEMA).repartition(3)


def test_round_trip(spark):
    big = "<p>" + "é" * 600
    rows = [(1, "http://a/b", big), (5, None, big), (9, "u", big), (9, "u", big), (2, "with space\r\nand break", "small"), (3, "u", "small"), (4, "u", None), (6, "u", ""), (7, "u", big + "x"),
            (None, "u", big), (8, "u", "x" * 3_000_000), (10, "u", "\r\n\r\nWARC/1.1\r\n" * 200)]
    import hashlib

    out = x.round_trip(spark, pages(spark, rows)).collect()
    expected = []
    for i, _, h in rows:
        p = (h or "").encode()
        again = len(p) >= 1000 and p == big.encode() and i != 9
        expected.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", 9 if again else None))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert {r["error"] for r in out} == {None}


def test_empty_table(spark):
    assert x.round_trip(spark, pages(spark, [])).collect() == []


def records(n, start=0):
    return [x.build_record(start + i, f"http://x/{i}", b"<html>page %d of many</html>" % i * 20, __import__("hashlib").sha1(b"<html>page %d of many</html>" % i * 20).hexdigest(), "response", None) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 5, 400])
def test_archive_with_and_without_dictionary(n):
    made = records(n)
    data = x.build_archive(made)
    assert (data[:4] == struct.pack("<I", x.DICTIONARY_FRAME)) == (n == 400)
    assert list(x.split_archive(data)) == made
    if n == 400:  # the frames need the dictionary
        with pytest.raises(zstandard.ZstdError):
            list(x.split_archive(data[8 + struct.unpack_from("<I", data, 4)[0] :]))


def test_bare_dictionary_is_read():
    made = records(300)
    dictionary = zstandard.train_dictionary(4096, made)
    body = dictionary.as_bytes()
    pack = zstandard.ZstdCompressor(dict_data=dictionary)
    data = struct.pack("<II", x.DICTIONARY_FRAME, len(body)) + body + b"".join(map(pack.compress, made))
    assert list(x.split_archive(data)) == made


@pytest.mark.parametrize("change, why", [
    (lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"), "version"),
    (lambda r: r.replace(b"Content-Length: ", b"Content-Length: 1", 1), "bytes long"),
    (lambda r: r[:-1], "bytes long"),
    (lambda r: r.replace(b"page 0", b"page 1", 1), "digest"),
    (lambda r: r.replace(b"WARC-Date", b"WARC-Late"), "warc-date"),
    (lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: other"), "type"),
    (lambda r: r.replace(b"WARC-Type: response", b"WARC-Type response"), "not a field"),
])
def test_damaged_records_are_told(change, why):
    with pytest.raises(ValueError, match=why):
        x.parse_record(change(records(1)[0]))


def test_reader_reports_or_stops(spark, tmp_path):
    good, bad = records(2)
    pack = zstandard.ZstdCompressor()
    (tmp_path / "a.warc.zst").write_bytes(pack.compress(good) + pack.compress(bad[:-4]) + pack.compress(good)[:-5])
    rows = x.read_archives(spark, str(tmp_path)).collect()
    assert [r["error"] is None for r in rows] == [True, False, False] and rows[0]["page_id"] == 0
    with pytest.raises(Exception, match="bytes long"):
        x.read_archives(spark, str(tmp_path), strict=True).collect()

import gzip
import hashlib
import zlib

import pytest

from chronolake.llm import warc


def rows():
    big, other = "<p>é" * 400, "\r\n\r\nWARC/1.1\r\n\n" * 100
    out = [(i, f"http://h/{i}", f"<html>{i}" + "x" * (i * 13)) for i in range(60)]
    out += [(100, "http://a b/\n", big), (101, None, big), (90, "u", big), (102, "u", other), (103, "u", other), (104, "u", "short"), (105, "u", "short"), (106, "u", None), (107, "u", "")]
    return out + [(101, "again", big), (None, "n", big), (None, "n", "x" * 2000), (None, "m", "x" * 2000)]


def expected(given):
    out, groups = [], {}
    for p, _, h in given:
        b = (h or "").encode()
        groups.setdefault(b, []).append(p)
    for b, ids in groups.items():
        d = hashlib.sha1(b).hexdigest()
        ids = sorted(ids, key=lambda x: (x is not None, x))
        for k, p in enumerate(ids):
            again = len(b) >= 1000 and k < len(ids) - 1
            out.append((p, len(b), d, "revisit" if again else "response", ids[-1] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("version", [1, 2])
def test_round_trip(spark, version):
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string").selectExpr("*", "1 AS path", "2 AS at")
    path = warc.archive(pages, version, 1500)
    files = [bytes(r.content) for r in warc._files(spark, path).collect()]
    assert len(files) > 4 and all(len(gzip.decompress(f)) > 0 for f in files)  # any gzip reader takes them
    members = sum(1 for f in files for _ in warc.warc_records(f))
    assert members == len(rows()) + len(files)  # a warcinfo each
    got = warc.read(spark, path, with_payload=True).collect()
    by = {r.id: r.page_id for r in got}
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.type, by.get(r.refers_to_id)) for r in got), key=str) == expected(rows())
    texts = {(p, (h or "").encode()) for p, _, h in rows()}
    assert all((r.page_id, bytes(r.payload)) in texts for r in got if r.type == "response")
    assert {r.url for r in got if r.page_id in (100, 106)} == {"http://a%20b/%0A", "u"} and {r.date for r in got} == {"2024-01-01T00:00:00Z"}


def test_slices(spark, tmp_path, monkeypatch):
    """Files converted in many slices give the same records; no slice shuffles or sorts contents."""
    assert list(warc.slices([("a", 3), ("b", 9), ("c", 1), ("d", 1), ("e", 0)], 2, 5)) == [["a"], ["b"], ["c", "d"], ["e"]] and not list(warc.slices([], 2, 5))
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string")
    warc.write_arc(pages, f"{tmp_path}/arc", 1, 1500)
    plans, made = [], warc._slice
    monkeypatch.setattr(warc, "_slice", lambda *a: plans.append(made(*a)) or plans[-1])
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        warc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/whole")
        warc.convert(spark, f"{tmp_path}/arc", f"{tmp_path}/cut", most_files=2, most_again=1)
        assert len(plans) > 3
        for df in plans:
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    read = lambda name: sorted(map(tuple, warc.read(spark, f"{tmp_path}/{name}", with_payload=True).collect()), key=str)
    assert len(read("whole")) == len(rows()) and read("whole") == read("cut")


def test_query_and_empty(spark, tmp_path):
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string")
    for name, p in (("a", pages), ("b", pages.limit(0))):
        p.write.parquet(f"{tmp_path}/{name}/pages.parquet")
        got = warc.op9_warc(spark, f"{tmp_path}/{name}").collect()
        assert sorted(map(tuple, got), key=str) == expected(rows() if name == "a" else [])


def test_broken_archives():
    block = warc._version_block(1, "x")
    with pytest.raises(ValueError, match="declared"):
        list(warc.arc_records(block + b"\nhttp://a 0.0.0.0 20240101000000 text/html 99\nshort"))
    with pytest.raises(ValueError, match="fields"):
        list(warc.arc_records(block + b"\nhttp://a text/html 5\nshort"))
    two = warc._version_block(2, "x") + b"\nhttp://a 0.0.0.0 20240101000000 text/html 200 c - 1 f 5\nshort\n"
    assert [(f["Result-code"], b) for _, f, b in warc.arc_records(two)] == [("200", b"short")]


@pytest.mark.parametrize("packed", [lambda b: b, gzip.compress, lambda b: gzip.compress(b[:70]) + gzip.compress(b[70:]) + b"\0\0"])
def test_any_packing(packed):
    """One member, many, or none; records are read one by one, long ones too."""
    body = b"HTTP/1.1 200 OK\r\n\r\n" + bytes(range(256)) * 3000
    arc = warc._version_block(1, "x") + b"\n" + b"".join(b"http://a/%d 0.0.0.0 20240101000000 text/html %d\n%s\n" % (i, len(body), body) for i in range(3))
    got = list(warc.arc_records(packed(arc)))
    assert [(f["URL"], b == body) for _, f, b in got] == [(f"http://a/{i}", True) for i in range(3)]
    assert all(arc[at:].startswith(b"http://a/") for at, *_ in got)
    with pytest.raises((ValueError, zlib.error)):
        list(warc.arc_records((packed := gzip.compress(arc))[: len(packed) // 2]))

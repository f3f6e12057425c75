import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringEndsWith, StringStartsWith

from chronolake.operators import contents_state, quality
from chronolake.sources import archive, files, growth
from chronolake.sources.store import Store


@pytest.fixture
def tree(tmp_path):
    for p, t in {"p/1.0/R/a.R": "x\n\n", "p/1.0/DESCRIPTION": "D: 1", "p/1.0/LICENSE": "", "p/1.0/.github/workflows/ci.yml": "on: push", "p/1.1/_pkgdown.yml": "", "q/0.1/big.bin": "z" * 9_000_000, "q/0.1/sub/b.txt": "b", "q/readme": "of no version", "top": "no"}.items():
        f = tmp_path / "in" / p
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(t)
    (tmp_path / "in" / "empty" / "1").mkdir(parents=True)
    return f"{tmp_path}/in"


def test_files(spark, tree):
    """All of them, empty and hidden ones, each with its bytes; filters and names."""
    df = files.files(spark, tree)
    got = {(r.package, r.version, r.path): bytes(r.content_bytes) for r in df.collect()}
    assert set(got) == {("p", "1.0", "R/a.R"), ("p", "1.0", "DESCRIPTION"), ("p", "1.0", "LICENSE"), ("p", "1.0", ".github/workflows/ci.yml"), ("p", "1.1", "_pkgdown.yml"), ("q", "0.1", "big.bin"), ("q", "0.1", "sub/b.txt")}
    assert got["p", "1.0", "LICENSE"] == b"" and len(got["q", "0.1", "big.bin"]) == 9_000_000
    path = lambda d: sorted(r.path for r in d.collect())
    assert path(df.filter("package = 'p' and path like '%.R'")) == ["R/a.R"] and path(df.filter("version in ('1.1', '0.1') and size < 10")) == ["_pkgdown.yml", "sub/b.txt"]
    assert path(files.files(spark, tree, r"(?i)^license$|\.yml$")) == [".github/workflows/ci.yml", "LICENSE", "_pkgdown.yml"]
    assert {r.content_bytes for r in files.files(spark, tree, content=False).collect()} == {None}
    assert {(r.path, r.content) for r in archive.corpus(spark, tree, "^(LICENSE|R/)").collect()} == {("LICENSE", ""), ("R/a.R", "x\n")}


def test_files_opened(tree, monkeypatch):
    """What isn't asked for isn't opened, and what is, once."""
    opened = []
    monkeypatch.setattr(files.ArchiveReader, "content", lambda self, fs, info: opened.append(os.path.relpath(info.path, tree)) or b"")
    for filters, find, want in (([EqualTo(("package",), "p"), StringEndsWith(("path",), ".R")], "", ["p/1.0/R/a.R"]), ([In(("version",), ("1.1",))], "", ["p/1.1/_pkgdown.yml"]), ([StringStartsWith(("path",), "sub/")], "", ["q/0.1/sub/b.txt"]), ([], "^D", ["p/1.0/DESCRIPTION"]), ([EqualTo(("package",), None)], "", [])):
        opened.clear()
        reader = files.ArchiveReader({"path": tree, "find": find})
        left = list(reader.pushFilters([*filters, GreaterThan(("size",), 1)]))
        assert [type(f) for f in left] == [GreaterThan]
        for part in reader.partitions():
            list(reader.read(part))
        assert sorted(opened) == want


def test_growth(spark, tmp_path):
    """Integers, then text, then flags and reals; declared types; nested values."""
    path = f"{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        growth.read(spark, path)
    growth.append(spark.createDataFrame([("a", 1, True, 2)], "package string, x int, f boolean, only bigint"), path, buckets=2)
    growth.append(spark.createDataFrame([("a", 2**40, None, 1.5)], "package string, x bigint, f boolean, y float"), path, buckets=2)
    assert dict(growth.read(spark, path).dtypes) == {"package": "string", "x": "bigint", "f": "boolean", "only": "bigint", "y": "double"}
    growth.append(spark.createDataFrame([("b", "text", 3, [1, 2])], "package string, x string, f int, y array<int>"), path, buckets=2)
    growth.append(spark.createDataFrame([("c", "text2", 3.25, [1, 2])], "package string, x string, f double, y array<int>"), path, buckets=2)
    got = growth.read(spark, path)
    assert dict(got.dtypes) == {"package": "string", "x": "string", "f": "double", "only": "bigint", "y": "string"}
    rows = sorted((tuple(r) for r in got.select("package", "x", "f", "only", "y").collect()), key=str)
    assert rows == sorted([("a", "1", 1.0, 2, None), ("a", str(2**40), None, None, "1.5"), ("b", "text", 3.0, None, "[1,2]"), ("c", "text2", 3.25, None, "[1,2]")], key=str)
    own = growth.read(spark, path, {"x": "bigint", "z": "double"})
    assert dict(own.dtypes)["z"] == "double" and sorted((r.x or 0) for r in own.collect()) == [0, 0, 1, 2**40]
    df = growth.with_declared(spark.createDataFrame([("7", "x", 1)], "nrow string, ncol string, other int"), {c: contents_state.CONTENT[c] for c in ("nrow", "ncol", "density")})
    assert tuple(df.first()) == (7, None, None, 1) and dict(df.dtypes)["density"] == "double"


def test_store(spark, tmp_path):
    """Ordered writes are seen whole or not at all, are redone by id, and leave other buckets as they are."""
    store = Store(spark, f"{tmp_path}/s", {"rows": "package", "marks": "package"}, 4)
    rows = lambda *r: spark.createDataFrame(list(r), "package string, x long")
    seen = lambda t: sorted(map(tuple, store.read(t).collect())) if store.read(t) is not None else None
    assert seen("rows") is None and store.upsert("1", [("rows", rows(*((f"p{i}", i) for i in range(20)))), ("marks", rows(("p1", 1)))])
    before, folders = seen("rows"), set(store.current())

    def fails():
        raise InterruptedError

    for _ in range(2):
        with pytest.raises(InterruptedError):
            store.upsert("2", [("rows", rows(("p3", 333), ("p3", 334))), ("marks", rows(("p3", 3)))], before_marker=fails)
        assert seen("rows") == before and seen("marks") == [("p1", 1)] and not store.has("2")
    assert store.upsert("2", [("rows", rows(("p3", 333), ("p3", 334))), ("marks", rows(("p3", 3)))])
    assert seen("rows") == sorted([r for r in before if r[0] != "p3"] + [("p3", 333), ("p3", 334)]) and seen("marks") == [("p1", 1), ("p3", 3)]
    assert len(set(store.current()) & folders) >= 3  # three of four buckets of rows are the old ones
    assert not store.upsert("2", [("rows", rows(("p4", 0)))]) and store.vacuum()
    again = Store(spark, f"{tmp_path}/s", {"rows": "package", "marks": "package"}, 4)
    assert sorted(map(tuple, again.read("rows").collect())) == seen("rows")
    assert store.upsert("3", [("rows", rows(("new", 1)))], wiped=["rows", "marks"]) and seen("rows") == [("new", 1)] and seen("marks") is None
    assert store.commit("4", [], wiped=["rows"]) and seen("rows") is None


def test_contents_over_batches(spark, tmp_path):
    """The row that is there wins; equal contents of several packages stay until the last link goes; generations part."""
    schema = "package string, name string, version string, seq long, content_fp string, schema_fp string, fp_algo_version int, internal boolean, is_current boolean, nrow long, notes string, row_sketch string"
    rec = lambda p, n, fp, seq, algo=1, rows=1, sketch=None: (p, n, "1", seq, fp, None, algo, False, True, rows, f"{p}/{n}", sketch)
    keys, columns = ["package", "name", "version"], ["nrow", "notes"]
    store = contents_state.open_state(spark, f"{tmp_path}/c", 4)
    take = lambda b, *r: contents_state.ingest(store, b, spark.createDataFrame(list(r), schema), keys, columns, "row_sketch")
    held = lambda: sorted((r.content_fp, r.fp_algo_version, r.nrow) for r in store.read("contents").collect())
    assert take("1", rec("a", "x", "F", 1, rows=10), rec("a", "y", "G", 2), rec("b", "z", "F", 3, rows=99, sketch="s"))
    assert held() == [("F", 1, 10), ("G", 1, 1)] and store.read("sketches").count() == 1
    assert not take("1", rec("a", "x", "H", 1)) and contents_state.collect(store, "gc1") == 0
    assert take("2", rec("c", "w", "F", 9, rows=77), rec("a", "x", "K", 8)) and held() == [("F", 1, 10), ("G", 1, 1), ("K", 1, 1)]
    assert sorted((r.package, r.name) for r in store.read("links").collect()) == [("a", "x"), ("b", "z"), ("c", "w")]
    assert contents_state.collect(store, "gc2") == 1 and held() == [("F", 1, 10), ("K", 1, 1)]
    assert take("3", rec("b", "z", "F", 12, algo=2, rows=5), rec("c", "w", "F", 13, algo=2)) and held() == [("F", 1, 10), ("F", 2, 5), ("K", 1, 1)]
    assert contents_state.collect(store, "gc3") == 1 and held() == [("F", 2, 5), ("K", 1, 1)] and store.read("sketches") is None or store.read("sketches").count() == 0


def test_distinct_sketches(spark):
    df = spark.range(60_000).select((F.col("id") % 25_000).alias("k"))
    stored = quality.distinct_sketches(df, "k", 8)
    n = quality.distinct_estimate(stored).first()
    assert n.n_rows == 60_000 and abs(n.n_distinct - 25_000) < 500
    more = df.unionByName(spark.range(25_000, 40_000).select(F.col("id").alias("k")))
    own = more.filter(F.pmod(F.xxhash64(F.col("k").cast("string")), F.lit(8)) == 3)
    n = quality.distinct_estimate(quality.refreshed_sketches(stored, own, "k", [3], 8)).first()
    assert n.n_rows == 60_000 + own.count() - df.filter(F.pmod(F.xxhash64(F.col("k").cast("string")), F.lit(8)) == 3).count() and abs(n.n_distinct - 25_000 - 15_000 / 8) < 700
    assert tuple(quality.distinct_estimate(quality.distinct_sketches(df.limit(0), "k")).first()) == (0, 0)

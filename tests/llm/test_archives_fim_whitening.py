"""Operators 11 to 13 against brute force and round trips, with awkward rows."""

import glob
import gzip
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from harmonia.llm import feast, fim, warc, whitening


# 11 ----------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, payload int, digest int, archive string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "a") for r in rows], PAGES)


@pytest.fixture(scope="module")
def some_pages():
    rng = random.Random(4)
    big = "<html>" + "é" * 90
    rows = [(1, "http://a\r\nb", big), (2, None, big), (3, "u", None), (4, "u", ""), (6, "u", "short"), (7, "u", "short"),
            (None, "n", big), (1, "again", big), (None, "m", "no id " * 40), (None, "m", "no id " * 40),
            (5, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 30), (10, "z", "\r\n\r" * 100), (11, "z", "x" * 99),
            (12, "z", "x" * 99), (13, "z", "y" * 100), (14, "z", "y" * 100), (15, "long", "many words " * 200_000)]
    return rows + [(100 + i, f"u{i}", "".join(rng.choice("\r\n\r\nabé") for _ in range(rng.randrange(300)))) for i in range(300)]


@pytest.fixture(scope="module")
def archived(spark, some_pages, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warc"))
    warc.write_monolithic(warc.plan_records(pages_of(spark, some_pages).repartition(3)), f"{root}/streams")
    warc.normalise(spark, f"{root}/streams", f"{root}/records")
    return root


def test_archives_round_trip(spark, some_pages, archived):
    got = warc.read_records(spark, f"{archived}/records")
    got = got.withColumns({"page": warc.page_of(F.col("record_id"), "long"), "ref": warc.page_of(F.col("refers_to"), "long")})
    first = {}
    for p, _, h in some_pages:
        h = (h or "").encode()
        if len(h) >= 100 and p is not None:
            first[h] = min(p, first.get(h, p))

    def expected(p, u, h):
        h = (h or "").encode()
        f = first.get(h)
        u = u and u.replace("\r", "%0D").replace("\n", "%0A")
        again = f is not None and f != p
        return p, u, len(h), hashlib.sha256(h).hexdigest(), "revisit" if again else "response", f if again else None, None if again else h

    def key(t):
        return tuple((x is None, str(x)) for x in t)

    rows = [(r.page, r.target_uri, r.payload_bytes, r.payload_digest, r.record_type, r.ref,
             None if r.payload is None else bytes(r.payload)) for r in got.collect()]
    assert sorted(rows, key=key) == sorted([expected(*p) for p in some_pages], key=key)


def test_every_record_is_a_member_where_the_index_says(spark, archived):
    streams = glob.glob(f"{archived}/streams/*.gz")
    assert all(open(f, "rb").read(4)[:2] == b"\x1f\x8b" for f in streams)
    n = 0
    for a in glob.glob(f"{archived}/records/archives/archive=*"):
        (file,) = glob.glob(f"{a}/part-*")
        data = open(file, "rb").read()
        index = spark.read.parquet(a.replace("/archives/", "/index/")).orderBy("offset").collect()
        whole = gzip.decompress(data)  # the archive is one gzip file still
        parts = [gzip.decompress(data[r.offset:r.offset + r.length]) for r in index]
        assert b"".join(parts) == whole and all(p.startswith(b"WARC/1.1\r\n") for p in parts)
        assert [r.seq for r in index] == list(range(len(index)))
        assert index[-1].offset + index[-1].length + len(warc.REST) == len(data)
        n += len(index)
    assert sum(gzip.open(f).read().count(b"WARC-Record-ID: ") for f in streams) == n


def test_single_records_by_index(spark, archived):
    index = warc.read_index(spark, f"{archived}/records")
    got = warc.read_records(spark, f"{archived}/records", index.filter("record_id = '<urn:page:10>'")).collect()
    assert [bytes(r.payload) for r in got] == [b"\r\n\r" * 100]


def test_archives_roll_over_and_survive_any_piece_size(monkeypatch):
    records = [b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(b), b)
               for b in (b"", b"\r\n\r\n", b"abc" * 50, b"\r\n\r\nWARC/1.1\r\n")]
    stream = b"".join(records) * 3
    for size in (1, 2, 3, 7, 64, 10_000):
        cutter = warc.RecordStream()
        got = [r for i in range(0, len(stream), size) for r in cutter.feed(stream[i:i + size])]
        assert got == records * 3 and cutter.rest() == b""


def test_long_streams_go_on_in_further_archives(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 4)
    pieces = [b"WARC/1.1\r\nWARC-Record-ID: <%d>\r\nContent-Length: 1" % (i // 2) if i % 2 == 0 else b"x" for i in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array(pieces), pa.array(["s3://b/One.warc.gz"] * 20)], names=["piece", "file"])
    out = pa.Table.from_batches(warc._members(iter([batch])))
    assert out.column("record_id").to_pylist() == [f"<{i}>" for i in range(10)]
    assert out.column("seq").to_pylist() == [0, 1, 2, 3, 0, 1, 2, 3, 0, 1]
    assert len(set(out.column("archive").to_pylist())) == 3


def test_short_streams_of_a_task_share_archives(spark, tmp_path):
    import pyarrow as pa
    record = b"WARC/1.1\r\nWARC-Record-ID: <%d>\r\nContent-Length: 1"
    pieces = [p for i in range(30) for p in (record % i, b"x")]
    files = [f"s3://b/{i // 6}.warc.gz" for i in range(60)]  # ten streams of three records
    batch = pa.RecordBatch.from_arrays([pa.array(pieces), pa.array(files)], names=["piece", "file"])
    out = pa.Table.from_batches(warc._members(iter([batch.slice(0, 25), batch.slice(25)]))).to_pylist()
    assert [x["record_id"] for x in out] == [f"<{i}>" for i in range(30)]
    assert {x["archive"] for x in out} == {out[0]["archive"]} and [x["seq"] for x in out] == list(range(30))
    ends = [x["offset"] + x["length"] + len(warc.REST) for x in out]
    assert [x["offset"] for x in out] == [0, *ends[:-1]]


def test_what_is_no_record_is_kept_as_malformed(spark, tmp_path):
    good = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    (tmp_path / "in").mkdir()
    for name, data in (("a", b"junk\r\n\r\n" + good), ("b", good + b"WARC/1.1\r\nContent-Length: 99\r\n\r\ncut short"), ("c", b"")):
        (tmp_path / "in" / f"{name}.warc.gz").write_bytes(gzip.compress(data))
    warc.normalise(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    got = warc.read_records(spark, str(tmp_path / "out")).collect()
    assert sorted(r.record_type for r in got) == ["malformed", "malformed", "response", "response"]
    assert any(b"cut short" in bytes(r.payload) for r in got)


def test_archives_of_no_pages_and_of_bytes(spark, tmp_path):
    raw = bytes(range(256)) * 2
    df = spark.createDataFrame([("x>y", "u", raw), ("a b", "u", raw)], "page_id string, url string, html binary")
    for i, (rows, n) in enumerate(((df, 2), (df.limit(0), 0))):
        warc.write_monolithic(warc.plan_records(rows), f"{tmp_path}/s{i}")
        warc.normalise(spark, f"{tmp_path}/s{i}", f"{tmp_path}/r{i}")
        got = warc.read_records(spark, f"{tmp_path}/r{i}").withColumn("id", warc.page_of(F.col("record_id"), "string")).collect()
        assert len(got) == n
        if n:
            assert sorted((r.id, r.record_type, r.payload and bytes(r.payload)) for r in got) == [
                ("a b", "response", raw), ("x>y", "revisit", None)]


# 12 ----------------------------------------------------------------------------------------

def fim_by_hand(doc_id, text, unit=r"[^\n]*\n|[^\n]+"):
    text = text or ""
    units = re.findall(unit, text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


FIM_DOCS = "doc_id long, text string, n int, output int, _cuts string"


def test_fim_equals_brute_force_and_restores(spark):
    rng = random.Random(2)
    texts = [None, "", "\n", "a", "a\n", "a\nb", "\n\n\nx", "é\n日本\n😀", "<P>x\ny", "<P\n<S", "$1\n\\2\n", "line\n" * 40_000,
             "no line feed " * 20_000, "a\r\nb\x0bc d\x85e\n"]
    texts += ["".join(rng.choice("ab\n é😀<PSM>") for _ in range(rng.randrange(200))) for _ in range(300)]
    rows = [(i, t, 1, 2, "c") for i, t in enumerate(texts)] + [(None, "q\nr", 1, 2, "c"), (5, "q\nr", 1, 2, "c"), (5, "q\nr", 1, 2, "c")]
    got = fim.restore(fim.fill_in_middle(spark.createDataFrame(rows, FIM_DOCS))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == fim_by_hand(r.doc_id, r.text)
        assert r.restored == (r.text or "") and r._cuts == "c"


def test_fim_of_no_rows_and_other_settings(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], FIM_DOCS)).count() == 0
    df = spark.createDataFrame([(i, f"One {i}. Two! Three words here") for i in range(40)], "doc_id long, text string")
    got = fim.restore(fim.fill_in_middle(df, unit="word", sentinels=("[p]", "[s]", "[m]"), spm_rate=0),
                      sentinels=("[p]", "[s]", "[m]")).collect()
    assert {r.form for r in got} == {"psm"} and all(r.restored == r.text for r in got)
    assert all(r.n == len(re.findall(r"[^ \n]*[ \n]|[^ \n]+", r.text)) for r in got)
    assert {r.form for r in fim.fill_in_middle(df, fim_rate=0).collect()} == {"plain"}
    with pytest.raises(ValueError):
        fim.fill_in_middle(df, sentinels=("<P>", "<P<", "<M>"))


def test_wavelet_matrix_ranks_and_cuts():
    rng = np.random.default_rng(3)
    for n in (0, 1, 63, 64, 65, 1000):
        codes = rng.integers(0, 8, n).astype(np.uint8)
        m = fim.WaveletMatrix(codes)
        start = rng.integers(0, n + 1, 50)
        stop = np.maximum(start, rng.integers(0, n + 1, 50))
        for c in range(8):
            assert m.rank(c, start, stop).tolist() == [int((codes[a:b] == c).sum()) for a, b in zip(start, stop)]
    texts = ["", "a. b\n", "x", "\n", "Hi. You! 1\n2"] * 3
    for limit in (1, 5, 100):  # texts share a matrix or not, the cuts are the same
        n, a, b = fim.two_cuts(texts, np.arange(15), np.arange(15) * 7, fim.UNIT_ENDS["sentence"], limit)
        for i, t in enumerate(texts):
            units = re.findall(r"[^\n.!]*[\n.!]|[^\n.!]+", t)
            x, y = sorted((i % (len(units) + 1), 7 * i % (len(units) + 1)))
            assert (n[i], a[i], b[i]) == (len(units), len("".join(units[:x])), len("".join(units[:y])))


# 13 ----------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, whitened string, _x int, deviation int"


def whitened_by_hand(rows, k=16):
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in kept]
    fit = np.array(sorted(set(map(tuple, x))), object)
    n, s = len(fit), fit.sum(axis=0)
    c = np.array([[float((n * a - b)) / n for a, b in zip(row, s)] for row in fit])
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = np.array([[float(n * a - b) / n for a, b in zip(row, s)] for row in x]) @ u / np.sqrt(e)
    return [i for i, _ in kept], n, [sum((n * a - b) ** 2 for a, b in zip(row, s)) for row in x], out, e / np.trace(c.T @ c / n)


def test_whitening_equals_direct_eigenvectors(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(c) for c in rng.standard_normal(20) * np.linspace(0.3, 2, 20)]) for i in range(400)]
    rows += [(400 + i, rows[3][1]) for i in range(50)] + [(3, rows[3][1]), (None, rows[5][1])]  # copies count once in the fit
    odd = [(900, None), (901, []), (902, [None] * 20), (903, [float("nan")] * 20), (904, [float("inf")] * 20), (905, [1.0] * 7)]
    df = spark.createDataFrame([(*r, "w", 1, 2) for r in rows + odd], VECTORS)
    model = whitening.fit(df)
    got = whitening.whiten(df, model).collect()
    ids, n, deviation, want, explained = whitened_by_hand(rows)
    assert model.n == n == 400 and model.identity_error < 1e-10
    assert sorted((r.vec_id is None, r.vec_id, r.deviation) for r in got) == sorted((i is None, i, d) for i, d in zip(ids, deviation))
    assert np.allclose(model.explained, explained, rtol=1e-9)
    by_id = {i: w for i, w in zip(ids, want)}
    mine, theirs = (np.array(x) for x in zip(*[(r.whitened, by_id[r.vec_id]) for r in got]))
    sign = np.sign((mine * theirs).sum(axis=0))
    assert np.abs(mine * sign - theirs).max() < 1e-8
    long = whitening.component_rows(whitening.whiten(df, model), model)
    assert long.count() == 16 * len(rows) and long.filter("component not between 1 and 16").count() == 0


def test_whitening_of_few_and_flat_vectors(spark):
    def run(vectors):
        df = spark.createDataFrame([(i, v, "w", 1, 2) for i, v in enumerate(vectors)], VECTORS)
        model = whitening.fit(df)
        return model, whitening.component_rows(whitening.whiten(df, model), model).collect()

    assert run([])[1] == [] and run([None, []])[1] == []
    model, got = run([[1.0, 2.0]] * 3)
    assert model.n == 1 and got == []  # no variance, no component
    model, got = run([[1.0, 2.0], [2.0, 2.0], [4.0, 2.0]])
    assert len(model.values) == 1 and sorted(round(r.whitened, 6) for r in got) in (
        [-1.069045, -0.267261, 1.336306], [-1.336306, 0.267261, 1.069045])
    model, got = run([[1e30, 1.0], [-1e30, 2.0], [0.0, 3.0]])
    assert len(got) and got[0].deviation is None


def test_exact_deviation_beyond_machine_integers():
    model = whitening.Whitening(2, 3, (3 * 10 ** 9 + 1, 7), np.zeros(0), np.zeros((2, 0)), np.zeros(0), None)
    x = np.array([[10 ** 9 + 2, 5], [5, 2 ** 40]])
    want = [sum((3 * int(a) - s) ** 2 for a, s in zip(row, model.sums)) for row in x]
    assert model.deviations(x) == [w if w < 2 ** 63 else None for w in want]


def test_contour_integration_on_clusters_gaps_and_low_rank():
    rng = np.random.default_rng(0)

    def check(v, k):
        e, u = feast.leading_pairs(v, k)
        w = np.linalg.eigvalsh(v)[::-1]
        k = min(k, int((w > 1e-12 * w[0]).sum()))
        assert np.allclose(e, w[:k], rtol=1e-9, atol=1e-12 * w[0]) and u.shape == (len(v), k)
        assert np.abs(u.T @ u - np.eye(k)).max() < 1e-10 and np.abs(v @ u - u * e).max() < 1e-9 * w[0]

    for d, k in ((1, 4), (2, 1), (7, 16), (40, 16), (64, 64)):
        x = rng.standard_normal((300, d)) * np.linspace(0.01, 3, d)
        check(np.cov(x.T, bias=True).reshape(d, d), k)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    for values in ([7.0] * 20 + [1e-3] * 10 + [0.0] * 10, [1.0] * 40, [5.0] + [0.0] * 39, list(10.0 ** -np.arange(40.0))):
        v = q @ np.diag(values) @ q.T
        check((v + v.T) / 2, 12)
    assert feast.leading_pairs(np.zeros((5, 5)), 3)[0].tolist() == []


def test_inertia_counts():
    rng = np.random.default_rng(1)
    for _ in range(100):
        a = rng.standard_normal((12, 12))
        a, s = a + a.T, rng.standard_normal()
        assert feast.Inertia(a).below(s) == int((np.linalg.eigvalsh(a) < s).sum())

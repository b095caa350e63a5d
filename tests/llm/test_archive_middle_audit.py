"""Operators 11 to 13 against brute force, on the smallest tables and on hard rows."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from burrowline.llm import fill_in_middle, filter_audit, queries, warc
from tests.llm.test_operators import empty, hard, pairs, prose, rows_of, same, small  # noqa: F401

sha = lambda x: hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


@pytest.mark.parametrize("name", ["op11_warc", "op12_fill_in_middle", "op13_filter_audit"])
def test_query_equals_its_sql(spark, sf, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    found = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    same(df.select(*names).collect(), found.fetchall())


# 11 archive

PAGE = "page_id long, url string, html string, digest string, rec int, header string, n_bytes string, payload string"


def hard_pages():
    a, b = prose(60, 1), "é" * 50
    texts = [None, "", "", "short", "short", a, a, a, b, b, "é" * 49 + "x", prose(20000, 2), "HTTP/1.1\r\n\r\nWARC/1.1\r\n" + a, a + "\r\n\r\n", "\x00" * 100, "\x00" * 100]
    rows = [(100 - i, f"http://h/{i}", t) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, None, a), (None, None, "only without an id" * 9), (None, "u", "only without an id" * 9), (7, "line\r\nPage-ID: 3", a), (7, "other", b)]
    return [(*r, "d", 1, "h", "n", "p") for r in rows]


def archived(rows):
    """page_id, bytes, digest, type, refers to; of equal smallest ids any one is the response."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2] or ""].append(r[0])
    out = []
    for t, ids in groups.items():
        ids.sort(key=lambda x: (x is None, x))
        for k, i in enumerate(ids):
            again = k > 0 and len(t.encode()) >= 100
            out.append((i, len(t.encode()), sha(t), "revisit" if again else "response", ids[0] if again else None, True))
    return out


def test_archive(spark, sf):
    rows = hard_pages()
    pages = spark.createDataFrame(rows, PAGE).repartition(3)
    folder = warc.archive(pages)
    same(warc.index(spark, folder).collect(), archived(rows))
    same(warc.restored(spark, folder).select("page_id", "html").collect(), [(r[0], r[2] or "") for r in rows])
    assert warc.payloads(spark, folder).count() == len({r[2] or "" for r in rows})
    assert {r["target"] for r in warc.headers(spark, folder).collect() if r["page_id"] == 7} == {"line%0D%0APage-ID: 3", "other"}
    whole = spark.read.parquet(f"{sf}/pages.parquet")
    same(warc.op11(whole).collect(), archived([tuple(r) for r in whole.select("page_id", "url", "html").collect()]))
    assert warc.op11(spark.createDataFrame([], PAGE)).count() == 0


def parsed(raw: bytes):
    """Records of a WARC file by their stated lengths."""
    at = 0
    while at < len(raw):
        stop = raw.index(b"\r\n\r\n", at) + 4
        fields = dict(x.split(": ", 1) for x in raw[at:stop].decode().split("\r\n")[1:-2])
        assert raw[at:stop].startswith(b"WARC/1.1\r\n")
        n = int(fields["Content-Length"])
        assert raw[stop + n : stop + n + 4] == b"\r\n\r\n"
        yield fields, raw[stop : stop + n]
        at = stop + n + 4


def test_warc_files(spark, tmp_path):
    rows = hard_pages()
    folder = warc.archive(spark.createDataFrame(rows, PAGE).repartition(2))
    warc.write_files(spark, folder, f"file://{tmp_path}/w")
    found = [x for p in sorted((tmp_path / "w").glob("part-*")) for x in parsed(p.read_bytes())]
    assert len(found) == len(rows) and len({f["WARC-Record-ID"] for f, _ in found}) == len(rows)
    names = {f["WARC-Record-ID"]: f for f, _ in found}
    for f, block in found:
        http, payload = block.split(b"\r\n\r\n", 1)
        assert http.startswith(b"HTTP/1.1 200 OK\r\n")
        if f["WARC-Type"] == "response":
            assert f["WARC-Payload-Digest"] == "sha256:" + sha(payload) and f"Content-Length: {len(payload)}" in http.decode()
        else:
            lead = names[f["WARC-Refers-To"]]
            assert payload == b"" and lead["WARC-Type"] == "response" and lead["WARC-Payload-Digest"] == f["WARC-Payload-Digest"] and lead.get("Page-ID") == f.get("Refers-To-Page-ID")


def test_damaged_archive_is_told(spark):
    from burrowline.llm.common import fresh_path

    folder = warc.archive(spark.createDataFrame(hard_pages(), PAGE))
    bad = fresh_path(spark, "damaged")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{bad}/headers")
    p = warc.payloads(spark, folder)
    p.filter("payload <> cast('short' as binary)").selectExpr("digest", "if(octet_length(payload) > 10000, cast('x' as binary), payload) AS payload").write.parquet(f"{bad}/payloads")
    wrong = warc.index(spark, bad).filter("NOT intact").collect()
    assert sorted((r["page_id"], r["payload_bytes"]) for r in wrong if r["payload_bytes"]) == [(89, 1)]
    assert sorted(r["page_id"] for r in wrong if r["payload_bytes"] is None) == [96, 97]


def test_clashing_digests_stop_the_job(monkeypatch):
    class Same:
        def __init__(self, raw):
            pass

        digest = lambda self: b"k"
        hexdigest = lambda self: "k"

    batch = lambda *x: pa.RecordBatch.from_arrays([pa.array(x, pa.binary())], names=["payload"])
    monkeypatch.setattr(warc.hashlib, "sha256", Same)
    with pytest.raises(ValueError, match="different payloads"):
        list(warc.distinct_payloads([batch(b"a", b"b")]))
    sent = [next(warc.distinct_payloads([batch(x)])) for x in (b"a", b"a", b"b")]
    assert [b.num_rows for b in warc.verified_payloads(sent[:2])] == [1, 0]
    with pytest.raises(ValueError, match="different payloads"):
        list(warc.verified_payloads(sent))


def test_payloads_that_are_held_are_bounded(monkeypatch):
    monkeypatch.setattr(warc, "HELD", 100)
    raw = [bytes([i % 7]) * 30 for i in range(50)]
    sent = list(warc.distinct_payloads([pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], names=["payload"])]))
    assert {z[8:] for z in sent[0].column(1).to_pylist()} == {pa.compress(r, "zstd", asbytes=True) for r in raw}


# 12 fill in the middle

LINE, WORD, SENTENCE = r"[^\n]*\n|[^\n]+", r"[^\x20\x09-\x0D]*[\x20\x09-\x0D]|[^\x20\x09-\x0D]+", r"[^\n.!?]*[\n.!?]|[^\n.!?]+"


def cut(doc, t, unit=LINE, rate=100, spm=50, seed=7):
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(unit, t)
    assert "".join(units) == t
    n = len(units)
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc, n, "plain", None, None, t
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    return (doc, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (doc, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def middle_texts():
    return ["\n", "\n\n\n", "a\nb", "a\nb\n", "x <S> y\n", "a<\nS>b\nP>\n<\n", "<\n" * 40, "é\n😀\nü" * 50, "a\r\nb c\x85d\x0b\n", "one line " * 9, "z\n" * 3000 + "end", "S>\n<" * 9, "M>P>"]


@pytest.fixture(scope="module")
def middle(spark, hard):  # noqa: F811
    rows = hard[1] + rows_of(middle_texts())[: len(middle_texts())]
    return spark.createDataFrame(rows, hard[0].schema).repartition(3), rows


@pytest.mark.parametrize("unit,pattern", [("line", LINE), ("word", WORD), ("sentence", SENTENCE)])
def test_transform(middle, small, empty, unit, pattern):  # noqa: F811
    for df, rows in (middle, small):
        for seed, rate, spm in ((7, 100, 50), (11, 70, 0)):
            out = fill_in_middle.transform(df, unit, rate, spm, seed)
            same(out.collect(), [cut(d, t, pattern, rate, spm, seed) for d, t in pairs(rows)])
            back = out.select("doc_id", fill_in_middle.restored(out["output"], out["form"]))
            same(back.collect(), pairs(rows))
    assert fill_in_middle.op12(empty).count() == 0


def test_op12(middle, small):  # noqa: F811
    for df, rows in (middle, small):
        same(fill_in_middle.op12(df).collect(), [(*(c := cut(d, t))[:5], sha(c[5]), sha(t)) for d, t in pairs(rows)])


def test_wavelet_matrix():
    g = np.random.default_rng(5)
    for n in (0, 1, 63, 64, 65, 1000, 5000):
        s = g.integers(0, 8, n).astype(np.uint8)
        s[: n // 2][s[: n // 2] == 3] = 1
        m = fill_in_middle.WaveletMatrix(s)
        for c in range(8):
            at = np.arange(n + 1)
            assert (m.rank(c, at) == np.concatenate([[0], np.cumsum(s == c)])).all()
            where = np.flatnonzero(s == c)
            assert (m.select(c, np.arange(len(where))) == where).all()


def test_slices_cover_all(monkeypatch):
    monkeypatch.setattr(fill_in_middle, "SLICE", 10)
    assert list(fill_in_middle.slices(np.array([0, 4, 6, 1, 100, 0, 3]))) == [(0, 3), (3, 4), (4, 5), (5, 7)]
    texts = middle_texts()
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts, "h1": [12345] * len(texts), "h2": [777] * len(texts), "plain": [False] * len(texts), "spm": [False] * len(texts)})
    out = [r for b in fill_in_middle.cutter("line")([batch.slice(0, 5), batch.slice(5)]) for r in b.to_pylist()]
    for r, t in zip(out, texts, strict=True):
        units = re.findall(LINE, t)
        lo, hi = sorted((12345 % (len(units) + 1), 777 % (len(units) + 1)))
        assert r["output"].decode() == "<P>" + "".join(units[:lo]) + "<S>" + "".join(units[hi:]) + "<M>" + "".join(units[lo:hi])


# 13 filter audit


def audited(rows, labels):
    """rows: (doc_id, text, part)."""
    smallest, good, toxic = {}, set(), set()
    for d, t, _ in rows:
        if d is not None:
            smallest[t or ""] = min(d, smallest.get(t or "", d))
    for d, q, x in labels:
        if d is not None:
            good |= {d} if q == 1 else set()
            toxic |= {d} if x == 1 else set()
    docs = defaultdict(list)
    for d, t, part in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)), d is not None and d > smallest[t]]
        docs[part or ""].append((frozenset(c for c, f in zip("ABCDE", fails, strict=True) if f), d in good, d in toxic))
    out = []
    for part, ds in docs.items():
        steps, total = [], Counter()
        for o in map("".join, permutations("ABCDE")):
            left = list(ds)
            for k, c in enumerate(o, 1):
                gone = [x for x in left if c in x[0]]
                failing = sum(c in x[0] for x in ds)
                left = [x for x in left if c not in x[0]]
                total[c] += len(gone)
                steps.append((part, o, k, len(left), len(gone), failing - len(gone), sum(x[0] == {c} for x in ds), sum(x[1] for x in gone), sum(x[2] for x in gone)))
        out += [(*s, total[s[1][s[2] - 1]]) for s in steps]
    return out


def test_audit(spark, sf, hard, small, empty):  # noqa: F811
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    known = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    rows = [tuple(r) for r in small[0].select("doc_id", "text", "lang").collect()]
    same(filter_audit.audit(small[0], labels).collect(), audited(rows, known))
    odd = [(6, 1, 0), (6, 0, 1), (None, 1, 1), (7, None, None), (9999, 1, 1), (1, 1, 1)]
    few = spark.createDataFrame([(*r, 5) for r in odd], "doc_id long, quality int, toxic int, good int")
    same(filter_audit.audit(hard[0], few).collect(), audited([(r[0], r[1], r[2]) for r in hard[1]], odd))
    assert filter_audit.audit(empty, labels).count() == 0
    assert filter_audit.audit(hard[0], few.limit(0)).count() == 120 * 5 * 2


def test_audit_of_repeated_rows_and_parts(spark):
    a, b = prose(250, 3), prose(250, 4) + " #"
    rows = [(5, a, "x"), (5, a, "x"), (5, a, "y"), (6, a, "y"), (None, a, "y"), (2, b, None), (2, b, ""), (1, b, "x"), (8, "", "x"), (9, None, "x"), (9, None, "x")]
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, lang string, mask int").repartition(5)
    labels = spark.createDataFrame([(5, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int")
    same(filter_audit.audit(docs, labels).collect(), audited(rows, [(5, 1, 0), (9, 0, 1)]))


def test_contraction_adds_up():
    g = np.random.default_rng(2)
    counts = pd.DataFrame({"part": "p", "cell": range(32), "n": g.integers(0, 99, 32), "n_good": 0, "n_toxic": 0})
    out = filter_audit.contracted(counts)
    for _, o in out.groupby("filter_order"):
        assert o["removed"].sum() + o["kept"].min() == counts["n"].sum()
    total = out.drop_duplicates("shapley")["shapley"].sum()  # the filters' values share all that is removed
    assert total == 120 * (counts["n"].sum() - counts["n"][0])

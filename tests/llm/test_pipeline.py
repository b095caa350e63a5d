"""The pipeline, stage by stage, against brute force on the smallest table."""

import re
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from burrowline.llm import pii
from burrowline.llm.common import fresh_path

from .test_operators import SCHEMA, prose, rows_of, hard_texts, crc, pii_base, plain_dedup, quality_row, whole_ids


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, f in corpus_pipeline.STAGES:
        path = fresh_path(spark, f"test-{name}")
        f(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [{r["doc_id"]: r["text"] for r in d.collect()} for d in out[:-1]] + [out[-1].collect()], out


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_columns_stay_until_packing(stages):
    assert all(d.columns == stages[1][0].columns for d in stages[1][:-1])


def test_quality_keeps_what_the_rules_pass(stages):
    before, after = stages[0][0], stages[0][1]
    assert after == {d: t for d, t in before.items() if quality_row(d, t or "")[-1]}


def test_one_of_each_group_stays(stages):
    before, after = stages[0][1], stages[0][2]
    s = {d: shingles(t) for d, t in before.items()}
    like = {(a, b): len(s[a] & s[b]) / len(s[a] | s[b]) for a in s for b in s if a < b}
    assert not [p for p, j in like.items() if j >= 0.8 and p[0] in after and p[1] in after]
    close = defaultdict(float)
    for (a, b), j in like.items():
        close[a], close[b] = max(close[a], j), max(close[b], j)
    assert {d for d in before if close[d] < 0.6} <= set(after)
    assert all(before[d] == t for d, t in after.items())


def test_repeated_strings_go(stages):
    before, after = stages[0][2], stages[0][3]
    rows = sorted(before.items())
    assert {d: len(t.encode()) for d, t in after.items()} == {d: pytest.approx(n - gone, abs=6) for d, n, gone, _, _ in plain_dedup(rows)}
    assert all(t == before[d] for (d, t), (_, _, gone, _, _) in zip(sorted(after.items()), plain_dedup(rows), strict=True) if not gone)


def test_personal_data_is_replaced(stages):
    before, after = stages[0][3], stages[0][4]
    for d, t in before.items():
        spans, out, done = sorted(((a, z, k) for k, a, z in pii_base(t)), key=lambda x: (x[0], -x[1])), [], 0
        for a, z, k in spans:
            if a >= done:
                out += [t[done:a], f"<{k}>"]
            done = max(done, z)
        assert re.sub("<context>", "", after[d]) == "".join([*out, t[done:]]) or "<context>" in after[d]
    assert not [d for d, t in after.items() if pii.spans_of(t)]


def test_pieces_are_those_of_the_texts(stages, spark, sf):
    texts, found = stages[0][4], stages[0][5]
    expected = set()
    for d, ids in zip(texts, whole_ids(list(texts.values())), strict=True):
        expected |= {(d, k // 4096, k, len(ids[k : k + 4096]), crc(ids[k : k + 4096])) for k in range(0, len(ids), 4096)}
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found} == expected
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        assert [o for o, _ in sorted(b)] == [0, *np.cumsum([n for _, n in sorted(b)])[:-1]]
    run = corpus_pipeline.run(spark, sf)
    assert run.count() == len(found) and run.columns == stages[1][5].columns


CLASHING = "n_words long, kept string, n_bytes string, n_removed double, n_spans string, fail_bits string, c0 string, kind int, rid string, root string, packed string, spans string, dk int, n string, `odd name.x` string"


@pytest.fixture(scope="module")
def clashing(spark):
    """Hard rows with columns that operators name their measures by."""
    base = rows_of([*hard_texts(), *[prose(80 + i, 50 + i) for i in range(12)], prose(90, 999) + " bob@mail.example.com"])
    values = lambda i: (i, f"k{i}", f"b{i}", i / 2, None, "f", "c", i, "r", None, f"p{i}", "s", -i, "n", f"x{i}")
    rows = [(r[0], r[1], *values(i)) for i, r in enumerate(base)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHING}").repartition(3), rows


def test_other_columns_go_through_untouched(spark, clashing, sf):
    docs, rows = clashing
    of = {r[2]: r[2:] for r in rows}  # by n_words, a number of their own here
    for name, f in corpus_pipeline.STAGES[:-1]:
        path = fresh_path(spark, f"clash-{name}")
        f(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        found = docs.collect()
        assert docs.columns == clashing[0].columns and dict(docs.dtypes) == dict(clashing[0].dtypes)
        assert found and all(tuple(r)[2:] == of[r["n_words"]] for r in found), name
    kept = {r["n_words"]: r["text"] for r in docs.collect()}
    assert any("<email>" in t for t in kept.values()) and len(kept) >= 10


def test_empty_tables_and_lone_rows(spark, sf):
    docs = spark.createDataFrame([], SCHEMA)
    for name, f in corpus_pipeline.STAGES:
        out = f(spark, docs, sf)
        assert out.count() == 0, name
    lone = spark.createDataFrame([(None, prose(70, 9), "en", None, 5)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, f in corpus_pipeline.STAGES[:-1]:
        lone = spark.createDataFrame(f(spark, lone, sf).collect(), lone.schema)
        assert [tuple(r) for r in lone.collect()] == [(None, prose(70, 9), "en", None, len(prose(70, 9)))], name


def test_repeated_and_null_ids(spark, sf):
    """Rows that share an id are told apart by their texts; of equal texts one row stays."""
    a, b, c = prose(120, 1), prose(120, 2), prose(120, 3)
    docs = spark.createDataFrame([(1, a), (1, b), (1, a), (None, c), (None, c), (None, None), (None, "")], "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, corpus_pipeline.quality(spark, docs, sf), sf)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == sorted([(1, a), (1, b), (0, c)])

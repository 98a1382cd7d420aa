"""The pipeline's stages, each against a plain version of it on the stage's own input; and the queries with SQL."""

from pathlib import Path

import corpus_pipeline
import duckdb
import pytest
from tests.llm import _brute as brute
from tidewell.llm import mixing, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _given(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def _check(spark, docs, folder, data):
    columns = docs.columns
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, data).write.parquet(f"{folder}/{i}")
        out.append((docs, docs := spark.read.parquet(f"{folder}/{i}")))
        if i < 4:
            assert docs.columns == columns
    (raw, good), (_, unique), (_, distinct), (_, mixed), (_, packed) = out

    before, after = dict(_given(raw)), dict(_given(good))
    failed = {d for d, t in before.items() if (m := brute.base_measures(t)) and (m[0] < 50 or 2 * m[4] > m[0])}
    assert not failed & set(after) and len(after) >= 0.95 * (len(before) - len(failed))
    assert all(set(after[d].split("\n")) <= set(before[d].split("\n")) for d in after)

    first = {}
    for d, t in _given(good):
        first[brute.normal(t)] = min(d, first.get(brute.normal(t), d))
    assert sorted(d for d, _ in _given(unique)) == sorted(first.values())

    fps = {d: brute.simhash(t) for d, t in _given(unique)}
    values = set(fps.values())
    roots = brute.components(values, [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4])
    least = {}
    for d, f in fps.items():
        least[roots[f]] = min(d, least.get(roots[f], d))
    assert sorted(d for d, _ in _given(distinct)) == sorted(least.values())

    copies = {r.doc_id: r.copies for r in mixing.mix(distinct).collect()}
    assert sorted(d for d, _ in _given(mixed)) == sorted(d for d, n in copies.items() for _ in range(n))

    pieces = packed.collect()
    assert sum(p.length for p in pieces) == sum(len(brute.ids(t)) for _, t in _given(mixed))
    texts = dict(_given(mixed))
    for p in pieces[:50]:
        assert p.ids_crc32 == brute.crc(brute.ids(texts[p.doc_id])[p.start : p.start + p.length]) and p.offset + p.length <= 4096


def test_pipeline(spark, data, tmp_path):
    _check(spark, spark.read.parquet(f"{data}/documents.parquet"), str(tmp_path), data)
    assert corpus_pipeline.run(spark, data).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_pipeline_of_awkward_rows(spark, data, tmp_path):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, text, "en", "a", 1), (3, text, "en", "a", 1), (4, text.replace(" ", "\t"), None, None, None), (None, text + " x", "en", "b", 1), (None, text + " x", "en", "b", 1), (5, "few words", "en", "b", 9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, data).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept.append(docs.count())
    assert kept[0] == 5 and kept[1] == 2 and 1 <= kept[2] <= 2
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, data).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, data, name):
    c = duckdb.connect()
    for p in Path(data).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    found = c.execute(queries.ORACLE_SQL[name])
    columns = [x[0] for x in found.description]
    df = queries.QUERIES[name](spark, data)
    assert sorted(df.columns) == sorted(columns)
    key = sorted(columns)
    assert sorted(repr(tuple(r[c] for c in key)) for r in df.collect()) == sorted(repr(tuple(r[columns.index(c)] for c in key)) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_runs(spark, data, name):
    assert queries.QUERIES[name](spark, data).count() > 0

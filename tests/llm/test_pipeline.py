"""The pipeline against brute force, stage by stage, and the registered queries against SQL."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from fundmart.llm.base import clear_written
from fundmart.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import DOCS, EDGE, LABELS, doc
from tests.llm.test_dedup import brute_components, brute_fingerprint, brute_groups
from tests.llm.test_mixing import brute_mix
from tests.llm.test_texts import toxic_rows

DATA = Path("/root/testdata/sf0.001")


def write(spark, folder, rows, labels):
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_equals_brute_force(spark, tmp_path):
    import sentencepiece

    rows, labels = toxic_rows()
    rows += [doc(1000 + i, rows[i][1], "t") for i in range(1, 100)]
    changed = [r[1].split() for r in rows[200:260]]
    rows += [doc(2000 + i, " ".join(w[:-1] + ["changed"]), "u") for i, w in enumerate(changed)]
    folder = write(spark, tmp_path, rows, labels)

    # The made-up toxic words are all that tells toxic rows, so brute force may look for them.
    marks = ("scoundrel", "nitwit", "rotter", "vorb")
    left = [r for r in rows if not any(m in r[1] for m in marks)]
    kept = {g[0] for g in brute_groups(left) if g[3]}
    left = [r for r in left if r[0] in kept]
    roots = brute_components([(r[0], brute_fingerprint(r[1])) for r in left])
    left = [r for r, root in zip(left, roots, strict=True) if r[0] == root]
    coder = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    text = {r[0]: r[1] for r in left}
    expected = []
    for doc_id, size, _, _, taken in brute_mix(left):
        expected += [(doc_id, coder.encode(text[doc_id]))] * (taken // size)
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in found) == sorted(expected)
    assert all(r["parity"] and r["round_trip"] for r in found)


@pytest.mark.parametrize("rows", [EDGE, []], ids=["edge", "empty"])
def test_stages_on_odd_tables(spark, tmp_path, rows):
    folder = write(spark, tmp_path, rows, [(1, 1, 0), (2, 0, 1), (None, None, None)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert (docs.count() > 0) == bool(rows)
    assert "ids" in docs.columns


def test_written_tables_can_be_removed(spark, edge):
    from fundmart.llm.base import _scratch, written
    from fundmart.session import path_exists

    written(edge.select("doc_id"), "some")
    assert path_exists(spark, _scratch(spark))


@pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        database.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df, expected = QUERIES[name](spark, str(DATA)), database.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    left = sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    places = [expected.columns.index(c) for c in columns]
    assert left == sorted((tuple(r[i] for i in places) for r in expected.fetchall()), key=str)


@pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")
def test_every_operator_has_one_query(spark):
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    for name in QUERIES:
        if name not in ORACLES:
            other = {"op5": ("pages", 1), "op11": ("embeddings", 16), "op13": ("pages", 1)}
            table, times = other.get(name.split("_")[0], ("documents", 1))
            rows = times * spark.read.parquet(f"{DATA}/{table}.parquet").count()
            assert QUERIES[name](spark, str(DATA)).count() == rows
    clear_written(spark)

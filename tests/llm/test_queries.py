"""The registered queries on the small tables, and the pipeline against a
version of each stage that looks at everything."""

from __future__ import annotations

import random
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from framelake.llm.common import written
from framelake.llm.decontaminate import WINDOW
from framelake.llm.queries import ORACLE_SQL, QUERIES, word_tokenizer

from .test_decontaminate import expected as expected_hits
from .test_decontaminate import words
from .test_simhash import expected as expected_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "labels", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, con, name):
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_each_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_stage_by_stage(spark, con):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    benchmark = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    before = [tuple(r) for r in docs.collect()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, SF), "test-pipeline")
        after = [tuple(r) for r in docs.collect()]
        if number < 4:
            assert docs.columns == columns
        if number == 0:
            kept = {r[0] for r in con.execute(ORACLE_SQL["op9_quality_rules"]).fetchall() if r[7]}
            assert sorted(after) == sorted(r for r in before if r[0] in kept)
        elif number == 1:
            keep = {i for i, _, c in expected_components(before) if i == c}
            assert sorted(after) == sorted(r for r in before if r[0] in keep)
        elif number == 2:
            out = {r[0]: r for r in after}
            for r in before:
                n, hit, _ = expected_hits(r[1], benchmark, WINDOW)
                if not hit:
                    assert out[r[0]] == r
                elif r[0] in out:
                    text = out[r[0]][1]
                    assert not expected_hits(text, benchmark, WINDOW)[1] and out[r[0]][4] == len(text)
                    assert 2 * (n - len(words(text))) <= n
                else:
                    assert 2 * len(hit) > 0.8 * n
        elif number == 3:
            counts = {r: after.count(r) for r in before}
            assert set(after) <= set(before) and max(counts.values()) <= 2
            size = lambda rows: sum(len((r[1] or "").split()) for r in rows)
            assert abs(size(after) / size(before) - 1.5) < 0.1
        else:
            tokenizer, start, want = Tokenizer.from_file(word_tokenizer()), 0, []
            for r in sorted(before):
                ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2]
                want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
                start += len(ids)
            assert sorted(after, key=lambda r: r[1]) == want
        before = after


def test_pipeline_on_awkward_rows(spark, documents, tmp_path):
    draw = random.Random(3)
    text = lambda n: " ".join("".join(draw.choice("abcdef") for _ in range(5)) for _ in range(n))
    rows = [(i, text(draw.choice([10, 60, 300])), draw.choice(["en", None]), draw.choice(["a", "b", None])) for i in range(60)]
    rows += [(100, None, None, None), (101, "", "en", "a"), (None, text(80), "en", "a"), (102, text(100_000), "en", "a"), rows[0], rows[0]]
    documents(rows, clashes=True).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, rows[1][1]), (2, None), (None, "x")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} <= {r[0] for r in rows} and 102 in {r["doc_id"] for r in got}
    documents([]).write.parquet(str(tmp_path / "none/documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "none/benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []

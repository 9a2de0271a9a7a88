"""The corpus pipeline against plain versions of its stages."""

from __future__ import annotations

from pathlib import Path

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from docloom.llm.registry import QUERIES  # noqa: E402
from tests.llm.brute import classes, deduplicated  # noqa: E402
from tests.llm.test_quality import plain_verdicts  # noqa: E402
from tests.llm.test_tokens import laws_of_packing  # noqa: E402

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="no test tables here")


def test_stages(spark, tmp_path):
    d = str(DATA)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], d).write.parquet(str(tmp_path / str(k)))
        seen.append(spark.read.parquet(str(tmp_path / str(k))))
    assert all(s.columns == columns for s in seen[1:-1])
    ids = [sorted(r.doc_id for r in s.select("doc_id").collect()) for s in seen[:-1]]
    good = {r.doc_id for r in QUERIES["op1_rule_ensemble"](spark, d).where("predicted = 1").collect()}
    assert ids[1] == sorted(set(ids[0]) & good)
    verdicts = plain_verdicts([tuple(r) for r in seen[1].select("doc_id", "text", "lang", "source", "n_chars").collect()])
    assert ids[2] == sorted(i for i, kept in verdicts.items() if kept) and len(ids[2]) > 0.8 * len(ids[1])
    before = [(r.doc_id, r.text) for r in seen[2].collect()]
    assert ids[3] == sorted(i for i, c in classes(before).items() if i == c)
    before = {r.doc_id: r.text for r in seen[3].collect()}
    expected = {i: kept if gone else before[i] for i, (_, gone, kept) in deduplicated(list(before.items())).items() if kept or not gone}
    after = seen[4].collect()
    assert {r.doc_id: r.text for r in after} == expected and all(r.n_chars == len(r.text) for r in after)
    tokens, sequences = laws_of_packing([(r.doc_id, r.text) for r in after], seen[5].collect())
    assert tokens and sequences
    run = corpus_pipeline.run(spark, d)
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in run.collect()) == sorted((r.doc_id, r.start, r.ids_crc32) for r in seen[5].collect())

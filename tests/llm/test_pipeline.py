import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from helpers import AWKWARD, docs, prose
from tickwise.llm import registered

SF = "/root/testdata/sf0.001"


def test_stages_and_registration():
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "pii", "packing"]
    names = entry.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(registered.ORACLE_SQL) <= set(entry.oracle_sql())


def test_decisions_take_effect(spark, workdir):
    item = prose(20, 77)
    rows = [r for r in AWKWARD] + [(20 + i, prose(80, i)) for i in range(10)]
    rows += [(40, prose(80, 0)), (41, prose(79, 0) + " changed"), (42, prose(50, 41) + " " + item),
             (43, prose(50, 42) + " write to a@b.org")]
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{workdir}/benchmark.parquet")
    data = docs(spark, rows, extra=True)
    kept = data
    seen = {}
    for name, stage in pipeline.STAGES[:-1]:
        path = f"{workdir}/{name}"
        stage(spark, kept, workdir).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == data.columns
        seen[name] = {x.doc_id: x for x in kept.collect()}
    assert {1, 2, 3, 9}.isdisjoint(seen["language_id"]) and 20 in seen["language_id"]
    assert {40, 41}.isdisjoint(seen["near_duplicates"]) and set(range(20, 30)) <= set(seen["near_duplicates"])
    assert sum(x.doc_id == 8 for x in kept.collect()) == 1 and None in seen["near_duplicates"]
    assert set(seen["near_duplicates"]) - set(seen["decontamination"]) == {42}
    assert seen["pii"][43].text.endswith("write to [EMAIL]") and seen["pii"][43].n_chars == len(seen["pii"][43].text)
    packed = pipeline.STAGES[-1][1](spark, kept, workdir).collect()
    assert {x.doc_id for x in packed} == set(seen["pii"])


def test_empty_table(spark, workdir):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{workdir}/benchmark.parquet")
    docs(spark, []).write.parquet(f"{workdir}/documents.parquet")
    assert pipeline.run(spark, workdir).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables not present")
def test_run_over_the_shared_tables(spark):
    got = pipeline.run(spark, SF)
    assert got.count() > 0 and "sequence_id" in got.columns

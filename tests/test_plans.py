"""Plan-shape rules for every registered query (checked on the smallest tables):
no Cartesian or nested-loop joins, and scans read only the columns they need."""

import re

import pytest

from quill.plans.registry import load_all

SF = "/root/testdata/sf0.001"
REG = load_all()


@pytest.mark.parametrize("name", sorted(REG))
def test_no_cross_products(spark, name):
    plan = REG[name].build(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_search_plan_prunes_and_limits_before_shuffle(spark):
    df = REG["j1_knn_topk"].build(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the store scan reads ids and vectors only (the label column is pruned)
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert any(set(s.split(",")) == {"vec_id#0L", "embedding#1"} or
               {c.split("#")[0] for c in s.split(",")} == {"vec_id", "embedding"} for s in scans)
    # partial top-k before the exchange, final after it
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


# Queries allowed to run Python: similarity scoring (mapInArrow, plus the
# hashing embedder's count step), HTML extraction, the recursive splitter and
# YAML validation. Everything else must stay in the JVM.
PYTHON_QUERIES = {"e2e_search", "j1_knn_topk", "j1_dealt_topk", "j1_text_search", "p3_a9_response_pack",
                  "f1_html_to_text", "f4_recursive_split", "f4_split_whole_texts", "f10_strict_validate"}
PY_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas")


def test_python_only_where_intended(spark):
    uses = set()
    for name, q in REG.items():
        if name == "e1_streaming_ingest":      # runs its stream while building; the rest is a Parquet read
            continue
        plan = q.build(spark, SF)._jdf.queryExecution().executedPlan().toString()
        if any(k in plan for k in PY_NODES):
            uses.add(name)
    assert uses == PYTHON_QUERIES


def test_store_roundtrip_plan_reads_the_selected_modules_only(spark):
    plan = REG["s4_s5_store_roundtrip"].build(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"PartitionFilters: \[[^\]]*label-2", plan) and re.findall(r"PartitionFilters: \[[^\]]*label-7", plan)


def test_windows_rows_carry_no_token_arrays(spark):
    plan = REG["f5_window_split"].build(spark, SF)._jdf.queryExecution().executedPlan().toString()
    generate = next(line for line in plan.splitlines() if "Generate inline" in line)
    # the generator's output columns: the documents' own, and the windows'
    assert "_p#" not in generate.rsplit("))), [", 1)[-1]


def _written_plans(spark, monkeypatch, run):
    """Physical plans of what ``run`` stores on the way."""
    from quill.operators import ordinal, scan
    plans = []
    for module in (ordinal, scan):
        real = module.stored
        monkeypatch.setattr(module, "stored", lambda df, label, real=real: (plans.append((label, df._jdf.queryExecution().executedPlan().toString())), real(df, label))[1])
    run()
    return plans


def test_scan_moves_the_lines_in_one_exchange(spark, monkeypatch):
    from quill.operators.changelog import unreleased_entries
    df = spark.createDataFrame([("f", i, "- x") for i in range(5)], "file string, line_no long, line string")
    out = []
    plans = _written_plans(spark, monkeypatch, lambda: out.append(unreleased_entries(df)))
    assert [label for label, _ in plans] == ["scan"] and len(re.findall(r"Exchange rangepartitioning", plans[0][1])) == 1
    # what reads the stored lines broadcasts one row a partition and shuffles nothing
    final = out[0]._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in final and "BroadcastHashJoin" in final


def test_ordinals_store_keys_only(spark, monkeypatch):
    from quill.operators.bundle import render_documents, toc_bundle
    from quill.operators.embed import ConsistentEmbedder
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for run in (lambda: render_documents(docs, module_col="lang"), lambda: ConsistentEmbedder("doc_id").embed(docs),
                lambda: toc_bundle(docs.select("source", "text"), path_col="source")):
        for label, plan in _written_plans(spark, monkeypatch, run):
            scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
            assert label == "ordinals" and "Exchange rangepartitioning" in plan
            top = plan.split("Exchange rangepartitioning")[0] + plan.split("Exchange rangepartitioning")[1].splitlines()[1]
            assert "text#" not in top, (scans, top)

"""File sources, the vector store and the streaming ingest, on temp folders."""

import json
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from quill.operators.headers import audit
from quill.sources import files as FS
from quill.sources import store as ST
from quill.sources.versions import drop_unused, manifest, open_versioned, refresh
from quill.streaming.ingest import ingest_pages, open_ingested, page_chunks, store_root


def _tmp():
    return tempfile.mkdtemp(prefix="quill-test-")


def test_module_docs_read_and_errors(spark):
    root = _tmp()
    os.makedirs(f"{root}/dpytest")
    with open(f"{root}/dpytest/dpytest_docs.txt", "w") as f:
        f.write("line one\nline two\n")
    row = FS.read_module_docs(spark, root, "dpytest").first()
    assert row.text == "line one\nline two\n"
    with pytest.raises(FS.ResourceError, match="Documentation file not found for module: other_module"):
        FS.read_module_docs(spark, root, "other_module")


def test_rule_files_and_audit(spark):
    root = _tmp()
    os.makedirs(f"{root}/core-rules")
    with open(f"{root}/core-rules/a-agent.mdc", "w") as f:
        f.write("---\ndescription: Use it\nglobs: \nalwaysApply: false\n---\nbody")
    with open(f"{root}/b.mdc.md", "w") as f:
        f.write("no header")
    with open(f"{root}/c.txt", "w") as f:
        f.write("ignored")
    df = audit(FS.read_rule_files(spark, root))
    got = {r.path: (r.rule_type, r.valid) for r in df.collect()}
    assert got == {"core-rules/a-agent.mdc": ("Agent Selected", True), "b.mdc.md": ("Unknown", False)}
    assert {r.path for r in FS.read_rule_files(spark, root, "lines").collect()} == {"core-rules/a-agent.mdc"}


def test_qa_and_url_map(spark):
    root = _tmp()
    with open(f"{root}/q_a.json", "w") as f:
        json.dump([{"question": "q1", "answer": "a1"}, {"question": "q2", "answer": "a2"}], f, indent=2)
    assert FS.read_qa(spark, f"{root}/q_a.json").count() == 2
    with open(f"{root}/map.json", "w") as f:
        json.dump({"https://x.io/a/b.html": "x.io_a_b.html.txt"}, f)
    assert FS.read_url_map(spark, f"{root}/map.json").first().file == "x.io_a_b.html.txt"


def test_text_totals_utf8(spark):
    root = _tmp()
    with open(f"{root}/ok.txt", "w", encoding="utf-8") as f:
        f.write("héllo world")
    with open(f"{root}/bad.txt", "wb") as f:
        f.write(b"\xff\xfe\x00bad")
    rows = {os.path.basename(r.path): r for r in FS.text_totals(spark, [f"{root}/ok.txt", f"{root}/bad.txt"]).collect()}
    assert rows["ok.txt"].chars == 11 and rows["ok.txt"].tokens == 2 and rows["ok.txt"].error is None
    assert rows["bad.txt"].error.startswith("Error: Could not decode")
    for paths in ([f"{root}/missing.txt"], [f"{root}/ok.txt", f"{root}/none/at/all.txt"], ["/no/such/folder/x.txt"]):
        with pytest.raises(FileNotFoundError, match=paths[-1]):
            FS.text_totals(spark, paths)
    os.makedirs(f"{root}/none")
    got = {r.path: r.error for r in FS.text_totals(spark, [f"file:{root}/ok.txt", f"{root}/none/x.txt"], texts=["a b"], missing="rows").collect()}
    assert got == {f"file:{root}/ok.txt": None, f"{root}/none/x.txt": f"Error: File not found - {root}/none/x.txt", "<text:0>": None}
    with pytest.raises(ValueError, match="Must provide"):
        FS.text_totals(spark, [])


def test_all_module_docs(spark):
    root = _tmp()
    os.makedirs(f"{root}/a")
    with open(f"{root}/a/a_docs.txt", "w") as f:
        f.write("one\n")
    mods = spark.createDataFrame([("a",), ("b",)], "module string")
    for where, text in ((root, "one\n"), (f"{root}/nowhere", None)):
        got = {r.module: (r.text, r.error) for r in FS.read_all_module_docs(spark, where, mods).collect()}
        lost = "Error reading documentation file: Documentation file not found for module: "
        assert got == {"a": (text, None if text else lost + "a"), "b": (None, lost + "b")}


def test_store_roundtrip_and_catalogue(spark):
    root = _tmp()
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for module in ("alpha", "beta"):
        rows = page_chunks(pages, module)
        ST.write_store(rows, ST.default_store_path(root, module), files_per_module=2)
    s = ST.open_store(spark, module="alpha", docs_root=root)
    assert s.count() > 0 and set(s.columns) >= {"chunk_id", "embedding", "text"}
    cat = {r.module: r.n_stores for r in ST.list_stores(spark, root).collect()}
    assert cat[None] == cat["alpha"] + cat["beta"]


def _chunks(df):
    return sorted((r.chunk_id, r.text, r.metadata["source"], tuple(r.embedding)) for r in df.collect())


def _article(*words):
    return "<article>" + " ".join(words) + "</article>"


def test_streaming_ingest_refreshes_pages(spark):
    root = _tmp()
    src, store = f"{root}/pages", f"{root}/store"
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    again = lambda ck: ingest_pages(spark, f"{src}/*", store, "web", checkpoint=f"{root}/{ck}", size=64, overlap=8, buckets=5)
    pages.filter(F.col("page_id") % 2 == 0).write.parquet(f"{src}/part1")
    again("ck")
    first = manifest(spark, store_root(store, "web"))
    # the other pages, and shorter captures of some that are there: one has no text left
    short = pages.withColumn("html", F.when(F.col("page_id") == 0, F.lit(_article())).otherwise(F.lit(_article("short", "text"))))
    pages.filter(F.col("page_id") % 2 == 1).unionByName(short.filter(F.col("page_id") % 4 == 0)).write.parquet(f"{src}/part2")
    again("ck")
    want = _chunks(page_chunks(pages.filter(F.col("page_id") % 4 != 0).unionByName(short.filter(F.col("page_id") % 4 == 0)), "web", size=64, overlap=8))
    assert _chunks(open_ingested(spark, store, "web")) == want
    live = manifest(spark, store_root(store, "web"))
    assert first["version"] == 1 and live["version"] == 2
    again("ck2")                                    # a full replay, old captures first or not, changes nothing
    assert manifest(spark, store_root(store, "web")) == live
    assert drop_unused(spark, store_root(store, "web")) == sorted({1, 2} - set(live["live"].values()))
    assert _chunks(open_ingested(spark, store, "web")) == want


def test_refresh_is_seen_at_once_and_survives_a_dead_run(spark):
    root = _tmp()
    pages = lambda *rows: spark.createDataFrame(list(rows), "page_id long, url string, html string, stamp int")
    build = lambda p: page_chunks(p, "m", size=4, overlap=0)
    n = iter(range(100))
    step = lambda p: refresh(spark, f"{root}/s", p, build, f"{root}/staging{next(n)}", buckets=3)
    texts = lambda: {r.metadata["source"]: r.text for r in open_versioned(spark, f"{root}/s").collect()}
    with pytest.raises(ValueError, match="no complete version"):
        open_versioned(spark, f"{root}/s")
    assert step(pages((1, "a", _article("x"), 1), (2, "b", _article("y"), 1), (None, "n", _article("n"), 1), (9, "s", _article("s"), None))) == 1
    assert texts() == {"a": "x", "b": "y"}
    os.makedirs(f"{root}/s/manifest/000000000002")       # data of a run that died before its manifest was complete
    page_chunks(pages((1, "a", _article("broken"), 9)), "m").withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{root}/s/data/version=2")
    assert texts() == {"a": "x", "b": "y"}
    # in one batch: an older capture, the newest, and one as new (the greater row counts)
    assert step(pages((1, "a", _article("old"), 0), (1, "a", _article("new"), 3), (1, "a", _article("mid"), 2), (2, "b", _article("z"), 1), (3, "c", "", 1))) == 2
    assert texts() == {"a": "new", "b": "y"}
    assert step(pages((1, "a", _article("late"), 2), (3, "c", _article("c"), 1))) == 2
    assert step(pages((3, "c", _article("c"), 2))) == 3 and texts() == {"a": "new", "b": "y", "c": "c"}
    plan = open_versioned(spark, f"{root}/s")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*version[^\]]*bucket", plan)


def test_index_file_lines(spark):
    from quill.operators.index import parse_index_lines
    root = _tmp()
    with open(f"{root}/llms.txt", "w") as f:
        f.write("[Backend — docs](https://x.io/a/backend.html): LLM should read this page when testing. (Backend module)\n"
                "\n"
                "[Index](https://x.io/a/index.html): LLM should read this page when starting (see intro). (Start page (v2))\n"
                "not an entry\n")
    rows = parse_index_lines(FS.read_index_lines(spark, f"{root}/llms.txt")).orderBy("value").collect()
    assert len(rows) == 3
    good = {r.url: (r.title, r.description, r.summary) for r in rows if r.valid}
    assert good["https://x.io/a/backend.html"] == ("Backend — docs", "LLM should read this page when testing.", "Backend module")
    assert good["https://x.io/a/index.html"][0] == "Index"
    assert sum(1 for r in rows if not r.valid) == 1


def test_ordered_bundle_sink(spark):
    import glob
    from quill.operators.bundle import render_documents, write_ordered_text
    docs = spark.createDataFrame([(i, "m" if i % 3 else "n", f"src{i}", f"text {i}") for i in range(40)],
                                 "doc_id long, module string, source string, text string")
    out = _tmp() + "/bundle"
    write_ordered_text(render_documents(docs), out, "module", ["ordinal"], "block", n_files=6)
    text = "".join(open(p).read() for p in sorted(glob.glob(f"{out}/module=m/part-*")))
    mids = [i for i in range(40) if i % 3]
    want = "".join(f"Document {k + 1}: src{i}\n" + "-" * 80 + f"\ntext {i}\n\n" + "=" * 80 + "\n\n"
                   for k, i in enumerate(mids))
    assert text == want


def test_image_inventory(spark):
    from quill.operators.answers import image_inventory
    root = _tmp()
    os.makedirs(f"{root}/sub")
    for name in ["a.PNG", ".hidden.png", "b.txt", "sub/c.jpeg", "sub/d.tar.gz", "sub/e.webp"]:
        with open(f"{root}/{name}", "wb") as f:
            f.write(b"x")
    got = sorted(os.path.basename(r.path) for r in image_inventory(spark, root).collect())
    assert got == ["a.PNG", "c.jpeg", "e.webp"]


def _site(spark):
    html = lambda body, links: ("<html><body><article>" + body + "".join(f'<a href="{l}">x</a>' for l in links)
                                + "</article></body></html>")
    pages = spark.createDataFrame([
        (1, "https://d.io/docs/", html("alpha beta", ["a/", "https://other.io/x"])),
        (2, "https://d.io/docs/a/", html("gamma", ["b.html", "../"])),
        (3, "https://d.io/docs/a/b.html", html("delta", ["/blog/c.html"])),
        (4, "https://d.io/blog/c.html", html("outside the prefix", [])),
        (5, "https://d.io/docs/orphan.html", html("never linked", [])),
    ], "page_id long, url string, html string")
    seeds = spark.createDataFrame([("m", 0, "https://d.io/docs/"), ("m", 1, "https://d.io/docs/a/"), ("m", 2, "https://d.io/docs/none/"), ("n", 0, "https://d.io/blog/c.html")],
                                  "module string, seed_pos int, seed_url string")
    return pages, seeds


def test_build_store_crawls_every_seed_inside_its_prefix(spark):
    from quill.operators.corpus import build_store, crawl
    pages, seeds = _site(spark)
    assert sorted((r.module, r.seed_pos, r.page_id, r.depth) for r in crawl(pages, seeds, 5).collect()) == [
        ("m", 0, 1, 0), ("m", 0, 2, 1), ("m", 0, 3, 2), ("m", 1, 2, 0), ("m", 1, 3, 1), ("n", 0, 4, 0)]
    assert {r.page_id for r in crawl(pages, seeds.filter("seed_pos = 0 and module = 'm'"), 1).collect()} == {1, 2}
    root = _tmp()
    counts = build_store(spark, pages, "m", root, seeds=seeds, max_depth=5, selector="article", size=50, overlap=5)
    got = {(r.seed_pos, r.page_id): (r.doc_tokens, r.chunk_tokens) for r in counts.collect()}
    assert set(got) == {(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (None, None)}    # 4 is outside, 5 not reachable, repeats stay
    assert got[None, None][0] == sum(v[0] for k, v in got.items() if k[1] is not None)
    store = spark.read.parquet(f"{root}/m/vectorstore/m_vectorstore.parquet")
    assert sorted(store.select(F.shiftright("chunk_id", 31).alias("d")).toPandas().d) == [0, 1, 2, 3, 4]
    assert sorted(store.select("metadata.source").toPandas().source) == sorted(2 * ["https://d.io/docs/a/", "https://d.io/docs/a/b.html"] + ["https://d.io/docs/"])


def test_callers_own_extractor_length_and_tokenizer(spark):
    from quill.operators.chunk import split_recursive, split_windows
    from quill.operators.corpus import build_store
    pages, seeds = _site(spark)
    shout = lambda html: re.sub("<[^>]*>", " ", html).upper().strip()
    counts = build_store(spark, pages, "m", (root := _tmp()), seeds=seeds, extractor=shout, length=len, size=8, overlap=2)
    store = spark.read.parquet(f"{root}/m/vectorstore/m_vectorstore.parquet")
    texts = [r.text for r in store.collect()]
    assert all(t == t.upper() and len(t) <= 8 for t in texts) and any("GAMMA" in t for t in texts)
    assert {(r.seed_pos, r.page_id): r.doc_tokens for r in counts.collect()}[0, 1] == len("ALPHA BETA X  X")
    docs = spark.createDataFrame([(1, "abcdefgh"), (2, None), (3, "")], "doc_id long, text string")
    win = split_windows(docs, size=4, overlap=1, tokenizer=lambda t: [t[i:i + 2] for i in range(0, len(t), 2)], doc_tokens_col="n")
    assert [(r.doc_id, r.chunk_index, r.text, r.n_tokens, r.n) for r in win.collect()] == [(1, 0, "abcdefgh", 4, 4)]
    assert [(r.text, r.n_tokens) for r in split_recursive(docs, size=3, overlap=0, length=len).collect()] == [("abc", 3), ("def", 3), ("gh", 2)]
    rows = page_chunks(pages.filter("page_id = 1"), "m", extractor=lambda h: "one two three", tokenizer=lambda t: t.split(" ") if t else [], size=2, overlap=0)
    assert sorted(r.text for r in rows.collect()) == ["onetwo", "three"]


def test_store_catalogue_matches_duckdb_glob(spark):
    import duckdb
    root = _tmp()
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(5)
    for module in ("alpha", "beta"):
        ST.write_store(page_chunks(pages, module), ST.default_store_path(root, module), files_per_module=2)
    # a single-file store as the reference writes it
    os.makedirs(f"{root}/gamma/vectorstore")
    duckdb.sql(f"COPY (SELECT 1 AS x) TO '{root}/gamma/vectorstore/gamma_vectorstore.parquet' (FORMAT parquet)")
    got = {r.module: r.n_stores for r in ST.list_stores(spark, root).collect()}
    want = dict(duckdb.sql(f"""
        WITH f AS (SELECT regexp_extract(file, '^(.*?[.]parquet)(/|$)', 1) AS store FROM glob('{root}/**/*.parquet')),
        s AS (SELECT DISTINCT store, string_split(store, '/')[-3] AS module FROM f)
        SELECT module, count(*) FROM s GROUP BY ROLLUP (module)""").fetchall())
    assert got == want and got[None] == 3


def test_file_sources_match_duckdb_readers(spark):
    import duckdb
    root = _tmp()
    os.makedirs(f"{root}/rules/core-rules/deep")
    files = {"rules/a.mdc": "---\nx: 1\n---\nA", "rules/core-rules/b.mdc.md": "B body\n",
             "rules/core-rules/deep/c.mdc": "ç unicode\n\n", "rules/skip.txt": "no"}
    for rel, text in files.items():
        with open(f"{root}/{rel}", "w", encoding="utf-8") as f:
            f.write(text)
    got = {(r.path, r.content) for r in FS.read_rule_files(spark, f"{root}/rules").collect()}
    want = {(p.split(f"{root}/rules/", 1)[1], c) for p, c in duckdb.sql(
        f"SELECT filename, content FROM read_text('{root}/rules/**/*.mdc') UNION ALL "
        f"SELECT filename, content FROM read_text('{root}/rules/**/*.mdc.md')").fetchall()}
    assert got == want and len(got) == 3
    with open(f"{root}/qa.json", "w") as f:
        json.dump([{"question": f"q{i}", "answer": f"a{i}"} for i in range(7)], f, indent=2)
    qa = {(r.question, r.answer) for r in FS.read_qa(spark, f"{root}/qa.json").collect()}
    assert qa == set(duckdb.sql(f"SELECT question, answer FROM read_json('{root}/qa.json')").fetchall())
    paths = [f"{root}/{p}" for p in files]
    totals = {r.path: (r.chars, r.tokens) for r in FS.text_totals(spark, paths).collect()}
    duck = dict((p, (c, t)) for p, c, t in duckdb.sql(
        "SELECT filename, length(content), len(regexp_extract_all(content, '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_ \\t\\n\\x0B\\f\\r]'))"
        f" FROM read_text({paths!r})").fetchall())
    assert totals == duck

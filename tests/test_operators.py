"""Unit tests for the Python-side operators and the distributed scans."""

import regex
from pyspark.sql import Window
from pyspark.sql import functions as F

from quill.functions.text import TOKEN
from quill.operators import chunk as C
from quill.operators.extract import html_text
from quill.operators.ordinal import global_index
from quill.operators.scan import carry_forward


def test_html_text_selector_and_fallback():
    html = ("<html><head><title>T</title><style>p{}</style><script>var x='</p>';</script></head>"
            "<body><nav>menu</nav><article class='md-content__inner x'><h1>Head</h1><p>a &amp; b<br>c</p>"
            "</article><!-- note --><p>tail</body></html>")
    assert html_text(html) == "Head" + "a & bc"
    assert html_text(html, "section") == "TmenuHeada & bctail"
    assert html_text("<p>unclosed <b>bold", "article") == "unclosed bold"


def test_recursive_split_invariants():
    words = [f"w{i}" for i in range(700)]
    text = "\n\n".join(" ".join(words[i:i + 37]) for i in range(0, 700, 37))
    chunks = C.recursive_split(text, size=50, overlap=10)
    n = lambda s: len(regex.findall(TOKEN, s))
    assert all(n(c) <= 50 for c in chunks)
    seen = " ".join(chunks).split()
    assert set(seen) == set(text.split())          # no text lost
    for a, b in zip(chunks, chunks[1:]):           # neighbours share at most the overlap
        shared = set(a.split()) & set(b.split())
        assert len(shared) <= 10


def test_window_split_covers_text(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, ""), (3, "   ")], "doc_id long, text string")
    rows = C.split_windows(df, size=4, overlap=1).orderBy("doc_id", "chunk_index").collect()
    assert [r.text for r in rows] == ["a b c d", "d e f g", "g h i j"]
    assert all(r.n_tokens == 4 for r in rows)


def test_global_index_matches_row_number(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("k"))
    got = {r.k: r.idx for r in global_index(df, ["k"]).collect()}
    assert got == {k: k for k in range(1000)}


def test_carry_forward_matches_window(spark):
    df = spark.range(0, 3000, 1, 9).select(
        (F.col("id") % 3).alias("g"), F.col("id").alias("o"),
        F.when(F.col("id") % 17 == 0, F.col("id")).alias("v"))
    w = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = {(r.g, r.o): r.x for r in df.select("g", "o", F.last("v", True).over(w).alias("x")).collect()}
    got = {(r.g, r.o): r.v_ff for r in carry_forward(df.repartition(9), "g", "o", ["v"]).collect()}
    assert got == want


def test_changelog_render_update(spark):
    from quill.operators.changelog import render_text, render_update
    text = """# Changelog
Intro
## [Unreleased]
### Fixed
- b fix
### Added
- Zeta
## [1.0.0] - 2024-01-02
### Added
- old
[Unreleased]: https://x/compare/v1.0.0...HEAD
[1.0.0]: https://x/releases/tag/v1.0.0"""
    lines = spark.createDataFrame([("F", i, l) for i, l in enumerate(text.split("\n"))], "file string, line_no long, line string")
    new = spark.createDataFrame([("F", "Added", "- alpha", 1), ("F", "Fixed", "- b fix", 2), ("F", "Removed", "- gone", 3)],
                                "file string, section string, entry string, seq long")
    got = render_text(render_update(lines, new)).first().text
    want = """# Changelog
Intro

## [Unreleased]

### Fixed
- b fix

### Added
- alpha
- old
- Zeta


## [1.0.0] - 2024-01-02
### Added
- old
[Unreleased]: https://x/compare/v1.0.0...HEAD
[1.0.0]: https://x/releases/tag/v1.0.0
[Unreleased]: https://x/compare/v1.0.0...HEAD
[1.0.0]: https://x/releases/tag/v1.0.0"""
    assert got == want


def test_changelog_render_finalize(spark):
    from quill.operators.changelog import render_text, render_update
    text = """# Changelog
Intro
## [Unreleased]
### Fixed
- b fix
### Added
- Zeta
## [1.0.0] - 2024-01-02
### Added
- old
[Unreleased]: https://x/compare/v1.0.0...HEAD
[1.0.0]: https://x/releases/tag/v1.0.0"""
    lines = spark.createDataFrame([("F", i, l) for i, l in enumerate(text.split("\n"))], "file string, line_no long, line string")
    new = spark.createDataFrame([("F", "Added", "- alpha", 1)], "file string, section string, entry string, seq long")
    nv = spark.createDataFrame([("F", "1.0.1")], "file string, new_version string")
    got = render_text(render_update(lines, new, new_versions=nv, today="2024-02-03")).first().text
    repo = "https://example.com/project"
    want = f"""# Changelog
Intro

## [Unreleased]

## [1.0.1] - 2024-02-03

### Fixed
- b fix

### Added
- alpha
- old
- Zeta


- old
[Unreleased]: https://x/compare/v1.0.0...HEAD
[1.0.0]: https://x/releases/tag/v1.0.0
[Unreleased]: {repo}/compare/v1.0.1...HEAD
[1.0.0]: https://x/releases/tag/v1.0.0
[1.0.1]: {repo}/compare/v1.0.0...v1.0.1"""
    assert got == want


def test_changelog_finalize_copies_like_reference(spark):
    from quill.operators.changelog import render_text, render_update
    text = """## [Unreleased]
### Added
- new
## [2.0.0] - 2024-03-01
intro of 2.0
### Fixed
- f2
### Added
- a2
## [1.0.0] - 2024-01-01
### Changed
- c1
## [0.9.0]
note"""
    lines = spark.createDataFrame([("F", i, l) for i, l in enumerate(text.split("\n"))], "file string, line_no long, line string")
    new = spark.createDataFrame([], "file string, section string, entry string, seq long")
    nv = spark.createDataFrame([("F", "2.0.1")], "file string, new_version string")
    got = render_text(render_update(lines, new, new_versions=nv, today="2024-04-01")).first().text
    repo = "https://example.com/project"
    want = "\n".join(["", "## [Unreleased]", "", "## [2.0.1] - 2024-04-01", "", "### Added", "- a2", "- new", "", "",
                      "- f2", "### Added", "- a2", "", "## [1.0.0] - 2024-01-01", "- c1", "", "## [0.9.0]",
                      f"[Unreleased]: {repo}/compare/v2.0.1...HEAD", f"[2.0.1]: {repo}/releases/tag/v2.0.1"])
    assert got == want


def test_load_pages_module_checks_and_dedupe(spark):
    import pytest
    from quill.sources import pages as PG
    pages = spark.createDataFrame([(1, "https://h.io/docs/a.html"), (2, "https://h.io/docs/sub/b.html?x=1"),
                                   (3, "https://other.io/docs/c.html")], "page_id long, url string")
    seeds = spark.createDataFrame([("m", 0, "https://h.io/docs/"), ("m", 1, "https://h.io/docs/sub/")],
                                  "module string, seed_pos int, seed_url string")
    rows = PG.load_pages(pages, seeds, module="m").select("page_id").collect()
    assert sorted(r.page_id for r in rows) == [1, 2, 2]            # overlapping seeds repeat a page
    assert PG.load_pages(pages, seeds, module="m", dedupe=True).count() == 2
    with pytest.raises(ValueError, match="Module 'nope' not found"):
        PG.load_pages(pages, seeds, module="nope", known_modules=["m"])
    with pytest.raises(ValueError, match="Available modules"):
        PG.check_module("nope")


def test_traverse_same_host_and_depth(spark):
    from quill.operators.links import traverse
    e = spark.createDataFrame([("http://a/1", "http://a/2"), ("http://a/2", "http://b/3"), ("http://a/2", "http://a/4"),
                               ("http://a/4", "http://a/5"), ("http://a/1", "http://a/4")], "src string, dst string")
    seeds = spark.createDataFrame([("http://a/1",)], "node string")
    got = {r.node: r.depth for r in traverse(e, seeds, 5, same_host=True).collect()}
    assert got == {"http://a/1": 0, "http://a/2": 1, "http://a/4": 1, "http://a/5": 2}
    got2 = {r.node: r.depth for r in traverse(e, seeds, 1).collect()}
    assert got2 == {"http://a/1": 0, "http://a/2": 1, "http://a/4": 1}


def test_previous_version_numeric_and_lexical(spark):
    from quill.operators.changelog import previous_versions
    v = spark.createDataFrame([("F", "0.9.0"), ("F", "0.10.0"), ("F", "0.10.0.dev1"), ("F", "Unreleased")],
                              "file string, version string")
    num = {r.version: r.previous for r in previous_versions(v).collect()}
    assert num == {"0.9.0": None, "0.10.0.dev1": "0.9.0", "0.10.0": "0.10.0.dev1"}
    lex = {r.version: r.previous for r in previous_versions(v, lexical=True).collect()}
    assert lex == {"0.10.0": None, "0.10.0.dev1": "0.10.0", "0.9.0": "0.10.0.dev1"}


def test_orders_l1_l2_l3(spark):
    from quill.operators.changelog import link_order, sort_entries
    from quill.operators.ownership import authors_ranked
    counts = spark.createDataFrame([(None, "b", 5), (None, "a", 5), (None, "c", 9), ("f.py", "c", 9)],
                                   "file string, author string, lines long")
    assert [r.author for r in authors_ranked(counts).collect()] == ["c", "a", "b"]
    ents = spark.createDataFrame([("S", "- beta", 0), ("S", "- Alpha", 1), ("S", "- alpha", 2)],
                                 "section string, entry string, pos int")
    assert [r.entry for r in sort_entries(ents, ["section"], "pos").collect()] == ["- Alpha", "- alpha", "- beta"]
    links = spark.createDataFrame([("1.0.0",), ("Unreleased",), ("0.9.0",)], "link_version string")
    assert [r.link_version for r in link_order(links).collect()] == ["Unreleased", "0.9.0", "1.0.0"]


def test_recursive_split_known_outputs(spark):
    assert C.recursive_split("a b c d e f g h", size=4, overlap=2) == ["a b c d", "c d e f", "e f g h"]
    assert C.recursive_split("a b c\n\nd e f\n\ng h", size=4, overlap=1) == ["a b c", "d e f", "g h"]
    df = spark.createDataFrame([(1, "m", "a b c d e f g h"), (2, "m", "   ")], "doc_id long, module string, text string")
    rows = C.split_recursive(df, size=4, overlap=2).orderBy("doc_id", "chunk_index").collect()
    assert [(r.doc_id, r.chunk_index, r.text, r.n_tokens, r.module) for r in rows] == [
        (1, 0, "a b c d", 4, "m"), (1, 1, "c d e f", 4, "m"), (1, 2, "e f g h", 4, "m")]


def test_unreleased_entries_legacy_and_strict(spark):
    from quill.operators.changelog import unreleased_entries
    text = ["## [Unreleased]", "### Added", "- new", "## [1.0.0]", "### Fixed", "- old fix"]
    lines = spark.createDataFrame([("F", i, l) for i, l in enumerate(text)], "file string, line_no long, line string")
    legacy = sorted((r.section, r.entry) for r in unreleased_entries(lines).collect())
    strict = sorted((r.section, r.entry) for r in unreleased_entries(lines, legacy=False).collect())
    assert legacy == [("Added", "- new"), ("Fixed", "- old fix")]      # the reference's never-cleared flag
    assert strict == [("Added", "- new")]


def test_changelog_fallback_puts_blank_lines_before_versions(spark):
    """No released version after the Unreleased heading: everything from the first release on
    is copied, a blank line before a version heading that follows a section."""
    from quill.operators.changelog import render_text, render_update
    lines = ["# Log", "## [2.0.0]", "## [1.9.0]", "### Added", "- a", "## [1.8.0]", "text", "## [1.7.0]", "### Fixed", "## [Unreleased]", "### Added", "- new"]
    df = spark.createDataFrame([("f", i, l) for i, l in enumerate(lines)], "file string, line_no long, line string")
    none = spark.createDataFrame([], "file string, section string, entry string, seq long")
    got = render_text(render_update(df, none)).first().text.split("\n")
    assert got == ["# Log", "", "## [Unreleased]", "", "### Added", "- new", "", "",
                   "## [2.0.0]", "## [1.9.0]", "### Added", "- a", "", "## [1.8.0]", "text", "## [1.7.0]", "### Fixed", "", "## [Unreleased]", "### Added", "- new"]


def test_ordered_scan_matches_pandas(spark):
    """Few and many partitions, groups over several of them, nulls in groups and values."""
    import random

    import pandas as pd

    from quill.operators.scan import BEFORE, LAST, ROW_BEFORE, ordered_scan
    rng = random.Random(5)
    rows = [(g, i, rng.choice([None, None, f"v{i}"]), rng.choice([None, i])) for g, n in (("a", 300), ("b", 1), (None, 40), ("c", 2), ("d", 500)) for i in range(n)]
    rows += [("empty", i, None, None) for i in range(60)]
    rng.shuffle(rows)
    want = pd.DataFrame(rows, columns=["g", "i", "s", "n"], dtype=object)
    want["g"] = want["g"].fillna("~")
    want = want.sort_values(["g", "i"])
    by = want.groupby("g")
    want["last"], want["row"] = by["s"].ffill(), by["n"].shift()
    want["before"] = want.groupby("g")["last"].shift()
    want = sorted(tuple(None if pd.isna(x) else x for x in r) for r in want[["g", "i", "last", "before", "row"]].itertuples(index=False))
    df = spark.createDataFrame(rows, "g string, i int, s string, n int").repartition(7)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, batch in ((1, 10000), (11, 10000), (40, 7)):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            got = ordered_scan(df, "g", ["i"], {"last": ("s", LAST), "before": ("s", BEFORE), "row": ("n", ROW_BEFORE)})
            assert sorted((r.g or "~", r.i, r["last"], r.before, r.row) for r in got.collect()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert ordered_scan(df.limit(0), "g", ["i"], {"last": ("s", LAST)}).count() == 0


def test_ordinals_of_equal_keys(spark):
    from quill.operators.ordinal import global_index
    df = spark.createDataFrame([(k, p) for p, k in enumerate(["b", "a", None, "b", "c", "b"])], "k string, p int")
    got = {r.p: r.i for r in global_index(df, ["k"], "i").collect()}
    assert got[2] == 0 and got[1] == 1 and got[4] == 5 and {got[0], got[3], got[5]} == {2, 3, 4}
    assert global_index(df.limit(0), ["k"], "i").count() == 0


def test_version_parse_and_bump(spark):
    from pyspark.sql import functions as F
    from quill.operators.changelog import bump_version, parse_version, version_key
    rows = [("1.2.3", "1.2.4.dev0", None), ("1.2.3.dev", "1.2.3.dev1", "0"), ("1.2.3.DEV4", "1.2.3.DEV5", "4"), ("1.2.3.rc1", "1.2.3.rc2", "1"), ("bad", None, None),
            ("1.2.3.dev99999999999", "1.2.3.dev100000000000", "99999999999"), ("1.2.99999999999", "1.2.100000000000.dev0", None),
            ("01.002.0009", "1.2.10.dev0", None), ("1.2.000", "1.2.1.dev0", None), ("1.2.1999", "1.2.2000.dev0", None), ("1.2." + "9" * 60, "1.2.1" + "0" * 60 + ".dev0", None)]
    df = spark.createDataFrame([r[:1] for r in rows], "v string")
    got = [tuple(r) for r in df.select("v", bump_version(F.col("v")), parse_version(F.col("v"))["num"]).collect()]
    assert got == rows
    order = ["0.9.0", "0.10.0.dev2", "0.10.0.dev10", "0.10.0", "9.0.0", "10.0.0.rc", "10.0.0.rc99999999999", "10.0.0", "10.0.99999999999"]
    df = spark.createDataFrame([(v,) for v in reversed(order)], "v string")
    assert [r.v for r in df.orderBy(version_key(F.col("v"))).collect()] == order


def test_bpe_token_counts(spark):
    import tempfile

    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    from quill.operators.tokens import count_tokens_bpe
    tok = Tokenizer(models.BPE(unk_token="[UNK]"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    tok.train_from_iterator(["the cat sat on the mat", "the dog sat"] * 20,
                            trainers.BpeTrainer(vocab_size=60, special_tokens=["[UNK]"]))
    path = tempfile.mkdtemp(prefix="quill-bpe-") + "/tokenizer.json"
    tok.save(path)
    df = spark.createDataFrame([(1, "the cat sat"), (2, None), (3, "the mat on the dog")], "i int, text string")
    got = {r.i: r.n for r in df.select("i", count_tokens_bpe("text", path).alias("n")).collect()}
    assert got == {1: len(tok.encode("the cat sat").ids), 2: 0, 3: len(tok.encode("the mat on the dog").ids)}
    # the same tokenizer drives the splitter (one tokenizer for splitting and counting)
    long = spark.createDataFrame([(1, " ".join(["the cat sat on the mat"] * 30))], "i int, text string")
    chunks = C.split_recursive(long, size=20, overlap=5, tokenizer_file=path).collect()
    assert len(chunks) > 1 and all(r.n_tokens <= 20 for r in chunks)
    assert all(r.n_tokens == len(tok.encode(r.text).ids) for r in chunks)


def test_box_answers_follow_float_semantics(spark):
    from quill.operators.answers import with_box
    answers = [
        (1, 'ok {"xmin": 10, "ymin": 20, "xmax": 30, "ymax": 40} end'),
        (2, '{"xmin": "10", "ymin": " 20 ", "xmax": 30.5, "ymax": [40]}'),      # float() accepts numeric text
        (3, '{"xmin": "ten", "ymin": 20, "xmax": 30, "ymax": 40}'),            # ValueError: failure, no regex
        (4, '{"xmin": null, "ymin": 20, "xmax": 30, "ymax": 40}'),             # TypeError: failure
        (5, '{"xmin": 10, "ymin": 20, "xmax": 30, "ymax": 40,}'),              # malformed: regex fallback
        (6, '{"xmin": 10, "ymin": 20}'),                                        # missing keys: failure
    ]
    df = spark.createDataFrame(answers, "i int, answer string")
    got = {r.i: (None if r.box is None else (r.box.xmin, r.box.ymin, r.box.xmax, r.box.ymax, r.box.method))
           for r in with_box(df, "answer").collect()}
    assert got == {1: (10.0, 20.0, 30.0, 40.0, "json"), 2: (10.0, 20.0, 30.5, 40.0, "json"), 3: None, 4: None,
                   5: (10.0, 20.0, 30.0, 40.0, "regex"), 6: None}


def test_page_links_resolve_like_a_browser(spark):
    from quill.operators.links import page_links
    html = " ".join(f'<a href="{h}">x</a>' for h in (
        "../x.html", "./y.html", "?p=2", "/r/./s/../t", "//o.org/z", "https://q.org/", "../../../up", "sub/..", "n.html?a=../b"))
    pages = spark.createDataFrame([("http://h.org/a/b/c.html?k=1", html), ("http://h.org", '<a href="d">x</a>')], "url string, html string")
    got = {r.dst for r in page_links(pages).collect()}
    assert got == {"http://h.org/a/x.html", "http://h.org/a/b/y.html", "http://h.org/a/b/c.html?p=2", "http://h.org/r/t",
                   "http://o.org/z", "https://q.org/", "http://h.org/up", "http://h.org/a/b/", "http://h.org/a/b/n.html?a=../b",
                   "http://h.org/d"}


def test_crawl_ignores_fragments(spark):
    from quill.operators.corpus import crawl
    pages = spark.createDataFrame([(1, "http://h.org/a/i.html#top", '<a href="../a/j.html">x</a>'), (2, "http://h.org/a/j.html#s", "")],
                                  "page_id long, url string, html string")
    seeds = spark.createDataFrame([("http://h.org/a/i.html",), ("http://h.org/a/",)], "seed_url string")
    assert sorted(r.page_id for r in crawl(pages, seeds).collect()) == [1, 2]


def test_next_versions_keep_the_tag(spark):
    from quill.plans.q_changelog import next_versions
    rows = [("a", "version", "1.2.3.dev1"), ("a", "version", "1.2.2"), ("b", "version", "1.2.3"), ("b", "version", "1.2.3.dev4"),
            ("c", "version", "Unreleased"), ("d", "version", "1.2.99999999999")]
    got = {r.file: r.new_version for r in next_versions(spark.createDataFrame(rows, "file string, kind string, version string")).collect()}
    assert got["a"] == "1.2.3.dev2" and got["b"] == "1.2.4.dev0" and got["c"] == "0.0.0.dev0"


def test_global_index_numbers_without_gaps(spark):
    from quill.operators.ordinal import global_index
    rows = global_index(spark.range(0, 5000, 1, 7).selectExpr("(id * 7919) % 5000 as k"), ["k"], "i").collect()
    assert all(r.k == r.i for r in rows) and len(rows) == 5000

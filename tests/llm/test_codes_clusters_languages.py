"""Vector codes, centroid clusters and language ids: against SQL, brute force and on odd rows."""

import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import regex

from quill.llm import gridcodes, langid, queries, simplex, vectors

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings")


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_language_id", "op13_centroid_clusters"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    rel = con.execute(queries.SQL[name])
    at = [[d[0] for d in rel.description].index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=str)


def integers(rows, scale):
    return [(*r[:-1], [int(np.floor(float(e) * scale)) for e in r[-1]]) for r in rows
            if r[-1] and all(e is not None and np.isfinite(e) for e in r[-1])]


def square(a, b):
    return sum((p - q) ** 2 for p, q in zip(a, b))


def moved(points, owner, old):
    own = [p for p, o in zip(points, owner) if o == old[0]]
    return [sum(c) // len(own) for c in zip(*own)] if own else old[1]


def plain_codes(rows, parts, entries, rounds, scale=256):
    rows = sorted(integers(rows, scale), key=lambda r: (r[0] is None, r[0], r[2]))
    w = len(rows[0][2]) // parts
    cut = [[v[p * w:p * w + w] for _, _, v in rows] for p in range(parts)]
    books = [c[:entries] for c in cut]
    for i in range(rounds + 1):
        owner = [[min(range(len(b)), key=lambda e: (square(x, b[e]), e)) for x in c] for c, b in zip(cut, books)]
        if i < rounds:
            books = [[moved(c, o, (e, old)) for e, old in enumerate(b)] for c, o, b in zip(cut, owner, books)]
    error = [sum(square(cut[p][i], books[p][owner[p][i]]) for p in range(parts)) for i in range(len(rows))]
    label = Counter()
    for r, e in zip(rows, error):
        label[r[1]] += e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted([(r[0], "".join(f"{owner[p][i]:02x}" for p in range(parts)), error[i], label[r[1]], digest) for i, r in enumerate(rows)], key=str)


def vector_rows(n, length, seed=2):
    rng = np.random.default_rng(seed)
    rows = [(int(i) - 5, int(rng.integers(3)) if i % 7 else None, rng.normal(0, 3, length).round(2).tolist()) for i in range(n)]
    rows += [rows[-2], rows[-2], (rows[-1][0], 1, [0.0] * length), (None, None, [0.5] * length), (None, 2, [-0.5] * length)]
    rows += [(900, 1, None), (901, 1, []), (902, 1, [float("nan")] * length), (903, None, [float("-inf")] + [0.0] * (length - 1)), (904, 0, [None] + [0.0] * (length - 1))]
    return rows


SCHEMA = "vec_id long, label int, embedding array<double>, code string, cluster int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA)


def test_codes_odd_rows(spark):
    for n, entries in ((60, 8), (3, 64)):
        rows = vector_rows(n, 8)
        got = gridcodes.codes(frame(spark, rows).repartition(3), parts=4, entries=entries, rounds=2)
        assert sorted(map(tuple, got.collect()), key=str) == plain_codes(rows, 4, entries, 2)
    assert gridcodes.codes(frame(spark, rows).limit(0)).collect() == []
    assert gridcodes.codes(frame(spark, [(1, 1, None)])).count() == 0
    assert gridcodes.codes(frame(spark, [(1, 1, [1.0] * 6)])).count() == 0
    mixed = [(i, i % 2, v) for i, (_, _, v) in enumerate(vector_rows(20, 8) + vector_rows(9, 12, seed=5) + vector_rows(4, 7))]
    got = gridcodes.codes(frame(spark, mixed), parts=4, entries=5, rounds=2).collect()
    own = [plain_codes([r for r in mixed if r[2] and len(r[2]) == n], 4, 5, 2) for n in (8, 12)]
    assert sorted((r.vec_id, r.code, r.error, r.codebooks_sha256) for r in got) == sorted((r[0], r[1], r[2], r[4]) for rows in own for r in rows)
    label = dict((r[0], r[1]) for r in mixed)
    for r in got:
        assert r.label_error == sum(x.error for x in got if label[x.vec_id] == label[r.vec_id])
    with pytest.raises(Exception, match="too large"):
        gridcodes.codes(frame(spark, [(1, 1, [1e300] * 16)])).collect()


def test_grid_cells_are_exact_and_reused():
    rng = np.random.default_rng(0)
    book = rng.integers(-500, 500, (64, 4))
    x = np.concatenate([rng.integers(-600, 600, (4000, 4)), np.repeat(book, 3, axis=0), [[10**6, -(10**6), 0, 5]]])
    d = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    grid = gridcodes.Grid(book)
    entry, error = grid.nearest(x)
    assert (entry == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all()
    cells = len(grid.memo)
    assert cells < len(x) and grid.nearest(x)[0].tolist() == entry.tolist() and len(grid.memo) == cells
    assert len(grid.entries) < 0.5 * cells * len(book)
    same = gridcodes.Grid(np.zeros((5, 4), int))  # all entries tie
    assert same.nearest(x)[0].max() == 0


def test_grid_starts_anew(monkeypatch):
    monkeypatch.setattr(gridcodes, "CELLS", 50)
    monkeypatch.setattr(gridcodes, "STEP", 300)
    rng = np.random.default_rng(1)
    book = rng.integers(-50, 50, (9, 3))
    grid = gridcodes.Grid(book)
    for _ in range(5):
        x = rng.integers(-60, 60, (200, 3))
        assert (grid.nearest(x)[0] == ((x[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


def plain_clusters(rows, k, rounds, length, scale=1024, seed=3):
    rows = [r for r in integers(rows, scale) if len(r[2]) == length]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows.sort(key=lambda r: (r[0] is None, r[0] is not None and digest(f"{seed}:{r[0]}"), r[2]))
    points = [r[2] for r in rows]
    centres = points[:k]
    for i in range(rounds + 1):
        owner = [min(range(len(centres)), key=lambda c: (square(p, centres[c]), c)) for p in points]
        if i < rounds:
            centres = [moved(points, owner, x) for x in enumerate(centres)]
    d = [square(p, centres[o]) for p, o in zip(points, owner)]
    own = Counter()
    for o, e in zip(owner, d):
        own[o] += e
    return sorted([(r[0], o, e, own[o], sum(d), digest(",".join(map(str, centres[o])))) for r, o, e in zip(rows, owner, d)], key=str)


def test_clusters_odd_rows(spark):
    for n, length, k in ((70, 6, 4), (2, 6, 8), (40, 1, 3)):
        rows = vector_rows(n, length) + [(77, 1, [1.0] * (length + 1)), (78, 1, [9.0])]
        got = simplex.cluster(frame(spark, rows).repartition(3), k=k, rounds=5, length=length)
        assert sorted(map(tuple, got.collect()), key=str) == plain_clusters(rows, k, 5, length)
    equal = [(i, 0, [0.25] * 4) for i in range(9)]  # one point: no base, all ties
    assert sorted(map(tuple, simplex.cluster(frame(spark, equal), k=3, length=4).collect()), key=str) == plain_clusters(equal, 3, 10, 4)
    assert simplex.cluster(frame(spark, equal).limit(0)).collect() == []
    with pytest.raises(Exception, match="too large"):
        simplex.cluster(frame(spark, [(1, 1, [1e12] * 4)]), length=4).collect()


def test_simplex_bounds_hold_and_filter():
    rng = np.random.default_rng(4)
    centres = rng.integers(-3000, 3000, (8, 64))
    x = centres[rng.integers(0, 8, 3000)] + rng.integers(-40, 40, (3000, 64))
    simplex_base = simplex.base(x[:512])
    for points in (x, rng.integers(-10**6, 10**6, (500, 64)), np.repeat(x[:3], 4, axis=0)):
        a, b = simplex_base.apex(points), simplex_base.apex(centres)
        low, high = simplex.bounds(a, b)
        d = np.sqrt(((points[:, None] - centres[None]) ** 2).sum(axis=2))
        assert (low <= d).all() and (d <= high).all()
        for all_distances in (True, False):
            assert (simplex.nearest(points, a, centres, b, all_distances)[0] == d.argmin(axis=1)).all()
    low, high = simplex.bounds(simplex_base.apex(x), simplex_base.apex(centres))
    assert (low <= high.min(axis=1)[:, None]).mean() < 0.3


def test_limits_keep_distances_in_64_bits():
    for length in (1, 64, 4096):
        for numbers in (1, 256):
            assert numbers * length * (2 * vectors.limit(length, numbers)) ** 2 <= 2**62


def plain_words(text):
    return [f" {w} " for w in regex.findall(r"\p{L}[\p{L}\p{M}]*", text.lower())]


def plain_grams(word):
    return [word[i:i + n] for n in range(1, 5) for i in range(len(word) - n + 1) if word[i:i + n] != " "]


def plain_languages(rows, folds=4, out=2, size=langid.PROFILE):
    held = [d is not None and zlib.crc32(str(d).encode()) % folds == out for d, _, _ in rows]
    found = [Counter(g for w in plain_words(t or "") for g in plain_grams(w)) for _, t, _ in rows]
    total = {}
    for h, (_, _, lang), c in zip(held, rows, found):
        if not h and lang is not None and c:
            total.setdefault(lang, Counter()).update(c)
    ranks = {lang: {g: i + 1 for i, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:size])} for lang, c in total.items()}
    res = []
    for h, (d, _, _), c in zip(held, rows, found):
        place = {g: 1 + sum(m > n for m in c.values()) for g, n in c.items()} if len(c) < 300 else \
            {g: 1 + len(c) - np.searchsorted(np.sort(list(c.values())), n, side="right") for g, n in c.items()}
        far = sorted((sum(abs(r - p[g]) if g in p else size for g, r in place.items() if r <= size), lang) for lang, p in ranks.items()) if c else []
        if not far:
            res.append((d, h, "und", 0.0))
        else:
            a, b = far[0][0], far[1][0] if len(far) > 1 else None
            res.append((d, h, far[0][1], 1.0 if b is None else 0.5 if a + b == 0 else b / (a + b)))
    return sorted(res, key=str)


LANGUAGE_ROWS = [(1, "the cat and the dog and the bird", "en"), (2, "le chat et le chien et les oiseaux", "fr"), (3, "der Hund und die Katze", "de"),
                 (3, "der Hund und die Katze", "de"), (4, None, "en"), (5, "", "en"), (6, " 12 _ ²³ !?\n", None), (7, "the dog", None), (None, "und die Katze", "de"),
                 (8, "ÉTÉ é́té İstanbul ǅ 한국어 हिन्दी", "fr"), (9, "der" * 60_000, None), (10, "die Katze " * 20_000, "de"), (11, "qqq", None), (12, "zz", ""),
                 (13, "1234", "digits"), (14, "the the the", "en")]


def test_languages_odd_rows(spark, monkeypatch):
    rows = [(d, t, lang, 0.5, "x") for d, t, lang in LANGUAGE_ROWS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, lang_pred string")
    want = plain_languages(LANGUAGE_ROWS)
    assert sorted(map(tuple, langid.identify(docs.repartition(3)).collect()), key=str) == want
    assert langid.identify(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", docs.lang.substr(9, 1)).filter("doc_id > 5")).collect()} <= {"und", ""}
    monkeypatch.setattr(langid, "LANGUAGES", 1)  # one scan a language
    assert sorted(map(tuple, langid.identify(docs).collect()), key=str) == want


def test_ngrams_of_a_text():
    for _, text, _ in LANGUAGE_ROWS:
        if text is not None and len(text) < 1000:
            codes = langid.framed(text)
            want = Counter(g for w in plain_words(text) for g in plain_grams(w))
            assert dict(langid._Grams().counts(codes)) == want
            assert sorted(langid._key(g) for g in want) == sorted(k for _, _, keys in langid.windows(codes) for k in set(keys.tolist()))
    assert len(set(langid._classes().tolist())) == 3


def test_language_counts_do_not_depend_on_steps(monkeypatch):
    rows = [(lang, t) for _, t, lang in LANGUAGE_ROWS if lang and t and len(t) < 1000] * 3
    batches = [pa.RecordBatch.from_pydict({"lang": [r[0] for r in part], "text": [r[1] for r in part]}) for part in (rows[:4], rows[4:5], [], rows[5:]) if part]

    def total():
        out = Counter()
        for b in langid._count(iter(batches)):
            for row in b.to_pylist():
                out[row["lang"], row["gram"]] += row["n"]
        return out

    want = total()
    for step, kept in ((1, 1), (5, 10**6), (10**6, 3), (40, 100)):
        monkeypatch.setattr(langid, "STEP", step)
        monkeypatch.setattr(langid, "GRAMS_KEPT", kept)
        assert total() == want


def test_language_held_out_accuracy(spark):
    found = langid.identify(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").toPandas()
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = found.merge(lang.drop_duplicates("doc_id"), on="doc_id")
    assert (both.lang == both.lang_pred).mean() > 0.97 and both.score.between(0, 1).all()

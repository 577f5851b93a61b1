"""Fingerprints, whitening and ranked search against brute force; their defined cases."""

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.llm import bloom_search, queries, sketch, whitening

DOCS = "doc_id long, text string, id int, k string, score long, item int"


def doc_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in rows], DOCS)


def prose(rnd, n, vocabulary=60):
    words = [f"w{j}" for j in range(vocabulary)] + ["Übung", "naïve", "Ab", "日本"]
    return rnd.choice([" ", "\n"]).join(rnd.choice(words) for _ in range(n))


# --- fingerprints -----------------------------------------------------------------------------------------------

def md5(text):
    return hashlib.md5(text.encode()).hexdigest()[:16]


def mark_brute(text, size=5, fraction=1 / 8):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    grams = [" ".join(ws[i:i + size]) for i in range(len(ws) - size + 1)] if len(ws) >= size else ([" ".join(ws)] if ws else [])
    return md5(" ".join(ws)), {h for h in map(md5, grams) if int(h, 16) < fraction * 2 ** 64}


def like_brute(a, b):
    if a[0] == b[0]:
        return 1.0
    return len(a[1] & b[1]) / len(a[1] | b[1]) if a[1] | b[1] else 0.0


def fingerprints_brute(rows):
    def key(r):
        return hashlib.sha256(f"{'null' if r[0] is None else r[0]}:{r[1] or ''}".encode()).digest()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), key(r)))
    out = Counter()
    for at, (i, t) in enumerate(order):
        t, follower = t or "", order[(at + 1) % len(order)][1] or ""
        cut = len(t) // 3
        edited = t[:len(t) - cut] + follower[:cut]
        a, b, c = mark_brute(t), mark_brute(edited), mark_brute(follower)
        out[(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a[0] + ":" + "".join(sorted(a[1])),
             b[0] + ":" + "".join(sorted(b[1])), round(like_brute(a, b), 9), round(like_brute(a, c), 9))] += 1
    return out


def told(df):
    return Counter((r.id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
                   for r in df.collect())


def sketch_rows(seed):
    rnd = random.Random(seed)
    rows = [(i, prose(rnd, rnd.choice([0, 1, 3, 5, 6, 40, 300]))) for i in rnd.sample(range(-50, 5000), 60)]
    same = prose(rnd, 100)
    rows += [(6000, same)] * 5 + [(6001, same), (6001, "other text of one id"), (None, same), (None, None), (None, None), (7, None)]
    return rows + [(2 ** 63 - 1, "a " * 50), (-2 ** 63, "\n\t "), (8000, "".join(f"{i} " for i in range(60_000)))]


@pytest.mark.parametrize("seed,repeat", [(1, 1 << 16), (2, 2)])
def test_fingerprints_against_brute_force(spark, monkeypatch, seed, repeat):
    monkeypatch.setattr(sketch, "REPEAT", repeat)
    rows = sketch_rows(seed)
    got = sketch.fingerprints(doc_frame(spark, rows).repartition(5))
    assert told(got) == fingerprints_brute(rows)


@pytest.mark.parametrize("rows", [[], [(4, "one two three four five six")], [(4, None)], [(None, "a b"), (None, "a b"), (None, "a b")]])
def test_fingerprints_of_few_rows(spark, rows):
    assert told(sketch.fingerprints(doc_frame(spark, rows))) == fingerprints_brute(rows)


def test_sketches_merge_and_estimate_containment(spark):
    from pyspark.sql import functions as F
    rnd = random.Random(5)
    small = [f"s{i}" for i in range(400)]
    rows = [(1, " ".join(small)), (2, " ".join(small[:200] + [f"b{rnd.random()}" for _ in range(20_000)])), (3, " ".join(small[:204]))]
    marks = doc_frame(spark, rows).select("doc_id", sketch.fingerprint(F.col("text"))["kept"].alias("kept"))
    a, b = (marks.where(f"doc_id = {i}").select(F.col("kept").alias(f"k{i}")) for i in (1, 2))
    share = a.join(b, F.lit(True)).select(sketch.containment(F.col("k1"), F.col("k2"))).first()[0]
    assert abs(share - 196 / 396) < 0.2  # a quarter of a percent of the large document is shared, half of the small one
    merged = marks.agg(sketch.merge(F.col("kept")).alias("m")).first().m
    assert set(merged) == set().union(*[mark_brute(t)[1] for _, t in rows])


def test_fingerprints_run_no_python(spark):
    plan = sketch.fingerprints(doc_frame(spark, [(1, "a"), (2, "b")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- whitening --------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, id int, key string, x int, rows int"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "k", 5, 6) for i, v in rows], VECTORS)


def whiten_brute(rows, components, distinct=False):
    good = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good}) if distinct else [x for _, x in good]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = values.sum()
    out = []
    for i, x in good:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        w = (np.array([(n * a - s) / n for a, s in zip(x, sums)]) @ vectors)
        out += [(i, k + 1, n, deviation, w[k] / math.sqrt(values[k]), values[k] / trace) for k in range(components)]
    return out


def vector_rows(seed, n=200, d=6):
    rnd = random.Random(seed)
    rows = [(i, [rnd.gauss(j, 1 + j) for j in range(d)]) for i in range(n)]
    rows += [(n + i, [0.5 * j for j in range(d)]) for i in range(150)] + [(None, [1.0] * d), (3, [1.0] * d), (3, [1.0] * d)]
    return rows + [(900, None), (901, []), (902, [None] + [1.0] * (d - 1)), (903, [float("nan")] * d), (904, [float("-inf")] * d)]


@pytest.mark.parametrize("weights,share", [("counts", 1000), ("one", 1000), ("counts", 5)])
def test_whitening_against_brute_force(spark, monkeypatch, weights, share):
    monkeypatch.setattr(whitening, "HOT_SHARE", share)
    rows = vector_rows(4)
    got = whitening.whiten(vector_frame(spark, rows).repartition(5), components=4, weights=weights).collect()
    want = whiten_brute(rows, 4, weights == "one")
    assert len(got) == len(want)

    def key(r):
        return (r[1], r[0] is None, r[0] or 0, abs(round(r[4], 6)))
    got, want = sorted(((*r[:3], int(r[3]), *r[4:]) for r in got), key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for k in range(1, 5):
        a, b = (np.array([r[4] for r in part if r[1] == k]) for part in (got, want))
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9  # either sign, one for all rows
    assert max(abs(a[5] / b[5] - 1) for a, b in zip(got, want)) < 1e-9
    assert len({r[6] for r in got}) == 1 and got[0][6] < 1e-9


def test_whitening_large_sums_stay_exact():
    centre = whitening.Centre(3 * 10 ** 12, [3 * 10 ** 18 + 7])
    assert [int(v) for v in centre.numerators(np.array([[1_000_000 + 5 * 10 ** 6], [1_000_000]])).ravel()] == [15 * 10 ** 18 - 7, -7]
    assert centre.deviations(np.array([[1_000_000 + 5 * 10 ** 6]])) == [(15 * 10 ** 18 - 7) ** 2]
    assert whitening._weighted_sum(np.array([[2 ** 40]]), np.array([2 ** 40])) == [2 ** 80]


def test_whitening_without_variance(spark):
    assert whitening.whiten(vector_frame(spark, [])).collect() == []
    assert whitening.whiten(vector_frame(spark, [(1, [1.0, 2.0])] * 9)).collect() == []
    flat = whitening.whiten(vector_frame(spark, [(i, [float(i), float(i), 7.0]) for i in range(20)])).collect()
    assert {r.component for r in flat} == {1} and len(flat) == 20  # one direction carries all variance


def test_whitening_errors_say_what_is_wrong(spark):
    with pytest.raises(ValueError, match="from 2 to 3 components"):
        whitening.whiten(vector_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0])]))
    with pytest.raises(Exception, match="no exact grid value"):
        whitening.whiten(vector_frame(spark, [(1, [1e30, 2.0]), (2, [1.0, 2.0])]))


# --- ranked search ----------------------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def search_brute(items, docs, k):
    counted = [(i, terms(t)) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = Counter()
    for item, text in items:
        found = []
        for i, c, n in counted:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t, q in terms(text).items() if t in c)
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out.update((item, rank, i, -s) for rank, (s, _, i) in enumerate(found[:k], 1))
    return out


def search_rows(seed):
    rnd = random.Random(seed)
    docs = [(i, prose(rnd, rnd.choice([0, 2, 10, 60, 400]), 400)) for i in range(300)]
    same = prose(rnd, 30, 400)
    docs += [(1000 + i % 50, same) for i in range(80)] + [(None, same), (None, None), (5, ""), (6, " ,;-"), (7, "x" * 5000)]
    docs += [(2000, "A-B_c:Übung 日本語!9z\x00q " * 40)]
    items = [(i, prose(rnd, 12, 400)) for i in range(30)] + [(3, same), (40, None), (41, ""), (42, "nowhere"), (None, docs[7][1]), (43, docs[-1][1])]
    return items, docs


def item_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "item_id long, text string, score int, rank int")


@pytest.mark.parametrize("settings", [{}, {"BLOCK_DOCS": 16, "BUFFER_DOCS": 40, "ITEM_BLOCK": 7, "TERM_CHUNK": 9, "BITS_PER_TERM": 2, "PIECE": 13},
                                      {"BLOCK_BITS": 1 << 12, "MAX_WIDTH": 256, "LEVELS": (1,), "ITEM_TERMS": 20}])
def test_search_against_brute_force(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(bloom_search, name, value)
    items, docs = search_rows(3)
    tally = []
    got = bloom_search.search(item_frame(spark, items), doc_frame(spark, docs).repartition(4), k=5, tally=tally).collect()
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == search_brute(items, docs, 5)
    assert sum(t[1] for t in tally) < sum(t[0] for t in tally)  # some were provably excluded


def test_bounds_are_never_below_scores():
    items, docs = search_rows(9)
    block = bloom_search.Items([(i, bloom_search.term_counts(t)) for i, t in items if terms(t)])
    counted = [(len(c) * 2, i, c) for i, c in ((i, bloom_search.term_counts(t)) for i, t in docs) if c]
    df = Counter(t for _, _, c in counted for t in c)
    block.weigh(df, len(counted), sum(sum(c.values()) for _, _, c in counted))
    times, hashes = block.times(), bloom_search._Hashes()
    for record in bloom_search._blocks(counted, hashes):
        opened = bloom_search.Block(record, 0, block)
        bounds, scores = opened.bounds(times), opened.scores(np.arange(len(opened)), times)
        assert (bounds >= scores).all() and (bounds > scores).any()


def test_a_block_of_documents_needs_little_memory():
    rnd = random.Random(4)
    words = [f"w{i}".encode() for i in range(8192)]
    docs = [(len(c), i, c) for i, c in enumerate(Counter(words if i == 0 else rnd.sample(words, 2000)) for i in range(512))]
    items = bloom_search.Items([(i, Counter(words[i::8])) for i in range(8)])
    items.weigh({w: 1 for w in words}, len(docs), sum(n for n, _, _ in docs))
    times, hashes = items.times(), bloom_search._Hashes()
    for word in words:
        hashes[word]
    tracemalloc.start()
    record = next(bloom_search._blocks(list(docs), hashes))
    built = tracemalloc.get_traced_memory()[1]
    opened = bloom_search.Block(record, 0, items)
    tracemalloc.reset_peak()
    opened.scores(np.arange(len(opened)), times)
    scored = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert opened.width * len(opened) == bloom_search.BLOCK_BITS and built < 55e6 and scored < 60e6


def test_index_rows_reach_python_a_few_at_a_time(spark):
    names = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = [spark.conf.get(n) for n in names]
    with bloom_search._small_batches(spark, bloom_search.READ_ROWS):
        rows = spark.range(0, 400, 1, 1).select(F.col("id"), F.expr("repeat('x', 100000)").alias("t"))
        most = rows.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n long").agg(F.max("n")).first()[0]
    assert most <= 50
    assert [spark.conf.get(n) for n in names] == before


def test_terms_do_not_break_at_pieces(monkeypatch):
    text = "alpha Beta, gamma" + "日" * 50 + " delta9 " + "e" * 70 + "-zeta"
    want = {t.encode(): n for t, n in terms(text).items()}
    for piece in (1, 2, 7, 50, 1000):
        monkeypatch.setattr(bloom_search, "PIECE", piece)
        assert bloom_search.term_counts(text) == want


def test_search_few_rows_and_empty(spark):
    one = [(1, "alpha beta")]
    for items, docs in (([], one), (one, []), (one, [(4, None)]), (one, one), ([(1, "alpha")], [(1, "alpha"), (2, "alpha alpha"), (2, "alpha")])):
        got = bloom_search.search(item_frame(spark, items), doc_frame(spark, docs), k=20).collect()
        assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == search_brute(items, docs, 20)


def test_queries_keep_their_columns(spark):
    want = {"op11_fingerprints": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
                                  "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
            "op12_whitening": {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                               "explained": "double", "identity_error": "double"},
            "op13_ranked_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}}
    for name, columns in want.items():
        got = dict(queries.QUERIES[name][0](spark, "/root/testdata/sf0.001").dtypes)
        assert columns.items() <= got.items(), name

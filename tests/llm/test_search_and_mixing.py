"""Top-k search and source mixing against brute force; the pipeline's stages."""

import hashlib
import math
import os
import random
from collections import Counter

import numpy as np
import pytest

from starloom.llm import cover_tree, mixing

VECTORS = "vec_id long, embedding array<float>, score long, query_id long, cell int"


def top_brute(rows, k, pick):
    good = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(64 * float(np.float32(x))) for x in v]))
    out = Counter()
    for i, q in good:
        if not pick(i):
            continue
        found = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in good if j != i)
        out.update((i, n, j, -s) for n, (s, j) in enumerate(found[:k], 1))
    return out


def vectors(seed, n):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, [c + rnd.gauss(0, 0.1) for c in rnd.choice(centres)]) for i in range(n)]
    rows += [(n, None), (n + 1, [1.0, None] + [0.0] * 4), (n + 2, [float("nan")] * 6), (n + 3, [float("inf")] * 6), (None, [1.0] * 6),
             (n + 4, [1.0, 2.0]), (n + 5, [])]
    same = [0.5] * 6
    return rows + [(n + 10 + k, same) for k in range(60)]


@pytest.mark.parametrize("block,group,leaf", [(8192, 512, 128), (40, 8, 4)])
def test_top_k_against_brute_force(spark, monkeypatch, block, group, leaf):
    for name, value in (("BLOCK", block), ("GROUP", group), ("LEAF", leaf)):
        monkeypatch.setattr(cover_tree, name, value)
    rows = vectors(1, 300)
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], VECTORS).repartition(4)
    got = cover_tree.top_k(df, df.where("vec_id % 7 = 0"), k=5).collect()
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == top_brute(rows, 5, lambda i: i % 7 == 0)


@pytest.mark.parametrize("block", [8192, 40])
def test_top_k_with_repeated_ids(spark, monkeypatch, block):
    """Rows of the query's own id, with other and with equal vectors, take no place of a result."""
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    rnd = random.Random(8)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(100)]
    rows += [(7, [3.0 + rnd.random() for _ in range(4)]) for _ in range(9)]  # one id, different vectors that score best
    rows += [(i, [2.0] * 4) for i in [14] * 12 + [15] * 3 + list(range(200, 230))]  # a group of equal vectors with repeated ids
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], VECTORS).repartition(4)
    got = cover_tree.top_k(df, df.where("vec_id % 7 = 0"), k=5).collect()
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == top_brute(rows, 5, lambda i: i % 7 == 0)


def test_tree_covers_and_search_prunes(monkeypatch):
    monkeypatch.setattr(cover_tree, "LEAF", 8)
    rnd = np.random.default_rng(3)
    points = np.concatenate([rnd.normal(c * 100, 1.0, size=(200, 4)) for c in range(5)]).round()
    tree = cover_tree.CoverTree(np.unique(points, axis=0))
    for c, r, m in zip(tree.centre, tree.radius, tree.members):
        assert np.sqrt(((tree.points[m] - c) ** 2).sum(axis=1)).max() <= r + 1e-9
    seen = []
    real = cover_tree.inner
    monkeypatch.setattr(cover_tree, "inner", lambda a, b: seen.append(a.shape[0] * b.shape[0]) or real(a, b))
    queries = cover_tree.CoverTree(points[-20:])
    best = cover_tree.Best(np.arange(10_000, 10_020), 5)
    cover_tree.search(queries, tree, [np.array([k]) for k in range(len(tree.points))], best)
    assert sum(seen) < 0.5 * 20 * len(tree.points), "far nodes are skipped"
    want = np.sort(points[-20:] @ tree.points.T, axis=1)[:, ::-1][:, :5]
    assert [[-s for s, _ in b] for b in best.score] == want.tolist()


def test_large_components_stay_exact():
    a = np.array([[2.0 ** 40, 3.0]])
    assert cover_tree.inner(a, a)[0, 0] == 2 ** 80 + 9


def test_components_beyond_long_and_double_raise(spark):
    """A finite component takes part; a score or multiple that no type holds is an error that names it, not a dropped row."""
    small = [(i, [float(i), 1.0], 0, 0, 0) for i in range(30)]
    fits = spark.createDataFrame([*small, (40, [2.0 ** 25, 0.0], 0, 0, 0), (41, [2.0 ** 25, 0.0], 0, 0, 0)], VECTORS.replace("float", "double"))
    assert max(r.score for r in cover_tree.top_k(fits, fits).collect()) == 2 ** 62
    for value, said in ((1e30, "beyond a long"), (1e307, "beyond a double")):
        df = spark.createDataFrame([*small, (40, [value, 0.0], 0, 0, 0), (41, [value, 0.0], 0, 0, 0)], VECTORS.replace("float", "double"))
        with pytest.raises(Exception, match=said):
            cover_tree.top_k(df, df).collect()


def test_top_k_few_rows_and_empty(spark):
    two = spark.createDataFrame([(0, [1.0], 0, 0, 0), (20, [2.0], 0, 0, 0)], VECTORS)
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in cover_tree.top_k(two, two).collect()) == \
        Counter({(0, 1, 20, 8192): 1, (20, 1, 0, 8192): 1})
    none = spark.createDataFrame([], VECTORS)
    assert cover_tree.top_k(none, none).count() == 0


DOCS = "doc_id long, text string, source string, rate double, copies int, _u string, doc string"


def mix_brute(rows, weights=None):
    chars = Counter()
    for _, t, s in rows:
        chars[s] += max(len(t or ""), 1)
    w = {s: 1.0 if weights is None else weights.get(s, 0.0) for s in chars}
    total = sum(w.values())
    out = Counter()
    for i, t, s in rows:
        rate = w[s] / total * sum(chars.values()) / chars[s]
        u = int(hashlib.md5(f"{mixing.SEED}:{'null' if i is None else i}".encode()).hexdigest()[:13], 16) / (1 << 52)
        k, cum = 0, math.exp(-rate)
        while rate and cum <= u:
            k += 1
            cum += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        out[i, t, s] += k
    return +out


@pytest.mark.parametrize("weights", [None, {"a": 3.0, "c": 1.0}, {"zzz": 1.0}])
def test_mixing_against_brute_force(spark, weights):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, *range(500)]), rnd.choice([None, "", "x" * rnd.randrange(90)]), rnd.choice("aaab") if rnd.random() < 0.9 else rnd.choice(["c", None]))
            for _ in range(300)]
    df = spark.createDataFrame([(i, t, s, 0.1, 5, "u", "d") for i, t, s in rows], DOCS)
    out = mixing.mix(df, weights=weights)
    assert out.schema == df.schema
    want = mix_brute(rows, weights) if weights != {"zzz": 1.0} else Counter()
    assert Counter((r.doc_id, r.text, r.source) for r in out.collect()) == want


def test_mixing_reaches_the_target(spark):
    rows = [(i, "x" * 50, "big" if i % 10 else "small") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    n = Counter(r.source for r in mixing.mix(df).collect())
    assert abs(n["big"] / 2000 - 1) < 0.1 and abs(n["small"] / 2000 - 1) < 0.1


@pytest.mark.parametrize("rate", [1e-9, 0.3, 7.0, 150.0, 230.0, 900.5, 250_000.0, 3e9])
def test_poisson_tables(spark, rate):
    r = mixing.poisson_tables(spark.createDataFrame([("a", rate), (None, 1.0)], "_source string, rate double")).where("_source = 'a'").first()
    assert all(a <= b for a, b in zip(r._cdf, r._cdf[1:])) and abs(r._cdf[-1] - 1) < 1e-9
    for k in {0, int(rate), int(rate + 2 * rate ** 0.5) + 1} & set(range(r._low, r._low + 2000)) | {int(rate)}:
        below = r._cdf[k - r._low - 1] if k > r._low else 0.0
        want = math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        assert math.isclose(r._cdf[k - r._low] - below, want, rel_tol=1e-6 if rate < 1e6 else 1e-4)
    assert abs(r._cdf[int(rate) - r._low] - 0.5) < max(0.5 / (1 + rate) ** 0.5, 1e-4) + (0.5 if rate < 1 else 0.1)
    assert r._low == 0 or r._cdf[0] < 1e-25


def test_very_large_rates(spark, monkeypatch):
    """One character beside two million in another source: about a million copies, listed by several tasks."""
    df = spark.createDataFrame([(1, "x", "a"), (2, "y" * 2_000_000, "b")], "doc_id long, text string, source string")
    out = mixing.replicate(df).groupBy("doc.doc_id").agg(mixing.F.count("*").alias("n"), mixing.F.countDistinct("copy").alias("d"),
                                                        mixing.F.max("copy").alias("m"), mixing.F.max("copies").alias("c"))
    got = {r.doc_id: r for r in out.collect()}
    assert abs(got[1].n - 1_000_000) < 12_000 and got[1].n == got[1].d == got[1].m == got[1].c
    small = spark.createDataFrame([(i, "x" * 9, "ab"[i % 9 == 0]) for i in range(200)], "doc_id long, text string, source string")
    whole = Counter((r.doc.doc_id, r.copies, r["copy"], r.order_key) for r in mixing.replicate(small).collect())
    monkeypatch.setattr(mixing, "CHUNK", 2)
    assert Counter((r.doc.doc_id, r.copies, r["copy"], r.order_key) for r in mixing.replicate(small).collect()) == whole


def test_mixing_runs_no_python(spark):
    df = spark.createDataFrame([(1, "x", "a")], "doc_id long, text string, source string")
    plan = mixing.replicate(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert mixing.mix(df.limit(0)).count() == 0


# --- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as p
    from starloom.llm import toxicity
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in p.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "mixing", "segmentation"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    clean = p.toxicity_filter(spark, docs, sf)
    bad = toxicity.toxicity_scores(docs, labels).where("predicted = 1").count()
    assert clean.columns == docs.columns and clean.count() == docs.count() - bad and bad > 0
    unique = p.exact_dedup(spark, clean, sf).cache()
    assert unique.count() == clean.selectExpr(r"regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ') t").distinct().count()
    near = p.simhash_dedup(spark, unique, sf)
    mixed = p.mix_sources(spark, near, sf)
    assert near.columns == mixed.columns == docs.columns
    ids = {r.doc_id for r in near.collect()}
    assert {r.doc_id for r in mixed.collect()} <= ids <= {r.doc_id for r in unique.collect()}
    assert p.run(spark, sf).count() == 2 * mixed.where("length(text) > 1").count() + p.segment(
        spark, mixed.where("length(coalesce(text, '')) <= 1"), sf).count()


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline as p
    sf = "/root/testdata/sf0.001"
    for t in ("documents", "labels"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert p.run(spark, str(tmp_path)).count() == 0


def test_every_query_keeps_its_columns(spark):
    from starloom.llm.queries import QUERIES
    want = {1: "page_id host path rule verdict", 2: "query_id rank vec_id score", 3: "doc_id keep_id group_size kept text_sha256",
            4: "doc_id held_out n_tokens n_known train_tokens base_score score", 6: "doc_id held_out score predicted",
            8: "doc_id fingerprint component_id", 10: "doc_id n_bytes n_removed n_spans kept_sha256"}
    names = {int(n[2:].split("_")[0]): n for n in QUERIES}
    assert sorted(names) == list(range(1, 14))
    for k in (1, 3, 6):
        df = QUERIES[names[k]][0](spark, os.environ.get("LLM_SF", "/root/testdata/sf0.001"))
        assert set(want[k].split()) <= set(df.columns)

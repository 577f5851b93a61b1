"""URL filter, language model, toxicity, segmentation and token counts against plain Python."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from starloom.llm import kneser_ney, segmentation, token_counts, toxicity, url_filter

SCHEMA = "doc_id long, text string, source string, score double, ids string, sample int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "s", 0.5, "z", 9) for i, t in rows], SCHEMA).repartition(parts)


def texts(seed, n=40):
    rnd = random.Random(seed)
    words = ["The", "cat", "sat", "on", "a", "mat", "é", "x,", "dog."]
    rows = [(rnd.choice([None, *range(200)]), " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 30)))) for _ in range(n)]
    return rows + [(7, None), (8, ""), (9, " \n\t")] + rows[:3]


# --- URL filter

URLS = [None, "", "no scheme", "http://", "https://WWW.Example.COM/en/1?x=/es/", "http://a.example.com/en/2", "ftp://com/x",
        "http://com", "http://xcom/", "http://b.net/es/9#q", "http://b.net/ES/9", "http://b.net/de/1", "http://net/fr/", "a://b?c/d"]


def parse(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if c.isascii() else c for c in host), rest[:end]


def rule_brute(host, path):
    fits = [(r, v) for r, v in url_filter.RULES
            for d, p in [r.split("/", 1)] if (host == d or host.endswith("." + d)) and path.startswith("/" + p)]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


def ngram_brute(text, salt):
    raw = b"^" + text.encode() + b"$"
    out = []
    for n in url_filter.SIZES:
        for k in range(len(raw) - n + 1):
            h = 0
            for b in raw[k:k + n]:
                h = (h * int(url_filter.BASE) + b + 1) % (1 << 64)
            h = (h + salt * 31 + n) % (1 << 64)
            out.append(int(url_filter.mix64(np.array([h], dtype=np.uint64))[0]) % url_filter.WEIGHTS)
    return out


def test_ngram_features_are_those_of_each_url():
    hosts, paths = ["a.net", "", "b"], ["/es/é", "", ""]
    who, index, value = url_filter.ngram_features(hosts, paths)
    for k, (h, p) in enumerate(zip(hosts, paths)):
        want = (ngram_brute(h, 1) if h else []) + (ngram_brute(p, 2) if p else [])
        assert sorted(index[who == k].tolist()) == sorted(want)
        assert np.allclose(value[who == k], 1 / math.sqrt(len(want)) if want else 0)


def test_url_verdicts(spark):
    urls = URLS + [f"http://h{k}.example.net/{l}/{k}" for k in range(30) for l in ("es", "de")] \
        + [f"http://h{k}.example.com/fr/{k}" for k in range(30)]
    pages = spark.createDataFrame([(k, u, "p", "r") for k, u in enumerate(urls)], "page_id long, url string, path string, rule string")
    got = {r.page_id: r for r in url_filter.url_verdicts(pages, url_filter.judged_by_rules(pages)).collect()}
    labelled = sorted({(h, p, v) for h, p in map(parse, urls) for _, v in [rule_brute(h, p)] if v})
    weights = url_filter.train_on(spark.createDataFrame(labelled, "host string, path string, verdict string"))
    assert len(got) == len(urls)
    for k, u in enumerate(urls):
        host, path = parse(u)
        rule, verdict = rule_brute(host, path)
        p = url_filter.block_probability([host], [path], weights)[0]
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule)
        assert got[k].verdict == (verdict or ("block" if p >= 0.5 else "allow"))
        assert math.isclose(got[k].block_probability, p, rel_tol=1e-9)


def test_url_filter_learns_held_out_urls(spark):
    """URLs of hosts that training never saw are told apart by their paths."""
    rows = [(f"s{k}.site.org", f"/{w}/{k}", v) for k in range(200) for w, v in (("casino-win", "block"), ("docs-guide", "allow"))]
    weights = url_filter.train_on(spark.createDataFrame(rows, "host string, path string, verdict string"))
    p = url_filter.block_probability(["new.edu"] * 2, ["/casino-win/x", "/docs-guide/x"], weights)
    assert p[0] > 0.8 and p[1] < 0.2


def test_url_filter_empty_and_one_sided(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.url_verdicts(none, url_filter.judged_by_rules(none)).count() == 0
    one = spark.createDataFrame([(1, "http://x.org/a"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in url_filter.url_verdicts(one, url_filter.judged_by_rules(one)).collect()} == {"allow"}


# --- language model

def lm_brute(rows):
    tok = lambda t: (t or "").encode().lower().split()
    uni, bi = Counter(), Counter()
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            w = tok(t) + [b"\n"]
            uni.update(w)
            bi.update(zip([b"\n"] + w, w))
    ctx, kinds, cont = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (u, v), c in bi.items():
        ctx[u] += c
        kinds[u][min(c, 3) - 1] += 1
        cont[v] += 1
    d = kneser_ney.discounts([Counter(bi.values())[k] for k in (1, 2, 3, 4)])
    low_d = kneser_ney.discounts([Counter(cont.values())[k] for k in (1, 2, 3, 4)])
    v, n = len(uni), sum(uni.values())
    rest = sum(low_d[min(c, 3) - 1] for c in cont.values()) / len(bi) if bi else 1.0

    def p(a, b):
        low = rest / (v + 1) + ((cont[b] - low_d[min(cont[b], 3) - 1]) / len(bi) if cont[b] else 0)
        if not ctx[a]:
            return low
        c = bi[a, b]
        return (c - d[min(c, 3) - 1] if c else 0) / ctx[a] + sum(x * k for x, k in zip(d, kinds[a])) / ctx[a] * low
    if uni:
        assert math.isclose(sum(p(b"the", b) for b in uni) + p(b"the", b"?"), 1.0, rel_tol=1e-9)
    out = []
    for i, t in rows:
        w = tok(t) + [b"\n"]
        out.append((i, len(w), sum(x in uni for x in w), n, sum(math.log10((uni[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w),
                    sum(math.log10(p(a, b)) for a, b in zip([b"\n"] + w, w))))
    return out


@pytest.mark.parametrize("portion", [4 << 20, 16])
def test_kneser_ney_against_brute_force(spark, monkeypatch, portion):
    monkeypatch.setattr(kneser_ney, "PORTION", portion)  # the driver's value; pieces of long texts are tested below
    rows = texts(1)
    got = kneser_ney.corpus_scores(frame(spark, rows)).collect()
    key = lambda r: (str(r[0]), r[1], round(r[5], 6))
    got = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], key=key)
    for a, b in zip(got, sorted(lm_brute(rows), key=key), strict=True):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9) and math.isclose(a[5], b[5], rel_tol=1e-9)


def test_portions_keep_words_whole(monkeypatch):
    monkeypatch.setattr(kneser_ney, "PORTION", 7)
    data = [b"one two three  four", b"", b" ", b"x" * 50 + b" y"]
    got = defaultdict(list)
    for portion in kneser_ney.portions(iter(data)):
        words, owner = kneser_ney.flat_words(portion)
        for w, o in zip(words, owner):
            got[int(o)].append(w)
    assert [got[k] for k in range(4)] == [d.split() + [b"\n"] for d in data]


def test_kneser_ney_empty_and_untrained(spark):
    assert kneser_ney.corpus_scores(spark.createDataFrame([], SCHEMA)).count() == 0
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    got = kneser_ney.corpus_scores(frame(spark, [(i, "a b") for i in held])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.score) for r in got] == [(3, 0, 0, 0.0)] * 3


def test_model_folder_must_be_mounted():
    assert kneser_ney.model_folder("file:/tmp/x") == "/tmp/x"
    with pytest.raises(ValueError):
        kneser_ney.model_folder("hdfs://host/x")


@pytest.mark.parametrize("lost", ["words-0", "word-counts-1", "pairs-2", "pair-counts-0", "context-0", "continuation-0", ""])
def test_a_model_that_is_not_whole_raises(spark, lost):
    """A lost or cut array, or a folder that is out of sight (the last case), never scores as if it were empty."""
    import dataclasses
    import os
    from pyspark.sql import functions as F
    rows = frame(spark, texts(1)).select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).cast("binary").alias("_t"))
    model = kneser_ney.train(rows.select("_t"), 10_000)
    assert kneser_ney.score(rows, model).count() == rows.count()
    if not lost:
        model = dataclasses.replace(model, folder=model.folder + "-elsewhere")
    else:
        path = f"{model.folder}/{lost}.npy"
        whole = np.load(path)
        os.remove(path)
    with pytest.raises(Exception, match="is missing"):
        kneser_ney.score(rows, model).collect()
    if lost:
        np.save(path, whole[:-1])
        with pytest.raises(Exception, match="entries, not"):
            kneser_ney.score(rows, model).collect()


# --- toxicity

def test_grammar_composes_the_parts():
    tagger, machine = toxicity.Tagger({"idiot": 1.0}, {}), toxicity.grammar([1.0, 1.25, 1.5, 0.5, 0.6])
    score = lambda t: sum(c for c, _ in toxicity.matched_clauses(t, tagger, machine))
    plain, aimed = score("what an idiot"), score("you are an idiot")
    denied, reported, menace = score("not an idiot"), score("someone said idiot"), score("we kill them")
    assert plain == 1.0 and aimed == 1.25 and denied == 0.5 and reported == 0.6 and menace == 1.5
    assert score("you and he are not an idiot") == 0.5
    assert score("you are here. idiot") == 1.0, "a target of another clause does not aim"
    assert score("a kind word") == score("") == 0.0
    judge = toxicity.Model({"idiot": 1.0}, {}, list(toxicity.PRIOR)).scorer()
    assert [judge(t) >= 0.7 for t in ("what an idiot", "you are an idiot", "not an idiot", "she wrote idiot", "we kill them")] \
        == [False, True, False, False, True], "without labels a bare, denied or reported insult does not reach the threshold"


def patterns_of(clause, insults):
    """The pattern of each word of a clause by the distances to its trigger words; None where nothing matches."""
    words = re.findall(r"[^\W\d_]+", clause.lower())
    role = ["report" if w in toxicity.REPORTS else "negation" if w in toxicity.NEGATIONS else "target" if w in toxicity.TARGETS
            else "threat" if w in toxicity.THREATS else "insult" if insults(w) else "" for w in words]
    before = lambda kind, i, n, of: kind in of[max(0, i - n):i]
    menaced = ["menace" if r == "target" and before("threat", i, 3, role) else r for i, r in enumerate(role)]
    out = []
    for i, r in enumerate(menaced):
        p = r if r in ("insult", "menace") else None
        if p == "insult" and before("target", i, 4, menaced):
            p = "aimed"
        if p and before("negation", i, 3, role):
            p = "denied"
        elif p and before("report", i, 8, role):
            p = "reported"
        out.append(p)
    return words, out


def insult_corpus(n, seed=5):
    """Toxic documents throw an insult, clean ones deny or report it in the same words."""
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        plain = lambda k: " ".join(rnd.choice(["bara", "doso", "ketu", "lura", "miso", "you", "they"]) for _ in range(k))
        filler, insult = ". ".join(plain(6) for _ in range(5)), rnd.choice(["zorgling", "zorgface", "vexhead", "idiot"])
        bad = i % 3 == 0
        clause = rnd.choice([f"bara {insult}", f"you are a {insult}"] if bad else
                            [f"you are not a {insult}", f"he said bara {insult}", f"she wrote that they are {insult}", "bara doso"])
        rows.append((i, f"{filler}. {clause}. {plain(4)}"))
        labels.append((i, int(bad)))
    return rows, labels


def test_the_grammar_decides_and_isolated_words_do_not(spark):
    rows, labels = insult_corpus(900)
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    truth = dict(labels)
    held = [r for r in toxicity.toxicity_scores(docs, marks).collect() if r.held_out]
    model = toxicity.train(docs, marks)
    assert set(model.words) >= {"zorgling", "zorgface", "vexhead"}, "words that clean documents only deny or report are learnt"
    assert model.weights[1] > 2 and model.weights[2] > 2 and max(model.weights[4:]) < 1
    alone = {i: any(w in model.words or any(w.startswith(s) and w != s for s in model.stems) for w in re.findall(r"\w+", t.lower())) for i, t in rows}
    wrong = sum(r.predicted != truth[r.doc_id] for r in held)
    wrong_alone = sum(int(alone[r.doc_id]) != truth[r.doc_id] for r in held)
    assert len(held) > 250 and wrong == 0 and wrong_alone > len(held) / 3


def test_toxicity_against_brute_force(spark):
    rows, labels = insult_corpus(240, seed=9)
    rows[7], rows[8] = (7, "we kill them. " + rows[7][1]), (8, "They never hurt him; idiot\nno. " + rows[8][1])
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    y = dict(labels)
    train = {t: y[i] for i, t in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    roles = set(toxicity.REPORTS + toxicity.NEGATIONS + toxicity.TARGETS + toxicity.THREATS)
    split = lambda t: re.split(r"[.!?;\n]+", t)
    seen, size = {0: Counter(), 1: Counter()}, Counter(train.values())
    for t, label in train.items():
        standing = set()
        for c in split(t):
            words, _ = patterns_of(c, lambda w: False)
            for w in set(words) - roles:
                got = patterns_of(c, lambda x: x == w)  # noqa: B023
                if any(a == w and p in ("insult", "aimed") for a, p in zip(*got)):
                    standing.add(w)
        seen[label].update({w for w in standing if len(w) > 2} | {w[:n] + "*" for w in standing for n in (4, 5, 6, 7) if len(w) > n})
    words, stems = {w: 1.0 for w in toxicity.INSULTS}, {}
    for f, n in seen[1].items():
        odds = math.log((n + 0.5) / (size[1] + 1)) - math.log((seen[0][f] + 0.5) / (size[0] + 1))
        if n >= 3 and odds >= 4:
            into, key = (stems, f[:-1]) if f.endswith("*") else (words, f)
            into[key] = max(into.get(key, 0), odds / 4)
    model = toxicity.train(docs, marks)
    assert model.words == pytest.approx(words) and model.stems == pytest.approx(stems)

    strength = lambda w: max([words.get(w, 0.0)] + [v for s, v in stems.items() if w.startswith(s) and w != s])

    def sums(t):
        total = dict.fromkeys(("insult", "aimed", "menace", "denied", "reported"), 0.0)
        for c in split(t):
            for w, p in zip(*patterns_of(c, lambda w: strength(w) > 0)):
                if p:
                    total[p] += 1.0 if w in roles else strength(w)
        return list(total.values())

    # the weights are the one point where the penalised likelihood has no slope
    x = np.array([[1.0, *sums(t)] for t in train])
    slope = x.T @ (1 / (1 + np.exp(-x @ np.array(model.weights))) - np.array(list(train.values()))) \
        + 0.1 * (np.array(model.weights) - np.array([-3.0, 2.0, 4.0, 4.0, 0.0, 0.0]))
    assert np.abs(slope).max() < 1e-6
    for r in toxicity.toxicity_scores(docs, marks).collect():
        want = 1 / (1 + math.exp(-float(np.dot(model.weights, [1.0, *sums(dict(rows)[r.doc_id])]))))
        assert math.isclose(r.score, want, rel_tol=1e-9) and r.predicted == int(r.score >= 0.7)


def test_toxicity_does_not_depend_on_the_order_of_rows(spark):
    """Several texts of an id: one of them, by value, is learnt; a very long text scores like any other."""
    rows, labels = insult_corpus(240)
    rows += [(i, rows[(i + 3) % 240][1]) for i in range(0, 240, 2)] + rows[:20]
    rows += [(5000, "bara doso " * 200_000 + ". you zorgling"), (5001, "bara" * 500_000)]
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    mixed = frame(spark, random.Random(1).sample(rows, len(rows))).repartition(3)
    got, again = (Counter((r.doc_id, r.score) for r in toxicity.toxicity_scores(d, marks).collect()) for d in (docs, mixed))
    assert got == again and len(rows) == sum(got.values())
    scores = dict(got.keys())
    assert scores[5000] >= 0.7 > scores[5001]


def test_toxicity_learns_held_out_rows(spark):
    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        words = [rnd.choice(["ba", "do", "ke", "lu", "mi"]) + rnd.choice(["ra", "so", "tu"]) for _ in range(30)]
        if bad:
            words[rnd.randrange(30)] = rnd.choice(["zorgling", "zorgface", "zorghead"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    rows += [(1000, None), (1001, ""), (None, "zorgling"), (None, None), rows[0]]
    labels += [(1, None), (None, 1), (0, 1)]
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs, marks).collect()
    assert len(got) == len(rows)
    truth = dict(x for x in labels if x[1] is not None and x[0] is not None)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert all(r.predicted == truth[r.doc_id] for r in got if r.doc_id in truth)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    clean = toxicity.keep_clean(docs, marks)
    assert clean.schema == docs.schema
    assert clean.count() == sum(r.predicted == 0 for r in got)


def test_rare_markers_are_learnt_beside_many_toxic_documents(spark):
    """Markers of under 1 % of the toxic documents, and more entries than a fixed number."""
    rows = [(i, 1, f"tox{i} common" + (" raremarker" if i < 6 else "")) for i in range(700)]
    rows += [(1000 + i, 0, f"clean{i}") for i in range(3500)]
    words, _ = toxicity.learn_lexicon(spark.createDataFrame(rows, "_id long, _y int, _t string"))
    assert "common" in words and "raremarker" in words and "clean" not in words
    many = [(i, 1, " ".join(f"{chr(97 + k // 676)}{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}" for k in range(2500)) + f" x{i}") for i in range(3)]
    words, _ = toxicity.learn_lexicon(spark.createDataFrame(many + [(1000 + i, 0, f"clean{i}") for i in range(60)], "_id long, _y int, _t string"))
    assert len(words) >= 2500


def test_toxicity_without_labels_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(frame(spark, [(1, "you idiot"), (2, "hello"), (3, "idiot")]), none).collect()}
    assert got == {1: 1, 2: 0, 3: 0}
    assert toxicity.toxicity_scores(spark.createDataFrame([], SCHEMA), none).count() == 0


# --- segmentation

def all_paths(lattices, text):
    per = []
    for w in segmentation._units(text):
        n = lattices.numbers([w])[0]
        row, found = lattices.row_of[n], []

        def walk(p, ids, lp):
            if p == len(w):
                found.append((tuple(ids), lp))
                return
            for e in range(lattices.first[row + p], lattices.first[row + p] + lattices.edges[row + p]):
                walk(p + lattices.step[e], [*ids, int(lattices.piece[e])], lp + lattices.logp[e])
        walk(0, [], 0.0)
        per.append(found)
    return {sum((x[0] for x in c), ()): sum(x[1] for x in c) for c in itertools.product(*per)}


def test_samples_follow_the_law_without_replacement():
    lattices = segmentation.lattices_of(segmentation.DEFAULT_MODEL)
    text, n = "a bc\nd", 6000
    law = {k: math.exp(v) for k, v in all_paths(lattices, text).items()}
    assert math.isclose(sum(law.values()), 1.0, rel_tol=1e-9)
    keys = segmentation.mix64(np.arange(n, dtype=np.uint64) + np.uint64(99))
    seen = [Counter(), Counter()]
    weighted = 0.0
    for found in segmentation.sample_texts([text] * n, keys, lattices, 2):
        a, b = (tuple(p["ids"].tolist()) for p in found)
        assert a != b and found[0]["value"] >= found[1]["value"]
        assert math.isclose(math.log(law[a]), found[0]["log_prob"], abs_tol=1e-9)
        seen[0][a] += 1
        seen[1][b] += 1
        weighted += sum(math.exp(p["log_prob"] - p["log_inclusion"]) for p in found)
    assert math.isclose(weighted / n, 1.0, abs_tol=0.02)
    for k, p in law.items():
        second = sum(law[a] * p / (1 - law[a]) for a in law if a != k)
        assert abs(seen[0][k] / n - p) < 0.02 and abs(seen[1][k] / n - second) < 0.02


def test_paths_are_whole_and_distinct(monkeypatch):
    lattices = segmentation.lattices_of(segmentation.DEFAULT_MODEL)
    cases = ["", " ", "\n", "▁x▁ é漢\U0001F600  \n\n a", "x" * 2000, "the " * 100, "A\tb\r\n  c", "\x00\x7f"]
    keys = np.arange(len(cases), dtype=np.uint64)
    for ahead in (1, 48):
        monkeypatch.setattr(segmentation, "AHEAD", ahead)  # small: the joint set of later steps is opened too
        for text, found in zip(cases, segmentation.sample_texts(cases, keys, lattices, 4)):
            assert all(lattices.v.decode(p["ids"]).decode() == text for p in found)
            assert len({tuple(p["ids"].tolist()) for p in found}) == len(found) == min(4, len(all_paths(lattices, text)) if len(text) < 3 else 4)
            if len(found) < 4:
                assert all(p["log_inclusion"] == 0 for p in found)


def test_numbers_of_all_texts_are_drawn_together(monkeypatch):
    calls, real = [], segmentation.uniforms
    monkeypatch.setattr(segmentation, "uniforms", lambda key, counter: calls.append(1) or real(key, counter))
    lattices = segmentation.lattices_of(segmentation.DEFAULT_MODEL)
    drawn = []
    for n in (20, 200):
        calls.clear()
        found = segmentation.sample_texts(["the cat sat on the mat"] * n, np.arange(n, dtype=np.uint64), lattices, 2)
        assert all(len(f) == 2 for f in found)
        drawn.append(len(calls))
    assert drawn[1] < drawn[0] + 100  # no draw a text


def test_forgetting_words_changes_nothing(monkeypatch):
    fresh = segmentation.Lattices(segmentation.Vocabulary(segmentation.DEFAULT_MODEL))
    small = segmentation.Lattices(fresh.v)
    monkeypatch.setattr(segmentation, "WORDS_BUILT", 3)
    cases = [f"the cat number {k} sat on mat {k * 7}" for k in range(30)]
    keys = np.arange(30, dtype=np.uint64)
    want = segmentation.sample_texts(cases, keys, fresh, 2)
    monkeypatch.setattr(segmentation, "MAX_EDGES", 150)
    got = [segmentation.sample_texts([c], keys[k:k + 1], small, 2)[0] for k, c in enumerate(cases)]
    assert [[p["ids"].tolist() for p in w] for w in want] == [[p["ids"].tolist() for p in g] for g in got]


def test_encode_and_decode_round_trip(spark):
    rows = texts(5) + [(None, "ünï \U0001F600"), (3, "a" * 500)]
    df = frame(spark, rows)
    enc = segmentation.encode(df, samples=2)
    back = segmentation.decode(enc).collect()
    assert Counter((r.doc_id, r.text) for r in back if r["sample"] == 1) == Counter((i, t or "") for i, t in rows)
    again = segmentation.digests(df.repartition(1)).collect()
    cols = ["doc_id", "sample", "ids_xxh64", "n_pieces"]
    one = Counter(tuple(r[c] for c in cols) for r in segmentation.digests(df).collect())
    assert one == Counter(tuple(r[c] for c in cols) for r in again), "samples do not depend on the partitioning"
    assert segmentation.digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_digests_keep_the_ids(spark):
    rows = texts(5)
    got = segmentation.digests(frame(spark, rows))
    assert Counter((r.doc_id, r.text) for r in segmentation.decode(got).collect() if r["sample"] == 1) == Counter((i, t or "") for i, t in rows)


# --- token counts

def test_token_histogram_answers_every_limit(spark):
    rows = texts(6)
    enc = token_counts._encoder(token_counts.DEFAULT_VOCABULARY)
    n = [len(enc.encode_ordinary(t or "")) for _, t in rows]
    sums = token_counts.token_counts(frame(spark, rows)).cache()
    got = {r.n_tokens: r for r in sums.collect()}
    assert set(got) == set(n)
    for k, r in got.items():
        assert r.n_docs == n.count(k) and r.docs_from == sum(x >= k for x in n) and r.tokens_from == sum(x for x in n if x >= k)
        assert r.truncated_total == sum(min(x, k) for x in n) and (r.total_docs, r.total_tokens) == (len(n), sum(n))
    for limit in (0, 1, 5, max(n), max(n) + 9):
        assert token_counts.truncated_total(sums, limit) == sum(min(x, limit) for x in n)
    for q in (0.01, 0.5, 0.9, 1.0):
        assert token_counts.quantile(sums, q) == sorted(n)[math.ceil(q * len(n)) - 1]
    empty = token_counts.token_counts(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and token_counts.truncated_total(empty, 5) == 0


def test_long_white_space_counts_like_any_other(spark, monkeypatch):
    enc = token_counts._encoder(token_counts.DEFAULT_VOCABULARY)
    rnd = random.Random(4)
    monkeypatch.setattr(token_counts, "LONG_SPACE", 3)
    for _ in range(300):
        text = "".join(rnd.choice([" ", "\n", "\t", "  ", "\u3000", "\xa0", "\x1c", "a", "Wort", "12", "!?", "é"]) for _ in range(rnd.randrange(30)))
        assert token_counts.count_tokens(enc, text) == len(enc.encode_ordinary(text)), repr(text)
    monkeypatch.setattr(token_counts, "LONG_SPACE", 10_000)
    n = 2_000_000
    got = token_counts.token_lengths(frame(spark, [(1, " " * n), (2, "a" + " " * n + "b"), (3, "\n" * n + "x y")])).collect()
    assert sorted(r.n_tokens for r in got) == sorted([n, 1 + (n - 1) + 1, len(enc._encode_single_piece("\n" * (n - 1))) + 1 + 2])


def test_suffix_sums_over_blocks(spark):
    hist = spark.createDataFrame([(k * 700, k + 1) for k in range(10)], "n_tokens long, n_docs long")
    n = [k * 700 for k in range(10) for _ in range(k + 1)]
    for r in token_counts.suffix_sums(hist).collect():
        assert r.truncated_total == sum(min(x, r.n_tokens) for x in n) and r.docs_up_to == sum(x <= r.n_tokens for x in n)

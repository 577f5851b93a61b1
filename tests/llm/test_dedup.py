"""Exact, SimHash and suffix dedup against brute force, with nulls, empties, ties, repeats and odd columns."""

import hashlib
import random
import re

import pytest
import xxhash

from starloom.llm import content_sort, simhash, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, _id string, _fp long"


def frame(spark, rows, parts=4):
    full = [(i, t, "en", f"s{(i or 0) % 3}", 1, "x", "y", 7) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def corpus(seed, n=60):
    rnd = random.Random(seed)
    words = ["Aa", "b", "ccc", "é", "dd", "the", "of"]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.choice([1, 3, 30, 60]))) for _ in range(8)]
    rows = []
    for _ in range(n):
        t = rnd.choice([None, "", " ", rnd.choice(base), rnd.choice(base) + rnd.choice([" ", "\n\t", " x"]) + rnd.choice(base)])
        rows.append((rnd.choice([None, *range(40)]), t))
    return rows + rows[:5]


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("parts", [1, 7])
def test_content_sort(spark, parts):
    rows = corpus(1)
    got = content_sort.content_sort_dedup(frame(spark, rows, parts)).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    want = []
    for i, t in rows:
        ids = [x for x in groups[norm(t)] if x is not None]
        want.append((i, min(ids) if ids else None, len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_content_sort_splits_one_hot_text(spark):
    """Half of all rows hold one text, cut over several partitions by their ids."""
    rows = [(i, "same  text" if i % 2 else f"text {i}") for i in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = content_sort.content_sort_dedup(frame(spark, rows, 5)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = [r for r in got if r.doc_id % 2]
    assert {(r.keep_id, r.group_size) for r in hot} == {(1, 200)} and [r.doc_id for r in hot if r.kept] == [1]


def test_keep_first_keeps_columns(spark):
    rows = corpus(2)
    df = frame(spark, rows)
    out = content_sort.keep_first(df)
    assert out.columns == df.columns and out.schema == df.schema
    got = out.collect()
    assert sorted(norm(r.text) for r in got) == sorted({norm(t) for _, t in rows})
    texts = {(i, t) for i, t in rows}
    assert all((r.doc_id, r.text) in texts for r in got)


def simhash_brute(t):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_brute(rows):
    fps = sorted({simhash_brute(t) for _, t in rows})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= 4:
                root[find(b)] = find(a)
    low = {}
    for i, t in rows:
        r = find(simhash_brute(t))
        if i is not None:
            low[r] = min(low.get(r, i), i)
    return [(i, f"{simhash_brute(t):016x}", low.get(find(simhash_brute(t)))) for i, t in rows]


def near_copies(seed):
    rnd = random.Random(seed)
    rows, no = corpus(seed, 20), 100
    for _ in range(6):
        words = [f"w{rnd.randrange(400)}" for _ in range(300)]
        for _ in range(8):
            copy = list(words)
            for _ in range(rnd.choice([1, 2, 4, 8])):
                copy[rnd.randrange(len(copy))] = "edit"
            rows.append((no, " ".join(copy)))
            no += 1
    return rows


def test_simhash_against_brute_force(spark):
    rows = near_copies(3)
    got = simhash.simhash_components(frame(spark, rows)).collect()
    assert sorted(map(str, components_brute(rows))) == sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got)


def test_fingerprint_of_long_text_in_pieces(monkeypatch):
    text = " ".join(f"Word{k % 97}" for k in range(3000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "PIECE", 64)
    assert simhash.fingerprint(text.encode()) == whole == simhash_brute(text)


def test_links_split_large_buckets(spark, monkeypatch):
    """Blocks of a bucket are compared pairwise in tasks of their own, with the same components."""
    rnd = random.Random(5)
    fps = set()
    for _ in range(12):
        base = rnd.getrandbits(64)
        for _ in range(12):
            fps.add(base ^ sum(1 << b for b in rnd.sample(range(64), rnd.choice([1, 2, 3]))))
    fps = [f - (1 << 64) if f >> 63 else f for f in fps]
    monkeypatch.setattr(simhash, "BLOCK", 3)
    df = spark.createDataFrame([(f,) for f in fps], "_fp long")
    root = {r.node: r.root for r in simhash.components(simhash.links(df)).collect()}
    parent = {f: f for f in fps}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f
    for a in fps:
        for b in fps:
            if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert {f: root.get(f, f) for f in fps} == {f: find(f) for f in fps}


def test_simhash_keep_one(spark):
    rows = near_copies(4)
    df = frame(spark, rows)
    out = simhash.keep_one(df)
    assert out.schema == df.schema
    comps = {}
    for (i, t), (_, _, c) in zip(rows, components_brute(rows)):
        comps.setdefault(c, []).append((i, t))
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert len(got) == len(comps)
    assert sorted(str(i) for i, _ in got) == sorted(str(min([x for x, _ in m if x is not None], default=None)) for m in comps.values())


def suffix_brute(rows, w=50):
    low = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - w + 1):
            s = b[p:p + w]
            if i is not None and (s not in low or i < low[s]):
                low[s] = i
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - w + 1):
            m = low.get(b[p:p + w])
            if m is not None and (i is None or m < i):
                gone[p:p + w] = [True] * w
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(map(str, out))


def suffix_rows(df, **kw):
    return sorted(str((r.doc_id, r.n_bytes, r.n_removed, len(r.starts), bytes(r.kept)))
                  for r in suffix_dedup.suffix_dedup(df, **kw).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("ab é") for _ in range(rnd.choice([0, 10, 49, 50, 51, 200]))) for _ in range(12)]
    rows = [(rnd.choice([None, *range(9)]), rnd.choice([None, "", "a" * 300, "xy" * 100, "".join(rnd.sample(base, 3))]))
            for _ in range(80)]
    assert suffix_rows(frame(spark, rows, 5)) == suffix_brute(rows)


def test_suffix_dedup_long_text_over_chunks(spark, monkeypatch):
    """Windows across the chunks in which long texts are hashed."""
    monkeypatch.setattr(suffix_dedup, "CHUNK", 64)
    rnd = random.Random(9)
    text = "".join(rnd.choice("abcd") for _ in range(2000))
    data = suffix_dedup.np.frombuffer(text.encode(), dtype=suffix_dedup.np.uint8)
    starts = suffix_dedup.np.array([0, 700, 2000])
    first, count, _, owner = suffix_dedup.segments(data, starts, 50, 16)
    covered = sorted(x for f, n in zip(first, count) for x in range(f, f + n))
    assert covered == [*range(651), *range(700, 1951)]
    assert all((f >= 700) == (o == 1) for f, o in zip(first, owner))


def test_merge_sort_orders_suffixes():
    np = suffix_dedup.np
    rnd = random.Random(4)
    text = "".join(rnd.choice("ab") for _ in range(600)).encode()
    s = suffix_dedup.Suffixes(np.frombuffer(text, dtype=np.uint8), np.array([0, 600]), 20)
    at = np.array(rnd.sample(range(580), 300))
    groups = np.array([0, 1, 8, 100, 300])
    got = s.merge_sort(at, groups)
    for a, b in zip(groups, groups[1:]):
        assert got[a:b].tolist() == sorted(at[a:b].tolist(), key=lambda p: text[p:p + 20]) or \
            [text[p:p + 20] for p in got[a:b]] == sorted(text[p:p + 20] for p in at[a:b])


def test_colliding_hashes_are_verified(monkeypatch):
    """With a hash that says everything is equal the bytes decide."""
    np = suffix_dedup.np
    texts = [b"a" * 60, b"b" * 60]
    monkeypatch.setattr(suffix_dedup.Suffixes, "hash", lambda self, at, size: np.zeros(len(at), dtype=np.uint64))
    offsets, best = suffix_dedup.window_minima(texts, np.zeros(2, dtype=np.uint64), np.array([5, 3]), 50)
    assert best[:offsets[1]].tolist() == [5] * 11 and best[offsets[1]:].tolist() == [3] * 11


@pytest.mark.parametrize("run", [
    lambda d: content_sort.content_sort_dedup(d), lambda d: content_sort.keep_first(d),
    lambda d: simhash.simhash_components(d), lambda d: simhash.keep_one(d), lambda d: suffix_dedup.suffix_dedup(d)])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], SCHEMA)).count() == 0


def common_phrase(seed, n=300):
    """A phrase shorter than a window in ever other surroundings, and a longer passage in every third text."""
    rnd = random.Random(seed)
    noise = lambda: "".join(rnd.choice("abcdefghij ") for _ in range(rnd.randrange(60, 120)))
    return [(i, noise() + "a phrase that occurs in all texts" + noise() + ("The passage " * 9 if i % 3 == 0 else "") + noise())
            for i in range(n)] + [(None, None), (7, "")]


@pytest.mark.parametrize("most", [1, 20, 10_000])
def test_suffix_dedup_with_hot_hashes(spark, most):
    rows = common_phrase(4) + [(i, t) for i, t in corpus(3)]
    assert suffix_rows(frame(spark, rows, 5), most=most) == suffix_brute(rows)


def test_contexts_of_a_common_phrase_do_not_meet(spark):
    """No hash brings more than ``most`` distinct segments, or a window of each block, to one task."""
    np, most = suffix_dedup.np, 20
    packed = suffix_dedup.blocks(frame(spark, common_phrase(5), 3), "doc_id", "text")
    wanted, hot = suffix_dedup._wanted(packed, 8, 50, 16, most)
    assert len(hot)
    texts = suffix_dedup._segment_texts(packed.join(wanted, "block"), 8, 50, 16, hot).select("keys").collect()
    keys = np.concatenate([suffix_dedup.unpack_sorted(r["keys"]) for r in texts])
    assert np.unique(keys, return_counts=True)[1].max() <= most

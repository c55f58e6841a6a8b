"""Near duplicates, token rollups and the pipeline."""

import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from freshet.llm import order_minhash, token_rollup
from freshet.session import fresh_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, root string, k string"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(prev + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_alignment_is_edit_similarity():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 40))]
        b = list(a)
        for _ in range(rng.randrange(8)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randrange(2)] = [rng.randrange(6)] * rng.randrange(2)
        s = 1 - edits(a, b) / max(len(a), len(b))
        assert abs(order_minhash.alignment(a, b) - (s if s >= 0.8 - 1e-9 else 0.0)) < 1e-9
        assert order_minhash._bound(np.array(a), np.array(b)) >= s - 1e-9


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def made(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", None, "r", "k") for i, t in enumerate(texts)], SCHEMA)


def classes(docs):
    rows, found = order_minhash.near_classes(docs)
    return {r.doc_id: r.class_id for r in rows.join(found, "k").collect()}


def test_classes_match_brute_force(spark):
    rng = random.Random(2)
    texts = []
    for _ in range(25):
        base = words(rng, rng.choice([30, 120, 400]))
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            w = list(base)
            for _ in range(len(w) // 25):
                w[rng.randrange(len(w))] = "new"
            texts.append(" ".join(w))
    passage = " ".join(words(rng, 60))
    texts += [passage + " " + " ".join(words(rng, 200)) for _ in range(30)]
    texts += [None, "", "short one", "short one", "lone", texts[0], "same " * 500, "same " * 490]
    split = [(t or "").lower().split() for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            longest = max(len(split[i]), len(split[j]))
            if (texts[i] or "") == (texts[j] or "") or (longest and order_minhash._bound(np.array(split[i] or [""]), np.array(split[j] or [""])) >= 0.8 and edits(split[i], split[j]) <= 0.2 * longest + 1e-9):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    assert classes(made(spark, texts)) == {i: top(i) for i in range(len(texts))}


def test_keys_find_links_from_the_least_similarity_on():
    rng = np.random.default_rng(7)

    def share(n, similarity, pairs=200):
        found = 0
        for _ in range(pairs):
            a = rng.integers(1, 1 << 62, n).astype(np.uint64)
            b = a.copy()
            at = rng.choice(n, int((1 - similarity) * n + 1e-9), replace=False)
            b[at] = rng.integers(1, 1 << 62, len(at)).astype(np.uint64)
            found += len(np.intersect1d(order_minhash.buckets_of(a), order_minhash.buckets_of(b))) > 0
        return found / pairs

    assert all(share(n, 0.8) == 1 for n in range(5, 13))
    assert all(share(n, s) >= 0.98 for n in (16, 20, 30, 61, 200) for s in (0.8, 0.83, 0.85, 0.88, 0.9))


def test_short_texts_are_found_exactly():
    rng = random.Random(8)
    for _ in range(2000):
        a = [rng.randrange(12) for _ in range(rng.randrange(1, 15))]
        b = list(a)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randrange(2)] = [rng.randrange(12)] * rng.randrange(2)
        b = b[:14]
        if b and edits(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9:
            assert len(np.intersect1d(order_minhash.buckets_of(np.array(a, np.uint64)), order_minhash.buckets_of(np.array(b, np.uint64))))


def test_short_near_copies_become_one_class(spark):
    nine = "one two three four five six seven eight nine"
    assert classes(made(spark, [nine, nine.replace("five", "5"), "a b c d e", "a b c d e f", "u v w x", "u v w y"])) == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 5}


def test_large_groups_and_empty_tables(spark):
    rng = random.Random(3)
    base = words(rng, 100)
    texts = []
    for i in range(300):
        w = list(base)
        w[rng.randrange(100)] = f"x{i}"
        texts.append(" ".join(w))
    texts += [" ".join(base)] * 200 + [" ".join(words(rng, 100)) for _ in range(50)]
    got = classes(made(spark, texts))
    assert {got[i] for i in range(500)} == {0} and all(got[i] == i for i in range(500, 550))
    docs = made(spark, texts + [texts[0]])
    kept = order_minhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == 51
    assert order_minhash.keep_one(docs.limit(0)).count() == 0


def test_links_inside_one_large_bucket_of_many_classes(spark):
    # 150 originals share a long passage, so they share buckets; the two or three versions of each link only to each other
    rng = random.Random(9)
    passage, texts, want = words(rng, 60), [], {}
    for c in range(150):
        base = words(rng, 100)
        for v in range(rng.choice([2, 3])):
            w = list(base)
            for at in rng.sample(range(100), 8):
                w[at] = f"c{c}v{v}{at}"
            want[len(texts)] = c
            texts.append(" ".join(passage + w))
    least = {}
    for i, c in want.items():
        least.setdefault(c, i)
    assert classes(made(spark, texts)) == {i: least[c] for i, c in want.items()}


def test_texts_that_meet_only_in_a_large_bucket_are_tried(spark):
    # one bucket of 60 pairs of versions: a text links to its twin and to nobody else
    rng = random.Random(10)
    texts = {}
    for c in range(60):
        base = words(rng, 50)
        for v in range(2):
            w = list(base)
            for at in rng.sample(range(50), 4):
                w[at] = f"c{c}v{v}{at}"
            texts[c, v] = w
    docs = spark.createDataFrame([(f"{c:02}{v}".encode(), " ".join(w)) for (c, v), w in texts.items()], "k binary, text string")
    none = spark.createDataFrame([], "a binary, b binary")
    large = docs.select(F.lit(1).cast("long").alias("b"), "k")
    got = order_minhash._settled(docs, large, none, order_minhash.components(none))
    assert {bytes(r.k): bytes(r.root) for r in got.collect()} == {f"{c:02}{v}".encode(): f"{c:02}0".encode() for c, v in texts}


def test_rollup_follows_changes_and_commits_once(spark):
    root = fresh_path(spark, "rollup")
    schema = "source string, lang string, tokenizer string, sign int, tokens long, characters long"
    one = spark.createDataFrame([("a", "en", "t", 1, 10, 50), ("a", None, "t", 1, 5, 20), (None, "en", "t", 1, 1, 1)], schema)
    two = spark.createDataFrame([("a", "en", "t", -1, 10, 50), ("a", "en", "t", 1, 12, 55), (None, "en", "t", -1, 1, 1)], schema)
    for batch, changes in (("1", one), ("2", two), ("1", one), ("2", two)):
        token_rollup.commit(root, batch, changes)
    assert {tuple(r) for r in token_rollup.totals(spark, root).collect()} == {("a", "en", "t", 1, 12, 55), ("a", None, "t", 1, 5, 20)}


def test_deduplicated_rollup_matches_brute_force(spark):
    rows = [(3, "a b", "en", "s"), (1, "a b", "fr", "s"), (1, "a b", "fr", "s"), (4, "mail me: x.y@mail.example now", "en", None), (5, "mail me: x.y@mail.example now", "en", "s"), (6, None, None, "s"), (7, "", "en", "s"), (None, "c", "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("tokens", F.lit("clash"))
    got = token_rollup.deduplicated_rollup(docs, {"words-1": token_rollup.word_tokens, "letters": F.length}, fresh_path(spark, "rollup"))
    first = {}
    for i, t, lang, s in rows:
        key = ((i is not None, i or 0), (s is not None, s or ""), (lang is not None, lang or ""))
        if (t or "") not in first or key < first[t or ""][0]:
            first[t or ""] = (key, s, lang)
    want = defaultdict(Counter)
    for t, (_, s, lang) in first.items():
        t = t.replace("x.y@mail.example", "<email>")
        for k, n in (("words-1", len(t.split())), ("letters", len(t))):
            want[s, lang, k].update(d=1, n=n, c=len(t))
    assert {tuple(r) for r in got.collect()} == {(*k, v["d"], v["n"], v["c"]) for k, v in want.items()}
    empty = token_rollup.deduplicated_rollup(docs.limit(0), {"words-1": token_rollup.word_tokens}, fresh_path(spark, "rollup"))
    assert empty.count() == 0


def test_pipeline_stages_keep_columns_and_clean_documents(spark, tmp_path):
    rng = random.Random(6)
    clean = [" ".join(words(rng, 80)) + "." for _ in range(150)]
    item = " ".join(f"q{i}" for i in range(20))
    bad = [" ".join(w.upper() + "!!" for w in words(rng, 80)) for _ in range(50)]
    texts = clean + bad + [clean[0], clean[1] + " more", clean[2] + " " + item, "hi", None, "spam " * 100]
    docs = made(spark, texts)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    good = [(i, int(i < 150), 0) for i in range(200)]
    spark.createDataFrame(good, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), str(tmp_path)).columns == docs.columns
    got = corpus_pipeline.run(spark, str(tmp_path))
    ids = {r.doc_id for r in got.collect()}
    d = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, str(tmp_path))
        assert d.columns == docs.columns
    left = {r.doc_id for r in d.collect()}
    assert ids <= left and left >= set(range(150)) - {2} and not left & {*range(150, 202), 203, 204, 205}


def test_blocks_of_shared_buckets_unite_what_all_pairs_would(spark, monkeypatch):
    # versions of versions in several buckets that overlap, cut into many blocks
    monkeypatch.setattr(order_minhash, "BLOCK", 7)
    rng = random.Random(11)
    texts = {}
    for c in range(9):
        w = words(rng, 60)
        for v in range(8):
            w = list(w)
            for at in rng.sample(range(60), rng.choice([3, 9, 14])):
                w[at] = f"c{c}v{v}{at}"
            texts[f"{c}-{v}".encode()] = w
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()], "k binary, text string")
    buckets = [(b, k) for b in range(4) for k in texts if rng.random() < 0.8] + [(9, k) for k in texts]
    large = spark.createDataFrame(buckets, "b long, k binary")
    none = spark.createDataFrame([], "a binary, b binary")
    got = defaultdict(set)
    for r in order_minhash._settled(docs, large, none, order_minhash.components(none)).collect():
        got[bytes(r.root)].add(bytes(r.k))
    above = {k: k for k in texts}

    def top(k):
        while above[k] != k:
            k = above[k]
        return k

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if order_minhash.alignment(texts[a], texts[b]) >= 0.8 - 1e-9:
                above[top(b)] = top(a)
    want = defaultdict(set)
    for k in keys:
        want[top(k)].add(k)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)

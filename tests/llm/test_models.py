"""Language, toxicity, quality and lattice models on small made data."""

import math
import os
import random
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from freshet.llm import arrays, factorisation, language, lattice, toxicity

PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def words(rng, syllables, n):
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


def test_word_arrays_match_regex():
    texts = ["", "a bb  a\n\tccc", "É x y", "A a", "z" * 50, " lead and trail "]
    w = arrays.Words(texts)
    assert [(int(r), w.text(i)) for i, r in enumerate(w.rows)] == [(i, x) for i, t in enumerate(texts) for x in re.findall(r"[^\x20\x09-\x0D]+", t)]
    same = {}
    for i in range(len(w.rows)):
        same.setdefault(w.text(i), set()).add(int(w.hashes[i]))
    assert all(len(v) == 1 for v in same.values()) and len(set.union(*same.values())) == len(same)
    long = "ab cd " * 1000
    parts = list(arrays.slices([long, "", "x"], 100))
    assert "".join(p for rows, some in parts for r, p in zip(rows, some) if r == 0) == long


def test_kneser_ney_is_a_distribution():
    rng = random.Random(3)
    texts = [words(rng, ["ab", "ba", "c"], 50) for _ in range(5)]
    counts = Counter()
    for codes, rows in language._streams(texts):
        _, last, _ = language._windows(codes, rows)
        counts.update(tuple(int(c) for c in codes[e - 3 : e + 1]) for e in last)
    grams = np.array(list(counts), np.uint32)
    m = language.KneserNey(grams, np.array(list(counts.values())))
    seen = sorted({int(c) for g in counts for c in g[-1:]})
    for context in ([32, 97, 98], [99, 99, 99], [32, 32, 32]):
        p = np.exp(m.log_probs(np.array([[*context, c] for c in seen], np.uint32))).sum()
        unseen = np.exp(m.log_probs(np.array([[*context, 1000]], np.uint32)))[0]
        assert p + unseen == pytest.approx(1.0)


def test_languages_are_told_apart(spark):
    rng = random.Random(1)
    kinds = {"xx": ["ka", "lo", "mi"], "yy": ["she", "tru", "ong"], "zz": ["éa", "ñu", "za"]}
    rows = [(i, words(rng, kinds[k], 40), k) for i, k in enumerate(list(kinds) * 60)]
    docs = spark.createDataFrame([*rows, (900, None, "xx"), (901, "", "yy"), (902, "123 !!", "zz"), (903, "kalomi", None), (None, "shetru ong", None)], "doc_id long, text string, lang string")
    found = language.fit(docs)
    got = {r.doc_id: r for r in language.identify(docs, found).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows)
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[900].score == 0
    assert got[903].lang_pred == "xx" and got[None].lang_pred == "yy"
    assert all(0 <= r.score <= 1 for r in got.values())
    odd = spark.createDataFrame([(1, "qqqqwwwwxxxxvvvv " * 5)], "doc_id long, text string")
    assert language.identify(odd, found).first().rejected
    assert language.fit(docs.limit(0)).names == []
    assert language.identify(docs, language.fit(docs.limit(0))).where("lang_pred <> 'und'").count() == 0


def labelled(rng, n, mark):
    out = []
    for i in range(n):
        w = words(rng, ["th", "on", "er", "ing", "at"], 80).split()
        if i % 2:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(mark))
        out.append((" ".join(w), i % 2))
    return pd.DataFrame(out, columns=["text", "y"])


def test_toxic_words_are_found(spark):
    rng = random.Random(2)
    mark = ["worthless", "pathetic", "idiot", "scum"]
    model = toxicity.fit(labelled(rng, 600, mark))
    fresh = labelled(rng, 200, mark)
    score, _ = model.score(fresh["text"].tolist())
    assert ((score >= 0.5) == (fresh["y"] == 1)).mean() > 0.95
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "worthless idiot scum pathetic " * 5), (None, "at on")], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got[3].score > 0.5 > got[1].score == got[2].score
    assert toxicity.fit(fresh[fresh["y"] == 1]) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}


def test_machine_identity_and_learning(spark):
    m = factorisation.Machine(6, 3, seed=1)
    row, at, x = np.array([0, 0, 0, 1]), np.array([1, 3, 5, 2]), np.array([0.5, 1.0, 2.0, 1.0])
    pairs = sum(m.v[a] @ m.v[b] * p * q for a, b, p, q in [(1, 3, 0.5, 1.0), (1, 5, 0.5, 2.0), (3, 5, 1.0, 2.0)])
    assert m.margin(row, at, x, 2) == pytest.approx([pairs, 0.0])
    rng = random.Random(4)
    texts = [words(rng, ["th", "on", "er"], 60) for _ in range(400)]
    texts = [t.upper() if i % 2 else t for i, t in enumerate(texts)]
    data = pd.DataFrame({"text": texts, "y": [1 - i % 2 for i in range(400)]})
    model = factorisation.fit(data)
    docs = spark.createDataFrame([(1, None), (2, ""), (3, texts[1]), (4, texts[0]), (4, texts[0])], "doc_id long, text string")
    got = [(r.doc_id, r.score) for r in factorisation.score(docs, model).collect()]
    assert len(got) == 5 and all(0 <= s <= 1 for _, s in got)
    s = dict(got)
    assert s[4] > 0.9 and s[3] < 0.1 and s[1] == s[2]
    assert factorisation.fit(data[data["y"] == 1]) is None
    assert docs.withColumn("q", factorisation.probability(docs, model)).where("q > 0.5 and doc_id = 4").count() == 2


@pytest.mark.skipif(not os.path.exists(PIECES), reason="no vocabulary")
def test_lattice_sums_over_all_segmentations():
    p = lattice.Pieces(PIECES, {}, 3)
    at = {int(k): v for k, v in zip(p.keys, p.log_p)}

    def total(w):
        w = "▁" + w

        @lru_cache(None)
        def f(i):
            if i == len(w):
                return 1.0
            out = 0.0
            for j in range(i + 1, min(len(w), i + p.longest) + 1):
                h = int(lattice.Pieces._hash(w[i:j]))
                if h in at:
                    out += math.exp(at[h]) * f(j)
                elif j == i + 1:
                    out += math.exp(p.fallback(ord(w[i]))) * f(j)
            return out

        return math.log(f(0))

    some = ["the", "a", "thorough", "naïve", "日本", "x1", "zzz"]
    assert p.marginals(some) == pytest.approx([total(w) for w in some])


@pytest.mark.skipif(not os.path.exists(PIECES), reason="no vocabulary")
@pytest.mark.parametrize("head", [2, 500_000])
def test_scores_match_brute_force(spark, head):
    rng = random.Random(5)
    rows = [(i, words(rng, ["th", "On", "er", "é"], 30)) for i in range(60)] + [(60, None), (61, ""), (62, "never seen wørds"), (60, None), (None, "th on")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tokens = [(i, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for i, t in rows]
    out = lambda i: zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 1
    counts, ends = Counter(w for i, ws in tokens if not out(i) for w in ws), sum(not out(i) for i, _ in tokens)
    n, v = sum(counts.values()) + ends, len(counts) + 1
    base = lambda c: math.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    want = sorted((i if i is not None else -1, out(i), len(ws) + 1, sum(counts[w] > 0 for w in ws) + 1, round(sum(base(counts[w]) for w in ws) + base(ends), 6)) for i, ws in tokens)
    got = lattice.score(docs, PIECES, head_words=head).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n} and all(r.score < 0 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[60] == by[61]
    assert lattice.score(docs.limit(0), PIECES).count() == 0


def test_copies_do_not_eat_the_language_sample(spark):
    rng = np.random.default_rng(12)
    text = lambda letters: " ".join("".join(rng.choice(list(letters), 6)) for _ in range(20))
    schema = "doc_id long, text string, lang string"
    rows = [(i, text("abcdef"), "aa") for i in range(100)] + [(1000 + i, text("uvwxyz"), "zz") for i in range(100)] + [(5000, text("klmnop"), "kk")]
    hot = [spark.range(20_000).select("id", F.lit(text("abcdef")).alias("text"), F.lit("aa").alias("lang")) for _ in range(2)]
    docs = spark.createDataFrame(rows, schema).union(hot[0]).union(hot[1])
    got = language.sampled(docs, sample=50).toPandas()
    assert set(got["lang"]) == {"aa", "kk", "zz"} and not got.duplicated(["lang", "text"]).any()
    assert 20 <= (got["lang"] == "aa").sum() <= 80
    found = language.fit(docs, sample=50)
    assert found.names == ["aa", "kk", "zz"]
    assert {r.doc_id: r.lang_pred for r in language.identify(spark.createDataFrame(rows, schema), found).collect()} == {i: k for i, _, k in rows}


def test_rare_insults_are_found():
    rng = random.Random(13)
    insults = ["".join(rng.choice("bcdfgklmpqrvwxz") for _ in range(9)) for _ in range(100)]
    common = ["the", "house", "river", "walked", "with", "green", "under", "morning", "over", "little", "garden", "stone"]

    def texts(n, toxic):
        out = []
        for i in range(n):
            w = [rng.choice(common) for _ in range(60)]
            if i % 2:
                at = rng.randrange(len(w))
                w[at:at] = toxic()
            out.append((" ".join(w), i % 2))
        return pd.DataFrame(out, columns=["text", "y"])

    def recall(toxic):
        model, fresh = toxicity.fit(texts(3000, toxic)), texts(400, toxic)
        said = model.score(fresh["text"].tolist())[0] >= 0.5
        return said[fresh["y"] == 1].mean(), said[fresh["y"] == 0].mean(), model

    # each insult is in one of a hundred toxic texts and in no ordinary one
    right, wrong, model = recall(lambda: [rng.choice(insults)])
    assert right > 0.9 and wrong < 0.1
    assert {(t["words"], t["rule"]) for t in model.tried} >= {(1, "all toxic text"), (2, "all toxic text"), (4, "all toxic text"), (1, "frequent marking words")}

"""Quality rules, mixture, decontamination and license scan against brute force, with edge rows."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from freshet.llm import decontaminate, licenses, mixture, quality_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, h string, k1 long"
A = "one two three four five six seven eight nine ten eleven twelve"


def made(spark, texts, sources=None):
    rows = [(i, t, None, (sources or ["s"] * len(texts))[i], None, "x", "y", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


TEXTS = [None, "", "   \n\t ", "hi", A, A + " " + A, "a b c d e a b c d e f", "# x\n# x\n\n# x " + A, "é ü ß " * 40, "x" * 5000, "w%d " * 3 % (1, 2, 3) + A, A]


def by_hand(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(runs)
    hit = {j for i, r in enumerate(runs) if n[r] > 1 for j in range(i, i + 5)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit), failed


def test_rules_match_brute_force(spark):
    docs = made(spark, TEXTS)
    ratios = [0.5] * quality_rules.BUCKETS
    got = {r.doc_id: r.rules for r in quality_rules.apply_rules(docs, ratios).collect()}
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == by_hand(t), t
        assert r.kept == (not r.base_failed)
        assert r.score == (pytest.approx(0.5) if r.n_words else 0.0)


def test_ratio_prefers_trusted_text_and_filter_agrees(spark):
    good = [f"river level gauge {i} station reading rain flow bank water rises" for i in range(20)]
    bad = [f"buy pills now {i} cheap offer click win cash prize fast" for i in range(20)]
    docs = made(spark, good + bad)
    trusted = spark.createDataFrame([(i,) for i in range(10)], "trusted_id long")
    ratios = quality_rules.fit(docs, trusted, buckets=256)
    got = {r.doc_id: r.rules for r in quality_rules.apply_rules(docs, ratios).collect()}
    assert min(got[i].score for i in range(20)) > max(got[i].score for i in range(20, 40))
    kept = quality_rules.accepted(docs, ratios)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept} == set(range(20))
    assert quality_rules.fit(docs, trusted.limit(0)) == [0.0] * quality_rules.BUCKETS
    assert quality_rules.apply_rules(docs.limit(0), ratios).count() == 0


def test_every_good_label_is_trusted(spark):
    n = 250_000
    labels = spark.range(n).selectExpr("id AS doc_id", "int(id % 50 <> 0) AS quality", "CASE WHEN id % 3 = 0 THEN 0 END AS toxic")
    ids = quality_rules.trusted_ids(labels.union(labels.limit(100)))
    assert ids.count() == ids.distinct().count() == n - n // 50


def test_many_trusted_ids_are_merged_with_the_same_ratios(spark, monkeypatch):
    texts = [None, "", *(f"river level {i} rises" for i in range(30)), *(f"buy {i} pills" for i in range(30))]
    docs = made(spark, texts)
    # ids that repeat, ids that are missing, and trusted ids that are the hashes of texts
    docs = docs.union(docs.where("doc_id % 7 = 0")).union(docs.where("doc_id > 20").withColumn("doc_id", F.lit(None).cast("long")))
    trusted = docs.where("doc_id < 25").select(F.col("doc_id").alias("trusted_id")).union(docs.select(F.xxhash64(F.coalesce("text", F.lit(""))))).distinct()
    few = quality_rules.fit(docs, trusted, buckets=64)
    plans = []
    monkeypatch.setattr(DataFrame, "collect", lambda self, real=DataFrame.collect: (plans.append(self._jdf.queryExecution().executedPlan().toString()), real(self))[1])
    many = quality_rules.fit(docs, trusted, buckets=64, broadcast_rows=10)
    assert "SortMergeJoin" in plans[-1] and "Broadcast" not in plans[-1]
    assert many == few
    numbered = docs.fillna({"doc_id": -1})
    assert many == quality_rules.fit(numbered, spark.range(25).select(F.col("id").alias("trusted_id")), buckets=64)


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_mixture_meets_its_targets(spark):
    sources = ["b", None, "a", "c", "d", "empty", "b", "b"]
    texts = [None if s == "empty" else "w " * (1 + (i * 7) % 30) for i, s in ((i, sources[i % 8]) for i in range(400))]
    docs = made(spark, texts, [sources[i % 8] for i in range(400)])
    got = mixture.mix(docs).collect()
    assert len(got) == 400
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixture.mix(docs).collect()))
    of = {i: sources[i % 8] for i in range(400)}
    sizes = Counter()
    for r in got:
        sizes[of[r.doc_id]] += r.size
        assert r.taken <= 2 * r.size
    want = targets({s: sizes[s] for s in set(sources)})
    taken = Counter()
    for r in got:
        taken[of[r.doc_id]] += r.taken
        assert r.target == pytest.approx(want[of[r.doc_id]])
        assert r.source_size == sizes[of[r.doc_id]]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 15, s
    kept = mixture.mixed_documents(docs)
    assert {r.doc_id: r.taken for r in kept.collect()} == {r.doc_id: r.taken for r in got if r.taken}
    assert mixture.mix(docs.limit(0)).count() == 0


def test_mixture_of_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c", "s"), (None, "a b c", "s"), (1, "d", "s"), (1, "d", None)], "doc_id long, text string, source string")
    got = mixture.mix(docs).collect()
    assert len(got) == 4 and all(r.taken <= 2 * r.size for r in got)


def shingles(t):
    w = [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_leaks_match_brute_force(spark):
    item = " ".join(f"q{i}" for i in range(14))
    long = " ".join(f"word{i}" for i in range(3000))
    texts = [None, "", item, long + " " + item + " " + long, long, item.upper().replace(" ", ", "), item.replace("q5 ", ""), " ".join(item.split()[:9]), long + item, "q1 q2", item]
    docs = made(spark, texts)
    items = [(7, item), (7, item), (8, "too short here"), (9, None), (None, "n1 n2 n3 n4 n5 n6"), (10, long)]
    bench = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, doc_id string")
    want = set()
    for i, t in enumerate(texts):
        for k, q in items:
            s = shingles(q)
            if s and len(s & shingles(t)) >= 0.8 * len(s):
                want.add((i, k, len(s & shingles(t)), len(s)))
    got = [(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in decontaminate.find_leaks(docs, bench).collect()]
    assert sorted(got) == sorted(want)
    left = decontaminate.without_leaks(docs, bench)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == set(range(len(texts))) - {w[0] for w in want}
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


def test_shared_passage_leaks_everywhere(spark):
    item = " ".join(f"q{i}" for i in range(12))
    docs = made(spark, [f"start {i % 50} " + item + f" end {i % 50}" for i in range(500)])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert decontaminate.find_leaks(docs, bench).count() == 500


def test_license_scan_matches_brute_force(spark):
    texts = [
        None, "", "Released under the MIT License.", "under the mit license under the mit license", "under the mit x license", "Apache License, Version 2.0 and CC BY-NC",
        "cc by nc cc by nc", "This work is licensed under the GNU General Public License, version 3.", "this work is licensed under GNU general public license version 3",
        "UNDER THE MIT LICENSE " * 300, "é under the mit license", "nothing at all " * 500, "by nc cc", "under the m\u0130t license", "apache \u212ay license version 2 apache license version 2", "\u212a under the mit license",
    ]
    docs = made(spark, texts)
    got = {r.doc_id: r for r in licenses.digest(*licenses.scan(docs)).collect()}
    for i, t in enumerate(texts):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = [(p, label) for phrase, label in licenses.PHRASES for p in range(len(w)) if w[p : p + len(phrase.split())] == phrase.split()]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(w), len(at)), t
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in at}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert got[7].labels == got[8].labels == "gpl-3"
    assert got[5].labels == "apache-2,cc-by-nc"
    assert licenses.digest(*licenses.scan(docs.limit(0))).count() == 0
    assert math.isclose(got[2].score, 1.0)

"""Conversation repair, fill-in-the-middle and exact copies against brute force."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import conversation_repair as cr
from freshet.llm import exact_radix, fill_middle

STEP = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
FILL = {0: "user", 1: "user", 2: "assistant", 3: "user"}


def all_ways(rows):
    """Every edit sequence with at most two inserts in a row: (cost, letters, lines)."""
    inserts = ("", "I", "II")
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for edits in itertools.product("DKR", repeat=len(rows)):
            state, cost, lines, at = 0, 0, [], 0
            letters = "".join(itertools.chain(*zip(gaps, edits, strict=False))) + gaps[-1]
            for x in letters:
                role, text, fault = ("", "", 0) if x == "I" else rows[at]
                at += x != "I"
                if x == "D":
                    cost += 2
                    continue
                if fault in (1, 2) or (x == "K" and role[:1] not in STEP[state]):
                    break
                role = role if x == "K" else FILL[state]
                state = STEP[state][role[:1]]
                cost += {"K": 0, "R": 1, "I": 5}[x] + 5 * (fault == 3)
                lines.append(f"{role}:{text}")
            else:
                if state in (0, 3):
                    yield cost, letters, lines


def whole_search(rows):
    """The same by full strings per state, for conversations of any length."""
    alive = {0: (0, "", ())}

    def filled():
        out = dict(alive)
        for state, (cost, letters, lines) in alive.items():
            for _ in range(2):
                role = FILL[state]
                state, cost, letters, lines = STEP[state][role[0]], cost + 5, letters + "I", (*lines, f"{role}:")
                out[state] = min(out.get(state, (cost, letters, lines)), (cost, letters, lines))
        return out

    for role, text, fault in rows:
        new = defaultdict(list)
        for state, (cost, letters, lines) in filled().items():
            new[state].append((cost + 2, letters + "D", lines))
            if fault not in (1, 2):
                if role[:1] in STEP[state]:
                    new[STEP[state][role[:1]]].append((cost + 5 * (fault == 3), letters + "K", (*lines, f"{role}:{text}")))
                new[STEP[state][FILL[state][0]]].append((cost + 1 + 5 * (fault == 3), letters + "R", (*lines, f"{FILL[state]}:{text}")))
        alive = {s: min(v) for s, v in new.items()}
    return min(v for s, v in filled().items() if s in (0, 3))


def searched(rows):
    out = []
    c = cr.Conversation("c", lambda *r: out.append(r))
    held = 0
    for i, (role, text, fault) in enumerate(rows):
        c.turn(i, role, text, fault)
        held = max(held, len(c.waiting))
    c.end()
    return out[-1][5]["cost"], "".join(r[2] for r in out[:-1]), [f"{r[3]}:{r[4]}" for r in out[:-1] if r[3] is not None], held


def test_cheapest_edits_are_those_of_all_sequences():
    rng = random.Random(3)
    for n in range(4):
        for _ in range(60 if n else 1):
            rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), f"t{i}", rng.choice([0, 0, 0, 1, 2, 3])) for i in range(n)]
            cost, letters, lines = min(all_ways(rows))
            assert searched(rows)[:3] == (cost, letters, lines)
            assert whole_search(rows) == (cost, letters, tuple(lines))


def test_long_conversations_and_ties():
    rng = random.Random(4)
    kinds = [["user"], ["assistant"], ["system"], ["user", "assistant"], ["user", "user", "assistant", "system", "x"]]
    for trial in range(60):
        rows = [(rng.choice(kinds[trial % 5]), f"t{i}", rng.choice([0, 0, 0, 0, 1, 2, 3][: 1 + trial % 7])) for i in range(rng.randrange(1, 250))]
        cost, letters, lines = whole_search(rows)
        assert searched(rows)[:3] == (cost, letters, list(lines))


def test_undecided_part_stays_small():
    rng = random.Random(5)
    rows = [(("user", "assistant")[i % 2], f"t{i}", 3 if rng.random() < 0.05 else 0) for i in range(20_000)]
    assert searched(rows)[3] < 100


def expected_report(rows):
    """rows: (turn, role, text) of one conversation -> report, audit, hash."""
    rows = sorted([(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, marked = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        fault = 1 if not last else 2 if (role, text) in seen else 3 if last[0] not in ".!?" else 0
        seen.add((role, text))
        marked.append((role, text, fault))
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit, lines = whole_search(marked)
    pairs = list(zip(marked, marked[1:], strict=False))
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(sum(f == k for _, _, f in marked) for k in (1, 2, 3)),
        sum((a[0][:1], b[0][:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def test_repair_of_edge_rows(spark):
    rows = [
        (1, 0, "user", "Hello there.", "k"), (1, 1, "assistant", "Good.", "k"), (1, 1, "assistant", "Good.", "k"), (1, 4, "user", "open", "k"), (1, None, None, None, "k"),
        (2, 0, None, "x", "k"), (3, None, "user", "One.", "k"), (3, None, "assistant", "Two!", "k"), (None, 0, "user", "A.", "k"), (None, 1, "assistant", "B?\n ", "k"),
        (4, 0, "system", "S.", "k"), (4, 1, "", "long " * 50_000 + ".", "k"), (4, 2, "assistant", "Z.", "k"),
    ]
    schema = "conv_id long, turn long, role string, text string, key string"
    docs = spark.createDataFrame(rows, schema).withColumn("fault", F.lit(9)).withColumn("there", F.lit("x"))
    got = {r[0]: tuple(r[1:]) for r in cr.digest(cr.repair(docs)).collect()}
    by = defaultdict(list)
    for c, *r in rows:
        by[c].append(r[:3])
    assert got == {c: expected_report(r) for c, r in by.items()}
    gone = cr.digest(cr.repair(docs, there=F.lit(False))).collect()
    assert len(gone) == 5 and all(tuple(r[1:]) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in gone)
    assert cr.digest(cr.repair(docs.limit(0))).collect() == []
    stands = cr.repaired_turns(cr.repair(docs)).where("conv_id = 4").orderBy("step").collect()
    assert [r.role for r in stands] == ["system", "user", "assistant"]


def test_damaged_conversations_many_partitions(spark):
    rng = random.Random(8)
    text = lambda: rng.choice(["", " \n", "Yes.", "No!", "open end", "a b c?", "Yes.", "x" * 300 + "."])
    rows = [(c % 7 if c % 3 else 0, rng.choice([None, *range(40)]), rng.choice(["system", "user", "assistant", "assistant", "tool", None]), rng.choice([None, text()])) for c in range(900)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(13)
    harmed = cr.damaged(df)
    by = defaultdict(list)
    for r in harmed.where("there").collect():
        by[r.conv_id].append((r.turn, r.role, r.text))
    got = {r[0]: tuple(r[1:]) for r in cr.digest(cr.repair(harmed, there=F.col("there"))).collect()}
    assert got == {c: expected_report(r) for c, r in by.items()}


def test_ranks_of_the_wavelet_matrix():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 8, 511, 512, 513, 3000):
        symbols = rng.integers(0, 4, n).astype(np.uint8)
        m = fill_middle.WaveletMatrix(symbols, 2)
        for i in {0, n // 3, n // 2, n, *rng.integers(0, n + 1, 20).tolist()}:
            assert [m.rank(s, i) for s in range(4)] == [int((symbols[:i] == s).sum()) for s in range(4)]


@pytest.mark.parametrize("block", [1, 3, 1 << 18])
def test_cuts_are_at_tokens(monkeypatch, block):
    monkeypatch.setattr(fill_middle, "BLOCK", block)
    rng = random.Random(2)
    for _ in range(60):
        text = "".join(rng.choice("abZ .,\n9é漢😀_") for _ in range(rng.randrange(60)))
        tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        marks = fill_middle.Boundaries(text)
        assert marks.tokens == len(tokens)
        assert [marks.after(u) for u in range(len(tokens) + 1)] == [len("".join(tokens[:u])) for u in range(len(tokens) + 1)]


def test_fill_in_middle_round_trip(spark):
    rng = random.Random(6)
    texts = [None, "", "a", "x <P> y", "<S>", "<<", "word " * 40_000, "é" * 50, "<P", "S>"] + ["".join(rng.choice("ab <>PSM.漢\n") for _ in range(rng.randrange(80))) for _ in range(150)]
    rows = [(i % 120 if i else None, t, "p", "q") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, places string, fim string")
    made = fill_middle.fill_in_middle(docs)
    assert made.columns == ["doc_id", "text", "places", "fim"]
    got = made.select("doc_id", "text", "places", "fim.*", fill_middle.restored(F.col("fim.output"), F.col("fim.form")).alias("back")).collect()
    forms = set()
    for r in got:
        text = r.text or ""
        assert r.back == text and r.places == "p"
        digest = hashlib.sha256(f"1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
        tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
        p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
        plain = not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90
        form = "plain" if plain else "spm" if h[3] % 100 < 20 else "psm"
        forms.add(form)
        assert (r.n, r.form) == (len(tokens), form)
        assert r.output == {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        assert (r.prefix_chars, r.middle_chars) == ((None, None) if plain else (len(p), len(m)))
    assert forms == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(docs.limit(0)).collect() == []


def test_exact_copies_against_grouping(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh ") for _ in range(30_000))
    texts = [None, "", "a", "a ", "é", "é", long, long + "x", long[:-1], "y" + long, long[:64], long[:63], long[:320], long[:319], long[:321]]
    rows = [(rng.choice([None, *range(300)]), rng.choice(texts) if i % 3 else "hot " * 100, f"v{i % 5}") for i in range(400)]
    rows += [(7, "twice", "v"), (7, "twice", "v"), (None, "nobody", "v"), (None, "nobody", "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k string").repartition(6)
    docs = docs.withColumn("group", F.lit(1)).withColumn("run", F.lit("r")).withColumn("kept", F.lit("no")).withColumn("keep_k", F.lit(0))
    by = defaultdict(list)
    for i, t, _ in rows:
        by[t or ""].append(i)
    want = sorted(
        (str(i), str(max((x for x in ids if x is not None), default=None)), len(ids), k == 0, t[:70])
        for t, ids in by.items()
        for k, i in enumerate(sorted(ids, key=lambda x: (x is None, -(x or 0))))
    )
    got = exact_radix.label_copies(docs, carry={"doc_id": F.col("doc_id"), "t": F.coalesce("text", F.lit(""))}).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.t[:70]) for r in got) == want
    stay = exact_radix.without_copies(docs)
    assert stay.columns == docs.columns and stay.count() == len(by)
    assert exact_radix.label_copies(docs.limit(0)).collect() == []
    assert exact_radix.label_copies(docs.limit(1)).count() == 1


def test_new_queries_have_the_columns_of_their_contract(spark):
    from freshet.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").count()
    middle = queries.op12_fill_in_middle(spark, sf)
    assert middle.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"] and middle.count() == rows
    copies = queries.op13_exact_copies(spark, sf)
    assert copies.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and copies.count() == rows
    repaired = queries.op11_conversation_repair(spark, sf)
    assert repaired.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert repaired.count() == spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().count()

"""The Jaccard join, conversation repair and hard negatives against brute force."""

import hashlib
import itertools
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from regiscope.llm import conversation_repair, hard_negatives, jaccard_join, queries

from ..conftest import SF_SMALL
from .test_operators import SCHEMA, odd_rows

WORDS = [f"w{i}" for i in range(300)]


def shingles(text, k):
    words = text.translate({c: c + 32 for c in range(65, 91)}).encode("utf-8", "surrogatepass").split() if text else []
    words = [w for w in words if w]
    return {tuple(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))} if words else set()


def brute_join(rows, k, num, den):
    """(id, n_shingles, component_id, n_links) per row."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
            links[i], links[j] = links[i] + 1, links[j] + 1
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        key = (d is None, d or 0)
        least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((d, len(sets[i]), None if least[find(i)][0] else least[find(i)][1], links[i])
                   for i, (d, _) in enumerate(rows)), key=repr)


def family(rnd, n, size, edits):
    base = [rnd.choice(WORDS) for _ in range(size)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            t[rnd.randrange(len(t))] = rnd.choice(WORDS)
        out.append(" ".join(t[:len(t) - rnd.randrange(edits + 1)]))
    return out


@pytest.mark.parametrize("num,den", [(80, 100), (60, 100), (95, 100)])
def test_join_sets_equals_brute_force(num, den):
    rnd = random.Random(num)
    sets = []
    for n in (3, 12, 30, 80, 200):
        base = rnd.sample(range(10 ** 6), n)
        for _ in range(14):
            s = set(base)
            for _ in range(rnd.randrange(1 + n // 6)):
                s.discard(rnd.choice(base))
                s.add(rnd.randrange(10 ** 6))
            sets.append(s or {1})
    sets = [np.array(sorted(s), np.uint64) for s in {frozenset(x) for x in sets}]
    weight = [rnd.randrange(1, 5) for _ in sets]
    for side in (None, [rnd.randrange(1, 3) for _ in sets]):
        want = [0] * len(sets)
        pairs = set()
        for i, j in itertools.combinations(range(len(sets)), 2):
            both = len(np.intersect1d(sets[i], sets[j]))
            if (side is None or side[i] != side[j]) and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                want[i], want[j] = want[i] + weight[j], want[j] + weight[i]
                pairs.add((i, j))
        total, links = jaccard_join.join_sets(sets, num, den, weight, side)
        assert total.tolist() == want
        assert {tuple(sorted(x)) for x in links} <= pairs

        def classes(edges):
            root = list(range(len(sets)))
            for a, b in edges:
                a, b = (root[a], root[b])
                root = [min(a, b) if r in (a, b) else r for r in root]
            return root
        assert classes(links) == classes(pairs)


@pytest.mark.parametrize("chunked", [False, True])
def test_op11_equals_brute_force(spark, monkeypatch, chunked):
    rnd = random.Random(3)
    texts = [None, "", " \n", "one two", "One  TWO", "one two three four five", "a b c d e f"]
    for n, size, edits in ((25, 120, 8), (10, 40, 2), (8, 15, 1), (12, 300, 30)):
        texts += family(rnd, n, size, edits)
    passage = " ".join(rnd.choice(WORDS) for _ in range(60))
    texts += [passage + " " + " ".join(rnd.choice(WORDS) for _ in range(rnd.randrange(0, 40))) for _ in range(30)]
    texts += texts[7:20]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    if chunked:
        monkeypatch.setattr(jaccard_join, "GROUP_SETS", 4)
        monkeypatch.setattr(jaccard_join, "SALTS", 3)
        monkeypatch.setattr(jaccard_join, "DEALT_FROM", 3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = jaccard_join.jaccard_join(df).collect()
    assert sorted(map(tuple, got), key=repr) == brute_join(rows, 5, 80, 100)


def test_op11_edges(spark):
    rows = odd_rows()
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute_join([(r[0], r[1]) for r in rows], 5, 80, 100)
    assert sorted(map(tuple, got), key=repr) == want
    assert jaccard_join.jaccard_join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_op11_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = queries.QUERIES["op11_jaccard_join"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, got), key=repr) == brute_join([tuple(r) for r in docs.select("doc_id", "text").collect()], 5, 80, 100)


@pytest.mark.parametrize("num,den", [(80, 100), (60, 100), (95, 100)])
def test_prefixes_of_linked_sets_share_enough(num, den):
    rnd = np.random.default_rng(num)
    linked = 0
    for _ in range(3000):
        both = rnd.integers(1, 300)
        only, other = rnd.integers(0, 1 + both * (den - num) // num, 2)
        if den * both < num * (both + only + other):
            continue
        linked += 1
        order = rnd.permutation(both + only + other)  # places of the shingles in the order
        x, y = np.sort(order[:both + only]), np.sort(np.concatenate([order[:both], order[both + only:]]))
        prefix = [s[:jaccard_join.prefix_length(len(s), num, den) + jaccard_join.least_shared(len(s)) - 1] for s in (x, y)]
        assert len(np.intersect1d(*prefix)) >= jaccard_join.least_shared(min(len(x), len(y)))
    assert linked > 200


@pytest.mark.parametrize("num,den", [(80, 100), (60, 100)])
def test_op11_few_shared_shingles_make_no_group(spark, monkeypatch, num, den):
    rnd = random.Random(11)
    words = [f"v{i}" for i in range(40_000)]
    passages = [" ".join(rnd.sample(words, 6)) for _ in range(61)]  # two shingles shared with either neighbour
    texts = [f"{a} {' '.join(rnd.sample(words, 110))} {b}" for a, b in zip(passages, passages[1:])]
    for n, size, edits in ((12, 150, 9), (6, 400, 20), (5, 30, 2)):
        texts += family(rnd, n, size, edits)
    rows = list(enumerate(texts))
    # as in a large corpus, whose counters do not tell rare shingles apart
    monkeypatch.setattr(jaccard_join, "_order", lambda sig: np.zeros(jaccard_join.SKETCH, np.uint32))
    store, stored = jaccard_join.store, {}

    def counted(df, name):
        out = store(df, name)
        stored[name] = out.count()
        return out

    monkeypatch.setattr(jaccard_join, "store", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_join.jaccard_join(df, similarity=(num, den)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_join(rows, 5, num, den)
    assert 2 < stored["jaccard-members"] <= 23


# Conversation repair

def brute_repair(rows):
    """(cost, audit, sha256) of rows (role, text) in order, by trying states
    forward with whole audits and texts."""
    seen, held = set(), {0: (0, "", ())}

    def inserted(held):
        for _ in range(3):
            for s, (c, a, m) in list(held.items()):
                t, role = (3, "assistant") if s == 2 else (2, "user")
                new = (c + 5, a + "I", (*m, f"{role}:"))
                if t not in held or new[:2] < held[t][:2]:
                    held[t] = new
        return held

    for role, text in rows:
        kept = text.strip(" \t\n\x0b\x0c\r")
        gone = not kept or (role, text) in seen
        seen.add((role, text))
        more = 0 if gone or kept[-1] in ".!?" else 5
        new = {}

        def offer(s, c, a, m):
            if s not in new or (c, a) < new[s][:2]:
                new[s] = (c, a, m)

        for s, (c, a, m) in inserted(held).items():
            offer(s, c + 2, a + "D", m)
            if gone:
                continue
            to = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(role[:1], {}).get(s)
            if to is not None:
                offer(to, c + more, a + "K", (*m, f"{role}:{text}"))
            t, other = (3, "assistant") if s == 2 else (2, "user")
            offer(t, c + more + 1, a + "R", (*m, f"{other}:{text}"))
        held = new
    c, a, m = min((inserted(held)[s] for s in (0, 3) if s in held))
    return c, a, hashlib.sha256("\n".join(m).encode()).hexdigest()


def random_rows(rnd, n):
    roles = ["user", "assistant", "system", "tool", " ", "u2", ""]
    texts = ["Hello.", "hello", " ", "Why?", "no end ", "Done! \n", "x"]
    return [(rnd.choices(roles, [8, 8, 3, 1, 1, 1, 1])[0], rnd.choice(texts) + (str(rnd.randrange(9)) + "." if rnd.random() < .6 else ""))
            for _ in range(n)]


def test_auction_prices_and_trace_equal_brute_force():
    rnd = random.Random(5)
    for n in [*range(0, 9), 30, 64] * 6:
        rows = random_rows(rnd, n)
        seen, steps = set(), []
        for role, text in rows:
            steps += conversation_repair.steps(role, conversation_repair.fault(text, (role, text) not in seen), 1)
            seen.add((role, text))
        cost, audit, _ = brute_repair(rows)
        assert conversation_repair.solve(steps) == (cost, audit)
        out, price, target = conversation_repair.lattice(steps, conversation_repair.FINAL, True)
        conversation_repair.auction(out, price, 0, target)
        assert all(price[i] <= c + price[j] for i, arcs in enumerate(out) for _, c, j in arcs)
        cuts = sorted(rnd.randrange(len(steps) + 1) for _ in range(3))
        parts = [steps[a:b] for a, b in zip([0, *cuts], [*cuts, len(steps)])]
        solved = [conversation_repair.solve_between(p) for p in parts]
        path = conversation_repair.join_segments(solved)
        joined = "".join(a[4 * e + x] for (_, a), (e, x) in zip(solved, path))
        assert joined + conversation_repair.CLOSE[path[-1][1]][1] == audit


def test_op12_long_conversations_over_segments_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "SEGMENT", 5)
    rnd = random.Random(8)
    rows = []
    for conv, n in ((1, 160), (2, 3), (3, 0), (4, 41), (None, 12), (5, 1)):
        rows += [(conv, t, *r) for t, r in enumerate(random_rows(rnd, n))]
    rows += [(6, 1, "user", "Same text.")] * 50 + [(6, 2, "assistant", "Yes.")] + [(6, None, "user", "First.")]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, copies int, audit string").repartition(7)
    got = {r["conv_id"]: r for r in conversation_repair.summary(conversation_repair.repair(df)).collect()}
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, role, hashlib.sha256(text.encode()).hexdigest(), text))
    assert set(got) == set(convs)
    for c, held in convs.items():
        held = [(r[2], r[4]) for r in sorted(held)]
        assert (got[c]["cost"], got[c]["audit"], got[c]["repaired_sha256"]) == brute_repair(held), c
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(held, held[1:])]
        assert got[c]["illegal"] == sum(p not in ("su", "ua", "au") for p in pairs)
    assert (got[6]["gaps"], got[6]["duplicate"], got[6]["blank"]) == (0, 49, 0)
    out = conversation_repair.messages(conversation_repair.repair(df)).where("conv_id = 6").orderBy("segment", "at").collect()
    assert [r["edit"] for r in out if r["edit"] != "I"] == [e for e in got[6]["audit"] if e in "KR"]
    empty = spark.createDataFrame([], df.schema)
    assert conversation_repair.summary(conversation_repair.repair(empty)).count() == 0


def same(spark, name, tables, sf_dir, tmp_path):
    """Query and SQL twin on the given frames."""
    con = duckdb.connect()
    for t, df in tables.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{t}.parquet")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = queries.QUERIES[name](spark, str(tmp_path))
    want = con.sql(queries.SQL[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda r: tuple(map(repr, r))
    a = sorted((tuple(r[c] for c in cols) for r in got.collect()), key=key)
    b = sorted((r for r in con.sql(queries.SQL[name]).select(*cols).fetchall()), key=key)
    assert a == b
    return a


def test_op12_equals_sql_with_nulls_and_odd_texts(spark, tmp_path):
    rows = [(1, None, "user", "A."), (1, 0, None, "B."), (1, 1, "assistant", None), (None, 0, "user", "C?"),
            (None, None, None, None), (2, 5, "user", ""), (2, 9, "user", "é中. \t"), (3, -4, "system", "D."),
            (3, 1, "user", "E." * 100_000), (3, 2, "assistant", "F\x00!"), (3, 2, "assistant", "F\x00!"),
            (7, None, None, None), (8, 3, "", "x.")] + [(9, i, ["user", "assistant"][i % 2], f"t{i}.") for i in range(80)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    same(spark, "op12_conversation_repair", {"conversations": df}, SF_SMALL, tmp_path / "a")
    same(spark, "op12_conversation_repair", {"conversations": df.where("conv_id = 99")}, SF_SMALL, tmp_path / "b")


# Hard negatives

def brute_negatives(rows, anchor, k=5, m=5):
    rows = [(i, [int(np.floor(256 * float(x))) for x in v], g) for i, v, g in rows]
    out = []
    for a, va, ga in rows:
        if not anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, g) for i, v, g in rows if i != a)
        for s, p, _ in [r for r in scored if r[2] == ga][:k]:
            fit = [(i, t) for t, i, g in scored if g != ga and 80 * -s <= 100 * -t <= 100 * -s][:m]
            out += [(a, p, r, i, -s, -t) for r, (i, t) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 1 << 18])
def test_op13_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", block * 8)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 40)
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(6, 8))
    rows = [(int(i), (base[rnd.integers(6)] + 0.2 * rnd.normal(size=8)).round(2).tolist(), int(rnd.integers(3))) for i in range(160)]
    rows += [(200 + i, [0.5] * 8, i % 2) for i in range(40)]  # one vector, many rows
    rows += [(300, [0.1, 0.2], 0), (301, [], 1), (302, [9e3] * 8, 2)]
    bad = [(400, None, 1), (None, [0.5] * 8, 1), (401, [0.5] * 8, None), (402, [0.5] * 7 + [None], 1),
           (403, [float("nan")] * 8, 1), (404, [float("inf")] * 8, 1)]
    df = spark.createDataFrame([(*r, 0) for r in rows + bad + rows[:9]],
                               "vec_id long, embedding array<double>, label int, score int").repartition(5)
    got = sorted(map(tuple, hard_negatives.mine(df, F.col("id") % 10 == 0).collect()))
    assert got == brute_negatives(rows, lambda i: i % 10 == 0)
    assert hard_negatives.mine(df.where("vec_id < 0"), F.col("id") % 10 == 0).count() == 0


def test_op13_wide_scores_stay_exact():
    a = np.array([[2.0 ** 40, 3.0], [1.0, 2.0]])
    b = np.array([[2.0 ** 20, 1.0]])
    assert hard_negatives.products(a, b).tolist() == [[2 ** 60 + 3], [2 ** 20 + 2]]
    s = np.array([[2 ** 62, 5, 2 ** 62, 7]])
    row, col = hard_negatives.best(s, np.array([[True, True, True, False]]), 2)
    assert sorted(col.tolist()) == [0, 2]


def test_op13_equals_sql(spark, tmp_path):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label")
    assert same(spark, "op13_hard_negatives", {"embeddings": df}, SF_SMALL, tmp_path)

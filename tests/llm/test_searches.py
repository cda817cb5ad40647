"""Conversation repair, ranked search and the Jaccard join against brute force, and their stated edge cases."""

import hashlib
import heapq
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumencat.llm import conversation_repair as repair
from lumencat.llm import jaccard, lexical
from lumencat.llm.queries import QUERIES

# --- conversation repair ---------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, cost bigint, copy string"


def cheapest(rows):
    """(cost, audit, text) by best-first search over strings: rows are (role, text, fault)."""
    heap, done = [(0, "", 0, "", "")], set()
    while heap:
        cost, audit, at, last, text = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit, text

        def go(price, letter, to, role=None, body="", cost=cost, audit=audit, last=last, text=text):
            if role is None:
                heapq.heappush(heap, (cost + price, audit + letter, to, last, text))
                return
            initial = role[:1]
            if (initial == "s" and last == "" and letter == "K") or (initial == "u" and last in ("", "s", "a")) or (initial == "a" and last == "u"):
                line = f"{role}:{body}"
                heapq.heappush(heap, (cost + price, audit + letter, to, initial, text + "\n" + line if last else line))

        go(5, "I", at, "user")
        go(5, "I", at, "assistant")
        if at < len(rows):
            role, body, fault = rows[at]
            go(2, "D", at + 1)
            if fault not in (repair.BLANK, repair.DUPLICATE):
                stay = 5 * (fault == repair.TRUNCATED)
                go(stay, "K", at + 1, role, body)
                go(1 + stay, "R", at + 1, "user", body)
                go(1 + stay, "R", at + 1, "assistant", body)
    raise AssertionError


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        kind = 0
        if not re.search(r"[^\x20\x09-\x0D]", text):
            kind = repair.BLANK
        elif (role, text) in seen:
            kind = repair.DUPLICATE
        elif re.findall(r"[^\x20\x09-\x0D]", text)[-1] not in ".!?":
            kind = repair.TRUNCATED
        seen.add((role, text))
        out.append((role, text, kind))
    return out


def expected(rows):
    """The contract's columns from (turn, role, text) in order."""
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    marked = faults([(r, t) for _, r, t in rows])
    kinds = Counter(k for _, _, k in marked)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
    cost, audit, text = cheapest(marked)
    return gaps, kinds[1], kinds[2], kinds[3], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "S", "ß"]), st.sampled_from(["Yes.", "no", " ", "Go!", "", "a. "])), max_size=9))
def test_minimum_of_integers_equals_search(rows):
    r = repair.Repair()
    for i, (role, text, fault) in enumerate(faults(rows)):
        r.take(i, role.encode(), text.encode(), fault)
    assert r.plan() == expected([(i, role, text) for i, (role, text) in enumerate(rows)])


@pytest.mark.parametrize("block", [1, 2, 5, 64])
def test_letters_put_aside_change_nothing(monkeypatch, block):
    """Long conversations in blocks of rows, against one integer of full width by the search."""
    rng = np.random.default_rng(block)
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    for size in (7, 40, 150):
        rows = [(str(rng.choice(["system", "user", "assistant", "tool"])), str(rng.choice(["A.", "b", "", f"c{rng.integers(9)}."]))) for _ in range(size)]
        r = repair.Repair()
        for i, (role, text, fault) in enumerate(faults(rows)):
            r.take(i, role.encode(), text.encode(), fault)
        assert r.plan() == expected([(i, *x) for i, x in enumerate(rows)])


def brute_repair(rows):
    """All of op11 from (conv_id, turn, role, text)."""
    out = {}
    text = lambda x: " " if x is None else str(x)
    for conv, turn, role, body in rows:
        deal = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        role, body = text(role), text(body)
        kept = out.setdefault(conv, [])
        if deal == 0:
            continue
        body = "" if deal == 1 else re.sub("[.!?]", "", body) if deal == 2 else body
        kept += [(turn, "user" if deal == 4 else role, body)] * (2 if deal == 3 else 1)
    order = lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())
    return {c: expected(sorted(k, key=order)) for c, k in out.items()}


def test_repair_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op11_conversation_repair"](spark, sf_dir).collect()}
    assert found == brute_repair(rows)


def odd_conversations(spark):
    rows = [(c, t, r, x) for c in range(12) for t, (r, x) in enumerate([("user", "Hi."), ("assistant", None), (None, "x"), ("assistant", "Done."), ("user", "é" * 5000 + "!"), ("assistant", "ok ?\u0085")])]
    rows += [(None, 1, "user", "Of no id."), (None, None, None, None), (50, None, "user", "A."), (50, None, "assistant", "B."), (51, 9, "user", "A."), (51, 9, "user", "A."), (51, -4, "assistant", "B.")]
    rows += [(77, i // 2, ["user", "assistant"][i % 2], f"turn {i}.") for i in range(900)]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS), rows


def test_repair_of_odd_rows(spark):
    df, rows = odd_conversations(spark)
    plans = repair.repair_plans(repair.damaged(df)).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in plans} == brute_repair(rows)
    none = spark.createDataFrame([], TURNS)
    assert repair.repair_plans(repair.damaged(none)).count() == 0
    # every row dropped: the conversation stays
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    assert tuple(repair.repair_plans(repair.damaged(spark.createDataFrame([(5, gone, "user", "x")], "conv_id bigint, turn bigint, role string, text string"))).first())[1:] == expected([])


def test_repaired_turns_have_the_digest(spark):
    df, _ = odd_conversations(spark)
    rows = repair.damaged(df.where("conv_id is not null"))
    plans = repair.repair_plans(rows)
    lines = {}
    for r in repair.repaired_turns(rows, plans).orderBy("conv_id", "position").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        assert len(lines[r["conv_id"]]) == r["position"] + 1
    for p in plans.collect():
        assert hashlib.sha256("\n".join(lines.get(p["conv_id"], [])).encode()).hexdigest() == p["repaired_sha256"]


# --- ranked search -----------------------------------------------------------------


def brute_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute_ranking(docs, items, k=20):
    counted = [(d, Counter(brute_terms(t))) for d, t in docs]
    sizes = [c.total() for _, c in counted]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, []).extend(brute_terms(t))
    out = []
    for i, terms in asked.items():
        scores = []
        for (d, c), n in zip(counted, sizes, strict=True):
            if n:
                m = 100 - 25 + 25 * n * n_docs // total
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms if t in c)
                if score > 0:
                    scores.append((-score, d is None, d or 0))
        out += [(i, rank, None if null else d, -score) for rank, (score, null, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def ranking(found):
    return sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found.collect()], key=str)


@pytest.mark.parametrize("bucket, focus, block", [(256, 6, 200_000), (3, 1, 7)])
def test_ranking_equals_brute_force(spark, monkeypatch, bucket, focus, block):
    monkeypatch.setattr(lexical, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(lexical, "FOCUS", focus)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(40)] + ["İx", "Straße", "ÉÀ", "z9", "\U0001f600q"]
    weight = np.arange(1, 46)[::-1] ** 1.5
    make = lambda n: "-".join(str(w).upper() if rng.random() < 0.3 else str(w) for w in rng.choice(words, n, p=weight / weight.sum()))
    docs = [(i, make(int(rng.integers(1, 60)))) for i in range(300)] + [(7, make(30)), (None, make(30)), (None, None), (301, ""), (302, "...\n"), (303, "w1 " * 5000)] + [(400 + i, "w3 w4 w44") for i in range(30)]
    items = [(i, make(int(rng.integers(1, 25)))) for i in range(25)] + [(3, "w3 w3 w4"), (None, "w0 w5"), (90, None), (91, "nowhere")]
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id bigint, text string, term string, score bigint").repartition(5)
    q = spark.createDataFrame([(*r, "y") for r in items], "item_id bigint, text string, rank string")
    assert ranking(lexical.ranked_search(d, q, block_terms=block)) == brute_ranking(docs, items)


def test_ranking_of_empty_tables(spark):
    d, q = "doc_id bigint, text string", "item_id bigint, text string"
    some = spark.createDataFrame([(1, "a b")], d)
    item = spark.createDataFrame([(1, "a")], q)
    assert lexical.ranked_search(spark.createDataFrame([], d), item).count() == 0
    assert lexical.ranked_search(some, spark.createDataFrame([], q)).count() == 0
    assert ranking(lexical.ranked_search(some, item)) == brute_ranking([(1, "a b")], [(1, "a")])


def test_buckets_are_pruned():
    """Long vectors first: later buckets of the batch are not looked at once theta is out of their reach."""
    items = lexical.Items.build([(1, 0, 1)], np.array([1000]))
    found = lexical.Ranking(items, 5)
    looked = []
    whole = found._bucket
    found._bucket = lambda rows, *a: looked.append(len(rows)) or whole(rows, *a)
    impacts = np.concatenate([np.full(300, 900_000), np.full(3000, 1000)])
    n = len(impacts)
    found.search(np.arange(n), np.zeros(n, bool), np.arange(n + 1), np.zeros(n, np.int64), impacts)
    assert sum(looked) <= 512 and found.best[0][2].tolist() == [0, 1, 2, 3, 4]


@given(st.text(max_size=60))
def test_terms_equal_the_pattern(text):
    assert {t.decode(): n for t, n in lexical.term_counts(text.encode()).items()} == Counter(brute_terms(text))


def test_terms_of_long_texts(monkeypatch):
    monkeypatch.setattr(lexical, "CHUNK", 10)
    text = "Ab cd-éé ab " * 50 + "x" * 40 + " y"
    assert {t.decode(): n for t, n in lexical.term_counts(text.encode()).items()} == Counter(brute_terms(text))


# --- Jaccard join ------------------------------------------------------------------


def brute_sets(texts, n=3):
    out = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        size = min(n, len(words))
        out.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    return out


def brute_classes(rows, percent=90):
    """(doc_id, n_shingles, component_id) of each row."""
    sets = brute_sets([t for _, t in rows])
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    names = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            names[find(i)] = min(names.get(find(i), d), d)
    return sorted([(d, len(sets[i]), names.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)], key=str)


def varied(rng, base, share):
    return " ".join(f"x{rng.integers(10**6)}" if rng.random() < share else w for w in base)


def hard_texts(seed=4):
    """Chains of near copies, strays below the threshold, common passages, small sets, exact copies."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(120)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [varied(rng, base, s) for s in (0.0, 0.005, 0.01, 0.015, 0.02, 0.03, 0.05, 0.1) for _ in range(9)]
    texts += [" ".join(f"u{rng.integers(10**6)}" for _ in range(50)) + " " + passage for _ in range(40)]
    chain = [f"c{i}" for i in range(300)]
    for step in range(12):
        texts.append(" ".join(chain[step * 5 : step * 5 + 200]))
    small = [f"s{i}" for i in range(14)]
    texts += [" ".join(small[:k]) for k in range(15)] * 2 + ["A b C", "a B c", "a\tb\nc", "a", "A", "a b", "", " ", None]
    texts += ["same text again and again for every row " * 9] * 25
    return texts


def classes(found):
    return sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()], key=str)


@pytest.mark.parametrize("hashes, hot", [(2_000_000, 20), (600, 2)])
def test_classes_equal_brute_force(spark, monkeypatch, hashes, hot):
    """Whole shards, and shards cut into slices and blocks with keys counted as hot."""
    monkeypatch.setattr(jaccard, "SHARD_HASHES", hashes)
    monkeypatch.setattr(jaccard, "HOT_IN_SAMPLE", hot)
    rows = [*enumerate(hard_texts()), (None, "w0 w1 w2 and something else of no id"), (None, hard_texts()[0]), (3, "one more text under a used id")]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id bigint, text string, node string, label bigint, key string").repartition(6)
    assert classes(jaccard.jaccard_join(df)) == brute_classes(rows)


def test_other_thresholds(spark):
    rows = list(enumerate(hard_texts(9)[:100]))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert classes(jaccard.jaccard_join(df, percent=80)) == brute_classes(rows, 80)


def test_join_of_empty_tables(spark):
    kind = "doc_id bigint, text string"
    assert jaccard.jaccard_join(spark.createDataFrame([], kind)).count() == 0
    assert classes(jaccard.jaccard_join(spark.createDataFrame([(1, None), (2, "")], kind))) == [(1, 0, 1), (2, 0, 2)]


@pytest.mark.parametrize("percent", [80, 90, 95])
def test_similar_sets_share_a_key(percent):
    """Whatever differs: sets that link agree on a band, also where bands are empty."""
    rng = np.random.default_rng(percent)
    for size in [*range(4, 60), 100, 333, 1000]:
        a = np.unique(rng.integers(0, 2**64, size, np.uint64, endpoint=False))
        for _ in range(6):
            drop = int(rng.integers(0, size * (100 - percent) // 100 + 1))
            b = np.delete(a, rng.choice(len(a), drop, replace=False))
            more = np.unique(rng.integers(0, 2**64, int(rng.integers(0, size // 8 + 1)), np.uint64, endpoint=False))
            b = np.union1d(b, more)
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
                assert len(np.intersect1d(jaccard.band_keys(a, percent), jaccard.band_keys(b, percent)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=8, unique=True), max_size=9), st.integers(1, 5))
def test_merge_skip_counts(lists, least):
    documents, runs = [], []
    for own in lists:
        runs.append((len(documents), len(documents) + len(own)))
        documents += sorted(own)
    counts = Counter(documents)
    assert dict(jaccard.merge_skip(runs, documents, least, 2, 11)) == {d: n for d, n in counts.items() if n >= least and 2 <= d < 11}


def test_shard_search_equals_brute_force(monkeypatch):
    """Bitmaps of long lists, short lists merged, a centre or none, and those at home not asking."""
    monkeypatch.setattr(jaccard, "LONG_LIST", 2)
    sets = [s for s in (jaccard.shingle_set((t or "").encode()) for t in hard_texts(6)) if len(s)]
    sets = [*{s.tobytes(): s for s in sets}.values()]
    n = len(sets)
    plain = [set(s.tolist()) for s in sets]
    links = [(i, j) for i in range(n) for j in range(i) if 100 * len(plain[i] & plain[j]) >= 90 * len(plain[i] | plain[j])]

    def partition(pairs):
        root = list(range(n))
        find = lambda i: i if root[i] == i else find(root[i])
        for i, j in pairs:
            root[find(i)] = find(j)
        return {tuple(sorted(k for k in range(n) if find(k) == find(i))) for i in range(n)}

    for centre in (None, 0, 30):
        found = jaccard.linked_nodes(np.arange(n), sets, list(range(n)), [False] * n, 90, centre)
        assert {tuple(sorted(p, reverse=True)) for p in found} <= {*links}
        assert partition(found) == partition(links)
    home = [i < 40 for i in range(n)]
    found = jaccard.linked_nodes(np.arange(n), sets, [0 if h else i for i, h in enumerate(home)], home, 90)
    tied = [(i, 0) for i in range(40)]
    assert partition(found + tied) == partition(links + tied)


def test_sifted_rows_hold_all_wanted(spark):
    rows = spark.range(5000).select("id", F.xxhash64("id").alias("k"))
    wanted = spark.range(0, 5000, 50).select(F.xxhash64("id").alias("w"))
    found = {r["id"] for r in jaccard.sifted(rows, "k", wanted, "w").collect()}
    assert {*range(0, 5000, 50)} <= found and len(found) < 400

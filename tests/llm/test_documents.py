"""Operators on documents against brute force, and their stated edge cases."""

import binascii
import hashlib
import math
import re
import struct
import unicodedata

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

tokenizers = pytest.importorskip("tokenizers")

from pyspark.sql import functions as F

from lumencat.llm import bpe, common, language_id, packing, quality_classifier, quality_rules, simhash, stages
from lumencat.llm.components import components
from lumencat.llm.queries import QUERIES, WORD_BPE

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, score string, worker string, qr_stats string"
ODD = [None, "", " \n", "a", "!!!???" * 300, "the " * 400, "é" * 3000, "Hello World<|endoftext|>x don't 12 ΑΣ İs é \U0001f600\x85q\x1cz", "x'S'll''d ½ǅ①x²", "one two three four five six\n" * 3]


def rows(texts):
    return [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, 0, "x", "y", "z", "q") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    texts = [*ODD, *ODD, "word " * 20000, "alpha beta gamma delta " * 40]
    return spark.createDataFrame([*rows(texts), (None, "null id", "en", "s", 0, "", "", "", "")], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def brute_fingerprint(text, size=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, distance=4):
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= distance
    label = np.array(ids)
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return dict(zip(ids, label.tolist(), strict=True))
        label = new


def test_simhash_equals_brute_force(spark, sf_dir):
    docs = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    found = {r["doc_id"]: r for r in QUERIES["op2_simhash"](spark, sf_dir).collect()}
    assert {*found} == {*docs}
    fps = {i: brute_fingerprint(t) for i, t in docs.items()}
    assert {i: r["fingerprint"] for i, r in found.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r["component_id"] for i, r in found.items()} == brute_components([*fps], [*fps.values()])


@pytest.mark.parametrize("bands", [2, 3, 4, 5])
def test_fingerprint_links_keep_every_component(spark, bands, monkeypatch):
    """Dense clusters and chains, with shards and blocks small enough to be split."""
    monkeypatch.setattr(simhash, "SHARD_ROWS", 16)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres:
        for _ in range(60):
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(1, 9)):
                x ^= 1 << int(b)
            fps.add(x)
    fps |= {int(x) for x in rng.integers(0, 1 << 63, 300, dtype=np.uint64)}
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    edges = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp bigint"), 4, bands)
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    want = brute_components([*range(len(fps))], fps)
    mine = [roots.get(x, x) for x in signed]
    assert {(a, b) for a in range(len(fps)) for b in [want[a]]} == {(a, mine.index(mine[a])) for a in range(len(fps))}


def test_vp_tree_reaches_every_leaf_within_radius():
    values = np.arange(1 << 8)
    tree = simhash.VPTree.build(values, np.ones(len(values), int), 10)
    home = {int(v): leaf for leaf, at in tree.reach(values, 0) for v in at}
    assert len(home) == 256 and len({*home.values()}) == tree.leaves
    reach = {leaf: {*at.tolist()} for leaf, at in tree.reach(values, 2)}
    assert all(q in reach[home[v]] for v in range(256) for q in range(256) if (v ^ q).bit_count() <= 2)


def test_components_of_chain_star_and_noise(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == dict.fromkeys(range(61), 0) | dict.fromkeys(range(100, 160), 100) | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_simhash_edge_rows(spark, odd, empty):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    by = {r["doc_id"]: r for r in found}
    n = len(ODD)
    assert all(by[i]["fp"] == by[i + n]["fp"] and by[i]["component_id"] == by[i + n]["component_id"] for i in range(n))
    assert by[0]["fp"] == by[1]["fp"] == by[2]["fp"] == 0 and by[2]["component_id"] == 0
    assert by[None]["component_id"] is None
    assert simhash.near_duplicates(empty).count() == 0


def brute_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in windows if windows.count(w) > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len({*lines}), len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab #%\n\té|", max_size=60))
def test_text_stats_equal_brute_force(text):
    assert quality_rules.text_stats(text)[:5] == brute_stats(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab #A!\n\t\x1c\x85é|", max_size=40), max_size=6), st.integers(1, 60))
def test_stats_of_many_texts_equal_brute_force(texts, size):
    before, quality_rules.GROUP_CHARS = quality_rules.GROUP_CHARS, size
    try:
        found = quality_rules.batch_stats(texts)
    finally:
        quality_rules.GROUP_CHARS = before
    lines = [[x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)] for t in texts]
    want = [(*brute_stats(t), len(own), len(re.findall("[A-Z]", t)), t.count("!")) for t, own in zip(texts, lines, strict=True)]
    assert [tuple(r) for r in found.tolist()] == want


def test_quality_rules_keep_good_and_reject_bad(spark, sf_dir):
    found = {r["doc_id"]: r for r in QUERIES["op4_quality_rules"](spark, sf_dir).collect()}
    docs = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    assert {*found} == {*docs}
    for i in [*docs][:60]:
        r = found[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_stats(docs[i])
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["kept"] and r["base_failed"]) for r in found.values())
    labels = dict(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").collect())
    kept = {q: [found[i]["kept"] for i, x in labels.items() if x == q and i in found and not found[i]["base_failed"]] for q in (0, 1)}
    assert np.mean(kept[1]) > 0.97 and (not kept[0] or np.mean(kept[0]) < 0.1)


def brute_cut(values, lengths, side="high"):
    """The logarithm of a threshold from all values of a group; lengths: of its documents, none for a plain value."""

    def sketched(x):
        return 0.0 if x <= 1e-6 else quality_rules.GAMMA ** math.ceil(math.log(x) / math.log(quality_rules.GAMMA)) * 2 / (1 + quality_rules.GAMMA)

    quantile = lambda xs, q: sorted(xs)[math.ceil(q * len(xs)) - 1]
    typical = quantile([*map(sketched, lengths)], 0.5) if lengths else None
    z = sorted(math.log1p(sketched(x) * typical) if typical else math.log(sketched(x)) for x in values)
    low, high, far = quantile(z, 0.25), quantile(z, 0.75), math.log(quality_rules.GAP)
    if high > low:
        cut = high + quality_rules.FENCE * (high - low) if side == "high" else low - quality_rules.FENCE * (high - low)
    elif side == "high":
        gaps = [(a + b) / 2 for a, b in zip(z, z[1:]) if a >= high and b - a >= far]
        cut = gaps[0] if gaps else z[-1] + far
    else:
        cut = z[0] - far
    return math.log(math.expm1(cut) / typical) if typical else cut


def test_sketches_merge_to_thresholds(spark):
    """However rows are dealt, a group's cuts are those of all its values: quartiles that differ, gaps, and neither."""
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice([*"abcdefgh"], int(rng.integers(2, 9))))
    plain = [" ".join(word() for _ in range(int(rng.integers(55, 90)))) for _ in range(400)]
    often = [t + " " + "# " * int(rng.integers(0, 30)) for t in plain]
    rare = [t + (" $" if i % 9 == 0 else " $ $ &" if i % 50 == 0 else " " + "#" * 200 if i % 40 == 7 else "") for i, t in enumerate(plain)]
    for texts in (plain, often, rare):
        df = quality_rules.with_stats(spark.createDataFrame([(i, t, "en", "abc"[i % 3]) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string"))
        one, many = (quality_rules.cuts(quality_rules.sketch(d), ["lang"]).first() for d in (df.coalesce(1), df.repartition(7)))
        assert one == many
        facts = [dict(zip(quality_rules.STATS, quality_rules.text_stats(t), strict=True)) for t in texts]
        facts = [f for f in facts if f["n_words"] >= 50 and 100 * f["n_repeat_words"] <= 50 * f["n_words"]]
        for m, (formula, side, length) in quality_rules.MEASURES.items():
            top, bottom = formula.split(" / ")
            assert one[m] == pytest.approx(brute_cut([f[top] / f[bottom] for f in facts], [f[length] for f in facts] if length else None, side), abs=1e-9)
    # between what is usual and what is not: three symbols pass, two hundred do not
    assert 3 < math.exp(one["symbol_rate"]) * 72 < 200


def test_no_threshold_is_a_constant(spark):
    """Every measure's threshold differs between the groups of one corpus, and between corpora."""
    found = []
    for sf in ("sf0.001", "sf0.01"):
        stats = quality_rules.with_stats(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet"))
        found.append(quality_rules.thresholds(quality_rules.sketch(stats)).toPandas())
    for m in quality_rules.MEASURES:
        assert all(t[m].nunique() > 10 for t in found)
        assert not {*found[0][m].round(9)} & {*found[1][m].round(9)}


def test_thresholds_follow_their_group(spark):
    """The fence tightens and loosens with its group; documents that one group keeps another rejects."""
    rng = np.random.default_rng(6)

    def text(size, spread):
        return " ".join("".join(rng.choice([*"abcdefghij"], int(k))) for k in np.clip(rng.normal(size, spread, 80), 1, 60))

    near, wide = [(i, text(5, 0.5), "en", "near") for i in range(1500)], [(4000 + i, text(rng.uniform(3, 9), 0.5), "en", "wide") for i in range(1500)]
    planted = [(2000, text(14, 0.5), "en", "near"), (2001, text(14, 0.5), "en", "wide"), (2002, text(2, 0.5), "en", "near"), (2003, text(2.2, 0.5), "en", "wide")]
    df = spark.createDataFrame([*near, *wide, *planted], "doc_id bigint, text string, lang string, source string")
    stats = quality_rules.with_stats(df)
    limits = quality_rules.thresholds(quality_rules.sketch(stats))
    cut = {r["source"]: r for r in limits.collect()}
    assert cut["near"]["long_words"] < 13 < 16 < cut["wide"]["long_words"] and cut["near"]["short_words"] > 2.3 > cut["wide"]["short_words"]
    kept = {r["doc_id"]: r["qr_kept"] for r in quality_rules.judged(stats, limits).collect()}
    assert [kept[i] for i in range(2000, 2004)] == [False, True, False, True]
    assert np.mean([kept[i] for i in kept if i < 2000 or i >= 4000]) > 0.99


def test_quality_rules_edge_rows(spark, odd, empty):
    for df in (odd, empty):
        stats = quality_rules.with_stats(df)
        found = quality_rules.judged(stats, quality_rules.thresholds(quality_rules.sketch(stats)))
        assert found.count() == df.count()
    assert not any(r["qr_kept"] for r in found.collect())


def crc(i):
    return binascii.crc32(str(i).encode())


def test_quality_classifier_on_held_out_rows(spark):
    found = QUERIES["op5_quality_classifier"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality is not null")
    rows_ = found.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (crc(r["doc_id"]) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows_)
    held = [r for r in rows_ if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95


M64 = (1 << 64) - 1


def brute_mixed(x):
    x = (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 & M64
    return x ^ (x >> 32)


def brute_units(text):
    """Buckets of a text's units, character by character."""
    runs, kind_of = [], lambda c: "s" if c in whites else {"L": "w", "N": "n"}.get(unicodedata.category(c)[0], "o")
    whites = {chr(c) for c in bpe.WHITE}
    for c in text or "":
        kind = kind_of(c)
        if runs and runs[-1][0] == kind:
            runs[-1][1].append(c)
        else:
            runs.append((kind, [c]))
    out = []
    for kind, chars in runs:
        if kind == "w":
            out.append(sum((ord(c.lower()[0]) + 1) * pow(quality_classifier.MULTIPLIER, i + 1, 1 << 64) for i, c in enumerate(chars)) & M64)
            if len(chars) > 1 and all(c != c.lower() for c in chars):
                out.append(quality_classifier.CAPITALS)
        elif kind == "n":
            out.append(quality_classifier.NUMBERS)
        elif kind == "o":
            out.append(ord(chars[0].lower()[0]) * 4 + min(len(chars), 3) + 8)
    return [brute_mixed(u) >> 46 for u in out]


def brute_context(units):
    """Column and sign of each entry of a document's vector."""
    seed = sum(brute_mixed(u + 1) for u in {*units}) & M64
    drawn = [brute_mixed(seed + quality_classifier.MULTIPLIER * j & M64) for j in range(1, 9)]
    return {d % 8 + 8 * j: 1 if d >> 63 else -1 for j, d in enumerate(drawn)}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abAB ÉéΣ1²_!#\n\u0301", max_size=30), max_size=5))
def test_units_equal_brute_force(texts):
    assert [u.tolist() for u in quality_classifier.text_units(texts)] == [brute_units(t) for t in texts]


@pytest.mark.parametrize("parts", [1, 5])
def test_word_vectors_and_scores_equal_brute_force(spark, monkeypatch, parts):
    """Sums over all documents, whatever the partitions; pooling and the network in plain Python."""
    monkeypatch.setattr(quality_classifier, "FAN_IN", 2)
    texts = ["Alpha beta GAMMA 12, alpha!", "beta gamma; delta", "alpha ALPHA ... 7 delta", None, "", "epsilon beta beta"]
    rows_ = [(i, t) for i, t in enumerate(texts)] + [(9, texts[1])]
    df = spark.createDataFrame(rows_, "doc_id bigint, text string").repartition(parts)
    sums = {}
    for _, t in rows_:
        units = brute_units(t)
        for u in {*units}:
            for column, sign in brute_context(units).items():
                sums.setdefault(u, [0] * 64)[column] += sign
    table = quality_classifier.word_vectors(df)
    assert {*np.flatnonzero(table.any(axis=1)).tolist()} == {u for u, v in sums.items() if any(v)}
    for u, v in sums.items():
        length = sum(x * x for x in v) ** 0.5
        assert table[u].tolist() == [round(127 * x / length) if length else 0 for x in v]
    net = quality_classifier.train(np.random.default_rng(0).normal(size=(40, 68)), np.arange(40) % 2.0)
    found = {r["doc_id"]: r["score"] for r in quality_classifier.scored(df, (table, net)).collect()}
    for i, t in enumerate(texts):
        units = brute_units(t)
        n, distinct = len(units), len({*units})
        mean = [sum(int(table[u][k]) for u in units) / (127 * n) if n else 0.0 for k in range(64)]
        x = np.array([*mean, *([np.log1p(n) / 10, distinct / n, np.log1p(n / distinct) / 3, sum(m * m for m in mean) ** 0.5] if n else [0.0] * 4)])
        hidden = [np.tanh(sum((x[a] - net.centre[a]) / net.spread[a] * net.w1[a, b] for a in range(68)) + net.b1[b]) for b in range(32)]
        logit = sum(h * w for h, w in zip(hidden, net.w2, strict=True)) + net.b2
        assert found[i] == pytest.approx(1 / (1 + np.exp(-logit / net.temperature)), abs=1e-5)


def test_quality_classifier_edge_rows(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (3, None, 0), (4, 7, 0)], "doc_id bigint, quality int, toxic int")
    usable = quality_classifier.remainder(F.col("doc_id"), 5) != 0
    for labels in (none, one):
        model = quality_classifier.fit(odd, labels, usable)
        scores = [r["score"] for r in quality_classifier.scored(odd, model).collect()]
        assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores) and len({*scores}) == 1
    both = spark.createDataFrame([(i, int(i % 2)) for i in range(20)], "doc_id bigint, quality int")
    model = quality_classifier.fit(odd, both, usable)
    assert quality_classifier.scored(empty, model).count() == 0


def brute_entropy(model_texts, lang, text):
    """Interpolated Kneser-Ney from the definition, over class trigrams."""
    grams = [tuple((k >> s) & 127 for s in (14, 7, 0)) for t in model_texts[lang] for ks in language_id.trigrams(t) for k in ks.tolist()]
    tri = {}
    for g in grams:
        tri[g] = tri.get(g, 0) + 1
    d3 = language_id.discount(np.array([*tri.values()]))
    pre = {}
    for a, b, c in tri:
        pre.setdefault((b, c), set()).add(a)
    d2 = language_id.discount(np.array([len(v) for v in pre.values()]))
    uni = {}
    for b, c in pre:
        uni.setdefault(c, set()).add(b)
    total1 = sum(map(len, uni.values()))

    def p1(c):
        return max(len(uni.get(c, ())) - 0.5, 0) / total1 + 0.5 * len(uni) / total1 / 128

    def p2(b, c):
        total = sum(len(v) for (x, _), v in pre.items() if x == b)
        if not total:
            return p1(c)
        kinds = sum(1 for x, _ in pre if x == b)
        return max(len(pre.get((b, c), ())) - d2, 0) / total + d2 * kinds / total * p1(c)

    def p3(a, b, c):
        total = sum(n for g, n in tri.items() if g[:2] == (a, b))
        if not total:
            return p2(b, c)
        kinds = sum(1 for g in tri if g[:2] == (a, b))
        return max(tri.get((a, b, c), 0) - d3, 0) / total + d3 * kinds / total * p2(b, c)

    keys = [k for ks in language_id.trigrams(text) for k in ks.tolist()]
    return -np.mean([np.log(p3(k >> 14, k >> 7 & 127, k & 127)) for k in keys])


def test_kneser_ney_equals_definition(spark):
    texts = {"x": ["abba cab", "bac a"], "y": ["zyx yyz", "xyz zé"]}
    df = spark.createDataFrame([(k, t) for k, v in texts.items() for t in v], "lang string, text string")
    model = language_id.fit(df)
    assert model.langs == ["x", "y"] and (np.diff(model.keys) > 0).all()
    for t in ("abc", "zyz é", "qqq", "A-b,b!"):
        got = model.entropies(t)
        assert got == pytest.approx([brute_entropy(texts, k, t) for k in ("x", "y")], rel=1e-5)


def test_trigram_slices_do_not_matter(monkeypatch):
    text = "Ab, cd -- éf\n\n ghi 12 j" * 7
    whole = np.concatenate([*language_id.trigrams(text)])
    for size in (1, 2, 5, 16):
        monkeypatch.setattr(language_id, "SLICE", size)
        assert (np.concatenate([*language_id.trigrams(text)]) == whole).all()


def test_language_id_on_held_out_rows(spark):
    found = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows_ = found.join(docs, "doc_id").collect()
    assert len(rows_) == docs.count() and all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows_)
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows_ if r["held_out"]]) > 0.97


def test_language_id_edge_rows(spark, odd, empty):
    found = {r["doc_id"]: r for r in language_id.identified(odd, F.lit(True)).collect()}
    assert len(found) == odd.select("doc_id").distinct().count()
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (0, 1, 2, 4)) and found[3]["lang_pred"] == "en"
    assert language_id.identified(empty, F.lit(True)).count() == 0
    assert {r["lang_pred"] for r in language_id.identified(odd, F.lit(False)).collect()} == {"und"}


def library():
    t = tokenizers.Tokenizer.from_file(WORD_BPE)
    t.no_padding()
    t.no_truncation()
    return t


def test_bpe_equals_library_on_documents(spark, sf_dir):
    t, docs = library(), dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for r in QUERIES["op9_bpe"](spark, sf_dir).collect():
        ids = t.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        plain = t.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest() and r["decoded_sha256"] == hashlib.sha256(plain.encode()).hexdigest()


CODERS = {}


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="the and'sréß\n <|endoftext|>12!Σ", max_size=200)))
def test_encoder_equals_library(text):
    if not CODERS:
        CODERS.update(own=bpe.TextEncoder(WORD_BPE), t=library())
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    want = CODERS["t"].encode(text, add_special_tokens=False).ids
    assert CODERS["own"].ids(text).tolist() == want
    decoder = bpe.TokenDecoder(CODERS["own"].table, joined=True)
    assert b"".join(decoder.push(want[i : i + 3]) for i in range(0, len(want), 3)).decode() == CODERS["t"].decode(want, skip_special_tokens=False)


def test_letters_that_compose_in_lower_case_only():
    """NFC comes before lower case: these capitals have no composed form, their small letters do."""
    t = library()
    pairs = ["H\u0331", "T\u0308", "W\u030a", "Y\u030a", "J\u030c", "T\u0344", "H\u05b0\u0331", "T\u0323\u0308", "I\u0307", "E\u0301"]
    texts = [*pairs, *(p + "anun plain Words" for p in pairs), " ".join(pairs), "Plain É Words", "h\u0331anun"]
    assert [ids.tolist() for ids in bpe.TextEncoder(WORD_BPE).batch(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 255), min_size=1, max_size=30))
def test_lockstep_equals_single_transducer(raw):
    """Words of any bytes: each step picks the same token, and so does applying the merges by rank."""
    if "own" not in CODERS:
        CODERS.update(own=bpe.TextEncoder(WORD_BPE), t=library())
    enc = CODERS["own"]
    symbols = [enc.table.symbols[b] for b in raw]
    single = [*enc.single.push(symbols[:-1]), *enc.single.finish(symbols[-1])]
    ids, counts = enc.machine.encode(np.array(raw * 2, np.uint8), np.array([0, len(raw)]), np.array([len(raw)] * 2))
    assert ids.tolist() == single * 2 and counts.tolist() == [len(single)] * 2
    assert enc.table._merge([enc.table.vocab[s] for s in symbols[:-1]] + [enc.table.vocab[symbols[-1] + enc.table.end]]) == single


def test_transducer_emits_early_in_constant_memory():
    table = bpe.MergeTable(WORD_BPE)
    machine, out, most = bpe.Transducer(table), [], 0
    word = "thethein" * 3000
    for c in word[:-1]:
        out += machine.push(c)
        most = max(most, len(machine.text))
    assert len(out) > 1000 and most < 8 * table.lookahead
    out += machine.finish(word[-1])
    assert out == library().encode(word, add_special_tokens=False).ids


def test_texts_longer_than_a_group(monkeypatch):
    monkeypatch.setattr(bpe, "GROUP_BYTES", 50)
    text = "some words of éé plain text, <|endoftext|>" * 20 + "é" * 300
    want = library().encode(text, add_special_tokens=False).ids
    assert [ids.tolist() for ids in bpe.TextEncoder(WORD_BPE).batch([text, None, "a", text])] == [want, [], library().encode("a", add_special_tokens=False).ids, want]


def test_decoder_gives_text_back():
    table = bpe.MergeTable(WORD_BPE)
    ids = library().encode("Plain words, é and \U0001f600!", add_special_tokens=False).ids
    decoder = bpe.TokenDecoder(table)
    assert b"".join([*(decoder.push([i]) for i in ids), decoder.finish()]).decode() == "plain words , é and \U0001f600! "


def test_decoded_text_column(spark):
    t = library()
    texts = ["Plain words, é!", "x<|endoftext|>\U0001f600", ""]
    df = spark.createDataFrame([(t.encode(x, add_special_tokens=False).ids,) for x in texts] + [(None,)], "ids array<bigint>")
    assert [r[0] for r in df.select(bpe.decoded_text(F.col("ids"), WORD_BPE)).collect()] == ["plain words , é ! ", "x <|endoftext|>\U0001f600 ", "", None]


def check_packing(pieces, texts, whole=True):
    """Every id in one piece, sequences gapless; whole: pieces are all there are."""
    t = library()
    by_doc, by_seq = {}, {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert {*by_doc} == {*texts}
    for i, own in by_doc.items():
        ids = [*t.encode(texts[i] or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            part = ids[at : at + r["length"]]
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == binascii.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at or not whole
            at += r["length"]
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding / sum(r["length"] for r in pieces)


def test_packing_of_documents(spark, sf_dir):
    docs = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    assert check_packing(QUERIES["op8_packing"](spark, sf_dir).collect(), docs) < 0.02


def test_packing_edge_rows(spark, odd, empty):
    known = odd.where("doc_id is not null")
    check_packing(packing.harmonic_pack(known, WORD_BPE).collect(), dict(known.select("doc_id", "text").collect()))
    assert packing.harmonic_pack(odd, WORD_BPE).where("doc_id is null").count() >= 1
    assert packing.harmonic_pack(empty, WORD_BPE).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 20000))
def test_cuts_cover_a_document(total):
    at = 0
    for start, length in packing.cuts(total, 2048, packing.class_lengths(2048)):
        assert start == at and 0 < length <= 2048
        at += length
    assert at == total


def test_stages_on_odd_documents(spark, sf_dir, odd, empty):
    for stage in (stages.quality_rules, stages.quality_classifier, stages.simhash_dedup):
        for df in (odd, empty):
            kept = stage(spark, df, sf_dir)
            assert kept.columns == df.columns and kept.schema == df.schema and kept.count() <= df.count()
    pieces = stages.packing(spark, odd, sf_dir).collect()
    known = [r for r in pieces if r["doc_id"] is not None]
    check_packing(known, dict(odd.where("doc_id is not null").select("doc_id", "text").collect()), whole=False)
    assert sum(r["length"] for r in pieces if r["doc_id"] is None) == 3 and stages.packing(spark, empty, sf_dir).count() == 0
    kept = [r["doc_id"] for r in stages.simhash_dedup(spark, odd, sf_dir).collect()]
    assert len(kept) == len({*kept}) and all(i < len(ODD) or i >= 2 * len(ODD) for i in kept if i is not None)


def with_threshold(spark, value):
    """stored(), after which Spark broadcasts up to value; set back by the fixture below."""

    def store(df):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
        return common.stored(df)

    return store


@pytest.fixture(autouse=True)
def same_threshold(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_every_group_keeps_one_row(spark, sf_dir, monkeypatch):
    """Null ids in unrelated groups, a null-id copy of a row with an id, one id with two texts, copies that differ in another column."""
    a, b, c, d, e = (" ".join(f"{w}{i}" for i in range(30)) for w in "abcde")
    docs = [(None, a, "x"), (None, b, "x"), (None, c, "x"), (3, c, "x"), (5, d, "x"), (5, e, "x"), (4, d, "x"), (None, a, "w"), (None, b, "x"), (3, c, "x")]
    df = spark.createDataFrame([(i, t, "en", s) for i, t, s in docs], "doc_id bigint, text string, lang string, source string")
    found = []
    for most in ("-1", "10m"):
        monkeypatch.setattr(stages, "stored", with_threshold(spark, most))
        for n in (1, 7):
            found.append(sorted(((r["doc_id"], r["text"], r["source"]) for r in stages.simhash_dedup(spark, df.repartition(n), sf_dir).collect()), key=str))
    assert sorted(found[0], key=lambda r: r[1])[1:] == [(None, b, "x"), (3, c, "x"), (4, d, "x"), (5, e, "x")]
    assert sum(r[1] == a for r in found[0]) == 1 and all(f == found[0] for f in found)


def test_both_ways_of_joining_give_the_same(spark, sf_dir, odd, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = []
    for most in ("-1", "10m"):
        monkeypatch.setattr(stages, "stored", with_threshold(spark, most))
        kept = stages.simhash_dedup(spark, stages.quality_rules(spark, docs, sf_dir), sf_dir)
        found.append(sorted(r["doc_id"] for r in kept.collect()))
    assert found[0] == found[1] and found[0]


def test_pipeline_equals_its_operators(spark, sf_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    pieces = pipeline.run(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = {r["doc_id"] for r in QUERIES["op4_quality_rules"](spark, sf_dir).collect() if r["kept"]}
    good &= {r["doc_id"] for r in QUERIES["op5_quality_classifier"](spark, sf_dir).collect() if r["predicted"]}
    texts = {i: t for i, t in docs.select("doc_id", "text").collect() if i in good}
    classes = brute_components([*texts], [brute_fingerprint(t) for t in texts.values()])
    assert {r["doc_id"] for r in pieces} == {i for i, c in classes.items() if i == c}
    check_packing(pieces, {i: t for i, t in texts.items() if classes[i] == i})

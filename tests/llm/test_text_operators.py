"""Operators on documents against brute force, on awkward small tables."""

import base64
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from reviewlake.llm import bpe, jaccard_join, mixing, quality_classifier, quality_rules, sharding, token_codes, toxicity
from reviewlake.llm.components import components
from reviewlake.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string, n_words string, score string, shard string"
WORDS = [f"w{i}" for i in range(400)]


def _row(doc_id, text, source="s0"):
    return (doc_id, text, None, source, None, "clash", "clash", "clash", "clash")


def _mutated(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = rng.choice(WORDS) + "x"
    return out


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, a shared passage, ties, NULLs, empty and long texts, repeated rows."""
    rng = random.Random(5)
    made = [_row(None, "no id " * 30), _row(1, None), _row(2, ""), _row(3, " \n\t "), _row(4, "one"), _row(5, "ONE"), _row(6, "one two three")]
    base = [rng.choice(WORDS) for _ in range(120)]
    made += [_row(10 + i, " ".join(_mutated(rng, base, i % 6)), "hot") for i in range(60)]
    passage = " ".join(rng.choice(WORDS) for _ in range(50))
    made += [_row(100 + i, " ".join(rng.choice(WORDS) for _ in range(60)) + "\n" + passage, None) for i in range(40)]
    made += [_row(200 + i, "the same text in many rows again and again until it is long enough to count " * 3) for i in range(50)]
    made += [_row(300, "repeated row of some words here"), _row(300, "repeated row of some words here"), _row(301, "other text"), _row(301, "one two three")]
    made += [_row(400, " ".join(rng.choice(WORDS) for _ in range(30_000)), "s1"), _row(401, "# * $ % & | < > " * 20), _row(402, "LOUD WORDS HERE!! " * 20)]
    made += [_row(403, "Élan  vital naïve\tx \n\n y'all we're 12345 \U0001f600<|endoftext|>"), _row(404, "a b c d e f g h\n" * 9 + "tail of nine other words that are here once only")]
    return made


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < n else [tuple(words[i : i + n]) for i in range(len(words) - n + 1)])


def _brute_components(rows, percent, n):
    sets = [(r[0], _shingles(r[1], n)) for r in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in itertools.combinations([s for s in sets if s[0] is not None and s[1]], 2):
        if 100 * len(x & y) >= percent * len(x | y):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return Counter((d, len(s), None if d is None else root(d)) for d, s in sets)


@pytest.mark.parametrize("percent, n", [(85, 4), (80, 5)])
def test_jaccard_components(docs, rows, percent, n):
    found = jaccard_join.jaccard_components(docs, percent, n)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(map(tuple, found.collect())) == _brute_components(rows, percent, n)


def test_jaccard_many_near_copies(spark):
    rng = random.Random(9)
    bases = [[rng.choice(WORDS) for _ in range(70)] for _ in range(4)]
    made = [(i, " ".join(_mutated(rng, bases[i % 4], rng.randrange(9)))) for i in range(400)]
    found = jaccard_join.jaccard_components(spark.createDataFrame(made, "doc_id long, text string").repartition(3), 85, 4)
    assert Counter(map(tuple, found.collect())) == _brute_components(made, 85, 4)


def _brute_links(rows, percent, n):
    sets = [(r[0], _shingles(r[1], n)) for r in rows]
    similar = lambda x, y: 100 * len(x & y) >= percent * len(x | y)
    return Counter(
        (d, len(s), 0 if d is None or not s else sum(e is not None and j != i and bool(z) and similar(s, z) for j, (e, z) in enumerate(sets)))
        for i, (d, s) in enumerate(sets)
    )


def test_links_inside_components_are_all_found(spark, docs, rows):
    rng = random.Random(9)
    bases = [[rng.choice(WORDS) for _ in range(70)] for _ in range(2)]
    made = [(i, " ".join(_mutated(rng, bases[i % 2], rng.randrange(6)))) for i in range(600)]
    found = jaccard_join.link_counts(spark.createDataFrame(made, "doc_id long, text string").repartition(3), 85, 4)
    assert found.columns == ["doc_id", "n_shingles", "n_links"]
    assert Counter(map(tuple, found.collect())) == _brute_links(made, 85, 4)
    assert Counter(map(tuple, jaccard_join.link_counts(docs, 85, 4).collect())) == _brute_links(rows, 85, 4)


def test_groups_in_several_cells(spark, monkeypatch):
    """Copies of sets, two groups that only an own link connects, parts of about 20 sets and few columns at a time."""
    monkeypatch.setattr(jaccard_join, "GROUP_PART", 20)
    rng = random.Random(4)
    bases = [[rng.choice(WORDS) for _ in range(70)] for _ in range(2)]
    made = [(i, " ".join(_mutated(rng, bases[i % 2], rng.randrange(5)))) for i in range(160)]
    made += [(1000 + i, made[i][1]) for i in range(0, 160, 7)]
    found = jaccard_join.jaccard_join(spark.createDataFrame(made, "doc_id long, text string").repartition(3), 85, 4)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    got = list(map(tuple, found.collect()))
    assert Counter(r[:3] for r in got) == _brute_components(made, 85, 4)
    assert Counter((r[0], r[1], r[3]) for r in got) == _brute_links(made, 85, 4)


@pytest.mark.parametrize("parts", [(0, 0), (0, 1)])
def test_links_of_a_cell(parts, monkeypatch):
    monkeypatch.setattr(jaccard_join, "COLUMNS", 7)
    rng = random.Random(6)
    leader = set(range(40))
    sets = [(leader - set(rng.sample(range(40), rng.randrange(6)))) | set(rng.sample(range(40, 60), rng.randrange(6))) for _ in range(30)]
    part = [rng.choice(parts) for _ in sets]
    copies = [rng.randrange(1, 4) for _ in sets]
    cell = pa.table({
        "low": [parts[0]] * 30, "high": [parts[1]] * 30, "part": part, "cls": list(range(30)), "size": list(map(len, sets)), "copies": copies,
        "apart": pa.array([sorted(s ^ leader) for s in sets], pa.list_(pa.int64())),
    })
    got = {r["cls"]: r["others"] for r in jaccard_join._cell_links(85)(cell).to_pylist()}
    meets = lambda i, j: i != j and (part[i] != part[j] or parts[0] == parts[1])
    want = {
        i: sum(copies[j] for j in range(30) if meets(i, j) and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])) for i in range(30)
    }
    assert got == {i: n for i, n in want.items() if n}


def _brute_kept(rows, percent, n):
    """One text of each group of similar ones, by (doc_id, text); texts without words stay as often as they occur."""
    sets, kept = {}, Counter()
    for r in rows:
        if grams := _shingles(r[1], n):
            sets.setdefault(grams, []).append((r[0] is None, r[0] or 0))
        else:
            kept[r[0]] += 1
    keys, root = list(sets), {g: g for g in sets}

    def top(g):
        while root[g] is not g:
            g = root[g]
        return g

    for a, b in itertools.combinations(keys, 2):
        if 100 * len(a & b) >= percent * len(a | b):
            root[top(a)] = top(b)
    groups = {}
    for g in keys:
        groups.setdefault(top(g), []).extend(sets[g])
    for members in groups.values():
        none, doc_id = min(members)
        kept[None if none else doc_id] += 1
    return kept


def test_keep_one_per_component(docs, rows):
    kept = jaccard_join.keep_one_per_component(docs, 80, 5)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == _brute_kept(rows, 80, 5)


def test_keep_one_decides_by_text_not_by_id(spark):
    first, second, third = (" ".join(f"{p}{i}" for i in range(30)) for p in "xyz")
    rows = [(1, first), (1, second), (1, second), (2, first + " end"), (None, second), (None, third), (None, third), (7, ""), (7, None)]
    docs = spark.createDataFrame([(i, t, "own") for i, t in rows], "doc_id long, text string, at string").repartition(4)
    kept = jaccard_join.keep_one_per_component(docs, 80, 5).collect()
    assert {r["at"] for r in kept} == {"own"}
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter([(1, first), (1, second), (None, third), (7, ""), (7, None)])
    unique = docs.where(F.col("text") == first).unionByName(docs.where("doc_id = 2"))
    assert [(r["doc_id"], r["text"]) for r in jaccard_join.keep_one_per_component(unique, 80, 5).collect()] == [(1, first)]


def test_jaccard_empty(empty):
    assert jaccard_join.jaccard_components(empty).count() == 0
    assert jaccard_join.keep_one_per_component(empty).count() == 0


def test_list_pairs_skip_nothing_needed():
    rng = np.random.default_rng(0)
    size = np.sort(rng.integers(5, 12, 60)).astype(np.int32)
    pos = np.concatenate([np.sort(rng.integers(0, 4, (size == s).sum())) for s in np.unique(size)]).astype(np.int32)
    cls = np.arange(60)
    left, right = jaccard_join._list_pairs(cls, size, pos, 85)
    got = {tuple(sorted(p)) for p in zip(left.tolist(), right.tolist())}
    need = lambda a, b: -(-85 * int(size[a] + size[b]) // 185)
    want = {
        (a, b) for a, b in itertools.combinations(range(60), 2)
        if 100 * min(size[a], size[b]) >= 85 * max(size[a], size[b]) and size[a] - pos[a] >= need(a, b) and size[b] - pos[b] >= need(a, b)
    }
    assert got == want and len(left) == len(got)


def test_components_of_chain_star_and_cycle(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 202), (202, 200), (None, 5), (7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert all(found[i] == 0 for i in range(41)) and all(found[100 + i] == 100 for i in range(50))
    assert [found[i] for i in (200, 201, 202)] == [200] * 3
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mixing_gives_every_document_and_meets_budgets(docs, rows):
    mixed = mixing.mix(docs, 0.95, 4.0)
    assert mixed.columns[: len(docs.columns)] == docs.columns
    got = mixed.select("doc_id", "source", "mix_tokens", "mix_weight", "mix_epoch").collect()
    assert {(r["doc_id"], r["source"]) for r in got} == {(r[0], r[3]) for r in rows}
    tokens = Counter()
    for r in rows:
        tokens[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    drawn, weight = Counter(), {}
    for r in got:
        drawn[r["source"]] += r["mix_tokens"]
        weight[r["source"]] = r["mix_weight"]
    assert abs(sum(weight.values()) - 1) < 1e-9
    budget = max(tokens.values()) / weight[max(tokens, key=tokens.get)]
    for source in tokens:
        assert abs(drawn[source] - weight[source] * budget) <= max(200, 0.2 * tokens[source])
        assert drawn[source] <= 4.01 * tokens[source] + 200
    again = mixing.mix(docs.repartition(2), 0.95, 4.0).select("doc_id", "source", "mix_tokens", "mix_weight", "mix_epoch").collect()
    assert Counter(again) == Counter(got)


def test_mixing_exponent(spark):
    totals = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10)], "_mix_source string, tokens long")
    shares = np.array([1000, 100, 10]) / 1110

    def entropy(e):
        w = shares**e / (shares**e).sum()
        return -(w * np.log(w)).sum()

    e = mixing.fit_exponent(totals, 0.8, None)
    assert abs(entropy(e) - 0.8 * np.log(3)) < 1e-6
    assert abs(mixing.fit_exponent(totals, 0.99, 5.0) - (1 - np.log(5) / np.log(100))) < 1e-6
    assert mixing.fit_exponent(totals, 0.1, None) == 1.0


def test_mixing_budget_and_empty(docs, empty):
    mixed = mixing.mix(docs, None, 1.0, budget_tokens=20_000)
    drawn = sum(r["mix_tokens"] for r in mixed.select("mix_tokens").collect())
    assert drawn < 36_000
    assert mixing.mix(empty).count() == 0


def _rules_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n


def test_quality_rules(docs, rows, empty):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = quality_rules.judge(docs)
    found = judged.select("doc_id", *names, "kept").collect()
    assert Counter(tuple(r)[:-1] for r in found) == Counter((r[0], *_rules_by_hand(r[1])) for r in rows)
    kept = {r["doc_id"]: r["kept"] for r in found}
    assert not kept[401] and not kept[402] and not kept[1] and kept[400] and kept[100]
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.judge(empty).count() == 0


def test_a_filter_on_the_verdict_stays_above_the_features(docs):
    judged = quality_rules.judge(docs)
    assert judged.where("kept").count() == sum(r["kept"] for r in judged.select("kept").collect())


def test_keep_good_leaves_columns_of_any_name(docs):
    named = docs.selectExpr("doc_id", "text", "doc_id AS kept", "'x' AS n_words", "doc_id AS _words", "'y' AS in0", "doc_id AS `a.b`")
    got = quality_rules.keep_good(named)
    assert got.schema == named.schema
    want = [r["doc_id"] for r in quality_rules.judge(docs).where("kept").collect()]
    assert Counter(map(tuple, got.drop("text").collect())) == Counter((d, d, "x", d, "y", d) for d in want)


def test_cascade_order_changes_cost_only(docs):
    rules = quality_rules.rules()
    measured = {r.name: (1.0, i / 10) for i, r in enumerate(rules)}
    ordered = quality_rules.cascade(rules, measured)
    assert [r.name for r in ordered] == [r.name for r in reversed(rules)]
    rows = quality_rules.features(docs)
    both = rows.select(
        quality_rules.verdict(rules, quality_rules.base_failed()).alias("a"), quality_rules.verdict(ordered, quality_rules.base_failed()).alias("b")
    )
    assert both.where("a <> b").count() == 0


def test_quality_classifier_learns_and_holds_out(spark, empty):
    rng = random.Random(1)
    made = [(i, " ".join(rng.choice(WORDS) + ("%%%" if i % 5 == 0 else "") for _ in range(40))) for i in range(600)] + [(900, None), (901, ""), (None, "x")]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(0, 600, 2)] + [(5, None), (None, 1), (7777, 0)], "doc_id long, quality int")
    found = quality_classifier.score_documents(docs, labels).collect()
    assert len(found) == len(made)
    for r in found:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in found if r["held_out"] and r["doc_id"] < 600]
    assert sum(r["predicted"] == int(r["doc_id"] % 5 != 0) for r in held) >= 0.97 * len(held)
    assert quality_classifier.score_documents(docs, labels.limit(0)).where("score <> 0.5").count() == 0
    assert quality_classifier.score_documents(empty, labels).count() == 0


def test_quality_of_held_out_labels(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_classifier.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in scored)
    assert right >= 0.9 * len(scored)


def test_toxicity_chain(spark, empty):
    rng = random.Random(2)
    bad = ["idiot", "scum", "trash", "zorgword"]
    made = [(i, " ".join(rng.choice(WORDS) for _ in range(60)) + (" " + bad[i // 4 % 4] if i % 4 == 0 else "")) for i in range(800)]
    made += [(900, None), (901, ""), (None, "x")]
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(500)] + [(5, None), (None, 1)], "doc_id long, toxic int")
    scored = toxicity.score_toxicity(docs, labels)
    assert scored.columns == ["doc_id", "p_insult", "p_contempt", "p_toxic", "toxic"]
    found = scored.collect()
    assert len(found) == len(made)
    unseen = [r for r in found if r["doc_id"] is not None and 500 <= r["doc_id"] < 800]
    assert sum(r["toxic"] for r in unseen if r["doc_id"] % 4 == 0) >= 70  # of 75, each told by a single word
    assert sum(r["toxic"] for r in unseen if r["doc_id"] % 4) == 0
    kept = toxicity.reject_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in found if not r["toxic"]}
    assert toxicity.score_toxicity(docs, labels.limit(0)).where("toxic").count() == 0
    assert toxicity.score_toxicity(empty, labels).count() == 0


@pytest.mark.parametrize("table,recall", [("sf0.01", 0.6), ("sf0.1", 0.8)])
def test_toxicity_of_labels_kept_out(spark, table, recall):
    """A third of the labels trains nothing. Most toxic words of the smaller table occur in no trained text."""
    documents = spark.read.parquet(f"/root/testdata/{table}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{table}/labels.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    kept_out = labels.where(out).select("doc_id", F.col("toxic").alias("marked"))
    rows = toxicity.score_toxicity(documents.join(labels, "doc_id", "left_semi"), labels.where(~out)).join(kept_out, "doc_id").collect()
    hits = sum(r["toxic"] for r in rows if r["marked"] == 1)
    assert hits >= recall * sum(r["marked"] == 1 for r in rows)
    assert hits >= 0.97 * sum(r["toxic"] for r in rows if r["marked"] is not None)


def test_telling_grams_by_hand(spark):
    made = [(1, 0, [5, 7]), (1, 1, [5, 7]), (1, 2, [5]), (1, 0, [5]), (1, 1, [5, 9]), (1, 2, [5]), *[(0, k % 3, [7, 8]) for k in range(9)]]
    rows = spark.createDataFrame(made, "toxic int, fold int, grams array<long>")
    masks = toxicity.telling_grams(rows, 16)
    for model, fold in (("all", None), ("fold0", 0), ("fold1", 1), ("fold2", 2)):
        counts = {g: [t for t, f, grams in made if f != fold and g in grams] for g in range(16)}
        want = []
        for g, marks in counts.items():
            n, p = len(marks), sum(marks) / max(1, len(marks))
            low = (p + 1.96**2 / (2 * n) - 1.96 * math.sqrt(p * (1 - p) / n + 1.96**2 / (4 * n * n))) / (1 + 1.96**2 / n) if n else 0
            want += [g] if low >= 0.4 else []
        assert np.flatnonzero(masks[model]).tolist() == want


@pytest.fixture(scope="module")
def reference_encoding():
    with open(tokenizer_file("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("block_bytes", [50, 1 << 24])
def test_bpe_equals_library(docs, rows, empty, reference_encoding, block_bytes):
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    found = bpe.digest_documents(docs, path, public_tokenizers.PATTERN, block_bytes).collect()
    want = Counter()
    for r in rows:
        ids = reference_encoding.encode_ordinary(r[1] or "")
        want[r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, found)) == want
    assert bpe.digest_documents(empty, path, public_tokenizers.PATTERN).count() == 0


def test_bpe_replay_of_a_vocabulary_out_of_order():
    tokens = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"bc": 400, b"aa": 500, b"aaa": 450, b"aaaa": 700}
    ranks = bpe.Ranks(tokens)
    rng = random.Random(3)
    words = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(12))) for _ in range(300)] + [b"a" * n for n in range(9)]

    def greedy(word):
        parts = [bytes([b]) for b in word]
        while True:
            best = min(((tokens.get(x + y, 1 << 30), i) for i, (x, y) in enumerate(zip(parts, parts[1:]))), default=(1 << 30, 0))
            if best[0] == 1 << 30:
                return [tokens[p] for p in parts]
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    flat, counts = bpe.replay(words, ranks)
    got = [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    assert got == [greedy(w) for w in words]


def test_token_codes_round_trip(spark, docs, rows, empty, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    assert 50256 in tokenizer.encode("a<|endoftext|>b", add_special_tokens=False).ids
    path = str(tmp_path / "codes")
    found = token_codes.encode_documents(docs, tokenizer_file("byte_bpe_50k.json"), path, segment_ids=5_000).orderBy("start").collect()
    want = Counter((r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + (0,)) for r in rows)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == Counter(
        {(d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())): n for (d, ids), n in want.items()}
    )
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda d: -1 if d is None else d)
    assert [r["start"] for r in found] == np.cumsum([0, *(r["n_tokens"] for r in found)])[:-1].tolist()
    long_ids = next(ids for d, ids in want if d == 400)
    assert token_codes.read_range(spark, path, 400, 1000, 1020) == list(long_ids[1000:1020])
    assert token_codes.read_range(spark, path, 999, 0, 5) == []
    assert token_codes.encode_documents(empty, tokenizer_file("byte_bpe_50k.json"), str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("top", [1, 2, 200, 50_257, 2**32])
def test_codes_random_access(top):
    rng = np.random.default_rng(top)
    ids = (rng.random(20_000) ** 3 * top).astype(np.uint32)
    codes = token_codes.Codes(token_codes.pack(ids, [None, 7], np.array([5, 19_995])))
    assert (codes.all() == ids).all() and codes.doc_ids == [None, 7] and codes.counts.tolist() == [5, 19_995]
    assert all(codes[int(i)] == ids[i] for i in rng.integers(0, 20_000, 300))
    with pytest.raises(IndexError):
        codes[20_000]


def test_sharding_moves_few_rows(docs, rows, empty, spark):
    found = sharding.shard_documents(docs, 24, ranges=16).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows
    )
    assert all(r["law"] == "key" and r["grown_shard"] in (r["shard"], 24) for r in found)
    per_key = {}
    for r in found:
        per_key.setdefault(r["doc_id"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in per_key.values())
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    many = spark.range(40_000).selectExpr("id AS doc_id", "'x' AS text")
    counts = sharding.shard_documents(many, [1.0, 1.0, 2.0, 0.0]).groupBy("shard").count().collect()
    got = {r["shard"]: r["count"] for r in counts}
    assert set(got) == {0, 1, 2} and abs(got[2] - 20_000) < 600 and abs(got[0] - 10_000) < 500
    assert sharding.shard_documents(empty, 24).count() == 0


def test_written_shards(docs, rows, spark, tmp_path):
    sharding.write_shards(docs.drop("shard"), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows) and back.select("shard").distinct().count() <= 4


def test_a_block_of_the_encoder_is_small(monkeypatch):
    met = []

    class Table:
        def encode_all(self, texts):
            met.append(sum(len(t) for t in texts))
            return []

    monkeypatch.setattr(bpe, "corpus_encoder", lambda path, pattern: Table())
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(64)), "text": ["x" * (1 << 18)] * 64})
    assert len(list(bpe.encoded(iter([batch]), "", ""))) == 8
    assert sum(met) == 64 << 18 and max(met) <= 2 << 20

"""Manifest, decontamination and vector codes against brute force, on awkward small tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from reviewlake.llm import decontaminate, merkle, vector_codes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos string, marks string, digest string"


def _low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def _docs(n_hot):
    rng = random.Random(3)
    made = [(None, "No id", None, "s", 5), (None, "No id", None, "s", 5), (7, None, "xx", None, None), (8, "", "", "s", 0), (9, "Alone É", "zz", "s", 7)]
    made += [(20, "Twice", "de", "s", 5)] * 3 + [(20, "Other", "de", "s", 5), (-4, "minus", "de", "s", 5)]
    made += [(1000 + i, f"Text {rng.randrange(50)} " * rng.randrange(1, 4), "en", "hot", i) for i in range(n_hot)]
    made += [(500 + i, "Straße Ä", f"l{i}", "s", 3) for i in range(70)] + [(999, "Very Long " * 30_000, "en", "s", 1)]
    return [(*r, "clash", "clash", "clash", "clash") for r in made]


def _hash(parts):
    return sha256("".join(parts).encode()).hexdigest()


def _brute_manifest(rows):
    def leaf(doc_id, text, lang, source, n_chars):
        return _hash("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([_hash(levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
        return levels

    def others(levels, at):
        for level in levels[:-1]:
            start = at // 8 * 8
            yield level[start:at], level[at + 1 : start + 8]
            at //= 8

    groups = defaultdict(list)
    for r in rows:
        changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        other = leaf(r[0], None if r[1] is None else _low(r[1]), *r[2:5]) if changed else None
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(*r[:5]), other, r[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = Counter()
    for place, g in enumerate(names):
        for at, (_, _, own, other, doc_id) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            way = [*others(trees[g], at), *others(top, place)]
            folded = other or own
            for left, right in way:
                folded = _hash([*left, folded, *right])
            proof = _hash(x for left, right in way for x in (*left, *right))
            out[doc_id, own, trees[g][-1][0], top[-1][0], proof, folded, folded == top[-1][0]] += 1
    return out


@pytest.mark.parametrize("n_hot", [0, 1200])
def test_manifest(spark, n_hot):
    rows = _docs(n_hot)
    found = merkle.digest_manifest(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, found.collect())) == _brute_manifest(rows)


def test_manifest_of_one_and_no_record(spark):
    rows = [(1, "One", "en", "s", 3)]
    one = merkle.digest_manifest(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert Counter(map(tuple, one.collect())) == _brute_manifest(rows)
    assert merkle.digest_manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_versions_share_what_they_do_not_copy():
    nodes = [sha256(bytes([i % 256, i // 256])).digest() for i in range(513)]
    levels = merkle.grown(nodes[:512], 513)
    assert [len(x) for x in levels] == [512, 64, 8, 1] and merkle.width_above(513) == 2
    way = merkle.siblings(levels, 77)
    assert merkle.unpack(merkle.pack(way)) == way
    assert merkle.copied(nodes[77], way) == [levels[1][9], levels[2][1], levels[3][0]]
    version = merkle.copied(b"\0" * 32, way)
    assert len(version) == 3 and not set(version) & {x for level in levels for x in level}


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _low(text or ""))


def _brute_marks(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        words, hit, found = _words(text), set(), set()
        for item, item_text in items:
            own = _words(item_text)
            size = min(window, len(own))
            windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
            starts = [i for i in range(len(words) - size + 1) if size and tuple(words[i : i + size]) in windows]
            hit.update(j for i in starts for j in range(i, i + size))
            if starts and item is not None:
                found.add(item)
        listed = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(words), len(hit), len(found), sha256(listed.encode()).hexdigest(), bool(hit)))
    return Counter(out)


@pytest.fixture(scope="module")
def contaminated():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)] + ["été", "don"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(1, 40))) for i in range(12)] + [(10, text(15)), (10, text(15)), (None, text(12)), (50, None), (51, ""), (52, "-- !"), (53, "UPPER Case")]
    items += [(60 + i, items[3][1]) for i in range(5)]
    docs = [(None, text(30)), (1, None), (2, ""), (3, "\n\t -"), (4, "upper,case"), (5, text(9))]
    for i in range(60):
        item = rng.choice([t for _, t in items if t])
        docs.append((10 + i, f"{text(rng.randrange(5))}, {item.title()}\n{text(rng.randrange(20))} {item[: rng.randrange(60)]}"))
    docs += [docs[-1]] * 3 + [(99, f"{text(30_000)} {items[5][1]}")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_marks(spark, contaminated, block_bytes):
    docs, items = contaminated
    frame = spark.createDataFrame([(*d, "clash", "clash") for d in docs], "doc_id long, text string, marks string, n_words string").repartition(4)
    found = decontaminate.report(frame, spark.createDataFrame(items, "item_id long, text string"), block_bytes)
    assert Counter(map(tuple, found.collect())) == _brute_marks(docs, items)


def test_spans_and_documents_are_removed(spark):
    passage = "one two three four five six seven eight nine ten"
    docs = [(1, f"Before, this:  {passage.upper()}! (after) it"), (2, "clean\n text "), (3, passage), (4, None)]
    frame = spark.createDataFrame([(*d, "mine") for d in docs], "doc_id long, text string, marks string")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    cut = decontaminate.decontaminate(frame, bench)
    assert cut.columns == frame.columns
    assert {tuple(r) for r in cut.collect()} == {(1, "Before, this: ! (after) it", "mine"), (2, "clean\n text ", "mine"), (3, "", "mine"), (4, None, "mine")}
    assert {r["doc_id"] for r in decontaminate.decontaminate(frame, bench, "documents").collect()} == {2, 4}
    with pytest.raises(ValueError):
        decontaminate.decontaminate(frame, bench, "words")


def test_marks_of_empty_tables(spark, contaminated):
    docs = spark.createDataFrame(contaminated[0], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(docs, none).where("contaminated or n_hit > 0 or n_items > 0").count() == 0
    assert decontaminate.report(docs.limit(0), none).count() == 0


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(decontaminate, "window_hashes", lambda numbers, size: np.zeros(max(0, len(numbers) - size + 1), np.uint64))
    block = decontaminate.build_block([(1, "a b"), (2, "b c")])
    found = decontaminate.scan(["x b c a", "a b"], block)
    assert found.hit.tolist() == [False, True, True, False, True, True]
    assert [block.lists[n] for _, n in found.pairs.tolist()] == [(2,), (1,)]


def _brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(v, [math.floor(x) * 256 if abs(x) > 2**60 else math.floor(256 * x) for x in e], lab) for v, e, lab in rows if e and all(x is not None and math.isfinite(x) for x in e)]
    step = len(kept[0][1]) // parts
    cut = lambda x: [x[p * step : (p + 1) * step] for p in range(parts)]
    books = [[cut(x)[p] for _, x, _ in sorted((k for k in kept if k[0] is not None), key=lambda k: k[:2])[:entries]] for p in range(parts)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min(range(len(books[p])), key=lambda e: (distance(part, books[p][e]), e)) for p, part in enumerate(cut(x))] for _, x, _ in kept]

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [cut(x)[p] for (_, x, _), c in zip(kept, codes) if c[p] == e]
                if mine:
                    books[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    codes = assign()
    digest = sha256(",".join(str(x) for book in books for row in book for x in row).encode()).hexdigest()
    errors = [min(2**63 - 1, sum(distance(part, books[p][c[p]]) for p, part in enumerate(cut(x)))) for (_, x, _), c in zip(kept, codes)]
    labels = Counter()
    for (_, _, lab), e in zip(kept, errors):
        labels[lab] += e
    return Counter((v, bytes(c).hex(), e, min(2**63 - 1, labels[lab]), digest) for (v, _, lab), c, e in zip(kept, codes, errors))


VECTORS = "vec_id long, embedding array<float>, label int, code string, error string"


def _vectors(n, width=32, large=()):
    rng = np.random.default_rng(4)
    made = [(i, rng.normal(0, 0.2, width).astype(np.float32).tolist(), None if i % 5 == 0 else i % 3) for i in range(n)]
    made += [made[1], made[2], (None, [0.25] * width, 1), (3, [0.0] * width, None), (n, None, 1), (n, [None] * width, 1), (n, [math.nan] * width, 0)]
    made += [(n, [math.inf] * width, 0), (n, [], 0)] + [(n + i, [x] * width, 2) for i, x in enumerate(large)]
    return made


@pytest.mark.parametrize("n, large", [(150, ()), (20, ()), (70, (1e25, -3e38, 5e4))])
def test_vector_codes(spark, n, large):
    rows = [(v, e and [None if x is None else float(np.float32(x)) for x in e], lab) for v, e, lab in _vectors(n, large=large)]
    found = vector_codes.compress(spark.createDataFrame([(*r, "clash", "clash") for r in rows], VECTORS).repartition(3))
    assert Counter(map(tuple, found.collect())) == _brute_codes(rows)


def test_vector_codes_of_odd_tables(spark):
    none = vector_codes.compress(spark.createDataFrame([], VECTORS))
    assert none.count() == 0 and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    odd = spark.createDataFrame([(1, [0.5] * 20, 1), (2, [0.1] * 20, 1), (3, [0.1] * 7, 1)], "vec_id long, embedding array<float>, label int")
    assert {r["vec_id"]: len(r["code"]) for r in vector_codes.compress(odd).collect()} == {1: 32, 2: 32}


def test_decoded_vectors_are_near(spark):
    rows = vector_codes.usable(spark.createDataFrame([(*r, "", "") for r in _vectors(40)], VECTORS))
    blocks = vector_codes.to_blocks(rows, block_values=100)
    books = vector_codes.fit_codebooks(rows, blocks)
    decoded = vector_codes.decode(vector_codes.encode(blocks, books), books)
    given = defaultdict(list)
    for r in rows.collect():
        given[r["vec_id"]].append(np.array(r["embedding"]))
    gaps = [min(np.abs(np.array(r["embedding"]) - g).max() for g in given[r["vec_id"]]) for r in decoded.collect()]
    assert len(gaps) == 44 and np.median(gaps) < 0.01

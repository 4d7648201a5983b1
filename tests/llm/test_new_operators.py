"""Fill-in-middle, hard negatives and SimHash against plain versions."""

import hashlib
import re

import numpy as np
import pytest
import regex
import xxhash
from odd_rows import LONG, TEXTS
from pyspark.sql import functions as F

from telemorph.llm import fill_in_middle, hard_negatives, language_id, simhash

# ---- fill in the middle --------------------------------------------------------------

UNIT = regex.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_cut(doc_id, text):
    text = text or ""
    ends = [0] + [m.end() for m in UNIT.finditer(text)]
    n = len(ends) - 1
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = (ends[x] for x in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    if not text or re.search("<P>|<S>|<M>", text) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def check_cuts(docs):
    got = fill_in_middle.transform(docs).withColumn("back", fill_in_middle.restore(F.col("output"), F.col("form"))).collect()
    have = sorted([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got], key=str)
    rows = docs.select("doc_id", "text").collect()
    assert have == sorted([(r.doc_id, *plain_cut(r.doc_id, r.text)) for r in rows], key=str)
    assert sorted(r.back for r in got) == sorted(r.text or "" for r in rows)
    return {r.form for r in got}


def test_fill_in_middle_odd_rows(odd, empty):
    check_cuts(odd)
    assert fill_in_middle.digest(fill_in_middle.transform(empty)).count() == 0


def test_fill_in_middle_cuts_and_marks(spark):
    texts = [*TEXTS, "a<S", "S>b <", "< <P", "a <P> b", "<M>", "é<S x y", "x\n\n", "\n\nx", "  ", "<" * 9 + "S", LONG]
    docs = spark.createDataFrame([(i, texts[i % len(texts)]) for i in range(400)], "doc_id long, text string")
    assert check_cuts(docs) == {"plain", "spm", "psm"}
    shown = fill_in_middle.digest(fill_in_middle.transform(docs)).collect()
    by_id = {r.doc_id: r for r in shown}
    for i in range(400):
        n, form, _, _, output = plain_cut(i, texts[i % len(texts)])
        assert by_id[i].output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert by_id[i].restored_sha256 == hashlib.sha256((texts[i % len(texts)] or "").encode()).hexdigest()


# ---- hard negatives ----------------------------------------------------------------------


def plain_negatives(rows, is_anchor, positives=5, negatives=10):
    """rows: distinct (vec_id, label, point as a tuple)."""
    out = []
    for name, label, point in (r for r in rows if is_anchor(r[0])):
        scored = sorted((-sum(x * y for x, y in zip(point, p)), i, other) for i, other, p in rows)
        for minus, i, _ in [s for s in scored if s[2] == label and s[1] != name][:positives]:
            best = [s for s in scored if s[2] != label and s[1] != name and -30 * minus <= -100 * s[0] <= -90 * minus][:negatives]
            out += [(name, i, k, j, -minus, -score) for k, (score, j, _) in enumerate(best, 1)]
    return sorted(out)


def mined(vectors, **more):
    found = hard_negatives.mine(vectors, F.col("vec_id") % 10 == 0, **more)
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in found.collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, block int, row string, lo string").repartition(3)


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, spread):
    """Several cells and blocks, clusters and near-random vectors, ties and copies."""
    for name, value in (("CELL", 40), ("BLOCK", 100), ("ANCHORS", 7), ("LEAF", 8), ("FAN", 4)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 8))
    points = (centres[rng.integers(0, 6, 400)] + spread * rng.standard_normal((400, 8))).astype(np.float32)
    points[50:70] = points[50]
    rows = [(i, [float(x) for x in points[i]], int(rng.integers(0, 4)), 1, "r", "l") for i in range(400)]
    whole = [(i, label, tuple(int(np.floor(256 * np.float64(x))) for x in p)) for i, p, label, *_ in rows]
    assert mined(table(spark, [*rows, rows[7], rows[20]])) == plain_negatives(whole, lambda i: i % 10 == 0)


def test_hard_negatives_odd_rows(spark):
    good = [(i, [0.1 * (i % 5), 0.2, -0.1 * (i % 3)], i % 2, 1, "r", "l") for i in range(60)]
    odd = [
        (100, None, 1, 1, None, None), (110, [0.1, None, 0.2], 1, 1, "", ""), (120, [float("nan"), 0.1, 0.1], 1, 1, "", ""), (130, [float("inf"), 0.0, 0.0], 0, 1, "", ""),
        (140, [0.5, 0.5], 0, 1, "", ""), (150, [0.5, 0.5, 0.5], None, 1, "", ""), (None, [0.5, 0.5, 0.5], 1, 1, "", ""), (160, [], 1, 1, "", ""), (170, [0.0, 0.0, 0.0], 1, 1, "", ""),
        (10, [0.3, 0.1, -0.2], 1, 1, "", ""),
    ]
    whole = [(i, label, tuple(int(np.floor(256 * np.float64(np.float32(x)))) for x in p)) for i, p, label, *_ in [*good, odd[8], odd[9]]]
    assert mined(table(spark, good + odd)) == plain_negatives(whole, lambda i: i % 10 == 0)
    assert mined(table(spark, [])) == [] and mined(table(spark, odd[:3])) == []
    assert mined(table(spark, [(0, [1.0, 0.0], 1, 1, "", ""), (1, [1.0, 0.0], 1, 1, "", "")])) == []


def test_windows_are_exact():
    """Products at both ends of a window, for small scores where rounding shows."""
    points = np.array([[s] for s in range(-40, 41)])
    tree = hard_negatives.CoverTree(np.arange(81), np.zeros(81, np.int64), points)
    for least, most in ((-3, 5), (0, 0), (12, 12), (39, 50), (7, 6)):
        lower, upper = hard_negatives.bounds(np.array([[1.0]]), tree.centres, tree.covering, tree.longest)
        anchor = (-1, 1, np.array([1]), [least], [most])
        [(_, found)] = tree.descend(anchor, lower[0], upper[0], np.ones(len(tree.nodes), bool), False, 10)
        assert [s for _, s in found] == [s for s in range(40, -41, -1) if least <= s <= most][:10]


def test_cover_tree_bounds_and_nets():
    rng = np.random.default_rng(8)
    points = rng.integers(-300, 300, (3000, 5))
    tree = hard_negatives.CoverTree(np.arange(3000), rng.integers(0, 3, 3000), points)

    def below(node):
        return np.concatenate([tree.rows[node], *[below(c) for c in tree.children[node]]]).astype(int)

    anchors = rng.integers(-300, 300, (20, 5)).astype(float)
    lower, upper = hard_negatives.bounds(anchors, tree.centres, tree.covering, tree.longest)
    assert sorted(np.concatenate([below(r) for r in tree.roots])) == list(range(3000))
    for node, children in enumerate(tree.children):
        values = points[below(node)] @ anchors.T
        assert (values.min(0) >= lower[:, node]).all() and (values.max(0) <= upper[:, node]).all()
        if children:  # nested, and centres at least as far apart as half the covering angle
            assert tree.nodes[children[0]][0] == tree.nodes[node][0]
            centres = tree.unit[[tree.nodes[c][0] for c in children]]
            apart = hard_negatives.angle(centres @ centres.T)[np.triu_indices(len(children), 1)]
            assert (apart >= tree.nodes[node][1] / 2 - 1e-6).all()


# ---- language id --------------------------------------------------------------------------


def test_marks_without_letters_have_no_language(spark):
    train = spark.createDataFrame([(i, "haus und hof" if i % 2 else "casa de campo", "de" if i % 2 else "es") for i in range(40)], "doc_id long, text string, lang string")
    texts = [chr(0x301) * 2, "12 " + chr(0x301), None, "", "e" + chr(0x301), "haus"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs, language_id.learn(train)).collect()}
    assert [got[i] for i in range(4)] == [("und", 0.0)] * 4 and got[4][0] in ("de", "es") and got[5][0] == "de"


# ---- SimHash ---------------------------------------------------------------------------------


def plain_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(codes, radius):
    label = list(range(len(codes)))
    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= radius and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_fingerprints(spark, monkeypatch):
    texts = [*TEXTS, "a b c d", "A b  c\nd e", " lead and trail \n", "x y z", "x y z " * 500]
    want = [plain_fingerprint(t) for t in texts]
    for piece in (8, 1 << 20):
        monkeypatch.setattr(simhash, "PIECE", piece)
        assert [simhash.fingerprint(t, 4) & (1 << 64) - 1 for t in texts] == want


def test_near_copies(spark, odd, empty):
    rng = np.random.default_rng(2)
    texts = [None, "", "one", "ONE", *TEXTS]
    for size in (30, 200, 800):
        base = [f"t{x}" for x in rng.integers(0, 5000, size)]
        for edits in (0, 0, 1, 1, 2, 3, 5, size // 20):
            new = list(base)
            for at in rng.integers(0, size, edits):
                new[at] = f"u{rng.integers(0, 5000)}"
            texts.append(" ".join(new))
    docs = spark.createDataFrame([(i, t, "x", 1, "c") for i, t in enumerate(texts)], "doc_id long, text string, fp string, n int, component_id string").repartition(4)
    codes = [plain_fingerprint(t) for t in texts]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_copies(docs).collect()}
    assert got == {i: (f"{c:016x}", root) for i, (c, root) in enumerate(zip(codes, plain_roots(codes, 4), strict=True))}
    strange = simhash.near_copies(odd).collect()
    assert len(strange) == odd.count() and sum(r.doc_id is None for r in strange) == 1
    assert simhash.near_copies(empty).count() == 0


def test_rows_without_id_link_but_name_nothing(spark):
    got = simhash.near_copies(spark.createDataFrame([(None, "same text here now"), (7, "same text here now"), (None, "lonely words without any id")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 7), (7, 7)]


@pytest.mark.parametrize("radius", [0, 1, 3, 4])
def test_links_equal_brute_force(spark, radius):
    """Dense clouds of fingerprints, chains, and entries of many blocks."""
    rng = np.random.default_rng(radius)
    codes = {int(x) for x in rng.integers(0, 1 << 63, 40)}
    for base in list(codes)[:4]:
        for _ in range(60):
            flipped = base
            for bit in rng.integers(0, 64, rng.integers(1, 9)):
                flipped ^= 1 << int(bit)
            codes.add(flipped)
    chain = 0
    for bit in range(0, 60, 3):
        chain ^= 0b101 << bit
        codes.add(chain)
    codes = sorted(c - (1 << 64) if c >> 63 else c for c in codes)
    nodes = spark.createDataFrame([(c,) for c in codes], "fp long").repartition(3)
    label = plain_roots([c & (1 << 64) - 1 for c in codes], radius)
    for block in (8, 4096):
        found = {r.node: r.root for r in simhash.link_fingerprints(nodes, radius, block).collect()}
        assert [found.get(c, c) for c in codes] == [codes[x] for x in label]


@pytest.mark.parametrize("count", [10, 10**5, 10**8, 10**11])
def test_any_layout_reaches_every_pair(count):
    for radius in (0, 1, 3, 4):
        segments = simhash.layout(count, radius)
        assert sum(width for _, width, _ in segments) == 64 and sum(r + 1 for _, _, r in segments) > radius

"""Operators for training data against plain versions, on rows meant to upset them."""

import hashlib
import itertools
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from odd_rows import LONG, TEXTS, rows
from pyspark.sql import functions as F

from telemorph.llm import decontamination, disclosure, jaccard_join, language_id, language_model, licences, mixing, neighbours, quality_rules, token_counts
from telemorph.llm.hashing import token_hashes

ROWS = len(TEXTS) + 3


def words(text):
    return (text or "").encode().lower().split()


def pairs(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_token_hashes_follow_tokens():
    texts = ["a b A", None, LONG * 4, "b"]
    found, offsets = token_hashes(texts)
    seen = {}
    for text, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
        assert len(words(text)) == b - a
        for word, h in zip(words(text), found[a:b], strict=True):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_language_model_base_is_exact(odd):
    got = language_model.score_held_out(odd, bits=1 << 20, head=4).collect()
    train = [r.text for r in odd.collect() if r.doc_id is not None and crc32(str(r.doc_id).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in [*words(t), "END"])
    n, v = sum(counts.values()), len(counts)
    texts = {r.doc_id: r.text for r in odd.collect()}
    assert len(got) == ROWS
    for r in got:
        own = [*words(texts[r.doc_id]), "END"]
        assert r.n_tokens == len(own) and r.train_tokens == n and r.n_known == sum(counts[w] > 0 for w in own)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
        assert r.score < 0


def test_bloom_levels_are_one_sided():
    counts = np.array([1, 2, 3, 7, 8, 100])
    grams = language_model.mix(np.arange(1, 7, dtype=np.uint64))
    bloom = np.zeros((1 << 20) // 64, np.uint64)
    for gram, count in zip(grams, counts, strict=True):
        for level in range(int(math.log2(count)) + 1):
            word, mask = language_model.entry(np.array([gram]), level, len(bloom))
            bloom[word] |= mask
    found = language_model.levels(bloom, grams)
    assert (language_model.low(found) <= counts).all() and (language_model.high(found) >= counts).all()


def test_language_model_keeps_its_error_rate(spark):
    """A filter far too small for the corpus gives nearly the scores of an ample one."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"t{x}" for x in rng.integers(0, 9000, 300)) for _ in range(60)]
    strange = [" ".join(f"u{x}" for x in rng.integers(0, 9000, 300)) for _ in range(5)]
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    docs = spark.createDataFrame([*enumerate(texts + strange), (None, "t1 t2"), (64, strange[-1]), (90, None)], "doc_id long, text string").repartition(3)
    got = language_model.score(docs, train, bits=1 << 14).collect()
    small = {r.doc_id: r for r in got}
    ample = {r.doc_id: r for r in language_model.score(docs, train, bits=1 << 26).collect()}
    assert len(got) == 68 and set(small) == set(ample)
    for i, r in ample.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (small[i].n_tokens, small[i].n_known, small[i].train_tokens)
        assert r.base_score == pytest.approx(small[i].base_score)
        assert abs(r.score - small[i].score) < 0.04 * r.n_tokens


def plain_components(texts, n, percent):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label, [len(s) for s in sets]


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_components(spark, n, percent):
    rng = np.random.default_rng(1)
    texts = [None, "", "one two", "ONE  two"]
    for size in (6, 11, 30, 140, 400):
        base = [f"t{x}" for x in rng.integers(0, 5000, size)]
        for edits in (0, 0, 1, 2, size // 60, size // 30, size // 15):
            new = list(base)
            for at in rng.integers(0, size, edits):
                new[at] = f"u{rng.integers(0, 5000)}"
            texts.append(" ".join(new))
    label, sizes = plain_components(texts, n, percent)
    docs = spark.createDataFrame(rows(texts), "doc_id long, text string, a string, b string, n long, c string, d int, e int, digest long, cell string")
    got = {r.doc_id: r for r in jaccard_join.jaccard_components(docs, n, percent, parts=16).collect()}
    assert [got[i].component_id for i in range(len(texts))] == label
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    kept = {r.doc_id for r in jaccard_join.keep_one(docs, n, percent).collect()}
    assert kept == {i for i, x in enumerate(label) if i == x}


def test_jaccard_crowded_cells(spark):
    """Cells with more members in a batch than meet in the cell's task: near copies
    in a long chain, exact copies, and texts that share a passage without being close."""
    rng = np.random.default_rng(2)
    fresh = iter(range(10**6))
    base = [f"t{x}" for x in rng.integers(0, 5000, 120)]
    texts = [" ".join(base)] * 5
    for _ in range(40):
        new = list(base)
        new[rng.integers(0, 120)] = f"u{next(fresh)}"
        texts.append(" ".join(new))
    passage = [f"p{x}" for x in range(60)]
    for _ in range(40):
        texts.append(" ".join(passage + [f"v{next(fresh)}" for _ in range(60)]))
    link = list(base)
    for at in range(0, 120, 7):  # drifts away from the first text in small steps
        link[at] = f"w{at}"
        texts.append(" ".join(link))
    label, sizes = plain_components(texts, 3, 90)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: r for r in jaccard_join.jaccard_components(docs, 3, 90, parts=4).collect()}
    assert [got[i].component_id for i in range(len(texts))] == label
    assert [got[i].n_shingles for i in range(len(texts))] == sizes


def test_jaccard_odd_rows(odd, empty):
    got = jaccard_join.jaccard_components(odd, 3, 90).collect()
    assert len(got) == ROWS and jaccard_join.jaccard_components(empty).count() == 0
    assert {r.component_id for r in got if r.doc_id in (8, 9)} == {8} and {r.component_id for r in got if r.doc_id in (6, 7)} == {6}


def test_language_id(spark, odd, empty):
    texts = [" ".join(f"{stem}{end}" for stem in "bcdfg" for end in ends) for ends in (["ung", "keit"], ["cion", "mente"]) for _ in range(20)]
    train = spark.createDataFrame([(i, t, "de" if i < 20 else "es") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    field = language_id.learn(train)
    asked = spark.createDataFrame([(1, "hung lkeit mung"), (2, "hcion lmente"), (3, None), (4, "12 .."), (5, "hung lkeit pung rung tcion xmente")], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(asked, field).collect()}
    assert [got[i].lang_pred for i in range(1, 6)] == ["de", "es", "und", "und", "de"]
    assert got[5].score < got[1].score and all(0 <= r.score <= 1 for r in got.values())
    found = language_id.identify_held_out(odd)
    assert found.count() == ROWS and language_id.identify_held_out(empty).count() == 0


def test_language_id_sees_every_letter(spark):
    """Texts without spaces are judged by all their letters, not by their ends."""
    ends = {"de": ["ung", "keit"], "es": ["cion", "mente"]}
    made = {k: [f"{stem}{end}" for stem in "bcdfg" for end in v] for k, v in ends.items()}
    texts = [(" ".join(v), k) for k, v in made.items() for _ in range(20)]
    field = language_id.fit([t for t, _ in texts], [k for _, k in texts])
    de, es = "".join(made["de"] * 40), "".join(made["es"] * 40)
    asked = [de[:32] + es + de[-32:], es[:32] + de + es[-32:], de + es, "/".join(made["es"] * 9), "bung/" + "/".join(made["es"]) + "/bung", "12.." * 40]
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(docs, field).collect()}
    assert [got[i].lang_pred for i in (0, 1, 3, 4, 5)] == ["es", "de", "es", "es", "und"]
    assert 0.4 < got[2].score < 0.8 and got[0].score > got[2].score
    for token in (*asked, "don't", "a" * 32, "a" * 33, "--", "ab" * 50 + "'" + "c" * 31):
        assert "".join(language_id.parts(token)) == "".join(c for c in token if c.isalpha())
        assert all(0 < len(w) <= language_id.LONGEST for w in language_id.parts(token))


def test_forward_backward_sums_all_paths():
    rng = np.random.default_rng(0)
    scores, moves = rng.standard_normal((1, 4, 3)), rng.standard_normal((3, 3))
    posterior, steps = language_id.forward_backward(scores, np.array([4]), moves)
    total, want, pair = 0.0, np.zeros((4, 3)), np.zeros((3, 3))
    for path in np.ndindex(3, 3, 3, 3):
        weight = math.exp(sum(scores[0, t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += weight
        for t, y in enumerate(path):
            want[t, y] += weight
        for a, b in zip(path, path[1:], strict=False):
            pair[a, b] += weight
    assert np.allclose(posterior[0], want / total) and np.allclose(steps, pair / total)


def test_licences(odd, empty):
    got = {r.doc_id: r for r in licences.scan(odd).collect()}
    assert got[10].licence == "mit" and got[10].dice == 1.0 and got[10].n_notices == 1 and got[0].licence is None
    assert licences.scan(odd).count() == ROWS and licences.scan(empty).count() == 0


def test_licences_at_the_threshold(spark):
    """Lines of just enough bigrams of each template, found as a scan without anchors finds them."""
    made = []
    for wording in licences.TEMPLATES.values():
        own = re.sub(r"[\W_]+", " ", wording.lower()).split()
        b = len(set(zip(own, own[1:], strict=False)))
        for size in range(2, len(own)):
            made += [" ".join(own[at : at + size]) for at in range(len(own) - size + 1) if abs(2 * (size - 1) / (size - 1 + b) - 0.8) < 0.07]
    made.append("CC BY-NC 4.0")
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")

    def grams(text):
        own = re.sub(r"[\W_]+", " ", text.lower()).split()
        return set(zip(own, own[1:], strict=False))

    def plain(text):
        a = grams(text)
        scored = [(-2 * len(a & b) / (len(a) + len(b)), name) for name, b in ((k, grams(v)) for k, v in licences.TEMPLATES.items())]
        best = min(x for x in scored)
        return (1, best[1], -best[0]) if -best[0] >= 0.8 else (0, None, None)

    got = {r.doc_id: (r.n_notices, r.licence, r.dice) for r in licences.scan(docs).collect()}
    assert any(got[i][2] == 0.8 for i in got) and got[len(made) - 1][1] == "cc-by-nc-4.0"
    assert {made[i]: r for i, r in got.items()} == {text: plain(text) for text in made}


def test_token_counts(odd, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    got = token_counts.count_tokens(odd).collect()
    assert len(got) == ROWS and token_counts.count_tokens(empty).count() == 0
    for r in got:
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def good(kind, value):
        digits = re.sub("[^0-9]", "", value)
        luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in value.split(".")), "card": 16 <= len(digits) <= 19 and luhn, "phone": 8 <= len(digits) <= 15}[kind]

    return ",".join(f"{k}:{m.start()}:{m.end()}" for k in PLAIN for m in re.finditer(PLAIN[k], text or "") if good(k, m.group()))


def test_personal_data(spark, odd, empty):
    hard = ["a@b.c_x@y.zz x@y@z.w a@b", "1.2.3.4.5 300.1.2.3.4 0001.2.3.255", "4111 1111 1111 1111 4111-1111-1111-1112", "1" * 900 + ".1.1.1 " + "a" * 30000 + "@", "😀 q@x.yy +12 ++44.20.7946.0958-"]
    docs = odd.unionByName(spark.createDataFrame(rows(hard), odd.schema).withColumn("doc_id", F.col("doc_id") + 100))
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = disclosure.digest(disclosure.detect(docs)).collect()
    assert len(got) == ROWS + len(hard)
    for r in got:
        assert r.base_sha256 == hashlib.sha256(plain_spans(texts[r.doc_id]).encode()).hexdigest()
    assert disclosure.detect(empty).count() == 0


def test_revealing_terms(spark):
    filler = [f"common words here number {i} about nothing much" for i in range(40)]
    telling = [f"common words zeppelin note{i} from ann@x.example.com about nothing" for i in range(4)]
    docs = spark.createDataFrame(list(enumerate(filler + telling)), "doc_id long, text string")
    found = {r.doc_id: r for r in disclosure.detect(docs).collect()}
    assert [(s.kind, s.value) for s in found[41].spans] == [("email", "ann@x.example.com"), ("removed", "zeppelin"), ("removed", "from")]
    assert all(not found[i].spans for i in range(40))
    assert "zeppelin" not in disclosure.sanitised(docs).where("doc_id = 41").first().text


def test_join_reads_slices_and_searches_together():
    """Texts become strings a slice at a time, and what a tree finds for many
    vectors at once, in cells of any size, is what all pairs give."""
    import pandas as pd
    import pyarrow as pa

    texts = ["x" * 60, None, "", "é" * 400, *["y" * 30] * 40]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    slices = list(jaccard_join.text_pieces(iter([batch, batch.slice(0, 0)]), 100))
    assert [t for s in slices for t in s.column("text").to_pylist()] == texts
    assert len(slices) > 10 and all(sum(len((t or "").encode()) for t in s.column("text").to_pylist()) <= 100 + 800 for s in slices)

    rng, rule = np.random.default_rng(3), jaccard_join.Rule(80)
    for count in (2, 40, 900):
        base = rng.integers(0, 4, (9, jaccard_join.FINE))
        fine = base[rng.integers(0, 9, count)] + (rng.random((count, jaccard_join.FINE)) < 0.05)
        rows = pd.DataFrame({"cell": 1, "asking": np.arange(count) % 2 == 0, "digest": rng.permutation(count), "part": np.arange(count)})
        packed = np.array([jaccard_join.packed(x) for x in fine] + [None], object)[:-1]
        ((held, asked),) = jaccard_join.sides(rows, ["cell"], rows["asking"].to_numpy())
        got = jaccard_join.near_parts(rows["digest"].to_numpy(), rows["part"].to_numpy(), packed, held, asked, rule, every=True)
        want = {(min(a, b), max(a, b)) for a in asked for b in held if np.minimum(fine[a], fine[b]).sum() >= rule.needed(fine[a].sum() + fine[b].sum())}
        assert {(p, q) for p, q, _, _ in got.tolist()} == want and (count < 40 or want)



def test_fine_points_bound_the_overlap():
    rng = np.random.default_rng(5)
    for size in (0, 1, 40, 3000):
        common, own = (np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64)) for _ in range(2))
        a, b = (jaccard_join.points(x) for x in (np.union1d(common, own), common))
        both = [np.minimum(x(a), x(b)).sum() for x in (lambda v: v, jaccard_join.coarse)]
        assert len(common) <= both[0] <= both[1]
        assert (jaccard_join.unpacked(jaccard_join.packed(a)) == a).all()
    wide = np.full(jaccard_join.FINE, 1 << 16)
    assert (jaccard_join.unpacked(jaccard_join.packed(wide)) == wide).all()
    assert jaccard_join.coarse(np.stack([wide, a])).shape == (2, jaccard_join.GROUPS)


def test_decontamination(spark, odd, empty):
    passage = " ".join(f"p{i}" for i in range(30))
    changed = " ".join("zz" if i % 9 == 4 else f"P{i}" for i in range(30))
    apart = " ".join(f"p{i}" if i % 2 else "zz" for i in range(30))
    benchmark = spark.createDataFrame([(7, passage), (5, passage + " more"), (1, None), (2, ""), (None, passage)], "item_id long, text string")
    docs = spark.createDataFrame([(0, passage), (1, "x y " + changed + " z"), (2, apart), (3, None), (4, "p1 p2"), (4, "p1 p2")], "doc_id long, text string")
    assert pairs(decontamination.contaminated(docs, benchmark), "doc_id", "n_items", "item_id") == [(0, 2, 5), (1, 2, 5), (2, 0, None), (3, 0, None), (4, 0, None), (4, 0, None)]
    assert pairs(decontamination.clean(docs, benchmark), "doc_id") == [(2,), (3,), (4,), (4,)]
    assert decontamination.contaminated(odd, benchmark.limit(0)).count() == ROWS and decontamination.clean(empty, benchmark).count() == 0


def test_masks_hit_every_placement():
    for wide, masks in decontamination.MASKS_OF.items():
        spare = wide - math.ceil(decontamination.LEAST * wide / decontamination.WINDOW)
        for lost in itertools.combinations(range(wide), spare):
            kept = "".join("0" if i in lost else "1" for i in range(wide))
            assert any(all(kept[at + i] == "1" for i, c in enumerate(mask) if c == "1") for mask in masks for at in range(wide - len(mask) + 1)), (wide, lost)


def test_decontamination_equals_all_windows(spark):
    """Against a comparison of all windows: every fourth word replaced, substitutions
    and shifts at random, items of all lengths from one word on."""
    rng = np.random.default_rng(6)
    items = [[f"i{n}w{k}" for k in range(n)] for n in (*range(1, 16), 40)]
    texts = [["x", *items[-1], "y"], [w if i % 4 != 3 else "zz" for i, w in enumerate(items[-1])]]
    texts += [["x", *w, "y"] for w in items] + [w[:-1] for w in items]
    for _ in range(150):
        own = list(items[rng.integers(0, len(items))])
        for _ in range(rng.integers(0, 5)):
            own[rng.integers(0, len(own))] = "zz"
        texts.append(["x"] * rng.integers(0, 3) + own[rng.integers(0, 2) :] + ["y"] * rng.integers(0, 3))

    def plain(text):
        found = {}
        for n, item in enumerate(items):
            wide = min(12, len(item))
            equal = [sum(a == b for a, b in zip(text[i : i + wide], item[j : j + wide], strict=True)) for i in range(len(text) - wide + 1) for j in range(len(item) - wide + 1)]
            if max(equal, default=0) * 12 >= 9 * wide:
                found[n] = max(equal)
        return len(found), min(found, default=None), max(found.values(), default=None)

    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = {r.doc_id: (r.n_items, r.item_id, r.equal_words) for r in decontamination.contaminated(docs, benchmark).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}
    assert got[1] == (1, 15, 9)


def test_quality_rules(spark, odd, empty):
    texts = [("Plain words follow. " * 20 if i % 2 else "a| b| c$$ d%% " * 20) + f"x{i}" for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(1, None), (2, 7)], "doc_id long, quality int")
    got = quality_rules.score_held_out(docs, labels).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)
    assert quality_rules.score_held_out(odd, labels.limit(0)).count() == ROWS and quality_rules.score_held_out(empty, labels).count() == 0


def test_mixing(spark, odd, empty):
    rng = np.random.default_rng(2)
    made = [(i, "w " * int(n), None if s == 0 else f"s{s}") for i, (n, s) in enumerate(zip(rng.integers(0, 60, 900), rng.choice(4, 900, p=[0.1, 0.6, 0.2, 0.1]), strict=True))]
    docs = spark.createDataFrame(made, "doc_id long, text string, source string")
    got = mixing.taken_words(docs).collect()
    again = mixing.taken_words(docs.repartition(5)).collect()
    assert {r.doc_id: r.taken for r in got} == {r.doc_id: r.taken for r in again}
    names, sizes = sorted({s for *_, s in made}, key=lambda s: (s is None, s)), Counter()
    for _, text, source in made:
        sizes[source] += len(text.split())
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_names, left = {}, list(names), 1.5 * sum(sizes.values())
    while open_names:
        share = {s: left * weight[s] / sum(weight[x] for x in open_names) for s in open_names}
        above = [s for s in open_names if share[s] > 2 * sizes[s]]
        for s in above or open_names:
            target[s] = 2.0 * sizes[s] if above else share[s]
        left -= sum(target[s] for s in above)
        open_names = [s for s in open_names if s not in target]
    source_of, taken = {i: s for i, _, s in made}, Counter()
    for r in got:
        s = source_of[r.doc_id]
        assert r.target == pytest.approx(target[s]) and r.source_size == sizes[s] and r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 5 for s in names)
    mixed = mixing.mix(docs).groupBy("doc_id").agg(F.count("*").alias("n"))
    times = {r.doc_id: r.n for r in mixed.collect()}
    assert all(r.taken == r.size * times.get(r.doc_id, 0) for r in got)
    assert mixing.taken_words(odd).count() == ROWS and mixing.taken_words(empty).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(3)
    points = rng.standard_normal((1500, 64)).astype(np.float32)
    points[7] = points[100]
    made = [(i, p.tolist(), 1) for i, p in enumerate(points)]
    bad = [(5000, None, 1), (5001, [0.0] * 64, 1), (5100, [float("nan")] * 64, 1), (None, points[0].tolist(), 1), (5200, [1.0], 1), (5300, [None] * 64, 1)]
    vectors = spark.createDataFrame(made + bad + made[:3], "vec_id long, embedding array<float>, score int")
    got = neighbours.nearest_of_hundredth(vectors).collect()
    wide, hits = points.astype(float), 0
    for q in range(0, 1500, 100):
        distance = np.sqrt(((wide - wide[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(1500), distance)) if i != q][:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in mine] == list(range(1, 11)) and all(s == pytest.approx(distance[i], abs=0) for _, i, s in mine)
        hits += len(set(order) & {i for _, i, _ in mine})
    assert hits >= 0.9 * 150 and len(got) == 150
    assert neighbours.nearest_of_hundredth(vectors.limit(0)).count() == 0


def test_language_model_counts_slice_by_slice(monkeypatch):
    """Texts become strings a slice at a time, n-grams of several slices and
    batches are counted together, and the counts are those of all texts."""
    import pyarrow as pa

    from telemorph.llm import shared

    rng = np.random.default_rng(6)
    texts = [" ".join(f"t{x}" for x in rng.integers(0, 300, 40)) for _ in range(3000)] + [None, "", "one"]
    batches = [pa.RecordBatch.from_pydict({"text": texts[a : a + 1000]}) for a in range(0, len(texts), 1000)]
    read, whole = [], language_model.sequences
    monkeypatch.setattr(language_model, "sequences", lambda some: read.append(sum(len(t or "") for t in some)) or whole(some))
    rows = [r for b in language_model.count_batches(iter(batches)) for r in b.to_pylist()]
    assert len(read) > 1 == len({(r["part"], r["kind"]) for r in rows}) / len(rows) and max(read) <= language_model.SLICE + 400
    tokens, offsets = whole(texts)
    wanted = {"w": language_model.mix(tokens ^ language_model.WORD), "p": language_model.combine(language_model.bigrams(tokens, offsets), tokens) ^ language_model.PAIR}
    for kind, grams in wanted.items():
        own = [r for r in rows if r["kind"] == kind]
        got = {g: c for r in own for g, c in zip(np.frombuffer(r["grams"], np.uint64), np.frombuffer(r["counts"], np.uint16 if 4 * len(r["counts"]) == len(r["grams"]) else np.uint32), strict=True)}
        assert got == Counter(grams.tolist()) and all((np.frombuffer(r["grams"], np.uint64) >> np.uint64(56) == r["part"]).all() for r in own)
    assert list(language_model.count_batches(iter([]))) == []
    assert len(list(shared.text_pieces(iter(batches[:1]), 1 << 12))) > 10


def test_join_holds_small_slices_and_packs_points_in_bytes():
    import pyarrow as pa

    rng = np.random.default_rng(8)
    texts = [" ".join(f"t{x}" for x in rng.integers(0, 90, 200)) for _ in range(4000)] + [None, "one two"]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    assert batch.nbytes > 2 * jaccard_join.SLICE
    found, wanted = jaccard_join.sliced_sets(batch, 3), jaccard_join.shingle_sets(texts, 3)
    assert all((a == b).all() for a, b in zip(found, wanted, strict=True))
    for most, width in ((0, 1), (255, 1), (256, 2), (65535, 2), (65536, 4)):
        point = rng.integers(0, most + 1, jaccard_join.FINE)
        point[0] = most
        packed = jaccard_join.packed(point)
        assert len(packed) == width * jaccard_join.FINE and (jaccard_join.unpacked(packed) == point).all()
    # Points of different widths meet in one cell.
    low, high = np.full(jaccard_join.FINE, 250), np.full(jaccard_join.FINE, 260)
    both = np.array([jaccard_join.packed(x) for x in (low, high)] + [None], object)[:-1]
    args = (np.array([7, 8]), np.array([1, 2]), both, np.array([0]), np.array([1]), jaccard_join.Rule(90))
    for every in (True, False):
        assert {tuple(r) for r in jaccard_join.near_parts(*args, every=every).tolist()} == {(1, 2, 7, 1), (1, 2, 8, 2)}

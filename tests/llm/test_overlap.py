"""The Jaccard join against all pairs in plain Python; bounds and directory entries on random sets."""

import random
import re

import numpy as np
import pytest

from logwarden.llm import common, neardup, overlap, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, words):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def components(rows, words, percent):
    """Smallest reachable doc_id per doc_id, by comparing all pairs."""
    label, sets = {}, [(d, shingles(t, words)) for d, t in rows if d is not None]
    for d, _ in sets:
        label[d] = d
    links = [(a, b) for i, (a, s) in enumerate(sets) for b, t in sets[:i] if s and t and 100 * len(s & t) >= percent * len(s | t)]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def thue_morse(bits):
    out = "a"
    for _ in range(bits):
        out += out.translate({97: 98, 98: 97})
    return out, out.translate({97: 98, 98: 97})


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    out = [" ".join(word() for _ in range(rng.choice((1, 2, 3, 4, 5, 6, 7, 9, 12, 30, 80, 200)))) for _ in range(120)]
    bases = [[word() for _ in range(n)] for n in (8, 15, 16, 31, 33, 60, 120, 127, 300)]
    for base in bases:  # stars of copies with few and many changes, longer and shorter ones
        for _ in range(28):
            copy = list(base)
            for _ in range(rng.choice((0, 0, 0, 1, 1, 2, 5)) * len(base) // 60 + rng.choice((0, 1, 1, 2))):
                copy[rng.randrange(len(copy))] = word()
            cut = rng.choice((0, 0, 0, 0, 0, len(copy) // 12, len(copy) // 6))
            out.append(" ".join(copy[: len(copy) - cut] + [word() for _ in range(rng.choice((0, 0, cut)))]))
    passage = " ".join(word() for _ in range(60))  # that many documents share
    out += [f"{' '.join(word() for _ in range(rng.randint(1, 40)))} {passage}" for _ in range(25)]
    out += [out[130].upper(), out[130], out[131].replace(" ", "\n\t ")]
    one, two = thue_morse(10)
    out += [" ".join([one, "x y z v w u t", two]), " ".join([two, "x y z v w u t", two]), f"{one} {one}", f"{two} {two}"]
    out += [None, "", " \n\t", "one", "ONE", "one two", "x" * 5000, "日本語 テキスト です ね"]
    rows = [(i, t) for i, t in enumerate(out)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("piece", [256, 7])
def test_joined(spark, piece):
    rows = corpus()
    given = [*rows, (131, dict(rows)[131]), (None, "a row without id at all")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in given], "doc_id bigint, text string, class string, names int").repartition(5)
    got = overlap.joined(docs, overlap.Params(piece=piece)).collect()
    want = components(rows, 4, 85)
    assert len(got) == len(given)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(shingles(dict(rows)[r.doc_id], 4)), want[r.doc_id])
    sizes = np.unique(list(want.values()), return_counts=True)[1]
    assert sizes.max() > 12 and (sizes > 1).sum() > 8
    assert overlap.joined(docs.limit(0)).count() == 0


def test_query(spark, tmp_path):
    rows = corpus()[:150]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op13_overlap"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert {r.doc_id: r.component_id for r in got.collect()} == components(rows, 4, 85)


def random_pairs(rng, count):
    for _ in range(count):
        size = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        drop, more = int(rng.integers(0, max(1, size // 6) + 1)), int(rng.integers(0, max(1, size // 6) + 1))
        b = np.unique(np.concatenate([rng.permutation(a)[: max(0, len(a) - drop)], rng.integers(0, 2**63, more).astype(np.uint64)]))
        if len(b):
            yield a, b


def linked(a, b, percent):
    n = len(np.intersect1d(a, b))
    return 100 * n >= percent * (len(a) + len(b) - n)


@pytest.mark.parametrize("percent, spare, groupings", [(85, 4, 4), (85, 0, 2), (75, 0, 1)])
def test_linked_sets_share_an_entry_and_pass_the_bound(percent, spare, groupings):
    rng, params, links = np.random.default_rng(1), overlap.Params(similar_percent=percent, spare=spare, groupings=groupings), 0
    for a, b in random_pairs(rng, 1500):
        if linked(a, b, percent):
            links += 1
            names = overlap.entry_names([a, b], params)
            assert len(np.intersect1d(*names))
            assert overlap.may_link(*overlap.count_vectors([a, b]), len(a), len(b), percent)
    assert links > 300


def test_sets_in_one_part_are_dealt_again():
    # all elements fall into one part of the first grouping; equal sets but for one element
    a = np.arange(1, 41, dtype=np.uint64)
    b = np.append(a[1:], np.uint64(99))
    names = overlap.entry_names([a, b], overlap.Params())
    assert len(np.intersect1d(*names)) and linked(a, b, 85)


def test_tree_finds_what_the_bound_allows():
    rng = np.random.default_rng(2)
    base = rng.poisson(3, (6, 64))
    vectors = np.concatenate([np.maximum(b + rng.integers(-1, 2, (50, 64)) * (rng.random((50, 64)) < 0.15), 0) for b in base]).astype(np.int32)
    sizes = vectors.sum(1)
    tree = overlap.RTree(vectors, sizes, 8)
    assert len(tree.levels) == 3 and sorted(tree.order) == list(range(300))
    got = set(zip(*(x.tolist() for x in tree.search(vectors[::7], sizes[::7], 85))))
    want = set()
    for i, q in enumerate(range(0, 300, 7)):
        for j in range(300):
            a, b = sizes[q], sizes[j]
            if 100 * min(a, b) >= 85 * max(a, b) and np.minimum(vectors[q], vectors[j]).sum() * 185 >= 85 * (a + b):
                want.add((i, j))
    assert got == want and 0 < len(want) < 43 * 300 / 2


def test_hashes_tell_long_regular_words_apart():
    one, two = thue_morse(10)
    found = next(common.lower_words([f"{one} {two} {one}"]))
    assert len(set(found.hashes.tolist())) == 2
    text = f"{one} {two} a b c d e {two} {one} a b c d e"
    ((_, sets, _),) = neardup.shingle_sets([text], 5)
    assert len(sets[0]) == len(shingles(text, 5)) == 9


def test_long_texts_are_read_in_runs():
    rng = random.Random(1)
    text = " ".join(f"w{rng.randint(0, 999)}" for _ in range(3000)) + "  \n" + "y" * 900 + " end"
    whole, cut = (next(common.lower_words([text], limit)) for limit in (1 << 20, 256))
    assert whole.hashes.tolist() == cut.hashes.tolist() and whole.classes == cut.classes and cut.counts.tolist() == [len(text.split())]

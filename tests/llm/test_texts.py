"""Long texts, texts without blanks, and scripts other than Latin."""

import functools
import random
import re

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logwarden.llm import bytebpe, langid, lmscore, syncmers, tokenfiles

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


# --- languages ------------------------------------------------------------------------


def sentences(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


EN, DE = "the of and to in is that for with was".split(), "der die und das ist nicht ein ich zu auf".split()


def test_a_language_of_long_texts_only_is_learned(spark):
    rng = random.Random(1)
    rows = [(i, sentences(rng, EN, 80), "en") for i in range(60)] + [(100 + i, sentences(rng, DE, 21_000), "de") for i in range(2)]
    models = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert models.languages == ["de", "en"]
    kinds = langid.letter_kinds()
    assert models.judge(sentences(rng, DE, 40), kinds)[0] == "de" and models.judge(sentences(rng, EN, 40), kinds)[0] == "en"


def test_a_language_of_kept_back_texts_only_is_learned(spark):
    rng = random.Random(2)
    kept_back = None
    for _ in range(200):  # a text that falls to the tenth that is kept back
        text = sentences(rng, DE, 60)
        if spark.range(1).select(F.pmod(F.xxhash64(F.lit(text), F.lit("part")), F.lit(10))).first()[0] == 0:
            kept_back = text
            break
    rows = [(i, sentences(rng, EN, 80), "en") for i in range(40)] + [(100, kept_back, "de")]
    models = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert models.languages == ["de", "en"]
    assert models.judge(sentences(rng, DE, 40), langid.letter_kinds())[0] == "de"


@pytest.mark.parametrize("text", ["Some words, 12 of them!  And  more\n\n(lines)  ", "  --  a", "x" * 300, "é ß -- 日本語 " * 30, " . . . ab", "ab . . . . . . . . . . . . . . . . . . . . cd", "...", ""])
def test_long_texts_are_judged_in_parts(text):
    kinds = langid.letter_kinds()
    whole = langid.normal(text, kinds, 4)
    for run in (1, 2, 7, 50):
        parts = [p for p in langid.normal_runs(text, kinds, 4, run)]
        if whole is None:
            assert not parts
            continue
        grams = [tuple(p[i : i + 4]) for p in parts for i in range(len(p) - 3)]
        assert grams == [tuple(whole[i : i + 4]) for i in range(len(whole) - 3)]


# --- fingerprints ----------------------------------------------------------------------


def near(spark, a, b):
    params = syncmers.Params()
    rows = spark.createDataFrame([(a, b)], "a string, b string")
    sketch = lambda c: syncmers.sketch(syncmers.anchor_list(F.col(c)), params)
    return rows.select(syncmers.likeness(sketch("a"), sketch("b"), params)).first()[0]


@pytest.mark.parametrize("alphabet", ["абвгдежзиклмнопрстуфхцчшыэюя", "αβγδεζηθικλμνξοπρστυφχψω", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "가나다라마바사아자차카타파하", "abcdefghijklmnopqrstuvwxyz"])
def test_unrelated_texts_are_unlike_in_every_script(spark, alphabet):
    rng = random.Random(3)
    text = lambda: " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(3, 8))) for _ in range(1500))
    a = text()
    assert near(spark, a, text()) < 0.1
    words = a.split()
    words[700] = "x"
    assert near(spark, a, " ".join(words)) > 0.9


def test_a_change_in_a_long_run_stays_local(spark):
    rng = random.Random(4)
    run = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(4000))
    assert near(spark, run, run[:1000] + "X" + run[1000:]) > 0.8
    assert near(spark, run, run[:2000] + run[2003:]) > 0.8


def test_scripts_without_blanks_go_by_characters(spark):
    rng = random.Random(5)
    text = "".join(chr(rng.randint(0x4E00, 0x5E00)) for _ in range(600))
    assert near(spark, text, text[:300] + "本" + text[300:]) > 0.9
    assert near(spark, text, "".join(chr(rng.randint(0x4E00, 0x5E00)) for _ in range(600))) < 0.1


PYTHON_UNITS = syncmers.UNITS.replace(r"\x{20000}-\x{3FFFF}", "\U00020000-\U0003ffff")


def test_fingerprints_by_brute_force(spark):
    texts = ["", " ", "one", "one two", "one two three four five six seven", "日本語のテキスト です", "x" * 500, "Привет мир и ещё слова " * 4, "a\x00b \x01 c", "naïve — «quoted» 123, done.", "\U00020001\U00020002 w"]
    signed = lambda h: h - 2**64 if h >= 2**63 else h
    chain = lambda *p: functools.reduce(lambda seed, x: xxhash.xxh64_intdigest(x, seed), p, 42)
    number = lambda h: (h % 2**64).to_bytes(8, "little")
    params = syncmers.Params(size=8)
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for r in syncmers.fingerprints(rows, params=params).collect():
        units = regex.findall(PYTHON_UNITS, r.text)
        h = [signed(chain(u.encode())) for u in units]
        if len(h) >= 3:
            found = [signed(chain(*(number(x) for x in h[i : i + 3]))) for i in range(len(h) - 2) if min(h[i], h[i + 2]) <= h[i + 1]]
        else:
            found = [signed(chain(*(number(x) for x in h)))] if h else []
        assert r.fingerprint == "".join(f"{x % 2**64:016x}" for x in sorted(set(found))[:8]), r.text


def test_ranges_are_found_in_two_steps(spark):
    for n in (1, 2, 3, 10, 50, 101):
        cuts = [7 * i for i in range(n)]
        places = spark.range(-3, 7 * n + 10)
        got = [r[0] for r in places.select(syncmers.range_of(F.col("id"), cuts)).collect()]
        assert got == [sum(c < p for c in cuts) for p in range(-3, 7 * n + 10)]


# --- memories of tokenizers -------------------------------------------------------------


def test_texts_without_blanks_are_not_remembered():
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefghij0123456789,.é") for _ in range(2000)) for _ in range(40)]
    encoder = bytebpe.Encoder(bytebpe.Vocabulary(bytebpe.read_ranks(RANKS)), public_tokenizers.PATTERN)
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.read_ranks(RANKS), special_tokens={})
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [known.encode_ordinary(t) for t in texts]
    assert not encoder.memory
    path = public_tokenizers.path("word_bpe_49k.json")
    words, library = tokenfiles.WordEncoder(path), Tokenizer.from_file(path)
    for text in texts:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert all(len(w) <= tokenfiles.LONGEST for w in [*words.words, *words.runs]) and len(words.words) <= 40


def test_other_patterns_and_vocabularies_read_whole_texts():
    pattern = r"\S+\s*|\s+"  # a blank belongs to the word before it
    encoder = bytebpe.Encoder(bytebpe.Vocabulary(bytebpe.read_ranks(RANKS)), pattern)
    known = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bytebpe.read_ranks(RANKS), special_tokens={})
    assert not encoder.splits
    for text in ("two words", " a  b ", "it's  here\n"):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == known.encode_ordinary(text)
    path = public_tokenizers.path("byte_bpe_50k.json")  # keeps case and white space
    words, library = tokenfiles.WordEncoder(path), Tokenizer.from_file(path)
    assert not words.as_assumed
    assert np.frombuffer(words.encode("Two  Words"), "<u4").tolist() == library.encode("Two  Words", add_special_tokens=False).ids


# --- language model ----------------------------------------------------------------------


def thue_morse(bits):
    out = "a"
    for _ in range(bits):
        out += out.translate({97: 98, 98: 97})
    return out, out.translate({97: 98, 98: 97})


def lm_rows():
    rng = random.Random(7)
    pool = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(pool, weights=range(60, 0, -1), k=rng.randint(1, 120)))) for i in range(150)]
    one, two = thue_morse(10)  # hash alike as polynomials
    rows += [(200, None), (201, ""), (202, f"{one} w1 w2"), (203, f"{two} w1 w2"), (204, f"{one} {two} w1"), (205, "W1 w2 W3"), (206, rows[3][1])]
    return rows


def brute_force(rows, held_out, params, weighing):
    """Scores from dictionaries, with weights learned from exact ratios in steps."""
    from collections import Counter

    def tokens(text):
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "<end>"]

    def grams(text):
        t = ["<s>", "<s>", *tokens(text)]
        return [(tuple(t[i - 2 : i + 1]), tuple(t[i - 1 : i + 1]), t[i]) for i in range(2, len(t))]

    def counts(texts):
        c = Counter()
        for text in texts:
            for three, two, one in grams(text):
                c.update([three, two, (one,)])
            c[("<s>",)] += 1
            c[("<s>", "<s>")] += 1
        return c

    def sizes(c):
        words = {k: n for k, n in c.items() if len(k) == 1 and k != ("<s>",)}
        return len(words), sum(words.values())

    train = [t for d, t in rows if not held_out(d)]
    counted, weighed = [t for t in train if not weighing[t]], [t for t in train if weighing[t]]
    c0 = counts(counted)
    v0, n0 = sizes(c0)
    step = lambda x: round(np.log2(x) * params.steps) if x > 0 else -(10**6)
    power = lambda x: 0 if x == 0 else min(int(np.log2(x)) + 1, params.buckets - 1)
    cells = Counter()
    for text in weighed:
        for three, two, one in grams(text):
            h = c0[(two[0],)]
            cells[(power(h), step(c0[two] / max(h, 1) * (v0 + 1)), step(c0[(one,)] / max(n0, 1) * (v0 + 1)))] += 1
    table = lambda c: np.array([(*k, n) for k, n in c.items()], np.int64).reshape(-1, 4)
    low = lmscore.learned_weights(table(cells), params)

    def lower(c, v, n, two, one):
        h = c[(two[0],)]
        w = low[power(h)]
        return w[0] * c[two] / max(h, 1) + w[1] * c[(one,)] / max(n, 1) + w[2] / (v + 1)

    cells = Counter()
    for text in weighed:
        for three, two, one in grams(text):
            h = c0[three[:2]]
            cells[(power(h), step(c0[three] / max(h, 1) / lower(c0, v0, n0, two, one)), 0)] += 1
    high = lmscore.learned_share(table(cells), params)
    c = counts(train)
    v, n = sizes(c)
    out = {}
    for d, text in rows:
        total = 0.0
        for three, two, one in grams(text):
            k = high[power(c[three[:2]])]
            total += np.log10(k * c[three] / max(c[three[:2]], 1) + (1 - k) * lower(c, v, n, two, one))
        out[d] = total
    return out


@pytest.mark.parametrize("options", [{}, {"block_bytes": 3000, "range_bytes": 2000}, {"block_bytes": 900, "range_bytes": 500, "fan_out": 2}, {"block_bytes": 900, "range_bytes": 300, "fan_out": 4}])
def test_scores_by_brute_force(spark, options):
    rows = lm_rows()
    params = lmscore.Params(**options)
    held_out = lambda d: d % 5 == 1
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    weighing = {r.text: r.w for r in docs.select("text", (F.pmod(F.xxhash64("text", F.lit("weights")), F.lit(10)) == 0).alias("w")).collect()}
    assert sum(weighing.values()) > 5
    want = brute_force(rows, held_out, params, weighing)
    got = {r.doc_id: r.score for r in lmscore.score(docs, F.col("doc_id") % 5 == 1, params).collect()}
    assert got.keys() == want.keys()
    # a ratio on the border of a step may fall to either side
    assert all(got[d] == pytest.approx(want[d], rel=2e-3) for d in want)
    assert np.mean([abs(got[d] - want[d]) < 1e-6 * abs(want[d]) for d in want]) > 0.5


def test_trigrams_tell_repeated_texts(spark):
    rng = random.Random(8)
    pool = [f"w{i}" for i in range(300)]
    repeated = " ".join(rng.choices(pool, k=80))
    rows = [(i, " ".join(rng.choices(pool, k=80))) for i in range(120)] + [(200 + i, f"x{i} {repeated}") for i in range(60)]  # some are among the weighing tenth
    found = lmscore.score(spark.createDataFrame(rows, "doc_id bigint, text string"), F.lit(False))
    per_token = {r.doc_id: r.score / r.n_tokens for r in found.collect()}
    assert min(per_token[200 + i] for i in range(60)) > max(per_token[i] for i in range(120)) + 0.5


# --- quality ------------------------------------------------------------------------------


def test_quality_verdicts_by_brute_force(spark):
    from collections import Counter

    from logwarden.llm import quality

    rng = random.Random(9)
    pool = [a + b for a in ("wat", "lich", "gré", "son", "mar", "日本") for b in ("er", "en", "ing", "tes", "lo")]
    good = [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    odd = ["", None, " \n", "x", "zq$ " * 80, "wat#er " * 60] + [" ".join(w[::-1] for w in t.split()) for t in good[:10]]
    texts = dict(enumerate(good + odd))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    trusted = [i for i in range(60) if i % 3]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id bigint, quality int")
    params = quality.Params()
    got = {r.doc_id: r for r in quality.judged(docs, labels, F.col("quality") == 1).collect()}

    signed = lambda h: h - 2**64 if h >= 2**63 else h
    chain = lambda *p: functools.reduce(lambda seed, x: xxhash.xxh64_intdigest(x.encode(), seed), p, 42)
    bucket = lambda *p: signed(chain(*p)) % params.buckets
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in texts.items()}
    trigrams = {i: [bucket(f" {x} "[j : j + 3]) for x in w for j in range(len(x))] for i, w in words.items()}
    borders = {i: [bucket(x[-2:]) for x in w] + [bucket(a[-1], b[0]) for a, b in zip(w, w[1:])] for i, w in words.items()}

    def counted(features):
        raw = Counter(b for f in features.values() for b in f)
        return raw, Counter(b for i in trusted for b in features[i])

    raw, best = counted(trigrams)
    scale = sum(raw.values()) / sum(best.values())
    inner = {b: np.log((best[b] * scale + 1) / (n + 1)) for b, n in raw.items()}
    raw, best = counted(borders)
    outer = {b: np.log((best[b] + 1) / (sum(best.values()) + params.buckets)) - np.log((n + 1) / (sum(raw.values()) + params.buckets)) for b, n in raw.items()}
    mean = lambda table, found: sum(table[b] for b in found) / max(1, len(found))
    text_ratio = {i: mean(inner, f) for i, f in trigrams.items()}
    log_ratio = {i: mean(outer, f) for i, f in borders.items()}
    for i, r in got.items():
        assert r.text_ratio == pytest.approx(text_ratio[i], abs=1e-4) and r.log_ratio == pytest.approx(log_ratio[i], abs=1e-4)
    # less than a thousandth of the trusted texts may be lost: none of them
    least = min(got[i].log_ratio for i in trusted if words[i]), min(got[i].text_ratio for i in trusted if words[i])
    for i, r in got.items():
        assert r.kept == (not r.base_failed and r.log_ratio >= least[0] and r.text_ratio >= least[1])
    assert any(r.kept for r in got.values()) and any(not r.kept and not r.base_failed for r in got.values())

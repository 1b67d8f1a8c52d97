"""The whole pipeline against plain Python: who stays, what texts become, how much each source gives."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from logwarden.llm import bytebpe, pseudonyms

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def documents():
    rng = random.Random(11)
    pools = {"en": "the of and to in is that for with was".split(), "de": "der die und das ist nicht ein ich zu auf".split()}
    text = lambda lang, n: " ".join(rng.choice(pools[lang]) + rng.choice(["", "ing", "en", "ly", "er"]) for _ in range(n))
    rows = [(i, text(("en", "de")[i % 2], rng.randint(40, 160)), ("en", "de")[i % 2], "abc"[i % 3] if i % 7 else None) for i in range(120)]
    for i in range(120, 150):  # copies with one word changed or none
        words = rows[i % 10][1].split()
        if i % 2:
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), rows[i % 10][2], "a"))
    private = "write to bob.smith{0}@example.com or +1 (456) 555-21{0}, card 4111 1111 1111 1111, password=hunter{0}x"
    rows += [(150 + i, f"{text('en', 60)} {private.format(10 + i)} {text('en', 20)}", "en", "b") for i in range(10)]
    rows += [(160, None, None, "a"), (161, "12 34 !!", "en", "a"), (162, rows[3][1], "de", "c")]
    return rows


def test_pipeline_by_brute_force(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    stages = {}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        stages[name] = docs.collect()
    given = {r[0]: r for r in rows}

    # languages: what has no letters goes, whole texts in the two languages stay as they are
    found = {r.doc_id: tuple(r) for r in stages["languages"]}
    assert found == {d: r for d, r in given.items() if d not in (160, 161)}

    # near duplicates: the least id of each group
    sets = {d: shingles(r[1]) for d, r in found.items()}
    label = {d: d for d in sets}
    for _ in range(5):
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    kept = {d for d in sets if label[d] == d}
    assert {r.doc_id: tuple(r) for r in stages["near_duplicates"]} == {d: given[d] for d in kept}
    assert len(kept) < len(found) - 20

    # personal data: the same pseudonyms as for single texts
    feistel = pseudonyms.Feistel(corpus_pipeline.PSEUDONYM_KEY)
    private = {d: pseudonyms.replaced(given[d][1], feistel)[0] for d in kept}
    assert {r.doc_id: r.text for r in stages["personal_data"]} == private
    assert all(private[d] != given[d][1] for d in range(150, 160))

    # mix: each source near its target, no document above its limit
    size = {d: len(WORD.findall(t)) for d, t in private.items()}
    total = Counter()
    for d in kept:
        total[given[d][3]] += size[d]
    order = sorted(s for s in total if s is not None) + ([None] if None in total else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while open_:
        left = sum(total.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 3 * total[s]]
        target |= {s: 3 * total[s] for s in above} if above else share
        open_ = open_ - set(above) if above else set()
    copies = Counter(r.doc_id for r in stages["mix"])
    taken = Counter()
    for d, n in copies.items():
        assert d in kept and n <= 3
        taken[given[d][3]] += n * size[d]
    assert all(abs(taken[s] - target[s]) <= 2 * max(size[d] for d in kept if given[d][3] == s) for s in order)
    assert all(r.text == private[r.doc_id] for r in stages["mix"])

    # tokens: what the library says of each text, as often as it was taken
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    assert Counter(r.doc_id for r in stages["tokens"]) == copies
    for r in stages["tokens"]:
        assert np.frombuffer(r.ids, "<u4").tolist() == known.encode_ordinary(private[r.doc_id]) and r.n_tokens == len(r.ids) // 4
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()) == copies

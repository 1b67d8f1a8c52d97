"""Fill-in-middle against a plain regular expression; the border set against a sorted list."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from logwarden.llm import infill, queries

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")
TEXTS = [
    "The quick brown fox, it jumps!", "", None, "a", "!", " \t\n", "日本語 text \U0001f600 mixed É", "has <P> marker", "has <S> too", "and <M>", "tail <", "<P", "<<P",
    "word " * 30_000, "x" * 70_000, ".,;" * 50_000, "a." * 40_000 + "b" * 70_000 + "!" * 70_000,
]


def wanted(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(tokens)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    head, body, tail = ("".join(t) for t in (tokens[:a], tokens[a:b], tokens[b:]))
    if h4 % 100 < 20:
        return n, "spm", len(head), len(body), f"<S>{tail}<P>{head}<M>{body}"
    return n, "psm", len(head), len(body), f"<P>{head}<S>{tail}<M>{body}"


@pytest.fixture(scope="module")
def rows():
    out = [(i, TEXTS[i % len(TEXTS)]) for i in range(170)]
    return [*out, (7, "the same id twice"), (7, "the same id twice"), (None, "a row without id"), (None, None)]


def test_transform_and_restore(spark, rows):
    docs = spark.createDataFrame([(*r, "x", "y", 3) for r in rows], "doc_id bigint, text string, form string, key string, n bigint").repartition(3)
    found = infill.restore(infill.transform(docs))
    assert found.columns == ["doc_id", "key", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found.collect()]
    assert sorted(got, key=repr) == sorted([(d, *wanted(d, t)) for d, t in rows], key=repr)
    assert sorted((r.doc_id, r.restored) for r in found.filter("doc_id is not null").collect()) == sorted((d, t or "") for d, t in rows if d is not None)
    assert {"plain", "psm", "spm"} == {r[2] for r in got}
    empty = infill.restore(infill.transform(docs.limit(0)))
    assert empty.count() == 0


def test_query(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_infill"](spark, str(tmp_path)).filter(F.col("doc_id").isNotNull()).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for d, t in rows:
        if d is not None:
            *head, output = wanted(d, t)
            want.append((d, *head, sha(output), sha(t or "")))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_border_set_uses_every_container():
    rng = np.random.default_rng(1)
    parts = [rng.random(65_536) < 0.01, rng.random(65_536) < 0.5, np.arange(65_536) % 1000 < 700, np.zeros(65_536, bool), np.ones(65_536, bool), rng.random(100) < 0.3]
    found = infill.BorderSet()
    for part in parts:
        found.append(part)
    members = np.flatnonzero(np.concatenate(parts))
    assert {c[0] for c in found.containers} == {"array", "bitmap", "runs"} and len(found) == len(members)
    for rank in [*range(0, len(members), 997), len(members) - 1]:
        assert found.select(rank) == members[rank]

import random

import numpy as np
import pytest

from tests.llm import plain
from weekmeter.llm import ngram_join as J
from weekmeter.llm.common import Cuts
from weekmeter.llm.components import components


def result(df):
    return {r["id"]: (r["n"], r["component"]) for r in J.jaccard_components(df).collect()}


def mutated(rnd, words, share):
    return [rnd.choice(VOCABULARY) if rnd.random() < share else w for w in words]


VOCABULARY = [f"w{k}" for k in range(300)]


def corpus(seed):
    """Sets of all sizes near the threshold, groups of copies, chains, and passages that many share."""
    rnd = random.Random(seed)
    passage = [rnd.choice(VOCABULARY) for _ in range(30)]
    texts = []
    for size in (1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 15, 20, 30, 31, 36, 37, 40, 60, 132, 140, 300):
        base = [rnd.choice(VOCABULARY) for _ in range(size)]
        texts.append(base)
        texts.append(list(base))
        for share in (0.005, 0.01, 0.02, 0.03, 0.05):
            texts.append(mutated(rnd, base, share))
        texts += [base + [rnd.choice(VOCABULARY) for _ in range(max(1, size // k))] for k in (5, 8, 20)]
        texts += [base[: max(1, size - size // k)] for k in (5, 6, 10)]
        texts.append(passage + base)
    chain = [rnd.choice(VOCABULARY) for _ in range(120)]
    for _ in range(12):
        texts.append(list(chain))
        chain = chain[9:] + [rnd.choice(VOCABULARY) for _ in range(9)]
    rnd.shuffle(texts)
    return [(k, " ".join(t).upper() if rnd.random() < 0.1 else " ".join(t)) for k, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_those_of_comparing_every_pair(documents, seed):
    rows = corpus(seed)
    assert result(documents(rows)) == plain.jaccard_groups(rows)


def test_hot_buckets_are_salted_without_losing_links(documents, monkeypatch):
    monkeypatch.setattr(J, "HOT_LEVEL", 0)
    rows = corpus(3)
    assert result(documents(rows)) == plain.jaccard_groups(rows)


@pytest.mark.parametrize("other", ["{} more", "before {}"])
def test_hot_short_text_links_with_a_rare_one(documents, monkeypatch, other):
    # 64 copies and one text of a shingle more: the levels are 7 and, of the shingle with a new word, 0.
    monkeypatch.setattr(J, "HOT_LEVEL", 4)
    base = " ".join(f"hot{k}" for k in range(11))
    rows = [(k, base) for k in range(10, 74)] + [(100, other.format(base)), (102, "not like the others")]
    found = result(documents(rows))
    assert found == plain.jaccard_groups(rows)
    assert found[100] == (8, 10) and found[102] == (1, 102)


def test_equal_signatures_have_equal_levels():
    rnd = np.random.default_rng(6)
    counts = rnd.integers(0, 20, 1 << 10).astype(np.uint8)
    for n in [k for k in range(1, 9) for _ in range(50)]:
        whole = np.unique(rnd.integers(0, 2**64, n, dtype=np.uint64))
        levels = {}
        for k in range(-1, n):
            part = np.delete(whole, k) if k >= 0 else whole
            if len(part):
                for sign, level in zip(*(x.tolist() for x in J.signatures(part, counts)), strict=True):
                    assert levels.setdefault(sign, level) == level


def test_every_linked_pair_shares_a_signature():
    rnd = np.random.default_rng(5)
    counts = rnd.integers(0, 6, 1 << 10).astype(np.uint8)
    for _ in range(3000):
        n = int(rnd.integers(1, 150))
        base = rnd.integers(0, 2**64, n, dtype=np.uint64)
        changes = int(rnd.integers(0, n // 4 + 2))
        drop = min(n - 1, int(rnd.integers(0, changes + 1)))
        other = np.concatenate((base[drop:], rnd.integers(0, 2**64, changes - min(drop, changes), dtype=np.uint64)))
        a, b = np.unique(base), np.unique(other)
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert np.intersect1d(J.signatures(a, counts)[0], J.signatures(b, counts)[0]).size
            x, y = (np.frombuffer(J.parity(s), np.uint8) for s in (a, b))
            x, y = (x, y) if len(x) >= len(y) else (y, x)
            apart = np.bitwise_count(np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0) ^ y).sum()
            assert apart <= (len(a) + len(b)) // 9


def test_defined_results(documents):
    long = " ".join(f"x{k}" for k in range(50_000))
    rows = [
        (None, "a b c d e f"), (2, "A b C d e f"), (3, None), (4, ""), (5, " \n\t"), (6, "one two"), (7, "one\x0btwo"),
        (8, long), (9, long + " y"), (10, "z" * 3_000_000), (11, "z" * 3_000_000), (6, "one two"), (12, "é é é é é"),
    ]
    found = J.jaccard_components(documents(rows, node=1, id=5, sign=3)).collect()
    by = {r["id"]: (r["n"], r["component"]) for r in found}
    low = -(2**63)
    assert len(found) == len(rows)
    assert by[low] == (2, low) and by[2] == (2, low)
    assert by[3] == (0, 3) and by[4] == (0, 4) and by[5] == (0, 5)
    assert by[6] == (1, 6) and by[7] == (1, 6)
    assert by[8] == (49_996, 8) and by[9] == (49_997, 8)
    assert by[10] == (1, 10) and by[11] == (1, 10) and by[12] == (1, 12)


def test_empty_table(documents):
    assert J.jaccard_components(documents([])).collect() == []


def test_stage_keeps_one_of_each_group_and_all_columns(spark, documents):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other text of a document"), (4, None), (4, None), (5, "")]
    docs = documents(rows, id=7, component=8, node=9)
    kept = J.keep_one_of_each(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["id"], r["component"]) for r in kept.collect()) == [(k, 7, 8) for k in (1, 3, 4, 5)]


def test_stage_tells_rows_of_one_id_apart(spark, documents):
    near = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (None, "clean text of a document without id"), (None, "some other text that is as clean"), (None, "CLEAN text of a document without id"),
        (None, None), (None, None), (None, ""), (None, " \n"),
        (1, near), (7, near + " thirteen"), (7, "nothing in common with the first text of this id"), (7, "nor has this one anything"),
        (7, ""), (8, near), (8, near + " thirteen"), (9, near + " thirteen"),
    ]
    kept = [(r["doc_id"], r["text"]) for r in J.keep_one_of_each(spark, documents(rows), "").collect()]
    want = [
        (None, "CLEAN text of a document without id"), (None, "some other text that is as clean"),
        (None, None), (None, ""), (None, " \n"), (1, near),
        (7, "nothing in common with the first text of this id"), (7, "nor has this one anything"), (7, ""),
    ]
    assert sorted(map(repr, kept)) == sorted(map(repr, want))


def test_components_of_long_chains_and_big_stars(spark):
    links = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1400)] + [(5000, 5000), (7001, 7000)]
    with Cuts(spark) as cuts:
        found = components(spark.createDataFrame(links, "a long, b long"), "a", "b", cuts)
        found = {r["node"]: r["component"] for r in found.collect()}
    assert found == {k: 0 for k in range(201)} | {k: 1000 for k in range(1000, 1400)} | {7000: 7000, 7001: 7000}

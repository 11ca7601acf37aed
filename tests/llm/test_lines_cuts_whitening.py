"""Line dedup, fill-in-middle and whitening against plain Python, and their defined results."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import plain
from weekmeter.llm import fim, line_dedup, whitening

# Line dedup

SPACES = " \t\n\x0b\f\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_lines(rows, min_chars=40, min_docs=5):
    """(doc_id, text, n_lines, n_dropped) per row of (doc_id, text)."""
    holders = collections.defaultdict(set)
    key = lambda line: lower(line.strip(SPACES))
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc_id)
    last = {k: max(i for i in ids if i is not None) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == doc_id]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


LONG = "This line is longer than forty code points, É and all: ÀÉÎ"


def line_rows():
    rnd = random.Random(5)
    pool = [f"{k} a line that many of the documents share, number {k}" for k in range(30)]
    odd = [LONG, LONG.lower(), "  " + LONG + "\t\r", "\x0b" + LONG.upper(), "short", "", " ", "x" * 39, "x" * 40, "É" * 39, "É" * 40, "日本" * 20]
    rows = [(k, "\n".join(rnd.choices(pool + odd, k=rnd.randint(0, 12)))) for k in range(300)]
    rows += [(1000 + k, f"{pool[0]}\n{k}") for k in range(400)]  # a line of a third of all rows
    rows += [(2000, None), (2001, ""), (2002, "\n"), (2003, "\n".join(pool * 400)), (2003, pool[3]), (2004, "x" * 300_000)]
    rows += [(None, pool[1]), (None, pool[2] + "\nother"), (None, pool[2] + "\nother"), (7, "again\n" + pool[4]), (7, "again\n" + pool[4])]
    # Four documents and NULL are five; three and NULL, however often, are four.
    rows += [(k, "z" * 50) for k in (3000, 3001, 3002, 3003, None)]
    rows += [(k, "y" * 50 + "\n" + "Y" * 50) for k in (3000, 3001, 3002, None, None)]
    rnd.shuffle(rows)
    return rows


def test_lines_equal_plain_python(documents):
    rows = line_rows()
    found = line_dedup.drop_repeated_lines(documents(rows, h1=1, gone=2, line="x")).collect()
    assert collections.Counter(tuple(r) for r in found) == collections.Counter(plain_lines(rows))


def test_other_limits_and_columns_stay(documents):
    rows = line_rows()
    frame = documents(rows, id=1, kept="k", n_lines=3).withColumnRenamed("kept", "a.b")
    found = line_dedup.without_repeated_lines(frame, min_chars=3, min_docs=2)
    assert found.columns == frame.columns
    want = collections.Counter((i, t) for i, t, _, _ in plain_lines(rows, 3, 2))
    assert collections.Counter((r["doc_id"], r["text"]) for r in found.collect()) == want
    assert {r["n_lines"] for r in found.collect()} == {3}


def test_no_documents_have_no_lines(documents):
    empty = documents([(1, "x")]).where("doc_id > 1")
    assert line_dedup.drop_repeated_lines(empty).collect() == []


def test_hot_lines_are_dealt_out(spark, documents):
    """A hash that holds more than its share of lines has several salts, and all salts together are few."""
    rows = [(k, f"{LONG}\nown line of document number {k}, which nobody else has") for k in range(9000)]
    found = line_dedup.drop_repeated_lines(documents(rows))
    assert {(r[0], r[1]): r[2] for r in found.groupBy("n_lines", "n_dropped").count().collect()} == {(2, 1): 8999, (2, 0): 1}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# Fill-in-middle


def plain_cut(doc_id, text, seed=7, rate=100, first=50):
    text = text or ""
    units = re.findall("[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < first:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def cut_rows():
    rnd = random.Random(9)
    bits = ["\n", "\n\n", "a", "é", "日本語", "🎉", "<P", "<", ">", "S>", "\r\n", " ", "word " * 30, "x" * 5000, "é" * 4096]
    rows = [(k, "".join(rnd.choices(bits, k=rnd.randint(0, 40)))) for k in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "<P>"), (1003, "a<M>\nb"), (1004, "\n" * 50_000), (1005, "z" * 2_000_000), (1006, "line\n" * 100_000)]
    rows += [(None, "a\nb\nc"), (None, "a\nb\nc"), (7, "again\n"), (-5, "minus\nfive"), (1007, "<S" + "\n>" * 9)]
    return rows


@pytest.mark.parametrize("rates", [fim.Rates(), fim.Rates(seed=3, cut=40, suffix_first=90)])
def test_cuts_equal_plain_python_and_are_undone(documents, rates):
    rows = cut_rows()
    made = fim.fill_in_middle(documents(rows, n=5, form="f", output="o"), rates)
    found = made.withColumn("back", fim.restored(made["output"], made["form"])).collect()
    want = [(*plain_cut(i, t, rates.seed, rates.cut, rates.suffix_first), t or "") for i, t in rows]
    assert collections.Counter(tuple(r) for r in found) == collections.Counter(want)
    assert len({r["form"] for r in found}) == 3


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
def test_descent_finds_every_end(block):
    rnd = random.Random(block)
    for _ in range(60):
        text = "".join(rnd.choices(["\n", "a", "é", "🎉"], k=rnd.randint(0, 50)))
        data = np.frombuffer(text.encode(), np.uint8)
        counts = fim.BlockCounts(data, block)
        assert counts.total() == (text.count("\n"), len(text))
        at = 0
        for unit in range(1, text.count("\n") + 1):
            at = text.index("\n", at) + 1
            assert counts.after(unit) == (len(text[:at].encode()), at)
        assert counts.after(0) == (0, 0)


def test_no_documents_have_no_cuts(documents):
    assert fim.fill_in_middle(documents([(1, "x")]).where("doc_id > 1")).collect() == []


# Whitening


def embeddings(spark, rows):
    schema = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("n", pa.string()), ("x", pa.int64())])
    return spark.createDataFrame(pa.Table.from_pylist([{"vec_id": i, "embedding": v, "n": "own", "x": 3} for i, v in rows], schema))


def vector_rows(count=700, size=12, seed=4):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(count, size)) @ rng.normal(size=(size, size)) / 7
    return [(k, row.astype(np.float32).tolist()) for k, row in enumerate(mixed)]


ODD = [
    (5000, None), (5001, []), (5002, [float("nan")] + [0.0] * 11), (5003, [float("inf")] + [0.0] * 11),
    (5004, [None] + [0.0] * 11), (None, [0.5] * 12), (None, [0.5] * 12), (3, [0.25] * 12), (5005, [-100.5] * 12),
]


@pytest.mark.parametrize("rows", [vector_rows() + ODD, vector_rows(5, 3), vector_rows(40, 20), vector_rows(30, 40)])
def test_whitening_equals_plain_python(spark, rows):
    found = whitening.whiten(embeddings(spark, rows).repartition(5)).collect()
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * np.float64(np.float32(c))) + 100000 for c in v] for _, v in good], object)
    n, size = x.shape
    deviation = ((n * x - x.sum(axis=0)) ** 2).sum(axis=1)
    centred = np.array((x * n - x.sum(axis=0)) / n, float)
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(8, size, n - 1)
    assert len(found) == n * count
    assert {r["component"] for r in found} == set(range(1, count + 1))
    want = collections.Counter((i, d) for (i, _), d in zip(good, deviation, strict=True))
    assert collections.Counter((r["vec_id"], r["deviation"]) for r in found if r["component"] == 1) == want
    assert {r["n"] for r in found} == {n}
    assert found[0]["identity_error"] < 1e-9 and len({r["identity_error"] for r in found}) == 1
    for k in range(count):
        got = {(r["vec_id"], r["deviation"]): (r["whitened"], r["explained"]) for r in found if r["component"] == k + 1}
        plain_values = centred @ vectors[:, k] / np.sqrt(values[k])
        pairs = [(got[(i, d)][0], w) for (i, _), d, w in zip(good, deviation, plain_values, strict=True)]
        sign = np.sign(sum(a * b for a, b in pairs))
        assert max(abs(a * sign - b) for a, b in pairs) < 1e-6
        assert all(abs(e - values[k] / np.trace(v)) < 1e-9 for _, e in got.values())


@pytest.mark.parametrize("span", [1, 2, 5000, 1 << 33, 1 << 41])
def test_products_of_planes_are_exact(span):
    rng = np.random.default_rng(span)
    for rows in (1, 63, 64, 200):
        x = rng.integers(-span, span + 1, (rows, 5))
        assert (np.triu(whitening.products(x)) == np.triu(x.astype(object).T @ x.astype(object))).all()


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 0.25])], [(k, [0.5, 0.25]) for k in range(9)], [(1, None), (2, [])]])
def test_vectors_that_do_not_vary_give_no_rows(spark, rows):
    found = whitening.whiten(embeddings(spark, rows))
    assert found.collect() == [] and ", ".join(f"{c} {t.replace('bigint', 'long')}" for c, t in found.dtypes) == whitening.WHITENED


def test_deviations_too_large_for_a_long_are_null(spark):
    rows = [(k, [float(2**25 * (-1) ** k), 1.0]) for k in range(6)]
    found = whitening.whiten(embeddings(spark, rows)).collect()
    assert len(found) == 6 and all(r["deviation"] is None or r["deviation"] > 0 for r in found)
    want = {k: sum((6 * x - s) ** 2 for x, s in zip((2**35 * (-1) ** k + 100000, 1024 + 100000), (600000, 6 * 101024))) for k in range(6)}
    assert {r["vec_id"]: r["deviation"] for r in found} == {k: d if d < 2**63 else None for k, d in want.items()}


@pytest.mark.parametrize("rows", [[(1, [0.5]), (2, [0.5, 1.0])], [(1, [1e30]), (2, [0.5])]])
def test_other_lengths_and_too_large_entries_are_refused(spark, rows):
    with pytest.raises(Exception, match="differ in length|too large"):
        whitening.whiten(embeddings(spark, rows)).collect()


def test_plain_helper_reads_lines_as_the_contract_does():
    assert plain_lines([(1, None)]) == [(1, "", 1, 0)]
    assert plain.sha("") == hashlib.sha256(b"").hexdigest()

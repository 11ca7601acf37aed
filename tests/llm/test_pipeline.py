"""The corpus pipeline against plain Python, stage by stage in plain Python as well."""

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm import plain
from weekmeter.llm import bpe, quality_rules
from weekmeter.llm.common import read

CLEAN = [a + b for a in ("ther", "on", "ing", "ea", "st", "lo") for b in ("an", "ed", "or", "ly", "in", "at", "es")]


def sentence(rnd, length):
    return " ".join(rnd.choice(CLEAN) + rnd.choice(CLEAN) for _ in range(length)).capitalize() + "."


def corpus(seed):
    rnd = random.Random(seed)
    license_ = sentence(rnd, 60)
    rows = []
    for k in range(160):
        kind = k % 8
        lines = [sentence(rnd, rnd.randint(12, 30)) for _ in range(rnd.randint(4, 9))]
        if kind == 0:
            lines = [" ".join(w + "%%% ###" for w in line.split()) for line in lines]
        if kind == 1:
            lines.insert(rnd.randint(0, 4), license_)
        if kind == 2 and k > 8:
            lines = rows[-3][1].split("\n")
        if kind == 3 and k > 8:
            words = rows[-4][1].split(" ")
            words[len(words) // 2] = "changed"
            lines = [" ".join(words)]
        if kind == 4:
            lines = lines[:1]
        rows.append((k * 2, "\n".join(lines), f"s{k % 5}", int(kind != 0)))
    return rows


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    import pyarrow.parquet as pq

    path = tmp_path_factory.mktemp("sf")
    rows = corpus(11) + [(1001, None, "s1", None), (1003, "", None, None), (1005, " \n ", "s2", None)]
    pq.write_table(
        pa.table({
            "doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": [r[1] for r in rows], "lang": ["en"] * len(rows),
            "source": pa.array([r[2] for r in rows], pa.string()),
            "n_chars": pa.array([None if r[1] is None else len(r[1]) for r in rows], pa.int64()),
        }),
        path / "documents.parquet",
    )
    pq.write_table(
        pa.table({"doc_id": [r[0] for r in rows if r[3] is not None], "quality": [r[3] for r in rows if r[3] is not None]}),
        path / "labels.parquet",
    )
    return str(path)


def test_stages_are_in_order_and_keep_the_columns(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "substring dedup", "mixing sources to target weights", "BPE encoding and decoding",
    ]
    docs = read(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).dtypes == docs.dtypes


def test_pipeline_equals_plain_python(spark, folder):
    from tokenizers import Tokenizer

    docs = read(spark, folder, "documents")
    field = quality_rules.fit_field(docs, read(spark, folder, "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    content = dict(zip(texts, quality_rules.measure(pa.array(list(texts.values())), field)[5].tolist()))
    kept = {}
    for i, text in texts.items():
        words, _, _, _, repeated = plain.measures(text)
        if words >= 50 and 2 * repeated <= words and 2 * content[i] >= words:
            kept[i] = text
    assert len(kept) < len(texts) and all(r[3] == 0 for r in corpus(11) if r[0] not in kept and plain.measures(r[1])[0] >= 50)

    groups = plain.jaccard_groups(list(kept.items()))
    kept = {i: t for i, t in kept.items() if groups[i][1] == i}
    left = {}
    for i, words, removed, text in plain.without_repeats(list(kept.items())):
        if not removed:
            left[i] = kept[i]
        elif removed < words:
            left[i] = text
    taken = plain.mixed([(i, t, source[i]) for i, t in left.items()])
    library = Tokenizer.from_file(bpe.default_path())
    want = []
    for i, a, b in taken:
        words = plain.split(left[i])
        ids = library.encode(left[i] if b - a == len(words) else " ".join(words[a:b]), add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), plain.hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), plain.sha(text)))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got) == sorted(want)
    assert len({g[0] for g in got}) > 20


def test_pipeline_on_an_empty_table(spark, folder, tmp_path):
    read(spark, folder, "documents").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    read(spark, folder, "labels").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []

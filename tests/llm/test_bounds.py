"""Bounds on samples, ties, clashing names and shared ids."""

import collections
import itertools

import pytest
from pyspark.sql import functions as F

from weekmeter.llm import bpe, mixing, quality_knn, quality_rules, sharding
from weekmeter.llm.common import Cuts, join_spread, labelled_sample, shared_path


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_sample_is_bounded_in_texts_and_takes_the_lower_label(spark, documents):
    rows = [(1, f"text number {k} of one id") for k in range(3000)] + [(k, f"text of {k}") for k in range(2, 60)] + [(None, "x")]
    given = [(k, k % 2) for k in range(1, 60)] + [(1, 0), (4, 1), (4, 1), (None, 1), (5, None), (7, 3)]
    found = [labelled_sample(documents(rows), labels_of(spark, given).repartition(n), 20).collect() for n in (1, 7)]
    assert sorted(map(tuple, found[0])) == sorted(map(tuple, found[1]))
    assert collections.Counter(r["quality"] for r in found[0]) == {0: 20, 1: 20}
    whole = {r["doc"]: r["quality"] for r in labelled_sample(documents(rows), labels_of(spark, given), 1000).collect()}
    assert whole[1] == 0 and whole[4] == 0 and whole[5] == 1 and set(whole) == set(range(1, 60))


def test_voters_of_an_id_of_many_rows_are_bounded(spark, documents):
    rows = [(1, f"text number {k} of one id") for k in range(2900)] + [(k, f"word{k} " * 9) for k in range(2, 12)]
    voters = quality_knn.fit_voters(documents(rows), labels_of(spark, [(k, k % 2) for k in range(1, 12)]), sample=2)
    assert len(voters.good) <= 4


def test_training_lines_are_bounded(spark, documents):
    text = lambda k: "\n".join(f"line {k} {n} of a text that has very many lines" for n in range(5000))
    rows = [(k, text(k)) for k in range(6)]
    labels = labels_of(spark, [(k, k % 2) for k in range(6)])
    sizes = []

    def seen(chains):
        table = chains.toArrow()
        sizes.append((table.num_rows, max(len(x) for x in table.column("hashes").to_pylist())))

    original, quality_rules.train = quality_rules.train, seen
    try:
        quality_rules.fit_field(documents(rows), labels, most=50)
    finally:
        quality_rules.train = original
    assert sizes == [(50, quality_rules.LONGEST_CHAIN)]


def test_votes_equal_those_of_comparing_every_vector(spark, documents):
    good = [(k, f"A plain text about topic {k}. " + "It has several words and ends well. " * (1 + k % 3)) for k in range(0, 60, 2)]
    bad = [(k, "### $$ %% " * (1 + k % 4) + f"{k} && ||") for k in range(1, 60, 2)]
    docs = documents(good + bad)
    voters = quality_knn.fit_voters(docs, labels_of(spark, [(k, 1 - k % 2) for k in range(60)]))
    found = {r["doc_id"]: r["score"] for r in quality_knn.quality_scores(docs, voters).collect()}
    import pyarrow as pa

    for doc_id, text in good + bad:
        (_, terms), = quality_knn.term_counts(pa.array([text]))
        own = voters.latent(terms)[0].astype(float)
        cosines = sorted(((float(v.astype(float) @ own), g) for v, g in zip(voters.vectors, voters.good)), reverse=True)
        votes = [(max(c, 0) ** quality_knn.SHARPNESS, g) for c, g in cosines[: quality_knn.NEIGHBOURS]]
        want = sum(v * g for v, g in votes) / sum(v for v, _ in votes)
        assert found[doc_id] == pytest.approx(want, abs=1e-3)


def test_tokens_keep_columns_of_any_name(spark, documents):
    rows = [(1, "one two"), (2, None)]
    docs = documents(rows, n_tokens=5, ids="own", b=7).withColumnRenamed("b", "a.b")
    found = bpe.tokenize(spark, docs, "")
    assert found.columns == [c for c in docs.columns if c != "text"] + ["n_tokens_", "ids_sha256", "decoded_sha256", "ids_"]
    assert {(r["n_tokens"], r["ids"], r["a.b"]) for r in found.collect()} == {(5, "own", 7)}
    assert {r["doc_id"]: r["n_tokens_"] == len(r["ids_"]) for r in found.collect()} == {1: True, 2: True}


def test_mix_of_many_rows_without_id_is_the_same_each_time(spark, documents):
    rows = [(None, f"text {k} " + "word " * (k % 7), "s") for k in range(900)] + [(k, "a few words more", "t") for k in range(900)]
    docs = documents(rows)
    runs = []
    for parts in (1, 9):
        found = mixing.mix(docs.repartition(parts)).select("text", "size", "taken", "slices", "source_size", "target").collect()
        runs.append(collections.Counter((r["text"], r["size"], r["taken"], str(r["slices"])) for r in found))
        by = collections.defaultdict(list)
        for r in found:
            by[r["source_size"]].append(r)
            assert r["taken"] <= 3 * r["size"]
        assert all(abs(sum(r["taken"] for r in g) - g[0]["target"]) <= 2 * mixing.BLOCK for g in by.values())
    assert runs[0] == runs[1]


def test_one_more_shard_moves_few_keys(spark, documents):
    docs = documents([(k, "x") for k in range(6000)]).select("doc_id")
    keyed = docs.withColumns({"_ring": F.xxhash64("doc_id"), "_order": F.xxhash64("doc_id", F.lit("turn"))})
    before, after = (
        {r["doc_id"]: r["shard"] for r in sharding.assign(keyed, ["_order", "doc_id"], n).collect()} for n in (8, 9)
    )
    moved = [k for k in before if before[k] != after[k]]
    assert len(moved) < 0.25 * len(before)
    assert sum(after[k] != 8 for k in moved) < 0.08 * len(before)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_joins_equal_plain_ones(spark, how):
    rows = [(k % 3 if k % 2 else 7, k) for k in range(3000)] + [(None, 1), (50, 2)]
    rows = spark.createDataFrame(rows, "key long, value long")
    table = spark.createDataFrame([(k, f"t{k}") for k in range(9)], "key long, name string")
    plain_rows, spread = (collections.Counter(map(tuple, d.select("key", "value", "name").collect())) for d in (rows.join(table, "key", how), join_spread(rows, table, "key", how)))
    assert plain_rows == spread


class Cluster:
    """Stands in for a session on a cluster."""

    def __init__(self, folder):
        self.sparkContext = self
        self.master = "spark://host:7077"
        self.getCheckpointDir = lambda: folder


def test_folders_of_one_machine_are_refused_on_a_cluster():
    for folder in (None, "file:/tmp/x"):
        with pytest.raises(ValueError, match="share"):
            shared_path(Cluster(folder))
    assert shared_path(Cluster("hdfs://name/x/")) == "hdfs://name/x"


def test_cuts_are_removed(spark):
    from weekmeter.sources.tables import children

    with Cuts(spark) as cuts:
        one = cuts.keep(spark.range(5).select("id"))
        two = cuts.keep(one.groupBy((F.col("id") % 2).alias("k")).count())
        cuts.drop(one, None)
        assert {r["k"]: r["count"] for r in two.collect()} == {0: 3, 1: 2} and len(children(spark, cuts.folder)) == 1
        with pytest.raises(Exception):  # noqa: B017
            one.collect()
    assert children(spark, cuts.folder) == [] and cuts.folder.startswith(shared_path(spark))


def test_every_combination_of_edges_and_links_has_the_right_components(spark):
    from weekmeter.llm.components import components

    for links in itertools.islice(itertools.combinations([(1, 2), (2, 3), (5, 4), (3, 9), (9, 9)], 3), 3):
        with Cuts(spark) as cuts:
            got = {r["node"]: r["component"] for r in components(spark.createDataFrame(list(links), "a long, b long"), "a", "b", cuts).collect()}
        nodes = {x for a, b in links if a != b for x in (a, b)}
        group = {x: x for x in nodes}
        for _ in nodes:
            for a, b in links:
                if a != b:
                    group[a] = group[b] = min(group[a], group[b])
        assert got == group

"""Queries on a cluster whose folder for cut points is a mount (``file:``); a local session stands in for it."""

import collections
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from weekmeter.llm import common
from weekmeter.llm.queries import queries


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Some documents, pages and vectors; every third text and page is there twice."""
    at, deal = tmp_path_factory.mktemp("tables"), random.Random(5)
    lines = [" ".join(f"word{deal.randrange(300)}" for _ in range(12)) + "." for _ in range(60)]
    texts = ["\n".join(deal.sample(lines, 1 + k % 9)) for k in range(40)]
    texts = texts + texts[::3]
    ids = list(range(len(texts)))
    tables = {
        "documents": {"doc_id": ids, "text": texts, "lang": ["en"] * len(ids), "source": [f"s{k % 4}" for k in ids], "n_chars": list(map(len, texts))},
        "pages": {"page_id": ids, "url": [f"http://h{k % 5}.org/{k}" for k in ids], "html": [t * 5 for t in texts]},
        "embeddings": {"vec_id": ids, "embedding": pa.array([[deal.gauss(0, 1) for _ in range(16)] for _ in ids], pa.list_(pa.float32())), "label": [0] * len(ids)},
        "labels": {"doc_id": ids, "quality": [k % 2 for k in ids], "toxic": [0] * len(ids)},
    }
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), at / f"{name}.parquet")
    return str(at)


@pytest.fixture
def cluster(spark, monkeypatch):
    """The session, under the master's name of a cluster."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    yield spark
    common._seen.clear()


@pytest.fixture
def named(spark):
    """Set another folder for cut points; the session's own is set again afterwards."""
    yield spark.sparkContext.setCheckpointDir
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))


def rows(df):
    return collections.Counter(map(str, df.select(sorted(df.columns)).collect()))


def test_pipeline_runs_where_executors_share_a_mount(spark, folder, monkeypatch):
    alone = rows(corpus_pipeline.run(spark, folder))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert rows(corpus_pipeline.run(spark, folder)) == alone and alone
    common._seen.clear()


def test_a_mount_is_tried_and_leaves_nothing(cluster):
    common.prepare(cluster)
    at = cluster.sparkContext.getCheckpointDir()
    assert at.startswith("file:") and common.shared_path(cluster) == at
    assert not [x for x in common_files(cluster, at) if "seen-" in x]


def common_files(spark, at):
    from weekmeter.sources.tables import children

    return children(spark, at)


def test_a_mount_that_is_not_shared_is_refused(cluster, monkeypatch):
    """Some of what executors write is not there."""
    common.prepare(cluster)
    monkeypatch.setattr(common, "seen_by_all", lambda spark, folder: False)
    common.prepare(cluster)
    with pytest.raises(ValueError, match="share"):
        common.shared_path(cluster)


def test_files_that_are_missing_or_cannot_be_written_are_noticed(spark, tmp_path, monkeypatch):
    (tmp_path / "plain").write_text("x")
    assert common.seen_by_all(spark, f"file:{tmp_path}/there")
    assert not common.seen_by_all(spark, f"file:{tmp_path}/plain/x")
    assert not common.seen_by_all(spark, "nosuchstore://name/x")
    reader = type(spark.read)
    monkeypatch.setattr(reader, "parquet", lambda self, *paths, f=reader.parquet: f(self, *paths).where("id > 0"))
    assert not common.seen_by_all(spark, f"file:{tmp_path}/there")


def test_the_warehouse_is_taken_where_no_folder_is_named(cluster, named, monkeypatch):
    context = cluster.sparkContext
    own, set_dir = [], context.setCheckpointDir
    monkeypatch.setattr(context, "setCheckpointDir", lambda to: (set_dir(to), own.append(to)))
    monkeypatch.setattr(context, "getCheckpointDir", lambda f=context.getCheckpointDir: f() if own else None)
    for master in ("spark://host:7077", "local-cluster[2,1,1024]"):
        own.clear()
        context.master = master
        with pytest.raises(ValueError, match="share"):
            common.shared_path(cluster)
        common.prepare(cluster)
        assert own == [f"{cluster.conf.get('spark.sql.warehouse.dir')}/weekmeter-shared"]
        assert common.shared_path(cluster).startswith("file:") and "/weekmeter-shared/" in common.shared_path(cluster)
        assert common.cut(cluster.range(5)).count() == 5


def test_of_two_folders_the_one_that_is_shared_is_taken(cluster, named, monkeypatch):
    """The named folder is a disk of each machine, the warehouse is not."""
    tried = common.seen_by_all
    monkeypatch.setattr(common, "seen_by_all", lambda spark, at: "warehouse" in at and tried(spark, at))
    common.prepare(cluster)
    assert "/weekmeter-shared/" in common.shared_path(cluster)


QUERIES = ["op3_sharding", "op4_substring_dedup", "op5_warc", "op7_mixing", "op8_ngram_join", "op10_ann", "op11_line_dedup"]


@pytest.mark.parametrize("name", QUERIES)
def test_query_runs_where_executors_share_a_mount(spark, folder, monkeypatch, name):
    query = queries()[name]
    alone = rows(query(spark, folder))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert rows(query(spark, folder)) == alone and alone
    common._seen.clear()

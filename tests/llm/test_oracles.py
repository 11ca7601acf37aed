"""Every query of the package: against its SQL where it has one, and its contract's columns."""

from collections import Counter

import duckdb
import pytest

from weekmeter.llm.queries import oracle_sql, queries

FOLDERS = ("/root/testdata/sf0.001", "/root/testdata/sf0.01")
SAME_TYPE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
COLUMNS = {
    "op2_quality_knn": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op6_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op9_quality_rules": (
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, content_words bigint, base_failed boolean, kept boolean"
    ),
    "op10_ann": "query_id bigint, rank int, vec_id bigint, score double",
    "op13_embedding_whitening": (
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    ),
}


@pytest.fixture(scope="module", params=FOLDERS, ids=lambda f: f.rsplit("/", 1)[1])
def data(request):
    con = duckdb.connect()
    for name in ("documents", "pages", "conversations"):
        con.execute(f"create view {name} as select * from '{request.param}/{name}.parquet'")
    return request.param, con


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, data, name):
    folder, con = data
    got = queries()[name](spark, folder)
    want = con.sql(oracle_sql()[name])
    assert {c: SAME_TYPE[t] for c, t in got.dtypes} == dict(zip(want.columns, map(str, want.types)))
    columns = sorted(got.columns)
    got_rows = Counter(tuple(r) for r in got.select(*columns).collect())
    want_rows = Counter(want.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall())
    assert got_rows == want_rows


@pytest.mark.parametrize("name", list(COLUMNS))
def test_other_queries_have_their_columns(spark, name):
    df = queries()[name](spark, FOLDERS[0])
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[name]
    assert df.count() > 0


def test_every_query_is_tested():
    assert set(queries()) == set(oracle_sql()) | set(COLUMNS)

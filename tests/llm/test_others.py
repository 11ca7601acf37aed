"""Chat formatting, WARC and nearest neighbours against plain Python, and their defined results."""

import gzip
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import plain
from weekmeter.llm import ann, chat, warc

# Chat formatting

HARD = ["", "#", "##", "###", "####", "#####a###", "\\", "\\\\###", "</turn></turn>", "</tur</turn>n>", ":a: b", "\\:", "### user: x</turn>\n"]


@pytest.mark.parametrize("text", HARD)
def test_escapes_are_undone_and_leave_no_control_string(text):
    for escape in (chat.escape, chat.escape_role):
        assert chat.unescape(escape(text)) == text
        bare = chat.re.sub(r"\\.", "", escape(text))
        assert "###" not in bare and "</turn>" not in bare
    assert ":" not in chat.re.sub(r"\\.", "", chat.escape_role(text))


def conversations(spark, rows):
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("ids", pa.int64())])
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(schema.names, (*r, 1))) for r in rows], schema))


def chat_rows():
    rnd = random.Random(3)
    rows = []
    for conv in range(30):
        for turn in range(rnd.randint(1, 9)):
            role = rnd.choice(["user", "assistant", "system", "### x: ", ""])
            rows.append((conv, turn, role, rnd.choice([*HARD, "é 日本語 🎉 text", "plain words " * 20])))
    rows += [(100, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(3000)]
    rows += [(200, 0, "assistant", "z" * 300_000), (201, 1, None, None), (201, None, "assistant", None), (None, 5, "user", "no id"), (None, 4, "assistant", "first")]
    rnd.shuffle(rows)
    return rows


def test_conversations_are_read_back(spark):
    rows = chat_rows()
    template = chat.Template(spark, chat.default_path())
    formatted = chat.format_conversations(conversations(spark, rows), template)
    found = {r["conv"]: r for r in chat.read_back(formatted, template).collect()}
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(-(2**63) if conv is None else conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(found) == set(by)
    for conv, turns in by.items():
        turns.sort()
        r = found[conv]
        loss = "".join(t for _, _, role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == plain.sha("".join(f"{role}\n{t}\n" for _, _, role, t in turns))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), plain.sha(loss))
        assert r["formatted_chars"] == sum(
            len(f"### {chat.escape_role(role)}: {chat.escape(t)}</turn>\n") for _, _, role, t in turns
        )


def test_places_and_masks_are_prefix_sums(spark):
    template = chat.Template(spark, chat.default_path())
    rows = chat.format_conversations(conversations(spark, chat_rows()), template).collect()
    coder = template()
    ends = {}
    for r in sorted(rows, key=lambda r: (r["conv"], r["place"])):
        assert r["token_start"] == ends.get(r["conv"], 0)
        ends[r["conv"]] = r["token_start"] + len(r["ids"])
        ids, mask = r["ids"], r["loss_mask"]
        middle = ids.index(coder.role_end)
        trained = coder.decode(np.array(ids[1:middle])) == "assistant"
        assert mask == [int(trained and middle < k < len(ids) - 1) for k in range(len(ids))]


def test_chat_query_adds_the_given_conversation(spark, tmp_path):
    conversations(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    (row,) = chat.op1_chat(spark, str(tmp_path)).collect()
    text = "\\### Assistant: </turn> ok"
    assert (row["conv_id"], row["n_turns"], row["loss_chars"]) == (-7, 2, len(text)) and row["loss_sha256"] == plain.sha(text)


# WARC

def page_rows():
    rnd = random.Random(6)
    same = "é" * 900
    rows = [(k, f"http://{rnd.choice('abc')}.example.org/{rnd.randint(0, 9)}?x#{k}", "x" * rnd.randint(0, 3000)) for k in range(300)]
    rows += [(1000 + k, "http://hot.org/", same) for k in range(200)] + [(None, "q", same), (7000, None, None), (7001, "http://a.org/\r\nWARC/1.1", "")]
    return rows + [(8000, "x", "a\r\n\r\nWARC/1.1\r\n" * 200)] * 2 + [(8001, "X://Y.z", "Content-Length: 5\r\n\r\n" * 60)]


def pages(spark, rows):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string()), ("id", pa.int64()), ("key", pa.int64())])
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(schema.names, (*r, 1, 2))) for r in rows], schema))


def test_archives_are_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 40_000)
    monkeypatch.setattr(warc, "RANGE_ROWS", 60)
    rows = page_rows()
    pages(spark, rows).repartition(4).write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in warc.op5_warc(spark, str(tmp_path)).collect()]
    greatest = {}
    for i, _, html in rows:
        greatest[html] = max(greatest.get(html, -1), -1 if i is None else i)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 1000 and greatest[html] != i
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", greatest[html] if revisit else None))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_index_is_in_one_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    monkeypatch.setattr(warc, "RANGE_ROWS", 50)
    path = f"{tmp_path}/archives"
    warc.write_archives(pages(spark, page_rows()).repartition(3), path)
    entries = warc.read_archives(spark, path).checkpoint()
    assert entries.select("file").distinct().count() > 5
    merged = [tuple(r) for r in warc.merge_index(entries).collect()]
    assert len(merged) == len(page_rows()) and merged == sorted(merged, key=warc._order)


def test_no_pages(spark, tmp_path):
    pages(spark, []).write.parquet(f"{tmp_path}/pages.parquet")
    assert warc.op5_warc(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("count", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree_merges(count):
    rnd = random.Random(count)
    for _ in range(30):
        runs = [sorted(rnd.randrange(30) for _ in range(rnd.randrange(9))) for _ in range(count)]
        assert list(warc.LoserTree([iter(r) for r in runs], lambda x: x)) == sorted(sum(runs, []))


def test_url_key():
    assert warc.url_key("HTTP://www.Example.org/a/B?c=D#e") == "org,example,www)/a/B?c=D"
    assert warc.url_key("") == ")" and warc.url_key("x.org?q") == "org,x)?q"


def test_a_damaged_payload_is_found():
    data = (
        b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Target-URI: u\r\nWARC-Date: d\r\n"
        b"WARC-Payload-Digest: sha1:00\r\nContent-Length: 43\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 1\r\n\r\nabcdefgh"
    )
    with pytest.raises(ValueError, match="payload"):
        list(warc.parse_archive(data))


# Nearest neighbours


def embeddings(spark, rows):
    schema = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("score", pa.int64()), ("block", pa.int64())])
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(schema.names, (*r, 1, 2))) for r in rows], schema))


def brute(rows, k):
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for at in np.flatnonzero(ids % 20 == 0):
        scores = (matrix * matrix[at]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if j != at][:k]
        out[int(ids[at])] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def found(spark, folder):
    out = {}
    for r in sorted(ann.op10_ann(spark, str(folder)).collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("norms", ["unit", "mixed"])
def test_recall_against_brute_force(spark, tmp_path, monkeypatch, norms):
    monkeypatch.setattr(ann, "BLOCK", 1500)
    rnd = np.random.default_rng(7)
    matrix = rnd.standard_normal((3000, 48))
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    if norms == "mixed":
        matrix *= rnd.uniform(0.2, 3, (3000, 1))
    rows = [(k, v.tolist()) for k, v in enumerate(matrix)]
    embeddings(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got, want = found(spark, tmp_path), brute(rows, 20)
    assert set(got) == set(want)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.95
    exact = dict((q, dict(v)) for q, v in want.items())
    assert all(abs(s - exact[q][i]) < 1e-12 for q in got for i, s in got[q] if i in exact[q])


def test_ties_copies_and_vectors_that_take_no_part(spark, tmp_path):
    rnd = np.random.default_rng(8)
    base = rnd.standard_normal(16).tolist()
    rows = [(k, base) for k in range(200)] + [(200 + k, rnd.standard_normal(16).tolist()) for k in range(50)]
    odd = [(900, None), (920, []), (940, [0.0] * 16), (960, [None] + base[1:]), (980, [float("nan")] + base[1:]), (1000, [float("inf")] + base[1:]), (1020, [1.0, 2.0])]
    embeddings(spark, rows + odd + rows[:5] + [(None, base)]).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = found(spark, tmp_path)
    assert set(got) == {i for i, _ in rows if i % 20 == 0}
    assert [i for i, _ in got[40]] == [None, *range(19)]
    assert [i for i, _ in got[0]] == [None, *range(1, 20)]


def test_few_or_no_vectors(spark, tmp_path):
    embeddings(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 2.0])]).write.parquet(f"{tmp_path}/a/embeddings.parquet")
    assert found(spark, f"{tmp_path}/a") == {0: [(1, 0.5), (20, 0.0)], 20: [(1, 1.0), (0, 0.0)]}
    embeddings(spark, []).write.parquet(f"{tmp_path}/b/embeddings.parquet")
    assert found(spark, f"{tmp_path}/b") == {}


def test_probing_retrieves_every_code_within_the_radius():
    rnd = np.random.default_rng(9)
    subs = rnd.integers(0, 256, (500, 32)).astype(np.uint8)
    subs[:200] = subs[0] ^ (rnd.random((200, 32)) < 0.3) * rnd.integers(0, 256, (200, 32)).astype(np.uint8)
    index = ann.MultiIndex(subs)
    seen = np.zeros(500, bool)
    for t in range(4):
        new = index.probe(subs[0], t, seen)
        exactly = (np.bitwise_count(subs ^ subs[0]) == t).any(axis=1)
        assert sorted(new) == sorted(np.flatnonzero(exactly & ~seen))
        seen[new] = True
        near = index.distances(subs[0], np.arange(500)) <= 32 * (t + 1) - 1
        assert not (near & ~seen).any()


def test_each_block_is_indexed_once_whatever_the_batches(monkeypatch):
    rnd = np.random.default_rng(10)
    matrix = rnd.standard_normal((400, 16))
    ids = np.arange(400)
    built = []
    monkeypatch.setattr(ann, "MultiIndex", lambda subs, real=ann.MultiIndex: built.append(len(subs)) or real(subs))
    rows = [(block, False, int(i), matrix[i]) for block in (0, 1, 3) for i in ids if i % 4 == block]
    rows += [(block, True, int(i), matrix[i]) for block in (0, 1, 2, 3) for i in ids[::20]]
    rows.sort(key=lambda r: r[:2])
    table = pa.table({
        "block": pa.array([r[0] for r in rows], pa.int32()), "asked": [r[1] for r in rows],
        "id": [r[2] for r in rows], "embedding": [r[3].tolist() for r in rows],
    })
    longest, results = float(np.linalg.norm(matrix, axis=1).max()), []
    rotations = ann.learn_rotations(ann.on_sphere(matrix, longest))
    for size in (1, 7, 1000):
        built.clear()
        parts = ann.search_blocks(table.to_batches(max_chunksize=size), 16, longest, rotations, 20)
        results.append(sorted(tuple(r.values()) for part in parts for r in part.to_pylist()))
        assert built == [100, 100, 100]  # the block without vectors is none
    assert results[0] == results[1] == results[2] and len(results[0]) == 20 * 3 * 20


def test_vectors_move_once_and_queries_to_every_block(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 100)
    rnd = np.random.default_rng(11)
    rows = embeddings(spark, [(k, rnd.standard_normal(8).tolist()) for k in range(1000)])
    real = ann.search_blocks
    counter = spark.sparkContext.accumulator(0)

    def counted(batches, *given):
        def seen():
            for batch in batches:
                counter.add(batch.num_rows)
                yield batch

        return real(seen(), *given)

    monkeypatch.setattr(ann, "search_blocks", counted)
    assert ann.nearest(rows, rows.where("vec_id % 20 = 0")).count() == 50 * 20
    assert counter.value == 1000 + 50 * 10


def test_archives_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    # One partition of long pages among short ones: by number of records its file would hold nearly all bytes.
    monkeypatch.setattr(warc, "FILE_BYTES", 50_000)
    long = [(k, f"http://l.org/{k}", f"{k:06d}" * 2_000) for k in range(40)]
    short = [(k, f"http://s.org/{k}", f"<p>{k}</p>") for k in range(100, 1000)]
    given = pages(spark, long).coalesce(1).unionAll(pages(spark, short).coalesce(1))
    path = f"{tmp_path}/archives"
    warc.write_archives(given, path)
    entries = warc.read_archives(spark, path).checkpoint()
    sizes = [r["bytes"] for r in entries.groupBy("file").agg({"payload_bytes": "sum"}).withColumnRenamed("sum(payload_bytes)", "bytes").collect()]
    assert max(sizes) <= 50_000 + 12_000 and len(sizes) >= 9
    merged = warc.merge_index(entries).collect()
    assert sorted((r["page_id"], r["payload_bytes"]) for r in merged) == sorted((i, len(h)) for i, _, h in long + short)
    # A record's offset is where it starts in its unpacked file.
    one = merged[0]
    assert gzip.decompress((tmp_path / "archives" / one["file"]).read_bytes())[one["offset"] :].startswith(b"WARC/1.1\r\n")

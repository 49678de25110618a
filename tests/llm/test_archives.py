"""Whitening, web archives and conversation repair against brute force, SQL and round trips."""

import base64
import hashlib
import itertools
import math
import tempfile

import duckdb
import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from peerscope.llm import conversations, oracle, warc, whitening
from peerscope.llm.session import scratch_folder, with_row_key

# --- whitening -----------------------------------------------------------------------------

VECTORS = "extra string, x long, vec_id long, embedding array<double>, component string"


def brute_whitened(rows, components=4):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(v) for _, v in kept), default=0)
    kept = [(i, v + [0] * (dims - len(v))) for i, v in kept]
    fit = sorted(set(map(tuple, (v for _, v in kept))))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    x = np.array(fit, float) - np.array([s / n for s in sums])
    cov = x.T @ x / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    out = []
    for i, v in kept:
        dev = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        w = (np.array(v, float) - np.array(sums) / n) @ q / np.sqrt(e)
        out += [(i, k + 1, n, dev, abs(w[k]), e[k] / np.trace(cov)) for k in range(len(e))]
    return out


def whitened(spark, rows, **more):
    df = spark.createDataFrame([("e", 1, i, v, "c") for i, v in rows], VECTORS)
    return whitening.whitened_vectors(df, **more).collect()


def test_whitening_equals_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 64)  # many blocks and slices
    monkeypatch.setattr(whitening, "SLICE_ROWS", 32)
    rng = np.random.default_rng(5)
    rows = [(int(i), (rng.normal(size=6) * [9, 7, 5, 3, 2, 1]).tolist()) for i in range(150)]
    rows += [(0, rows[0][1])] * 40 + [(None, rows[1][1]), (7, None), (8, [1.0, None] + [0.0] * 4),
                                      (9, [float("nan")] + [0.0] * 5), (9, [-0.0] * 6),
                                      (10, [float("inf")] * 6), (11, [1.5, -2.5]), (12, [])]
    got = whitened(spark, rows)
    want = brute_whitened(rows)
    assert len(got) == len(want)
    key = lambda r: (repr(r[0]), r[1], r[3], round(r[4], 6))
    got_rows = [(r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained)
                for r in got]
    for g, w in zip(sorted(got_rows, key=key), sorted(want, key=key)):
        assert g[:4] == w[:4] and np.allclose(g[4:], w[4:], rtol=1e-9, atol=1e-9)
    assert {r.identity_error for r in got if r.identity_error < 1e-9}
    signs = {}
    for r in got:  # one sign for all rows of a component
        signs.setdefault((r.vec_id, r.deviation, r.component), set()).add(r.whitened)
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_without_variance_few_dimensions_and_no_rows(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, None), (2, [])]) == []
    got = whitened(spark, [(1, [0.5, 0.25])] * 3)
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error)
            for r in got] == [(1, c, 1, 0, None, None, None) for c in (1, 2)] * 3
    line = whitened(spark, [(i, [i / 4.0, i / 2.0]) for i in range(5)])
    assert {(r.component, r.whitened is None) for r in line} == {(1, False), (2, True)}
    assert {round(r.explained, 12) for r in line} == {0.0, 1.0}
    huge = whitened(spark, [(1, [1e30]), (2, [-1e30]), (3, [1e9]), (4, [2e9])])
    assert {r.vec_id for r in huge} == {1, 2, 3, 4}
    assert {r.vec_id for r in huge if r.deviation is None} == {1, 2, 3, 4}


# --- web archives --------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, row_ string"


def pages(spark, rows):
    return with_row_key(spark.createDataFrame([(*r, "x") for r in rows], PAGES), "row")


def sha(payload):
    return base64.b32encode(hashlib.sha1((payload or "").encode()).digest()).decode()


def test_archives_come_back_as_written(spark):
    text = "<p>é日\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n</p>"
    rows = [(1, "http://a/\r\nX: y", text), (2, None, text), (5, "u", None), (4, "", ""),
            (9, "http://x", "z" * 3_000_000), (None, "n", "only"), (None, "n", "only"),
            (7, "same", "row"), (7, "same", "row"), (3, "big", "<i>" + text * 99)]
    rows += [(100 + i, f"http://h/{i}", f"<html><body>{'word ' * (i % 50)}{i % 37}</body>")
             for i in range(400)]
    df, folder = pages(spark, rows), scratch_folder(spark, "test-warc")
    warc.write_archives(df, folder, archive_bytes=20_000)
    records = warc.read_archives(spark, folder)
    assert records.filter("error IS NOT NULL").isEmpty()
    assert records.select("archive").distinct().count() > 3
    got = warc.with_responses(records).collect()
    top = {}
    for page_id, _, html in rows:
        if page_id is not None:
            top[html or ""] = max(page_id, top.get(html or "", page_id))
    free = set()
    for r in got:
        html = next(h or "" for _, _, h in rows if sha(h) == r.payload_digest)
        assert r.payload_bytes == len(html.encode())
        if r.record_type == "response":
            assert r.page_id == top.get(html) and html not in free and r.refers_to is None
            free.add(html)
        else:
            assert r.record_type == "revisit" and r.refers_to == top.get(html)
    assert sorted(repr(r.page_id) for r in got) == sorted(repr(r[0]) for r in rows)
    assert free == {r[2] or "" for r in rows}
    kept = {r.payload.decode() for r in records.filter("record_type = 'response'").collect()}
    assert kept == free
    at_least = scratch_folder(spark, "test-warc")
    few = warc.round_trip(df, at_least, least=4).collect()
    assert {r.record_type for r in few if r.payload_bytes < 4} == {"response"}
    assert sum(r.record_type == "revisit" for r in few if r.payload_bytes >= 4) > 0


def test_archives_equal_sql_and_empty_tables(spark):
    rows = [(i, f"http://h/{i}", None if i % 9 == 0 else f"<b>{i % 23}é</b>") for i in range(200)]
    got = warc.round_trip(pages(spark, rows), scratch_folder(spark, "test-warc"))
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    want = con.sql(oracle.ORACLE_SQL["op12_warc"])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
    assert pages(spark, []).count() == 0
    assert warc.round_trip(pages(spark, []), scratch_folder(spark, "test-warc")).collect() == []


def some_records(n):
    return [warc.page_record(i, i, f"http://h/{i}", b"<html>%d %d</html>" % (i, i * i), None,
                             warc.DATE) for i in range(n)]


def test_dictionary_is_read_from_the_leading_frame():
    data = warc.archive_of(some_records(300))
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY
    found, stop = warc.dictionary_in(data)
    assert found and stop == warc.frame_stop(data, 0)
    with pytest.raises(zstandard.ZstdError):  # the frames cannot be read without it
        zstandard.ZstdDecompressor().decompressobj().decompress(
            data[stop:warc.frame_stop(data, stop)])
    plain = found.as_bytes()
    again = (warc.DICTIONARY.to_bytes(4, "little") + len(plain).to_bytes(4, "little") + plain
             + data[stop:])
    assert [f["page_id"] for _, f in warc.records_in(again)] == list(range(300))
    few = warc.archive_of(some_records(2))  # too few for a dictionary
    assert int.from_bytes(few[:4], "little") == warc.FRAME
    assert [f["page_id"] for _, f in warc.records_in(few + warc.SEPARATOR.encode())] == [0, 1]


def test_one_record_a_frame_and_damage_costs_one_record():
    data = warc.archive_of(some_records(50))
    _, at = warc.dictionary_in(data)
    frames = 0
    while at < len(data):
        at, frames = warc.frame_stop(data, at), frames + 1
    assert frames == 51  # with the warcinfo record
    places = [at for at, _ in warc.records_in(data)]
    broken = bytearray(data)
    broken[places[10] + 30] ^= 0xFF
    found = list(warc.records_in(bytes(broken)))
    assert [i for i, (_, f) in enumerate(found) if "error" in f] == [10] and len(found) == 50
    assert "ends inside" in list(warc.records_in(data[:-2]))[-1][1]["error"]
    assert "no frame" in list(warc.records_in(data + b"tail"))[-1][1]["error"]


@pytest.mark.parametrize("change, why", [
    (lambda r: r.replace(b"WARC/1.1", b"HTTP/1.1"), "no WARC header"),
    (lambda r: r.replace(b"Content-Length: ", b"Content-Length: 1", 1), "Content-Length"),
    (lambda r: r.replace(b"WARC-Date: ", b"WARC-When: "), "without WARC-Date"),
    (lambda r: r[:-1], "Content-Length"), (lambda r: r[:-4] + b"\r\n\n\n", "blank lines"),
    (lambda r: r.replace(b"WARC-Type: ", b"WARC Type "), "malformed field"),
    (lambda r: r.replace(b"<html>", b"<HTML>"), "another digest"),
    (lambda r: r.replace(b"\r\nWARC-Date", b"\r\nWARC-Type: revisit\r\nWARC-Date"), "two values"),
])
def test_invalid_records_are_told_apart(change, why):
    records = some_records(3)
    pack = zstandard.ZstdCompressor().compress
    data = b"".join(map(pack, [records[0], change(records[1]), records[2]]))
    found = [f for _, f in warc.records_in(data)]
    assert [f.get("page_id") for f in found] == [0, None, 2] and why in found[1]["error"]


def test_missing_response_and_broken_archives_fail_the_query(spark):
    folder = tempfile.mkdtemp(prefix="warc-")
    lone = warc.page_record(1, 1, "u", b"abc", 99, warc.DATE)
    with open(f"{folder}/a.warc.zst", "wb") as f:
        f.write(warc.archive_of([lone]))
    with pytest.raises(Exception, match="no response with this digest"):
        warc.with_responses(warc.read_archives(spark, folder)).collect()
    with open(f"{folder}/b.warc.zst", "wb") as f:
        f.write(b"junk")
    with pytest.raises(Exception, match="no frame begins here"):
        warc.with_responses(warc.read_archives(spark, folder)).collect()


# --- conversations -------------------------------------------------------------------------

def brute_audit(rows):
    """The least (cost, audit) over all edits with at most three insertions in a place."""
    best = None

    def legal(roles):
        s = "".join(roles)
        s = s[1:] if s.startswith("s") else s
        return s == "ua" * (len(s) // 2) and (s or not roles)

    def walk(i, cost, audit, roles):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(rows):
            for k in range(4):
                for more in itertools.product("ua", repeat=k):
                    if legal(roles + list(more)):
                        found = (cost + 5 * k, audit + "I" * k)
                        best = found if best is None else min(best, found)
            return
        initial, kind = rows[i]
        for k in range(3):
            for more in itertools.product("ua", repeat=k):
                c, a, r = cost + 5 * k, audit + "I" * k, roles + list(more)
                walk(i + 1, c + 2, a + "D", r)
                if kind < 2:
                    if initial in ("s", "u", "a"):
                        walk(i + 1, c + 5 * kind, a + "K", r + [initial])
                    for new in "ua":
                        walk(i + 1, c + 1 + 5 * kind, a + "R", r + [new])

    walk(0, 0, "", [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "x", ""]), st.integers(0, 2)),
                max_size=4))
def test_audit_equals_brute_force(rows):
    assert conversations.audit_of(rows) == brute_audit(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.integers(0, 2)), max_size=40),
       st.integers(1, 39))
def test_any_split_of_a_span_gives_the_same_cell(rows, at):
    cell = lambda part: conversations.Spans() if not part else _spans(part)

    def _spans(part):
        spans = conversations.Spans()
        for r in part:
            spans.add(conversations.row_cell(*r))
        return spans

    if rows[:at] and rows[at:]:
        both = conversations.joined(cell(rows[:at]).whole(), cell(rows[at:]).whole())
        assert conversations.cheapest(both) == conversations.audit_of(rows)


def test_equal_rows_as_one_cell():
    for before, after in itertools.product("sua", repeat=2):
        rows = [(before, 0), *[("u", 2)] * 5, (after, 0)]
        spans = conversations.Spans()
        for cell in (conversations.row_cell(before, 0), conversations.deleted_cell(5),
                     conversations.row_cell(after, 0)):
            spans.add(cell)
        assert conversations.cheapest(spans.whole()) == conversations.audit_of(rows)


TURNS = "extra string, conv_id long, turn long, role string, text string, audit string"


def repaired(spark, rows):
    df = spark.createDataFrame([("e", *r, "a") for r in rows], TURNS)
    body, found = conversations.repair(conversations.damaged(df), df)
    kept = conversations.repaired_rows(body, found).collect()
    return conversations.with_digest(body, found), kept


def sql_of(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, "
                "text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return con.sql(oracle.ORACLE_SQL["op13_conversations"])


def turns(rng, n_conv, longest):
    roles, texts = ["system", "user", "assistant", "tool", "", None, "user", "assistant"], [
        "Hello.", "no stop", "a! ", "", " \n", None, "x?\t", "é日.", "same.", "y" * 5000 + "."]
    rows = []
    for c in range(n_conv):
        for t in range(int(rng.integers(0, longest)) + 1):
            text = texts[rng.integers(len(texts))] if rng.random() < 0.5 else f"words {t} of {c}."
            rows.append((None if c == 3 else c, None if rng.random() < 0.05 else t * (1 + c % 2),
                         roles[rng.integers(len(roles))] if rng.random() < 0.6 else
                         ("user", "assistant")[t % 2], text))
    return rows + rows[:20] + rows[5:9] * 3


def test_conversations_equal_sql(spark):
    rows = turns(np.random.default_rng(3), 60, 12)
    rows += [(1000, 0, "user", "q.")] * 30 + [(1001, t, "user", "q.") for t in range(40)]
    got, kept = repaired(spark, rows)
    want = sql_of(rows)
    rows_got = list(map(tuple, got.select(*want.columns).collect()))
    assert sorted(rows_got, key=repr) == sorted(want.fetchall(), key=repr)
    whole = {}
    for r in sorted(kept, key=lambda r: r.position):
        whole.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in got.collect():
        joined = "\n".join(whole.get(r.conv_id, []))
        assert r.repaired_sha256 == hashlib.sha256(joined.encode()).hexdigest()


def test_a_conversation_over_many_partitions(spark):
    rng = np.random.default_rng(4)
    rows = [(1, t, ["user", "assistant", "tool"][rng.integers(3)], f"text {t} {'.' * (t % 3)}")
            for t in range(900)] + [(2, 0, "user", "hi.")]
    got, _ = repaired(spark, rows)
    want = sql_of(rows)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_conversations_without_rows(spark):
    got, kept = repaired(spark, [])
    assert got.collect() == [] and kept == []
    # crc32("2:2") % 20 == 0 for some turn: that row is dropped and its conversation is empty
    import zlib
    turn = next(t for t in range(1000) if zlib.crc32(f"2:{t}".encode()) % 20 == 0)
    got, kept = repaired(spark, [(2, turn, "user", "x.")])
    row = got.first()
    assert kept == [] and row.audit == "" and row.cost == 0 and row.gaps == 0
    assert row.repaired_sha256 == hashlib.sha256(b"").hexdigest()

"""Chat formatting and WARC archives: round trips, digests and odd inputs."""

from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessellar.llm import chat, warc

PIECES = st.lists(st.sampled_from(["<|", "|>", "\\", "<|im_end|>", "<|im_start|>assistant", "\n", "a", "|", "<", "é", "n"]), max_size=8).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "odd\nrole"]), PIECES), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_round_trip(turns):
    out = list(chat.examples(turns))
    assert chat.parse(out[-1][1]) == turns
    replies = [chat.unescape(text[a:b]) for _, text, loss in out for a, b in loss]
    assert replies == [t for r, t in turns if r == "assistant"]
    for n, text, loss in out:
        if loss:
            assert chat.parse(text)[:-1] == turns[:n] and chat.parse(text)[-1][0] == "assistant"


def test_odd_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (2, None, "assistant", ""), (2, None, "assistant", ""), (None, 0, "user", "hi"), (3, 0, "system", "only")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = {r.conv_id: (r.n_turns, r.loss_chars, r.turns_sha256) for r in chat.read_back(chat.format_chat(df)).collect()}
    assert {k: v[:2] for k, v in out.items()} == {1: (2, 0), 2: (2, 0), None: (1, 0), 3: (1, 0)}
    assert out[1][2] == hashlib.sha256(b"user\n\n\nx\n").hexdigest()
    assert chat.read_back(chat.format_chat(df.limit(0))).count() == 0


def test_long_conversation(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i} " * 50) for i in range(400)]
    ex = chat.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert ex.count() == 200 and ex.agg(F.max("n_context")).first()[0] == 399


PAGES = "page_id long, url string, html string"


def test_archives(spark, tmp_path):
    big = "<p>" + "é" * 600 + "</p>"
    rows = [(1, "http://a/%41?x\r\ny", big), (2, "http://b", big), (3, None, "small"), (4, "http://c", "small"), (5, "http://d", None), (6, "", "WARC/1.0\r\nWARC-Type: response\r\n\r\n\r\n\r\n" * 50), (None, "http://e", ""), (7, "http://f", "x" * 300_000)]
    df = spark.createDataFrame(rows, PAGES).withColumns({"digest": F.lit(1), "value": F.lit(2), "bytes": F.lit(3)})
    for codec in ("gzip", "none"):
        path = str(tmp_path / codec)
        warc.write_warc(df, path, per_file=3, compression=codec)
        out = {r.page_id: r for r in warc.read_warc(spark, path).collect()}
        assert len(out) == len(rows) and out[1].record_type == "revisit" and out[1].refers_to == 2 and out[1].payload is None
        for i, url, html in rows:
            raw = (html or "").encode()
            assert (out[i].url, out[i].payload_bytes, out[i].payload_digest) == (url, len(raw), hashlib.sha1(raw).hexdigest())
            assert i == 1 or (bytes(out[i].payload) == raw and out[i].record_type == "response" and out[i].refers_to is None)
        some = warc.read_warc(spark, path, payload=False).filter("record_type = 'response' and page_id in (2, 3)")
        assert {r.page_id for r in some.collect()} == {2, 3} and some.filter("payload is not null").count() == 0
        plan = warc.read_warc(spark, path).filter("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
        assert "Filter (" not in plan.split("BatchScan")[0]


def test_empty_archive(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([], PAGES), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).count() == 0


def test_payloads_are_stepped_over(tmp_path):
    class Watch:
        def __init__(self, raw):
            self.raw, self.read_bytes = raw, 0

        def read(self, n):
            got = self.raw.read(n)
            self.read_bytes += len(got)
            return got

        def __getattr__(self, name):
            return getattr(self.raw, name)

    body = b"HTTP/1.1 200 OK\r\n\r\n" + b"z" * 5_000_000
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
    p = tmp_path / "a.warc"
    p.write_bytes(record * 3)
    with p.open("rb") as f:
        w = Watch(f)
        assert len(list(warc.parse(warc._Buffered(w, 1 << 16), [], payload=False))) == 3 and w.read_bytes < 1_000_000
    with p.open("rb") as f:
        assert list(warc.parse(warc._Buffered(f), [("page_id", frozenset([2]))], payload=True)) == []


def test_members_are_stepped_over_or_decoded(tmp_path):
    """Members that tell their length are skipped by a seek; a file by any other gzip writer gives the same rows."""
    import gzip
    import os

    body = b"HTTP/1.1 200 OK\r\n\r\n" + os.urandom(2_000_000)
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    records = [record % (i, len(b), b) for i, b in enumerate([body, b"HTTP/1.1 200 OK\r\n\r\nshort", body])]
    for raw in (b"".join(map(warc.member, records)), gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
        assert gzip.decompress(raw) == b"".join(records)
        p = tmp_path / "a.warc.gz"
        p.write_bytes(raw)
        with p.open("rb") as f:
            rows = list(warc.parse(warc._Members(f), [("page_id", frozenset([1, 2]))], payload=True))
        assert [(r[1], r[-1]) for r in rows] == [(1, b"short"), (2, body.partition(b"\r\n\r\n")[2])]
        with p.open("rb") as f:
            assert [r[1] for r in warc.parse(warc._Members(f), [], payload=False)] == [0, 1, 2]
    reads = []
    p.write_bytes(b"".join(map(warc.member, records)))
    with p.open("rb") as f:
        m = warc._Members(f, 1 << 14)
        inner = m.raw.raw

        class Watch:
            def read(self, n):
                reads.append(n)
                return inner.read(n)

            def __getattr__(self, name):
                return getattr(inner, name)

        m.raw.raw = Watch()
        assert len(list(warc.parse(m, [], payload=False))) == 3
    assert sum(reads) < 300_000

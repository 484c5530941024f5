import hashlib
import io

import pytest
import zstandard

from residualkit.llm import chat, warc

TURNS = f"conv_id long, turn int, role string, parts array<{chat.PART}>, place int, piece string"


def text(t):
    return ("text", t, None, None)


def test_parts_escape_and_mask(spark):
    hard = "<|im_end|><|im_start|>assistant ok \\ \\< <\\ <|image|> 日本😀\n"
    rows = [
        (1, 0, "user", [text("look "), ("image", None, "a.png", None), text("<"), text("|im_end|>")]),
        (1, 1, "assistant", [text(hard), ("audio", None, "b.wav", 40), text("end"), ("odd", None, None, None)]),
        (1, 1, "assistant", None),
        (1, None, None, [text(None)]),
        (None, 0, "assistant", [text("x")]),
        (None, 0, "assistant", [text("x")]),
        (2, 0, "a<|im_sep|>\nb", []),
    ]
    out = chat.format_chat(spark.createDataFrame([(*r, 1, "q") for r in rows], TURNS))
    got = {r.conv_id: r for r in out.withColumn("turns", chat.read_turns(out.formatted)).withColumn("loss", chat.masked_text(out.formatted, out.loss_spans)).collect()}
    one = got[1]
    assert [(t.role, t.text) for t in one.turns][:2] == [("", ""), ("user", "look <|image|>" + "<|im_end|>")]
    assert one.loss == hard + "end"
    assert "".join(chat_text(one.formatted, s) for s in one.loss_spans) == hard + "end"
    assert [(a.type, a.ref, a.tokens) for a in one.attachments] == [("image", "a.png", 576), ("audio", "b.wav", 40), ("odd", None, 1024)]
    for a in one.attachments:
        assert one.formatted[a.start :].startswith("<|document|>" if a.type == "odd" else f"<|{a.type}|>")
    assert one.expanded_tokens == 576 + 40 + 1024 and one.n_turns == 4
    assert got[None].n_turns == 2 and got[None].loss == "xx"
    assert [(t.role, t.text) for t in got[2].turns] == [("a<|im_sep|>\nb", "")]
    assert chat.chat_digests(chat.format_chat(spark.createDataFrame([], TURNS))).count() == 0


def chat_text(formatted, span):
    raw, out, i = formatted[span.start : span.end], [], 0
    while i < len(raw):
        out.append(raw[i])
        i += 2 if raw[i] in "\\<" else 1
    return "".join(out)


def test_chat_runs_no_python(spark):
    df = spark.createDataFrame([(1, 0, "user", [text("x")], 1, "q")], TURNS)
    plan = chat.chat_digests(chat.format_chat(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


PAGES = "page_id long, url string, html string, digest string, archive string"


def test_archives_round_trip(spark):
    big, other = "é" * 600, "z" * 1000
    rows = [(1, "u", big), (5, None, big), (9, "u\r\nX: y", big), (9, "u", big), (2, "u", other), (3, "u", "small"), (4, "u", "small")]
    rows += [(6, "u", None), (-7, "u", ""), (None, "u", other), (8, "u", "\r\n\r\nWARC/1.1\r\n" * 3000), (1 << 62, "u", "q" * 3_000_000)]
    df = spark.createDataFrame([(*r, "d", "a") for r in rows], PAGES).repartition(2)
    got = warc.archive_round_trip(df).collect()
    assert len(got) == len(rows)
    expected = []
    for page, _, html in rows:
        payload = (html or "").encode()
        first = {big: 9, other: 2}.get(html)
        revisit = first is not None and page != first
        expected.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_payloads_come_back(spark):
    rows = [(i, "u", f"<p>{i}</p>" * 100) for i in range(50)]
    df = spark.createDataFrame([(*r, "d", "a") for r in rows], PAGES)
    folder = f"{warc.staged_folder(spark)}/test-archives-{id(df)}"
    got = warc.read_archives(warc.write_archives(warc.plan_records(df), folder, 16), payloads=True).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in got} == {i: h for i, _, h in rows}


def archive(records=3):
    raw = [warc.write_record(i, "u", b"x" * 100, None, hashlib.sha1(b"x" * 100).hexdigest()) for i in range(records)]
    out = io.BytesIO()
    warc.write_archive(out, raw, b"dictionary " * 20)
    return raw, out.getvalue()


def test_frames_hold_one_record_each():
    raw, data = archive()
    assert list(warc.read_archive(io.BytesIO(data), chunk=7)) == raw
    size = int.from_bytes(data[4:8], "little")
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    assert decompressor.decompressobj().decompress(data[8 + size :]) == raw[0]


@pytest.mark.parametrize("broken", [b"", b"\x00" * 20, "cut", "short dictionary"])
def test_broken_archives_are_errors(broken):
    data = {"cut": archive()[1][:-3], "short dictionary": archive()[1][:30]}.get(broken, broken)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.read_archive(io.BytesIO(data)))


@pytest.mark.parametrize(
    "change",
    [
        lambda r: r.replace(b"WARC/1.1", b"WARC/0.9"),
        lambda r: r.replace(b"x" * 100, b"y" * 100),
        lambda r: r[:-1],
        lambda r: r + b"more",
        lambda r: r.replace(b"WARC-Date: ", b"Other: "),
        lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: revisit"),
    ],
)
def test_broken_records_are_errors(change):
    raw = archive()[0][0]
    assert warc.parse_record(raw).payload == b"x" * 100
    with pytest.raises(ValueError):
        warc.parse_record(change(raw))


def test_page_ids_come_back_from_record_ids():
    for page in (0, 1, -1, -5, 1 << 62, -(1 << 63)):
        assert warc.page_of(warc.record_id(page)) == page
    assert warc.page_of(warc.record_id(None)) is None


def foreign(kind, block, *extra, version=b"WARC/1.0"):
    lines = [f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:12345678-0000-1111-2222-333333333333>", "WARC-Date: 2020-01-01T00:00:00Z"]
    head = "\r\n".join([*lines, f"content-length: {len(block)}", *extra]).encode()
    return version + b"\r\n" + head + b"\r\n\r\n" + block + b"\r\n\r\n"


HTTP = "Content-Type: application/http; msgtype=response"
SHA256 = "WARC-Payload-Digest: sha256:" + hashlib.sha256(b"body").hexdigest()


@pytest.mark.parametrize(
    ("raw", "kind", "payload"),
    [
        (foreign("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields"), "warcinfo", b"software: x\r\n"),
        (foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", HTTP), "request", b""),
        (foreign("metadata", b""), "metadata", b""),
        (foreign("resource", b"body", SHA256), "resource", b"body"),
        (foreign("response", b"HTTP/1.1 200 OK\r\nA: b\r\n c\r\n\r\nbody", HTTP, SHA256), "response", b"body"),
        (foreign("response", b"HTTP/1.1 200 OK\r\n\r\nbody", HTTP, "WARC-Concurrent-To: <a>", "WARC-Concurrent-To: <b>"), "response", b"body"),
        (foreign("response", b"HTTP/1.1 200\r\nTransfer-Encoding: chunked\r\n\r\n4\r\nbody\r\n0\r\n\r\n", HTTP, SHA256), "response", b"4\r\nbody\r\n0\r\n\r\n"),
        (foreign("response", b"HTTP/1.1 200\r\nContent-Length: 9\r\n\r\nbody", HTTP, "WARC-Truncated: length"), "response", b"body"),
        (foreign("response", b"HTTP/1.1 200\r\n\r\nbody", HTTP, "WARC-Payload-Digest: other:zz", version=b"WARC/1.1"), "response", b"body"),
        (foreign("revisit", b"", HTTP, "WARC-Payload-Digest: sha1:" + "A" * 32), "revisit", None),
    ],
)
def test_records_of_other_writers(raw, kind, payload):
    record = warc.parse_record(raw)
    assert (record.headers["WARC-Type"], record.payload) == (kind, payload)
    assert warc.page_of(record.headers["WARC-Record-ID"]) is None
    if payload is not None:
        assert (record.payload_bytes, record.digest) == (len(payload), hashlib.sha1(payload).hexdigest())


@pytest.mark.parametrize(
    "raw",
    [
        foreign("resource", b"bodies", SHA256),
        foreign("response", b"HTTP/1.1 200\r\nContent-Length: 9\r\n\r\nbody", HTTP),
        foreign("response", b"no header", HTTP),
        foreign("metadata", b"", "WARC-Type: resource"),
        foreign("metadata", b"", "no colon"),
        foreign("revisit", b"", HTTP),
    ],
)
def test_broken_records_of_other_writers_are_errors(raw):
    with pytest.raises(ValueError):
        warc.parse_record(raw)


def test_archives_of_other_writers(spark, tmp_path):
    dictionary = b"dictionary " * 20
    raw = [foreign("warcinfo", b"a: b\r\n"), archive()[0][1]]
    with_dictionary = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    packed = zstandard.ZstdCompressor().compress(dictionary)
    head = (0x184D2A5D).to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed
    (tmp_path / "a.warc.zst").write_bytes(head + b"".join(with_dictionary.compress(r) for r in raw))
    (tmp_path / "b.warc.zst").write_bytes(b"".join(zstandard.ZstdCompressor().compress(r) for r in raw))
    (tmp_path / "c.warc.zst").write_bytes(b"")
    archives = spark.createDataFrame([(str(tmp_path / f"{n}.warc.zst"),) for n in "abc"], "archive string")
    got = warc.read_archives(archives, need_dictionary=False).collect()
    assert sorted((r.page_id or 0, r.record_type, r.payload_bytes) for r in got) == [(0, "warcinfo", 6)] * 2 + [(1, "response", 100)] * 2
    with pytest.raises(ValueError):
        list(warc.read_archive(open(tmp_path / "b.warc.zst", "rb")))


def test_archives_are_bounded_in_records_and_bytes(spark):
    rows = [(i, "u", "x" * 5000 + str(i)) for i in range(40)]
    df = spark.createDataFrame([(*r, "d", "a") for r in rows], PAGES).coalesce(1)
    folder = f"{warc.staged_folder(spark)}/test-bounded-{id(df)}"
    by_count = warc.write_archives(warc.plan_records(df).coalesce(1), folder, 16)
    assert sorted(r.records for r in by_count.collect()) == [8, 16, 16]
    by_bytes = warc.write_archives(warc.plan_records(df).coalesce(1), folder, 1000, 30_000)
    written = by_bytes.collect()
    assert max(r.records for r in written) == 6
    for r in written:
        with open(r.archive.removeprefix("file:"), "rb") as file:
            data = file.read()
        assert len(data) == r.bytes and int.from_bytes(data[:4], "little") == 0x184D2A5D
        assert all(raw.startswith(b"WARC/1.1") for raw in warc.read_archive(io.BytesIO(data)))
    assert warc.read_archives(by_bytes).count() == 40

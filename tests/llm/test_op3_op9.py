import base64
import hashlib
import io

import pytest

from recsieve.llm import chat_format, queries, warc


def expected_pages(rows):
    last = {}
    for number, _, html in rows:
        if number is not None:
            last[html or ""] = max(last.get(html or "", number), number)
    out = []
    for number, _, html in rows:
        block = (html or "").encode()
        first = last.get(html or "")
        revisit = first is not None and first != number
        out.append((number, len(block), base64.b32encode(hashlib.sha1(block).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_pages(spark, sf):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op3_warc(spark, sf).collect()), key=str) == expected_pages(rows)


def test_warc_edges(spark, tmp_path):
    rows = [(1, "http://a/ b\n?é", "x\r\n\r\nWARC/1.0\r\n"), (2, None, None), (3, "", ""), (4, "u", "é𝒳"), (9, "u", "é𝒳"), (9, "u", "é𝒳"), (None, "v", "é𝒳"), (None, "w", "only"), (None, "w", "only"), (7, "z", "\n" * 50_000), (8, "q", "last\r")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as number", "'d' as digest")
    warc.write_archives(df, f"{tmp_path}/w")
    got = warc.read_archives(spark, f"{tmp_path}/w")
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == expected_pages(rows)
    warc.write_archives(df.where("false"), f"{tmp_path}/e")
    assert warc.read_archives(spark, f"{tmp_path}/e").count() == 0


def test_arc_versions_and_lengths():
    blocks = [b"one\n", b"", b"http://x 0.0.0.0 20240101000000 text/html 3\nabc", "é".encode() * 9]
    for version in (1, 2):
        data = warc.write_arc(version, [(f"http://h/{i}", "20240102030405", "text/html", b) for i, b in enumerate(blocks)])
        found = list(warc.read_arc(data))
        assert [(r.version, r.url, r.date, r.block) for r in found] == [(version, f"http://h/{i}", "20240102030405", b) for i, b in enumerate(blocks)]
        text = warc.to_warc(found[3], 5, None)
        (head, block), = warc.read_warc(io.BytesIO(text.encode()))
        assert block == blocks[3] and head["WARC-Date"] == "2024-01-02T03:04:05Z" and head["WARC-Record-ID"].startswith("<urn:uuid:")
        assert warc.to_warc(found[3], 5, None) == warc.to_warc(found[3], 5, None)
    with pytest.raises(ValueError):
        list(warc.read_arc(data[:-12]))
    with pytest.raises(ValueError):
        list(warc.read_arc(data.replace(b"2 0 rec", b"3 0 rec")))


def test_archives_are_bounded_and_refer(spark, tmp_path):
    """Files of some bytes, a member per record, a warcinfo first, revisits that name their response; a record over 16 MB too."""
    import gzip
    import random
    import zlib
    from pathlib import Path

    rng = random.Random(1)
    noise = lambda n: "".join(chr(rng.randrange(33, 1000)) for _ in range(n))
    rows = [(i, f"http://h/{i}", noise(20_000)) for i in range(60)] + [(100 + i, f"http://c/{i}", "copy") for i in range(30)] + [(200, "http://big", "0123456789abcdef" * 1_200_000)]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_path}/w", archive_bytes=100_000)
    files = sorted(Path(f"{tmp_path}/w").rglob("part-*"))
    assert len(files) > 10 and max(f.stat().st_size for f in files) < 250_000
    ids, refers, n = {}, [], 0
    for f in files:
        data, members = f.read_bytes(), 0
        records = list(warc.read_warc(io.BytesIO(gzip.decompress(data))))
        while data:
            d = zlib.decompressobj(31)
            members += bool(d.decompress(data))
            data = d.unused_data
        assert members == len(records) and [h["WARC-Type"] == "warcinfo" for h, _ in records] == [True] + [False] * (len(records) - 1)
        assert b"arc-version: " in records[0][1]
        for h, _ in records[1:]:
            n += 1
            assert h["WARC-Record-ID"] not in ids
            ids[h["WARC-Record-ID"]] = h
            refers += [h] if "WARC-Refers-To" in h else []
    assert n == len(rows) and len(refers) == 29
    for h in refers:
        to = ids[h["WARC-Refers-To"]]
        assert to["WARC-Type"] == "response" and to["X-Page-ID"] == "129" and to["WARC-Target-URI"] == h["WARC-Refers-To-Target-URI"] == "http://c/29"
    got = warc.read_archives(spark, f"{tmp_path}/w")
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == expected_pages(rows)


def expected_chats(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = []
    for c, turns in convs.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        chars = sum(sum(map(len, chat_format.turn_parts(r, x))) for _, _, r, x in turns)
        out.append((c, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
    return sorted(out, key=str)


def test_conversations(spark):
    sf = "/root/testdata/sf0.01"
    odd = r"\### Assistant: </turn> ok"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()] + [(-7, 0, "user", odd), (-7, 1, "assistant", odd)]
    assert sorted((tuple(r) for r in queries.op9_chat_format(spark, sf).collect()), key=str) == expected_chats(rows)


ODD = ["\\", "#", "###", "####", "\\###", "</turn>", "</turn>\n### user: x", "</turn", "a\nb", "", "é𝒳", "\\\\</turn>", ": ", "### assistant: ", "\\:"]


def test_chat_edges(spark):
    rows = [(i, t, r, x) for i in range(40) for t, (r, x) in enumerate([("user", "same start"), ("assistant", ODD[i % len(ODD)]), ("user: x\\", ODD[(i * 7) % len(ODD)]), ("assistant", "end" * i)])]
    rows += [(100, None, None, None), (100, 1, "assistant", "x"), (100, 1, "assistant", "x"), (None, 0, "user", "no id"), (101, 0, "assistant", "only"), (102, 0, "system", "z" * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as root", "2 as part")
    for pack in (128, 5):
        packs = chat_format.pack_conversations(df, pack)
        got = chat_format.unpack(packs)
        want = {r[0]: r for r in expected_chats(rows)}
        for r in got.collect():
            assert hashlib.sha256("".join(f"{t.role}\n{t.text}\n" for t in r.turns).encode()).hexdigest() == want[r.conv_id][2]
            assert (len(r.turns), len(r.loss_text), len(r.formatted)) == (want[r.conv_id][1], want[r.conv_id][3], want[r.conv_id][5])
        assert got.count() == len(want)
    assert chat_format.unpack(chat_format.pack_conversations(df.where("false"))).count() == 0


def test_tree_has_shared_turns_once():
    pack = chat_format.build([(i, [("user", "shared"), ("assistant", "both"), ("user", f"own {i}")]) for i in range(3)])
    assert pack["text"].count("shared") == 1 and len(pack["nodes"]) == 5
    for c in pack["conversations"]:
        leaf = pack["nodes"][c["leaf"]]
        assert leaf["attends"] == [{"start": 0, "end": pack["nodes"][1]["end"]}]
        assert leaf["position"] == pack["nodes"][1]["end"]
    assert [n["start"] for n in pack["nodes"]] == sorted(n["start"] for n in pack["nodes"])


def test_each_prefix_has_one_node(spark):
    """Over 128 conversations with one first turn: every turn that some share comes once, hot ones too."""
    def said(i):
        return [("system", "pr:om###pt"), ("user", f"second {i // 3}"), ("assistant", f"third {i // 3}"), ("user", f"own {i}")]

    chats = {i: said(i) for i in range(600)}
    chats |= {1000 + i: [("system", "pr:om###pt"), ("assistant", "com</turn>mon"), ("assistant", f"answer {i // 2}"), ("user", f"own {i}")] for i in range(300)}  # a hot second turn
    chats |= {2000 + i: [("system", "pr:om###pt"), ("user", "equal")] for i in range(300)}  # equal whole conversations
    chats |= {3000 + i: [("a:b\\\\", "ten"), ("user", f"branch {i % 10}"), ("assistant", f"leaf {i}")] for i in range(1000)}
    rows = [(c, t, r, x) for c, turns in chats.items() for t, (r, x) in enumerate(turns)]
    packs = chat_format.pack_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = packs.collect()
    size = lambda r, x: sum(map(len, chat_format.turn_parts(r, x)))
    nodes = {tuple(turns[: d + 1]) for turns in chats.values() for d in range(len(turns))}
    assert sum(len(p.nodes) for p in found) == len(nodes)
    assert sum(len(p.text) for p in found) == sum(size(*n[-1]) for n in nodes)
    assert sorted(c.conv_id for p in found for c in p.conversations) == sorted(chats)
    assert sum(not p.conversations for p in found) == 4 and max(len(p.conversations) for p in found) <= 300
    by_name = {p["pack"]: p for p in found}
    for p in found:
        offset = sum(len(by_name[x].text) for x in p.path)
        for n in p.nodes:
            assert n.position == offset + sum(x.end - x.start for x in n.attends)
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat_format.unpack(packs).collect()} == chats
    assert {r.conv_id: r.loss_text for r in chat_format.unpack(packs).collect()} == {c: "".join(x for r, x in turns if r == "assistant") for c, turns in chats.items()}


def test_a_conversation_of_many_turns(spark):
    """10,000 turns, and one that leaves it after 5,000: read back whole, the shared turns once."""
    said = lambda n: [("assistant" if i % 2 else "user", f"turn {i}") for i in range(n)]
    chats = {1: said(10_000), 2: [*said(5_000), ("user", "other"), ("assistant", "end")], 3: said(128), 4: said(129)}
    rows = [(c, t, r, x) for c, turns in chats.items() for t, (r, x) in enumerate(turns)]
    packs = chat_format.pack_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).cache()
    assert packs.agg({"text": "count"}).first()[0] == 1 and packs.selectExpr("size(nodes) as n").first().n == 10_002
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat_format.unpack(packs).collect()} == chats
    packs.unpersist()

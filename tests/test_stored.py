import pytest
from pyspark.sql import functions as F

from recsieve.sources.stored import StoredTable
from recsieve.streaming import streams


def files(path):
    return {str(p): p.read_bytes() for p in (path / "rows").rglob("part-*.parquet")}


def rows(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def frame(spark, data, schema="k string, a long, b string"):
    return spark.createDataFrame(data, schema)


def test_only_partitions_that_change_are_written(spark, tmp_path):
    t = StoredTable(spark, str(tmp_path), ("k",), 8)
    with pytest.raises(FileNotFoundError):
        t.read()
    assert len(t.upsert(frame(spark, [(f"k{i}", i, "old") for i in range(200)]))) == 8
    before = files(tmp_path)
    changed = t.upsert(frame(spark, [("k7", 70, "new"), ("k7", 69, "lost"), ("fresh", 1, None)]), F.col("a"))
    want = [(f"k{i}", i, "old") for i in range(200) if i != 7] + [("k7", 70, "new"), ("fresh", 1, None)]
    assert 1 <= len(changed) <= 2 and rows(t) == sorted(want, key=str)
    after = files(tmp_path)
    assert before.items() <= after.items() and len(after) - len(before) == len(changed)
    assert t.version() == 1 and t.upsert(frame(spark, [("k7", 70, "new"), ("fresh", 1, None)])) == [] and t.version() == 1 and files(tmp_path) == after
    assert t.upsert(frame(spark, [])) == [] and t.version() == 1
    assert sorted(tuple(r) for r in t.read(0).collect()) == sorted((f"k{i}", i, "old") for i in range(200))


def test_columns_null_keys_and_inserts_only(spark, tmp_path):
    t = StoredTable(spark, str(tmp_path), ("k", "n"), 3)
    t.upsert(frame(spark, [("a", None, 1, "x"), (None, 2, 2, "y"), (None, None, 3, "z")], "k string, n long, v long, w string"))
    t.upsert(frame(spark, [(None, None, "Z", True), ("b", 1, "B", None)], "k string, n long, w string, extra boolean"))
    assert rows(t) == sorted([("a", None, 1, "x", None), (None, 2, 2, "y", None), (None, None, 3, "Z", True), ("b", 1, None, "B", None)], key=str)
    assert t.upsert(frame(spark, [("a", None, "no", False), ("c", 1, "C", None)], "k string, n long, w string, extra boolean"), insert_only=True)
    assert ("a", None, 1, "x", None) in rows(t) and ("c", 1, None, "C", None) in rows(t)


def test_deleted_rows(spark, tmp_path):
    t = StoredTable(spark, str(tmp_path), ("k",), 2)
    t.upsert(frame(spark, [("a", 1, "x"), ("b", 2, "y")]))
    odd = frame(spark, [("a", 9, None, True), ("c", 3, "z", True), ("d", 4, "w", None)], "k string, a long, b string, out boolean")
    assert t.upsert(odd, gone="out") and rows(t) == [("b", 2, "y"), ("d", 4, "w")] and t.read().columns == ["k", "a", "b"]
    assert t.upsert(odd, gone="out") == []
    t.upsert(frame(spark, [("b", 0, "", True), ("d", 0, "", True)], "k string, a long, b string, out boolean"), gone="out")
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.upsert(frame(spark, [("e", 1, None)])) and rows(t) == [("e", 1, None)]


def test_written_pages_are_checked_and_written_back(spark, tmp_path):
    from recsieve.operators import qa

    data = [(i, "[Archived] x" if i == 2 else "x", "SIGNAL PACK", "s", "k", "r", f"text {i} mcp_unavailable" if i == 3 else f"text {i}") for i in range(6)]
    t = StoredTable(spark, str(tmp_path / "pages"), ("page_id",), 4)
    t.upsert(spark.createDataFrame(data, "page_id long, entry string, type string, source_skill string, report_key string, run_id string, content string"))
    got = {r.page_id: r.qa_status for r in qa.audit_written(t, spark.createDataFrame([(2,), (3,), (3,), (99,)], "page_id long"), F.lit("2026-01-01").cast("timestamp")).collect()}
    want = {r.page_id: r.qa_status for r in qa.validate_pages(t.read()).collect()}
    assert got == {2: None, 3: want[3]} and want[2] == "SKIP"
    after = {r.page_id: (r.content, r.qa_status) for r in t.read().collect()}
    assert after == {i: (data[i][6], got[3] if i == 3 else None) for i in range(6)}  # an archived page keeps what it had


def test_command_line_changes_only_what_it_was_given(spark, tmp_path):
    from recsieve import cli
    from recsieve.sources import tables as T

    p, b = StoredTable(spark, str(tmp_path / "pages"), ("page_id",), 4), StoredTable(spark, str(tmp_path / "blocks"), ("page_id", "pos"), 4)
    p.upsert(T.pages(spark, "/root/testdata/sf0.001").limit(40))
    b.upsert(T.blocks(spark, "/root/testdata/sf0.001"))
    one = p.read().where("not contains(entry, '[Archived]')").agg(F.min("page_id")).first()[0]
    page = b.read().where("text = 'mcp_unavailable'").first().page_id
    before = {r.page_id: r.content for r in p.read().collect()}
    blocks = {(r.page_id, r.pos): r.text for r in b.read().collect()}
    assert cli.main(["validate", p.path, "--stored", "--page-id", str(one)], spark) == 0
    assert cli.main(["clean", b.path, "--stored", "--page-id", str(page), "--dry-run"], spark) == 0 and b.version() == 0
    assert cli.main(["clean", b.path, "--stored", "--page-id", str(page)], spark) == 0 and b.version() == 1
    after = p.read().collect()
    assert {r.page_id: r.content for r in after} == before and [r.page_id for r in after if r.last_audited_at is not None] == [one]
    left = {(r.page_id, r.pos): r.text for r in b.read().collect()}
    assert {k: v for k, v in left.items() if k[0] != page} == {k: v for k, v in blocks.items() if k[0] != page}
    assert 0 < sum(k[0] == page for k in left) < sum(k[0] == page for k in blocks)
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        cli.main(["validate", p.path, "--stored", "--page-id", str(one), "--out", str(tmp_path / "pages")], spark)


def test_a_batch_counts_once_and_a_dead_writer_leaves_no_trace(spark, tmp_path, monkeypatch):
    clean, t = StoredTable(spark, str(tmp_path / "clean"), ("k",), 4), StoredTable(spark, str(tmp_path / "t"), ("k",), 4)
    first, second = frame(spark, [("a", 1, "x"), ("b", 2, "y")]), frame(spark, [("b", 3, "z"), ("c", 4, "w")])
    for batch, data in enumerate((first, second)):
        clean.upsert(data, batch=str(batch))
    t.upsert(first, batch="0")
    monkeypatch.setattr(StoredTable, "_add_version", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        t.upsert(second, batch="1")
    monkeypatch.undo()
    assert rows(t) == [("a", 1, "x"), ("b", 2, "y")]
    assert t.upsert(second, batch="1") and not t.upsert(second.withColumn("a", F.lit(9).cast("long")), batch="1")
    assert rows(t) == rows(clean) and t.version() == 1
    monkeypatch.setattr(StoredTable, "version", lambda self: 0)  # as a writer that read before another one wrote
    with pytest.raises(RuntimeError, match="another writer"):
        t.upsert(frame(spark, [("d", 1, None)]))
    monkeypatch.undo()
    assert rows(t) == rows(clean)


def test_stream_into_a_stored_table(spark, tmp_path, monkeypatch):
    """Two runs, the first killed after the table took its batch and before the stream's checkpoint did."""
    t = StoredTable(spark, str(tmp_path / "t"), ("k",), 4)
    frame(spark, [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")]).write.parquet(str(tmp_path / "in"))
    source = lambda: spark.readStream.schema("k string, a long, b string").parquet(str(tmp_path / "in"))
    start = lambda: streams.upsert_batches(source(), t, str(tmp_path / "check"), "pages", F.col("a"))
    real, versions = StoredTable.upsert, []

    def dies(self, *a, **k):
        real(self, *a, **k)
        raise RuntimeError("killed")

    monkeypatch.setattr(StoredTable, "upsert", dies)
    with pytest.raises(Exception, match="killed"):
        start().awaitTermination()
    monkeypatch.undo()
    versions.append(t.version())
    start().awaitTermination()
    assert rows(t) == [("a", 2, "y"), ("b", 1, "z")] and [*versions, t.version()] == [0, 0]
    frame(spark, [("a", 0, "late"), ("c", 5, None)]).write.mode("append").parquet(str(tmp_path / "in"))
    start().awaitTermination()
    assert rows(t) == [("a", 0, "late"), ("b", 1, "z"), ("c", 5, None)] and t.version() == 1

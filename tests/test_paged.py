from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq

from recsieve.sources.paged import PagedReader, ParquetPages, read_paged

SCHEMA = "id long, day timestamp_ntz, kind string"


def written(tmp_path):
    rows = [(i, datetime(2026, 1, 1 + i // 50), None if i % 9 == 0 else "ab"[i % 2]) for i in range(1000)]
    table = pa.table({"id": [r[0] for r in rows], "day": pa.array([r[1] for r in rows], pa.timestamp("us")), "kind": [r[2] for r in rows]})
    pq.write_table(table, str(tmp_path / "x.parquet"), row_group_size=100)
    return rows, {"path": str(tmp_path / "x.parquet"), "columns": ["id", "day", "kind"]}


def test_pages_and_pushed_filters(spark, tmp_path):
    rows, args = written(tmp_path)
    df = read_paged(spark, "recsieve.sources.paged:ParquetPages", SCHEMA, 7, **args)
    assert sorted(map(tuple, df.collect())) == sorted(rows) and df.rdd.getNumPartitions() == 10
    some = df.where("id >= 430 and day < timestamp_ntz'2026-01-12' and kind = 'a' and id % 3 = 0").select("id")
    assert sorted(r.id for r in some.collect()) == [r[0] for r in rows if r[0] >= 430 and r[1] < datetime(2026, 1, 12) and r[2] == "a" and r[0] % 3 == 0]
    plan = some._jdf.queryExecution().executedPlan().toString()
    # what the source took is no filter of Spark's any more; of ten row groups two are read
    assert "430" not in plan and "2026-01-12" not in plan and "% 3" in plan and some.rdd.getNumPartitions() == 2
    assert df.where("kind is null").count() == sum(r[2] is None for r in rows) and df.where("id < 0").count() == 0


def test_only_matching_rows_are_fetched(tmp_path):
    from pyspark.sql import datasource as D
    from pyspark.sql.types import StructType

    rows, args = written(tmp_path)
    fetched = []

    class Counting(ParquetPages):
        def page(self, *a):
            out = super().page(*a)
            fetched.append(len(out[0]))
            return out

    import json

    reader = PagedReader(StructType.fromDDL(SCHEMA), {"client": "recsieve.sources.paged:ParquetPages", "args": json.dumps(args), "page_size": "20"})
    reader.made = Counting
    left = list(reader.pushFilters([D.GreaterThan(("id",), 849), D.EqualTo(("kind",), "b"), D.IsNull(("kind",))]))
    assert left == [D.IsNull(("kind",))] and [p.value for p in reader.partitions()] == [8, 9]
    got = [r for p in reader.partitions() for r in reader.read(p)]
    want = [r for r in rows if r[0] > 849 and r[2] == "b"]
    assert got == want and sum(fetched) == len(want) and max(fetched) <= 20

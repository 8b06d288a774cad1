from __future__ import annotations

from raw import raw
from subledger.plans import staging
from subledger.streaming import first_deliveries, read_deliveries, read_orders, write_orders


def delivery(id, second, total=1.0, day=None):
    return {"id": id, "created_at": f"2024-01-{day or 1 + id % 5:02d}T10:00:{second:02d}-05:00", "total_price": total}


def stream(spark, settings, tmp_path, batches):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for batch in batches:
        raw(spark, "raw_shopify__orders", *batch).coalesce(1).write.mode("append").parquet(folder)
        write_orders(
            read_deliveries(spark, folder, 1), out, str(tmp_path / "checkpoint"), settings, available_now=True
        ).awaitTermination()
    return read_orders(spark, out), staging.shop_orders(spark.read.parquet(folder), settings), out


def same(a, b):
    return a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_retries_on_a_stream_equal_the_batch_table(spark, settings, tmp_path):
    batches = [[delivery(1, 0), delivery(2, 0), delivery(2, 5, 9.0)], [delivery(1, 7, 9.0), delivery(3, 0)], [delivery(3, 30, 9.0)]]
    streamed, batch, _ = stream(spark, settings, tmp_path, batches)
    assert same(streamed, batch)


def test_an_order_that_comes_weeks_late_is_kept(spark, settings, tmp_path):
    undated = {"id": 9, "created_at": None, "total_price": 2.0}
    batches = [[delivery(1, 0, day=20), delivery(2, 0, day=21)], [delivery(3, 0, day=2), delivery(4, 0, day=22), undated], [delivery(3, 9, day=2), undated]]
    streamed, batch, _ = stream(spark, settings, tmp_path, batches)
    assert sorted(r.order_id for r in streamed.collect()) == [1, 2, 3, 4, 9]
    assert same(streamed, batch)


def test_a_repeated_batch_replaces_itself(spark, settings, tmp_path):
    streamed, batch, out = stream(spark, settings, tmp_path, [[delivery(1, 0)], [delivery(2, 0), delivery(3, 0)]])
    again = raw(spark, "raw_shopify__orders", delivery(2, 0), delivery(3, 0))
    first_deliveries(out, settings)(again, 1)
    assert same(read_orders(spark, out), batch)


def test_what_lies_beyond_the_search_is_left_to_the_batch_dedup(spark, settings, tmp_path):
    streamed, batch, _ = stream(spark, settings, tmp_path, [[delivery(1, 0, day=1)], [delivery(1, 0, 5.0, day=9)]])
    assert streamed.count() == 2 and batch.count() == 1

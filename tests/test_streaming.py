import os

from orderlake import constants as K
from orderlake.sinks import TableStore
from orderlake.streaming import start_order_ingest


def test_stream_ingest_classifies_each_file_once(spark, tmp_root):
    src = tmp_root.replace("file:", "") + "/in"
    os.makedirs(src)
    header = "order_id,cust_id,order date,prod_id,quantity,status\n"
    with open(f"{src}/a.csv", "w") as f:
        f.write(header + "A-1,1,1/5/2020 0:00,2,3,PAID\nA-1,1,1/5/2020 0:00,2,3,PAID\n"
                         "A-21,,1/5/2020 0:00,2,3,PAID\n")
    with open(f"{src}/b.csv", "w") as f:
        f.write(header + "A-013,3,1/6/2020 0:00,4,0.1,PAID\nA-2,2,1/6/2020 0:00,5,1, Shipped\n")
    store = TableStore(spark, tmp_root + "/tables", prefix="strm_")
    q = start_order_ingest(spark, src, store, tmp_root + "/chk", max_files_per_trigger=1)
    q.awaitTermination(120)
    clean = store.read("bronze", "orders_stream")
    errs = store.read("error_tables", "err_orders_stream")
    assert sorted(r.order_id for r in clean.collect()) == ["A-1", "A-2"]
    assert sorted((r.order_id, r._error_code) for r in errs.collect()) == [
        ("A-013", K.INVALID_QTY), ("A-21", K.NULL_CUST_ID)]
    assert clean.select("_batch_id").distinct().count() == 2

"""The command line drives the same jobs and reports."""

import json

from pulse.__main__ import main
from pulse.operators import ingest

BASE = 1_705_276_800_000


def test_cli_dau_stream_then_reports(spark, scratch, capsys):
    topics, table, ckpt = scratch("cli_topics"), scratch("cli_dau"), scratch("cli_ckpt")
    orders_dir = scratch("cli_orders")
    lines = [(m, json.dumps({"type": "startup", "mid": m, "ts": BASE + i * 3_600_000}))
             for i, m in enumerate(["a", "b", "a"])]
    spark.createDataFrame(lines, "key string, value string").write.parquet(f"{topics}/topic=startup_log")
    assert main(["dau", "--topic", "startup_log", "--topic-path", topics, "--table", table,
                 "--checkpoint", ckpt, "--trigger", "available_now"]) == 0
    spark.createDataFrame([("1", "2024-01-15", "10", 2.5)],
                          "id string, create_date string, create_hour string, total_amount double") \
        .write.parquet(orders_dir)
    capsys.readouterr()
    assert main(["report", "total", "--dau", table, "--orders", orders_dir, "--date", "2024-01-15"]) == 0
    doc = json.loads(capsys.readouterr().out)
    assert [d["id"] for d in doc] == ["dau", "new_mid", "order_amount"]
    assert doc[0]["value"] == 2 and doc[2]["value"] == 2.5
    assert main(["report", "hour", "--dau", table, "--orders", orders_dir, "--date", "2024-01-15"]) == 0
    assert json.loads(capsys.readouterr().out) == {"yesterday": {}, "today": {"00": 1, "01": 1}}


def test_cli_cdc_with_quarantine_and_compact(spark, scratch, capsys):
    import os
    base, out, ck, bad = scratch("cli_cdc_topics"), scratch("cli_cdc_out"), scratch("cli_cdc_ck"), scratch("cli_cdc_bad")
    env = {"entry_type": "ROWDATA", "table": "order_info", "op": "INSERT",
           "rows": [[{"name": "id", "value": "7"}, {"name": "user_id", "value": "u"}]]}
    spark.createDataFrame([("1", json.dumps(env)), ("2", "{broken")], "key string, value string") \
        .write.parquet(f"{base}/topic=changes")
    assert main(["cdc", "--topic", "changes", "--topic-path", base, "--out", out, "--checkpoint", ck,
                 "--quarantine", bad, "--trigger", "available_now"]) == 0
    assert [r.value for r in spark.read.parquet(out).collect()] == ['{"id":"7","user_id":"u"}']
    assert [r.value for r in spark.read.parquet(bad).collect()] == ["{broken"]

    from pulse.streaming import jobs
    table = scratch("cli_compact")
    for bid in range(2):
        lines = spark.createDataFrame([(json.dumps({"type": "startup", "mid": f"m{bid}", "ts": BASE}),)], "value string")
        jobs.dau_batch(ingest.parse_startup(lines), bid, table)
    capsys.readouterr()
    assert main(["compact", "--table", table, "--day-col", "logDate", "--days", "2024-01-15"]) == 0
    assert "compacted 2 rows" in capsys.readouterr().out
    assert os.listdir(f"{table.replace('file:', '')}/logDate=2024-01-15") == ["batch=compact"]


def test_cli_report_detail(spark, capsys):
    assert main(["report", "detail", "--tables", "/root/testdata/sf0.001", "--start", "0", "--length", "10", "--order", "sku_price:desc",
                 "--order", "order_detail_id"]) == 0
    doc = json.loads(capsys.readouterr().out)
    rows = doc["data"]["detail"]
    prices = [r["sku_price"] for r in rows]
    assert len(rows) == 10 and prices == sorted(prices, reverse=True) and doc["data"]["total"] > 10

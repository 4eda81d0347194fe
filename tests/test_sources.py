"""Readers of the source dataset's single-document formats, on literal files."""

import datetime as dt
import json
import os

from tidemark.session import shared_dir
from tidemark.sources.metadata import scan_exchange_info, scan_index, scan_meta, scan_snapshot, scan_symbol_info


def _put(root, rel, text):
    path = os.path.join(root.replace("file:", "", 1), rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_exchange_info_document_keeps_order_and_nested_text(spark):
    root = shared_dir(spark, "t_exinfo")
    doc = {"symbols": [{"symbol": "A", "status": "TRADING", "filters": [{"filterType": "PRICE_FILTER", "tickSize": "0.1"}]},
                       {"symbol": "B", "permissions": ["SPOT"]}, {"symbol": "A", "status": "BREAK"}]}
    _put(root, "exchangeInfo.json", json.dumps(doc, indent=2))
    rows = scan_exchange_info(spark, root, layout="document").orderBy("pos").collect()
    assert [r.raw["symbol"] for r in rows] == ["A", "B", "A"]
    assert json.loads(rows[0].raw["filters"])[0]["tickSize"] == "0.1"
    assert json.loads(rows[1].raw["permissions"]) == ["SPOT"]


def test_index_object_file(spark):
    root = shared_dir(spark, "t_index")
    idx = {"BTCUSDT/BTCUSDT_1d.parquet": "2026-07-05 00:00:00", "ETHUSDT/ETHUSDT_1d.parquet": "garbage"}
    path = _put(root, "index.json", json.dumps(idx, indent=0, sort_keys=True))
    rows = scan_index(spark, path, layout="object").collect()
    assert [(r.path, r.last_ts) for r in rows] == [("BTCUSDT/BTCUSDT_1d.parquet", dt.datetime(2026, 7, 5))]
    bad = _put(root, "broken/index.json", "{not json")
    assert scan_index(spark, bad, layout="object").count() == 0


def test_snapshot_and_meta(spark):
    root = shared_dir(spark, "t_snap")
    path = _put(root, "symbols.json", json.dumps({"_fetched_at": 1783468800.5, "symbols": ["ZZ", "AA"]}))
    rows = scan_snapshot(spark, path, "committed", 2).orderBy("symbol").collect()
    assert [r.symbol for r in rows] == ["AA", "ZZ"]
    assert rows[0].fetched_at == dt.datetime(2026, 7, 8, 0, 0, 0, 500000)
    meta = _put(root, "meta.json", json.dumps({"BTCUSDT": {"listing_date": "2019-09"}, "ETHUSDT": {}}))
    got = {r.symbol: dict(r.info) for r in scan_meta(spark, meta).collect()}
    assert got == {"BTCUSDT": {"listing_date": "2019-09"}, "ETHUSDT": {}}


def test_symbol_info_bad_content_is_empty(spark):
    root = shared_dir(spark, "t_info")
    _put(root, "BTCUSDT/BTCUSDT_info.json", json.dumps({"symbol": "BTCUSDT", "sector": "L1"}))
    _put(root, "ETHUSDT/ETHUSDT_info.json", "[1, 2]")
    _put(root, "XRPUSDT/XRPUSDT_info.json", "{broken")
    got = {r.symbol: dict(r.info) for r in scan_symbol_info(spark, root).collect()}
    assert got == {"BTCUSDT": {"symbol": "BTCUSDT", "sector": "L1"}, "ETHUSDT": {}, "XRPUSDT": {}}

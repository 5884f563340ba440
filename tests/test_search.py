"""J1/J2 on hand-written rows: filters, screening, SKU list and key/value traps."""

import datetime as dt

from siftkit.config import SearchConfig
from siftkit.plans.search import search_clicks, search_views

CFG = SearchConfig(date_from=dt.date(2024, 1, 5), zone="Asia/Jakarta", accounts=("WEB", "APP"),
                   web_account="WEB")
VIEW_SCHEMA = """account_id string, device_type string, device string, session_id string, search_id string,
catalog_page_type string, client_member_id string, actual_search_internal_keyword string, page_number int,
page_url string, applied_filter string, all_category_click string, sort_by string, search_internal_keyword string,
browser string, sequence int, search_result_count int, search_internal_category_id string,
search_internal_category_name string, app_version string, datetime timestamp_ntz,
product_list array<struct<sku:string>>, extension_data array<struct<key:string,val:string>>"""

T0 = dt.datetime(2024, 1, 5, 3, 0)


def _row(sid="s1", qid="q1", kw="Shoe", acc="WEB", dev="MOBILE", ts=T0, count=3, skus=None, ext=None):
    return (acc, dev, "phone", sid, qid, "search", None, kw, 1, "/u", None, "false", "rel", kw, "chrome", 1,
            count, "C1", "n", "1.0", ts, skus, ext)


def _run(spark, rows, sessions=("s1", "s2"), members=(), stops=()):
    raw = spark.createDataFrame(rows, VIEW_SCHEMA)
    s = spark.createDataFrame([(x,) for x in sessions], "session_id string")
    m = spark.createDataFrame(list(members), "session_id string, client_status string")
    w = spark.createDataFrame([(x,) for x in stops], "stopword_keyword string")
    return search_views(raw, s, m, w, CFG).collect()


def test_row_filters_and_zone_bound(spark):
    rows = [
        _row(ts=dt.datetime(2024, 1, 4, 16, 59, 59)),          # 23:59:59 local on the 4th: out
        _row(ts=dt.datetime(2024, 1, 4, 17, 0, 0), qid="q2"),   # local midnight of the 5th: in
        _row(qid=None), _row(qid=""), _row(qid="undefined"),
        _row(count=0, qid="q3"), _row(count=None, qid="q4"),
        _row(acc="web", qid="q5"),                               # case-folded filter passes
        _row(acc="OTHER", qid="q6"),
    ]
    out = _run(spark, rows)
    assert sorted(r.search_id for r in out) == ["q2", "q5"]
    q5 = [r for r in out if r.search_id == "q5"][0]
    assert q5.business_channel == "web" and q5.app_version == "1.0"   # T5: rules are case-sensitive
    q2 = [r for r in out if r.search_id == "q2"][0]
    assert q2.business_channel == "MOBILE-WEB" and q2.app_version == "WEB"
    assert q2.datetime == dt.datetime(2024, 1, 5, 0, 0) and q2.date == dt.date(2024, 1, 5)


def test_sku_list_and_kv(spark):
    ext1 = [("algo", "x1"), ("algo_name", "x2"), ("source", ""), ("source", None), ("result_type", "r")]
    ext2 = [("result_type", "s")]
    rows = [
        _row(skus=[("B",), ("A",), ("",), (None,)], ext=ext1),
        _row(skus=[("A",), ("C",)], ext=ext2),
        _row(sid="s2", skus=[("",)], ext=[("source", "")]),      # no valid SKU, no valid value
        _row(sid="s2", qid="q9", skus=None, ext=None),
    ]
    out = {(r.session_id, r.search_id): r for r in _run(spark, rows)}
    g = out[("s1", "q1")]
    assert g.skus == "A,B,C" and g.algo_name == "x2" and g.result_type == "s" and g.source is None
    assert out[("s2", "q1")].skus is None and out[("s2", "q1")].source is None   # T4, T23
    assert out[("s2", "q9")].skus is None
    assert len(_run(spark, rows)) == 4


def test_screening_null_aware(spark):
    rows = [_row(), _row(sid="s2"), _row(kw=None, qid="qn")]
    # an excluded set holding a null removes everything
    assert _run(spark, rows, members=[("s2", "INTERNAL"), (None, "GOOGLE_BOT")]) == []
    out = _run(spark, rows, members=[("s2", "INTERNAL"), ("s1", "MEMBER")])
    assert {(r.session_id, r.search_internal_keyword) for r in out} == {("s1", "Shoe"), ("s1", None)}
    # a null keyword survives only an empty stopword set, and gets null facts
    nk = [r for r in out if r.search_internal_keyword is None][0]
    assert nk.skus is None and nk.algo_name is None
    out = _run(spark, rows, stops=("SHOE",))
    assert out == []


def test_clicks_columns(spark):
    schema = VIEW_SCHEMA.replace("device string, ", "").replace("client_member_id string, ", "").replace(
        "all_category_click string, ", "").replace("product_list array<struct<sku:string>>, ", "")
    schema += ", product_sku string, click_type string, product_name string"
    r = _row(ext=[("discount", "10"), ("algo", "a")])
    row = tuple(v for i, v in enumerate(r) if i not in (2, 6, 11, 21)) + ("SKU-1", "product", "shoe")
    raw = spark.createDataFrame([row], schema)
    s = spark.createDataFrame([("s1",)], "session_id string")
    m = spark.createDataFrame([], "session_id string, client_status string")
    w = spark.createDataFrame([], "stopword_keyword string")
    out = search_clicks(raw, s, m, w, CFG)
    assert len(out.columns) == 36
    got = out.collect()[0]
    assert got.discount == "10" and got.algo_name == "a" and got.product_sku == "SKU-1"

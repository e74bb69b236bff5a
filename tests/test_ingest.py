import pytest
from pyspark.sql import functions as F

from build import day, holdings, rows_by
from tidemark import DEFAULT
from tidemark.operators import ingest
from tidemark.sources import payloads

RUN, OLD, FUTURE = "2026-06-20", "2026-06-19", "2026-06-21"


def offer(fund, source, stocks, date=RUN, valid=True, history=None):
    low = history is not None and stocks < history * 0.6
    return (day(RUN), day(RUN), f"{fund}-{source}", fund, source, day(date) if date else None, stocks, 0, stocks, 100.0, 1.0, valid,
            "ok" if valid else "missing_weight_pct", history * 0.6 if history else None, low)


SCHEMA = ("run_date DATE, target_date DATE, candidate_id STRING, etf_code STRING, source_type STRING, data_date DATE, stock_count INT, "
          "non_stock_count INT, row_count INT, total_weight DOUBLE, shares_coverage DOUBLE, valid BOOLEAN, reason STRING, "
          "minimum_expected DOUBLE, low_confidence BOOLEAN")
AGG, WEB, OFF, STATIC = "moneydj_primary", "moneydj_browser", "official_fallback", "official_static"
LOW = "low_row_count_official_fallback"

CASES = {
    "BETTER": ([offer("BETTER", AGG, 55, history=115), offer("BETTER", OFF, 122)], (OFF, None)),
    "STALEOFF": ([offer("STALEOFF", AGG, 55, history=115), offer("STALEOFF", OFF, 122, OLD)], (AGG, f"{LOW}_stale")),
    "EQUAL": ([offer("EQUAL", AGG, 55, history=115), offer("EQUAL", OFF, 55)], (AGG, "low_row_count_confirmed_by_fallback")),
    "LOWER": ([offer("LOWER", AGG, 55, history=115), offer("LOWER", OFF, 40)], (AGG, f"{LOW}_lower_row_count")),
    "STILL": ([offer("STILL", AGG, 55, history=115), offer("STILL", OFF, 60)], (OFF, f"{LOW}_still_low")),
    "ZERO": ([offer("ZERO", AGG, 55, history=115), offer("ZERO", OFF, 0)], (AGG, f"{LOW}_zero_rows")),
    "NODATE": ([offer("NODATE", AGG, 55, history=115), offer("NODATE", OFF, 80, None)], (AGG, f"{LOW}_missing_date")),
    "NOOFF": ([offer("NOOFF", AGG, 55, history=115), offer("NOOFF", OFF, 122, valid=False)], (AGG, f"{LOW}_failed")),
    "FINE": ([offer("FINE", AGG, 100, history=115), offer("FINE", OFF, 122)], (AGG, None)),
    "RENEWED": ([offer("RENEWED", AGG, 100, OLD, history=115), offer("RENEWED", OFF, 10)], (OFF, None)),
    "BOTHOLD": ([offer("BOTHOLD", AGG, 100, OLD, history=115), offer("BOTHOLD", OFF, 110, OLD)], (AGG, None)),
    "WEB": ([offer("WEB", AGG, 100, valid=False), offer("WEB", WEB, 90), offer("WEB", OFF, 122)], (WEB, None)),
    "OFFONLY": ([offer("OFFONLY", AGG, 100, valid=False), offer("OFFONLY", STATIC, 90)], (STATIC, None)),
    "NONE": ([offer("NONE", AGG, 100, valid=False)], (None, "all sources failed")),
    "FUTURE": ([offer("FUTURE", AGG, 100, FUTURE)], (AGG, None)),
}


@pytest.fixture(scope="module")
def checked(spark):
    return spark.createDataFrame([o for offers, _ in CASES.values() for o in offers], SCHEMA)


def test_selection(checked):
    got = rows_by(ingest.candidate_selection(checked), "etf_code")
    assert {k: (r["chosen_source_type"], r["row_count_warning"]) for k, r in got.items()} == {k: want for k, (_, want) in CASES.items()}


def test_outcomes(checked):
    got = rows_by(ingest.scrape_outcome(ingest.candidate_selection(checked), checked), "etf_code")
    assert (got["FINE"]["outcome"], got["FINE"]["outcome_reason"]) == ("success", None)
    assert (got["BOTHOLD"]["outcome"], got["BOTHOLD"]["outcome_reason"]) == ("stale", "source_date_before_expected_data_date")
    assert (got["FUTURE"]["outcome"], got["FUTURE"]["outcome_reason"]) == ("failed", "source_date_after_expected_data_date")
    assert (got["NONE"]["outcome"], got["NONE"]["outcome_reason"]) == ("failed", "all sources failed")


def test_row_count_history_is_strictly_before(spark):
    days = [f"2026-06-{d:02d}" for d in range(1, 9)]
    rows = [(d, "A", f"{1000 + i}", 1, 1.0) for n, d in enumerate(days) for i in range(n + 1)]
    counts = ingest.stored_row_counts(holdings(spark, rows))
    means = {str(r["date"]): r["mean_rows"] for r in ingest.row_count_history(counts).collect()}
    assert means[days[0]] is None and means[days[2]] == 1.5 and means[days[7]] == 5.0
    profiles = spark.createDataFrame(
        [(day(RUN), "c1", "A", AGG, day("2026-06-08"), 2), (day(RUN), "c2", "A", AGG, day("2026-06-20"), 4), (day(RUN), "c3", "A", OFF, day("2026-06-20"), 1)],
        "run_date DATE, candidate_id STRING, etf_code STRING, source_type STRING, data_date DATE, stock_count INT")
    got = rows_by(ingest.row_count_check(profiles, counts), "candidate_id")
    assert got["c1"]["mean_rows"] == 5.0 and got["c1"]["low_confidence"] is True
    assert got["c2"]["mean_rows"] == 6.0 and got["c2"]["low_confidence"] is False or got["c2"]["minimum_expected"] > 4
    assert got["c3"]["minimum_expected"] is None and got["c3"]["low_confidence"] is False


def test_min_weight_gate(spark):
    def rows(fund, weights):
        return [(RUN, fund, f"{1000 + i}", 1, w) for i, w in enumerate(weights)]

    frame = holdings(spark, rows("KEEP", [1, 1, 1, 1, 1, 0.004]) + rows("BREAK", [1, 1, 1, 1, 0.004]))
    frame = frame.withColumn("run_date", F.col("date")).withColumn("candidate_id", F.col("etf_code"))
    got = rows_by(ingest.candidate_profiles(frame), "etf_code")
    assert got["KEEP"]["valid"] and got["KEEP"]["stock_count"] == 5
    assert got["BREAK"]["reason"] == "post_filter_invalid_snapshot:fewer_than_5_rows"


def test_weight_warning(spark):
    rows = [("a", "moneydj_primary", 69.99), ("b", "moneydj_primary", 140.0), ("c", "official_fallback", 110.01), ("d", "official_static", 20.0)]
    profiles = spark.createDataFrame([(c, s, t, True) for c, s, t in rows], "candidate_id STRING, source_type STRING, total_weight DOUBLE, valid BOOLEAN")
    got = {k: r["weight_warning"] for k, r in rows_by(ingest.weight_warning(profiles), "candidate_id").items()}
    assert got == {"a": "total_weight_below_expected_range", "b": None, "c": "total_weight_above_expected_range", "d": None}


def landed(spark, kind, body, fund="00980A"):
    return spark.createDataFrame([("p", fund.lower(), "official_fallback", kind, "N1", body)],
        "payload_id STRING, etf_code STRING, source_type STRING, format STRING, expected_fund_no STRING, body STRING")


def test_json_key_fallbacks(spark):
    body = '{"data":{"pcf":{"date1":"2026-06-20"},"stocks":[{"stocNo":"2330 TT","stocName":"台積電","share":"1,000","weightRound":0,"weight":"9.5"},' \
           '{"stocNo":"1101","stocName":"zero","share":"5","weightRound":"0","weight":"9.5"},{"code":"2317","name":"鴻海","qty":5,"ratio":1.25},{"code":"ABC","name":"x","qty":5,"ratio":1.25},{"code":"2454","name":"x"}]}}'
    got = {(r["stock_code"], r["stock_name"], r["shares"], r["weight_pct"], str(r["date"]), r["etf_code"]) for r in payloads.payload_rows(landed(spark, "object_list", body)).collect()}
    assert got == {("2330", "台積電", 1000.0, 9.5, RUN, "00980A"), ("1101", "zero", 5.0, 0.0, RUN, "00980A"), ("2317", "鴻海", 5.0, 1.25, RUN, "00980A")}


def test_identity_rejections(spark):
    titled = '{"Entries":{"FundID":"00999A","Data":{"FundAsset":{"NavDate":"2026/06/20"},"Table":[]}}}'
    assert payloads.payload_rejects(landed(spark, "titled_table", titled)).first()["reject"] == "fund_mismatch"
    base = '{"StatusCode":%s,"Entries":{"CSecuritiesCode":"%s","CFundId":"%s","CPcfdate":"%s","DynamicTableData":[{"TableTitle":"%s","Columns":[{"Name":"股票代號"},{"Name":"股票名稱"},{"Name":"股數"},{"Name":"權重"}],"Rows":[["2330","台積電","10","5"]]}]}}'
    cases = {
        ("1", "00980A", "N1", "2026-06-20T00:00", "股票"): "api_failed",
        ("0", "00981A", "N1", "2026-06-20T00:00", "股票"): "etf_mismatch",
        ("0", "00980A", "N2", "2026-06-20T00:00", "股票"): "fund_mismatch",
        ("0", "00980A", "N1", "2026-06-40T00:00", "股票"): "holdings_date_missing_or_invalid",
        ("0", "00980A", "N1", "2026-06-20T00:00", "債券"): "stock_table_not_found",
    }
    for values, want in cases.items():
        assert payloads.payload_rejects(landed(spark, "headered_table", base % values)).first()["reject"] == want
    good = landed(spark, "headered_table", base % ("0", "00980A", "N1", "2026-06-20T00:00", "股票"))
    assert payloads.payload_rejects(good).count() == 0
    assert payloads.payload_rows(good).first()["asset_name"] == "台積電(2330.TW)"


OBJECTS = '{"data":{"pcf":{"date1":"2026-06-20"},"stocks":[%s]}}'
GOOD = '{"stocNo":"2330","stocName":"a","share":"1","weight":"9.5"}'
TABLE = "<p>日期：2026/06/20</p><table><tr><td>代號</td><td>名稱</td><td>%s</td><td>權重</td></tr><tr><td>2330</td><td>a</td><td>%s</td><td>%s</td></tr></table>"
LIST = "<p>資料日期：2026/06/20</p><table class='datalist'><tr><td>a<b>b</b>(2330.TW)</td><td>%s</td><td>5</td></tr></table>"


def test_every_payload_gives_rows_or_one_reason(spark):
    cases = {
        "good": ("object_list", OBJECTS % GOOD, None), "oops": ("object_list", OBJECTS % (GOOD + ',{"stocNo":"x","share":"1","weight":"oops"}'), "unreadable_number"),
        "torn": ("object_list", (OBJECTS % GOOD)[:-9], "malformed_payload"), "none": ("object_list", OBJECTS % "", "no_stock_rows"),
        "null": ("grouped_detail", None, "malformed_payload"), "other": ("spreadsheet", "x", "unknown_format"),
        "html": ("html_table", TABLE % ("股數", "1,0", "2%"), None), "noshares": ("html_table", TABLE % ("x", "1", "2"), "no_stock_rows"),
        "badhtml": ("html_table", TABLE % ("股數", "1.x", "2"), "unreadable_number"), "text": ("text_block", "2026/06/20\n2330\na\n1\nten\n", "unreadable_number"),
        "list": ("aggregator_table", LIST % "1.5", None), "badlist": ("aggregator_table", LIST % "1.5.2", "unreadable_number"),
        "emptylist": ("aggregator_table", "<table></table>", "no_stock_rows"), "dash": ("aggregator_table", LIST % "-", None),
    }
    schema = "payload_id STRING, etf_code STRING, source_type STRING, format STRING, expected_fund_no STRING, body STRING"
    df = spark.createDataFrame([(k, "f", "official_fallback", kind, "N", body) for k, (kind, body, _) in cases.items()], schema)
    rejects = {r["payload_id"]: r["reject"] for r in payloads.payload_rejects(df).collect()}
    assert rejects == {k: want for k, (_, _, want) in cases.items() if want}
    rows = payloads.payload_rows(df).collect()
    assert {r["payload_id"] for r in rows} == set(cases) - set(rejects)
    assert {r["asset_name"] for r in rows if r["payload_id"] == "list"} == {"ab(2330.TW)"}


def test_short_rows_give_nothing(spark):
    body = '{"StatusCode":0,"Entries":{"CSecuritiesCode":"00980A","CFundId":"N1","CPcfdate":"2026-06-20","DynamicTableData":[{"TableTitle":"股票",' \
           '"Columns":[{"Name":"代號"},{"Name":"名稱"},{"Name":"權重"},{"Name":"股數"}],"Rows":[["2330","a","5"],["2317","b","5","7"]]}]}}'
    assert [r["stock_code"] for r in payloads.payload_rows(landed(spark, "headered_table", body)).collect()] == ["2317"]


def test_html_with_and_without_header(spark):
    body = "<p>日期：2026/06/20</p><table><tr><td>名稱</td><td>權重(%)</td><td>代號</td><td>股數</td></tr><tr><td>台積電</td><td>9.5%</td><td>2330</td><td>1,000</td></tr></table>" \
           "<table><tr><td>2317</td><td><b>鴻海</b></td><td>--</td><td>1.5</td></tr></table>"
    got = {(r["stock_code"], r["stock_name"], r["shares"], r["weight_pct"]) for r in payloads.payload_rows(landed(spark, "html_table", body)).collect()}
    assert got == {("2330", "台積電", 1000.0, 9.5), ("2317", "鴻海", None, 1.5)}


def test_text_block_at_the_end_is_cut(spark):
    body = "x 2026/06/20\n\n 2330 \n台積電\n1,000\n9.5%\n2317\n鴻海\n5\n"
    got = [(r["stock_code"], r["weight_pct"]) for r in payloads.payload_rows(landed(spark, "text_block", body)).collect()]
    assert got == [("2330", 9.5)]


def test_repeated_rows_in_a_candidate(spark):
    rows = holdings(spark, [(RUN, "A", "2330", 1, 1.0)] * 2 + [(RUN, "A", "2330", 1, 2.0)])
    assert ingest.dedupe_rows(rows).count() == 2
    assert DEFAULT.min_weight == 0.01


def test_a_payload_is_parsed_once_and_judged_with_its_rows(spark, capsys):
    bad = (GOOD + ',{"stocNo":"x","share":"1","weight":"oops"}')
    body = "object_list", OBJECTS % GOOD, OBJECTS % bad
    rows = [("good", body[1]), ("twice", body[1]), ("twice", body[2]), (None, body[1]), (None, body[2])]
    schema = "payload_id STRING, etf_code STRING, source_type STRING, format STRING, expected_fund_no STRING, body STRING"
    df = spark.createDataFrame([(k, "f", "official_fallback", body[0], "N", text) for k, text in rows], schema)
    got = [r["payload_id"] for r in payloads.payload_rows(df).collect()]
    assert sorted(map(str, got)) == ["None", "None", "good"]
    payloads.text_block_rows(df).explain()
    assert capsys.readouterr().out.count("Scan ExistingRDD") == 1


def test_no_body_is_moved_to_find_rejects(spark, capsys):
    payloads.payload_rejects(landed(spark, "text_block", "x")).explain()
    moved = [line for line in capsys.readouterr().out.splitlines() if "Exchange" in line or "Sort " in line]
    plan = payloads.payload_rejects(landed(spark, "text_block", "x"))._jdf.queryExecution().optimizedPlan().toString()
    joins = [at for at, line in enumerate(plan.splitlines()) if "Join" in line]
    assert moved and "AS malformed" in "".join(plan.splitlines()[joins[-1]:])

"""Landed raw payloads to holdings rows.

``raw_payloads`` is laid out by ``format``, so each parser reads its own partition. A payload
is one row; its rows come out of array expressions, with no shuffle and no Python.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.parsing import (
    MISSING_DASHES,
    MISSING_NUMBERS,
    cell_text,
    classify_asset,
    four_digit_code,
    labelled_date,
    parse_aggregator_weight,
    parse_date,
    parse_number,
    parse_weight,
    strip_tags,
)

# Header words of each field, words that mark a header row, stock table title.
HEADER_WORDS = {
    "code": ("股票代號", "股票代碼", "證券代號", "證券代碼", "代號", "code"),
    "name": ("股票名稱", "證券名稱", "名稱", "name"),
    "shares": ("持有股數", "持股數", "庫存股數", "股數", "shares"),
    "weight": ("權重", "投資比例", "佔基金淨資產比例", "比例", "weight", "%"),
}
HEADER_TERMS = ("股票", "證券", "代號", "名稱", "股數", "權重", "比例", "code", "name")
STOCK_TITLE = "股票"

ROW_COLUMNS = (
    "payload_id", "date", "etf_code", "asset_name", "asset_type", "stock_code", "stock_name",
    "shares", "weight_pct", "source_type",
)


def _text(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def _first(item: str, raw: str, *names: str) -> Column:
    """First non-empty of several spellings of a field; the JSON number 0 counts as absent, a quoted "0" does not."""
    def given(name: str) -> Column:
        zero = F.col(raw).rlike(rf'"{name}"\s*:\s*-?0+(\.0*)?([eE][-+]?\d+)?\s*[,}}]')
        return F.when(~zero, _text(F.col(f"{item}.{name}")))

    return F.coalesce(*map(given, names))


def _unreadable(printed: Column, number: Column, missing: tuple[str, ...] = MISSING_NUMBERS) -> Column:
    """A cell that is neither blank nor a missing marker nor a number."""
    plain = F.upper(F.regexp_replace(printed, "[,%\\s]", ""))
    return F.coalesce(number.isNull() & ~plain.isin("", *missing), F.lit(False))


def _printed(rows: DataFrame, code: Column, name: Column, shares: Column, weight: Column, whole: bool = True) -> DataFrame:
    """Printed stock rows: the fields, whether the row counts, and whether a number cannot be read.

    ``whole``: shares are read in every row; else only in rows that count.
    """
    read = rows.withColumns({
        "stock_code": four_digit_code(code), "stock_name": _text(name), "shares": parse_number(shares), "weight_pct": parse_weight(weight)})
    counts = F.col("stock_code").isNotNull() & F.col("stock_name").isNotNull() & F.col("weight_pct").isNotNull()
    bad_shares = _unreadable(shares, F.col("shares"))
    return read.withColumns({
        "counts": counts, "unreadable": _unreadable(weight, F.col("weight_pct")) | (bad_shares if whole else bad_shares & counts),
        "asset_name": F.concat("stock_name", F.lit("("), "stock_code", F.lit(".TW)")), "asset_type": F.lit("stock"),
    }).select(*ROW_COLUMNS, "counts", "unreadable")


def _accepted(printed: DataFrame) -> DataFrame:
    """Rows that count, of payloads in which every number can be read.

    The rows of a payload meet once and are judged together, so that it is parsed once; a payload without id
    is known by its rows alone and keeps those that count.
    """
    refused = F.bool_or("unreadable").over(W.partitionBy("payload_id")) & F.col("payload_id").isNotNull()
    return printed.withColumn("refused", refused).where(F.col("counts") & ~F.col("refused")).select(*ROW_COLUMNS)


def _of(payloads: DataFrame, kind: str) -> DataFrame:
    return payloads.where(F.col("format") == kind).withColumn("etf_code", F.upper("etf_code"))


# --- JSON shapes ----------------------------------------------------------------------

_ITEM = ", ".join(
    f"{n}: STRING" for n in (
        "stocNo", "stockNo", "stockCode", "code", "stocName", "stockName", "name",
        "share", "shares", "qty", "weightRound", "weight", "ratio",
    )
)
OBJECT_LIST = f"STRUCT<data: STRUCT<pcf: STRUCT<date1: STRING, date2: STRING>, stocks: ARRAY<STRING>>>"
TITLED_TABLE = (
    "STRUCT<Entries: STRUCT<FundID: STRING, Data: STRUCT<FundAsset: STRUCT<NavDate: STRING>, "
    "Table: ARRAY<STRUCT<TableTitle: STRING, `Rows`: ARRAY<ARRAY<STRING>>>>>>>"
)
GROUPED_DETAIL = (
    "STRUCT<Data: STRUCT<FundAssets: ARRAY<STRUCT<`資料日期`: STRING>>, FundAssetsDetail: ARRAY<STRUCT<Code: STRING, "
    "Data: ARRAY<STRUCT<code_: STRING, name_: STRING, qty_: STRING, weights_: STRING>>>>>>"
)
HEADERED_TABLE = (
    "STRUCT<StatusCode: INT, Entries: STRUCT<CSecuritiesCode: STRING, CFundId: STRING, CPcfdate: STRING, "
    "DynamicTableData: ARRAY<STRUCT<TableTitle: STRING, Columns: ARRAY<STRUCT<Name: STRING>>, `Rows`: ARRAY<ARRAY<STRING>>>>>>"
)


def _object_list(payloads: DataFrame) -> DataFrame:
    doc = _of(payloads, "object_list").withColumn("doc", F.from_json("body", OBJECT_LIST))
    dated = doc.withColumn("date", parse_date(F.coalesce(_text(F.col("doc.data.pcf.date2")), F.col("doc.data.pcf.date1"))))
    items = dated.withColumn("raw", F.explode("doc.data.stocks")).withColumn("item", F.from_json("raw", f"STRUCT<{_ITEM}>"))
    return _printed(
        items,
        _first("item", "raw", "stocNo", "stockNo", "stockCode", "code"),
        _first("item", "raw", "stocName", "stockName", "name"),
        _first("item", "raw", "share", "shares", "qty"),
        _first("item", "raw", "weightRound", "weight", "ratio"),
    )


def _titled(payloads: DataFrame) -> DataFrame:
    doc = _of(payloads, "titled_table").withColumn("doc", F.from_json("body", TITLED_TABLE))
    fund = _text(F.col("doc.Entries.FundID"))
    return doc.withColumn("reject", F.when(F.upper(fund) != F.col("etf_code"), "fund_mismatch"))


def _titled_table(payloads: DataFrame) -> DataFrame:
    doc = _titled(payloads).where("reject IS NULL")
    dated = doc.withColumn("date", parse_date(F.col("doc.Entries.Data.FundAsset.NavDate")))
    tables = dated.withColumn("table", F.explode("doc.Entries.Data.Table")).where(F.col("table.TableTitle") == STOCK_TITLE)
    cells = tables.withColumn("cells", F.explode("table.Rows")).where(F.size("cells") >= 4)
    return _printed(cells, *[F.col("cells")[i] for i in range(4)], whole=False)


def _grouped_detail(payloads: DataFrame) -> DataFrame:
    doc = _of(payloads, "grouped_detail").withColumn("doc", F.from_json("body", GROUPED_DETAIL))
    dated = doc.withColumn("date", parse_date(F.get("doc.Data.FundAssets", F.lit(0))["資料日期"]))
    groups = dated.withColumn("g", F.explode("doc.Data.FundAssetsDetail")).where(F.upper("g.Code") == "STOCK")
    items = groups.withColumn("item", F.explode("g.Data"))
    return _printed(items, *[F.col(f"item.{n}") for n in ("code_", "name_", "qty_", "weights_")])


def header_positions(headers: Column) -> dict[str, Column]:
    """1-based position of the first header naming each field, 0 when there is none."""
    plain = F.transform(headers, lambda h: F.lower(F.regexp_replace(h, r"\s+", "")))
    return {
        field: F.coalesce(F.array_position(F.transform(plain, lambda h: h.rlike("|".join(words))), True), F.lit(0)).cast("int")
        for field, words in HEADER_WORDS.items()
    }


def _cell(at: str) -> Column:
    return F.try_element_at("cells", F.nullif(F.col(at), F.lit(0)))


def _complete() -> Column:
    """All four positions are known and inside the row."""
    return reduce(lambda a, b: a & b, [F.col(f"at_{k}").between(1, F.size("cells")) for k in HEADER_WORDS])


def _headered(payloads: DataFrame) -> DataFrame:
    doc = _of(payloads, "headered_table").withColumn("doc", F.from_json("body", HEADERED_TABLE))
    entry = F.col("doc.Entries")
    tables = F.filter(entry["DynamicTableData"], lambda t: F.trim(t["TableTitle"]).startswith(STOCK_TITLE))
    placed = (
        doc.withColumn("table", F.get(tables, F.lit(0)))
        .withColumn("date", parse_date(F.substring_index(entry["CPcfdate"], "T", 1)))
        .withColumn("headers", F.transform("table.Columns", lambda c: F.coalesce(c["Name"], F.lit(""))))
    )
    placed = placed.withColumns({f"at_{k}": v for k, v in header_positions(F.col("headers")).items()})
    no_schema = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"at_{k}"), F.lit(0)) == 0 for k in HEADER_WORDS])
    reject = (
        F.when(entry.isNull() | (F.coalesce("doc.StatusCode", F.lit(-1)) != 0), "api_failed")
        .when(F.upper(F.trim(F.coalesce(entry["CSecuritiesCode"], F.lit("")))) != F.col("etf_code"), "etf_mismatch")
        .when(F.trim(F.coalesce(entry["CFundId"], F.lit(""))) != F.coalesce("expected_fund_no", F.lit("")), "fund_mismatch")
        .when(F.col("date").isNull(), "holdings_date_missing_or_invalid")
        .when(F.col("table").isNull(), "stock_table_not_found")
        .when(no_schema, "stock_table_schema_invalid")
    )
    return placed.withColumn("reject", reject)


def _headered_table(payloads: DataFrame) -> DataFrame:
    cells = _headered(payloads).where("reject IS NULL").withColumn("cells", F.explode("table.Rows")).where(_complete())
    return _printed(cells, *[_cell(f"at_{k}") for k in HEADER_WORDS])


REPEATS = ["payload_id", "etf_code", "date", "asset_name", "weight_pct", "shares"]


def json_payload_rows(payloads: DataFrame) -> DataFrame:
    plain = _accepted(_object_list(payloads)).unionByName(_accepted(_titled_table(payloads)))
    once = _accepted(_grouped_detail(payloads)).unionByName(_accepted(_headered_table(payloads)))
    return plain.unionByName(once.dropDuplicates(REPEATS))


def fund_options(options: DataFrame) -> DataFrame:
    """Internal fund number of each asked code, or why there is none.

    ``options``: etf_code and the body of the issuer's options payload. Codes must match exactly,
    but for case and outer blanks.
    """
    doc = options.withColumn("doc", F.from_json("body", "StatusCode INT, Entries ARRAY<STRUCT<SecuritiesCode: STRING, FundNo: STRING>>"))
    code = F.upper("etf_code")
    hits = F.filter("doc.Entries", lambda e: F.upper(F.trim(e["SecuritiesCode"])) == code)
    found = doc.withColumn("hits", F.coalesce(hits, F.array()))
    number = _text(F.get("hits", F.lit(0))["FundNo"])
    reject = (
        F.when(F.coalesce("doc.StatusCode", F.lit(-1)) != 0, "api_failed")
        .when(F.size("hits") != 1, "fund_option_missing_or_ambiguous")
        .when(number.isNull(), "fund_no_missing")
    )
    return found.select(code.alias("etf_code"), F.when(reject.isNull(), number).alias("fund_no"), reject.alias("reject"))


# --- HTML and text --------------------------------------------------------------------


def _pieces(html: Column, tag: str, group: int = 0) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), F.lit(group))


def _cell_texts(row: Column, text=strip_tags) -> Column:
    return F.transform(_pieces(row, "td", 1), lambda cell: text(cell))


def _html_table(payloads: DataFrame) -> DataFrame:
    """Rows of every well-formed table: by header names, or the first four cells without a header."""
    tables = (
        _of(payloads, "html_table")
        .withColumn("date", parse_date(labelled_date(strip_tags(F.col("body")))))
        .withColumn("table", F.explode(_pieces(F.col("body"), "table")))
        .withColumn("lines", _pieces(F.col("table"), "tr"))
        .withColumn("first_line", F.get("lines", F.lit(0)))
        .where("first_line IS NOT NULL")
    )
    any_cell = F.transform(
        F.regexp_extract_all("first_line", F.lit(r"(?is)<t[hd](?:\s[^>]*)?>(.*?)</t[hd]>"), F.lit(1)), lambda cell: strip_tags(cell)
    )
    worded = F.lower(F.array_join("headers", " ")).rlike("|".join(HEADER_TERMS))
    headed = (
        tables.withColumn("headers", any_cell)
        .withColumn("has_header", F.col("first_line").rlike(r"(?i)<th[\s>]") | worded)
        .withColumn("data", F.when(F.col("has_header"), F.slice("lines", 2, F.size("lines"))).otherwise(F.col("lines")))
    )
    found = {k: F.when(F.col("has_header"), v).otherwise(0) for k, v in header_positions(F.col("headers")).items()}
    mapped = headed.withColumns({f"at_{k}": v for k, v in found.items()})
    named = reduce(lambda a, b: a | b, [F.col(f"at_{k}") > 0 for k in HEADER_WORDS])
    placed = mapped.withColumn("named", named).withColumns(
        {
            f"at_{k}": F.when(F.col("named"), F.col(f"at_{k}")).otherwise(i + 1)
            for i, k in enumerate(HEADER_WORDS)
        }
    )
    cells = placed.withColumn("line", F.explode("data")).withColumn("cells", _cell_texts(F.col("line"))).where(F.size("cells") >= 4)
    return _printed(cells.where(_complete()), *[_cell(f"at_{k}") for k in HEADER_WORDS])


def html_table_rows(payloads: DataFrame) -> DataFrame:
    return _accepted(_html_table(payloads))


def _aggregator_table(payloads: DataFrame) -> DataFrame:
    """Three-column table of asset name, weight and shares, covering every asset type."""
    lists = F.filter(_pieces(F.col("body"), "table"), lambda t: t.rlike(r"(?is)\A<table\s[^>]*class\s*=\s*[\"'][^\"']*\bdatalist\b"))
    cells = (
        _of(payloads, "aggregator_table")
        .withColumn("date", parse_date(labelled_date(strip_tags(F.col("body")))))
        .withColumn("table", F.explode(lists))
        .withColumn("line", F.explode(_pieces(F.col("table"), "tr")))
        .withColumn("cells", _cell_texts(F.col("line"), cell_text))
        .where(F.size("cells") == 3)
    )
    weight, shares = F.col("cells")[1], F.col("cells")[2]
    return (
        cells.withColumn("asset_name", F.col("cells")[0])
        .withColumn("weight_pct", parse_aggregator_weight(weight))
        .withColumn("shares", parse_number(shares))
        .withColumn("class", classify_asset(F.col("asset_name")))
        .select("*", "class.*")
        .withColumns({"counts": F.lit(True), "unreadable": _unreadable(weight, F.col("weight_pct"), MISSING_DASHES) | _unreadable(shares, F.col("shares"))})
        .select(*ROW_COLUMNS, "counts", "unreadable")
    )


def aggregator_table_rows(payloads: DataFrame) -> DataFrame:
    return _accepted(_aggregator_table(payloads))


def _text_block(payloads: DataFrame) -> DataFrame:
    """Plain text: a four-digit line followed by name, shares and weight lines."""
    lines = F.filter(F.transform(F.split("body", r"\R"), lambda x: F.trim(x)), lambda x: x != "")
    placed = (
        _of(payloads, "text_block")
        .withColumn("date", parse_date(F.regexp_extract("body", r"(\d{4}/\d{2}/\d{2})", 1)))
        .withColumn("lines", lines)
        .select("*", F.posexplode("lines").alias("at", "line"))
        .where(F.col("line").rlike(r"\A\d{4}\z") & (F.col("at") + 3 < F.size("lines")))
    )
    following = [F.get("lines", F.col("at") + i) for i in range(4)]
    return _printed(placed, *following)


def text_block_rows(payloads: DataFrame) -> DataFrame:
    return _accepted(_text_block(payloads))


def payload_rows(payloads: DataFrame) -> DataFrame:
    """Holdings rows of every supported format."""
    parsers = (json_payload_rows, html_table_rows, aggregator_table_rows, text_block_rows)
    return reduce(DataFrame.unionByName, [p(payloads) for p in parsers])


JSON_FORMATS = ("object_list", "titled_table", "grouped_detail", "headered_table")
PARSERS = (_object_list, _titled_table, _grouped_detail, _headered_table, _html_table, _aggregator_table, _text_block)


def payload_rejects(payloads: DataFrame) -> DataFrame:
    """Payloads that give no rows, each with one reason; every other payload gives rows.

    In this order: unknown format, malformed body, wrong identity or layout, a number that cannot be
    read (the whole payload is refused, not only the row), no stock row.
    """
    seen = reduce(DataFrame.unionByName, [parse(payloads).select("payload_id", "counts", "unreadable") for parse in PARSERS])
    verdicts = seen.groupBy("payload_id").agg(F.bool_or("counts").alias("counts"), F.bool_or("unreadable").alias("unreadable"))
    layout = _titled(payloads).select("payload_id", "reject").unionByName(_headered(payloads).select("payload_id", "reject"))
    malformed = F.col("body").isNull() | (F.col("format").isin(*JSON_FORMATS) & F.try_parse_json("body").isNull())
    known = (*JSON_FORMATS, "html_table", "aggregator_table", "text_block")
    reason = (
        F.when(~F.coalesce(F.col("format").isin(*known), F.lit(False)), "unknown_format")
        .when(F.col("malformed"), "malformed_payload")
        .when(F.col("reject").isNotNull(), F.col("reject"))
        .when(F.coalesce("unreadable", F.lit(False)), "unreadable_number")
        .when(~F.coalesce("counts", F.lit(False)), "no_stock_rows")
    )
    # The body is looked at before the joins, so that none is moved.
    told = payloads.select("payload_id", "etf_code", "format", malformed.alias("malformed"))
    judged = told.join(layout.where("reject IS NOT NULL"), "payload_id", "left").join(verdicts, "payload_id", "left")
    return judged.select("payload_id", F.upper("etf_code").alias("etf_code"), "format", reason.alias("reject")).where("reject IS NOT NULL")


def security_master_rows(pages: DataFrame) -> DataFrame:
    """Listed securities of a market page: ``CODE NAME``, isin, listing date."""
    cells = (
        pages.withColumn("line", F.explode(_pieces(F.col("body"), "tr")))
        .withColumn("cells", _cell_texts(F.col("line")))
        .where(F.size("cells") >= 2)
        .withColumn("first", F.regexp_replace(F.col("cells")[0], r"(?U)\s+", " "))
    )
    pattern = r"^([0-9A-Z]{4,8})\s+(.+)$"
    return cells.where(F.col("first").rlike(pattern)).select(
        "market",
        F.regexp_extract("first", pattern, 1).alias("code"),
        F.trim(F.regexp_extract("first", pattern, 2)).alias("name"),
        _text(F.col("cells")[1]).alias("isin"),
        parse_date(F.get("cells", F.lit(2))).alias("listing_date"),
    )


def payload_dates(payloads: DataFrame) -> DataFrame:
    """Labelled (or first) date of each page."""
    return payloads.select("payload_id", parse_date(labelled_date(strip_tags(F.col("body")))).alias("data_date"))

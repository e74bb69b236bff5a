"""Portfolio tables derived from the generated order tables.

Fund = supplier, stock = part bucket, snapshot date = quarter of the ship date,
issuer = nation of the supplier. Every row of ``lineitem`` takes part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.plans.staging import task_count
from tidemark.sources.tables import Tables

STOCK_BUCKETS = 20
SCRAPED_AT = "2002-01-01 00:00:00"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fund_code(key: Column) -> Column:
    return F.concat(F.lit("F"), F.lpad(key.cast("string"), 5, "0"))


def _fixed(method: str) -> list[Column]:
    return [
        F.concat(F.lit("https://example.com/"), F.col("etf_code")).alias("source_url"),
        F.col("source_type"),
        F.lit(method).alias("extraction_method"),
        F.lit(SCRAPED_AT).cast("timestamp").alias("scraped_at"),
    ]


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock holdings: weights are integer cents over integer cents, so engines agree bit for bit."""
    quarter = F.trunc(F.to_date("l_shipdate"), "quarter")
    lines = read(spark, sf_dir, "lineitem")
    base = lines.select(
        quarter.alias("date"),
        F.col("l_suppkey").alias("k"),
        (F.col("l_partkey") % STOCK_BUCKETS).alias("b"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("q"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("c"),
    ).repartition(task_count(lines.count()), "k")  # the sums and the totals below both stay inside one fund
    # On one date every third fund comes without its source, which makes these snapshots invalid.
    one_thin_date = (F.col("date") == F.lit("1997-07-01").cast("date")) & (F.col("k") % 3 == 0)
    on_fallback = (F.col("k") + F.quarter("date") + F.year("date")) % 7 == 0
    main_source = F.when(one_thin_date, "").when(on_fallback, "official_fallback").otherwise("moneydj_primary")
    # Both sources are summed before they part into rows, over keys and values of fixed width.
    in_second = (F.col("k") % 5 == 0) & (F.col("line") <= 3)
    summed = base.groupBy("date", "k", "b").agg(
        F.sum("q").alias("q"), F.sum("c").alias("c"),
        F.sum(F.when(in_second, F.col("q"))).alias("second_q"), F.sum(F.when(in_second, F.col("c"))).alias("second_c"),
        F.count_if(in_second).alias("second_lines"),
    )
    # At most STOCK_BUCKETS rows per fund and date, so this window never holds a large group.
    # The fund leads the order, as it tells most rows of a task apart; rows of a fund stay together in what is written.
    fund_day = W.partitionBy("k", "date")
    totalled = summed.select("*", F.sum("c").over(fund_day).alias("total"), F.sum("second_c").over(fund_day).alias("second_total"))
    main = F.struct(main_source.alias("source_type"), "q", "c", "total")
    second = F.struct(F.lit("official_static").alias("source_type"), *[F.col(f"second_{x}").alias(x) for x in ("q", "c", "total")])
    sources = F.when(F.col("second_lines") > 0, F.array(main, second)).otherwise(F.array(main))
    sourced = totalled.select("date", "k", "b", F.inline(sources))
    code = (F.lit(1000) + F.col("b")).cast("string")
    return (
        sourced.withColumn("etf_code", fund_code(F.col("k")))
        .withColumn("stock_code", code)
        .withColumn("stock_name", F.concat(F.lit("STK"), code))
        .select(
            "date",
            "etf_code",
            F.concat("stock_name", F.lit("("), "stock_code", F.lit(".TW)")).alias("asset_name"),
            F.lit("stock").alias("asset_type"),
            "stock_code",
            "stock_name",
            F.when((F.col("k") + F.col("b")) % 17 != 0, F.col("q")).alias("shares"),
            (F.lit(95.0) * F.col("c") / F.col("total")).alias("weight_pct"),
            *_fixed("generated"),
        )
    )


def non_stock(stock_rows: DataFrame) -> DataFrame:
    """One cash row of five percent per snapshot."""
    return (
        stock_rows.select("date", "etf_code", "source_type")
        .distinct()
        .select(
            "date",
            "etf_code",
            F.lit("Cash").alias("asset_name"),
            F.lit("cash").alias("asset_type"),
            F.lit(5.0).alias("weight_pct"),
            *_fixed("generated"),
        )
    )


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    listing = F.date_add(F.lit("1995-01-01").cast("date"), ((key % 10) * 91).cast("int"))
    stamp = F.lit(SCRAPED_AT).cast("timestamp")
    return (
        read(spark, sf_dir, "supplier")
        .join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            fund_code(key).alias("code"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("issuer"),
            F.when(key % 2 == 0, "TWSE").otherwise("TPEx").alias("market"),
            F.when(key % 7 != 0, F.concat(F.lit("TW"), key.cast("string"))).alias("isin"),
            F.when(key % 33 != 32, listing).alias("listing_date"),
            (key % 20 == 19).cast("int").alias("retired"),
            F.lit("1995-01-01").cast("date").alias("first_seen_date"),
            F.lit(None).cast("string").alias("official_url"),
            F.when(key % 4 == 0, "api").otherwise("static").alias("official_method"),
            F.when(key % 25 == 24, "excluded_from_taiwan_stock_universe")
            .otherwise(F.concat(F.lit("fund_no="), key.cast("string"), F.lit("; lang = zh")))
            .alias("official_logic"),
            stamp.alias("created_at"),
            stamp.alias("updated_at"),
        )
    )


def tables(spark: SparkSession, sf_dir: str, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> Tables:
    """The three tables; ``keep`` may stage the derived holdings, which every query reads."""
    stock_rows = holdings(spark, sf_dir)
    if keep:
        stock_rows = keep(stock_rows, "holdings")
    return Tables(stock_rows, non_stock(stock_rows), universe(spark, sf_dir))


# --- Landed inputs --------------------------------------------------------------------


def fund_number() -> Column:
    return F.substring("etf_code", 2, 10).cast("bigint")


def candidates(stock_rows: DataFrame, other_rows: DataFrame) -> DataFrame:
    """One landed candidate per snapshot, with late runs, another channel and thinned rows.

    Every fourth fund is collected a quarter late; every eighth comes through the browser
    channel, which misses the stocks whose code divides by seven.
    """
    k = fund_number()
    late = k % 4 == 1
    browser = (k % 8 == 3) & (F.col("source_type") == "moneydj_primary")
    rows = stock_rows.unionByName(other_rows, allowMissingColumns=True)
    thinned = browser & (F.coalesce(F.col("stock_code").cast("int"), F.lit(1)) % 7 == 0)
    channel = F.when(browser, "moneydj_browser").otherwise(F.col("source_type"))
    return (
        rows.where(~thinned)
        .withColumn("source_type", channel)
        .withColumn("candidate_id", F.concat_ws("|", F.col("date").cast("string"), "etf_code", "source_type"))
        .withColumn("run_date", F.when(late, F.add_months("date", 3)).otherwise(F.col("date")))
        .select(
            "candidate_id", "run_date", "date", "etf_code", "asset_name", "asset_type", "stock_code", "stock_name",
            "shares", "weight_pct", "source_url", "source_type", "extraction_method",
        )
    )


PAYLOAD_FORMATS = (
    "object_list", "titled_table", "grouped_detail", "headered_table", "html_table", "text_block", "aggregator_table",
)


def payloads(stock_rows: DataFrame) -> DataFrame:
    """Each snapshot rendered as the payload of one of the source formats.

    A snapshot has at most STOCK_BUCKETS rows, so its rendering fits one row. Funds whose
    number leaves 10 modulo 14 print a wrong identity.
    """
    k = fund_number()
    shares = F.coalesce(F.col("shares").cast("bigint").cast("string"), F.lit("-")).alias("shares")
    weight = F.col("weight_pct").cast("string").alias("weight")
    item = F.struct(F.col("stock_code").alias("code"), F.col("stock_name").alias("name"), shares, weight)
    base = (
        stock_rows.groupBy("date", "etf_code", "source_type")
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
        .withColumn("payload_id", F.concat_ws("|", F.col("date").cast("string"), "etf_code", "source_type"))
        .withColumn("kind", F.element_at(F.array(*map(F.lit, PAYLOAD_FORMATS)), ((k % 7) + 1).cast("int")))
        .withColumn("shown", F.when(k % 14 == 10, F.lit("WRONG")).otherwise(F.col("etf_code")))
        .withColumn("day", F.date_format("date", "yyyy-MM-dd"))
        .withColumn("slashed", F.date_format("date", "yyyy/MM/dd"))
    )
    items = F.col("items")

    def each(render) -> Column:
        return F.transform(items, render)

    def text_lines(render, sep: str = "") -> Column:
        return F.array_join(F.transform(items, render), sep)

    arrays = each(lambda x: F.array(x["code"], x["name"], x["shares"], x["weight"]))
    object_list = F.to_json(
        F.struct(
            F.struct(
                F.struct(F.col("day").alias("date2")).alias("pcf"),
                each(
                    lambda x: F.struct(
                        x["code"].alias("stocNo"), x["name"].alias("stocName"), x["shares"].alias("share"),
                        x["weight"].alias("weightRound"),
                    )
                ).alias("stocks"),
            ).alias("data")
        )
    )
    titled = F.to_json(
        F.struct(
            F.struct(
                F.col("etf_code").alias("FundID"),
                F.struct(
                    F.struct(F.col("day").alias("NavDate")).alias("FundAsset"),
                    F.array(
                        F.struct(F.lit("現金").alias("TableTitle"), F.array(F.array(F.lit("1"), F.lit("x"), F.lit("1"), F.lit("1"))).alias("Rows")),
                        F.struct(F.lit("股票").alias("TableTitle"), arrays.alias("Rows")),
                    ).alias("Table"),
                ).alias("Data"),
            ).alias("Entries")
        )
    )
    grouped = F.to_json(
        F.struct(
            F.struct(
                F.array(F.struct(F.col("day").alias("資料日期"))).alias("FundAssets"),
                F.array(
                    F.struct(
                        F.lit("STOCK").alias("Code"),
                        each(
                            lambda x: F.struct(
                                x["code"].alias("code_"), x["name"].alias("name_"), x["shares"].alias("qty_"),
                                F.concat(x["weight"], F.lit("%")).alias("weights_"),
                            )
                        ).alias("Data"),
                    )
                ).alias("FundAssetsDetail"),
            ).alias("Data")
        )
    )
    swapped = each(lambda x: F.array(x["name"], x["code"], x["weight"], x["shares"]))
    headered = F.to_json(
        F.struct(
            F.lit(0).alias("StatusCode"),
            F.struct(
                F.col("shown").alias("CSecuritiesCode"),
                F.concat(F.lit("N"), F.col("etf_code")).alias("CFundId"),
                F.concat("day", F.lit("T00:00:00")).alias("CPcfdate"),
                F.array(
                    F.struct(
                        F.lit("股票明細").alias("TableTitle"),
                        F.array(
                            *[F.struct(F.lit(n).alias("Name")) for n in ("股票名稱", "股票代號", "權重(%)", "持有股數")]
                        ).alias("Columns"),
                        swapped.alias("Rows"),
                    )
                ).alias("DynamicTableData"),
            ).alias("Entries"),
        )
    )

    def tr(*cells: Column) -> Column:
        return F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>"))

    html = F.concat(
        F.lit("<html><body><p>資料日期："), F.col("slashed"),
        F.lit("</p><table><tr><th>證券代號</th><th>證券名稱</th><th>股數</th><th>投資比例</th></tr>"),
        text_lines(lambda x: tr(F.concat(F.lit("<b>"), x["code"], F.lit("</b>")), x["name"], x["shares"], F.concat(x["weight"], F.lit(" %")))),
        F.lit("</table></body></html>"),
    )
    text = F.concat(
        F.lit("Fund holdings "), F.col("slashed"), F.lit("\n\n"),
        text_lines(lambda x: F.concat_ws("\n", x["code"], x["name"], x["shares"], x["weight"]), "\n"),
    )
    aggregator = F.concat(
        F.lit("<html><body>日期: "), F.col("slashed"), F.lit("<table class=\"datalist\"><tbody>"),
        text_lines(lambda x: tr(F.concat(x["name"], F.lit("("), x["code"], F.lit(".TW)")), x["weight"], x["shares"])),
        tr(F.lit("Cash &amp; equivalents"), F.lit("5.0"), F.lit("N/A")),
        F.lit("</tbody></table></body></html>"),
    )
    bodies = dict(zip(PAYLOAD_FORMATS, (object_list, titled, grouped, headered, html, text, aggregator)))
    body = F.lit(None).cast("string")
    for kind, rendered in bodies.items():
        body = F.when(F.col("kind") == kind, rendered).otherwise(body)
    return base.select(
        "payload_id", "etf_code", "source_type", F.col("kind").alias("format"),
        F.concat(F.lit("N"), F.col("etf_code")).alias("expected_fund_no"), body.alias("body"),
    )


# Names given to generated listed securities, by supplier number modulo six.
SECURITY_NAMES = ("主動台灣優選", "主動全球科技", "主動中國信託台股", "被動高息", "主動中國信託海外", "主動價值")


def securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    name = F.element_at(F.array(*map(F.lit, SECURITY_NAMES)), ((key % 6) + 1).cast("int"))
    return read(spark, sf_dir, "supplier").select(
        F.when(key % 2 == 0, "TWSE").otherwise("TPEx").alias("market"),
        F.concat(F.lpad(key.cast("string"), 5, "0"), F.when(key % 5 == 0, "B").otherwise("A")).alias("code"),
        name.alias("name"),
        F.when(key % 7 != 0, F.concat(F.lit("TW"), key.cast("string"))).alias("isin"),
        F.date_add(F.lit("1995-01-01").cast("date"), key.cast("int") % 500).alias("listing_date"),
    )


def market_pages(listed: DataFrame) -> DataFrame:
    """Security master pages of a market, a hundred listings to a page."""
    row = F.concat(
        F.lit("<tr><td>"), "code", F.lit("　"), "name", F.lit("</td><td>"), F.coalesce("isin", F.lit("")),
        F.lit("</td><td>"), F.date_format("listing_date", "yyyy/MM/dd"), F.lit("</td></tr>"),
    )
    page = F.floor(F.substring("code", 1, 5).cast("bigint") / 100)
    return (
        listed.withColumn("page", page).withColumn("row", row).groupBy("market", "page")
        .agg(F.concat(F.lit("<table>"), F.array_join(F.array_sort(F.collect_list("row")), ""), F.lit("</table>")).alias("body"))
    )


def ship_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()


def holidays(dates: DataFrame) -> DataFrame:
    """Fixed closing days of every year in the dates, plus an override in even years."""
    years = dates.select(F.year("date").alias("year")).distinct()
    days = years.select("year", F.explode(F.array(*map(F.lit, ("0101", "0228", "0404", "0501", "1010")))).alias("mmdd"))
    extra = years.where("year % 2 = 0").select("year", F.lit("0702").alias("mmdd"))
    return days.withColumn("kind", F.lit("holiday")).unionByName(extra.withColumn("kind", F.lit("override")))

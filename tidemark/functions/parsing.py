"""Text to value: dates, numbers, asset names, key=value config."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date labels, missing-number markers and asset words of the source pages.
DATE_LABELS = ("資料日期", "日期")
MISSING_NUMBERS = ("-", "--", "N/A", "NA")
MISSING_DASHES = ("-", "--")
ASSET_WORDS = (
    ("cash", "cash", "現金"),
    ("futures", "futures", "期貨"),
    ("options", "options", "選擇權"),
    ("bond", "bond", "債"),
)
ZERO_WEIGHT_STANDIN = 0.004


def parse_date(text: Column) -> Column:
    """``yyyy-MM-dd`` or ``yyyy/MM/dd`` text to a date, NULL when it is neither."""
    t = F.trim(text.cast("string"))
    return F.coalesce(F.try_to_date(t, "yyyy-M-d"), F.try_to_date(t, "yyyy/M/d"))


def labelled_date(text: Column) -> Column:
    """The labelled yyyy/MM/dd date of a page, else its first yyyy/MM/dd, as text."""
    labels = "|".join(DATE_LABELS)
    found = F.regexp_extract(text, rf"(?:{labels})\s*[:：]?\s*(\d{{4}}/\d{{2}}/\d{{2}})", 1)
    anywhere = F.regexp_extract(text, r"(\d{4}/\d{2}/\d{2})", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.nullif(anywhere, F.lit("")))


def parse_number(text: Column, missing: tuple[str, ...] = MISSING_NUMBERS) -> Column:
    """Number with thousands separators; the missing markers and blanks give NULL."""
    cleaned = F.replace(F.trim(text), F.lit(","), F.lit(""))
    return F.when(
        (cleaned != "") & ~F.upper(cleaned).isin(*missing), cleaned.try_cast("double")
    )


def parse_weight(text: Column, missing: tuple[str, ...] = MISSING_NUMBERS) -> Column:
    """Percentage text to a number."""
    return parse_number(F.replace(text, F.lit("%"), F.lit("")), missing)


def parse_aggregator_weight(text: Column) -> Column:
    """Aggregator weights: a printed zero means a tiny position, kept as a stand-in value."""
    weight = parse_weight(text, MISSING_DASHES)
    return F.when(weight == 0.0, F.lit(ZERO_WEIGHT_STANDIN)).otherwise(weight)


def classify_asset(asset_name: Column) -> Column:
    """Struct of asset_type, stock_code and stock_name read from a printed asset name."""
    name = F.trim(asset_name)
    pattern = r"(?i)\A(.+?)\((\d{4})\.TW\)\z"
    code = F.nullif(F.regexp_extract(name, pattern, 2), F.lit(""))
    lowered = F.lower(name)
    kind = F.when(code.isNotNull(), F.lit("stock"))
    for asset_type, english, chinese in ASSET_WORDS:
        kind = kind.when(lowered.contains(english) | name.contains(chinese), F.lit(asset_type))
    return F.struct(
        kind.otherwise(F.lit("unknown")).alias("asset_type"),
        code.alias("stock_code"),
        F.when(code.isNotNull(), F.trim(F.regexp_extract(name, pattern, 1))).alias("stock_name"),
    )


def four_digit_code(text: Column) -> Column:
    """First stand-alone four-digit number of a text, or NULL."""
    return F.nullif(F.regexp_extract(text, r"\b(\d{4})\b", 1), F.lit(""))


def config_map(text: Column) -> Column:
    """``k=v;k=v`` text to a map with trimmed keys and values; parts without ``=`` are ignored."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), ";"), lambda part: part.contains("="))
    pairs = F.transform(
        parts,
        lambda part: F.struct(
            F.trim(F.substring_index(part, "=", 1)).alias("k"),
            F.trim(F.substr(part, F.instr(part, "=") + F.lit(1))).alias("v"),
        ),
    )
    # A repeated key keeps its last value: a pair is dropped when its key comes again later.
    last_only = F.filter(
        pairs,
        lambda pair, i: ~F.exists(
            F.slice(pairs, i + F.lit(2), F.size(pairs)), lambda later: later["k"] == pair["k"]
        ),
    )
    return F.map_from_entries(last_only)


def _visible(html: Column, joint: str) -> Column:
    text = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", joint)
    for entity, char in (
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"),
    ):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.regexp_replace(F.regexp_replace(text, r"\s+", " "), r"(?U)\A\s+|\s+\z", "")


def strip_tags(html: Column) -> Column:
    """Visible text of an HTML fragment with the common entities decoded; a tag parts words."""
    return _visible(html, " ")


def cell_text(html: Column) -> Column:
    """The same, with the texts around inner tags joined without a blank."""
    return _visible(html, "")

"""Registered queries: prompt text and response parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from barflow.functions import prompts as P
from barflow.operators.retrieval import context_text
from barflow.plans import inputs as I
from barflow.plans.inputs import sql
from barflow.plans.registry import query


def _q(text: str) -> str:
    """SQL literal, line breaks included."""
    return "'" + text.replace("'", "''") + "'"


def _fill(template: str, values: dict[str, str]) -> str:
    """SQL concatenation of a template with SQL expressions for its placeholders."""
    out, rest = [], template
    while "{" in rest:
        text, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        if text:
            out.append(_q(text))
        out.append(values[name])
    if rest:
        out.append(_q(rest))
    return " || ".join(out)


def _named(name: str, digits: int) -> str:
    return f"'{name}: ' || printf('%.{digits}f', CAST({name} AS DOUBLE))"


_SHOWN = ("SMA_20", "SMA_50", "BB_upper", "BB_lower", "Price_change", "Price_change_5d")
_LINE = "concat_ws(' | ', " + ", ".join(
    [_named(c, 2) for c in ("Open", "High", "Low", "Close", "Volume")] + [_named(c, 4) for c in _SHOWN]
) + ")"
# Band edges come from sums in different order, so a text shows them only at fewer digits.
_FEATURES = {
    "fx": "SELECT symbol, date, Open, High, Low, Close, Volume, round(SMA_20, 6) AS SMA_20, round(SMA_50, 6) AS SMA_50, round(BB_upper, 3) AS BB_upper, "
    "round(BB_lower, 3) AS BB_lower, round(Price_change, 5) AS Price_change, round(Price_change_5d, 5) AS Price_change_5d FROM features"
}
_KEEP = ["symbol", "date", "Open", "High", "Low", "Close", "Volume", *_SHOWN]


def _features(spark, folder):
    f = I.features(spark, folder).select(*_KEEP)
    digits = {"BB_upper": 3, "BB_lower": 3, "Price_change": 5, "Price_change_5d": 5}
    return f.withColumns({c: I.rounded(c, d) for c, d in digits.items()}).withColumns(
        {c: I.rounded(c, 6) for c in ("SMA_20", "SMA_50")}
    )


@query("g01_feature_text", sql(f"SELECT symbol, date, {_LINE} AS features FROM fx", "features", extra=_FEATURES))
def feature_text(spark, folder):
    f = _features(spark, folder)
    return f.select("symbol", "date", P.feature_text(f.columns).alias("features"))


@query(
    "g02_retrieval_query",
    sql("SELECT symbol, date, symbol || ' ' || CAST(date AS VARCHAR) || ' financial data' AS query FROM bars", "bars"),
)
def retrieval_query(spark, folder):
    return I.bars(spark, folder).select("symbol", "date", P.retrieval_query().alias("query"))


@query(
    "g03_context_text",
    "SELECT conv_id AS query_id, string_agg(text, ' ' ORDER BY turn) AS context FROM conversations GROUP BY conv_id",
)
def joined_context(spark, folder):
    hits = I.table(spark, folder, "conversations").select(
        F.col("conv_id").alias("query_id"), F.col("turn").alias("rank"), "text"
    )
    return context_text(hits)


@query(
    "g04_training_prompt",
    sql(
        f"SELECT n.doc_id, 'Symbol: ' || n.symbol || chr(10) || 'Date: ' || CAST(date AS VARCHAR) || chr(10) || 'Features: Close: ' "
        "|| printf('%.2f', Close) || chr(10) || 'Context: ' || content || chr(10) || "
        f"{_q(P.TRAIN_TASK)} AS prompt FROM news n JOIN bars_1d USING (symbol, date)",
        "news", "bars_1d",
    ),
)
def training_prompt(spark, folder):
    b = I.bars_1d(spark, folder).select("symbol", "date", "Close")
    joined = I.news(spark, folder).join(b, ["symbol", "date"])
    return joined.select("doc_id", P.training_prompt(P.feature_text(["Close"]), F.col("content")).alias("prompt"))


@query(
    "g05_target_label",
    "SELECT doc_id, coalesce(quality, 0) AS from_number, CASE WHEN upper(CASE WHEN quality = 1 THEN 'up' WHEN quality = 0 "
    "THEN 'down' END) IN ('UP', '1', 'TRUE') THEN 1 ELSE 0 END AS from_text FROM documents LEFT JOIN labels USING (doc_id)",
)
def target_label(spark, folder):
    d = I.documents(spark, folder).join(I.table(spark, folder, "labels"), "doc_id", "left")
    d = d.withColumn("word", F.when(F.col("quality") == 1, "up").when(F.col("quality") == 0, "down"))
    return d.select(
        "doc_id",
        P.target_label("quality", d.schema["quality"].dataType).alias("from_number"),
        P.target_label("word", d.schema["word"].dataType).alias("from_text"),
    )


_INFER_LINE = "concat_ws(' | ', 'sector: ' || sector, 'market_cap: ' || printf('%.4f', market_cap), 'pe_ratio: ' || printf('%.4f', pe_ratio))"


@query(
    "g07_inference_prompt",
    sql(f"SELECT symbol, 'Symbol: ' || symbol || chr(10) || 'Date: 2024-01-01' || chr(10) || 'Features: ' || {_INFER_LINE} "
        f"|| chr(10) || {_q(P.INFER_TASK)} AS prompt FROM fundamentals", "fundamentals"),
)
def inference_prompt(spark, folder):
    f = I.fundamentals(spark, folder).select("symbol", "sector", "market_cap", "pe_ratio")
    prompt = P.inference_prompt(f.schema, f.columns, today=F.lit("2024-01-01"))
    return f.select("symbol", prompt.alias("prompt"))


def _any(words) -> str:
    return " OR ".join(f"contains(upper(response), '{w}')" for w in words)


_DIR = f"CASE WHEN {_any(P.UP_WORDS)} THEN 'UP' WHEN {_any(P.DOWN_WORDS)} THEN 'DOWN' ELSE 'UNKNOWN' END"


@query("g08_parse_direction", sql(f"SELECT id, {_DIR} AS direction FROM responses", "responses"))
def parse_direction(spark, folder):
    return I.responses(spark, folder).select("id", P.parse_direction("response").alias("direction"))


def _any_word(words) -> str:
    return " OR ".join(f"regexp_matches(upper(response), '\\b{w}\\b')" for w in words)


@query(
    "g08_parse_direction_whole_word",
    sql(f"SELECT id, CASE WHEN {_any_word(P.UP_WORDS)} THEN 'UP' WHEN {_any_word(P.DOWN_WORDS)} THEN 'DOWN' ELSE 'UNKNOWN' END "
        "AS direction FROM responses", "responses"),
)
def parse_direction_whole_word(spark, folder):
    return I.responses(spark, folder).select("id", P.parse_direction("response", True).alias("direction"))


_CONF = "CASE " + " ".join(f"WHEN {_any([w])} THEN '{w}'" for w in P.CONFIDENCE_WORDS) + " ELSE 'MEDIUM' END"


@query("g09_parse_confidence", sql(f"SELECT id, {_CONF} AS confidence FROM responses", "responses"))
def parse_confidence(spark, folder):
    return I.responses(spark, folder).select("id", P.parse_confidence("response").alias("confidence"))


@query(
    "g10_parse_explanation",
    sql("SELECT id, trim(response, ' ' || chr(10)) AS explanation FROM responses", "responses"),
)
def parse_explanation(spark, folder):
    return I.responses(spark, folder).select("id", P.parse_explanation("response").alias("explanation"))


_TEMPLATE = "CASE {col} " + " ".join(f"WHEN '{k}' THEN {_q(v)}" for k, v in P.TEMPLATES.items()) + f" ELSE {_q(P.TEMPLATES[P.BASE])} END"
_KINDS = ("direction", "price", "volatility", "news_impact", "sector_analysis", "earnings", "risk_assessment", "none")


@query(
    "g11_get_template",
    "SELECT event_id, " + _TEMPLATE.replace("{col}", f"({list(_KINDS)})[event_id % 8 + 1]") + " AS template FROM events",
)
def get_template(spark, folder):
    e = I.table(spark, folder, "events")
    kind = F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (F.col("event_id") % 8 + 1).cast("int"))
    return e.select("event_id", P.template_text(kind).alias("template"))


_BASE_VALUES = {
    "symbol": "symbol",
    "date": "CAST(date AS VARCHAR)",
    "current_price": "CAST(Close AS VARCHAR)",
    "context": _q(P.NO_CONTEXT),
    "features": _q(P.NOT_AVAILABLE),
    "technical_indicators": _q(P.NOT_AVAILABLE),
    "task_instruction": _q(P.DEFAULT_TEXTS["task_instruction"]),
}


@query(
    "g12_format_template",
    sql(f"SELECT symbol, date, {_fill(P.TEMPLATES[P.BASE], _BASE_VALUES)} AS prompt FROM bars", "bars"),
)
def format_template(spark, folder):
    b = I.bars(spark, folder)
    return b.select("symbol", "date", P.format_template("base", symbol=F.col("symbol"), date=F.col("date")).alias("prompt"))


_NUMBERS = "'Open: ' || printf('%.4f', Open) || ', High: ' || printf('%.4f', High)"
_PLAIN = "'Low: ' || CAST(Low AS VARCHAR) || ', Volume: ' || CAST(Volume AS VARCHAR)"


def _numbers():
    return F.create_map(F.lit("Open"), F.col("Open"), F.lit("High"), F.col("High"))


def _plain():
    return F.create_map(F.lit("Low"), F.col("Low").cast("string"), F.lit("Volume"), F.col("Volume").cast("string"))


@query("g13_number_list", sql(f"SELECT symbol, date, {_NUMBERS} AS text FROM bars", "bars"))
def number_list(spark, folder):
    return I.bars(spark, folder).select("symbol", "date", P.number_list(_numbers()).alias("text"))


@query("g14_plain_list", sql(f"SELECT symbol, date, {_PLAIN} AS text FROM bars", "bars"))
def plain_list(spark, folder):
    return I.bars(spark, folder).select("symbol", "date", P.plain_list(_plain()).alias("text"))


def _built(name: str, **values: str) -> str:
    return sql(f"SELECT symbol, date, {_fill(P.TEMPLATES[name], {**_BASE_VALUES, **values})} AS prompt FROM bars", "bars")


def _build(column):
    def run(spark, folder):
        return I.bars(spark, folder).select("symbol", "date", column().alias("prompt"))

    return run


query("g15_direction_prompt", _built("direction", technical_indicators=_NUMBERS, context="'Trend of ' || symbol"))(
    _build(
        lambda: P.direction_prompt(
            "symbol", "Close", _numbers(), F.concat(F.lit("Trend of "), F.col("symbol")), F.col("date")
        )
    )
)
query("g16_price_prompt", _built("price", technical_indicators=_NUMBERS))(
    _build(lambda: P.price_prompt("symbol", "Close", _numbers(), F.lit(""), F.col("date")))
)
query("g17_news_impact_prompt", _built("news_impact", news_summary="'News on ' || symbol"))(
    _build(
        lambda: P.news_impact_prompt(
            "symbol", "Close", F.concat(F.lit("News on "), F.col("symbol")), None, F.col("date")
        )
    )
)
query("g18_earnings_prompt", _built("earnings", expected_earnings=_PLAIN, historical_performance=_PLAIN))(
    _build(lambda: P.earnings_prompt("symbol", "Close", _plain(), _plain(), None, F.col("date")))
)
query("g19_risk_prompt", _built("risk_assessment", financial_metrics=_NUMBERS))(
    _build(lambda: P.risk_prompt("symbol", "Close", _numbers(), None, F.col("date")))
)
query("g20_custom_volatility_prompt", _built("volatility", recent_volatility="printf('%.2f', High - Low)"))(
    _build(
        lambda: P.custom_prompt(
            "volatility",
            symbol=F.col("symbol"),
            date=F.col("date"),
            current_price=F.col("Close"),
            recent_volatility=P.fixed(F.col("High") - F.col("Low"), 2),
        )
    )
)
query(
    "g20_custom_sector_prompt",
    sql(
        "SELECT sector, "
        + _fill(
            P.TEMPLATES["sector_analysis"],
            {**_BASE_VALUES, "date": "'2024-01-01'", "sector": "sector", "sector_performance": "CAST(n AS VARCHAR)", "key_stocks": "first_symbol"},
        )
        + " AS prompt FROM (SELECT sector, count(*) AS n, min(symbol) AS first_symbol FROM fundamentals GROUP BY sector)",
        "fundamentals",
    ),
)(
    lambda spark, folder: I.fundamentals(spark, folder)
    .groupBy("sector")
    .agg(F.count(F.lit(1)).alias("n"), F.min("symbol").alias("first_symbol"))
    .select(
        "sector",
        P.custom_prompt(
            "sector_analysis",
            sector=F.col("sector"),
            date="2024-01-01",
            sector_performance=F.col("n"),
            key_stocks=F.col("first_symbol"),
        ).alias("prompt"),
    )
)

_TEXTS = "SELECT item_id, {expr} AS prompt FROM benchmark"


def _vary(kind: str, **options):
    def run(spark, folder):
        b = I.table(spark, folder, "benchmark")
        return b.select("item_id", P.optimize_prompt("text", kind, **{k: v() for k, v in options.items()}).alias("prompt"))

    return run


def _examples():
    one = F.struct(F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("input"), F.lit("UP").alias("output"))
    two = F.struct(F.lit("flat volume").alias("input"), F.lit("DOWN").alias("output"))
    return F.array(one, two)


_SHOTS = (
    "text || chr(10) || chr(10) || 'Examples:' || chr(10) || 'Example 1:' || chr(10) || 'Input: item ' || item_id || chr(10) "
    "|| 'Output: UP' || chr(10) || chr(10) || 'Example 2:' || chr(10) || 'Input: flat volume' || chr(10) || 'Output: DOWN' || chr(10) || chr(10)"
)
query("g22_few_shot", _TEXTS.format(expr=_SHOTS))(_vary("few_shot", examples=_examples))
query("g23_chain_of_thought", _TEXTS.format(expr=f"text || {_q(P.STEP_BY_STEP)}"))(_vary("chain_of_thought"))
_ROLE = "'Take the part of a seasoned {role} and judge from the data below.' || chr(10) || chr(10) || text"
query("g24_role_play", _TEXTS.format(expr=_ROLE.format(role="financial analyst")))(_vary("role_playing"))
query("g21_optimize_prompt_role", _TEXTS.format(expr=_ROLE.format(role="risk manager")))(
    _vary("role_playing", role=lambda: "risk manager")
)
query(
    "g25_constraints",
    _TEXTS.format(expr="text || chr(10) || chr(10) || 'Constraints:' || chr(10) || '- be brief' || chr(10) || '- item ' || item_id || chr(10)"),
)(
    _vary(
        "constraints",
        items=lambda: F.array(F.lit("be brief"), F.concat(F.lit("item "), F.col("item_id").cast("string"))),
    )
)

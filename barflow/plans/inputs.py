"""Market tables derived from the given tables, in Spark and as SQL of the same meaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.operators.indicators import pct_change, technical_indicators
from barflow.operators.series import cut_blocks, dealt
from barflow.session import materialize, spread
from barflow.sources.market import resample_ohlcv

TRADE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
EVENT_SYMBOLS = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def rounded(x: str | Column, digits: int) -> Column:
    """``round`` as the SQL computes it: the scaled double to the nearest whole number, halves away from zero; a zero keeps its sign.

    Spark rounds the shortest decimal text instead, which differs where a double lies beside a half.
    """
    value, scale = F.col(x) if isinstance(x, str) else x, float(10**digits)
    return F.signum(value) * (F.round(F.abs(value) * scale) / scale)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"), "doc_id")


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return e.select(F.col("event_type").alias("symbol"), "ts", F.col("value").alias("price"), F.col("event_id").alias("id"))


def bars_1d(spark: SparkSession, folder: str) -> DataFrame:
    return resample_ohlcv(ticks(spark, folder), "1d")


def bars_1h(spark: SparkSession, folder: str) -> DataFrame:
    return resample_ohlcv(ticks(spark, folder), "1h")


def trades(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as trades: one symbol per supplier, a unit price in whole cents and a total order
    within a day."""
    li = table(spark, folder, "lineitem")
    found = li.select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.to_date("l_shipdate").alias("ts"),
        (F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")) / 100).alias("price"),
        F.col("l_quantity").alias("size"),
        *TRADE_ORDER,
    )
    return dealt(spread(found, "symbol", "ts"), li.count(), "symbol", "ts")


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars of all suppliers, stored, as the operators read them more than once; grows with the data."""
    return materialize(resample_ohlcv(trades(spark, folder), "1d", volume="size", order=TRADE_ORDER))


def bars_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars with leading empty rows, gaps in Close and Volume, and outliers."""
    b = bars(spark, folder)
    day = F.dayofmonth("date")
    early = F.col("date") < F.lit("1995-02-01").cast("date")
    close = F.when(day % 7 == 3, None).when(day == 10, F.col("Close") * 50).otherwise(F.col("Close"))
    volume = F.when(day % 5 == 1, None).otherwise(F.col("Volume"))
    out = b.withColumn("Close", close).withColumn("Volume", volume)
    return out.withColumns(
        {c: F.when(early, None).otherwise(F.col(c)) for c in ("Open", "High", "Low", "Close", "Volume")}
    )


def news(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    labels = table(spark, folder, "labels")
    symbol = F.element_at(F.array(*[F.lit(s) for s in EVENT_SYMBOLS]), (F.col("doc_id") % 5 + 1).cast("int"))
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        symbol.alias("symbol"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.expr("cast(2 * ((doc_id div 5) % 15) as int)")).alias("date"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("content"),
        "source",
        (F.col("quality") - F.col("toxic")).cast("double").alias("sentiment"),
    )


def bar_news(spark: SparkSession, folder: str) -> DataFrame:
    """The same news for the symbols and days of ``bars``."""
    suppliers = table(spark, folder, "supplier").agg(F.count(F.lit(1))).scalar()
    day = F.date_add(F.lit("1995-01-02").cast("date"), F.expr("cast((doc_id * 7) % 2400 as int)"))
    return news(spark, folder).withColumns(
        {"symbol": (F.col("doc_id") % suppliers + 1).cast("string"), "date": day}
    )


def fundamentals(spark: SparkSession, folder: str) -> DataFrame:
    s, n, r = (table(spark, folder, t) for t in ("supplier", "nation", "region"))
    li = table(spark, folder, "lineitem")
    year, amount = F.year("l_shipdate"), F.col("l_extendedprice")
    growth = li.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        (
            F.try_divide(F.sum(F.when(year == 1997, amount)), F.sum(F.when(year == 1996, amount))) - 1
        ).alias("growth")
    )
    joined = s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.join(growth, "s_suppkey", "left").select(
        F.col("s_suppkey").cast("string").alias("symbol"),
        F.col("r_name").alias("sector"),
        F.col("n_name").alias("industry"),
        F.col("s_acctbal").alias("market_cap"),
        F.when(F.col("s_suppkey") % 10 != 0, rounded(F.col("s_acctbal") / 100, 2)).alias("pe_ratio"),
        rounded("growth", 4).alias("revenue_growth"),
    )


def raw_info(spark: SparkSession, folder: str) -> DataFrame:
    """Fundamentals in provider form: one map of texts per symbol."""
    f = fundamentals(spark, folder)
    pairs: list[Column] = []
    for key, c in (("sector", "sector"), ("industry", "industry"), ("marketCap", "market_cap"), ("trailingPE", "pe_ratio")):
        pairs += [F.lit(key), F.col(c).cast("string")]
    return f.select("symbol", F.create_map(*pairs).alias("info"))


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "embeddings")
    return e.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vec"), "label")


def vector_queries(spark: SparkSession, folder: str) -> DataFrame:
    """One query per label: the mean vector of its members."""
    v = vectors(spark, folder)
    parts = v.select("label", F.posexplode("vec").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"].cast("float"))
    return means.groupBy("label").agg(listed.alias("vec")).select(F.col("label").cast("bigint").alias("query_id"), "vec")


def labels_conf(spark: SparkSession, folder: str) -> DataFrame:
    li = table(spark, folder, "lineitem")
    return li.select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y_true"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("y_pred"),
        (F.col("l_discount") * 10).alias("confidence"),
    )


def class_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Two class scores and a label; the label is masked where the flag is N."""
    li = table(spark, folder, "lineitem")
    return li.select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.array(F.col("l_tax") * 20, F.col("l_discount") * 20).alias("scores"),
        F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0).otherwise(-100).alias("label"),
    )


def price_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Close as truth and the close before as prediction; the first bar of a symbol has none."""
    b = bars(spark, folder).select("symbol", "date", "Close")
    blocks = cut_blocks(b, ["symbol"], "date", 1, 0)
    blocks = blocks.with_columns({"y_pred": F.lag("Close", 1).over(blocks.window)})
    return blocks.result().where(F.col("y_pred").isNotNull()).select(
        "symbol", "date", F.col("Close").alias("y_true"), "y_pred"
    )


def returns(spark: SparkSession, folder: str) -> DataFrame:
    """Daily returns, divided by ten to keep compounding in range."""
    b = bars(spark, folder).select("symbol", "date", "Close")
    blocks = cut_blocks(b, ["symbol"], "date", 1, 0)
    blocks = blocks.with_columns({"ret": pct_change(blocks, "Close", 1) / 10})
    return blocks.result().where(F.col("ret").isNotNull()).select("symbol", "date", "ret")


def responses(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    view = (
        F.when(F.col("o_orderstatus") == "F", "Direction: down")
        .when(F.col("o_orderstatus") == "O", "prices should rise")
        .otherwise("no view")
    )
    extra = F.when(F.col("o_orderkey") % 11 == 0, " - finds support ").otherwise(" \n")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("  "), view, F.lit(", confidence "), F.col("o_orderpriority"), extra).alias("response"),
        F.when(F.col("o_totalprice") > 150000, 1).otherwise(0).alias("y_true"),
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a metric log: one experiment per user, one metric per event type."""
    e = table(spark, folder, "events")
    return e.select(
        F.col("user_id").cast("string").alias("experiment"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 17 != 0, F.expr("event_id div 100")).alias("step"),
        "ts",
        F.col("event_type").alias("name"),
        "value",
    )


def run_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a status: purchases complete a run, errors fail it, all others say that it goes on."""
    e = table(spark, folder, "events")
    kind = F.col("event_type")
    status = F.when(kind == "purchase", "completed").when(kind == "error", "failed").otherwise("running")
    return e.select(F.col("user_id").cast("string").alias("experiment"), "ts", status.alias("status"))


def features(spark: SparkSession, folder: str) -> DataFrame:
    """Bars with the indicators that prompts and models read, rounded where a text shows them."""
    b = bars(spark, folder)
    return technical_indicators(b, ["SMA_20", "SMA_50", "BB_upper", "BB_lower", "Price_change", "Price_change_5d"])


# --- the same as SQL -----------------------------------------------------------------------------

_SEQ = f"row({', '.join(TRADE_ORDER)})"


def _resampled(source: str, bucket: str, price: str, order: str, volume: str, symbol: str) -> str:
    return (
        f"SELECT {symbol} AS symbol, {bucket} AS date, arg_min({price}, {order}) AS Open, max({price}) AS High, "
        f"min({price}) AS Low, arg_max({price}, {order}) AS Close, CAST({volume} AS BIGINT) AS Volume "
        f"FROM {source} GROUP BY 1, 2"
    )


_EV = ("events", "value", "ts", "count(*)", "event_type")
SQL = {
    "bars_1d": _resampled(_EV[0], "CAST(ts AS DATE)", *_EV[1:]),
    "bars_1h": _resampled(_EV[0], "date_trunc('hour', ts)", *_EV[1:]),
    "bars": _resampled(
        "lineitem",
        "CAST(l_shipdate AS DATE)",
        "floor(l_extendedprice * 100 / l_quantity) / 100",
        _SEQ,
        "sum(l_quantity)",
        "CAST(l_suppkey AS VARCHAR)",
    ),
    "bars_gaps": """SELECT symbol, date,
        CASE WHEN date >= DATE '1995-02-01' THEN Open END AS Open,
        CASE WHEN date >= DATE '1995-02-01' THEN High END AS High,
        CASE WHEN date >= DATE '1995-02-01' THEN Low END AS Low,
        CASE WHEN date < DATE '1995-02-01' OR day(date) % 7 = 3 THEN NULL
             WHEN day(date) = 10 THEN Close * 50 ELSE Close END AS Close,
        CASE WHEN date >= DATE '1995-02-01' AND day(date) % 5 <> 1 THEN Volume END AS Volume
        FROM bars""",
    "filled": """SELECT symbol, date, """
    + ", ".join(
        f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in ("Open", "High", "Low", "Close", "Volume")
    )
    + " FROM bars_gaps WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)",
    "news": """SELECT d.doc_id, (['click','error','purchase','signup','view'])[d.doc_id % 5 + 1] AS symbol,
        DATE '2024-01-01' + CAST(2 * ((d.doc_id // 5) % 15) AS INT) AS date, split_part(text, chr(10), 1) AS title,
        text AS content, source, CAST(quality - toxic AS DOUBLE) AS sentiment
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "bar_news": """SELECT doc_id, CAST(doc_id % (SELECT count(*) FROM supplier) + 1 AS VARCHAR) AS symbol,
        DATE '1995-01-02' + CAST((doc_id * 7) % 2400 AS INT) AS date, title, content, source, sentiment FROM news""",
    "fundamentals": """SELECT CAST(s_suppkey AS VARCHAR) AS symbol, r_name AS sector, n_name AS industry,
        s_acctbal AS market_cap, CASE WHEN s_suppkey % 10 <> 0 THEN round(s_acctbal / 100, 2) END AS pe_ratio,
        round(growth, 4) AS revenue_growth
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN (SELECT l_suppkey,
            sum(CASE WHEN year(l_shipdate) = 1997 THEN l_extendedprice END)
            / nullif(sum(CASE WHEN year(l_shipdate) = 1996 THEN l_extendedprice END), 0) - 1 AS growth
            FROM lineitem GROUP BY 1) g ON s_suppkey = l_suppkey""",
    "vectors": "SELECT vec_id AS doc_id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings",
    "vector_queries": """SELECT CAST(label AS BIGINT) AS query_id, list(CAST(CAST(x AS FLOAT) AS DOUBLE) ORDER BY i) AS vec FROM (
        SELECT label, i, avg(vec[i]) AS x FROM vectors, unnest(range(1, len(vec) + 1)) AS u(i) GROUP BY 1, 2)
        GROUP BY 1""",
    "labels_conf": """SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_returnflag = 'R' AS INT) AS y_true,
        CAST(l_linestatus = 'F' AS INT) AS y_pred, l_discount * 10 AS confidence FROM lineitem""",
    "class_scores": """SELECT CAST(l_suppkey AS VARCHAR) AS symbol, l_tax * 20 AS s0, l_discount * 20 AS s1,
        CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 ELSE -100 END AS label FROM lineitem""",
    "price_pairs": """SELECT symbol, date, Close AS y_true, y_pred FROM (
        SELECT symbol, date, Close, lag(Close) OVER (PARTITION BY symbol ORDER BY date) AS y_pred FROM bars)
        WHERE y_pred IS NOT NULL""",
    "returns": """SELECT symbol, date, ret FROM (SELECT symbol, date,
        (Close / lag(Close) OVER (PARTITION BY symbol ORDER BY date) - 1) / 10 AS ret FROM bars)
        WHERE ret IS NOT NULL""",
    "responses": """SELECT o_orderkey AS id, '  ' || CASE o_orderstatus WHEN 'F' THEN 'Direction: down'
        WHEN 'O' THEN 'prices should rise' ELSE 'no view' END || ', confidence ' || o_orderpriority
        || CASE WHEN o_orderkey % 11 = 0 THEN ' - finds support ' ELSE ' ' || chr(10) END AS response,
        CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END AS y_true FROM orders""",
    "runs": """SELECT CAST(user_id AS VARCHAR) AS experiment, event_id AS seq,
        CASE WHEN event_id % 17 <> 0 THEN event_id // 100 END AS step, ts, event_type AS name, value FROM events""",
    "run_events": """SELECT CAST(user_id AS VARCHAR) AS experiment, ts,
        CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'running' END AS status
        FROM events""",
    "features": """SELECT *,
        CASE WHEN count(Close) OVER w20 = 20 THEN avg(Close) OVER w20 END AS SMA_20,
        CASE WHEN count(Close) OVER w50 = 50 THEN avg(Close) OVER w50 END AS SMA_50,
        CASE WHEN count(Close) OVER w20 = 20 THEN avg(Close) OVER w20 + 2 * stddev_pop(Close) OVER w20 END AS BB_upper,
        CASE WHEN count(Close) OVER w20 = 20 THEN avg(Close) OVER w20 - 2 * stddev_pop(Close) OVER w20 END AS BB_lower,
        Close / lag(Close) OVER w - 1 AS Price_change, Close / lag(Close, 5) OVER w - 1 AS Price_change_5d
        FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date),
        w20 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
        w50 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)""",
}
_NEEDS = {
    "bars_gaps": ["bars"],
    "filled": ["bars_gaps"],
    "bar_news": ["news"],
    "vector_queries": ["vectors"],
    "price_pairs": ["bars"],
    "returns": ["bars"],
    "features": ["bars"],
}


def sql(body: str, *names: str, recursive: bool = False, extra: dict[str, str] | None = None) -> str:
    """``body`` behind the named derived tables (and what they need) and any ``extra`` ones."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({SQL[n]})" for n in ordered] + [f"{n} AS ({q})" for n, q in (extra or {}).items()]
    if not parts:
        return body
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {body}"

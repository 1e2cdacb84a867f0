"""Registered queries: joins, splits, sequences, scaling, selection, composites."""

from __future__ import annotations

from pyspark.sql import functions as F

from barflow.functions import prompts
from barflow.operators import assemble, datasets, metrics, news, retrieval, tokens
from barflow.operators.indicators import technical_indicators
from barflow.operators.targets import target_variables
from barflow.plans import inputs as I
from barflow.plans.inputs import sql
from barflow.plans.q_clean import _AGG, _ANY, _BOUNDS, _stats
from barflow.plans.registry import query
from barflow.session import materialize

_W = "OVER (PARTITION BY symbol ORDER BY date)"
_ALL_NEWS = _AGG
_AGG_COLUMNS = (
    "date, symbol, news_count, round(sentiment_mean, 6) AS sentiment_mean, "
    "round(sentiment_std, 6) AS sentiment_std, sentiment_count"
)


@query("e01_news_aggregate", sql(f"SELECT {_AGG_COLUMNS} FROM agg", "news", extra={"agg": _ALL_NEWS}))
def news_aggregate(spark, folder):
    return _stats(news.aggregate_news(news.with_day(I.news(spark, folder))))


@query(
    "e02_left_join_news",
    sql("SELECT symbol, date, Close, news_count, sentiment_count FROM bars_1d LEFT JOIN agg USING (date, symbol)",
        "bars_1d", "news", extra={"agg": _AGG}),
)
def left_join_news(spark, folder):
    daily = news.aggregate_news(I.news(spark, folder))
    joined = news.join_news(I.bars_1d(spark, folder), daily)
    return joined.select("symbol", "date", "Close", "news_count", "sentiment_count")


@query(
    "e03_news_features",
    sql(
        "SELECT symbol, date, Open, High, Low, Close, Volume, coalesce(news_count, 0) AS news_count, "
        "round(coalesce(sentiment_mean, 0), 6) AS sentiment_mean, round(coalesce(sentiment_std, 0), 6) AS sentiment_std, "
        "sentiment_count FROM bars_1d LEFT JOIN agg USING (date, symbol)",
        "bars_1d", "news", extra={"agg": _ALL_NEWS},
    ),
)
def news_features(spark, folder):
    out = news.news_features(I.news(spark, folder), I.bars_1d(spark, folder))
    return out.withColumns({c: F.round(c, 6) for c in ("sentiment_mean", "sentiment_std")})


@query(
    "e04_concat_tables",
    sql("SELECT symbol, date, Close, Volume, NULL::DOUBLE AS sentiment FROM bars_1d UNION ALL BY NAME "
        "SELECT symbol, date, sentiment FROM news", "bars_1d", "news"),
)
def concat_tables(spark, folder):
    return news.concat_tables(
        [
            I.bars_1d(spark, folder).select("symbol", "date", "Close", "Volume"),
            I.news(spark, folder).select("symbol", "date", "sentiment"),
        ]
    )


@query(
    "e05_align_contexts",
    "SELECT d.doc_id AS sample_id, d.source, b.text AS context FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id",
)
def align_contexts(spark, folder):
    samples = I.documents(spark, folder).select(F.col("doc_id").alias("sample_id"), "source")
    contexts = I.table(spark, folder, "benchmark").select(F.col("item_id").alias("sample_id"), F.col("text").alias("context"))
    return retrieval.align_contexts(samples, contexts)


_BENCH = {"b": "SELECT date, avg(ret) AS bench FROM returns GROUP BY date"}


@query(
    "e07_paired_returns",
    sql("SELECT date, round(s.ret, 8) AS ret, round(b.bench, 8) AS bench FROM s JOIN b USING (date)",
        "returns", extra={**_BENCH, "s": "SELECT date, max(ret) AS ret FROM returns GROUP BY date"}),
)
def paired_returns(spark, folder):
    r = I.returns(spark, folder)
    strategy = r.groupBy("date").agg(F.max("ret").alias("ret"))
    benchmark = r.groupBy("date").agg(F.avg("ret").alias("bench"))
    pairs = metrics.paired_returns(strategy, benchmark, ["date"])
    return pairs.select("date", F.round("ret", 8).alias("ret"), F.round("bench", 8).alias("bench"))


@query(
    "e08_predictions_with_truth",
    sql("SELECT symbol, date, y_true, y_pred FROM price_pairs", "price_pairs"),
)
def predictions_with_truth(spark, folder):
    b = I.bars(spark, folder)
    truth = b.select("symbol", "date", F.col("Close").alias("y_true"))
    return truth.join(I.price_pairs(spark, folder).select("symbol", "date", "y_pred"), ["symbol", "date"])


# --- splits --------------------------------------------------------------------------------------

_PART = "CASE WHEN pos < CAST(floor(n * {p}::DOUBLE) AS BIGINT) THEN 'train' ELSE 'test' END"
_TARGETS = f"SELECT * FROM (SELECT symbol, date, Close, lead(Close) {_W} / Close - 1 AS t FROM bars) WHERE t IS NOT NULL"


def _with_target(spark, folder):
    t = target_variables(I.bars(spark, folder).select("symbol", "date", "Close"), [1])
    return t.withColumnRenamed("price_change_1d", "t")


@query(
    "f01_split_global_time",
    sql(f"SELECT symbol, date, {_PART.format(p='(1 - 0.2::DOUBLE)')} AS split FROM p JOIN d USING (date)", "bars",
        extra={"p": _TARGETS, "d": "SELECT date, sum(count(*)) OVER (ORDER BY date) - count(*) AS pos, "
               "sum(count(*)) OVER () AS n FROM p GROUP BY date"}),
)
def split_global_time(spark, folder):
    return assemble.prepare_dataset(_with_target(spark, folder), "t").select("symbol", "date", "split")


@query(
    "f01_split_by_position",
    sql(f"SELECT symbol, date, {_PART.format(p='(1 - 0.2::DOUBLE)')} AS split FROM (SELECT symbol, date, "
        "row_number() OVER (ORDER BY symbol, date) - 1 AS pos, count(*) OVER () AS n FROM p)", "bars", extra={"p": _TARGETS}),
)
def split_by_position(spark, folder):
    out = assemble.prepare_dataset(_with_target(spark, folder), "t", mode="position")
    return out.select("symbol", "date", "split")


@query(
    "f01_split_per_symbol",
    sql(f"SELECT symbol, date, {_PART.format(p='(1 - 0.2::DOUBLE)')} AS split FROM (SELECT symbol, date, "
        f"row_number() {_W} - 1 AS pos, count(*) OVER (PARTITION BY symbol) AS n FROM p)", "bars", extra={"p": _TARGETS}),
)
def split_per_symbol(spark, folder):
    out = assemble.prepare_dataset(_with_target(spark, folder), "t", mode="per_symbol_time", block_rows=100)
    return out.select("symbol", "date", "split")


@query(
    "f02_three_way_split",
    sql("SELECT symbol, date, CASE WHEN pos < a THEN 'train' WHEN pos < a + b THEN 'val' ELSE 'test' END AS split FROM ("
        "SELECT symbol, date, pos, CAST(floor(n * 0.7::DOUBLE) AS BIGINT) AS a, CAST(floor(n * 0.15::DOUBLE) AS BIGINT) AS b "
        "FROM (SELECT symbol, date, row_number() OVER (ORDER BY symbol, date) - 1 AS pos, count(*) OVER () AS n FROM bars))",
        "bars"),
)
def three_way_split(spark, folder):
    out = assemble.three_way_split(I.bars(spark, folder).select("symbol", "date"), mode="position")
    return out.select("symbol", "date", "split")


@query(
    "f03_create_sequences",
    sql("SELECT symbol, date, array_to_string(list_transform(X, lambda v: printf('%.2f', v)), ',') AS X, Close AS y FROM ("
        "SELECT symbol, date, Close, row_number() OVER w AS rn, list(Close) OVER (PARTITION BY symbol ORDER BY date "
        "ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS X FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)) "
        "WHERE rn > 30", "bars"),
)
def create_sequences(spark, folder):
    out = assemble.create_sequences(I.bars(spark, folder), block_rows=200)
    text = F.array_join(F.transform("X", lambda v: prompts.fixed(v, 2)), ",")
    return out.select("symbol", "date", text.alias("X"), "y")


_SCALED = ("Open", "High", "Low", "Close", "Volume")


def _scaled_sql(kind: str) -> str:
    if kind == "standard":
        expr = "({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1)"
    else:
        expr = "({c} - min({c}) OVER ()) / coalesce(nullif(max({c}) OVER () - min({c}) OVER (), 0), 1)"
    parts = ", ".join(f"round({expr.format(c=f'CAST({c} AS DOUBLE)')}, 6) AS {c}" for c in _SCALED)
    return sql(f"SELECT symbol, date, {parts} FROM bars", "bars")


def _scale(kind: str):
    def run(spark, folder):
        out = assemble.scale_features(I.bars(spark, folder), _SCALED, kind)
        return out.select("symbol", "date", *[F.round(c, 6).alias(c) for c in _SCALED])

    return run


query("f04_scale_standard", _scaled_sql("standard"))(_scale("standard"))
query("f05_scale_minmax", _scaled_sql("minmax"))(_scale("minmax"))


@query(
    "f06_fitted_scaler_reused",
    sql("SELECT symbol, date, round((Close - m) / s, 6) AS Close FROM bars_1d, (SELECT avg(Close) AS m, stddev_pop(Close) AS s "
        "FROM bars_1h)", "bars_1d", "bars_1h"),
)
def fitted_scaler_reused(spark, folder):
    params = assemble.fit_scaler(I.bars_1h(spark, folder), ["Close"])
    out = assemble.apply_scaler(I.bars_1d(spark, folder), params)
    return out.select("symbol", "date", F.round("Close", 6).alias("Close"))


_CANDIDATES = ("Open", "High", "Low", "Volume", "SMA_20", "SMA_50", "BB_upper", "BB_lower", "Price_change", "Price_change_5d")
_SCORES = (
    "SELECT feature, idx, r * r / (1 - r * r) * (n - 2) AS score FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {i} AS idx, corr({c}, Close) AS r, count({c}) FILTER (WHERE Close IS NOT NULL) AS n FROM features"
        for i, c in enumerate(_CANDIDATES)
    )
    + ")"
)
_RANKED = "SELECT *, row_number() OVER (ORDER BY score DESC, idx DESC) AS rank FROM s"


@query(
    "f08_feature_scores",
    sql("SELECT feature, CAST(idx AS INT) AS idx, round(score, 2) AS score, CAST(rank AS INT) AS rank, rank <= 4 AS selected FROM k",
        "features", extra={"s": _SCORES, "k": _RANKED}),
)
def feature_scores(spark, folder):
    out = assemble.feature_scores(I.features(spark, folder), _CANDIDATES, "Close", 4)
    return out.withColumn("score", F.round("score", 2))


@query(
    "f07_select_features",
    sql("SELECT symbol, date, u.feature, round(u.value, 6) AS value FROM (UNPIVOT (SELECT symbol, date, "
        + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _CANDIDATES) + " FROM features) ON "
        + ", ".join(_CANDIDATES) + " INTO NAME feature VALUE value) u JOIN k ON k.feature = u.feature WHERE k.rank <= 4",
        "features", extra={"s": _SCORES, "k": _RANKED}),
)
def select_features(spark, folder):
    out = assemble.select_features(I.features(spark, folder), _CANDIDATES, "Close", 4)
    kept = [c for c in out.columns if c not in ("symbol", "date", "Close")]
    values = out.select("symbol", "date", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in kept])
    return values.unpivot(["symbol", "date"], kept, "feature", "value").where("value IS NOT NULL")


@query(
    "f09_feature_map",
    sql("SELECT symbol, date, 'Open: ' || printf('%.4f', Open) || ', Close: ' || printf('%.4f', Close) AS features FROM bars",
        "bars"),
)
def feature_map(spark, folder):
    b = I.bars(spark, folder).withColumn("m", assemble.feature_map(["Open", "Close"]))
    return b.select("symbol", "date", prompts.number_list("m").alias("features"))


@query(
    "f10_mini_batches_in_order",
    "SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 4 AS batch_id, "
    "CAST((row_number() OVER (ORDER BY event_id) - 1) % 4 AS INT) AS batch_pos FROM events",
)
def mini_batches_in_order(spark, folder):
    return assemble.mini_batches(I.table(spark, folder, "events").select("event_id"), "event_id")


@query(
    "f10_mini_batches_shuffled",
    "SELECT event_id, pos // 4 AS batch_id, CAST(pos % 4 AS INT) AS batch_pos FROM (SELECT event_id, "
    "row_number() OVER (ORDER BY md5('42/' || CAST(event_id AS VARCHAR)), event_id) - 1 AS pos FROM events)",
)
def mini_batches_shuffled(spark, folder):
    return assemble.mini_batches(I.table(spark, folder, "events").select("event_id"), "event_id", seed=42)


@query(
    "f11_first_sample",
    sql("SELECT symbol, date, Close FROM (SELECT symbol, date, Close, row_number() OVER (ORDER BY symbol, date) - 1 AS pos, "
        "count(*) OVER () AS n FROM bars) WHERE pos = CAST(floor(n * 0.7::DOUBLE) AS BIGINT)", "bars"),
)
def first_sample(spark, folder):
    out = assemble.three_way_split(I.bars(spark, folder).select("symbol", "date", "Close"), mode="position")
    return assemble.first_sample(out, "val").select("symbol", "date", "Close")


_PROMPT = (
    "'Symbol: ' || symbol || chr(10) || 'Date: ' || CAST(date AS VARCHAR) || chr(10) || 'Features: Close: ' || "
    "printf('%.2f', Close) || ' | Volume: ' || printf('%.2f', Volume::DOUBLE) || chr(10) || "
    f"'{prompts.TRAIN_TASK.replace(chr(39), chr(39) * 2)}'"
)


@query(
    "f12_prepare_datasets",
    sql("SELECT symbol, date, prompt, label, split, known, CAST(sum_ids AS BIGINT) AS sum_ids FROM s JOIN t USING (symbol, date)",
        "bars",
        extra={
            "s": f"SELECT symbol, date, {_PROMPT} AS prompt, CAST(coalesce(lead(Close) {_W} > Close, false) AS INT) AS label, "
            "CASE WHEN pos < a THEN 'train' WHEN pos < a + b THEN 'val' ELSE 'test' END AS split FROM (SELECT *, "
            "row_number() OVER (ORDER BY symbol, date) - 1 AS pos, CAST(floor(count(*) OVER () * 0.7::DOUBLE) AS BIGINT) AS a, "
            "CAST(floor(count(*) OVER () * 0.15::DOUBLE) AS BIGINT) AS b FROM bars)",
            "w": r"SELECT symbol, date, unnest(list_filter(regexp_split_to_array(prompt, '[ \t\n\r\f\v]+'), lambda w: w <> '')) AS token FROM s",
            "v": "SELECT token, row_number() OVER (ORDER BY n DESC, token) + 1 AS token_id FROM (SELECT token, count(*) AS n "
            "FROM w GROUP BY token ORDER BY n DESC, token LIMIT 500)",
            "t": "SELECT symbol, date, count(token_id) AS known, sum(coalesce(token_id, 1)) AS sum_ids "
            "FROM w LEFT JOIN v USING (token) GROUP BY ALL",
        }),
)
def prepare_datasets(spark, folder):
    t = target_variables(I.bars(spark, folder).select("symbol", "date", "Close", "Volume"), [1])
    parts = assemble.three_way_split(t, mode="position")
    # The prompts are stored, as the vocabulary and the ids both read them.
    samples = materialize(datasets.prepare_datasets(parts, features=["Close", "Volume"]))
    out = tokens.tokenize(samples, "symbol", "prompt", tokens.vocabulary(samples, "prompt", 500))
    # The mask says where the padding begins; its zeros add nothing to either figure.
    ids = F.slice("input_ids", 1, F.size(F.array_remove("attention_mask", 0)))
    out = out.withColumn("ids", ids)
    known = F.size(F.filter("ids", lambda i: i > tokens.UNKNOWN_ID)).cast("bigint")
    return out.select(
        "symbol", "date", "prompt", "label", "split", known.alias("known"),
        F.aggregate("ids", F.lit(0).cast("bigint"), lambda s, i: s + i).alias("sum_ids"),
    )


_CLEAN_EXPR = ", ".join(
    f"CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi ELSE CAST({c} AS DOUBLE) END AS {c}" for c in _SCALED
)
_SMA = "(PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"
_SMA_50 = _SMA.replace("19 PRECEDING", "49 PRECEDING")


@query(
    "f13_prepare_data",
    sql(
        "SELECT symbol, split, count(*) AS samples, CAST(sum(up1) AS BIGINT) AS ups, CAST(sum(up5) AS BIGINT) AS ups_5d, "
        "CAST(sum(up20) AS BIGINT) AS ups_20d, count(SMA_20) AS with_sma, round(avg(SMA_20), 4) AS mean_sma_20, "
        "round(avg(SMA_50), 4) AS mean_sma_50, round(avg(BB_upper), 4) AS mean_bb_upper, round(avg(Volatility), 4) AS mean_volatility, "
        "round(avg(Price_change), 6) AS mean_change, round(avg(Price_change_20d), 6) AS mean_change_20d, "
        "CAST(sum(news_count) AS BIGINT) AS news, round(avg(sentiment_mean), 6) AS sentiment FROM ("
        "SELECT t.*, CASE WHEN pos < CAST(floor(n * (1 - 0.2::DOUBLE)) AS BIGINT) THEN 'train' ELSE 'test' END AS split, "
        "coalesce(news_count, 0) AS news_count, coalesce(sentiment_mean, 0) AS sentiment_mean "
        "FROM t JOIN d USING (date) LEFT JOIN agg USING (symbol, date)) GROUP BY symbol, split",
        "filled", "bar_news",
        extra={
            "agg": _ALL_NEWS.replace("FROM news", "FROM bar_news"),
            "kept": f"SELECT * FROM filled WHERE {_ANY}",
            "bounds": f"{_BOUNDS} FROM filled GROUP BY symbol",
            "c": f"SELECT symbol, date, {_CLEAN_EXPR} FROM kept LEFT JOIN bounds USING (symbol)",
            "t": f"SELECT symbol, date, CASE WHEN count(Close) OVER {_SMA} = 20 THEN avg(Close) OVER {_SMA} END AS SMA_20, "
            f"CASE WHEN count(Close) OVER {_SMA_50} = 50 THEN avg(Close) OVER {_SMA_50} END AS SMA_50, "
            f"CASE WHEN count(Close) OVER {_SMA} = 20 THEN avg(Close) OVER {_SMA} + 2 * stddev_pop(Close) OVER {_SMA} END AS BB_upper, "
            f"CASE WHEN count(Close) OVER {_SMA} = 20 THEN stddev_samp(Close) OVER {_SMA} END AS Volatility, "
            f"Close / lag(Close) {_W} - 1 AS Price_change, Close / lag(Close, 20) {_W} - 1 AS Price_change_20d, "
            + ", ".join(f"CAST(coalesce(lead(Close, {h}) {_W} > Close, false) AS INT) AS up{h}" for h in (1, 5, 20)) + " FROM c",
            "d": "SELECT date, sum(count(*)) OVER (ORDER BY date) - count(*) AS pos, sum(count(*)) OVER () AS n FROM t GROUP BY date",
        },
    ),
)
def prepare_data(spark, folder):
    """The whole preparation over bars with gaps and news of their symbols, summed up per symbol and split."""
    table = assemble.prepare_data(I.bars_gaps(spark, folder), I.bar_news(spark, folder))
    return table.groupBy("symbol", "split").agg(
        F.count(F.lit(1)).alias("samples"),
        F.sum("price_direction_1d").alias("ups"),
        F.sum("price_direction_5d").alias("ups_5d"),
        F.sum("price_direction_20d").alias("ups_20d"),
        F.count("SMA_20").alias("with_sma"),
        F.round(F.avg("SMA_20"), 4).alias("mean_sma_20"),
        F.round(F.avg("SMA_50"), 4).alias("mean_sma_50"),
        F.round(F.avg("BB_upper"), 4).alias("mean_bb_upper"),
        F.round(F.avg("Volatility"), 4).alias("mean_volatility"),
        F.round(F.avg("Price_change"), 6).alias("mean_change"),
        F.round(F.avg("Price_change_20d"), 6).alias("mean_change_20d"),
        F.sum("news_count").alias("news"),
        F.round(F.avg("sentiment_mean"), 6).alias("sentiment"),
    )


_TOKENS = r"list_filter(regexp_split_to_array(text, '[ \t\n\r\f\v]+'), lambda w: w <> '')"


@query(
    "g06_tokenize",
    sql(
        "SELECT doc_id, array_to_string(list_concat(ids, list_resize([0], 64 - len(ids), 0)[:64 - len(ids)]), ' ') AS input_ids, "
        "repeat('1', len(ids)) || repeat('0', 64 - len(ids)) AS attention_mask FROM ("
        "SELECT doc_id, coalesce(list(coalesce(token_id, 1) ORDER BY pos) FILTER (WHERE token IS NOT NULL), []) AS ids "
        "FROM p LEFT JOIN v USING (token) GROUP BY doc_id)",
        extra={
            "w": f"SELECT doc_id, {_TOKENS} AS ws FROM documents",
            "v": "SELECT token, row_number() OVER (ORDER BY n DESC, token) + 1 AS token_id FROM ("
            "SELECT token, count(*) AS n FROM (SELECT unnest(ws) AS token FROM w) GROUP BY token ORDER BY n DESC, token LIMIT 1000)",
            "p": "SELECT doc_id, unnest(ws[:64]) AS token, unnest(range(1, len(ws[:64]) + 1)) AS pos FROM w",
        },
    ),
)
def tokenize(spark, folder):
    docs = I.documents(spark, folder).select("doc_id", "text")
    out = tokens.tokenize(docs, "doc_id", "text", tokens.vocabulary(docs, "text", 1000), 64)
    return out.select(
        "doc_id",
        F.array_join("input_ids", " ").alias("input_ids"),
        F.array_join("attention_mask", "").alias("attention_mask"),
    )

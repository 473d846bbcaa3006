"""Registered queries: one Spark plan and one DuckDB oracle per operator id.

Each entry takes (spark, sf_dir) and returns a DataFrame over the full test
tables. Doubles are rounded to 6 places in both engines; every computed
column is aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.operators import cohort as C
from prelaunch.operators import profile as P
from prelaunch.plans import fixtures as FX
from prelaunch.plans.oracle_views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def gy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture G with parsed release parts."""
    return C.with_release_parts(FX.games(spark, sf_dir))


GY = "gy"

# --------------------------------------------------------------- profiling

@register("yearly_success", with_views("""
SELECT release_year, round(avg(CAST(success AS DOUBLE)), 6) AS success_rate, count(success) AS total_games
FROM gy WHERE release_year IS NOT NULL GROUP BY release_year""", GY))
def q_yearly_success(spark, sf):
    y = P.yearly_stats(gy(spark, sf), "success", "release_year")
    return y.select("release_year", r6("success_rate").alias("success_rate"), "total_games")


@register("dataset_size", with_views("""
SELECT count(*) AS n_rows, 19 AS n_columns FROM gy""", GY))
def q_dataset_size(spark, sf):
    return P.dataset_size(gy(spark, sf)).select("n_rows", F.col("n_columns").cast("int"))


_MISSING_COLS = ["release_date", "price", "estimated_owners", "success", "achievements", "dlc_count",
                 "windows", "developers", "genres", "release_year"]

_MISSING_UNION = "\n  UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL"
    f"{' OR isnan(' + c + ')' if c == 'price' else ''}) AS n_missing, count(*) AS n FROM gy"
    for c in _MISSING_COLS)
_MISSING = f"""missing AS (
  SELECT column_name, n_missing, round(n_missing * 100.0 / n, 2) AS missing_pct FROM ({_MISSING_UNION}) m
)"""


@register("missing_values", with_views("SELECT * FROM missing", GY, extra=[_MISSING]))
def q_missing_values(spark, sf):
    return P.missing_values(gy(spark, sf), _MISSING_COLS)


@register("significant_missing", with_views("SELECT * FROM missing WHERE missing_pct > 1.9", GY, extra=[_MISSING]))
def q_significant_missing(spark, sf):
    return P.significant_missing(gy(spark, sf), 1.9, _MISSING_COLS)   # 1.9 % parts the fixture's columns


@register("top_missing", with_views("""
SELECT * FROM (SELECT *, row_number() OVER (ORDER BY missing_pct DESC, column_name) AS rank
               FROM missing WHERE missing_pct > 0.5) r WHERE rank <= 3""", GY, extra=[_MISSING]))
def q_top_missing(spark, sf):
    return P.top_missing(gy(spark, sf), 3, 0.5, _MISSING_COLS)

# ------------------------------------------------------------------ scalars

from prelaunch.functions import lists as L  # noqa: E402
from prelaunch.functions import scalars as S  # noqa: E402
from prelaunch.plans.oracle_views import hash_uniform_sql  # noqa: E402

# DuckDB spelling of the list decode for the fixture's list text.
def _dlist(c: str) -> str:
    return f"coalesce(from_json(replace({c}, '''', '\"'), '[\"VARCHAR\"]'), [])"


_WS = S.PY_WHITESPACE

# Fixed values of the fixture queries: keywords, excluded tags and cut-offs
# chosen so the fixture's brands and part types exercise each operator.
FX_KEYWORDS = ["#1", "brand#5"]
FX_EXCLUDED = ["PROMO"]
FX_TRAIN, FX_TEST = FX.TRAIN_YEARS, FX.TEST_FROM


@register("list_decode", with_views(f"""
SELECT game_id, len({_dlist('genres')}) AS n_items, array_to_string({_dlist('genres')}, '|') AS items
FROM g""", "g"))
def q_list_decode(spark, sf):
    a = L.decode_list("genres")
    return FX.games(spark, sf).select("game_id", F.size(a).alias("n_items"),
                                      F.array_join(a, "|").alias("items"))


@register("list_length", with_views(f"""
SELECT game_id, CAST(len({_dlist('supported_languages')}) AS INTEGER) AS language_count FROM g""", "g"))
def q_list_length(spark, sf):
    return FX.games(spark, sf).select("game_id", L.list_length("supported_languages").alias("language_count"))


@register("comma_pieces", with_views("""
SELECT game_id, CAST(CASE WHEN categories IS NULL THEN 0
       ELSE length(categories) - length(replace(categories, ',', '')) + 1 END AS INTEGER) AS language_count_eda
FROM g""", "g"))
def q_comma_pieces(spark, sf):
    return FX.games(spark, sf).select("game_id", L.comma_pieces("categories").cast("int").alias("language_count_eda"))


@register("keyword_any", with_views(f"""
SELECT game_id, CAST(coalesce(len(list_filter({_dlist('categories')},
       lambda x: {' OR '.join(f"contains(lower(x), '{k}')" for k in FX_KEYWORDS)})) > 0, false) AS INTEGER) AS has_keyword
FROM g""", "g"))
def q_keyword_any(spark, sf):
    return FX.games(spark, sf).select("game_id", L.any_keyword("categories", FX_KEYWORDS).alias("has_keyword"))


@register("date_parse", with_views("""
SELECT game_id, strftime(try_strptime(release_date, '%Y-%m-%d'), '%Y-%m-%d') AS release_day FROM g""", "g"))
def q_date_parse(spark, sf):
    return FX.games(spark, sf).select("game_id", F.date_format(S.parse_date("release_date"), "yyyy-MM-dd")
                                      .alias("release_day"))


@register("calendar_parts", with_views("""
SELECT game_id, release_year, release_month, release_quarter FROM gy""", GY))
def q_calendar_parts(spark, sf):
    return gy(spark, sf).select("game_id", "release_year", "release_month", "release_quarter")


@register("q4_flag", with_views("""
SELECT game_id, CAST(coalesce(release_quarter = 4, false) AS INTEGER) AS released_q4 FROM gy""", GY))
def q_q4_flag(spark, sf):
    return gy(spark, sf).select("game_id", S.q4_flag("release_quarter").alias("released_q4"))


@register("fill_zero", with_views("""
SELECT game_id, coalesce(price, 0.0) AS price, coalesce(CAST(achievements AS DOUBLE), 0.0) AS achievements FROM g""", "g"))
def q_fill_zero(spark, sf):
    return FX.games(spark, sf).select("game_id", S.fill_zero("price").alias("price"),
                                      S.fill_zero("achievements").alias("achievements"))


@register("log1p_counts", with_views("""
SELECT game_id, round(ln(1 + coalesce(dlc_count, 0)), 6) AS dlc_count,
       round(ln(1 + coalesce(achievements, 0)), 6) AS achievements FROM g""", "g"))
def q_log1p(spark, sf):
    return FX.games(spark, sf).select("game_id", r6(S.log1p_filled("dlc_count")).alias("dlc_count"),
                                      r6(S.log1p_filled("achievements")).alias("achievements"))


@register("flag01", with_views("""
SELECT game_id, CAST(coalesce(windows, false) AS INTEGER) AS windows,
       CAST(coalesce(mac, false) AS INTEGER) AS mac, CAST(coalesce(linux, false) AS INTEGER) AS linux FROM g""", "g"))
def q_flag01(spark, sf):
    return FX.games(spark, sf).select("game_id", *[S.flag01(c).alias(c) for c in ("windows", "mac", "linux")])


@register("platform_count", with_views("""
SELECT game_id, CAST(coalesce(windows, false) AS INTEGER) + CAST(coalesce(mac, false) AS INTEGER)
       + CAST(coalesce(linux, false) AS INTEGER) AS platform_count FROM g""", "g"))
def q_platform_count(spark, sf):
    return FX.games(spark, sf).select("game_id", S.row_sum_flags(["windows", "mac", "linux"]).alias("platform_count"))


@register("char_length", with_views("""
SELECT doc_id, CAST(length(coalesce(short_description, '')) AS INTEGER) AS desc_length,
       CAST(length(coalesce(detailed_features, '')) AS INTEGER) AS detailed_features_length FROM d""", "d"))
def q_char_length(spark, sf):
    return FX.texts(spark, sf).select("doc_id", S.char_length("short_description").alias("desc_length"),
                                      S.char_length("detailed_features").alias("detailed_features_length"))


@register("word_count", with_views(f"""
SELECT doc_id, CAST(len(regexp_extract_all(coalesce(short_description, ''), '[^{_WS}]+')) AS INTEGER) AS desc_word_count,
       CAST(len(regexp_extract_all(coalesce(detailed_features, ''), '[^{_WS}]+')) AS INTEGER) AS detailed_features_word_count
FROM d""", "d"))
def q_word_count(spark, sf):
    return FX.texts(spark, sf).select("doc_id", S.word_count("short_description").alias("desc_word_count"),
                                      S.word_count("detailed_features").alias("detailed_features_word_count"))


@register("text_concat", with_views("""
SELECT doc_id, md5(coalesce(short_description, '') || ' ' || coalesce(detailed_features, '')) AS text_md5,
       CAST(length(coalesce(short_description, '') || ' ' || coalesce(detailed_features, '')) AS INTEGER) AS text_length
FROM d""", "d"))
def q_text_concat(spark, sf):
    t = S.text_concat("short_description", "detailed_features")
    return FX.texts(spark, sf).select("doc_id", F.md5(t).alias("text_md5"), F.length(t).alias("text_length"))


@register("is_free", with_views("""
SELECT game_id, CAST(coalesce(price, 0.0) = 0 AS INTEGER) AS is_free FROM g""", "g"))
def q_is_free(spark, sf):
    return FX.games(spark, sf).select("game_id", S.is_free("price").alias("is_free"))


_COMBO_SQL = ("CAST(CAST(coalesce(windows, false) AS INTEGER) AS VARCHAR) || CAST(CAST(coalesce(mac, false) AS INTEGER) AS VARCHAR)"
              " || CAST(CAST(coalesce(linux, false) AS INTEGER) AS VARCHAR)")
_LABEL_SQL = "CASE " + " ".join(f"WHEN {_COMBO_SQL} = '{k}' THEN '{v}'" for k, v in S.PLATFORM_COMBOS.items()) + " END"


@register("combo_code", with_views(f"SELECT game_id, {_COMBO_SQL} AS combo_code FROM g", "g"))
def q_combo_code(spark, sf):
    return FX.games(spark, sf).select("game_id", S.combo_code(["windows", "mac", "linux"]).alias("combo_code"))


@register("combo_label", with_views(f"SELECT game_id, {_LABEL_SQL} AS combo_label FROM g", "g"))
def q_combo_label(spark, sf):
    code = S.combo_code(["windows", "mac", "linux"])
    return FX.games(spark, sf).select("game_id", S.lookup(code, S.PLATFORM_COMBOS).alias("combo_label"))


_CLEAN_SQL = (f"list_transform(list_filter({_dlist('genres')}, lambda x: x IS NOT NULL AND length(x) > 0 "
              f"AND NOT list_contains({FX_EXCLUDED!r}, regexp_replace(x, '^[{_WS}]+|[{_WS}]+$', '', 'g'))), "
              f"lambda x: regexp_replace(x, '^[{_WS}]+|[{_WS}]+$', '', 'g'))")


@register("tag_clean", with_views(f"""
SELECT game_id, array_to_string({_CLEAN_SQL}, '|') AS tags FROM g""", "g"))
def q_tag_clean(spark, sf):
    return FX.games(spark, sf).select("game_id", F.array_join(L.clean_tags("genres", FX_EXCLUDED), "|").alias("tags"))


# ------------------------------------------------------------ cohort, filters

@register("price_filter", with_views("SELECT game_id FROM g WHERE price BETWEEN 0 AND 30", "g"))
def q_price_filter(spark, sf):
    return C.price_filter(FX.games(spark, sf)).select("game_id")


@register("studio_size_filter", with_views("""
SELECT game_id FROM g WHERE developers IN (
  SELECT developers FROM g WHERE developers IS NOT NULL GROUP BY developers HAVING count(*) <= 10)""", "g"))
def q_studio_size_filter(spark, sf):
    return C.studio_size_filter(FX.games(spark, sf), max_games=10).select("game_id")


@register("release_window_filter", with_views("SELECT game_id FROM gy WHERE release_year >= 1997", GY))
def q_release_window(spark, sf):
    return C.release_window_filter(gy(spark, sf), 1997).select("game_id")


@register("success_label", with_views("""
SELECT game_id, CAST(estimated_owners >= 100 AS INTEGER) AS success FROM g""", "g"))
def q_success_label(spark, sf):
    return FX.games(spark, sf).select("game_id", C.success_label("estimated_owners", 100).alias("success"))


@register("cohort_funnel", with_views("""
SELECT * FROM (
  SELECT 0 AS step, 'all rows' AS name, count(*) AS rows FROM x
  UNION ALL SELECT 1, 'price 0-30', count(*) FILTER (WHERE price BETWEEN 0 AND 30) FROM x
  UNION ALL SELECT 2, 'studio <= 10 games', count(*) FILTER (WHERE price BETWEEN 0 AND 30 AND dev_n <= 10) FROM x
  UNION ALL SELECT 3, 'released >= 1996', count(*) FILTER (WHERE price BETWEEN 0 AND 30 AND dev_n <= 10
                                                            AND release_year >= 1996) FROM x)""", GY, extra=[
    "dev AS (SELECT developers, count(*) AS n FROM g WHERE developers IS NOT NULL GROUP BY developers)",
    "x AS (SELECT gy.*, dev.n AS dev_n FROM gy LEFT JOIN dev ON gy.developers = dev.developers)"]))
def q_cohort_funnel(spark, sf):
    g = C.with_developer_count(gy(spark, sf))
    steps = [("price 0-30", F.col("price").between(0, 30)),
             ("studio <= 10 games", F.col("dev_game_count") <= 10),
             ("released >= 1996", F.col("release_year") >= 1996)]
    return C.cohort_funnel(g, steps)


@register("target_not_null", with_views("SELECT game_id FROM g WHERE success IS NOT NULL", "g"))
def q_target_not_null(spark, sf):
    return C.target_not_null(FX.games(spark, sf)).select("game_id")


@register("train_filter", with_views(
    f"SELECT game_id FROM gy WHERE release_year BETWEEN {FX_TRAIN[0]} AND {FX_TRAIN[1]}", GY))
def q_train_filter(spark, sf):
    return C.train_rows(gy(spark, sf), train_years=FX_TRAIN).select("game_id")


@register("test_filter", with_views(f"SELECT game_id FROM gy WHERE release_year >= {FX_TEST}", GY))
def q_test_filter(spark, sf):
    return C.test_rows(gy(spark, sf), test_from=FX_TEST).select("game_id")


@register("temporal_split", with_views(f"""
SELECT game_id, CASE WHEN release_year BETWEEN {FX_TRAIN[0]} AND {FX_TRAIN[1]} THEN 'train'
                     WHEN release_year >= {FX_TEST} THEN 'test' ELSE 'none' END AS split FROM gy""", GY))
def q_temporal_split(spark, sf):
    return C.temporal_split(gy(spark, sf), train_years=FX_TRAIN, test_from=FX_TEST).select("game_id", "split")


@register("developer_game_count", with_views("""
SELECT g.game_id, d.n AS dev_game_count FROM g
LEFT JOIN (SELECT developers, count(*) AS n FROM g WHERE developers IS NOT NULL GROUP BY developers) d
  ON g.developers = d.developers""", "g"))
def q_developer_game_count(spark, sf):
    return C.with_developer_count(FX.games(spark, sf)).select("game_id", "dev_game_count")

# ------------------------------------------------------ profile aggregates

from prelaunch.operators import tags as TG  # noqa: E402

_NUM_VARS = ["price", "required_age", "achievements", "dlc_count", "success", "release_year"]
_BOX_FEATURES = ["price", "achievements", "dlc_count", "required_age", "language_count", "platform_count"]


def gy_eda(spark, sf) -> DataFrame:
    """G with the EDA's derived counts (comma-piece language count)."""
    return gy(spark, sf).withColumns({
        "language_count": L.comma_pieces("supported_languages"),
        "platform_count": S.row_sum_flags(["windows", "mac", "linux"])})


_GE = """ge AS (
  SELECT gy.*, CASE WHEN supported_languages IS NULL THEN 0
         ELSE length(supported_languages) - length(replace(supported_languages, ',', '')) + 1 END AS language_count,
         CAST(coalesce(windows, false) AS INTEGER) + CAST(coalesce(mac, false) AS INTEGER)
         + CAST(coalesce(linux, false) AS INTEGER) AS platform_count
  FROM gy)"""


def _num_summary_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS variable, round(avg({c}), 6) AS mean, round(median({c}::DOUBLE), 6) AS median, "
        f"min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM gy" for c in _NUM_VARS)
    return with_views(f"SELECT * FROM ({parts})", GY)


@register("numeric_summary", _num_summary_sql())
def q_numeric_summary(spark, sf):
    s = P.numeric_summary(gy(spark, sf), _NUM_VARS)
    return s.select("variable", r6("mean").alias("mean"), r6("median").alias("median"), "min", "max")


_CAT_VARS = ["release_date", "developers", "genres", "categories"]


@register("categorical_summary", with_views("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, 'string' AS dtype, count(DISTINCT {c}) AS n_distinct FROM gy" for c in _CAT_VARS)
    + ")", GY))
def q_categorical_summary(spark, sf):
    return P.categorical_summary(gy(spark, sf), _CAT_VARS)


@register("target_summary", with_views("""
SELECT count(*) AS n_rows, round(avg(success), 6) AS success_rate, CAST(sum(success) AS BIGINT) AS n_success,
       min(release_year) AS min_year, max(release_year) AS max_year FROM gy""", GY))
def q_target_summary(spark, sf):
    s = P.target_summary(gy(spark, sf), "success", "release_year")
    return s.select("n_rows", r6("success_rate").alias("success_rate"), "n_success", "min_year", "max_year")


@register("price_histogram", with_views("""
SELECT b.bin, CAST(b.bin AS DOUBLE) AS bin_start, CAST(b.bin + 1 AS DOUBLE) AS bin_end, coalesce(c.n, 0) AS count
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(50)) b
LEFT JOIN (SELECT CAST(least(floor(price), 49) AS INTEGER) AS bin, count(*) AS n FROM g
           WHERE price >= 0 AND price <= 50 GROUP BY 1) c ON b.bin = c.bin""", "g"))
def q_price_histogram(spark, sf):
    h = P.histogram(FX.games(spark, sf), "price", 0.0, 50.0, 50)
    return h.select("bin", r6("bin_start").alias("bin_start"), r6("bin_end").alias("bin_end"), "count")


_BAND_SQL = "CASE " + " ".join(
    f"WHEN price > {P.PRICE_EDGES[i]} AND price <= {P.PRICE_EDGES[i + 1]} THEN '{lab}'"
    for i, lab in enumerate(P.PRICE_LABELS)) + " END"
_BANDS = f"""bands AS (
  SELECT d.price_range, d.band_order, s.success_rate, coalesce(s.n, 0) AS count
  FROM (VALUES {', '.join(f"({i}, '{lab}')" for i, lab in enumerate(P.PRICE_LABELS))}) d(band_order, price_range)
  LEFT JOIN (SELECT {_BAND_SQL} AS band, round(avg(success), 6) AS success_rate, count(success) AS n
             FROM g GROUP BY 1) s ON s.band = d.price_range)"""


@register("price_band_stats", with_views("SELECT * FROM bands", "g", extra=[_BANDS]))
def q_price_band_stats(spark, sf):
    b = P.binned_target_stats(FX.games(spark, sf))
    return b.select("price_range", "band_order", r6("success_rate").alias("success_rate"), "count")


@register("price_bands_min_count", with_views("SELECT * FROM bands WHERE count >= (SELECT count(*) // 11 FROM g)", "g", extra=[_BANDS]))
def q_price_bands_min_count(spark, sf):
    g = FX.games(spark, sf)
    b = P.bands_with_min_count(P.binned_target_stats(g), g.count() // 11)   # parts the fixture's bands
    return b.select("price_range", "band_order", r6("success_rate").alias("success_rate"), "count")


@register("bin_coverage", with_views(f"""
SELECT count(*) AS total_rows, count(CASE WHEN ({_BAND_SQL}) IS NOT NULL THEN success END) AS rows_in_bins,
       count(*) - count(CASE WHEN ({_BAND_SQL}) IS NOT NULL THEN success END) AS rows_lost FROM g""", "g"))
def q_bin_coverage(spark, sf):
    return P.bin_coverage(FX.games(spark, sf))


@register("price_over_cap", with_views("SELECT count(*) FILTER (WHERE price > 40) AS n_above_cap FROM g", "g"))
def q_price_over_cap(spark, sf):
    return P.price_extras(FX.games(spark, sf), cap=40.0).select("n_above_cap")


@register("mean_paid_price", with_views(
    "SELECT round(avg(price) FILTER (WHERE price > 0), 6) AS mean_paid_price FROM g", "g"))
def q_mean_paid_price(spark, sf):
    return P.price_extras(FX.games(spark, sf)).select(r6("mean_paid_price").alias("mean_paid_price"))


_CORR_VARS = ["price", "required_age", "achievements", "dlc_count", "language_count", "success"]


def _corr_sql() -> str:
    parts = []
    for a in _CORR_VARS:
        for b in _CORR_VARS:
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            den = (f"stddev_pop(CASE WHEN {both} THEN {a}::DOUBLE END) * "
                   f"stddev_pop(CASE WHEN {both} THEN {b}::DOUBLE END)")
            parts.append(f"SELECT '{a}' AS var_a, '{b}' AS var_b, round(CASE WHEN {den} > 0 THEN "
                         f"greatest(-1.0, least(1.0, covar_pop({a}::DOUBLE, {b}::DOUBLE) / ({den}))) END, 6) AS corr FROM ge")
    return with_views("SELECT * FROM (" + " UNION ALL ".join(parts) + ")", GY, extra=[_GE])


@register("correlation_matrix", _corr_sql())
def q_correlation(spark, sf):
    return P.correlation_long(gy_eda(spark, sf), _CORR_VARS).select("var_a", "var_b", r6("corr").alias("corr"))


def _class_long_sql() -> str:
    return "lf AS (" + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST(success AS INTEGER) AS cls, CAST({f} AS DOUBLE) AS value FROM ge "
        f"WHERE success IN (0, 1) AND {f} IS NOT NULL" for f in _BOX_FEATURES) + ")"


_MOMENTS = """mo AS (
  SELECT feature, cls, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
         quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3,
         max(value) AS max
  FROM lf GROUP BY feature, cls)"""


@register("class_moments", with_views("""
SELECT feature, cls, count, round(mean, 6) AS mean, round(std, 6) AS std, min, q1, median, q3, max FROM mo""",
    GY, extra=[_GE, _class_long_sql(), _MOMENTS]))
def q_class_moments(spark, sf):
    m = P.class_moments(gy_eda(spark, sf), _BOX_FEATURES)
    return m.select("feature", "cls", "count", r6("mean").alias("mean"), r6("std").alias("std"),
                    "min", "q1", "median", "q3", "max")


@register("box_stats", with_views("""
SELECT mo.feature, mo.cls, mo.q1, mo.median, mo.q3, round(mo.mean, 6) AS mean, mo.count,
       w.whisker_low, w.whisker_high, w.n_outliers
FROM mo JOIN (
  SELECT lf.feature, lf.cls,
         min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) THEN value END) AS whisker_low,
         max(CASE WHEN value <= q3 + 1.5 * (q3 - q1) THEN value END) AS whisker_high,
         count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers
  FROM lf JOIN mo ON lf.feature = mo.feature AND lf.cls = mo.cls GROUP BY lf.feature, lf.cls
) w ON mo.feature = w.feature AND mo.cls = w.cls""", GY, extra=[_GE, _class_long_sql(), _MOMENTS]))
def q_box_stats(spark, sf):
    b = P.box_stats(gy_eda(spark, sf), _BOX_FEATURES)
    return b.select("feature", "cls", "q1", "median", "q3", r6("mean").alias("mean"), "count",
                    "whisker_low", "whisker_high", "n_outliers")


_CMP_METRICS = ["count", "mean", "median", "std", "min", "q1", "q3", "max", "iqr"]


def _pct_sql(a: str, b: str) -> str:
    return f"CASE WHEN {b} IS NULL OR {b} = 0 THEN NULL WHEN {a} = 0 THEN 0.0 ELSE ({b} - {a}) / abs({a}) * 100 END"


def _comparison_sql() -> str:
    parts = []
    for k in _CMP_METRICS:
        expr = "q3 - q1" if k == "iqr" else k
        a = f"max(CASE WHEN cls = 0 THEN CAST({expr} AS DOUBLE) END)"
        b = f"max(CASE WHEN cls = 1 THEN CAST({expr} AS DOUBLE) END)"
        diff = f"{b} - {a}" if k == "count" else _pct_sql(a, b)
        parts.append(f"SELECT feature, '{k}' AS metric, round({a}, 6) AS unsuccessful, round({b}, 6) AS successful, "
                     f"round({diff}, 6) AS difference FROM mo GROUP BY feature")
    return with_views("SELECT * FROM (" + " UNION ALL ".join(parts) + ")", GY,
                      extra=[_GE, _class_long_sql(), _MOMENTS])


@register("class_comparison", _comparison_sql())
def q_class_comparison(spark, sf):
    c = P.class_comparison(gy_eda(spark, sf), _BOX_FEATURES)
    return c.select("feature", "metric", r6("unsuccessful").alias("unsuccessful"),
                    r6("successful").alias("successful"), r6("difference").alias("difference"))


_COHEN = """cd AS (
  SELECT feature, pooled, CASE WHEN pooled > 0 THEN (m1 - m0) / pooled END AS d FROM (
    SELECT feature, sqrt(((max(CASE WHEN cls = 0 THEN count END) - 1) * power(max(CASE WHEN cls = 0 THEN std END), 2)
                        + (max(CASE WHEN cls = 1 THEN count END) - 1) * power(max(CASE WHEN cls = 1 THEN std END), 2))
                       / (max(CASE WHEN cls = 0 THEN count END) + max(CASE WHEN cls = 1 THEN count END) - 2)) AS pooled,
           max(CASE WHEN cls = 0 THEN mean END) AS m0, max(CASE WHEN cls = 1 THEN mean END) AS m1
    FROM mo GROUP BY feature) x)"""
_EFFECT_SQL = ("CASE WHEN d IS NULL THEN NULL WHEN abs(d) < 0.2 THEN 'negligible' WHEN abs(d) < 0.5 THEN 'small' "
               "WHEN abs(d) < 0.8 THEN 'medium' ELSE 'LARGE' END")


@register("cohens_d", with_views(f"""
SELECT feature, round(pooled, 6) AS pooled_std, round(d, 6) AS cohens_d, {_EFFECT_SQL} AS effect FROM cd""",
    GY, extra=[_GE, _class_long_sql(), _MOMENTS, _COHEN]))
def q_cohens_d(spark, sf):
    c = P.cohens_d(gy_eda(spark, sf), _BOX_FEATURES)
    return c.select("feature", r6("pooled_std").alias("pooled_std"), r6("cohens_d").alias("cohens_d"), "effect")


@register("pct_difference", with_views(f"""
SELECT feature, round({_pct_sql("max(CASE WHEN cls = 0 THEN mean END)", "max(CASE WHEN cls = 1 THEN mean END)")}, 6)
       AS mean_difference_pct FROM mo GROUP BY feature""", GY, extra=[_GE, _class_long_sql(), _MOMENTS]))
def q_pct_difference(spark, sf):
    c = P.class_comparison(gy_eda(spark, sf), _BOX_FEATURES).where(F.col("metric") == "mean")
    return c.select("feature", r6("difference").alias("mean_difference_pct"))


@register("effect_label", with_views(f"SELECT feature, {_EFFECT_SQL} AS effect FROM cd",
                                     GY, extra=[_GE, _class_long_sql(), _MOMENTS, _COHEN]))
def q_effect_label(spark, sf):
    return P.cohens_d(gy_eda(spark, sf), _BOX_FEATURES).select("feature", "effect")


_FLAGS = ["windows", "mac", "linux"]


@register("flag_totals", with_views("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{f}' AS flag, count(*) FILTER (WHERE {f}) AS count, "
    f"round(count(*) FILTER (WHERE {f}) * 100.0 / count(*), 6) AS pct FROM g" for f in _FLAGS) + ")", "g"))
def q_flag_totals(spark, sf):
    return P.flag_totals(FX.games(spark, sf), _FLAGS).select("flag", "count", r6("pct").alias("pct"))


@register("combo_distribution", with_views(f"""
SELECT combo_label, count, round(count * 100.0 / (SELECT count(*) FROM g), 6) AS pct,
       row_number() OVER (ORDER BY count, combo_label) AS "order"
FROM (SELECT {_LABEL_SQL} AS combo_label, count(*) AS count FROM g GROUP BY 1) x WHERE combo_label IS NOT NULL""",
    "g"))
def q_combo_distribution(spark, sf):
    c = P.combo_distribution(FX.games(spark, sf), _FLAGS)
    return c.select("combo_label", "count", r6("pct").alias("pct"), "order")


@register("combo_success", with_views(f"""
SELECT combo_label, round(avg(success), 6) AS success_rate FROM (SELECT {_LABEL_SQL} AS combo_label, success FROM g)
WHERE combo_label IS NOT NULL GROUP BY combo_label""", "g"))
def q_combo_success(spark, sf):
    return P.combo_success(FX.games(spark, sf), _FLAGS).select("combo_label", r6("success_rate").alias("success_rate"))


@register("class_distribution", with_views("""
SELECT success, count(*) AS count, round(count(*) * 100.0 / (SELECT count(success) FROM g), 6) AS pct,
       round((SELECT count(*) FILTER (WHERE success = 0) * 1.0 / count(*) FILTER (WHERE success = 1) FROM g), 6)
         AS imbalance_ratio
FROM g WHERE success IS NOT NULL GROUP BY success""", "g"))
def q_class_distribution(spark, sf):
    c = P.class_distribution(FX.games(spark, sf))
    return c.select("success", "count", r6("pct").alias("pct"), r6("imbalance_ratio").alias("imbalance_ratio"))


@register("relative_change", with_views("""
SELECT min(release_year) AS first_period, max(release_year) AS last_period,
       round(arg_min(rate, release_year), 6) AS first_rate, round(arg_max(rate, release_year), 6) AS last_rate,
       count(*) AS n_periods,
       round(CASE WHEN count(*) >= 2 THEN (arg_max(rate, release_year) - arg_min(rate, release_year))
             / arg_min(rate, release_year) * 100 END, 6) AS change_pct
FROM (SELECT release_year, avg(success) AS rate FROM gy WHERE release_year IS NOT NULL GROUP BY 1)""", GY))
def q_relative_change(spark, sf):
    r = P.relative_change(P.yearly_stats(gy(spark, sf), "success", "release_year"), "success_rate", "release_year")
    return r.select("first_period", "last_period", r6("first_rate").alias("first_rate"),
                    r6("last_rate").alias("last_rate"), "n_periods", r6("change_pct").alias("change_pct"))


@register("feature_means", with_views(f"""
SELECT round(avg(len({_dlist('supported_languages')})), 6) AS avg_language_count,
       round(avg(CAST(coalesce(windows, false) AS INTEGER) + CAST(coalesce(mac, false) AS INTEGER)
                 + CAST(coalesce(linux, false) AS INTEGER)), 6) AS avg_platform_count,
       count(DISTINCT developers) AS n_developers FROM g""", "g"))
def q_feature_means(spark, sf):
    g = FX.games(spark, sf).withColumns({"language_count": L.list_length("supported_languages"),
                                         "platform_count": S.row_sum_flags(_FLAGS)})
    m = P.feature_means(g, ["language_count", "platform_count"])
    return m.select(r6("avg_language_count").alias("avg_language_count"),
                    r6("avg_platform_count").alias("avg_platform_count"), "n_developers")


@register("majority_accuracy", with_views(
    "SELECT round(1 - avg(success), 6) AS majority_accuracy FROM g", "g"))
def q_majority_accuracy(spark, sf):
    return P.majority_accuracy(FX.games(spark, sf)).select(r6("majority_accuracy").alias("majority_accuracy"))


@register("summary_stats", with_views(f"""
SELECT count(*) AS total_games, round(avg(success), 6) AS success_rate,
       CAST(min(release_year) AS VARCHAR) || '-' || CAST(max(release_year) AS VARCHAR) AS date_range,
       round(count(*) FILTER (WHERE success = 0) * 1.0 / count(*) FILTER (WHERE success = 1), 6) AS class_imbalance_ratio,
       (SELECT count(*) FROM missing WHERE missing_pct > 5) AS features_with_missing_data,
       (SELECT round((arg_max(rate, release_year) - arg_min(rate, release_year)) / arg_min(rate, release_year) * 100, 6)
        FROM (SELECT release_year, avg(success) AS rate FROM gy WHERE release_year IS NOT NULL GROUP BY 1)) AS temporal_decline
FROM gy""", GY, extra=[_MISSING.replace("FROM gy", "FROM gy")]))
def q_summary_stats(spark, sf):
    s = P.summary_stats(gy(spark, sf).select(*_MISSING_COLS, "game_id"), "success", "release_year")
    return s.select("total_games", r6("success_rate").alias("success_rate"), "date_range",
                    r6("class_imbalance_ratio").alias("class_imbalance_ratio"),
                    "features_with_missing_data", r6("temporal_decline").alias("temporal_decline"))


# ----------------------------------------------------------------- tags

_TAGS_EXPLODED = f"""te AS (SELECT unnest({_CLEAN_SQL}) AS tag, success AS y FROM g)"""
_TAG_COUNTS = """tc AS (
  SELECT tag, count(*) FILTER (WHERE y = 0) AS unsuccessful, count(*) FILTER (WHERE y IS NULL OR y <> 0) AS successful
  FROM te GROUP BY tag)"""
_TAG_STATS = """ts AS (
  SELECT tag, unsuccessful, successful, unsuccessful + successful AS total,
         CASE WHEN unsuccessful + successful > 0 THEN successful * 100.0 / (unsuccessful + successful) ELSE 0.0 END
           AS success_rate
  FROM tc)"""
_TAGX = [_TAGS_EXPLODED, _TAG_COUNTS, _TAG_STATS]


@register("tag_class_counts", with_views("SELECT * FROM tc", "g", extra=_TAGX[:2]))
def q_tag_class_counts(spark, sf):
    return TG.tag_class_counts(FX.games(spark, sf), "genres", "success", FX_EXCLUDED)


@register("tag_stats", with_views(
    "SELECT tag, unsuccessful, successful, total, round(success_rate, 6) AS success_rate FROM ts", "g",
    extra=[_TAGS_EXPLODED.replace("genres", "categories"), _TAG_COUNTS, _TAG_STATS]))
def q_tag_stats(spark, sf):
    t = TG.tag_stats(FX.games(spark, sf), "categories", "success", FX_EXCLUDED)
    return t.select("tag", "unsuccessful", "successful", "total", r6("success_rate").alias("success_rate"))


@register("top_tags", with_views("""
SELECT * FROM (SELECT tag, unsuccessful, successful, total, round(success_rate, 6) AS success_rate,
                      row_number() OVER (ORDER BY total DESC, tag) AS rank FROM ts) WHERE rank <= 20""",
    "g", extra=[_TAGS_EXPLODED.replace("genres", "categories"), _TAG_COUNTS, _TAG_STATS]))
def q_top_tags(spark, sf):
    t = TG.top_tags(TG.tag_stats(FX.games(spark, sf), "categories", "success", FX_EXCLUDED), 20)
    return t.select("tag", "unsuccessful", "successful", "total", r6("success_rate").alias("success_rate"), "rank")


@register("top_tags_by_rate", with_views("""
SELECT tag, unsuccessful, successful, total, round(success_rate, 6) AS success_rate,
       row_number() OVER (ORDER BY success_rate DESC, tag) AS rate_rank
FROM (SELECT *, row_number() OVER (ORDER BY total DESC, tag) AS rank FROM ts) WHERE rank <= 20""",
    "g", extra=[_TAGS_EXPLODED.replace("genres", "categories"), _TAG_COUNTS, _TAG_STATS]))
def q_top_tags_by_rate(spark, sf):
    t = TG.top_tags_by_rate(TG.tag_stats(FX.games(spark, sf), "categories", "success", FX_EXCLUDED), 20)
    return t.select("tag", "unsuccessful", "successful", "total", r6("success_rate").alias("success_rate"),
                    "rate_rank")


@register("tag_totals", with_views("""
SELECT count(DISTINCT tag) AS n_tags, count(*) FILTER (WHERE y = 0) AS unsuccessful_instances,
       count(*) FILTER (WHERE y IS NULL OR y <> 0) AS successful_instances FROM te""", "g", extra=_TAGX[:1]))
def q_tag_totals(spark, sf):
    return TG.tag_totals(FX.games(spark, sf), "genres", "success", FX_EXCLUDED)


@register("tag_bag_union", with_views("SELECT tag, count(*) AS n FROM te GROUP BY tag", "g", extra=_TAGX[:1]))
def q_tag_bag_union(spark, sf):
    return TG.tag_bag_union(FX.games(spark, sf), "genres", FX_EXCLUDED)


@register("tag_exclusion", with_views(f"""
SELECT game_id, len({_dlist('genres')}) AS n_all, len(list_filter({_dlist('genres')}, lambda x: x NOT IN ('PROMO', 'ECONOMY'))) AS n_kept
FROM g""", "g"))
def q_tag_exclusion(spark, sf):
    g = FX.games(spark, sf)
    return g.select("game_id", L.list_length("genres").alias("n_all"), F.size(L.clean_tags("genres", ["PROMO", "ECONOMY"])).alias("n_kept"))


@register("multi_hot", with_views(f"""
SELECT game_id, (SELECT string_agg(CASE WHEN list_contains(dl, c) THEN '1' ELSE '0' END, '' ORDER BY c)
                 FROM classes) AS bits
FROM (SELECT game_id, {_dlist('categories')} AS dl FROM g)""", "g", extra=[
    f"classes AS (SELECT DISTINCT unnest({_dlist('categories')}) AS c FROM g)"]))
def q_multi_hot(spark, sf):
    g = FX.games(spark, sf)
    mh = TG.MultiHot("categories", "category_").fit(g)
    return mh.transform(g).select("game_id", F.concat(*[F.col(c).cast("string") for c in mh.columns]).alias("bits"))

# ----------------------------------------------------------------- text

from prelaunch.operators import text as TXO  # noqa: E402

# The short stop-word list of the text fixture queries.
FX_STOP_WORDS = ["the", "and", "of", "to", "a", "in", "is", "it", "that", "for", "on", "with", "as",
                 "by", "this", "are", "be", "at", "or", "an"]
_TOKEN_SQL = r"regexp_extract_all(lower(coalesce(short_description, '') || ' ' || coalesce(detailed_features, '')), '[\p{L}\p{N}_]{2,}')"
_TOKS = f"""toks AS (SELECT doc_id, {_TOKEN_SQL} AS raw,
  list_filter({_TOKEN_SQL}, lambda x: NOT list_contains({FX_STOP_WORDS!r}, x)) AS t FROM d)"""
_TERMS = """terms AS (SELECT doc_id, t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) AS terms FROM toks)"""
_TF = """tf AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(terms) AS term FROM terms) GROUP BY 1, 2)"""
_ST = """st AS (SELECT term, count(*) AS df, sum(n) AS tf FROM tf GROUP BY term)"""
_VOCAB = """vocab AS (
  SELECT term, df, tf, ln((1 + nd.n) / (1 + df)) + 1 AS idf
  FROM st, (SELECT count(*) AS n FROM d) nd WHERE df >= 10 AND df <= 0.7 * nd.n
  ORDER BY tf DESC, term LIMIT 50)"""
_TEXTX = [_TOKS, _TERMS, _TF, _ST, _VOCAB]


def _tfidf() -> TXO.Tfidf:
    return TXO.Tfidf(max_features=50, min_df=10, max_df=0.7, stop_words=FX_STOP_WORDS, ngram_max=2)


def _dtext(df: DataFrame) -> F.Column:
    return TXO.description_text(df)


@register("tokenize", with_views("""
SELECT doc_id, CAST(len(raw) AS INTEGER) AS n_tokens, md5(array_to_string(raw, ' ')) AS tokens_md5 FROM toks""",
    "d", extra=_TEXTX[:1]))
def q_tokenize(spark, sf):
    from prelaunch.functions import text as TX
    d = FX.texts(spark, sf)
    t = TX.tokens(_dtext(d))
    return d.select("doc_id", F.size(t).alias("n_tokens"), F.md5(F.array_join(t, " ")).alias("tokens_md5"))


@register("stop_words", with_views("""
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM toks""",
    "d", extra=_TEXTX[:1]))
def q_stop_words(spark, sf):
    from prelaunch.functions import text as TX
    d = FX.texts(spark, sf)
    t = TX.remove_stop_words(TX.tokens(_dtext(d)), FX_STOP_WORDS)
    return d.select("doc_id", F.size(t).alias("n_tokens"), F.md5(F.array_join(t, " ")).alias("tokens_md5"))


@register("ngrams", with_views("""
SELECT doc_id, CAST(len(terms) AS INTEGER) AS n_terms, md5(array_to_string(terms, '|')) AS terms_md5 FROM terms""",
    "d", extra=_TEXTX[:2]))
def q_ngrams(spark, sf):
    d = FX.texts(spark, sf)
    t = d.select("doc_id", _tfidf().terms(_dtext(d)).alias("t"))
    return t.select("doc_id", F.size("t").alias("n_terms"), F.md5(F.array_join("t", "|")).alias("terms_md5"))


@register("term_frequencies", with_views("SELECT term, df, tf FROM st", "d", extra=_TEXTX[:4]))
def q_term_frequencies(spark, sf):
    d = FX.texts(spark, sf)
    return _tfidf().term_stats(d, _dtext(d), "doc_id").select("term", "df", F.col("tf").cast("bigint"))


@register("vocabulary", with_views("""
SELECT term, df, tf, round(idf, 6) AS idf, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx FROM vocab""",
    "d", extra=_TEXTX))
def q_vocabulary(spark, sf):
    d = FX.texts(spark, sf)
    m = _tfidf()
    n = d.count()
    v = m.vocabulary_frame(m.term_stats(d, _dtext(d), "doc_id"), n)
    from pyspark.sql import Window
    return v.select("term", "df", F.col("tf").cast("bigint"), r6("idf").alias("idf"),
                    (F.row_number().over(Window.orderBy("term")) - 1).cast("int").alias("idx"))


@register("tfidf_weights", with_views("""
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf
FROM (SELECT tf.doc_id, tf.term, tf.n * v.idf AS w FROM tf JOIN vocab v ON tf.term = v.term)""",
    "d", extra=_TEXTX))
def q_tfidf_weights(spark, sf):
    d = FX.texts(spark, sf)
    m = _tfidf().fit(d, _dtext(d), "doc_id")
    return m.transform_long(d, _dtext(d), "doc_id").select("doc_id", "term", r6("tfidf").alias("tfidf"))


@register("tfidf_row_norms", with_views("""
SELECT d.doc_id, round(coalesce(x.norm, 0.0), 6) AS l2_norm, coalesce(x.n_terms, 0) AS n_terms FROM d LEFT JOIN (
  SELECT doc_id, sqrt(sum(power(wn, 2))) AS norm, count(*) AS n_terms FROM (
    SELECT doc_id, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS wn
    FROM (SELECT tf.doc_id, tf.term, tf.n * v.idf AS w FROM tf JOIN vocab v ON tf.term = v.term)) GROUP BY doc_id
) x ON d.doc_id = x.doc_id""", "d", extra=_TEXTX))
def q_tfidf_row_norms(spark, sf):
    d = FX.texts(spark, sf)
    m = _tfidf().fit(d, _dtext(d), "doc_id")
    w = m.transform_wide(d, _dtext(d))
    sq = sum(F.col(c) * F.col(c) for c in m.columns)
    nz = sum((F.col(c) != 0).cast("bigint") for c in m.columns)
    return w.select("doc_id", r6(F.sqrt(sq)).alias("l2_norm"), nz.alias("n_terms"))

# ----------------------------------------------------------- evaluation

from prelaunch.operators import evaluate as EV  # noqa: E402


def scored_all(spark, sf) -> DataFrame:
    return EV.stack_results(FX.scored(spark, sf), FX.constant_scored(spark, sf))


_ST = "st AS (SELECT model, game_id, y, proba, pred FROM s UNION ALL SELECT model, game_id, y, proba, pred FROM t)"
_CNT = """cnt AS (SELECT model, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn FROM st GROUP BY model)"""
_MET = """met AS (SELECT model, tp, fp, fn, tn,
  coalesce(CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) END, 0.0) AS precision,
  coalesce(CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) END, 0.0) AS recall,
  coalesce(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) END, 0.0) AS f1 FROM cnt)"""
_PTS = """pts AS (
  SELECT model, score, pos, neg,
         sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS cp, sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS cn,
         sum(pos) OVER (PARTITION BY model) AS np, sum(neg) OVER (PARTITION BY model) AS nn
  FROM (SELECT model, proba AS score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg
        FROM st GROUP BY 1, 2))"""
_CURVE = """cv AS (
  SELECT model, score, cp * 1.0 / (cp + cn) AS precision, CASE WHEN np > 0 THEN cp * 1.0 / np ELSE 1.0 END AS recall,
         CASE WHEN cp - pos + cn - neg = 0 THEN 1.0 ELSE (cp - pos) * 1.0 / (cp - pos + cn - neg) END AS prev_precision,
         CASE WHEN cp - pos + cn - neg = 0 THEN 0.0 WHEN np > 0 THEN (cp - pos) * 1.0 / np ELSE 1.0 END AS prev_recall,
         CASE WHEN nn > 0 THEN cn * 1.0 / nn END AS fpr, CASE WHEN np > 0 THEN cp * 1.0 / np END AS tpr,
         CASE WHEN nn > 0 THEN (cn - neg) * 1.0 / nn END AS prev_fpr, CASE WHEN np > 0 THEN (cp - pos) * 1.0 / np END AS prev_tpr,
         np, nn, cp - pos + cn - neg = 0 AS first
  FROM pts)"""
_AREAS = """areas AS (
  SELECT model, sum((recall - prev_recall) * (precision + prev_precision) / 2) AS pr_auc,
         CASE WHEN max(np) > 0 AND max(nn) > 0 THEN sum((fpr - prev_fpr) * (tpr + prev_tpr) / 2) END AS roc_auc,
         sum((recall - prev_recall) * (precision + CASE WHEN first THEN precision ELSE prev_precision END) / 2) AS pr_auc_spark
  FROM cv GROUP BY model)"""
_CMP = """cmp AS (SELECT met.model, precision, recall, f1, pr_auc, roc_auc, pr_auc_spark FROM met JOIN areas ON met.model = areas.model)"""
_EVX = [_ST, _CNT, _MET, _PTS, _CURVE, _AREAS, _CMP]


@register("confusion_matrix", with_views("""
SELECT * FROM (SELECT model, 0 AS actual, 0 AS predicted, tn AS n FROM cnt UNION ALL SELECT model, 0, 1, fp FROM cnt
  UNION ALL SELECT model, 1, 0, fn FROM cnt UNION ALL SELECT model, 1, 1, tp FROM cnt)""", "s", "t", extra=_EVX[:2]))
def q_confusion(spark, sf):
    return EV.confusion(scored_all(spark, sf))


@register("classification_metrics", with_views("""
SELECT model, tp, fp, fn, tn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM met""",
    "s", "t", extra=_EVX[:3]))
def q_classification_metrics(spark, sf):
    m = EV.classification_metrics(scored_all(spark, sf))
    return m.select("model", "tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@register("cumulative_by_score", with_views("""
SELECT model, score AS proba, pos, neg, cp AS cum_pos, cn AS cum_neg, np AS "P", nn AS "N" FROM pts""",
    "s", "t", extra=_EVX[:4]))
def q_cumulative(spark, sf):
    c = EV.cumulative_by_score(scored_all(spark, sf))
    return c.select("model", "proba", "pos", "neg", "cum_pos", "cum_neg", "P", "N")


@register("pr_curve", with_views("""
SELECT model, score AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM cv
UNION ALL SELECT DISTINCT model, NULL, 1.0, 0.0 FROM cv""", "s", "t", extra=_EVX[:5]))
def q_pr_curve(spark, sf):
    c = EV.pr_curve(scored_all(spark, sf))
    return c.select("model", "threshold", r6("precision").alias("precision"), r6("recall").alias("recall"))


@register("roc_curve", with_views("""
SELECT model, score AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM cv
UNION ALL SELECT DISTINCT model, NULL, 0.0, 0.0 FROM cv""", "s", "t", extra=_EVX[:5]))
def q_roc_curve(spark, sf):
    c = EV.roc_curve(scored_all(spark, sf))
    return c.select("model", "threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@register("roc_curve_reduced", with_views("""
SELECT model, score AS threshold, round(cn * 1.0 / nn, 6) AS fpr, round(cp * 1.0 / np, 6) AS tpr FROM (
  SELECT *, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg FROM pts WINDOW w AS (PARTITION BY model ORDER BY score DESC))
WHERE cp + cn = pos + neg OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT DISTINCT model, NULL, 0.0, 0.0 FROM cv""", "s", "t", extra=_EVX[:5]))
def q_roc_curve_reduced(spark, sf):
    c = EV.roc_curve(scored_all(spark, sf), drop_intermediate=True)
    return c.select("model", "threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@register("pr_auc", with_views("SELECT model, round(pr_auc, 6) AS pr_auc FROM areas", "s", "t", extra=_EVX[:6]))
def q_pr_auc(spark, sf):
    return EV.curve_areas(scored_all(spark, sf)).select("model", r6("pr_auc").alias("pr_auc"))


@register("roc_auc", with_views("SELECT model, round(roc_auc, 6) AS roc_auc FROM areas", "s", "t", extra=_EVX[:6]))
def q_roc_auc(spark, sf):
    return EV.curve_areas(scored_all(spark, sf)).select("model", r6("roc_auc").alias("roc_auc"))


_CMP_COLS = ["precision", "recall", "f1", "pr_auc", "roc_auc"]


@register("model_comparison", with_views(
    "SELECT model, " + ", ".join(f"round({c}, 6) AS {c}" for c in [*_CMP_COLS, "pr_auc_spark"]) + " FROM cmp", "s", "t", extra=_EVX))
def q_model_comparison(spark, sf):
    found = EV.comparison(scored_all(spark, sf), evaluator_area=True)
    return found.select("model", *[r6(c).alias(c) for c in [*_CMP_COLS, "pr_auc_spark"]])


@register("baseline_improvement", with_views("""
SELECT model, round(precision / (SELECT precision FROM cmp WHERE model = 'baseline'), 6) AS precision_ratio FROM cmp""",
    "s", "t", extra=_EVX))
def q_improvement(spark, sf):
    return EV.improvement(EV.comparison(scored_all(spark, sf))).select(
        "model", r6("precision_ratio").alias("precision_ratio"))


_ROI_SQL = f"""
SELECT model, round(precision, 6) AS precision, round(recall, 6) AS recall, round(tp, 6) AS true_positives,
       round(fp, 6) AS false_positives,
       round(CASE WHEN (tp + fp) * {EV.ROI_DEV_COST} > 0 THEN
         (tp * ({EV.ROI_SUCCESS_GROSS} * (1 - {EV.ROI_STORE_CUT}) - {EV.ROI_DEV_COST})
          + fp * ({EV.ROI_FAILURE_GROSS} * (1 - {EV.ROI_STORE_CUT}) - {EV.ROI_DEV_COST})) / ((tp + fp) * {EV.ROI_DEV_COST}) * 100
         ELSE 0.0 END, 6) AS roi_pct
FROM (SELECT model, precision, recall, recall * {int(EV.ROI_GAMES * EV.ROI_SUCCESS_SHARE)} AS tp,
             CASE WHEN precision > 0 THEN recall * {int(EV.ROI_GAMES * EV.ROI_SUCCESS_SHARE)} / precision
                  - recall * {int(EV.ROI_GAMES * EV.ROI_SUCCESS_SHARE)} ELSE 0.0 END AS fp FROM cmp)"""


@register("roi", with_views(_ROI_SQL, "s", "t", extra=_EVX))
def q_roi(spark, sf):
    r = EV.roi(EV.comparison(scored_all(spark, sf)))
    return r.select("model", *[r6(c).alias(c) for c in
                               ("precision", "recall", "true_positives", "false_positives", "roi_pct")])


@register("model_choice", with_views("""
SELECT model, round(precision, 6) AS precision, round(f1, 6) AS f1 FROM cmp ORDER BY precision DESC, f1 DESC, model LIMIT 1""",
    "s", "t", extra=_EVX))
def q_model_choice(spark, sf):
    return EV.choose_model(EV.comparison(scored_all(spark, sf))).select(
        "model", r6("precision").alias("precision"), r6("f1").alias("f1"))


@register("stack_results", with_views("""
SELECT model, count(*) AS n_rows, round(avg(proba), 6) AS mean_proba FROM st GROUP BY model""", "s", "t", extra=_EVX[:1]))
def q_stack_results(spark, sf):
    return scored_all(spark, sf).groupBy("model").agg(F.count(F.lit(1)).alias("n_rows"),
                                                      r6(F.avg("proba")).alias("mean_proba"))


@register("scalar_attach", with_views("""
SELECT game_id, round(proba, 6) AS proba, pred FROM t""", "t"))
def q_scalar_attach(spark, sf):
    return FX.constant_scored(spark, sf).select("game_id", r6("proba").alias("proba"), "pred")

# ------------------------------------------------ encoding, splits, models

import uuid  # noqa: E402

from prelaunch.operators import encode as EN  # noqa: E402
from prelaunch.operators import models as MO  # noqa: E402
from prelaunch.plans import pipeline as PL  # noqa: E402
from prelaunch.plans.features import build_features  # noqa: E402
from prelaunch.session import scratch_path  # noqa: E402

_TRAIN_SQL = f"release_year BETWEEN {FX_TRAIN[0]} AND {FX_TRAIN[1]}"


def _gfill(spark, sf) -> DataFrame:
    return gy(spark, sf).withColumns({"price": S.fill_zero("price"), "achievements": S.log1p_filled("achievements")})


@register("standard_scaling", with_views(f"""
SELECT game_id, round((coalesce(price, 0.0) - m1) / s1, 6) AS num__price,
       round((ln(1 + coalesce(achievements, 0)) - m2) / s2, 6) AS num__achievements
FROM gy, (SELECT avg(coalesce(price, 0.0)) AS m1, CASE WHEN stddev_pop(coalesce(price, 0.0)) > 0 THEN stddev_pop(coalesce(price, 0.0)) ELSE 1 END AS s1,
                 avg(ln(1 + coalesce(achievements, 0))) AS m2,
                 CASE WHEN stddev_pop(ln(1 + coalesce(achievements, 0))) > 0 THEN stddev_pop(ln(1 + coalesce(achievements, 0))) ELSE 1 END AS s2
          FROM gy WHERE {_TRAIN_SQL}) p""", GY))
def q_standard_scaling(spark, sf):
    g = _gfill(spark, sf)
    fs = EN.fit_standard_scaler(C.train_rows(g, train_years=FX_TRAIN), ["price", "achievements"])
    out = fs.stage.transform(g)
    return out.select("game_id", *[r6(c).alias(c) for c in fs.outputs])


@register("one_hot", with_views(f"""
SELECT game_id, (SELECT string_agg(CASE WHEN (c IS NULL AND m IS NULL) OR c = m THEN '1' ELSE '0' END, ''
                                   ORDER BY c NULLS LAST)
                 FROM (SELECT c FROM classes ORDER BY c NULLS LAST OFFSET 1)) AS code
FROM (SELECT game_id, release_month AS m FROM gy)""", GY, extra=[
    f"classes AS (SELECT DISTINCT release_month AS c FROM gy WHERE {_TRAIN_SQL})"]))
def q_one_hot(spark, sf):
    g = gy(spark, sf)
    oh = EN.fit_one_hot(C.train_rows(g, train_years=FX_TRAIN), ["release_month"])
    out = oh.stage.transform(g)
    return out.select("game_id", F.concat(*[F.col(c).cast("int").cast("string") for c in oh.outputs]).alias("code"))


@register("stratified_split", with_views(f"""
SELECT game_id, CASE WHEN row_number() OVER (PARTITION BY success ORDER BY u, game_id)
                          <= floor(0.3 * count(*) OVER (PARTITION BY success) + 0.5) THEN 'test' ELSE 'train' END AS split
FROM (SELECT game_id, success, {hash_uniform_sql('game_id', '42')} AS u FROM g WHERE success IS NOT NULL)""", "g"))
def q_stratified_split(spark, sf):
    g = C.target_not_null(FX.games(spark, sf))
    return EN.stratified_split(g, "success", "game_id", 0.3, "42").select("game_id", "split")


@register("class_weights", with_views(f"""
SELECT success, round((SELECT count(*) FROM gy WHERE {_TRAIN_SQL} AND success IS NOT NULL) * 1.0 / (2 * count(*)), 6) AS weight
FROM gy WHERE {_TRAIN_SQL} AND success IS NOT NULL GROUP BY success""", GY))
def q_class_weights(spark, sf):
    tr = C.train_rows(gy(spark, sf), train_years=FX_TRAIN)
    w = EN.balanced_weights(tr, "success")
    return tr.where(F.col("success").isNotNull()).groupBy("success").agg(
        r6(F.first(EN.weight_column("success", w))).alias("weight"))


@register("positive_weight", with_views(f"""
SELECT round(count(*) FILTER (WHERE success = 0) * 1.0 / count(*) FILTER (WHERE success = 1), 6) AS pos_weight
FROM gy WHERE {_TRAIN_SQL}""", GY))
def q_positive_weight(spark, sf):
    weight = EN.positive_weight(C.train_rows(gy(spark, sf), train_years=FX_TRAIN), "success")
    return gy(spark, sf).groupBy().agg(r6(F.max(F.lit(weight))).alias("pos_weight"))


@register("baseline_predictions", with_views(f"""
SELECT game_id AS key, success AS y, round(p, 6) AS proba, CAST({hash_uniform_sql('game_id', '42')} < p AS INTEGER) AS pred
FROM gy, (SELECT avg(success) AS p FROM gy WHERE {_TRAIN_SQL} AND success IS NOT NULL) b
WHERE release_year >= {FX_TEST} AND success IS NOT NULL""", GY))
def q_baseline_predictions(spark, sf):
    g = C.target_not_null(gy(spark, sf))
    p = MO.baseline_predictions(C.train_rows(g, train_years=FX_TRAIN), C.test_rows(g, test_from=FX_TEST),
                                "success", "game_id")
    return p.select("key", "y", r6("proba").alias("proba"), "pred")


@register("baseline_train_metrics", with_views(f"""
SELECT round(avg(success), 6) AS precision, 1.0 AS recall, round(2 * avg(success) / (1 + avg(success)), 6) AS f1
FROM gy WHERE {_TRAIN_SQL} AND success IS NOT NULL""", GY))
def q_baseline_train_metrics(spark, sf):
    m = MO.baseline_train_metrics(C.train_rows(gy(spark, sf), train_years=FX_TRAIN), "success")
    return m.select(r6("precision").alias("precision"), "recall", r6("f1").alias("f1"))


@register("split_report", with_views(f"""
SELECT split, count(*) AS rows, round(avg(success), 6) AS success_rate FROM (
  SELECT success, CASE WHEN {_TRAIN_SQL} THEN 'train' WHEN release_year >= {FX_TEST} THEN 'test' ELSE 'none' END AS split
  FROM gy WHERE success IS NOT NULL) WHERE split <> 'none' GROUP BY split""", GY))
def q_split_report(spark, sf):
    g = C.temporal_split(C.target_not_null(gy(spark, sf)), train_years=FX_TRAIN, test_from=FX_TEST)
    from prelaunch.plans.features import FeatureSpec
    r = PL.split_report(g, "success", FeatureSpec())
    return r.select("split", "rows", r6("success_rate").alias("success_rate"))


@register("feature_table_roundtrip", with_views("""
SELECT game_id, price, release_year FROM gy""", GY))
def q_feature_table_roundtrip(spark, sf):
    from prelaunch.sources.sinks import read_features, write_features
    path = scratch_path(spark, f"features-{uuid.uuid4().hex}")
    write_features(gy(spark, sf).select("game_id", "price", "release_year"), path, "release_year")
    return read_features(spark, path).select("game_id", "price", F.col("release_year").cast("int"))


def _features(spark, sf):
    """Features of G; the tag lists are learned from the training period only."""
    g = PL._materialise(FX.games(spark, sf))
    return build_features(g, fit_on=C.train_rows(gy_of(g), train_years=FX_TRAIN), key="game_id")


def gy_of(g: DataFrame) -> DataFrame:
    return C.with_release_parts(g)


_FB_SQL = f"""
SELECT game_id, round(coalesce(price, 0.0), 6) AS price, round(ln(1 + coalesce(dlc_count, 0)), 6) AS dlc_count,
       round(ln(1 + coalesce(achievements, 0)), 6) AS achievements, CAST(required_age AS DOUBLE) AS required_age,
       len({_dlist('supported_languages')}) AS language_count,
       CAST(coalesce(windows, false) AS INTEGER) + CAST(coalesce(mac, false) AS INTEGER) + CAST(coalesce(linux, false) AS INTEGER) AS platform_count,
       (SELECT string_agg(CASE WHEN list_contains({_dlist('genres')}, c) THEN '1' ELSE '0' END, '' ORDER BY c) FROM gc) AS genres_bits,
       (SELECT string_agg(CASE WHEN list_contains({_dlist('categories')}, c) THEN '1' ELSE '0' END, '' ORDER BY c) FROM cc) AS categories_bits,
       CAST(coalesce(windows, false) AS INTEGER) AS windows, CAST(coalesce(mac, false) AS INTEGER) AS mac, CAST(coalesce(linux, false) AS INTEGER) AS linux,
       n AS dev_game_count, CAST(coalesce(price, 0.0) = 0 AS INTEGER) AS is_free, release_month, release_quarter,
       CAST(coalesce(release_quarter = 4, false) AS INTEGER) AS released_q4
FROM gy LEFT JOIN (SELECT developers AS dev, count(*) AS n FROM g WHERE developers IS NOT NULL GROUP BY 1) dc ON gy.developers = dc.dev"""


@register("feature_build", with_views(_FB_SQL, GY, extra=[
    f"gc AS (SELECT DISTINCT unnest({_dlist('genres')}) AS c FROM gy WHERE {_TRAIN_SQL})",
    f"cc AS (SELECT DISTINCT unnest({_dlist('categories')}) AS c FROM gy WHERE {_TRAIN_SQL})"]))
def q_feature_build(spark, sf):
    f, spec = _features(spark, sf)
    bits = {p: F.concat(*[F.col(S.quoted(c)).cast("string") for c in spec.categorical_features if c.startswith(f"{p}_")])
            for p in ("genre", "category")}
    ints = ["language_count", "platform_count", "windows", "mac", "linux", "is_free", "release_month", "release_quarter", "released_q4"]
    return f.select("game_id", r6("price").alias("price"), r6("dlc_count").alias("dlc_count"), r6("achievements").alias("achievements"),
                    F.col("required_age").cast("double").alias("required_age"), bits["genre"].alias("genres_bits"),
                    bits["category"].alias("categories_bits"), "dev_game_count", *[F.col(c).cast("int").alias(c) for c in ints])


def _text_games(spark, sf) -> DataFrame:
    """DL with a year and a release date, so that text runs through the whole build: even ids train, odd ids test."""
    return FX.labelled_texts(spark, sf).withColumn("release_year", F.when(F.col("doc_id") % 2 == 0, FX_TRAIN[0]).otherwise(FX_TEST))


_TEXT_YEAR = f"CASE WHEN doc_id % 2 = 0 THEN {FX_TRAIN[0]} ELSE {FX_TEST} END"


@register("text_features", with_views(f"""
SELECT doc_id, length(short_description) AS desc_length, len(regexp_extract_all(short_description, '{S.WORD_RUN}')) AS desc_word_count,
       coalesce(length(detailed_features), 0) AS detailed_features_length,
       len(regexp_extract_all(coalesce(detailed_features, ''), '{S.WORD_RUN}')) AS detailed_features_word_count,
       round(coalesce(n.total, 0), 6) AS tfidf_sum
FROM dl LEFT JOIN (SELECT doc_id AS did, sum(w) / sqrt(sum(w * w)) AS total
                   FROM (SELECT tf.doc_id, tf.n * v.idf AS w FROM tf JOIN vocab_t v ON tf.term = v.term) GROUP BY 1) n ON n.did = dl.doc_id""",
    "d", "dl", extra=_TEXTX[:3] + ["fit AS (SELECT doc_id FROM dl WHERE doc_id % 2 = 0)",
    "st_t AS (SELECT term, count(*) AS df, sum(n) AS tf FROM tf WHERE doc_id IN (SELECT doc_id FROM fit) GROUP BY term)",
    """vocab_t AS (SELECT term, df, tf, ln((1 + nd.n) / (1 + df)) + 1 AS idf FROM st_t, (SELECT count(*) AS n FROM fit) nd
      WHERE df >= 10 AND df <= 0.7 * nd.n ORDER BY tf DESC, term LIMIT 50)"""]))
def q_text_features(spark, sf):
    d = PL._materialise(_text_games(spark, sf))
    f, spec = build_features(d, fit_on=C.train_rows(d, train_years=FX_TRAIN), key="doc_id", tfidf=_tfidf())
    terms = [c for c in spec.numerical_features if c.startswith("tfidf_")]
    total = sum((F.col(S.quoted(c)) for c in terms), F.lit(0.0))
    return f.select("doc_id", "desc_length", "desc_word_count", "detailed_features_length", "detailed_features_word_count",
                    r6(total).alias("tfidf_sum"))


@register("text_model")
def q_text_model(spark, sf):
    """Logistic regression on the lengths and TF-IDF columns of the labelled texts (default stop words)."""
    d = PL._materialise(_text_games(spark, sf))
    f, spec = build_features(d, fit_on=C.train_rows(d, train_years=FX_TRAIN), key="doc_id")
    return PL.train_and_evaluate(f, spec, "doc_id", FX_TRAIN, FX_TEST, models=("baseline", "logistic_regression")).comparison


def _run(spark, sf, models, **kw):
    f, spec = _features(spark, sf)
    return PL.train_and_evaluate(f, spec, "game_id", FX_TRAIN, FX_TEST, models=models, **kw)


@register("logistic_regression")
def q_logistic(spark, sf):
    return _run(spark, sf, ("logistic_regression",)).metrics


@register("random_forest")
def q_forest(spark, sf):
    return _run(spark, sf, ("random_forest",)).metrics


@register("gradient_boosting")
def q_boosting(spark, sf):
    return _run(spark, sf, ("gradient_boosting",)).metrics


@register("feature_importance")
def q_feature_importance(spark, sf):
    return _run(spark, sf, ("random_forest",)).importances


@register("train_evaluate")
def q_train_evaluate(spark, sf):
    r = _run(spark, sf, PL.MODEL_NAMES)
    return r.comparison.select("model", *[r6(c).alias(c) for c in _CMP_COLS])


@register("assembled_features", with_views(f"""
SELECT game_id, name, round(value, 6) AS value FROM (
  SELECT game_id, unnest(['price', 'achievements', 'release_quarter_2', 'release_quarter_3', 'release_quarter_4']) AS name,
         unnest([(coalesce(price, 0.0) - m1) / s1, (ln(1 + coalesce(achievements, 0)) - m2) / s2, CAST(q = 2 AS DOUBLE), CAST(q = 3 AS DOUBLE),
                 CAST(q = 4 AS DOUBLE)]) AS value
  FROM (SELECT *, coalesce(release_quarter, 0) AS q FROM gy),
       (SELECT avg(coalesce(price, 0.0)) AS m1, stddev_pop(coalesce(price, 0.0)) AS s1, avg(ln(1 + coalesce(achievements, 0))) AS m2,
               stddev_pop(ln(1 + coalesce(achievements, 0))) AS s2 FROM gy WHERE {_TRAIN_SQL}) p)""", GY))
def q_assembled_features(spark, sf):
    """Numeric block, then one-hot block, with the slots' names (ENC4, ENC5)."""
    from pyspark.ml.functions import vector_to_array
    g = _gfill(spark, sf)
    train = C.train_rows(g, train_years=FX_TRAIN)
    num, cat = EN.fit_standard_scaler(train, ["price", "achievements"]), EN.fit_one_hot(train, ["release_quarter"], output="vector")
    out = EN.assembler(num, cat).transform(cat.stage.transform(num.stage.transform(g)))
    names = F.array(*[F.lit(n) for n in EN.feature_names(num, cat)])
    cells = F.explode(F.arrays_zip(names.alias("name"), vector_to_array("features").alias("value")))
    return out.select("game_id", cells.alias("c")).select("game_id", "c.name", r6("c.value").alias("value"))


@register("importance_ranking", with_views("""
SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY tag) - 1 AS INTEGER) AS slot, tag AS feature, round(n * 1.0 / sum(n) OVER (), 6) AS importance,
                      CAST(row_number() OVER (ORDER BY n DESC, tag) AS INTEGER) AS rank
               FROM (SELECT tag, count(*) AS n FROM te GROUP BY tag)) WHERE rank <= 5""",
    "g", extra=[_TAGS_EXPLODED.replace("genres", "categories")]))
def q_importance_ranking(spark, sf):
    """Slot values paired with names and ranked (JOI5, TOP5); the values are tag shares, so that SQL can follow."""
    from types import SimpleNamespace

    from pyspark.ml.linalg import Vectors
    rows = TG.tag_bag_union(FX.games(spark, sf), "categories", FX_EXCLUDED).orderBy("tag").collect()
    total = sum(r.n for r in rows)
    fitted = SimpleNamespace(featureImportances=Vectors.dense([r.n / total for r in rows]))
    top = MO.importances(spark, fitted, [r.tag for r in rows], 5)
    return top.select("slot", "feature", r6("importance").alias("importance"), "rank")


@register("score_new_rows", with_views(f"""
SELECT count(*) AS n_scored, 0 AS n_different FROM gy WHERE release_year >= {FX_TEST}""", GY))
def q_score_new_rows(spark, sf):
    """A saved and loaded pipeline scores the test period like the fitted one (MOD7, SNK5)."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    from prelaunch.sources.sinks import save_model
    g = PL._materialise(_gfill(spark, sf).select("game_id", "price", "achievements", "release_year", "success"))
    train = C.train_rows(C.target_not_null(g), train_years=FX_TRAIN).withColumn("label", F.col("success").cast("double"))
    num, cat = EN.fit_standard_scaler(train, ["price", "achievements"]), EN.fit_one_hot(train, [])
    prep = PipelineModel(stages=[*num.stages, EN.assembler(num, cat)])
    fitted = MO.logistic(float(train.count())).setWeightCol("w").fit(prep.transform(train.withColumn("w", F.lit(1.0))))
    model = PipelineModel(stages=[*prep.stages, fitted])
    path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    save_model(model, path)
    new = C.test_rows(g, test_from=FX_TEST)
    here = model.transform(new).select("game_id", vector_to_array("probability")[1].alias("p"))
    there = MO.score_new_rows(path, new).select("game_id", "proba")
    return here.join(there, "game_id").agg(F.count(F.lit(1)).alias("n_scored"),
                                           F.count_if(F.abs(F.col("p") - F.col("proba")) > 1e-12).cast("int").alias("n_different"))


# ------------------------------------------------ sources and sinks round trips


@register("csv_scan", with_views("""
SELECT game_id, price, success, genres FROM g""", "g"))
def q_csv_scan(spark, sf):
    from prelaunch.sources.games import read_games
    path = scratch_path(spark, f"games-csv-{uuid.uuid4().hex}")
    FX.games(spark, sf).write.option("header", True).csv(path)
    return read_games(spark, path).select("game_id", "price", "success", "genres")


@register("results_roundtrip", with_views("""
SELECT model, tp, fp, fn, tn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM met""",
    "s", "t", extra=_EVX[:3]))
def q_results_roundtrip(spark, sf):
    from prelaunch.sources.sinks import read_results, write_results
    path = scratch_path(spark, f"results-{uuid.uuid4().hex}")
    write_results({"metrics": EV.classification_metrics(scored_all(spark, sf))}, path)
    m = read_results(spark, path, ["metrics"])["metrics"]
    return m.select("model", "tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@register("summary_roundtrip", ORACLE["summary_stats"])
def q_summary_roundtrip(spark, sf):
    from prelaunch.sources.sinks import write_summary
    path = scratch_path(spark, f"summary-{uuid.uuid4().hex}")
    write_summary(QUERIES["summary_stats"](spark, sf), path)
    s = spark.read.json(path)
    return s.select("total_games", "success_rate", "date_range", "class_imbalance_ratio",
                    "features_with_missing_data", "temporal_decline")


@register("tfidf_fit_subset", with_views("""
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf
FROM (SELECT tf.doc_id, tf.term, tf.n * v.idf AS w FROM tf JOIN vocab_en v ON tf.term = v.term)""",
    "d", extra=_TEXTX[:3] + ["""st_en AS (SELECT term, count(*) AS df, sum(n) AS tf FROM tf
      WHERE doc_id IN (SELECT doc_id FROM d WHERE lang = 'en') GROUP BY term)""", """vocab_en AS (
  SELECT term, df, tf, ln((1 + nd.n) / (1 + df)) + 1 AS idf
  FROM st_en, (SELECT count(*) AS n FROM d WHERE lang = 'en') nd WHERE df >= 10 AND df <= 0.7 * nd.n
  ORDER BY tf DESC, term LIMIT 50)"""]))
def q_tfidf_fit_subset(spark, sf):
    d = FX.texts(spark, sf)
    en = d.where(F.col("lang") == "en")
    m = _tfidf().fit(en, _dtext(en))
    return m.transform_long(d, _dtext(d), "doc_id").select("doc_id", "term", r6("tfidf").alias("tfidf"))


_CORR_LONG_BODY = _corr_sql().rsplit("\nSELECT * FROM (", 1)[1][:-1]


@register("correlation_wide", with_views("SELECT var_a, " + ", ".join(
    f"max(CASE WHEN var_b = '{b}' THEN corr END) AS {b}" for b in _CORR_VARS) + " FROM corr_long GROUP BY var_a",
    GY, extra=[_GE, "corr_long AS (" + _CORR_LONG_BODY + ")"]))
def q_correlation_wide(spark, sf):
    w = P.correlation_wide(gy_eda(spark, sf), _CORR_VARS)
    return w.select("var_a", *[r6(c).alias(c) for c in _CORR_VARS])


@register("predictions_roundtrip", with_views("""
SELECT model, count(*) AS rows, count(*) FILTER (WHERE pred = 1) AS positives, round(sum(proba), 4) AS total FROM s GROUP BY model""", "s"))
def q_predictions_roundtrip(spark, sf):
    """Per-row predictions written by model and read again (SNK4)."""
    from prelaunch.sources.sinks import write_predictions
    path = scratch_path(spark, f"predictions-{uuid.uuid4().hex}")
    write_predictions(FX.scored(spark, sf), path)
    return spark.read.parquet(path).groupBy("model").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("pred") == 1).alias("positives"),
                                                         F.round(F.sum("proba"), 4).alias("total"))


@register("present_columns", with_views("""
SELECT c AS column_name, CASE c WHEN 'price' THEN count(price) ELSE count(genres) END AS n FROM g, (SELECT unnest(['price', 'genres']) AS c) GROUP BY c""", "g"))
def q_present_columns(spark, sf):
    """Only the wanted columns that exist are counted (SRC3)."""
    from prelaunch.sources.tables import present
    g = FX.games(spark, sf)
    cols = present(g, ["price", "peak_ccu", "genres", "tags"])
    wide = g.agg(*[F.count(c).alias(c) for c in cols])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in cols])).alias("r")).select("r.*")


@register("input_check", """
SELECT 'documents' AS name, true AS found, (SELECT count(*) FROM documents) AS rows UNION ALL SELECT 'no_such_table', false, 0""")
def q_input_check(spark, sf):
    """A missing input is reported before anything is read (SRC4)."""
    from prelaunch.sources.tables import read_table
    out = None
    for name in ("documents", "no_such_table"):
        try:
            one = read_table(spark, sf, name, ["doc_id"]).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("name"), F.lit(True).alias("found"), "rows")
        except Exception as e:  # local paths raise FileNotFoundError, remote ones the reader's PATH_NOT_FOUND
            if not isinstance(e, FileNotFoundError) and "PATH_NOT_FOUND" not in str(e):
                raise
            one = read_table(spark, sf, "region", ["r_regionkey"]).groupBy().agg(F.lit(0).cast("long").alias("rows")).select(
                F.lit(name).alias("name"), F.lit(False).alias("found"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


# Text with commas, quotes, bare words and junk around list literals, made from part names.
def _edge_literal() -> F.Column:
    k = F.col("p_partkey") % 7
    name, size = F.col("p_name"), F.col("p_size").cast("string")
    return F.when(k == 0, F.concat(F.lit("['"), name, F.lit("'] junk"))).when(k == 1, F.concat(F.lit("['"), name, F.lit("',, 'x']"))).otherwise(
        F.concat(F.lit("['"), name, F.lit(", None, [x]', \"it's\", 'caf\\xe9', None, "), size, F.lit(", ]")))


@register("list_decode_edge", """
SELECT p_partkey, CASE WHEN p_partkey % 7 < 2 THEN '' ELSE p_name || ', None, [x]|it''s|café|' || CAST(p_size AS VARCHAR) END AS items,
       p_partkey % 7 < 2 AS undecodable FROM part""")
def q_list_decode_edge(spark, sf):
    from prelaunch.sources.tables import read_table
    p = read_table(spark, sf, "part", ["p_partkey", "p_name", "p_size"]).withColumn("v", _edge_literal())
    return p.select("p_partkey", F.array_join(L.decode_list("v"), "|").alias("items"), L.undecodable("v").alias("undecodable"))


@register("csv_mixed", with_views("""
SELECT game_id, success, estimated_owners, release_year FROM gy""", GY))
def q_csv_mixed(spark, sf):
    """Integers spelled as floats and three date forms, as other tools write them (SRC1, SCA5)."""
    from prelaunch.sources.games import read_games
    path = scratch_path(spark, f"games-mixed-{uuid.uuid4().hex}")
    d = S.parse_date("release_date")
    g = FX.games(spark, sf).select("game_id", F.col("success").cast("double").cast("string").alias("success"),
                                   F.col("estimated_owners").cast("double").cast("string").alias("estimated_owners"),
                                   F.when(F.col("game_id") % 3 == 0, F.date_format(d, "MMM d, yyyy")).when(
                                       F.col("game_id") % 3 == 1, F.date_format(d, "yyyy/MM/dd")).otherwise(F.col("release_date")).alias("release_date"))
    g.write.option("header", True).csv(path)
    back = C.with_release_parts(read_games(spark, path))
    return back.select("game_id", "success", "estimated_owners", "release_year")


@register("lifecycle_roundtrip", with_views(f"""
SELECT 'features' AS name, count(*) AS rows FROM gy UNION ALL SELECT 'spec', 1 UNION ALL SELECT 'comparison', 4 UNION ALL SELECT 'confusion', 16
UNION ALL SELECT 'data_info', 2 UNION ALL SELECT 'metrics', 32 UNION ALL SELECT 'importances', 15
UNION ALL SELECT 'predictions', 4 * count(*) FROM gy WHERE release_year >= {FX_TEST} AND success IS NOT NULL
UNION ALL SELECT 'rescored', count(*) FROM gy WHERE release_year >= {FX_TEST} AND success IS NOT NULL""", GY))
def q_lifecycle(spark, sf):
    """The whole run with all four models: the written tables, read back and counted, and the saved model loaded to score the test
    rows again (SNK1-SNK5); rows whose score the written predictions do not have would not be counted."""
    path = scratch_path(spark, f"run-{uuid.uuid4().hex}")
    PL.run(FX.games(spark, sf), path, train_years=FX_TRAIN, test_from=FX_TEST)
    tables = {"features": "features", **{n: f"results/{n}" for n in ("comparison", "confusion", "data_info", "metrics", "importances")}, "predictions": "predictions"}
    out = spark.read.text(f"{path}/spec").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("spec").alias("name"), "rows")
    for name, at in tables.items():
        out = out.unionByName(spark.read.parquet(f"{path}/{at}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows"))
    new = C.test_rows(C.target_not_null(spark.read.parquet(f"{path}/features")), test_from=FX_TEST)
    again = MO.score_new_rows(f"{path}/model", new).select(F.col("game_id").alias("key"), F.col("proba").alias("p"))
    before = spark.read.parquet(f"{path}/predictions").where(F.col("model") == PL.SAVED_MODEL)
    same = again.join(before, "key").where(F.abs(F.col("p") - F.col("proba")) <= 1e-12)
    return out.unionByName(same.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("rescored").alias("name"), "rows"))


# ------------------------------------------------ estimators of any kind, dictionaries, guards


@register("leakage_report", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {str(c in C.POST_LAUNCH_COLUMNS).lower()} AS post_launch, count({c}) AS n_present FROM gy" for c in _MISSING_COLS), GY))
def q_leakage_report(spark, sf):
    return C.leakage_report(gy(spark, sf), _MISSING_COLS)


_LINEAR_ROWS = f"""lr AS (
  SELECT CASE WHEN {_TRAIN_SQL} THEN 'train' ELSE 'test' END AS split, CAST(success AS INTEGER) AS y, coalesce(price, 0.0) AS x
  FROM gy WHERE success IS NOT NULL AND ({_TRAIN_SQL} OR release_year >= {FX_TEST})),
ls AS (SELECT split, y, x * slope + intercept AS score, CAST(x * slope + intercept >= 0.3 AS INTEGER) AS pred
       FROM lr, (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM lr WHERE split = 'train') f),
lc AS (SELECT split, count(*) FILTER (WHERE y = 1 AND pred = 1) * 1.0 AS tp, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
              count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn FROM ls GROUP BY split),
lp AS (SELECT pos, neg, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER () AS np, sum(neg) OVER () AS nn
       FROM (SELECT score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM ls WHERE split = 'test' GROUP BY 1)
       WINDOW w AS (ORDER BY score DESC)),
la AS (SELECT sum(pos * 1.0 / np * (cp * 1.0 / (cp + cn) + CASE WHEN cp + cn = pos + neg THEN 1.0 ELSE (cp - pos) * 1.0 / (cp - pos + cn - neg) END) / 2) AS pr_auc,
              sum(neg * 1.0 / nn * (cp + cp - pos) * 1.0 / np / 2) AS roc_auc FROM lp)"""


@register("evaluate_any_estimator", with_views("""
SELECT 'linear' AS model, split, metric, round(value, 6) AS value FROM (
  SELECT split, unnest(['precision', 'recall', 'f1']) AS metric,
         unnest([CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END,
                 CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END]) AS value FROM lc
  UNION ALL SELECT 'test', 'pr_auc', pr_auc FROM la UNION ALL SELECT 'test', 'roc_auc', roc_auc FROM la)""", GY, extra=[_LINEAR_ROWS]))
def q_evaluate_any_estimator(spark, sf):
    """A pipeline that ends in a regressor, fitted and judged by the evaluation driver: least squares on the price, which SQL can
    follow (MOD6, UDF4)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    g = C.target_not_null(gy(spark, sf)).select("game_id", "release_year", F.col("success").cast("double").alias("label"), S.fill_zero("price").alias("price"))
    estimator = Pipeline(stages=[VectorAssembler(inputCols=["price"], outputCol="features"), LinearRegression(solver="normal")])
    done = PL.evaluate(estimator, C.train_rows(g, train_years=FX_TRAIN), C.test_rows(g, test_from=FX_TEST), "linear", "game_id", threshold=0.3)
    return done.metrics().select("model", "split", "metric", r6("value").alias("value"))


@register("models_closed_form", with_views("""
SELECT m.model, x AS mac, round(CASE WHEN m.model = 'gradient_boosting' THEN 1 / (1 + exp(-2 * (2 * p - 1))) ELSE p END, 4) AS proba
FROM (SELECT x, s / q / (s / q + (1 - s) / (1 - q)) AS p FROM
        (SELECT CAST(coalesce(mac, false) AS INTEGER) AS x, avg(success) AS s FROM gy WHERE success IS NOT NULL GROUP BY 1),
        (SELECT avg(success) AS q FROM gy WHERE success IS NOT NULL)),
     (SELECT unnest(['logistic_regression', 'random_forest', 'gradient_boosting']) AS model) m""", GY))
def q_models_closed_form(spark, sf):
    """The three estimators where their fit has a closed form, one 0/1 feature and balanced classes: unpenalised logistic
    regression and a tree of one split give the classes' weighted shares, one boosting round its logistic transform (MOD3-MOD5)."""
    from pyspark.ml.feature import VectorAssembler
    g = PL._materialise(C.target_not_null(gy(spark, sf)).select(F.col("success").cast("double").alias("label"), S.flag01("mac").alias("mac")))
    g = PL.dealt(g).withColumn("weight", EN.weight_column("label", EN.balanced_weights(g, "label")))
    v = VectorAssembler(inputCols=["mac"], outputCol="features").transform(g)
    estimators = {"logistic_regression": MO.logistic(1.0, c=1e9, tol=1e-9), "random_forest": MO.forest(trees=1, max_depth=1).setBootstrap(False),
                  "gradient_boosting": MO.boosted(rounds=1, max_depth=1)}
    out = None
    for name, estimator in estimators.items():
        fitted = estimator.fit(v)
        score, _ = MO.score_and_prediction(fitted)
        got = fitted.transform(v).groupBy("mac").agg(F.max(score).alias("p")).select(F.lit(name).alias("model"), "mac", F.round("p", 4).alias("proba"))
        out = got if out is None else out.unionByName(got)
    return out


@register("importance_total", with_views("SELECT 3 AS n_features, 1.0 AS total, 0 AS n_negative, 'price' AS first FROM gy LIMIT 1", GY))
def q_importance_total(spark, sf):
    """Importances of a forest: none negative, together 1, the label's own driver first (MOD8, TOP5). The label is whether the
    price is above 10, so the price must lead."""
    from pyspark.ml.feature import VectorAssembler
    g = PL._materialise(gy(spark, sf).select((S.fill_zero("price") > 10).cast("double").alias("label"), S.fill_zero("price").alias("price"),
                                             S.flag01("mac").alias("mac"), S.flag01("linux").alias("linux"), F.lit(1.0).alias("weight")))
    cols = ["price", "mac", "linux"]
    fitted = MO.forest(trees=10, max_depth=4).fit(VectorAssembler(inputCols=cols, outputCol="features").transform(PL.dealt(g)))
    ranked = MO.importances(spark, fitted, cols, None)
    return ranked.agg(F.count(F.lit(1)).cast("int").alias("n_features"), r6(F.sum("importance")).alias("total"),
                      F.count_if(F.col("importance") < 0).cast("int").alias("n_negative"), F.max(F.when(F.col("rank") == 1, F.col("feature"))).alias("first"))


_VALUE_SQL = """CASE game_id % 5 WHEN 0 THEN 1e7 WHEN 1 THEN 1e-4 WHEN 2 THEN CAST(NULL AS DOUBLE) WHEN 3 THEN CAST(price AS DOUBLE) ELSE 2.5 END"""


def _slot_sql(kept: int) -> str:
    return f"""
SELECT v.game_id, CAST(CASE WHEN slot >= {kept} THEN slot - {kept} ELSE -1 END AS INTEGER) AS slot
FROM (SELECT game_id, {_VALUE_SQL} AS x FROM gy) v
LEFT JOIN (SELECT x, row_number() OVER (ORDER BY x NULLS LAST) - 1 AS slot FROM (SELECT DISTINCT {_VALUE_SQL} AS x FROM gy WHERE {_TRAIN_SQL})) d
  ON d.x IS NOT DISTINCT FROM v.x"""


def _valued(spark, sf) -> DataFrame:
    v = (F.when(F.col("game_id") % 5 == 0, 1e7).when(F.col("game_id") % 5 == 1, 1e-4).when(F.col("game_id") % 5 == 2, F.lit(None).cast("double"))
         .when(F.col("game_id") % 5 == 3, F.col("price").cast("double")).otherwise(2.5))
    return gy(spark, sf).select("game_id", "release_year", v.alias("x"))


def _slot_of(vector: str) -> F.Column:
    """The slot of a one-hot vector's only entry, -1 without one."""
    from pyspark.ml.functions import vector_to_array
    return (F.array_position(vector_to_array(vector), 1.0) - 1).cast("int")


@register("one_hot_values", with_views(_slot_sql(1), GY))
def q_one_hot_values(spark, sf):
    """One-hot of doubles, a null and values of extreme size, in vector form by the default encoder (ENC3)."""
    g = PL._materialise(_valued(spark, sf))
    oh = EN.fit_one_hot(C.train_rows(g, train_years=FX_TRAIN), ["x"], output="vector")
    return oh.stage.transform(g).select("game_id", _slot_of(oh.outputs[0]).alias("slot"))


@register("dictionary_values", with_views(_slot_sql(0), GY))
def q_dictionary_values(spark, sf):
    """The same values numbered by a dictionary table, joined in (ENC3)."""
    from prelaunch.operators.dictionary import fit_value_encoder
    g = PL._materialise(_valued(spark, sf))
    encoder = fit_value_encoder(C.train_rows(g, train_years=FX_TRAIN), "x", "v", drop_first=False)
    return encoder.transform(g).select("game_id", _slot_of("v").alias("slot"))


@register("dictionary_tags", with_views(f"""
SELECT game_id, coalesce((SELECT string_agg(CAST(slot AS VARCHAR), ',' ORDER BY slot) FROM tc WHERE list_contains({_dlist('categories')}, c)), '') AS slots FROM gy""",
    GY, extra=[f"tc AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS slot FROM (SELECT DISTINCT unnest({_dlist('categories')}) AS c FROM gy WHERE {_TRAIN_SQL}) WHERE c IS NOT NULL)"]))
def q_dictionary_tags(spark, sf):
    """Tag lists as multi-hot vectors by a dictionary table of the training period's tags (ENC1)."""
    from pyspark.ml.functions import vector_to_array

    from prelaunch.operators.dictionary import fit_list_encoder
    g = PL._materialise(gy(spark, sf).select("game_id", "release_year", L.decode_list("categories").alias("items")))
    encoder = fit_list_encoder(C.train_rows(g, train_years=FX_TRAIN), "items", "v")
    cells = F.transform(vector_to_array("v"), lambda x, i: F.when(x > 0, i))
    slots = F.array_join(F.filter(cells, lambda i: i.isNotNull()).cast("array<string>"), ",")
    return encoder.transform(g).select("game_id", slots.alias("slots"))


@register("developer_count_salted", ORACLE["developer_game_count"])
def q_developer_count_salted(spark, sf):
    """Counts mapped back by a shuffled join that salts hot keys only, whatever the size of the counts (JOI1)."""
    cols = QUERIES["developer_game_count"](spark, sf).columns
    return C.with_developer_count(FX.games(spark, sf), broadcast_bytes=-1).select(*cols)


_PROFILED = ["price", "achievements", "dlc_count", "estimated_owners", "developers", "genres"]
_PROFILED_NUMBERS = _PROFILED[:4]


@register("merged_profile", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
    + (f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, " if c in _PROFILED_NUMBERS
       else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, ")
    + f"true AS distinct_ok, {'true' if c in _PROFILED_NUMBERS else 'CAST(NULL AS BOOLEAN)'} AS median_ok FROM gy" for c in _PROFILED), GY))
def q_merged_profile(spark, sf):
    """Two halves of G profiled apart, stored, read back and merged: exact parts as of the whole, sketches within their error."""
    from prelaunch.operators import sketches as SK
    from prelaunch.operators.dictionary import distinct_values
    g = PL._materialise(gy(spark, sf).select("game_id", *_PROFILED))
    path = scratch_path(spark, f"profile-{uuid.uuid4().hex}")
    for half in (0, 1):
        SK.profile_sketch(g.where(F.col("game_id") % 2 == half), _PROFILED).write.parquet(f"{path}/{half}")
    merged = PL._materialise(SK.merge_profiles(*[spark.read.parquet(f"{path}/{half}") for half in (0, 1)]))
    out = SK.summarise(merged)
    exact = None
    for values in distinct_values(g, _PROFILED).values():
        one = values.where("value is not null").groupBy("at").agg(F.count(F.lit(1)).alias("exact"))
        exact = one if exact is None else exact.unionByName(one)
    names = F.element_at(F.array(*[F.lit(c) for c in _PROFILED]), F.col("at") + 1)
    out = out.join(exact.select(names.alias("column_name"), "exact"), "column_name")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in _PROFILED_NUMBERS]))
    ranks = (g.select(cells.alias("c")).select("c.*").where("v is not null").join(out.select("column_name", "median"), "column_name").groupBy("column_name")
             .agg(F.avg((F.col("v") < F.col("median")).cast("double")).alias("below"), F.avg((F.col("v") <= F.col("median")).cast("double")).alias("upto")))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= 0.05 * F.col("exact") + 1
    return out.join(ranks, "column_name", "left").select(
        "column_name", "n", "n_missing", r6("mean").alias("mean"), r6("std").alias("std"), "min", "max", near.alias("distinct_ok"),
        ((F.col("below") <= 0.53) & (F.col("upto") >= 0.47)).alias("median_ok"))

"""DuckDB oracle SQL for every registered query that SQL can express.

Written from the warehouse models' SQL and the dashboard's pandas semantics,
not from the Spark plans: the dashboard metrics here are computed over the
literal joined frame (one row per review), whereas the Spark side uses
weighted pre-aggregates.  Guards shared by both sides (see SURVEY §2.13):
numbers and ISO dates are cast only when they match a plain pattern;
averages are compared at 6 decimals.
"""

from __future__ import annotations

from storelens.sources.schemas import NA_TOKENS

NUM_RE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
DATE_RE = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s*$"
STRIP = r"'^\s+|\s+$'"
NA_LIST = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)


def num(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '{NUM_RE}') THEN TRY_CAST({x} AS DOUBLE) END)"


def na(c: str) -> str:
    return f"(CASE WHEN {c} IN ({NA_LIST}) THEN NULL ELSE {c} END) AS {c}"


def key(*cols: str) -> str:
    return "md5(" + " || ".join(f"coalesce(CAST({c} AS VARCHAR), '_')" for c in cols) + ")"


def exact_mean(col: str, digits: int, scale: int = 6) -> str:
    """Mean rounded half away from zero to ``digits`` decimals, computed in
    integer 10**-scale units (order-independent)."""
    units = f"CAST(round({col} * {10 ** scale}) AS HUGEINT)"
    total = f"sum({units})"
    count = f"CAST(count({col}) AS HUGEINT)"
    step = 10 ** (scale - digits)
    half = f"((2 * abs({total}) + {count} * {step}) // (2 * {count} * {step}))"
    return (f"(CASE WHEN {count} > 0 THEN CAST(CASE WHEN {total} < 0 THEN -{half} ELSE {half} END "
            f"AS DOUBLE) / {10 ** digits} END)")


APP_COLS = ("App", "Category", "Rating", "Reviews", "Size", "Installs", "Type", "Price",
            "Content_Rating", "Genres", "Last_Updated", "Current_Ver", "Android_Ver")
REVIEW_COLS = ("App", "Translated_Review", "Sentiment", "Sentiment_Polarity",
               "Sentiment_Subjectivity")

CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTE[name] = (deps, sql)


cte("raw_apps", (), """
SELECT p_name || ' ' || p_brand AS App,
 CASE WHEN p_partkey % 29 = 0 THEN NULL ELSE p_type END AS Category,
 CASE WHEN p_partkey % 10 = 0 THEN 'NaN' ELSE CAST(1 + (p_partkey % 41) / CAST(10 AS DOUBLE) AS STRING) END AS Rating,
 CAST(p_partkey * 7 % 1000 AS STRING) AS Reviews,
 CASE WHEN p_partkey % 4 = 0 THEN 'Varies with device' WHEN p_partkey % 4 = 1 THEN CAST(p_size AS STRING) || 'M' WHEN p_partkey % 4 = 2 THEN CAST(p_size AS STRING) || '.5k' ELSE CAST(p_size AS STRING) || 'G' END AS Size,
 CASE WHEN p_partkey % 13 = 0 THEN 'Free' ELSE CAST(p_size AS STRING) || ',000+' END AS Installs,
 CASE WHEN p_partkey % 3 = 0 THEN 'Free' ELSE 'Paid' END AS Type,
 CASE WHEN p_partkey % 3 = 0 THEN '0' WHEN p_partkey % 17 = 0 THEN 'Everyone' ELSE '$' || CAST(p_retailprice AS STRING) END AS Price,
 CASE WHEN p_size < 10 THEN 'Everyone' WHEN p_size < 30 THEN 'Teen' ELSE NULL END AS Content_Rating,
 CASE WHEN p_partkey % 5 = 0 THEN p_name || ' ' || p_brand ELSE p_brand END AS Genres,
 CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN '2018-01-' || CAST(10 + p_size % 20 AS STRING) ELSE 'January 7, 2018' END AS Last_Updated,
 CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_size % 5 AS STRING) || '.0' END AS Current_Ver,
 CAST(4 + p_size % 3 AS STRING) || '.1 and up' AS Android_Ver
FROM part""")

cte("raw_reviews", (), """
SELECT p.p_name || ' ' || p.p_brand AS App,
 CASE WHEN l_linenumber = 7 THEN NULL ELSE 'review ' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) END AS Translated_Review,
 CASE WHEN l_linenumber = 6 THEN NULL WHEN l_returnflag = 'A' THEN 'Positive' WHEN l_returnflag = 'N' THEN 'Neutral' ELSE 'Negative' END AS Sentiment,
 CASE WHEN l_linenumber = 5 THEN 'NULL' ELSE CAST(l_discount * 20 - 1 AS STRING) END AS Sentiment_Polarity,
 CASE WHEN l_linenumber = 5 THEN 'nan' ELSE CAST(l_tax * 10 AS STRING) END AS Sentiment_Subjectivity
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")

cte("na_apps", ("raw_apps",), "SELECT " + ", ".join(na(c) for c in APP_COLS) + " FROM raw_apps")
cte("na_reviews", ("raw_reviews",),
    "SELECT " + ", ".join(na(c) for c in REVIEW_COLS) + " FROM raw_reviews")

cte("clean_apps", ("na_apps",), f"""
SELECT App,
 coalesce(Category, 'UNKNOWN') AS Category,
 coalesce({num('Rating')}, CAST(0.0 AS DOUBLE)) AS Rating,
 coalesce(Reviews, '0') AS Reviews,
 coalesce(Size, 'Varies with device') AS Size,
 coalesce(TRY_CAST(inst AS BIGINT), CAST(0 AS BIGINT)) AS Installs,
 coalesce(Type, 'Free') AS Type,
 coalesce({num(f"regexp_replace(replace(coalesce(Price, '0'), '$', ''), {STRIP}, '', 'g')")}, CAST(0.0 AS DOUBLE)) AS Price,
 coalesce(Content_Rating, 'Everyone') AS Content_Rating,
 coalesce(Genres, 'Unknown') AS Genres,
 coalesce(Last_Updated, 'Unknown') AS Last_Updated,
 coalesce(Current_Ver, 'Varies with device') AS Current_Ver,
 coalesce(Android_Ver, 'Varies with device') AS Android_Ver
FROM (SELECT *, regexp_replace(replace(replace(Installs, ',', ''), '+', ''), {STRIP}, '', 'g') AS inst
      FROM na_apps) s
WHERE App IS NOT NULL AND regexp_matches(inst, '^[0-9]+$')""")

cte("clean_reviews", ("na_reviews",), """
SELECT App, Translated_Review,
 coalesce(Sentiment, 'Neutral') AS Sentiment,
 coalesce(Sentiment_Polarity, '0.0') AS Sentiment_Polarity,
 coalesce(Sentiment_Subjectivity, '0.0') AS Sentiment_Subjectivity
FROM na_reviews
WHERE App IS NOT NULL AND Translated_Review IS NOT NULL""")

cte("stg_apps", ("clean_apps",), f"""
SELECT App AS app_name, Category AS app_category, Rating AS app_rating, Reviews AS reviews_text,
 CASE WHEN Size = 'Varies with device' THEN NULL
      WHEN Size LIKE '%M' THEN {num("replace(Size, 'M', '')")} * 1024 * 1024
      WHEN Size LIKE '%k' THEN {num("replace(Size, 'k', '')")} * 1024
      ELSE NULL END AS app_size_bytes,
 Installs AS installs_int, Type AS app_type, Price AS app_price,
 Content_Rating AS content_rating, Genres AS app_genres,
 CASE WHEN regexp_matches(Last_Updated, '{DATE_RE}') THEN TRY_CAST(Last_Updated AS DATE) END AS last_updated_date,
 Current_Ver AS current_version, Android_Ver AS android_version,
 {key('App', 'Last_Updated', 'Current_Ver')} AS source_unique_key
FROM clean_apps
WHERE App IS NOT NULL AND Installs IS NOT NULL""")

cte("stg_reviews", ("clean_reviews",), f"""
SELECT App AS app_name, Translated_Review AS review_text, Sentiment AS review_sentiment,
 {num("NULLIF(CAST(Sentiment_Subjectivity AS VARCHAR), 'NULL')")} AS subjectivity,
 {num("NULLIF(CAST(Sentiment_Polarity AS VARCHAR), 'NULL')")} AS polarity,
 {key('App', 'Translated_Review')} AS source_unique_key
FROM clean_reviews
WHERE Translated_Review IS NOT NULL""")

cte("dim_apps", ("stg_apps",), f"""
SELECT {key('app_name', 'current_version')} AS app_id, app_name, app_size_bytes, app_price,
 content_rating, last_updated_date, current_version, android_version, source_unique_key
FROM stg_apps
GROUP BY app_name, app_size_bytes, app_price, content_rating, last_updated_date,
 current_version, android_version, source_unique_key""")

cte("dim_categories", ("stg_apps",), f"""
SELECT {key('app_category', 'app_genres')} AS category_id, app_category, app_genres
FROM stg_apps WHERE app_category IS NOT NULL
GROUP BY app_category, app_genres""")

cte("reviews_agg", ("stg_reviews",), """
SELECT app_name,
 AVG(CASE WHEN lower(review_sentiment) = 'positive' THEN CAST(1.0 AS DOUBLE)
          WHEN lower(review_sentiment) = 'neutral' THEN CAST(0.5 AS DOUBLE)
          WHEN lower(review_sentiment) = 'negative' THEN CAST(0.0 AS DOUBLE)
          ELSE NULL END) AS avg_sentiment,
 COUNT(*) AS total_reviews
FROM stg_reviews GROUP BY app_name""")

cte("fact", ("dim_apps", "dim_categories", "reviews_agg"), """
SELECT a.app_id, a.app_name, c.app_category, c.app_genres, a.app_price, a.content_rating,
 a.android_version, a.current_version, r.avg_sentiment, r.total_reviews
FROM dim_apps a
LEFT JOIN dim_categories c ON a.app_name = c.app_genres
LEFT JOIN reviews_agg r ON a.app_name = r.app_name""")

cte("fact_keyed", ("stg_apps", "reviews_agg"), f"""
SELECT k.app_id, k.app_name, k.category_id, k.app_price, k.average_user_rating,
 k.total_installs, r.avg_sentiment, r.total_reviews
FROM (SELECT {key('app_name', 'current_version')} AS app_id, app_name,
        {key('app_category', 'app_genres')} AS category_id,
        max(app_price) AS app_price, {exact_mean('app_rating', 6)} AS average_user_rating,
        max(installs_int) AS total_installs
      FROM stg_apps GROUP BY 1, 2, 3) k
LEFT JOIN reviews_agg r ON k.app_name = r.app_name""")

cte("frame", ("fact_keyed", "dim_apps", "dim_categories", "stg_reviews"), """
SELECT da.app_name, dc.app_category AS category_name, da.app_size_bytes,
 fm.app_price AS price, fm.average_user_rating, fm.total_installs, fm.total_reviews,
 da.last_updated_date, sr.review_sentiment,
 CASE WHEN da.app_size_bytes IS NULL OR isnan(da.app_size_bytes) OR isinf(da.app_size_bytes)
      THEN CAST(0 AS DOUBLE) ELSE da.app_size_bytes / CAST(1048576 AS DOUBLE) END AS app_size_mb
FROM fact_keyed fm
JOIN dim_apps da ON fm.app_id = da.app_id
JOIN dim_categories dc ON fm.category_id = dc.category_id
LEFT JOIN stg_reviews sr ON da.app_name = sr.app_name""")

cte("app_rows", ("fact_keyed", "dim_categories"), """
SELECT fm.app_name, dc.app_category AS category_name, fm.app_price AS price,
 fm.average_user_rating, fm.total_installs
FROM fact_keyed fm JOIN dim_categories dc ON fm.category_id = dc.category_id""")


# Where every keyed group's first listing stands in the part file (its key
# counts the rows).
cte("first_places", ("na_apps_placed",), f"""
SELECT {key('App', 'ver')} AS app_id, App AS app_name, {key('cat', 'gen')} AS category_id, min(p_partkey) AS place
FROM (SELECT App, p_partkey, coalesce(Category, 'UNKNOWN') AS cat, coalesce(Genres, 'Unknown') AS gen,
        coalesce(Current_Ver, 'Varies with device') AS ver,
        regexp_replace(replace(replace(Installs, ',', ''), '+', ''), {STRIP}, '', 'g') AS inst
      FROM na_apps_placed) s
WHERE App IS NOT NULL AND regexp_matches(inst, '^[0-9]+$') GROUP BY 1, 2, 3""")

cte("na_apps_placed", (), "SELECT p_partkey, " + ", ".join(na(c) for c in APP_COLS)
    + " FROM (" + CTE["raw_apps"][1].replace("SELECT p_name", "SELECT p_partkey, p_name", 1) + ") s")


def with_ctes(body: str, *roots: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTE[n][0]:
            visit(d)
        order.append(n)

    for r in roots:
        visit(r)
    parts = ",\n".join(f"{n} AS ({CTE[n][1]}\n)" for n in order)
    return f"WITH {parts}\n{body}"


def compact(n: str) -> str:
    """Compact count text, tenths rounded half-up in integers."""
    def unit(d: int, s: str) -> str:
        t = f"(({n} + {d // 20}) // {d // 10})"
        return f"CAST({t} // 10 AS VARCHAR) || '.' || CAST({t} % 10 AS VARCHAR) || '{s}'"
    return (f"CASE WHEN {n} >= 1000000000 THEN {unit(1000000000, 'B')} "
            f"WHEN {n} >= 1000000 THEN {unit(1000000, 'M')} "
            f"WHEN {n} >= 1000 THEN {unit(1000, 'K')} "
            f"ELSE CAST({n} AS VARCHAR) END")


def kpis(source: str, where: str = "TRUE") -> str:
    return with_ctes(f"""
SELECT total_apps, avg_rating, total_installs, {compact('total_installs')} AS installs_display,
 format('{{:,}}', total_apps) AS total_apps_display
FROM (SELECT count(DISTINCT app_name) AS total_apps,
        coalesce({exact_mean('average_user_rating', 2)}, CAST(0.0 AS DOUBLE)) AS avg_rating,
        CAST(coalesce(sum(total_installs), 0) AS BIGINT) AS total_installs
      FROM {source} WHERE {where}) k""", source)


def cat(c: str) -> str:
    return f"coalesce(category_name, 'Unknown') = '{c}'"


def top_rated_apps(where: str = "TRUE") -> str:
    return with_ctes(f"""
SELECT app_name, average_user_rating FROM (
  SELECT app_name, {exact_mean('average_user_rating', 6)} AS average_user_rating
  FROM frame WHERE {where} GROUP BY app_name) g
ORDER BY average_user_rating DESC NULLS LAST, app_name ASC NULLS LAST
LIMIT 10""", "frame")


def sentiment_distribution(where: str = "TRUE") -> str:
    return with_ctes(f"""
SELECT review_sentiment, n, round(CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE), 6) AS share
FROM (SELECT review_sentiment, CAST(count(*) AS BIGINT) AS n FROM frame
      WHERE review_sentiment IS NOT NULL AND {where} GROUP BY review_sentiment) s""", "frame")


ORACLE: dict[str, str] = {
    "clean_apps": with_ctes("SELECT * FROM clean_apps", "clean_apps"),
    "clean_reviews": with_ctes("SELECT * FROM clean_reviews", "clean_reviews"),
    "stg_apps": with_ctes("SELECT * FROM stg_apps", "stg_apps"),
    "stg_reviews": with_ctes("SELECT * FROM stg_reviews", "stg_reviews"),
    "dim_apps": with_ctes("SELECT * FROM dim_apps", "dim_apps"),
    "dim_categories": with_ctes("SELECT * FROM dim_categories", "dim_categories"),
    "fact_app_metrics": with_ctes(
        "SELECT * REPLACE (round(avg_sentiment, 6) AS avg_sentiment) FROM fact", "fact"),
    "fact_app_metrics_keyed": with_ctes(
        "SELECT * REPLACE (round(avg_sentiment, 6) AS avg_sentiment) FROM fact_keyed",
        "fact_keyed"),
    "top_rated": with_ctes("""
SELECT da.app_name, fm.average_user_rating
FROM fact_keyed fm JOIN dim_apps da ON fm.app_id = da.app_id
ORDER BY fm.average_user_rating DESC NULLS LAST, da.app_name ASC NULLS LAST, fm.app_id ASC NULLS LAST
LIMIT 5""", "fact_keyed", "dim_apps"),
    "dashboard_frame": with_ctes("SELECT * FROM frame", "frame"),
    "kpis_row": kpis("frame"),
    "kpis_app": kpis("app_rows"),
    "kpis_category": kpis("frame", cat("PROMO")),
    "kpis_unknown": kpis("frame", cat("Unknown")),
    "top_rated_apps": top_rated_apps(),
    "top_rated_apps_category": top_rated_apps(cat("PROMO")),
    "rating_vs_installs": with_ctes(f"""
SELECT app_name, {exact_mean('average_user_rating', 6)} AS average_user_rating,
 CAST(coalesce(sum(total_installs), 0) AS BIGINT) AS total_installs,
 min(price) AS price, coalesce(min(price), CAST(0.0 AS DOUBLE)) AS price_numeric_viz
FROM frame GROUP BY app_name""", "frame"),
    "rating_vs_installs_sample": with_ctes(f"""
SELECT app_name, {exact_mean('average_user_rating', 6)} AS average_user_rating,
 CAST(coalesce(sum(total_installs), 0) AS BIGINT) AS total_installs,
 min(price) AS price, coalesce(min(price), CAST(0.0 AS DOUBLE)) AS price_numeric_viz
FROM frame GROUP BY app_name
ORDER BY md5(concat_ws('|', '0', coalesce(CAST(app_name AS VARCHAR), ''))), app_name
LIMIT 2000""", "frame"),
    "rating_vs_installs_sample_200": with_ctes(f"""
SELECT app_name, {exact_mean('average_user_rating', 6)} AS average_user_rating,
 CAST(coalesce(sum(total_installs), 0) AS BIGINT) AS total_installs,
 min(price) AS price, coalesce(min(price), CAST(0.0 AS DOUBLE)) AS price_numeric_viz
FROM frame GROUP BY app_name
ORDER BY md5(concat_ws('|', '0', coalesce(CAST(app_name AS VARCHAR), ''))), app_name
LIMIT 200""", "frame"),
    "sentiment_distribution": sentiment_distribution(),
    "sentiment_distribution_category": sentiment_distribution(cat("PROMO")),
    "sentiment_histogram": with_ctes("""
SELECT bin, CAST(bin AS DOUBLE) / 20 AS bin_start, CAST(bin + 1 AS DOUBLE) / 20 AS bin_end, n
FROM (SELECT CAST(greatest(least(floor(avg_sentiment * 20), 19), 0) AS BIGINT) AS bin,
        CAST(count(*) AS BIGINT) AS n
      FROM fact WHERE avg_sentiment IS NOT NULL GROUP BY 1) h""", "fact"),
    "top_apps_by_reviews": with_ctes("""
SELECT app_id, app_name, total_reviews FROM fact
ORDER BY total_reviews DESC NULLS LAST, app_name ASC NULLS LAST, app_id ASC NULLS LAST
LIMIT 10""", "fact"),
    "top_categories_by_reviews": with_ctes("""
SELECT app_category, CAST(coalesce(sum(total_reviews), 0) AS BIGINT) AS total_reviews
FROM fact WHERE app_category IS NOT NULL GROUP BY app_category
ORDER BY total_reviews DESC NULLS LAST, app_category ASC NULLS LAST
LIMIT 10""", "fact"),
    "category_ratings": with_ctes(
        "SELECT app_category, count(app_rating) AS listings,"
        " round(fsum(app_rating) / count(app_rating), 6) AS average_rating"
        " FROM stg_apps WHERE app_category IS NOT NULL GROUP BY app_category", "stg_apps"),
    "category_list": with_ctes(
        "SELECT DISTINCT category_name FROM frame WHERE category_name IS NOT NULL", "frame"),
    "dq_unique_app_id": with_ctes("""
SELECT app_id AS unique_field, CAST(count(*) AS BIGINT) AS n_records
FROM dim_apps WHERE app_id IS NOT NULL GROUP BY app_id HAVING count(*) > 1""", "dim_apps"),
    "dq_not_null_last_updated": with_ctes(
        "SELECT * FROM stg_apps WHERE last_updated_date IS NULL", "stg_apps"),
    "required_columns": with_ctes("""
SELECT app_name, 'Unknown' AS category_name, CAST(0.0 AS DOUBLE) AS average_user_rating,
 CAST(0 AS BIGINT) AS total_installs, total_reviews, CAST(0.0 AS DOUBLE) AS price,
 CAST(NULL AS VARCHAR) AS review_sentiment, CAST(0.0 AS DOUBLE) AS app_size_mb
FROM fact""", "fact"),
    "csv_roundtrip": with_ctes("SELECT * FROM stg_reviews", "stg_reviews"),
    "raw_csv_apps": with_ctes("SELECT * FROM raw_apps", "raw_apps"),
    "raw_csv_reviews": with_ctes(
        "SELECT * REPLACE (replace(Translated_Review, '-', chr(10)) AS Translated_Review) FROM raw_reviews",
        "raw_reviews"),
    "csv_roundtrip_apps": with_ctes("SELECT * FROM stg_apps", "stg_apps"),
    "landing_refresh": with_ctes("SELECT * FROM clean_apps", "clean_apps"),
    "warehouse_fact": with_ctes(
        "SELECT * REPLACE (round(avg_sentiment, 6) AS avg_sentiment) FROM fact", "fact"),
    "kpis_by_category": with_ctes(f"""
SELECT category_name, total_apps, avg_rating, total_installs,
 {compact('total_installs')} AS installs_display, format('{{:,}}', total_apps) AS total_apps_display
FROM (SELECT category_name, count(DISTINCT app_name) AS total_apps,
        coalesce({exact_mean('average_user_rating', 2)}, CAST(0.0 AS DOUBLE)) AS avg_rating,
        CAST(coalesce(sum(total_installs), 0) AS BIGINT) AS total_installs
      FROM (SELECT * REPLACE (coalesce(category_name, 'Unknown') AS category_name) FROM frame
            UNION ALL BY NAME SELECT * REPLACE (NULL AS category_name) FROM frame) f
      GROUP BY category_name) k""", "frame"),
    "top_rated_by_category": with_ctes(f"""
SELECT category_name, CAST(rank AS INTEGER) AS rank, app_name, average_user_rating FROM (
  SELECT *, row_number() OVER (PARTITION BY category_name ORDER BY average_user_rating DESC NULLS LAST,
                               app_name ASC NULLS LAST) AS rank
  FROM (SELECT category_name, app_name, {exact_mean('average_user_rating', 6)} AS average_user_rating
        FROM (SELECT * REPLACE (coalesce(category_name, 'Unknown') AS category_name) FROM frame
              UNION ALL BY NAME SELECT * REPLACE (NULL AS category_name) FROM frame) f
        GROUP BY category_name, app_name) g) r
WHERE rank <= 10""", "frame"),
    "sentiment_by_category": with_ctes("""
SELECT category_name, review_sentiment, n,
 round(CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY category_name) AS DOUBLE), 6) AS share
FROM (SELECT category_name, review_sentiment, CAST(count(*) AS BIGINT) AS n
      FROM (SELECT * REPLACE (coalesce(category_name, 'Unknown') AS category_name) FROM frame
            UNION ALL BY NAME SELECT * REPLACE (NULL AS category_name) FROM frame) f
      WHERE review_sentiment IS NOT NULL GROUP BY category_name, review_sentiment) s""", "frame"),
    "sentiment_distribution_app": with_ctes("""
SELECT review_sentiment, n, round(CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE), 6) AS share
FROM (SELECT review_sentiment, CAST(count(*) AS BIGINT) AS n
      FROM app_rows a JOIN stg_reviews r ON a.app_name = r.app_name
      WHERE review_sentiment IS NOT NULL GROUP BY review_sentiment) s""", "app_rows", "stg_reviews"),
    "top_rated_apps_app": with_ctes(f"""
SELECT app_name, average_user_rating FROM (
  SELECT app_name, {exact_mean('average_user_rating', 6)} AS average_user_rating
  FROM app_rows GROUP BY app_name) g
ORDER BY average_user_rating DESC NULLS LAST, app_name ASC NULLS LAST LIMIT 10""", "app_rows"),
    "rating_vs_installs_app": with_ctes(f"""
SELECT app_name, {exact_mean('average_user_rating', 6)} AS average_user_rating,
 CAST(coalesce(sum(total_installs), 0) AS BIGINT) AS total_installs,
 min(price) AS price, coalesce(min(price), CAST(0.0 AS DOUBLE)) AS price_numeric_viz
FROM app_rows GROUP BY app_name""", "app_rows"),
    "rating_vs_installs_first_price": with_ctes(f"""
SELECT f.app_name, f.average_user_rating, f.total_installs, p.price,
 coalesce(p.price, CAST(0.0 AS DOUBLE)) AS price_numeric_viz
FROM (SELECT app_name, {exact_mean('average_user_rating', 6)} AS average_user_rating,
        CAST(coalesce(sum(total_installs), 0) AS BIGINT) AS total_installs
      FROM frame GROUP BY app_name) f
LEFT JOIN (SELECT da.app_name, arg_min(k.app_price, o.place) AS price
      FROM fact_keyed k
      JOIN first_places o ON k.app_id = o.app_id AND k.category_id = o.category_id
       AND k.app_name IS NOT DISTINCT FROM o.app_name
      JOIN dim_apps da ON k.app_id = da.app_id JOIN dim_categories dc ON k.category_id = dc.category_id
      WHERE k.app_price IS NOT NULL GROUP BY da.app_name) p
 ON f.app_name IS NOT DISTINCT FROM p.app_name""", "frame", "first_places"),
    "dq_suite": with_ctes("""
SELECT "check", "column", failures, failures = 0 AS passed FROM (
  SELECT 'unique' AS "check", 'source_unique_key' AS "column", CAST(count(*) AS BIGINT) AS failures
  FROM (SELECT 1 FROM stg_apps WHERE source_unique_key IS NOT NULL
        GROUP BY source_unique_key HAVING count(*) > 1) u
  UNION ALL SELECT 'unique', 'app_name', CAST(count(*) AS BIGINT)
  FROM (SELECT 1 FROM stg_apps WHERE app_name IS NOT NULL GROUP BY app_name HAVING count(*) > 1) u
  UNION ALL SELECT 'not_null', 'app_name', CAST(count(*) - count(app_name) AS BIGINT) FROM stg_apps
  UNION ALL SELECT 'not_null', 'app_size_bytes', CAST(count(*) - count(app_size_bytes) AS BIGINT) FROM stg_apps
  UNION ALL SELECT 'not_null', 'last_updated_date', CAST(count(*) - count(last_updated_date) AS BIGINT)
  FROM stg_apps) s""", "stg_apps"),
    "pipeline_fact_keyed": with_ctes(
        "SELECT * REPLACE (round(avg_sentiment, 6) AS avg_sentiment) FROM fact_keyed",
        "fact_keyed"),
}

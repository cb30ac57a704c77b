"""Queries: profiling aggregates, ordered reports and the SQL tutorial set."""

from __future__ import annotations

from pyspark.sql import functions as F

from keysieve.operators import features, profile
from keysieve.plans.oracle import FLAGS_SQL, sql
from keysieve.plans.registry import query
from keysieve.sources import tables as T

PROBE = "the"
EXTREME_ABOVE = 19  # strings the outlier filter removes (length >= 20)
QUANTILE_DEPTH = 5


def _nonblank(spark, d):
    return features.drop_blank(T.raw(spark, d))


_PATTERNS_SQL = f"""
SELECT {FLAGS_SQL['is_lower']} AS is_lower, {FLAGS_SQL['is_upper']} AS is_upper,
       {FLAGS_SQL['is_digit']} AS is_digit, count(*) AS pattern_frequency
FROM nonblank GROUP BY 1, 2, 3"""


@query("password_frequency",
       sql("SELECT password, count(*) AS freq FROM nonblank GROUP BY password"))
def password_frequency(spark, d):
    return profile.password_frequency(_nonblank(spark, d))


@query("top_passwords", sql("""
SELECT password, count(*) AS freq FROM nonblank GROUP BY password
ORDER BY freq DESC, password LIMIT 10"""))
def top_passwords(spark, d):
    return profile.top_passwords(profile.password_frequency(_nonblank(spark, d)), 10)


@query("length_histogram", sql(
    "SELECT length(password)::INT AS length, count(*) AS length_count FROM nonblank GROUP BY 1"))
def length_histogram(spark, d):
    return profile.length_histogram(_nonblank(spark, d))


@query("longest_lengths", sql("""
SELECT length(password)::INT AS length, count(*) AS length_count FROM nonblank
GROUP BY 1 ORDER BY length DESC LIMIT 10"""))
def longest_lengths(spark, d):
    return profile.longest_lengths(profile.length_histogram(_nonblank(spark, d)), 10)


@query("pattern_frequency", sql(_PATTERNS_SQL))
def pattern_frequency(spark, d):
    return profile.pattern_frequency(features.with_features(_nonblank(spark, d)))


@query("top_patterns", sql(f"""
SELECT * FROM ({_PATTERNS_SQL}) ORDER BY pattern_frequency DESC, is_lower, is_upper, is_digit
LIMIT 10"""))
def top_patterns(spark, d):
    return profile.top_patterns(
        profile.pattern_frequency(features.with_features(_nonblank(spark, d))), 10)


@query("class_distribution", sql(
    "SELECT password_strength, count(*) AS n FROM labelled GROUP BY 1"))
def class_distribution(spark, d):
    return profile.distribution(T.labelled(spark, d), "password_strength")


@query("letter_digit_distribution", sql(
    "SELECT has_letter_and_digit, count(*) AS n FROM feats GROUP BY 1"))
def letter_digit_distribution(spark, d):
    return profile.distribution(features.with_features(T.candidates(spark, d)),
                                "has_letter_and_digit")


@query("row_counts", sql("""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE password_strength = 'weak') AS n_weak,
       count(*) FILTER (WHERE password_strength = 'medium') AS n_medium,
       count(*) FILTER (WHERE password_strength = 'Strong') AS n_strong
FROM labelled"""))
def row_counts(spark, d):
    return profile.class_counts(T.labelled(spark, d))


@query("probe_count", sql(
    f"SELECT '{PROBE}' AS probe, count(*) AS n FROM nonblank WHERE password = '{PROBE}'"))
def probe_count(spark, d):
    return profile.probe_count(_nonblank(spark, d), PROBE)


@query("extreme_length", sql(f"""
SELECT password, length(password)::INT AS length FROM nonblank
WHERE length(password) > {EXTREME_ABOVE} ORDER BY length DESC, password LIMIT 3"""))
def extreme_length(spark, d):
    return profile.extreme_length(_nonblank(spark, d), EXTREME_ABOVE, 3)


_QS = profile.letter_values(QUANTILE_DEPTH)
_QS_SQL = "[" + ", ".join(repr(q) for q in _QS) + "]"


@query("length_quantiles", sql(f"""
SELECT unnest(range(0, {len(_QS)}))::INT AS idx, unnest({_QS_SQL}::DOUBLE[]) AS quantile,
       unnest(list_transform(quantile_cont(length(password), {_QS_SQL}::DOUBLE[]),
                             lambda v: round(v, 6))) AS value
FROM clean"""))
def length_quantiles(spark, d):
    """Letter values (boxen plot) of candidate lengths, exact, over all rows."""
    return profile.length_quantiles(features.clean(T.raw(spark, d)), QUANTILE_DEPTH)


@query("dedup_rows", sql("SELECT DISTINCT password FROM nonblank"))
def dedup_rows(spark, d):
    return profile.dedup(_nonblank(spark, d))


# --- SQL tutorial set over the flights stand-in ------------------------------

@query("group_count_df", sql(
    "SELECT DEST_COUNTRY_NAME, count(*) AS count FROM flights GROUP BY 1"))
def group_count_df(spark, d):
    return T.flights(spark, d).groupBy("DEST_COUNTRY_NAME").count()


@query("group_count_sql", sql(
    "SELECT DEST_COUNTRY_NAME, count(*) AS count FROM flights GROUP BY 1"))
def group_count_sql(spark, d):
    T.flights(spark, d).createOrReplaceTempView("flight_data")
    return spark.sql("SELECT DEST_COUNTRY_NAME, count(1) AS count "
                     "FROM flight_data GROUP BY DEST_COUNTRY_NAME")


@query("global_max", sql("SELECT max(count) AS max_count FROM flights"))
def global_max(spark, d):
    return T.flights(spark, d).agg(F.max("count").alias("max_count"))


@query("group_sum_top5", sql("""
SELECT DEST_COUNTRY_NAME, sum(count)::BIGINT AS destination_total FROM flights
GROUP BY 1 ORDER BY destination_total DESC, DEST_COUNTRY_NAME LIMIT 5"""))
def group_sum_top5(spark, d):
    return (T.flights(spark, d).groupBy("DEST_COUNTRY_NAME")
            .agg(F.sum("count").alias("destination_total"))
            .orderBy(F.desc("destination_total"), "DEST_COUNTRY_NAME").limit(5))


@query("group_sum_top5_sql", sql("""
SELECT DEST_COUNTRY_NAME, sum(count)::BIGINT AS destination_total FROM flights
GROUP BY 1 ORDER BY destination_total DESC, DEST_COUNTRY_NAME LIMIT 5"""))
def group_sum_top5_sql(spark, d):
    T.flights(spark, d).createOrReplaceTempView("flight_data")
    return spark.sql("SELECT DEST_COUNTRY_NAME, sum(count) AS destination_total "
                     "FROM flight_data GROUP BY DEST_COUNTRY_NAME "
                     "ORDER BY destination_total DESC, DEST_COUNTRY_NAME LIMIT 5")


@query("sort_take", sql(
    "SELECT DEST_COUNTRY_NAME, count FROM flights ORDER BY count, DEST_COUNTRY_NAME LIMIT 5"))
def sort_take(spark, d):
    return T.flights(spark, d).orderBy("count", "DEST_COUNTRY_NAME").limit(5)

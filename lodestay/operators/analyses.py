"""Ready-made questions over the marts; thresholds are parameters with their usual values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestay.functions import mean, month_name, ratio, rounded
from lodestay.operators.marts import LEADS, STAYS
from lodestay.sources import stored

r = rounded
total = lambda c: F.sum(c)
def listings() -> Column:
    return F.countDistinct("listing_id")



def bands(c: str | Column, edges: Sequence[tuple[float | None, str]]) -> Column:
    """The label of the first edge above the value; the last edge is open."""
    value = F.col(c) if isinstance(c, str) else c
    rule = F
    for edge, label in edges[:-1]:
        rule = rule.when(value < edge, label)
    return rule.otherwise(edges[-1][1])


LEAD_BANDS = [(7, "1. Under 1 week"), (14, "2. 1-2 weeks"), (30, "3. 2-4 weeks"), (60, "4. 1-2 months"), (None, "5. 2+ months")]
STAY_BANDS = [(2, "1. Under 2 nights"), (3, "2. 2-3 nights"), (5, "3. 3-5 nights"), (7, "4. 5-7 nights"), (None, "5. 7+ nights")]
OCCUPANCY_BANDS = [(30, "1. Below 30%"), (50, "2. 30-50%"), (70, "3. 50-70%"), (90, "4. 70-90%"), (None, "5. 90%+")]
REVENUE_BANDS = [(1000, "A. Under $1K"), (3000, "B. $1K-$3K"), (5000, "C. $3K-$5K"), (10000, "D. $5K-$10K"), (None, "E. $10K+")]


def avg2(c: str) -> Column:
    return r(F.avg(c), 2).alias(c)


def booking_summary(m: DataFrame) -> DataFrame:
    return m.agg(
        listings().alias("total_active_listings"),
        total("total_bookings").alias("total_bookings"),
        total("total_booking_value").alias("total_revenue"),
        r(ratio(total("total_booking_value"), total("total_bookings")), 2).alias("platform_avg_booking_value"),
        *[r(F.avg(c), 2).alias(n) for c, n in (("avg_length_of_stay", "platform_avg_length_of_stay"), ("avg_booking_lead_time", "platform_avg_lead_time"), ("cancellation_rate", "platform_avg_cancellation_rate"))],
    )


def cancellation_impact(m: DataFrame) -> DataFrame:
    lost = F.sum(F.col("cancelled_bookings") * F.col("avg_booking_value"))
    return m.groupBy("property_type").agg(
        r(F.avg("cancellation_rate"), 2).alias("avg_cancellation_rate"),
        r(lost, 2).alias("estimated_lost_revenue"),
        total("total_booking_value").alias("actual_revenue"),
        r(ratio(lost, total("total_booking_value"), 100.0), 2).alias("pct_revenue_impact"),
    ).orderBy(F.desc("estimated_lost_revenue"))


def cancellation_by_lead_time(m: DataFrame) -> DataFrame:
    return m.groupBy(bands("avg_booking_lead_time", LEAD_BANDS).alias("lead_time_category")).agg(
        r(F.avg("cancellation_rate"), 2).alias("avg_cancellation_rate"),
        total("cancelled_bookings").alias("total_cancelled_bookings"),
        total("total_bookings_with_cancellation_data").alias("total_bookings"),
        r(ratio(total("cancelled_bookings"), total("total_bookings_with_cancellation_data"), 100.0), 2).alias("overall_cancellation_rate"),
    ).orderBy("lead_time_category")


def booking_kpis(m: DataFrame) -> DataFrame:
    return m.agg(
        listings().alias("total_listings"),
        total("total_bookings").alias("total_bookings"),
        total("total_booking_value").alias("total_revenue"),
        *[avg2(c) for c in ("avg_length_of_stay", "median_length_of_stay", "avg_booking_lead_time", "avg_booking_value")],
        F.max("max_length_of_stay").alias("max_length_of_stay"),
        total("last_minute_bookings").alias("last_minute_bookings"),
        r(ratio(total("last_minute_bookings"), total("total_bookings"), 100.0), 2).alias("pct_last_minute"),
        F.max("max_booking_value").alias("max_booking_value"),
        r(F.avg("cancellation_rate"), 2).alias("avg_cancellation_rate"),
        total("cancelled_bookings").alias("total_cancellations"),
        *[total(f"{k}_{what}").alias(f"{k}_{what}") for what in ("bookings", "revenue") for k in STAYS],
    )


def lead_time_buckets(m: DataFrame) -> DataFrame:
    return m.groupBy(bands("avg_booking_lead_time", LEAD_BANDS).alias("lead_time_category")).agg(
        listings().alias("num_listings"), avg2("avg_booking_value"), total("total_booking_value").alias("total_revenue"), avg2("avg_length_of_stay"), r(F.avg("cancellation_rate"), 2).alias("avg_cancellation_rate")
    ).orderBy("lead_time_category")


def lead_time_by_property(m: DataFrame) -> DataFrame:
    """Ordered by bookings, which are not shown."""
    every = F.sum(sum((F.col(f"{k}_bookings") for k in LEADS), F.lit(0)))
    out = m.groupBy("property_type").agg(
        *[total(f"{k}_bookings").alias(f"{k}_bookings") for k in LEADS],
        r(ratio(total("last_minute_bookings"), every, 100.0), 2).alias("pct_last_minute"),
        r(ratio(total("long_lead_bookings"), every, 100.0), 2).alias("pct_long_lead"),
        total("total_bookings").alias("__by"),
    )
    return out.orderBy(F.desc("__by"), "property_type").drop("__by")


def stay_length_buckets(m: DataFrame) -> DataFrame:
    return m.groupBy(bands("avg_length_of_stay", STAY_BANDS).alias("stay_length_category")).agg(
        listings().alias("num_listings"), total("total_bookings").alias("num_bookings"), total("total_booking_value").alias("total_revenue"), avg2("avg_booking_value"), r(F.avg("cancellation_rate"), 2).alias("avg_cancellation_rate")
    ).orderBy("stay_length_category")


#: What optimization_opportunities() shows and reads of a listing.
ECONOMICS = ("listing_id", "listing_name", "property_type", "room_type", "neighbourhood_cleansed", "avg_length_of_stay", "avg_booking_value", "cancellation_rate", "most_valuable_stay_duration", "total_bookings", "long_stay_revenue_percentage", "one_night_booking_percentage")


def optimization_opportunities(m: DataFrame) -> DataFrame:
    """What to change about each listing with more than five bookings, the most pressing first.

    The listings are written once, as their average, the sample that the order needs and the result each read them."""
    m = stored(m.select(*ECONOMICS))
    usual = m.agg(F.avg("avg_booking_value").alias("__usual"))  # one row
    rules = [
        ("High cancellation rate", (F.col("cancellation_rate") > 15) & (F.col("total_bookings") > 10)),
        ("Extend min nights requirement", (F.col("long_stay_revenue_percentage") > 75) & (F.col("avg_length_of_stay") < 5)),
        ("Increase min nights", (F.col("one_night_booking_percentage") > 75) & (F.col("avg_booking_value") < F.col("__usual"))),
        ("Optimize for shorter stays", (F.col("avg_length_of_stay") > 5) & (F.col("long_stay_revenue_percentage") < 30)),
    ]
    label, rank = F, F
    for i, (name, rule) in enumerate(rules):
        label, rank = label.when(rule, name), rank.when(rule, len(rules) - i)
    out = m.where("total_bookings > 5").crossJoin(F.broadcast(usual)).withColumns({"optimization_opportunity": label.otherwise("No major optimization needed"), "__rank": rank.otherwise(0)})
    return out.orderBy(F.desc("__rank"), "listing_id").select(*ECONOMICS[:9], "optimization_opportunity")


def neighbourhood_stay_mix(m: DataFrame, more_than: int = 5) -> DataFrame:
    names = dict(zip(("one_night", "two_night", "medium_stay", "long_stay"), (label for *_, label in STAYS.values()), strict=True))
    out = m.groupBy("neighbourhood_cleansed").agg(
        r(F.avg("one_night_booking_percentage"), 2).alias("avg_one_night_pct"),
        r(F.avg("long_stay_revenue_percentage"), 2).alias("avg_long_stay_revenue_pct"),
        *[F.countDistinct(F.when(F.col("most_valuable_stay_duration") == label, F.col("listing_id"))).alias(f"{n}_optimal_listings") for n, label in names.items()],
        listings().alias("__n"),
    )
    return out.where(F.col("__n") > more_than).orderBy(F.desc("avg_long_stay_revenue_pct"), "neighbourhood_cleansed").drop("__n")


def profitable_stay_by_property(m: DataFrame) -> DataFrame:
    return m.groupBy("property_type", "most_valuable_stay_duration").agg(listings().alias("num_listings"), avg2("avg_booking_value"), total("total_booking_value").alias("total_revenue")).orderBy("property_type", F.desc("total_revenue"))


def revenue_breakdown(m: DataFrame) -> DataFrame:
    every = F.sum(sum((F.col(f"{k}_revenue") for k in STAYS), F.lit(0)))
    return m.agg(*[total(f"{k}_revenue").alias(f"{k}_revenue") for k in STAYS], *[r(ratio(total(f"{k}_revenue"), every, 100.0), 2).alias(f"pct_{k}") for k in STAYS])


def revenue_per_night(m: DataFrame, nights: Sequence[float] = (1, 2, 4.5, 10)) -> DataFrame:
    return m.agg(*[r(ratio(total(f"{k}_revenue"), total(f"{k}_bookings") * float(n)), 2).alias(f"revenue_per_night_{k}") for k, n in zip(STAYS, nights, strict=True)])


def top_neighbourhoods(m: DataFrame, k: int = 15) -> DataFrame:
    return m.groupBy("neighbourhood_cleansed").agg(
        listings().alias("num_listings"),
        avg2("avg_length_of_stay"),
        r(F.avg("avg_booking_lead_time"), 2).alias("avg_lead_time"),
        avg2("avg_booking_value"),
        r(F.avg("cancellation_rate"), 2).alias("avg_cancellation_rate"),
        total("total_bookings").alias("total_bookings"),
        total("total_booking_value").alias("total_revenue"),
    ).orderBy(F.desc("total_revenue"), "neighbourhood_cleansed").limit(k)


def monthly_revenue_trend(m: DataFrame) -> DataFrame:
    return m.groupBy("month_start_date").agg(total("total_revenue").alias("platform_revenue"), r(F.avg("adr")).alias("platform_avg_adr"), r(F.avg("occupancy_rate")).alias("platform_avg_occupancy")).orderBy("month_start_date")


def elasticity_distribution(m: DataFrame) -> DataFrame:
    return m.where(F.col("elasticity_category") != "Insufficient Data").groupBy("elasticity_category").agg(
        F.count("*").alias("month_listing_count"), listings().alias("unique_listing_count"), *[r(F.avg(c), 3).alias(n) for c, n in (("price_elasticity", "avg_elasticity"), ("occupancy_rate", "avg_occupancy"), ("adr", "avg_price"))]
    ).orderBy(F.desc("avg_elasticity"))


def seasonal_patterns(m: DataFrame) -> DataFrame:
    d = "month_start_date"
    in_season = lambda s: F.countDistinct(F.when(F.col("seasonality") == s, F.col("listing_id")))
    return m.groupBy(F.month(d).alias("month_num"), month_name(d).alias("month_name")).agg(
        r(F.avg("seasonal_index")).alias("avg_seasonal_index"), in_season("High Season").alias("high_season_listings"), in_season("Low Season").alias("low_season_listings"), r(F.avg("occupancy_rate")).alias("avg_occupancy")
    ).orderBy("month_num")


def weekend_premium(m: DataFrame, more_than: int = 5) -> DataFrame:
    out = m.groupBy("property_type").agg(r(F.avg("weekend_pricing_premium_pct")).alias("avg_weekend_premium"), listings().alias("listing_count"))
    return out.where(F.col("listing_count") > more_than).orderBy(F.desc("avg_weekend_premium"))


def by_host(h: DataFrame, *aggregates: Column, months: int = 3) -> DataFrame:
    """Aggregates of each host with enough months."""
    return h.groupBy("host_id", "host_name").agg(F.countDistinct("month_date").alias("active_months"), *aggregates).where(F.col("active_months") >= months)


def ranked(rules: Sequence[tuple[str, Column, int]], other: tuple[str, int]) -> tuple[Column, Column]:
    label, rank = F, F
    for name, rule, place in rules:
        label, rank = label.when(rule, name), rank.when(rule, place)
    return label.otherwise(other[0]), rank.otherwise(other[1])


def host_consistency(h: DataFrame, k: int = 100) -> DataFrame:
    out = by_host(h, F.stddev("occupancy_rate").alias("ov"), F.stddev("revenue_growth_pct").alias("rv"), F.avg("occupancy_rate").alias("ao"), total("estimated_revenue").alias("total_revenue"))
    v, a = F.col("ov"), F.col("ao")
    label, rank = ranked([("Highly Consistent", (v < 5) & (a > 70), 1), ("Consistent", (v < 10) & (a > 60), 2), ("Moderately Consistent", (v < 15) & (a > 50), 3), ("Volatile", v >= 15, 4)], ("Low Performer", 5))
    out = out.withColumns({"consistency_rating": label, "__rank": rank}).orderBy("__rank", F.desc("total_revenue"), "host_id").limit(k)
    return out.select("host_id", "host_name", "active_months", r("ao", 1).alias("avg_occupancy"), r("ov", 1).alias("occupancy_volatility"), r("rv", 1).alias("revenue_volatility"), "total_revenue", "consistency_rating")


def platform_growth(h: DataFrame, as_of: str) -> DataFrame:
    """One row a month after grouping, so the window over all months is small."""
    months = h.where(F.col("month_date") <= F.lit(as_of).cast("date")).groupBy("month_date").agg(
        F.countDistinct("host_id").alias("active_hosts"), total("active_listings").alias("total_listings"), F.avg("occupancy_rate").alias("o"), total("estimated_revenue").alias("total_revenue")
    )
    w = Window.orderBy("month_date")
    growth = lambda c: r(ratio(F.col(c).cast("double") - F.lag(c).over(w).cast("double"), F.lag(c).over(w), 100.0), 1)
    return months.select("month_date", F.date_format("month_date", "yyyy-MM").alias("month"), "active_hosts", "total_listings", r("o", 1).alias("avg_occupancy"), "total_revenue", growth("total_revenue").alias("platform_revenue_growth"), growth("o").alias("platform_occupancy_growth")).orderBy("month_date")


def host_growth_trajectory(h: DataFrame) -> DataFrame:
    out = by_host(h, F.avg("revenue_growth_pct").alias("g"), F.min_by("active_listings", "month_date").alias("initial_listings"), F.max_by("active_listings", "month_date").alias("latest_listings"), total("estimated_revenue").alias("total_revenue"))
    g, more = F.col("g"), F.col("latest_listings") - F.col("initial_listings")
    label, rank = ranked([("High Growth", (g > 10) & (more > 0), 1), ("Growing", (g > 5) | (more > 0), 2), ("Stable", g.between(-5, 5) & (more == 0), 3), ("Declining", (g < -5) | (more < 0), 4)], ("Inconsistent", 5))
    out = out.withColumns({"listing_growth": more, "growth_trajectory": label, "__rank": rank}).orderBy("__rank", F.desc("total_revenue"), "host_id")
    return out.select("host_id", "host_name", "active_months", r("g", 1).alias("avg_monthly_growth_pct"), "initial_listings", "latest_listings", "listing_growth", "total_revenue", "growth_trajectory")


def host_vs_platform(h: DataFrame, host_id: int) -> DataFrame:
    own = ratio("estimated_revenue", "active_listings")
    mine = F.when(F.col("host_id") == host_id, F.struct("host_id", "host_name", "active_listings", "occupancy_rate", "estimated_revenue", "positive_review_percentage"))
    platform = h.groupBy("month_date").agg(F.avg("occupancy_rate").alias("po"), F.avg(own).alias("pr"), F.avg("positive_review_percentage").alias("pp"), F.collect_list(mine).alias("mine"))
    return platform.select("month_date", "po", "pr", "pp", F.inline("mine")).select(
        *("host_id", "host_name", "month_date", "active_listings", "occupancy_rate"),
        r("po").alias("avg_platform_occupancy"),
        r(F.col("occupancy_rate") - F.col("po"), 1).alias("occupancy_vs_platform"),
        r(own).alias("revenue_per_listing"),
        r("pr").alias("avg_platform_revenue_per_listing"),
        r(ratio(own - F.col("pr"), "pr", 100.0), 1).alias("revenue_pct_vs_platform"),
        "positive_review_percentage",
        r("pp").alias("avg_platform_positive_reviews"),
        r(F.col("positive_review_percentage") - F.col("pp"), 1).alias("reviews_vs_platform"),
    ).orderBy("month_date")


def host_kpis(h: DataFrame) -> DataFrame:
    """The newest month beside the one before it."""
    months = h.groupBy("month_date").agg(
        F.countDistinct("host_id").alias("active_hosts"),
        total("active_listings").alias("total_listings"),
        total("estimated_revenue").alias("total_revenue"),
        *[r(F.avg(c), d).alias(n) for c, n, d in (("occupancy_rate", "avg_occupancy", 1), ("revenue_per_listing", "avg_revenue_per_listing", 2), ("positive_review_percentage", "avg_positive_reviews", 1))],
        total("review_count").alias("total_reviews"),
    )
    last = months.orderBy(F.desc("month_date")).limit(2)
    w = Window.orderBy("month_date")  # over two rows
    both = last.withColumns({f"p_{c}": F.lag(c).over(w) for c in months.columns}).orderBy(F.desc("month_date")).limit(1)
    growth = lambda c: r(ratio(F.col(c).cast("double") - F.col(f"p_{c}").cast("double"), f"p_{c}", 100.0), 1)
    return both.select(
        "active_hosts",
        growth("active_hosts").alias("active_hosts_growth"),
        "total_listings",
        growth("total_listings").alias("listings_growth"),
        "total_revenue",
        growth("total_revenue").alias("revenue_growth"),
        "avg_occupancy",
        r(F.col("avg_occupancy") - F.col("p_avg_occupancy"), 2).alias("occupancy_change"),
        "avg_revenue_per_listing",
        growth("avg_revenue_per_listing").alias("revenue_per_listing_growth"),
        "avg_positive_reviews",
        r(F.col("avg_positive_reviews") - F.col("p_avg_positive_reviews"), 2).alias("positive_reviews_change"),
        "total_reviews",
        growth("total_reviews").alias("reviews_growth"),
    )


def host_segments(h: DataFrame, k: int = 100) -> DataFrame:
    out = by_host(h, F.avg("active_listings").alias("al"), F.avg("occupancy_rate").alias("ao"), mean("estimated_revenue").alias("am"), total("estimated_revenue").alias("total_revenue"), F.avg("positive_review_percentage").alias("ap"))
    al, ao, am, ap = (F.col(c) for c in ("al", "ao", "am", "ap"))
    rules = [
        ("Premium Performer", (ao >= 70) & (ap >= 80) & (am >= 5000), 1),
        ("High Performer", (ao >= 60) & (ap >= 70) & (am >= 3000), 2),
        ("Professional Multi-listing", (ao >= 50) & (al > 3), 3),
        ("Efficient Single-listing", (ao >= 50) & (al <= 3) & (am >= 2000), 4),
        ("High-value Low-occupancy", (ao < 50) & (am >= 3000), 5),
        ("Needs Improvement", (ao < 40) & (ap < 70), 7),
    ]
    label, rank = ranked(rules, ("Average Performer", 6))
    out = out.withColumns({"host_segment": label, "__rank": rank}).orderBy("__rank", F.desc("total_revenue"), "host_id").limit(k)
    return out.select("host_id", "host_name", "active_months", r("al", 1).alias("avg_listings"), r("ao", 1).alias("avg_occupancy"), r("am", 2).alias("avg_monthly_revenue"), "total_revenue", r("ap", 1).alias("avg_positive_reviews"), "host_segment")


def occupancy_revenue_matrix(h: DataFrame) -> DataFrame:
    hosts = h.groupBy("host_id").agg(F.avg("occupancy_rate").alias("ao"), mean("estimated_revenue").alias("am"))
    return hosts.groupBy(bands("ao", OCCUPANCY_BANDS).alias("occupancy_bucket"), bands("am", REVENUE_BANDS).alias("revenue_bucket")).agg(
        F.count("*").alias("host_count"), r(F.avg("ao"), 1).alias("avg_occupancy_in_group"), r(F.avg("am"), 2).alias("avg_revenue_in_group")
    ).orderBy("occupancy_bucket", "revenue_bucket")


def satisfaction_trends(h: DataFrame, k: int = 50) -> DataFrame:
    p = "positive_review_percentage"
    out = h.where("review_count > 0").groupBy("host_id", "host_name").agg(
        F.countDistinct("month_date").alias("months_with_reviews"),
        total("review_count").alias("total_reviews"),
        r(F.avg(p), 1).alias("avg_positive_review_pct"),
        r(F.avg("avg_review_length"), 0).alias("avg_review_length"),
        r(F.avg("occupancy_rate"), 1).alias("avg_occupancy"),
        r(F.corr(p, "occupancy_rate"), 3).alias("review_occupancy_correlation"),
        r(F.corr(p, F.col("estimated_revenue").cast("double")), 3).alias("review_revenue_correlation"),
        F.corr(p, F.unix_timestamp(F.col("month_date").cast("timestamp")).cast("double")).alias("t"),
    ).where("months_with_reviews >= 2")
    enough = F.col("months_with_reviews") >= 3
    trend = F.when(enough & (F.col("t") > 0.3), "Improving").when(enough & (F.col("t") < -0.3), "Declining").otherwise("Stable")
    return out.withColumn("satisfaction_trend", trend).drop("t").orderBy(F.desc("total_reviews"), "host_id").limit(k)


def seasonal_host_performance(h: DataFrame) -> DataFrame:
    d = "month_date"
    return h.groupBy(F.month(d).alias("month_num"), month_name(d).alias("month_name")).agg(
        F.countDistinct("host_id").alias("active_hosts"),
        r(F.avg("occupancy_rate"), 1).alias("avg_occupancy"),
        r(F.avg("active_listings"), 1).alias("avg_listings_per_host"),
        r(mean("estimated_revenue"), 2).alias("avg_host_revenue"),
        total("estimated_revenue").alias("total_platform_revenue"),
        r(F.avg("positive_review_percentage"), 1).alias("avg_positive_review_pct"),
    ).orderBy("month_num")


def top_hosts(h: DataFrame, k: int = 20) -> DataFrame:
    return by_host(h, r(F.avg("active_listings"), 1).alias("avg_listings"), total("estimated_revenue").alias("total_revenue"), r(F.avg("occupancy_rate"), 1).alias("avg_occupancy"), r(F.avg("revenue_growth_pct"), 1).alias("avg_monthly_growth"), months=1).orderBy(F.desc("total_revenue"), "host_id").limit(k)

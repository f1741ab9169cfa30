"""Facts, dimensions without history, and analytic marts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestay.functions import count_of, day, mean, month_name, ratio, rounded, sum_of, surrogate_key, weekday_name
from lodestay.sources.keyed import Keyed

STAYS = {"one_night": (1, 1, "1 Night"), "two_night": (2, 2, "2 Nights"), "three_to_six_night": (3, 6, "3-6 Nights"), "seven_plus_night": (7, None, "7+ Nights")}
LEADS = {"last_minute": (None, 7), "short_lead": (8, 30), "medium_lead": (31, 90), "long_lead": (91, None)}
DIM = ("listing_id", "listing_name", "host_id", "host_name", "neighbourhood_cleansed", "property_type", "room_type")


def between(c: str, low: int | None, high: int | None) -> Column:
    held = F.lit(True) if low is None else F.col(c) >= low
    return held if high is None else held & (F.col(c) <= high)


def fct_calendar_daily(clean: DataFrame) -> DataFrame:
    """Daily facts with the price change from a listing's day before, 0 on its first. A row without a date has no place in
    that order: its change is 0, and it is no other row's day before."""
    dated = F.col("calendar_date").isNotNull()
    # rows without a date come first and have no price to look back on, so one order serves this and what picks one row a day
    before = F.lag(F.when(dated, F.col("price"))).over(Window.partitionBy("listing_id").orderBy("calendar_date"))
    change = F.when(dated & F.col("__before").isNotNull(), F.col("price") - F.col("__before")).otherwise(0)
    return clean.withColumn("__before", before).withColumn("price_change_from_previous_day", change).drop("__before")


def fct_calendar_incremental(facts: DataFrame | None, clean: DataFrame, deal: Callable[[DataFrame], DataFrame] | None = None, order: Sequence[Column] = (), earlier: DataFrame | None = None) -> DataFrame:
    """facts after more cleaned days: days that are there already are replaced, others added, and price changes follow, also
    of the day after. The same rows as a computation anew, whatever the batches.

    A row without a date replaces none and is replaced by none. Stored and new rows meet in one exchange by listing (deal,
    where the caller has one), so either is read once; give it the stored rows of the listings concerned alone. With order
    (what comes first wins) new days may come more than once; they are told apart after that same exchange. earlier: stored
    rows of the same listings, all before any day of facts and clean, that stay as they are; only each one's last price is read.
    """

    def first(df: DataFrame, *order: Column) -> DataFrame:
        """Of each day the first row; a window a listing, as one a day is mostly one of a single row."""
        before = F.lag("calendar_date").over(Window.partitionBy("listing_id").orderBy("calendar_date", *order))
        return df.withColumn("__day", before).where("calendar_date IS NULL OR __day IS NULL OR __day <> calendar_date").drop("__day")

    if facts is None:
        dealt = deal(clean) if deal else clean
        return fct_calendar_daily(first(dealt, *order) if order else dealt)
    both = facts.select(*clean.columns).withColumn("__new", F.lit(False)).unionByName(clean.withColumn("__new", F.lit(True)))
    if earlier is not None:
        last = earlier.where("calendar_date IS NOT NULL").groupBy("listing_id").agg(F.max_by("price", "calendar_date").alias("price"), F.max("calendar_date").alias("calendar_date"))
        both = both.withColumn("__kept", F.lit(True)).unionByName(last.withColumns({"__new": F.lit(False), "__kept": F.lit(False)}), allowMissingColumns=True)
    both = deal(both) if deal else both.repartition("listing_id")
    if order:  # new ones before the stored one
        kept = first(both, F.desc("__new"), *order)
    else:
        again = F.max("__new").over(Window.partitionBy("listing_id", "calendar_date"))
        kept = both.withColumn("__again", again).where("__new OR NOT __again OR calendar_date IS NULL").drop("__again")
    changed = fct_calendar_daily(kept.drop("__new"))
    return (changed if earlier is None else changed.where("__kept")).select(*facts.columns)


#: The facts' slices (see Keyed): years, rows without a date coming last.
YEARS = "coalesce(year(calendar_date), 9999)"


def load_calendar(table: Keyed, clean: DataFrame, batch: int | None = None, order: Sequence[Column] = ()) -> bool:
    """Cleaned days into the stored facts (a table by listing_id): only buckets with one of their listings are read and
    written, each once, and where the table has slices by YEARS only from the first year that gets days on. A numbered batch
    that is in already changes nothing. order: see fct_calendar_incremental()."""
    return table.merge(clean, lambda facts, fresh, deal, earlier=None: fct_calendar_incremental(facts, fresh, deal, order, earlier), batch)


def fct_reviews(clean: DataFrame) -> DataFrame:
    """Valid reviews with a surrogate key and parts of the date."""
    d = "review_date"
    return clean.where(F.col("data_quality_check") == "valid").select(
        surrogate_key("review_id").alias("review_sk"),
        *("review_id", "listing_id", "reviewer_id", "reviewer_name", d, "review_text"),
        F.year(d).alias("review_year"),
        F.month(d).alias("review_month"),
        F.dayofmonth(d).alias("review_day"),
        weekday_name(d).alias("review_day_of_week"),
        *("review_length", "sentiment", "_ingested_at", "record_hash"),
    )


def dim_reviewers(stg: DataFrame) -> DataFrame:
    """One row for each reviewer id and name; dates that are texts are parsed before they are compared."""
    when = F.col("review_date") if dict(stg.dtypes)["review_date"] == "date" else day("review_date")
    grouped = stg.groupBy("reviewer_id", "reviewer_name").agg(
        F.min(when).alias("first_review_date"),
        F.max(when).alias("last_review_date"),
        F.count("*").alias("total_reviews"),
        F.countDistinct("listing_id").alias("unique_listings_reviewed"),
    )
    n = F.col("total_reviews")
    return grouped.withColumn("reviewer_tier", F.when(n >= 10, "frequent").when(n >= 3, "regular").otherwise("new"))


def booking_sequences(calendar: DataFrame, mode: str = "islands") -> DataFrame:
    """Taken days with the number of their run in the listing.

    islands: a run ends at an available day or a missing date. as_written: the filter comes before the look back, so that
    all of a listing's taken days are one run.
    """
    w = Window.partitionBy("listing_id").orderBy("calendar_date")
    if mode == "as_written":
        calendar = calendar.where(~F.col("is_available"))
    before, last = F.lag("is_available").over(w), F.lag("calendar_date").over(w)
    starts = ~F.col("is_available") & (before.isNull() | before)
    if mode == "islands":
        starts = ~F.col("is_available") & (before.isNull() | before | (F.datediff("calendar_date", last) > 1))
    flagged = calendar.select("listing_id", "calendar_date", "price", "is_available", F.when(starts, 1).otherwise(0).alias("new_sequence_flag"))
    if mode == "islands":
        flagged = flagged.withColumn("booking_sequence_id", F.sum("new_sequence_flag").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        return flagged.where(~F.col("is_available")).drop("is_available")
    return flagged.withColumn("booking_sequence_id", F.sum("new_sequence_flag").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("is_available")


def stays(sequences: DataFrame) -> DataFrame:
    return sequences.groupBy("listing_id", "booking_sequence_id").agg(
        F.min("calendar_date").alias("check_in_date"),
        F.max("calendar_date").alias("check_out_date"),
        F.count("*").alias("nights"),
        mean("price").alias("avg_nightly_price"),
        F.sum("price").alias("total_booking_value"),
    )


def stay_metrics(bookings: DataFrame) -> DataFrame:
    value = "total_booking_value"
    return bookings.groupBy("listing_id").agg(
        mean("nights").alias("alos"),
        F.min("nights").alias("min_nights"),
        F.max("nights").alias("max_nights"),
        F.percentile("nights", 0.5).alias("median_nights"),
        mean(value).alias("avg_booking_value"),
        F.max(value).alias("max_booking_value"),
        F.min(value).alias("min_booking_value"),
        F.sum(value).alias(value),
        F.count("*").alias("total_bookings"),
        *[count_of(between("nights", a, b)).alias(f"{k}_bookings") for k, (a, b, _) in STAYS.items()],
        *[sum_of(between("nights", a, b), value).alias(f"{k}_revenue") for k, (a, b, _) in STAYS.items()],
    )


def booking_patterns(bookings: DataFrame) -> DataFrame:
    month = F.trunc("check_in_date", "month")
    return bookings.groupBy("listing_id", month.alias("month_start_date")).agg(
        F.count("*").alias("monthly_bookings"),
        mean("nights").alias("monthly_alos"),
        mean("total_booking_value").alias("monthly_avg_booking_value"),
        F.sum("total_booking_value").alias("monthly_total_booking_value"),
    )


def lead_times(booked: DataFrame, key: str = "listing_id") -> DataFrame:
    """Days from booking to check-in, by key, over real dates."""
    led = booked.withColumn("lead", F.datediff("check_in", "booked_at"))
    return led.groupBy(key).agg(
        mean("lead").alias("avg_lead_time_days"),
        F.percentile("lead", 0.5).alias("median_lead_time_days"),
        F.min("lead").alias("min_lead_time_days"),
        F.max("lead").alias("max_lead_time_days"),
        *[count_of(between("lead", a, b)).alias(f"{k}_bookings") for k, (a, b) in LEADS.items()],
        F.count("*").alias("total_bookings_with_lead_time"),
    )


def cancellations(booked: DataFrame, key: str = "listing_id") -> DataFrame:
    return booked.groupBy(key).agg(
        count_of(F.col("cancelled")).alias("cancelled_bookings"),
        F.count("*").alias("total_bookings_with_cancellation_data"),
        ratio(count_of(F.col("cancelled")), F.count("*"), 100.0).alias("cancellation_rate"),
    )


def most_valuable_stay(as_written: bool = False) -> Column:
    """The stay length with the largest revenue, the first on ties; without any revenue, none (the first, as written)."""
    top = F.greatest(*[f"{k}_revenue" for k in STAYS])
    rule = F if as_written else F.when(top == 0, "No Revenue")
    for k, (_, _, label) in STAYS.items():
        rule = rule.when(top == F.col(f"{k}_revenue"), label)
    return rule.otherwise("No Revenue")


def booking_economics(listings: DataFrame, stays_by_listing: DataFrame, leads: DataFrame, cancelled: DataFrame) -> DataFrame:
    dim = listings.select(*DIM, "accommodates")
    joined = dim.join(stays_by_listing, "listing_id", "left").join(leads, "listing_id", "left").join(cancelled, "listing_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = joined.select(
        *DIM,
        "accommodates",
        *[zero(a).alias(b) for a, b in (("alos", "avg_length_of_stay"), ("median_nights", "median_length_of_stay"), ("min_nights", "min_length_of_stay"), ("max_nights", "max_length_of_stay"))],
        *[zero(a).alias(b) for a, b in (("avg_lead_time_days", "avg_booking_lead_time"), ("median_lead_time_days", "median_booking_lead_time"))],
        *[zero(c).alias(c) for c in (*[f"{k}_bookings" for k in LEADS], "avg_booking_value", "min_booking_value", "max_booking_value", "cancellation_rate", "cancelled_bookings", "total_bookings_with_cancellation_data", "total_bookings", "total_booking_value")],
        *[zero(f"{k}_{what}").alias(f"{k}_{what}") for what in ("bookings", "revenue") for k in STAYS],
    )
    share = lambda a, b: F.when(F.col(b) > 0, ratio(a, b, 100.0)).otherwise(0.0)
    return out.withColumns(
        {
            "one_night_booking_percentage": share("one_night_bookings", "total_bookings"),
            "long_stay_revenue_percentage": share("seven_plus_night_revenue", "total_booking_value"),
            "most_valuable_stay_duration": most_valuable_stay(),
        }
    )


def listing_months(calendar: DataFrame, as_of: str | None = None) -> DataFrame:
    """Days, revenue, daily rates and occupancy of each listing and month, up to as_of (default: today)."""
    past = calendar.where(F.col("calendar_date") <= (F.current_date() if as_of is None else F.lit(as_of).cast("date")))
    taken, weekend = ~F.col("is_available"), F.col("is_weekend")
    rate = lambda c: F.coalesce(ratio(sum_of(c, "price"), count_of(c)), F.lit(0.0))
    return past.groupBy("listing_id", F.trunc("calendar_date", "month").alias("month_start_date")).agg(
        F.count("*").alias("total_days"),
        count_of(taken).alias("booked_days"),
        count_of(F.col("is_available")).alias("available_days"),
        count_of(weekend & taken).alias("booked_weekend_days"),
        count_of(~weekend & taken).alias("booked_weekday_days"),
        sum_of(taken, "price").alias("total_revenue"),
        rate(taken).alias("adr"),
        ratio(sum_of(taken, "price"), F.count("*")).alias("revpad"),
        rate(weekend & taken).alias("weekend_adr"),
        rate(~weekend & taken).alias("weekday_adr"),
        ratio(count_of(taken), F.count("*"), 100.0).alias("occupancy_rate"),
    )


def elasticity(months: DataFrame) -> DataFrame:
    """Change of rate and occupancy from a listing's month before, and minus their ratio (0 where the rate stayed)."""
    changed = with_elasticity(months).where("price_elasticity IS NOT NULL")
    return changed.select("listing_id", "month_start_date", "price_change_pct", "occupancy_change_pct", "price_elasticity")


def with_elasticity(months: DataFrame) -> DataFrame:
    """months with the columns of elasticity(), null unless both changes are known."""
    w = Window.partitionBy("listing_id").orderBy("month_start_date")
    change = lambda c: F.when(F.lag(c).over(w) > 0, (F.col(c) / F.lag(c).over(w) - 1) * 100)
    both = months.withColumns({"price_change_pct": change("adr"), "occupancy_change_pct": change("occupancy_rate")})
    known = F.col("price_change_pct").isNotNull() & F.col("occupancy_change_pct").isNotNull()
    both = both.withColumns({c: F.when(known, F.col(c)) for c in ("price_change_pct", "occupancy_change_pct")})
    by = F.col("price_change_pct")
    return both.withColumn("price_elasticity", F.when(by != 0, F.col("occupancy_change_pct") / F.nullif(by, F.lit(0.0)) * -1).when(by == 0, 0.0))


def elasticity_category(e: str = "price_elasticity") -> Column:
    c = F.col(e)
    return F.when(c > 1.5, "Highly Elastic").when(c.between(0.5, 1.5), "Elastic").when(c.between(-0.5, 0.5), "Inelastic").when(c < -0.5, "Abnormal Response").otherwise("Insufficient Data")


def pricing_recommendation(e: str = "price_elasticity") -> Column:
    c = F.col(e)
    return (
        F.when(c > 1.0, "Consider lowering price to increase occupancy")
        .when(c.between(0.5, 1.0), "Price is sensitive - optimize carefully")
        .when(c.between(-0.5, 0.5), "Price is inelastic - may increase price")
        .when(c < -0.5, "Abnormal data - investigate other factors")
        .otherwise("Need more data")
    )


def seasonal(df: DataFrame) -> DataFrame:
    """Mean rate of the twelve months up to each, the month's ratio to it, and high or low season."""
    year = Window.partitionBy("listing_id").orderBy("month_start_date").rowsBetween(-11, 0)
    df = df.withColumn("trailing_12m_avg_adr", F.avg("adr").over(year))
    rate, usual = F.col("adr"), F.col("trailing_12m_avg_adr")
    season = F.when(rate > 1.1 * usual, "High Season").when(rate < 0.9 * usual, "Low Season").otherwise("Regular Season")
    return df.withColumns({"seasonal_index": F.when(usual > 0, rate / usual), "seasonality": season})


def financial_performance(months: DataFrame, listings: DataFrame) -> DataFrame:
    joined = with_elasticity(months).join(listings.select(*DIM), "listing_id")
    premium = F.when(F.col("weekday_adr") > 0, (F.col("weekend_adr") / F.col("weekday_adr") - 1) * 100).otherwise(0.0)
    return seasonal(joined.withColumns({"weekend_pricing_premium_pct": premium, "elasticity_category": elasticity_category(), "pricing_recommendation": pricing_recommendation()}))


def availability_monthly(calendar: DataFrame) -> DataFrame:
    """One grouping; joining the distinct months back to the days would give the same rows."""
    weekend, taken = F.col("is_weekend"), ~F.col("is_available")
    grouped = calendar.groupBy("listing_id", "year_num", "month_num").agg(
        F.count("*").alias("total_days"),
        count_of(F.col("is_available")).alias("available_days"),
        count_of(taken).alias("booked_days"),
        mean("price").alias("avg_daily_price"),
        F.max("price").alias("max_daily_price"),
        F.min("price").alias("min_daily_price"),
        mean(F.when(weekend, F.col("price"))).alias("avg_weekend_price"),
        mean(F.when(~weekend, F.col("price"))).alias("avg_weekday_price"),
        ratio(count_of(taken), F.count("*"), 100.0).alias("occupancy_rate"),
    )
    return grouped.withColumn("first_day_of_month", F.make_date("year_num", "month_num", F.lit(1)))


def host_performance(listings: DataFrame, calendar: DataFrame, reviews: DataFrame, mode: str = "deduplicated", deal: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Activity, revenue, reviews and growth of each host and month.

    deduplicated: reviews are summed by listing and month before they meet the days. as_written: every day of a month counts
    once for each review of the listing's month, and every review once for each day. Those rows are never made: each side is
    summed by listing and month and multiplied by the other's count, and distinct reviews are counted apart.

    deal: how the calendar is dealt by listing_id, if it is; reviews and listings are dealt alike then, and meet the days without
    an exchange of listing months.
    """
    days = calendar.select("listing_id", F.trunc("calendar_date", "month").alias("month_date"), "is_available", "price")
    held = reviews.select("listing_id", F.trunc("review_date", "month").alias("month_date"), "review_id", "sentiment", "review_length")
    hosts = listings.select("listing_id", "host_id", "host_name")
    held, hosts = (deal(held), deal(hosts)) if deal else (held, hosts)
    taken, positive = ~F.col("is_available"), F.col("sentiment") == "positive"
    measures = {
        "booked_days": count_of(taken),
        "available_days": count_of(F.col("is_available")),
        "total_days": F.count("*"),
        "estimated_revenue": sum_of(taken, "price"),
        "priced_days": F.count("price"),
        "price_sum": F.sum("price"),
    }
    keys = ["host_id", "host_name", "month_date"]
    by_month = days.groupBy("listing_id", "month_date").agg(*[e.alias(n) for n, e in measures.items()])
    more = ("positive_reviews", "length_sum", "lengths")
    counted = {
        "review_count": F.countDistinct("review_id"),
        "positive_reviews": count_of(positive),
        "length_sum": F.sum("review_length"),
        "lengths": F.count("review_length"),
        "__reviews": F.count("*"),
    }
    of = ["listing_id", "month_date"]
    reviewed = held.where("month_date IS NOT NULL").groupBy(*of).agg(*[e.alias(n) for n, e in counted.items()])

    def met(days: DataFrame, other: DataFrame) -> DataFrame:
        """Either's columns of each month that has days; a union needs no exchange where both are dealt by listing, a join would."""
        both = days.unionByName(other, allowMissingColumns=True)
        return both.groupBy(*of).agg(*[F.any_value(c, F.lit(True)).alias(c) if c == "__ids" else F.max(c).alias(c) for c in both.columns if c not in of]).where("total_days IS NOT NULL")

    nth = F.row_number().over(Window.partitionBy("listing_id", "host_id", "host_name").orderBy(F.lit(1)))  # a listing that is there twice is one
    joined = met(by_month, reviewed).join(hosts.withColumn("__nth", nth), "listing_id")
    if mode == "as_written":
        joined = joined.withColumns({n: F.col(n) * F.coalesce("__reviews", F.lit(1)) for n in measures} | {n: F.col(n) * F.col("total_days") for n in more})
    summed = [*[F.sum(n).alias(n) for n in measures], *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in more]]
    grouped = joined.groupBy(*keys).agg(F.count_if(F.col("__nth") == 1).alias("active_listings"), *summed, F.coalesce(F.sum("review_count"), F.lit(0)).alias("review_count"))
    if mode == "as_written":  # a review of two listings of a host counts once
        ids = held.where("month_date IS NOT NULL").groupBy(*of).agg(F.collect_set("review_id").alias("__ids"))
        apart = met(by_month.select(*of, "total_days"), ids).join(hosts, "listing_id").select(*[F.col(k).alias(f"__{k}") for k in keys], F.explode("__ids").alias("review_id"))
        apart = apart.groupBy(*[f"__{k}" for k in keys]).agg(F.countDistinct("review_id").alias("__distinct"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
        grouped = grouped.join(apart, same, "left").withColumn("review_count", F.coalesce("__distinct", F.lit(0)))
    shown = grouped.select(
        *keys,
        *("active_listings", "booked_days", "available_days", "total_days"),
        rounded(ratio("booked_days", "total_days", 100.0), 2).alias("occupancy_rate"),
        "estimated_revenue",
        rounded(ratio("estimated_revenue", "active_listings"), 2).alias("revenue_per_listing"),
        rounded(ratio("estimated_revenue", "booked_days"), 2).alias("revenue_per_booked_day"),
        ratio("price_sum", "priced_days").alias("average_daily_rate"),
        "review_count",
        rounded(ratio("positive_reviews", "review_count", 100.0), 2).alias("positive_review_percentage"),
        ratio("length_sum", "lengths").alias("avg_review_length"),
    )
    w = Window.partitionBy("host_id").orderBy("month_date")
    shown = shown.withColumns({"previous_month_revenue": F.lag("estimated_revenue").over(w), "previous_month_occupancy": F.lag("occupancy_rate").over(w)})
    growth = F.when(F.col("previous_month_revenue") > 0, (F.col("estimated_revenue").cast("double") / F.col("previous_month_revenue").cast("double") - 1) * 100)
    return shown.withColumn("revenue_growth_pct", growth)


def review_metrics(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews of each listing; those without any have zeros and a category of their own."""
    kinds = ("positive", "negative", "neutral")
    grouped = reviews.groupBy("listing_id").agg(
        F.count("*").alias("review_count"),
        mean("review_length").alias("avg_review_length"),
        F.min("review_date").alias("first_review_date"),
        F.max("review_date").alias("last_review_date"),
        *[count_of(F.col("sentiment") == k).alias(f"{k}_reviews") for k in kinds],
    )
    joined = listings.select(*DIM, "price").join(grouped, "listing_id", "left")
    joined = joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("review_count", *[f"{k}_reviews" for k in kinds])})
    good, bad = F.col("positive_reviews"), F.col("negative_reviews")
    category = F.when(F.col("review_count") == 0, "No Reviews").when(good > bad * 3, "Highly Rated").when(good > bad, "Well Rated").when(bad > good, "Poorly Rated").otherwise("Mixed Reviews")
    return joined.withColumns({"positive_review_percentage": F.coalesce(ratio(good, "review_count", 100.0), F.lit(0.0)), "review_rating_category": category})


def freshness(df: DataFrame, record: str, ingested: str, loaded: str, as_of: Column) -> DataFrame:
    """Oldest and newest stamps, spans in hours, and the share of rows ingested in the 24 hours before as_of."""
    hours = lambda a, b: (F.unix_micros(F.col(b)) - F.unix_micros(F.col(a))) / 3.6e9
    out = df.agg(
        *[f(c).alias(f"{age}_{n}") for c, n in ((record, "record"), (ingested, "ingestion"), (loaded, "load")) for f, age in ((F.min, "oldest"), (F.max, "newest"))],
        F.count("*").alias("record_count"),
        count_of(F.col(ingested) >= as_of - F.expr("interval 24 hours")).alias("fresh_records_24h"),
    )
    spans = {f"{n}_span_hours": hours(f"oldest_{n}", f"newest_{n}") for n in ("record", "ingestion", "load")}
    return out.withColumns(spans | {"fresh_records_percentage": ratio("fresh_records_24h", "record_count", 100.0)})

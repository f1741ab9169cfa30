"""Files to marts: deliveries of gzipped CSV, loaded with their checks and refreshed in steps, against one computation of all."""

import csv
import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodestay import sources
from lodestay.operators import checks, clean, marts
from lodestay.plans.warehouse import Warehouse
from lodestay.sources import loading

TEXT = "host_since host_location host_response_time host_response_rate host_acceptance_rate host_is_superhost neighbourhood_cleansed property_type room_type bathrooms_text amenities license instant_bookable".split()
NUMBERS = ["host_listings_count", "latitude", "longitude", "accommodates", "bedrooms", "beds", "minimum_nights", "maximum_nights", *clean.HOST_COUNTS]
LISTINGS = ", ".join(["id bigint", "host_id bigint", "name string", "host_name string", "price string", *[f"{c} string" for c in TEXT], *[f"{c} int" for c in NUMBERS], "last_scraped timestamp"])
CALENDAR = "listing_id bigint, date string, available string, price string, adjusted_price string, minimum_nights int, maximum_nights int"
REVIEWS = "id bigint, listing_id bigint, reviewer_id bigint, reviewer_name string, date string, comments string"


def put(path, schema, rows):
    names = [c.strip().split()[0] for c in schema.split(",")]
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", newline="") as f:
        out = csv.writer(f)
        out.writerow(names)
        out.writerows([[r.get(n, "") for n in names] for r in rows])


def listing(i, price):
    return {"id": i, "host_id": i // 2, "name": f"n{i}", "host_name": f"h{i // 2}", "price": price, "accommodates": 2, "minimum_nights": 1, "maximum_nights": 9, "property_type": "Loft", "room_type": "Room", "last_scraped": "2024-01-01 00:00:00"}


def day(i, d, taken, price):
    return {"listing_id": i, "date": d, "available": "f" if taken else "t", "price": f"${price}.00", "minimum_nights": 1, "maximum_nights": 9}


def review(n, i, who, d, text):
    return {"id": n, "listing_id": i, "reviewer_id": who, "reviewer_name": f"r{who}", "date": d, "comments": text}


FIRST = {
    "listings": (LISTINGS, [listing(i, f"${50 + i}.00") for i in range(6)]),
    "calendar": (CALENDAR, [day(i, f"2024-01-{d:02d}", (i + d) % 3 == 0, 50 + d) for i in range(6) for d in range(1, 16)] + [day(2, "", False, 70)]),
    "reviews": (REVIEWS, [review(n, n % 6, n % 4, f"2024-01-{n % 9 + 1:02d}", "a great stay") for n in range(20)]),
}
SECOND = {
    "listings": (LISTINGS, [listing(1, "$99.00"), listing(2, "$52.00"), listing(7, "$70.00")]),
    "calendar": (CALENDAR, [day(i, f"2024-01-{d:02d}", d % 2 == 0, 80 + d) for i in (1, 7) for d in range(14, 20)] + [day(1, "", True, 9)]),
    "reviews": (REVIEWS, [review(3, 3, 3, "2024-01-20", "a terrible stay"), review(30, 7, 9, "02/03/2024", "fine"), review(31, 7, 9, "soon", "no date")]),
}


def deliver(spark, house, work, given, n, stamp):
    status = {}
    for entity, (schema, rows) in given.items():
        put(f"{work}/in{n}/{entity}/{entity}.csv.gz", schema, rows)
        file = sources.fingerprints(spark, f"{work}/in{n}/{entity}").first()
        status[entity] = house.deliver(entity, sources.read_csv_gz(spark, file.file_name, schema), f"b{n}", f"{entity}.csv.gz", file.file_hash, ingested_at=stamp)
    return status


def plain(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_from_files_to_marts_in_steps(spark):
    work = sources.work_dir(spark).removeprefix("file://")
    house = Warehouse(spark, f"{work}/house", buckets=4)
    assert set(deliver(spark, house, work, FIRST, 1, "2024-02-01 00:00:00").values()) == {"COMPLETED"}
    assert all(house.refresh().values())
    assert set(deliver(spark, house, work, FIRST, 1, "2024-02-01 00:00:00").values()) == {"SKIPPED"}  # the same bytes
    assert not any(house.refresh().values())
    untouched = {p for p in Path(work, "house/stored/fct_calendar_daily").rglob("*.parquet")}
    assert set(deliver(spark, house, work, SECOND, 2, "2024-03-01 00:00:00").values()) == {"COMPLETED"}
    assert all(house.refresh().values()) and not any(house.refresh().values())
    assert untouched <= {p for p in Path(work, "house/stored/fct_calendar_daily").rglob("*.parquet")}
    plan = house.calendar.above(house.bronze("calendar"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(_ingested_at" in plan and house.calendar.above(house.bronze("calendar")).count() == 0
    # one computation over the newest row of each key
    newest = {e: {} for e in FIRST}
    dateless = []
    for given in (FIRST, SECOND):
        for entity, (_, rows) in given.items():
            for r in rows:
                if entity == "calendar" and not r["date"]:
                    dateless.append(r)
                else:
                    newest[entity][(r["listing_id"], r["date"]) if entity == "calendar" else r["id"]] = r
    newest["calendar"] = [*newest["calendar"].values(), *dateless]
    raw = {}
    for entity, (schema, _) in FIRST.items():
        rows = newest[entity] if entity == "calendar" else newest[entity].values()
        put(f"{work}/whole/{entity}/{entity}.csv.gz", schema, rows)
        raw[entity] = sources.read_csv_gz(spark, f"{work}/whole/{entity}", schema).withColumn("_ingested_at", F.lit("2024-03-01").cast("timestamp"))
    facts = marts.fct_calendar_daily(clean.clean_calendar(clean.stg_calendar(raw["calendar"])))
    shown = ("listing_id", "calendar_date", "is_available", "price", "price_change_from_previous_day")
    assert plain(house.facts(), *shown) == plain(facts, *shown)
    reviews = marts.fct_reviews(clean.clean_reviews(clean.stg_reviews(raw["reviews"])))
    assert plain(house.valid_reviews(), "review_id", "review_date", "sentiment") == plain(reviews, "review_id", "review_date", "sentiment")
    listings = clean.clean_listings(clean.stg_listings(raw["listings"]))
    assert plain(house.current_listings(), "listing_id", "price") == plain(listings, "listing_id", "price")
    assert {r.listing_id: r.n for r in house.listings.read().groupBy("listing_id").agg(F.count("*").alias("n")).collect()} == {0: 1, 1: 2, 2: 1, 3: 1, 4: 1, 5: 1, 7: 1}
    hosts = ("host_id", "month_date", "booked_days", "total_days", "estimated_revenue", "review_count")
    assert plain(marts.host_performance(house.current_listings(), house.facts(), house.valid_reviews()), *hosts) == plain(marts.host_performance(listings, facts, reviews), *hosts)
    who = ("reviewer_id", "reviewer_name", "total_reviews", "last_review_date")
    assert plain(house.reviewers.read(), *who) == plain(marts.dim_reviewers(clean.stg_reviews(raw["reviews"])), *who)
    assert sorted(map(tuple, house.batches().collect())) == sorted((e, f"b{n}", len(rows)) for n, given in ((1, FIRST), (2, SECOND)) for e, (_, rows) in given.items())


def test_a_refused_delivery_leaves_the_warehouse_as_it_was(spark):
    work = sources.work_dir(spark).removeprefix("file://")
    house = Warehouse(spark, f"{work}/house", buckets=2)
    assert not any(house.refresh().values())  # nothing has come
    deliver(spark, house, work, FIRST, 1, "2024-02-01 00:00:00")
    house.refresh()
    before = plain(house.facts(), "listing_id", "calendar_date", "price")
    bad = spark.createDataFrame([(1, "2024-01-03", "t", "$-5.00", "", 1, 9)], CALENDAR)
    with pytest.raises(loading.RejectedError, match="price"):
        house.deliver("calendar", bad, "b9", "bad.csv.gz", "x", rules=[checks.row_rule("price", "price LIKE '$-%'")])
    with pytest.raises(ValueError, match="lacks.*available"):
        house.deliver("calendar", bad.drop("available"), "b9", "bad.csv.gz", "y")
    assert not any(house.refresh().values()) and plain(house.facts(), "listing_id", "calendar_date", "price") == before
    failed = loading.read_metrics(spark, f"{work}/house/metrics").where("processing_status = 'FAILED'").select("rows_processed", "rows_inserted", "failed_rules").collect()
    assert sorted(map(tuple, failed)) == [(0, 0, "{}"), (1, 0, '{"price":1}')]

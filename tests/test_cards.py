from __future__ import annotations

import json

from pyspark.sql import functions as F

from rentlens.plans import canonical
from rentlens.schema import CANONICAL_COLUMNS, LOOKUP, RAW_RECORD
from rentlens.sources import cards
from rentlens.sources.cards import cards_of_page
from rentlens.sources.tables import append_lookup, read_lookup, read_records

BASE = "https://www.buyrentkenya.com"
CARD = """
<div class="listing-card">
  <a href="/x/1"><h2> Executive <b>Apartment</b> </h2></a>
  <div class="text-sm"> Westlands, Nairobi </div>
  <p>  KSh 65,000 per month </p>
  <span class="feature-label">2 Bathrooms</span>
  <span class="text-sm">3 Beds</span>
</div>"""


def parse(html):
    return list(cards_of_page(html, BASE, "Nairobi"))


def test_card():
    assert parse(CARD) == [
        ("ExecutiveApartment", "KSh 65,000 per month", "Westlands, Nairobi", f"{BASE}/x/1", 2)
    ]


def test_missing_parts():
    assert parse('<div class="listing-card"><h2>No price</h2></div>') == []
    assert parse('<div class="listing-card"><p>KSh 5</p></div>') == []
    bare = '<div class="relative"><a class="card-title">T</a><p>KSh 5</p></div>'
    assert parse(bare) == [("T", "KSh 5", "Nairobi", "", None)]
    full = '<div class="relative"><a class="title" href="http://e/1">T</a>KSh 5</div>'
    assert parse(full)[0][3] == "http://e/1"


def test_a_number_beyond_every_column_is_null(spark):
    html = CARD.replace("2 Bathrooms", "99999999999 Bathrooms")
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r["card_bathrooms"] for r in cards.listing_cards(pages).collect()] == [None]


def test_first_bath_label_decides():
    html = CARD.replace("2 Bathrooms", "Bathroom").replace("3 Beds", "4 baths")
    assert parse(html)[0][4] is None


def test_nested_cards_and_unclosed_tags():
    html = (
        '<div class="listing-card"><h2>Outer</h2><p>KSh 1'
        '<div class="relative"><h2>Inner</h2><span>KSh 2</span></div></div>'
        '<div class="listing-card"><h2>Next<br></h2><img src=x>KSh 3</div>'
    )
    got = [(c[0], c[1]) for c in parse(html)]
    assert got == [("Outer", "KSh 1"), ("Inner", "KSh 2"), ("Next", "KSh 3")]


def test_junk_pages():
    assert parse(None) == [] and parse("") == []
    assert parse("<div class='listing-card'><h2>KSh</h2></div></div></p>") == [
        ("KSh", "KSh", "Nairobi", "", None)
    ]


def test_pages_table(spark):
    pages = spark.createDataFrame(
        [(1, CARD + CARD), (2, "<p>KSh 1</p>"), (3, None)], "page_id long, html string"
    )
    got = cards.listing_cards(pages).collect()
    assert [(r["page_id"], r["position"], r["card_bathrooms"]) for r in got] == [
        (1, 0, 2), (1, 1, 2),
    ]


def lookups(spark):
    cache = spark.createDataFrame(
        [("Westlands CBD", "Westlands", -1.2633, 36.8037), ("westlands cbd", "later", 0.0, 0.0)],
        LOOKUP,
    ).withColumn("inserted", F.monotonically_increasing_id())
    geocoded = spark.createDataFrame(
        [("Thika Road", "Thika Superhighway, Nairobi, Kenya", -1.22, 36.88)],
        "query string, address string, lat double, lon double",
    )
    return cache, geocoded


def test_canonical_listings(spark):
    raw = [
        {"id": "brk-abc123", "title": "Spacious 2 Bedroom Apartment", "price": "KSh 65,000",
         "location": "WESTLANDS cbd", "url": "https://e/1", "bedrooms": "9", "bathrooms": "2"},
        {"title": "Studio in Kilimani", "price": "KSh 25000", "suburb": "Kilimani", "url": "https://e/2"},
        {"name": "House", "price": None, "rentPrice": "90,000", "location": "", "area": "Thika Road",
         "link": "https://e/3", "propertyId": "p3", "beds": "0", "baths": "1"},
        {"title": "Mystery", "price": "KSh 45,000", "id": "p4"},
        {"title": "Nowhere 1 bed", "price": "on call", "location": "qqqq zzzz", "id": "p5"},
        {"title": "No identity", "price": "KSh 9,000", "location": "Ngara Rd"},
    ]
    rows = spark.createDataFrame([json.dumps(r) for r in raw], "string").select(
        F.from_json("value", RAW_RECORD).alias("r")
    ).select("r.*")
    cache, geocoded = lookups(spark)
    stamp = F.lit("2026-03-04 05:06:07").cast("timestamp_ntz")
    out = canonical.canonical_listings(rows, cache, geocoded, stamp)
    assert out.columns == [c for c in CANONICAL_COLUMNS if c != "ingested_at"]
    got = {r["source_url"] or r["property_id"] or r["title"]: r for r in out.collect()}
    # The record without any location is skipped.
    assert len(got) == 5
    one = got["https://e/1"]
    assert (one["property_id"], one["neighbourhood"], one["latitude"]) == (
        "brk-abc123", "Westlands", -1.2633,
    )
    assert (one["price_ksh"], one["bedrooms"], one["bathrooms"]) == (65000, 2, 2)
    assert one["scraped_at"] == "2026-03-04T05:06:07.000000+00:00"
    two = got["https://e/2"]
    assert two["property_id"].startswith("brk-") and len(two["property_id"]) == 16
    assert (two["neighbourhood"], two["bedrooms"], two["property_type"]) == (
        "Kilimani", 0, "Apartment",
    )
    three = got["https://e/3"]
    assert (three["property_id"], three["neighbourhood"], three["title"]) == (
        "p3", "Thika Superhighway", "House",
    )
    assert (three["price_ksh"], three["bedrooms"], three["bathrooms"]) == (90000, 0, 1)
    five = got["p5"]
    assert (five["neighbourhood"], five["dist_to_archives_km"], five["price_ksh"]) == (
        "Unknown", None, None,
    )
    # Neither id nor url: no id, so the record cannot merge with others like it.
    assert got["No identity"]["property_id"] is None
    assert got["No identity"]["neighbourhood"] == "Ngara"
    assert got["No identity"]["dist_to_archives_km"] == 1.214

    summary = canonical.ingest_summary(rows).first().asDict()
    assert summary == {"total_scraped": 6, "posted_ok": 4, "failed": 1, "skipped": 1}


def test_record_cap(spark):
    raw = spark.range(20).withColumn("title", F.lit("x"))
    assert [r["id"] for r in canonical.first_records(raw, "id", 3).collect()] == [0, 1, 2]


def test_json_array_and_cache_files(spark, tmp_path):
    (tmp_path / "batch.json").write_text(
        json.dumps([{"title": "1 BR", "location": "Ngara Estate", "price": "KSh 30,000", "x": 1}])
    )
    got = read_records(spark, str(tmp_path / "batch.json")).collect()
    assert len(got) == 1 and got[0]["location"] == "Ngara Estate" and got[0]["id"] is None

    path = str(tmp_path / "cache")
    for name in ("first", "second"):
        append_lookup(
            spark.createDataFrame([("Kilimani Area, W", name, -1.2, 36.7)], LOOKUP), path
        )
    rows = read_lookup(spark, path).orderBy("inserted").collect()
    assert [r["matched_name"] for r in rows] == ["first", "second"]
    assert rows[0]["raw_string"] == "Kilimani Area, W"

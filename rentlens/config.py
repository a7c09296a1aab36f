"""Thresholds and labels. Every number a model depends on is named here once."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Quality gate.
    min_price: int = 3_000
    max_price: int = 2_000_000
    max_bedrooms: int = 20
    max_bathrooms: int = 10

    # Value zones.
    premium_price: int = 80_000
    premium_km: float = 5.0
    sweet_price: int = 50_000
    sweet_km: float = 8.0
    commuter_km: float = 15.0
    studio_price: int = 35_000

    # Rankings.
    min_support: int = 3
    weight_price: float = 0.5
    weight_distance: float = 0.3
    weight_consistency: float = 0.2

    # Trend confidence.
    robust_count: int = 15
    stable_count: int = 5

    # Price-distance points.
    outlier_floor: int = 1_000

    # Time.
    local_zone: str = "Africa/Nairobi"
    expiry_days: int = 90
    # Commits of the history table beyond which old ones are folded into one.
    history_commits: int = 20
    # Held deliveries are written when they have this size or this age.
    buffer_bytes: int = 128 << 20
    buffer_seconds: int = 600
    recency_hours: int = 26
    warn_hours: int = 25
    error_hours: int = 49
    gate_hours: int = 2

    # Place resolution. The fixed point is the national archives building.
    origin_lat: float = -1.2850
    origin_lon: float = 36.8258
    fuzzy_cutoff: float = 80.0
    default_location: str = "Nairobi"
    site_base_url: str = "https://www.buyrentkenya.com"
    id_prefix: str = "brk-"


DEFAULTS = Settings()

# Labels that outputs are compared on.
VALUE_ZONES = ["Premium", "Sweet Spot", "Commuter", "Mid-range", "Unknown"]
PRICE_BUCKETS = ["Under 15k", "15k - 30k", "30k - 50k", "50k - 80k", "80k+", "Unknown"]
COMMUTE_TIERS = [
    "1 - Walking (0-2 km)",
    "2 - Short (2-5 km)",
    "3 - Medium (5-8 km)",
    "4 - Long (8-15 km)",
    "5 - Far (15+ km)",
    "Unknown",
]
LOCATION_SEGMENTS = [
    "Core CBD / Inner Ring",
    "Mid-Ring Suburb",
    "Commuter Zone",
    "Satellite Town",
]
BEDROOM_LABELS = ["Studio", "1 BR", "2 BR", "3 BR", "4+ BR", "Unknown"]
VERDICTS = [
    "Project Star",
    "Premium Location",
    "Good Value",
    "Budget Commuter",
    "Average",
]
REQUIRED_FIELDS = ["location_raw", "price_raw", "property_id"]

"""Distance on the WGS-84 ellipsoid."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rentlens.functions.numeric import round_to

# WGS-84 axes in metres and flattening.
MAJOR_AXIS = 6_378_137.0
FLATTENING = 1 / 298.257223563
MINOR_AXIS = MAJOR_AXIS * (1 - FLATTENING)

# Each round shrinks the error by about the flattening, so six are ample
# for any two points that are not nearly opposite on the globe.
ROUNDS = 6
# Radians that another round may move the longitude; 1e-9 is below a centimetre.
SETTLED = 1e-9
# Cosine of the arc from which on a pair is solved by its azimuth: 174 degrees.
OPPOSITE = -0.995
# Halvings of a half turn until the azimuth is as exact as a double.
HALVINGS = 54
# A latitude of 0 is taken as 6 micrometres off the equator, where azimuths are defined.
LEAST_SINE = 1e-12


def _let(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """Evaluate `values` once and use them many times in `body`."""
    bound = F.array(F.struct(*[v.alias(k) for k, v in values.items()]))
    return F.get(F.transform(bound, body), F.lit(0))


def _reduced(lat: Column | float) -> tuple[Column, Column]:
    """Sine and cosine of the latitude on the auxiliary sphere."""
    if isinstance(lat, Column):
        u = F.atan((1 - FLATTENING) * F.tan(F.radians(lat)))
        return F.sin(u), F.cos(u)
    u = math.atan((1 - FLATTENING) * math.tan(math.radians(lat)))
    return F.lit(math.sin(u)), F.lit(math.cos(u))


def _radians(angle: Column | float) -> Column:
    return F.radians(angle) if isinstance(angle, Column) else F.lit(math.radians(angle))


def _flattened(s: Column, mid: Column) -> Column:
    """How far the longitude on the ellipsoid lags behind the one on the sphere."""
    c = (FLATTENING / 16) * s["cos2_alpha"] * (4.0 + FLATTENING * (4.0 - 3.0 * s["cos2_alpha"]))
    bend = s["sigma"] + c * s["sin_sigma"] * (
        mid + c * s["cos_sigma"] * (2.0 * mid * mid - 1.0)
    )
    return (1.0 - c) * FLATTENING * s["sin_alpha"] * bend


def _metres(s: Column, mid: Column) -> Column:
    """Length of an arc of the auxiliary sphere on the ellipsoid."""
    squash = (MAJOR_AXIS**2 - MINOR_AXIS**2) / MINOR_AXIS**2
    u_sq = s["cos2_alpha"] * squash
    a = 1.0 + u_sq / 16384.0 * (4096.0 + u_sq * (-768.0 + u_sq * (320.0 - 175.0 * u_sq)))
    b = u_sq / 1024.0 * (256.0 + u_sq * (-128.0 + u_sq * (74.0 - 47.0 * u_sq)))
    twice = 2.0 * mid * mid - 1.0
    quarter = mid * (4.0 * s["sin_sigma"] * s["sin_sigma"] - 3.0) * (4.0 * mid * mid - 3.0)
    correction = (
        b * s["sin_sigma"] * (mid + b / 4.0 * (s["cos_sigma"] * twice - b / 6.0 * quarter))
    )
    return MINOR_AXIS * a * (s["sigma"] - correction)


def _by_longitude(p: Column, lam: Column, body: Callable[[Column, Column], Column]) -> Column:
    """Bind arc and azimuth terms of the auxiliary sphere for one longitude difference."""

    def arc(turn: Column) -> Column:
        across = p["cos_u2"] * turn["sin"]
        along = p["cos_u1"] * p["sin_u2"] - p["sin_u1"] * p["cos_u2"] * turn["cos"]
        return _let(
            {
                "sin_sigma": F.sqrt(across * across + along * along),
                "cos_sigma": p["sin_u1"] * p["sin_u2"] + p["cos_u1"] * p["cos_u2"] * turn["cos"],
                "product": p["cos_u1"] * p["cos_u2"] * turn["sin"],
            },
            azimuth,
        )

    def azimuth(a: Column) -> Column:
        sin_alpha = F.coalesce(F.try_divide(a["product"], a["sin_sigma"]), F.lit(0.0))
        return _let(
            {
                "sin_sigma": a["sin_sigma"],
                "cos_sigma": a["cos_sigma"],
                "sigma": F.atan2(a["sin_sigma"], a["cos_sigma"]),
                "sin_alpha": sin_alpha,
                "cos2_alpha": 1.0 - sin_alpha * sin_alpha,
            },
            midpoint,
        )

    def midpoint(s: Column) -> Column:
        offset = F.try_divide(2.0 * p["sin_u1"] * p["sin_u2"], s["cos2_alpha"])
        mid = s["cos_sigma"] - F.coalesce(offset, F.lit(0.0))
        return _let({"mid": mid}, lambda m: body(s, m["mid"]))

    return _let({"sin": F.sin(lam), "cos": F.cos(lam)}, arc)


def _by_azimuth(p: Column) -> Column:
    """Metres between nearly opposite points.

    With the point farther from the equator first and moved to the south, the longitude
    that a geodesic reaches at the other latitude grows with its azimuth at the start, and
    one azimuth gives the shortest line. Halving finds it for any pair.
    """

    def path(start: Column, body: Callable[[Column, Column], Column]) -> Column:
        def ends(t: Column) -> Column:
            along = t["cos"] * p["cos_b1"]
            return _let(
                {
                    "sin_alpha": t["sin"] * p["cos_b1"],
                    "first": along,
                    "second": F.sqrt(F.greatest(along * along + p["gap"], F.lit(0.0))),
                },
                angles,
            )

        def angles(e: Column) -> Column:
            return _let(
                {
                    "sin_alpha": e["sin_alpha"],
                    "from": F.atan2(p["sin_b1"], e["first"]),
                    "to": F.atan2(p["sin_b2"], e["second"]),
                    "omega": F.atan2(e["sin_alpha"] * p["sin_b2"], e["second"])
                    - F.atan2(e["sin_alpha"] * p["sin_b1"], e["first"]),
                },
                line,
            )

        def line(g: Column) -> Column:
            sigma = g["to"] - g["from"]
            return _let(
                {
                    "sigma": sigma,
                    "sin_sigma": F.sin(sigma),
                    "cos_sigma": F.cos(sigma),
                    "sin_alpha": g["sin_alpha"],
                    "cos2_alpha": 1.0 - g["sin_alpha"] * g["sin_alpha"],
                    "omega": g["omega"],
                    "mid": F.cos(g["to"] + g["from"]),
                },
                lambda s: body(s, s["mid"]),
            )

        return _let({"sin": F.sin(start), "cos": F.cos(start)}, ends)

    def halve(bounds: Column, _: Column) -> Column:
        return _let(
            {"at": (bounds["low"] + bounds["high"]) / 2.0},
            lambda h: F.when(
                path(h["at"], lambda s, mid: s["omega"] - _flattened(s, mid)) < p["turn"],
                F.struct(h["at"].alias("low"), bounds["high"].alias("high")),
            ).otherwise(F.struct(bounds["low"].alias("low"), h["at"].alias("high"))),
        )

    whole = F.struct(F.lit(0.0).alias("low"), F.lit(math.pi).alias("high"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), whole, halve)
    return _let({"at": (found["low"] + found["high"]) / 2.0}, lambda h: path(h["at"], _metres))


def _opposite(p: Column) -> Column:
    """The terms of `_by_azimuth` from those of the two points."""
    swapped = F.abs(p["sin_u1"]) < F.abs(p["sin_u2"])

    def pick(first: str, second: str) -> Column:
        return F.when(swapped, p[second]).otherwise(p[first])

    def placed(q: Column) -> Column:
        side = F.when(q["sin_1"] > 0, -1.0).otherwise(1.0)
        by_sine = (q["sin_1"] - q["sin_2"]) * (q["sin_1"] + q["sin_2"])
        by_cosine = (q["cos_2"] - q["cos_1"]) * (q["cos_2"] + q["cos_1"])
        return _let(
            {
                "sin_b1": F.least(side * q["sin_1"], F.lit(-LEAST_SINE)),
                "sin_b2": side * q["sin_2"],
                "cos_b1": q["cos_1"],
                # The difference of squares that keeps most digits.
                "gap": F.when(q["cos_1"] < F.abs(q["sin_1"]), by_cosine).otherwise(by_sine),
                "turn": q["turn"],
            },
            _by_azimuth,
        )

    return _let(
        {
            "sin_1": pick("sin_u1", "sin_u2"), "cos_1": pick("cos_u1", "cos_u2"),
            "sin_2": pick("sin_u2", "sin_u1"), "cos_2": pick("cos_u2", "cos_u1"),
            "turn": F.abs(p["delta"]),
        },
        placed,
    )


def geodesic_m(
    lat: Column, lon: Column, origin_lat: Column | float, origin_lon: Column | float
) -> Column:
    """Metres between any two points, as one JVM-side expression.

    Vincenty's fixed-point iteration on the longitude difference is an `aggregate` over a
    short literal array. It does not settle for points nearly opposite; these, and all
    pairs more than 174 degrees of arc apart, are solved by their azimuth. The branch is
    entered by such rows only. Null coordinates give null.
    """

    def step(p: Column) -> Callable[[Column, Column], Column]:
        return lambda lam, _: _by_longitude(p, lam, lambda s, mid: p["delta"] + _flattened(s, mid))

    def solve(p: Column) -> Column:
        settled = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), p["delta"], step(p))

        def decide(at: Column) -> Column:
            def length(s: Column, mid: Column) -> Column:
                off = F.abs(p["delta"] + _flattened(s, mid) - at["lam"])
                return F.when((off < SETTLED) & (s["cos_sigma"] > OPPOSITE), _metres(s, mid))

            return F.coalesce(_by_longitude(p, at["lam"], length), _opposite(p))

        return _let({"lam": settled}, decide)

    (sin_u1, cos_u1), (sin_u2, cos_u2) = _reduced(origin_lat), _reduced(lat)
    apart = _radians(lon) - _radians(origin_lon)
    turn = F.pmod(apart, F.lit(2 * math.pi))
    folded = F.when(F.abs(apart) <= math.pi, apart).otherwise(F.least(turn, 2 * math.pi - turn))
    distance = _let(
        {"sin_u1": sin_u1, "cos_u1": cos_u1, "sin_u2": sin_u2, "cos_u2": cos_u2, "delta": folded},
        solve,
    )
    known = lat.isNotNull() & lon.isNotNull()
    for given in (origin_lat, origin_lon):
        known = known & given.isNotNull() if isinstance(given, Column) else known
    return F.when(known, distance)


def geodesic_km(
    lat: Column, lon: Column, origin_lat: Column | float, origin_lon: Column | float
) -> Column:
    """Kilometres between any two points, 3 decimals; null for null coordinates."""
    metres = geodesic_m(lat, lon, origin_lat, origin_lon)
    return round_to(metres / 1000.0, 3).cast("double")

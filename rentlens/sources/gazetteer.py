"""Known places with their coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Place name, latitude, longitude. The order decides ties.
PLACES = [
    ("Gigiri", -1.2333, 36.8000),
    ("Runda", -1.2167, 36.8167),
    ("Runda Mimosa", -1.2210, 36.8050),
    ("Runda Evergreen", -1.2100, 36.8300),
    ("Old Muthaiga", -1.2533, 36.8233),
    ("New Muthaiga", -1.2417, 36.8117),
    ("Muthaiga", -1.2500, 36.8167),
    ("Muthaiga North", -1.2309, 36.8078),
    ("Rosslyn", -1.2256, 36.7903),
    ("Rosslyn Heights", -1.2280, 36.7850),
    ("Nyari", -1.2355, 36.7725),
    ("Kitisuru", -1.2396, 36.7840),
    ("Hillview Estate", -1.2450, 36.7900),
    ("Ruaka", -1.2083, 36.7750),
    ("Thindigua", -1.1967, 36.8417),
    ("Ndenderu", -1.2000, 36.7450),
    ("Wangige", -1.2400, 36.7150),
    ("Westlands", -1.2633, 36.8037),
    ("Brookside", -1.2647, 36.7939),
    ("General Mathenge", -1.2558, 36.7992),
    ("Spring Valley", -1.2581, 36.7884),
    ("Loresho", -1.2483, 36.7567),
    ("Kyuna", -1.2567, 36.7767),
    ("Lower Kabete", -1.2450, 36.7633),
    ("Mountain View", -1.2683, 36.7417),
    ("Kangemi", -1.2633, 36.7500),
    ("Kikuyu", -1.2500, 36.6667),
    ("Kinoo", -1.2667, 36.6833),
    ("Uthiru", -1.2650, 36.7167),
    ("Sigona", -1.2417, 36.6333),
    ("Kilimani", -1.2874, 36.7845),
    ("Hurlingham", -1.2950, 36.7967),
    ("Adams Arcade", -1.3009, 36.7808),
    ("Riara", -1.2986, 36.7694),
    ("Lavington", -1.2833, 36.7750),
    ("Kileleshwa", -1.2723, 36.7997),
    ("Riverside", -1.2721, 36.7936),
    ("Karen", -1.3333, 36.7000),
    ("Jamhuri", -1.3033, 36.7667),
    ("Woodley", -1.3033, 36.7750),
    ("Dagoretti", -1.2917, 36.7417),
    ("Kawangware", -1.2833, 36.7417),
    ("Ngong Town", -1.3667, 36.6333),
    ("Bulbul", -1.3550, 36.6650),
    ("Kerarapon", -1.3284, 36.6673),
    ("Ongata Rongai", -1.3917, 36.7417),
    ("Garden Estate", -1.2167, 36.8667),
    ("Ridgeways", -1.2217, 36.8400),
    ("Thome", -1.2144, 36.8525),
    ("WillMary", -1.2144, 36.8525),
    ("Windsor", -1.2386, 36.8544),
    ("Roysambu", -1.2185, 36.8856),
    ("Kasarani", -1.2217, 36.8967),
    ("Mirema", -1.2050, 36.8900),
    ("Zimmerman", -1.2050, 36.8950),
    ("Kahawa Sukari", -1.1850, 36.9350),
    ("Kahawa Wendani", -1.2000, 36.9200),
    ("Githurai 44", -1.2017, 36.9100),
    ("Githurai 45", -1.1983, 36.9250),
    ("Safari Park", -1.2250, 36.8833),
    ("Clay City", -1.2234, 36.9173),
    ("Lucky Summer", -1.2333, 36.9000),
    ("Babadogo", -1.2400, 36.8800),
    ("South B", -1.3122, 36.8456),
    ("South C", -1.3200, 36.8300),
    ("Upper Hill", -1.2967, 36.8167),
    ("Imara Daima", -1.3250, 36.8750),
    ("Syokimau", -1.3600, 36.9380),
    ("Mlolongo", -1.3930, 36.9420),
    ("Athi River", -1.4500, 36.9833),
    ("Kitengela", -1.4833, 36.9667),
    ("Katani", -1.3450, 36.9950),
    ("Utawala", -1.2833, 36.9667),
    ("Ruai", -1.2750, 37.0167),
    ("Nyayo Estate", -1.3150, 36.9050),
    ("Pipeline", -1.3117, 36.9017),
    ("Donholm", -1.3000, 36.8833),
    ("Buruburu", -1.2983, 36.8700),
    ("Umoja", -1.2833, 36.8833),
    ("Fedha", -1.3100, 36.9100),
    ("Eastleigh", -1.2717, 36.8467),
    ("Pangani", -1.2682, 36.8401),
    ("Ngara", -1.2741, 36.8245),
    ("Dandora", -1.2467, 36.9033),
    ("Kayole", -1.2660, 36.9169),
    ("Kariobangi", -1.2500, 36.8833),
    ("Huruma", -1.2583, 36.8667),
    ("Mathare", -1.2583, 36.8500),
    ("Kibera", -1.3133, 36.7883),
]
NAMES = [name for name, _, _ in PLACES]


def gazetteer(spark: SparkSession) -> DataFrame:
    """A local relation, whose size the planner knows; `pos` decides ties."""
    rows = [(i, *place) for i, place in enumerate(PLACES)]
    return spark.createDataFrame(rows, "pos long, name string, lat double, lon double")

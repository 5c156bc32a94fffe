"""Airport dimension for real flight data (J1): code -> (lat, lon, city).

A small static table; ``airports(spark)`` returns it as a DataFrame that
``lookup_join`` broadcasts (48 rows, proven bound).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The 48 known airports, code -> (latitude, longitude, city),
# in the reference's order.
AIRPORTS = [
    ("ATL", 33.6407, -84.4277, "Atlanta"),
    ("LAX", 33.9416, -118.4085, "Los Angeles"),
    ("ORD", 41.9742, -87.9073, "Chicago O'Hare"),
    ("DFW", 32.8998, -97.0403, "Dallas/Fort Worth"),
    ("DEN", 39.8561, -104.6737, "Denver"),
    ("JFK", 40.6413, -73.7781, "New York JFK"),
    ("SFO", 37.6213, -122.379, "San Francisco"),
    ("SEA", 47.4502, -122.3088, "Seattle"),
    ("LAS", 36.0840, -115.1537, "Las Vegas"),
    ("MCO", 28.4312, -81.3081, "Orlando"),
    ("EWR", 40.6895, -74.1745, "Newark"),
    ("BOS", 42.3656, -71.0096, "Boston"),
    ("PHX", 33.4373, -112.0078, "Phoenix"),
    ("IAH", 29.9902, -95.3368, "Houston"),
    ("MIA", 25.7959, -80.2870, "Miami"),
    ("MSP", 44.8848, -93.2223, "Minneapolis"),
    ("DTW", 42.2124, -83.3534, "Detroit"),
    ("FLL", 26.0742, -80.1506, "Fort Lauderdale"),
    ("PHL", 39.8729, -75.2437, "Philadelphia"),
    ("LGA", 40.7769, -73.8740, "LaGuardia"),
    ("BWI", 39.1774, -76.6684, "Baltimore"),
    ("SLC", 40.7899, -111.9791, "Salt Lake City"),
    ("DCA", 38.8512, -77.0402, "Washington Reagan"),
    ("IAD", 38.9531, -77.4565, "Washington Dulles"),
    ("SAN", 32.7338, -117.1933, "San Diego"),
    ("TPA", 27.9756, -82.5333, "Tampa"),
    ("PDX", 45.5898, -122.5951, "Portland"),
    ("STL", 38.7487, -90.3700, "St. Louis"),
    ("HNL", 21.3187, -157.9225, "Honolulu"),
    ("AUS", 30.1975, -97.6664, "Austin"),
    ("BNA", 36.1263, -86.6774, "Nashville"),
    ("MDW", 41.7868, -87.7522, "Chicago Midway"),
    ("DAL", 32.8481, -96.8512, "Dallas Love"),
    ("HOU", 29.6454, -95.2789, "Houston Hobby"),
    ("RDU", 35.8776, -78.7875, "Raleigh-Durham"),
    ("CLE", 41.4117, -81.8498, "Cleveland"),
    ("SMF", 38.6954, -121.5908, "Sacramento"),
    ("MCI", 39.2976, -94.7139, "Kansas City"),
    ("SJC", 37.3639, -121.9289, "San Jose"),
    ("OAK", 37.7213, -122.2208, "Oakland"),
    ("MSY", 29.9934, -90.2580, "New Orleans"),
    ("SAT", 29.5337, -98.4698, "San Antonio"),
    ("PIT", 40.4915, -80.2329, "Pittsburgh"),
    ("RSW", 26.5362, -81.7552, "Fort Myers"),
    ("IND", 39.7173, -86.2944, "Indianapolis"),
    ("CVG", 39.0489, -84.6678, "Cincinnati"),
    ("CMH", 39.9980, -82.8919, "Columbus"),
    ("JAX", 30.4941, -81.6879, "Jacksonville"),
]


def airports(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AIRPORTS, "code string, lat double, lon double, city string")

"""JSON decoding of the wire format."""

from contrail.sources.stream import decode_events


def test_decode_nan_float_month_and_corrupt(spark):
    msgs = [
        '{"timestamp": "2025-12-17T09:23:27.796123", "AIRLINE_CODE": "AA", "ORIGIN": "JFK", "DEST": "LAX", '
        '"DEP_DELAY": NaN, "ARR_DELAY": 5, "DISTANCE": 2475.0, "Month": 5.0, "DayOfWeek": 2, "CRS_DEP_TIME": 930}',
        '{"a":',
        '{"timestamp": "2025-12-17T09:23:27", "Month": 12}',
    ]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    rows = decode_events(df).collect()
    a, bad, c = rows
    assert a.airline_code == "AA" and a.month == 5 and a.crs_dep_time == 930
    assert a.dep_delay != a.dep_delay  # NaN kept by the decoder (nan_to_null runs in cleaning)
    assert str(a.timestamp) == "2025-12-17 09:23:27.796000"
    assert bad._corrupt_record == '{"a":' and bad.airline_code is None
    assert str(c.timestamp) == "2025-12-17 09:23:27" and c.month == 12

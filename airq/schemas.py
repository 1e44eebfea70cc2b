"""Declared schemas of the inputs."""

from __future__ import annotations

from pyspark.sql import types as T

SENSOR_KEYS = ["sensor_id", "sensor_type", "location", "lat", "lon", "timestamp"]
DUST = ["P1", "durP1", "ratioP1", "P2", "durP2", "ratioP2"]
PRESSURE = ["pressure", "altitude", "pressure_sealevel", "temperature"]

# Columns of the sensor archives in file order, by sensor type.
SENSOR_MEASURES = {
    "DHT22": ["temperature", "humidity"],
    "SDS011": DUST,
    "PPD42NS": DUST,
    "BMP180": PRESSURE,
    "BME280": [*PRESSURE, "humidity"],
}

MEASURES = [*DUST, "temperature", "humidity", "pressure", "altitude", "pressure_sealevel"]
OBSERVATION_COLUMNS = [*SENSOR_KEYS, *MEASURES]

_KEY_TYPES = {
    "sensor_id": T.IntegerType(),
    "sensor_type": T.StringType(),
    "location": T.IntegerType(),
    "lat": T.DoubleType(),
    "lon": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _observation(measures: list[str]) -> T.StructType:
    fields = [T.StructField(c, t) for c, t in _KEY_TYPES.items()]
    return T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in measures])


OBSERVATION = _observation(MEASURES)


def sensor_schema(sensor_type: str) -> T.StructType:
    return _observation(SENSOR_MEASURES[sensor_type])


# Hourly weather products: columns after STATIONS_ID and MESS_DATUM.
PRODUCT_COLUMNS = {
    "temperature": ["QN_9", "TT_TU", "RF_TU"],
    "precipitation": ["QN_8", "R1", "RS_IND", "WRTR"],
    "cloud": ["QN_9", "V_N_I", "V_N"],
    "sun": ["QN_7", "SD_SO"],
    "wind": ["QN_3", "F", "D"],
}
PRODUCTS = list(PRODUCT_COLUMNS)
_TEXT_COLUMNS = {"V_N_I"}

# Capability flag and nearest-station column of each product.
CAPABILITIES = {
    "precipitation": ("isPerc", "closestPerc"),
    "cloud": ("isCloud", "closestCloud"),
    "sun": ("isSun", "closestSun"),
    "wind": ("isWind", "closestWind"),
    "temperature": ("isTemp", "closestTemp"),
}

# Weather columns attached to an observation, by product.
WEATHER_COLUMNS = {
    "temperature": ["TT_TU", "RF_TU"],
    "precipitation": ["R1", "RS_IND", "WRTR"],
    "cloud": ["V_N_I", "V_N"],
    "sun": ["SD_SO"],
    "wind": ["F", "D"],
}
WEATHER_FIELDS = [c for p in PRODUCTS for c in WEATHER_COLUMNS[p]]


def product_schema(product: str) -> T.StructType:
    fields = [T.StructField("STATIONS_ID", T.IntegerType()), T.StructField("MESS_DATUM", T.StringType())]
    for c in PRODUCT_COLUMNS[product]:
        fields.append(T.StructField(c, T.StringType() if c in _TEXT_COLUMNS else T.DoubleType()))
    return T.StructType(fields)


SENSOR_METADATA = T.StructType(
    [
        T.StructField("_c0", T.IntegerType()),
        T.StructField("sensor_id", T.IntegerType()),
        T.StructField("location", T.IntegerType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("lon", T.StringType()),
        T.StructField("lat", T.StringType()),
    ]
)

SNAPSHOT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("location", T.StructType([T.StructField("id", T.LongType())])),
        T.StructField(
            "sensordatavalues",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.LongType()),
                        T.StructField("value", T.StringType()),
                        T.StructField("value_type", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

# Measures of the geo-time aggregate: output column, source field, aggregate.
GEO_TIME_MEASURES = [
    ("weekend", "datedim.weekend", "max"),
    ("holiday", "datedim.holiday", "max"),
    ("day_of_week", "datedim.day_of_week", "max"),
    ("day_num", "datedim.day_num", "mean"),
    ("time_num", "datedim.time_num", "mean"),
    ("temperature", "temperature", "mean"),
    ("dwd_temperature", "dwddim.TT_TU", "mean"),
    ("humidity", "humidity", "mean"),
    ("dwd_precipitation_height", "dwddim.R1", "mean"),
    ("dwd_precipitation_indicator", "dwddim.RS_IND", "max"),
    ("pressure", "pressure", "mean"),
    ("dwd_wind_speed", "dwddim.F", "mean"),
    ("dwd_wind_direction", "dwddim.D", "mean"),
    ("dwd_clouds", "dwddim.V_N", "mean"),
    ("dwd_sun", "dwddim.SD_SO", "mean"),
    ("P1", "P1", "mean"),
    ("durP1", "durP1", "mean"),
    ("ratioP1", "ratioP1", "mean"),
    ("P2", "P2", "mean"),
    ("durP2", "durP2", "mean"),
    ("ratioP2", "ratioP2", "mean"),
]
GEO_TIME_KEYS = ["hash", "year", "month", "day", "time_bin"]

# Measures kept as arrays in the series table.
SERIES_MEASURES = [
    "weekend",
    "holiday",
    "day_of_week",
    "day_num",
    "time_num",
    "temperature",
    "dwd_temperature",
    "humidity",
    "dwd_precipitation_height",
    "pressure",
    "dwd_wind_speed",
    "dwd_wind_direction",
    "dwd_clouds",
    "dwd_sun",
    "P1",
    "P2",
]

"""Declared input schemas and output table contracts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(18,5)": T.DecimalType(18, 5),
}


def struct(columns: str) -> T.StructType:
    """Schema from ``"name type, name type"``, usable before a session exists."""
    pairs = (column.split(" ") for column in columns.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column names, order and types of the files that are read and of the tables that
# are written.

# --- inputs -----------------------------------------------------------------------------------

IMMIGRATION_SOURCE = struct(
    "cicid double, i94yr double, i94mon double, i94cit double, i94res double, i94port string, "
    "arrdate double, i94mode double, i94addr string, depdate double, i94bir double, "
    "i94visa double, count double, dtadfile string, visapost string, entdepa string, "
    "entdepd string, matflag string, biryear double, dtaddto string, gender string, "
    "airline string, admnum double, fltno string, visatype string"
)

TEMPERATURE = struct(
    "dt timestamp_ntz, AverageTemperature double, AverageTemperatureUncertainty double, "
    "City string, Country string, Latitude string, Longitude string"
)

# The raw log: keys as they stand in the JSON. userId is blank for visitors who are not logged in
# and registration may carry a fraction, so both are read as text and cast afterwards.
LOG_JSON = struct(
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length decimal(18,5), level string, location string, method string, "
    "page string, registration string, sessionId bigint, song string, status int, ts bigint, "
    "userAgent string, userId string"
)

SONG_JSON = struct(
    "num_songs int, artist_id string, artist_latitude decimal(18,5), "
    "artist_longitude decimal(18,5), artist_location string, artist_name string, "
    "song_id string, title string, duration decimal(18,5), year int"
)


# --- outputs ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class TableContract:
    """What a loaded table must look like; the quality checks are derived from it."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def ddl(self, table: str | None = None, location: str | None = None) -> str:
        """``CREATE TABLE IF NOT EXISTS`` text for this contract."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        text = f"CREATE TABLE IF NOT EXISTS {table or self.name} ({columns}) USING parquet"
        if self.partition_by:
            text += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in self.partition_by) + ")"
        if location is not None:
            text += f" LOCATION '{location}'"
        return text


def _contract(name: str, ddl: str, key: str, **rest) -> TableContract:
    return TableContract(name=name, schema=struct(ddl), key=tuple(key.split()), **rest)


_CONTRACTS = [
    _contract(
        "staging_events",
        "staging_event_id bigint, artist string, auth string, first_name string, gender string, "
        "item_in_session int, last_name string, length decimal(18,5), level string, "
        "location string, method string, page string, registration bigint, session_id bigint, "
        "song string, status int, ts timestamp_ntz, user_agent string, user_id bigint",
        "staging_event_id",
        max_length={"auth": 30, "gender": 8},
    ),
    _contract(
        "staging_songs",
        "staging_song_id bigint, num_songs int, artist_id string, artist_latitude decimal(18,5), "
        "artist_longitude decimal(18,5), artist_location string, artist_name string, "
        "song_id string, title string, duration decimal(18,5), year int",
        "staging_song_id",
        max_length={"artist_id": 30, "song_id": 30},
    ),
    _contract(
        "songplays",
        "songplay_id string, start_time timestamp_ntz, user_id bigint, level string, "
        "song_id string, artist_id string, session_id bigint, location string, user_agent string, "
        "year int, month int",
        "songplay_id",
        not_null=("start_time", "user_id", "session_id"),
        partition_by=("year", "month"),
    ),
    _contract(
        "users",
        "user_id bigint, first_name string, last_name string, gender string, level string",
        "user_id",
        sort_by=("user_id",),
    ),
    _contract(
        "songs",
        "song_id string, title string, artist_id string, year int, duration double",
        "song_id",
        sort_by=("song_id",),
    ),
    _contract(
        "artists",
        "artist_id string, name string, location string, latitude double, longitude double",
        "artist_id",
        sort_by=("artist_id",),
    ),
    _contract(
        "time",
        "start_time timestamp_ntz, hour int, day int, week int, month int, year int, weekday int",
        "start_time",
        sort_by=("start_time",),
    ),
    _contract(
        "immigration",
        "cicid int, i94res int, i94cit int, arrdate date, i94addr string, i94yr int, i94mon int, "
        "i94port string, i94mode int, i94visa int, visatype string, depdate date, "
        "dtaddto string, entdepa string, entdepd string, i94bir int, biryear int, "
        "gender string, airline string, stay int",
        "cicid",
        partition_by=("i94yr", "i94mon"),
    ),
    _contract(
        "immigration_counts",
        "column_name string, value string, n bigint, i94yr int, i94mon int",
        "column_name value i94yr i94mon",
        partition_by=("i94yr", "i94mon"),
    ),
    _contract(
        "arrivals_cube",
        "cube_set string, i94res int, i94addr string, i94visa int, i94mode int, gender string, arrivals bigint, "
        "ages bigint, age_sum bigint, age_min int, age_max int, i94yr int, i94mon int",
        "cube_set i94res i94addr i94visa i94mode gender i94yr i94mon",
        partition_by=("i94yr", "i94mon"),
    ),
    _contract(
        "date",
        "date date, year int, month int, day int, weekofyear int, dayofweek int",
        "date",
        not_null=("date",),
    ),
    _contract("country", "Code int, CountryName string, Temperature double", "Code"),
    _contract(
        "state",
        "State string, StateCode string, TotalPopulation bigint, MalePopulation bigint, "
        "FemalePopulation bigint, ForeignBorn bigint, NumberOfVeterans bigint, "
        "AmericanIndianAndAlaskaNative bigint, Asian bigint, BlackOrAfricanAmerican bigint, "
        "HispanicOrLatino bigint, White bigint, MedianAge double, AverageHouseholdSize double",
        "StateCode",
    ),
]

CONTRACTS: dict[str, TableContract] = {c.name: c for c in _CONTRACTS}

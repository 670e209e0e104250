"""Names, formats and rules that input files already follow.

A file written for the same data contract must be read unchanged, so these values are external
facts and not choices of this library. Inside the library English names are used throughout.
"""

# CSV / JSON header of a trip -> column name and type used here
TRIP_FIELDS = [
    ("trajet_id", "trip_id", "STRING"),
    ("velo_id", "vehicle_id", "STRING"),
    ("station_depart", "origin", "STRING"),
    ("station_arrivee", "destination", "STRING"),
    ("debut", "started_at", "TIMESTAMP"),
    ("fin", "ended_at", "TIMESTAMP"),
    ("duree_min", "duration_min", "DOUBLE"),
    ("distance_km", "distance_km", "DOUBLE"),
    ("type_usager", "rider_type", "STRING"),
    ("electrique", "electric", "INT"),
    ("tarif_eur", "fare_eur", "DOUBLE"),
]

# columns the cleaned table adds
CALENDAR_FIELDS = [
    ("heure", "hour", "INT"),
    ("jour_semaine", "weekday", "INT"),
    ("week_end", "weekend", "BOOLEAN"),
]

STATION_FIELDS = [
    ("station_id", "station_id", "STRING"),
    ("nom", "name", "STRING"),
    ("quartier", "district", "STRING"),
    ("latitude", "latitude", "DOUBLE"),
    ("longitude", "longitude", "DOUBLE"),
    ("capacite", "capacity", "INT"),
]

WEATHER_FIELDS = [
    ("date", "date", "DATE"),
    ("temperature_c", "temperature_c", "DOUBLE"),
    ("pluie_mm", "rain_mm", "DOUBLE"),
]

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIMESTAMP_OPTIONS = {"timestampFormat": TIMESTAMP_FORMAT, "timestampNTZFormat": TIMESTAMP_FORMAT}

# rider types
SUBSCRIBER = "abonne"
CASUAL = "occasionnel"

# kiosk log: event kind -> keys its line must carry
LOG_KINDS = {
    "RETRAIT": ["velo", "badge"],
    "DEPOT": ["velo", "duree"],
    "ERREUR": ["code", "message"],
}
PICKUP, DEPOSIT, ERROR = LOG_KINDS
LOG_STATION = r"^S\d{3}$"
LOG_PAIR = r'(\w+)=("[^"]*"|\S+)'  # key=value, the value quoted (it may hold spaces) or up to a space
LOG_TIMESTAMP_LENGTH = 19
LOG_ERRORS = [
    ("E12", "verrou bloqué"),
    ("E27", "lecteur de badge muet"),
    ("E42", "batterie non détectée"),
    ("E51", "écran figé"),
]

# duration classes (upper bound in minutes, exclusive) and rain classes
DURATION_CLASSES = [(10, "court"), (30, "moyen")]
LONG_CLASS = "long"
RAIN_CLASSES = ["sec", "pluie faible", "pluie forte"]
LIGHT_RAIN_BELOW_MM = 5

# fare rule, in euros and minutes
FREE_MINUTES = 30
SUBSCRIBER_STEP_EUR = 1.0
CASUAL_BASE_EUR = 1.0
CASUAL_MINUTE_EUR = 0.05
ELECTRIC_EXTRA_EUR = 0.5

# features of the rider-type models
AT_PICKUP = ["hour", "weekday", "weekend", "electric", "district_vec"]
AT_DROPOFF = [*AT_PICKUP, "duration_min", "distance_km"]

EARTH_RADIUS_KM = 6371.0


def ddl(fields, text_timestamps: bool = False, external: bool = True) -> str:
    """A DDL schema string for a field list, with the external or the internal names."""
    def spark_type(kind: str) -> str:
        return "STRING" if text_timestamps and kind == "TIMESTAMP" else kind

    return ", ".join(f"{outer if external else inner} {spark_type(kind)}" for outer, inner, kind in fields)


def rename_map(fields, to_external: bool = False) -> dict[str, str]:
    """External -> internal names (or the reverse) for `withColumnsRenamed`."""
    return {(inner if to_external else outer): (outer if to_external else inner) for outer, inner, _ in fields}

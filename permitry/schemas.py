"""Column layouts and fixed value sets shared by the operators."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_TEXT, _REAL, _INT = T.StringType(), T.DoubleType(), T.IntegerType()

SNAPSHOT_TEXT = [
    "BusinessName", "BusinessType", "BusinessSubType", "Status", "IssuedDate", "ExpiredDate",
    "House", "Street", "City", "Province", "Country", "PostalCode",
    "Latitude", "Longitude", "LocalArea",
]

SNAPSHOT = _struct(
    *[(c, _REAL if c in ("Latitude", "Longitude") else _TEXT) for c in SNAPSHOT_TEXT],
    ("YearRecorded", _INT),
)

SQUEEZED = _struct(
    ("BusinessName", _TEXT), ("IssueDate", _TEXT), ("ExpiryDate", _TEXT), ("Year", _INT),
    ("LastStatus", _TEXT), ("BusinessType", _TEXT), ("House", _TEXT), ("Street", _TEXT),
    ("City", _TEXT), ("Province", _TEXT), ("Country", _TEXT), ("PostalCode", _TEXT),
    ("Latitude", _REAL), ("Longitude", _REAL), ("LocalArea", _TEXT),
)

# The register is addressed by position; only these positions carry meaning.
REGISTER_POSITIONS = {
    "type": 0, "name_tail": 1, "issued": 3, "name_head": 4,
    "street": 7, "city": 8, "postal": 9, "expiry": 15,
}
REGISTER = _struct(*[(f"c{i}", _TEXT) for i in range(16)])

LICENCE_COLUMNS = [
    "DataSetOrigin", "BusinessName", "Status", "IssuedDate", "ExpiryDate", "BusinessType",
    "HouseStreet", "CityProvince", "PostalCode", "Latitude", "Longitude",
]
LICENCE = _struct(*[(c, _REAL if c in ("Latitude", "Longitude") else _TEXT) for c in LICENCE_COLUMNS])

ADDRESS_KEYS = ["HouseStreet", "CityProvince", "PostalCode"]
ADDRESS_KEYS_SPLIT = ["House", "Street", "City", "Province", "Country", "PostalCode"]


def address_cache(keys=ADDRESS_KEYS):
    """Layout of the address cache for a choice of key columns."""
    return _struct(
        ("IsUpdated", T.BooleanType()), *[(k, _TEXT) for k in keys],
        ("Latitude", _REAL), ("Longitude", _REAL),
    )


PREDICTIONS = _struct(
    ("BusinessType", _TEXT), ("City", _TEXT), ("Year", _INT), ("Stability", _REAL),
)

# The status domain of the licence data and the two groups used by the statistics.
STATUSES = [
    "Open", "Invalid Status Code", "Cancelled", "Gone Out of Business",
    "Issued", "Inactive", "Pending", "Closed",
]
ISSUED_STATUSES = ["Issued", "Open"]
CLOSED_STATUSES = ["Cancelled", "Closed", "Gone Out of Business"]
# The closed group as it was literally written, two names run together.
CLOSED_STATUSES_LITERAL = ["Cancelled", "ClosedGone Out of Business"]

# First and last year of the yearly statistics, of the forecast, and the open-licence expiry.
STATISTICS_YEARS = (1998, 2016)
FORECAST_YEARS = (2017, 2026)
OPEN_EXPIRY = "31-DEC-2017"

# Origin tags of the two registers.
ORIGIN_A, ORIGIN_B = "Van", "Tor"

# Stop words, the usual English list followed by words common in business types.
STOP_WORDS = """
all just being over both through yourselves its before herself
had should to only under ours has do them his
very they not during now him nor did this she
each further where few because doing some are our ourselves
out what for while does above between t be we
who were here hers by on about of against s
or own into yourself down your from her their there
been whom too themselves was until more himself that but
don with than those he me myself these up will
below can theirs my and then is am it an
as itself at have in any if again no when
same how other which you after most such why a
off i yours so the having once
services dealer historic other service office contractor temporary
""".split()

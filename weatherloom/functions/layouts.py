"""Fixed-width record layouts, as data.

Every scan is driven by one of the layouts below, so another archive format is
another ``SlotLayout`` or ``StationLayout`` value and needs no new parser.
Positions are 0-based and half-open, counted in bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -----------------------------------------------------------
MISSING_READING = -9999
MISSING_COORDINATE = -999.9

CORE_ELEMENTS = ("PRCP", "TMAX", "TMIN")
UNKNOWN_DATASET = "UNKNOWN"
UNKNOWN_ELEMENT = "Unknown"

# second dot-part of a three-part file name -> dataset
DATASET_BY_SUFFIX = {"raw": "RAW", "tob": "TOB"}
# a four-part file name always belongs to the fully corrected dataset
CORRECTED_DATASET = "FLS52"
# last dot-part of a file name -> element
ELEMENT_BY_SUFFIX = {"tmax": "Max", "tmin": "Min", "tavg": "Avg"}

# dataset names as they appear in archive names
ARCHIVE_DATASETS = ("raw", "tob", "FLs.52j")
ARCHIVE_ELEMENTS = ("tmax", "tmin", "tavg")

# the nine measures of the monthly output, in output order
MONTHLY_MEASURES = tuple(
    (f"{element.lower()}_{dataset.lower()}", element, dataset)
    for element in ("Max", "Min", "Avg")
    for dataset in ("RAW", "TOB", "FLS52")
)

# source flags from the most to the least trusted source
SOURCE_PRIORITY = "ZRD06CXWK7FBMfmrEzubsaGQIANTUHS"
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class SlotLayout:
    """A record with a header and a run of equally wide value slots."""

    name: str
    id: tuple[int, int]
    year: tuple[int, int]
    month: tuple[int, int] | None
    element: tuple[int, int] | None
    first_slot: int
    slot_width: int
    slots: int
    value_width: int
    scale: int
    flags: tuple[str, ...]
    # shortest line that is still a record
    min_length: int
    # True: a slot that the line does not reach completely holds no value
    whole_slots: bool


@dataclass(frozen=True)
class StationLayout:
    """A station-list record."""

    name: str
    latitude: tuple[int, int]
    longitude: tuple[int, int]
    elevation: tuple[int, int]
    country_code: tuple[int, int] = (0, 2)
    network_code: tuple[int, int] = (2, 3)
    id_placeholder: tuple[int, int] = (3, 5)
    coop_id: tuple[int, int] = (5, 11)
    state: tuple[int, int] = (38, 40)
    # the last field: a line whose trailing blanks were stripped ends inside it
    station_name: tuple[int, int] = (41, 71)
    min_length: int = 40


# --- fixed values: where the fields stand in a record -----------------------
DAILY = SlotLayout(
    name="daily",
    id=(0, 11),
    year=(11, 15),
    month=(15, 17),
    element=(17, 21),
    first_slot=21,
    slot_width=8,
    slots=31,
    value_width=5,
    scale=10,
    flags=("mflag", "qflag", "sflag"),
    min_length=21,
    whole_slots=True,
)

# The value field is six characters wide. A line may lack up to two trailing
# characters of its last slot (flags only), hence 123 and not 125.
MONTHLY = SlotLayout(
    name="monthly",
    id=(0, 11),
    year=(12, 16),
    month=None,
    element=None,
    first_slot=16,
    slot_width=9,
    slots=12,
    value_width=6,
    scale=100,
    flags=("dmflag", "qcflag", "dsflag"),
    min_length=123,
    whole_slots=False,
)

MONTHLY_NETWORK_STATIONS = StationLayout(
    name="monthly_network", latitude=(12, 20), longitude=(21, 30), elevation=(32, 37)
)
# The elevation field starts one column earlier here: "-999.9" takes all six.
DAILY_NETWORK_STATIONS = StationLayout(
    name="daily_network", latitude=(11, 20), longitude=(21, 30), elevation=(31, 37)
)
# ----------------------------------------------------------------------------

STATION_LAYOUTS = {
    layout.name: layout for layout in (MONTHLY_NETWORK_STATIONS, DAILY_NETWORK_STATIONS)
}

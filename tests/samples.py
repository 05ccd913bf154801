"""Small raw records for tests, as the columns of a real raw file."""

from __future__ import annotations

from casestar.config import RAW_TO_PUBLISHED
from casestar.schemas import RAW

HEADER = {name: raw for raw, name in RAW_TO_PUBLISHED.items()}

DEFAULTS = {
    "COLLISION_ID": "1", "CRASH DATE": "03/05/2020", "CRASH TIME": "5:07", "BOROUGH": "BRONX",
    "ZIP CODE": "10451", "ON STREET NAME": "MAIN STREET", "LATITUDE": "40.7", "LONGITUDE": "-73.9",
    "VEHICLE TYPE CODE 1": "Sedan", "CONTRIBUTING FACTOR VEHICLE 1": "Unspecified",
} | {raw: "0" for raw in RAW_TO_PUBLISHED if raw.startswith("NUMBER OF")}


def raw_frame(spark, *records: dict):
    """Records by published column name; what is not given gets a plain default."""
    rows = []
    for number, record in enumerate(records, start=1):
        values = DEFAULTS | {"COLLISION_ID": str(number)}
        values |= {HEADER[name]: value for name, value in record.items()}
        rows.append(tuple(values.get(raw) for raw in RAW_TO_PUBLISHED))
    return spark.createDataFrame(rows, RAW)

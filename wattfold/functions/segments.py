"""Customer segments: contract ranges, meter types, load factors and expected readings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RESIDENTIAL, COMMERCIAL, INDUSTRIAL = "residential", "commercial", "industrial"
SEGMENTS = (RESIDENTIAL, COMMERCIAL, INDUSTRIAL)

# Contract id ranges, expected hourly reading in kWh at load factor 1,
# load factors and the hours in which the peak factor holds.
RESIDENTIAL_CONTRACTS = (1, 10000)
COMMERCIAL_CONTRACTS = (10001, 10100)
EXPECTED_READING = {RESIDENTIAL: (2, 5), COMMERCIAL: (10, 100), INDUSTRIAL: (50, 500)}
EVENING_HOURS = (17, 23)
WAKING_HOURS = (8, 23)
OFFICE_HOURS = (8, 17)
PEAK, OFF_PEAK, PEAK_SUMMER, OFF_PEAK_SUMMER = "1.0", "0.6", "1.3", "0.9"


def _factor(value: str) -> Column:
    return F.lit(value).cast("decimal(2,1)")


def segment_of_contract(contract_id: Column) -> Column:
    return (
        F.when(contract_id.between(*RESIDENTIAL_CONTRACTS), RESIDENTIAL)
        .when(contract_id.between(*COMMERCIAL_CONTRACTS), COMMERCIAL)
        .otherwise(INDUSTRIAL)
    )


def meter_type(contract_id: Column) -> Column:
    return F.when(contract_id <= RESIDENTIAL_CONTRACTS[1], "single-phase").otherwise("three-phase")


def load_factor(segment: Column, moment: Column) -> Column:
    """Share of the expected reading at an instant; homes peak in the evening, firms in office hours."""
    hour = F.hour(moment)
    workday = F.weekday(moment) < 5
    summer = F.quarter(moment).isin(2, 4)
    evening, waking, office = (hour.between(*span) for span in (EVENING_HOURS, WAKING_HOURS, OFFICE_HOURS))
    home = (
        F.when(~workday, F.when(waking, _factor(PEAK)).otherwise(_factor(OFF_PEAK)))
        .when(summer, F.when(evening, _factor(PEAK_SUMMER)).otherwise(_factor(OFF_PEAK_SUMMER)))
        .otherwise(F.when(evening, _factor(PEAK)).otherwise(_factor(OFF_PEAK)))
    )
    firm = F.when(workday & office, _factor(PEAK)).otherwise(_factor(OFF_PEAK))
    return F.when(segment == RESIDENTIAL, home).otherwise(firm)


def expected_reading(segment: Column) -> tuple[Column, Column]:
    """Lowest and highest hourly reading of a segment at load factor 1."""
    bounds = []
    for side in (0, 1):
        pick = F.when(segment == RESIDENTIAL, EXPECTED_READING[RESIDENTIAL][side])
        pick = pick.when(segment == COMMERCIAL, EXPECTED_READING[COMMERCIAL][side])
        bounds.append(pick.otherwise(EXPECTED_READING[INDUSTRIAL][side]).cast("decimal(5,0)"))
    return bounds[0], bounds[1]

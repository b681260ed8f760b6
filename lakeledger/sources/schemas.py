"""Explicit schemas (as DDL) of the input tables; nothing is inferred from files."""

SERIES = {
    "sarea": "date date, area double",
    "inflow": "date date, streamflow double",
    "evaporation": "time date, OUT_EVAP double",
    "dels": "date date, area double, ds double, days_passed int",
    "outflow": "date date, outflow_rate double",
    "sar": "time timestamp, sarea double",
}
LANDSAT = ("mosaic_enddate date, from_date date, to_date date, water_area_cordeiro double, non_water_area_cordeiro double, "
           "cloud_area double, images int, corrected_area_cordeiro double")
SENTINEL2 = ("date date, PROCESSING_STATUS int, POSTPROCESSING_STATUS int, from_date date, to_date date, cloud_area double, "
             "cloud_percent double, water_area_uncorrected double, non_water_area double, water_area_corrected double")
CURVE = "CumArea double, Elevation double, Storage double, `Storage (mil. m3)` double, Elevation_Observed double"
OBSERVED_CURVE = "Elevation double, CumArea double"
RULE_CURVE = "Month int, `S/Smax` double"
STATIONS = "run int, name string, x double, y double, area double"
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

# Optical column names as delivered -> column names used here.
LANDSAT_NAMES = {"mosaic_enddate": "date", "water_area_cordeiro": "water_area", "non_water_area_cordeiro": "non_water_area",
                 "corrected_area_cordeiro": "corrected_area"}
SENTINEL2_NAMES = {"water_area_uncorrected": "water_area", "water_area_corrected": "corrected_area"}
# Altimeter extract: position in the line -> column.
EXTRACT = {9: "cycle", 10: "mjd", 11: "lon", 12: "lat", 13: "height", 14: "sig0"}
EXTRACT_WIDTH = 16
FLUXES = ["OUT_PREC", "OUT_EVAP", "OUT_RUNOFF", "OUT_BASEFLOW"]

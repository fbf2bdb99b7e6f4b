from levain.functions.dates import date_parts, sale_date
from levain.functions.geo import EARTH_RADIUS_KM, haversine_km
from levain.functions.json import json_path, parse_json_array, to_json_path
from levain.functions.text import clean_lower, string_columns, trim_columns

__all__ = ["date_parts", "sale_date", "EARTH_RADIUS_KM", "haversine_km", "json_path", "parse_json_array",
           "to_json_path", "clean_lower", "string_columns", "trim_columns"]

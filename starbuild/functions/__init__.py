from .scalars import date_key, date_parts, label_nulls, to_local_time, zone_of, zone_time

__all__ = ["date_key", "date_parts", "label_nulls", "to_local_time", "zone_of", "zone_time"]

from .tables import TABLES, load, load_all, events_stream  # noqa: F401

"""Sources: driver tables, the change log built from them, the calendar and
file / stream readers."""
